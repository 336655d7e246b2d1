"""Byte-level BPE encoding and decoding by DuckDB recursive queries in every partition.

Each task keeps a DuckDB table of the pairs that merge (left id, right id, merged id; the
id is the rank) and one of the pieces. Token-position rows of the distinct words join the
merge table; in every step the leftmost pair of least rank of each word is contracted, until
no word has a pair left. Decoding joins a text's ids with the pieces and concatenates them
by an aggregate over the rows ordered by position (one DuckDB thread keeps that order).

The recursion keeps the rows of every step, so it costs a word its length squared. Words of
more than ``LONG`` bytes (runs without a pattern boundary) are therefore contracted by the
same rule with a heap of pairs; both give the same ids.

Defined cases: null text counts as empty and has no ids; a null id stays null; equal rows
each get their result; special tokens are ordinary text; no rows give no rows. Only the id
and the text are read.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm.base import map_arrow, release, slices
from graustein.llm.chunks import Encoded

LONG = 256
# words that are contracted at once: the recursion keeps about half of a word's length squared in rows, of 24 bytes
ROWS_AT_ONCE = 1 << 19
IDS_AT_ONCE = 1 << 17  # ids that are decoded at once (a longer text: all of its own)
# contracted chunks that a worker remembers from task to task: at most so many (about 40 bytes each),
# and so many bytes of chunks and ids
KNOWN, KNOWN_BYTES = 600_000, 32 << 20
SLICE = 1 << 20

CONTRACT = """
WITH RECURSIVE state AS (
  SELECT word, place, id, next_id, next_place, 0 AS step FROM start
  UNION ALL
  SELECT word, place, id, next_id, next_place, step FROM (
    WITH best AS (
      SELECT s.word, min(m.merged::BIGINT << 32 | s.place) AS pair
      FROM state s JOIN merges m ON m.a = s.id AND m.b = s.next_id GROUP BY s.word),
    hit AS (
      SELECT b.word, (b.pair >> 32)::INTEGER AS merged, l.place, l.next_place AS gone, r.next_id, r.next_place
      FROM best b JOIN state l ON l.word = b.word AND l.place = b.pair & 4294967295
      JOIN state r ON r.word = l.word AND r.place = l.next_place)
    SELECT s.word, s.place, CASE WHEN s.place = h.place THEN h.merged ELSE s.id END AS id,
           CASE WHEN s.place = h.place THEN h.next_id WHEN s.next_place = h.place THEN h.merged ELSE s.next_id END AS next_id,
           CASE WHEN s.place = h.place THEN h.next_place ELSE s.next_place END AS next_place, s.step + 1 AS step
    FROM state s JOIN hit h ON h.word = s.word WHERE s.place <> h.gone))
SELECT s.word, s.id FROM state s JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
ORDER BY s.word, s.place"""

DECODE = """
SELECT text, string_agg(piece, '') AS bytes
FROM (SELECT text, place, piece FROM tokens JOIN pieces USING (id) ORDER BY place) GROUP BY text ORDER BY text"""


def letters(data: bytes) -> str:
    """Bytes as characters 256 to 511, so that any byte string is a DuckDB string."""
    return (np.frombuffer(data, np.uint8).astype("<u2") + 256).tobytes().decode("utf-16-le")


def unletters(text: str) -> bytes:
    return (np.frombuffer(text.encode("utf-16-le"), "<u2") - 256).astype(np.uint8).tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Coder:
    """The tables of one vocabulary, in a DuckDB of the Python worker (memory only)."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        pairs = [(self.ranks[b[:i]], self.ranks[b[i:]], r) for b, r in self.ranks.items() for i in range(1, len(b))
                 if b[:i] in self.ranks and b[i:] in self.ranks]
        pairs = np.array(pairs, np.int32).reshape(-1, 3)
        self.pairs: dict[tuple[int, int], int] = {}  # of the merge table, when the first long word comes
        self._table("merges", pa.table({"a": pairs[:, 0], "b": pairs[:, 1], "merged": pairs[:, 2]}))
        self._table("pieces", pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "piece": [letters(b) for b in self.ranks]}))
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.encoded = Encoded(self.encode_chunks, KNOWN, KNOWN_BYTES)

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register("rows_of_" + name, rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows_of_{name}")
        self.con.unregister("rows_of_" + name)

    def contract(self, words: list[bytes]) -> list[bytes]:
        """The ids (as bytes) of words of up to ``LONG`` bytes, by the recursive query."""
        lens = np.array([len(w) for w in words], np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        at = (np.arange(len(ids)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)
        has_next = at + 1 < np.repeat(lens, lens)
        next_id = pa.array(np.append(ids[1:], 0).astype(np.int32), mask=~has_next)
        next_place = pa.array(at + 1, mask=~has_next)
        self.con.register("start", pa.table({"word": word, "place": at, "id": ids, "next_id": next_id, "next_place": next_place}))
        out = self.con.sql(CONTRACT).to_arrow_table()
        self.con.unregister("start")
        data = out["id"].to_numpy().astype("<u4").tobytes()
        cut = (4 * np.searchsorted(out["word"].to_numpy(), np.arange(len(words) + 1))).tolist()
        return [data[a:b] for a, b in zip(cut, cut[1:])]

    def contract_long(self, word: bytes) -> bytes:
        """The ids (as bytes) of one word by the same rule, with a heap: n log n."""
        if not self.pairs:
            self.pairs = {(a, b): r for a, b, r in self.con.execute("SELECT a, b, merged FROM merges").fetchall()}
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(self.pairs[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.pairs]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (p := (ids[left], ids[right])) in self.pairs:
                    heapq.heappush(heap, (self.pairs[p], left, *p))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        found = [self.pattern.findall(c) for c in chunks]
        ids, short, spelled = {}, [], []
        for w in set().union(*found) if found else ():
            raw = w.encode()
            if raw in self.ranks:
                ids[w] = self.ranks[raw].to_bytes(4, "little")
            elif len(raw) > LONG:
                ids[w] = self.contract_long(raw)
            else:
                short.append(w)
                spelled.append(raw)
        fresh = []
        for w, raw, held in zip(short, spelled, self.encoded.remembered(spelled)):
            if held is None:
                fresh.append((len(raw), w, raw))
            else:
                ids[w] = held
        fresh.sort()  # words of about one length take about as many steps
        group = np.cumsum([n * n for n, _, _ in fresh]) // (2 * ROWS_AT_ONCE)
        for at in np.split(np.arange(len(fresh)), np.flatnonzero(np.diff(group)) + 1):
            if len(at):
                ids.update(zip((fresh[i][1] for i in at), self.contract([fresh[i][2] for i in at])))
        get = ids.__getitem__
        return [get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws)) for ws in found]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each text's ids stand for, by sets of texts of about ``IDS_AT_ONCE`` ids."""
        ends = np.cumsum([len(x) // 4 for x in ids])
        cut = np.flatnonzero(np.diff(ends // IDS_AT_ONCE, append=-1)) + 1
        return [text for a, b in zip([0, *cut], cut) for text in self._decode(ids[a:b])]

    def _decode(self, ids: list[bytes]) -> list[bytes]:
        lens = np.array([len(x) // 4 for x in ids], np.int64)
        n = int(lens.sum())
        if not n:
            return [b""] * len(ids)
        self.con.register("tokens", pa.table({
            "text": np.repeat(np.arange(len(ids), dtype=np.int32), lens), "place": np.arange(n, dtype=np.int64),
            "id": np.frombuffer(b"".join(ids), "<u4").astype(np.int32)}))
        rows = self.con.sql(DECODE).to_arrow_table()
        self.con.unregister("tokens")
        out = [b""] * len(ids)
        for i, text in zip(rows["text"].to_pylist(), rows["bytes"].to_pylist()):
            out[i] = unletters(text)
        return out


_coders: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """The worker's coder for a vocabulary; kept between tasks."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def _code(path: str, pattern: str):
    def run(batches):
        own = coder(path, pattern)
        for batch in batches:
            for i, j, text, offsets in slices(batch.column(1), SLICE):
                flat, at = own.encoded.slice(text, offsets)
                data = flat.tobytes()
                ids = [data[4 * a:4 * b] for a, b in zip(at, at[1:])]
                decoded = own.decode(ids)
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                                      ["id", "ids", "decoded"])
                del text, flat, data, ids, decoded
                release()  # freed memory piles up over the slices of a task otherwise
    return run


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row: the ids as little-endian unsigned 32-bit integers, and
    the bytes that they decode to."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(texts, _code(path, pattern), f"id {texts.schema['id'].dataType.simpleString()}, ids binary, decoded binary")


def digests(coded: DataFrame) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256)."""
    return coded.select("id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


