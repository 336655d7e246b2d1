"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The symbols of all distinct words of a slice of texts lie in one flat numpy array. A round takes, in
every word, the least rank of its neighbouring pairs (the rank orders pieces by their score, best
first), merges all leftmost non-overlapping pairs of that rank at once, closes the gaps, and looks up
the pairs at the changed places only. Words without a pair leave the array; rounds go on until no pair
remains. Words are cut in front of a space that follows another character, which no piece crosses, so
their merges are independent, and a word is contracted once however often it occurs in the slice.

Merging all pairs of a rank at once gives what one merge at a time gives if no merge makes a pair of the
same or a better rank. That is checked for each rank when the vocabulary is read. Where a rank fails
(pieces of equal score, such as the runs of spaces, or pieces better than a half of theirs) a word with one
such pair goes on as the others; a word with several is finished one merge at a time, best rank first and
leftmost among equals, from a heap.

Symbols are ids of pieces; a character that is no piece is the number of pieces plus its code point,
and becomes the ids of its UTF-8 bytes at the end. Decoding gathers the bytes of the pieces.

Models: BPE with byte fallback, the identity normaliser, a leading space added, spaces kept; others
raise ValueError. The sentencepiece library only reads the vocabulary.

Defined cases: null text counts as empty and has no ids; a null id stays null; equal rows each get their
result; strings of control pieces in a text are ordinary text; no rows give no rows. Only the id and
the text are read; texts are processed whole.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm import base
from graustein.llm.base import map_arrow

SLICE = 4 << 20
SPACE = "▁"  # a space, as pieces spell it
CHARACTERS = 0x110000
NONE = np.iinfo(np.int32).max


class Pieces:
    """The vocabulary of one model: pairs that merge, their ranks, and what the ids decode to."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        bytes_ = {names[i]: i for i in range(size) if model.is_byte(i)}
        ids = {n: i for i, n in enumerate(names) if not special[i]}
        crossing = any(a != SPACE and b == SPACE for n in ids for a, b in zip(n, n[1:]))
        if len(bytes_) < 256 or crossing or any(model.is_unused(i) for i in range(size)) or model.normalize(" a  Ａ ") != "▁▁a▁▁Ａ▁":
            raise ValueError(f"{path}: not a BPE model with byte fallback, words cut at spaces and texts left as they are")
        self.size = size
        self.byte_id = np.array([bytes_[f"<0x{b:02X}>"] for b in range(256)], np.int32)
        self.symbol = np.arange(size, size + CHARACTERS, dtype=np.int32)  # of a code point
        for n, i in ids.items():
            if len(n) == 1:
                self.symbol[ord(n)] = i
        scores = {n: model.get_score(i) for n, i in ids.items()}
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs, unsafe = {}, set()
        of = lambda half: ids.get(half, size + ord(half) if len(half) == 1 else None)
        for n, i in ids.items():
            r = rank[scores[n]]
            for cut in range(1, len(n)):
                a, b = of(n[:cut]), of(n[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = r, i
                    # made by merging one of its halves first, this pair must come after that merge
                    unsafe.update(rank[scores[h]] for h in (n[:cut], n[cut:]) if len(h) > 1 and rank[scores[h]] >= r)
        self.pairs = pairs
        self.unsafe = np.zeros(len(rank) + 1, bool)
        self.unsafe[list(unsafe)] = True
        keys = np.array([a * self.width + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)[order]
        self.rank_of, self.merged = np.append(values[:, 0], NONE).astype(np.int32), np.append(values[:, 1], 0).astype(np.int32)
        # what an id decodes to
        spelled = [bytes([int(n[3:5], 16)]) if n in bytes_ else b"" if model.is_control(i) else n.replace(SPACE, " ").encode()
                   for i, n in enumerate(names)]
        spelled[model.unk_id()] = " ⁇ ".encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.ends = np.cumsum([len(s) for s in spelled])
        self.lens = np.diff(self.ends, prepend=0)
        self.is_byte, self.is_control = np.zeros(size, bool), np.array([model.is_control(i) for i in range(size)])
        self.is_byte[self.byte_id] = True
        self.spaced = np.array([n.startswith(SPACE) and not s for n, s in zip(names, special)])

    @property
    def width(self) -> int:
        return self.size + CHARACTERS

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs; rank ``NONE`` where they don't merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.rank_of[at], NONE), self.merged[at]

    def contract(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word) after all merges; ``word`` ascends and says whose symbol it is."""
        done = []
        rank, merged = np.full(len(symbols), NONE, np.int32), np.zeros(len(symbols), np.int32)  # of the pair that starts here
        here = np.flatnonzero(word[1:] == word[:-1])
        rank[here], merged[here] = self.look_up(symbols[here], symbols[here + 1])
        while len(symbols):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lens = np.diff(np.append(first, len(symbols)))
            least = np.minimum.reduceat(rank, first)
            over = least == NONE
            wanted = rank == np.repeat(least, lens)
            several = np.add.reduceat(wanted, first, dtype=np.int64) > 1
            slow = ~over & several & self.unsafe[np.minimum(least, len(self.unsafe) - 1)]
            if over.any() or slow.any():
                out = np.repeat(over, lens)
                done.append((symbols[out], word[out]))
                for w in np.flatnonzero(slow).tolist():
                    rest = self.one_by_one(symbols[first[w]:first[w] + lens[w]].tolist())
                    done.append((np.array(rest, np.int32), np.full(len(rest), word[first[w]])))
                stay = ~np.repeat(over | slow, lens)
                symbols, word, rank, merged, wanted = symbols[stay], word[stay], rank[stay], merged[stay], wanted[stay]
                if not len(symbols):
                    break
            hit = np.flatnonzero(wanted)
            # of pairs that overlap, every second one from the left
            new = np.ones(len(hit), bool)
            new[1:] = hit[1:] != hit[:-1] + 1
            nth = np.arange(len(hit))
            hit = hit[(nth - np.maximum.accumulate(np.where(new, nth, 0))) % 2 == 0]
            symbols[hit] = merged[hit]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            at = (np.cumsum(stay) - 1)[hit]
            symbols, word, rank, merged = symbols[stay], word[stay], rank[stay], merged[stay]
            mark = np.zeros(len(symbols), bool)
            mark[at] = True
            mark[at[at > 0] - 1] = True
            changed = np.flatnonzero(mark)
            rank[changed] = NONE
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], merged[changed] = self.look_up(symbols[changed], symbols[changed + 1])
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def one_by_one(self, symbols: list[int]) -> list[int]:
        """The same rule, one merge at a time: best rank first, leftmost among equals."""
        n, pairs = len(symbols), self.pairs
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(*pairs[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs]
        heap = [(r, i, m, a, b) for r, m, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, piece, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # one of the two has been merged since
            symbols[i], symbols[j], after[i] = piece, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (p := (symbols[left], symbols[right])) in pairs:
                    r, m = pairs[p]
                    heapq.heappush(heap, (r, left, m, *p))
        return [s for s in symbols if s >= 0]

    def with_bytes(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece as the ids of their UTF-8 bytes."""
        strange = np.flatnonzero(symbols >= self.size)
        if not len(strange):
            return symbols, word
        point = symbols[strange] - self.size
        length = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        lens = np.ones(len(symbols), np.int64)
        lens[strange] = length
        out, at = np.repeat(symbols, lens), (np.cumsum(lens) - lens)[strange]
        head = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for k in range(4):
            some = length > k
            bits = point[some] >> (6 * (length[some] - 1 - k))
            byte = bits | head[length[some]] if k == 0 else (bits & 0x3F) | 0x80
            out[at[some] + k] = self.byte_id[byte]
        return out, np.repeat(word, lens)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids) of texts as UTF-8 bytes, SPACE as a space."""
        lens = np.diff(offsets)
        some = lens > 0
        shift = np.cumsum(some)
        text = np.full(len(data) + int(some.sum()), 0x20, np.uint8)  # a space in front of every text
        text[np.arange(len(data)) + np.repeat(shift, lens)] = data
        offsets = offsets + np.concatenate([[0], shift])
        if not len(text):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        space = text == 0x20
        start = np.empty(len(text), bool)
        start[0] = True
        start[1:] = space[1:] & ~space[:-1]
        start[offsets[:-1][some]] = True
        starts = np.flatnonzero(start)
        cut = np.append(starts, len(text))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(text)]).dictionary_encode()
        of = words.indices.to_numpy()
        ids, word = self._words(words.dictionary)
        # the ids of every word, in order
        size = np.bincount(word, minlength=len(words.dictionary))
        first = np.cumsum(size) - size
        lens = size[of]
        total = np.concatenate([[0], np.cumsum(lens)])
        flat = ids[np.arange(int(total[-1])) + np.repeat(first[of] - total[:-1], lens)]
        return flat, total[np.searchsorted(starts, offsets)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, word) of distinct words."""
        data, offsets = base.utf8(words)
        lead = (data & 0xC0) != 0x80
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        points = np.where(points == 0x20, ord(SPACE), points)
        word = np.searchsorted(offsets, np.flatnonzero(lead), "right") - 1
        return self.with_bytes(*self.contract(self.symbol[points], word))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of ids; ``offsets`` says where each text's ids begin."""
        lens = self.lens[ids]
        # the space in front of a text isn't part of it: the first piece that isn't a control loses it
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        shown = np.flatnonzero(~self.is_control[ids])
        first = shown[np.append(True, text[shown][1:] != text[shown][:-1])] if len(shown) else shown
        first = first[self.spaced[ids[first]]]
        begin = (self.ends - self.lens)[ids]
        begin[first] += 1
        lens[first] -= 1
        at = np.cumsum(lens) - lens
        out = self.spelled[np.arange(int(lens.sum())) + np.repeat(begin - at, lens)]
        ends = np.append(at, int(lens.sum()))[offsets]
        raw = out.tobytes()
        try:
            raw.decode()
            return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw))
        except UnicodeDecodeError:  # ids that no text has: each byte that is no part of a character becomes U+FFFD
            return pa.array([lenient(raw[a:b]) for a, b in zip(ends, ends[1:])], pa.string())


def lenient(raw: bytes) -> str:
    """UTF-8 decoded; every single byte that is no part of a character becomes U+FFFD."""
    out = []
    while True:
        try:
            out.append(raw.decode())
            return "".join(out)
        except UnicodeDecodeError as e:
            out.append(raw[:e.start].decode() + "�")
            raw = raw[e.start + 1:]


_known: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's vocabulary of a model file; kept between tasks."""
    if path not in _known:
        _known[path] = Pieces(path)
    return _known[path]


def _code(path: str):
    def run(batches):
        own = pieces(path)
        for batch in batches:
            texts = pc.replace_substring(pc.fill_null(batch.column(1), ""), SPACE, " ")
            for i, j, data, offsets in base.slices(texts, SLICE):
                ids, cut = own.encode(data, offsets)
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids)),
                                       own.decode(ids, cut)], ["id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row: the ids as an array of int, and the text that they decode to."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(texts, _code(path), f"id {texts.schema['id'].dataType.simpleString()}, ids array<int>, decoded string")


def _decode(path: str):
    def run(batches):
        own = pieces(path)
        for batch in batches:
            column = pc.fill_null(batch.column(1), [])
            ids = column.values.slice(column.offsets[0].as_py()).to_numpy(zero_copy_only=False) if batch.num_rows else np.zeros(0, np.int32)
            cut = column.offsets.to_numpy() - column.offsets[0].as_py()
            yield pa.record_batch([batch.column(0), own.decode(ids[:cut[-1]], cut)], ["id", "text"])
    return run


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(id, text) of rows (id, ids); null ids count as none."""
    rows = coded.select("id", F.col("ids").cast("array<int>").alias("ids"))
    return map_arrow(rows, _decode(path), f"id {rows.schema['id'].dataType.simpleString()}, text string")
