"""Cutting texts at spaces where no match of the tokenizer's pattern can cross.

The pattern's matches hold a space only in front of a run of other characters or among
white space. So a space followed by a visible character always begins a match, what comes
before it ends one, and the chunks between such spaces can be encoded by themselves: the
same few chunks recur all the time and are encoded once."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from graustein.llm.base import span_hashes, utf8

# a space that isn't followed by a visible character: such texts are cut by the slower rule
ODD_SPACE = re.compile(r" (?=[\s\x00-\x20\x7f-\xa0]|\Z)")
BOUNDARY = re.compile(r"(?= [^\s\x00-\x20\x7f-\xa0])")


def cut(text: str) -> tuple[str, list[str]]:
    """(first chunk, the other chunks without the space in front of each)."""
    if ODD_SPACE.search(text) is None:
        parts = text.split(" ")
        return parts[0], parts[1:]
    parts = BOUNDARY.split(text)
    return parts[0], [p[1:] for p in parts[1:]]


# bytes that begin a visible character; of other characters (first bytes of U+0080 to U+00BF, U+1000 to
# U+3FFF among them) some are white space, and no text is cut in front of them
VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7F] = True
VISIBLE[0xC3:0xF5] = True
VISIBLE[0xE1:0xE4] = False


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the chunks of texts (UTF-8 bytes, offsets) begin; they follow each other without gaps, and
    a chunk holds the space in front of it."""
    start = np.zeros(len(data), bool)
    start[:-1] = (data[:-1] == 0x20) & VISIBLE[data[1:]]
    some = np.diff(offsets) > 0
    start[offsets[1:][some] - 1] = False  # a text's last space stays with what is before it
    start[offsets[:-1][some]] = True
    return np.flatnonzero(start)


def ragged(values: np.ndarray, first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``first`` and have ``lens`` elements, one after the other."""
    return values[np.arange(int(lens.sum())) + np.repeat(first - (np.cumsum(lens) - lens), lens)]


class Texts:
    """Byte strings, none of them empty, with their hashes: ``data`` from ``first`` on, ``lens`` bytes each."""

    def __init__(self, data: np.ndarray, first: np.ndarray, lens: np.ndarray, hashes: np.ndarray | None = None):
        self.data, self.first, self.lens = data, first, lens
        self.hashes = span_hashes(data, first, first + lens) if hashes is None else hashes

    @classmethod
    def of(cls, strings: list[bytes]) -> Texts:
        lens = np.array([len(x) for x in strings], np.int64)
        return cls(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lens) - lens, lens)

    def take(self, rows: np.ndarray) -> Texts:
        return Texts(self.data, self.first[rows], self.lens[rows], self.hashes[rows])

    def strings(self) -> list[bytes]:
        return [self.data[i:i + n].tobytes() for i, n in zip(self.first.tolist(), self.lens.tolist())]


class Table:
    """Chunks and their ids in flat arrays (about 40 bytes a chunk, where Python objects take 200). A chunk
    is found by its 64-bit hash and compared byte by byte."""

    def __init__(self):
        self.hashes, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # in the order of the hashes
        self.text, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.uint32)
        self.text_at, self.ids_at = np.zeros(1, np.int32), np.zeros(1, np.int32)

    def __len__(self) -> int:
        return len(self.hashes)

    def held(self) -> int:
        """Bytes of chunks and ids."""
        return len(self.text) + 4 * len(self.ids)

    def find(self, texts: Texts) -> np.ndarray:
        """The row of each text, -1 where there is none."""
        out = np.full(len(texts.lens), -1, np.int64)
        if not len(self) or not len(out):
            return out
        at = np.minimum(np.searchsorted(self.hashes, texts.hashes), len(self) - 1)
        row = self.row[at]
        like = np.flatnonzero((self.hashes[at] == texts.hashes) & (np.diff(self.text_at)[row] == texts.lens))
        if len(like):
            lens, row = texts.lens[like], row[like]
            differ = ragged(self.text, self.text_at[row], lens) != ragged(texts.data, texts.first[like], lens)
            equal = ~np.logical_or.reduceat(differ, np.cumsum(lens) - lens)
            out[like[equal]] = row[equal]
        return out

    def ids_of(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of the rows."""
        first = self.ids_at[row].astype(np.int64)
        lens = self.ids_at[row + 1] - first
        return ragged(self.ids, first, lens), lens

    def add(self, texts: Texts, ids: np.ndarray, lens: np.ndarray) -> None:
        """Takes texts that aren't in the table; of equal hashes only the first one (the others are encoded each time)."""
        hashes, new = np.unique(texts.hashes, return_index=True)
        if len(self):
            at = np.searchsorted(self.hashes, hashes)
            other = self.hashes[np.minimum(at, len(self) - 1)] != hashes
            hashes, new, at = hashes[other], new[other], at[other]
        else:
            at = np.zeros(len(new), np.int64)
        row = np.arange(len(self), len(self) + len(new), dtype=np.int32)
        first = (np.cumsum(lens) - lens)[new]
        self.text = np.concatenate([self.text, ragged(texts.data, texts.first[new], texts.lens[new])])
        self.ids = np.concatenate([self.ids, ragged(ids, first, lens[new])])
        self.text_at = np.concatenate([self.text_at, self.text_at[-1] + np.cumsum(texts.lens[new]).astype(np.int32)])
        self.ids_at = np.concatenate([self.ids_at, self.ids_at[-1] + np.cumsum(lens[new]).astype(np.int32)])
        self.hashes, self.row = np.insert(self.hashes, at, hashes), np.insert(self.row, at, row)


class Encoded:
    """The ids (unsigned 32-bit) of texts, from a bounded table of chunks.

    Chunks are numbered by dictionary encoding, so each distinct one of a slice is handled once, and
    numpy puts the ids of all texts together. ``encode(list of chunks) -> list of bytes`` does the
    encoding. The table has two halves: when the younger one would hold more than half of ``limit`` chunks
    or of ``limit_bytes`` bytes of chunks and ids, the older one goes and the younger takes its place.
    Chunks that are met again move to the younger half, so the frequent ones stay. Chunks of more than
    ``LONGEST`` bytes are encoded each time."""

    LONGEST = 1024

    def __init__(self, encode, limit: int = 600_000, limit_bytes: int = 32 << 20):
        self.encode, self.limit, self.limit_bytes = encode, limit // 2, limit_bytes // 2
        self.known, self.older = Table(), Table()

    def remembered(self, chunks: list[bytes]) -> list[bytes | None]:
        """The ids of those chunks that the table holds."""
        out: list[bytes | None] = [None] * len(chunks)
        short = [i for i, c in enumerate(chunks) if 0 < len(c) <= self.LONGEST]
        texts = Texts.of([chunks[i] for i in short])
        for half in (self.known, self.older):
            row = half.find(texts)
            for i, k in zip(np.flatnonzero(row >= 0).tolist(), row[row >= 0].tolist()):
                out[short[i]] = half.ids[half.ids_at[k]:half.ids_at[k + 1]].tobytes()
        return out

    def _of(self, data: np.ndarray, first: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, place of each chunk's first one, number of them) of distinct chunks."""
        start, size, parts, n = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64), [], 0

        def put(chunk, ids, count):
            nonlocal n
            start[chunk], size[chunk] = n + np.cumsum(count) - count, count
            parts.append(ids)
            n += len(ids)

        def encoded(texts):
            ids = self.encode([c.decode() for c in texts.strings()])
            return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)

        long = np.flatnonzero(lens > self.LONGEST)
        if len(long):
            put(long, *encoded(Texts(data, first[long], lens[long], np.zeros(len(long), np.uint64))))
        short = np.flatnonzero(lens <= self.LONGEST)
        texts = Texts(data, first[short], lens[short])
        row = self.known.find(texts)
        missing = np.flatnonzero(row < 0)
        if len(self.known) and (len(self.known) + len(missing) > self.limit or self.known.held() > self.limit_bytes):
            self.older, self.known, missing = self.known, Table(), np.arange(len(short))
        else:
            put(short[row >= 0], *self.known.ids_of(row[row >= 0]))
        row = self.older.find(texts.take(missing))
        for chunk, again in ((missing[row >= 0], row[row >= 0]), (missing[row < 0], None)):
            if len(chunk):
                some = texts.take(chunk)
                ids, count = encoded(some) if again is None else self.older.ids_of(again)
                put(short[chunk], ids, count)
                self.known.add(some, ids, count)
        return np.concatenate(parts), start, size

    def slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids) of texts as UTF-8 bytes and offsets."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        starts = chunk_starts(data, offsets)
        ends = np.append(starts, len(data))
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        spelled, at = utf8(chunks.dictionary)
        ids, first, size = self._of(spelled, at[:-1], np.diff(at))
        of = chunks.indices.to_numpy()
        lens = size[of]
        total = np.concatenate([[0], np.cumsum(lens)])
        return ragged(ids, first[of], lens), total[np.searchsorted(starts, offsets)]

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian bytes."""
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        flat, at = self.slice(np.frombuffer(b"".join(raw), np.uint8), offsets)
        data = flat.tobytes()
        return [data[4 * i:4 * j] for i, j in zip(at, at[1:])]


def text_slices(column, limit: int = 4 << 20):
    """(first row, list of texts) of consecutive rows of an Arrow string column with about
    ``limit`` characters; null counts as empty."""
    start, held, size = 0, [], 0
    for i, x in enumerate(column):
        t = x.as_py() or ""
        if held and size + len(t) > limit:
            yield start, held
            start, held, size = i, [], 0
        held.append(t)
        size += len(t)
    if held:
        yield start, held
