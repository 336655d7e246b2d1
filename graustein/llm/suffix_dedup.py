"""Removal of repeated byte strings by a sparse suffix array.

A byte goes when a string of ``LENGTH`` (200) bytes that covers it also starts anywhere else.
Sorting every suffix would move 20 bytes per byte of text, so the array is sparse:

1. One pass picks for every window of 200 bytes its anchor, the position of the window's
   least hashed 32-byte gram (leftmost of equals). Equal windows have their anchors at equal
   offsets. Neighbouring windows share an anchor, so about 1 % of the positions are anchors;
   each stands for a run of windows, and the bytes of that whole run have a class hash.
2. The suffixes at the anchors are range-partitioned by their leading bytes (Spark samples
   the splitters), and every bucket is sorted locally, key after key: leading bytes, gram,
   class. Suffixes with equal grams never straddle a boundary. A walk over the sorted
   bucket, holding two rows, compares neighbours: in a class of two or more, all windows of
   the run are repeated; where a gram has several classes, one run of each is open.
3. The texts meet their marks. Repeated runs are cut; the bytes of open runs (the ends of
   repeated passages, about 300 bytes each) go to buckets by gram, where their single windows
   are sorted and compared with their neighbours. A gram with more than ``GROUP`` open runs
   isn't gathered: its windows are range-partitioned, sorted and compared as in step 2.

Hashes of grams only bring suffixes together; runs and windows are equal when two
independent 64-bit polynomial hashes agree.

Defined cases: null text counts as empty; texts under 200 bytes lose nothing; rows with
equal id and text are two places of the same strings; a null id stays null; no rows give no
rows. Only the id and the text are read; texts are processed whole, in blocks of windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm import base
from graustein.llm.base import map_arrow, mix, seed, stored

LENGTH, GRAM = 200, 32
BLOCK_BYTES = 1 << 20
GROUP = 20_000
PLACE = np.uint64((1 << 24) - 1)

FACTORS = [0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15]
BYTES = [base.BYTE_HASH, mix(base.BYTE_HASH + seed(7))]
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(j: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of factor ``j`` and of its inverse, modulo 2**64."""
    if j not in _tables or len(_tables[j][0]) < n:
        out = []
        for f in (FACTORS[j], pow(FACTORS[j], -1, 1 << 64)):
            full = np.full(max(n, 1 << 16), np.uint64(f))
            full[0] = 1
            out.append(np.cumprod(full, dtype=np.uint64))
        _tables[j] = tuple(out)
    return _tables[j]


class Prefix:
    """Polynomial hashes of any stretch of ``data``."""

    def __init__(self, data: np.ndarray, j: int):
        power, self.inverse = _powers(j, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        value = BYTES[j][data]
        value *= power[:len(data)]
        np.cumsum(value, out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self) -> np.ndarray:
        n = len(self.sums) - GRAM
        return mix((self.sums[GRAM:] - self.sums[:n]) * self.inverse[:n])


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as a long in the order of the bytes."""
    full = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(len(at), np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | full[at + i].astype(np.uint64)
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def blocks(column: pa.Array):
    """(rows, offsets of their first bytes in the text, bytes, boundaries): many short texts at
    a time, or a stretch of a long one; stretches overlap so that each window is in one."""
    for i, j, data, offsets in base.slices(column, BLOCK_BYTES):
        if j - i > 1 or len(data) <= 2 * BLOCK_BYTES:
            yield np.arange(i, j), np.zeros(j - i, np.int64), data, offsets
            continue
        for a in range(0, len(data) - LENGTH + 1, BLOCK_BYTES):
            part = data[a:a + BLOCK_BYTES + LENGTH - 1]
            yield np.array([i]), np.array([a]), part, np.array([0, len(part)])


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(text number, anchor, first window, last window, prefixes) of every run of windows."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, []
    prefixes = [Prefix(data, j) for j in range(2)]
    key = prefixes[0].grams()
    key &= ~PLACE
    key |= np.arange(len(key), dtype=np.uint64)
    span = LENGTH - GRAM + 1
    width = 1
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if span > width:
        key = np.minimum(key[:-(span - width)], key[span - width:])
    place = (key & PLACE).astype(np.int64)  # of the anchor, for every window of the slice
    change = np.zeros(len(place) + 1, bool)
    change[1:-1] = place[1:] != place[:-1]
    lens = np.diff(offsets)
    has = np.flatnonzero(lens >= LENGTH)
    first, last = offsets[has], offsets[has] + lens[has] - LENGTH
    inside = np.zeros(len(place) + 1, np.int32)
    np.add.at(inside, first, 1)
    np.add.at(inside, last + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    change[first] = True
    lo = np.flatnonzero(change[:-1] & valid)
    text = np.searchsorted(offsets, lo, "right") - 1
    ends = np.zeros(len(lens), np.int64)
    ends[has] = last
    hi = np.minimum(np.append(lo[1:], len(place)) - 1, ends[text])
    return text, place[lo], lo, hi, prefixes


def _anchor_rows(batches):
    for batch in batches:
        for rows, shift, data, offsets in blocks(batch.column(2)):
            text, at, lo, hi, prefixes = anchors(data, offsets)
            if not len(text):
                continue
            runs = [(p.hash(lo, hi + LENGTH) ^ mix((at - lo).astype(np.uint64) + (hi - lo).astype(np.uint64) * np.uint64(512) + seed(j))).view(np.int64)
                    for j, p in enumerate(prefixes)]
            gram = prefixes[1].hash(at, at + GRAM).view(np.int64)
            take = pa.array(rows[text])
            move = (shift - offsets[:-1])[text]
            yield pa.record_batch([
                batch.column(0).take(take), batch.column(1).take(take), pa.array((lo + move).astype(np.int32)), pa.array((hi + move).astype(np.int32)),
                pa.array(leading(data, at)), pa.array(gram), pa.array(runs[0]), pa.array(runs[1]),
            ], ["id", "th", "lo", "hi", "lead", "gram", "c1", "c2"])


REPEATED, OPEN = 2, 1
MARK = ["id", "th", "kind", "lo", "hi", "lead", "gram"]
MARKS = "id {id}, th long, kind byte, lo int, hi int, lead long, gram long"


def compare_neighbours(batches):
    """Walks over rows sorted by (lead, gram, c1, c2) and yields marks: every row whose class
    has another row, as REPEATED, and the first row of every class whose gram has several
    classes, as OPEN. Between batches it holds the last row and the first of its gram."""
    held, told, said, many, twice = None, None, None, False, False

    def out(batch, which, kind):
        part = batch.take(pa.array(np.flatnonzero(which)))
        c = part.columns
        return pa.record_batch([c[0], c[1], pa.array(np.full(len(part), kind, np.int8)), *c[2:6]], MARK)

    for batch in batches:
        if not batch.num_rows:
            continue
        n_old = 0
        if held is not None:
            n_old = held.num_rows
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        n = batch.num_rows
        key = [batch.column(c).to_numpy() for c in range(4, 8)]
        new_gram = np.ones(n, bool)
        new_gram[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])
        new_class = new_gram.copy()
        new_class[1:] |= (key[2][1:] != key[2][:-1]) | (key[3][1:] != key[3][:-1])
        of = np.cumsum(new_gram) - 1
        several = np.bincount(of, weights=new_class) > 1
        again = ~new_class
        again[:-1] |= ~new_class[1:]
        flagged, opened = np.zeros(n, bool), np.zeros(n, bool)  # those already told
        if n_old:
            several[0] |= many
            again[n_old - 1] |= twice
            flagged[:n_old], opened[:n_old] = told, said
        yes = again & ~flagged
        yes[-1] = False
        if yes.any():
            yield out(batch, yes, REPEATED)
        rep = new_class & several[of] & ~opened
        if rep.any():
            yield out(batch, rep, OPEN)
        first = int(np.flatnonzero(new_gram)[-1])
        many, twice = bool(several[-1]), bool(again[-1])
        keep = [n - 1] if many or first == n - 1 else [first, n - 1]
        held = batch.take(pa.array(keep))
        told = np.array([i != n - 1 for i in keep])
        said = np.array([many] * len(keep))
    if held is not None and twice:
        yield out(held, np.array([False] * (held.num_rows - 1) + [True]), REPEATED)


def bucketed(rows: DataFrame, id_type: str) -> DataFrame:
    """Sampled splitters, local sort, neighbours compared."""
    ordered = rows.repartitionByRange("lead", "gram").sortWithinPartitions("lead", "gram", "c1", "c2")
    return map_arrow(ordered, compare_neighbours, MARKS.format(id=id_type))


def _window_hashes(data: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    return [Prefix(data, j).hash(start, start + LENGTH) for j in range(2)]


def resolve_open(group: int):
    """Rows (id, th, lo, gram, bytes) sorted by gram -> (id, th, kind, lo, lead, gram, c1): the
    windows that another open run has too, as REPEATED. Whole grams are gathered up to ``group``
    rows; the windows of a gram with more are passed on as OPEN."""

    def windows(rows):
        data, offsets = base.utf8(rows.column("bytes"))
        n = np.diff(offsets) - LENGTH + 1
        row = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = offsets[row] + inside
        return row, inside, data, at, _window_hashes(data, at)

    def told(rows, row, inside, kind, lead, a, b):
        take = pa.array(row)
        return pa.record_batch([
            rows.column("id").take(take), rows.column("th").take(take), pa.array(np.full(len(row), kind, np.int8)),
            pa.array((rows.column("lo").to_numpy()[row] + inside).astype(np.int32)),
            pa.array(lead), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["id", "th", "kind", "lo", "lead", "gram", "c1"])

    def compared(rows):
        row, inside, _, _, (a, b) = windows(rows)
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        hit = np.zeros(len(row), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        at = np.flatnonzero(hit)
        return told(rows, row[at], inside[at], REPEATED, np.zeros(len(at), np.int64), a[at], b[at])

    def passed_on(rows):
        row, inside, data, at, (a, b) = windows(rows)
        return told(rows, row, inside, OPEN, leading(data, at), a, b)

    def one(parts):
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    def run(batches):
        held, n, large, step = [], 0, None, max(1, group // 4)
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                gram = part.column("gram").to_numpy()
                if large is not None:  # the rest of a gram that has been passed on
                    k = int(np.argmax(gram != large)) if (gram != large).any() else len(gram)
                    if k:
                        yield passed_on(part.slice(0, k))
                    if k == len(gram):
                        continue
                    part, gram, large = part.slice(k), gram[k:], None
                held.append(part)
                n += len(gram)
                if n < group:
                    continue
                rows = one(held)
                gram = rows.column("gram").to_numpy()
                others = np.flatnonzero(gram != gram[-1])
                cut = int(others[-1]) + 1 if len(others) else 0
                if cut:
                    yield compared(rows.slice(0, cut))
                    held, n = [rows.slice(cut)], len(gram) - cut
                else:
                    yield passed_on(rows)
                    held, n, large = [], 0, gram[-1]
        if n:
            yield compared(one(held))
    return run


def _cut(data: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(bytes removed, maximal runs, sha256 of the rest) without [lo, hi + LENGTH) of the ranges."""
    kept, end, removed, runs = hashlib.sha256(), 0, 0, 0
    for lo, hi in sorted(ranges):
        stop = hi + LENGTH
        if lo > end or not runs:
            kept.update(data[end:lo])
            runs += 1
            removed += stop - lo
        else:
            removed += max(0, stop - end)
        end = max(end, stop)
    kept.update(data[end:])
    return removed, runs, kept.hexdigest()


def _pack(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield pa.record_batch([*batch.columns[:2], pa.array([pack(t.as_py().encode()) for t in batch.column(2)], pa.binary())], ["id", "th", "packed"])


RANGES = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
OPENS = pa.list_(pa.struct([("lo", pa.int32()), ("lead", pa.int64()), ("gram", pa.int64()), ("bytes", pa.binary())]))
RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
CUT = ("id {id}, th long, " + RESULT + ", ranges array<struct<lo:int,hi:int>>, "
       "opens array<struct<lo:int,lead:long,gram:long,bytes:binary>>, packed binary")


def _apply(batches):
    """Cuts the repeated runs; texts with open runs are kept, with the bytes of these runs."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for packed, marks in zip(batch.column(2), batch.column(3)):
            packed = packed.as_py()
            data = unpack(packed)
            ranges, opens = [], []
            for m in marks.as_py() or []:
                if m["kind"] == REPEATED:
                    ranges.append((m["lo"], m["hi"]))
                else:
                    opens.append({"lo": m["lo"], "lead": m["lead"], "gram": m["gram"], "bytes": data[m["lo"]:m["hi"] + LENGTH]})
            out.append((len(data), *_cut(data, ranges), [{"lo": a, "hi": b} for a, b in ranges] if opens else None, opens or None, packed if opens else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), RANGES, OPENS, pa.binary()]
        yield pa.record_batch([*batch.columns[:2], *(pa.array([r[i] for r in out], t) for i, t in enumerate(kinds))],
                              ["id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256", "ranges", "opens", "packed"])


def _cut_again(batches):
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for packed, ranges, found in zip(*batch.columns[1:4]):
            data = unpack(packed.as_py())
            out.append((len(data), *_cut(data, [(r["lo"], r["hi"]) for r in ranges.as_py()] + [(s, s) for s in found.as_py()])))
        yield pa.record_batch([batch.column(0), *(pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                              ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    # not written: sampling the splitters makes the suffixes a second time, which costs less than the disk
    suffixes = map_arrow(texts, _anchor_rows, f"id {id_type}, th long, lo int, hi int, lead long, gram long, c1 long, c2 long")
    marks = stored(bucketed(suffixes, id_type), "marks")
    listed = marks.groupBy(F.col("id").alias("mid"), F.col("th").alias("mth")).agg(
        F.collect_list(F.struct("kind", "lo", "hi", "lead", "gram")).alias("marks"))
    packed = map_arrow(texts, _pack, f"id {id_type}, th long, packed binary")
    met = packed.join(listed, (packed["th"] == listed["mth"]) & packed["id"].eqNullSafe(listed["mid"]), "left")
    cut = stored(map_arrow(met.select("id", "th", "packed", "marks"), _apply, CUT.format(id=id_type)), "cut")

    runs = cut.filter("packed IS NOT NULL").select("id", "th", F.explode("opens").alias("o")).select(
        "id", "th", F.col("o.lo").alias("lo"), F.col("o.lead").alias("lead"), F.col("o.gram").alias("gram"), F.col("o.bytes").alias("bytes"))
    gathered = runs.repartitionByRange("lead", "gram").sortWithinPartitions("lead", "gram").select("id", "th", "lo", "gram", "bytes")
    resolved = stored(map_arrow(gathered, resolve_open(group), f"id {id_type}, th long, kind byte, lo int, lead long, gram long, c1 long"), "resolved")
    left = resolved.filter(F.col("kind") == OPEN).select("id", "th", "lo", F.col("lo").alias("hi"), "lead", "gram", "c1", F.lit(0).cast("long").alias("c2"))
    found = resolved.filter(F.col("kind") == REPEATED).select("id", "th", "lo").unionByName(
        bucketed(left, id_type).filter(F.col("kind") == REPEATED).select("id", "th", "lo"))
    found = stored(found.groupBy(F.col("id").alias("mid"), F.col("th").alias("mth")).agg(F.collect_list("lo").alias("found")), "found")

    result = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    still = cut.filter("packed IS NOT NULL")
    key = (still["th"] == found["mth"]) & still["id"].eqNullSafe(found["mid"])
    again = map_arrow(still.join(found, key).select("id", "packed", "ranges", "found"), _cut_again, f"id {id_type}, {RESULT}")
    return cut.filter("packed IS NULL").select(*result).unionByName(still.join(found, key, "left_anti").select(*result)).unionByName(again)
