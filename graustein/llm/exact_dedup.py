"""Exact deduplication by two-pass Bloom filtering.

Pass 1 hashes every whole text (SHA-256, inside the JVM) and counts, up to two, how many
texts set each of a fixed number of filter positions. Pass 2 looks every digest up: only
digests whose positions were all set at least twice can be repeated. Those rows alone are
shuffled, as (digest, id), and grouped; all others pass straight through. A full filter
costs more shuffled rows, never a wrong answer; the texts themselves are never shuffled.

The filter has ``bits`` positions whatever the size of the corpus (default 2**26: 8 MB on
the driver and on each executor).

Defined cases: null text equals empty text; a null id counts as smaller than any other;
of rows that agree in text and id, exactly one stays; no rows give no rows. Columns other
than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm.base import keep_rows, map_arrow, stored, text_hash, utf8

BLOOM_BITS = 1 << 26
SEGMENTS = 64
HASHES = 2


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, id, th, digest) of every row; ``uid`` tells rows apart and is written once."""
    return stored(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("th"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest")), "digests")


def _positions(digest: pa.Array, bits: int) -> np.ndarray:
    """(rows, HASHES) filter positions, taken from separate bytes of the digest."""
    data, _ = utf8(digest)
    words = data.reshape(-1, 32)[:, :8 * HASHES].copy().view("<u8")
    return (words & np.uint64(bits - 1)).astype(np.int64)


def _count_positions(bits: int):
    """Rows (segment, once, twice): the positions that the rows of a task set, or set twice."""
    width = bits // SEGMENTS

    def run(batches):
        seen = []
        for b in batches:
            if b.num_rows:
                seen.append(_positions(b.column(0), bits).ravel())
        if not seen:
            return
        at, n = np.unique(np.concatenate(seen), return_counts=True)
        cut = np.searchsorted(at, np.arange(SEGMENTS + 1) * width)
        rows = [(s, at[i:j] - s * width, n[i:j]) for s, (i, j) in enumerate(zip(cut[:-1], cut[1:])) if i < j]
        yield pa.record_batch([
            pa.array([s for s, _, _ in rows], pa.int32()),
            pa.array([a[c == 1].astype("<u4").tobytes() for _, a, c in rows], pa.binary()),
            pa.array([a[c > 1].astype("<u4").tobytes() for _, a, c in rows], pa.binary()),
        ], ["segment", "once", "twice"])
    return run


def _merge_positions(bits: int):
    """Rows (segment, bitmap): the positions set at least twice by the rows of all tasks.
    Holds two bitmaps for each segment of the partition, however many rows arrive."""
    width = bits // SEGMENTS

    def run(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for s, once, twice in zip(*(c.to_pylist() for c in b.columns)):
                a, t = held.setdefault(s, (np.zeros(width, bool), np.zeros(width, bool)))
                once, twice = np.frombuffer(once, "<u4"), np.frombuffer(twice, "<u4")
                t[twice] = True
                t[once[a[once]]] = True
                a[once] = True
                a[twice] = True
        if held:
            yield pa.record_batch([pa.array(list(held), pa.int32()),
                                   pa.array([np.packbits(t).tobytes() for _, t in held.values()], pa.binary())],
                                  ["segment", "bitmap"])
    return run


def repeated_filter(digest_rows: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """The packed bitmap (``bits`` / 8 bytes) of the positions set at least twice."""
    counted = map_arrow(digest_rows.select("digest"), _count_positions(bits), "segment int, once binary, twice binary")
    merged = map_arrow(counted.repartition("segment"), _merge_positions(bits), "segment int, bitmap binary")
    full = np.zeros((SEGMENTS, bits // SEGMENTS // 8), np.uint8)
    for row in merged.collect():  # at most SEGMENTS rows, bits / 8 bytes together
        full[row["segment"]] = np.frombuffer(row["bitmap"], np.uint8)
    return full.ravel()


def _look_up(shared, bits: int):
    def run(batches):
        for b in batches:
            packed = shared.value
            at = _positions(b.column(3), bits)
            hit = ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
            yield pa.record_batch([*b.columns, pa.array(hit)], ["uid", "id", "th", "digest", "maybe"])
    return run


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BLOOM_BITS) -> DataFrame:
    """One row per row of ``docs``: uid, id, th, keep_id, group_size, kept, digest (binary)."""
    rows = digests(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(repeated_filter(rows, bits))
    looked = stored(map_arrow(rows, _look_up(shared, bits), f"uid long, id {id_type}, th long, digest binary, maybe boolean"), "looked")
    maybe = looked.filter("maybe").drop("maybe")
    of_group = maybe.groupBy("digest").agg(F.max(F.struct("id", "uid")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    shuffled = maybe.join(of_group, "digest").select(
        "uid", "id", "th", F.col("best.id").alias("keep_id"), "group_size", (F.col("best.uid") == F.col("uid")).alias("kept"), "digest")
    straight = looked.filter("NOT maybe").select(
        "uid", "id", "th", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return shuffled.unionByName(straight)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BLOOM_BITS) -> DataFrame:
    """``docs`` with one row for each distinct text (the one with the largest id), all columns kept."""
    return keep_rows(docs, groups(docs, id_col, text_col, bits).select("id", "th", "kept"), id_col, text_col)
