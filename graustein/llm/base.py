"""Helpers shared by the operators: Arrow stages, scratch tables and word hashes.

The word helpers work on the UTF-8 bytes of many texts at once (numpy inside an Arrow
stage); every text is processed whole, in slices of about ``SLICE_BYTES`` bytes of texts so
that the working memory of a task does not grow with its partition.
"""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from graustein.session import checkpoint_dir

SLICE_BYTES = 1 << 19
BATCH_ROWS = 2000
BATCH_BYTES = 2 << 20
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def release() -> None:
    """Gives back what a worker's Arrow pool and the C library keep of freed memory: workers are
    reused, and one that goes on to other work should hold no more than it needs."""
    global _powers
    if len(_powers) > 1 << 16:
        _powers = np.ones(1, np.uint64)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose Python workers can import this package also when the driver process was
    started from another folder.

    Rows hold whole texts, so batches are bounded by rows and by bytes (a longer text makes a batch
    of its own). Spark reads both bounds from the session when the query starts: they stay set."""
    env = getattr(df.sparkSession.sparkContext, "environment", None)
    if env is not None and REPO not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, env.get("PYTHONPATH", "")) if x)
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release()
    return df.mapInArrow(run, schema)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back with its own schema.

    Cuts the lineage: what follows rereads files when an executor is lost."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the (n + 1) offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    if data is None or len(data) == 0:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``limit`` bytes;
    a longer text makes a slice of its own."""
    data, offsets = utf8(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seed(n: int) -> np.uint64:
    return mix(np.array([(n + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)], np.uint64))[0]


def text_hash(column):
    """xxhash64 of a text column, null as empty: with the id it tells apart rows of equal ids."""
    from pyspark.sql import functions as F
    return F.xxhash64(F.coalesce(column.cast("string"), F.lit("")))


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that ``decided`` (id, th, kept: a row for each of them) drops, all
    columns kept. Of rows that agree in id and text, as many stay as are kept; those of which some
    but not all stay take a pass of their own."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F
    per_key = stored(decided.groupBy("id", "th").agg(F.count_if(F.col("kept")).alias("stay"), F.count(F.lit(1)).alias("n"))
                     .filter("stay < n"), "dropped")
    key = "_text_hash"
    while key in docs.columns:
        key += "_"
    tagged = docs.withColumn(key, text_hash(docs[text_col]))
    match = lambda side: tagged[id_col].eqNullSafe(side["id"]) & (tagged[key] == side["th"])
    once = tagged.join(per_key, match(per_key), "left_anti").drop(key)
    one, some = per_key.filter("stay = 1"), per_key.filter("stay > 1")
    if not one.isEmpty():
        once = once.unionByName(tagged.join(one, match(one), "left_semi").dropDuplicates([id_col, key]).drop(key))
    if not some.isEmpty():
        nth = key + "_nth"
        while nth in docs.columns:
            nth += "_"
        by_key = W.partitionBy(id_col, key).orderBy(key)
        few = tagged.withColumn(nth, F.row_number().over(by_key)).alias("t").join(
            some.select(F.col("id").alias(nth + "_id"), F.col("th").alias(nth + "_th"), F.col("stay").alias(nth + "_stay")),
            F.col(id_col).eqNullSafe(F.col(nth + "_id")) & (F.col(key) == F.col(nth + "_th")) & (F.col(nth) <= F.col(nth + "_stay")))
        once = once.unionByName(few.select([F.col(f"t.`{c}`") for c in docs.columns]))
    return once


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
BYTE_HASH = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
POWER_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of ``POWER_BASE`` modulo 2**64."""
    global _powers
    if len(_powers) < n:
        full = np.full(max(n, 2 * len(_powers), 1024), POWER_BASE)
        full[0] = 1
        _powers = np.cumprod(full, dtype=np.uint64)
    return _powers[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the maximal runs of bytes outside ``space``, in order;
    no run crosses a text's end."""
    return mask_spans(~space[data], offsets)


def mask_spans(word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of the maximal runs of set places; no run crosses a text's end."""
    if not len(word):
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(len(word) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(word), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(word), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the disjoint, ascending byte spans (all of them non-empty)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    inside = np.arange(int(lens.sum()), dtype=np.int64)
    inside -= np.repeat(first, lens)
    at = inside + np.repeat(starts, lens)
    value = BYTE_HASH[data[at]] * powers(int(lens.max()))[inside]
    return mix(np.add.reduceat(value, first) + lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def windows(hashes: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``k`` words within one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes[:n]
    for i in range(1, k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[i:n + i])
    at = np.flatnonzero(text[:n] == text[k - 1:])
    return h[at], at


def shingles(hashes: np.ndarray, text: np.ndarray, n_texts: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct ``k``-word shingles of each text, sorted by both.
    A text with fewer than ``k`` words has its whole sequence as its one shingle."""
    h, at = windows(hashes, text, k)
    count = np.bincount(text, minlength=n_texts) if len(text) else np.zeros(n_texts, np.int64)
    short = np.flatnonzero((count > 0) & (count < k))
    first = np.searchsorted(text, short, "left") if len(short) else short
    s = np.zeros(len(short), np.uint64)
    for i in range(k):
        has = i < count[short]
        w = np.full(len(short), seed(77), np.uint64)  # marks an absent word
        w[has] = hashes[first[has] + i]
        s = mix(s * np.uint64(0x9E3779B97F4A7C15) + w + np.uint64(i + 1))
    doc = np.concatenate([text[at], short])
    h = np.concatenate([h, s])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        doc, h = doc[new], h[new]
    return doc, h


FILTER_BITS = 1 << 26


def bitmap_of(df: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A one-hash Bloom filter of the column's values: ``bits`` / 8 bytes, whatever the rows.
    ``filter_position`` gives the position of a value."""
    return bitmap_at(df.select(filter_position(column, bits).alias("p")), bits)


def bitmap_at(at: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The bitmap with the places ``p`` (from 1 on) set."""
    from pyspark.sql import functions as F
    parts = at.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map"))
    full = np.zeros((bits // 32768 + 1, 4096), np.uint8)
    for row in parts.collect():  # at most bits / 32768 rows of 4 KB
        full[row["bucket"] - 1] = np.frombuffer(row["map"], np.uint8)
    return full.ravel()


def filter_position(column: str, bits: int = FILTER_BITS):
    from pyspark.sql import functions as F
    return F.pmod(F.xxhash64(column), F.lit(bits)) + 1


def in_bitmap(full: np.ndarray, position: np.ndarray) -> np.ndarray:
    at = position - 1
    return (full[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
