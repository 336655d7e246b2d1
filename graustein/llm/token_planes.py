"""Token ids on disk as bit-plane shuffled, zstandard-compressed chunks with an index.

Documents are range-partitioned and sorted by id, so the shards, the chunks in a shard and
the documents in a chunk are in ascending order. A chunk holds whole documents of about
``CHUNK_IDS`` ids. Its ids, as unsigned 32-bit integers, are cut into blocks of ``BLOCK``
(the last one filled up with zeros); every block is transposed into 4 byte planes or 32 bit
planes; plane p of all blocks is compressed by itself.

Files, written by Spark's committer (a lost task is written again):
``data/``  a row per chunk: shard, chunk, block, kind, n_ids, ids (document ids), lengths,
           plane_bytes, payload (the compressed planes in order)
``index/`` a row per chunk: shard, chunk, n_docs, n_ids, start (ids before it), payload_bytes,
           plane_bytes, payload_crc32

Defined cases: null text counts as empty and still gets its end id; a null document id sorts
first; rows with equal ids follow each other, ordered by a hash of their text; no rows give
empty tables. Only the id and the text are read. A text is encoded whole, in memory.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graustein.llm.base import map_arrow, slices
from graustein.llm.chunks import Encoded

BLOCK = 4096
CHUNK_IDS = 1 << 18
END_ID = 0
KNOWN, KNOWN_BYTES = 1_200_000, 64 << 20  # chunks whose ids a worker remembers: at most so many, and so many bytes

# How byte-level BPE files spell bytes: visible characters stand for themselves, the others for
# the characters from 256 on. (By rule; a fixed convention of the format.)
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLED = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_VISIBLE)))}
SPACE = chr(SPELLED[32])
MARKS = ".,;:!?"

_encoders: dict[str, Encoded] = {}


def encoder(path: str) -> Encoded:
    """The worker's encoder for a tokenizer file; kept between tasks."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

        one_word, marks = tokenizer.model.tokenize, {}

        def several(chunks: list[str]) -> list[bytes]:
            return [array("I", e.ids).tobytes() for i in range(0, len(chunks), 10_000)
                    for e in tokenizer.encode_batch_fast(chunks[i:i + 10_000], add_special_tokens=False)]

        def encode(chunks: list[str]) -> list[bytes]:
            # letters behind at most one space are one word for the model, as are marks after
            # them: those take the library's model alone, all others its whole tokenizer
            out, rest = [b""] * len(chunks), []
            for i, c in enumerate(chunks):
                word = c.rstrip(MARKS)
                space, letters = (SPACE, word[1:]) if word[:1] == " " else ("", word)
                if not letters.isalpha():
                    rest.append(i)
                    continue
                if not letters.isascii():
                    letters = letters.encode().decode("latin-1").translate(SPELLED)
                ids = array("I", [t.id for t in one_word(space + letters)]).tobytes()
                if len(word) < len(c):
                    end = c[len(word):]
                    if end not in marks:
                        marks[end] = several([end])[0]
                    ids += marks[end]
                out[i] = ids
            for i, ids in zip(rest, several([chunks[i] for i in rest])):
                out[i] = ids
            if len(marks) > 10_000:
                marks.clear()
            return out
        _encoders[path] = Encoded(encode, KNOWN, KNOWN_BYTES)
    return _encoders[path]


def to_planes(ids: np.ndarray, kind: str = "byte", block: int = BLOCK) -> list[bytes]:
    """The planes of all blocks: 4 byte planes, or 32 bit planes (least significant first)."""
    full = np.zeros(-(-len(ids) // block) * block, "<u4")
    full[:len(ids)] = ids
    parts = full.view(np.uint8).reshape(-1, block, 4)
    if kind == "byte":
        return [np.ascontiguousarray(parts[:, :, p]).tobytes() for p in range(4)]
    bits = np.unpackbits(parts, axis=2, bitorder="little")
    return [np.packbits(bits[:, :, p], axis=1).tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str = "byte", block: int = BLOCK) -> np.ndarray:
    if kind == "byte":
        parts = np.stack([np.frombuffer(p, np.uint8).reshape(-1, block) for p in planes], axis=2)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8).reshape(-1, block // 8), axis=1) for p in planes], axis=2)
        parts = np.packbits(bits, axis=2, bitorder="little")
    return np.ascontiguousarray(parts).reshape(-1).view("<u4")[:n]


DATA = ("shard int, chunk int, block int, kind string, n_ids long, ids array<{id}>, lengths array<long>, "
        "plane_bytes array<int>, payload binary")


def _write(path: str, kind: str):
    def run(batches):
        own, compress = encoder(path), zstandard.ZstdCompressor(level=3).compress
        shard, chunk, held_ids, held, size = 0, 0, [], [], 0

        def row():
            ids = np.frombuffer(b"".join(held), "<u4")
            planes = [compress(p) for p in to_planes(ids, kind)]
            lens = pa.array([len(x) // 4 for x in held], pa.int64())
            return pa.record_batch([
                pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([BLOCK], pa.int32()), pa.array([kind]),
                pa.array([len(ids)], pa.int64()), pa.ListArray.from_arrays([0, len(held)], pa.concat_arrays(held_ids)),
                pa.ListArray.from_arrays([0, len(held)], lens),
                pa.array([[len(p) for p in planes]], pa.list_(pa.int32())), pa.array([b"".join(planes)], pa.binary()),
            ], ["shard", "chunk", "block", "kind", "n_ids", "ids", "lengths", "plane_bytes", "payload"])

        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            if batch.num_rows:
                shard = batch.column(0)[0].as_py()
            for i, _, text, offsets in slices(batch.column(2), 4 << 20):
                flat, at = own.slice(text, offsets)
                data = flat.tobytes()
                for k, (a, b) in enumerate(zip(at.tolist(), at[1:].tolist())):
                    held.append(data[4 * a:4 * b] + end)
                    held_ids.append(batch.column(1).slice(i + k, 1))
                    size += b - a + 1
                    if size >= CHUNK_IDS:
                        yield row()
                        chunk, held_ids, held, size = chunk + 1, [], [], 0
        if held:
            yield row()
    return run


def write(docs: DataFrame, out: str, path: str, kind: str = "byte", id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes ``docs`` with the tokenizer file ``path`` and writes ``out``/data and ``out``/index."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ranged = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = ranged.select(F.spark_partition_id().alias("shard"), "id", "text")
    schema = DATA.format(id=texts.schema["id"].dataType.simpleString())
    map_arrow(rows, _write(path, kind), schema).write.mode("errorifexists").parquet(f"{out}/data")
    data = docs.sparkSession.read.parquet(f"{out}/data")
    each = data.select("shard", "chunk", F.size("ids").alias("n_docs"), "n_ids", "plane_bytes",
                       F.octet_length("payload").alias("payload_bytes"), F.crc32("payload").alias("payload_crc32"))
    # ids before each shard: one row per shard; before each chunk: within its shard
    shards = each.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    so_far = W.orderBy("shard").rowsBetween(W.unboundedPreceding, 0)
    before = shards.select("shard", (F.sum("n").over(so_far) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_ids")
    (each.withColumn("inside", inside).join(before, "shard")
     .select("shard", "chunk", "n_docs", "n_ids", (F.col("before") + F.col("inside")).alias("start"), "payload_bytes", "plane_bytes", "payload_crc32")
     .write.mode("errorifexists").parquet(f"{out}/index"))


def chunk_ids(block: int, kind: str, n_ids: int, plane_bytes: list[int], payload: bytes) -> np.ndarray:
    """The ids of a chunk, from its payload."""
    cut = np.concatenate([[0], np.cumsum(plane_bytes)])
    planes = [zstandard.ZstdDecompressor().decompress(payload[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return from_planes(planes, n_ids, kind, block)


def _read(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            get = lambda name: batch.column(name)[r]  # noqa: B023, E731
            ids = chunk_ids(get("block").as_py(), get("kind").as_py(), get("n_ids").as_py(), get("plane_bytes").as_py(), get("payload").as_py())
            data = ids.astype("<u4").tobytes()
            lens = get("lengths").values.to_numpy()
            ends = np.cumsum(lens)
            n = len(lens)
            yield pa.record_batch([
                pa.array([get("shard").as_py()] * n, pa.int32()), pa.array([get("chunk").as_py()] * n, pa.int32()), get("ids").values,
                pa.array(ends - lens), pa.array(lens), pa.array([data[4 * (e - m):4 * e] for e, m in zip(ends, lens)], pa.binary()),
            ], ["shard", "chunk", "id", "inside", "n_tokens", "ids"])


def read(spark: SparkSession, out: str, *values) -> DataFrame:
    """(id, start, n_tokens, ids) of every document, from the files; ``ids`` are the bytes of
    little-endian unsigned 32-bit integers. ``values`` (columns made of ``ids``) take its
    place where the ids themselves needn't be moved to meet the index."""
    data, index = spark.read.parquet(f"{out}/data"), spark.read.parquet(f"{out}/index")
    kind = data.schema["ids"].dataType.elementType.simpleString()
    docs = map_arrow(data, _read, f"shard int, chunk int, id {kind}, inside long, n_tokens long, ids binary")
    docs = docs.select("shard", "chunk", "id", "inside", "n_tokens", *(values or ["ids"]))
    starts = index.select("shard", "chunk", F.col("start").alias("before"))
    return docs.join(starts, ["shard", "chunk"]).withColumn("start", F.col("before") + F.col("inside")).drop("shard", "chunk", "inside", "before")


