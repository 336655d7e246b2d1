"""Large JSON arrays read by many tasks.

A file that is one JSON list, or one object with a list, is one record for the JSON reader: one task
holds all of it. Here Spark's text source reads it on byte ranges, cut at line ends or, where a file has a
line of more than ``LINE_BYTES`` (a document in one line), at every ``}``. Such lines are skipped by the line reader, so the
lines' bytes tell which files have them. The state between the blocks is carried by two levels of running sums:

1. The task that reads a block (a byte range of the file) counts quotes and brackets through it.
   It doesn't know how its block begins, so it keeps the sums for both cases, inside a string or not, and
   gives one row: what the block changes, and how many objects it closes at each relative depth.
2. These rows (file size / ``spark.sql.files.maxPartitionBytes``) are summed up over the file: the
   string state, the depth and the number of the item with which each block starts. Joined back, every
   block knows its depth.

A ``}`` that closes an object at the list's depth ends an item. The bytes up to it are its
text, which ``from_json`` parses. The texts are not shuffled: a block's task cuts its items out of the Arrow
batches as they lie there, and only those that lie in several blocks meet by their number. Nothing larger than a batch
or an item is held by one task.

Files are UTF-8. What the JSON reader would drop as malformed gives null fields here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graustein.session import arrow_stage, written_copy

BLOCK_SUMS = ("file string, block long, size long, bytes long, flips int, t0 long, t1 long, head string, "
              "closes array<struct<begins: int, depth: long, n: long>>")
BLOCK_ITEMS = "id long, n long, raw string, ended boolean, whole boolean, plain boolean"
LINE_BYTES = 32 << 10

CHANGE = np.zeros(256, np.int8)
CHANGE[[ord("{"), ord("[")]], CHANGE[[ord("}"), ord("]")]] = 1, -1
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BLANK = SPACE.copy()
BLANK[list("\ufeff".encode())] = True


def _line_bytes(spark: SparkSession, most: int) -> int:
    """Lines of so many bytes count as long: ``most``, or a block's bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]?)b?\s*", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return max(64, min(most, int(number) << {"": 0, "k": 10, "m": 20, "g": 30}.get(unit, 40)))


def _pieces(spark: SparkSession, path: str, larger_than: int = -1, sep: str = "}", longest: int | None = None) -> DataFrame:
    """(file, block, size, last, text): the text up to each ``sep``, which ends it, in the order of the block; those of
    ``longest`` bytes or more are left out. ``last``: the block is the file's last one."""
    reader = spark.read.option("lineSep", sep)
    if longest is not None:
        reader = reader.option("mapreduce.input.linerecordreader.line.maxlength", longest)
    m = lambda name: F.col(f"_metadata.{name}")
    return reader.text(path).filter(m("file_size") > larger_than).select(
        m("file_path").alias("file"), m("file_block_start").alias("block"), m("file_size").alias("size"),
        (m("file_block_start") + m("file_block_length") >= m("file_size")).alias("last"), F.concat("value", F.lit(sep)).alias("text"))


def _blocks(batches, *by: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The batches cut where a block ends: (the columns that name it, its next rows)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c) for c in by]
        changes = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            changes |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        at = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for low, high in zip(at, at[1:]):
            yield tuple(c[low].as_py() for c in columns), batch.slice(low, high - low)


def _bytes(texts: pa.Array) -> np.ndarray:
    """The texts' bytes, one text behind the other."""
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]


def _escaped(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` lie behind an odd number of backslashes."""
    back = np.flatnonzero(data == 92)
    starts = back[np.concatenate(([True], np.diff(back) > 1))]  # of runs of backslashes
    ends = back[np.concatenate((np.diff(back) > 1, [True]))]
    run = np.searchsorted(ends, at - 1)
    run[run == len(ends)] = 0
    return (ends[run] == at - 1) & ((ends[run] - starts[run]) % 2 == 0)


def _sums(data: np.ndarray, state: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], tuple[int, int, int]]:
    """Every ``}``, by running sums from the block's start: its place, the quotes' parity there, and the
    change of depth behind it if the block begins outside or inside a string; and the state for the next bytes."""
    quotes = data == 34
    if (data == 92).any():
        at = np.flatnonzero(quotes)
        quotes[at[_escaped(data, at)]] = False
    parity = np.bitwise_xor.accumulate(quotes.view(np.uint8))
    change = CHANGE[data]
    at = np.flatnonzero(change)
    change, inside = change[at].astype(np.int64), parity[at] ^ np.uint8(state[0])
    depths = [state[1 + begins] + np.cumsum(np.where(inside == begins, change, 0)) for begins in (0, 1)]
    state = (int(parity[-1]) ^ state[0], *(int(d[-1]) if len(at) else state[1 + b] for b, d in enumerate(depths)))
    closes = data[at] == 125
    return at[closes], inside[closes], [d[closes] for d in depths], state


def _last_close(data: np.ndarray, last: bool) -> bool:
    """Whether a last object that isn't closed ends here: the text behind a file's last ``}`` counts as one."""
    return last and len(data) > 0 and data[-1] != 125


CLOSE = np.array([125], np.uint8)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block (``BLOCK_SUMS``)."""
    names = ["file", "block", "size", "bytes", "flips", "t0", "t1", "head", "closes"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(),
             pa.list_(pa.struct([("begins", pa.int32()), ("depth", pa.int64()), ("n", pa.int64())]))]
    now = None

    def count(data):
        nonlocal state
        _, inside, depths, state = _sums(data, state)
        for begins in (0, 1):
            for depth, n in zip(*(x.tolist() for x in np.unique(depths[begins][inside == begins], return_counts=True))):
                closes[begins, depth] = closes.get((begins, depth), 0) + n

    def row():
        if _last_close(data, last):
            count(CLOSE)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((
            *now, size, held, *state, head, [{"begins": b, "depth": d, "n": n} for (b, d), n in closes.items()]), types)], names=names)
    for key, rows in _blocks(batches, "file", "block"):
        texts = rows.column("text")
        if key != now:
            if now is not None:
                yield row()
            now, size, last, held, state, closes, head = key, rows.column("size")[0].as_py(), rows.column("last")[0].as_py(), 0, (0, 0, 0), {}, ""
        data = _bytes(texts)
        held += len(data)
        if not head and len(at := np.flatnonzero(~BLANK[data])):
            head = "[" if data[at[0]] == 91 else "other"
        count(data)
    if now is not None:
        yield row()


def _behind_comma(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the item begins in the text from each of ``starts``, if that is a comma and ``{`` with white
    space around: (the place, whether it is so)."""
    at, most = starts.copy(), len(data) - 1

    def skip():
        left = np.flatnonzero(SPACE[data[at]])
        while len(left):
            at[left] = np.minimum(at[left] + 1, most)
            left = left[SPACE[data[at[left]]] & (at[left] < most)]
    skip()
    comma = data[at] == 44
    at[comma] = np.minimum(at[comma] + 1, most)
    skip()
    return at, comma & (data[at] == 123)


def _block_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The items of each block (``BLOCK_ITEMS``); ``whole`` if nothing of an item can lie in another block. ``plain``
    ones are whole and without the comma before them. The text of an item's last part ends with its ``}``."""
    now = None

    def strings(data, starts, ends):
        offsets = np.concatenate(([0], np.cumsum(ends - starts)))
        if offsets[-1] != len(data):
            kept = np.zeros(len(data) + 1, np.int8)
            kept[starts] += 1
            kept[ends] -= 1
            data = data[np.cumsum(kept[:-1], dtype=np.int8).view(bool)]
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())

    def batch(numbers, raw, ended, whole, plain):
        k = len(numbers)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(k, now[0])), pa.array(numbers), raw, pa.array(np.full(k, ended)), pa.array(whole), pa.array(plain)],
            names=["id", "n", "raw", "ended", "whole", "plain"])

    def items(data):
        """The items that end in the next bytes; what is left of them waits in ``rest``."""
        nonlocal state, rest, n, whole
        at, inside, depths, state = _sums(data, state)
        ends = at[(inside == begins) & (depths[begins] + depth == level)] + 1
        if not len(ends):
            rest.append(data)
            return None
        if rest:
            ends, data = ends + sum(map(len, rest)), np.concatenate([*rest, data])
        starts = np.concatenate(([0], ends[:-1]))
        first, plain = _behind_comma(data, starts)
        entire = np.full(len(ends), True)
        entire[0] = whole
        plain &= entire
        out = batch(n + np.arange(len(ends)), strings(data, np.where(plain, first, starts), ends), True, entire, plain)
        rest, n, whole = [data[ends[-1]:]] if ends[-1] < len(data) else [], n + len(ends), True
        return out

    def end():
        """What the block ends with."""
        if _last_close(data, last) and (out := items(CLOSE)) is not None:
            yield out
        if rest:
            left = np.concatenate(rest)
            yield batch(np.array([n]), strings(left, np.array([0]), np.array([len(left)])), False, np.array([False]), np.array([False]))
    for key, rows in _blocks(batches, "id"):
        if key != now:
            if now is not None:
                yield from end()
            begins, depth, level, n, last, first_block = (rows.column(c)[0].as_py() for c in ("begins", "depth", "level", "earlier", "last", "first"))
            now, state, rest, whole = key, (0, 0, 0), [], first_block
        data = _bytes(rows.column("text"))
        if (out := items(data)) is not None:
            yield out
    if now is not None:
        yield from end()


def _before(value, by, order) -> F.Column:
    """The sum of ``value`` over the rows before this one."""
    return F.coalesce(F.sum(value).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _with_long_lines(spark: SparkSession, path: str, larger_than: int, sums: DataFrame) -> DataFrame:
    """(file) of the files some of whose bytes are in no line: long lines are left out. A byte order mark
    has three bytes; file sizes only, no contents."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("length")).filter(F.col("length") > larger_than)
    lines = sums.groupBy("file").agg(F.sum("bytes").alias("bytes"))
    return files.join(lines, "file", "left").filter(F.coalesce("bytes", F.lit(0)) + 3 < F.col("length")).select("file")


def item_texts(spark: SparkSession, path: str, container: str | None = "elements", larger_than: int = -1, line_bytes: int = LINE_BYTES) -> DataFrame:
    """(file, n, text) of every object in the list that a file is, or in the list ``container`` of the
    object that a file is; ``n`` ascends in the file's order. Only of files with more than ``larger_than`` bytes."""
    pieces = _pieces(spark, path, larger_than, "\n", _line_bytes(spark, line_bytes))
    sums = written_copy(arrow_stage(pieces, _block_sums, BLOCK_SUMS), "line_sums")
    long = written_copy(_with_long_lines(spark, path, larger_than, sums), "long_lines")
    if not long.isEmpty():
        braces = _pieces(spark, path, larger_than).withColumn("last", F.lit(False)).join(F.broadcast(long), "file", "left_semi")
        pieces = pieces.join(F.broadcast(long), "file", "left_anti").unionByName(braces)
        sums = sums.join(F.broadcast(long), "file", "left_anti").unionByName(arrow_stage(braces, _block_sums, BLOCK_SUMS))
    by_file = W.partitionBy("file").orderBy("block")
    blocks = sums.withColumn("begins", _before(F.col("flips"), ["file"], ["block"]) % 2)
    blocks = blocks.withColumn("depth", _before(F.when(F.col("begins") == 0, F.col("t0")).otherwise(F.col("t1")), ["file"], ["block"]))
    # a list's items close to depth 1, those of a list in an object to depth 2
    head = F.first(F.when(F.col("head") != "", F.col("head")), ignorenulls=True).over(by_file.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    blocks = blocks.withColumn("level", F.when(head == "[", 1).otherwise(2))
    ends = F.aggregate("closes", F.lit(0).cast("long"), lambda n, c: n + F.when(
        (c["begins"] == F.col("begins")) & (c["depth"] + F.col("depth") == F.col("level")), c["n"]).otherwise(0))
    blocks = blocks.withColumn("ends", ends).select(
        F.monotonically_increasing_id().alias("id"), "file", "block", F.col("begins").cast("int").alias("begins"), "depth", "level",
        _before(F.col("ends"), ["file"], ["block"]).alias("earlier"), (F.row_number().over(by_file) == 1).alias("first"))
    blocks = written_copy(blocks, "blocks")
    # a row per block; the join must leave the pieces in their order
    known = pieces.join(F.broadcast(blocks), ["file", "block"]).drop("file", "block", "size")
    opening = f"^[^\\x00]*?\"{container}\"\\s*:\\s*\\[\\s*(?=\\{{)"
    opens = F.col("raw").contains(f'"{container}"') & F.col("raw").rlike(opening)
    shuts = ~F.col("plain") & F.col("raw").rlike("^\\s*\\]")
    marked = lambda df: df.select("*", opens.alias("opens"), shuts.alias("shuts"))
    cut = written_copy(marked(arrow_stage(known, _block_items, BLOCK_ITEMS)), "items", compression="zstd")
    parts = F.array_sort(F.collect_list(F.struct("block", "raw")))
    across = cut.filter("NOT whole").join(F.broadcast(blocks.select("id", "file", "block")), "id").groupBy("file", "n").agg(
        parts.alias("p"), F.max("ended").alias("ended"), F.min("id").alias("id")).filter("ended").select(
        "id", "n", F.array_join(F.transform("p", lambda x: x["raw"]), "").alias("raw"), F.lit(False).alias("plain"))
    columns = ["id", "n", "raw", "plain", "opens", "shuts"]
    items = cut.filter("whole").select(columns).unionByName(written_copy(marked(across), "across"))
    # of an object's lists only ``container`` counts: from the item behind its name to the one before its end
    files = blocks.select("id", "file", "level")
    bounds = items.filter("opens OR shuts").join(F.broadcast(files), "id").groupBy("file").agg(
        F.min(F.when(F.col("opens"), F.col("n"))).alias("from"), F.collect_list(F.when(F.col("shuts"), F.col("n"))).alias("shut"))
    bounds = bounds.select("file", "from", F.array_min(F.filter("shut", lambda n: n > F.col("from"))).alias("to"))
    files = files.filter("level = 1").withColumns({"from": F.lit(None).cast("long"), "to": F.lit(None).cast("long")}) if container is None else files.join(bounds, "file", "left")
    listed, n = F.col("level") == 1, F.col("n")
    behind = "^\\s*,\\s*(?=\\{)"
    strip = lambda pattern: F.regexp_replace("raw", pattern, "")
    text = (F.when(listed, F.when(F.col("plain"), F.col("raw")).otherwise(strip("^[\\s\\uFEFF]*\\[\\s*|" + behind)))
            .when(F.col("opens"), strip(opening)).when(F.col("plain"), F.col("raw")).otherwise(strip(behind)))
    # a row per block
    held = items.join(F.broadcast(files.select("id", "file", "level", "from", "to")), "id")
    held = held.filter(listed | ((n >= F.col("from")) & (F.col("to").isNull() | (n < F.col("to")))))
    return held.select("file", "n", text.alias("text")).filter(F.col("text").startswith("{"))


def read_items(spark: SparkSession, path: str, schema: T.StructType, container: str | None = "elements", larger_than: int = -1) -> DataFrame:
    """(file, source_file, n, e): every item parsed with ``schema``; ``source_file`` is the file's name."""
    # behind a generator: what is asked of ``e`` later can't be pushed below it, so an item is parsed once
    return item_texts(spark, path, container, larger_than).select("file", F.element_at(F.split("file", "/"), -1).alias("source_file"), "n",
                                                                  F.explode(F.array(F.from_json("text", schema))).alias("e"))


def read_elements(spark: SparkSession, path: str, without: tuple[str, ...] = ()) -> DataFrame:
    """Element documents of any size, exploded: (source_file, project_id, e) per element, as
    ``operators.elements.explode_documents`` gives them; ``without`` names fields of ``e`` that aren't asked for."""
    from graustein import schemas
    from graustein.functions.ids import project_from_filename
    wanted = T.StructType([f for f in schemas.ELEMENT.fields if f.name not in without])
    return read_items(spark, path, wanted).select("source_file", project_from_filename("source_file").alias("project_id"), "e")
