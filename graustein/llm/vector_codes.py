"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Every component x becomes the integer floor(scale * x). Vectors are cut into ``PARTS`` consecutive
parts; each part position has a codebook of ``ENTRIES`` entries, at first that part of the vectors
with the smallest ids. In each of ``ROUNDS`` rounds all parts are assigned to their nearest entry
(squared Euclidean distance, ties to the lower index), and every used entry becomes the
componentwise floor of the mean of its parts.

Nearest entries: for every entry the others are listed by their distance from it. A search starts
at some entry c at distance d, walks c's list, marks what it visits, and jumps to the list of an
entry that is nearer (or as near, with a lower index). Entries farther than 2d from c are at least
d away from the part, and farther away than c unless the distances add up exactly, so the walk
stops beyond twice the current distance. All parts of a slice of rows walk at once (numpy).

All arithmetic is on integers, so sums do not depend on the order of rows. Tasks send one sum and
count for every entry; the codebooks (``PARTS`` x ``ENTRIES`` x part length integers, whatever the
rows) are the only thing that reaches the driver and goes back to the tasks.

Defined cases: rows whose vector is null or holds a null, NaN or infinite component are dropped;
others all stay, also repeated ones. A null id sorts last; equal ids sort by their vectors. With
fewer vectors than entries the codebooks are shorter. The first entry's length holds for all: a
vector of another length keeps its row, with null code and error, and moves no entry. A length that
``PARTS`` doesn't divide makes parts that differ by one. Components must stay below 2**28 after
scaling (ValueError otherwise), so that no distance overflows. No rows give no rows. Only the id,
the vector and the label are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm.base import map_arrow, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 28
ROWS_AT_ONCE = 4096


class Codebooks:
    """The entries of all part positions and, for every entry, the others by distance."""

    def __init__(self, entries: np.ndarray, parts: int = PARTS):
        self.entries, self.parts = entries, parts  # (entries, length) integers
        n, length = entries.shape
        self.cuts = [i * length // parts for i in range(parts + 1)]
        books = [entries[:, a:b] for a, b in zip(self.cuts, self.cuts[1:])]
        apart = np.stack([((b[:, None, :] - b[None, :, :]) ** 2).sum(axis=2) for b in books])
        self.lists = np.argsort(apart, axis=2, kind="stable")  # (parts, entries, entries)
        self.apart = np.take_along_axis(apart, self.lists, axis=2)
        self.books = books

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, squared distances) of the parts of every vector, (rows, parts) each."""
        codes, errors = np.empty((len(vectors), self.parts), np.int64), np.empty((len(vectors), self.parts), np.int64)
        for p, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            codes[:, p], errors[:, p] = orchard(vectors[:, a:b], self.books[p], self.lists[p], self.apart[p])
        return codes, errors

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and place within the part."""
        numbers = np.concatenate([b.ravel() for b in self.books]) if len(self.entries) else []
        return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def orchard(queries: np.ndarray, book: np.ndarray, lists: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) nearest to each query; ties go to the lower entry. ``lists`` and
    ``apart`` hold, for every entry, all entries and their squared distances, nearest first."""
    n, size = len(queries), len(book)
    # a start near the query: the entry whose components add up to about the same
    by_sum = np.argsort(book.sum(axis=1), kind="stable")
    near = np.searchsorted(book.sum(axis=1)[by_sum], queries.sum(axis=1))
    at = by_sum[np.minimum(near, size - 1)]
    best = ((queries - book[at]) ** 2).sum(axis=1)
    seen = np.zeros((n, size), bool)
    live = np.arange(n)
    seen[live, at] = True
    step = np.zeros(n, np.int64)
    while True:
        # squared, the bound is four times the current distance
        live = live[step[live] < size]
        live = live[apart[at[live], step[live]] <= 4 * best[live]]
        if not len(live):
            return at, best
        entry = lists[at[live], step[live]]
        step[live] += 1
        new = ~seen[live, entry]
        rows, entry = live[new], entry[new]
        seen[rows, entry] = True
        d = ((queries[rows] - book[entry]) ** 2).sum(axis=1)
        nearer = (d < best[rows]) | ((d == best[rows]) & (entry < at[rows]))
        rows = rows[nearer]
        at[rows], best[rows], step[rows] = entry[nearer], d[nearer], 0


def integers(column: pa.Array, length: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, their vectors as integers) of the rows of a list column with ``length`` components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lens = np.diff(column.offsets.to_numpy())
    rows = np.flatnonzero(lens == length)
    flat = column.values.slice(column.offsets[0].as_py(), int(lens.sum())).to_numpy(zero_copy_only=False)
    inside = np.repeat(lens == length, lens)
    numbers = np.floor(flat[inside].astype(np.float64) * scale)
    if len(numbers) and np.abs(numbers).max() >= LARGEST:
        raise ValueError(f"scaled components must stay below {LARGEST}")
    return rows, numbers.astype(np.int64).reshape(len(rows), length)


def finite(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, vector, label) of the rows whose vector has only finite components."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.filter(F.col("vector").isNotNull() & F.forall("vector", number))


def _sums(shared, scale: int):
    """Rows (part, entry, place, total, n): what a task's vectors add to every entry."""
    def run(batches):
        books = shared.value
        length = books.entries.shape[1]
        total, count = np.zeros(books.entries.shape, np.int64), np.zeros((len(books.entries), books.parts), np.int64)
        for batch in batches:
            _, vectors = integers(batch.column(0), length, scale)
            for i in range(0, len(vectors), ROWS_AT_ONCE):
                some = vectors[i:i + ROWS_AT_ONCE]
                codes, _ = books.assign(some)
                for p, (a, b) in enumerate(zip(books.cuts, books.cuts[1:])):
                    np.add.at(total[:, a:b], codes[:, p], some[:, a:b])
                    count[:, p] += np.bincount(codes[:, p], minlength=len(count))
        entry, place = np.nonzero(np.repeat(count > 0, np.diff(books.cuts), axis=1))
        part = np.searchsorted(books.cuts, place, "right") - 1
        yield pa.record_batch([pa.array(entry), pa.array(place), pa.array(total[entry, place]), pa.array(count[entry, part])],
                              ["entry", "place", "total", "n"])
    return run


def first_entries(rows: DataFrame, entries: int = ENTRIES, scale: int = SCALE) -> np.ndarray:
    """The vectors of the smallest ids, as integers; (0, 0) without rows."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()  # at most ``entries`` rows
    if not first:
        return np.zeros((0, 0), np.int64)
    length = len(first[0]["vector"])
    column = pa.array([r["vector"] for r in first], pa.list_(pa.float64()))
    return integers(column, length, scale)[1]


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """The codebooks after ``rounds`` rounds over all of ``rows`` (id, vector)."""
    spark = rows.sparkSession
    books = Codebooks(first_entries(rows, entries, scale), parts)
    for _ in range(rounds if len(books.entries) else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = map_arrow(rows.select("vector"), _sums(shared, scale), "entry long, place long, total long, n long")
        new = books.entries.copy()
        for r in sums.groupBy("entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # entries x length rows
            new[r["entry"], r["place"]] = r["total"] // r["n"]  # floors, also below zero
        books = Codebooks(new, parts)
    return books


def _codes(shared, scale: int):
    def run(batches):
        books = shared.value
        length = books.entries.shape[1]
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(i, ROWS_AT_ONCE)
                rows, vectors = integers(some.column(1), length, scale)
                codes, errors = books.assign(vectors)
                packed = [None] * some.num_rows
                error = np.zeros(some.num_rows, np.int64)
                error[rows] = errors.sum(axis=1)
                for r, c in zip(rows.tolist(), codes.astype(np.uint8)):
                    packed[r] = c.tobytes()
                known = np.zeros(some.num_rows, bool)
                known[rows] = True
                yield pa.record_batch([some.column(0), some.column(2), pa.array(packed, pa.binary()), pa.array(error, mask=~known)],
                                      ["id", "label", "code", "error"])
    return run


def encode(rows: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """(id, label, code, error) of ``rows`` (id, vector, label): one byte for each part, and the
    squared distances of all parts from their entries."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    shared = rows.sparkSession.sparkContext.broadcast(books)
    return map_arrow(rows.select("id", "vector", "label"), _codes(shared, scale), f"id {types['id']}, label {types['label']}, code binary, error long")


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """((id, label, code, error, label_error) of every row with a finite vector, the codebooks);
    label_error is the error of all rows with the same label, null labels together."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte for each part: 1 to 256 entries")
    rows = finite(vectors, id_col, vector_col, label_col)
    books = train(rows, parts, entries, rounds, scale)
    coded = stored(encode(rows, books, scale), "codes")
    # partial sums per label first; the written table is small where labels are few, and Spark knows its size
    of_label = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("of")), "left").drop("of"), books
