"""Tables stored in hash buckets of a key, changed by rewriting the touched buckets only (M1, M2, M5, M6).

A table's rows lie in ``{root}/{table}/version={v}/bucket={b}``; the commit log (``sinks.commits``)
says for every bucket which version is current. A batch is written once, its buckets are found (at
most as many rows as there are buckets reach the driver), the stored rows of these buckets are read,
merged and written as a new version, and one commit makes them current. The files of all other buckets
stay as they are: a batch costs its buckets, not the table. Several tables with the same number of
buckets and the same key values (elements, their materials, their results) are touched in the same
buckets and change in one commit.

Old versions stay readable for queries that began before the commit; ``expired`` names the folders
that no commit refers to any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graustein.operators.maintenance import upsert as merged
from graustein.session import written_copy
from graustein.sinks import commits

BUCKET, VERSION = "bucket", "version"


def bucket_of(key: str, buckets: int):
    """The bucket of a row; null keys share one."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _write(df: DataFrame, root: str, table: str, entry: dict) -> list[int]:
    """Writes rows as a new version; returns (version, the buckets that have rows)."""
    version = uuid.uuid4().hex
    path = f"{root}/{table}/{VERSION}={version}"
    keyed = df.withColumn(BUCKET, bucket_of(entry["key"], entry["buckets"]))
    keyed.hint("rebalance", BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
    found = [int(n.split("=")[1]) for n in commits.names(df.sparkSession, path) if n.startswith(f"{BUCKET}=")]
    return version, found


def create(tables: dict[str, tuple[DataFrame, str]], root: str, buckets: int) -> int:
    """Stores ``tables`` (name -> rows, key column) as new bucketed tables, in one commit."""
    changes, spark = {}, None
    for table, (df, key) in tables.items():
        if {BUCKET, VERSION} & set(df.columns):
            raise ValueError(f"{table}: columns named {BUCKET} or {VERSION} are taken by the storage")
        spark = df.sparkSession
        entry = {"key": key, "buckets": buckets, "schema": df.schema.json()}
        version, found = _write(df, root, table, entry)
        changes[table] = {**entry, "versions": {str(b): version for b in found}}
    return commits.commit(spark, root, changes)


def read(spark: SparkSession, root: str, table: str, only: Sequence[int] | None = None, entry: dict | None = None) -> DataFrame:
    """The current rows of ``table``, or of the buckets ``only``; other folders aren't opened."""
    import json
    entry = entry or commits.state(spark, root)[1][table]
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    wanted = entry["versions"] if only is None else {str(b): entry["versions"][str(b)] for b in only if str(b) in entry["versions"]}
    if not wanted:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    paths = [f"{root}/{table}/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(wanted.items())]
    return spark.read.schema(full).option("basePath", f"{root}/{table}").parquet(*paths).select(*schema.names)


def change(spark: SparkSession, root: str, keys: DataFrame, changes: dict[str, Callable[[DataFrame], DataFrame]],
           base: tuple[int, dict] | None = None) -> int:
    """Rewrites the buckets that ``keys`` (one column, the key's values) touch: every table in
    ``changes`` becomes its function of the rows it has there. One commit; returns its number."""
    base = base or commits.state(spark, root)
    entries = {t: base[1][t] for t in changes}
    numbers = {e["buckets"] for e in entries.values()}
    if len(numbers) != 1:
        raise ValueError("tables changed together need the same number of buckets")
    buckets = numbers.pop()
    touched = [r[0] for r in keys.select(bucket_of(keys.columns[0], buckets).alias("b")).distinct().collect()]  # at most ``buckets`` rows
    new = {}
    for table, fn in changes.items():
        entry = entries[table]
        version, found = _write(fn(read(spark, root, table, touched, entry)), root, table, entry)
        if not set(found) <= set(touched):
            raise ValueError(f"{table}: rows outside the touched buckets")
        versions = {b: v for b, v in entry["versions"].items() if int(b) not in touched}
        new[table] = {**entry, "versions": {**versions, **{str(b): version for b in found}}}
    return commits.commit(spark, root, new, base)


def upsert(spark: SparkSession, root: str, table: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
           keep_from_old: Sequence[str] = ()) -> int:
    """M1/M2 on a stored table: last row of a key wins, ``keep_from_old`` columns keep what is stored."""
    base = commits.state(spark, root)
    batch = written_copy(batch, f"batch_{table}")
    key = base[1][table]["key"]
    return change(spark, root, batch.select(key), {table: lambda old: merged(old, batch, keys, order, keep_from_old)}, base)


def delete(spark: SparkSession, root: str, doomed: DataFrame, tables: Sequence[str]) -> int:
    """M5 on stored tables: the rows of the keys in ``doomed`` (one column) go from all ``tables``."""
    base = commits.state(spark, root)
    ids = written_copy(doomed.toDF("_doomed").distinct(), "doomed")

    def without(key):
        return lambda old: old.join(ids, old[key] == F.col("_doomed"), "left_anti")
    return change(spark, root, ids, {t: without(base[1][t]["key"]) for t in tables}, base)


def expired(spark: SparkSession, root: str, table: str) -> list[str]:
    """Folders of versions that the current commit doesn't use."""
    used = set(commits.state(spark, root)[1][table]["versions"].values())
    return [f"{root}/{table}/{n}" for n in commits.names(spark, f"{root}/{table}") if n.startswith(f"{VERSION}=") and n.split("=")[1] not in used]
