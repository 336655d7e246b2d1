"""Sinks (K1-K9), the result store's latest read (S10, T4), snapshots and backup.

Paths are folders on the shared file system; every write is a Spark job (no driver
collection). A table's new version goes to a new snapshot folder, so readers of the
current one are never disturbed and a failed write leaves no half table behind.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graustein import schemas
from graustein.session import shuffles_dropped
from graustein.sinks import commits

STORE_PARTITIONS = ("data_type", "project_id", "filename", "run_ts")
RUN_LOG = "_runs"


class NothingComputed(ValueError):
    pass


# ---------------------------------------------------------------- partitioned writes

def write_partitioned(df: DataFrame, path: str, partition_by: tuple[str, ...], mode: str = "append", fmt: str = "parquet", observe=None) -> None:
    """Write ``df`` into one folder per value of ``partition_by``.

    Rows are first rebalanced by the partition columns: a task holds whole projects and writes
    a file for each, and AQE splits a project holding a third of all rows over many tasks.
    Nothing is sampled, so ``df`` is computed once.
    ``observe`` = (Observation, *metrics) is attached after it."""
    out = df.hint("rebalance", *partition_by)
    if observe is not None:
        out = out.observe(*observe)
    w = out.write.mode(mode).partitionBy(*partition_by).format(fmt)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")  # only the partitions written are replaced
    w.save(path)


def save_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` saved as the catalogue table ``name`` at ``path``, bucketed and sorted by ``key``, a file per
    bucket. Aggregates by the key and joins of tables with the same buckets on it need no shuffle."""
    (df.repartition(buckets, key).write.mode("errorifexists").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def read_back(spark: SparkSession, path: str, written: DataFrame) -> DataFrame:
    """What ``written`` was written to ``path`` as, with the types it had: folder names such as
    ``project_id=007`` or a date stay the ids they are."""
    return spark.read.schema(written.schema).parquet(path).select(*written.columns)


def read_partitions(spark: SparkSession, path: str, partition_by: tuple[str, ...]) -> DataFrame:
    """A stored table whose partition columns are strings, whatever their values look like."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType() if f.name in partition_by else f.dataType) for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


# ---------------------------------------------------------------- result store

def run_stamp(now: _dt.datetime | None = None) -> str:
    """Sortable run timestamp used as the ``run_ts`` partition value (with a ``T`` inside so
    partition discovery keeps it a string)."""
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%dT%H%M%S%f")


def store_results(df: DataFrame, root: str, data_type: str, filename: str, run_ts: str | None = None) -> str:
    """K1: append a result set under ``{root}/data_type=/project_id=/filename=/run_ts=``.
    ``df`` carries ``project_id``; returns the run stamp.

    When all rows are written, the run is entered in the run log: a row per project, in a folder of its
    own. Readers go by the log, so a run that is being written, or was lost half way, isn't seen."""
    run_ts, spark = run_ts or run_stamp(), df.sparkSession
    out = (df.withColumn("data_type", F.lit(data_type)).withColumn("filename", F.lit(filename))
           .withColumn("run_ts", F.lit(run_ts)))
    # only this run's (type, project, file, run) folders are replaced: storing again is idempotent
    write_partitioned(out, root, STORE_PARTITIONS, mode="overwrite")
    here = (F.col("data_type") == data_type) & (F.col("filename") == filename) & (F.col("run_ts") == run_ts)
    projects = read_partitions(spark, root, STORE_PARTITIONS).filter(here).select(*STORE_PARTITIONS).distinct()  # folder names, no columns
    entry = hashlib.sha256(f"{data_type}/{filename}/{run_ts}".encode()).hexdigest()
    projects.coalesce(1).write.mode("overwrite").parquet(os.path.join(root, RUN_LOG, entry))
    return run_ts


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """(data_type, project_id, filename, run_ts) of every complete run."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in STORE_PARTITIONS])
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(os.path.join(root, RUN_LOG))


def read_latest(spark: SparkSession, root: str, data_type: str, project_id: str | None = None,
                filename: str | None = None) -> DataFrame:
    """The latest run per (project, filename) of a data type, found in the run log. The stored
    rows are joined on their folder columns, so other runs' folders are pruned; the filename is matched
    exactly (not as a prefix)."""
    def wanted(df):
        df = df.filter(F.col("data_type") == F.lit(data_type))
        if project_id is not None:
            df = df.filter(F.col("project_id") == F.lit(project_id))
        return df if filename is None else df.filter(F.col("filename") == F.lit(filename))
    latest = wanted(run_log(spark, root)).groupBy("project_id", "filename").agg(F.max("run_ts").alias("run_ts"))
    return wanted(read_partitions(spark, root, STORE_PARTITIONS)).join(latest, ["project_id", "filename", "run_ts"], "left_semi")


# ---------------------------------------------------------------- snapshots

def write_snapshot(df: DataFrame, root: str, table: str, snapshot: str) -> None:
    """Write a version of ``table`` to ``{root}/{table}/snapshot={id}``; readers don't see it yet."""
    df.write.mode("errorifexists").parquet(os.path.join(root, table, f"snapshot={snapshot}"))


def publish(spark: SparkSession, root: str, snapshots: dict[str, str], base: tuple[int, dict] | None = None) -> int:
    """Make the named snapshots the current ones, all of them in one numbered commit; what was
    published last is current, whatever the snapshots are called. With ``base`` (``commits.state``
    before the snapshots were made) a table that another loader published since is a ``Conflict``."""
    return commits.commit(spark, root, {t: {"snapshot": s} for t, s in snapshots.items()}, base)


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """The current snapshot of every published table."""
    return {t: e["snapshot"] for t, e in commits.state(spark, root)[1].items() if "snapshot" in e}


def publish_snapshot(df: DataFrame, root: str, table: str, snapshot: str | None = None) -> str:
    """Write a new version of ``table`` and make it the current one; returns its id."""
    snapshot = snapshot or run_stamp()
    write_snapshot(df, root, table, snapshot)
    publish(df.sparkSession, root, {table: snapshot})
    return snapshot


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The published snapshot of ``table``, also when it has no rows."""
    return spark.read.parquet(os.path.join(root, table, f"snapshot={published(spark, root)[table]}"))


# ---------------------------------------------------------------- JSON / text outputs

def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """K2/K7: JSON lines with null fields kept; an empty result is an error. ``compression``: the files'
    codec, such as gzip; Spark's reader knows it by their names.

    Rows are counted while they are written, so the plan runs once. An empty result leaves nothing
    behind: it is written beside ``path`` and moved there when it has rows."""
    spark = df.sparkSession
    counted = Observation("json_rows")
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").option("ignoreNullFields", False).json(staged, compression=compression)
    fs, source = commits.file_system(spark, staged)
    _, target = commits.file_system(spark, path)
    if not counted.get.get("n"):
        fs.delete(source, True)
        raise NothingComputed("No results to save")
    if fs.exists(target):
        if mode != "overwrite":
            fs.delete(source, True)
            raise FileExistsError(path)
        fs.delete(target, True)
    fs.rename(source, target)


def write_report(lines: DataFrame, path: str, single_file: bool = False) -> None:
    """K6: the report lines in order (section, then key). The global sort is a range
    partitioning, so the part files are written in parallel and read in name order give
    the report; ``single_file=True`` funnels them into one file for small reports."""
    ordered = lines.orderBy("section", "sort_key").select("line")
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The report lines back, with the part file and position to keep their order."""
    return (spark.read.text(path).select(F.col("_metadata.file_name").alias("part"),
                                         F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line")))


# ---------------------------------------------------------------- result table (K4/P14) and logs (K8, K9)

def results_table(components: DataFrame, active_version: str, created_at=None) -> DataFrame:
    """LCA components in the ``processing_results`` layout: ``kbob_uuid`` is ''
    when failed, ``kbob_version`` defaults to the active version, ``error`` only when failed."""
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    failed = F.coalesce(F.col("failed"), F.lit(True))
    cols = {
        "element_id": F.col("element_id"), "material_name": F.col("material_name"),
        "kbob_uuid": F.when(failed, F.lit("")).otherwise(F.col("kbob_uuid")),
        "kbob_version": F.coalesce(F.col("kbob_version"), F.lit(active_version)),
        "error": F.when(failed, F.col("error_message")), "failed": failed, "created_at": ts,
    }
    def pick(name):
        if name in cols:
            return cols[name]
        return F.col(name) if name in components.columns else F.lit(None)
    return components.select(*[pick(f.name).cast(f.dataType).alias(f.name) for f in schemas.PROCESSING_RESULTS.fields])


def append_table(df: DataFrame, root: str, table: str, run_id: str | None = None,
                 partition_by: tuple[str, ...] = ("project_id",)) -> None:
    """K4/K8/K9: add a run's rows to a table folder partitioned by run and project.

    With a ``run_id`` the write replaces exactly that run's partitions (dynamic partition
    overwrite), so a retried run does not add its rows twice."""
    if run_id is None:
        write_partitioned(df, os.path.join(root, table), partition_by)
    else:
        write_partitioned(df.withColumn("run_id", F.lit(run_id)), os.path.join(root, table),
                          ("run_id", *partition_by), mode="overwrite")


def history_rows(stats: DataFrame, processing_time: float, created_at=None) -> DataFrame:
    """K9: run statistics -> ``processing_history`` rows."""
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return stats.select("project_id", F.col("total_elements").cast("int"), F.col("processed_elements").cast("int"),
                        F.col("failed_elements").cast("int"), F.lit(float(processing_time)).alias("processing_time"),
                        "kbob_version", ts.alias("created_at"))


# ---------------------------------------------------------------- backup / restore

def export_tables(tables: dict[str, DataFrame], root: str) -> None:
    """K3: every table as JSON, split by project where the table has a project column; the schemas
    are written beside the data, last."""
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        path = os.path.join(root, name)
        writer = df if "project_id" not in df.columns else df.hint("rebalance", "project_id")
        writer = writer.write.mode("overwrite").option("ignoreNullFields", False)
        (writer.partitionBy("project_id") if "project_id" in df.columns else writer).json(path)
    if spark is not None:
        known = {t: e for t, e in commits.state(spark, root)[1].items() if t not in tables}
        commits.commit(spark, root, {**known, **{n: {"schema": df.schema.json()} for n, df in tables.items()}})


def import_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """An export read back with the schemas it was written with (declared ones for exports
    without): a project called ``007`` stays ``007``."""
    saved = commits.state(spark, root)[1]
    out = {}
    for name in names:
        if name in saved:
            schema = T.StructType.fromJson(json.loads(saved[name]["schema"]))
        elif name in schemas.TABLES:
            schema = schemas.TABLES[name]
        else:
            raise KeyError(f"{name}: no schema was saved with the export, and none is declared")
        out[name] = spark.read.schema(schema).json(os.path.join(root, name)).select(*[F.col(f.name) for f in schema.fields])
    return out
