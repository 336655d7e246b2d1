"""What each micro-batch delivered, published as a whole.

Every batch writes its rows of every table to ``{root}/{table}/batch={id}``, the projects it delivered
(also those without a row in any table) to ``{root}/deliveries/batch={id}``, and last an empty record
``{root}/_batches/{id}``. Readers take committed batches only, and of each project the rows of the last
batch that delivered it: a delivery replaces everything that earlier ones wrote for its projects, in all
tables at once, also when it has no rows at all. Nothing is deleted or overwritten while it is read, and
a batch that was lost half way is written again to the same folders before its record exists.

Logs (errors, history, replies) keep the rows of all committed batches.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graustein.sinks import commits

DELIVERIES = "deliveries"
BATCH = "batch"


def committed(spark: SparkSession, root: str) -> list[int]:
    """The batches that are complete, in order."""
    return sorted(int(n) for n in commits.names(spark, f"{root}/_batches") if n.isdigit())


def folder(root: str, table: str, batch_id: int) -> str:
    return f"{root}/{table}/{BATCH}={batch_id}"


def write_rows(df: DataFrame, root: str, table: str, batch_id: int) -> DataFrame:
    """A batch's rows of a table, written and read back; nobody else sees them before ``commit``."""
    path = folder(root, table, batch_id)
    if table == DELIVERIES:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", "project_id").write.mode("overwrite").partitionBy("project_id").parquet(path)
    commits.create_if_absent(df.sparkSession, f"{path}/_schema.json", df.schema.json())
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def commit(spark: SparkSession, root: str, batch_id: int) -> None:
    """Publishes the batch: all its tables and deliveries."""
    commits.create_if_absent(spark, f"{root}/_batches/{batch_id}", "")


def _read(spark: SparkSession, root: str, table: str, batches: list[int]) -> DataFrame:
    held = [b for b in batches if commits.names(spark, folder(root, table, b))]
    if not held:
        raise FileNotFoundError(f"no committed batch has the table {table}")
    # the columns of the newest batch, ids as what they are: folders such as ``project_id=007`` stay ids
    schema = T.StructType.fromJson(json.loads(commits.read_text(spark, f"{folder(root, table, held[-1])}/_schema.json")))
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(full).option("basePath", f"{root}/{table}").parquet(*(folder(root, table, b) for b in held)).select(*full.names)


def read_all(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of all committed batches, with ``batch``."""
    return _read(spark, root, table, committed(spark, root))


def current_batches(spark: SparkSession, root: str) -> DataFrame:
    """(project_id, batch): the last committed batch that delivered each project."""
    return read_all(spark, root, DELIVERIES).groupBy("project_id").agg(F.max(BATCH).alias(BATCH))


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of each project's last delivery. Batches that are no project's last one aren't opened
    (at most as many numbers as there are batches reach the driver)."""
    current = current_batches(spark, root)
    live = sorted(r[0] for r in current.select(BATCH).distinct().collect())
    return _read(spark, root, table, live).join(current, ["project_id", BATCH], "left_semi").drop(BATCH)
