"""Join and dedup building blocks shared by the jobs.

* ``left_lookup``: left join to a dimension; Spark's own size check decides on a broadcast.
* ``last_wins``: N8 "last writer wins" per key as an aggregate (``max_by``), which
  combines map-side, so a hot key never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS_CONF = "graustein.skew.salts"


def left_lookup(fact: DataFrame, dim: DataFrame, keys: Sequence[str], salts: int | None = None) -> DataFrame:
    """Left join of facts to a dimension with one row per key.

    A plain join: Spark broadcasts the dimension when its size in bytes is known to be below
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE also when it turns out so), else it joins by
    shuffle and AQE splits hot fact partitions. No job runs before the query does.
    ``salts`` (or ``graustein.skew.salts``) asks for a salted join, for sessions without AQE:
    each fact row gets a salt from the hash of its values and the dimension is replicated once
    per salt, so a key holding a third of all facts is spread over ``salts`` tasks. Every fact
    row meets exactly one copy of its dimension row, so the result is the same."""
    keys = list(keys)
    conf_salts = fact.sparkSession.conf.get(SALTS_CONF, None)
    n = salts or (int(conf_salts) if conf_salts else None)
    if n is None:
        return fact.join(dim, keys, "left")
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(n)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (ties broken by the
    remaining columns, so the result is deterministic)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    order_struct = F.struct(*order_cols, *[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_struct).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
