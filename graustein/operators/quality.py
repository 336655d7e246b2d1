"""Data-quality operators (P12, P16, P19): required columns, domain checks, and the
table constraints (primary/unique key, NOT NULL, CHECK, foreign key) as DataFrames of
violations, never exceptions thrown mid-job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.schemas import PROJECT_STATUSES


class MissingColumns(ValueError):
    pass


def require_columns(df: DataFrame, required: Iterable[str], where: str = "columns") -> None:
    """Raise before any action when required columns are absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        label = "Missing required columns" if where == "columns" else "Missing required fields in elements"
        raise MissingColumns(f"{label}: {', '.join(missing)}")


def check_status(status: str) -> str:
    """The project status domain."""
    if status not in PROJECT_STATUSES:
        raise ValueError(f"Invalid status: {status}. Must be one of {', '.join(PROJECT_STATUSES)}")
    return status


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P19 PK/UNIQUE: key values occurring more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))


def null_violations(df: DataFrame, not_null: Sequence[str]) -> DataFrame:
    """P19 NOT NULL: one row per column with its number of nulls (only columns with nulls)."""
    if not not_null:
        return df.sparkSession.createDataFrame([], "column string, n_nulls long")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    stacked = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_nulls"))
                                                for c in not_null])).alias("s")).select("s.*")
    return stacked.filter(F.col("n_nulls") > 0)


def check_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """P19 CHECK: rows whose value is outside the allowed set."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """P19 FK: child rows without a parent row."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def _tags(name: str, df: DataFrame, keys: dict, not_null: dict, fks: Sequence, checks: dict) -> list:
    """What a row of table ``name`` says to the checks: (table, check, key, parent) structs. Rows of a key
    are counted under it; NOT NULL and CHECK say something only when they are violated."""
    def tag(table, check, key, parent=False, when=None):
        s = F.struct(F.lit(table).alias("table"), F.lit(check).alias("check"), key.alias("key"), F.lit(parent).alias("parent"))
        return s if when is None else F.when(when, s)
    out = []
    if name in keys:
        out.append(tag(name, "primary_key", F.to_json(F.struct(*keys[name]))))
    out += [tag(name, f"not_null:{c}", F.lit(""), when=F.col(c).isNull()) for c in not_null.get(name, []) if c in df.columns]
    out += [tag(name, f"check:{label}", F.lit(""), when=~F.coalesce(ok, F.lit(True))) for label, ok in checks.get(name, [])]
    for child, ckey, parent, pkey in fks:
        check = f"foreign_key:{ckey}->{parent}.{pkey}"
        if name == child:
            out.append(tag(child, check, F.col(ckey).cast("string"), when=F.col(ckey).isNotNull()))
        if name == parent:
            out.append(tag(child, check, F.col(pkey).cast("string"), parent=True, when=F.col(pkey).isNotNull()))
    return out


def _declared(tables: dict, keys: dict, not_null: dict, fks: Sequence, checks: dict) -> list[tuple[str, str]]:
    return ([(t, "primary_key") for t in keys if t in tables]
            + [(t, f"not_null:{c}") for t, df in tables.items() for c in not_null.get(t, []) if c in df.columns]
            + [(t, f"check:{label}") for t in tables for label, _ in checks.get(t, [])]
            + [(child, f"foreign_key:{ckey}->{parent}.{pkey}") for child, ckey, parent, pkey in fks])


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violations(tables: dict[str, DataFrame], keys: dict[str, list[str]], not_null: dict[str, list[str]],
               fks: Sequence[tuple[str, str, str, str]] = (), checks: dict[str, list] | None = None) -> DataFrame:
    """(table, check, key, n) of everything that is violated: duplicated keys, child keys without a
    parent, and numbers of nulls and failed CHECKs. ``checks``: table -> [(label, condition that holds)].

    One pass: every table is read once, all checks of all tables meet in one shuffle by (table, check,
    key), and whatever can be counted is counted before it. A key with a third of all rows is one row
    per task there."""
    parts = []
    for name, df in tables.items():
        tags = _tags(name, df, keys, not_null, fks, checks or {})
        if tags:
            parts.append(df.select(F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())).alias("t")).select("t.*"))
    met = _union(parts).groupBy("table", "check", "key").agg(F.count_if(~F.col("parent")).alias("n"), F.bool_or("parent").alias("has_parent"))
    bad = (F.when(F.col("check") == "primary_key", F.col("n") > 1).when(F.col("check").startswith("foreign_key:"), ~F.col("has_parent"))
           .otherwise(F.lit(True)))
    return met.filter(bad & (F.col("n") > 0)).select("table", "check", "key", "n")


def constraint_report(tables: dict[str, DataFrame], keys: dict[str, list[str]],
                      not_null: dict[str, list[str]], fks: Sequence[tuple[str, str, str, str]] = (),
                      checks: dict[str, list] | None = None) -> DataFrame:
    """P19 summary: (table, check, n_violations) for every declared constraint, also those that hold:
    duplicated keys, and rows that violate the others."""
    found = violations(tables, keys, not_null, fks, checks)
    counted = found.select("table", "check", F.when(F.col("check") == "primary_key", 1).otherwise(F.col("n")).cast("long").alias("n"))
    spark = found.sparkSession
    zero = F.array(*(F.struct(F.lit(t).alias("table"), F.lit(c).alias("check"), F.lit(0).cast("long").alias("n"))
                     for t, c in _declared(tables, keys, not_null, fks, checks or {})))
    declared = spark.range(1).select(F.inline(zero))
    return counted.unionByName(declared).groupBy("table", "check").agg(F.sum("n").alias("n_violations"))


def quarantine(tables: dict[str, DataFrame], keys: dict[str, list[str]], not_null: dict[str, list[str]],
               fks: Sequence[tuple[str, str, str, str]] = (), checks: dict[str, list] | None = None,
               found: DataFrame | None = None) -> DataFrame:
    """(table, check, key, record) of every row that violates something, once per reason, the row as
    JSON; of a duplicated key all rows. ``found``: ``violations``, if they are stored already."""
    given = found is not None
    found = found if given else violations(tables, keys, not_null, fks, checks)
    reasons = found.select(F.col("table").alias("_table"), F.col("check").alias("_check"), F.col("key").alias("_key"))
    rows, said = [], []
    for name, df in tables.items():
        # a NOT NULL or CHECK tag is a violation by itself: its rows, all of one empty key, need not meet the reasons
        for parts, tags in ((rows, _tags(name, df, keys, {}, [f for f in fks if f[0] == name], {})), (said, _tags(name, df, {}, not_null, [], checks or {}))):
            if tags:
                own = F.filter(F.array(*tags), lambda x: x.isNotNull() & ~x["parent"])
                parts.append(df.select(F.struct(*df.columns).alias("r"), F.explode(own).alias("t"))
                             .select("t.table", "t.check", "t.key", F.to_json("r").alias("record")))
    on = (F.col("table") == F.col("_table")) & (F.col("check") == F.col("_check")) & (F.col("key") == F.col("_key"))
    out = [_union(rows).join(reasons, on, "left_semi")] if rows else []
    if said:
        out.append(_union(said).join(reasons, on, "left_semi") if given else _union(said))
    return _union(out)
