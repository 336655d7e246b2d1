"""Table maintenance as pure functions ``new_table = f(old_table, change)``
(M1, M2, M3, M5, M6, M7, M9, M10, M12).

Publishing a result is a separate step: ``sinks.writers.publish`` for whole snapshots,
``sinks.buckets`` for tables of which a batch changes a few buckets. Nothing is written over a
folder being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.operators.joins import last_wins
from graustein.operators.quality import check_status


def _stamp(as_of):
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def upsert(old: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
           keep_from_old: Sequence[str] = ()) -> DataFrame:
    """Generic keyed upsert: the batch (deduplicated, last wins) replaces old rows with the
    same key; ``keep_from_old`` columns keep the stored value on update.

    One shuffle per side on the key; hot keys are reduced map-side by ``last_wins``."""
    keys = list(keys)
    # one row per key; without an order column the greatest row wins (deterministic, unlike dropDuplicates)
    batch = last_wins(batch, keys, list(order))
    if keep_from_old:
        kept = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep_from_old])
        batch = batch.join(kept, keys, "left")
        for c in keep_from_old:
            batch = batch.withColumn(c, F.coalesce(F.col(f"_old_{c}"), F.col(c))).drop(f"_old_{c}")
    untouched = old.join(batch.select(*keys), keys, "left_anti")
    return untouched.unionByName(batch.select(*old.columns))


def upsert_elements(elements: DataFrame, batch: DataFrame, as_of=None) -> DataFrame:
    """M1: upsert by id; an existing element keeps its project; rows are time-stamped."""
    order = ["timestamp"] if "timestamp" in batch.columns else []
    b = batch.withColumn("timestamp", _stamp(as_of)) if as_of is not None or "timestamp" not in batch.columns else batch
    return upsert(elements, b, ["id"], order, keep_from_old=["project_id"])


def upsert_materials(materials: DataFrame, batch: DataFrame) -> DataFrame:
    """M2: upsert by (element_id, material_name); all value columns overwritten."""
    return upsert(materials, batch, ["element_id", "material_name"])


DEFAULT_PROJECT_YEARS = 60  # fixed value: life expectancy of a project that names none


def project_defaults(merged: DataFrame, hit, life_expectancy: int | None, kbob_version: str | None) -> DataFrame:
    """M3: on insert and update the project gets the given life expectancy and version; without
    them it keeps what it has, and a new one gets the default years."""
    if "life_expectancy" in merged.columns:
        years = F.lit(life_expectancy).cast("int") if life_expectancy is not None else F.coalesce("life_expectancy", F.lit(DEFAULT_PROJECT_YEARS))
        merged = merged.withColumn("life_expectancy", F.when(hit, years).otherwise(F.col("life_expectancy")))
    if "kbob_version" in merged.columns and kbob_version is not None:
        merged = merged.withColumn("kbob_version", F.when(hit, F.lit(kbob_version)).otherwise(F.col("kbob_version")))
    return merged


def upsert_project(projects: DataFrame, project_id: str, name: str | None = None, as_of=None,
                   life_expectancy: int | None = None, kbob_version: str | None = None) -> DataFrame:
    """M3: insert or update a project: name set, status back to active, updated_at now,
    created_at kept, life expectancy and catalogue version set."""
    spark = projects.sparkSession
    row = spark.range(1).select(F.lit(project_id).alias("project_id"),
                                F.lit(name).cast("string").alias("_name"), F.lit(True).alias("_hit"))
    ts = _stamp(as_of)
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    merged = project_defaults(projects.join(row, "project_id", "full"), hit, life_expectancy, kbob_version)
    return (merged
            .withColumn("name", F.when(hit & F.col("_name").isNotNull(), F.col("_name")).otherwise(F.col("name")))
            .withColumn("created_at", F.coalesce(F.col("created_at"), ts))
            .withColumn("updated_at", F.when(hit, ts).otherwise(F.col("updated_at")))
            .withColumn("status", F.when(hit, F.lit("active")).otherwise(F.col("status")))
            .select(*projects.columns))


def set_status(projects: DataFrame, project_id: str, status: str, as_of=None) -> DataFrame:
    """M7 (+P16): set one project's status and updated_at."""
    check_status(status)
    hit = F.col("project_id") == F.lit(project_id)
    return (projects.withColumn("status", F.when(hit, F.lit(status)).otherwise(F.col("status")))
            .withColumn("updated_at", F.when(hit, _stamp(as_of)).otherwise(F.col("updated_at"))))


def set_statuses(projects: DataFrame, statuses: DataFrame, as_of=None) -> DataFrame:
    """M7 in bulk: ``statuses`` has (project_id, status), e.g. the run statistics (a row per project,
    written once, so they are computed once). Any status outside the domain (P16) is an error before
    anything changes."""
    from graustein.schemas import PROJECT_STATUSES
    from graustein.session import written_copy
    statuses = written_copy(statuses.select("project_id", "status"), "statuses")
    bad = statuses.filter(F.col("status").isNull() | ~F.col("status").isin(*PROJECT_STATUSES)).select("status").limit(1)
    row = bad.first()
    if row is not None:
        check_status(row["status"])
    s = statuses.select("project_id", F.col("status").alias("_new"))
    return (projects.join(s, "project_id", "left")
            .withColumn("status", F.coalesce("_new", "status"))
            .withColumn("updated_at", F.when(F.col("_new").isNotNull(), _stamp(as_of)).otherwise(F.col("updated_at")))
            .drop("_new"))


def delete_elements(elements: DataFrame, materials: DataFrame, results: DataFrame,
                    doomed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M5: remove elements (``doomed`` has ``id``) with their material and result rows.
    Errors and history stay."""
    ids = doomed.select(F.col("id")).distinct()
    return (elements.join(ids, "id", "left_anti"),
            materials.join(ids.withColumnRenamed("id", "element_id"), "element_id", "left_anti"),
            results.join(ids.withColumnRenamed("id", "element_id"), "element_id", "left_anti"))


def delete_project_elements(elements: DataFrame, materials: DataFrame, results: DataFrame,
                            project_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M5 for a whole project."""
    doomed = elements.filter(F.col("project_id") == F.lit(project_id)).select("id")
    return delete_elements(elements, materials, results, doomed)


def replace_project_elements(elements: DataFrame, materials: DataFrame, results: DataFrame,
                             project_id: str, new_elements: DataFrame, new_materials: DataFrame):
    """M6: delete a project's elements (M5), then upsert the new ones (M1, M2)."""
    e, m, r = delete_project_elements(elements, materials, results, project_id)
    return upsert_elements(e, new_elements), upsert_materials(m, new_materials), r


def replace_project_mappings(mappings: DataFrame, project_id: str, new_mapping: DataFrame,
                             active_version: str, as_of=None) -> DataFrame:
    """M9: a project's mapping replaced by ``new_mapping`` (ifc_material, kbob_id), stamped
    with the active catalogue version."""
    new = new_mapping.select(F.lit(project_id).alias("project_id"), "ifc_material", "kbob_id",
                             F.lit(active_version).alias("kbob_version"), F.lit(True).alias("is_modelled"),
                             _stamp(as_of).alias("created_at"))
    kept = mappings.filter(~F.col("project_id").eqNullSafe(F.lit(project_id)))  # rows for all projects stay
    return kept.unionByName(new, allowMissingColumns=True)


def replace_all(old: DataFrame, new: DataFrame) -> DataFrame:
    """Full replacement (the new snapshot is just the new rows, in the old layout)."""
    return new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(t).alias(c)
                        for c, t in old.dtypes])
