"""Project queries.

All per-project figures are pre-aggregated on their own side before any join (J8),
so no join fans out rows and every aggregate combines map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def elements_of_project(elements: DataFrame, project_id: str) -> DataFrame:
    """The elements of one project (filter reaches the scan / partition)."""
    return elements.filter(F.col("project_id") == F.lit(project_id))


def materials_of_elements(materials: DataFrame, elements: DataFrame) -> DataFrame:
    """Material rows of the given elements."""
    return materials.join(elements.select(F.col("id").alias("element_id")), "element_id", "left_semi")


def project_mapping(mappings: DataFrame, project_id: str) -> DataFrame:
    """One project's usable mapping, one row per material (last row wins, N8, P20)."""
    from graustein.operators.lca import usable_mappings
    m = mappings.filter(F.col("project_id") == F.lit(project_id))
    return usable_mappings(m).select("ifc_material", "kbob_id")


def latest_per_project(history: DataFrame) -> DataFrame:
    """The latest history row per project (created_at, then id, descending).

    ``max_by`` over a struct is an aggregate that combines map-side: a project with a
    third of all runs is reduced per partition before the shuffle."""
    rest = [c for c in history.columns if c != "project_id"]
    order = F.struct(F.col("created_at"), F.col("id")) if "id" in rest else F.col("created_at")
    return (history.groupBy("project_id")
            .agg(F.max_by(F.struct(*rest), order).alias("_latest"))
            .select("project_id", *[F.col("_latest")[c].alias(c) for c in rest]))


def latest_of_project(history: DataFrame, project_id: str) -> DataFrame:
    """The latest history row of one project."""
    return (history.filter(F.col("project_id") == F.lit(project_id))
            .orderBy(F.col("created_at").desc(), *([F.col("id").desc()] if "id" in history.columns else []))
            .limit(1))


def element_counts(elements: DataFrame) -> DataFrame:
    """A2: distinct elements per project."""
    return (elements.groupBy("project_id").agg(F.countDistinct("id").alias("total_elements")))


def error_counts(errors: DataFrame) -> DataFrame:
    """A2: error rows per project."""
    return errors.groupBy("project_id").agg(F.count(F.lit(1)).alias("total_errors"))


def project_info(projects: DataFrame, elements: DataFrame, errors: DataFrame, history: DataFrame) -> DataFrame:
    """C3 for all projects: project row, element and error counts, latest run (J8 + A2 + W1)."""
    latest = latest_per_project(history)
    latest = latest.select("project_id", *[F.col(c).alias(f"latest_{c}") for c in latest.columns if c != "project_id"])
    return (projects
            .join(element_counts(elements), "project_id", "left")
            .join(error_counts(errors), "project_id", "left")
            .join(latest, "project_id", "left")
            .withColumn("total_elements", F.coalesce("total_elements", F.lit(0)).cast("long"))
            .withColumn("total_errors", F.coalesce("total_errors", F.lit(0)).cast("long")))


def material_volumes(materials: DataFrame, elements: DataFrame) -> DataFrame:
    """Total volume per (project, material), null total -> 0.0, largest first."""
    mats = materials.select("element_id", "material_name", F.col("volume").cast("decimal(38,6)").alias("volume"))
    els = elements.select(F.col("id").alias("element_id"), "project_id")
    return (mats.join(els, "element_id", "inner")
            .groupBy("project_id", "material_name")
            .agg(F.sum("volume").alias("volume"))
            .select("project_id", F.col("material_name").alias("name"),
                    F.coalesce(F.col("volume").cast("double"), F.lit(0.0)).alias("volume")))


def ordered_material_volumes(volumes: DataFrame) -> DataFrame:
    """Order by volume descending (nulls last), then name."""
    return volumes.orderBy("project_id", F.col("volume").desc_nulls_last(), "name")


def project_mappings_in_use(mappings: DataFrame, materials: DataFrame, elements: DataFrame) -> DataFrame:
    """Per project, the mappings of materials that occur in it: of every material the
    last one (N8), and none where that is blank."""
    from graustein.operators.lca import usable_mappings
    used = (materials.select("element_id", F.col("material_name").alias("ifc_material"))
            .join(elements.select(F.col("id").alias("element_id"), "project_id"), "element_id", "inner")
            .select("project_id", "ifc_material").distinct())
    m = usable_mappings(mappings.filter(F.col("ifc_material") != ""))
    if "project_id" in m.columns:
        return m.join(used, ["project_id", "ifc_material"], "left_semi").select("project_id", "ifc_material", "kbob_id")
    # a global mapping applies to every project that uses the material
    return used.join(m, "ifc_material", "inner").select("project_id", "ifc_material", "kbob_id")
