"""LCA computation (C1): J1, J2, J4, A3, N1, H4-H6, P13, A7, A8.

Input is one row per element x material (``project_id, element_id, material_name,
volume, density, ebkp``). Every lookup is a left join against a dimension with one row
per key (Spark broadcasts it if it is small enough); the checks are one ordered ``when`` chain and all arithmetic stays in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graustein.functions.numbers import not_positive
from graustein.operators.joins import last_wins, left_lookup

# Error codes of the LCA checks, in check order (N1), and the default
# service life in years when no positive value is found.
INVALID_VOLUME = "INVALID_VOLUME"
INVALID_DENSITY = "INVALID_DENSITY"
MAPPING_NOT_FOUND = "MAPPING_NOT_FOUND"
KBOB_NOT_FOUND = "KBOB_NOT_FOUND"
DEFAULT_LIFE_YEARS = 60

INDICATORS = (("gwp", "indicator_co2eq", 3), ("penr", "indicator_penre", 3), ("ubp", "indicator_ubp", 0))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def service_life(life: DataFrame, normalise: bool = False) -> DataFrame:
    """A3: MIN(years) per trimmed code. ``normalise=True`` keys by the H1 form instead."""
    from graustein.functions.ebkp import normalize_code
    key = normalize_code(F.trim("ebkp_code")) if normalise else F.trim("ebkp_code")
    return life.groupBy(key.alias("life_code")).agg(F.min("years").alias("life_years"))


def usable_mappings(mappings: DataFrame) -> DataFrame:
    """P20 + N8: one row per material (per project when the mapping has a ``project_id``), the
    latest ``created_at`` winning; then those with a non-empty kbob id. A blank latest row
    means that the material has no mapping, whatever older rows say."""
    keys = (["project_id"] if "project_id" in mappings.columns else []) + ["ifc_material"]
    order = [c for c in ("created_at", "kbob_version") if c in mappings.columns]
    m = mappings.filter(F.col("ifc_material").isNotNull()).select(*keys, "kbob_id", *order)
    return (last_wins(m, keys, order or ["kbob_id"])
            .filter(F.col("kbob_id").isNotNull() & (F.trim("kbob_id") != "")).select(*keys, "kbob_id"))


def resolved_mapping(mappings: DataFrame, project_id: str) -> DataFrame:
    """(material_name, kbob_id): what a project's materials map to; its own rows come before those
    without a project."""
    rows = mappings if "project_id" in mappings.columns else mappings.withColumn("project_id", F.lit(None).cast("string"))
    own = usable_mappings(rows.filter(F.col("project_id") == F.lit(project_id)).drop("project_id")).select("ifc_material", F.col("kbob_id").alias("own"))
    shared = usable_mappings(rows.filter(F.col("project_id").isNull()).drop("project_id")).select("ifc_material", F.col("kbob_id").alias("shared"))
    return own.join(shared, "ifc_material", "full").select(F.col("ifc_material").alias("material_name"), F.coalesce("own", "shared").alias("kbob_id"))


def catalogue_of_version(catalogue: DataFrame, version: str) -> DataFrame:
    """J2 right side: one row per uuid of the version. A key violation (two rows for one
    uuid) must not multiply component rows, so the latest ``created_at`` wins (then the
    greatest values, deterministically)."""
    cols = [F.col("uuid").alias("kbob_id"), F.col("name").alias("kbob_material_name"),
            *[F.col(src) for _, src, _ in INDICATORS]]
    order = ["created_at"] if "created_at" in catalogue.columns else []
    rows = catalogue.filter(F.col("version") == F.lit(version)).select(*cols, *order)
    return last_wins(rows, ["kbob_id"], order or ["kbob_material_name"]).select(
        "kbob_id", "kbob_material_name", *[src for _, src, _ in INDICATORS])


def named_by(catalogue: DataFrame, mappings: DataFrame) -> DataFrame:
    """The catalogue rows whose uuid a mapping names: the only ones that ``lca_components`` can find. Written, they
    show how few they may be; as an aggregate of a large catalogue they would be joined by shuffling the facts."""
    return catalogue.join(mappings.select(F.col("kbob_id").alias("uuid")).distinct(), "uuid", "left_semi").select(*catalogue.columns)


def lca_components(components_in: DataFrame, mappings: DataFrame, catalogue: DataFrame,
                   life: DataFrame, version: str, normalise_life: bool = False) -> DataFrame:
    """C1 core: one result row per input row, good or failed."""
    kbob = catalogue_of_version(catalogue, version).withColumn("_kbob_found", F.lit(True))
    years = service_life(life, normalise_life).withColumnRenamed("life_code", "_life_key")
    if "project_id" in mappings.columns:
        # project rows first; rows without a project apply to every project (fallback)
        per_project = (usable_mappings(mappings.filter(F.col("project_id").isNotNull()))
                       .withColumnRenamed("ifc_material", "material_name").withColumnRenamed("kbob_id", "_kbob_project"))
        shared = (usable_mappings(mappings.filter(F.col("project_id").isNull()).drop("project_id"))
                  .withColumnRenamed("ifc_material", "material_name").withColumnRenamed("kbob_id", "_kbob_shared"))
        df = left_lookup(components_in, per_project, ["project_id", "material_name"])
        df = left_lookup(df, shared, ["material_name"])
        df = (df.withColumn("kbob_id", F.coalesce("_kbob_project", "_kbob_shared"))
              .drop("_kbob_project", "_kbob_shared"))
    else:
        mapping = usable_mappings(mappings).withColumnRenamed("ifc_material", "material_name")
        df = left_lookup(components_in, mapping, ["material_name"])

    from graustein.functions.ebkp import normalize_code
    life_key = normalize_code(F.trim("ebkp")) if normalise_life else F.trim("ebkp")
    df = left_lookup(df, kbob, ["kbob_id"])
    df = left_lookup(df.withColumn("_life_key", life_key), years, ["_life_key"]).drop("_life_key")

    volume, density = F.col("volume"), F.col("density")
    error_code = (F.when(not_positive(volume), F.lit(INVALID_VOLUME))
                  .when(not_positive(density), F.lit(INVALID_DENSITY))
                  .when(F.col("kbob_id").isNull(), F.lit(MAPPING_NOT_FOUND))
                  .when(F.col("_kbob_found").isNull(), F.lit(KBOB_NOT_FOUND)))
    error_message = (F.when(not_positive(volume), F.concat(F.lit("Invalid volume: "), _text(volume)))
                     .when(not_positive(density), F.concat(F.lit("Invalid density: "), _text(density)))
                     .when(F.col("kbob_id").isNull(), F.concat(F.lit("Material mapping not found: "), F.col("material_name")))
                     .when(F.col("_kbob_found").isNull(), F.concat(F.lit("KBOB ID not found: "), F.col("kbob_id"))))
    life_years = F.coalesce(F.when(F.col("life_years") != 0, F.col("life_years")), F.lit(DEFAULT_LIFE_YEARS))

    ok = F.col("error_code").isNull()
    impacts = []
    for name, src, digits in INDICATORS:
        absolute = F.col("volume") * F.col("density") * F.col(src)
        impacts.append(F.when(ok, F.round(absolute, digits)).cast("double").alias(f"{name}_absolute"))
        impacts.append(F.when(ok, F.round(absolute / F.col("amortization"), digits)).cast("double")
                       .alias(f"{name}_relative"))

    return (df.withColumn("error_code", error_code)
            .withColumn("amortization", F.when(F.col("error_code").isNull(), life_years).cast("int"))
            .select(
                "project_id", "element_id", "material_name",
                F.when(ok, F.col("kbob_id")).alias("kbob_uuid"),
                F.when(ok, F.col("kbob_material_name")).alias("kbob_material_name"),
                F.lit(version).alias("kbob_version"),
                F.when(ok, F.round(volume, 3)).cast("double").alias("volume"),
                F.when(ok, F.round(density, 3)).cast("double").alias("density"),
                "amortization", F.col("ebkp").alias("ebkp_h"), *impacts,
                (~ok).alias("failed"), "error_code", error_message.alias("error_message")))


def lca_errors(components: DataFrame, created_at=None) -> DataFrame:
    """K8: the error rows of a run (``processing_errors`` layout)."""
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return (components.filter(F.col("failed"))
            .select("project_id", "element_id", "material_name",
                    F.col("error_code").alias("error_type"), "error_message", ts.alias("created_at")))


def lca_run_stats(components: DataFrame, version: str) -> DataFrame:
    """A7/N10 per project: valid elements, processed elements, failed elements and components.
    Two small aggregates (element, then project) that combine map-side."""
    per_element = (components.groupBy("project_id", "element_id")
                   .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("failed")).alias("n_failed")))
    return (per_element.groupBy("project_id")
            .agg(F.count(F.lit(1)).cast("int").alias("total_elements"),
                 F.count(F.lit(1)).cast("int").alias("processed_elements"),
                 F.count_if(F.col("n_failed") > 0).cast("int").alias("failed_elements"),
                 F.sum("n_failed").cast("long").alias("failed_components"),
                 F.sum("n").cast("long").alias("total_components"))
            .withColumn("kbob_version", F.lit(version))
            .withColumn("status", F.lit("completed")))


def element_summary(components: DataFrame) -> DataFrame:
    """A8 in flat form: per element the component count and ``shared_guid`` (count > 1)."""
    return (components.groupBy("project_id", "element_id")
            .agg(F.count(F.lit(1)).alias("n_components"), F.count_if(F.col("failed")).alias("n_failed"))
            .withColumn("shared_guid", F.col("n_components") > 1))


def impact_difference(totals: DataFrame, gone: DataFrame, new: DataFrame) -> DataFrame:
    """``project_impacts`` after some components changed: the totals before, less those of the rows that
    are ``gone``, plus those of the ``new`` ones. Exact: decimals are added, no other row is read."""
    names = [f"{n}_{kind}" for n, _, _ in INDICATORS for kind in ("absolute", "relative")]
    digits = {f"{n}_{kind}": d for n, _, d in INDICATORS for kind in ("absolute", "relative")}
    signed = lambda df, sign: df.select("project_id", (F.col("n_components") * sign).alias("n_components"),
                                        *((F.col(c).cast(f"decimal(38,{digits[c]})") * sign).cast(f"decimal(38,{digits[c]})").alias(c) for c in names))
    parts = signed(totals, 1).unionByName(signed(project_impacts(gone), -1)).unionByName(signed(project_impacts(new), 1))
    return (parts.groupBy("project_id").agg(F.sum("n_components").alias("n_components"), *(F.sum(c).cast("double").alias(c) for c in names))
            .filter(F.col("n_components") > 0))


def exact_sum(name: str, digits: int) -> Column:
    """Sum of values already rounded to ``digits``: added as DECIMAL, so the total does not
    depend on partitioning or row order, then returned as DOUBLE."""
    return F.sum(F.col(name).cast(f"decimal(38,{digits})")).cast("double")


def project_impacts(components: DataFrame) -> DataFrame:
    """Per-project totals of the successful components."""
    ok = components.filter(~F.col("failed"))
    sums = [exact_sum(f"{n}_{kind}", digits).alias(f"{n}_{kind}")
            for n, _, digits in INDICATORS for kind in ("absolute", "relative")]
    return ok.groupBy("project_id").agg(F.count(F.lit(1)).alias("n_components"), *sums)
