"""Cost computation (C2): J5, H7, N2, N6, P5, P10, P12, A7.

One row per element: its eBKP-H code is looked up in the cost key figures of one
version (a small dimension, which Spark broadcasts if its size allows); the unit decides whether
area (m2) or length (m) is the quantity; quantity x key figure is the cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graustein.functions.numbers import is_missing, not_positive
from graustein.operators.joins import left_lookup

# Cost error codes in check order (N2), the two units and the component name.
COST_CODE_NOT_FOUND = "COST_CODE_NOT_FOUND"
AMBIGUOUS_COST_CODE = "AMBIGUOUS_COST_CODE"
UNKNOWN_UNIT = "UNKNOWN_UNIT"
INVALID_QUANTITY = "INVALID_QUANTITY"
UNIT_AREA = "m2"
UNIT_LENGTH = "m"
COST_COMPONENT = "Cost Calculation"

# P5: names of the flat cost-element file (edge only; snake_case inside).
# The file's column names for the element columns, and those that it must have.
COST_ALIASES = {"id": "GUID", "volume_net": "Volume", "length": "Length", "area_net": "Area", "ebkp": "eBKP-H"}
REQUIRED_COST_COLUMNS = ("GUID", "Volume", "Length", "Area", "KBOB UUID-Nummer", "eBKP-H")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def cost_keys(cost_reference: DataFrame, version: str | None = None) -> DataFrame:
    """Key figures of one version (default: the greatest version string), one row
    per trimmed code with the number of rows found for it (more than one is ambiguous)."""
    if version is None:
        version = cost_reference.agg(F.max("version")).first()[0]
    rows = cost_reference.filter(F.col("version") == F.lit(version)) if version is not None else cost_reference
    return (rows.groupBy(F.trim("ebkp_code").alias("cost_code"))
            .agg(F.count(F.lit(1)).alias("n_keys"), F.min("unit").alias("unit"),
                 F.min("cost_per_unit").alias("cost_per_unit")))


def cost_components(elements: DataFrame, cost_reference: DataFrame, version: str | None = None) -> DataFrame:
    """C2 core: one result row per element, good or failed."""
    keys = cost_keys(cost_reference, version).withColumnRenamed("cost_code", "ebkp_h")
    code = F.trim(F.col("ebkp"))
    facts = elements.select(F.col("project_id"), F.col("id").alias("guid"), code.alias("ebkp_h"), "area_net", "length")
    df = left_lookup(facts, keys, ["ebkp_h"])
    unit = F.col("unit")
    quantity = F.when(unit == UNIT_AREA, F.col("area_net")).when(unit == UNIT_LENGTH, F.col("length"))
    error_code = (F.when(F.col("n_keys").isNull(), F.lit(COST_CODE_NOT_FOUND))
                  .when(F.col("n_keys") > 1, F.lit(AMBIGUOUS_COST_CODE))
                  .when(unit.isNull() | ~unit.isin(UNIT_AREA, UNIT_LENGTH), F.lit(UNKNOWN_UNIT))
                  .when(not_positive(quantity), F.lit(INVALID_QUANTITY)))
    error = (F.when(F.col("n_keys").isNull(), F.concat(F.lit("'"), _text(F.col("ebkp_h")), F.lit("'")))
             .when(F.col("n_keys") > 1, F.concat(F.lit("Ambiguous cost code: "), F.col("ebkp_h")))
             .when(unit.isNull() | ~unit.isin(UNIT_AREA, UNIT_LENGTH), F.concat(F.lit("Unknown unit type: "), _text(unit)))
             .when(not_positive(quantity),
                   F.concat(F.lit("Invalid quantity: "), F.when(is_missing(quantity), F.lit("nan")).otherwise(quantity.cast("string")))))
    ok = F.col("error_code").isNull()
    return (df.withColumn("error_code", error_code)
            .select("project_id", "guid", "ebkp_h",
                    F.when(ok, quantity).cast("double").alias("quantity"),
                    F.when(ok, unit).alias("unit"),
                    F.when(ok, F.round(F.col("cost_per_unit"), 2)).cast("double").alias("unit_cost"),
                    F.when(ok, F.round(quantity * F.col("cost_per_unit"), 2)).cast("double").alias("total_cost"),
                    (~ok).alias("failed"), "error_code", error.alias("error")))


def cost_errors(components: DataFrame, created_at=None) -> DataFrame:
    """K8 rows of a cost run."""
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return (components.filter(F.col("failed"))
            .select("project_id", F.col("guid").alias("element_id"), F.lit(COST_COMPONENT).alias("material_name"),
                    F.col("error_code").alias("error_type"), F.col("error").alias("error_message"),
                    ts.alias("created_at")))


def cost_run_stats(components: DataFrame) -> DataFrame:
    """A7/N10 for cost: all counters count elements; ``failed`` status if any element failed."""
    return (components.groupBy("project_id")
            .agg(F.count(F.lit(1)).cast("int").alias("total_elements"),
                 F.count(F.lit(1)).cast("int").alias("processed_elements"),
                 F.count_if(F.col("failed")).cast("int").alias("failed_elements"))
            .withColumn("kbob_version", F.lit("N/A"))
            .withColumn("status", F.when(F.col("failed_elements") == 0, F.lit("completed")).otherwise(F.lit("failed"))))


def project_costs(components: DataFrame) -> DataFrame:
    """Per-project cost totals (exact decimal sum of the 2-dp amounts)."""
    return (components.filter(~F.col("failed")).groupBy("project_id")
            .agg(F.count(F.lit(1)).alias("n_elements"),
                 F.sum(F.col("total_cost").cast("decimal(38,2)")).cast("double").alias("total_cost")))


def to_cost_file_columns(elements: DataFrame) -> DataFrame:
    """P5: element rows with the flat cost-file column names (edge of the system)."""
    return elements.select(*[F.col(k).alias(v) for k, v in COST_ALIASES.items()])


def from_cost_file_columns(flat: DataFrame, project_id: str | None = None) -> DataFrame:
    """Flat cost-file columns -> snake_case element columns. A column that comes under
    its snake_case name is given its file name first (the material id: from ``id``)."""
    from graustein.operators.quality import require_columns
    for own, name in (*COST_ALIASES.items(), ("id", "KBOB UUID-Nummer")):
        if name not in flat.columns and own in flat.columns:
            flat = flat.withColumn(name, F.col(own))
    require_columns(flat, REQUIRED_COST_COLUMNS)
    out = flat.select(*[F.col(f"`{v}`").alias(k) for k, v in COST_ALIASES.items()])
    out = out.withColumn("id", F.col("id").cast("string"))
    for c in ("volume_net", "length", "area_net"):
        out = out.withColumn(c, F.col(c).cast("double"))
    return out.withColumn("project_id", F.lit(project_id))
