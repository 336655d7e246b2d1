"""eBKP-H classification.

The model's property sets arrive as a flat property table
(``element_id, pset_pos, prop_pos, prop_name, prop_value``); classification references
as (``element_id, schema_version, system, name, item_reference, identification``).
The catalogue is a small dimension (a few hundred codes), which Spark broadcasts if its
size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graustein.functions.ebkp import CATALOGUE_LINE_PATTERN, main_code, normalize_code, parent_code
from graustein.operators.joins import last_wins, left_lookup

# Match levels of the hierarchical lookup.
EXACT, PARENT, MAIN, NONE = "exact", "parent", "main", "none"


def read_catalogue_lines(spark: SparkSession, path: str) -> DataFrame:
    """S12 source: numbered lines of catalogue text files (one file is one small task)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("line_no", "value"))
            .select("file", "line_no", F.regexp_replace("value", "\r$", "").alias("value")))


def parse_catalogue(lines: DataFrame, levels: int = 3, letter: str | None = None) -> DataFrame:
    """S12 (+P22): ``"B 6.1 Abholzung"`` lines -> (code, description), normalised (H1/H2),
    optionally only codes of one leading letter; a later line wins for a repeated code (N8)."""
    order = [c for c in ("file", "line_no") if c in lines.columns]
    text = F.trim("value")
    parsed = (lines.select(*order, text.alias("t"))
              .filter(F.col("t").rlike(CATALOGUE_LINE_PATTERN))
              .select(*order,
                      F.regexp_extract("t", CATALOGUE_LINE_PATTERN, 1).alias("letter"),
                      F.regexp_extract("t", CATALOGUE_LINE_PATTERN, 2).alias("number"),
                      F.regexp_extract("t", CATALOGUE_LINE_PATTERN, 3).alias("description")))
    if letter is not None:
        parsed = parsed.filter(F.col("letter") == F.lit(letter))
    coded = parsed.select(*order, normalize_code(F.concat("letter", F.lit(" "), "number"), levels).alias("code"),
                          "description")
    return last_wins(coded, ["code"], order).select("code", "description")


def first_ebkp_property(props: DataFrame, stop_on_empty: bool = True) -> DataFrame:
    """T5: per element the value of the first property named ``ebkp`` (any case).

    ``stop_on_empty=True`` (mapper): the very first such property decides, a missing value
    counts as empty. ``False`` (classifier): only the first such property of each set is
    looked at, and sets whose property has no value are skipped."""
    e = props.filter(F.lower("prop_name") == "ebkp")
    if stop_on_empty:
        chosen = e.groupBy("element_id").agg(
            F.min_by(F.coalesce("prop_value", F.lit("")), F.struct("pset_pos", "prop_pos")).alias("ebkp_value"))
    else:
        per_set = e.groupBy("element_id", "pset_pos").agg(F.min_by("prop_value", F.col("prop_pos")).alias("v"))
        chosen = (per_set.filter(F.col("v").isNotNull()).groupBy("element_id")
                  .agg(F.min_by("v", F.col("pset_pos")).alias("ebkp_value")))
    return chosen


def classify_hierarchical(values: DataFrame, catalogue: DataFrame) -> DataFrame:
    """J9 (mapper): normalise (3 levels) and look up exact -> parent -> main -> own text.

    Output: element_id, identification (raw value), code, description, match_level."""
    cat = catalogue.select("code", "description")
    v = (values.filter(F.trim("ebkp_value") != "")
         .select("element_id", F.col("ebkp_value").alias("identification"),
                 normalize_code("ebkp_value", 3).alias("code")))
    v = v.select("element_id", "identification", "code",
                 parent_code("code").alias("parent"), main_code(F.split("code", r"\.")[0]).alias("main"))
    # three lookups of the same catalogue
    for level in ("exact", "parent", "main"):
        key = "code" if level == "exact" else level
        side = cat.select(F.col("code").alias(key), F.col("description").alias(f"d_{level}"))
        v = left_lookup(v, side, [key])
    d_exact, d_parent, d_main = F.col("d_exact"), F.col("d_parent"), F.col("d_main")
    level = (F.when(d_exact.isNotNull(), F.lit(EXACT)).when(d_parent.isNotNull(), F.lit(PARENT))
             .when(d_main.isNotNull(), F.lit(MAIN)).otherwise(F.lit(NONE)))
    return v.select("element_id", "identification", "code",
                    F.coalesce(d_exact, d_parent, d_main, F.col("identification")).alias("description"),
                    level.alias("match_level"))


def classify_exact(values: DataFrame, catalogue: DataFrame) -> DataFrame:
    """J10 (classifier): normalise (2 levels), exact lookup, else own text.
    ``identification`` is the normalised code."""
    cat = catalogue.select(F.col("code").alias("identification"), F.col("description").alias("d"))
    v = (values.filter(F.trim("ebkp_value") != "")
         .select("element_id", "ebkp_value", normalize_code("ebkp_value", 2).alias("identification")))
    j = left_lookup(v, cat, ["identification"])
    return j.select("element_id", "identification",
                    F.coalesce("d", "ebkp_value").alias("description"),
                    F.when(F.col("d").isNotNull(), F.lit(EXACT)).otherwise(F.lit(NONE)).alias("match_level"))


def coverage(element_ids: DataFrame, classified: DataFrame) -> DataFrame:
    """Elements processed, elements with a code, exact matches. ``classified`` has at
    most one row per element, so a keyed left join and one aggregate give all three."""
    c = classified.select("element_id", F.lit(True).alias("_has_code"), "match_level")
    return (element_ids.select("element_id").join(c, "element_id", "left")
            .agg(F.count(F.lit(1)).alias("elements_processed"),
                 F.count_if(F.col("_has_code").isNotNull()).alias("elements_with_ebkp"),
                 F.count_if(F.col("match_level") == EXACT).alias("elements_with_match")))


def code_diagnostics(values: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The distinct raw codes, their normalised form and whether it is in the catalogue."""
    cat = catalogue.select(F.col("code").alias("c"))
    d = values.select(F.col("ebkp_value").alias("raw")).filter(F.col("raw").isNotNull()).distinct()
    d = d.select("raw", normalize_code("raw", 3).alias("normalized"))
    return (d.join(cat, d.normalized == cat.c, "left")
            .select("raw", "normalized", F.col("c").isNotNull().alias("in_catalogue")))


def incomplete_references(refs: DataFrame) -> DataFrame:
    """References whose name or code is empty; the code is ``item_reference`` for
    IFC2X3 schemas and ``identification`` otherwise."""
    code = F.when(F.col("schema_version").contains("2X3"), F.col("item_reference")).otherwise(F.col("identification"))
    return (refs.select("*", (F.coalesce("name", F.lit("")) == "").alias("name_missing"),
                        (F.coalesce(code, F.lit("")) == "").alias("id_missing"))
            .filter(F.col("name_missing") | F.col("id_missing")))


def completeness(element_ids: DataFrame, refs: DataFrame) -> DataFrame:
    """Total elements, with classification, with an incomplete one, % incomplete
    (references are first reduced to one row per element, then joined by key)."""
    code = F.when(F.col("schema_version").contains("2X3"), F.col("item_reference")).otherwise(F.col("identification"))
    incomplete = (F.coalesce("name", F.lit("")) == "") | (F.coalesce(code, F.lit("")) == "")
    per_el = refs.groupBy("element_id").agg(F.bool_or(incomplete).alias("incomplete"))
    counts = (element_ids.select("element_id").join(per_el, "element_id", "left")
              .agg(F.count(F.lit(1)).alias("total_elements"),
                   F.count_if(F.col("incomplete").isNotNull()).alias("with_classification"),
                   F.count_if(F.col("incomplete")).alias("with_incomplete")))
    pct = F.when(F.col("with_classification") > 0,
                 F.round(F.col("with_incomplete") * F.lit(100.0) / F.col("with_classification"), 2))
    return counts.withColumn("pct_incomplete", pct)


def assign_codes(element_ids: DataFrame, catalogue: DataFrame, seed: int = 0, letter: str | None = "C") -> DataFrame:
    """A repeatable pseudo-random catalogue code per element.

    The catalogue is numbered 0..k-1 by code, in two levels: within each three-character
    prefix, then by the counts of the smaller prefixes. Each element picks
    ``hash(element_id, seed) mod k``."""
    cat = catalogue if letter is None else catalogue.filter(F.col("code").startswith(letter))
    from pyspark.sql import Window
    keyed = cat.select("code", "description", F.substring("code", 1, 3).alias("prefix"))
    # one row per prefix: its first number
    counts = keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select("prefix", (F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("first"))
    inside = keyed.withColumn("at", F.row_number().over(Window.partitionBy("prefix").orderBy("code")) - 1)
    numbered = inside.join(first, "prefix").select("code", "description", (F.col("first") + F.col("at")).alias("idx"))
    k = cat.count()
    if k == 0:
        raise ValueError(f"No valid EBKP codes found starting with '{letter}'")
    pick = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("element_id"), F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return (element_ids.select("element_id", F.pmod(pick, F.lit(k)).alias("idx"))
            .join(numbered, "idx", "inner")
            .select("element_id", F.col("code").alias("identification"), F.col("description").alias("name")))


def as_references(assigned: DataFrame, schema_version: str, system: str = "EBKP") -> DataFrame:
    """H17 output as classification references: the code goes to ``item_reference`` for
    IFC2X3 schemas and to ``identification`` otherwise, ready for P21/A10 checks."""
    two_x3 = "2X3" in schema_version
    return assigned.select(
        "element_id", F.lit(schema_version).alias("schema_version"), F.lit(system).alias("system"), "name",
        (F.col("identification") if two_x3 else F.lit(None).cast("string")).alias("item_reference"),
        (F.lit(None).cast("string") if two_x3 else F.col("identification")).alias("identification"))
