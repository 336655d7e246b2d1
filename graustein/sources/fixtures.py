"""Domain tables derived from the driver's TPC-H-like tables.

The driver ships ``orders``, ``lineitem``, ``part``, ``events``, ``nation`` and
``region``; these adapters give them the shape of the domain tables so every job
runs over data that grows with the scale factor:

* orders -> building elements (one order = one element, customer -> project)
* lineitem x part -> element material layers (part name = material)
* part -> material mapping and the versioned material catalogue
* events -> processing history and incoming messages
* nation/region -> classification catalogue text lines

All measures are DECIMAL so sums and products are exact in any engine.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed values of the fixture: 20 projects; the versions, the service-life and cost
# rows below are the reference data the queries run against.
N_PROJECTS = 20
ACTIVE_VERSION = "2024-v1"
VERSIONS = [("2023-v1", False, _dt.date(2023, 1, 1), "previous"),
            ("2024-v1", True, _dt.date(2024, 1, 1), "current")]
LIFE_ROWS = [("C2.1", "a", 50), ("C2.1", "b", 40), ("E3", "c", 25), ("C02.03", "d", 30)]
COST_ROWS = [("C2.1", "Aussenwand", "m2", Decimal("120.50"), "2024"),
             ("E3", "Fenster", "m", Decimal("80.25"), "2024"),
             ("C02.03", "Stuetze", "stk", Decimal("9.00"), "2024")]


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the file footer once per process (the driver
    tables are read-only), later reads pass it so no footer is read at planning time."""
    path = f"{sf_dir}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _ebkp(k):
    """The element's eBKP-H code in several spellings (by order key)."""
    variant = k % 5
    return (F.when(variant == 0, F.concat(F.lit("C02.0"), (k % 7 + 1).cast("string")))
            .when(variant == 1, F.concat(F.lit("C 2."), (k % 7 + 1).cast("string")))
            .when(variant == 2, F.lit("C2.1"))
            .when(variant == 3, F.lit(" E3 "))
            .otherwise(F.lit("Z9")))


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ifc_elements``-like rows: id, project_id, ebkp (several spellings), area_net, length."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(14,2)")
    return o.select(
        k.cast("string").alias("id"),
        F.concat(F.lit("P"), (F.col("o_custkey") % N_PROJECTS).cast("string")).alias("project_id"),
        _ebkp(k).alias("ebkp"),
        F.when(F.col("o_orderstatus") != "P", price * F.lit(Decimal("0.01"))).alias("area_net"),
        (price * F.lit(Decimal("0.001")) - F.lit(50)).alias("length"),
    )


def element_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ifc_element_materials``-like rows: one per (element, material name).

    The grouping combines map-side, so no element's raw rows are gathered first."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    joined = (li.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner")
              .select(F.col("l_orderkey").cast("string").alias("element_id"),
                      F.col("p_name").alias("material_name"),
                      F.col("l_quantity").cast("decimal(12,2)").alias("q"), "p_size"))
    size = F.max("p_size")
    return (joined.groupBy("element_id", "material_name")
            .agg((F.sum("q") - F.lit(5)).cast("decimal(12,2)").alias("volume"),
                 F.when(size % 10 == 0, F.lit(0)).otherwise(size * 50).cast("decimal(8,1)").alias("density")))


def mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Material mapping: part name -> smallest part key; names starting ``red `` unmapped."""
    p = table(spark, sf_dir, "part")
    return (p.filter(~F.col("p_name").startswith("red "))
            .groupBy(F.col("p_name").alias("ifc_material"))
            .agg(F.min("p_partkey").cast("string").alias("kbob_id")))


def kbob_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue in two versions; the active one lacks the PROMO parts (-> KBOB_NOT_FOUND)."""
    p = table(spark, sf_dir, "part")
    cols = [F.col("p_partkey").cast("string").alias("uuid"), F.col("p_name").alias("name"),
            F.col("p_retailprice").cast("decimal(10,3)").alias("indicator_co2eq"),
            (F.col("p_size").cast("decimal(10,3)") * F.lit(Decimal("3.5"))).cast("decimal(10,3)").alias("indicator_penre"),
            (F.col("p_size") * 1000).cast("decimal(12,3)").alias("indicator_ubp"),
            F.lit(None).cast("double").alias("density")]
    old = p.select(*cols, F.lit("2023-v1").alias("version"))
    new = p.filter(F.col("p_type") != "PROMO").select(*cols, F.lit(ACTIVE_VERSION).alias("version"))
    return old.unionByName(new)


def _few_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few literal rows. Spark knows their size, as that of a stored table, and can broadcast them;
    of rows that come from the Python process it doesn't, and would shuffle the facts to join them."""
    fields = [f.split() for f in schema.split(", ")]
    row = lambda r: F.struct(*(F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields)))
    return spark.range(1).select(F.inline(F.array(*map(row, rows))))


def kbob_versions(spark: SparkSession) -> DataFrame:
    return _few_rows(spark, VERSIONS, "version string, is_active boolean, release_date date, description string")


def life_expectancy(spark: SparkSession) -> DataFrame:
    return _few_rows(spark, LIFE_ROWS, "ebkp_code string, description string, years int")


def cost_reference(spark: SparkSession) -> DataFrame:
    return _few_rows(spark, COST_ROWS, "ebkp_code string, description string, unit string, cost_per_unit decimal(10,2), version string")


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One project per customer group found in the orders."""
    return (elements(spark, sf_dir).select("project_id").distinct()
            .select("project_id", F.concat(F.lit("Project "), F.col("project_id")).alias("name"),
                    F.lit(60).alias("life_expectancy"), F.lit(ACTIVE_VERSION).alias("kbob_version"),
                    F.lit("active").alias("status")))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``processing_history``-like rows: one run per event."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"),
                    F.concat(F.lit("P"), (F.col("user_id") % N_PROJECTS).cast("string")).alias("project_id"),
                    F.col("value").alias("processing_time"), F.col("event_type").alias("kbob_version"),
                    F.col("ts").alias("created_at"))


def catalogue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification catalogue as numbered text lines (``C 2.01 NATION_7``).

    Regions give main codes ``C r`` and ``E r`` (the ``E 0r`` lines repeat them later, so
    the later line wins); nations give two-level codes ``C r.j``; every nation also adds a
    comment line that is not a code."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rk, nk = F.col("r_regionkey"), F.col("n_nationkey")
    lines = [
        r.select((rk * 10).alias("line_no"), F.concat_ws(" ", F.lit("C"), rk.cast("string"), F.col("r_name")).alias("value")),
        n.select((F.lit(1000) + nk * 2).alias("line_no"),
                 F.concat(F.lit("C "), F.col("n_regionkey").cast("string"), F.lit("."),
                          F.lpad(F.floor(nk / 5).cast("string"), 2, "0"), F.lit(" "), F.col("n_name")).alias("value")),
        n.select((F.lit(1001) + nk * 2).alias("line_no"), F.concat(F.lit("# note "), F.col("n_name")).alias("value")),
        r.select((F.lit(2000) + rk).alias("line_no"), F.concat_ws(" ", F.lit("E"), rk.cast("string"), F.lower("r_name")).alias("value")),
        r.select((F.lit(3000) + rk).alias("line_no"), F.concat(F.lit("E 0"), rk.cast("string"), F.lit(" "), F.col("r_name")).alias("value")),
    ]
    out = lines[0]
    for df in lines[1:]:
        out = out.unionByName(df)
    return out


def _order_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("id"), _ebkp(F.col("o_orderkey")).alias("ebkp"),
                    "o_orderstatus", "o_orderpriority")


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property table: a name property, an ``eBKP`` property in the first set (without a
    value for finished orders) and an ``EBKP`` property in the second set. One orders scan
    per property row kind (no join)."""
    base = _order_attributes(spark, sf_dir)

    def rows(pset, prop, name, value):
        return base.select(F.col("id").alias("element_id"), F.lit(pset).alias("pset_pos"), F.lit(prop).alias("prop_pos"),
                           F.lit(name).alias("prop_name"), value.alias("prop_value"))
    return (rows(0, 0, "Name", F.col("o_orderpriority"))
            .unionByName(rows(0, 1, "eBKP", F.when(F.col("o_orderstatus") != "F", F.col("ebkp"))))
            .unionByName(rows(1, 0, "EBKP", F.concat(F.col("ebkp"), F.lit(" ")))))


def classification_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification references of the elements (none for low-priority orders)."""
    prio = F.col("o_orderpriority")
    return (_order_attributes(spark, sf_dir).filter(prio != "5-LOW")
            .select(F.col("id").alias("element_id"),
                    F.when(prio.startswith("1") | prio.startswith("2"), F.lit("IFC2X3")).otherwise(F.lit("IFC4")).alias("schema_version"),
                    F.lit("eBKP").alias("system"),
                    F.when(F.col("o_orderstatus") != "P", prio).otherwise(F.lit("")).alias("name"),
                    F.when(F.col("o_orderstatus") != "F", F.col("ebkp")).alias("item_reference"),
                    F.trim("ebkp").alias("identification")))
