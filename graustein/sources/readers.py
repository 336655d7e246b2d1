"""File sources (S1-S9, S12, S13) with declared schemas.

Readers return lazy DataFrames; files are split and read in parallel by Spark. CSV
headers of the reference files contain spaces, slashes and brackets, so columns are
selected with back-ticks and renamed to the snake_case table columns at once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graustein import schemas
from graustein.functions.numbers import to_number
from graustein.functions.ids import project_from_filename

# Column headers of the reference's input files.
KBOB_HEADERS = {
    "uuid": "UUID-Nummer",
    "name": "BAUMATERIALIEN",
    "indicator_co2eq": "Treibhausgasemissionen, Total [kg CO2-eq]",
    "indicator_penre": "Primaerenergie nicht erneuerbar, Total [kWh oil-eq]",
    "indicator_ubp": "UBP (Total)",
    "density": "Rohdichte/ Flaechenmasse",
}
LIFE_HEADERS = {"ebkp_code": "eBKP-H Code", "description": "Description", "years": "Years",
                "model_based": "model-based?"}
COST_HEADERS = {"ebkp_code": "Code", "description": "Bezeichnung", "unit": "reference", "cost_per_unit": "Kennwert"}
KBOB_ENCODING = "ISO-8859-1"


class UnsupportedFormat(ValueError):
    pass


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               encoding: str = "utf-8") -> DataFrame:
    """Read by extension (csv, json, parquet); anything else is an error."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if ext == ".csv":
        if schema is None:
            reader = reader.option("inferSchema", True)
        return reader.option("header", True).option("encoding", encoding).csv(path)
    if ext == ".json":
        return reader.option("multiLine", True).json(path)
    if ext == ".parquet":
        return reader.parquet(path)
    raise UnsupportedFormat("Unsupported file format")


def read_kbob_csv(spark: SparkSession, path: str, version: str, created_at=None) -> DataFrame:
    """S2 + P6: catalogue CSV (ISO-8859-1, German headers) -> ``kbob_materials`` rows of one version."""
    raw = (spark.read.option("header", True).option("encoding", KBOB_ENCODING)
           .option("quote", '"').option("escape", '"').csv(path))
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return raw.select(
        F.trim(F.col(_q(KBOB_HEADERS["uuid"]))).alias("uuid"),
        F.col(_q(KBOB_HEADERS["name"])).alias("name"),
        *[to_number(F.col(_q(KBOB_HEADERS[c]))).alias(c) for c in ("indicator_co2eq", "indicator_penre", "indicator_ubp")],
        F.coalesce(to_number(F.col(_q(KBOB_HEADERS["density"]))), F.lit(0.0)).alias("density"),
        F.lit(version).alias("version"), ts.alias("created_at"))


def read_positional_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """S3: header CSV whose columns are taken by position and cast to the table's schema."""
    schema = schemas.TABLES[table]
    raw = spark.read.option("header", True).csv(path)
    cols = raw.columns
    out = [F.col(_q(cols[i])).try_cast(f.dataType).alias(f.name) if i < len(cols) else F.lit(None).cast(f.dataType).alias(f.name)
           for i, f in enumerate(schema.fields)]
    return raw.select(*out)


def _json_list(spark: SparkSession, path: str, schema: T.StructType, framed: bool) -> DataFrame:
    """The objects of JSON lists: each file whole in one task, or (``framed``) over byte ranges."""
    if framed:
        from graustein.sources import json_arrays
        return json_arrays.read_items(spark, path, schema, None).select("e.*")
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_life_expectancy(spark: SparkSession, path: str, framed: bool = False) -> DataFrame:
    """Service life from a JSON list or a CSV (``eBKP-H Code, Description, Years, model-based?``);
    ``framed`` for lists too large for one task."""
    if path.endswith(".json"):
        schema = T.StructType([f for f in schemas.LIFE_EXPECTANCY.fields if f.name != "created_at"])
        df = _json_list(spark, path, schema, framed)
    else:
        raw = spark.read.option("header", True).csv(path)
        df = raw.select(*[F.col(_q(h)).alias(c) for c, h in LIFE_HEADERS.items()])
    return df.select(
        F.col("ebkp_code").cast("string"), F.col("description").cast("string"),
        F.col("years").cast("int").alias("years"),
        F.coalesce(F.col("model_based").cast("boolean"), F.lit(True)).alias("model_based"))


def read_cost_csv(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Cost key figures (``Code, Bezeichnung, reference, Kennwert``) + version literal."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        *[F.col(_q(h)).alias(c) for c, h in COST_HEADERS.items() if c != "cost_per_unit"],
        to_number(F.col(_q(COST_HEADERS["cost_per_unit"]))).alias("cost_per_unit"),
        F.lit(version).alias("version"))


MAPPING_FILE = T.StructType([
    T.StructField("project_id", T.StringType()), T.StructField("ifc_material", T.StringType()),
    T.StructField("kbob_material", T.StringType()), T.StructField("kbob_id", T.StringType()),
    T.StructField("kbob_version", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("is_modelled", T.BooleanType()), T.StructField("ebkp", T.StringType()),
    T.StructField("quantity", T.DoubleType()), T.StructField("created_at", T.TimestampType())])


def read_material_mappings(spark: SparkSession, path: str, project_id: str | None = None, framed: bool = False) -> DataFrame:
    """Mapping list (JSON); ``is_modelled`` defaults to true; ``project_id`` given by the caller
    when the file has none; ``framed`` for lists too large for one task."""
    df = _json_list(spark, path, MAPPING_FILE, framed)
    if project_id is not None:
        df = df.withColumn("project_id", F.coalesce("project_id", F.lit(project_id)))
    return df.withColumn("is_modelled", F.coalesce("is_modelled", F.lit(True)))


WHOLE_BYTES = 64 << 20  # a JSON file of up to so many bytes is read by one task


def read_element_documents(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Element documents (dict with ``elements`` or a bare list), one row per document or
    bare element, plus ``source_file`` and the project id derived from the file name (H14).

    The JSON reader holds a file in one task. Files of more than ``whole_bytes`` are framed over byte
    ranges (``sources.json_arrays``) and give a row per element, as a bare list does; the JSON reader
    takes those that hold no list."""
    df = spark.read.schema(schemas.ELEMENT_DOCUMENT).option("multiLine", True).json(path)
    large = F.col("_metadata.file_size") > whole_bytes
    name = F.col("_metadata.file_name")

    def rows(docs):
        return docs.select("*", name.alias("source_file"), project_from_filename(name).alias("project_id"))
    # file sizes only, no contents
    if not spark.read.format("binaryFile").load(path).select("length").filter(F.col("length") > whole_bytes).head(1):
        return rows(df)
    from graustein.sources import json_arrays
    fields = {f.name for f in schemas.ELEMENT.fields}
    items = json_arrays.read_items(spark, path, schemas.ELEMENT, larger_than=whole_bytes)
    framed = items.select(*(F.col(f"e.{f.name}").alias(f.name) if f.name in fields else F.lit(None).cast(f.dataType).alias(f.name)
                            for f in schemas.ELEMENT_DOCUMENT.fields), "source_file", project_from_filename("source_file").alias("project_id"))
    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > whole_bytes).select("path", F.col("_metadata.file_path").alias("file"))
    others = [r["path"] for r in files.join(items.select("file").distinct(), "file", "left_anti").collect()]
    out = rows(df.filter(~large)).unionByName(framed)
    return out.unionByName(rows(spark.read.schema(schemas.ELEMENT_DOCUMENT).option("multiLine", True).json(others))) if others else out


def read_cost_elements_csv(spark: SparkSession, path: str, project_id: str | None = None) -> DataFrame:
    """S8 + P5: flat cost-element CSV -> snake_case element rows."""
    from graustein.operators.cost import from_cost_file_columns
    return from_cost_file_columns(spark.read.option("header", True).csv(path), project_id)


def read_catalogue(spark: SparkSession, path: str, levels: int = 3, letter: str | None = None) -> DataFrame:
    """Classification catalogue text -> (code, description)."""
    from graustein.operators.classification import parse_catalogue, read_catalogue_lines
    return parse_catalogue(read_catalogue_lines(spark, path), levels, letter)


# The eleven template rows of the synthetic element set (GUID, density,
# KBOB uuid, eBKP-H code) and the value ranges drawn for the replicated rows.
TEMPLATE_ROWS = [
    ("1", 2770.0, "3A51918F-AB60-4CE7-A771-A10C3266684A", "C03.01"),
    ("2", 439.0, "75F8C2B2-0B4E-4243-93D6-9D8B721B4D12", "C03.02"),
    ("3", 34.3, "ACF64203-B038-4EAF-B297-53D8C48F8A42", "C04.01"),
    ("4", 1400.0, "1300707C-F4F2-4FDC-AF3B-E31F5840F18E", "C04.04"),
    ("5", 2300.0, "E13EE05E-FD34-4FB5-A178-0FC4164A96F2", "C04.05"),
    ("6", 605.0, "BD66B05D-27E3-4ADF-85A2-E0ABBBA686A5", "C04.08"),
    ("7", 7850.0, "4DC70979-B6CA-4DA5-A291-6F1A082EE475", "C04.01"),
    ("8", 148.0, "B9689582-8BDE-4FE1-849D-BBBED840E410", "C04.04"),
    ("9", 7850.0, "38C1572A-3CE8-47C0-B24E-5E924A8AD97E", "C04.05"),
    ("10", 1500.0, "9831C103-3AC5-439B-9BF1-3C1976328C98", "E02.05"),
    ("11", 2300.0, "E13EE05E-FD34-4FB5-A178-0FC4164A96F2", "F01.02"),
]
RANGES = {"density": (400.0, 3000.0, 2), "volume": (0.1, 100.0, 4), "length": (0.0, 500.0, 2), "area": (0.0, 1000.0, 2)}


def synthetic_elements(spark: SparkSession, n: int = 100_000, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """``n`` rows cycling through the template rows, with uniform random density,
    volume, length and area (seeded, rounded); generated in parallel from ``range``.
    Column names are those of the flat cost file."""
    templates = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(TEMPLATE_ROWS)],
        "t int, GUID string, template_density double, `KBOB UUID-Nummer` string, `eBKP-H` string")
    base = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    rows = base.select("id", (F.col("id") % len(TEMPLATE_ROWS)).cast("int").alias("t"))
    drawn = [F.round(F.lit(lo) + F.rand(seed + k) * F.lit(hi - lo), digits).alias(name)
             for k, (name, (lo, hi, digits)) in enumerate(RANGES.items())]
    return (rows.join(F.broadcast(templates), "t").select(  # eleven literal rows
        "id", "GUID", F.col("`KBOB UUID-Nummer`"), F.col("`eBKP-H`"), *drawn)
        .select("id", "GUID", F.col("density").alias("Density (kg/m³)"), F.col("volume").alias("Volume"),
                F.col("length").alias("Length"), F.col("area").alias("Area"), "KBOB UUID-Nummer", "eBKP-H"))
