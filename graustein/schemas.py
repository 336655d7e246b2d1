"""Declared schemas of every table (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType, MapType,
    StringType, StructField, StructType, TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


S, D, B, I, L, TS = StringType(), DoubleType(), BooleanType(), IntegerType(), LongType(), TimestampType()

KBOB_MATERIALS = _s(
    ("uuid", S, False), ("name", S, False), ("indicator_co2eq", D, False),
    ("indicator_penre", D, False), ("indicator_ubp", D, False), ("density", D, True),
    ("version", S, False), ("created_at", TS, True),
)
KBOB_VERSIONS = _s(
    ("version", S, False), ("is_active", B, True), ("release_date", DateType(), True),
    ("description", S, True), ("created_at", TS, True),
)
LIFE_EXPECTANCY = _s(
    ("ebkp_code", S, False), ("description", S, False), ("years", I, True),
    ("model_based", B, True), ("created_at", TS, True),
)
COST_REFERENCE = _s(
    ("ebkp_code", S, False), ("description", S, True), ("unit", S, True),
    ("cost_per_unit", D, True), ("version", S, False), ("created_at", TS, True),
)
PROJECTS = _s(
    ("project_id", S, False), ("name", S, True), ("life_expectancy", I, True),
    ("kbob_version", S, True), ("created_at", TS, True), ("updated_at", TS, True),
    ("status", S, True),
)
IFC_ELEMENTS = _s(
    ("id", S, False), ("ifc_class", S, False), ("object_type", S, True),
    ("load_bearing", B, True), ("is_external", B, True), ("ebkp", S, True),
    ("volume_net", D, True), ("volume_gross", D, True), ("area_net", D, True),
    ("area_gross", D, True), ("length", D, True), ("width", D, True), ("height", D, True),
    ("project_id", S, False), ("timestamp", TS, True),
)
IFC_ELEMENT_MATERIALS = _s(
    ("element_id", S, False), ("material_name", S, False), ("fraction", D, True),
    ("volume", D, True), ("width", D, True), ("density", D, True),
)
MATERIAL_MAPPINGS = _s(
    ("project_id", S, False), ("ifc_material", S, False), ("kbob_id", S, True),
    ("kbob_version", S, True), ("type", S, True), ("is_modelled", B, True),
    ("ebkp", S, True), ("quantity", D, True), ("created_at", TS, True),
)
PROCESSING_RESULTS = _s(
    ("element_id", S, True), ("material_name", S, False), ("kbob_uuid", S, False),
    ("kbob_version", S, False), ("volume", D, True), ("density", D, True),
    ("gwp_absolute", D, True), ("gwp_relative", D, True), ("penr_absolute", D, True),
    ("penr_relative", D, True), ("ubp_absolute", D, True), ("ubp_relative", D, True),
    ("amortization", I, True), ("ebkp_h", S, True), ("failed", B, True), ("error", S, True),
    ("project_id", S, False), ("created_at", TS, True),
)
PROCESSING_ERRORS = _s(
    ("project_id", S, True), ("element_id", S, True), ("material_name", S, True),
    ("error_type", S, True), ("error_message", S, True), ("created_at", TS, True),
)
PROCESSING_HISTORY = _s(
    ("project_id", S, True), ("total_elements", I, True), ("processed_elements", I, True),
    ("failed_elements", I, True), ("processing_time", D, True), ("kbob_version", S, True),
    ("created_at", TS, True),
)
COST_RESULTS = _s(
    ("project_id", S, True), ("guid", S, False), ("ebkp_h", S, True), ("quantity", D, True),
    ("unit", S, True), ("unit_cost", D, True), ("total_cost", D, True), ("failed", B, False),
    ("error_code", S, True), ("error", S, True),
)

# Nested element document (one model file). Keys may be absent.
MATERIAL_VOLUME = _s(("fraction", D, True), ("volume", D, True), ("width", D, True), ("density", D, True))
ELEMENT = _s(
    ("id", S, True), ("guid", S, True), ("ifc_class", S, True), ("object_type", S, True),
    ("load_bearing", B, True), ("is_external", B, True),
    ("properties", _s(("loadBearing", B, True), ("isExternal", B, True), ("ebkp", S, True),
                      ("reference", S, True)), True),
    ("quantities", _s(
        ("volume", _s(("net", D, True), ("gross", D, True)), True),
        ("area", _s(("net", D, True), ("gross", D, True)), True),
        ("dimensions", _s(("length", D, True), ("width", D, True), ("height", D, True)), True),
    ), True),
    ("materials", ArrayType(S), True),
    ("material_volumes", MapType(S, MATERIAL_VOLUME), True),
)
METADATA = _s(
    ("total_elements", I, True), ("total_pages", I, True), ("current_page", I, True),
    ("page_size", I, True),
    ("units", _s(("length", S, True), ("area", S, True), ("volume", S, True)), True),
)
# A document is either {elements:[...], metadata:{...}} or a bare list of elements; reading
# with the union of both field sets gives one row per document or one row per bare element.
ELEMENT_DOCUMENT = StructType(
    [StructField("elements", ArrayType(ELEMENT), True), StructField("metadata", METADATA, True)]
    + list(ELEMENT.fields)
)

# Property and classification-reference tables (flat forms of the model's property sets).
PROPERTIES = _s(
    ("element_id", S, False), ("pset_pos", I, False), ("prop_pos", I, False),
    ("prop_name", S, True), ("prop_value", S, True),
)
CLASSIFICATION_REFS = _s(
    ("element_id", S, False), ("schema_version", S, True), ("system", S, True),
    ("name", S, True), ("item_reference", S, True), ("identification", S, True),
)

MESSAGE = _s(("value", S, True))

TABLES = {
    "kbob_materials": KBOB_MATERIALS, "kbob_versions": KBOB_VERSIONS,
    "life_expectancy": LIFE_EXPECTANCY, "cost_reference": COST_REFERENCE,
    "projects": PROJECTS, "ifc_elements": IFC_ELEMENTS,
    "ifc_element_materials": IFC_ELEMENT_MATERIALS, "material_mappings": MATERIAL_MAPPINGS,
    "processing_results": PROCESSING_RESULTS, "processing_errors": PROCESSING_ERRORS,
    "processing_history": PROCESSING_HISTORY, "cost_results": COST_RESULTS,
}

# Primary / unique keys and NOT NULL columns of the tables (P19 data-quality checks).
KEYS = {
    "kbob_materials": ["uuid", "version"], "kbob_versions": ["version"],
    "life_expectancy": ["ebkp_code", "description"], "cost_reference": ["ebkp_code", "version"],
    "projects": ["project_id"], "ifc_elements": ["id"],
    "ifc_element_materials": ["element_id", "material_name"],
    "material_mappings": ["project_id", "ifc_material", "kbob_id", "kbob_version"],
}
NOT_NULL = {name: [f.name for f in schema.fields if not f.nullable] for name, schema in TABLES.items()}
PROJECT_STATUSES = ("active", "processing", "completed", "failed")
