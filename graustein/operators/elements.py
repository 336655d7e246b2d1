"""Element documents -> element and material rows, and element validation
(P1, P2, P3, P4, P11, A12, J6, J13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.functions.numbers import not_positive


def _blank_to_null(c):
    return F.when(F.trim(c) != "", c)


def element_key():
    """First non-empty of ``id`` and ``guid``."""
    return F.coalesce(_blank_to_null(F.col("e.id")), _blank_to_null(F.col("e.guid")))


def explode_documents(docs: DataFrame) -> DataFrame:
    """One row per element, whether a document holds ``elements`` or is a bare element.

    ``docs`` is read with ``schemas.ELEMENT_DOCUMENT``. Rows that are neither are dropped
    (see ``rejected_documents``)."""
    from graustein.schemas import ELEMENT
    keep = [c for c in docs.columns if c not in {f.name for f in ELEMENT.fields} | {"elements", "metadata"}]
    bare = F.struct(*[F.col(f.name) for f in ELEMENT.fields])
    is_bare = F.col("id").isNotNull() | F.col("guid").isNotNull()
    items = F.when(F.col("elements").isNotNull(), F.col("elements")).when(is_bare, F.array(bare))
    return docs.select(*keep, F.explode(items).alias("e"))


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Documents with neither an ``elements`` list nor element fields."""
    return docs.filter(F.col("elements").isNull() & F.col("id").isNull() & F.col("guid").isNull())


def flatten_elements(exploded: DataFrame, project_id=None, as_of=None) -> DataFrame:
    """Element rows in the ``ifc_elements`` layout; rows without a key are dropped."""
    props = F.col("e.properties")
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    project = F.col("project_id") if project_id is None else F.lit(project_id)
    return (exploded.select(
        element_key().alias("id"),
        F.coalesce(F.col("e.ifc_class"), F.lit("Unknown")).alias("ifc_class"),
        F.col("e.object_type").alias("object_type"),
        F.coalesce(F.col("e.load_bearing"), props["loadBearing"]).alias("load_bearing"),
        F.coalesce(F.col("e.is_external"), props["isExternal"]).alias("is_external"),
        F.coalesce(_blank_to_null(props["ebkp"]), props["reference"]).alias("ebkp"),
        F.col("e.quantities.volume.net").alias("volume_net"),
        F.col("e.quantities.volume.gross").alias("volume_gross"),
        F.col("e.quantities.area.net").alias("area_net"),
        F.col("e.quantities.area.gross").alias("area_gross"),
        F.col("e.quantities.dimensions.length").alias("length"),
        F.col("e.quantities.dimensions.width").alias("width"),
        F.col("e.quantities.dimensions.height").alias("height"),
        project.alias("project_id"), ts.alias("timestamp"))
        .filter(F.col("id").isNotNull()))


def explode_materials(exploded: DataFrame) -> DataFrame:
    """One row per (element, material) from the ``material_volumes`` map.

    A missing density key and a null density are the same after a typed read; both give 0
    (the reference's default for a missing key)."""
    return (exploded.select(element_key().alias("element_id"),
                            F.explode("e.material_volumes").alias("material_name", "mv"))
            .filter(F.col("element_id").isNotNull())
            .select("element_id", "material_name",
                    F.col("mv.fraction").alias("fraction"), F.col("mv.volume").alias("volume"),
                    F.col("mv.width").alias("width"),
                    F.coalesce(F.col("mv.density"), F.lit(0.0)).alias("density")))


def document_components(exploded: DataFrame, project_id=None) -> DataFrame:
    """LCA input straight from documents: one row per material listed in ``materials``,
    with its volume data looked up in ``material_volumes`` (H15). No join is needed."""
    project = F.col("project_id") if project_id is None else F.lit(project_id)
    rows = exploded.select(
        project.alias("project_id"), element_key().alias("element_id"),
        F.coalesce(_blank_to_null(F.col("e.properties.ebkp")), F.col("e.properties.reference")).alias("ebkp"),
        F.col("e.material_volumes").alias("mv"), F.explode("e.materials").alias("material_name"))
    entry = F.try_element_at(F.col("mv"), F.col("material_name"))
    return (rows.filter(F.col("element_id").isNotNull())
            .select("project_id", "element_id", "material_name",
                    F.coalesce(entry["volume"], F.lit(0)).alias("volume"),
                    F.coalesce(entry["density"], F.lit(0)).alias("density"), "ebkp"))


def attach_elements(materials: DataFrame, elements: DataFrame) -> DataFrame:
    """Material rows with their element's project and classification.

    Both sides are large; the join shuffles once on ``element_id`` and everything after it
    that is keyed by element reuses that partitioning."""
    els = elements.select(F.col("id").alias("element_id"), "project_id", "ebkp")
    mats = materials.select("element_id", "material_name", "volume", "density")
    return mats.join(els, "element_id", "inner")


def positive_volume_elements(components_in: DataFrame) -> DataFrame:
    """Elements having at least one material with a volume > 0 (NaN does not count)."""
    return (components_in.groupBy("element_id")
            .agg(F.bool_or(~not_positive(F.col("volume"))).alias("has_positive_volume"))
            .filter(F.col("has_positive_volume"))
            .select("element_id"))


def validate_components(components_in: DataFrame) -> DataFrame:
    """Keep the material rows of elements that have a material with volume > 0.

    An aggregate that combines map-side and a semi join, which AQE can split: an element with
    a third of all rows never lands in one task."""
    return components_in.join(positive_volume_elements(components_in), "element_id", "left_semi").select(*components_in.columns)


def valid_component_rows(materials: DataFrame, elements: DataFrame) -> DataFrame:
    """J6 + P11: material rows of valid elements, with their element's project and classification.

    Which elements are valid follows from the materials alone (their ids and volumes), so it is
    settled before J6 and narrows the element side; the material rows themselves are joined once.
    The aggregate combines map-side and AQE can split the join: an element with a third of all rows
    never lands in one task. On tables bucketed by element (``sinks.writers.save_bucketed``) neither
    the aggregate nor the joins shuffle."""
    valid = positive_volume_elements(materials)
    return attach_elements(materials, elements.join(valid, F.col("id") == F.col("element_id"), "left_semi"))


def rejected_elements(elements: DataFrame, components_in: DataFrame) -> DataFrame:
    """P11 rejects with a reason: NO_MATERIALS or NO_POSITIVE_VOLUME."""
    per_element = (components_in.groupBy("element_id")
                   .agg(F.count(F.lit(1)).alias("n_materials"),
                        F.bool_or(~not_positive(F.col("volume"))).alias("has_positive_volume")))
    return (elements.select(F.col("id").alias("element_id"), "project_id")
            .join(per_element, "element_id", "left")
            .filter(F.col("has_positive_volume").isNull() | ~F.col("has_positive_volume"))
            .select("project_id", "element_id",
                    F.when(F.col("n_materials").isNull(), F.lit("NO_MATERIALS"))
                    .otherwise(F.lit("NO_POSITIVE_VOLUME")).alias("reason")))
