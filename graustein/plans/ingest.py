"""Model ingestion (S7 -> P1-P4 -> M1, M2, M3 with H12 ids; X3).

Each element gets a repeatable id (hash of project, source file and its own id/guid)
instead of a random one, so delivering the same model twice upserts the same rows
instead of adding copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.functions.ids import element_uid
from graustein.operators import elements as el
from graustein.operators import maintenance as mt


def _with_uids(exploded: DataFrame) -> DataFrame:
    key = el.element_key()
    return exploded.withColumn("e", F.col("e").withField(
        "id", F.when(key.isNotNull(), element_uid(F.col("project_id"), F.col("source_file"), key))))


def documents_to_tables(docs: DataFrame, as_of=None) -> tuple[DataFrame, DataFrame]:
    """Element and material rows of read documents (``sources.readers.read_element_documents``)."""
    exploded = _with_uids(el.explode_documents(docs))
    return el.flatten_elements(exploded, as_of=as_of), el.explode_materials(exploded)


def upsert_projects(projects: DataFrame, project_ids: DataFrame, as_of=None, kbob_version: str | None = None) -> DataFrame:
    """M3 in bulk: every project named in ``project_ids`` exists afterwards and is active."""
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    hit = project_ids.select("project_id").distinct().withColumn("_hit", F.lit(True))
    merged = mt.project_defaults(projects.join(hit, "project_id", "full"), F.coalesce("_hit", F.lit(False)), None, kbob_version)
    return (merged
            .withColumn("created_at", F.coalesce(F.col("created_at"), ts))
            .withColumn("updated_at", F.when(F.col("_hit"), ts).otherwise(F.col("updated_at")))
            .withColumn("status", F.when(F.col("_hit"), F.lit("active")).otherwise(F.col("status")))
            .select(*projects.columns))


def ingest(docs: DataFrame, projects: DataFrame, elements: DataFrame, materials: DataFrame,
           as_of=None, kbob_version: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Store a batch of model documents: projects (M3), elements (M1), materials (M2)."""
    new_elements, new_materials = documents_to_tables(docs, as_of)
    new_elements = new_elements.select(*elements.columns)
    return (upsert_projects(projects, new_elements, as_of, kbob_version),
            mt.upsert_elements(elements, new_elements, as_of),
            mt.upsert_materials(materials, new_materials.select(*materials.columns)))
