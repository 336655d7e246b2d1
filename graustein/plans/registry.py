"""Registered queries over the driver's tables: name -> (spark, sf_dir) -> DataFrame.

Each query runs a library operator over the fixture domain tables (``sources.fixtures``),
over the whole tables. ``ORACLE`` holds the matching DuckDB SQL where one exists.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graustein.operators import cost as cost_ops
from graustein.operators import lca as lca_ops
from graustein.plans import jobs
from graustein.plans.oracle import COST_VIEWS, LCA_VIEWS, with_views
from graustein.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def lca_inputs(spark: SparkSession, sf_dir: str) -> jobs.LcaInputs:
    return jobs.LcaInputs(
        elements=fx.elements(spark, sf_dir), materials=fx.element_materials(spark, sf_dir),
        mappings=fx.mappings(spark, sf_dir), catalogue=fx.kbob_materials(spark, sf_dir),
        versions=fx.kbob_versions(spark), life=fx.life_expectancy(spark))


def lca_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    comps, _ = jobs.lca(lca_inputs(spark, sf_dir))
    return comps


def cost_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.cost(fx.elements(spark, sf_dir), fx.cost_reference(spark))


# ---------------------------------------------------------------- LCA

@query("lca_components", with_views(LCA_VIEWS, body="SELECT * FROM lca_components"))
def q_lca_components(spark, sf_dir):
    """Every element x material row with its impacts or its error."""
    return lca_components(spark, sf_dir)


def bucketed_inputs(spark: SparkSession, sf_dir: str, buckets: int = 8) -> jobs.LcaInputs:
    """The LCA's tables with elements and materials stored bucketed by element."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sinks import writers
    inputs, tag = lca_inputs(spark, sf_dir), uuid.uuid4().hex
    path = scratch_path(spark, "bucketed", tag)
    inputs.elements = writers.save_bucketed(inputs.elements, f"{path}/elements", f"elements_{tag}", "id", buckets)
    inputs.materials = writers.save_bucketed(inputs.materials, f"{path}/materials", f"materials_{tag}", "element_id", buckets)
    return inputs


@query("lca_bucketed", with_views(LCA_VIEWS, body="SELECT * FROM lca_components"))
def q_lca_bucketed(spark, sf_dir):
    """C1 on tables stored bucketed by element (J6/J13, P11): no shuffle of the facts."""
    comps, _ = jobs.lca(bucketed_inputs(spark, sf_dir))
    return comps


@query("lca_from_documents", with_views(LCA_VIEWS, body="SELECT * FROM lca_components"))
def q_lca_from_documents(spark, sf_dir):
    """S7/H15 path: element documents (materials list + material_volumes map) built from the
    tables, then the same LCA straight from the documents; equals the table path."""
    from graustein.operators import elements as el
    mats = fx.element_materials(spark, sf_dir)
    # a document per layer: an element may come in several documents, and none has to be gathered
    layers = mats.select("element_id", F.array("material_name").alias("materials"),
                         F.create_map("material_name", F.struct("volume", "density")).alias("material_volumes"))
    els = fx.elements(spark, sf_dir)
    docs = (els.join(layers, els.id == layers.element_id, "inner")
            .select("project_id", F.struct(F.col("id"), F.lit(None).cast("string").alias("guid"),
                                           F.struct(F.col("ebkp"), F.lit(None).cast("string").alias("reference")).alias("properties"),
                                           "materials", "material_volumes").alias("e")))
    rows = el.validate_components(el.document_components(docs))
    from graustein.operators import catalogue as cat
    version = cat.active_version(fx.kbob_versions(spark))
    return lca_ops.lca_components(rows, fx.mappings(spark, sf_dir), fx.kbob_materials(spark, sf_dir),
                                  fx.life_expectancy(spark), version)


@query("lca_outcomes", with_views(LCA_VIEWS, body="""
SELECT COALESCE(error_code, 'OK') AS outcome, COUNT(*) AS n_components,
       COUNT(DISTINCT element_id) AS n_elements
FROM lca_components GROUP BY 1"""))
def q_lca_outcomes(spark, sf_dir):
    """Component and element counts per outcome (error code or OK)."""
    return (lca_components(spark, sf_dir)
            .groupBy(F.coalesce("error_code", F.lit("OK")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_components"), F.countDistinct("element_id").alias("n_elements")))


# ---------------------------------------------------------------- cost

@query("cost_components", with_views(COST_VIEWS, body="SELECT * FROM cost_components"))
def q_cost_components(spark, sf_dir):
    """One cost row per element."""
    return cost_components(spark, sf_dir)


@query("cost_outcomes", with_views(COST_VIEWS, body="""
SELECT COALESCE(error_code, 'OK') AS outcome, COUNT(*) AS n_elements FROM cost_components GROUP BY 1"""))
def q_cost_outcomes(spark, sf_dir):
    """Elements per cost outcome."""
    return (cost_components(spark, sf_dir).groupBy(F.coalesce("error_code", F.lit("OK")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_elements")))


@query("cost_run_stats", with_views(COST_VIEWS, body="""
SELECT project_id, CAST(COUNT(*) AS INTEGER) AS total_elements, CAST(COUNT(*) AS INTEGER) AS processed_elements,
       CAST(COUNT(*) FILTER (WHERE failed) AS INTEGER) AS failed_elements, 'N/A' AS kbob_version,
       CASE WHEN COUNT(*) FILTER (WHERE failed) = 0 THEN 'completed' ELSE 'failed' END AS status
FROM cost_components GROUP BY project_id"""))
def q_cost_run_stats(spark, sf_dir):
    """A7/N10 for cost runs, per project."""
    return cost_ops.cost_run_stats(cost_components(spark, sf_dir))


@query("cost_project_totals", with_views(COST_VIEWS, body="""
SELECT project_id, COUNT(*) AS n_elements, CAST(SUM(CAST(total_cost AS DECIMAL(38,2))) AS DOUBLE) AS total_cost
FROM cost_components WHERE NOT failed GROUP BY project_id"""))
def q_cost_project_totals(spark, sf_dir):
    """Per-project cost totals of the successful elements."""
    return cost_ops.project_costs(cost_components(spark, sf_dir))


@query("cost_errors", with_views(COST_VIEWS, body="""
SELECT project_id, guid AS element_id, 'Cost Calculation' AS material_name, error_code AS error_type,
       error AS error_message FROM cost_components WHERE failed"""))
def q_cost_errors(spark, sf_dir):
    """K8 rows of the cost run."""
    return cost_ops.cost_errors(cost_components(spark, sf_dir)).drop("created_at")


# ---------------------------------------------------------------- LCA results

@query("lca_errors", with_views(LCA_VIEWS, body="""
SELECT project_id, element_id, material_name, error_code AS error_type, error_message
FROM lca_components WHERE failed"""))
def q_lca_errors(spark, sf_dir):
    """K8: the error table of the LCA run."""
    return lca_ops.lca_errors(lca_components(spark, sf_dir)).drop("created_at")


@query("lca_run_stats", with_views(LCA_VIEWS, body="""
, per_el AS (SELECT project_id, element_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE failed) AS n_failed
            FROM lca_components GROUP BY project_id, element_id)
SELECT project_id, CAST(COUNT(*) AS INTEGER) AS total_elements, CAST(COUNT(*) AS INTEGER) AS processed_elements,
       CAST(COUNT(*) FILTER (WHERE n_failed > 0) AS INTEGER) AS failed_elements,
       CAST(SUM(n_failed) AS BIGINT) AS failed_components, CAST(SUM(n) AS BIGINT) AS total_components,
       '2024-v1' AS kbob_version, 'completed' AS status
FROM per_el GROUP BY project_id""".replace("\n, per_el", "per_el", 0)))
def q_lca_run_stats(spark, sf_dir):
    """Run statistics per project."""
    comps, version = jobs.lca(lca_inputs(spark, sf_dir))
    return lca_ops.lca_run_stats(comps, version)


@query("lca_element_summary", with_views(LCA_VIEWS, body="""
SELECT project_id, element_id, COUNT(*) AS n_components, COUNT(*) FILTER (WHERE failed) AS n_failed,
       COUNT(*) > 1 AS shared_guid
FROM lca_components GROUP BY project_id, element_id"""))
def q_lca_element_summary(spark, sf_dir):
    """A8 (flat): components per element and shared_guid."""
    return lca_ops.element_summary(lca_components(spark, sf_dir))


_IMPACT_SUMS = ", ".join(
    f"CAST(SUM(CAST({n}_{k} AS DECIMAL(38,{d}))) AS DOUBLE) AS {n}_{k}"
    for n, d in (("gwp", 3), ("penr", 3), ("ubp", 0)) for k in ("absolute", "relative"))


@query("lca_project_totals", with_views(LCA_VIEWS, body=f"""
SELECT project_id, COUNT(*) AS n_components, {_IMPACT_SUMS}
FROM lca_components WHERE NOT failed GROUP BY project_id"""))
def q_lca_project_totals(spark, sf_dir):
    """Per-project impact totals (the flagship query)."""
    return lca_ops.project_impacts(lca_components(spark, sf_dir))


@query("lca_rejected_elements", with_views(LCA_VIEWS, body="""
, per_el AS (SELECT element_id, COUNT(*) AS n, bool_or(volume > 0) AS pos FROM lca_rows GROUP BY element_id)
SELECT e.project_id, e.id AS element_id,
       CASE WHEN p.n IS NULL THEN 'NO_MATERIALS' ELSE 'NO_POSITIVE_VOLUME' END AS reason
FROM fx_elements e LEFT JOIN per_el p ON p.element_id = e.id
WHERE p.pos IS NULL OR NOT p.pos"""))
def q_lca_rejected_elements(spark, sf_dir):
    """Elements dropped by validation, with the reason."""
    from graustein.operators import elements as el
    els = fx.elements(spark, sf_dir)
    rows = el.attach_elements(fx.element_materials(spark, sf_dir), els)
    return el.rejected_elements(els, rows)


@query("element_service_life", with_views(LCA_VIEWS, body="""
SELECT e.id AS element_id, e.ebkp, CAST(COALESCE(NULLIF(l.life_years, 0), 60) AS INTEGER) AS amortization
FROM fx_elements e LEFT JOIN lca_life l ON l.code = trim(e.ebkp)"""))
def q_element_service_life(spark, sf_dir):
    """A3 + J4/N5: service life per element (MIN over the code's rows, default 60)."""
    life = lca_ops.service_life(fx.life_expectancy(spark))
    els = fx.elements(spark, sf_dir)
    return (els.join(life, F.trim("ebkp") == F.col("life_code"), "left")
            .select(F.col("id").alias("element_id"), "ebkp",
                    F.coalesce(F.when(F.col("life_years") != 0, F.col("life_years")),
                               F.lit(lca_ops.DEFAULT_LIFE_YEARS)).cast("int").alias("amortization")))


# ---------------------------------------------------------------- catalogue

@query("active_catalogue", with_views(body="""
SELECT m.uuid, m.name, m.version FROM fx_kbob m
JOIN (SELECT version FROM fx_versions WHERE is_active ORDER BY release_date DESC, version DESC LIMIT 1) a
  ON m.version = a.version"""))
def q_active_catalogue(spark, sf_dir):
    """T1 + J3: catalogue rows of the active version."""
    from graustein.operators import catalogue as cat
    return cat.active_materials(fx.kbob_materials(spark, sf_dir), fx.kbob_versions(spark)).select("uuid", "name", "version")


@query("catalogue_versions", with_views(body="""
SELECT m.version, COUNT(*) AS n_materials, v.version IS NOT NULL AS in_versions_table,
       m.version = (SELECT MAX(version) FROM fx_kbob) AS is_latest
FROM fx_kbob m LEFT JOIN fx_versions v ON v.version = m.version
GROUP BY m.version, v.version"""))
def q_catalogue_versions(spark, sf_dir):
    """A4 + J14 + U3: versions used by the catalogue, whether registered, which is latest."""
    from graustein.operators import catalogue as cat
    mats, vers = fx.kbob_materials(spark, sf_dir), fx.kbob_versions(spark)
    latest = cat.latest_version(mats)
    missing = cat.missing_versions(mats, vers).select("version", F.lit(True).alias("_missing"))
    return (mats.groupBy("version").agg(F.count(F.lit(1)).alias("n_materials"))
            .join(missing, "version", "left")
            .join(F.broadcast(latest), F.col("version") == F.col("latest_version"), "left")  # one row
            .select("version", "n_materials", F.col("_missing").isNull().alias("in_versions_table"),
                    F.col("latest_version").isNotNull().alias("is_latest")))


@query("mapping_resolution", with_views(body="""
SELECT mp.ifc_material, mp.kbob_id, k.uuid IS NOT NULL AS found_in_active, k.name AS kbob_material_name
FROM fx_mappings mp LEFT JOIN (SELECT uuid, name FROM fx_kbob WHERE version = '2024-v1') k ON k.uuid = mp.kbob_id"""))
def q_mapping_resolution(spark, sf_dir):
    """P18/J2 in bulk: every mapped catalogue id resolved against the active version."""
    from graustein.operators import catalogue as cat
    version = cat.active_version(fx.kbob_versions(spark))
    kb = cat.materials_of_version(fx.kbob_materials(spark, sf_dir), version).select(
        F.col("uuid").alias("kbob_id"), F.col("name").alias("kbob_material_name"), F.lit(True).alias("_f"))
    return (lca_ops.usable_mappings(fx.mappings(spark, sf_dir)).join(kb, "kbob_id", "left")
            .select("ifc_material", "kbob_id", F.coalesce("_f", F.lit(False)).alias("found_in_active"),
                    "kbob_material_name"))


# ---------------------------------------------------------------- projects

_LATEST = """
latest AS (SELECT project_id, id, processing_time, kbob_version, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY created_at DESC, id DESC) AS rn FROM fx_history) WHERE rn = 1)"""


@query("latest_run_per_project", with_views(_LATEST, body="SELECT * FROM latest"))
def q_latest_run_per_project(spark, sf_dir):
    """The latest processing-history row of every project."""
    from graustein.operators import projects as pr
    return pr.latest_per_project(fx.history(spark, sf_dir))


@query("project_info", with_views(LCA_VIEWS, _LATEST, body="""
, el AS (SELECT project_id, COUNT(DISTINCT id) AS total_elements FROM fx_elements GROUP BY project_id),
er AS (SELECT project_id, COUNT(*) AS total_errors FROM lca_components WHERE failed GROUP BY project_id)
SELECT p.project_id, p.name, p.life_expectancy, p.kbob_version, p.status,
       COALESCE(el.total_elements, 0) AS total_elements, COALESCE(er.total_errors, 0) AS total_errors,
       l.id AS latest_id, l.processing_time AS latest_processing_time, l.kbob_version AS latest_kbob_version,
       l.created_at AS latest_created_at
FROM fx_projects p LEFT JOIN el USING (project_id) LEFT JOIN er USING (project_id) LEFT JOIN latest l USING (project_id)
"""))
def q_project_info(spark, sf_dir):
    """Project, element count, error count and latest run for every project."""
    from graustein.operators import projects as pr
    errors = lca_ops.lca_errors(lca_components(spark, sf_dir))
    return pr.project_info(fx.projects(spark, sf_dir), fx.elements(spark, sf_dir), errors, fx.history(spark, sf_dir))


@query("project_material_volumes", with_views(body="""
SELECT e.project_id, m.material_name AS name, COALESCE(CAST(SUM(m.volume) AS DOUBLE), 0.0) AS volume
FROM fx_element_materials m JOIN fx_elements e ON m.element_id = e.id
GROUP BY e.project_id, m.material_name"""))
def q_project_material_volumes(spark, sf_dir):
    """Total volume per project and material."""
    from graustein.operators import projects as pr
    return pr.ordered_material_volumes(pr.material_volumes(fx.element_materials(spark, sf_dir), fx.elements(spark, sf_dir)))


@query("project_mappings_in_use", with_views(body="""
SELECT DISTINCT e.project_id, mp.ifc_material, mp.kbob_id
FROM fx_element_materials m JOIN fx_elements e ON m.element_id = e.id
JOIN fx_mappings mp ON mp.ifc_material = m.material_name
WHERE mp.kbob_id IS NOT NULL AND mp.kbob_id <> '' AND mp.ifc_material <> ''"""))
def q_project_mappings_in_use(spark, sf_dir):
    """Mappings of the materials that occur in each project."""
    from graustein.operators import projects as pr
    return pr.project_mappings_in_use(fx.mappings(spark, sf_dir), fx.element_materials(spark, sf_dir),
                                      fx.elements(spark, sf_dir))


# ---------------------------------------------------------------- combined results and summary

_COMBINED = """
combined AS (
  SELECT project_id, element_id AS guid, material_name AS material, ebkp_h, gwp_absolute, penr_absolute,
         ubp_absolute, CAST(NULL AS DOUBLE) AS total_cost, failed, error_message AS error FROM lca_components
  UNION ALL
  SELECT project_id, guid, 'Cost Calculation', ebkp_h, NULL, NULL, NULL, total_cost, failed, error FROM cost_components),
summary AS (
  SELECT project_id,
         CAST(COALESCE(SUM(CAST(total_cost AS DECIMAL(38,2))), 0) AS DOUBLE) AS total_cost,
         CAST(COALESCE(SUM(CAST(gwp_absolute AS DECIMAL(38,3))), 0) AS DOUBLE) AS total_co2_emission,
         CAST(COALESCE(SUM(CAST(penr_absolute AS DECIMAL(38,3))), 0) AS DOUBLE) AS total_primary_energy,
         CAST(COALESCE(SUM(CAST(ubp_absolute AS DECIMAL(38,0))), 0) AS DOUBLE) AS total_ubp
  FROM combined WHERE NOT failed GROUP BY project_id)"""


def combined(spark, sf_dir):
    from graustein.operators import combine as cb
    return cb.combine_results(lca_components(spark, sf_dir), cost_components(spark, sf_dir))


@query("combined_per_guid", with_views(LCA_VIEWS, COST_VIEWS, body="""
, l AS (SELECT project_id, element_id AS guid, COUNT(*) AS n, COUNT(*) FILTER (WHERE failed) AS f
        FROM lca_components GROUP BY project_id, element_id)
SELECT COALESCE(l.project_id, c.project_id) AS project_id, COALESCE(l.guid, c.guid) AS guid,
       COALESCE(l.n, 0) + CASE WHEN c.guid IS NULL THEN 0 ELSE 1 END AS n_components,
       COALESCE(l.f, 0) + CASE WHEN c.failed THEN 1 ELSE 0 END AS n_failed,
       COALESCE(l.n > 1, false) AS shared_guid
FROM l FULL JOIN cost_components c ON l.project_id = c.project_id AND l.guid = c.guid"""))
def q_combined_per_guid(spark, sf_dir):
    """LCA and cost merged by guid; shared_guid is the OR of the inputs."""
    from graustein.operators import combine as cb
    return cb.combined_per_guid(lca_components(spark, sf_dir), cost_components(spark, sf_dir)) \
        .withColumn("n_components", F.col("n_components").cast("long")).withColumn("n_failed", F.col("n_failed").cast("long"))


@query("combined_rows", with_views(LCA_VIEWS, COST_VIEWS, body="""
, shared AS (SELECT project_id, element_id AS guid, COUNT(*) > 1 AS shared_guid FROM lca_components GROUP BY 1, 2)
SELECT l.project_id, l.element_id AS guid, l.material_name AS material, l.ebkp_h, l.failed, l.error_message AS error, 'lca' AS source, s.shared_guid
FROM lca_components l JOIN shared s ON s.project_id = l.project_id AND s.guid = l.element_id
UNION ALL
SELECT c.project_id, c.guid, 'Cost Calculation', c.ebkp_h, c.failed, c.error, 'cost', COALESCE(s.shared_guid, false)
FROM cost_components c LEFT JOIN shared s ON s.project_id = c.project_id AND s.guid = c.guid"""))
def q_combined_rows(spark, sf_dir):
    """Every LCA and cost component with the shared_guid flag of its guid."""
    from graustein.operators import combine as cb
    return cb.combined_rows(lca_components(spark, sf_dir), cost_components(spark, sf_dir)).select(
        "project_id", "guid", "material", "ebkp_h", "failed", "error", "source", "shared_guid")


@query("lca_nested", with_views(LCA_VIEWS, body="""
SELECT project_id, element_id AS guid, COUNT(*) > 1 AS shared_guid, COUNT(*) AS n_components, COUNT(*) FILTER (WHERE failed) AS n_failed,
       string_agg(material_name || '=' || COALESCE(kbob_uuid, error_message), ';' ORDER BY material_name) AS materials,
       SUM(CAST(gwp_absolute AS DECIMAL(38,3)))::DOUBLE AS gwp_absolute
FROM lca_components GROUP BY project_id, element_id"""))
def q_lca_nested(spark, sf_dir):
    """The LCA results as JSON, one record with its components per element, read back."""
    import uuid
    from graustein.operators import combine as cb
    from graustein.session import scratch_path
    from graustein.sinks import writers
    path = scratch_path(spark, "nested", uuid.uuid4().hex)
    records = cb.lca_nested(lca_components(spark, sf_dir))
    writers.write_json(records, path, compression="gzip")
    c = F.col("components")
    return spark.read.schema(records.schema).json(path).select(
        "project_id", "guid", "shared_guid", "n_components", F.size(F.filter(c, lambda x: x["failed"])).cast("long").alias("n_failed"),
        F.array_join(F.transform(c, lambda x: F.concat(x["material"], F.lit("="), F.coalesce(x["mat_kbob"], x["error"]))), ";").alias("materials"),
        F.aggregate(c, F.lit(None).cast("decimal(38,3)"), lambda s, x: F.coalesce((F.coalesce(s, F.lit(0)) + x["gwp_absolute"].cast("decimal(38,3)")).cast("decimal(38,3)"), s))
        .cast("double").alias("gwp_absolute"))


@query("combined_nested", with_views(LCA_VIEWS, COST_VIEWS, _COMBINED, body="""
, per_guid AS (
  SELECT project_id, guid, COUNT(*) AS n_components, COUNT(*) FILTER (WHERE material <> 'Cost Calculation') > 1 AS shared_guid,
         string_agg(material || '=' || CASE WHEN failed THEN error ELSE 'ok' END, ';' ORDER BY material) AS materials,
         COALESCE(SUM(CAST(total_cost AS DECIMAL(38,2))), 0)::DOUBLE AS total_cost
  FROM combined GROUP BY project_id, guid)
SELECT *, CAST((n_components + 2) // 3 AS BIGINT) AS n_chunks, true AS chunks_numbered FROM per_guid"""))
def q_combined_nested(spark, sf_dir):
    """LCA and cost components of every guid in numbered chunks of about three, written as JSON,
    read back and put together again."""
    import uuid
    from graustein.operators import combine as cb
    from graustein.session import passing_copy, scratch_path
    from graustein.sinks import writers
    path = scratch_path(spark, "nested", uuid.uuid4().hex)
    inputs = lca_inputs(spark, sf_dir)
    # the material rows are read twice: for the valid elements, and whole; the reference rows' sizes are known when they are written
    with (passing_copy(inputs.mappings, "mappings") as inputs.mappings,
          passing_copy(lca_ops.named_by(inputs.catalogue, inputs.mappings), "catalogue") as inputs.catalogue,
          passing_copy(inputs.materials, "materials", compression="zstd") as inputs.materials):
        records = cb.combined_nested(jobs.lca(inputs)[0], cost_components(spark, sf_dir), chunk=3)
    writers.write_json(records, path, compression="gzip")
    back = spark.read.schema(records.schema).json(path)
    # per record first, so that only what is put together is shuffled; the sums are exact
    cost = F.aggregate("components", F.lit(0).cast("decimal(38,2)"), lambda s, x: (s + F.coalesce(x["total_cost"].cast("decimal(38,2)"), F.lit(0))).cast("decimal(38,2)"))
    whole = back.groupBy("project_id", "guid", "shared_guid", "n_components", "n_chunks").agg(
        F.array_sort(F.flatten(F.collect_list(F.transform("components", lambda x: F.struct(
            x["material"].alias("m"), F.when(x["failed"], x["error"]).otherwise("ok").alias("o")))))).alias("c"),
        F.sum(cost).cast("decimal(38,2)").cast("double").alias("total_cost"),
        F.size(F.collect_set("chunk")).alias("n"), F.count(F.lit(1)).alias("rows"), F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    numbered = (F.col("n") == F.col("rows")) & (F.col("low") >= 0) & (F.col("high") < F.col("n_chunks")) & (F.size("c") == F.col("n_components"))
    return whole.select("project_id", "guid", "shared_guid", "n_components", "n_chunks", numbered.alias("chunks_numbered"),
                        F.array_join(F.transform("c", lambda x: F.concat(x["m"], F.lit("="), x["o"])), ";").alias("materials"), "total_cost")


def _as_documents(rows: int | None):
    """An Arrow stage: JSON texts of elements, each behind a comma, as the lines of documents, a document per
    ``rows`` elements or (None) per task. The texts are passed on as they are."""
    def lines(batches):
        import pyarrow as pa
        n = 0
        first = '{"metadata":{"units":{"length":"{m}"}},"elements":[{}'
        out = lambda texts: pa.RecordBatch.from_arrays([texts], names=["value"])
        yield out(pa.array([first]))
        for batch in batches:
            texts, at = batch.column(0), 0
            while at < len(texts):
                if n == rows:
                    yield out(pa.array(["]}", first]))
                    n = 0
                held = texts.slice(at, None if rows is None else rows - n)
                yield out(held)
                at, n = at + len(held), n + len(held)
        yield out(pa.array(["]}"]))
    return lines


def json_documents(spark: SparkSession, sf_dir: str, rows: int | None = None) -> str:
    """Element documents of the fixture as JSON files, each one object with a list of elements (an
    element per line, a text row each). Every task writes its own files, one or (``rows``) one per so many
    elements: nothing is sorted or shuffled for them, and their number grows with the tables."""
    import uuid
    from graustein.session import arrow_stage, scratch_path, shuffles_dropped
    path = scratch_path(spark, "documents", uuid.uuid4().hex)
    mats = fx.element_materials(spark, sf_dir).select(
        "element_id", F.struct(F.col("material_name").alias("name"), F.col("volume").cast("double").alias("volume"), F.col("density").cast("double").alias("density")).alias("m"))
    els = fx.elements(spark, sf_dir)
    # a document per layer, as in lca_from_documents: no element is gathered
    layer = F.struct(F.col("id"), F.struct(F.col("ebkp")).alias("properties"), F.struct(F.struct(F.col("area_net").cast("double").alias("net")).alias("area")).alias("quantities"),
                     F.array("m.name").alias("materials"), F.create_map(F.col("m.name"), F.struct("m.volume", "m.density")).alias("material_volumes"))
    texts = els.join(mats, els.id == mats.element_id).select(F.concat(F.lit(","), F.to_json(layer)).alias("value"))
    with shuffles_dropped(spark):
        # the writer begins a new file behind a document's last line
        arrow_stage(texts, _as_documents(rows), "value string").write.option("maxRecordsPerFile", rows + 2 if rows else 0).text(path)
    return path


@query("elements_from_json", with_views(body="""
SELECT DISTINCT e.id, 'Unknown' AS ifc_class, e.ebkp, CAST(e.area_net AS DOUBLE) AS area_net
FROM fx_elements e JOIN fx_element_materials m ON m.element_id = e.id"""))
def q_elements_from_json(spark, sf_dir):
    """S7 + P1-P3: JSON documents framed over byte ranges and flattened to element rows."""
    from graustein.operators import elements as el
    from graustein.sources import json_arrays
    # element rows have no materials
    documents = json_arrays.read_elements(spark, json_documents(spark, sf_dir), without=("materials", "material_volumes"))
    rows = el.flatten_elements(documents)
    return rows.select("id", "ifc_class", "ebkp", "area_net").distinct()


@query("materials_from_json", with_views(body="""
SELECT m.element_id, m.material_name, CAST(m.volume AS DOUBLE) AS volume, CAST(m.density AS DOUBLE) AS density
FROM fx_element_materials m JOIN fx_elements e ON m.element_id = e.id"""))
def q_materials_from_json(spark, sf_dir):
    """S7 + P4: JSON documents read whole by the JSON reader, material rows of the volume maps."""
    from graustein.operators import elements as el
    from graustein.sources.readers import read_element_documents
    docs = read_element_documents(spark, json_documents(spark, sf_dir, rows=100_000))
    return el.explode_materials(el.explode_documents(docs)).select("element_id", "material_name", "volume", "density")


@query("portfolio_summary", with_views(LCA_VIEWS, COST_VIEWS, _COMBINED, body="""
SELECT *, translate(format('{:,.2f}', total_cost), ',.', '`,') AS total_cost_text,
       translate(format('{:,.2f}', total_co2_emission), ',.', '`,') AS total_co2_emission_text,
       translate(format('{:,.2f}', total_primary_energy), ',.', '`,') AS total_primary_energy_text,
       translate(format('{:,.2f}', total_ubp), ',.', '`,') AS total_ubp_text
FROM summary"""))
def q_portfolio_summary(spark, sf_dir):
    """A5 + H9: per-project totals of cost, CO2, primary energy and UBP, with Swiss formatting."""
    from graustein.operators import combine as cb
    return cb.formatted_summary(cb.summarize(combined(spark, sf_dir), by=["project_id"]))


@query("failed_components", with_views(LCA_VIEWS, COST_VIEWS, _COMBINED, body="""
SELECT project_id, guid, material, ebkp_h, error FROM combined WHERE failed"""))
def q_failed_components(spark, sf_dir):
    """All failed components of the combined run."""
    from graustein.operators import combine as cb
    return cb.failed_components(combined(spark, sf_dir))


@query("summary_report", with_views(LCA_VIEWS, COST_VIEWS, _COMBINED, body="""
, total AS (
  SELECT CAST(COALESCE(SUM(CAST(total_cost AS DECIMAL(38,2))), 0) AS DOUBLE) AS c,
         CAST(COALESCE(SUM(CAST(gwp_absolute AS DECIMAL(38,3))), 0) AS DOUBLE) AS g,
         CAST(COALESCE(SUM(CAST(penr_absolute AS DECIMAL(38,3))), 0) AS DOUBLE) AS p,
         CAST(COALESCE(SUM(CAST(ubp_absolute AS DECIMAL(38,0))), 0) AS DOUBLE) AS u
  FROM combined WHERE NOT failed)
SELECT 0 AS section, '' AS sort_key, chr(10) || 'Summary Report:' AS line
UNION ALL SELECT 1, '', 'Total Cost: ' || translate(format('{:,.2f}', c), ',.', '`,') || ' Chf' FROM total
UNION ALL SELECT 2, '', 'Total CO₂ Emissions: ' || translate(format('{:,.2f}', g), ',.', '`,') || ' kg CO₂-eq' FROM total
UNION ALL SELECT 3, '', 'Total Primary Energy (non-renewable): ' || translate(format('{:,.2f}', p), ',.', '`,') || ' kWh oil-eq' FROM total
UNION ALL SELECT 4, '', 'Total UBP: ' || translate(format('{:,.2f}', u), ',.', '`,') FROM total
UNION ALL SELECT 5, '', chr(10) || 'Failed Components:' WHERE EXISTS (SELECT 1 FROM combined WHERE failed)
UNION ALL SELECT 6, COALESCE(guid, '') || chr(0) || COALESCE(material, ''),
       '- GUID: ' || COALESCE(guid, 'N/A') || ', eBKP-H: ' || COALESCE(ebkp_h, 'N/A') || ', Error: ' || COALESCE(error, 'N/A')
FROM combined WHERE failed"""))
def q_summary_report(spark, sf_dir):
    """K6: the summary report lines over the whole portfolio."""
    from graustein.operators import combine as cb
    from graustein.session import written_copy
    c = written_copy(combined(spark, sf_dir), "combined")
    return cb.report_lines(cb.summarize(c, count_failed=True), cb.failed_components(c))


# ---------------------------------------------------------------- classification

_CATALOGUE = r"""
cat_parsed AS (
  SELECT line_no, regexp_extract(trim(value), '^([A-Z])\s+([0-9]+(?:\.[0-9]+)?)\s+(.*)$', 1) AS letter,
         regexp_extract(trim(value), '^([A-Z])\s+([0-9]+(?:\.[0-9]+)?)\s+(.*)$', 2) AS number,
         regexp_extract(trim(value), '^([A-Z])\s+([0-9]+(?:\.[0-9]+)?)\s+(.*)$', 3) AS description
  FROM fx_catalogue_lines WHERE regexp_matches(trim(value), '^([A-Z])\s+([0-9]+(?:\.[0-9]+)?)\s+(.*)$')),
cat_coded AS (
  SELECT line_no, description,
         letter || CASE WHEN ltrim(split_part(number, '.', 1), '0') = '' THEN '0' ELSE ltrim(split_part(number, '.', 1), '0') END
         || CASE WHEN split_part(number, '.', 2) = '' THEN ''
                 ELSE '.' || CASE WHEN ltrim(split_part(number, '.', 2), '0') = '' THEN '0' ELSE ltrim(split_part(number, '.', 2), '0') END END AS code
  FROM cat_parsed),
catalogue AS (SELECT code, arg_max(description, line_no) AS description FROM cat_coded GROUP BY code)"""

# H1/H2 in SQL: blanks removed, then letter + numbers without leading zeros.
_NORM = r"""
norm_input AS (SELECT DISTINCT raw FROM norm_source),
norm_parts AS (
  SELECT raw, replace(raw, ' ', '') AS s,
         regexp_extract(replace(raw, ' ', ''), '^([A-Z])([0-9]+)(?:\.([0-9]+))?(?:\.([0-9]+))?', 1) AS l,
         regexp_extract(replace(raw, ' ', ''), '^([A-Z])([0-9]+)(?:\.([0-9]+))?(?:\.([0-9]+))?', 2) AS a,
         regexp_extract(replace(raw, ' ', ''), '^([A-Z])([0-9]+)(?:\.([0-9]+))?(?:\.([0-9]+))?', 3) AS b,
         regexp_extract(replace(raw, ' ', ''), '^([A-Z])([0-9]+)(?:\.([0-9]+))?(?:\.([0-9]+))?', 4) AS c
  FROM norm_input),
norm_z AS (
  SELECT raw, s, l,
         CASE WHEN a = '' THEN '' WHEN ltrim(a, '0') = '' THEN '0' ELSE ltrim(a, '0') END AS a,
         CASE WHEN b = '' THEN '' WHEN ltrim(b, '0') = '' THEN '0' ELSE ltrim(b, '0') END AS b,
         CASE WHEN c = '' THEN '' WHEN ltrim(c, '0') = '' THEN '0' ELSE ltrim(c, '0') END AS c
  FROM norm_parts),
norm AS (
  SELECT raw,
         CASE WHEN regexp_matches(s, '^[A-Z][0-9]+') THEN l || a || CASE WHEN b <> '' THEN '.' || b ELSE '' END
              || CASE WHEN b <> '' AND c <> '' THEN '.' || c ELSE '' END ELSE s END AS code3,
         CASE WHEN regexp_matches(s, '^[A-Z][0-9]+') THEN l || a || CASE WHEN b <> '' THEN '.' || b ELSE '' END
              ELSE s END AS code2
  FROM norm_z)"""


def _catalogue(spark, sf_dir, levels=3):
    from graustein.operators import classification as cl
    return cl.parse_catalogue(fx.catalogue_lines(spark, sf_dir), levels=levels)


@query("catalogue_codes", with_views(_CATALOGUE, body="SELECT code, description FROM catalogue"))
def q_catalogue_codes(spark, sf_dir):
    """S12 + H1 + N8: catalogue text lines parsed into (code, description), later line wins."""
    return _catalogue(spark, sf_dir)


@query("ebkp_code_forms", with_views(_CATALOGUE, "norm_source AS (SELECT ebkp AS raw FROM fx_elements)", _NORM, body="""
SELECT n.raw, n.code3 AS normalized, n.code2 AS normalized_2,
       CASE WHEN instr(n.code3, '.') > 0 THEN regexp_replace(n.code3, '\\.[^.]*$', '') END AS parent,
       NULLIF(regexp_extract(n.code3, '^([A-Z][0-9]+)', 1), '') AS main,
       c.code IS NOT NULL AS in_catalogue
FROM norm n LEFT JOIN catalogue c ON c.code = n.code3"""))
def q_ebkp_code_forms(spark, sf_dir):
    """Each distinct raw code with its 3- and 2-level forms, parent, main,
    and whether the catalogue has it."""
    from graustein.functions.ebkp import main_code, normalize_code, parent_code
    from graustein.operators import classification as cl
    vals = fx.elements(spark, sf_dir).select(F.lit("x").alias("element_id"), F.col("ebkp").alias("ebkp_value"))
    diag = cl.code_diagnostics(vals, _catalogue(spark, sf_dir))
    return diag.select("raw", "normalized", normalize_code("raw", 2).alias("normalized_2"),
                       parent_code("normalized").alias("parent"), main_code("normalized").alias("main"), "in_catalogue")


_MAPPER = """
m_first AS (
  SELECT element_id, COALESCE(arg_min(COALESCE(prop_value, ''), (pset_pos, prop_pos)), '') AS v
  FROM fx_properties WHERE lower(prop_name) = 'ebkp' GROUP BY element_id),
norm_source AS (SELECT v AS raw FROM m_first WHERE trim(v) <> '')"""

_CLASSIFIER = """
c_sets AS (
  SELECT element_id, pset_pos, arg_min(prop_value, prop_pos) AS v
  FROM fx_properties WHERE lower(prop_name) = 'ebkp' GROUP BY element_id, pset_pos),
c_first AS (SELECT element_id, arg_min(v, pset_pos) AS v FROM c_sets WHERE v IS NOT NULL GROUP BY element_id),
norm_source AS (SELECT v AS raw FROM c_first WHERE trim(v) <> '')"""

_MAPPER_RESULT = """
, mapped AS (
  SELECT f.element_id, f.v AS identification, n.code3 AS code,
         CASE WHEN instr(n.code3, '.') > 0 THEN regexp_replace(n.code3, '\\.[^.]*$', '') END AS parent,
         NULLIF(regexp_extract(split_part(n.code3, '.', 1), '^([A-Z][0-9]+)', 1), '') AS main
  FROM m_first f JOIN norm n ON n.raw = f.v WHERE trim(f.v) <> '')
, classified AS (
  SELECT m.element_id, m.identification, m.code,
         COALESCE(ce.description, cp.description, cm.description, m.identification) AS description,
         CASE WHEN ce.code IS NOT NULL THEN 'exact' WHEN cp.code IS NOT NULL THEN 'parent'
              WHEN cm.code IS NOT NULL THEN 'main' ELSE 'none' END AS match_level
  FROM mapped m LEFT JOIN catalogue ce ON ce.code = m.code LEFT JOIN catalogue cp ON cp.code = m.parent
  LEFT JOIN catalogue cm ON cm.code = m.main)"""


def _mapper(spark, sf_dir):
    from graustein.operators import classification as cl
    vals = cl.first_ebkp_property(fx.properties(spark, sf_dir), stop_on_empty=True)
    return cl.classify_hierarchical(vals, _catalogue(spark, sf_dir))


def _classifier(spark, sf_dir):
    from graustein.operators import classification as cl
    vals = cl.first_ebkp_property(fx.properties(spark, sf_dir), stop_on_empty=False)
    return cl.classify_exact(vals, _catalogue(spark, sf_dir, levels=2))


@query("classification_mapper", with_views(_CATALOGUE, _MAPPER, _NORM, body=_MAPPER_RESULT + """
SELECT * FROM classified"""))
def q_classification_mapper(spark, sf_dir):
    """C7 (mapper): first ebkp property, 3-level code, exact -> parent -> main -> own text."""
    return _mapper(spark, sf_dir)


_CLASSIFIER_RESULT = """
, classified AS (
  SELECT f.element_id, n.code2 AS identification, COALESCE(c.description, f.v) AS description,
         CASE WHEN c.code IS NOT NULL THEN 'exact' ELSE 'none' END AS match_level
  FROM c_first f JOIN norm n ON n.raw = f.v LEFT JOIN catalogue c ON c.code = n.code2
  WHERE trim(f.v) <> '')"""


@query("classification_classifier", with_views(_CATALOGUE, _CLASSIFIER, _NORM, body=_CLASSIFIER_RESULT + """
SELECT * FROM classified"""))
def q_classification_classifier(spark, sf_dir):
    """C7 (classifier): first valued ebkp property per set, 2-level code, exact lookup."""
    return _classifier(spark, sf_dir)


@query("classification_coverage", with_views(_CATALOGUE, _MAPPER, _NORM, body=_MAPPER_RESULT + """
SELECT (SELECT COUNT(*) FROM fx_elements) AS elements_processed, COUNT(*) AS elements_with_ebkp,
       COUNT(*) FILTER (WHERE match_level = 'exact') AS elements_with_match FROM classified"""))
def q_classification_coverage(spark, sf_dir):
    """Processed elements, elements with a code, exact matches (mapper flavour)."""
    from graustein.operators import classification as cl
    return cl.coverage(fx.elements(spark, sf_dir).select(F.col("id").alias("element_id")), _mapper(spark, sf_dir))


_REFS = """
refs AS (
  SELECT *, CASE WHEN schema_version LIKE '%2X3%' THEN item_reference ELSE identification END AS code,
         COALESCE(name, '') = '' AS name_missing,
         COALESCE(CASE WHEN schema_version LIKE '%2X3%' THEN item_reference ELSE identification END, '') = '' AS id_missing
  FROM fx_classification_refs)"""


@query("incomplete_references", with_views(_REFS, body="""
SELECT element_id, schema_version, system, name, item_reference, identification, name_missing, id_missing
FROM refs WHERE name_missing OR id_missing"""))
def q_incomplete_references(spark, sf_dir):
    """Classification references lacking a name or a code."""
    from graustein.operators import classification as cl
    return cl.incomplete_references(fx.classification_refs(spark, sf_dir))


@query("classification_completeness", with_views(_REFS, body="""
, per_el AS (SELECT element_id, bool_or(name_missing OR id_missing) AS incomplete FROM refs GROUP BY element_id)
SELECT (SELECT COUNT(*) FROM fx_elements) AS total_elements, COUNT(*) AS with_classification,
       COUNT(*) FILTER (WHERE incomplete) AS with_incomplete,
       CASE WHEN COUNT(*) > 0 THEN CAST(ROUND(CAST(COUNT(*) FILTER (WHERE incomplete) AS DECIMAL(38,10)) * 100
            / COUNT(*), 2) AS DOUBLE) END AS pct_incomplete
FROM per_el"""))
def q_classification_completeness(spark, sf_dir):
    """Elements with classifications and with incomplete ones, and the percentage."""
    from graustein.operators import classification as cl
    return cl.completeness(fx.elements(spark, sf_dir).select(F.col("id").alias("element_id")),
                           fx.classification_refs(spark, sf_dir))


@query("random_codes", with_views(_CATALOGUE, body="""
, numbered AS (SELECT code, description, row_number() OVER (ORDER BY code) - 1 AS idx FROM catalogue WHERE code LIKE 'C%'),
k AS (SELECT COUNT(*) AS k FROM numbered)
SELECT e.id AS element_id, n.code AS identification, n.description AS name
FROM fx_elements e, k
JOIN numbered n ON n.idx = ('0x' || substr(md5(e.id || '|' || '7'), 1, 8))::BIGINT % k.k"""))
def q_random_codes(spark, sf_dir):
    """A repeatable pseudo-random C-code from the catalogue for every element."""
    from graustein.operators import classification as cl
    return cl.assign_codes(fx.elements(spark, sf_dir).select(F.col("id").alias("element_id")),
                           _catalogue(spark, sf_dir), seed=7, letter="C")


# ---------------------------------------------------------------- data quality

@query("constraint_report", with_views(body="""
SELECT 'elements' AS "table", 'primary_key' AS "check", (SELECT COUNT(*) FROM (SELECT id FROM fx_elements GROUP BY id HAVING COUNT(*) > 1)) AS n_violations
UNION ALL SELECT 'elements', 'not_null:id', COUNT(*) FILTER (WHERE id IS NULL) FROM fx_elements
UNION ALL SELECT 'elements', 'not_null:project_id', COUNT(*) FILTER (WHERE project_id IS NULL) FROM fx_elements
UNION ALL SELECT 'element_materials', 'primary_key', (SELECT COUNT(*) FROM (SELECT element_id, material_name FROM fx_element_materials GROUP BY ALL HAVING COUNT(*) > 1))
UNION ALL SELECT 'element_materials', 'not_null:element_id', COUNT(*) FILTER (WHERE element_id IS NULL) FROM fx_element_materials
UNION ALL SELECT 'element_materials', 'not_null:material_name', COUNT(*) FILTER (WHERE material_name IS NULL) FROM fx_element_materials
UNION ALL SELECT 'mappings', 'primary_key', (SELECT COUNT(*) FROM (SELECT ifc_material FROM fx_mappings GROUP BY ALL HAVING COUNT(*) > 1))
UNION ALL SELECT 'kbob_materials', 'primary_key', (SELECT COUNT(*) FROM (SELECT uuid, version FROM fx_kbob GROUP BY ALL HAVING COUNT(*) > 1))
UNION ALL SELECT 'kbob_materials', 'not_null:uuid', COUNT(*) FILTER (WHERE uuid IS NULL) FROM fx_kbob
UNION ALL SELECT 'kbob_materials', 'not_null:version', COUNT(*) FILTER (WHERE version IS NULL) FROM fx_kbob
UNION ALL SELECT 'life_expectancy', 'primary_key', (SELECT COUNT(*) FROM (SELECT ebkp_code, description FROM fx_life GROUP BY ALL HAVING COUNT(*) > 1))
UNION ALL SELECT 'cost_reference', 'primary_key', (SELECT COUNT(*) FROM (SELECT ebkp_code, version FROM fx_cost GROUP BY ALL HAVING COUNT(*) > 1))
UNION ALL SELECT 'element_materials', 'foreign_key:element_id->elements.id',
       COUNT(*) FILTER (WHERE element_id NOT IN (SELECT id FROM fx_elements)) FROM fx_element_materials
UNION ALL SELECT 'mappings', 'foreign_key:kbob_id->kbob_materials.uuid',
       COUNT(*) FILTER (WHERE kbob_id NOT IN (SELECT uuid FROM fx_kbob)) FROM fx_mappings"""))
def q_constraint_report(spark, sf_dir):
    """Primary-key, NOT NULL and foreign-key violations of the domain tables."""
    from graustein.operators import quality as qa
    tables = {"elements": fx.elements(spark, sf_dir), "element_materials": fx.element_materials(spark, sf_dir),
              "mappings": fx.mappings(spark, sf_dir), "kbob_materials": fx.kbob_materials(spark, sf_dir),
              "life_expectancy": fx.life_expectancy(spark), "cost_reference": fx.cost_reference(spark)}
    keys = {"elements": ["id"], "element_materials": ["element_id", "material_name"], "mappings": ["ifc_material"],
            "kbob_materials": ["uuid", "version"], "life_expectancy": ["ebkp_code", "description"],
            "cost_reference": ["ebkp_code", "version"]}
    not_null = {"elements": ["id", "project_id"], "element_materials": ["element_id", "material_name"],
                "kbob_materials": ["uuid", "version"]}
    fks = [("element_materials", "element_id", "elements", "id"), ("mappings", "kbob_id", "kbob_materials", "uuid")]
    return qa.constraint_report(tables, keys, not_null, fks)


_DIRTY = """
d_elements AS (
  SELECT id, project_id, ebkp, length FROM fx_elements
  UNION ALL SELECT id, NULL, ebkp, length FROM fx_elements WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
d_materials AS (
  SELECT element_id, material_name, volume FROM fx_element_materials
  UNION ALL SELECT 'X' || element_id, material_name, volume FROM fx_element_materials WHERE volume < 0
  UNION ALL SELECT element_id, material_name, volume FROM fx_element_materials WHERE volume = 0),
d_projects AS (SELECT project_id, CASE WHEN project_id = 'P7' THEN 'weird' ELSE status END AS status FROM fx_projects),
d_found AS (
  SELECT 'elements' AS "table", 'primary_key' AS "check", '{"id":"' || id || '"}' AS key, id AS record FROM d_elements QUALIFY COUNT(*) OVER (PARTITION BY id) > 1
  UNION ALL SELECT 'elements', 'not_null:project_id', '', id FROM d_elements WHERE project_id IS NULL
  UNION ALL SELECT 'elements', 'check:length', '', id FROM d_elements WHERE length <= 0
  UNION ALL SELECT 'materials', 'primary_key', '{"element_id":"' || element_id || '","material_name":"' || material_name || '"}', element_id FROM d_materials
            QUALIFY COUNT(*) OVER (PARTITION BY element_id, material_name) > 1
  UNION ALL SELECT 'materials', 'foreign_key:element_id->elements.id', element_id, element_id FROM d_materials WHERE element_id NOT IN (SELECT id FROM fx_elements)
  UNION ALL SELECT 'projects', 'check:status', '', project_id FROM d_projects WHERE status NOT IN ('active', 'processing', 'completed', 'failed'))"""


def dirty_tables(spark, sf_dir):
    """Tables with duplicated keys, nulls, orphans and values outside their domain, and their constraints."""
    from graustein.schemas import PROJECT_STATUSES
    o = fx.table(spark, sf_dir, "orders")
    urgent = o.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select(F.col("o_orderkey").cast("string").alias("id"))
    els = fx.elements(spark, sf_dir).select("id", "project_id", "ebkp", "length")
    twice = els.join(urgent, "id", "left_semi").withColumn("project_id", F.lit(None).cast("string"))
    mats = fx.element_materials(spark, sf_dir).select("element_id", "material_name", "volume")
    more = F.when(F.col("volume") < 0, F.concat(F.lit("X"), "element_id")).when(F.col("volume") == 0, F.col("element_id"))
    ids = F.when(F.col("volume") <= 0, F.array("element_id", more)).otherwise(F.array("element_id"))  # one pass over the materials
    mats = mats.select(F.explode(ids).alias("element_id"), "material_name", "volume")
    projects = fx.projects(spark, sf_dir).select("project_id", F.when(F.col("project_id") == "P7", "weird").otherwise(F.col("status")).alias("status"))
    tables = {"elements": els.unionByName(twice), "materials": mats, "projects": projects}
    return dict(tables=tables, keys={"elements": ["id"], "materials": ["element_id", "material_name"], "projects": ["project_id"]},
                not_null={"elements": ["id", "project_id"]}, fks=[("materials", "element_id", "elements", "id")],
                checks={"projects": [("status", F.col("status").isin(*PROJECT_STATUSES))], "elements": [("length", F.col("length") > 0)]})


@query("constraint_violations", with_views(_DIRTY, body="""
, declared AS (SELECT * FROM (VALUES ('elements', 'primary_key'), ('materials', 'primary_key'), ('projects', 'primary_key'), ('elements', 'not_null:id'),
  ('elements', 'not_null:project_id'), ('elements', 'check:length'), ('projects', 'check:status'), ('materials', 'foreign_key:element_id->elements.id')) t("table", "check"))
SELECT d."table", d."check", COUNT(DISTINCT CASE WHEN d."check" = 'primary_key' THEN f.key ELSE f.key || f.record || f.rn END) AS n_violations
FROM declared d LEFT JOIN (SELECT *, '#' || row_number() OVER () AS rn FROM d_found) f ON f."table" = d."table" AND f."check" = d."check" GROUP BY ALL"""))
def q_constraint_violations(spark, sf_dir):
    """P19 on tables that violate their constraints: primary keys, NOT NULL, CHECK and foreign keys
    of all tables in one shuffle."""
    from graustein.operators import quality as qa
    return qa.constraint_report(**dirty_tables(spark, sf_dir))


@query("quarantined_rows", with_views(_DIRTY, body='SELECT * FROM d_found'))
def q_quarantined_rows(spark, sf_dir):
    """Every row that violates a constraint, with its reason, written and read back by table."""
    import uuid
    from graustein.operators import quality as qa
    from graustein.session import scratch_path, written_copy
    from graustein.sinks import writers
    dirty = dirty_tables(spark, sf_dir)
    # they are read twice: for the violations and for the rows
    dirty["tables"] = {name: written_copy(df, name) for name, df in dirty["tables"].items()}
    rows = qa.quarantine(**dirty)
    path = scratch_path(spark, "quarantine", uuid.uuid4().hex)
    writers.write_partitioned(rows, path, ("table",), mode="overwrite")
    back = writers.read_back(spark, path, rows)
    first = F.coalesce(F.get_json_object("record", "$.element_id"), F.get_json_object("record", "$.id"), F.get_json_object("record", "$.project_id"))
    return back.select("table", "check", "key", first.alias("record"))


@query("value_checks", with_views(body="""
SELECT id AS element_id,
       CASE WHEN area_net IS NULL THEN 'Missing area for GUID ' || id || ' (eBKP-H: ' || ebkp || ')'
            WHEN area_net <= 0 THEN 'Invalid area (' || CAST(area_net AS VARCHAR) || ') for GUID ' || id || ' (eBKP-H: ' || ebkp || ')' END AS area_problem,
       CASE WHEN length IS NULL THEN 'Missing length for GUID ' || id || ' (eBKP-H: ' || ebkp || ')'
            WHEN length <= 0 THEN 'Invalid length (' || CAST(length AS VARCHAR) || ') for GUID ' || id || ' (eBKP-H: ' || ebkp || ')' END AS length_problem
FROM fx_elements WHERE area_net IS NULL OR area_net <= 0 OR length IS NULL OR length <= 0"""))
def q_value_checks(spark, sf_dir):
    """Missing or non-positive quantities with the reference's messages."""
    from graustein.functions.numbers import value_problem
    e = fx.elements(spark, sf_dir)
    out = e.select(F.col("id").alias("element_id"),
                   value_problem("area_net", "area", "id", "ebkp").alias("area_problem"),
                   value_problem("length", "length", "id", "ebkp").alias("length_problem"))
    return out.filter(F.col("area_problem").isNotNull() | F.col("length_problem").isNotNull())


# ---------------------------------------------------------------- table maintenance

_UPSERT_BATCH = """
batch AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, 'NEW' AS project_id, 'C2.1' AS ebkp,
         CAST(o_totalprice AS DECIMAL(14,2)) * 0.01 AS area_net, CAST(NULL AS DECIMAL(19,5)) AS length, o_orderdate AS ts
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), 'NEW', 'E3', NULL, CAST(o_totalprice AS DECIMAL(14,2)) * 0.001, o_orderdate + INTERVAL 1 DAY
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT 'N' || CAST(o_orderkey AS VARCHAR), 'NEW', 'Z9', NULL, NULL, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'),
latest AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC) = 1)"""


def _upsert_batch(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(14,2)")
    key = F.col("o_orderkey").cast("string")
    done = o.filter(F.col("o_orderstatus") == "F")
    first = done.select(key.alias("id"), F.lit("NEW").alias("project_id"), F.lit("C2.1").alias("ebkp"),
                        (price * F.lit(0.01).cast("decimal(3,2)")).alias("area_net"),
                        F.lit(None).cast("decimal(19,5)").alias("length"), F.col("o_orderdate").alias("timestamp"))
    second = done.select(key.alias("id"), F.lit("NEW").alias("project_id"), F.lit("E3").alias("ebkp"),
                         F.lit(None).cast("decimal(17,4)").alias("area_net"),
                         (price * F.lit(0.001).cast("decimal(4,3)")).alias("length"),
                         (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("timestamp"))
    new = o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("N"), key).alias("id"), F.lit("NEW").alias("project_id"), F.lit("Z9").alias("ebkp"),
        F.lit(None).cast("decimal(17,4)").alias("area_net"), F.lit(None).cast("decimal(19,5)").alias("length"),
        F.col("o_orderdate").alias("timestamp"))
    return first.unionByName(second).unionByName(new)


@query("upsert_elements", with_views(_UPSERT_BATCH, body="""
SELECT id, project_id, ebkp, CAST(area_net AS DOUBLE) AS area_net, CAST(length AS DOUBLE) AS length FROM (
  SELECT e.id, e.project_id, e.ebkp, e.area_net, e.length FROM fx_elements e WHERE e.id NOT IN (SELECT id FROM latest)
  UNION ALL
  SELECT l.id, COALESCE(e.project_id, l.project_id), l.ebkp, l.area_net, l.length
  FROM latest l LEFT JOIN fx_elements e ON e.id = l.id)"""))
def q_upsert_elements(spark, sf_dir):
    """M1: upsert a batch of elements: last row per id wins, existing elements keep their project."""
    from graustein.operators import maintenance as mt
    out = mt.upsert_elements(fx.elements(spark, sf_dir), _upsert_batch(spark, sf_dir))
    return out.select("id", "project_id", "ebkp", F.col("area_net").cast("double"), F.col("length").cast("double"))


@query("delete_project", with_views(LCA_VIEWS, body="""
, gone AS (SELECT id FROM fx_elements WHERE project_id = 'P3')
SELECT 'elements' AS table_name, COUNT(*) AS n_rows FROM fx_elements WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'element_materials', COUNT(*) FROM fx_element_materials WHERE element_id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'results', COUNT(*) FROM lca_components WHERE element_id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'errors', COUNT(*) FROM lca_components WHERE failed"""))
def q_delete_project(spark, sf_dir):
    """M5: delete a project's elements with their materials and results; errors stay."""
    from graustein.operators import maintenance as mt
    from graustein.session import written_copy
    comps = written_copy(lca_components(spark, sf_dir), "lca_components")
    e, m, r = mt.delete_project_elements(fx.elements(spark, sf_dir), fx.element_materials(spark, sf_dir), comps, "P3")
    errors = lca_ops.lca_errors(comps)
    def n(df, name):
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
    return n(e, "elements").unionByName(n(m, "element_materials")).unionByName(n(r, "results")).unionByName(n(errors, "errors"))


@query("bucketed_upsert", with_views("""
batch AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, 'NEW' AS project_id, 'E3' AS ebkp, o_totalprice FROM orders
  WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)
  UNION ALL SELECT 'N' || CAST(o_orderkey AS VARCHAR), 'NEW', 'E3', o_totalprice FROM orders
  WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders))""", body="""
SELECT id, project_id, ebkp, true AS untouched_buckets_kept FROM fx_elements WHERE id NOT IN (SELECT id FROM batch)
UNION ALL
SELECT b.id, COALESCE(e.project_id, b.project_id), b.ebkp, true FROM batch b LEFT JOIN fx_elements e ON e.id = b.id"""))
def q_bucketed_upsert(spark, sf_dir):
    """M1 on a stored table: the last day's elements delivered again and some new ones; only the
    buckets of their ids are rewritten, and the files of all others are the ones from before."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sinks import buckets
    root = scratch_path(spark, "buckets", uuid.uuid4().hex)
    buckets.create({"elements": (fx.elements(spark, sf_dir), "id")}, root, 64)
    files = lambda: buckets.read(spark, root, "elements").select(
        buckets.bucket_of("id", 64).alias("b"), F.col("_metadata.file_path").alias("file")).distinct()
    before = files()
    o = fx.table(spark, sf_dir, "orders")
    last = o.agg(F.max("o_orderdate").alias("o_orderdate"))
    key = F.col("o_orderkey").cast("string")
    again = o.join(last, "o_orderdate").select(F.explode(F.array(key, F.concat(F.lit("N"), key))).alias("id"), "o_orderkey")
    schema = fx.elements(spark, sf_dir).schema
    batch = again.select("id", F.lit("NEW").alias("project_id"), F.lit("E3").alias("ebkp"),
                         *(F.lit(None).cast(schema[c].dataType).alias(c) for c in ("area_net", "length")))
    buckets.upsert(spark, root, "elements", batch, ["id"], keep_from_old=["project_id"])
    touched = batch.select(buckets.bucket_of("id", 64).alias("b"), F.lit(True).alias("touched")).distinct()
    # of every bucket: touched ones have new files only, the others the same files
    both = before.withColumn("old", F.lit(True)).join(files().withColumn("new", F.lit(True)), ["b", "file"], "full").join(touched, "b", "left")
    kept = both.agg(F.bool_and(F.when(F.col("touched"), F.col("old").isNull() | F.col("new").isNull())
                               .otherwise(F.col("old") & F.col("new") & True)).alias("kept"))
    return buckets.read(spark, root, "elements").select("id", "project_id", "ebkp", F.lit(bool(kept.first()["kept"])).alias("untouched_buckets_kept"))


@query("bucketed_delete", with_views(body="""
SELECT 'elements' AS table_name, COUNT(*) AS n_rows FROM fx_elements WHERE NOT (project_id = 'P3' AND ebkp = 'C2.1')
UNION ALL SELECT 'element_materials', COUNT(*) FROM fx_element_materials
WHERE element_id NOT IN (SELECT id FROM fx_elements WHERE project_id = 'P3' AND ebkp = 'C2.1')"""))
def q_bucketed_delete(spark, sf_dir):
    """M5 on stored tables: some elements of a project deleted with their materials in one commit."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sinks import buckets
    root = scratch_path(spark, "buckets", uuid.uuid4().hex)
    buckets.create({"elements": (fx.elements(spark, sf_dir), "id"), "element_materials": (fx.element_materials(spark, sf_dir), "element_id")}, root, 16)
    doomed = buckets.read(spark, root, "elements").filter("project_id = 'P3' AND ebkp = 'C2.1'").select("id")
    buckets.delete(spark, root, doomed, ["elements", "element_materials"])
    count = lambda t: buckets.read(spark, root, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
    return count("elements").unionByName(count("element_materials"))


_OUTCOME_BODY = """
SELECT COALESCE(error_code, 'OK') AS outcome, COUNT(*) AS n_components FROM lca_components {where} GROUP BY 1"""


@query("lca_outcomes_previous_version", with_views(LCA_VIEWS.replace("'2024-v1'", "'2023-v1'"),
                                                   body=_OUTCOME_BODY.format(where="")))
def q_lca_outcomes_previous_version(spark, sf_dir):
    """M8: activate the previous catalogue version, then rerun the LCA (outcome counts)."""
    from graustein.operators import catalogue as cat
    inputs = lca_inputs(spark, sf_dir)
    inputs.versions = cat.set_active_version(inputs.versions, "2023-v1")
    comps, _ = jobs.lca(inputs)
    return (comps.groupBy(F.coalesce("error_code", F.lit("OK")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_components")))


_REMAP = """
new_map AS (SELECT p_name AS ifc_material, CAST(MAX(p_partkey) AS VARCHAR) AS kbob_id FROM part GROUP BY p_name)"""


@query("mappings_last_wins", with_views("""
rows AS (
  SELECT 'P' || CAST(p_partkey % 20 AS VARCHAR) AS project_id, p_name AS ifc_material,
         CASE WHEN p_size % 5 = 0 THEN ' ' ELSE CAST(p_partkey AS VARCHAR) END AS kbob_id, p_partkey AS v FROM part),
last AS (SELECT project_id, ifc_material, arg_max(kbob_id, v) AS kbob_id FROM rows GROUP BY 1, 2)""", body="""
SELECT DISTINCT l.* FROM last l JOIN fx_element_materials m ON m.material_name = l.ifc_material
JOIN fx_elements e ON e.id = m.element_id AND e.project_id = l.project_id WHERE trim(l.kbob_id) <> ''"""))
def q_mappings_last_wins(spark, sf_dir):
    """Several mappings of one material per project; the last one counts, and a blank
    last one leaves the material without."""
    from graustein.operators import projects as pr
    p = fx.table(spark, sf_dir, "part")
    rows = p.select(F.concat(F.lit("P"), (F.col("p_partkey") % fx.N_PROJECTS).cast("string")).alias("project_id"), F.col("p_name").alias("ifc_material"),
                    F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.col("p_partkey").cast("string")).alias("kbob_id"),
                    F.timestamp_seconds(F.col("p_partkey")).alias("created_at"))
    return pr.project_mappings_in_use(rows, fx.element_materials(spark, sf_dir), fx.elements(spark, sf_dir))


@query("published_in_order", with_views(body="SELECT uuid, version, 2 AS commits FROM fx_kbob WHERE version = '2024-v1'"))
def q_published_in_order(spark, sf_dir):
    """Two snapshots published one after the other (v9, then v10): the one published last is
    current, whatever their names sort like."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sinks import commits, writers
    root = scratch_path(spark, "published", uuid.uuid4().hex)
    kbob = fx.kbob_materials(spark, sf_dir).select("uuid", "version")
    writers.publish_snapshot(kbob.filter("version = '2023-v1'"), root, "kbob_materials", "v9")
    writers.publish_snapshot(kbob.filter("version = '2024-v1'"), root, "kbob_materials", "v10")
    return writers.read_current(spark, root, "kbob_materials").withColumn("commits", F.lit(commits.state(spark, root)[0]))


@query("remap_and_recompute", with_views(_REMAP, LCA_VIEWS.replace("fx_mappings mp", "new_map mp"),
                                         body=_OUTCOME_BODY.format(where="WHERE project_id = 'P5'")))
def q_remap_and_recompute(spark, sf_dir):
    """C5 (M9 + C1): replace project P5's mapping, recompute that project only."""
    from graustein.operators import projects as pr
    inputs = lca_inputs(spark, sf_dir)
    in_use = pr.project_mappings_in_use(inputs.mappings, inputs.materials, inputs.elements)
    new_map = (fx.table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("ifc_material"))
               .agg(F.max("p_partkey").cast("string").alias("kbob_id")))
    _, comps = jobs.remap_and_recompute(inputs, "P5", new_map, in_use)
    return (comps.groupBy(F.coalesce("error_code", F.lit("OK")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_components")))


@query("remap_difference", with_views("""
new_map AS (SELECT p_name AS ifc_material, CAST(CASE WHEN MAX(p_size) % 2 = 0 THEN MIN(p_partkey) ELSE MAX(p_partkey) END AS VARCHAR) AS kbob_id FROM part
            WHERE p_name NOT LIKE 'red %' OR p_size % 3 = 0 GROUP BY p_name)""", LCA_VIEWS.replace("fx_mappings mp", "new_map mp"), body=f"""
, changed AS (SELECT COALESCE(n.ifc_material, o.ifc_material) AS m FROM new_map n FULL JOIN fx_mappings o ON o.ifc_material = n.ifc_material
              WHERE n.kbob_id IS DISTINCT FROM o.kbob_id)
SELECT project_id, COUNT(*) AS n_components, {_IMPACT_SUMS},
       (SELECT COUNT(*) FROM lca_components WHERE project_id = 'P5' AND material_name IN (SELECT m FROM changed)) AS n_recomputed
FROM lca_components WHERE NOT failed AND project_id = 'P5' GROUP BY project_id"""))
def q_remap_difference(spark, sf_dir):
    """C5 by difference: some of P5's materials are mapped to something else; only their components are
    computed again, and P5's totals corrected by them."""
    from graustein.session import written_copy
    inputs = lca_inputs(spark, sf_dir)
    old = inputs.mappings.select(F.lit("P5").alias("project_id"), "ifc_material", "kbob_id")
    stored = written_copy(lca_components(spark, sf_dir).filter("project_id = 'P5'"), "components")
    p = fx.table(spark, sf_dir, "part").filter(~F.col("p_name").startswith("red ") | (F.col("p_size") % 3 == 0))
    new_map = p.groupBy(F.col("p_name").alias("ifc_material")).agg(
        F.when(F.max("p_size") % 2 == 0, F.min("p_partkey")).otherwise(F.max("p_partkey")).cast("string").alias("kbob_id"))
    d = jobs.remap_difference(inputs, "P5", new_map, old, stored, lca_ops.project_impacts(stored))
    again = d.components.groupBy("project_id").agg(F.count(F.lit(1)).alias("n_recomputed"))
    return d.totals.join(again, "project_id", "left").withColumn("n_recomputed", F.coalesce("n_recomputed", F.lit(0)).cast("long"))


@query("repair_versions", with_views(body="""
SELECT version, version = (SELECT MAX(version) FROM fx_kbob) AS is_active FROM (
  SELECT version FROM fx_versions WHERE version <> '2024-v1'
  UNION SELECT MAX(version) FROM fx_kbob)"""))
def q_repair_versions(spark, sf_dir):
    """M11 (A4, J14, M8): register the newest catalogue version when missing and activate it."""
    from graustein.operators import catalogue as cat
    versions = fx.kbob_versions(spark).filter(F.col("version") != "2024-v1")
    return cat.repair_versions(fx.kbob_materials(spark, sf_dir), versions).select("version", "is_active")


@query("project_status", with_views(COST_VIEWS, body="""
, st AS (SELECT project_id, CASE WHEN COUNT(*) FILTER (WHERE failed) = 0 THEN 'completed' ELSE 'failed' END AS status
        FROM cost_components GROUP BY project_id),
p AS (SELECT project_id, CASE WHEN project_id = 'P3' THEN 'Renamed' ELSE name END AS name, status FROM fx_projects
      UNION ALL SELECT 'P99', 'Fresh', 'active')
SELECT p.project_id, p.name, COALESCE(st.status, p.status) AS status FROM p LEFT JOIN st USING (project_id)"""))
def q_project_status(spark, sf_dir):
    """M3 + M7: upsert two projects, then set every project's status from its cost run."""
    from graustein.operators import maintenance as mt
    projects = (fx.projects(spark, sf_dir).withColumn("created_at", F.lit(None).cast("timestamp"))
                .withColumn("updated_at", F.lit(None).cast("timestamp")))
    projects = mt.upsert_project(projects, "P3", "Renamed")
    projects = mt.upsert_project(projects, "P99", "Fresh")
    stats = cost_ops.cost_run_stats(cost_components(spark, sf_dir))
    return mt.set_statuses(projects, stats).select("project_id", "name", "status")


# ---------------------------------------------------------------- streaming (X1-X3) and store

def _event_message():
    project = F.concat(F.lit("P"), (F.col("user_id") % fx.N_PROJECTS).cast("string"))
    url = F.concat(F.lit("s3://models/"), project, F.lit("/model_"), F.col("event_id").cast("string"), F.lit(".ifc"))
    return F.to_json(F.struct(url.alias("fileUrl"), project.alias("projectId")))


@query("stream_replies", with_views(LCA_VIEWS, body="""
, msg AS (
  SELECT 'P' || CAST(user_id % 20 AS VARCHAR) AS project_id,
         's3://models/P' || CAST(user_id % 20 AS VARCHAR) || '/model_' || CAST(event_id AS VARCHAR) || '.ifc' AS file_url
  FROM events),
st AS (SELECT project_id, COUNT(*) AS total_components, COUNT(*) FILTER (WHERE failed) AS failed_components
       FROM lca_components GROUP BY project_id),
rep AS (
  SELECT CASE WHEN st.project_id IS NOT NULL THEN 'success' ELSE 'error' END AS status, m.project_id,
         CASE WHEN st.project_id IS NOT NULL THEN 'Processed ' || split_part(m.file_url, '/', -1) || ': '
              || CAST(st.total_components - st.failed_components AS VARCHAR) || ' components computed, '
              || CAST(st.failed_components AS VARCHAR) || ' failed'
              ELSE 'No elements for project ' || m.project_id END AS message,
         '{"fileUrl":"' || m.file_url || '","projectId":"' || m.project_id || '"}' AS value,
         m.file_url, split_part(m.file_url, '/', -2) AS bucket, split_part(m.file_url, '/', -1) AS object_name
  FROM msg m LEFT JOIN st ON st.project_id = m.project_id)
SELECT *, '{"status":"' || status || '","project_id":"' || project_id || '","message":"' || message || '"}' AS reply
FROM rep"""))
def q_stream_replies(spark, sf_dir):
    """The events table as a message stream (one message per model); each micro-batch
    runs the LCA for the projects it names and writes one reply per message."""
    import uuid
    from graustein.session import scratch_path
    from graustein.streaming import messages as ms
    root = scratch_path(spark, "streams", uuid.uuid4().hex)
    stream = ms.file_messages(spark, sf_dir, fmt="parquet", schema=fx.table(spark, sf_dir, "events").schema,
                              glob="events.parquet", value=_event_message)
    ctx = ms.BatchContext(lca_inputs=lambda: lca_inputs(spark, sf_dir), output_root=os.path.join(root, "out"))
    ms.run_available(stream, ctx, checkpoint=os.path.join(root, "checkpoint"))
    from graustein.streaming import deliveries as dl
    return dl.read_all(spark, os.path.join(root, "out"), "replies").drop(dl.BATCH)


@query("stream_redelivery", with_views(LCA_VIEWS, body="""
, msg AS (SELECT DISTINCT 'P' || CAST(user_id % 20 AS VARCHAR) AS project_id FROM events),
again AS (SELECT project_id FROM msg WHERE project_id IN ('P1', 'P2', 'P3')),
st AS (SELECT project_id, COUNT(*) AS n FROM lca_components GROUP BY project_id)
SELECT m.project_id, CASE WHEN m.project_id IN ('P1', 'P3') THEN 0 ELSE COALESCE(st.n, 0) END AS n_components,
       CASE WHEN m.project_id IN ('P1', 'P3') OR st.n IS NULL THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN m.project_id IN ('P1', 'P3') OR st.n IS NULL THEN 'error' ELSE 'success' END AS last_reply
FROM msg m LEFT JOIN st USING (project_id)"""))
def q_stream_redelivery(spark, sf_dir):
    """All projects delivered, then P1, P2 and P3 again after the elements of P1 and P3 were
    deleted: those show no rows, are failed and answered with an error; all tables change in one commit."""
    import uuid
    from graustein.session import scratch_path, written_copy
    from graustein.streaming import deliveries as dl
    from graustein.streaming import messages as ms
    root = scratch_path(spark, "streams", uuid.uuid4().hex)
    materials = written_copy(fx.element_materials(spark, sf_dir), "element_materials")  # both batches read them

    def inputs_now():
        inputs = lca_inputs(spark, sf_dir)
        inputs.materials = materials
        return inputs
    messages = fx.table(spark, sf_dir, "events").select(_event_message().alias("value"))
    # one message per project
    url = F.concat(F.lit("s3://models/"), F.col("project_id"), F.lit("/model.ifc"))
    named = ms.clean_messages(messages).select("project_id").distinct().select(F.to_json(F.struct(url.alias("fileUrl"), F.col("project_id").alias("projectId"))).alias("value"), "project_id")
    ms.make_batch_handler(ms.BatchContext(inputs_now, root))(named.select("value"), 0)

    def later():
        inputs = inputs_now()
        inputs.elements = inputs.elements.filter(~F.col("project_id").isin("P1", "P3"))
        return inputs
    ms.make_batch_handler(ms.BatchContext(later, root))(named.filter(F.col("project_id").isin("P1", "P2", "P3")).select("value"), 1)
    comps = dl.read_current(spark, root, "components").groupBy("project_id").agg(F.count(F.lit(1)).alias("n"))
    last = dl.read_current(spark, root, "replies").select("project_id", F.col("status").alias("last_reply"))
    return (dl.read_current(spark, root, "projects").select("project_id", "status").join(comps, "project_id", "left").join(last, "project_id")
            .select("project_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_components"), "status", "last_reply"))


@query("stored_latest_results", with_views(LCA_VIEWS, body="""
SELECT project_id, element_id, material_name, gwp_absolute, failed FROM lca_components"""))
def q_stored_latest_results(spark, sf_dir):
    """K1 + S10 + T4: two runs stored per project (an older one with every row failed), the
    latest run per (project, file) read back by partition pruning."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sinks import writers
    root = scratch_path(spark, "store", uuid.uuid4().hex)
    comps = lca_components(spark, sf_dir).select("project_id", "element_id", "material_name", "gwp_absolute", "failed")
    stale = comps.withColumn("failed", F.lit(True)).withColumn("gwp_absolute", F.lit(None).cast("double"))
    writers.store_results(stale, root, "lca", "model.ifc", run_ts="20240101T000000000000")
    writers.store_results(comps, root, "lca", "model.ifc", run_ts="20240102T000000000000")
    return (writers.read_latest(spark, root, "lca", filename="model.ifc")
            .select("project_id", "element_id", "material_name", "gwp_absolute", "failed"))


@query("persisted_lca_results", with_views(LCA_VIEWS, body="""
SELECT CASE WHEN CAST(element_id AS BIGINT) % 2 = 0 THEN lpad(CAST(CAST(element_id AS BIGINT) % 7 AS VARCHAR), 3, '0')
            ELSE '2024-01-0' || CAST(CAST(element_id AS BIGINT) % 7 + 1 AS VARCHAR) END AS project_id,
       element_id, material_name, failed FROM lca_components"""))
def q_persisted_lca_results(spark, sf_dir):
    """Component rows of projects named like numbers (007) and dates, stored by project
    and read back; the ids stay what they were."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sinks import writers
    key = F.col("element_id").cast("long")
    project = F.when(key % 2 == 0, F.lpad((key % 7).cast("string"), 3, "0")).otherwise(F.concat(F.lit("2024-01-0"), (key % 7 + 1).cast("string")))
    comps = lca_components(spark, sf_dir).select(project.alias("project_id"), "element_id", "material_name", "failed")
    path = scratch_path(spark, "store", uuid.uuid4().hex)
    writers.write_partitioned(comps, path, ("project_id",), mode="overwrite")
    return writers.read_back(spark, path, comps)


# ---------------------------------------------------------------- file round trips

@query("catalogue_csv_round_trip", with_views(body="""
SELECT uuid, name, CAST(indicator_co2eq AS DOUBLE) AS indicator_co2eq, CAST(indicator_penre AS DOUBLE) AS indicator_penre,
       CAST(indicator_ubp AS DOUBLE) AS indicator_ubp, CAST(0 AS DOUBLE) AS density, version
FROM fx_kbob WHERE version = '2024-v1'"""))
def q_catalogue_csv_round_trip(spark, sf_dir):
    """S2 + P6: the active catalogue written as the German-header ISO-8859-1 CSV and imported
    back (uuid trimmed, unparsable density -> 0)."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sources.readers import KBOB_ENCODING, KBOB_HEADERS, read_kbob_csv
    path = scratch_path(spark, "csv", uuid.uuid4().hex)
    kbob = fx.kbob_materials(spark, sf_dir).filter(F.col("version") == fx.ACTIVE_VERSION)
    (kbob.select(*[F.col(c).cast("string").alias(h) for c, h in KBOB_HEADERS.items()])
     .write.option("header", True).option("encoding", KBOB_ENCODING).csv(path))
    return read_kbob_csv(spark, path, fx.ACTIVE_VERSION).drop("created_at")


@query("backup_round_trip", with_views(body="""
SELECT id, '00' || substr(project_id, 2) AS project_id, ebkp, CAST(area_net AS DOUBLE) AS area_net, CAST(length AS DOUBLE) AS length, '007' AS code FROM fx_elements"""))
def q_backup_round_trip(spark, sf_dir):
    """K3 + S9 (C9): the elements, with projects named like numbers, exported as JSON split by project
    and restored with the types they had."""
    import uuid
    from graustein.session import scratch_path
    from graustein.sinks import writers
    root = scratch_path(spark, "backup", uuid.uuid4().hex)
    numbered = fx.elements(spark, sf_dir).withColumn("project_id", F.concat(F.lit("00"), F.substring("project_id", 2, 9))).withColumn("code", F.lit("007"))
    writers.export_tables({"elements": numbered, "kbob_versions": fx.kbob_versions(spark)}, root)
    back = writers.import_tables(spark, root, ["elements", "kbob_versions"])["elements"]
    return back.select("id", "project_id", "ebkp", F.col("area_net").cast("double"), F.col("length").cast("double"), "code")


from graustein.plans import file_queries  # noqa: E402, F401  registers its queries here
