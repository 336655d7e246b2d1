"""Registered queries that write the fixture tables as real files and read them back (S1, S3-S6, S8),
and queries on single projects, persisted runs and loads. Registered through ``plans.registry``."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from graustein.operators import lca as lca_ops
from graustein.operators import maintenance as mt
from graustein.operators import projects as pr
from graustein.plans import runs
from graustein.plans.oracle import COST_VIEWS, LCA_VIEWS, with_views
from graustein.plans.registry import _LATEST, lca_inputs, query
from graustein.session import scratch_path
from graustein.sinks import writers
from graustein.sources import fixtures as fx
from graustein.sources import readers


def folder(spark, *parts):
    return scratch_path(spark, "files", uuid.uuid4().hex, *parts)


def json_lists(rows, path, files=4):
    """Writes ``rows`` as JSON lists, an object per line, in ``files`` files."""
    spark = rows.sparkSession
    body = rows.select(F.pmod(F.xxhash64(*rows.columns), F.lit(files)).cast("int").alias("file"), F.concat(F.lit(","), F.to_json(F.struct(*rows.columns))).alias("value"))
    ends = [spark.range(files).select(F.col("id").cast("int").alias("file"), F.lit(v).alias("value")) for v in ("[{}", "~")]
    order = F.expr("CASE substring(value, 1, 1) WHEN '[' THEN 0 WHEN ',' THEN 1 ELSE 2 END")
    (ends[0].unionByName(body).unionByName(ends[1]).repartitionById(files, "file").sortWithinPartitions(order)
     .select(F.when(F.col("value") == "~", "]").otherwise(F.col("value")).alias("value")).write.text(path))


@query("tables_by_extension", with_views(body="""
SELECT f.format, CAST(project_id AS VARCHAR) AS project_id, COUNT(*) AS n_runs, CAST(SUM(id) AS BIGINT) AS ids
FROM fx_history, (VALUES ('csv'), ('json'), ('parquet')) f(format) GROUP BY 1, 2"""))
def q_tables_by_extension(spark, sf_dir):
    """The run history written as CSV, JSON lists and Parquet and read by the path's extension."""
    rows = fx.history(spark, sf_dir).select("id", "project_id")
    path = folder(spark)
    rows.write.option("header", True).csv(f"{path}/h.csv")
    json_lists(rows, f"{path}/h.json")
    rows.write.parquet(f"{path}/h.parquet")
    parts = [readers.load_table(spark, f"{path}/h.{f}").filter("id IS NOT NULL").select(F.lit(f).alias("format"), "project_id", F.col("id").cast("long").alias("id"))
             for f in ("csv", "json", "parquet")]
    return (parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("format", "project_id")
            .agg(F.count(F.lit(1)).alias("n_runs"), F.sum("id").alias("ids")))


@query("positional_csv", with_views(body="""
SELECT CAST(p_partkey AS VARCHAR) AS ebkp_code, p_name AS description, CASE WHEN p_size % 2 = 0 THEN 'm2' ELSE 'm' END AS unit,
       CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS DOUBLE) END AS cost_per_unit, 'v' AS version FROM part"""))
def q_positional_csv(spark, sf_dir):
    """S3: a CSV whose columns have other names, taken by position; what is no number becomes null."""
    p = fx.table(spark, sf_dir, "part")
    path = folder(spark)
    p.select(F.col("p_partkey").alias("a"), F.col("p_name").alias("b"), F.when(F.col("p_size") % 2 == 0, "m2").otherwise("m").alias("c"),
             F.when(F.col("p_size") % 3 > 0, F.col("p_size").cast("string")).otherwise("n/a").alias("d"), F.lit("v").alias("e")).write.option("header", True).csv(path)
    return readers.read_positional_csv(spark, path, "cost_reference").drop("created_at")


@query("life_expectancy_files", with_views(body="""
SELECT f.format, 'C' || p_partkey AS ebkp_code, p_name AS description, CASE WHEN p_size % 4 > 0 THEN CAST(p_size AS INTEGER) END AS "years",
       COALESCE(CASE WHEN p_size % 3 = 0 THEN false END, true) AS model_based
FROM part, (VALUES ('csv'), ('framed'), ('json')) f(format)"""))
def q_life_expectancy_files(spark, sf_dir):
    """Service lives as a CSV and as JSON lists, these read whole and framed over byte ranges."""
    p = fx.table(spark, sf_dir, "part")
    rows = p.select(F.concat(F.lit("C"), "p_partkey").alias("ebkp_code"), F.col("p_name").alias("description"),
                    F.when(F.col("p_size") % 4 > 0, F.col("p_size")).cast("int").alias("years"), F.when(F.col("p_size") % 3 == 0, False).alias("model_based"))
    path = folder(spark)
    rows.select(*(F.col(c).alias(h) for c, h in readers.LIFE_HEADERS.items())).write.option("header", True).csv(f"{path}/life.csv")
    json_lists(rows, f"{path}/life.json")
    read = {"csv": readers.read_life_expectancy(spark, f"{path}/life.csv"), "json": readers.read_life_expectancy(spark, f"{path}/life.json"),
            "framed": readers.read_life_expectancy(spark, f"{path}/life.json", framed=True)}
    parts = [df.filter("ebkp_code IS NOT NULL").withColumn("format", F.lit(f)) for f, df in read.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("cost_csv", with_views(body="""
SELECT 'C' || p_partkey AS ebkp_code, p_name AS description, 'm2' AS unit, CASE WHEN p_size % 5 > 0 THEN CAST(p_size AS DOUBLE) + 0.5 END AS cost_per_unit, '2024' AS version FROM part"""))
def q_cost_csv(spark, sf_dir):
    """Cost key figures from a CSV with the file's headers."""
    p = fx.table(spark, sf_dir, "part")
    path = folder(spark)
    values = {"ebkp_code": F.concat(F.lit("C"), "p_partkey"), "description": F.col("p_name"), "unit": F.lit("m2"),
              "cost_per_unit": F.when(F.col("p_size") % 5 > 0, F.concat(F.col("p_size").cast("string"), F.lit(".5"))).otherwise("?")}
    p.select(*(values[c].alias(h) for c, h in readers.COST_HEADERS.items())).write.option("header", True).csv(path)
    return readers.read_cost_csv(spark, path, "2024")


@query("mapping_files", with_views(body="""
SELECT f.format, ifc_material, kbob_id, 'P1' AS project_id, COALESCE(CASE WHEN length(kbob_id) > 2 THEN false END, true) AS is_modelled
FROM fx_mappings, (VALUES ('framed'), ('json')) f(format)"""))
def q_mapping_files(spark, sf_dir):
    """Mapping lists as JSON, read whole and framed; the project is given by the caller."""
    path = folder(spark)
    json_lists(fx.mappings(spark, sf_dir).withColumn("is_modelled", F.when(F.length("kbob_id") > 2, False)), path)
    parts = [readers.read_material_mappings(spark, path, "P1", framed=f == "framed").filter("ifc_material IS NOT NULL")
             .select(F.lit(f).alias("format"), "ifc_material", "kbob_id", "project_id", "is_modelled") for f in ("framed", "json")]
    return parts[0].unionByName(parts[1])


@query("cost_elements_csv", with_views(body="""
SELECT id, project_id, ebkp, CAST(area_net AS DOUBLE) AS area_net, CAST(length AS DOUBLE) AS length FROM (
  SELECT id, 'P0' AS project_id, ebkp, area_net, length FROM fx_elements)"""))
def q_cost_elements_csv(spark, sf_dir):
    """S8 + P5: elements under the flat cost file's column names, as CSV and back (spaces in codes kept)."""
    from graustein.operators import cost as cost_ops
    path = folder(spark)
    rows = cost_ops.to_cost_file_columns(fx.elements(spark, sf_dir).withColumn("volume_net", F.lit(1.0))).withColumn("KBOB UUID-Nummer", F.lit("u"))
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_cost_elements_csv(spark, path, "P0").select("id", "project_id", "ebkp", "area_net", "length")


@query("run_tables", with_views(LCA_VIEWS, COST_VIEWS, body="""
SELECT 'results' AS table_name, project_id, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE failed) AS n_failed FROM lca_components GROUP BY 2
UNION ALL SELECT 'errors', project_id, COUNT(*), COUNT(*) FROM (
  SELECT project_id FROM lca_components WHERE failed UNION ALL SELECT project_id FROM cost_components WHERE failed) GROUP BY 2
UNION ALL SELECT 'history', project_id, 2, CAST(COUNT(DISTINCT element_id) FILTER (WHERE failed) AS BIGINT) + (
  SELECT COUNT(*) FILTER (WHERE c.failed) FROM cost_components c WHERE c.project_id = l.project_id) FROM lca_components l GROUP BY 2
UNION ALL SELECT 'observed', NULL, COUNT(*), COUNT(*) FILTER (WHERE failed) FROM lca_components"""))
def q_run_tables(spark, sf_dir):
    """Persisted LCA and cost runs, their stored results, errors and history
    by project, and what the LCA run counted while it wrote."""
    path, inputs = folder(spark), lca_inputs(spark, sf_dir)
    counts = runs.run_lca(spark, inputs, path, run_id="r").counts
    runs.run_cost(spark, inputs.elements, fx.cost_reference(spark), path, run_id="r")
    read = lambda t: spark.read.parquet(os.path.join(path, t))
    parts = [read("processing_results").groupBy("project_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("failed") & (F.col("kbob_uuid") == "") & F.col("error").isNotNull()).alias("n_failed")),
             read("processing_errors").groupBy("project_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count("error_type").alias("n_failed")),
             read("processing_history").groupBy("project_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("failed_elements").cast("long").alias("n_failed")),
             spark.range(1).select(F.lit(None).cast("string").alias("project_id"), F.lit(counts["components"]).cast("long").alias("n_rows"), F.lit(counts["failed"]).cast("long").alias("n_failed"))]
    out = [df.select(F.lit(n).alias("table_name"), "project_id", "n_rows", "n_failed") for n, df in zip(("results", "errors", "history", "observed"), parts)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("one_project", with_views(_LATEST, body="""
SELECT 'elements' AS part, id AS key, ebkp AS value FROM fx_elements WHERE project_id = 'P3'
UNION ALL SELECT 'materials', element_id || '/' || material_name, CAST(volume AS VARCHAR) FROM fx_element_materials WHERE element_id IN (SELECT id FROM fx_elements WHERE project_id = 'P3')
UNION ALL SELECT 'latest', CAST(id AS VARCHAR), kbob_version FROM latest WHERE project_id = 'P3'
UNION ALL SELECT 'mapping', p_name, CAST(MAX(p_partkey) AS VARCHAR) FROM part WHERE p_size % 2 = 0 GROUP BY p_name HAVING p_name <> ''"""))
def q_one_project(spark, sf_dir):
    """Elements, materials, mapping (its last rows) and latest run of one project."""
    els = pr.elements_of_project(fx.elements(spark, sf_dir), "P3")
    mats = pr.materials_of_elements(fx.element_materials(spark, sf_dir), els)
    p = fx.table(spark, sf_dir, "part").filter("p_size % 2 = 0")
    rows = p.select(F.explode(F.array(F.lit("P3"), F.lit("P4"))).alias("project_id"), F.col("p_name").alias("ifc_material"), F.col("p_partkey").cast("string").alias("kbob_id"),
                    F.timestamp_seconds("p_partkey").alias("created_at"))
    mapping = pr.project_mapping(rows, "P3")
    latest = pr.latest_of_project(fx.history(spark, sf_dir), "P3")
    out = [els.select("id", "ebkp"), mats.select(F.concat_ws("/", "element_id", "material_name"), F.col("volume").cast("string")),
           latest.select(F.col("id").cast("string"), "kbob_version"), mapping.select("ifc_material", "kbob_id")]
    out = [df.toDF("key", "value").select(F.lit(n).alias("part"), "key", "value") for n, df in zip(("elements", "materials", "latest", "mapping"), out)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("largest_volumes", with_views(body="""
SELECT row_number() OVER (ORDER BY volume DESC NULLS LAST, name) AS place, name, volume FROM (
  SELECT m.material_name AS name, COALESCE(CAST(SUM(m.volume) AS DOUBLE), 0.0) AS volume
  FROM fx_element_materials m JOIN fx_elements e ON m.element_id = e.id WHERE e.project_id = 'P3' GROUP BY 1)
QUALIFY place <= 20"""))
def q_largest_volumes(spark, sf_dir):
    """The twenty largest materials of one project, in order (a top-k report)."""
    volumes = pr.material_volumes(fx.element_materials(spark, sf_dir), pr.elements_of_project(fx.elements(spark, sf_dir), "P3"))
    top = pr.ordered_material_volumes(volumes).limit(20).agg(F.collect_list(F.struct("name", "volume")).alias("top"))  # 20 rows
    return top.select(F.posexplode("top").alias("at", "r")).select((F.col("at") + 1).cast("long").alias("place"), "r.name", "r.volume")


@query("replace_project", with_views(body="""
SELECT 'elements' AS part, id AS key, project_id || '/' || ebkp AS value FROM fx_elements WHERE project_id <> 'P3'
UNION ALL SELECT 'elements', 'R' || id, 'P3/E3' FROM fx_elements WHERE project_id = 'P4'
UNION ALL SELECT 'materials', m.element_id || '/' || m.material_name, CAST(CAST(m.volume AS DOUBLE) AS VARCHAR) FROM fx_element_materials m JOIN fx_elements e ON e.id = m.element_id WHERE e.project_id <> 'P3'
UNION ALL SELECT 'materials', 'R' || id || '/Beton', '2.0' FROM fx_elements WHERE project_id = 'P4'"""))
def q_replace_project(spark, sf_dir):
    """M6 (M5, M1, M2): a project's elements and materials replaced; of a material given twice one row stays."""
    els, mats = fx.elements(spark, sf_dir), fx.element_materials(spark, sf_dir).withColumn("volume", F.col("volume").cast("double"))
    new = els.filter("project_id = 'P4'").withColumn("id", F.concat(F.lit("R"), "id")).withColumn("project_id", F.lit("P3")).withColumn("ebkp", F.lit("E3"))
    layers = new.select(F.col("id").alias("element_id"), F.lit("Beton").alias("material_name"), F.explode(F.array(F.lit(1.0), F.lit(2.0))).alias("volume"),
                        F.lit(1).cast("decimal(8,1)").alias("density"))
    no_results = mats.select("element_id").limit(0)
    e, m, _ = mt.replace_project_elements(els, mats, no_results, "P3", new, layers)
    return (e.select(F.lit("elements").alias("part"), F.col("id").alias("key"), F.concat_ws("/", "project_id", "ebkp").alias("value"))
            .unionByName(m.select(F.lit("materials").alias("part"), F.concat_ws("/", "element_id", "material_name").alias("key"), F.col("volume").cast("string").alias("value"))))


@query("catalogue_loaded", with_views(body="""
SELECT 'v2' AS version, uuid, CAST(indicator_co2eq AS DOUBLE) AS indicator_co2eq, true AS is_active, 2 AS commits FROM fx_kbob WHERE version = '2024-v1'
UNION ALL SELECT 'v1', uuid, CAST(indicator_co2eq AS DOUBLE), false, 2 FROM fx_kbob WHERE version = '2023-v1'"""))
def q_catalogue_loaded(spark, sf_dir):
    """M12 (S2, M4, M8): two catalogue versions loaded from CSV files, each as one commit; the second becomes
    active and the first stays."""
    from graustein.sinks import commits
    path, out = folder(spark), folder(spark)
    for version, source in (("v1", "2023-v1"), ("v2", "2024-v1")):
        kbob = fx.kbob_materials(spark, sf_dir).filter(F.col("version") == source)
        (kbob.select(*[F.col(c).cast("string").alias(h) for c, h in readers.KBOB_HEADERS.items()])
         .write.option("header", True).option("encoding", readers.KBOB_ENCODING).csv(f"{path}/{version}"))
        runs.load_reference_data(spark, out, version, f"{path}/{version}")
    versions = writers.read_current(spark, out, "kbob_versions").select("version", "is_active")
    return (writers.read_current(spark, out, "kbob_materials").select("version", "uuid", "indicator_co2eq").join(versions, "version")
            .withColumn("commits", F.lit(commits.state(spark, out)[0])))


@query("element_ids", with_views(body="""
SELECT id, sha256(project_id || '|' || 'ifc_model.ifc' || '|' || id) AS uid, 'ifc_' || 'm' || id AS project FROM fx_elements"""))
def q_element_ids(spark, sf_dir):
    """H12 + H14: repeatable element ids, and projects named after files."""
    from graustein.functions.ids import element_uid, project_from_filename
    e = fx.elements(spark, sf_dir)
    return e.select("id", element_uid("project_id", F.lit("ifc_model.ifc"), "id").alias("uid"),
                    project_from_filename(F.concat(F.lit("in/m"), "id", F.lit(".json"))).alias("project"))


@query("catalogue_lookup", with_views(body="""
SELECT 'active' AS asked, uuid, version FROM fx_kbob WHERE uuid = '7' AND version = '2024-v1'
UNION ALL SELECT '2023-v1', uuid, version FROM fx_kbob WHERE uuid = '7' AND version = '2023-v1'"""))
def q_catalogue_lookup(spark, sf_dir):
    """A material by its id, in the active version and in a named one."""
    from graustein.operators import catalogue as cat
    kbob, versions = fx.kbob_materials(spark, sf_dir), fx.kbob_versions(spark)
    active, named = cat.material_by_uuid(kbob, versions, "7"), cat.material_by_uuid(kbob, versions, "7", "2023-v1")
    return active.select(F.lit("active").alias("asked"), "uuid", "version").unionByName(named.select(F.lit("2023-v1").alias("asked"), "uuid", "version"))


@query("project_status_set", with_views(body="""
SELECT project_id, CASE WHEN project_id = 'P3' THEN 'processing' ELSE status END AS status FROM fx_projects"""))
def q_project_status_set(spark, sf_dir):
    """M7 + P16: one project's status set; a status outside the domain is refused."""
    projects = fx.projects(spark, sf_dir).withColumn("updated_at", F.lit(None).cast("timestamp"))
    try:
        mt.set_status(projects, "P3", "unheard of")
    except ValueError:
        return mt.set_status(projects, "P3", "processing").select("project_id", "status")
    raise AssertionError("a status outside the domain was taken")


@query("stream_restarted", with_views(LCA_VIEWS, body="""
SELECT 'P' || CAST(user_id % 20 AS VARCHAR) AS project_id, COUNT(*) AS n_replies, 1 AS n_batches FROM events GROUP BY 1"""))
def q_stream_restarted(spark, sf_dir):
    """The message stream run twice with one checkpoint; the second run finds nothing new."""
    from graustein.plans.registry import _event_message
    from graustein.streaming import deliveries as dl
    from graustein.streaming import messages as ms
    root = folder(spark)
    for _ in range(2):
        stream = ms.file_messages(spark, sf_dir, fmt="parquet", schema=fx.table(spark, sf_dir, "events").schema, glob="events.parquet", value=_event_message)
        ms.run_available(stream, ms.BatchContext(lambda: lca_inputs(spark, sf_dir), f"{root}/out"), checkpoint=f"{root}/checkpoint")
    return dl.read_all(spark, f"{root}/out", "replies").groupBy("project_id").agg(
        F.count(F.lit(1)).alias("n_replies"), F.count_distinct(dl.BATCH).cast("int").alias("n_batches"))


@query("lca_totals_of_version", with_views(LCA_VIEWS.replace("'2024-v1'", "'2023-v1'"), body="""
SELECT project_id, COUNT(*) AS n_components FROM lca_components WHERE NOT failed GROUP BY project_id"""))
def q_lca_totals_of_version(spark, sf_dir):
    """M4 + M10: a catalogue version replaced by the other one's rows, then the whole table replaced."""
    from graustein.operators import catalogue as cat
    kbob = fx.kbob_materials(spark, sf_dir)
    old = kbob.filter("version = '2023-v1'").withColumn("version", F.lit("2024-v1"))
    inputs = lca_inputs(spark, sf_dir)
    inputs.catalogue = mt.replace_all(kbob, cat.replace_version(kbob, old, "2024-v1").drop("density"))
    from graustein.plans import jobs
    comps, _ = jobs.lca(inputs)
    return lca_ops.project_impacts(comps).select("project_id", "n_components")
