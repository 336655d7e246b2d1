"""Streaming (X1-X3) and persisted runs (C1, C2, C6): stream result = batch result,
replays are idempotent, run outputs are consistent with the lazy plans."""

import os

from pyspark.sql import functions as F

from graustein.operators import lca as lca_ops
from graustein.plans import jobs, registry, runs
from graustein.streaming import deliveries as dl
from graustein.streaming import messages as ms

SF = "/root/testdata/sf0.001"


def test_clean_messages(spark):
    df = spark.createDataFrame([("  http://h/bucket/a.ifc ",), ("",), ("   ",),
                                ('{"fileUrl": "http://h/b2/m.ifc", "projectId": "P1"}',)], "value string")
    got = [(r["file_url"], r["project_id"], r["bucket"], r["object_name"]) for r in ms.clean_messages(df).collect()]
    assert got == [("http://h/bucket/a.ifc", None, "bucket", "a.ifc"), ("http://h/b2/m.ifc", "P1", "b2", "m.ifc")]


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "m1.txt"), "w") as f:
        f.write('{"fileUrl": "s3://models/P3/a.ifc", "projectId": "P3"}\n{"fileUrl": "s3://models/P7/b.ifc", "projectId": "P7"}\n')
    out = os.path.join(tmp_dir, "out")
    from graustein.sources import fixtures as fx
    ctx = ms.BatchContext(lca_inputs=lambda: registry.lca_inputs(spark, SF), output_root=out,
                          cost_reference=lambda: fx.cost_reference(spark))
    ms.run_available(ms.file_messages(spark, inbox, fmt="text"), ctx, os.path.join(tmp_dir, "ckpt"))
    streamed = dl.read_current(spark, out, "components")
    comps, _ = jobs.lca(registry.lca_inputs(spark, SF))
    batch = comps.filter(F.col("project_id").isin("P3", "P7"))
    cols = sorted(batch.columns)
    assert sorted(map(repr, streamed.select(cols).collect())) == sorted(map(repr, batch.select(cols).collect()))
    n_costs = dl.read_current(spark, out, "cost_results").count()
    assert n_costs == fx.elements(spark, SF).filter(F.col("project_id").isin("P3", "P7")).count()
    replies = dl.read_all(spark, out, "replies").collect()
    assert sorted(r["project_id"] for r in replies) == ["P3", "P7"] and {r["status"] for r in replies} == {"success"}
    # replaying the same batch id overwrites its own output
    handler = ms.make_batch_handler(ctx)
    handler(spark.read.text(inbox), 0)
    assert dl.read_all(spark, out, "replies").count() == 2
    # a second delivery in a later batch replaces the projects' rows
    handler(spark.read.text(inbox), 9)
    assert dl.read_current(spark, out, "components").count() == batch.count()
    assert dl.read_current(spark, out, "cost_results").count() == n_costs
    assert dl.read_all(spark, out, "replies").filter("batch = 9").count() == 2
    # a restart with the same checkpoint reads nothing new
    ms.run_available(ms.file_messages(spark, inbox, fmt="text"), ctx, os.path.join(tmp_dir, "ckpt"))
    assert dl.read_all(spark, out, "replies").count() == 4


def test_persisted_combined_run(spark, tmp_dir):
    from graustein.sources import fixtures as fx
    inputs = registry.lca_inputs(spark, SF)
    result = runs.run_combined(spark, inputs, fx.cost_reference(spark), tmp_dir)
    lazy, _ = jobs.lca(registry.lca_inputs(spark, SF))
    assert result["lca"].components.count() == lazy.count()
    assert result["lca"].errors.count() == lazy.filter("failed").count()
    assert result["lca"].counts == {"components": lazy.count(), "failed": lazy.filter("failed").count()}
    hist = spark.read.parquet(os.path.join(tmp_dir, "processing_history"))
    assert hist.count() == 2 * lazy.select("project_id").distinct().count()
    results = spark.read.parquet(os.path.join(tmp_dir, "processing_results"))
    assert results.filter("failed and kbob_uuid != ''").count() == 0
    s = result["summary"].first()
    want = lca_ops.project_impacts(lazy).agg(F.sum("gwp_absolute")).first()[0]
    assert abs(s["total_co2_emission"] - want) < 1e-6 * max(1.0, want)
    parts = sorted(f for f in os.listdir(os.path.join(tmp_dir, "summary_report")) if f.startswith("part-"))
    lines = [ln for p in parts for ln in open(os.path.join(tmp_dir, "summary_report", p), encoding="utf-8").read().splitlines()]
    assert lines[:2] == ["", "Summary Report:"] and lines[6:8] == ["", "Failed Components:"]
    records = [r for r in spark.read.json(os.path.join(tmp_dir, "combined_results")).select("project_id", "guid", "n_components", F.size("components").alias("n")).collect()]
    assert len(records) == len({(r["project_id"], r["guid"]) for r in records})
    assert all(r["n"] == r["n_components"] for r in records)
    assert sum(r["n"] for r in records) == lazy.count() + fx.elements(spark, SF).count()


def test_reference_data_loaded_as_one_unit(spark, tmp_dir):
    from graustein.sinks import writers
    from graustein.sources.readers import KBOB_HEADERS
    kbob = os.path.join(tmp_dir, "kbob.csv")
    with open(kbob, "w", encoding="ISO-8859-1") as f:
        f.write(",".join(f'"{h}"' for h in KBOB_HEADERS.values()) + "\nU1,Beton,1,2,3,2300\n")
    cost = os.path.join(tmp_dir, "cost.csv")
    with open(cost, "w") as f:
        f.write("Code,Bezeichnung,reference,Kennwert\nC2.1,Wand,m2,120.5\n")
    snap = runs.load_reference_data(spark, os.path.join(tmp_dir, "ref"), "v1", kbob, cost_csv=cost)
    assert writers.read_current(spark, os.path.join(tmp_dir, "ref"), "kbob_materials").count() == 1
    assert os.path.isdir(os.path.join(tmp_dir, "ref", "cost_reference", f"snapshot={snap}"))
    dup = os.path.join(tmp_dir, "cost_dup.csv")
    with open(dup, "w") as f:
        f.write("Code,Bezeichnung,reference,Kennwert\nC2.1,Wand,m2,120.5\nC2.1,Wand2,m2,99\n")
    import pytest
    with pytest.raises(ValueError, match="cost_reference primary_key"):
        runs.load_reference_data(spark, os.path.join(tmp_dir, "ref2"), "v1", kbob, cost_csv=dup)
    assert not os.path.exists(os.path.join(tmp_dir, "ref2"))


def test_rerun_with_same_run_id_is_idempotent(spark, tmp_dir):
    inputs = registry.lca_inputs(spark, SF)
    runs.run_lca(spark, inputs, tmp_dir, run_id="r1")
    n1 = {t: spark.read.parquet(os.path.join(tmp_dir, t)).count()
          for t in ("processing_results", "processing_errors", "processing_history")}
    runs.run_lca(spark, registry.lca_inputs(spark, SF), tmp_dir, run_id="r1")
    n2 = {t: spark.read.parquet(os.path.join(tmp_dir, t)).count() for t in n1}
    assert n1 == n2
    runs.run_lca(spark, registry.lca_inputs(spark, SF), tmp_dir, run_id="r2")
    n3 = {t: spark.read.parquet(os.path.join(tmp_dir, t)).count() for t in n1}
    assert n3 == {t: 2 * n for t, n in n1.items()}


def test_document_stream_ingests_and_computes(spark, tmp_dir):
    import json
    import datetime as dt
    from graustein.sources import readers
    from graustein.plans import ingest
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    beton, glaswolle = "E13EE05E", "43B03F61"
    with open(os.path.join(landing, "haus.json"), "w") as f:
        json.dump({"elements": [
            {"id": "b1", "properties": {"ebkp": "C"}, "materials": ["Beton"],
             "material_volumes": {"Beton": {"volume": 3.684, "density": 2300}}},
            {"id": "w1", "properties": {"ebkp": "D"}, "materials": ["Wolle", "Nope"],
             "material_volumes": {"Wolle": {"volume": 86.392, "density": 30}}},
            {"id": "bad", "materials": ["Beton"], "material_volumes": {"Beton": {"volume": -1.0}}}]}, f)
    mappings = spark.createDataFrame([("Beton", beton), ("Wolle", glaswolle)], "ifc_material string, kbob_id string")
    catalogue = spark.createDataFrame([(beton, "Beton", 232.3, 402.5, 351900.0, "v"), (glaswolle, "Wolle", 340.615, 1633.5, 623150.0, "v")],
                                      "uuid string, name string, indicator_co2eq double, indicator_penre double, indicator_ubp double, version string")
    versions = spark.createDataFrame([("v", True, dt.date(2024, 1, 1))], "version string, is_active boolean, release_date date")
    life = spark.createDataFrame([("C", "c", 50), ("D", "d", 30)], "ebkp_code string, description string, years int")
    out = os.path.join(tmp_dir, "out")
    ctx = ms.DocumentContext(lambda: mappings, lambda: catalogue, lambda: versions, lambda: life, out)
    ms.run_documents_available(ms.document_stream(spark, landing), ctx, os.path.join(tmp_dir, "ckpt"))
    comps = {r["material_name"]: r for r in dl.read_current(spark, out, "components").collect()}
    assert set(comps) == {"Beton", "Wolle", "Nope"}  # the invalid element is dropped by P11
    assert comps["Beton"]["gwp_absolute"] == 1968324.36 and comps["Beton"]["amortization"] == 50
    assert comps["Nope"]["error_code"] == "INVALID_VOLUME"
    reply = dl.read_all(spark, out, "replies").first()
    assert reply["status"] == "success" and reply["project_id"] == "ifc_haus" and "2 components computed, 1 failed" in reply["message"]
    # the same ids as the batch ingestion (repeatable ids): replays upsert the same rows
    batch_els, _ = ingest.documents_to_tables(readers.read_element_documents(spark, landing))
    streamed_ids = {r["id"] for r in dl.read_current(spark, out, "elements").collect()}
    assert streamed_ids == {r["id"] for r in batch_els.collect()}


def reference(spark):
    import datetime as dt
    mappings = spark.createDataFrame([("Beton", "U1"), ("Wolle", "U2")], "ifc_material string, kbob_id string")
    catalogue = spark.createDataFrame([("U1", "Beton", 1.0, 2.0, 3.0, "v"), ("U2", "Wolle", 4.0, 5.0, 6.0, "v")],
                                      "uuid string, name string, indicator_co2eq double, indicator_penre double, indicator_ubp double, version string")
    versions = spark.createDataFrame([("v", True, dt.date(2024, 1, 1))], "version string, is_active boolean, release_date date")
    life = spark.createDataFrame([("C", "c", 50)], "ebkp_code string, description string, years int")
    cost = spark.createDataFrame([("C", "Wand", "m2", 10.0, "2024")], "ebkp_code string, description string, unit string, cost_per_unit double, version string")
    return mappings, catalogue, versions, life, cost


def element(name, volume=1.0, area=2.0, materials=("Beton",)):
    return {"id": name, "properties": {"ebkp": "C"}, "quantities": {"area": {"net": area}}, "materials": list(materials),
            "material_volumes": {m: {"volume": volume, "density": 100.0} for m in materials}}


def deliver(landing, name, elements):
    import json
    with open(os.path.join(landing, name), "w") as f:
        json.dump({"elements": elements}, f)


def document_context(spark, out):
    mappings, catalogue, versions, life, cost = reference(spark)
    return ms.DocumentContext(lambda: mappings, lambda: catalogue, lambda: versions, lambda: life, out, lambda: cost)


def test_an_emptied_delivery_removes_the_projects_rows(spark, tmp_dir):
    from graustein.sources import readers
    landing, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(landing)
    handler = ms.make_document_handler(document_context(spark, out))
    read = lambda: readers.read_element_documents(spark, landing)
    deliver(landing, "a.json", [element("x"), element("y", materials=("Beton", "Wolle", "Unknown"))])
    deliver(landing, "b.json", [element("z")])
    handler(read(), 0)
    tables = ["elements", "materials", "components", "cost_results", "projects"]
    rows = lambda t, p: dl.read_current(spark, out, t).filter(F.col("project_id") == p).count()
    assert [rows(t, "ifc_a") for t in tables] == [2, 4, 4, 2, 1] and [rows(t, "ifc_b") for t in tables] == [1, 1, 1, 1, 1]
    first = {r["project_id"]: r for r in dl.read_current(spark, out, "projects").collect()}
    assert {p: r["status"] for p, r in first.items()} == {"ifc_a": "completed", "ifc_b": "completed"}
    assert dl.read_all(spark, out, "processing_errors").select("element_id", "error_type").distinct().count() == 1
    # a.json again, with nothing that could be computed
    os.remove(os.path.join(landing, "b.json"))
    deliver(landing, "a.json", [element("x", volume=-1.0)])
    handler(read(), 1)
    assert [rows(t, "ifc_a") for t in tables] == [1, 1, 0, 1, 1] and [rows(t, "ifc_b") for t in tables] == [1, 1, 1, 1, 1]
    second = {r["project_id"]: r for r in dl.read_current(spark, out, "projects").collect()}
    assert second["ifc_a"]["status"] == "failed" and second["ifc_a"]["created_at"] == first["ifc_a"]["created_at"]
    reply = dl.read_all(spark, out, "replies").filter("batch = 1").first()
    assert reply["status"] == "error" and reply["message"] == "No valid elements in a.json"
    # and with no elements at all
    deliver(landing, "a.json", [])
    handler(read(), 2)
    assert [rows(t, "ifc_a") for t in tables] == [0, 0, 0, 0, 1]
    assert dl.read_all(spark, out, "processing_history").count() == 5  # LCA and cost of both, then the costs of one
    assert {r["batch"] for r in dl.read_all(spark, out, "replies").collect()} == {0, 1, 2}  # the log keeps all


def test_a_batch_shows_as_a_whole_or_not_at_all(spark, tmp_dir):
    from graustein.sources import readers
    import pytest
    landing, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(landing)
    deliver(landing, "a.json", [element("x")])
    ctx = document_context(spark, out)
    ms.make_document_handler(ctx)(readers.read_element_documents(spark, landing), 0)
    deliver(landing, "a.json", [element("x"), element("y")])
    broken = document_context(spark, out)
    broken.cost_reference = lambda: spark.createDataFrame([(1,)], "no_such_table int")
    with pytest.raises(Exception, match="ebkp_code|version"):
        ms.make_document_handler(broken)(readers.read_element_documents(spark, landing), 1)
    assert dl.committed(spark, out) == [0]  # elements and components of batch 1 are written, and seen by no reader
    assert dl.read_current(spark, out, "elements").count() == 1 and dl.read_current(spark, out, "components").count() == 1
    ms.make_document_handler(ctx)(readers.read_element_documents(spark, landing), 1)  # replayed
    assert dl.read_current(spark, out, "elements").count() == 2
    ms.make_document_handler(broken)(readers.read_element_documents(spark, landing), 1)  # committed: left as it is
    assert dl.read_current(spark, out, "components").count() == 2


def test_messages_for_projects_without_elements_and_bare_urls(spark, tmp_dir):
    mappings, catalogue, versions, life, cost = reference(spark)
    els = spark.createDataFrame([("e1", "ifc_haus", "C", 2.0, None)], "id string, project_id string, ebkp string, area_net double, length double")
    mats = spark.createDataFrame([("e1", "Beton", 1.0, 100.0)], "element_id string, material_name string, volume double, density double")
    held = {"elements": els}
    ctx = ms.BatchContext(lambda: jobs.LcaInputs(held["elements"], mats, mappings, catalogue, versions, life), tmp_dir, cost_reference=lambda: cost)
    handler = ms.make_batch_handler(ctx)
    handler(spark.createDataFrame([("http://host/bucket/haus.ifc",), (" \t",)], "value string"), 0)
    reply = dl.read_all(spark, tmp_dir, "replies").collect()
    assert [(r["status"], r["project_id"]) for r in reply] == [("success", "ifc_haus")]
    assert dl.read_current(spark, tmp_dir, "components").count() == 1
    # the project's elements are deleted, then its model is announced again
    held["elements"] = els.filter("false")
    handler(spark.createDataFrame([("http://host/bucket/haus.ifc",)], "value string"), 1)
    reply = dl.read_all(spark, tmp_dir, "replies").filter("batch = 1").first()
    assert reply["status"] == "error" and reply["message"] == "No elements for project ifc_haus"
    assert [dl.read_current(spark, tmp_dir, t).count() for t in ("elements", "components", "cost_results")] == [0, 0, 0]
    assert dl.read_current(spark, tmp_dir, "projects").first()["status"] == "failed"
