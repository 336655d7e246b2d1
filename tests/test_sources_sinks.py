"""Sources (S1-S8, S12, S13) and sinks (K1-K9, snapshots, backup/restore C9)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from graustein import schemas
from graustein.operators import elements as el
from graustein.sinks import writers
from graustein.sources import readers


def test_kbob_csv_latin1(spark, tmp_dir):
    path = os.path.join(tmp_dir, "kbob.csv")
    header = list(readers.KBOB_HEADERS.values())
    with open(path, "w", encoding="ISO-8859-1") as f:
        f.write(",".join(f'"{h}"' for h in header) + "\n")
        f.write(' E13EE05E ,Hochbaubeton (ohne Bewehrung),232.3,402.5,351900,2300\n')
        f.write('43B03F61,Wärmedämmung,340.615,1633.5,623150,n/a\n')
    df = readers.read_kbob_csv(spark, path, "2024-6.2")
    got = {r["uuid"]: r for r in df.collect()}
    assert set(got) == {"E13EE05E", "43B03F61"}
    assert got["43B03F61"]["name"] == "Wärmedämmung" and got["43B03F61"]["density"] == 0.0
    assert got["E13EE05E"]["indicator_co2eq"] == 232.3 and got["E13EE05E"]["version"] == "2024-6.2"


def test_life_and_cost_files(spark, tmp_dir):
    csv_path = os.path.join(tmp_dir, "life.csv")
    with open(csv_path, "w") as f:
        f.write("eBKP-H Code,Description,Years,model-based?\nC2.1,Wand,50,true\n")
    json_path = os.path.join(tmp_dir, "life.json")
    with open(json_path, "w") as f:
        json.dump([{"ebkp_code": "E3", "description": "Fenster", "years": 25}], f)
    a = readers.read_life_expectancy(spark, csv_path).first()
    b = readers.read_life_expectancy(spark, json_path).first()
    assert (a["ebkp_code"], a["years"], a["model_based"]) == ("C2.1", 50, True)
    assert (b["ebkp_code"], b["years"], b["model_based"]) == ("E3", 25, True)
    cost_path = os.path.join(tmp_dir, "cost.csv")
    with open(cost_path, "w") as f:
        f.write("Code,Bezeichnung,reference,Kennwert\nC2.1,Wand,m2,120.5\n")
    c = readers.read_cost_csv(spark, cost_path, "2024").first()
    assert (c["ebkp_code"], c["unit"], c["cost_per_unit"], c["version"]) == ("C2.1", "m2", 120.5, "2024")
    with pytest.raises(readers.UnsupportedFormat):
        readers.load_table(spark, os.path.join(tmp_dir, "x.xlsx"))


def test_element_documents_dict_and_bare_list(spark, tmp_dir):
    d = os.path.join(tmp_dir, "docs")
    os.makedirs(d)
    with open(os.path.join(d, "haus.json"), "w") as f:
        json.dump({"elements": [{"id": "e1", "ifc_class": "IfcWall", "properties": {"ebkp": "C2.1", "loadBearing": True},
                                 "quantities": {"volume": {"net": 2.0}, "area": {"net": 5.0}},
                                 "materials": ["Beton"], "material_volumes": {"Beton": {"volume": 2.0, "density": 2300}}},
                                {"guid": "g2", "materials": [], "material_volumes": {"Holz": {"volume": 1.0}}}],
                   "metadata": {"total_elements": 2}}, f)
    with open(os.path.join(d, "bare.json"), "w") as f:
        json.dump([{"id": "e3", "properties": {"reference": "E3"}}, {"id": ""}], f)
    with open(os.path.join(d, "bad.json"), "w") as f:
        json.dump({"something": 1}, f)
    docs = readers.read_element_documents(spark, d)
    assert el.rejected_documents(docs).count() == 1
    exploded = el.explode_documents(docs)
    els = {r["id"]: r for r in el.flatten_elements(exploded).collect()}
    assert set(els) == {"e1", "g2", "e3"}
    assert els["e1"]["project_id"] == "ifc_haus" and els["e1"]["load_bearing"] and els["e1"]["volume_net"] == 2.0
    assert els["g2"]["ifc_class"] == "Unknown" and els["e3"]["ebkp"] == "E3"
    mats = {(r["element_id"], r["material_name"]): (r["volume"], r["density"]) for r in el.explode_materials(exploded).collect()}
    assert mats == {("e1", "Beton"): (2.0, 2300.0), ("g2", "Holz"): (1.0, 0.0)}


def test_store_and_read_latest(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    df1 = spark.createDataFrame([("P1", "a", 1.0), ("P2", "b", 2.0)], "project_id string, id string, gwp double")
    df2 = spark.createDataFrame([("P1", "a", 9.0)], df1.schema)
    writers.store_results(df1, root, "lca", "m.ifc", run_ts=writers.run_stamp(dt.datetime(2024, 1, 1)))
    writers.store_results(df2, root, "lca", "m.ifc", run_ts=writers.run_stamp(dt.datetime(2024, 1, 2)))
    writers.store_results(df2, root, "lca", "m.ifc.bak", run_ts=writers.run_stamp(dt.datetime(2024, 1, 3)))
    got = {(r["project_id"], r["id"]): r["gwp"] for r in writers.read_latest(spark, root, "lca", filename="m.ifc").collect()}
    assert got == {("P1", "a"): 9.0, ("P2", "b"): 2.0}
    one = writers.read_latest(spark, root, "lca", project_id="P1", filename="m.ifc").collect()
    assert [r["gwp"] for r in one] == [9.0]
    writers.store_results(df2, root, "lca", "m.ifc", run_ts=writers.run_stamp(dt.datetime(2024, 1, 2)))  # replay
    assert spark.read.parquet(root).count() == 4


def test_snapshots(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "x int")
    writers.publish_snapshot(df, tmp_dir, "t", "20240101T000000000001")
    writers.publish_snapshot(df.selectExpr("x + 1 as x"), tmp_dir, "t", "20240101T000000000002")
    assert [r["x"] for r in writers.read_current(spark, tmp_dir, "t").collect()] == [2]


def test_backup_restore_round_trip(spark, tmp_dir):
    ts = dt.datetime(2024, 5, 1, 12, 0)
    elements = spark.createDataFrame(
        [("e1", "IfcWall", None, True, None, "C2.1", 1.0, None, 2.0, None, 3.0, None, None, "P1", ts),
         ("e2", "IfcBeam", "x", None, False, None, None, None, None, None, None, None, None, "P2", ts)], schemas.IFC_ELEMENTS)
    versions = spark.createDataFrame([("v1", True, dt.date(2024, 1, 1), "d", ts)], schemas.KBOB_VERSIONS)
    writers.export_tables({"ifc_elements": elements, "kbob_versions": versions}, tmp_dir)
    back = writers.import_tables(spark, tmp_dir, ["ifc_elements", "kbob_versions"])
    for name, df in (("ifc_elements", elements), ("kbob_versions", versions)):
        assert sorted(map(tuple, back[name].collect())) == sorted(map(tuple, df.collect()))


def test_json_and_report_outputs(spark, tmp_dir):
    with pytest.raises(writers.NothingComputed):
        writers.write_json(spark.createDataFrame([], "a int"), os.path.join(tmp_dir, "empty"))
    writers.write_json(spark.createDataFrame([(1, None)], "a int, b string"), os.path.join(tmp_dir, "j"))
    text = "".join(open(os.path.join(tmp_dir, "j", f)).read() for f in os.listdir(os.path.join(tmp_dir, "j")) if f.endswith(".json"))
    assert '"b":null' in text
    lines = spark.createDataFrame([(6, "b", "- second"), (0, "", "Summary Report:"), (6, "a", "- first")],
                                  "section int, sort_key string, line string")
    writers.write_report(lines, os.path.join(tmp_dir, "r"))
    parts = sorted(f for f in os.listdir(os.path.join(tmp_dir, "r")) if f.startswith("part-"))
    text = [ln for p in parts for ln in open(os.path.join(tmp_dir, "r", p)).read().splitlines()]
    assert text == ["Summary Report:", "- first", "- second"]


def test_results_table_projection(spark):
    comps = spark.createDataFrame([("P", "e", "m", "uuid1", None, 1.0, False, None), ("P", "e", "n", None, None, None, True, "bad")],
                                  "project_id string, element_id string, material_name string, kbob_uuid string, "
                                  "kbob_version string, gwp_absolute double, failed boolean, error_message string")
    rows = {r["material_name"]: r for r in writers.results_table(comps, "v1").collect()}
    assert rows["m"]["kbob_uuid"] == "uuid1" and rows["m"]["error"] is None and rows["m"]["kbob_version"] == "v1"
    assert rows["n"]["kbob_uuid"] == "" and rows["n"]["error"] == "bad"


def test_synthetic_elements(spark):
    df = readers.synthetic_elements(spark, n=1000, seed=0)
    r = df.agg(F.count("*").alias("n"), F.min("Density (kg/m³)").alias("dmin"), F.max("Volume").alias("vmax"),
               F.countDistinct("GUID").alias("g")).first()
    assert r["n"] == 1000 and r["dmin"] >= 400 and r["vmax"] <= 100 and r["g"] == 11
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, readers.synthetic_elements(spark, n=1000, seed=0).collect()))


def test_ingest_twice_is_idempotent(spark, tmp_dir):
    from graustein.plans import ingest
    d = os.path.join(tmp_dir, "docs")
    os.makedirs(d)
    with open(os.path.join(d, "haus.json"), "w") as f:
        json.dump({"elements": [{"id": "w1", "properties": {"ebkp": "C2.1"}, "materials": ["Beton"],
                                 "material_volumes": {"Beton": {"volume": 2.0, "density": 2300}}},
                                {"guid": "g2", "materials": ["Holz"], "material_volumes": {"Holz": {"volume": 1.0}}}]}, f)
    docs = readers.read_element_documents(spark, d)
    ts = dt.datetime(2024, 1, 1)
    projects = spark.createDataFrame([], schemas.PROJECTS)
    elements = spark.createDataFrame([], schemas.IFC_ELEMENTS)
    materials = spark.createDataFrame([], schemas.IFC_ELEMENT_MATERIALS)
    p1, e1, m1 = ingest.ingest(docs, projects, elements, materials, as_of=ts)
    p2, e2, m2 = ingest.ingest(docs, p1, e1, m1, as_of=ts)
    assert e1.count() == 2 and m1.count() == 2 and p1.count() == 1
    for a, b in ((p1, p2), (e1, e2), (m1, m2)):
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert {r["project_id"] for r in e2.collect()} == {"ifc_haus"}


def test_stored_project_ids_keep_their_type(spark, tmp_dir):
    from graustein.sinks import writers
    df = spark.createDataFrame([("007", 1), ("042", 2), ("2024-01-01", 3), (None, 4)], "project_id string, n int")
    writers.write_partitioned(df, f"{tmp_dir}/t", ("project_id",), mode="overwrite")
    assert sorted(map(tuple, writers.read_back(spark, f"{tmp_dir}/t", df).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    writers.store_results(df.filter("project_id is not null"), f"{tmp_dir}/s", "lca", "2024-01-01")
    got = writers.read_latest(spark, f"{tmp_dir}/s", "lca", project_id="007", filename="2024-01-01").collect()
    assert [(r["project_id"], r["filename"], r["n"]) for r in got] == [("007", "2024-01-01", 1)]


def test_current_snapshot_follows_the_publication(spark, tmp_dir):
    from graustein.sinks import writers
    one = spark.createDataFrame([(1,)], "a int")
    writers.publish_snapshot(one, tmp_dir, "t", "1")
    writers.write_snapshot(one.union(one), tmp_dir, "t", "2")
    assert writers.read_current(spark, tmp_dir, "t").count() == 1  # written, not yet published
    writers.publish(spark, tmp_dir, {"t": "2"})
    assert writers.read_current(spark, tmp_dir, "t").count() == 2
    writers.publish_snapshot(one.limit(0), tmp_dir, "t", "3")
    assert writers.read_current(spark, tmp_dir, "t").count() == 0
