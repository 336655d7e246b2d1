"""Table maintenance (M1-M11) and data quality."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from graustein.operators import catalogue as cat
from graustein.operators import maintenance as mt
from graustein.operators import quality as qa

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def _rows(df, key="id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_upsert_elements_keeps_project_and_last_wins(spark):
    old = spark.createDataFrame([("a", "P1", "C1", T1), ("b", "P1", "C1", T1)], "id string, project_id string, ebkp string, timestamp timestamp")
    batch = spark.createDataFrame([("a", "P9", "C2", T1), ("a", "P9", "C3", T2), ("c", "P2", "E3", T1)], old.schema)
    new = mt.upsert_elements(old, batch)
    got = _rows(new)
    assert got["a"]["project_id"] == "P1" and got["a"]["ebkp"] == "C3"
    assert got["b"]["ebkp"] == "C1" and got["c"]["project_id"] == "P2"
    again = mt.upsert_elements(new, batch)  # idempotent
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_upsert_materials(spark):
    old = spark.createDataFrame([("a", "m", 1.0), ("a", "n", 2.0)], "element_id string, material_name string, volume double")
    new = mt.upsert_materials(old, spark.createDataFrame([("a", "m", 5.0)], old.schema))
    assert {(r["material_name"], r["volume"]) for r in new.collect()} == {("m", 5.0), ("n", 2.0)}


def test_delete_keeps_errors_and_history(spark):
    els = spark.createDataFrame([("a", "P1"), ("b", "P2")], "id string, project_id string")
    mats = spark.createDataFrame([("a", "m"), ("b", "m")], "element_id string, material_name string")
    res = spark.createDataFrame([("a", "m", False), ("b", "m", True)], "element_id string, material_name string, failed boolean")
    e, m, r = mt.delete_project_elements(els, mats, res, "P1")
    assert [x["id"] for x in e.collect()] == ["b"]
    assert [x["element_id"] for x in m.collect()] == ["b"] and [x["element_id"] for x in r.collect()] == ["b"]


def test_project_upsert_and_status(spark):
    projects = spark.createDataFrame([("P1", "one", "failed", T1, T1)],
                                     "project_id string, name string, status string, created_at timestamp, updated_at timestamp")
    p = _rows(mt.upsert_project(projects, "P1", "uno", as_of=T2), "project_id")
    assert p["P1"]["name"] == "uno" and p["P1"]["status"] == "active" and p["P1"]["created_at"] == T1 and p["P1"]["updated_at"] == T2
    p2 = _rows(mt.upsert_project(projects, "P2", "two", as_of=T2), "project_id")
    assert set(p2) == {"P1", "P2"} and p2["P1"]["status"] == "failed" and p2["P2"]["created_at"] == T2
    s = _rows(mt.set_status(projects, "P1", "completed", as_of=T2), "project_id")
    assert s["P1"]["status"] == "completed"
    with pytest.raises(ValueError, match="Invalid status"):
        mt.set_status(projects, "P1", "weird")
    with pytest.raises(ValueError, match="Invalid status"):
        mt.set_statuses(projects, spark.createDataFrame([("P1", "weird")], "project_id string, status string"))


def test_versions(spark):
    versions = spark.createDataFrame([("2023-v1", True, dt.date(2023, 1, 1)), ("2024-v1", False, dt.date(2024, 1, 1))],
                                     "version string, is_active boolean, release_date date")
    assert cat.active_version(versions) == "2023-v1"
    switched = cat.set_active_version(versions, "2024-v1")
    assert cat.active_version(switched) == "2024-v1"
    with pytest.raises(cat.UnknownVersion):
        cat.set_active_version(versions, "2099")
    mats = spark.createDataFrame([("u", "2023-v1"), ("u", "2025-v1")], "uuid string, version string")
    assert [r["version"] for r in cat.missing_versions(mats, versions).collect()] == ["2025-v1"]
    repaired = {r["version"]: r["is_active"] for r in cat.repair_versions(mats, versions).collect()}
    assert repaired == {"2023-v1": False, "2024-v1": False, "2025-v1": True}


def test_replace_version_and_mappings(spark):
    mats = spark.createDataFrame([("u1", "v1"), ("u2", "v2")], "uuid string, version string")
    new = mt.replace_all(mats, mats)
    assert new.count() == 2
    replaced = cat.replace_version(mats, spark.createDataFrame([("u3", "v2")], mats.schema), "v2")
    assert {(r["uuid"], r["version"]) for r in replaced.collect()} == {("u1", "v1"), ("u3", "v2")}
    maps = spark.createDataFrame([("P1", "Beton", "x"), ("P2", "Beton", "y")], "project_id string, ifc_material string, kbob_id string")
    out = mt.replace_project_mappings(maps, "P1", spark.createDataFrame([("Stahl", "z")], "ifc_material string, kbob_id string"), "v2")
    assert {(r["project_id"], r["ifc_material"], r["kbob_version"]) for r in out.collect()} == {("P2", "Beton", None), ("P1", "Stahl", "v2")}


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "y")], "id string, v string")
    assert [r["id"] for r in qa.duplicate_keys(df, ["id"]).collect()] == ["a"]
    assert [(r["column"], r["n_nulls"]) for r in qa.null_violations(df, ["id", "v"]).collect()] == [("v", 1)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert [r["id"] for r in qa.orphans(df, parent, "id", "id").collect()] == ["b"]
    report = {(r["table"], r["check"]): r["n_violations"] for r in
              qa.constraint_report({"t": df, "p": parent}, {"t": ["id"]}, {"t": ["v"]}, [("t", "id", "p", "id")]).collect()}
    assert report == {("t", "primary_key"): 1, ("t", "not_null:v"): 1, ("t", "foreign_key:id->p.id"): 1}
    with pytest.raises(qa.MissingColumns):
        qa.require_columns(df, ["id", "Code"])
    assert qa.check_violations(spark.createDataFrame([("ok",), ("active",)], "status string"), "status",
                               ["active"]).count() == 1


def test_project_lookups(spark):
    from graustein.operators import projects as pr
    maps = spark.createDataFrame([("P1", "Beton", "a", T1), ("P1", "Beton", "b", T2), ("P2", "Holz", "c", T1)],
                                 "project_id string, ifc_material string, kbob_id string, created_at timestamp")
    assert [tuple(r) for r in pr.project_mapping(maps, "P1").collect()] == [("Beton", "b")]
    hist = spark.createDataFrame([(1, "P1", T1), (2, "P1", T2), (3, "P1", T2), (4, "P2", T1)],
                                 "id long, project_id string, created_at timestamp")
    assert pr.latest_of_project(hist, "P1").first()["id"] == 3
    assert {r["project_id"]: r["id"] for r in pr.latest_per_project(hist).collect()} == {"P1": 3, "P2": 4}
    els = spark.createDataFrame([("a", "P1"), ("b", "P2")], "id string, project_id string")
    mats = spark.createDataFrame([("a", "m"), ("b", "n"), ("c", "o")], "element_id string, material_name string")
    p1 = pr.elements_of_project(els, "P1")
    assert [r["id"] for r in p1.collect()] == ["a"]
    assert [r["material_name"] for r in pr.materials_of_elements(mats, p1).collect()] == ["m"]


def test_positional_csv(spark, tmp_dir):
    from graustein.sources import readers
    path = f"{tmp_dir}/cost.csv"
    with open(path, "w") as f:
        f.write("a,b,c,d,e\nC2.1,Wand,m2,120.5,2024\n")
    r = readers.read_positional_csv(spark, path, "cost_reference").first()
    assert (r["ebkp_code"], r["unit"], r["cost_per_unit"], r["version"], r["created_at"]) == ("C2.1", "m2", 120.5, "2024", None)


def test_replace_project_elements(spark):
    els = spark.createDataFrame([("a", "P1", "C1"), ("b", "P2", "C1")], "id string, project_id string, ebkp string")
    mats = spark.createDataFrame([("a", "m", 1.0), ("b", "m", 2.0)], "element_id string, material_name string, volume double")
    res = spark.createDataFrame([("a", "m"), ("b", "m")], "element_id string, material_name string")
    new_e = spark.createDataFrame([("c", "P1", "E3")], els.schema)
    new_m = spark.createDataFrame([("c", "n", 3.0)], mats.schema)
    e, m, r = mt.replace_project_elements(els, mats, res, "P1", new_e, new_m)
    assert sorted(r2["id"] for r2 in e.collect()) == ["b", "c"]
    assert sorted((x["element_id"], x["material_name"]) for x in m.collect()) == [("b", "m"), ("c", "n")]
    assert [x["element_id"] for x in r.collect()] == ["b"]
