"""input that several steps need is built once; violations that say so themselves aren't joined."""

from pyspark.sql import functions as F

from graustein.operators import quality as qa
from graustein.plans import jobs, registry

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_both_deliveries_read_stored_materials(spark, monkeypatch):
    read, lca = [], jobs.lca
    monkeypatch.setattr(jobs, "lca", lambda inputs, *a, **k: (read.append(inputs.materials.inputFiles()), lca(inputs, *a, **k))[1])
    registry.QUERIES["stream_redelivery"](spark, SMALL)
    assert len(read) == 2 and read[0] and read[0] == read[1]
    assert not any("lineitem" in f for files in read for f in files)


def test_materials_with_violations_are_made_in_one_pass(spark):
    mats = registry.dirty_tables(spark, SMALL)["tables"]["materials"]
    assert plan(mats).count("l_quantity#") and "Union" not in plan(mats)
    from graustein.sources import fixtures as fx
    base = fx.element_materials(spark, SMALL)
    want = base.count() + base.filter("volume <= 0").count()
    assert mats.count() == want
    assert mats.filter("element_id LIKE 'X%'").count() == base.filter("volume < 0").count() > 0


def test_null_and_check_rows_are_quarantined_without_a_join(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, -1), (2, None, -1), (3, "b", None), (None, "c", -2)], "id long, name string, n long")
    parts = dict(keys={}, not_null={"t": ["id", "name"]}, checks={"t": [("n", F.col("n") > 0)]})
    got = qa.quarantine({"t": df}, **parts)
    assert "Join" not in plan(got)
    rows = sorted((r["check"], r["key"], r["record"]) for r in got.collect())
    assert rows == sorted([
        ("not_null:name", "", '{"id":2,"n":-1}'), ("not_null:name", "", '{"id":2,"n":-1}'), ("not_null:id", "", '{"name":"c","n":-2}'),
        ("check:n", "", '{"id":2,"n":-1}'), ("check:n", "", '{"id":2,"n":-1}'), ("check:n", "", '{"name":"c","n":-2}')])
    some = qa.violations({"t": df}, **parts).filter("check = 'check:n'")
    assert {r["check"] for r in qa.quarantine({"t": df}, **parts, found=some).collect()} == {"check:n"}
    keyed = qa.quarantine({"t": df}, keys={"t": ["id"]}, not_null={"t": ["name"]})
    assert sorted(r["check"] for r in keyed.collect()) == ["not_null:name"] * 2 + ["primary_key"] * 2
    assert qa.quarantine({"t": df.limit(0)}, **parts).count() == 0
