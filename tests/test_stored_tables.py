"""Stored tables: numbered commits, buckets rewritten by a batch, exports with their types."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from graustein.operators import maintenance as mt
from graustein.sinks import buckets, commits, writers


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def files(root, table, versions):
    return {f: os.stat(f).st_mtime_ns for b, v in versions.items() for d in [os.path.join(root, table, f"version={v}", f"bucket={b}")]
            for f in (os.path.join(d, n) for n in os.listdir(d) if n.endswith(".parquet"))}


def test_commits_are_numbered_and_the_last_one_counts(spark, tmp_dir):
    assert commits.state(spark, tmp_dir) == (0, {})
    assert commits.commit(spark, tmp_dir, {"a": {"snapshot": "v9"}}) == 1
    assert commits.commit(spark, tmp_dir, {"a": {"snapshot": "v10"}, "b": {"snapshot": "x"}}) == 2
    assert commits.state(spark, tmp_dir) == (2, {"a": {"snapshot": "v10"}, "b": {"snapshot": "x"}})
    # a number that a lost writer took and left half written is passed over
    assert commits.create_if_absent(spark, commits._path(tmp_dir, 3), '{"a": {"snap')
    assert commits.state(spark, tmp_dir)[0] == 2
    assert commits.commit(spark, tmp_dir, {"b": {"snapshot": "y"}}) == 4
    assert writers.published(spark, tmp_dir) == {"a": "v10", "b": "y"}
    assert not commits.create_if_absent(spark, commits._path(tmp_dir, 4), "{}")


def test_two_writers_cannot_overwrite_each_other(spark, tmp_dir):
    commits.commit(spark, tmp_dir, {"a": {"snapshot": "1"}, "b": {"snapshot": "1"}})
    base = commits.state(spark, tmp_dir)
    commits.commit(spark, tmp_dir, {"a": {"snapshot": "2"}}, base)
    with pytest.raises(commits.Conflict, match="'a'"):
        commits.commit(spark, tmp_dir, {"a": {"snapshot": "3"}}, base)
    commits.commit(spark, tmp_dir, {"b": {"snapshot": "2"}}, base)  # another table: no conflict, nothing lost
    assert commits.state(spark, tmp_dir)[1] == {"a": {"snapshot": "2"}, "b": {"snapshot": "2"}}


def test_publish_order(spark, tmp_dir):
    writers.publish_snapshot(spark.createDataFrame([(1,)], "a int"), tmp_dir, "t", "v9")
    writers.publish_snapshot(spark.createDataFrame([(2,)], "a int"), tmp_dir, "t", "v10")
    assert [r["a"] for r in writers.read_current(spark, tmp_dir, "t").collect()] == [2]


def stored(spark, root, n=400, buckets_=16):
    elements = spark.range(n).select(F.concat(F.lit("e"), "id").alias("id"), F.concat(F.lit("P"), F.col("id") % 3).alias("project_id"), F.lit("old").alias("ebkp"))
    materials = spark.range(2 * n).select(F.concat(F.lit("e"), (F.col("id") / 2).cast("long")).alias("element_id"),
                                          F.concat(F.lit("m"), F.col("id") % 2).alias("material_name"), F.col("id").cast("double").alias("volume"))
    buckets.create({"elements": (elements, "id"), "materials": (materials, "element_id")}, root, buckets_)
    return elements, materials


def test_an_upsert_rewrites_the_touched_buckets_only(spark, tmp_dir):
    elements, _ = stored(spark, tmp_dir)
    assert rows(buckets.read(spark, tmp_dir, "elements")) == rows(elements)
    old = commits.state(spark, tmp_dir)[1]["elements"]["versions"]
    before = files(tmp_dir, "elements", old)
    batch = spark.createDataFrame([("e1", "X", "a"), ("e1", "X", "b"), ("e2", "X", "c"), ("new", "X", "d")], "id string, project_id string, ebkp string")
    want = rows(mt.upsert(elements, batch, ["id"], keep_from_old=["project_id"]))
    buckets.upsert(spark, tmp_dir, "elements", batch, ["id"], keep_from_old=["project_id"])
    got = buckets.read(spark, tmp_dir, "elements")
    assert rows(got) == want
    assert {r["ebkp"] for r in got.filter("id = 'e1'").collect()} == {"b"}
    new = commits.state(spark, tmp_dir)[1]["elements"]["versions"]
    touched = {str(r[0]) for r in batch.select(buckets.bucket_of("id", 16)).distinct().collect()}
    assert {b for b in new if new[b] != old.get(b)} == touched and 0 < len(touched) < 16
    after = files(tmp_dir, "elements", new)
    same = {f for f in after if f in before}
    assert all(before[f] == after[f] for f in same)
    assert {f for f in before if f not in after} == {f for f in before if any(f"bucket={b}{os.sep}" in f for b in touched)}


def test_a_batch_reads_only_its_buckets(spark, tmp_dir, capsys):
    stored(spark, tmp_dir)
    one = buckets.read(spark, tmp_dir, "elements", only=[3])
    assert len(one.inputFiles()) == 1 and one.count() > 0
    assert buckets.read(spark, tmp_dir, "elements", only=[]).count() == 0


def test_deleting_elements_takes_their_materials_in_one_commit(spark, tmp_dir):
    elements, materials = stored(spark, tmp_dir)
    number = commits.state(spark, tmp_dir)[0]
    doomed = spark.createDataFrame([("e1",), ("e7",), ("e7",), ("nobody",), (None,)], "id string")
    buckets.delete(spark, tmp_dir, doomed, ["elements", "materials"])
    assert commits.state(spark, tmp_dir)[0] == number + 1
    gone = ["e1", "e7"]
    assert rows(buckets.read(spark, tmp_dir, "elements")) == rows(elements.filter(~F.col("id").isin(gone)))
    assert rows(buckets.read(spark, tmp_dir, "materials")) == rows(materials.filter(~F.col("element_id").isin(gone)))
    assert len(buckets.expired(spark, tmp_dir, "elements")) == 0  # other buckets still use the first version


def test_a_whole_project_replaced(spark, tmp_dir):
    elements, _ = stored(spark, tmp_dir)
    ids = buckets.read(spark, tmp_dir, "elements").select("id")
    buckets.delete(spark, tmp_dir, ids, ["elements"])
    assert buckets.read(spark, tmp_dir, "elements").count() == 0
    buckets.upsert(spark, tmp_dir, "elements", elements, ["id"])
    assert rows(buckets.read(spark, tmp_dir, "elements")) == rows(elements)
    assert len(buckets.expired(spark, tmp_dir, "elements")) == 2


def test_a_batch_that_was_overtaken_is_a_conflict(spark, tmp_dir):
    stored(spark, tmp_dir)
    base = commits.state(spark, tmp_dir)
    batch = spark.createDataFrame([("e1", "X", "a")], "id string, project_id string, ebkp string")
    buckets.upsert(spark, tmp_dir, "elements", batch, ["id"])
    with pytest.raises(commits.Conflict):
        buckets.change(spark, tmp_dir, batch.select("id"), {"elements": lambda old: old}, base)


def test_null_keys_and_taken_names(spark, tmp_dir):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "id string, v int")
    buckets.create({"t": (df, "id")}, tmp_dir, 4)
    buckets.upsert(spark, tmp_dir, "t", spark.createDataFrame([("a", 3)], df.schema), ["id"])
    assert rows(buckets.read(spark, tmp_dir, "t")) == rows(spark.createDataFrame([(None, 1), ("a", 3)], df.schema))
    with pytest.raises(ValueError, match="taken"):
        buckets.create({"u": (df.withColumnRenamed("v", "bucket"), "id")}, tmp_dir, 4)


def test_exports_keep_their_types(spark, tmp_dir):
    df = spark.createDataFrame([("007", "0042", Decimal("1.5")), (None, "2024-01-01", None)], "project_id string, code string, v decimal(9,3)")
    writers.export_tables({"odd": df, "none": df.filter("v > 99")}, tmp_dir)
    back = writers.import_tables(spark, tmp_dir, ["odd", "none"])
    assert back["odd"].dtypes == df.dtypes and rows(back["odd"]) == rows(df) and back["none"].count() == 0
    with pytest.raises(KeyError, match="no schema"):
        writers.import_tables(spark, tmp_dir, ["unknown"])


def test_an_empty_json_result_leaves_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "out")
    with pytest.raises(writers.NothingComputed):
        writers.write_json(spark.range(5).filter("id > 9"), path)
    assert os.listdir(tmp_dir) == []
    writers.write_json(spark.range(2), path)
    writers.write_json(spark.range(3), path)
    assert spark.read.json(path).count() == 3
    with pytest.raises(writers.NothingComputed):
        writers.write_json(spark.range(0), path)
    assert spark.read.json(path).count() == 3  # the earlier result stays
