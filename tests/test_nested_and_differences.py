"""Nested records in chunks, the run log, constraints in one pass, remapping by difference."""

import os

from pyspark.sql import functions as F

from graustein.operators import combine as cb
from graustein.operators import lca as lca_ops
from graustein.operators import quality as qa
from graustein.plans import jobs, registry
from graustein.sinks import writers

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


# ------------------------------------------------------------------ nested records

def components(spark, sizes, copies=1):
    each = [("P", g, f"m{i:05d}", float(i), i % 3 == 0) for g, n in sizes.items() for i in range(n) for _ in range(copies)]
    return spark.createDataFrame(each, "project_id string, guid string, material string, gwp double, failed boolean").repartition(4)


def test_a_hot_guid_is_nested_in_numbered_chunks(spark):
    df = components(spark, {"hot": 5000, "a": 3, "b": 1})
    got = cb.nested(df, chunk=100).collect()
    hot = [r for r in got if r["guid"] == "hot"]
    assert {r["n_chunks"] for r in hot} == {50} and sorted(r["chunk"] for r in hot) == list(range(50))
    assert max(len(r["components"]) for r in hot) < 200  # about 100 each; no task holds all
    assert sorted(c["material"] for r in hot for c in r["components"]) == [f"m{i:05d}" for i in range(5000)]
    small = {r["guid"]: r for r in got if r["guid"] != "hot"}
    assert [c["material"] for c in small["a"]["components"]] == ["m00000", "m00001", "m00002"] and small["a"]["n_chunks"] == 1
    assert small["a"]["shared_guid"] and not small["b"]["shared_guid"] and all(r["shared_guid"] for r in hot)


def test_equal_components_are_kept_and_spread(spark):
    df = components(spark, {"g": 1}, copies=600)
    got = cb.nested(df, chunk=50).collect()
    assert sum(len(r["components"]) for r in got) == 600 and {r["n_components"] for r in got} == {600}
    assert max(len(r["components"]) for r in got) < 150


def test_nested_with_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "g", "m", 1.0), ("P", None, "m", 1.0), ("P", None, None, None)], "project_id string, guid string, material string, gwp double")
    got = {(r["project_id"], r["guid"]): r["n_components"] for r in cb.nested(df).collect()}
    assert got == {(None, "g"): 1, ("P", None): 2}
    assert cb.nested(df.filter("false")).collect() == []


def test_combined_record_has_both_kinds(spark):
    lca = spark.createDataFrame([("P", "e", "Beton", "C", 1.0, 1.0, 1.0, False, None), ("P", "e", "Holz", "C", None, None, None, True, "no")],
                                "project_id string, element_id string, material_name string, ebkp_h string, gwp_absolute double, penr_absolute double, ubp_absolute double, failed boolean, error_message string")
    cost = spark.createDataFrame([("P", "e", "C", 5.0, False, None), ("P", "f", "C", 6.0, False, None)],
                                 "project_id string, guid string, ebkp_h string, total_cost double, failed boolean, error string")
    got = {r["guid"]: r for r in cb.combined_nested(lca, cost).collect()}
    assert [(c["material"], c["total_cost"], c["error"]) for c in got["e"]["components"]] == [("Beton", None, None), ("Cost Calculation", 5.0, None), ("Holz", None, "no")]
    assert got["e"]["shared_guid"] and not got["f"]["shared_guid"]


# ------------------------------------------------------------------ run log

def test_unfinished_runs_are_not_seen(spark, tmp_dir):
    df = spark.createDataFrame([("P1", 1), ("P2", 2)], "project_id string, v int")
    writers.store_results(df, tmp_dir, "lca", "a.ifc", "20240101T0")
    # a run that was lost before its log entry: its rows are there
    lost = df.withColumn("v", F.lit(99)).withColumn("data_type", F.lit("lca")).withColumn("filename", F.lit("a.ifc")).withColumn("run_ts", F.lit("20240102T0"))
    writers.write_partitioned(lost, tmp_dir, writers.STORE_PARTITIONS, mode="overwrite")
    assert sorted(r["v"] for r in writers.read_latest(spark, tmp_dir, "lca").collect()) == [1, 2]
    # a later run of one project replaces that project's rows only
    writers.store_results(df.filter("v = 2").withColumn("v", F.lit(7)), tmp_dir, "lca", "a.ifc", "20240103T0")
    assert sorted(r["v"] for r in writers.read_latest(spark, tmp_dir, "lca").collect()) == [1, 7]
    writers.store_results(df, tmp_dir, "cost", "a.ifc", "20240104T0")
    assert sorted(r["v"] for r in writers.read_latest(spark, tmp_dir, "lca", project_id="P2").collect()) == [7]
    assert writers.run_log(spark, tmp_dir).count() == 5
    writers.store_results(df, tmp_dir, "cost", "a.ifc", "20240104T0")  # stored again
    assert writers.run_log(spark, tmp_dir).count() == 5


def test_the_latest_run_is_found_in_the_log(spark, tmp_dir, capsys):
    df = spark.createDataFrame([("P1", 1)], "project_id string, v int")
    writers.store_results(df, tmp_dir, "lca", "a.ifc", "20240101T0")
    writers.read_latest(spark, tmp_dir, "lca").explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("ReadSchema: struct<v:int>") == 1 and writers.RUN_LOG in plan  # the rows are read once, with the log's folders only
    assert "dynamicpruning" in plan
    assert "PartitionFilters: [isnotnull(data_type" in plan


# ------------------------------------------------------------------ constraints

def dirty(spark):
    parents = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", -1)], "id string, v int")
    children = spark.createDataFrame([("a", "x"), ("zz", "x"), ("zz", "y"), (None, "x"), ("b", None)], "parent string, name string")
    return dict(tables={"parents": parents, "children": children}, keys={"parents": ["id"], "children": ["parent", "name"]},
                not_null={"parents": ["id"], "children": ["name", "no_such_column"]}, fks=[("children", "parent", "parents", "id")],
                checks={"parents": [("positive", F.col("v") > 0)]})


def test_all_constraints_in_one_pass(spark, capsys):
    got = {(r["table"], r["check"]): r["n_violations"] for r in qa.constraint_report(**dirty(spark)).collect()}
    assert got == {("parents", "primary_key"): 1, ("children", "primary_key"): 0, ("parents", "not_null:id"): 1, ("children", "not_null:name"): 1,
                   ("parents", "check:positive"): 1, ("children", "foreign_key:parent->parents.id"): 2}
    qa.violations(**dirty(spark)).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_quarantined_rows_carry_their_reasons(spark):
    got = sorted((r["check"], r["record"]) for r in qa.quarantine(**dirty(spark)).collect())
    assert got == [("check:positive", '{"id":"b","v":-1}'), ("foreign_key:parent->parents.id", '{"parent":"zz","name":"x"}'),
                   ("foreign_key:parent->parents.id", '{"parent":"zz","name":"y"}'), ("not_null:id", '{"v":3}'), ("not_null:name", '{"parent":"b"}'),
                   ("primary_key", '{"id":"a","v":1}'), ("primary_key", '{"id":"a","v":2}')]


def test_keys_with_nulls_in_other_places_differ(spark):
    t = spark.createDataFrame([(None, "x"), ("x", None), (None, "x")], "a string, b string")
    got = qa.violations({"t": t}, {"t": ["a", "b"]}, {}).collect()
    assert [(r["key"], r["n"]) for r in got] == [('{"b":"x"}', 2)]


# ------------------------------------------------------------------ remapping by difference

def test_difference_gives_what_a_full_recomputation_gives(spark):
    inputs = registry.lca_inputs(spark, SF)
    old = inputs.mappings.select(F.lit("P5").alias("project_id"), "ifc_material", "kbob_id")
    stored = registry.lca_components(spark, SF).filter("project_id = 'P5'").cache()
    names = [r[0] for r in old.select("ifc_material").distinct().orderBy("ifc_material").collect()]
    kept, moved, gone = names[::3], names[1::3], names[2::3]
    new = old.filter(F.col("ifc_material").isin(kept + moved)).select(
        "ifc_material", F.when(F.col("ifc_material").isin(moved), F.concat(F.lit("0"), "kbob_id")).otherwise(F.col("kbob_id")).alias("kbob_id"))
    d = jobs.remap_difference(inputs, "P5", new, old, stored, lca_ops.project_impacts(stored))
    assert {r[0] for r in d.materials.collect()} == set(moved) | set(gone)
    _, full = jobs.remap_and_recompute(inputs, "P5", new, old)
    after = stored.join(d.materials, "material_name", "left_anti").select(*stored.columns).unionByName(d.components)
    assert rows(after) == rows(full)
    assert 0 < d.components.count() < stored.count()
    assert rows(d.totals) == rows(lca_ops.project_impacts(full))
    # nothing changed: nothing is computed
    same = jobs.remap_difference(inputs, "P5", old.select("ifc_material", "kbob_id"), old, stored, lca_ops.project_impacts(stored))
    assert same.components.count() == 0 and rows(same.totals) == rows(lca_ops.project_impacts(stored))


def test_own_mappings_come_before_shared_ones(spark):
    m = spark.createDataFrame([("P", "a", "own"), (None, "a", "shared"), (None, "b", "shared"), ("Q", "b", "other"), ("P", "c", " ")],
                              "project_id string, ifc_material string, kbob_id string")
    got = {r["material_name"]: r["kbob_id"] for r in lca_ops.resolved_mapping(m, "P").collect()}
    assert got == {"a": "own", "b": "shared"}


def test_mappings_in_use_take_the_last_row(spark):
    from graustein.operators import projects as pr
    import datetime as dt
    t = lambda d: dt.datetime(2024, 1, d)
    mats = spark.createDataFrame([("e", "wood"), ("e", "steel")], "element_id string, material_name string")
    els = spark.createDataFrame([("e", "P")], "id string, project_id string")
    m = spark.createDataFrame([("P", "wood", "k1", t(1)), ("P", "wood", "", t(2)), ("P", "steel", "k2", t(1)), ("P", "steel", "k3", t(2))],
                              "project_id string, ifc_material string, kbob_id string, created_at timestamp")
    assert [tuple(r) for r in pr.project_mappings_in_use(m, mats, els).collect()] == [("P", "steel", "k3")]
    # without times the greatest id of a material counts
    assert sorted(tuple(r) for r in pr.project_mappings_in_use(m.drop("created_at", "project_id"), mats, els).collect()) == [("P", "steel", "k3"), ("P", "wood", "k1")]


def test_json_output_of_a_run_is_nested(spark, tmp_dir):
    path = os.path.join(tmp_dir, "out")
    records = cb.lca_nested(registry.lca_components(spark, SF))
    writers.write_json(records, path)
    back = spark.read.schema(records.schema).json(path)
    assert back.count() == registry.lca_components(spark, SF).select("project_id", "element_id").distinct().count()


def test_runs_set_the_status_of_their_projects(spark, tmp_dir):
    from graustein.plans import runs
    from graustein.sources import fixtures as fx
    projects = (fx.projects(spark, SF).withColumn("updated_at", F.lit(None).cast("timestamp"))
                .unionByName(spark.createDataFrame([("empty", "x", 60, "v", "active", None)], "project_id string, name string, life_expectancy int, kbob_version string, status string, updated_at timestamp")))
    inputs = registry.lca_inputs(spark, SF)
    lca_run = runs.run_lca(spark, inputs, tmp_dir, run_id="r", projects=projects)
    assert {r["project_id"]: r["status"] for r in lca_run.projects.collect()}["empty"] == "active"
    assert {r["status"] for r in lca_run.projects.filter("project_id <> 'empty'").collect()} == {"completed"}
    cost_run = runs.run_cost(spark, inputs.elements, fx.cost_reference(spark), tmp_dir, run_id="r", projects=lca_run.projects)
    want = {r["project_id"]: r["status"] for r in cost_run.stats.collect()}
    assert {r["project_id"]: r["status"] for r in cost_run.projects.collect()} == {**want, "empty": "active"} and "failed" in want.values()


def test_large_guids_are_dealt_over_groups_and_numbered_once(spark):
    df = components(spark, {"hot": 300, "warm": 40, "a": 3}).unionByName(components(spark, {"same": 1}, copies=130)).unionByName(
        spark.createDataFrame([(None, "g", f"m{i}", 1.0, True) for i in range(70)], "project_id string, guid string, material string, gwp double, failed boolean"))
    flags = spark.createDataFrame([("P", "hot", True), ("P", "a", False), ("P", "a", False), (None, "g", False), (None, "g", True)], "project_id string, guid string, shared_guid boolean")

    def whole(records):
        out = {}
        for r in records:
            assert len(r["components"]) <= 2 * 14 and 0 <= r["chunk"] < r["n_chunks"] == -(-r["n_components"] // 7)
            held = out.setdefault((r["project_id"], r["guid"], r["shared_guid"], r["n_components"]), ([], []))
            held[0].append(r["chunk"])
            held[1].extend(map(repr, r["components"]))
        assert all(len(c) == len(set(c)) for c, _ in out.values())
        return {k: sorted(c) for k, (_, c) in out.items()}
    for shared in (None, flags):
        got = whole(cb.nested(df, shared, chunk=7, met=50).collect())
        assert got == whole(cb.nested(df, shared, chunk=7).collect()) and sum(k[3] for k in got if k[:3] != (None, "g", True) or shared is None) == 543
    assert len(got["P", "a", False, 3]) == 6 and len(got[None, "g", True, 70]) == len(got[None, "g", False, 70]) == 70


def test_component_rows_are_shuffled_once(spark, capsys):
    cb.nested(components(spark, {"a": 3}).cache()).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("hashpartitioning(_id#") == 1 and "Join" not in plan


# ------------------------------------------------------------------ combined records from rows that are computed once

LCA_ROWS = "project_id string, element_id string, material_name string, ebkp_h string, gwp_absolute double, penr_absolute double, ubp_absolute double, failed boolean, error_message string"
COST_ROWS = "project_id string, guid string, ebkp_h string, total_cost double, failed boolean, error string"


def both_kinds(spark):
    of_lca = lambda p, g, n: [(p, g, f"m{i:03d}", "C", float(i), 1.0, 1.0, i % 3 == 0, "no" if i % 3 == 0 else None) for i in range(n)]
    of_cost = lambda p, g, n: [(p, g, "C", float(i), False, None) for i in range(n)]
    sizes = {("P", "a"): (2, 1), ("P", "b"): (1, 1), ("P", "c"): (0, 1), ("P", "d"): (3, 0), ("P", "e"): (2, 2), ("P", "f"): (1, 3), ("P", "g"): (0, 2),
             ("P", "h"): (1, 0), (None, "a"): (2, 1), (None, "b"): (1, 2), (None, None): (3, 2), ("P", None): (1, 1), ("Q", None): (0, 2), (None, "c"): (2, 0),
             ("P", "hot"): (120, 1), ("P", "hotter"): (90, 2), (None, "hot"): (70, 3), ("P", "costly"): (1, 80)}
    return (spark.createDataFrame([r for (p, g), (n, _) in sizes.items() for r in of_lca(p, g, n)], LCA_ROWS).repartition(3),
            spark.createDataFrame([r for (p, g), (_, n) in sizes.items() for r in of_cost(p, g, n)], COST_ROWS).repartition(3))


def test_flags_follow_from_the_components_of_both_kinds(spark):
    lca, cost = both_kinds(spark)
    shared = cb._counts_per_guid(lca, cost).select("project_id", "guid", (F.col("n_lca") > 1).alias("shared_guid"))

    def whole(records):
        out = {}
        for r in records.collect():
            out.setdefault((r["project_id"], r["guid"], r["shared_guid"], r["n_components"], r["n_chunks"]), []).extend(map(repr, r["components"]))
        return {k: sorted(v) for k, v in out.items()}
    want = whole(cb.nested(cb.combine_results(lca, cost), shared, chunk=7))
    assert whole(cb.combined_nested(lca, cost, chunk=7)) == want and len(want) > 18  # a null id can have both flags
    assert whole(cb.nested(cb.combine_results(lca, cost), by_source=True, chunk=7, met=50)) == want


def test_combined_components_are_computed_once(spark, tmp_dir):
    import shutil
    lca, cost = both_kinds(spark)
    lca.write.parquet(f"{tmp_dir}/lca")
    cost.write.parquet(f"{tmp_dir}/cost")
    records = cb.combined_nested(spark.read.parquet(f"{tmp_dir}/lca"), spark.read.parquet(f"{tmp_dir}/cost"))
    shutil.rmtree(f"{tmp_dir}/lca")
    shutil.rmtree(f"{tmp_dir}/cost")
    assert records.agg(F.sum(F.size("components"))).first()[0] >= lca.count() + cost.count()


def test_only_named_catalogue_rows_are_needed_and_copies_go(spark):
    from graustein.session import checkpoint_dir
    inputs = registry.lca_inputs(spark, SF)
    named = lca_ops.named_by(inputs.catalogue, inputs.mappings)
    assert named.count() < inputs.catalogue.count() and named.columns == inputs.catalogue.columns
    want = rows(jobs.lca(inputs)[0])
    inputs.catalogue = named
    assert rows(jobs.lca(inputs)[0]) == want
    held = lambda: {*os.listdir(os.path.join(checkpoint_dir(spark).removeprefix("file://"), "tables"))}
    from graustein.session import written_copy
    written_copy(spark.range(1), "any")  # the folder is there
    before = held()
    assert registry.QUERIES["combined_nested"](spark, SF).count() > 0
    new = {name.split("-")[0] for name in held() - before}
    assert "components" in new and new.isdisjoint({"materials", "mappings", "catalogue"})
