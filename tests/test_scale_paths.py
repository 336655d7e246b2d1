"""Scale paths: the shuffle fallback for lookups that are not proven small gives the same
rows as the broadcast path, also when one project and one material hold a third of all
rows and AQE splits the skewed partitions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from graustein.operators import lca
from graustein.plans import jobs, registry

SF = "/root/testdata/sf0.001"

FALLBACK = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SKEW = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}


class conf:
    def __init__(self, spark, values):
        self.spark, self.values, self.old = spark, values, {}

    def __enter__(self):
        for k, v in self.values.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def _rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_fallback_join_path_matches_broadcast_path(spark, capsys):
    base = _rows(registry.lca_components(spark, SF))
    with conf(spark, FALLBACK):
        df = registry.lca_components(spark, SF)
        df.explain()
        plan = capsys.readouterr().out
        got = _rows(df)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert got == base


def test_hot_project_and_material(spark):
    n = 30000
    rows = spark.range(n).select("id", (F.col("id") / 3).cast("long").alias("k"))  # 3 layers per element
    elements = (rows.select("k").distinct()
                .select(F.concat(F.lit("e"), F.col("k").cast("string")).alias("id"),
                        F.when(F.col("k") % 3 == 0, F.lit("HOT"))  # a third of all elements and rows
                        .otherwise(F.concat(F.lit("P"), (F.col("k") % 97).cast("string"))).alias("project_id"),
                        F.lit("C2.1").alias("ebkp")))
    materials = rows.select(F.concat(F.lit("e"), F.col("k").cast("string")).alias("element_id"),
                            F.when(F.col("id") % 3 == 0, F.lit("Beton"))  # a third of all rows: one material
                            .otherwise(F.concat(F.lit("m"), (F.col("id") % 50).cast("string"))).alias("material_name"),
                            (F.col("id") % 7 + 1).cast("double").alias("volume"), F.lit(2300.0).alias("density"))
    mappings = spark.range(50).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("ifc_material"),
                                      F.concat(F.lit("K"), (F.col("id") % 10).cast("string")).alias("kbob_id")) \
        .unionByName(spark.createDataFrame([("Beton", "K1")], "ifc_material string, kbob_id string"))
    catalogue = spark.range(9).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("uuid"),
                                      F.lit("mat").alias("name"), (F.col("id") + 1).cast("double").alias("indicator_co2eq"),
                                      F.lit(1.0).alias("indicator_penre"), F.lit(10.0).alias("indicator_ubp"),
                                      F.lit("v").alias("version"))
    versions = spark.createDataFrame([("v", True, dt.date(2024, 1, 1))], "version string, is_active boolean, release_date date")
    life = spark.createDataFrame([("C2.1", "a", 40)], "ebkp_code string, description string, years int")
    inputs = jobs.LcaInputs(elements, materials, mappings, catalogue, versions, life)
    comps, _ = jobs.lca(inputs)
    base = _rows(lca.project_impacts(comps))
    with conf(spark, {**FALLBACK, **SKEW}):
        comps2, _ = jobs.lca(jobs.LcaInputs(elements, materials, mappings, catalogue, versions, life))
        got = _rows(lca.project_impacts(comps2))
        assert comps2.filter("failed").count() == comps.filter("failed").count()
    assert got == base
    for salted in ({**FALLBACK, "graustein.skew.salts": "8"},):
        with conf(spark, salted):
            comps3, _ = jobs.lca(jobs.LcaInputs(elements, materials, mappings, catalogue, versions, life))
            assert "_salt" in comps3._jdf.queryExecution().optimizedPlan().toString()
            assert _rows(lca.project_impacts(comps3)) == base
            assert _rows(comps3) == _rows(comps)
    hot = comps.filter("project_id = 'HOT'").count()
    assert hot >= n // 3 and comps.count() == n


def _plan(df, capsys, mode="formatted"):
    df.explain(mode)
    return capsys.readouterr().out


def test_no_python_in_any_plan_and_one_fact_scan(spark, capsys):
    skip = {"stream_replies", "persisted_lca_results", "stored_latest_results", "catalogue_csv_round_trip", "backup_round_trip",
            "stream_redelivery", "bucketed_upsert", "bucketed_delete", "lca_bucketed", "published_in_order",
            "lca_nested", "combined_nested", "elements_from_json", "materials_from_json",
            "tables_by_extension", "positional_csv", "life_expectancy_files", "cost_csv", "mapping_files", "cost_elements_csv", "run_tables",
            "catalogue_loaded", "stream_restarted", "quarantined_rows", "remap_difference"}  # write while built
    for name, fn in registry.QUERIES.items():
        if name in skip:
            continue
        plan = _plan(fn(spark, SF), capsys, "simple")
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
    plan = _plan(registry.lca_components(spark, SF), capsys)
    # the material rows and, with one column less, the ids of valid elements; elements are read once
    assert plan.count("/lineitem.parquet]") == 2 and plan.count("/orders.parquet]") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_catalogue_version_prunes_partitions(spark, capsys, tmp_dir):
    from graustein.sources import fixtures as fx
    path = f"{tmp_dir}/kbob"
    fx.kbob_materials(spark, SF).write.partitionBy("version").parquet(path)
    inputs = registry.lca_inputs(spark, SF)
    inputs.catalogue = spark.read.parquet(path)
    comps, _ = jobs.lca(inputs)
    plan = _plan(comps, capsys)
    assert "PartitionFilters: [isnotnull(version" in plan and "2024-v1" in plan
    assert _rows(comps) == _rows(registry.lca_components(spark, SF))


def test_cost_and_classification_salted_paths(spark):
    import __spark_entry__ as entry
    names = ["cost_components", "classification_mapper", "classification_classifier"]
    base = {n: _rows(entry.queries()[n](spark, SF)) for n in names}
    with conf(spark, {**FALLBACK, "graustein.skew.salts": "4"}):
        for n in names:
            assert _rows(entry.queries()[n](spark, SF)) == base[n], n


def test_bucketed_tables_need_no_shuffle_of_the_facts(spark, capsys):
    inputs = registry.bucketed_inputs(spark, SF)
    comps, _ = jobs.lca(inputs)
    plan = _plan(comps, capsys)
    assert "SortMergeJoin" not in plan  # every lookup is broadcast: nothing shuffles the facts
    scans = [part for part in plan.split("\n\n") if "Scan parquet" in part.strip().split("\n")[0] and "/materials]" in part]
    # the rows are read once; the ids of valid elements come from two columns of them
    assert sorted("material_name" in s.split("ReadSchema")[1] for s in scans) == [False, True]
    with conf(spark, FALLBACK):  # with no side small enough for a broadcast
        large = _plan(jobs.lca(registry.lca_inputs(spark, SF))[0], capsys, "simple")
        stored = _plan(jobs.lca(inputs)[0], capsys, "simple")
    keys = ("hashpartitioning(element_id", "hashpartitioning(id")
    assert any(k in large for k in keys) and not any(k in stored for k in keys)
    assert "SelectedBucketsCount: 8 out of 8" in plan and "lineitem" not in plan
    assert _rows(comps) == _rows(registry.lca_components(spark, SF))
