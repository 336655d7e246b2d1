"""Persisted runs: the component rows are written once to the output folder (which cuts
the lineage, so a lost executor re-reads files instead of recomputing every join) and
errors, statistics, history and the report are derived from the written table.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graustein.operators import combine as cb
from graustein.operators import cost as cost_ops
from graustein.operators import lca as lca_ops
from graustein.operators import maintenance as mt
from graustein.plans import jobs
from graustein.sinks import commits, writers


@dataclass
class RunOutput:
    components: DataFrame
    errors: DataFrame
    stats: DataFrame
    version: str
    counts: dict | None = None   # A14: rows counted during the write
    projects: DataFrame | None = None  # M7: the projects given, with the run's status


def run_lca(spark: SparkSession, inputs: jobs.LcaInputs, out_root: str, run_id: str | None = None,
            projects: DataFrame | None = None) -> RunOutput:
    """C1 with persistence: K4 results, K8 errors, K9 history, all partitioned by project. Of
    ``projects``, those that the run computed are completed afterwards (M7)."""
    t0 = time.time()
    run_id = run_id or writers.run_stamp()
    comps, version = jobs.lca(inputs)
    path = os.path.join(out_root, "lca_components", f"run_id={run_id}")
    counts = Observation("lca_counts")  # A14: counted while writing, no second pass
    writers.write_partitioned(comps, path, ("project_id",), mode="overwrite",
                              observe=(counts, F.count(F.lit(1)).alias("components"),
                                       F.count_if(F.col("failed")).alias("failed")))
    written = writers.read_back(spark, path, comps)
    errors = lca_ops.lca_errors(written)
    stats = lca_ops.lca_run_stats(written, version)
    writers.append_table(writers.results_table(written, version), out_root, "processing_results", run_id)
    writers.append_table(errors, out_root, "processing_errors", run_id)
    writers.append_table(writers.history_rows(stats, time.time() - t0), out_root, "processing_history", run_id)
    return RunOutput(written, errors, stats, version, counts.get, mt.set_statuses(projects, stats) if projects is not None else None)


def run_cost(spark: SparkSession, elements: DataFrame, cost_reference: DataFrame, out_root: str,
             version: str | None = None, run_id: str | None = None, projects: DataFrame | None = None) -> RunOutput:
    """C2 with persistence: ``cost_results`` table, errors and history; ``projects`` get the run's
    status (M7)."""
    t0 = time.time()
    run_id = run_id or writers.run_stamp()
    comps = jobs.cost(elements, cost_reference, version)
    path = os.path.join(out_root, "cost_results", f"run_id={run_id}")
    writers.write_partitioned(comps, path, ("project_id",), mode="overwrite")
    written = writers.read_back(spark, path, comps)
    errors = cost_ops.cost_errors(written)
    stats = cost_ops.cost_run_stats(written)
    writers.append_table(errors, out_root, "processing_errors", f"cost-{run_id}")
    writers.append_table(writers.history_rows(stats, time.time() - t0), out_root, "processing_history", f"cost-{run_id}")
    return RunOutput(written, errors, stats, version or "N/A", projects=mt.set_statuses(projects, stats) if projects is not None else None)


def run_combined(spark: SparkSession, inputs: jobs.LcaInputs, cost_reference: DataFrame, out_root: str,
                 projects: DataFrame | None = None) -> dict:
    """LCA + cost, combined results (K7 JSON), portfolio summary (A5) and report (K6)."""
    lca_run = run_lca(spark, inputs, out_root, projects=projects)
    cost_run = run_cost(spark, inputs.elements, cost_reference, out_root, projects=lca_run.projects)
    # K7: one record per guid (a large one in numbered chunks); the totals come from the flat written rows
    writers.write_json(cb.combined_nested(lca_run.components, cost_run.components), os.path.join(out_root, "combined_results"))
    combined = cb.combine_results(lca_run.components, cost_run.components)
    summary = cb.summarize(combined, count_failed=True)
    writers.write_report(cb.report_lines(summary, cb.failed_components(combined)), os.path.join(out_root, "summary_report"))
    return {"lca": lca_run, "cost": cost_run, "summary": summary, "projects": cost_run.projects}


def load_reference_data(spark: SparkSession, out_root: str, version: str, kbob_csv: str,
                        life_path: str | None = None, cost_csv: str | None = None,
                        description: str | None = None) -> str:
    """Load catalogue, versions, service life and cost keys as one unit.

    Everything is read and checked (P19 keys and NOT NULL) before anything is published;
    then all tables are written as snapshots with the same id. A failed check publishes
    nothing."""
    import datetime as _dt
    from graustein import schemas
    from graustein.operators import catalogue as cat
    from graustein.operators import quality as qa
    from graustein.sources import readers
    tables = {"kbob_materials": readers.read_kbob_csv(spark, kbob_csv, version)}
    tables["kbob_versions"] = spark.createDataFrame(
        [(version, True, _dt.date.today(), description)],
        "version string, is_active boolean, release_date date, description string")
    if life_path:
        tables["life_expectancy"] = readers.read_life_expectancy(spark, life_path)
    if cost_csv:
        tables["cost_reference"] = readers.read_cost_csv(spark, cost_csv, version)
    report = qa.constraint_report(tables, {k: v for k, v in schemas.KEYS.items() if k in tables},
                                  {k: [c for c in schemas.NOT_NULL.get(k, []) if c in tables[k].columns] for k in tables})
    bad = report.filter(F.col("n_violations") > 0)
    failing = bad.collect()  # one row per check
    if failing:
        raise ValueError("reference data violates constraints: " + "; ".join(f"{r['table']} {r['check']} x{r['n_violations']}" for r in failing))
    # M4, M8: other versions stay, the loaded one becomes the active one
    base = commits.state(spark, out_root)
    current = {t: e["snapshot"] for t, e in base[1].items()}
    for name in ("kbob_materials", "cost_reference", "kbob_versions"):
        if name in tables and name in current and "version" in tables[name].columns:
            tables[name] = cat.replace_version(writers.read_current(spark, out_root, name), tables[name], version)
    tables["kbob_versions"] = tables["kbob_versions"].withColumn("is_active", F.col("version") == F.lit(version))
    snapshot = writers.run_stamp()
    for name, df in tables.items():
        writers.write_snapshot(df, out_root, name, snapshot)
    # last: readers see all or nothing, and a loader that was overtaken gets a Conflict
    writers.publish(spark, out_root, {name: snapshot for name in tables}, base)
    return snapshot
