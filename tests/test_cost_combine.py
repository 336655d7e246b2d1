"""Cost job (C2, N2, N6), combined results (U1, A9, N16), summary and report."""

import math

import pytest
from pyspark.sql import functions as F

from graustein.operators import combine as cb
from graustein.operators import cost


@pytest.fixture()
def cost_ref(spark):
    return spark.createDataFrame([
        ("C2.1", "Wand", "m2", 120.5, "2024"), ("E3", "Fenster", "m", 80.25, "2024"), ("C02.03", "Stuetze", "stk", 9.0, "2024"),
        ("D1", "a", "m2", 10.0, "2024"), ("D1", "b", "m2", 11.0, "2024"), ("C2.1", "Wand alt", "m2", 99.0, "2023")],
        "ebkp_code string, description string, unit string, cost_per_unit double, version string")


def _elements(spark, rows):
    return spark.createDataFrame(rows, "id string, project_id string, ebkp string, area_net double, length double")


def test_cost_outcomes_in_check_order(spark, cost_ref):
    els = _elements(spark, [("a", "P", " C2.1 ", 10.0, None), ("b", "P", "E3", None, 2.5), ("c", "P", "C02.03", 1.0, 1.0),
                            ("d", "P", "Z9", 1.0, 1.0), ("e", "P", "C2.1", None, 5.0), ("f", "P", "E3", 1.0, -1.0),
                            ("g", "P", "C2.1", math.nan, 1.0), ("h", "P", "D1", 1.0, 1.0), ("i", "P", None, 1.0, 1.0)])
    got = {r["guid"]: r for r in cost.cost_components(els, cost_ref).collect()}
    assert got["a"]["total_cost"] == 1205.0 and got["a"]["unit"] == "m2" and got["a"]["ebkp_h"] == "C2.1"
    assert got["b"]["total_cost"] == pytest.approx(200.63) and got["b"]["unit_cost"] == 80.25
    assert {k: r["error_code"] for k, r in got.items() if r["failed"]} == {
        "c": "UNKNOWN_UNIT", "d": "COST_CODE_NOT_FOUND", "e": "INVALID_QUANTITY", "f": "INVALID_QUANTITY",
        "g": "INVALID_QUANTITY", "h": "AMBIGUOUS_COST_CODE", "i": "COST_CODE_NOT_FOUND"}
    assert got["d"]["error"] == "'Z9'" and got["c"]["error"] == "Unknown unit type: stk"
    assert got["d"]["total_cost"] is None and got["d"]["unit"] is None  # N17


def test_cost_version_choice(spark, cost_ref):
    els = _elements(spark, [("a", "P", "C2.1", 1.0, None)])
    assert cost.cost_components(els, cost_ref, version="2023").first()["unit_cost"] == 99.0
    assert cost.cost_components(els, cost_ref).first()["unit_cost"] == 120.5


def test_cost_stats_status(spark, cost_ref):
    els = _elements(spark, [("a", "P1", "C2.1", 1.0, None), ("b", "P2", "C2.1", 1.0, None), ("c", "P2", "Z", 1.0, 1.0)])
    stats = {r["project_id"]: r for r in cost.cost_run_stats(cost.cost_components(els, cost_ref)).collect()}
    assert stats["P1"]["status"] == "completed" and stats["P2"]["status"] == "failed"
    assert stats["P2"]["failed_elements"] == 1 and stats["P2"]["total_elements"] == 2


def test_cost_file_columns_round_trip(spark):
    from graustein.operators.quality import MissingColumns
    els = _elements(spark, [("a", "P", "C2.1", 1.0, 2.0)]).withColumn("volume_net", F.lit(3.0))
    flat = cost.to_cost_file_columns(els).withColumn("KBOB UUID-Nummer", F.lit("x"))
    back = cost.from_cost_file_columns(flat, "P").first()
    assert (back["id"], back["ebkp"], back["area_net"], back["length"]) == ("a", "C2.1", 1.0, 2.0)
    with pytest.raises(MissingColumns, match="Missing required columns: KBOB UUID-Nummer"):
        cost.from_cost_file_columns(cost.to_cost_file_columns(els))


def _lca_rows(spark, rows):
    return spark.createDataFrame(rows, "project_id string, element_id string, material_name string, ebkp_h string, "
                                       "gwp_absolute double, penr_absolute double, ubp_absolute double, failed boolean, "
                                       "error_message string")


def _cost_rows(spark, rows):
    return spark.createDataFrame(rows, "project_id string, guid string, ebkp_h string, total_cost double, failed boolean, "
                                       "error string")


def test_combined_shared_guid_is_or_of_inputs(spark):
    lca = _lca_rows(spark, [("P", "x", "m1", "C", 1.0, 1.0, 1.0, False, None),
                            ("P", "y", "m1", "C", 1.0, 1.0, 1.0, False, None),
                            ("P", "y", "m2", "C", None, None, None, True, "Invalid volume: 0")])
    cst = _cost_rows(spark, [("P", "x", "C", 10.0, False, None), ("P", "z", "Z", None, True, "'Z'")])
    got = {r["guid"]: (r["n_components"], r["n_failed"], r["shared_guid"]) for r in cb.combined_per_guid(lca, cst).collect()}
    assert got == {"x": (2, 0, False), "y": (2, 1, True), "z": (1, 1, False)}
    flat = cb.combine_results(lca, cst)
    assert flat.count() == 5 and flat.filter(F.col("material") == "Cost Calculation").count() == 2


def test_summary_totals_and_report(spark):
    lca = _lca_rows(spark, [("P", "x", "m1", "C", 1234567.891, 2.0, 3.0, False, None),
                            ("P", "y", "m1", "C", math.nan, None, 1.0, False, None),
                            ("P", "y", "m2", "C", 5.0, 5.0, 5.0, True, "Invalid volume: 0")])
    cst = _cost_rows(spark, [("P", "x", "C", 10.5, False, None), ("P", "z", None, None, True, "'Z'")])
    combined = cb.combine_results(lca, cst)
    s = cb.formatted_summary(cb.summarize(combined)).first()
    assert (s["total_cost"], s["total_co2_emission"], s["total_primary_energy"], s["total_ubp"]) == (10.5, 1234567.891, 2.0, 4.0)
    assert s["total_co2_emission_text"] == "1`234`567,89" and s["total_cost_text"] == "10,50"
    lines = [r["line"] for r in cb.report_lines(cb.summarize(combined), cb.failed_components(combined))
             .orderBy("section", "sort_key").collect()]
    assert lines[:6] == ["\nSummary Report:", "Total Cost: 10,50 Chf", "Total CO₂ Emissions: 1`234`567,89 kg CO₂-eq",
                         "Total Primary Energy (non-renewable): 2,00 kWh oil-eq", "Total UBP: 4,00", "\nFailed Components:"]
    assert lines[6:] == ["- GUID: y, eBKP-H: C, Error: Invalid volume: 0", "- GUID: z, eBKP-H: N/A, Error: 'Z'"]


def test_report_without_failures_has_no_failed_section(spark):
    lca = _lca_rows(spark, [("P", "x", "m1", "C", 1.0, 2.0, 3.0, False, None)])
    combined = cb.combine_results(lca, _cost_rows(spark, [("P", "x", "C", 1.0, False, None)]))
    lines = [r["line"] for r in cb.report_lines(cb.summarize(combined), cb.failed_components(combined)).collect()]
    assert len(lines) == 5 and "\nFailed Components:" not in lines


def test_combined_rows_carry_shared_guid(spark):
    lca = _lca_rows(spark, [("P", "x", "m1", "C", 1.0, 2.0, 3.0, False, None), ("P", "x", "m2", "C", 1.0, 2.0, 3.0, False, None),
                            ("P", "y", "m1", "C", 1.0, 2.0, 3.0, False, None)])
    rows = cb.combined_rows(lca, _cost_rows(spark, [("P", "x", "C", 1.0, False, None), ("P", "z", "C", 1.0, False, None)])).collect()
    assert sorted((r["guid"], r["source"], r["shared_guid"]) for r in rows) == [
        ("x", "cost", True), ("x", "lca", True), ("x", "lca", True), ("y", "lca", False), ("z", "cost", False)]


def test_cost_file_with_snake_case_header(spark, tmp_dir):
    from graustein.sources import readers
    path = f"{tmp_dir}/cost.csv"
    spark.createDataFrame([("a", "1.5", "2", "3", "C2.1")], "id string, volume_net string, length string, area_net string, ebkp string").write.option(
        "header", True).csv(path)
    r = readers.read_cost_elements_csv(spark, path, "P").first()
    assert (r["id"], r["volume_net"], r["length"], r["area_net"], r["ebkp"], r["project_id"]) == ("a", 1.5, 2.0, 3.0, "C2.1", "P")
