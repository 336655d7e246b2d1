"""LCA job (C1): golden values from the reference's test document, check order (N1),
NaN/null (N3, N4), service life (N5), validation (P11), nesting (A8), statistics (A7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from graustein.operators import catalogue as cat
from graustein.operators import elements as el
from graustein.operators import lca
from graustein.plans import jobs

BETON, GLASWOLLE, ASPHALT = ("E13EE05E-FD34-4FB5-A178-0FC4164A96F2", "43B03F61-91A1-438E-B958-6E274F13B241",
                             "B0C749DA-292B-417D-8E38-65766E052FBC")


@pytest.fixture()
def reference(spark):
    catalogue = spark.createDataFrame([
        (ASPHALT, "Gussasphalt, 27.5 mm", 5785.45, 26690.0, 10126500.0, 2400.0, "2024-6.2"),
        (GLASWOLLE, "Glaswolle", 340.615, 1633.5, 623150.0, 30.0, "2024-6.2"),
        (BETON, "Hochbaubeton (ohne Bewehrung)", 232.3, 402.5, 351900.0, 2300.0, "2024-6.2"),
    ], "uuid string, name string, indicator_co2eq double, indicator_penre double, indicator_ubp double, "
       "density double, version string")
    versions = spark.createDataFrame([("2024-6.2", True, dt.date(2024, 6, 1))],
                                     "version string, is_active boolean, release_date date")
    life = spark.createDataFrame([(c, f"d{c}", y) for c, y in [("C", 50), ("D", 30), ("E", 25), ("G", 40), ("I", 35)]],
                                 "ebkp_code string, description string, years int")
    mappings = spark.createDataFrame([("Beton", BETON), ("Wärmedämmung", GLASWOLLE)], "ifc_material string, kbob_id string")
    return catalogue, versions, life, mappings


def _inputs(spark, reference, elements, materials):
    catalogue, versions, life, mappings = reference
    return jobs.LcaInputs(elements, materials, mappings, catalogue, versions, life)


def _tables(spark, rows):
    """rows: (id, project, ebkp, material, volume, density)"""
    els = spark.createDataFrame(sorted({(r[0], r[1], r[2]) for r in rows}), "id string, project_id string, ebkp string")
    mats = spark.createDataFrame([(r[0], r[3], r[4], r[5]) for r in rows],
                                 "element_id string, material_name string, volume double, density double")
    return els, mats


def test_golden_values_of_the_reference_document(spark, reference):
    els, mats = _tables(spark, [("test_beam_1", "P", "C", "Beton", 3.684, 2300.0),
                                ("test_wall_1", "P", "D", "Wärmedämmung", 86.392, 30.0),
                                ("test_invalid_guid", "P", "Z", "NonexistentMaterial", -1.0, None)])
    comps, version = jobs.lca(_inputs(spark, reference, els, mats))
    assert version == "2024-6.2"
    got = {r["element_id"]: r for r in comps.collect()}
    assert set(got) == {"test_beam_1", "test_wall_1"}  # P11 drops the invalid element
    beam, wall = got["test_beam_1"], got["test_wall_1"]
    assert beam["amortization"] == 50 and wall["amortization"] == 30
    assert beam["gwp_absolute"] == pytest.approx(1968324.360) and beam["gwp_relative"] == pytest.approx(39366.487)
    assert beam["penr_absolute"] == pytest.approx(3410463.000) and beam["penr_relative"] == pytest.approx(68209.260)
    assert beam["ubp_absolute"] == 2981719080 and beam["ubp_relative"] == 59634382
    assert wall["gwp_absolute"] == pytest.approx(882792.332) and wall["gwp_relative"] == pytest.approx(29426.411)
    assert wall["penr_absolute"] == pytest.approx(4233639.960) and wall["penr_relative"] == pytest.approx(141121.332)
    assert wall["ubp_absolute"] == 1615055244 and wall["ubp_relative"] == 53835175
    assert not beam["failed"] and beam["kbob_uuid"] == BETON and beam["kbob_material_name"].startswith("Hochbaubeton")


def test_without_validation_the_invalid_element_is_one_failed_component(spark, reference):
    els, mats = _tables(spark, [("test_invalid_guid", "P", "Z", "NonexistentMaterial", -1.0, None)])
    comps, _ = jobs.lca(_inputs(spark, reference, els, mats), validate=False)
    r = comps.first()
    assert r["failed"] and r["error_code"] == lca.INVALID_VOLUME and r["gwp_absolute"] is None


def test_check_order_first_failure_wins(spark, reference):
    rows = [("e1", "P", "C", "Beton", 1.0, 2300.0),            # ok (keeps e1 valid)
            ("e1", "P", "C", "Unmapped", -1.0, 0.0),            # volume and density bad -> INVALID_VOLUME
            ("e1", "P", "C", "Beton2", 1.0, 0.0),               # INVALID_DENSITY
            ("e1", "P", "C", "Unmapped2", 1.0, 5.0),            # MAPPING_NOT_FOUND
            ("e1", "P", "C", "Stale", 1.0, 5.0),                # mapped to an id absent from the version
            ("e1", "P", "C", "NaNvol", float("nan"), 5.0),      # N3: NaN is invalid
            ("e1", "P", "C", "NullDens", 2.0, None)]            # N4: null density is invalid
    els, mats = _tables(spark, rows)
    catalogue, versions, life, mappings = reference
    mappings = mappings.unionByName(spark.createDataFrame(
        [("Beton2", BETON), ("Stale", "NOT-IN-CATALOGUE"), ("NaNvol", BETON), ("NullDens", BETON), ("Empty", "")],
        "ifc_material string, kbob_id string"))
    comps, _ = jobs.lca(jobs.LcaInputs(els, mats, mappings, catalogue, versions, life))
    got = {r["material_name"]: r["error_code"] for r in comps.collect()}
    assert got == {"Beton": None, "Unmapped": "INVALID_VOLUME", "Beton2": "INVALID_DENSITY",
                   "Unmapped2": "MAPPING_NOT_FOUND", "Stale": "KBOB_NOT_FOUND", "NaNvol": "INVALID_VOLUME",
                   "NullDens": "INVALID_DENSITY"}
    failed = comps.filter("failed").select("gwp_absolute", "volume", "amortization", "kbob_uuid").distinct().collect()
    assert [tuple(r) for r in failed] == [(None, None, None, None)]  # N17


def test_service_life_rules(spark, reference):
    catalogue, versions, _, mappings = reference
    life = spark.createDataFrame([("C2.1", "a", 50), ("C2.1", "b", 40), ("E3", "c", 0), (" G ", "d", None)],
                                 "ebkp_code string, description string, years int")
    rows = [(f"e{i}", "P", code, "Beton", 1.0, 2300.0) for i, code in
            enumerate(["C2.1", " C2.1 ", "E3", "G", "C02.01", None, "X"])]
    els, mats = _tables(spark, rows)
    comps, _ = jobs.lca(jobs.LcaInputs(els, mats, mappings, catalogue, versions, life))
    got = {r["element_id"]: r["amortization"] for r in comps.collect()}
    # MIN over duplicates, trimmed match, 0/null/missing -> 60, no normalisation (C02.01 != C2.1)
    assert got == {"e0": 40, "e1": 40, "e2": 60, "e3": 60, "e4": 60, "e5": 60, "e6": 60}
    comps_n, _ = jobs.lca(jobs.LcaInputs(els, mats, mappings, catalogue, versions, life), normalise_life=True)
    assert {r["element_id"]: r["amortization"] for r in comps_n.collect()}["e4"] == 40


def test_no_active_version_is_an_error(spark, reference):
    catalogue, versions, life, mappings = reference
    els, mats = _tables(spark, [("e", "P", "C", "Beton", 1.0, 1.0)])
    with pytest.raises(cat.NoActiveVersion):
        jobs.lca(jobs.LcaInputs(els, mats, mappings, catalogue, versions.withColumn("is_active", F.lit(False)), life))


def test_project_mapping_last_wins(spark, reference):
    catalogue, versions, life, _ = reference
    mappings = spark.createDataFrame([
        ("P1", "Beton", GLASWOLLE, dt.datetime(2024, 1, 1)), ("P1", "Beton", BETON, dt.datetime(2024, 2, 1)),
        ("P2", "Beton", GLASWOLLE, dt.datetime(2024, 1, 1))],
        "project_id string, ifc_material string, kbob_id string, created_at timestamp")
    els, mats = _tables(spark, [("a", "P1", "C", "Beton", 1.0, 1.0), ("b", "P2", "C", "Beton", 1.0, 1.0)])
    comps, _ = jobs.lca(jobs.LcaInputs(els, mats, mappings, catalogue, versions, life))
    assert {r["element_id"]: r["kbob_uuid"] for r in comps.collect()} == {"a": BETON, "b": GLASWOLLE}


def test_rejects_statistics_and_nesting(spark, reference):
    rows = [("a", "P", "C", "Beton", 1.0, 2300.0), ("a", "P", "C", "Nope", 1.0, 1.0),
            ("b", "P", "C", "Beton", 2.0, 2300.0), ("c", "P", "C", "Beton", 0.0, 2300.0)]
    els, mats = _tables(spark, rows)
    els = els.unionByName(spark.createDataFrame([("d", "P", "C")], els.schema))
    rejected = {r["element_id"]: r["reason"] for r in el.rejected_elements(els, el.attach_elements(mats, els)).collect()}
    assert rejected == {"c": "NO_POSITIVE_VOLUME", "d": "NO_MATERIALS"}
    comps, version = jobs.lca(_inputs(spark, reference, els, mats))
    stats = lca.lca_run_stats(comps, version).first()
    assert (stats["total_elements"], stats["failed_elements"], stats["failed_components"], stats["total_components"]) == (2, 1, 1, 3)
    summary = {r["element_id"]: (r["n_components"], r["shared_guid"]) for r in lca.element_summary(comps).collect()}
    assert summary == {"a": (2, True), "b": (1, False)}
    # invariant: components = good + failed
    assert comps.count() == comps.filter("failed").count() + comps.filter("not failed").count()


def test_components_straight_from_documents(spark, reference):
    from graustein.schemas import ELEMENT_DOCUMENT
    doc = {"id": None, "elements": [
        {"id": "test_beam_1", "ifc_class": "IfcBeam", "properties": {"ebkp": "C"}, "materials": ["Beton"],
         "material_volumes": {"Beton": {"fraction": 1.0, "volume": 3.684, "density": 2300.0}}},
        {"guid": "g2", "properties": {"ebkp": "", "reference": "D"}, "materials": ["Wärmedämmung", "Missing"],
         "material_volumes": {"Wärmedämmung": {"volume": 86.392, "density": 30.0}}}]}
    docs = spark.createDataFrame([doc], ELEMENT_DOCUMENT).withColumn("project_id", F.lit("P"))
    rows = el.document_components(el.explode_documents(docs))
    got = {(r["element_id"], r["material_name"]): (r["volume"], r["density"], r["ebkp"]) for r in rows.collect()}
    assert got == {("test_beam_1", "Beton"): (3.684, 2300.0, "C"), ("g2", "Wärmedämmung"): (86.392, 30.0, "D"),
                   ("g2", "Missing"): (0.0, 0.0, "D")}
    catalogue, versions, life, mappings = reference
    comps = lca.lca_components(rows, mappings, catalogue, life, "2024-6.2")
    codes = {(r["element_id"], r["material_name"]): r["error_code"] for r in comps.collect()}
    assert codes == {("test_beam_1", "Beton"): None, ("g2", "Wärmedämmung"): None, ("g2", "Missing"): "INVALID_VOLUME"}


def test_duplicate_catalogue_rows_do_not_multiply_components(spark, reference):
    catalogue, versions, life, mappings = reference
    dup = catalogue.unionByName(catalogue.filter(F.col("uuid") == BETON).withColumn("indicator_co2eq", F.lit(1.0)))
    els, mats = _tables(spark, [("b", "P", "C", "Beton", 1.0, 1.0), ("w", "P", "D", "Wärmedämmung", 1.0, 1.0)])
    comps, _ = jobs.lca(jobs.LcaInputs(els, mats, mappings, dup, versions, life))
    assert comps.count() == 2


def test_blank_latest_mapping_hides_older_ones(spark):
    rows = [("P", "Beton", "K1", dt.datetime(2024, 1, 1)), ("P", "Beton", " ", dt.datetime(2024, 2, 1)), ("P", "Holz", "K2", dt.datetime(2024, 1, 1))]
    m = spark.createDataFrame(rows, "project_id string, ifc_material string, kbob_id string, created_at timestamp")
    assert [tuple(r) for r in lca.usable_mappings(m).collect()] == [("P", "Holz", "K2")]
    from graustein.operators import projects
    assert [tuple(r) for r in projects.project_mapping(m, "P").collect()] == [("Holz", "K2")]


def test_remap_keeps_the_mappings_of_all_projects(spark, reference):
    catalogue, versions, life, _ = reference
    schema = "project_id string, ifc_material string, kbob_id string, kbob_version string, is_modelled boolean, created_at timestamp"
    old = spark.createDataFrame([(None, "Beton", BETON, "v", True, dt.datetime(2024, 1, 1)), ("P1", "Holz", BETON, "v", True, dt.datetime(2024, 1, 1)),
                                 ("P2", "Holz", BETON, "v", True, dt.datetime(2024, 1, 1))], schema)
    els, mats = _tables(spark, [("a", "P1", "C", "Beton", 1.0, 1.0), ("b", "P1", "C", "Holz", 1.0, 1.0)])
    new = spark.createDataFrame([("Holz", GLASWOLLE)], "ifc_material string, kbob_id string")
    mapped, comps = jobs.remap_and_recompute(jobs.LcaInputs(els, mats, old, catalogue, versions, life), "P1", new, old)
    assert {(r["project_id"], r["ifc_material"], r["kbob_id"]) for r in mapped.collect()} == {
        (None, "Beton", BETON), ("P1", "Holz", GLASWOLLE), ("P2", "Holz", BETON)}
    assert {r["element_id"]: r["kbob_uuid"] for r in comps.collect()} == {"a": BETON, "b": GLASWOLLE}


def test_mapping_rows_without_project_apply_to_every_project(spark, reference):
    catalogue, versions, life, _ = reference
    mappings = spark.createDataFrame([(None, "Beton", BETON), ("P2", "Beton", GLASWOLLE)],
                                     "project_id string, ifc_material string, kbob_id string")
    els, mats = _tables(spark, [("a", "P1", "C", "Beton", 1.0, 1.0), ("b", "P2", "C", "Beton", 1.0, 1.0)])
    comps, _ = jobs.lca(jobs.LcaInputs(els, mats, mappings, catalogue, versions, life))
    assert {r["element_id"]: r["kbob_uuid"] for r in comps.collect()} == {"a": BETON, "b": GLASWOLLE}
