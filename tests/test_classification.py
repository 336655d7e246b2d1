"""Classification."""

from graustein.operators import classification as cl

CATALOGUE_TEXT = """# eBKP-H
C 2 Wände
C 02.01 Aussenwand alt
C 2.1 Aussenwand
E 3 Fenster
junk line
B 6.1 Abholzung, Rodung
"""


def _catalogue(spark, tmp_dir, **kw):
    path = f"{tmp_dir}/ebkp.md"
    with open(path, "w", encoding="utf-8") as f:
        f.write(CATALOGUE_TEXT)
    return cl.parse_catalogue(cl.read_catalogue_lines(spark, path), **kw)


def test_catalogue_parse_last_line_wins(spark, tmp_dir):
    got = {r["code"]: r["description"] for r in _catalogue(spark, tmp_dir).collect()}
    assert got == {"C2": "Wände", "C2.1": "Aussenwand", "E3": "Fenster", "B6.1": "Abholzung, Rodung"}
    only_c = {r["code"] for r in _catalogue(spark, tmp_dir, letter="C").collect()}
    assert only_c == {"C2", "C2.1"}


def _values(spark, pairs):
    return spark.createDataFrame(pairs, "element_id string, ebkp_value string")


def test_hierarchical_lookup(spark, tmp_dir):
    cat = _catalogue(spark, tmp_dir)
    vals = _values(spark, [("a", "C2.1"), ("b", "C02.01.03"), ("c", "E3.7"), ("d", "C2.9.9"), ("e", "Z9"), ("f", "abc"),
                           ("g", "  ")])
    got = {r["element_id"]: (r["match_level"], r["description"], r["identification"])
           for r in cl.classify_hierarchical(vals, cat).collect()}
    assert got == {"a": ("exact", "Aussenwand", "C2.1"), "b": ("parent", "Aussenwand", "C02.01.03"),
                   "c": ("parent", "Fenster", "E3.7"), "d": ("main", "Wände", "C2.9.9"),
                   "e": ("none", "Z9", "Z9"), "f": ("none", "abc", "abc")}
    cov = cl.coverage(vals, cl.classify_hierarchical(vals, cat)).first()
    assert (cov["elements_processed"], cov["elements_with_ebkp"], cov["elements_with_match"]) == (7, 6, 1)


def test_exact_lookup_uses_two_levels(spark, tmp_dir):
    cat = _catalogue(spark, tmp_dir, levels=2)
    vals = _values(spark, [("a", "C 02.01.03"), ("b", "Q1")])
    got = {r["element_id"]: (r["identification"], r["description"], r["match_level"])
           for r in cl.classify_exact(vals, cat).collect()}
    assert got == {"a": ("C2.1", "Aussenwand", "exact"), "b": ("Q1", "Q1", "none")}


def test_first_property_semantics(spark):
    props = spark.createDataFrame([
        ("x", 0, 0, "Name", "n"), ("x", 0, 1, "eBKP", None), ("x", 1, 0, "EBKP", "C2.1"),
        ("y", 0, 0, "ebkp", "E3"), ("y", 0, 1, "ebkp", "C2"), ("z", 2, 0, "other", "C2")],
        "element_id string, pset_pos int, prop_pos int, prop_name string, prop_value string")
    mapper = {r["element_id"]: r["ebkp_value"] for r in cl.first_ebkp_property(props, stop_on_empty=True).collect()}
    classifier = {r["element_id"]: r["ebkp_value"] for r in cl.first_ebkp_property(props, stop_on_empty=False).collect()}
    assert mapper == {"x": "", "y": "E3"}
    assert classifier == {"x": "C2.1", "y": "E3"}


def test_completeness_and_incomplete_references(spark):
    refs = spark.createDataFrame([
        ("a", "IFC2X3", "eBKP", "Wand", "C2.1", None), ("b", "IFC4", "eBKP", "Wand", None, "C2.1"),
        ("c", "IFC4", "eBKP", "", None, "C2.1"), ("c", "IFC4", "eBKP", "ok", None, "C2"), ("d", "IFC2X3", "eBKP", "x", None, "C")],
        "element_id string, schema_version string, system string, name string, item_reference string, identification string")
    elements = spark.createDataFrame([(e,) for e in "abcdef"], "element_id string")
    r = cl.completeness(elements, refs).first()
    assert (r["total_elements"], r["with_classification"], r["with_incomplete"], r["pct_incomplete"]) == (6, 4, 2, 50.0)
    bad = {(x["element_id"], x["name_missing"], x["id_missing"]) for x in cl.incomplete_references(refs).collect()}
    assert bad == {("c", True, False), ("d", False, True)}


def test_random_codes_are_repeatable_and_valid(spark, tmp_dir):
    cat = _catalogue(spark, tmp_dir)
    elements = spark.range(200).selectExpr("cast(id as string) as element_id")
    a = {r["element_id"]: r["identification"] for r in cl.assign_codes(elements, cat, seed=3).collect()}
    b = {r["element_id"]: r["identification"] for r in cl.assign_codes(elements, cat, seed=3).collect()}
    assert a == b and len(a) == 200 and set(a.values()) == {"C2", "C2.1"}


def test_code_diagnostics(spark, tmp_dir):
    cat = _catalogue(spark, tmp_dir)
    got = {r["raw"]: (r["normalized"], r["in_catalogue"]) for r in
           cl.code_diagnostics(_values(spark, [("a", "C 02.01"), ("b", "C 02.01"), ("c", "Z1")]), cat).collect()}
    assert got == {"C 02.01": ("C2.1", True), "Z1": ("Z1", False)}


def test_assigned_codes_verify_as_complete_references(spark, tmp_dir):
    cat = _catalogue(spark, tmp_dir)
    elements = spark.range(50).selectExpr("cast(id as string) as element_id")
    assigned = cl.assign_codes(elements, cat, seed=1)
    for schema in ("IFC2X3", "IFC4"):
        refs = cl.as_references(assigned, schema)
        assert cl.incomplete_references(refs).count() == 0
        r = cl.completeness(elements, refs).first()
        assert (r["with_classification"], r["with_incomplete"]) == (50, 0)
