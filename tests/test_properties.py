"""Property-based checks (hypothesis): the Spark code normaliser (H1/H2) against a plain
Python statement of the rule, on many generated strings in one Spark job."""

import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from graustein.functions import ebkp


def rule(code: str, levels: int) -> str:
    """The normalisation rule stated directly: drop blanks; if the text starts with a capital
    letter and digits, keep letter, number and up to ``levels - 1`` dot-separated numbers,
    each without leading zeros; otherwise return the blank-free text."""
    s = code.replace(" ", "")
    m = re.match(r"[A-Z][0-9]+", s)
    if not m:
        return s
    parts = [str(int(s[1:m.end()]))]
    rest = s[m.end():]
    while len(parts) < levels:
        n = re.match(r"\.([0-9]+)", rest)
        if not n:
            break
        parts.append(str(int(n.group(1))))
        rest = rest[n.end():]
    return s[0] + ".".join(parts)


codes = st.text(alphabet="ABCEZcx0123456789. ", max_size=12)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(codes, min_size=200, max_size=400))
def test_normalize_matches_rule(spark, values):
    values = values + ["E 03.01", "C02.01.03", "C0.0.0", "007", "C", "C.1", "C1..2", "C1.2.3.4"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", ebkp.normalize_code("v", 3).alias("n3"), ebkp.normalize_code("v", 2).alias("n2")).collect()
    for r in got:
        assert r["n3"] == rule(r["v"], 3), r
        assert r["n2"] == rule(r["v"], 2), r


# ---------------------------------------------------------------- LCA against a per-row model

from decimal import ROUND_HALF_UP, Decimal, localcontext  # noqa: E402

from graustein.operators import lca  # noqa: E402

VOL = st.one_of(st.none(), st.decimals(min_value=-5, max_value=50, places=2, allow_nan=False, allow_infinity=False))
DEN = st.one_of(st.none(), st.decimals(min_value=0, max_value=3000, places=1, allow_nan=False, allow_infinity=False))


def _q(x: Decimal, digits: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def model(rows, mapping, catalogue, life):
    """Per-row statement of N1/N5/H4-H6: checks in order, first failure wins."""
    seen: dict[str, list[int]] = {}
    for code, y in life:
        seen.setdefault(code.strip(), [])
        if y is not None:
            seen[code.strip()].append(y)
    years = {c: (min(v) if v else None) for c, v in seen.items()}  # MIN ignores nulls
    out = {}
    with localcontext() as ctx:
        ctx.prec = 60
        for key, mat, vol, den, ebkp_code in rows:
            if vol is None or vol <= 0:
                out[key] = ("INVALID_VOLUME",)
            elif den is None or den <= 0:
                out[key] = ("INVALID_DENSITY",)
            elif not mapping.get(mat):
                out[key] = ("MAPPING_NOT_FOUND",)
            elif mapping[mat] not in catalogue:
                out[key] = ("KBOB_NOT_FOUND",)
            else:
                life_years = years.get((ebkp_code or "").strip()) or 60
                co2 = catalogue[mapping[mat]]
                a = vol * den * co2
                out[key] = (None, life_years, _q(a, 3), _q(a / life_years, 3))
    return out


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(st.sampled_from(["m1", "m2", "m3", "m4"]), VOL, DEN,
                          st.sampled_from(["C2.1", " C2.1", "E3", "X", None])), min_size=30, max_size=80),
       st.dictionaries(st.sampled_from(["m1", "m2", "m3", "m4"]), st.sampled_from(["k1", "k2", "k9", ""])),
       st.lists(st.tuples(st.sampled_from(["C2.1", "E3 ", "X"]), st.one_of(st.none(), st.integers(0, 80))), max_size=5))
def test_lca_matches_row_model(spark, raw, mapping, life):
    from pyspark.sql import types as T
    rows = [(f"e{i}", m, v, d, c) for i, (m, v, d, c) in enumerate(raw)]
    catalogue = {"k1": Decimal("232.300"), "k2": Decimal("1.250")}
    comp_schema = T.StructType([T.StructField("project_id", T.StringType()), T.StructField("element_id", T.StringType()),
                                T.StructField("material_name", T.StringType()), T.StructField("volume", T.DecimalType(12, 2)),
                                T.StructField("density", T.DecimalType(8, 1)), T.StructField("ebkp", T.StringType())])
    comps_in = spark.createDataFrame([("P", k, m, v, d, c) for k, m, v, d, c in rows], comp_schema)
    maps = spark.createDataFrame([(m, k) for m, k in mapping.items()] or [("none", None)], "ifc_material string, kbob_id string")
    cat = spark.createDataFrame([(k, "n", v, v, v, "v") for k, v in catalogue.items()],
                                "uuid string, name string, indicator_co2eq decimal(10,3), indicator_penre decimal(10,3), "
                                "indicator_ubp decimal(10,3), version string")
    lif = spark.createDataFrame(life or [("none", None)], "ebkp_code string, years int")
    got = {r["element_id"]: r for r in lca.lca_components(comps_in, maps, cat, lif, "v").collect()}
    want = model(rows, mapping, catalogue, life)
    for key, w in want.items():
        g = got[key]
        assert g["error_code"] == w[0], (key, g, w)
        if w[0] is None:
            assert (g["amortization"], g["gwp_absolute"], g["gwp_relative"]) == w[1:], (key, g, w)


# ---------------------------------------------------------------- cost against a per-row model

from graustein.operators import cost as cost_ops  # noqa: E402

QTY = st.one_of(st.none(), st.decimals(min_value=-10, max_value=500, places=3, allow_nan=False, allow_infinity=False))


def cost_model(rows, keys):
    by_code: dict[str, list] = {}
    for code, unit, value in keys:
        by_code.setdefault(code.strip(), []).append((unit, value))
    out = {}
    for guid, code, area, length in rows:
        c = (code or "").strip() if code is not None else None
        found = by_code.get(c) if c is not None else None
        if not found:
            out[guid] = ("COST_CODE_NOT_FOUND", None)
        elif len(found) > 1:
            out[guid] = ("AMBIGUOUS_COST_CODE", None)
        else:
            unit, value = found[0]
            q = area if unit == "m2" else length if unit == "m" else "unknown"
            if q == "unknown":
                out[guid] = ("UNKNOWN_UNIT", None)
            elif q is None or q <= 0:
                out[guid] = ("INVALID_QUANTITY", None)
            else:
                out[guid] = (None, _q(q * value, 2))
    return out


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(st.sampled_from(["C2.1", " E3 ", "D1", "Z9", None]), QTY, QTY), min_size=30, max_size=80),
       st.lists(st.tuples(st.sampled_from(["C2.1", "E3", "D1"]), st.sampled_from(["m2", "m", "stk"]),
                          st.decimals(min_value=1, max_value=999, places=2, allow_nan=False, allow_infinity=False)),
                max_size=5))
def test_cost_matches_row_model(spark, raw, keys):
    rows = [(f"g{i}", c, a, l) for i, (c, a, l) in enumerate(raw)]
    els = spark.createDataFrame([(g, "P", c, a, l) for g, c, a, l in rows],
                                "id string, project_id string, ebkp string, area_net decimal(12,3), length decimal(12,3)")
    ref = spark.createDataFrame([(c, u, v, "2024") for c, u, v in keys] or [("none", "m", Decimal("1.00"), "2024")],
                                "ebkp_code string, unit string, cost_per_unit decimal(10,2), version string")
    got = {r["guid"]: (r["error_code"], r["total_cost"]) for r in cost_ops.cost_components(els, ref).collect()}
    assert got == cost_model(rows, keys)
