"""Scalar column functions: eBKP codes (H1-H3, N7), number format (H9), checks (P15), ids."""

import math

import pytest
from pyspark.sql import functions as F

from graustein.functions import ebkp, ids, numbers


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("E 03.01", "E3.1"), ("C02.01", "C2.1"), ("C02.01.03", "C2.1.3"), ("E3", "E3"),
    ("c2", "c2"), ("C2.1abc", "C2.1"), ("C00.000", "C0.0"), (" Z 9 ", "Z9"), ("abc def", "abcdef"),
])
def test_normalize_three_levels(spark, raw, expected):
    assert _one(spark, ebkp.normalize_code("v", 3), raw) == expected


@pytest.mark.parametrize("raw,expected", [("C02.01.03", "C2.1"), ("B 1.1", "B1.1"), ("C 02.01", "C2.1"), ("C7", "C7")])
def test_normalize_two_levels(spark, raw, expected):
    assert _one(spark, ebkp.normalize_code("v", 2), raw) == expected


@pytest.mark.parametrize("code,parent,main", [("C2.1.3", "C2.1", "C2"), ("C2.1", "C2", "C2"), ("C2", None, "C2"),
                                              ("abc", None, None)])
def test_parent_and_main(spark, code, parent, main):
    assert _one(spark, ebkp.parent_code("v"), code) == parent
    assert _one(spark, ebkp.main_code("v"), code) == main


@pytest.mark.parametrize("value,text", [(1234567.891, "1`234`567,89"), (0.0, "0,00"), (999.995, "1`000,00"),
                                        (-1234.5, "-1`234,50")])
def test_swiss_number(spark, value, text):
    assert _one(spark, numbers.swiss_number("v"), value, "v double") == text


def test_not_positive_treats_nan_and_null_as_invalid(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (float("nan"),), (None,)], "v double")
    got = [r["r"] for r in df.select(numbers.not_positive("v").alias("r")).collect()]
    assert got == [False, True, True, True, True]


def test_value_problem_messages(spark):
    df = spark.createDataFrame([("g1", None, "C2"), ("g2", -2.5, "C2"), ("g3", 3.0, "C2"), ("g4", math.nan, "E3")],
                               "guid string, v double, e string")
    got = [r["p"] for r in df.select(numbers.value_problem("v", "area", "guid", "e").alias("p")).collect()]
    assert got == ["Missing area for GUID g1 (eBKP-H: C2)", "Invalid area (-2.5) for GUID g2 (eBKP-H: C2)", None,
                   "Missing area for GUID g4 (eBKP-H: E3)"]


def test_to_number_is_ansi_safe(spark):
    df = spark.createDataFrame([("2300",), ("n/a",), (None,)], "v string")
    assert [r["r"] for r in df.select(numbers.to_number("v").alias("r")).collect()] == [2300.0, None, None]


def test_url_parts_and_ids(spark):
    df = spark.createDataFrame([("http://host:9000/ifc-files/project/model.ifc",)], "u string")
    r = df.select(ids.url_bucket("u").alias("b"), ids.url_object("u").alias("o"),
                  ids.project_from_filename(F.lit("/x/y/haus.json")).alias("p"),
                  ids.element_uid(F.lit("P"), F.lit("f"), F.lit("g")).alias("k")).first()
    assert (r["b"], r["o"], r["p"]) == ("project", "model.ifc", "ifc_haus")
    assert len(r["k"]) == 64
