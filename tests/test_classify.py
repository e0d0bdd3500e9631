"""Classifiers, references and requirements on edge cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelforge.functions import classify, measure
from parcelforge.operators import references


def _of(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(("label", "form", "want"), [
    ("21(ea)(1)", "number", ["21", "e", "a", "1"]), ("21(ii)", "number", ["21", "ii"]), ("21(a.1)", "number", None), ("21(iv.2)", "number", ["21", "iv.2"]), ("21(a.1)", "decimal", ["21", "a.1"]),
    ("RR-1(a)", "zone", ["RR-1", "a"]), ("12B3.4(ab12)", "zone", ["12B3.4", "ab12"]), ("12(?)", "plain", None), ("12()", "plain", None), ("12(a", "plain", None), ("12)a(", "plain", None), ("", "plain", None), (None, "plain", None),
])
def test_label_paths(spark, label, form, want):
    assert _of(spark, classify.label_path(F.lit(label).cast("string"), form)) == want


def test_label_order(spark):
    labels = ["(10)", "(2)", "z", "(aa)", "b", "x-1", "", None, "(a", "((a))"]
    rows = spark.createDataFrame([(v,) for v in labels], "label string").select("label", classify.label_order(F.col("label")).alias("o")).orderBy("o").collect()
    assert [r["label"] for r in rows][:5] == ["(2)", "(10)", "b", "z", "(aa)"] and {r["label"] for r in rows[5:]} == {"x-1", "", None, "(a", "((a))"}


def test_labels(spark):
    good, bad = ["a", "iv", "12", "A1.2", "1.2", "ab.3", "R-2", "1a2"], ["", "a b", "1.2.3", ".1", "a.", "-", "a_b"]
    rows = spark.createDataFrame([(v,) for v in good + bad], "t string").select("t", classify.is_label(F.col("t")).alias("ok")).collect()
    assert {r["t"] for r in rows if r["ok"]} == set(good)
    assert _of(spark, classify.is_measurement_fragment(F.lit("9.1"), F.lit("m. wide"))) and not _of(spark, classify.is_measurement_fragment(F.lit("9"), F.lit("m")))


def test_numbers(spark):
    said = {"1,200.5": 1200.5, "1,20": 20.0, ",5": 5.0, "1.2.3": None, ".5": None, "5.": None, "7,": None, "12": 12.0}
    rows = spark.createDataFrame([(k,) for k in said], "t string").select("t", measure.number(F.col("t")).alias("n")).collect()
    assert {r["t"]: r["n"] for r in rows} == said


def test_zone_relations(spark):
    clauses = spark.createDataFrame([(1, "Uses permitted in the R1 Zone"), (2, "near the R-10 zone"), (3, None), (4, "subject to the regulations of the Harbour Zone")], "clause int, text string").withColumn("zone", F.lit("Z"))
    got = {(r["clause"], r["zone_code"], r["relationship_type"], r["cross_reference"]) for r in references.zone_relations(clauses, [], "clause", "text", "zone", ["R-1", "HB"], {"harbour": "HB"}).collect()}
    assert got == {(1, "R-1", "inherits_uses", True), (4, "HB", "inherits_regulations", True)}


def test_rewrite_keeps_order_and_empties(spark):
    rows = spark.createDataFrame([(1, ["x", "a", "x"]), (2, []), (3, ["gone"])], "k int, ids array<string>")
    changes = spark.createDataFrame([("a", ["c", "b"]), ("gone", [])], "old_id string, new_ids array<string>")
    assert {r["k"]: r["ids"] for r in references.rewrite_ids(rows, "ids", changes, ["k"]).collect()} == {1: ["x", "c", "b"], 2: [], 3: []}


def test_grouped(spark):
    got = _of(spark, measure.grouped(F.lit("lot 1 ha (2.5 acres), 3 dwelling units; 4 parking spaces 5 ft 6 m")))
    assert [(g["amount"], g["unit"], g["alternative"] and g["alternative"]["amount"]) for g in got] == [(1.0, "ha", 2.5), (3.0, "dwelling_unit", None), (4.0, "parking_space", None), (5.0, "ft", None), (6.0, "m", None)]
    assert _of(spark, measure.grouped(F.lit(""))) == [] and _of(spark, measure.bedrooms(F.lit("Two (2) bedrooms"))) == "2 bedrooms"
