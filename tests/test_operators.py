"""Library operators on small fixtures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelforge.functions import geo, measure, text
from parcelforge.operators import rules, sequence, spatial, versioning
from parcelforge.plans import requests


def _values(spark, expression, **literals):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(("label", "path"), [("21(e)", ["21", "e"]), ("21(ea)(1)", ["21", "ea", "1"]), ("20(1)(a.1)", ["20", "1", "a.1"]), ("(a)", None)])
def test_clause_path(spark, label, path):
    assert _values(spark, text.clause_path(F.lit(label))) == path


def test_text(spark):
    assert _values(spark, text.zone_name(F.lit("Downtown Core (DC)"), F.lit("DC"))) == "Downtown Core"
    assert _values(spark, text.slugify(F.lit(" & "))) == "and"
    assert _values(spark, text.slugify(F.lit(None).cast("string"))) == "unknown"
    assert _values(spark, text.first_match(F.lit("Design standards"), [("sign", "signage"), ("design", "design")])) == "signage"


def test_measurements(spark):
    got = _values(spark, measure.measurements(F.lit("at least 9.75 metres (32 feet), 9.1m and 1,200 sq ft")))
    assert [(m["amount"], m["unit"], round(m["metric"], 4)) for m in got] == [(9.75, "m", 9.75), (32.0, "ft", 9.7536), (9.1, "m", 9.1), (1200.0, "sq ft", 111.4836)]


def test_requests():
    assert [requests.limit_of(v, 10, 25) for v in (None, "0", "-1", "abc", "7.9", "99999")] == [10, 10, 10, 10, 7, 25]
    assert requests.bbox_of("-63.20,46.20,-63.05,46.30")[0] == -63.2
    for bad in ("-63.05,46.20,-63.20,46.30", "1,2,3", "-200,0,1,1"):
        with pytest.raises(ValueError):
            requests.bbox_of(bad)


def test_projection(spark):
    east, north = geo.project(F.lit(-63.2345), F.lit(46.2266))
    row = spark.range(1).select(east.alias("e"), north.alias("n")).first()
    assert (round(row["e"], 3), round(row["n"], 3)) == (381909.321, 686266.945)


def test_import_twice_is_unchanged(spark):
    first = spark.createDataFrame([("a", "1"), ("b", "2")], "natural_key string, content_hash string")
    second = spark.createDataFrame([("b", "3"), ("c", "4")], "natural_key string, content_hash string")
    same = {r["change_status"] for r in versioning.diff(first, first).collect()}
    assert same == {"unchanged"}
    events = versioning.diff(first, second)
    assert {r["natural_key"]: r["change_status"] for r in events.collect()} == {"a": "removed", "b": "changed", "c": "added"}
    after = versioning.apply_diff(first.withColumn("is_active", F.lit(True)), second, events)
    assert sorted((r["natural_key"], r["content_hash"]) for r in after.where("is_active").collect()) == [("b", "3"), ("c", "4")]


def test_corrections(spark):
    fixes = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "natural_key string, content_hash string")
    now = spark.createDataFrame([("a", "1"), ("b", "2")], "natural_key string, content_hash string")
    got = {r["natural_key"]: r["correction_status"] for r in versioning.replay_corrections(fixes, now).collect()}
    assert got == {"a": "reapplied", "b": "needs_re_evaluation", "c": "needs_re_evaluation"}


def test_overlap_and_boundary(spark):
    box = "named_struct('x0', {}D, 'y0', {}D, 'x1', {}D, 'y1', {}D)"
    parcels = spark.range(1).selectExpr("1 AS parcel_id", box.format(0, 0, 10, 10) + " AS box")
    zones = spark.range(1).selectExpr("explode(array(named_struct('zone_id', 5, 'b', " + box.format(0, 0, 6, 10) + "), named_struct('zone_id', 4, 'b', " + box.format(6, 0, 20, 10) + "))) AS z").selectExpr("z.zone_id", "z.b AS box")
    row = spatial.largest_overlap(parcels, zones, 4.0).first()
    assert (row["zone_id"], row["shared"]) == (5, 60.0)
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (0, 4))])
    assert _values(spark, geo.covers(ring, F.lit(4.0), F.lit(2.0)))
    assert not _values(spark, geo.covers(ring, F.lit(4.1), F.lit(2.0)))
    assert _values(spark, geo.area(ring)) == 16.0


def test_rules_and_sequences(spark):
    zones = spark.createDataFrame([(1,), (2,)], "zone int")
    rows = spark.createDataFrame([(1, "ok", " A "), (1, "ok", "a"), (1, "no", "b")], "z int, kind string, use string")
    got = {r["zone"]: tuple(r)[1:] for r in rules.counts(zones, rows, "zone", "z", "kind", "use", {"yes": ["ok"]}, ["ok"]).collect()}
    assert got == {1: (3, 2, 1), 2: (0, 0, 0)}
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a int, b int")
    assert {r["node"]: r["component"] for r in sequence.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7}
