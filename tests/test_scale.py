"""Operators on what larger tables bring: plans without large broadcasts, long chains, many copies, many parts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from parcelforge.functions import overlay
from parcelforge.operators import raster, records, references, registration, sequence, shapes, spatial
from parcelforge.plans import answers, views


def _plan(rows) -> str:
    return rows._jdf.queryExecution().toString()


def test_samples_are_merged_and_read_once(spark):
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(3.0).alias("x1"), F.lit(3.0).alias("y1"))
    parcels = spark.range(2).select("id", F.when(F.col("id") == 0, box).otherwise(F.struct(*[(box[c] + 50).alias(c) for c in ("x0", "y0", "x1", "y1")])).alias("box"))
    pixels = spark.createDataFrame([(0, 0, "a", 10.0), (1, 1, "b", 30.0), (2, 2, "b", 50.0), (2, 0, None, 90.0)], "row long, col long, code string, distance double")
    voted = raster.votes(raster.sample(raster.sample_points(parcels, "id", "box"), pixels, 0.0, 3.0, 1.0), "id", "code", "distance", "place")
    got = {r["id"]: (r["samples"], r["matched"], r["code"], r["mean_distance"], r["confidence"]) for r in voted.collect()}
    assert got == {0: (9, 2, "b", 40.0, "low"), 1: (9, 0, None, None, "low")}
    plan = _plan(voted).split("== Initial Plan ==")[-1]
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 1


def test_union_of_parts_that_stand_apart(monkeypatch):
    seen = []
    whole = overlay.overlay
    monkeypatch.setattr(overlay, "overlay", lambda shapes, keep: seen.append(len(shapes)) or whole(shapes, keep))
    square = np.array([[0.0, 0], [1, 0], [1, 1], [0, 1]])
    found = overlay.union([[square + [3 * i + k, 0]] for i in range(50) for k in (0, 1)])
    assert seen == [2] * 50 and len(found) == 50 and abs(sum(overlay.area([r]) for r in found) - 100) < 1e-9


def test_dissolve_takes_equal_shapes_once(spark):
    square = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]
    rows = spark.range(4000).select((F.col("id") % 2).alias("zone"), F.lit(square).cast("array<array<array<double>>>").alias("shape"))
    made = shapes.dissolve(rows, "zone", 10.0)
    assert "keys=[zone" in _plan(made) and {(r["zone"], r["a"]) for r in made.select("zone", shapes.area(F.col("shape")).alias("a")).collect()} == {(0, 1.0), (1, 1.0)}


_BOX = "named_struct('x0', id % 1 * 1D, 'y0', id % 1 * 1D, 'x1', id % 1 + 4D, 'y1', id % 1 + 4D) AS box"


def test_largest_overlap_compares_equal_boxes_once(spark):
    parcels, zones = spark.range(3000).selectExpr("id AS parcel_id", _BOX), spark.range(5, 2005).selectExpr("id AS zone_id", _BOX)
    found = spatial.largest_overlap(parcels, zones, 20.0)
    assert found.where("zone_id = 5 AND shared = 16").count() == 3000 and found.count() == 3000
    assert "Aggregate [box" in found._jdf.queryExecution().optimizedPlan().toString()


def _many(spark, n: int, name: str):
    x = F.col("id") % 1  # 0, but no constant that the optimizer would take out of the grouping
    return spark.range(n).select(F.col("id").alias(name), F.lit("Z").alias("code"), shapes.make_envelope(x, x, x + 4, x + 4).alias("shape"))


def test_zoning_compares_equal_shapes_once(spark):
    found = answers.zoning(_many(spark, 3000, "parcel_id"), _many(spark, 2000, "zone_id"), 20.0)
    assert found.where("zone_id = 0 AND shared = 16").count() == 3000 and found.count() == 3000
    assert "Aggregate [shape" in found._jdf.queryExecution().optimizedPlan().toString()


def test_comparison_of_many_copies(spark):
    parcels, zones = _many(spark, 1000, "parcel_id"), _many(spark, 2000, "zone_id")
    found = answers.comparison(parcels, zones, zones.where("zone_id > 9").withColumn("code", F.lit("Y")), 20.0)
    assert found.where("current_code = 'Z' AND draft_code = 'Y' AND change = 'changed'").count() == 1000 == found.count()
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [shape") >= 4


def test_inclusion_as_deep_as_the_chain(spark):
    found = records.inclusion(spark.range(25).selectExpr("id AS a", "id + 1 AS b"))
    assert found.count() == 25 * 26 // 2 and found.agg(F.max("depth")).first()[0] == 25


def test_area_links_are_not_shuffled(spark):
    rules = spark.createDataFrame([(1, 1, ["main", "down"]), (1, 1, ["main"]), (1, 2, ["x"]), (2, 3, ["main"]), (1, 4, [""])], "scope int, rule int, tokens array<string>")
    places = spark.createDataFrame([(1, 7, ["main_east", "down"]), (1, 8, ["own"]), (1, 9, []), (2, 7, ["zone"])], "scope int, place int, keys array<string>")
    found = references.area_links(rules, places, "scope")
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 7), (1, 1, 8)]
    assert found._jdf.queryExecution().optimizedPlan().toString().lstrip().startswith("Project")


def test_zone_matches_are_distinct_without_a_shuffle(spark):
    zones = spark.createDataFrame([(1, 1, "R1"), (1, 1, "c1"), (1, 2, "r1"), (2, 1, None)], "zone_pk int, bylaw_pk int, zone_code string")
    bylaws = spark.createDataFrame([(1, '{"community_plan_name":"P"}'), (2, '{"community_plan_name":"P"}'), (3, "{}")], "bylaw_pk int, metadata string")
    plans = _many(spark, 2, "plan_id").select("plan_id", F.lit("P").alias("plan_name"), F.col("shape").alias("geom"))
    box = shapes.make_envelope(F.lit(1), F.lit(1), F.lit(2), F.lit(2))
    bounds = spark.createDataFrame([(5, "r1", None), (5, "C1", None), (6, "X", "d")], "source_feature_id int, zone string, description string").withColumn("geom", box)
    found = registration.zone_matches(zones, bylaws, plans, bounds, 20.0)
    assert [tuple(r) for r in found.collect()] == [(1, 5, None, "P")]
    assert found._jdf.queryExecution().optimizedPlan().toString().lstrip().startswith("Project")


def test_diagonal_halves_are_merged(spark):
    rows = spark.range(300).selectExpr("inline(array(named_struct('parcel_id', id * 2, 'shape', array(array(array(id * 30D, 0D), array(id * 30D + 10, 0D), array(id * 30D, 10D)))), named_struct('parcel_id', id * 2 + 1, 'shape', array(array(array(id * 30D + 10, 10D), array(id * 30D, 10D), array(id * 30D + 10, 0D))))))")
    pairs = shapes.diagonal_pairs(rows, 20.0)
    assert "Broadcast" not in _plan(pairs) and pairs.where("b = a + 1").count() == 300 == pairs.count()
    merged = shapes.merge_diagonals(rows, 20.0)
    assert "Broadcast" not in _plan(merged)
    assert merged.where("size(source_ids) = 2").count() == 300 == merged.count()


def test_halves_in_whole_arrays_are_as_one_by_one():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 20, (400, 3, 2)).astype(float)
    b = np.stack([a[:, 2], a[:, 1] + a[:, 2] - a[:, 0] + rng.normal(size=(400, 2)) * (np.arange(400) % 2)[:, None], a[:, 1]], axis=1)
    rings, known = overlay.union_of_halves(a, b)
    assert known.sum() > 100
    for i in np.flatnonzero(known):
        (whole,) = overlay.union([[a[i]], [b[i]]])
        assert whole.tolist() == rings[i].tolist()
    lines = [overlay.is_diagonal(overlay.shared_lines(x, y)) for x, y in zip(a, b, strict=True)]
    assert 0 < sum(lines) < 400 and overlay.share_diagonal(a, b).tolist() == lines


def test_equal_shapes_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def corner(shape):
        seen.add(1)
        return shape[0][1][0] if shape else None

    rows = _many(spark, 2000, "id").select("id", F.when(F.col("id") % 4 > 0, F.col("shape")).alias("shape")).persist()
    found = shapes.once_per_shape(rows, "shape", lambda one: one.withColumn("x", corner("shape")))
    assert found.columns == ["id", "shape", "x"]
    assert {(r["x"], r["n"]) for r in found.groupBy("x").agg(F.count(F.lit(1)).alias("n")).collect()} == {(None, 500), (4.0, 1500)}
    assert seen.value == 2
    rows.unpersist()


def test_overlaps_of_copies_are_expanded_by_all_tasks(spark):
    box = shapes.make_envelope(F.lit(0), F.lit(0), F.lit(4), F.lit(4))
    beside = shapes.make_envelope(F.lit(4), F.lit(0), F.lit(7), F.lit(1.23456))
    # one stored part each; of the ids, one is null and one stands twice
    parcels = spark.range(0, 700, 1, 1).select(F.when(F.col("id") > 0, F.greatest("id", F.lit(2))).alias("parcel_id"), box.alias("shape"))
    zones = spark.range(0, 600, 1, 1).select(F.col("id").alias("zone_id"), F.when(F.col("id") % 2 == 0, box).otherwise(beside).alias("shape"))
    met = shapes.overlaps(parcels, zones, 3.0)
    got = met.groupBy("parcel_id", "zone_id", "shared").count().collect()
    times = {(r["parcel_id"], r["zone_id"], r["shared"]): r["count"] for r in got}
    assert times == {(i or None, z, 0.0 if z % 2 else 16.0): 2 if i == 2 else 1 for i in [0, *range(2, 700)] for z in range(600)}
    tasks = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 4 and max(tasks) < 700 * 600 / 2
    lists = shapes.id_lists(parcels, "parcel_id", "shape", 100).select(F.size("parcel_id").alias("n")).collect()
    assert sum(r["n"] for r in lists) == 700 and len(lists) == 7 and max(r["n"] for r in lists) < 200
    wide = zones.select("zone_id", shapes.make_envelope(F.lit(1 / 3), F.lit(0), F.lit(3), F.lit(1)).alias("shape"))
    assert {r["shared"] for r in shapes.overlaps(parcels, wide, 3.0, 2).collect()} == {2.67}


def test_conflicts_of_one_group_are_expanded_by_all_tasks(spark):
    k = F.col("id")
    uses = spark.range(0, 1200, 1, 1).select(
        F.when(k < 1199, k).alias("rule_atom_pk"), F.when(k % 3 == 0, "use_prohibition").otherwise("principal_use").alias("rule_type"), F.when(k % 2 == 0, "Shop").otherwise(" shop ").alias("use_name"),
        F.when(k % 3 == 0, "prohibited").otherwise("permitted").alias("rule_intent"), F.lit("shop").alias("use_name_normalized"), F.lit("b").alias("bylaw_slug"), F.lit("z").alias("zone_code"),
        F.lit(5).alias("target_feature_id"), F.when(k % 5 > 0, "edge").alias("target_description"), shapes.make_envelope(k % 2, F.lit(0), F.lit(4), F.lit(4)).alias("geom"),
    )
    # a rule that stands twice pairs twice, one that both permits and prohibits not with itself, one without a key not at all
    more = uses.where("rule_atom_pk IN (1, 3)").withColumn("rule_intent", F.lit("permitted"))
    found = views.use_conflicts(uses.unionByName(more))
    pairs = found.groupBy("permitted_rule_atom_pk", "prohibited_rule_atom_pk").count().collect()
    permitted, prohibited = [i for i in range(1199) if i % 3] + [3], range(0, 1199, 3)
    times = {(r["permitted_rule_atom_pk"], r["prohibited_rule_atom_pk"]): r["count"] for r in pairs}
    assert times == {(p, x): 2 if p == 1 else 1 for p in permitted for x in prohibited if p != x}
    wrong = "permitted_use_name <> IF(permitted_rule_atom_pk % 2 = 0, 'Shop', ' shop ') OR NOT target_description <=> IF(permitted_rule_atom_pk % 5 > 0, 'edge', NULL) OR geom[0][0][0] <> permitted_rule_atom_pk % 2"
    assert found.where(f"{wrong} OR prohibited_use_name <> IF(prohibited_rule_atom_pk % 2 = 0, 'Shop', ' shop ') OR prohibited_rule_type <> 'use_prohibition'").count() == 0
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 4 and max(tasks) < sum(tasks) / 2
    lists = sequence.key_lists(uses.select("rule_atom_pk", "rule_intent"), "rule_atom_pk", 100).select(F.size("rule_atom_pk").alias("n")).collect()
    assert sum(r["n"] for r in lists) == 1199 and len(lists) <= 13 and max(r["n"] for r in lists) <= 100
