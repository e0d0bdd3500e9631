"""Validity reasons, simplifying, clipping, shared borders and merged halves."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from parcelforge.functions import overlay
from parcelforge.operators import parcels, shapes

SQUARE = np.array([[0.0, 0], [10, 0], [10, 10], [0, 10]])


def test_reasons():
    assert overlay.validity_reason([SQUARE]) == "Valid Geometry" == overlay.validity_reason([])
    assert overlay.validity_reason([SQUARE[:2]]).startswith("Too few points")
    assert overlay.validity_reason([SQUARE[[0, 2, 1, 3]]]) == "Self-intersection[5 5]"
    assert overlay.is_empty([]) and not overlay.is_empty([SQUARE])
    assert overlay.meeting_is_empty([SQUARE], [SQUARE + 20]) and not overlay.meeting_is_empty([SQUARE], [SQUARE + 10])


def test_lines():
    wavy = np.array([[0.0, 0], [1, 0.1], [2, -0.1], [3, 3], [4, 0]])
    assert overlay.simplify(wavy, 0.25).tolist() == [[0, 0], [2, -0.1], [3, 3], [4, 0]] and len(overlay.simplify(wavy, 9)) == 2
    parts = overlay.clip_line(np.array([[-5.0, 5], [15, 5], [15, 8], [5, 8]]), [SQUARE])
    assert [p.tolist() for p in parts] == [[[0, 5], [10, 5]], [[10, 8], [5, 8]]]
    assert overlay.clip_line(np.array([[20.0, 20], [30, 30]]), [SQUARE]) == []


def test_diagonals():
    a, b = SQUARE[[0, 1, 3]], SQUARE[[1, 2, 3]]
    assert overlay.is_diagonal(overlay.shared_lines(a, b)) and overlay.split_by_diagonal(a, b)
    assert not overlay.split_by_diagonal(a, b + 1) and not overlay.split_by_diagonal(SQUARE, b)
    upright = np.array([[0.0, 0], [0, 10], [-9, 0]])
    assert not overlay.split_by_diagonal(a, upright)


def test_area_of_rings(spark):
    hole, island, apart = SQUARE * 0.6 + 2, SQUARE * 0.2 + 4, SQUARE * 0.5 + 10
    rows = [([SQUARE.tolist(), hole.tolist(), island.tolist(), apart.tolist()],), ([],), ([SQUARE.tolist()],)]
    got = [r["a"] for r in spark.createDataFrame(rows, "shape array<array<array<double>>>").select(shapes.area(F.col("shape")).alias("a")).collect()]
    assert [round(v, 9) for v in got] == [100 - 36 + 4 + 25, 0, 100]


def test_merge_leaves_others(spark):
    rows = [(1, [SQUARE[[0, 1, 3]].tolist()]), (2, [SQUARE[[1, 2, 3]].tolist()]), (3, [(SQUARE + 50).tolist()])]
    got = {r["parcel_id"]: r["source_ids"] for r in shapes.merge_diagonals(spark.createDataFrame(rows, "parcel_id long, shape array<array<array<double>>>"), 20.0).collect()}
    assert got == {1: [1, 2], 3: [3]}


def test_fit():
    a, b, c, d, e, f = shapes.compose((2.0, 0, 1, 0, 2, 3), shapes.fit((0, 0, 10, 10), (100, 200, 120, 260)))
    x, y = 2.0, 1.0
    assert (a * x + b * y + c, d * x + e * y + f) == (100 + (2 * x + 1) * 2, 260 - (2 * y + 3) * 6)


def test_statuses(spark):
    shape = [SQUARE.tolist()]
    some = spark.createDataFrame([(1, shape)], "parcel_id long, shape array<array<array<double>>>")
    draft = spark.createDataFrame([(1, "R", "Low", shape)], "zone_id long, code string, name string, shape array<array<array<double>>>")
    rows = parcels.parcel_review(some, draft, 20.0)
    assert parcels.check_statuses(rows).first()["draft_match_fraction"] == 1.0
    for bad in ({"confidence": F.lit("sure")}, {"final_class_code": F.lit("R")}):
        try:
            parcels.check_statuses(rows.withColumns(bad)).collect()
            raise AssertionError("a bad status passed")
        except Exception as error:
            assert "status that is none" in str(error)
