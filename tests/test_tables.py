"""Rebuilt tables, condition rows, patches, drawings, strategy content, tiles, sample grids and the GeoPackage sink on small fixtures."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelforge.functions import overlay
from parcelforge.operators import drawing, extraction, raster, shapes, tables
from parcelforge.sources.geopackage import GeoPackage, blob_of, rings_of

SQUARE = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0]]
HOLE = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0]]


def test_condition_rows(spark):
    rows = [("Frontage Front access Rear lane", "6 m (20 ft) 8 m", ""), ("Yard Front access Rear lane", "6 m", None), ("Height", "9 m", None), (None, None, None)]
    got = tables.condition_rows(spark.createDataFrame(rows, "req string, a string, b string"), "req", ["a", "b"], [["Front access", "Rear lane"]])
    assert [tuple(r) for r in got.select("req", "condition", "part", "a", "b").orderBy("req", "part").collect()] == [
        (None, "", 1, None, None), ("Frontage", "Front access", 1, "6 m (20 ft)", ""), ("Frontage", "Rear lane", 2, "8 m", ""), ("Height", "", 1, "9 m", None),
        ("Yard Front access Rear lane", "", 1, "6 m", None),
    ]


def test_rebuild(spark):
    words = [
        (1, 5.0, 1.0, "loose"), (1, 10.0, 11.0, "Use"), (1, 50.0, 12.0, "Lot"), (1, 10.0, 20.0, "home"), (1, 51.0, 20.0, "6"), (1, 56.0, 20.5, "m"),
        (2, 52.0, 3.0, "min"), (2, 9.0, 9.0, "shop"), (2, 50.0, 9.0, "8"),
    ]
    got = tables.rebuild(spark.createDataFrame([(1, *w) for w in words], "doc int, page int, x double, y double, text string"), "doc", "page", "^Use Lot$")
    assert {tuple(r) for r in got.collect()} == {(1, 1, 1, 0, "Use", "home"), (1, 1, 1, 1, "Lot", "6 m min"), (1, 1, 2, 0, "Use", "shop"), (1, 1, 2, 1, "Lot", "8")}


def test_patches_and_scopes(spark):
    rows = spark.createDataFrame([("a", "h1", "x"), ("b", "h2", "y"), ("c", "h3", "z")], "key string, content_hash string, v string")
    patches = spark.createDataFrame([("a", "h1", {"v": "X"}), ("b", "old", {"v": "Y"})], "key string, content_hash string, patch map<string,string>")
    assert {tuple(r) for r in tables.apply_patches(rows, patches, "key", ["v"]).collect()} == {("a", "h1", "X", True), ("b", "h2", "y", False), ("c", "h3", "z", None)}
    scopes = spark.createDataFrame([("a", "corner", "p"), ("a", "inner", "q")], "key string, scope string, v string")
    got = {(r["key"], r["scope"], r["v"]) for r in tables.scoped_alternatives(rows, ["key"], scopes, "v").collect()}
    assert got == {("a", "corner", "p"), ("a", "inner", "q"), ("b", None, "y"), ("c", None, "z")}


def test_drawing(spark):
    items = [(1, "l", [0.0, 0, 1, 0]), (2, "l", [1.0, 0, 1, 1]), (3, "re", [0.0, 0, 2, 3]), (4, "l", [5.0, 5, 5, 5]), (5, "c", [0.0, 0, 0, 1, 1, 1, 1, 0]), (6, "x", [1.0])]
    got = drawing.paths(spark.createDataFrame([("d", *i, [float(v) for v in c]) for *i, c in items], "doc string, at int, kind string, coords array<double>"), ["doc"], "at").orderBy("path").collect()
    assert [r["points"] for r in got[:2]] == [[[0, 0], [1, 0], [1, 1]], [[0, 0], [2, 0], [2, 3], [0, 3], [0, 0]]]
    assert len(got) == 3 and len(got[2]["points"]) == 9 and got[2]["points"][4] == [0.5, 0.75]


def test_strategy_content(spark):
    texts = ["lead in", "HOUSING", "Objective: homes", "for all", None, "Policy 1.1 shall build", "TRADE", "context again"]
    lines = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc int, at int, line string")
    got = extraction.strategy_content(lines, ["doc"], ["at"], "line", "^[A-Z ]+$", "^Objective()[:]", r"^Policy (\d+\.\d+)").orderBy("place").collect()
    assert [tuple(r)[1:] for r in got] == [
        (1, "context", None, None, "lead in"), (2, "objective", "HOUSING", None, "homes for all"), (3, "policy", "HOUSING", "1.1", "shall build"), (4, "context", "TRADE", None, "context again")
    ]


def test_tiles(spark):
    pixels = spark.range(600).select((F.col("id") % 20).alias("row"), F.floor(F.col("id") / 20).alias("col"), F.col("id").alias("v"))
    tiled = raster.tiles(pixels, ["v"], 16)
    assert tiled.count() == 4 and sorted(map(tuple, raster.from_tiles(tiled).collect())) == sorted(map(tuple, pixels.collect()))


def test_sample_grid(spark):
    got = overlay.sample_grid([np.array(SQUARE) * 10])
    assert len(got) == 49 and all(overlay.inside([np.array(SQUARE) * 10], np.array(got)))
    hollow = [np.array(SQUARE), np.array(HOLE)]
    assert [5.0, 5.0] not in overlay.sample_grid(hollow) and len(overlay.sample_grid(hollow)) == 9
    assert overlay.sample_grid([]) == [] and len(overlay.sample_grid([np.array([[0.0, 0], [1, 0]])])) == 1
    triangle = np.array([[0.0, 0], [0, 9], [12, 0]])  # inradius 3, area 54
    assert abs(overlay.area(overlay._inset_convex(triangle, 1.08)) - 54 * 0.64**2) < 1e-9 and overlay._inset_convex(triangle, 3.1) == []
    row = spark.createDataFrame([([SQUARE],), (None,)], "shape array<array<array<double>>>").select(shapes.sample_grid(F.col("shape")).alias("p")).collect()
    assert len(row[0]["p"]) == 10 and row[1]["p"] is None


def test_geopackage_sink(spark, tmp_path):
    assert rings_of(blob_of([SQUARE, HOLE], 2954)) == [SQUARE, HOLE] and blob_of(None, 1) is None
    spark.dataSource.register(GeoPackage)
    rows = spark.createDataFrame([(i, f"R{i}", [SQUARE, HOLE] if i % 2 else None) for i in range(9)], "id long, code string, geom array<array<array<double>>>")
    folder = str(tmp_path / "zones")
    for mode, n in (("append", 9), ("append", 18), ("overwrite", 9)):
        rows.repartition(3).write.format("geopackage").option("layer", "zones").mode(mode).save(folder)
        got = spark.read.format("geopackage").option("layer", "zones").load(folder).collect()
        assert len(got) == n and {(r["id"], r["code"], r["geom"] is None) for r in got} == {(i, f"R{i}", i % 2 == 0) for i in range(9)}
    with pytest.raises(Exception, match="geom"):
        rows.drop("geom").write.format("geopackage").mode("append").save(folder)
