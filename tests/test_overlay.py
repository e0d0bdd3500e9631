"""Overlay kernels against identities of area, and their Spark forms on small fixtures."""

from __future__ import annotations

import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelforge.functions import overlay
from parcelforge.operators import raster, shapes, validate
from parcelforge.sources.geopackage import GeoPackage, rings_of


def square(x, y, s):
    return [np.array([[x, y], [x + s, y], [x + s, y + s], [x, y + s]], float)]


def star(rng, n):
    turn = np.sort(rng.random(n)) * 2 * np.pi
    return [np.column_stack([np.cos(turn), np.sin(turn)]) * (rng.random((n, 1)) * 5 + 3) + rng.random(2) * 6]


@pytest.mark.parametrize("seed", range(12))
def test_areas_add_up(seed):
    rng = np.random.default_rng(seed)
    a, b = star(rng, 5 + seed), star(rng, 7)
    shared = overlay.shared_area(a, b)
    assert overlay.area(overlay.intersection(a, b)) == pytest.approx(shared, abs=1e-4)
    assert overlay.area(overlay.union([a, b])) == pytest.approx(overlay.area(a) + overlay.area(b) - shared, abs=1e-4)
    assert overlay.area(overlay.difference(a, b)) == pytest.approx(overlay.area(a) - shared, abs=1e-4)


@pytest.mark.parametrize("seed", range(6))
def test_convex_rings_agree_with_slabs(seed):
    rng = np.random.default_rng(seed)
    a, b = ([overlay.hull(star(rng, 9)[0])] for _ in range(2))
    assert overlay.is_convex(a[0]) and not overlay.is_convex(np.array([[0, 3], [2, -3], [-3, 1], [3, 1], [-2, -3]], float))
    assert overlay.shared_area(a, b) == pytest.approx(overlay.area(overlay.intersection(a, b)), abs=1e-4)
    assert overlay.shared_area(a, [b[0][::-1]]) == pytest.approx(overlay.shared_area(b, a), abs=1e-9)


def test_holes_touching_and_closing():
    a = square(0, 0, 10)
    holed = overlay.difference(a, square(2, 2, 2))
    assert (len(holed), overlay.area(holed), overlay.area(overlay.without_holes(holed))) == (2, 96.0, 100.0)
    assert overlay.meets(a, square(10, 10, 3)) and overlay.shared_area(a, square(10, 0, 3)) == 0
    assert not overlay.meets(a, square(10.5, 0, 3)) and overlay.meets(a, square(3, 3, 1))
    assert len(overlay.union([a, square(10, 0, 10)])) == 1
    assert overlay.area(overlay.buffer(a, 1.0)) == pytest.approx(140 + np.pi, abs=0.03)
    assert overlay.area(overlay.buffer(a, -6.0)) == 0
    assert len(overlay.close_gaps(square(0, 0, 4) + square(4.5, 0, 4), 0.5)) == 1
    assert overlay.union([]) == [] and overlay.shared_area([], a) == 0 and not overlay.meets([], a)


def test_faces_and_validity():
    lines = np.array([[0, 0, 10, 0], [10, 0, 10, 10], [10, 10, 0, 10], [0, 10, 0, 0], [5, -2, 5, 12], [0, 4, 10, 4]], float)
    assert sorted(overlay.area([f]) for f in overlay.faces(lines)) == [20, 20, 30, 30]
    assert len(overlay.faces(lines, 25)) == 2 and overlay.faces(lines[:2]) == []
    assert overlay.is_valid(square(0, 0, 1)[0])
    assert not overlay.is_valid(np.array([[0, 0], [2, 2], [2, 0], [0, 2]], float))


def test_nulls_and_empty_shapes(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]])], "parcel_id int, shape array<array<array<double>>>")
    same = rows.select("parcel_id", shapes.shared_area(F.col("shape"), F.col("shape")).alias("a"), shapes.geojson(F.col("shape")).alias("g"), shapes.hull(F.col("shape")).alias("h")).collect()
    assert [r["a"] for r in same] == [None, 0.0, 16.0] and same[0]["g"] is None and same[1]["h"] == []
    zones = rows.withColumnRenamed("parcel_id", "zone_id")
    assert [tuple(r) for r in shapes.overlaps(rows, zones, 3.0).collect()] == [(3, 3, 16.0)]
    assert shapes.overlaps(rows.limit(0), zones, 3.0).collect() == []
    slanted = spark.createDataFrame([(1, [[[4.0, 0.0], [8.0, 2.0], [4.0, 4.0]]]), (2, [[[2.0, 0.0], [4.0, 2.0], [2.0, 4.0], [0.0, 2.0]]]), (3, [[[4.5, 0.0], [8.0, 2.0], [4.5, 4.0]]])], "zone_id int, shape array<array<array<double>>>")
    assert sorted((r["zone_id"], r["shared"]) for r in shapes.overlaps(rows, slanted, 3.0).collect()) == [(1, 0.0), (2, 8.0)]
    row = rows.where("parcel_id = 3").select(shapes.centroid(F.element_at("shape", 1)).alias("c")).first()
    assert list(row["c"]) == [2.0, 2.0]


def test_geopackage(spark, tmp_path):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    wkb = struct.pack("<BIII", 1, 3, 1, len(ring)) + b"".join(struct.pack("<2d", *p) for p in ring)
    blob = b"GP\x00\x01" + struct.pack("<i", 2954) + struct.pack("<BII", 1, 6, 1) + wkb
    assert rings_of(blob) == [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0]]]
    path = str(tmp_path / "a.gpkg")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT)")
        con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        con.execute("CREATE TABLE zones (fid INTEGER PRIMARY KEY, geom BLOB, code TEXT, size REAL)")
        con.execute("INSERT INTO gpkg_contents VALUES ('zones', 'features')")
        con.execute("INSERT INTO gpkg_geometry_columns VALUES ('zones', 'geom')")
        con.executemany("INSERT INTO zones VALUES (?, ?, ?, ?)", [(i, blob if i % 2 else None, f"R{i}", 1.5) for i in range(1, 8)])
    spark.dataSource.register(GeoPackage)
    rows = spark.read.format("geopackage").option("rows", "3").load(path).orderBy("fid").collect()
    assert [(r["fid"], r["code"], r["size"], r["geom"] is None) for r in rows] == [(i, f"R{i}", 1.5, i % 2 == 0) for i in range(1, 8)]
    assert rows[0]["geom"] == [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0]]]


def test_raster(spark):
    row = spark.range(1).select(
        raster.hex_rgb(F.lit(255), F.lit(0), F.lit(10)).alias("h"), raster.usable(F.lit(250), F.lit(250), F.lit(250)).alias("white"),
        raster.usable(F.lit(90), F.lit(9), F.lit(9)).alias("red"), F.array(*raster.bilinear(F.lit(0.5), F.lit(0.5), [(0, 10), (10, 10), (10, 0), (0, 0)])).alias("mid"),
    ).first()
    assert (row["h"], row["white"], row["red"], row["mid"]) == ("#ff000a", False, True, [5.0, 5.0])


def test_schema():
    schema = {
        "type": "object", "required": ["a"], "additionalProperties": False,
        "properties": {"a": {"$ref": "#/defs/list"}, "b~": {"enum": [1, "x"]}, "c": {"anyOf": [{"type": "null"}, {"type": "string", "minLength": 2}]}},
        "defs": {"list": {"type": "array", "items": {"type": ["integer", "null"], "minimum": 0}}, "p": {"type": "string", "pattern": "^z"}},
    }
    found = lambda v: [(p, w) for p, w, _ in validate.Schema(schema).errors(v)]
    assert found({"a": [1, None], "c": None}) == [] and found([]) == [("$", "type")]
    assert found({"a": [True, -1], "b~": 2, "c": "s", "z/": 0}) == [("$/a/0", "type"), ("$/a/1", "minimum"), ("$/b~0", "enum"), ("$/c", "anyOf"), ("$/z~1", "additionalProperties")]
    assert found({}) == [("$", "required")]
