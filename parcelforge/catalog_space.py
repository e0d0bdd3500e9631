"""Registered queries of the geometry, raster and validation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelforge.operators import raster, shapes, validate
from parcelforge.plans import answers
from parcelforge.registry import register, table

_ZONES = """z AS (SELECT s_suppkey AS zone_id, s_suppkey % 10 * 10.0 AS x0, s_suppkey // 10 % 10 * 10.0 AS y0, s_suppkey % 10 * 10.0 + 12 AS x1, s_suppkey // 10 % 10 * 10.0 + 12 AS y1 FROM supplier)"""
_PARCELS = """p AS (SELECT p_partkey AS parcel_id, p_partkey % 100 * 1.0 AS a0, p_size * 1.0 AS b0, p_partkey % 100 + 7.0 AS a1, p_size + 9.0 AS b1 FROM part)"""
_MET = f"""{_ZONES}, {_PARCELS}, m AS (SELECT parcel_id, zone_id, ((least(a1, x1) - greatest(a0, x0)) * (least(b1, y1) - greatest(b0, y0)))::DOUBLE AS shared
  FROM p JOIN z ON a0 <= x1 AND x0 <= a1 AND b0 <= y1 AND y0 <= b1)"""
_BEST = "SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY shared DESC, zone_id) AS rn FROM m"


def _zones(spark, sf_dir):
    k = F.col("s_suppkey")
    x, y = k % 10 * 10.0, F.floor(k / 10) % 10 * 10.0
    return table(spark, sf_dir, "supplier").select(k.alias("zone_id"), F.concat(F.lit("Z"), (k % 3).cast("string")).alias("code"), shapes.make_envelope(x, y, x + 12, y + 12).alias("shape"))


def _parcels(spark, sf_dir):
    x, y = F.col("p_partkey") % 100 * 1.0, F.col("p_size") * 1.0
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("parcel_id"), shapes.make_envelope(x, y, x + 7, y + 9).alias("shape"))


def _points(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("address_id"), F.col("c_name").alias("label"), (k * 7 % 107).cast("double").alias("x"), (k % 61).cast("double").alias("y"))


@register(f"WITH {_MET} SELECT parcel_id, zone_id, round(shared, 6) AS shared FROM m")
def polygon_overlaps(spark, sf_dir):
    return shapes.overlaps(_parcels(spark, sf_dir), _zones(spark, sf_dir), 20.0, 6)


@register(f"""WITH {_MET}, b AS ({_BEST}) SELECT p.parcel_id, 'Z' || zone_id % 3 AS code, round(shared, 6) AS shared FROM p LEFT JOIN b ON p.parcel_id = b.parcel_id AND rn = 1""")
def parcel_zoning(spark, sf_dir):
    return answers.zoning(_parcels(spark, sf_dir), _zones(spark, sf_dir), 20.0).select("parcel_id", "code", F.round("shared", 6).alias("shared"))


@register(f"""WITH {_MET}, c AS ({_BEST}), d AS (SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY shared DESC, zone_id) AS rn FROM m WHERE zone_id % 4 > 0),
  r AS (SELECT p.parcel_id, 'Z' || c.zone_id % 3 AS a, 'Z' || d.zone_id % 3 AS b FROM p LEFT JOIN c ON p.parcel_id = c.parcel_id AND c.rn = 1 LEFT JOIN d ON p.parcel_id = d.parcel_id AND d.rn = 1)
  SELECT parcel_id, a AS current_code, b AS draft_code, CASE WHEN a IS NULL AND b IS NULL THEN 'pending' WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' WHEN a = b THEN 'same' ELSE 'changed' END AS change FROM r""")
def zoning_comparison(spark, sf_dir):
    zones = _zones(spark, sf_dir)
    return answers.comparison(_parcels(spark, sf_dir), zones, zones.where("zone_id % 4 > 0"), 20.0)


@register(f"""WITH {_PARCELS} SELECT parcel_id FROM p WHERE a0 <= 40 AND 20 <= a1 AND b0 <= 30 AND 10 <= b1 ORDER BY parcel_id LIMIT 25""")
def viewport(spark, sf_dir):
    return answers.viewport(_parcels(spark, sf_dir), "parcel_id", (20.0, 10.0, 40.0, 30.0), 25).select("parcel_id")


@register("""WITH f AS (SELECT s_suppkey AS id, s_suppkey % 10 * 10.0::DOUBLE AS x, s_suppkey // 10 % 10 * 10.0::DOUBLE AS y FROM supplier)
  SELECT '{"type":"FeatureCollection","features":[' || string_agg('{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[' || x || ',' || y || '],[' || x + 12 || ',' || y || '],[' || x + 12 || ',' || y + 12 ||
  '],[' || x || ',' || y + 12 || '],[' || x || ',' || y || ']]]},"properties":{"zone_id":' || id || ',"code":"Z' || id % 3 || '"}}', ',' ORDER BY id) || ']}' AS geojson FROM f""")
def feature_collection(spark, sf_dir):
    return answers.feature_collection(_zones(spark, sf_dir), "zone_id", ["zone_id", "code"])


@register(f"""WITH {_MET}, a AS (SELECT c_custkey AS i, c_name AS n, c_custkey * 7 % 107 AS x, c_custkey % 61 AS y FROM customer), b AS ({_BEST})
  SELECT p.parcel_id, 'Z' || b.zone_id % 3 AS code, (a0 + 3.5)::DOUBLE AS cx, (b0 + 4.5)::DOUBLE AS cy,
  (SELECT coalesce(string_agg(n, ',' ORDER BY i), '') FROM a WHERE x BETWEEN a0 AND a1 AND y BETWEEN b0 AND b1) AS addresses
  FROM p LEFT JOIN b ON p.parcel_id = b.parcel_id AND rn = 1 WHERE p.parcel_id = 7""")
def parcel_by_id(spark, sf_dir):
    found = answers.parcel_by_id(_parcels(spark, sf_dir), _points(spark, sf_dir), _zones(spark, sf_dir), 7, 20.0)
    return found.select("parcel_id", "code", F.round(F.col("centroid")[0], 6).alias("cx"), F.round(F.col("centroid")[1], 6).alias("cy"), F.array_join("addresses", ",").alias("addresses"))


@register(f"""WITH {_PARCELS}, o AS (SELECT * FROM p WHERE 33.0 BETWEEN a0 AND a1 AND 21.0 BETWEEN b0 AND b1 ORDER BY (a1 - a0) * (b1 - b0), parcel_id LIMIT 1),
  a AS (SELECT c_custkey AS i, c_custkey * 7 % 107 AS x, c_custkey % 61 AS y FROM customer)
  SELECT parcel_id, (SELECT i FROM a WHERE x BETWEEN a0 AND a1 AND y BETWEEN b0 AND b1 ORDER BY (x - 33) ** 2 + (y - 21) ** 2, i LIMIT 1) AS address_id FROM o""")
def parcel_at(spark, sf_dir):
    found = answers.parcel_at(_parcels(spark, sf_dir), _points(spark, sf_dir), 33.0, 21.0)
    return found.select("parcel_id", F.col("address.address_id").alias("address_id"))


@register("""WITH g AS (SELECT DISTINCT p_size % 5 AS zone, p_partkey % 40 AS x, p_size AS y FROM part) SELECT zone, (count(*) * 1.0)::DOUBLE AS area FROM g GROUP BY zone""")
def dissolve(spark, sf_dir):
    x, y = F.col("p_partkey") % 40 * 1.0, F.col("p_size") * 1.0
    rows = table(spark, sf_dir, "part").select((F.col("p_size") % 5).alias("zone"), shapes.make_envelope(x, y, x + 1, y + 1).alias("shape"))
    merged = shapes.dissolve(rows, "zone", 10.0)
    return merged.select("zone", F.round(shapes.area(F.col("shape")), 6).alias("area"))


@register("""SELECT s_suppkey, 78.0::DOUBLE AS cut, 66.0::DOUBLE AS rest, 4 * 4.0::DOUBLE AS inner_area, 144.0::DOUBLE AS hull_area, true AS valid FROM supplier""")
def overlay_areas(spark, sf_dir):
    rows = _zones(spark, sf_dir).select(F.col("zone_id").alias("s_suppkey"), "shape")
    area = lambda s: F.round(shapes.area(s), 6)

    def made(rows):
        corner = F.element_at(F.element_at("shape", 1), 1)
        other = shapes.make_envelope(corner[0] - 1, corner[1] - 1, corner[0] + 6.5, corner[1] + 30)
        rows = rows.withColumns({"a": shapes.intersection(F.col("shape"), other), "b": shapes.difference(F.col("shape"), other), "c": shapes.buffer(F.col("shape"), -4.0), "d": shapes.hull(F.col("shape"))})
        return rows.select("shape", area(F.col("a")).alias("cut"), area(F.col("b")).alias("rest"), area(F.col("c")).alias("inner_area"), area(F.col("d")).alias("hull_area"), shapes.is_valid(F.col("shape")).alias("valid"))

    return shapes.once_per_shape(rows, "shape", made).select("s_suppkey", "cut", "rest", "inner_area", "hull_area", "valid")


@register("""SELECT s_suppkey AS sheet, 3 AS faces, ((12 + s_suppkey % 5) * 7.0)::DOUBLE AS area FROM supplier""")
def polygonize(spark, sf_dir):
    # a box 7 high, 12 to 16 wide, with two cuts through it and a line apart: three faces over the least area
    k = F.col("s_suppkey")
    w, x, y = 12.0 + k % 5, k % 100 * 30.0, F.floor(k / 100) * 30.0
    zero, high = F.lit(0.0), F.lit(7.0)
    segments = [(zero, zero, w, zero), (w, zero, w, high), (w, high, zero, high), (zero, high, zero, zero), (F.lit(4.0), F.lit(-1.0), F.lit(4.0), F.lit(8.0)), (F.lit(8.0), F.lit(-2.0), F.lit(8.0), high), (F.lit(20.0), F.lit(20.0), F.lit(21.0), F.lit(20.0))]
    parts = F.array(*[F.struct(*[(v + (x if n[0] == "x" else y)).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), s, strict=True)]) for s in segments])
    lines = table(spark, sf_dir, "supplier").select(k.alias("sheet"), F.inline(parts))
    found = shapes.polygonize(lines, "sheet", 20.0).withColumn("area", shapes.area(F.col("shape")))
    return found.groupBy("sheet").agg(F.count(F.lit(1)).alias("faces"), F.round(F.sum("area"), 6).alias("area"))


_CLASSES = [("red", 200, 40, 40, 90.0), ("green", 40, 200, 40, 90.0), ("blue", 40, 40, 200, 90.0)]
_PIXELS = """x AS (SELECT event_id // 90 AS "row", event_id % 90 AS col FROM events), c AS (SELECT *, "row" * 4 % 256 AS r, col * 2 AS g, ("row" * 3 + col) % 256 AS b FROM x),
  k(i, code, kr, kg, kb) AS (VALUES (0, 'red', 200, 40, 40), (1, 'green', 40, 200, 40), (2, 'blue', 40, 40, 200)),
  d AS (SELECT "row", col, i, code, sqrt((r - kr) ** 2 + (g - kg) ** 2 + (b - kb) ** 2) AS d FROM c, k WHERE NOT least(r, g, b) >= 242 AND NOT greatest(r, g, b) <= 28),
  n AS (SELECT "row", col, CASE WHEN min(d) <= 90 THEN arg_min(code, (d, i)) END AS code, min(d) AS distance FROM d GROUP BY "row", col)"""


def _pixels(spark, sf_dir):
    e = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(F.floor(e / 90).alias("row"), (e % 90).alias("col"))
    rows = rows.withColumns({"r": F.col("row") * 4 % 256, "g": F.col("col") * 2, "b": (F.col("row") * 3 + F.col("col")) % 256})
    near = raster.nearest_class(F.col("r"), F.col("g"), F.col("b"), _CLASSES)
    return rows.where(raster.usable(F.col("r"), F.col("g"), F.col("b"))).withColumn("_n", near).select("row", "col", "r", "g", "b", F.col("_n.code").alias("code"), F.col("_n.distance").alias("distance"))


@register(f"""WITH {_PIXELS} SELECT "row", col, code, round(distance, 6) AS distance, printf('#%02x%02x%02x', r::INT, g::INT, b::INT) AS colour FROM n JOIN c USING ("row", col)""")
def pixel_classes(spark, sf_dir):
    rows = _pixels(spark, sf_dir)
    return rows.select("row", "col", "code", F.round("distance", 6).alias("distance"), raster.hex_rgb(F.col("r"), F.col("g"), F.col("b")).alias("colour"))


@register(f"""WITH {_PIXELS}, g AS (SELECT *, col - row_number() OVER (PARTITION BY "row", code ORDER BY col) AS g FROM n WHERE code IS NOT NULL)
  SELECT "row", code, min(col) AS col_start, max(col) AS col_end FROM g GROUP BY "row", code, g""")
def pixel_runs(spark, sf_dir):
    return raster.runs(_pixels(spark, sf_dir).where("code IS NOT NULL"), "code")


@register(f"""WITH {_PIXELS}, p AS (SELECT p_partkey AS id, p_partkey % 80 AS x0, p_size % 50 AS y0, CASE WHEN p_partkey % 2 = 0 THEN 9 ELSE 40 END AS s FROM part),
  q AS (SELECT *, CASE WHEN s * s > 8000 THEN 7 WHEN s * s > 1000 THEN 5 ELSE 3 END AS m FROM p),
  t AS (SELECT id, u.place, x0 + (u.place // m + 0.5::DOUBLE) * s / m AS x, y0 + (u.place % m + 0.5::DOUBLE) * s / m AS y FROM q, LATERAL (SELECT unnest(range(m * m)) AS place) u),
  v AS (SELECT t.id, t.place, n.code, n.distance FROM t LEFT JOIN n ON n."row" = floor(60 - t.y) AND n.col = floor(t.x)),
  h AS (SELECT id, code, count(*) AS matched, avg(distance) AS mean_distance, min(place) AS f FROM v WHERE code IS NOT NULL GROUP BY id, code),
  b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY matched DESC, f) AS rn FROM h)
  SELECT s.id, s.samples, coalesce(matched, 0) AS matched, code, round(matched / samples, 6) AS share, round(mean_distance, 6) AS mean_distance,
  CASE WHEN matched / samples >= 0.72 AND mean_distance <= 45 THEN 'high' WHEN matched / samples >= 0.48 AND mean_distance <= 60 THEN 'medium' ELSE 'low' END AS confidence
  FROM (SELECT id, count(*) AS samples FROM v GROUP BY id) s LEFT JOIN b ON s.id = b.id AND rn = 1""")
def raster_votes(spark, sf_dir):
    x, y, s = F.col("p_partkey") % 80 * 1.0, F.col("p_size") % 50 * 1.0, F.when(F.col("p_partkey") % 2 == 0, 9.0).otherwise(40.0)
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + s).alias("x1"), (y + s).alias("y1"))
    parcels = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), box.alias("box"))
    found = raster.sample(raster.sample_points(parcels, "id", "box"), _pixels(spark, sf_dir), 0.0, 60.0, 1.0)
    voted = raster.votes(found, "id", "code", "distance", "place")
    return voted.withColumns({"share": F.round("share", 6), "mean_distance": F.round("mean_distance", 6)})


@register("""SELECT event_id, CASE WHEN json_extract_string(props, '$.k')::INT < 50 THEN 'minimum' ELSE '' END AS broken FROM events""")
def schema_errors(spark, sf_dir):
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"$ref": "#/defs/n"}}, "defs": {"n": {"type": ["integer"], "minimum": 50}}}
    errors = validate.schema_errors(F.col("props"), schema)
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.transform(errors, lambda e: e["validator"]), ",").alias("broken"))


@register("""SELECT p_brand, p_type, count(*) AS times FROM part GROUP BY p_brand, p_type HAVING count(*) > 1""")
def duplicate_codes(spark, sf_dir):
    return validate.duplicate_codes(table(spark, sf_dir, "part"), ["p_brand"], "p_type")
