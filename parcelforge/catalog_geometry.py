"""Registered queries over shapes that are no upright rectangles: concave outlines, holes, touching shapes, triangles, lines, known coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelforge.functions import geo
from parcelforge.operators import colours, parcels, raster, shapes
from parcelforge.plans import answers
from parcelforge.registry import register, table


def _ring(x, y, *corners: tuple[float, float]):
    return F.array(*[F.array(x + a, y + b) for a, b in corners])


def _zones(spark, sf_dir):
    """L-shaped zones, and square ones with a square hole."""
    k = F.col("s_suppkey")
    x, y = k % 10 * 14.0, F.floor(k / 10) * 14.0
    bent = F.array(_ring(x, y, (0, 0), (12, 0), (12, 4), (5, 4), (5, 12), (0, 12)))
    hollow = F.array(_ring(x, y, (0, 0), (12, 0), (12, 12), (0, 12)), _ring(x, y, (2, 2), (2, 10), (10, 10), (10, 2)))
    return table(spark, sf_dir, "supplier").select(k.alias("zone_id"), F.concat(F.lit("Z"), k % 3).alias("code"), F.col("s_name").alias("name"), F.when(k % 2 == 0, bent).otherwise(hollow).alias("shape"))


def _parcels(spark, sf_dir):
    k = F.col("p_partkey")
    x, y = k % 70 * 2.0, F.floor(k / 70) * 2.0
    return table(spark, sf_dir, "part").select(k.alias("parcel_id"), shapes.make_envelope(x, y, x + 3, y + 3).alias("shape"))


_MET = """z AS (SELECT s_suppkey AS zone_id, s_suppkey % 2 = 0 AS bent, s_suppkey % 10 * 14.0::DOUBLE AS x, s_suppkey // 10 * 14.0::DOUBLE AS y FROM supplier),
  p AS (SELECT p_partkey AS parcel_id, p_partkey % 70 * 2.0::DOUBLE AS a, p_partkey // 70 * 2.0::DOUBLE AS b FROM part),
  n AS (SELECT parcel_id, zone_id, bent, a, b, x, y, greatest(0, least(a + 3, x + 12) - greatest(a, x)) AS w, greatest(0, least(b + 3, y + 12) - greatest(b, y)) AS h FROM p JOIN z ON a <= x + 12 AND x <= a + 3 AND b <= y + 12 AND y <= b + 3),
  m AS (SELECT parcel_id, zone_id, CASE WHEN bent THEN w * greatest(0, least(b + 3, y + 4) - greatest(b, y)) + greatest(0, least(a + 3, x + 5) - greatest(a, x)) * greatest(0, least(b + 3, y + 12) - greatest(b, y + 4))
      ELSE w * h - greatest(0, least(a + 3, x + 10) - greatest(a, x + 2)) * greatest(0, least(b + 3, y + 10) - greatest(b, y + 2)) END AS shared FROM n
    WHERE CASE WHEN bent THEN (b <= y + 4 OR a <= x + 5) ELSE NOT (a > x + 2 AND a + 3 < x + 10 AND b > y + 2 AND b + 3 < y + 10) END)"""


@register(f"WITH {_MET} SELECT parcel_id, zone_id, round(shared, 6)::DOUBLE AS shared FROM m")
def bent_overlaps(spark, sf_dir):
    return shapes.overlaps(_parcels(spark, sf_dir), _zones(spark, sf_dir), 20.0).withColumn("shared", F.round("shared", 6))


@register(f"""WITH {_MET}, r AS (SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY shared DESC, zone_id) AS rn FROM m)
  SELECT p.parcel_id, 'Z' || zone_id % 3 AS code, round(shared, 6)::DOUBLE AS shared FROM p LEFT JOIN r ON r.parcel_id = p.parcel_id AND rn = 1""")
def bent_zoning(spark, sf_dir):
    return answers.zoning(_parcels(spark, sf_dir), _zones(spark, sf_dir), 20.0).select("parcel_id", "code", F.round("shared", 6).alias("shared"))


@register(f"""WITH {_MET}, r AS (SELECT m.*, 'Z' || zone_id % 3 AS code, row_number() OVER (PARTITION BY parcel_id ORDER BY shared DESC, 'Z' || zone_id % 3, zone_id) AS rn FROM m)
  SELECT p.parcel_id, 9.0::DOUBLE AS parcel_area_m2, code AS draft_zone_code, s_name AS draft_zone_name, round(shared / 9, 6)::DOUBLE AS share, 'needs_review' AS review_status, NULL::VARCHAR AS final_zoning_code FROM p
  LEFT JOIN r ON r.parcel_id = p.parcel_id AND rn = 1 LEFT JOIN supplier ON s_suppkey = zone_id""")
def parcel_review(spark, sf_dir):
    rows = parcels.check_statuses(parcels.parcel_review(_parcels(spark, sf_dir), _zones(spark, sf_dir), 20.0))
    return rows.select("parcel_id", F.round("parcel_area_m2", 6).alias("parcel_area_m2"), "draft_zone_code", "draft_zone_name", F.round("draft_match_fraction", 6).alias("share"), "review_status", "final_zoning_code")


@register("""SELECT s_suppkey AS zone_id, CASE WHEN s_suppkey % 2 = 0 THEN 88.0 ELSE 80.0 END::DOUBLE AS area, CASE WHEN s_suppkey % 2 = 0 THEN 44.0 ELSE 40.0 END::DOUBLE AS cut, CASE WHEN s_suppkey % 2 = 0 THEN 44.0 ELSE 40.0 END::DOUBLE AS rest,
  CASE WHEN s_suppkey % 2 = 0 THEN 116.0 ELSE 144.0 END::DOUBLE AS hull_area, true AS valid, 'Valid Geometry' AS reason, false AS empty FROM supplier""")
def bent_shapes(spark, sf_dir):
    """Half the area of each shape, cut off by a bent outline and by a line through the hole."""
    rows = _zones(spark, sf_dir)
    corner = F.element_at(F.element_at("shape", 1), 1)
    x, y = corner[0], corner[1]
    other = F.when(F.col("zone_id") % 2 == 0, F.array(_ring(x, y, (-1, -1), (20, -1), (20, 2), (5, 2), (5, 6), (-1, 6)))).otherwise(F.array(_ring(x, y, (-1, -1), (6, -1), (6, 20), (-1, 20))))
    rows = rows.withColumn("other", other)
    area = lambda s: F.round(shapes.area(s), 6)
    made = rows.withColumns({"a": shapes.intersection(F.col("shape"), F.col("other")), "b": shapes.difference(F.col("shape"), F.col("other")), "c": shapes.hull(F.col("shape"))})
    return made.select("zone_id", area(F.col("shape")).alias("area"), area(F.col("a")).alias("cut"), area(F.col("b")).alias("rest"), area(F.col("c")).alias("hull_area"), shapes.is_valid(F.col("shape")).alias("valid"),
        shapes.validity_reason(F.col("shape")).alias("reason"), shapes.is_empty(F.col("a")).alias("empty"))


@register("""SELECT p_partkey // 60 % 4 AS zone, (count(*) * 25.0)::DOUBLE AS area FROM part GROUP BY 1""")
def dissolve_triangles(spark, sf_dir):
    """Squares cut along the diagonal, both halves of each, in strips that belong to one zone."""
    k = F.col("p_partkey")
    x, y = k % 60 * 5.0, F.floor(k / 60) * 5.0
    halves = F.array(F.array(_ring(x, y, (0, 0), (5, 0), (0, 5))), F.array(_ring(x, y, (5, 0), (5, 5), (0, 5))))
    rows = table(spark, sf_dir, "part").select((F.floor(k / 60) % 4).alias("zone"), F.explode(halves).alias("shape"))
    merged = shapes.dissolve(rows, "zone", 20.0)
    return merged.select("zone", F.round(shapes.area(F.col("shape")), 6).alias("area"))


@register("""SELECT place, round(east, 3) AS east, round(north, 3) AS north FROM (VALUES ('origin', 400000.0::DOUBLE, 800000.0::DOUBLE), ('south west', 381909.321, 686266.945), ('north east', 393845.106, 695157.736)) v(place, east, north)""")
def known_coordinates(spark, sf_dir):
    rows = spark.createDataFrame([("origin", -63.0, 47.25), ("south west", -63.2345, 46.2266), ("north east", -63.0799, 46.3068)], "place string, lon double, lat double")
    east, north = geo.project(F.col("lon"), F.col("lat"))
    return rows.select("place", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


@register("""SELECT p_partkey, round(1000 + (p_partkey % 40) * 2.5, 6)::DOUBLE AS x, round(5000 - (p_size) * 4.0, 6)::DOUBLE AS y FROM part""")
def affine_fit(spark, sf_dir):
    """A drawing of 80 by 100 units shifted by (10, 20), laid on a map box of 200 by 400."""
    placed = shapes.compose((1.0, 0.0, -10.0, 0.0, 1.0, -20.0), shapes.fit((0.0, 0.0, 80.0, 100.0), (1000.0, 4600.0, 1200.0, 5000.0)))
    one = F.array(F.array(F.array(F.col("p_partkey") % 40 + 10.0, F.col("p_size") + 20.0)))
    moved = shapes.transform(one, *placed)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(moved[0][0][0], 6).alias("x"), F.round(moved[0][0][1], 6).alias("y"))


@register("""WITH d AS (SELECT p_partkey AS id, p_size, CASE p_partkey % 3 WHEN 0 THEN 'RES' WHEN 1 THEN 'COM' END AS code, greatest(0, least(p_size + p_partkey % 40, 60) - p_partkey % 40) * least(p_size, 40) / 2.0 AS a FROM part)
  SELECT id, code, round(a, 6)::DOUBLE AS area FROM d WHERE code IS NOT NULL AND a >= 10 AND a > 0""")
def filled_layers(spark, sf_dir):
    """Filled triangles clipped to a box far larger, except for boxes beyond its edge."""
    k, s = F.col("p_partkey"), F.col("p_size").cast("double")
    x, w, h = k % 40 * 1.0, F.greatest(F.least(F.col("p_size") + F.col("p_partkey") % 40, F.lit(60)) - F.col("p_partkey") % 40, F.lit(0)).cast("double"), F.least(s, F.lit(40.0))
    ring = F.array(F.array(F.array(x, F.lit(0.0)), F.array(x + w, F.lit(0.0)), F.array(x, h)))
    rows = table(spark, sf_dir, "part").select(k.alias("id"), F.element_at(F.array(F.lit("#aa0000"), F.lit("#00aa00"), F.lit("#123456")), (k % 3 + 1).cast("int")).alias("fill"), ring.alias("shape"))
    boundary = [[[0.0, 0.0], [100.0, 0.0], [100.0, 100.0], [0.0, 100.0]]]
    found = shapes.filled_layer(rows, ["id"], {"#aa0000": "RES", "#00aa00": "COM"}, boundary, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0), 10.0)
    return found.select("id", "code", F.round("area", 6).alias("area"))


@register("""WITH l AS (SELECT p_partkey AS id, p_size AS y, p_partkey % 4 < 3 AS black FROM part) SELECT id, u.part, 20.0::DOUBLE AS length, 2::BIGINT AS points FROM l, (VALUES (0), (1)) u(part) WHERE black AND y > 0 AND y < 60""")
def line_layers(spark, sf_dir):
    """Strokes that wiggle by less than the reach and leave a boundary of two blocks between them: two straight parts each."""
    k, y = F.col("p_partkey"), F.col("p_size").cast("double")
    line = F.array(*[F.array(F.lit(float(a)), y + b) for a, b in ((-5, 0.0), (10, 0.1), (25, 0.0), (45, -0.1), (65, 0.0))])
    flat = F.transform(line, lambda p: F.array(p[0], y))
    rows = table(spark, sf_dir, "part").select(k.alias("id"), F.when(k % 4 < 3, "#000000").otherwise("#0000ff").alias("colour"), F.when(k % 2 == 0, 0.1).otherwise(0.25).alias("width"), flat.alias("line"))
    boundary = [[[0.0, 0.0], [20.0, 0.0], [20.0, 60.0], [0.0, 60.0]], [[40.0, 0.0], [60.0, 0.0], [60.0, 60.0], [40.0, 60.0]]]
    found = shapes.line_layer(rows, ["id"], (0.1, 0.25), boundary, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0))
    return found.select("id", "part", F.round("length", 6).alias("length"), F.size("line").cast("long").alias("points"))


@register("""SELECT p_partkey * 2 AS parcel_id, CASE WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS parts, CASE WHEN p_partkey % 3 = 0 THEN 100.0 ELSE 50.0 END::DOUBLE AS area FROM part
  UNION ALL SELECT p_partkey * 2 + 1, 1, 50.0 FROM part WHERE p_partkey % 3 > 0""")
def merged_triangles(spark, sf_dir):
    """Squares cut along the diagonal: the halves that touch are joined, those that stand apart are not."""
    k = F.col("p_partkey")
    x, y = k % 50 * 30.0, F.floor(k / 50) * 30.0
    gap = F.when(k % 3 == 0, 0.0).otherwise(3.0)
    one, two = F.array(_ring(x, y, (0, 0), (10, 0), (0, 10))), F.array(_ring(x + gap, y + gap, (10, 10), (0, 10), (10, 0)))
    both = F.array(F.struct((k * 2).alias("parcel_id"), one.alias("shape")), F.struct((k * 2 + 1).alias("parcel_id"), two.alias("shape")))
    rows = table(spark, sf_dir, "part").select(F.inline(both))
    merged = shapes.merge_diagonals(rows, 20.0)
    return merged.select("parcel_id", F.size("source_ids").cast("long").alias("parts"), F.round(shapes.area(F.col("shape")), 6).alias("area"))


_ADDRESSES = """a AS (SELECT c_custkey AS id, (c_custkey % 300)::VARCHAR AS no, 'Main ' || c_mktsegment AS street, CASE WHEN c_custkey % 4 = 0 THEN c_nationkey::VARCHAR END AS unit, CASE WHEN c_custkey % 5 > 0 THEN 'Town ' || c_nationkey END AS comm, CASE WHEN c_custkey % 3 > 0 THEN (c_custkey + 1000)::VARCHAR END AS pid FROM customer),
  l AS (SELECT *, concat_ws(', ', concat_ws(' ', no, street, 'Unit ' || unit), comm, 'PID ' || pid) AS label FROM a)"""


@register(f"""WITH {_ADDRESSES} SELECT id AS address_id, label, unit, pid, CASE WHEN starts_with(lower(label), '1013') THEN 'high' WHEN contains(lower(label), '1013') THEN 'medium' ELSE 'low' END AS confidence
  FROM l WHERE contains(lower(label), '1013') OR pid = '1013' ORDER BY CASE WHEN pid = '1013' THEN 0 WHEN starts_with(lower(label), '1013') THEN 1 ELSE 2 END, label, id LIMIT 25""")
def address_search(spark, sf_dir):
    k = F.col("c_custkey")
    body = F.to_json(F.struct(
        (k % 300).cast("string").alias("STREET_NO"), F.concat(F.lit(" Main "), F.col("c_mktsegment")).alias("STREET_NM"), F.when(k % 4 == 0, F.col("c_nationkey").cast("string")).otherwise(" ").alias("APT_NO"),
        F.when(k % 5 > 0, F.concat(F.lit("Town "), F.col("c_nationkey"))).alias("COMM_NM"), F.when(k % 3 > 0, (k + 1000).cast("string")).alias("PID"),
    ))
    rows = table(spark, sf_dir, "customer").select(k.alias("address_id"), body.alias("attributes"))
    return parcels.search_addresses(rows, " 1013 ", 25).select("address_id", "label", "unit", "pid", "confidence")


@register("""SELECT s_suppkey::VARCHAR AS feature_key, '{"type":"Feature","id":"' || s_suppkey || '","geometry":{"type":"Polygon","coordinates":[[[0.0,0.0],[4.0,0.0],[0.0,' || s_suppkey % 7 + 1 || '.0],[0.0,0.0]]]},"properties":{"zoneCode":"' ||
  CASE s_suppkey % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'N' ELSE 'R' END || '","zoneName":"' || s_name || '","zoneCodeRaw":"R","zoneCodeNormalized":' || CASE WHEN s_suppkey % 3 < 2 THEN '"N"' ELSE 'null' END || ',"bylawZoneCode":' || CASE WHEN s_suppkey % 3 = 0 THEN '"B"' ELSE 'null' END ||
  ',"matchMethod":null,"areaM2":' || (s_suppkey % 7 + 1) * 2 || '.0,"attributes":"{}","source":{"table":"draft","featureKey":"' || s_suppkey || '","isValid":true,"validationReason":"Valid Geometry"}}}' AS feature FROM supplier""")
def zone_geojson(spark, sf_dir):
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    ring = F.array(F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(4.0), F.lit(0.0)), F.array(F.lit(0.0), k % 7 + 1.0)))
    rows = table(spark, sf_dir, "supplier").select(
        k.cast("string").alias("feature_key"), ring.alias("shape"), F.lit("R").alias("zone_code_raw"), F.when(k % 3 < 2, "N").alias("zone_code_normalized"), F.when(k % 3 == 0, "B").alias("bylaw_zone_code"), none.alias("match_method"),
        F.lit("{}").alias("attributes"), F.lit(True).alias("is_valid"), F.lit("Valid Geometry").alias("validation_reason"), "s_name",
    )
    return parcels.zone_features(rows, "draft", "s_name")


@register("""SELECT p_partkey::VARCHAR AS feature_key, '{"type":"Feature","id":"' || p_partkey || '","geometry":{"type":"Polygon","coordinates":[[[0.0,0.0],[2.0,0.0],[2.0,3.0],[0.0,3.0],[0.0,0.0]]]},"properties":{"parcelId":"' || p_partkey ||
  '","areaM2":6.0,"attributes":"{}","source":{"table":"parcels","featureKey":"' || p_partkey || '","isValid":true,"validationReason":"Valid Geometry"}}}' AS feature FROM part""")
def parcel_geojson(spark, sf_dir):
    box = shapes.make_envelope(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(3.0))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("feature_key"), box.alias("shape"), F.lit("{}").alias("attributes"), F.lit(True).alias("is_valid"), F.lit("Valid Geometry").alias("validation_reason"))
    return parcels.parcel_features(rows, "parcels")


@register("""SELECT code, count(*) AS pixels FROM (SELECT CASE WHEN event_id // 100 BETWEEN 10 AND 19 AND event_id % 100 < 50 THEN NULL ELSE event_type END AS code FROM events) GROUP BY code""")
def pixel_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 100).alias("row"), (F.col("event_id") % 100).alias("col"), F.col("event_type").alias("code"))
    return colours.histogram(colours.masked(rows, [(10, 0, 20, 50)]), "code")


@register("""WITH s AS (SELECT l_orderkey AS id, l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS place, CASE l_returnflag WHEN 'A' THEN 200 WHEN 'R' THEN 40 END AS r, CASE l_linestatus WHEN 'F' THEN 90 ELSE 10 END AS g FROM lineitem), v AS (SELECT * FROM s WHERE r IS NOT NULL),
  m AS (SELECT id, printf('#%02x%02x00', round(avg(r))::INT, round(avg(g))::INT) AS mean_rgb FROM v GROUP BY id), c AS (SELECT id, r, g, count(*) AS n, min(place) AS f FROM v GROUP BY ALL), d AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, f) AS k FROM c)
  SELECT id, mean_rgb, printf('#%02x%02x00', r, g) AS dominant_rgb FROM m JOIN d USING (id) WHERE k = 1""")
def sample_colours(spark, sf_dir):
    red = F.when(F.col("l_returnflag") == "A", 200).when(F.col("l_returnflag") == "R", 40)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("place"), red.alias("r"), F.when(F.col("l_linestatus") == "F", 90).otherwise(10).alias("g"), F.lit(0).alias("b"))
    return colours.sample_colours(rows, "id", "place")


@register("""SELECT p_partkey, round(10 + (p_partkey % 5) / 5.0::DOUBLE * 20, 6) AS x, round(40 - (p_size % 4) / 4.0::DOUBLE * 8, 6) AS y FROM part""")
def bilinear_places(spark, sf_dir):
    u, v = (F.col("p_partkey") % 5) / 5.0, (F.col("p_size") % 4) / 4.0
    x, y = raster.bilinear(u, v, [(10.0, 40.0), (30.0, 40.0), (30.0, 32.0), (10.0, 32.0)])
    return table(spark, sf_dir, "part").select("p_partkey", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))
