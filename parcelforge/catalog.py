"""Registered queries of the reference's operators over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelforge.functions import geo, measure, text
from parcelforge.operators import references, rules, sequence, similarity, spatial, versioning
from parcelforge.plans import requests
from parcelforge.registry import Query, sql_of
from parcelforge.registry import queries as _queries
from parcelforge.registry import register as _register
from parcelforge.registry import table as _table


def _round(c, digits: int = 6):
    return F.round(c, digits)


@_register("""SELECT o_orderkey, count(l_orderkey) AS rules, count(*) FILTER (l_returnflag = 'A') AS permitted,
  count(*) FILTER (l_returnflag = 'R') AS prohibited, count(DISTINCT lower(trim(l_linestatus))) FILTER (l_returnflag = 'N') AS uses
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def rule_counts(spark, sf_dir):
    return rules.counts(
        _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey", "l_returnflag", "l_linestatus",
        {"permitted": ["A"], "prohibited": ["R"]}, ["N"],
    )


@_register("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'N') THEN 'permitted' WHEN l_returnflag = 'R' THEN 'prohibited' END AS rule_intent
  FROM lineitem WHERE l_linestatus IS NOT NULL AND trim(l_linestatus) <> ''""")
def rule_intent(spark, sf_dir):
    rows = rules.with_subject(_table(spark, sf_dir, "lineitem"), "l_linestatus")
    return rows.select("l_orderkey", "l_linenumber", rules.intent(F.col("l_returnflag"), ["A", "N"], ["R"]).alias("rule_intent"))


@_register("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def permitted_filter(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("A", "N")).select("l_orderkey", "l_linenumber", "l_quantity")


@_register("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag IN ('R')")
def prohibited_filter(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("R")).select("l_orderkey", "l_linenumber", "l_quantity")


@_register("""SELECT a.l_orderkey, a.l_partkey, a.l_linenumber AS l_linenumber_a, b.l_linenumber AS l_linenumber_b
  FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linestatus = b.l_linestatus AND a.l_partkey = b.l_partkey
  WHERE a.l_returnflag IN ('A', 'N') AND b.l_returnflag = 'R' AND a.l_linenumber <> b.l_linenumber""")
def conflict_pairs(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem")
    return rules.conflicts(rows, ["l_orderkey", "l_linestatus", "l_partkey"], "l_linenumber", "l_returnflag", ["A", "N"], ["R"]).drop("l_linestatus")


@_register("""SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def applicability_chain(spark, sf_dir):
    t = lambda n: _table(spark, sf_dir, n)
    chain = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    chain = chain.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return chain.select("o_orderkey", "c_name", "n_name", "r_name")


@_register("""SELECT n_nationkey, coalesce(t, n_name) AS normalised FROM nation
  LEFT JOIN (VALUES ('NATION_1', 'N-1'), ('NATION_12', 'N-12'), ('NATION_7', NULL)) v(s, t) ON n_name = s""")
def crosswalk_normalise(spark, sf_dir):
    seeds = spark.createDataFrame([("NATION_1", "N-1"), ("NATION_12", "N-12"), ("NATION_7", None)], "source_code string, target_code string")
    return rules.crosswalk(_table(spark, sf_dir, "nation"), seeds, "n_name").select("n_nationkey", "normalised")


@_register("""SELECT s_suppkey, count(l_orderkey) AS lines, round(coalesce(sum(l_quantity), 0), 6) AS quantity
  FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY s_suppkey""")
def lateral_counts(spark, sf_dir):
    sums = _table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("l_orderkey").alias("lines"), F.sum("l_quantity").alias("quantity"))
    joined = _table(spark, sf_dir, "supplier").join(sums, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return joined.select("s_suppkey", F.coalesce("lines", F.lit(0)).alias("lines"), _round(F.coalesce("quantity", F.lit(0.0))).alias("quantity"))


@_register("""SELECT c_custkey, o_orderkey AS first_order FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) ON c_custkey = o_custkey AND rn = 1""")
def first_title(spark, sf_dir):
    first = sequence.top_k(_table(spark, sf_dir, "orders"), "o_custkey", [F.asc("o_orderdate"), F.asc("o_orderkey")])
    joined = _table(spark, sf_dir, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.col("o_orderkey").alias("first_order"))


@_register("""SELECT l_orderkey, count(*) AS n, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS detail
  FROM lineitem GROUP BY l_orderkey""")
def nested_detail(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    parts = F.transform(rows, lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string")))
    return _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.array_join(parts, ",").alias("detail"))


@_register("""SELECT p_partkey, p_name FROM part WHERE p_size = 15 OR starts_with(p_name, 'b')""")
def or_filter(spark, sf_dir):
    return _table(spark, sf_dir, "part").where((F.col("p_size") == 15) | F.startswith("p_name", F.lit("b"))).select("p_partkey", "p_name")


@_register("""WITH r AS (SELECT o_custkey % 200 AS scope, o_orderkey AS rule, ['main_street', 'downtown', 'zone_' || o_orderkey % 30][o_orderkey % 3 + 1] AS t FROM orders),
  p AS (SELECT c_custkey % 200 AS scope, c_custkey AS place, ['main_street_east', 'downtown', 'map_zone_' || c_nationkey][c_custkey % 3 + 1] AS k FROM customer)
  SELECT DISTINCT scope, rule, place FROM r JOIN p USING (scope) WHERE contains(t, k) OR contains(k, t)""")
def token_theta(spark, sf_dir):
    pick = lambda values, at: F.element_at(F.array(*values), (at % 3 + 1).cast("int"))
    order, cust = F.col("o_orderkey"), F.col("c_custkey")
    said = pick([F.lit("Main-Street"), F.lit("Downtown"), F.concat(F.lit("zone "), order % 30)], order)
    keys = pick([F.lit("main_street_east"), F.lit("downtown"), F.concat(F.lit("map_zone_"), F.col("c_nationkey"))], cust)
    rows = _table(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).alias("scope"), order.alias("rule"), references.area_tokens([], [said]).alias("tokens"))
    places = _table(spark, sf_dir, "customer").select((cust % 200).alias("scope"), cust.alias("place"), F.array(keys).alias("keys"))
    return references.area_links(rows, places, "scope")


@_register("""SELECT conv_id, string_agg(text, ' ' ORDER BY turn, role, text) AS body, count(*) AS turns FROM conversations GROUP BY conv_id""")
def ordered_text(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.array_join(F.transform(rows, lambda x: x["text"]), " ").alias("body"), F.count(F.lit(1)).alias("turns")
    )


@_register("""SELECT l_suppkey, l_partkey, value FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY value DESC, l_partkey) AS rn FROM
  (SELECT l_suppkey, l_partkey, round(sum(l_extendedprice), 2) AS value FROM lineitem GROUP BY ALL)) WHERE rn = 1""")
def best_match_rank(spark, sf_dir):
    sums = _table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))
    return sequence.top_k(sums, "l_suppkey", [F.desc("value"), F.asc("l_partkey")]).select("l_suppkey", "l_partkey", "value")


@_register("""SELECT c_custkey, c_name, CASE WHEN lower(c_name) = 'customer#00000001' THEN 1 WHEN starts_with(lower(c_name), 'customer#00000001') THEN 2 ELSE 3 END AS match_rank,
  CASE WHEN lower(c_name) = 'customer#00000001' THEN 'high' WHEN starts_with(lower(c_name), 'customer#00000001') THEN 'medium' ELSE 'low' END AS confidence
  FROM customer WHERE contains(lower(c_name), 'customer#00000001') ORDER BY match_rank, c_name, c_custkey LIMIT 10""")
def search_ranked(spark, sf_dir):
    return requests.search(_table(spark, sf_dir, "customer"), "Customer#00000001", "c_name", "c_custkey", requests.limit_of(None, 10, 25))


@_register("""SELECT c_custkey, concat_ws(', ', concat_ws(' ', nullif(trim(c_name), ''), nullif(trim(c_mktsegment), '')),
  CASE WHEN c_acctbal < 0 THEN 'arrears' END) AS label FROM customer""")
def address_label(spark, sf_dir):
    part = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    label = F.concat_ws(", ", F.concat_ws(" ", part("c_name"), part("c_mktsegment")), F.when(F.col("c_acctbal") < 0, "arrears"))
    return _table(spark, sf_dir, "customer").select("c_custkey", label.alias("label"))


def _versions(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("natural_key"), "o_orderstatus", "o_orderpriority")
    old = rows.where("natural_key % 7 <> 0").select("natural_key", text.content_hash(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("content_hash"))
    status = F.when(F.col("natural_key") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    new = rows.where("natural_key % 11 <> 0").select("natural_key", status, "o_orderpriority")
    return old, new.select("natural_key", text.content_hash(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("content_hash"))


_DIFF = """SELECT o_orderkey AS natural_key, CASE WHEN o_orderkey % 7 = 0 THEN 'added' WHEN o_orderkey % 11 = 0 THEN 'removed'
  WHEN o_orderkey % 5 = 0 AND o_orderstatus <> 'X' THEN 'changed' ELSE 'unchanged' END AS change_status
  FROM orders WHERE NOT (o_orderkey % 7 = 0 AND o_orderkey % 11 = 0)"""


@_register(_DIFF)
def version_diff(spark, sf_dir):
    return versioning.diff(*_versions(spark, sf_dir)).select("natural_key", "change_status")


@_register(f"""WITH e AS ({_DIFF}) SELECT natural_key, count(*) AS versions, count(*) FILTER (live) AS active FROM (
  SELECT natural_key, change_status = 'unchanged' AS live FROM e WHERE change_status <> 'added' UNION ALL
  SELECT natural_key, true FROM e WHERE change_status IN ('added', 'changed')) GROUP BY natural_key""")
def version_apply(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    after = versioning.apply_diff(old.withColumn("is_active", F.lit(True)), new, versioning.diff(old, new))
    return after.groupBy("natural_key").agg(F.count(F.lit(1)).alias("versions"), F.count_if("is_active").alias("active"))


@_register("""SELECT o_orderkey AS k, o_orderstatus AS review_status FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'O' UNION ALL
  SELECT o_orderkey, 'O' FROM orders WHERE o_orderkey % 3 = 0 AND NOT (o_orderkey % 2 = 0 AND o_orderstatus <> 'O')""")
def upsert_preserve(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("review_status"))
    incoming = rows.where("k % 3 = 0").withColumn("review_status", F.lit("O"))
    return versioning.upsert_preserving(rows.where("k % 2 = 0"), incoming, ["k"], open_status="O")


@_register("""SELECT p_partkey, CASE WHEN rn > 1 THEN p_type || '__' || rn ELSE p_type END AS unique_key
  FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn FROM part)""")
def dedupe_suffix(spark, sf_dir):
    return sequence.dedupe_suffix(_table(spark, sf_dir, "part"), "p_type", "p_partkey").select("p_partkey", "unique_key")


@_register("""SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, 999) AS page_end FROM conversations WHERE role = 'user'""")
def page_ranges(spark, sf_dir):
    heads = _table(spark, sf_dir, "conversations").where("role = 'user'")
    return sequence.page_ranges(heads, "conv_id", "turn", F.lit(999)).select("conv_id", "turn", "page_end")


@_register("""SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS section FROM events""")
def running_section(spark, sf_dir):
    value = F.when(F.col("event_type") == "click", F.col("event_id"))
    return sequence.running_context(_table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], value, "section").select("event_id", "section")


@_register("""WITH a AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  b AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM a)
  SELECT user_id, run::BIGINT AS run, min(event_type) AS kind, min(event_id) AS first, max(event_id) AS last, count(*) AS length FROM b GROUP BY user_id, run""")
def islands(spark, sf_dir):
    return sequence.islands(_table(spark, sf_dir, "events"), "user_id", ["event_id"], "event_type")


@_register("""WITH RECURSIVE e AS (SELECT n_nationkey AS a, 1000 + n_regionkey AS b FROM nation UNION ALL SELECT 1000 + n_regionkey, n_nationkey FROM nation),
  r(node, label) AS (SELECT a, a FROM e UNION SELECT e.b, r.label FROM r JOIN e ON r.node = e.a)
  SELECT node, min(label) AS component FROM r GROUP BY node""")
def components(spark, sf_dir):
    return sequence.components(_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("a"), (F.col("n_regionkey") + 1000).alias("b")))


@_register("""(SELECT c_nationkey AS k, 'missing' AS side FROM customer EXCEPT SELECT s_nationkey, 'missing' FROM supplier) UNION ALL
  (SELECT s_nationkey, 'extra' FROM supplier EXCEPT SELECT c_nationkey, 'extra' FROM customer)""")
def set_diff(spark, sf_dir):
    a = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).distinct()
    b = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).distinct()
    return a.join(b, "k", "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, "k", "left_anti").withColumn("side", F.lit("extra")))


@_register("""SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS norm_key,
  trim(regexp_replace(lower(replace(p_type, '&', ' and ')), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
  trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g'), ' ') AS norm_text FROM part""")
def norm_keys(spark, sf_dir):
    c = F.col
    return _table(spark, sf_dir, "part").select("p_partkey", text.norm_key(c("p_name")).alias("norm_key"), text.slugify(c("p_type")).alias("slug"), text.norm_text(c("p_brand")).alias("norm_text"))


@_register("""SELECT l_orderkey, l_linenumber, array_to_string([l_orderkey::VARCHAR, 'ea', l_linenumber::VARCHAR], '/') AS path FROM lineitem""")
def clause_paths(spark, sf_dir):
    label = F.concat(F.col("l_orderkey").cast("string"), F.lit("(ea)("), F.col("l_linenumber").cast("string"), F.lit(")"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(text.clause_path(label), "/").alias("path"))


@_register("""SELECT p_partkey, round(p_size * 0.3048::DOUBLE, 6) AS metres, round((p_size + 0.5::DOUBLE) * 0.09290304::DOUBLE, 6) AS area, 'minimum' AS comparator FROM part""")
def measurements(spark, sf_dir):
    body = F.concat(F.lit("Frontage at least "), F.col("p_size").cast("string"), F.lit(" feet; area "), F.col("p_size").cast("string"), F.lit(".5 sq ft."))
    found = measure.measurements(body)
    return _table(spark, sf_dir, "part").select("p_partkey", _round(found[0]["metric"]).alias("metres"), _round(found[1]["metric"]).alias("area"), measure.comparator(body).alias("comparator"))


@_register("""WITH u AS (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS place, unnest(['percent', 'percent', 'unit', 'ha', 'm2', 'm2', 'sq ft', 'ft', 'm']) AS unit,
    unnest(['percent', 'percent', 'unit', 'ha', 'm2', 'm2', 'm2', 'm', 'm']) AS metric_unit, unnest([1, 1, 1, 1, 1, 1, 0.09290304, 0.3048, 1]::DOUBLE[]) AS factor)
  SELECT p_partkey, place, unit, metric_unit, round(p_size * factor, 6) AS metric, CASE WHEN place % 3 = 0 THEN 'minimum' WHEN place % 3 = 1 THEN 'maximum' ELSE 'unknown' END AS comparator,
    'height' AS subject FROM part, u""")
def dimensional_texts(spark, sf_dir):
    size, said = F.col("p_size").cast("string"), ["minimum height", "height shall not exceed", "height of"]
    spelled = ["percent", "%", "units", "ha", "square meters", "sq. m", "square feet", "ft.", "metres (99 feet)"]
    parts = [F.concat(F.lit(f" {said[at % 3]} "), size, F.lit(f" {name};")) for at, name in enumerate(spelled, 1)]
    found = _table(spark, sf_dir, "part").select("p_partkey", F.posexplode(measure.standards(F.concat(*parts))).alias("place", "s"))
    return found.select("p_partkey", (F.col("place") + 1).alias("place"), "s.unit", "s.metric_unit", _round(F.col("s.metric")).alias("metric"), "s.comparator", "s.subject")


@_register("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_exists(props, '$.k') AS has_k FROM events""")
def json_fields(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.array_contains(F.json_object_keys("props"), "k").alias("has_k"))


@_register("""SELECT p_partkey, round(p_size * 2.0::DOUBLE * (p_size + 3), 6) AS area, (p_size >= 10) AS covers_corner FROM part""")
def area_shoelace(spark, sf_dir):
    w, h = F.col("p_size") * 2.0, F.col("p_size") + 3.0
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    zero = F.lit(0.0)
    ring = F.array(corner(zero, zero), corner(w, zero), corner(w, h), corner(zero, h))
    return _table(spark, sf_dir, "part").select("p_partkey", _round(geo.area(ring)).alias("area"), geo.covers(ring, F.lit(20.0), F.lit(13.0)).alias("covers_corner"))


def _boxes(spark, sf_dir):
    supplier = _table(spark, sf_dir, "supplier")
    x, y = (F.col("s_suppkey") % 10 * 10.0), (F.floor(F.col("s_suppkey") / 10) % 10 * 10.0)
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + 12.0).alias("x1"), (y + 12.0).alias("y1"))
    return supplier.select(F.col("s_suppkey").alias("zone_id"), box.alias("box"))


_BOXES = "SELECT s_suppkey AS zone_id, s_suppkey % 10 * 10.0 AS x0, floor(s_suppkey / 10) % 10 * 10.0 AS y0, s_suppkey % 10 * 10.0 + 12 AS x1, floor(s_suppkey / 10) % 10 * 10.0 + 12 AS y1 FROM supplier"


@_register(f"""WITH z AS ({_BOXES}) SELECT event_id AS point_id, zone_id AS polygon_id FROM events JOIN z
  ON event_id % 113 BETWEEN x0 AND x1 AND event_id * 7 % 113 BETWEEN y0 AND y1""")
def point_in_polygon(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    points = events.select(F.col("event_id").alias("point_id"), (F.col("event_id") % 113).cast("double").alias("x"), (F.col("event_id") * 7 % 113).cast("double").alias("y"))
    b = F.col("box")
    ring = F.array(*[F.struct(b[x].alias("x"), b[y].alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))])
    return spatial.points_in_polygons(points, _boxes(spark, sf_dir).select(F.col("zone_id").alias("polygon_id"), ring.alias("ring"), "box"), 20.0)


@_register(f"""WITH z AS ({_BOXES}), p AS (SELECT p_partkey AS parcel_id, p_partkey % 100 * 1.0 AS a0, p_size * 1.0 AS b0, p_partkey % 100 + 7.0 AS a1, p_size + 9.0 AS b1 FROM part),
  m AS (SELECT parcel_id, zone_id, (least(a1, x1) - greatest(a0, x0)) * (least(b1, y1) - greatest(b0, y0)) AS shared FROM p JOIN z ON a0 <= x1 AND x0 <= a1 AND b0 <= y1 AND y0 <= b1)
  SELECT parcel_id, zone_id, shared::DOUBLE AS shared FROM (SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY shared DESC, zone_id) AS rn FROM m) WHERE rn = 1""")
def largest_overlap(spark, sf_dir):
    x, y = (F.col("p_partkey") % 100).cast("double"), F.col("p_size").cast("double")
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + 7.0).alias("x1"), (y + 9.0).alias("y1"))
    return spatial.largest_overlap(_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("parcel_id"), box.alias("box")), _boxes(spark, sf_dir), 20.0)


@_register("""SELECT 100 AS steps, count(*) AS points, max(0) AS off FROM customer""")
def crs_round_trip(spark, sf_dir):
    lon = F.lit(-63.3) + F.col("c_custkey") % 100 / 250.0
    lat = F.lit(46.1) + F.col("c_custkey") % 37 / 100.0
    east, north = geo.project(lon, lat)
    grid = _table(spark, sf_dir, "customer").select(lon.alias("lon"), lat.alias("lat"), east.alias("e"), north.alias("n"))
    lon2, lat2 = geo.unproject(F.col("e"), F.col("n"))
    off = F.greatest(F.abs(lon2 - F.col("lon")), F.abs(lat2 - F.col("lat"))) > 1e-9
    return grid.agg(F.lit(100).alias("steps"), F.count(F.lit(1)).alias("points"), F.max(off.cast("int")).alias("off"))


@_register("""SELECT source, count(*) AS documents, count(l.doc_id) AS labelled, sum(octet_length(encode(text)))::BIGINT AS bytes
  FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source""")
def conservation(spark, sf_dir):
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("known"))
    joined = _table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return joined.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count("known").alias("labelled"), F.sum(F.octet_length("text")).alias("bytes"))


@_register("""SELECT page_id, octet_length(encode(html))::BIGINT AS size, sha256(html) AS sha256 FROM pages""")
def raw_inventory(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", F.octet_length("html").cast("long").alias("size"), F.sha2("html", 256).alias("sha256"))


@_register("""WITH t AS (SELECT p_partkey, p_brand, list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g'), ' '), ' '), lambda x: length(x) > 2)) AS k FROM part),
  s AS (SELECT a.p_partkey AS current_key, b.p_partkey AS draft_key, len(list_intersect(a.k, b.k)) / len(list_distinct(list_concat(a.k, b.k))) AS similarity
  FROM t a JOIN t b USING (p_brand) WHERE a.p_partkey % 2 = 0 AND b.p_partkey % 2 = 1)
  SELECT current_key, draft_key, round(similarity, 6) AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY current_key ORDER BY similarity DESC, draft_key) AS rank
  FROM s WHERE similarity > 0) WHERE rank <= 3""")
def candidate_top3(spark, sf_dir):
    words = text.tokens(F.concat_ws(" ", "p_name", "p_type")).alias("k")
    rows = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", words)
    found = similarity.token_candidates(rows.where("p_partkey % 2 = 0"), rows.where("p_partkey % 2 = 1"), ["p_brand"], "p_partkey", "k")
    return found.withColumn("similarity", _round(F.col("similarity")))


def _sections(spark, sf_dir):
    """Documents as sections of two revisions, in groups of 32 that share a zone or a topic."""
    group = F.floor(F.col("doc_id") / 32).cast("string")
    zoned = F.floor(F.col("doc_id") / 32) % 2 == 0
    heads = F.array(*[F.lit(t) for t in ("Permitted uses", "Lot requirements", "Signs", "General", "Conditional uses in")])
    words = F.array_join(F.slice(F.split(text.norm_text(F.col("text")), " "), 1, 4), " ")
    title = F.when(zoned, F.concat_ws(" ", F.get(heads, (F.col("doc_id") % 5).cast("int")), words)).otherwise(F.concat_ws(" ", F.lit("part"), group, words))
    kind = F.when(F.col("doc_id") % 7 > 0, "zone")
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"), kind.alias("document_type"), F.when(zoned, group).alias("zone_code"), title.alias("title"), F.concat(F.lit("t"), group).alias("topic"), "text"
    )


@_register(None)
def section_candidates(spark, sf_dir):
    rows = _sections(spark, sf_dir)
    found = similarity.candidates(rows.where("key % 2 = 0"), rows.where("key % 2 = 1"))
    return found.withColumns({c: _round(F.col(c)) for c in ("score", "title_similarity", "text_similarity")})


@_register(None)
def title_ratio(spark, sf_dir):
    rows = _table(spark, sf_dir, "part").select("p_partkey", "p_name", F.lead("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey")).alias("other"))
    return rows.select("p_partkey", _round(similarity.ratio(F.col("p_name"), F.coalesce("other", F.lit("")))).alias("ratio"))


@_register("""WITH c(code, r, g, b) AS (VALUES (0, -1.0, -1.0, -1.0), (1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0)),
  d AS (SELECT vec_id, code, (embedding[1]::DOUBLE - r) ** 2 + (embedding[2]::DOUBLE - g) ** 2 + (embedding[3]::DOUBLE - b) ** 2 AS d FROM embeddings, c)
  SELECT vec_id, CASE WHEN min(d) <= 1.0 THEN arg_min(code, d) END AS code FROM d GROUP BY vec_id""")
def colour_nearest(spark, sf_dir):
    centres = [(0, -1.0, -1.0, -1.0), (1, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0)]
    x = [F.element_at("embedding", i + 1).cast("double") for i in range(3)]
    away = [F.struct(sum((x[i] - c[i + 1]) * (x[i] - c[i + 1]) for i in range(3)).alias("d"), F.lit(c[0]).alias("code")) for c in centres]
    best = F.array_min(F.array(*away))
    return _table(spark, sf_dir, "embeddings").select("vec_id", F.when(best["d"] <= 1.0, best["code"]).alias("code"))


@_register("""SELECT o_orderkey, CASE WHEN a IS NULL AND b IS NULL THEN 'pending' WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' WHEN a = b THEN 'same' ELSE 'changed' END AS change
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 3 > 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END END AS b FROM orders)""")
def zone_change(spark, sf_dir):
    a = F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus"))
    b = F.when(F.col("o_orderkey") % 3 > 0, F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    return _table(spark, sf_dir, "orders").select("o_orderkey", text.zone_change(a, b).alias("change"))


def queries() -> dict[str, Query]:
    from parcelforge import catalog_documents, catalog_files, catalog_geometry, catalog_import, catalog_operators, catalog_records, catalog_rules, catalog_space, catalog_text  # noqa: F401  they register themselves

    return _queries()


def oracle_sql() -> dict[str, str]:
    queries()
    return sql_of()
