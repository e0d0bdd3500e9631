"""Registered queries of the text and record operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelforge.operators import extraction, layout, records
from parcelforge.registry import register, table


def _line() -> Column:
    return F.concat(F.lit("("), F.col("role"), F.lit(") "), F.coalesce("text", F.lit("")))


@register(r"""WITH t AS (SELECT conv_id, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM conversations),
  f AS (SELECT *, lag(x) OVER w AS p FROM t WHERE x <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role)),
  g AS (SELECT *, sum(CASE WHEN p IS NOT NULL AND (regexp_matches(p, '[,;:\-(]$') OR regexp_matches(x, '^[\p{Ll}()]')) THEN 0 ELSE 1 END)
    OVER (PARTITION BY conv_id ORDER BY turn, role) AS line_group FROM f)
  SELECT conv_id, line_group::BIGINT AS line_group, string_agg(x, ' ' ORDER BY turn, role) AS text FROM g GROUP BY ALL""")
def merge_wrapped(spark, sf_dir):
    return extraction.merge_wrapped(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role"], "text")


@register(r"""WITH t AS (SELECT conv_id, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM conversations),
  g AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn, role) AS block FROM t)
  SELECT * FROM (SELECT conv_id, block::BIGINT AS block, CASE WHEN count(*) FILTER (role = 'user') > 0 THEN 'user' ELSE 'section' END AS label,
    string_agg(CASE WHEN role = 'user' THEN nullif(x, '') ELSE trim('(' || role || ') ' || coalesce(x, '')) END, ' ' ORDER BY turn, role) AS text
  FROM g GROUP BY conv_id, block) WHERE text <> ''""")
def labelled_blocks(spark, sf_dir):
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", _line().alias("line"))
    return extraction.labelled_blocks(lines, ["conv_id"], ["turn", "role"], "line", r"(?s)^\((user)\) (.*)$")


@register(r"""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, CASE WHEN l_returnflag = 'R' THEN l_linenumber END AS s FROM lineitem),
  g AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_returnflag ROWS UNBOUNDED PRECEDING) AS section FROM t)
  SELECT l_orderkey, section::VARCHAR AS section, coalesce(string_agg('part ' || l_partkey, ' ' ORDER BY l_linenumber, l_partkey) FILTER (s IS NULL), '') AS text,
  coalesce(arg_min('Title ' || l_partkey, (l_linenumber, l_partkey)) FILTER (s IS NOT NULL), '') AS title FROM g GROUP BY l_orderkey, section""")
def split_sections(spark, sf_dir):
    part = F.col("l_partkey").cast("string")
    heading = F.concat(F.col("l_linenumber").cast("string"), F.lit(" Title "), part)
    line = F.when(F.col("l_returnflag") == "R", heading).otherwise(F.concat(F.lit("part "), part))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", line.alias("line"))
    return extraction.sections(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_returnflag"], "line", r"^(\d+) (.*)$")


@register(r"""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber % 3 AS k, row_number() OVER w AS n FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey)),
  d AS (SELECT *, last_value(CASE WHEN k = 0 THEN 'p' || l_partkey END IGNORE NULLS) OVER w AS dec,
    nullif(last_value(CASE WHEN k = 0 THEN '' WHEN k = 1 THEN 'b' || l_linenumber END IGNORE NULLS) OVER w, '') AS br
    FROM t WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING))
  SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('/', l_orderkey, dec, CASE WHEN k = 1 THEN 'b' || l_linenumber WHEN k = 2 AND dec IS NOT NULL THEN br END,
    CASE WHEN k = 2 THEN 'c' || l_linenumber END) AS path FROM d""")
def running_clause_paths(spark, sf_dir):
    k, n = F.col("l_linenumber") % 3, F.col("l_linenumber").cast("string")
    label = F.when(k == 0, F.concat(F.lit(".p"), F.col("l_partkey").cast("string"))).when(k == 1, F.concat(F.lit("(b"), n, F.lit(")"))).otherwise(F.concat(F.lit("c"), n, F.lit(")")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_orderkey").cast("string").alias("section"), label.alias("label"))
    paths = extraction.clause_paths(rows, ["l_orderkey"], ["l_linenumber", "l_partkey"], "section", "label")
    return paths.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("clause_path", "/").alias("path"))


@register("""SELECT p_partkey, unnest([0, 1, 2]) AS piece, unnest(['Uses:', p_name || ';', p_type]) AS text, unnest(['21', '21/1', '21/2']) AS path FROM part""")
def inline_clauses(spark, sf_dir):
    text = F.concat(F.lit("Uses: 1) "), F.col("p_name"), F.lit("; and 2) "), F.col("p_type"))
    rows = table(spark, sf_dir, "part").select("p_partkey", text.alias("text"), F.array(F.lit("21")).alias("path"), F.lit("21").alias("label"))
    return extraction.split_inline(rows, "text", "path", "label").select("p_partkey", "piece", "text", F.array_join("path", "/").alias("path"))


@register("""SELECT n_nationkey, unnest([0, 1]) AS place, unnest(['Dwelling', 'Lot']) AS term, unnest(['a home in ' || n_name || '.', 'land number ' || n_nationkey]) AS meaning FROM nation""")
def definition_places(spark, sf_dir):
    text = F.concat(F.lit("Dwelling means a home in "), F.col("n_name"), F.lit(". Lot means land number "), F.col("n_nationkey").cast("string"))
    rows = extraction.definitions(table(spark, sf_dir, "nation").select("n_nationkey", text.alias("text")), "text")
    return rows.select("n_nationkey", "place", "term", "meaning")


@register("""SELECT DISTINCT p_partkey, unnest(['section', 'schedule', 'part']) AS kind, unnest([p_size::VARCHAR, 'B-' || p_partkey, 'IV']) AS label FROM part""")
def shared_references(spark, sf_dir):
    text = F.concat(F.lit("See Section "), F.col("p_size").cast("string"), F.lit(" and Schedule B-"), F.col("p_partkey").cast("string"), F.lit(", Part IV, section "), F.col("p_size").cast("string"))
    return extraction.references(table(spark, sf_dir, "part").select("p_partkey", text.alias("text")), ["p_partkey"], "text")


@register(r"""SELECT DISTINCT p_partkey, code FROM (SELECT p_partkey, unnest(regexp_extract_all(p_name || ' ' || p_type, '[A-Za-z0-9\-]+')) AS code FROM part)
  WHERE code IN (SELECT regexp_extract(p_type, '[A-Za-z0-9\-]+') FROM part)""")
def mentioned_codes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    codes = part.select(F.regexp_extract("p_type", r"[A-Za-z0-9\-]+", 0).alias("code"))
    return extraction.mentioned_codes(part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("t")), ["p_partkey"], "t", codes, "code")


@register("""WITH s AS (SELECT event_id, user_id, last_value(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS i FROM events),
  t AS (SELECT *, coalesce(i, 0) AS now, coalesce(lag(coalesce(i, 0)) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS was FROM s)
  SELECT event_id, user_id FROM t WHERE now = 0 AND was <> 1""")
def outside_regions(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return extraction.drop_regions(rows, ["user_id"], ["event_id"], "event_type", "^click$", "^view$").select("event_id", "user_id")


@register(None)
def numbered_outline(spark, sf_dir):
    n = F.col("l_linenumber")
    line = F.when(n == 1, F.concat((F.col("l_orderkey") % 500 + 1).cast("string"), F.lit(" Title"))).when(n % 2 == 0, F.concat(F.lit("(a"), n.cast("string"), F.lit(") use:"))).otherwise("(ii) more")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 1000).alias("doc"), F.col("l_orderkey").alias("page"), n.alias("at"), line.alias("line"))
    return extraction.outline(rows, "doc", "page", "at", "line")


@register("""WITH i AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'o' WHEN 1 THEN 'ox' WHEN 2 THEN 'z' ELSE 'yo' END AS t, p_partkey % 90 + 10 AS x FROM part)
  SELECT p_partkey, CASE WHEN x <= 40 THEN 'R1' WHEN x <= 70 THEN 'R2' ELSE 'C1' END AS zone, replace(t, 'z', '') AS symbols,
  CASE WHEN t = 'o' THEN 'permitted' ELSE 'permitted_with_conditions' END AS status FROM i WHERE t <> 'z'""")
def permission_cells(spark, sf_dir):
    size = F.col("p_size") % 4
    text = F.when(size == 0, "o").when(size == 1, "ox").when(size == 2, "z").otherwise("yo")
    items = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 90 + 10).cast("double").alias("x"), text.alias("text"))
    return extraction.permission_cells(items, ["p_partkey"], [("R1", 25.0), ("R2", 55.0), ("C1", 85.0)], "oxy", 20.0)


#: Lines of a numbered document with their pages, and the outline that they must give.
_OUTLINE = [(1, "noise"), (1, "12 Uses"), (1, "These:"), (1, "(a) one:"), (2, "(i) deep"), (2, "(ii) deeper"), (2, "(b) two"), (2, "900 metres"), (3, "14A Repealed")]
_OUTLINED = [("12", "These:"), ("12(a)", "one:"), ("12(a)(i)", "deep"), ("12(a)(ii)", "deeper"), ("12(b)", "two 900 metres"), ("14A", "")]


@register("SELECT n_nationkey AS doc, label, text FROM nation, (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _OUTLINED) + ") v(label, text)")
def fixed_outline(spark, sf_dir):
    lines = F.array(*[F.struct(F.lit(p).alias("page"), F.lit(i).alias("at"), F.lit(t).alias("line")) for i, (p, t) in enumerate(_OUTLINE)])
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("doc"), F.inline(lines))
    return extraction.outline(rows, "doc", "page", "at", "line").select("doc", "label", "text")


@register(None)
def word_lines(spark, sf_dir):
    words = table(spark, sf_dir, "events").select((F.col("event_id") % 97).alias("page"), (F.col("event_id") % 31).cast("double").alias("x"), (F.col("event_id") % 61 * 3).cast("double").alias("y"), F.col("event_type").alias("text"))
    return layout.word_lines(words, ["page"])


@register("""WITH b AS (SELECT p_partkey, p_size AS page, p_partkey % 2 * 306.0 AS x0, (p_partkey * 7 % 50)::DOUBLE AS y0 FROM part),
  c AS (SELECT *, CASE WHEN x0 = 0 THEN 1 ELSE 2 END AS col, count(*) FILTER (x0 = 0) OVER (PARTITION BY page) >= 4 AND count(*) FILTER (x0 > 0) OVER (PARTITION BY page) >= 4 AS two FROM b)
  SELECT p_partkey, col AS "column", row_number() OVER (PARTITION BY page ORDER BY CASE WHEN two THEN col ELSE 0 END, y0, x0, p_partkey::VARCHAR) AS place FROM c""")
def reading_order(spark, sf_dir):
    x = F.col("p_partkey") % 2 * 306.0
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("page"), x.alias("x0"), (x + 300).alias("x1"), (F.col("p_partkey") * 7 % 50).cast("double").alias("y0"), F.col("p_partkey").cast("string").alias("text"))
    return layout.reading_order(rows, ["page"]).select("p_partkey", "column", "place")


@register("""SELECT o_orderkey::VARCHAR AS t, l_linenumber AS row_order, unnest([1, 9]) AS column_order, unnest(['Use', NULL]) AS column_label_raw,
  unnest([l_returnflag, l_linestatus]) AS cell_text_raw, concat_ws('|', o_orderkey, 'row', l_linenumber, 'col', unnest(['a', 'b']), 'pos', unnest([1, 9]),
  unnest([sha256(l_returnflag)[:16], sha256(l_linestatus)[:16]])) AS cell_key FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def table_cells(spark, sf_dir):
    cell = lambda i, c, n: F.struct(F.lit(i).alias("column_id"), F.col(c).alias("cell_text_raw"), F.lit(n).cast("int").alias("source_order"))
    row = F.struct(F.col("l_linenumber").alias("source_order"), F.array(cell("a", "l_returnflag", None), cell("b", "l_linestatus", 9)).alias("cells"))
    tables = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    tables = tables.groupBy(F.col("l_orderkey").cast("string").alias("t")).agg(F.collect_list(row).alias("rows"))
    tables = tables.withColumn("columns", F.array(F.struct(F.lit("a").alias("column_id"), F.lit("Use").alias("column_label_raw"))))
    return records.table_cells(tables, "t", "columns", "rows").drop("column_id")


@register("""SELECT c_custkey, 'segment' AS kind, 0 AS place, c_mktsegment AS value FROM customer UNION ALL SELECT c_custkey, 'name', 0, c_name FROM customer
  UNION ALL SELECT c_custkey, 'name', 1, c_mktsegment FROM customer""")
def flatten_branches(spark, sf_dir):
    docs = table(spark, sf_dir, "customer").select("c_custkey", F.array("c_mktsegment").alias("s"), F.array("c_name", "c_mktsegment").alias("n"), F.lit(None).cast("array<string>").alias("z"))
    return records.flatten_branches(docs, ["c_custkey"], {"segment": "s", "name": "n", "none": "z"})


@register("""WITH c AS (SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem),
  k AS (SELECT l_suppkey, [l_returnflag, l_linestatus] AS path, l_suppkey || l_returnflag || l_linestatus AS id FROM c UNION ALL SELECT DISTINCT l_suppkey, [l_returnflag], l_suppkey || l_returnflag FROM c WHERE l_returnflag <> 'N')
  SELECT k.id, p.id AS parent FROM k LEFT JOIN k p ON k.l_suppkey = p.l_suppkey AND len(k.path) > 1 AND p.path = k.path[:-2]""")
def clause_parents(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()
    low = rows.select("l_suppkey", F.array("l_returnflag", "l_linestatus").alias("path"))
    top = rows.where("l_returnflag <> 'N'").select("l_suppkey", F.array("l_returnflag").alias("path")).distinct()
    both = low.unionByName(top).withColumn("id", F.concat(F.col("l_suppkey").cast("string"), F.array_join("path", "")))
    return records.parents(both, ["l_suppkey"], "path", "id").select("id", "parent")


@register("""WITH a AS (SELECT c_custkey, c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n FROM customer),
  b AS (SELECT s_suppkey, s_nationkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier)
  SELECT c_custkey, s_suppkey FROM a LEFT JOIN b USING (k, n)""")
def match_in_turn(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    right = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"))
    return records.match_in_turn(left, right, ["k"], ["c_custkey"], ["s_suppkey"]).select("c_custkey", "s_suppkey")


@register("""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'C' || o_custkey WHEN o_custkey % 5 = 0 THEN 'S' || o_custkey END AS target,
  CASE WHEN o_custkey % 3 = 0 THEN 'section' WHEN o_custkey % 5 = 0 THEN 'table' END AS kind FROM orders""")
def resolve_refs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    ids = orders.select(F.col("o_custkey").alias("id")).distinct()
    named = lambda n, p: ids.where(f"id % {n} = 0").withColumn("target", F.concat(F.lit(p), F.col("id").cast("string")))
    rows = orders.select("o_orderkey", F.array(F.lit(-1).cast(orders.schema["o_custkey"].dataType), "o_custkey").alias("refs"))
    return records.resolve_refs(rows, "o_orderkey", "refs", [(named(3, "C"), "section"), (named(5, "S"), "table")])


@register("""SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN left(c_mktsegment, 3) END AS code FROM customer""")
def code_match(spark, sf_dir):
    entries = spark.createDataFrame([("BUI", "Building", None, 0), ("MAC", None, " machinery ", 1), ("ZZZ", None, "building", 2)], "code string, label string, symbol string, place int")
    return records.code_match(table(spark, sf_dir, "customer"), "c_mktsegment", entries, "code").select("c_custkey", "code")


@register("""WITH t AS (SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'Brand#12' ELSE p_brand END AS term FROM part)
  SELECT p_partkey, unnest(CASE WHEN term = 'Brand#12' THEN ['twelve', 'dozen'] ELSE [term] END) AS term FROM t""")
def split_terms(spark, sf_dir):
    aliases = spark.createDataFrame([("Brand#11", "Brand#12")], "alias string, term string")
    splits = spark.createDataFrame([("Brand#12", ["twelve", "dozen"])], "term string, parts array<string>")
    return records.split_terms(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("term")), "term", aliases, splits)


@register("""WITH m AS (SELECT l_suppkey, l_partkey, min((l_orderkey, l_linenumber)) AS o FROM lineitem GROUP BY l_suppkey, l_partkey),
  v AS (SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY o, l_partkey) AS n FROM m)
  SELECT l_suppkey, occurrences, confidence, parts FROM (SELECT l_suppkey, count(*) AS occurrences, least(1.0, max(l_discount * 12))::DOUBLE AS confidence FROM lineitem GROUP BY l_suppkey)
  JOIN (SELECT l_suppkey, string_agg(l_partkey, ',' ORDER BY n) AS parts FROM v WHERE n <= 5 GROUP BY l_suppkey) USING (l_suppkey)""")
def occurrence_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("confidence", F.col("l_discount") * 12)
    found = records.occurrences(rows, ["l_suppkey"], "confidence", ["l_orderkey", "l_linenumber"], {"l_partkey": 5})
    return found.select("l_suppkey", "occurrences", F.col("confidence").cast("double").alias("confidence"), F.array_join("l_partkey", ",").alias("parts"))


@register("""SELECT DISTINCT p_type AS name, CASE WHEN p_type LIKE '%STEEL' THEN 'exact' WHEN p_type LIKE 'SMALL%' THEN 'semantic' ELSE 'new' END AS bucket FROM part""")
def match_report(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select(F.col("p_type").alias("name"))
    return records.match_report(part, "p_type", names.where("name LIKE '%STEEL'"), names.where("name LIKE 'SMALL%'"))


@register("""SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 0 OR o_custkey % 7 = 0 OR (o_custkey + 1) % 7 = 0""")
def live_refs(spark, sf_dir):
    refs = F.when(F.col("o_orderkey") % 4 > 0, F.array(F.col("o_custkey"), F.col("o_custkey") + 1))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", refs.alias("refs"))
    live = rows.select(F.explode("refs").alias("id")).distinct().where("id % 7 = 0")
    return records.with_live_refs(rows, "o_orderkey", "refs", live, "id").select("o_orderkey")


@register("""WITH RECURSIVE e AS (SELECT c_custkey AS a, c_custkey // 2 + 3 AS b FROM customer WHERE c_custkey > 4),
  r(root, member, depth, path) AS (SELECT a, b, 1, [a, b] FROM e UNION ALL SELECT r.root, e.b, r.depth + 1, list_append(r.path, e.b) FROM r JOIN e ON r.member = e.a
    WHERE NOT list_contains(r.path[:-2], r.member))
  SELECT root, member, min(depth) AS depth, root = member AS cyclic FROM r GROUP BY root, member""")
def inclusion(spark, sf_dir):
    a = F.col("c_custkey")
    edges = table(spark, sf_dir, "customer").where(a > 4).select(a.alias("a"), (F.floor(a / 2) + 3).alias("b"))
    return records.inclusion(edges)


@register("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'new' ELSE s_name END AS s_name, s_nationkey FROM supplier""")
def update_by_key(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    changes = rows.where("s_suppkey % 2 = 0").select("s_suppkey", F.lit("new").alias("s_name"), F.lit(None).cast(rows.schema["s_nationkey"].dataType).alias("s_nationkey"))
    return records.update_by_key(rows, changes, ["s_suppkey"])
