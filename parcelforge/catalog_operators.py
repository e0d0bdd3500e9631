"""Registered queries of record keeping, requests, lines and layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelforge.functions import text as T
from parcelforge.operators import extraction, layout, records, similarity, tables, validate, versioning
from parcelforge.plans import requests
from parcelforge.registry import register, table


@register("""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders) SELECT k, CASE WHEN k % 3 = 0 THEN 'new' ELSE v END AS v, 'merge' AS run FROM o WHERE k % 2 = 0 OR k % 3 = 0
  UNION ALL SELECT k, CASE WHEN k % 2 = 0 THEN v ELSE 'new' END, 'ignore' FROM o WHERE k % 2 = 0 OR k % 3 = 0 UNION ALL SELECT k, v, 'delete' FROM o WHERE k % 2 = 0 AND v <> 'F'""")
def keyed_writes(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    old, new = rows.where("k % 2 = 0"), rows.where("k % 3 = 0").withColumn("v", F.lit("new"))
    runs = {"merge": records.merge_rows(old, new, ["k"]), "ignore": versioning.insert_ignore(old, new, ["k"]), "delete": records.delete_where(old, F.col("v") == "F")}
    marked = [r.select("k", "v", F.lit(name).alias("run")) for name, r in runs.items()]
    return marked[0].unionByName(marked[1]).unionByName(marked[2])


@register("""SELECT o_orderkey AS natural_key, CASE WHEN o_orderkey % 4 = 0 THEN 'needs_re_evaluation' WHEN o_orderkey % 3 = 0 THEN 'needs_re_evaluation' ELSE 'reapplied' END AS correction_status FROM orders WHERE o_orderkey % 2 = 0""")
def correction_replay(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("natural_key"), F.col("o_orderstatus").alias("content_hash"))
    active = rows.where("natural_key % 3 <> 0").withColumn("content_hash", F.when(F.col("natural_key") % 4 == 0, "changed").otherwise(F.col("content_hash")))
    return versioning.replay_corrections(rows.where("natural_key % 2 = 0"), active).select("natural_key", "correction_status")


@register("""SELECT s_suppkey, 'rejected' AS review_status, 'not_equivalent' AS equivalence_type, CASE WHEN s_suppkey % 2 = 0 THEN 'old' || chr(10) || 'said' ELSE 'said' END AS reviewer_notes FROM supplier""")
def review_note(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("candidate").alias("review_status"), F.lit("same_topic").alias("equivalence_type"), F.when(F.col("s_suppkey") % 2 == 0, "old").otherwise("").alias("reviewer_notes"))
    return versioning.review(rows, "rejected", "said")


@register("""SELECT * FROM (VALUES ('limit', '5', '5'), ('limit', '900', '25'), ('limit', 'x', '10'), ('limit', '-2', '10'), ('limit', '3.9', '3'), ('bbox', '-63.2,46.2,-63.0,46.3', '-63.2 46.2 -63.0 46.3'), ('bbox', '1,2,3', 'error'), ('bbox', '3,2,1,4', 'error'), ('bbox', 'a,b,c,d', 'error'),
  ('point', '-63.1 46.2', '-63.1 46.2'), ('point', '-181 0', 'error'), ('point', 'x 0', 'error')) v(kind, given, got)""")
def request_checks(spark, sf_dir):
    def tried(check, *values):
        try:
            got = check(*values)
        except ValueError:
            return "error"
        return " ".join(str(x) for x in got) if isinstance(got, tuple) else str(got)

    limits = [("limit", v, tried(requests.limit_of, v, 10, 25)) for v in ("5", "900", "x", "-2", "3.9")]
    boxes = [("bbox", v, tried(requests.bbox_of, v)) for v in ("-63.2,46.2,-63.0,46.3", "1,2,3", "3,2,1,4", "a,b,c,d")]
    points = [("point", v, tried(requests.point_of, *v.split(" "))) for v in ("-63.1 46.2", "-181 0", "x 0")]
    return spark.createDataFrame(limits + boxes + points, "kind string, given string, got string")


@register("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'extra,more' ELSE '' END AS unknown FROM events""")
def unknown_keys(spark, sf_dir):
    body = F.when(F.col("event_id") % 2 == 0, '{"k": 1, "extra": 2, "more": 3}').otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(validate.unknown_keys(body, ["k"]), ",").alias("unknown"))


_LABELS = ["2", "2.1", "21", "3.4", "5"]


@register("""SELECT p_partkey, ['2', '2.1', '21', '3.4', '5'][p_partkey % 5 + 1] AS label, p_partkey % 5 IN (0, 1, 4) AS allowed FROM part""")
def allowed_labels(spark, sf_dir):
    label = F.element_at(F.array(*[F.lit(v) for v in _LABELS]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"), extraction.in_allowed(label, F.array(F.lit("2"), F.lit("5"))).alias("allowed"))


@register("""SELECT event_id, CASE WHEN event_id % 40 < 10 THEN 'first' ELSE 'second' END AS name FROM events WHERE event_id % 40 < 10 OR event_id % 40 BETWEEN 20 AND 24""")
def filtered_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.lit("d").alias("doc"), (F.col("event_id") % 40).alias("page"))
    spec = spark.createDataFrame([("d", 0, 9, "first"), ("d", 20, 24, "second")], "doc string, first_page int, last_page int, name string")
    return extraction.page_filter(rows, "page", spec, "doc").select("event_id", "name")


@register("""SELECT p_partkey, '"' || p_name || '" - it''s' AS line, CASE p_partkey % 3 WHEN 0 THEN 'Lot' WHEN 1 THEN 'Old shed' ELSE 'odd ' || p_name END AS term, CASE p_partkey % 3 WHEN 0 THEN 'means ' || p_name WHEN 1 THEN 'Repealed 2019' ELSE 'odd ' || p_name END AS meaning,
  CASE WHEN p_partkey % 3 = 1 THEN 'repealed' ELSE 'active' END AS status, concat_ws('::', p_brand, CASE WHEN p_size % 2 = 0 THEN p_type END, p_partkey::VARCHAR) AS source_key FROM part""")
def clean_lines(spark, sf_dir):
    k, name = F.col("p_partkey") % 3, F.col("p_name")
    entry = extraction.definition_entry(F.when(k == 0, F.concat(F.lit("Lot means "), name)).when(k == 1, "Old shed Repealed 2019").otherwise(F.concat(F.lit("odd "), name)))
    line = extraction.clean_line(F.concat(F.lit("  “"), name, F.lit("”  –\tit’s ")))
    key = T.source_key(F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(""), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", line.alias("line"), entry["term"].alias("term"), entry["meaning"].alias("meaning"), entry["status"].alias("status"), key.alias("source_key"))


@register("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'corner lots' WHEN 1 THEN 'corner lots,rear' ELSE '' END AS notes FROM part""")
def footnotes(spark, sf_dir):
    symbols = F.element_at(F.array(F.lit("●①"), F.lit("①②"), F.lit("●")), (F.col("p_partkey") % 3 + 1).cast("int"))
    notes = F.create_map(F.lit("①"), F.lit("corner lots"), F.lit("②"), F.lit("rear"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(extraction.footnote_texts(symbols, notes, "●"), ",").alias("notes"))


@register("""WITH r AS (SELECT DISTINCT l_orderkey AS section, l_linenumber AS n, 'c' || l_linenumber AS id, 'clause' AS kind, 0 AS k FROM lineitem WHERE l_returnflag = 'A' UNION SELECT DISTINCT l_orderkey, l_linenumber, 't' || l_linenumber, 'table', 1 FROM lineitem WHERE l_returnflag = 'N')
  SELECT section, row_number() OVER (PARTITION BY section ORDER BY n, k, id) AS place, kind, id FROM r""")
def section_contents(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("section"), F.col("l_linenumber").alias("n"), "l_returnflag")
    part = lambda flag, mark: rows.where(F.col("l_returnflag") == flag).select("section", "n", F.concat(F.lit(mark), "n").alias("id")).distinct()
    return records.content_order([(part("A", "c"), "clause"), (part("N", "t"), "table")], "section", ["n"])


@register("""WITH c AS (SELECT l_orderkey AS k, list_sort(list_distinct(list(l_linestatus || l_linenumber))) AS cs FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
  SELECT o_orderkey AS k, array_to_string(coalesce(cs, []), ',') AS conditions FROM orders LEFT JOIN c ON c.k = o_orderkey WHERE o_orderkey % 5 <> 0""")
def enriched_clauses(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    conditions = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"), F.concat("l_linestatus", "l_linenumber").alias("condition"))
    found = records.enrich(rows, "k", rows.where("k % 5 = 0"), conditions)
    return found.select("k", F.array_join("conditions", ",").alias("conditions"))


@register("""SELECT p_partkey, s.scope, coalesce(s.v, p_name) AS value FROM part LEFT JOIN (VALUES (1, 'corner', 'p'), (1, 'inner', 'q'), (4, 'corner', 'r')) s(k, scope, v) ON p_partkey % 7 = s.k""")
def scoped_values(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 7).alias("k"), F.col("p_name").alias("value"))
    scopes = spark.createDataFrame([(1, "corner", "p"), (1, "inner", "q"), (4, "corner", "r")], "k long, scope string, value string")
    return tables.scoped_alternatives(rows, ["k"], scopes, "value").select("p_partkey", "scope", "value")


_WORDS = """w AS (SELECT event_id // 60 AS page, event_id % 7 * 10.0 AS x, event_id % 60 // 7 * 12.0 + event_id % 3 AS y, event_type || event_id AS text FROM events)"""


def _words(spark, sf_dir):
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.floor(k / 60).alias("page"), (k % 7 * 10.0).alias("x"), (F.floor(k % 60 / 7) * 12.0 + k % 3).cast("double").alias("y"), F.concat("event_type", k).alias("text")
    )


@register(f"""WITH {_WORDS}, l AS (SELECT *, floor(y / 12) AS line FROM w) SELECT page, row_number() OVER (PARTITION BY page ORDER BY line) - 1 AS line, min(y)::DOUBLE AS y, string_agg(text, ' ' ORDER BY x, text) AS text FROM l GROUP BY page, line""")
def page_word_lines(spark, sf_dir):
    """Words in lines twelve apart that waver by up to two: the gap of five tells the lines."""
    return layout.word_lines(_words(spark, sf_dir), ["page"])


@register(f"""WITH {_WORDS}, l AS (SELECT *, floor(y / 12) AS line FROM w) SELECT page, string_agg(text, ' ' ORDER BY x, text) AS text FROM l GROUP BY page, line""")
def page_bucket_rows(spark, sf_dir):
    return layout.bucket_rows(_words(spark, sf_dir), ["page"]).select("page", "text")


@register("""SELECT p_partkey, round(least(greatest(t, 0.95 * k, 0.75 * x) + CASE WHEN p_size % 2 = 0 THEN 0.08 ELSE 0 END + CASE WHEN p_size % 3 = 0 THEN 0.12 ELSE 0 END, 1), 6)::DOUBLE AS score,
  CASE WHEN t >= 0.92 THEN 'same_topic' WHEN x >= 0.45 THEN 'renamed_or_restructured' ELSE 'partial_overlap' END AS kind, CASE WHEN p_partkey % 3 = 0 THEN 'permitted_uses' WHEN p_partkey % 3 = 1 THEN 'signage' END AS family
  FROM (SELECT *, p_partkey % 11 / 10.0::DOUBLE AS t, p_partkey % 7 / 10.0::DOUBLE AS k, p_partkey % 9 / 10.0::DOUBLE AS x FROM part)""")
def equivalence_scores(spark, sf_dir):
    k = F.col("p_partkey")
    title, words, body = (k % 11) / 10.0, (k % 7) / 10.0, (k % 9) / 10.0
    total = similarity.score(title, words, body, F.col("p_size") % 2 == 0, F.col("p_size") % 3 == 0)
    name = F.when(k % 3 == 0, "Conditional uses and signs").when(k % 3 == 1, "Of Signs").otherwise("other")
    return table(spark, sf_dir, "part").select("p_partkey", F.round(total, 6).alias("score"), similarity.equivalence(F.least(total, F.lit(0.7)), title, body).alias("kind"), similarity.title_family(name).alias("family"))


@register("""SELECT n_regionkey::VARCHAR AS code_table, lower(n_name) AS key, 'c' || max(n_nationkey) OVER (PARTITION BY n_regionkey) AS code FROM nation QUALIFY n_nationkey = max(n_nationkey) OVER (PARTITION BY n_regionkey)
  UNION ALL SELECT r_regionkey::VARCHAR, 'shared', 'last' FROM region WHERE r_regionkey = (SELECT max(r_regionkey) FROM region)""")
def code_tables(spark, sf_dir):
    """Each region is a code table whose entries spell the same two keys; the last entry of all spells one of them too."""
    entry = lambda code, label: F.struct(code.alias("code"), label.alias("label"), F.lit(None).cast("string").alias("symbol"), F.lit("active").alias("status"))
    top = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.max(F.struct("n_nationkey", "n_name")).alias("t"))
    body = F.to_json(F.struct(F.col("n_regionkey").cast("string").alias("code_table"), F.array(
        entry(F.lit("first"), F.concat(F.lit(" "), F.upper("t.n_name"))), entry(F.concat(F.lit("c"), F.col("t.n_nationkey")), F.col("t.n_name")), entry(F.lit("last"), F.lit("Shared"))).alias("entries")))
    entries = records.code_entries(top.select(body.alias("payload")), "payload")
    return records.lookup(entries, "label", ["code_table", "place"]).select("code_table", "key", "code")


@register("""WITH s AS (SELECT o_orderkey AS k, count(l_orderkey) AS n, list_sort(list_distinct(list(l_linestatus) FILTER (l_linestatus IS NOT NULL))) AS v FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
  t AS (SELECT l_orderkey AS k, count(*) AS n, list_sort(list_distinct(list(l_linestatus))) AS v FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
  SELECT coalesce(s.k, t.k) AS k, coalesce(s.n, 0) AS source_n, coalesce(t.n, 0) AS target_n, array_to_string(list_sort(list_filter(coalesce(s.v, []), lambda x: NOT list_contains(coalesce(t.v, []), x))), ',') AS missing,
  array_to_string(list_sort(list_filter(coalesce(t.v, []), lambda x: NOT list_contains(coalesce(s.v, []), x))), ',') AS extra, coalesce(s.n, 0) = coalesce(t.n, 0) AS kept FROM s FULL JOIN t ON s.k = t.k""")
def source_conservation(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linestatus").alias("v"), "l_returnflag")
    source = lines.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), "k")
    found = records.conservation(source, lines.where("l_returnflag <> 'R'"), "k", "v")
    return found.select("k", "source_n", "target_n", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"), "kept")


@register("""WITH s AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 > 0), c AS (SELECT DISTINCT l_orderkey AS k, l_orderkey || '-' || l_linenumber AS id FROM lineitem SEMI JOIN s ON k = l_orderkey), f AS (SELECT DISTINCT l_partkey AS id FROM lineitem JOIN c ON c.id = l_orderkey || '-' || l_linenumber
    UNION SELECT p_partkey FROM part WHERE p_partkey % 10 = 0)
  SELECT 'clause' AS kind, count(*) AS n FROM c UNION ALL SELECT 'fact', count(*) FROM (SELECT id FROM f SEMI JOIN part ON p_partkey = id WHERE id % 10 <> 0 UNION SELECT p_partkey FROM part WHERE p_partkey % 10 = 0)
  UNION ALL SELECT 'flag', count(*) FROM (SELECT p_partkey FROM part WHERE (p_partkey + 1) IN (SELECT id FROM f SEMI JOIN part ON p_partkey = id WHERE id % 10 <> 0 UNION SELECT p_partkey FROM part WHERE p_partkey % 10 = 0))""")
def live_cascade(spark, sf_dir):
    """Sections, their clauses, facts that clauses state, and flags on the next fact; facts of every tenth part name no clause."""
    sections = table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("section_id"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("section_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey")
    refs = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.collect_set(F.struct(F.lit("clause").alias("kind"), "id")).alias("_r"))
    none = F.array().cast("array<struct<kind:string,id:string>>")
    facts = part.join(refs, "p_partkey", "left").select(F.col("p_partkey").alias("id"), F.when((F.col("p_partkey") % 10 == 0), none).otherwise(F.coalesce("_r", F.array(F.struct(F.lit("clause").alias("kind"), F.lit("x").alias("id"))))).alias("refs"))
    flags = part.select(F.col("p_partkey").alias("id"), F.array(F.struct(F.lit("fact").alias("kind"), (F.col("p_partkey") + 1).cast("string").alias("id"))).alias("refs"))
    kept = records.cascade(sections, {"clause": lines.select("section_id", "id").distinct()}, {"fact": facts, "flag": flags})
    return records.type_counts({k: (v.withColumn("_t", F.lit(k)), "_t") for k, v in kept.items()}).select(F.col("type").alias("kind"), "n")


_ROW_LABELS = ["Lot area (minimum", "for corners)", "Yard of", "Rear", "fence height", "Signs", "Parking /", "Loading"]


@register("""WITH r AS (SELECT user_id, event_id, event_id % 8 AS k, lag(event_id % 8) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events), f AS (SELECT *, CASE WHEN b IN (0, 2, 6) OR (k IN (1, 4) AND b IS NOT NULL) THEN 0 ELSE 1 END AS f FROM r),
  g AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY event_id) AS "row" FROM f)
  SELECT user_id, "row"::BIGINT AS "row", string_agg(['Lot area (minimum', 'for corners)', 'Yard of', 'Rear', 'fence height', 'Signs', 'Parking /', 'Loading'][k + 1], ' ' ORDER BY event_id) AS label FROM g GROUP BY ALL""")
def merged_labels(spark, sf_dir):
    label = F.element_at(F.array(*[F.lit(v) for v in _ROW_LABELS]), (F.col("event_id") % 8 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", label.alias("label"))
    return extraction.merge_labels(rows, ["user_id"], ["event_id"], "label")


@register("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'dot_numeric_provision_labels' WHEN 1 THEN 'parenthesized_alpha_clause_labels' WHEN 2 THEN 'roman_numeral_trailing_parenthesis_clause_labels' END AS pattern,
  CASE WHEN p_partkey % 4 < 3 THEN trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') END AS label FROM part""")
def provision_labels(spark, sf_dir):
    k = F.col("p_partkey") % 4
    label = F.when(k == 0, ".2").when(k == 1, "(a)").when(k == 2, "iv)").otherwise("section")
    return table(spark, sf_dir, "part").select("p_partkey", extraction.provision_patterns(label).alias("pattern"), T.canonical_label(F.when(k < 3, F.col("p_name")).otherwise(" - ")).alias("label"))
