"""Registered queries of the versioned import, of section reviews, and of files read from folders."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelforge.operators import importing, reviewing, similarity
from parcelforge.registry import register, table
from parcelforge.sources import files


@register("""SELECT o_orderkey, sha256('{"a":{"k":"' || o_orderstatus || '","n":[1,null]},"z":"caf\\u00e9 ' || o_orderpriority || '"}') AS hash, CASE WHEN o_orderkey % 4 = 0 THEN 2 WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END AS needs_review FROM orders""")
def canonical_hashes(spark, sf_dir):
    """Keys in any order, volatile keys and ids dropped at every level."""
    k = F.col("o_orderkey")
    inner = F.concat(F.lit('{"n": [1, null], "loaded_at": "'), k, F.lit('", "k": "'), F.col("o_orderstatus"), F.lit('", "zone_id": '), k, F.lit("}"))
    mark = F.when(k % 4 == 0, "needs_review").otherwise("high")
    flags = F.when(k % 4 < 2, '[{"confidence" : "needs_review"}]').otherwise("[]")
    body = F.concat(F.lit('{"z": "café '), F.col("o_orderpriority"), F.lit('", "confidence": "'), mark, F.lit('", "review_flags": '), flags, F.lit(', "a": '), inner, F.lit("}"))
    return table(spark, sf_dir, "orders").select("o_orderkey", importing.content_hash(body).alias("hash"), importing.needs_review(body).alias("needs_review"))


@register("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'sha' || p_size WHEN 1 THEN '2024' WHEN 2 THEN 'draft:' || left(sha256('root/' || p_brand), 12) ELSE 'draft:' || left(sha256('root/' || p_brand), 12) END AS revision,
  CASE WHEN p_size % 2 = 0 THEN 'Town of ' || p_brand ELSE 'City' END AS jurisdiction, 'Draft Bylaw' AS bylaw_name, p_name AS title_raw, 'Some Slug' AS named, [p_brand, p_name] AS path FROM part""")
def document_revisions(spark, sf_dir):
    k, none = F.col("p_partkey") % 4, F.lit(None).cast("string")
    manifest = F.to_json(F.struct(F.when(k == 0, F.concat(F.lit("sha"), F.col("p_size"))).when(k == 2, "").alias("source_sha256"), F.when(k == 1, "2024").alias("generated_at")))
    where = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Town of "), F.col("p_brand"))).otherwise("")
    payload = F.to_json(F.struct(F.struct(where.alias("jurisdiction"), F.col("p_name").alias("title_raw")).alias("document_metadata")))
    meta = importing.document_metadata(payload, F.lit("draft"), "City", {"draft": "Draft Bylaw", "current": "Bylaw"})
    named = importing.bylaw_metadata(F.when(k == 0, F.lit('{"section_metadata": {}}')).otherwise("{}"), F.lit("some-slug"))["bylaw_name"]
    return table(spark, sf_dir, "part").select(
        "p_partkey", importing.revision_label(F.when(k < 3, manifest).otherwise(none), F.lit("draft"), F.concat(F.lit("root/"), F.col("p_brand"))).alias("revision"), meta["jurisdiction"].alias("jurisdiction"),
        meta["bylaw_name"].alias("bylaw_name"), meta["title_raw"].alias("title_raw"), named.alias("named"), importing.clause_path(F.col("p_brand"), F.concat(F.col("p_name"), F.lit(""))).alias("path"),
    )


def _records(spark, sf_dir):
    k = F.col("o_orderkey")
    key = F.concat(F.when(k % 10 == 0, "draft|").otherwise("current|"), k)
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 2 == 0, "clause").otherwise("section").alias("record_table"), key.alias("natural_key"), F.col("o_orderstatus").alias("payload"))
    old = rows.where("k % 7 <> 0").withColumns({"content_hash": F.sha2("payload", 256), "record_id": F.col("k"), "is_active": F.lit(True), "superseded_by_id": F.lit(None).cast("bigint")}).drop("k")
    new = rows.where("k % 11 <> 0 AND k % 10 <> 0").withColumn("payload", F.when(F.col("k") % 5 == 1, "X").otherwise(F.col("payload"))).withColumn("content_hash", F.sha2("payload", 256)).drop("k")
    return old, new


_STATUS = """s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'clause' ELSE 'section' END AS record_table, CASE WHEN o_orderkey % 10 = 0 THEN 'draft|' ELSE 'current|' END || o_orderkey AS natural_key,
  o_orderkey % 7 <> 0 AS had, o_orderkey % 11 <> 0 AND o_orderkey % 10 <> 0 AS has, o_orderkey % 10 = 0 AS other, o_orderkey % 5 = 1 AND o_orderstatus <> 'X' AS differs FROM orders),
  e AS (SELECT *, CASE WHEN other THEN NULL WHEN had AND has THEN CASE WHEN differs THEN 'changed' ELSE 'unchanged' END WHEN had THEN 'removed' WHEN has THEN 'added' END AS change_status FROM s)"""


@register(f"""WITH {_STATUS} SELECT record_table, natural_key, 5::BIGINT AS import_batch_id, change_status, CASE WHEN change_status IN ('unchanged', 'removed') THEN k END AS kept_id FROM e WHERE change_status IS NOT NULL""")
def import_events(spark, sf_dir):
    _, events = importing.import_records(*_records(spark, sf_dir), "current", 5)
    kept = F.when(F.col("change_status").isin("unchanged", "removed"), F.col("active_record_id"))
    return events.select("record_table", "natural_key", "import_batch_id", "change_status", kept.alias("kept_id"))


@register(f"""WITH {_STATUS} SELECT record_table, natural_key, (had::INT + coalesce(change_status IN ('added', 'changed'), false)::INT)::BIGINT AS versions, CASE WHEN change_status = 'removed' THEN 0 ELSE 1 END::BIGINT AS active,
  CASE WHEN change_status = 'changed' THEN 1 ELSE 0 END::BIGINT AS superseded FROM e WHERE had OR change_status = 'added'""")
def import_versions(spark, sf_dir):
    after, _ = importing.import_records(*_records(spark, sf_dir), "current", 5)
    ids = after.where("is_active").select(F.col("record_id").alias("superseded_by_id"), F.lit(1).alias("_known"))
    linked = after.join(ids, "superseded_by_id", "left")
    return linked.groupBy("record_table", "natural_key").agg(F.count(F.lit(1)).alias("versions"), F.count_if("is_active").alias("active"), F.count("_known").alias("superseded"))


@register(f"""WITH {_STATUS} SELECT record_table, count(*) AS n FROM s WHERE has GROUP BY 1""")
def import_counts(spark, sf_dir):
    return importing.record_counts(_records(spark, sf_dir)[1])


@register("""WITH c AS (SELECT o_orderkey AS natural_key, o_orderkey % 3 > 0 AS cur, o_orderkey % 4 > 0 AS dra, o_orderkey % 5 = 0 AS differs, o_orderkey % 6 = 0 AS gap FROM orders)
  SELECT natural_key, CASE WHEN cur AND dra THEN 'changed' WHEN cur THEN 'removed' ELSE 'added' END AS change_status FROM c WHERE (cur OR dra) AND (cur <> dra OR differs) AND NOT (gap AND dra AND NOT cur)""")
def coverage_gaps(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("natural_key"), F.lit("h").alias("content_hash"))
    draft = rows.where("natural_key % 4 > 0").withColumn("content_hash", F.when(F.col("natural_key") % 5 == 0, "d").otherwise("h"))
    state = [F.when(F.col("natural_key") % 12 == 6, "closed").otherwise("open"), F.lit("suppress_missing_current_difference")]
    gaps = rows.where("natural_key % 6 = 0").select("natural_key", F.lit("open").alias("gap_status"), state[1].alias("comparison_effect"))
    other = rows.where("natural_key % 6 = 3").select("natural_key", F.lit("closed").alias("gap_status"), state[1].alias("comparison_effect"))
    found = importing.comparison_changes(rows.where("natural_key % 3 > 0"), draft, gaps.unionByName(other))
    return found.select("natural_key", "change_status")


@register("""WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0), n AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 0)
  SELECT k::VARCHAR AS natural_key, CASE WHEN k IN (SELECT k FROM o) THEN k END AS kept_id, CASE WHEN k IN (SELECT k FROM n) THEN 'new' ELSE 'old' END AS source_manifest_hash FROM (SELECT k FROM o UNION SELECT k FROM n)""")
def revision_upsert(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("natural_key"))
    old = rows.where("k % 2 = 0").select("natural_key", F.col("k").alias("document_revision_id"), F.lit("old").alias("source_manifest_hash"))
    after = importing.ensure_revision(old, rows.where("k % 3 = 0").select("natural_key", F.lit("new").alias("source_manifest_hash")))
    known = F.when(F.col("document_revision_id") == F.col("natural_key").try_cast("bigint"), F.col("document_revision_id"))
    return after.select("natural_key", known.alias("kept_id"), "source_manifest_hash")


def _sections(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("section_id"), F.when(F.col("p_size") % 9 > 0, F.col("p_size")).alias("source_order"), k.cast("string").alias("section_label"), F.col("p_name").alias("section_title"), F.col("p_type").alias("document_type"), F.col("p_brand").alias("zone_code")
    )


def _pairs(spark, sf_dir):
    k = F.col("s_suppkey")
    status = F.when(k % 4 == 0, "accepted").when(k % 4 == 1, "rejected").when(k % 4 == 2, "candidate")
    return table(spark, sf_dir, "supplier").select(
        k.alias("section_equivalence_id"), k.alias("current_section_id"), (k * 2 % 100).alias("draft_section_id"), F.when(k % 3 > 0, "token_v1").otherwise("other").alias("candidate_method"), status.alias("review_status"),
        F.lit("same_topic").alias("equivalence_type"), F.when(k % 5 == 0, "seen").otherwise("").alias("reviewer_notes"), F.concat(F.lit("topic"), k % 7).alias("candidate_topic"),
    )


_REVIEW = """s AS (SELECT p_partkey AS id, CASE WHEN p_size % 9 > 0 THEN p_size END AS so, p_name FROM part), p AS (SELECT s_suppkey AS k, s_suppkey AS c, s_suppkey * 2 % 100 AS d, CASE WHEN s_suppkey % 3 > 0 THEN 'token_v1' ELSE 'other' END AS m,
    CASE s_suppkey % 4 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' ELSE 'needs_review' END AS decision, CASE WHEN s_suppkey % 5 = 0 THEN 'seen' ELSE '' END AS notes FROM supplier),
  r AS (SELECT p.*, a.p_name AS ct, b.p_name AS dt, row_number() OVER (ORDER BY a.so ASC NULLS LAST, b.so ASC NULLS LAST, k) - 1 AS row_index FROM p JOIN s a ON a.id = c JOIN s b ON b.id = d)"""


@register(f"WITH {_REVIEW} SELECT k AS section_equivalence_id, row_index, decision AS review_decision, ct AS current_section_title, dt AS draft_section_title FROM r")
def review_rows(spark, sf_dir):
    rows = reviewing.review_rows(_pairs(spark, sf_dir), _sections(spark, sf_dir))
    return rows.select("section_equivalence_id", "row_index", "review_decision", "current_section_title", "draft_section_title")


@register(f"WITH {_REVIEW} SELECT k AS section_equivalence_id FROM r WHERE decision = 'needs_review' AND contains(lower(concat_ws(' ', decision, 'topic' || k % 7, 'same_topic', c::VARCHAR, ct, d::VARCHAR, dt, notes)), 'ring')")
def review_filter(spark, sf_dir):
    rows = reviewing.review_rows(_pairs(spark, sf_dir), _sections(spark, sf_dir))
    return reviewing.filter_rows(rows, " Ring ", "needs_review").select("section_equivalence_id")


@register(f"""WITH {_REVIEW} SELECT 'decision' AS kind, decision AS value, count(*) AS n FROM r GROUP BY decision UNION ALL SELECT 'rows', NULL, count(*) FROM r UNION ALL SELECT 'accepted', NULL, count(*) FILTER (decision = 'accepted') FROM r
  UNION ALL (SELECT 'zone', p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 20) UNION ALL SELECT 'flag', f, count(*) FROM (SELECT unnest(CASE WHEN p_size % 2 = 0 THEN ['a', 'b'] ELSE ['b'] END) AS f FROM part) GROUP BY f""")
def review_counts(spark, sf_dir):
    rows = reviewing.review_rows(_pairs(spark, sf_dir), _sections(spark, sf_dir))
    none = F.lit(None).cast("string")
    total = reviewing.review_summary(rows, accepted=F.col("review_decision") == "accepted").select(F.inline(F.array(*[F.struct(F.lit(c).alias("kind"), none.alias("value"), F.col(c).alias("n")) for c in ("rows", "accepted")])))
    part = table(spark, sf_dir, "part")
    flags = part.select(F.when(F.col("p_size") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b"))).alias("flags"))
    out = reviewing.decision_counts(rows).select(F.lit("decision").alias("kind"), F.col("review_decision").alias("value"), "n").unionByName(total)
    out = out.unionByName(reviewing.top_groups(part, "p_brand").select(F.lit("zone").alias("kind"), F.col("p_brand").alias("value"), "n"))
    return out.unionByName(reviewing.flag_counts(flags, "flags").select(F.lit("flag").alias("kind"), F.col("code").alias("value"), "n"))


@register("""SELECT s_suppkey AS section_equivalence_id, CASE WHEN s_suppkey % 6 = 0 THEN 'rejected' WHEN s_suppkey % 6 = 3 THEN 'accepted' ELSE CASE s_suppkey % 4 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' WHEN 2 THEN 'candidate' END END AS review_status,
  CASE WHEN s_suppkey % 6 = 0 THEN 'not_equivalent' ELSE 'same_topic' END AS equivalence_type, CASE WHEN s_suppkey % 6 IN (0, 3) THEN concat_ws(chr(10), CASE WHEN s_suppkey % 5 = 0 THEN 'seen' END, 'Review: ' || CASE WHEN s_suppkey % 6 = 0 THEN 'rejected.' ELSE 'accepted.' END)
  WHEN s_suppkey % 5 = 0 THEN 'seen' ELSE '' END AS reviewer_notes FROM supplier""")
def review_decisions(spark, sf_dir):
    k = F.col("s_suppkey")
    choices = table(spark, sf_dir, "supplier").where("s_suppkey % 6 IN (0, 2, 3)").select(k.alias("section_equivalence_id"), F.when(k % 6 == 0, "rejected").when(k % 6 == 3, "accepted").otherwise("perhaps").alias("decision"))
    return reviewing.decide(_pairs(spark, sf_dir), choices, "Review: ").select("section_equivalence_id", "review_status", "equivalence_type", "reviewer_notes")


def _candidate_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("current_key"), (k + 1).alias("draft_key"), k.alias("score"))
    status = F.when(F.col("current_key") % 5 == 0, "accepted").otherwise("candidate")
    old = rows.where("current_key % 2 = 0").select("current_key", "draft_key", F.when(F.col("current_key") % 8 == 0, "other").otherwise("token_v1").alias("candidate_method"), status.alias("review_status"), F.lit(0).cast("long").alias("score"))
    return old, rows.where("current_key % 3 = 0")


_UPSERT = """o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 8 = 0 THEN 'other' ELSE 'token_v1' END AS m, CASE WHEN o_orderkey % 5 = 0 THEN 'accepted' ELSE 'candidate' END AS s FROM orders WHERE o_orderkey % 2 = 0), n AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 0)"""


@register(f"""WITH {_UPSERT} SELECT k AS current_key, m AS candidate_method, s AS review_status, 0::BIGINT AS score FROM o WHERE m = 'other' OR s = 'accepted'
  UNION ALL SELECT k, 'token_v1', 'candidate', k FROM n WHERE k NOT IN (SELECT k FROM o WHERE m = 'token_v1' AND s = 'accepted')""")
def candidate_upsert(spark, sf_dir):
    after, _ = reviewing.upsert_candidates(*_candidate_rows(spark, sf_dir), "token_v1")
    return after.select("current_key", "candidate_method", "review_status", "score")


@register(f"""WITH {_UPSERT}, x AS (SELECT n.k, o.s FROM n LEFT JOIN o ON o.k = n.k AND m = 'token_v1')
  SELECT 'kept' AS run, CASE WHEN s IS NULL THEN 'inserted' WHEN s = 'candidate' THEN 'updated' ELSE 'preserved_reviewed' END AS outcome, count(*) AS n FROM x GROUP BY ALL
  UNION ALL SELECT 'kept', 'pruned_stale', count(*) FROM o WHERE m = 'token_v1' AND s = 'candidate' AND k NOT IN (SELECT k FROM n) UNION ALL SELECT 'reset', 'reset_deleted', count(*) FROM o WHERE m = 'token_v1' UNION ALL SELECT 'reset', 'inserted', count(*) FROM n""")
def candidate_outcomes(spark, sf_dir):
    runs = [reviewing.upsert_candidates(*_candidate_rows(spark, sf_dir), "token_v1", reset)[1].withColumn("run", F.lit(name)) for name, reset in (("kept", False), ("reset", True))]
    return runs[0].unionByName(runs[1]).select("run", "outcome", "n")


def _nested(spark, sf_dir):
    order, line, part = F.col("o_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    sections = table(spark, sf_dir, "orders").select(
        order.alias("section_id"), F.concat(F.lit("k"), order).alias("natural_key"), F.when(order % 2 == 0, "data/draft/x.json").otherwise("data/current/x.json").alias("path")
    )
    lines = table(spark, sf_dir, "lineitem")
    clauses = lines.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("section_id"), part.alias("clause_id"), F.concat(F.lit("("), line, F.lit(")")).alias("label"), F.col("l_linestatus").alias("text"), line.alias("source_order"))
    tables = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(
        order.alias("raw_table_id"), F.when(order % 2 == 0, order).alias("section_id"), F.concat(F.lit("k"), order, F.lit("|table|t|table|1")).alias("natural_key"), F.col("o_orderstatus").alias("title"), F.lit(1).alias("source_order")
    )
    cells = lines.where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("raw_table_id"), line.alias("row_order"), part.alias("column_order"), F.concat(F.lit("c"), part).alias("column_id"), F.col("l_suppkey").cast("string").alias("text"))
    return sections, clauses, tables, cells


@register("""WITH c AS (SELECT l_orderkey AS k, string_agg('(' || l_linenumber || ')' || l_linestatus, ',' ORDER BY l_linenumber, l_partkey) AS clauses FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
  r AS (SELECT l_orderkey AS k, l_linenumber, string_agg('c' || l_partkey || '=' || l_suppkey, ';' ORDER BY l_partkey) AS cells FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL), t AS (SELECT k, string_agg(l_linenumber || ':' || cells, ' ' ORDER BY l_linenumber) AS rows FROM r GROUP BY 1)
  SELECT o_orderkey AS section_id, coalesce(clauses, '') AS clauses, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || '[' || coalesce(rows, '') || ']' ELSE '' END AS tables FROM orders LEFT JOIN c ON c.k = o_orderkey LEFT JOIN t ON t.k = o_orderkey WHERE o_orderkey % 2 = 0""")
def section_detail(spark, sf_dir):
    found = reviewing.section_detail(*_nested(spark, sf_dir), family="data/draft/")
    cell = lambda c: F.concat(c["column_id"], F.lit("="), c["text"])
    row = lambda r: F.concat(r["row_order"].cast("string"), F.lit(":"), F.array_join(F.transform(r["cells"], cell), ";"))
    body = lambda t: F.concat(t["title"], F.lit("["), F.array_join(F.transform(t["rows"], row), " "), F.lit("]"))
    clauses = F.array_join(F.transform("clauses", lambda c: F.concat(c["label"], c["text"])), ",")
    return found.select("section_id", clauses.alias("clauses"), F.array_join(F.transform("tables", body), ",").alias("tables"))


@register("""SELECT o_orderkey AS section_id, o_orderkey AS raw_table_id FROM orders WHERE o_orderkey % 3 = 0""")
def or_join(spark, sf_dir):
    sections, _, tables, _ = _nested(spark, sf_dir)
    return reviewing.tables_of_sections(sections, tables).select("section_id", "raw_table_id")


@register("""WITH x AS (SELECT l_orderkey AS k, 0 AS a, l_linenumber AS b, 0 AS c, l_linestatus AS t FROM lineitem WHERE l_returnflag = 'A' UNION ALL
    SELECT l_orderkey, 1, l_linenumber, l_partkey, l_suppkey::VARCHAR FROM lineitem WHERE l_returnflag = 'N' AND l_orderkey % 6 = 0 AND l_orderkey IN (SELECT o_orderkey FROM orders))
  SELECT k AS section_id, string_agg(t, ' ' ORDER BY a, b, c, t) AS text, count(*) AS items, left(string_agg(t, ' ' ORDER BY a, b, c, t), 12) AS preview FROM x GROUP BY k""")
def section_texts(spark, sf_dir):
    _, clauses, tables, cells = _nested(spark, sf_dir)
    found = reviewing.section_texts(clauses, tables.where("section_id IS NOT NULL"), cells)
    return found.select("section_id", "text", "items", reviewing.preview(F.col("text"), 12).alias("preview"))


@register(f"""WITH {_REVIEW}, t AS (SELECT l_orderkey AS k, string_agg(l_linestatus, ' ' ORDER BY l_linenumber, l_linestatus) AS text, count(*) AS items FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
  SELECT r.k AS section_equivalence_id, row_number() OVER (ORDER BY row_index) - 1 AS row_index, coalesce(a.text, '') AS current_text_preview, coalesce(a.items, 0) AS current_items, coalesce(b.text, '') AS draft_text_preview, coalesce(b.items, 0) AS draft_items
  FROM r LEFT JOIN t a ON a.k = r.c LEFT JOIN t b ON b.k = r.d WHERE m = 'token_v1'""")
def review_ledger(spark, sf_dir):
    _, clauses, tables, cells = _nested(spark, sf_dir)
    texts = reviewing.section_texts(clauses, tables.limit(0), cells)
    found = reviewing.review_ledger(_pairs(spark, sf_dir), _sections(spark, sf_dir), texts, "token_v1")
    return found.select("section_equivalence_id", "row_index", "current_text_preview", "current_items", "draft_text_preview", "draft_items")


@register("SELECT p_partkey FROM part WHERE p_partkey % 3 = 0")
def checked_members(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey")
    return reviewing.checked_members(part, part.where("p_partkey % 3 = 0"), "p_partkey")


#: Pairs of titles with their similarity by Ratcliff and Obershelp's rule, worked out by hand.
_RATIOS = [("lot area", "lot areas", 16 / 17), ("signs", "parking", 4 / 12), ("permitted uses", "uses permitted", 18 / 28), ("", "yard", 0.0), ("abcd", "bcde", 0.75)]


@register("SELECT p_partkey, [" + ", ".join(f"round({v!r}::DOUBLE, 6)" for *_, v in _RATIOS) + "][p_partkey % 5 + 1] AS ratio FROM part")
def title_ratios(spark, sf_dir):
    at = (F.col("p_partkey") % 5 + 1).cast("int")
    one, two = (F.element_at(F.array(*[F.lit(r[i]) for r in _RATIOS]), at) for i in (0, 1))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(similarity.ratio(one, two), 6).alias("ratio"))


@register("""WITH p AS (SELECT page_id, page_id % 10 AS k FROM pages) SELECT page_id, CASE WHEN k < 7 THEN 'object' WHEN k < 9 THEN 'array' ELSE 'broken' END AS kind FROM p""")
def json_kinds(spark, sf_dir):
    """The test that the scan of JSON documents applies to each payload."""
    k = F.col("page_id") % 10
    payload = F.when(k < 7, F.to_json(F.struct("page_id"))).when(k < 9, F.concat(F.lit("["), F.col("page_id"), F.lit("]"))).otherwise('{"page_id": ')
    kind = F.schema_of_variant(F.try_parse_json(payload))
    return table(spark, sf_dir, "pages").select("page_id", F.when(F.startswith(kind, F.lit("OBJECT")), "object").when(F.startswith(kind, F.lit("ARRAY")), "array").otherwise("broken").alias("kind"))


@register("""SELECT page_id, CASE WHEN page_id % 3 > 0 THEN page_id::INT END AS printed_page, CASE WHEN page_id % 3 > 0 THEN 'text ' || page_id ELSE 'no number' END AS text FROM pages""")
def printed_pages(spark, sf_dir):
    k = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select("page_id", F.when(k % 3 > 0, F.concat(F.lit("text "), k, F.lit("\nBy-law Page "), k)).otherwise("no number").alias("text"))
    return files.printed_pages(rows, "text", r"By-law Page (\d+)")


@register("""SELECT s_suppkey, u.place, CASE WHEN u.place = 0 THEN 16.0 ELSE 25.0 END::DOUBLE AS area, CASE WHEN u.place = 0 THEN 'a' ELSE 'b' END AS name FROM supplier, (VALUES (0), (1)) u(place)""")
def geojson_polygons(spark, sf_dir):
    from parcelforge.operators import shapes

    square = '{"type":"Polygon","coordinates":[[[0,0],[5,0],[5,5],[0,5],[0,0]],[[1,1],[4,1],[4,4],[1,4],[1,1]]]}'
    two = '{"type":"MultiPolygon","coordinates":[[[[0,0],[4,0],[4,4],[0,4],[0,0]]],[[[9,9],[12,9],[12,12],[9,12],[9,9]]]]}'
    body = f'{{"type":"FeatureCollection","features":[{{"geometry":{square},"properties":{{"name":"a"}}}},{{"geometry":{two},"properties":{{"name":"b"}}}}]}}'
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("path"), F.lit(body).alias("payload"))
    found = files.geojson_shapes(rows, "payload")
    return found.select(F.col("path").alias("s_suppkey"), "place", F.round(shapes.area(F.col("shape")), 6).alias("area"), F.get_json_object("properties", "$.name").alias("name"))


@register("""WITH t AS (SELECT p_partkey // 40 AS tr, p_partkey % 40 AS tc, p_size FROM part), i AS (SELECT unnest(range(6)) AS i)
  SELECT tr * 3 + i // 3 AS "row", tc * 3 + i % 3 AS col, (p_size + i) % 256 AS r, tc AS g, tr % 256 AS b FROM t, i""")
def tile_mosaic(spark, sf_dir):
    k = F.col("p_partkey")
    byte = lambda c: F.unhex(F.lpad(F.hex(c.cast("long") % 256), 2, "0"))
    row, col = F.floor(k / 40), k % 40
    content = F.concat(*[x for i in range(6) for x in (byte(F.col("p_size") + i), byte(col), byte(row))])
    return files.mosaic(table(spark, sf_dir, "part").select(row.alias("tile_row"), col.alias("tile_col"), content.alias("content")), 3)
