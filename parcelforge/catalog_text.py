"""Registered queries of the classifiers and of uses, references, candidates, requirements and terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelforge.functions import classify, measure
from parcelforge.operators import references
from parcelforge.registry import register, table

_TITLES = ["Permitted Uses", "Lot area and height", "Landscaping", "Application for a permit", "Schedule C map", "Something else", "Design", "Signs"]


def _pick(values: list[str], at):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


@register(f"""WITH t AS (SELECT p_partkey, {_sql_list(_TITLES)}[p_partkey % 8 + 1] || ' of ' || p_name AS title, CASE WHEN p_size % 5 = 0 THEN 'definitions' END AS dt FROM part), h AS (SELECT *, lower(concat_ws(' ', coalesce(dt, ''), title)) AS h FROM t)
  SELECT p_partkey, CASE WHEN contains(h, 'definitions') THEN 'definitions' WHEN contains(h, 'permit') AND NOT contains(h, 'permitted') THEN 'process' WHEN contains(h, 'permit') THEN 'process' WHEN contains(h, 'application') THEN 'process'
  WHEN contains(h, 'use') THEN 'permitted_uses' WHEN contains(h, 'parking') THEN 'parking' WHEN contains(h, 'sign') THEN 'signage' WHEN contains(h, 'landscap') OR contains(h, 'buffer') THEN 'landscaping'
  WHEN contains(h, 'setback') OR contains(h, 'yard') OR contains(h, 'lot') OR contains(h, 'height') THEN 'lot_requirements' WHEN contains(h, 'map') OR contains(h, 'schedule') THEN 'maps_schedules'
  WHEN contains(h, 'design') THEN 'design_standards' WHEN contains(h, 'site specific') THEN 'site_specific' WHEN contains(h, 'administration') THEN 'administration' ELSE 'other' END AS topic FROM h""")
def section_topics(spark, sf_dir):
    title = F.concat(_pick(_TITLES, F.col("p_partkey") % 8), F.lit(" of "), F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", classify.topic(F.when(F.col("p_size") % 5 == 0, "definitions"), title).alias("topic"))


_USES = ["Accessory dwelling", "Two-unit dwellings", "Public library", "Golf Club", "Retail shop", "Museum", "Bedroom rental", "Apartment House"]


@register(f"""WITH u AS (SELECT p_partkey, lower({_sql_list(_USES)}[p_partkey % 8 + 1] || ' ' || p_name) AS u FROM part) SELECT p_partkey,
  CASE WHEN contains(u, 'accessory') THEN 'accessory_use' WHEN regexp_matches(u, 'dwelling|suite|housing|bedroom rental') THEN 'residential_use' WHEN regexp_matches(u, 'school|library|hospital|religious|institution') THEN 'institutional_or_open_space_use'
    WHEN regexp_matches(u, 'park|recreation|playground|club') THEN 'recreation_use' ELSE 'principal_use' END AS suburban,
  CASE WHEN contains(u, 'accessory') THEN 'accessory_use' WHEN regexp_matches(u, 'dwelling|shared housing|apartment|duplex') THEN 'residential_use' WHEN regexp_matches(u, 'school|library|museum|worship') THEN 'institutional_or_open_space_use'
    WHEN regexp_matches(u, 'park|playground|golf|club') THEN 'recreation_use' ELSE 'principal_use' END AS urban FROM u""")
def use_types(spark, sf_dir):
    use = F.concat_ws(" ", _pick(_USES, F.col("p_partkey") % 8), F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", classify.use_type(use).alias("suburban"), classify.use_type(use, "urban").alias("urban"))


_POLICIES = ["Council shall consider a development agreement", "Repealed 2009", "It may be Designated", "See the Generalized Future Land Use Map", "Council should marshal", "No word of it", "Map 3 may and shall"]


@register(f"""WITH p AS (SELECT o_orderkey, {_sql_list(_POLICIES)}[o_orderkey % 7 + 1] AS t, CASE WHEN o_orderkey % 9 = 0 THEN 'implementation' ELSE 'general' END AS s FROM orders), l AS (SELECT *, lower(t) AS l FROM p)
  SELECT o_orderkey, CASE WHEN contains(l, 'repealed') THEN 'repealed' WHEN contains(l, 'deleted') THEN 'deleted' WHEN s = 'implementation' THEN 'implementation_policy' WHEN contains(l, 'map ') OR contains(l, 'generalized future land use map') THEN 'map_interpretation_policy'
  WHEN contains(l, 'designat') THEN 'designation_policy' WHEN contains(l, 'development agreement') AND contains(l, 'shall consider') THEN 'development_agreement_criteria' ELSE 'policy_statement' END AS policy_type,
  CASE WHEN regexp_matches(l, '\\bshall\\b') THEN 'shall' WHEN regexp_matches(l, '\\bshould\\b') THEN 'should' WHEN regexp_matches(l, '\\bmay\\b') THEN 'may' END AS modality FROM l""")
def policy_types(spark, sf_dir):
    text, kind = _pick(_POLICIES, F.col("o_orderkey") % 7), F.when(F.col("o_orderkey") % 9 == 0, "implementation").otherwise("general")
    return table(spark, sf_dir, "orders").select("o_orderkey", classify.policy_type(kind, text).alias("policy_type"), classify.modality(text).alias("modality"))


_PATHS = ["data/zones/r1.json", "data/schedules/a.json", "data/definitions.json", "x/appendix-b.json", "x/general-provisions.json", "docs/Zoning Map/map.PDF", "scripts/a.py", "maps/Street Map.png", "x/maps.json", "zoning/Official Plan/plan.pdf"]


@register(f"""WITH p AS (SELECT p_partkey, {_sql_list(_PATHS)}[p_partkey % 10 + 1] AS p FROM part), x AS (SELECT *, regexp_extract(p, '([^/]+)/[^/]+$', 1) AS folder, regexp_extract(p, '([^/]+)$', 1) AS name, lower(regexp_extract(p, '[.]([^./]+)$', 1)) AS ext, lower(p) AS l FROM p)
  SELECT p_partkey, CASE WHEN folder = 'zones' THEN 'zone' WHEN folder = 'schedules' THEN 'schedule' WHEN name = 'definitions.json' THEN 'definitions' WHEN name LIKE 'appendix-%' THEN 'appendix' WHEN name LIKE 'general-provisions%' THEN 'general_provisions' ELSE 'document' END AS file_kind,
  CASE WHEN folder = 'zones' THEN 'zone' WHEN folder = 'schedules' THEN 'schedule' WHEN name = 'definitions.json' THEN 'definitions' WHEN name = 'maps.json' THEN 'maps' WHEN name = 'general-provisions.json' THEN 'general_provisions' WHEN name LIKE 'appendix-%' THEN 'appendix' ELSE 'document' END AS section_kind,
  CASE ext WHEN 'json' THEN 'extracted_json' WHEN 'pdf' THEN 'pdf' WHEN 'png' THEN 'image' ELSE 'unknown' END AS source_type,
  CASE WHEN p LIKE 'scripts/%' THEN 'converter_code' WHEN ext = 'pdf' AND (p LIKE 'docs/%' OR p LIKE 'zoning/%') THEN 'primary_source' ELSE 'source_extract' END AS source_role,
  CASE WHEN contains(l, '/zoning map') THEN 'zoning_map' WHEN contains(l, '/official plan') THEN 'official_plan_text' WHEN contains(l, 'street map') THEN 'street_map' ELSE 'unknown' END AS kind,
  array_to_string(list_concat(CASE WHEN ext = 'pdf' THEN ['attempt_text_extraction', 'attempt_vector_layer_extraction'] ELSE ['ocr_required'] END, list_concat(
    CASE WHEN contains(l, '/zoning map') OR contains(l, 'street map') THEN ['georeference_needed', 'legend_parsing_needed'] ELSE [] END,
    CASE WHEN contains(l, '/official plan') THEN ['section_and_table_parsing_needed', 'citation_capture_required'] ELSE [] END)), ',') AS hints FROM x""")
def path_classes(spark, sf_dir):
    path = _pick(_PATHS, F.col("p_partkey") % 10)
    kind = classify.source_class(path)["kind"]
    return table(spark, sf_dir, "part").select(
        "p_partkey", classify.file_kind(path).alias("file_kind"), classify.section_kind(path).alias("section_kind"), classify.source_type(path).alias("source_type"), classify.source_role(path).alias("source_role"),
        kind.alias("kind"), F.array_join(classify.extraction_hints(kind, classify.extension(path)), ",").alias("hints"),
    )


@register("""WITH u AS (SELECT l_orderkey, list(CASE l_returnflag WHEN 'A' THEN 'Residential' WHEN 'R' THEN 'office use' END) AS uses, bool_or(l_linestatus = 'F') AS f FROM lineitem GROUP BY l_orderkey),
  z AS (SELECT l_orderkey, array_to_string(list_filter(uses, lambda x: x IS NOT NULL), ' ') AS s, len(uses) AS n, l_orderkey % 13 = 0 AS sched, l_orderkey % 7 = 0 AS plan, f FROM u),
  k AS (SELECT *, CASE WHEN sched THEN 'schedule_zone' WHEN plan THEN 'planned_development' ELSE 'base' END AS kind FROM z)
  SELECT l_orderkey, kind, CASE WHEN kind = 'planned_development' THEN 'planned' WHEN contains(s, 'Residential') AND contains(s, 'office') THEN 'mixed_with_residential' WHEN contains(s, 'Residential') THEN 'primarily_residential' ELSE 'nonresidential' END AS class,
  CASE WHEN sched THEN 'partially_mapped' ELSE 'unknown' END AS mapped, CASE WHEN f THEN 'permitted_with_conditions' WHEN l_orderkey % 3 = 0 THEN 'permitted_with_conditions' ELSE 'permitted' END AS permission FROM k""")
def zone_classes(spark, sf_dir):
    k = F.col("l_orderkey")
    use = F.when(F.col("l_returnflag") == "A", "Residential").when(F.col("l_returnflag") == "R", "office use")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.coalesce(use, F.lit(""))).alias("uses"), F.bool_or(F.col("l_linestatus") == "F").alias("f"))
    schedule, name = F.when(k % 13 == 0, "Schedule A"), F.when(k % 7 == 0, "Comprehensive Development District").otherwise("Low")
    kind = classify.zone_kind(schedule, F.concat(F.lit("Z"), k), name)
    uses = F.transform("uses", lambda u: F.nullif(u, F.lit("")))
    symbols = F.when(k % 3 == 0, F.array(F.lit("permitted"), F.lit("x"))).when(k % 3 == 1, F.array(F.lit("Permitted")))
    return rows.select(
        "l_orderkey", kind.alias("kind"), classify.zone_class(kind, uses).alias("class"), classify.mapped_status(schedule).alias("mapped"),
        classify.permission_status(F.when(F.col("f"), F.array(F.lit("corner lots"))), symbols).alias("permission"),
    )


@register("""WITH l AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '(' || p_partkey || ')' WHEN 1 THEN '(' || chr((97 + p_size % 26)::INT) || chr((97 + p_partkey % 26)::INT) || ')' WHEN 2 THEN chr((65 + p_size % 26)::INT) ELSE 'x-' || p_size END AS label FROM part),
  t AS (SELECT *, lower(replace(replace(label, '(', ''), ')', '')) AS t FROM l), k AS (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS kind,
  CASE p_partkey % 4 WHEN 0 THEN t::BIGINT WHEN 1 THEN (ascii(t[1]) - 96) * 26 + ascii(t[2]) - 96 WHEN 2 THEN ascii(t) - 96 END AS n, CASE WHEN p_partkey % 4 = 3 THEN t END AS s FROM t)
  SELECT p_partkey, row_number() OVER (ORDER BY kind, n, s, p_partkey) AS place FROM k""")
def natural_order(spark, sf_dir):
    from pyspark.sql import Window

    k, letter = F.col("p_partkey"), lambda c: F.char((F.lit(97) + c % 26).cast("long"))
    plain = F.concat(F.lit("("), k, F.lit(")"))
    label = F.when(k % 4 == 0, plain).when(k % 4 == 1, F.concat(F.lit("("), letter(F.col("p_size")), letter(k), F.lit(")"))).when(k % 4 == 2, F.upper(letter(F.col("p_size")))).otherwise(F.concat(F.lit("x-"), F.col("p_size")))
    rows = table(spark, sf_dir, "part").select("p_partkey", classify.label_order(label).alias("o"))
    return rows.select("p_partkey", F.row_number().over(Window.orderBy("o", "p_partkey")).alias("place"))


_LABELS = ["21(ea)(1)", "20(1)(a.1)", "R-1.2(b)", "7A(ii)(iv.3)", "12.3(AB)", "x y(a)", "5(a", "(a)", "4.2A(cd)(i)"]
_PATHS_OF = {
    "number": ["21/e/a/1", None, None, "7A/ii/iv.3", None, None, None, None, None], "decimal": ["21/e/a/1", "20/1/a.1", None, "7A/ii/iv.3", "12.3/AB", None, None, None, "4.2A/c/d/i"],
    "zone": ["21/ea/1", "20/1/a.1", "R-1.2/b", "7A/ii/iv.3", "12.3/AB", None, None, None, None], "section": ["21/ea/1", "20/1/a.1", None, None, "12.3/AB", None, None, None, None],
}


@register("SELECT p_partkey, " + ", ".join("[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + f"][p_partkey % 9 + 1] AS {name}_path" for name, values in _PATHS_OF.items()) + " FROM part")
def label_paths(spark, sf_dir):
    label = _pick(_LABELS, F.col("p_partkey") % 9)
    return table(spark, sf_dir, "part").select("p_partkey", *[F.array_join(classify.label_path(label, form), "/").alias(f"{form}_path") for form in _PATHS_OF])


_LINES = ["The following uses are permitted:", "(a) Single dwelling;", "(b) Public park.", "9.1 metres of yard", "continued text", "PART 2: OTHER", "(c) Shop", "(d) Repealed 2003"]


def _page_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % 11).alias("k"))
    return rows.select("user_id", "event_id", F.when(F.col("k") < 8, _pick(_LINES, F.least("k", F.lit(7)))).otherwise("(e) Club house").alias("line"))


_PAGE_LINES = f"""l AS (SELECT user_id, event_id, CASE WHEN event_id % 11 < 8 THEN {_sql_list(_LINES)}[event_id % 11 + 1] ELSE '(e) Club house' END AS line FROM events)"""


@register(f"""WITH {_PAGE_LINES}, s AS (SELECT *, last_value(CASE WHEN contains(line, 'following uses') THEN 1 WHEN line LIKE 'PART%' THEN 0 END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM l)
  SELECT event_id, line[2:2] AS label, CASE line[2:2] WHEN 'a' THEN 'residential_use' WHEN 'b' THEN 'recreation_use' WHEN 'e' THEN 'recreation_use' ELSE 'principal_use' END AS use_type,
  rtrim(line[5:], ';.') AS use_name, CASE line[2:2] WHEN 'd' THEN 'repealed' ELSE 'active' END AS status FROM s WHERE i = 1 AND line LIKE '(%'""")
def use_blocks(spark, sf_dir):
    found = references.use_block(_page_lines(spark, sf_dir), ["user_id"], ["event_id"], "line", "^PART ", r"^\(?([A-Za-z0-9.]+)\)?\s+(.*)$")
    return found.where("label NOT IN ('The', 'continued', 'PART')").select("event_id", "label", "use_type", "use_name", "status")


@register("""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 4 WHEN 1 THEN '.1' WHEN 3 THEN '.2' ELSE '(a)' END AS label,
    CASE WHEN l_linenumber % 4 = 1 AND l_partkey % 2 = 0 THEN 'The following uses are permitted' ELSE 'use ' || l_partkey || ';' END AS t,
    CASE l_orderkey % 3 WHEN 0 THEN 'PERMITTED USES AS OF RIGHT' WHEN 1 THEN 'PERMITTED USES WITH SITE PLAN APPROVAL' ELSE 'GENERAL' END AS title FROM lineitem),
  w AS (SELECT *, last_value(CASE WHEN label LIKE '.%' THEN label END IGNORE NULLS) OVER o AS dot, last_value(CASE WHEN label = '.1' THEN t END IGNORE NULLS) OVER o AS cond FROM p
    WINDOW o AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS UNBOUNDED PRECEDING))
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, CASE WHEN title LIKE '%SITE PLAN%' AND label <> '.2' THEN 'site_plan_approval_use' ELSE 'permitted_use' END AS use_type,
  CASE WHEN label = '(a)' THEN rtrim(t, ';') ELSE t END AS use_name, CASE WHEN label = '(a)' THEN cond ELSE title END AS conditions FROM w
  WHERE title LIKE 'PERMITTED%' AND ((label = '.1' AND t NOT LIKE 'The following%') OR (label = '.2' AND title LIKE '%AS OF RIGHT') OR (label = '(a)' AND dot = '.1'))""")
def listed_uses(spark, sf_dir):
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    label = F.when(n % 4 == 1, ".1").when(n % 4 == 3, ".2").otherwise("(a)")
    text = F.when((n % 4 == 1) & (F.col("l_partkey") % 2 == 0), "The following uses are permitted").otherwise(F.concat(F.lit("use "), F.col("l_partkey"), F.lit(";")))
    title = _pick(["PERMITTED USES AS OF RIGHT", "PERMITTED USES WITH SITE PLAN APPROVAL", "GENERAL"], k % 3)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", label.alias("label"), text.alias("text"), title.alias("title"))
    return references.listed_uses(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "title", "label", "text")


_CAPTIONS = ["Map 1: Generalized Future Land Use", "Schedule B Flood Plain limits", "Map 2A Principal Streets", "no caption Map 3", "Schedule C", "Map 9 Watersheds"]


@register(f"""WITH c AS (SELECT DISTINCT user_id, event_id % 50 AS page, {_sql_list(_CAPTIONS)}[event_id % 6 + 1] AS label FROM events WHERE event_id % 6 <> 3)
  SELECT user_id, page, label, CASE WHEN label LIKE 'Map %' THEN 'map' ELSE 'schedule' END AS reference_type, trim(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '-') AS feature_key,
  CASE WHEN label LIKE '%Future%' THEN 'future_land_use_area' WHEN label LIKE '%Flood%' THEN 'flood_plain_area' WHEN label LIKE '%Streets%' THEN 'transportation_corridor' WHEN label LIKE '%Watershed%' THEN 'watershed_area' ELSE 'policy_map_reference' END AS feature_class,
  CASE WHEN label = 'Schedule C' THEN 'spatial_features.attributes' ELSE 'spatial_features.geom' END AS target FROM c""")
def map_captions(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 50).alias("page"), _pick(_CAPTIONS, F.col("event_id") % 6).alias("line"))
    return references.map_references(rows, ["user_id"], "line", "page")


_CLAUSES = ["Uses permitted in the R-1 Zone and C 2", "subject to the regulations of the Port Zone", "the R1 zone is near", "uses permitted in the M1 Zone, subject to regulations of C-2", "none"]
_EDGES = [(0, "R-1", "inherits_uses"), (0, "C-2", "inherits_uses"), (1, "PZ", "inherits_regulations"), (3, "M-1", "inherits_uses"), (3, "M-1", "inherits_regulations"), (3, "C-2", "inherits_uses"), (3, "C-2", "inherits_regulations")]


@register("WITH e(k, zone_code, relationship_type) AS (VALUES " + ", ".join(f"({a}, '{b}', '{c}')" for a, b, c in _EDGES) + """) SELECT p_partkey, 'Z' || p_size AS zone, zone_code, relationship_type, 'include_target_values' AS join_behavior,
  relationship_type = 'inherits_regulations' OR k = 0 AS cross_reference FROM part JOIN e ON p_partkey % 5 = k""")
def zone_relations(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("Z"), F.col("p_size")).alias("zone"), _pick(_CLAUSES, F.col("p_partkey") % 5).alias("text"))
    return references.zone_relations(rows, [], "p_partkey", "text", "zone", ["R-1", "C-2", "M-1", "PZ"], {"port": "PZ"})


@register("""WITH u AS (SELECT l_orderkey AS doc, l_linenumber AS clause, l_partkey % 20 AS term FROM lineitem), r AS (SELECT DISTINCT doc, clause FROM u WHERE (doc + clause) % 4 = 0),
  t AS (SELECT doc, term, list_distinct(list(clause)) AS cs FROM u GROUP BY doc, term), gone AS (SELECT DISTINCT doc, term FROM u SEMI JOIN r USING (doc, clause))
  SELECT 'use' AS kind, doc, term, count(*) AS n FROM u ANTI JOIN r USING (doc, clause) GROUP BY doc, term UNION ALL SELECT 'term', doc, term, len(cs) FROM t ANTI JOIN gone USING (doc, term)""")
def zone_reference_model(spark, sf_dir):
    uses = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("clause"), (F.col("l_partkey") % 20).alias("term_id"))
    edges = uses.where("(doc + clause) % 4 = 0").select("doc", "clause")
    terms = uses.groupBy("doc", "term_id").agg(F.collect_set("clause").alias("clauses"))
    kept, rest = references.apply_zone_relations(uses, terms, edges, ["doc"], "clause")
    one = kept.groupBy("doc", "term_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit("use").alias("kind"), "doc", F.col("term_id").alias("term"), "n")
    return one.unionByName(rest.select(F.lit("term").alias("kind"), "doc", F.col("term_id").alias("term"), F.size("clauses").cast("long").alias("n")))


_MARKS = ["2.1 Permitted uses", "see 21(ea)(1) and 4(b)", "17 low", "3.4.5 Signs and maps (all)", "of 9 metres", "12 Parking, loading"]


@register(f"""WITH l AS (SELECT user_id, event_id, {_sql_list(_MARKS)}[event_id % 6 + 1] AS line, event_id % 6 AS k FROM events)
  SELECT event_id, last_value([ '2.1', NULL, NULL, '3.4.5', NULL, '12'][k + 1] IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS section, CASE k WHEN 1 THEN '21(ea)(1)' END AS clause,
  ['permitted uses', '', '', 'signs', '', 'parking'][k + 1] AS context FROM l""")
def section_marks(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", _pick(_MARKS, F.col("event_id") % 6).alias("line"))
    return references.section_marks(rows, ["user_id"], ["event_id"], "line").select("event_id", "section", "clause", "context")


_PHRASES = [("term", "dwelling_type", "dwelling"), ("use", "dwelling_type", "dwelling"), ("requirement_type", "yard", "yard"), ("relationship_type", "relationship_phrase", "permitted")]


@register(f"""WITH {_PAGE_LINES}, h AS (SELECT event_id, t, c, p FROM l, (VALUES {', '.join(str(x) for x in _PHRASES)}) v(t, c, p) WHERE contains(lower(line), p)), r AS (SELECT *, row_number() OVER (PARTITION BY t, c, p ORDER BY event_id) AS n FROM h)
  SELECT t AS "table", c AS category, p AS phrase, count(*) AS occurrences, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (n <= 5) AS examples FROM r GROUP BY ALL""")
def phrase_candidates(spark, sf_dir):
    hits = references.phrase_hits(_page_lines(spark, sf_dir), ["event_id"], "line", _PHRASES)
    return references.candidates(hits, ["event_id"]).withColumn("examples", F.array_join(F.transform("examples", lambda e: e["event_id"].cast("string")), ","))


@register("""WITH l AS (SELECT user_id, event_id, event_id % 7 AS k FROM events WHERE event_id % 7 <> 6), s AS (SELECT *, sum((k = 0)::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS entry FROM l)
  SELECT user_id, entry::BIGINT AS entry, max(CASE WHEN k = 0 THEN event_id::VARCHAR END) AS number, string_agg(CASE WHEN k = 0 THEN 'Amends map' ELSE 'line ' || k END, ' ' ORDER BY event_id) AS text, min(event_id) AS page_start, max(event_id) AS page_end
  FROM s WHERE entry > 0 GROUP BY user_id, entry""")
def amendment_rows(spark, sf_dir):
    k = F.col("event_id") % 7
    line = F.when(k == 0, F.concat_ws(" ", "event_id", F.lit("Amends map"))).when(k == 6, "Council").otherwise(F.concat(F.lit("line "), k))
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.lit(0).alias("at"), line.alias("line"))
    return references.amendment_rows(rows, ["user_id"], "event_id", ["at"], "line", r"^(\d+)\s+(.*)$", ("Council",))


_NOISE = ["", "CITY OF X", "12", "12 | Zone", "Draft in progress 3", "text | LOW ZONE", "12a text", "real text"]


@register(f"""SELECT p_partkey, {_sql_list(_NOISE)}[p_partkey % 8 + 1] AS line, p_partkey % 8 < 6 AS noise, p_size AS label_size, CASE p_partkey % 8 WHEN 2 THEN true WHEN 7 THEN false WHEN 6 THEN false ELSE false END AS is_label,
  p_partkey % 2 = 0 AS fragment FROM part""")
def line_checks(spark, sf_dir):
    line = _pick(_NOISE, F.col("p_partkey") % 8)
    label, rest = F.concat(F.col("p_size"), F.lit(".5")), F.when(F.col("p_partkey") % 2 == 0, "Metres wide").otherwise("Shops")
    return table(spark, sf_dir, "part").select(
        "p_partkey", line.alias("line"), classify.is_noise(line, F.lit("Low Zone"), ("CITY OF X",), ("Draft in progress",)).alias("noise"), F.col("p_size").alias("label_size"), classify.is_label(line).alias("is_label"),
        classify.is_measurement_fragment(label, rest).alias("fragment"),
    )


_CELLS = ["6 m (20 ft) 8 m", "two", "n/a", "prose only", "1,200 sq. ft", "10 percent", "three (3) bedrooms"]


def _cells(spark, sf_dir):
    column = F.when(F.col("p_size") % 3 == 0, "accessory_buildings_permitted").when(F.col("p_size") % 3 == 1, "interior").otherwise("zone")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("cell_id"), column.alias("column_id"), F.concat(F.lit("Interior "), F.col("p_brand")).alias("column_label"),
        F.when(F.col("p_size") % 2 == 0, "Minimum lot frontage").otherwise("Height").alias("requirement"), F.when(F.col("p_size") % 5 == 0, "corner lots").otherwise("").alias("condition"), _pick(_CELLS, F.col("p_partkey") % 7).alias("text"),
    )


def _clauses(spark, sf_dir):
    text = F.concat(F.lit("A fence of "), F.col("s_suppkey"), F.when(F.col("s_suppkey") % 2 == 0, " metres and a yard of 2 ha (5 acres)").otherwise(" seats"))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("clause_id"), F.lit("(a)").alias("label"), text.alias("text"))


_VALUES = """c AS (SELECT p_partkey AS ref, p_partkey % 7 AS k, p_size % 3 = 0 AS acc, p_size % 2 = 0 AS frontage FROM part WHERE p_size % 3 < 2),
  v(k, place, raw, value, unit, av, au) AS (VALUES (0, 1, '6 m (20 ft)', 6.0, 'm', 20.0, 'ft'), (0, 2, '8 m', 8.0, 'm', NULL, NULL), (4, 1, '1,200 sq. ft', 1200.0, 'sq_ft', NULL, NULL), (5, 1, '10 percent', 10.0, 'percent', NULL, NULL),
    (6, 1, '3 bedrooms', 3.0, 'bedroom', NULL, NULL), (1, 1, 'two', 2.0, 'building', NULL, NULL)),
  n AS (SELECT 'table_cell' AS kind, ref, place, raw, value, unit, av, au, CASE WHEN unit = 'm' THEN CASE WHEN frontage THEN 'length' ELSE 'height' END WHEN unit = 'sq_ft' THEN 'area' WHEN unit = 'percent' THEN 'percentage' ELSE 'count' END AS measure_type,
    CASE WHEN frontage THEN 'minimum' ELSE 'exact' END AS comparator FROM c JOIN v USING (k) WHERE k <> 1 OR acc UNION ALL
    SELECT 'clause', s_suppkey, u.place, CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey || ' seats' WHEN u.place = 1 THEN s_suppkey || ' metres' ELSE '2 ha (5 acres)' END, CASE WHEN u.place = 2 THEN 2 ELSE s_suppkey END,
    CASE WHEN s_suppkey % 2 = 1 THEN 'seat' WHEN u.place = 1 THEN 'm' ELSE 'ha' END, CASE WHEN u.place = 2 THEN 5.0 END, CASE WHEN u.place = 2 THEN 'acre' END,
    CASE WHEN s_suppkey % 2 = 1 THEN 'count' WHEN u.place = 1 THEN 'length' ELSE 'area' END, 'exact' FROM supplier JOIN (VALUES (1), (2)) u(place) ON s_suppkey % 2 = 0 OR u.place = 1)"""


@register(f"""WITH {_VALUES} SELECT kind, ref, place, raw, value::DOUBLE AS value, unit, av::DOUBLE AS alternative_value, au AS alternative_unit, measure_type, comparator FROM n""")
def numeric_values(spark, sf_dir):
    return references.numeric_values(_cells(spark, sf_dir), _clauses(spark, sf_dir)).drop("context")


@register(f"""WITH {_VALUES}, m AS (SELECT kind, ref, count(*) AS "values" FROM n GROUP BY ALL)
  SELECT kind, ref, "values", CASE WHEN kind = 'clause' AND ref % 2 = 1 THEN 'other' ELSE 'dimensional_standard' END AS requirement_type, CASE WHEN kind = 'clause' AND ref % 2 = 0 THEN 'a_fence_of_' || ref || '_metres_and_a_yard_of_2_ha_5_acres'
    WHEN kind = 'clause' THEN 'a_fence_of_' || ref || '_seats' WHEN p_size % 2 = 0 THEN 'lot_frontage' ELSE 'height' END AS category,
  CASE WHEN kind = 'table_cell' THEN 'interior_' || lower(replace(p_brand, '#', '_')) END AS lot_context, CASE WHEN p_size % 5 = 0 THEN 'corner lots' END AS condition
  FROM m LEFT JOIN part ON kind = 'table_cell' AND p_partkey = ref""")
def numeric_requirements(spark, sf_dir):
    cells, clauses = _cells(spark, sf_dir), _clauses(spark, sf_dir)
    found = references.requirements(references.numeric_values(cells, clauses), cells, clauses)
    return found.select("kind", "ref", "values", "requirement_type", "category", "lot_context", "condition")


@register("""SELECT p_partkey AS cell_id, ['two', 'prose only'][CASE p_partkey % 7 WHEN 1 THEN 1 ELSE 2 END] AS text FROM part WHERE p_size % 3 < 2 AND (p_partkey % 7 = 3 OR (p_partkey % 7 = 1 AND p_size % 3 = 1))""")
def unparsed_cells(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return references.unparsed_cells(references.numeric_values(cells, _clauses(spark, sf_dir)), cells)


@register("""WITH u AS (SELECT l_orderkey AS doc, l_linenumber AS clause, l_partkey AS place, CASE l_partkey % 4 WHEN 0 THEN 'Shop' WHEN 1 THEN 'Mixed use' WHEN 2 THEN 'Odd thing ' || l_partkey % 9 ELSE 'use' END AS raw FROM lineitem),
  n AS (SELECT *, trim(regexp_replace(lower(raw), '[^a-z0-9]+', '_', 'g'), '_') AS k FROM u WHERE raw <> 'use'), c(k, t, cat, s) AS (VALUES ('shop', 'use', 'retail', 'active'), ('mixed_use', 'term', 'mix', 'review'))
  SELECT doc, 'term-' || coalesce(t, 'unmatched') || '-' || k AS term_id, coalesce(cat, 'unknown') AS term_category, CASE WHEN t IS NULL OR s = 'review' THEN 'needs_review' ELSE 'high' END AS confidence,
  array_to_string(list_sort(list_distinct(list(clause))), ',') AS clauses, count(*) AS uses FROM n LEFT JOIN c USING (k) GROUP BY ALL""")
def terms_of_uses(spark, sf_dir):
    k = F.col("l_partkey") % 4
    raw = F.when(k == 0, "Shop").when(k == 1, "Mixed use").when(k == 2, F.concat(F.lit("Odd thing "), F.col("l_partkey") % 9)).otherwise("use")
    parts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("clause"), F.col("l_partkey").alias("place"), raw.alias("raw"))
    codes = spark.createDataFrame([("shop", "use", "retail", "active"), ("mixed_use", "term", "mix", "review")], "code string, code_table string, category string, status string")
    terms, uses = references.terms_and_uses(parts, codes, ["doc"], "clause", ("use",))
    counts = uses.groupBy("doc", "term_id").agg(F.count(F.lit(1)).alias("uses"))
    return terms.join(counts, ["doc", "term_id"]).select("doc", "term_id", "term_category", "confidence", F.array_join("clauses", ",").alias("clauses"), "uses")


@register("""WITH r AS (SELECT l_orderkey, l_linenumber AS pos, (l_partkey % 10)::VARCHAR AS old FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey)),
  c(old, new, i) AS (VALUES ('1', 'a', 0), ('1', 'b', 1), ('2', 'a', 0), ('4', '5', 0)), e AS (SELECT l_orderkey, pos, coalesce(i, 0) AS i, CASE WHEN r.old = '3' THEN NULL ELSE coalesce(new, r.old) END AS id FROM r LEFT JOIN c USING (old)),
  f AS (SELECT l_orderkey, id, min(pos * 10 + i) AS p FROM e WHERE id IS NOT NULL GROUP BY ALL) SELECT o.l_orderkey, coalesce(string_agg(id, ',' ORDER BY p), '') AS ids FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN f USING (l_orderkey) GROUP BY ALL""")
def rewritten_ids(spark, sf_dir):
    first = F.min(F.struct("l_partkey", "l_suppkey"))["l_partkey"]
    once = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg((first % 10).cast("string").alias("id"))
    rows = once.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "id"))), lambda s: s["id"]).alias("ids"))
    changes = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a"]), ("3", []), ("4", ["5"])], "old_id string, new_ids array<string>")
    return references.rewrite_ids(rows, "ids", changes, ["l_orderkey"]).select("l_orderkey", F.array_join("ids", ",").alias("ids"))


@register("""SELECT 'requirement-reference:' || trim(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '-') AS target_id, count(*) AS n, count(DISTINCT o_custkey % 50) AS paths, arg_min(t, (o_custkey % 50, o_orderkey, t)) AS source_text
  FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'Chapter ' || o_orderstatus ELSE o_orderpriority END AS t FROM orders) GROUP BY ALL""")
def reference_targets(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Chapter "), F.col("o_orderstatus"))).otherwise(" ").alias("chapter"), F.col("o_orderpriority").alias("title"), (F.col("o_custkey") % 50).alias("path"), F.col("o_orderkey").alias("page")
    )
    return references.reference_targets(rows, ["chapter", "title"], "path", "page").select("target_id", "n", F.size("paths").cast("long").alias("paths"), "source_text")


@register("""WITH s(k, subject, comparator, metric, unit, roads) AS (VALUES (0, 'frontage', 'minimum', 9.1, 'm', ''), (1, 'front-yard', 'unknown', 6.096, 'm', 'local'), (1, 'front-yard', 'unknown', 9.144, 'm', 'collector,arterial'),
    (2, 'lot-area', 'minimum', 371.612, 'm2', ''), (3, 'height', 'maximum', 9.75, 'm', ''), (4, 'lot-coverage', 'maximum', 35.0, 'percent', ''))
  SELECT p_partkey, subject, comparator, round(metric, 3)::DOUBLE AS metric, unit, roads FROM part JOIN s ON p_partkey % 5 = k""")
def road_standards(spark, sf_dir):
    said = ["minimum frontage 9.1m on a local street", "front yard Local Street 20 ft; front yard Collector or Arterial 30 ft", "Lot area at least 4,000 sq. ft", "height shall not exceed 9.75 metres (32 feet)", "maximum lot coverage 35%"]
    found = table(spark, sf_dir, "part").select("p_partkey", F.explode(measure.standards(_pick(said, F.col("p_partkey") % 5))).alias("s"))
    shape = measure.value(F.col("s.amount"), F.col("s.unit"), F.col("s.sample"))
    return found.select("p_partkey", "s.subject", shape["comparator"].alias("comparator"), F.round(shape["amount"], 3).alias("metric"), shape["unit"].alias("unit"), F.array_join(measure.road_classes(F.col("s.sample")), ",").alias("roads"))


@register("""SELECT l_orderkey, l_linenumber, l_partkey, CASE l_partkey % 3 WHEN 0 THEN 'bylaw page 3-' || (l_linenumber + 3) || '; PDF page 9' WHEN 1 THEN 'PDF page 9' ELSE 'bylaw page 3' END AS cited FROM lineitem""")
def citation_ranges(spark, sf_dir):
    k, none = F.col("l_partkey") % 3, F.lit(None).cast("int")
    start = F.when(k != 1, 3)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", classify.citation_range(start, F.when(k == 0, F.col("l_linenumber") + 3).when(k == 2, 3), F.when(k != 2, 9), none).alias("cited"))
