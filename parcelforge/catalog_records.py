"""Registered queries of the document families, rebuilt tables, drawings and sample grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelforge.operators import documents, drawing, extraction, raster, shapes, tables
from parcelforge.registry import register, table


def _sorted(condition: Column, order: list[str], **fields: Column) -> Column:
    """Aggregate: structs of the fields of the rows that fulfil the condition, in order."""
    rows = F.array_sort(F.collect_list(F.when(condition, F.struct(*order, F.struct(*[c.alias(n) for n, c in fields.items()]).alias("_v")))))
    return F.transform(rows, lambda r: r["_v"])


_ORDER = ["l_linenumber", "l_partkey", "l_quantity", "l_linestatus"]


def _zone_documents(spark, sf_dir) -> DataFrame:
    """A zone document per order: its lines are uses, prohibitions and dimensional controls."""
    flag, part = F.col("l_returnflag"), F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    doc = F.struct(
        F.struct(F.concat(F.lit("Z"), F.col("l_orderkey").cast("string")).alias("zone_code")).alias("document_metadata"), "permitted_uses", "prohibitions",
        F.struct("base_dimensional_controls").alias("requirements"),
    )
    docs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        _sorted(flag == "A", _ORDER, use_name=part, conditions=F.when(F.col("l_linestatus") == "F", F.array("l_linestatus", F.lit("fenced")))).alias("permitted_uses"),
        _sorted(flag == "R", _ORDER, summary=F.concat(F.lit("no "), part)).alias("prohibitions"),
        _sorted(flag == "N", _ORDER, controls=F.array(F.struct(F.lit("depth").alias("metric"), F.col("l_quantity").alias("value"), F.lit("m").alias("unit")))).alias("base_dimensional_controls"),
    )
    return documents.parse(docs.select(F.col("l_orderkey").cast("string").alias("path"), F.to_json(doc).alias("body")), "body", documents.ZONE_DOCUMENT)


@register("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_quantity, l_linestatus) AS place FROM lineitem)
  SELECT 'Z' || l_orderkey AS zone_code, CASE l_returnflag WHEN 'A' THEN 'permitted_use' WHEN 'R' THEN 'prohibition' ELSE 'base_dimensional_controls' END AS rule_type,
    l_orderkey || '::' || CASE l_returnflag WHEN 'A' THEN 'permitted_use' WHEN 'R' THEN 'prohibition' ELSE 'base_dimensional_controls' END || '::' || place AS provision_key,
    CASE WHEN l_returnflag = 'N' THEN 'depth' END AS metric, CASE WHEN l_returnflag = 'A' THEN 'part ' || l_partkey END AS use_name,
    CASE WHEN l_returnflag = 'N' THEN l_quantity END AS numeric_value, CASE WHEN l_returnflag = 'R' THEN 'no part ' || l_partkey END AS value_text,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'F | fenced' END AS condition_text FROM n""")
def zone_rules(spark, sf_dir):
    rules = documents.zone_rules(documents.zone_provisions(_zone_documents(spark, sf_dir)))
    return rules.select("zone_code", "rule_type", "provision_key", "metric", "use_name", "numeric_value", "value_text", "condition_text")


@register("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_linestatus) AS place FROM lineitem WHERE l_returnflag = 'A')
  SELECT 'regulation:Z' || l_orderkey || ':' || place AS regulation_id, 'part-' || l_partkey AS subject,
    CASE WHEN l_linestatus = 'F' THEN 'permitted_with_conditions' ELSE 'permitted' END AS permission_status FROM n""")
def use_permissions(spark, sf_dir):
    found = documents.use_permissions(documents.zone_provisions(_zone_documents(spark, sf_dir)))
    return found.select("regulation_id", "subject", "permission_status")


@register("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role = 'user' ORDER BY turn, role, text) AS place FROM conversations)
  SELECT conv_id::VARCHAR AS section_label, CASE WHEN role = 'user' THEN 'mps_objective' ELSE 'mps_policy' END AS kind, place::INT AS place, nullif(role, '') AS label,
    text AS text_value, CASE WHEN role <> 'user' THEN 'mps_policy' END AS rule_type FROM n""")
def strategy_provisions(spark, sf_dir):
    own = dict(label_raw=F.col("role"), text=F.col("text"))
    order = ["turn", "role", "text"]
    docs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        _sorted(F.col("role") == "user", order, **own).alias("objectives"), _sorted(F.col("role") != "user", order, **own).alias("policies")
    )
    meta = F.struct(F.col("conv_id").cast("string").alias("section_label_raw"))
    docs = docs.select(F.col("conv_id").cast("string").alias("path"), F.to_json(F.struct(meta.alias("section_metadata"), "objectives", "policies")).alias("body"))
    found = documents.strategy_provisions(documents.parse(docs, "body", documents.STRATEGY_DOCUMENT))
    return found.select("section_label", "kind", "place", "label", "text_value", "rule_type")


@register("""WITH s AS (SELECT conv_id::VARCHAR AS f, conv_id || '|section|' || turn || '|' || role AS sk, left(sha256(coalesce(text, '')), 16) AS h, turn FROM conversations)
  SELECT DISTINCT f AS natural_key, 'source_file' AS family, NULL AS parent_key FROM s UNION ALL SELECT DISTINCT f || '|part||', 'bylaw_part', f FROM s
  UNION ALL SELECT sk, 'section', f FROM s UNION ALL SELECT sk || '|clause|' || turn || '|' || h, 'clause', sk FROM s
  UNION ALL SELECT sk || '|table|t' , 'raw_table', sk FROM s UNION ALL SELECT sk || '|table|t|row|1|col|c|pos|1|' || h, 'raw_table_cell', sk || '|table|t' FROM s""")
def document_records(spark, sf_dir):
    turn = F.col("turn").cast("int")
    clause = F.array(F.struct(F.col("text").alias("clause_text_raw"), turn.alias("source_order")))
    cells = F.array(F.struct(F.array(F.struct(F.lit("c").alias("column_id"), F.col("text").alias("cell_text_raw"))).alias("cells_raw")))
    held = F.array(F.struct(F.lit("t").alias("table_id"), cells.alias("rows_raw")))
    section = dict(section_id=F.col("turn").cast("string"), section_label_raw=F.col("role"), clauses_raw=clause, tables_raw=held)
    docs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(_sorted(F.lit(True), ["turn", "role", "text"], **section).alias("sections_raw"))
    body = F.to_json(F.struct(F.struct("sections_raw").alias("raw_data")))
    rows = documents.parse(docs.select(F.col("conv_id").cast("string").alias("path"), body.alias("body")), "body", documents.NORMALISED_DOCUMENT)
    return documents.document_records(rows).select("natural_key", "family", "parent_key")


@register("""WITH i AS (SELECT *, ['terms', 'uses', 'numeric_values', 'requirements', 'regulation_groups', 'conditional_rule_groups', 'zone_relationships', 'map_layer_references', 'definitions',
    'cross_references', 'site_specific_rules', 'spatial_references', 'other_requirements'][p_partkey % 13 + 1] AS f,
    '{"citations":{"page":' || p_partkey || '},"numeric_value":{"unit":"m","value":' || p_size || '},"term_raw":"' || p_name || '","type":"lot"}' AS v FROM part),
  p AS (SELECT *, '{"citations":{"page":' || p_partkey || '},"fact_family":"' || f || '","fact_type":"lot","normalized_key":"' || trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_')
    || '","raw_label":"' || p_name || '","raw_text":null,"source_record_key":null,"source_record_table":null,"value_payload":' || v || '}' AS payload FROM i)
  SELECT p_partkey || '|structured|' || f || '||1|' || left(sha256(v), 16) AS natural_key, payload, sha256('{"payload":' || payload || ',"table":"structured_fact"}') AS content_hash FROM p""")
def document_facts(spark, sf_dir):
    families = ["terms", "uses", "numeric_values", "requirements", "regulation_groups", "conditional_rule_groups", "zone_relationships", "map_layer_references", "definitions"]
    families += ["cross_references", "site_specific_rules", "spatial_references", "other_requirements"]
    family = F.get(F.array(*[F.lit(f) for f in families]), (F.col("p_partkey") % 13).cast("int"))
    amount = F.struct(F.col("p_size").alias("value"), F.lit("m").alias("unit"))
    entry = F.struct(
        F.concat(F.lit("f"), "p_partkey").alias("fact_id"), F.lit("lot").alias("type"), F.col("p_name").alias("term_raw"), amount.alias("numeric_value"),
        F.lit("high").alias("confidence"), F.struct(F.col("p_partkey").alias("page")).alias("citations"),
    )
    body = F.concat(F.lit('{"structured_data":{"'), family, F.lit('":['), F.to_json(entry), F.lit("]}}"))
    docs = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), body.alias("body"))
    rows = documents.document_records(documents.parse(docs, "body", documents.NORMALISED_DOCUMENT))
    return rows.where("family = 'structured_fact'").select("natural_key", "payload", "content_hash")


@register("""WITH u AS (SELECT s_nationkey AS zone, 'use ' || s_suppkey % 7 AS use_name FROM supplier),
  p AS (SELECT n_nationkey AS zone, (n_nationkey + 1) % 25 AS source_zone, n_name FROM nation)
  SELECT zone, use_name, NULL AS source_zone, '' AS conditions FROM u
  UNION ALL SELECT p.zone, u.use_name, p.source_zone, n_name FROM p JOIN u ON u.zone = p.source_zone
  WHERE NOT EXISTS (SELECT 1 FROM u o WHERE o.zone = p.zone AND o.use_name = u.use_name)""")
def inherited_uses(spark, sf_dir):
    uses = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("zone"), F.concat(F.lit("use "), (F.col("s_suppkey") % 7).cast("string")).alias("use_name"), F.array().cast("array<string>").alias("conditions")
    )
    permits = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("zone"), ((F.col("n_nationkey") + 1) % 25).cast("string").alias("source_zone"), F.array("n_name").alias("conditions")
    )
    found = documents.inherited_uses(uses, permits)
    return found.select(F.col("zone").cast("int").alias("zone"), "use_name", F.col("source_zone").cast("int").alias("source_zone"), F.array_join("conditions", "|").alias("conditions"))


@register("""SELECT p_partkey, unnest(['Yard', 'Yard']) AS requirement, unnest(['Front access', 'Rear lane access']) AS condition, unnest([1, 2]) AS part,
    unnest([p_size || ' m (' || p_size * 3 || ' ft)', p_size + 1 || ' m']) AS value FROM part WHERE p_size % 2 = 0
  UNION ALL SELECT p_partkey, 'Yard Front access Rear lane access', '', 1, p_size || ' m (' || p_size * 3 || ' ft)' FROM part WHERE p_size % 2 = 1""")
def condition_rows(spark, sf_dir):
    size = F.col("p_size")
    first = F.concat(size.cast("string"), F.lit(" m ("), (size * 3).cast("string"), F.lit(" ft)"))
    value = F.when(size % 2 == 0, F.concat(first, F.lit(" "), (size + 1).cast("string"), F.lit(" m"))).otherwise(first)
    rows = table(spark, sf_dir, "part").select("p_partkey", F.lit("Yard Front access Rear lane access").alias("requirement"), value.alias("value"))
    return tables.condition_rows(rows, "requirement", ["value"], [["Front access", "Rear lane access"]])


@register("""SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS "row", unnest([0, 1]) AS "column", unnest(['Use', 'Lot']) AS label,
    unnest([p_partkey::VARCHAR, p_size || ' m']) AS text FROM part""")
def rebuilt_tables(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    y = (F.col("p_partkey") % 40 + 1) * 10.0
    word = lambda x, up, t: F.struct(F.lit(x).alias("x"), (y + up).alias("y"), t.alias("text"))
    line = F.array(word(10.0, 0.0, F.col("p_partkey").cast("string")), word(50.0, 1.0, F.col("p_size").cast("string")), word(54.0, 0.5, F.lit("m")))
    words = part.select("p_brand", F.floor(F.col("p_partkey") / 40).alias("page"), F.inline(line))
    head = F.array(F.struct(F.lit(10.0).alias("x"), F.lit(1.0).alias("y"), F.lit("Use").alias("text")), F.struct(F.lit(50.0).alias("x"), F.lit(1.0).alias("y"), F.lit("Lot").alias("text")))
    heads = part.select("p_brand").distinct().select("p_brand", F.lit(-1).cast("long").alias("page"), F.inline(head))
    return tables.rebuild(words.unionByName(heads), "p_brand", "page", "^Use Lot$").drop("table")


@register("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'checked' ELSE p_name END AS p_name, CASE WHEN p_size % 3 < 2 THEN p_size % 3 = 0 END AS patched FROM part""")
def apply_patches(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_size").cast("string").alias("content_hash"))
    size = F.col("content_hash").cast("int")
    made_for = F.when(size % 3 == 0, F.col("content_hash")).otherwise("old")
    patches = rows.where(size % 3 < 2).select("p_partkey", made_for.alias("content_hash"), F.create_map(F.lit("p_name"), F.lit("checked")).alias("patch"))
    return tables.apply_patches(rows, patches, "p_partkey", ["p_name"]).drop("content_hash")


@register("""SELECT p_partkey, path, n, round(x, 6) AS x FROM part, LATERAL (VALUES (1, 3, p_size * 1.0), (2, 5, 0.0), (3, 9, p_size * 0.5)) v(path, n, x)""")
def drawing_paths(spark, sf_dir):
    size = F.col("p_size").cast("double")
    z, u = F.lit(0.0), F.lit(1.0)
    items = [("l", [z, z, size, z]), ("l", [size, z, size, u]), ("re", [z, z, size, u]), ("c", [z, z, z, u, size, u, size, z])]
    drawn = F.array(*[F.struct(F.lit(i).alias("at"), F.lit(k).alias("kind"), F.array(*c).alias("coords")) for i, (k, c) in enumerate(items)])
    found = drawing.paths(table(spark, sf_dir, "part").select("p_partkey", F.inline(drawn)), ["p_partkey"], "at")
    # of each path the abscissa of its middle point, of the closed rectangle of its last
    at = F.when(F.col("path") == 2, 4).otherwise(F.floor(F.size("points") / 2)).cast("int")
    at = F.when(F.col("path") == 1, 1).otherwise(at)
    return found.select("p_partkey", F.col("path").cast("int").alias("path"), F.size("points").alias("n"), F.round(F.get("points", at)[0], 6).alias("x"))


@register(r"""WITH t AS (SELECT conv_id, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM conversations),
  f AS (SELECT *, CASE WHEN role = 'user' THEN 'Objective: ' || x WHEN role = 'assistant' THEN 'Policy ' || turn || ' ' || x ELSE x END AS y FROM t WHERE x IS NOT NULL AND (x <> '' OR role IN ('user', 'assistant'))),
  g AS (SELECT *, sum((role IN ('user', 'assistant'))::INT) OVER (PARTITION BY conv_id ORDER BY turn, role) AS b FROM f)
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY b)::INT AS place,
    CASE WHEN bool_or(role = 'user') THEN 'objective' WHEN bool_or(role = 'assistant') THEN 'policy' ELSE 'context' END AS kind,
    max(CASE WHEN role = 'assistant' THEN turn::VARCHAR END) AS label, coalesce(string_agg(nullif(x, ''), ' ' ORDER BY turn, role), '') AS text
  FROM g GROUP BY conv_id, b""")
def strategy_content(spark, sf_dir):
    said = extraction.squeeze(F.col("text"))
    turn = F.col("turn").cast("string")
    line = F.when(F.col("role") == "user", F.concat(F.lit("Objective: "), said)).when(F.col("role") == "assistant", F.concat(F.lit("Policy "), turn, F.lit(" "), said)).otherwise(said)
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", line.alias("line"))
    found = extraction.strategy_content(lines, ["conv_id"], ["turn", "role"], "line", "^SECTION$", "^Objective()(?=:):", r"^Policy (\d+)(?![\d.])")
    return found.drop("topic")


@register("""SELECT l_partkey // 256 AS tile_row, l_suppkey // 256 AS tile_col, count(*) AS n, sum(l_linenumber)::BIGINT AS total FROM lineitem GROUP BY ALL""")
def raster_tiles(spark, sf_dir):
    pixels = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("row"), F.col("l_suppkey").alias("col"), F.col("l_linenumber").alias("v"))
    tiled = raster.tiles(pixels, ["v"])
    total = F.aggregate("pixels", F.lit(0).cast("long"), lambda s, p: s + p["v"])
    return tiled.select("tile_row", "tile_col", F.size("pixels").alias("n"), total.alias("total"))


@register("""WITH r AS (SELECT p_partkey, p_size * 1.0 AS w, p_size % 9 * 30.0 + 10 AS h FROM part),
  i AS (SELECT *, 0.12 * least(w, h) AS d, CASE WHEN w * h > 8000 THEN 7 WHEN w * h > 1000 THEN 5 ELSE 3 END AS n FROM r)
  SELECT p_partkey, least(n * n + 1, 49) AS places, round(w / 2, 4) AS middle_x, round(h / 2, 4) AS middle_y,
    round(d + 0.5 * (w - 2 * d) / n, 4) AS first_x, round(d + 0.5 * (h - 2 * d) / n, 4) AS first_y FROM i""")
def sample_grid(spark, sf_dir):
    w, h, z = F.col("p_size") * 1.0, F.col("p_size") % 9 * 30.0 + 10, F.lit(0.0)
    corner = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    shape = F.array(F.array(corner(z, z), corner(w, z), corner(w, h), corner(z, h)))
    rows = table(spark, sf_dir, "part").select("p_partkey", shapes.sample_grid(shape).alias("g"))
    place = lambda i, axis: F.round(F.get("g", F.lit(i))[axis], 4)
    return rows.select(
        "p_partkey", F.size("g").alias("places"), place(0, 0).alias("middle_x"), place(0, 1).alias("middle_y"), place(1, 0).alias("first_x"), place(1, 1).alias("first_y")
    )
