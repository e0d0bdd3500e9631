"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from parcelforge.llm.licences import PHRASES, TEMPLATES, template_regex

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP4 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_replace(text, '(\\\\*)(</?s>|\\[/?(?:INST|ANS|SYS|ROLE(?: [0-9a-f]*)?)\\])', '\\\\\\1\\2', 'g') AS escaped,
    regexp_matches(text, '</?s>|\\[/?(?:INST|ANS|SYS|ROLE(?: [0-9a-f]*)?)\\]') AS hostile
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE role WHEN 'user' THEN 23 WHEN 'assistant' THEN 21 WHEN 'system' THEN 21
      ELSE 24 + 2 * octet_length(encode(role)) END + length(CASE WHEN hostile THEN escaped ELSE text END))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

#: Exact similarities of all pairs of documents; equal sets are compared once, by the smallest id of each.
_OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(CASE WHEN len(w) < 2 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END) AS g FROM d),
c AS (SELECT g, min(doc_id) AS rep, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
t AS MATERIALIZED (SELECT rep, n, unnest(g) AS token FROM c),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS common, any_value(a.n) + any_value(b.n) AS total FROM t a JOIN t b ON a.token = b.token AND a.rep < b.rep
  AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.rep, b.rep),
l AS MATERIALIZED (SELECT a, b FROM p WHERE 100 * common >= 80 * (total - common)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, label) AS (SELECT rep, rep FROM c UNION SELECT e.b, r.label FROM r JOIN e ON r.node = e.a),
m AS (SELECT node, min(label) AS component FROM r GROUP BY node)
SELECT doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id, doc_id = coalesce(component, doc_id) AS kept
FROM s LEFT JOIN c ON s.g = c.g LEFT JOIN m ON m.node = c.rep
"""

_OP6 = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

_OP8 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
dup AS (SELECT doc_id, s FROM win JOIN firsts USING (h) WHERE doc_id > low),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM dup),
lists AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d JOIN lists USING (doc_id)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS k FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN g IS NULL THEN array_to_string(w, ' ') ELSE coalesce(t, '') END) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _op9() -> str:
    places = " + ".join(
        f"len([i FOR i IN range(1, len(w) - {len(p.split()) - 2}) IF "
        + " AND ".join(f"w[i + {k}] = '{x}'" if k else f"w[i] = '{x}'" for k, x in enumerate(p.split()))
        + "])"
        for p in PHRASES
    )
    starts = "list_concat(" + ", ".join(
        f"[i - 1 FOR i IN range(1, len(w) - {len(p.split()) - 2}) IF "
        + " AND ".join(f"w[i + {k}] = '{x}'" if k else f"w[i] = '{x}'" for k, x in enumerate(p.split()))
        + "]"
        for p in PHRASES
    ) + ")"
    def pick(conditions: list[tuple[str, str]]) -> str:
        cases = ", ".join(f"CASE WHEN {c} THEN '{label}' END" for label, c in conditions)
        return f"array_to_string(list_sort(list_distinct([x FOR x IN [{cases}] IF x IS NOT NULL])), ',')"

    base = [(label, f"contains(t, ' {p} ')") for p, label in PHRASES.items()]
    forms = [(label, f"regexp_matches(t, ' {template_regex(t)} ')") for label, t in TEMPLATES]
    any_form = " OR ".join(c for _, c in forms)
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
e AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS t, {starts} AS st, {places} AS nb FROM d)
SELECT doc_id, len(w)::BIGINT AS n_words, nb::BIGINT AS n_base, list_min(st)::BIGINT AS first_word, list_max(st)::BIGINT AS last_word,
  {pick(base)} AS base_labels, {pick(base + forms)} AS labels,
  CASE WHEN {any_form} THEN 1.0 WHEN nb > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM e
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash": _OP2, "op4_chat": _OP4, "op6_exact_dedup": _OP6, "op8_substring_dedup": _OP8, "op9_licences": _op9()}
