"""Records of imported documents: cells, references, lookups, parents, candidates, inclusion."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def table_cells(tables: DataFrame, key: str, columns: str, rows: str) -> DataFrame:
    """One row per cell with its column's label.

    ``rows`` holds structs (source_order, cells); a cell is a struct (column_id, cell_text_raw, source_order); missing orders are the places from 1.
    """
    at_row = tables.select(key, columns, F.posexplode(rows).alias("_r", "_row"))
    at_row = at_row.select(key, columns, F.coalesce("_row.source_order", F.col("_r") + 1).alias("row_order"), F.col("_row.cells").alias("_cells"))
    at = at_row.select(key, columns, "row_order", F.posexplode("_cells").alias("_c", "_cell"))
    label = F.get(F.filter(F.col(columns), lambda c: c["column_id"] == F.col("_cell.column_id")), F.lit(0))["column_label_raw"]
    cells = at.select(
        key, "row_order", F.coalesce("_cell.source_order", F.col("_c") + 1).alias("column_order"), F.col("_cell.column_id").alias("column_id"),
        label.alias("column_label_raw"), F.col("_cell.cell_text_raw").alias("cell_text_raw"),
    )
    digest = F.left(F.sha2(F.coalesce("cell_text_raw", F.lit("")), 256), F.lit(16))
    parts = [F.col(key), F.lit("row"), "row_order", F.lit("col"), F.coalesce("column_id", F.lit("")), F.lit("pos"), "column_order", digest]
    return cells.withColumn("cell_key", F.concat_ws("|", *parts))


def flatten_branches(docs: DataFrame, keys: list[str], branches: dict[str, str], value: str = "value") -> DataFrame:
    """(keys, kind, place, value): the arrays of several columns as one table; ``branches`` maps kind to column. One scan, no union."""

    def branch(kind: str, column: str) -> Column:
        return F.transform(F.coalesce(F.col(column), F.array()), lambda v, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), v.alias(value)))

    return docs.select(*keys, F.inline(F.concat(*[branch(k, c) for k, c in branches.items()])))


def parents(clauses: DataFrame, scope: list[str], path: str, key: str) -> DataFrame:
    """Adds ``parent`` = key of the clause one level up in the same scope, null at the top; of equal paths the last key counts."""
    above = clauses.groupBy(*scope, F.col(path).alias("_up")).agg(F.max(key).alias("parent"))
    return clauses.withColumn("_up", F.when(F.size(path) > 1, F.slice(path, F.lit(1), F.size(path) - 1))).join(above, [*scope, "_up"], "left").drop("_up")


def match_in_turn(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Left rows with the right row of equal keys and equal turn: the n-th takes the n-th, and none is taken twice."""
    numbered = [d.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*o))) for d, o in ((left, left_order), (right, right_order))]
    return numbered[0].join(numbered[1], [*keys, "_n"], "left").drop("_n")


def resolve_refs(rows: DataFrame, key: str, refs: str, targets: list[tuple[DataFrame, str]]) -> DataFrame:
    """(key, target, kind) of the first reference found in any target table (id, target); an id in several counts for the first table."""
    at = rows.select(key, F.posexplode_outer(refs).alias("_at", "id"))
    known = None
    for rank, (table, kind) in enumerate(targets):
        one = table.select("id", F.struct(F.lit(rank).alias("rank"), F.col("target"), F.lit(kind).alias("kind")).alias("_t"))
        known = one if known is None else known.unionByName(one)
    met = at.join(known.groupBy("id").agg(F.min("_t").alias("_t")), "id", "left")
    best = met.groupBy(key).agg(F.min(F.when(F.col("_t").isNotNull(), F.struct("_at", "_t"))).alias("_b"))
    return best.select(key, F.col("_b._t.target").alias("target"), F.col("_b._t.kind").alias("kind"))


def relink(rows: DataFrame, keys: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Foreign keys looked up by natural key: ``{column: (table, natural key, id)}`` replaces each natural key by the id, null if unknown."""
    for column, (table, natural, ident) in keys.items():
        rows = rows.join(table.select(F.col(natural).alias(column), F.col(ident).alias("_id")), column, "left").withColumn(column, F.col("_id")).drop("_id")
    return rows


def code_match(rows: DataFrame, key: str, entries: DataFrame, name: str = "match") -> DataFrame:
    """Rows with the code of the first entry (code, label, symbol, place) that equals the key by code, label or symbol, in that order.

    The entries are a reviewed code table; each spelling is reduced to one code before the join, which is a plain equi-join.
    """
    spelled = entries.select("code", "place", F.posexplode(F.array("code", "label", "symbol")).alias("by", "_k")).where("_k IS NOT NULL")
    best = spelled.groupBy(F.lower(F.trim("_k")).alias("_k")).agg(F.min(F.struct("by", "place", "code"))["code"].alias(name))
    return rows.withColumn("_k", F.lower(F.trim(F.col(key)))).join(best, "_k", "left").drop("_k")


def split_terms(rows: DataFrame, term: str, aliases: DataFrame, splits: DataFrame) -> DataFrame:
    """Terms by an alias table (alias, term), then 1 to n by a split table (term, parts)."""
    named = rows.join(aliases.select(F.col("alias").alias(term), F.col("term").alias("_term")), term, "left").withColumn(term, F.coalesce("_term", term)).drop("_term")
    return named.join(splits.select(F.col("term").alias(term), "parts"), term, "left").withColumn(term, F.explode(F.coalesce("parts", F.array(term)))).drop("parts")


def occurrences(rows: DataFrame, keys: list[str], confidence: str, order: list[str], lists: dict[str, int]) -> DataFrame:
    """Candidates per key: how often met, the highest confidence up to 1, and of each listed column its first n distinct values in order."""
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"), F.least(F.lit(1.0), F.max(confidence)).alias("confidence"))
    for c, n in lists.items():
        # a value's first place decides: reduced to one row per value first, so no group is gathered whole
        first = rows.where(F.col(c).isNotNull()).groupBy(*keys, F.col(c).alias("_v")).agg(F.min(F.struct(*order)).alias("_o"))
        first = first.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_o", "_v"))).where(F.col("_n") <= n)
        named = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_v"))), lambda s: s["_v"]).alias(c))
        out = out.join(named, keys, "left").withColumn(c, F.coalesce(c, F.array()))
    return out


def match_report(names: DataFrame, name: str, codes: DataFrame, semantic: DataFrame) -> DataFrame:
    """Each distinct name as exact (in codes.name), semantic (in semantic.name) or new."""
    rows = names.select(F.col(name).alias("name")).distinct()
    rows = rows.join(codes.select("name", F.lit(1).alias("_e")).distinct(), "name", "left").join(semantic.select("name", F.lit(1).alias("_s")).distinct(), "name", "left")
    return rows.select("name", F.when(F.col("_e") == 1, "exact").when(F.col("_s") == 1, "semantic").otherwise("new").alias("bucket"))


def with_live_refs(rows: DataFrame, key: str, refs: str, live: DataFrame, ident: str) -> DataFrame:
    """Rows without references and rows of which at least one reference is live."""
    held = rows.select(key, F.explode(refs).alias(ident)).join(live.select(ident), ident, "left_semi").select(key).distinct().withColumn("_live", F.lit(True))
    return rows.join(held, key, "left").where(F.col("_live") | (F.size(F.coalesce(F.col(refs), F.array())) == 0)).drop("_live")


def enrich(rows: DataFrame, key: str, gone: DataFrame, conditions: DataFrame) -> DataFrame:
    """Rows that nothing supersedes, with the sorted conditions of their key (key, condition); none: an empty array."""
    per = conditions.groupBy(key).agg(F.sort_array(F.collect_set("condition")).alias("conditions"))
    kept = rows.join(gone.select(key).distinct(), key, "left_anti").join(per, key, "left")
    return kept.withColumn("conditions", F.coalesce("conditions", F.array()))


def content_order(parts: list[tuple[DataFrame, str]], scope: str, order: list[str]) -> DataFrame:
    """Clauses and tables of a section as one numbered sequence; ``parts`` gives (rows, kind), earlier kinds first at equal places."""
    rows = None
    for rank, (table, kind) in enumerate(parts):
        one = table.select(scope, *order, "id", F.lit(kind).alias("kind"), F.lit(rank).alias("_k"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(scope).orderBy(*order, "_k", "id"))).select(scope, "place", "kind", "id")


def inclusion(edges: DataFrame) -> DataFrame:
    """(root, member, depth, cyclic) along edges (a includes b); a member that already stands on the path closes a cycle and ends it.

    One row per shortest way.  Rounds go on until one finds nothing new, as deep as the longest shortest way; each finds new pairs or ends, so they end also on cycles.
    """
    step = edges.select(F.col("a").alias("_a"), F.col("b").alias("_b")).distinct()
    front = step.select(F.col("_a").alias("root"), F.col("_b").alias("member"), F.lit(1).alias("depth"), (F.col("_a") == F.col("_b")).alias("cyclic"))
    seen = front
    for depth in count(2):
        # a set of pairs per round rather than paths: linear in reachable pairs, also where ways multiply
        grown = front.where("NOT cyclic").join(step, F.col("member") == F.col("_a")).select("root", F.col("_b").alias("member")).distinct()
        fresh = grown.join(seen.select("root", "member"), ["root", "member"], "left_anti")
        front = fresh.select("root", "member", F.lit(depth).alias("depth"), (F.col("root") == F.col("member")).alias("cyclic"))
        front = front.checkpoint() if edges.sparkSession.sparkContext.getCheckpointDir() else front.persist()
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)


def update_by_key(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of ``changes`` that are not null replace those of the row with their key; keys unknown to ``rows`` are passed over."""
    names = [c for c in changes.columns if c not in keys]
    joined = rows.join(changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in names]), keys, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in names else F.col(c) for c in rows.columns])


def merge_rows(rows: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: incoming rows replace those of equal key, others are kept or added."""
    return rows.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming.select(*rows.columns))


def delete_where(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false or null, as a DELETE leaves them."""
    return rows.where(~F.coalesce(condition, F.lit(False)))


def code_entries(documents: DataFrame, payload: str) -> DataFrame:
    """(code_table, place, code, label, symbol, status) of reviewed code tables, one JSON document each: ``{"code_table": ..., "entries": [{"code": ...}, ...]}``."""
    entry = "struct<code:string,label:string,symbol:string,status:string>"
    rows = documents.select(F.from_json(payload, f"struct<code_table:string,entries:array<{entry}>>").alias("_d"))
    return rows.select("_d.code_table", F.posexplode("_d.entries").alias("place", "_e")).select("code_table", "place", "_e.code", "_e.label", "_e.symbol", "_e.status").where("code is not null")


def lookup(entries: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Entries by a key in lower case without blanks around; of entries that spell one key the last by ``order`` counts."""
    named = entries.withColumn("key", F.lower(F.trim(key))).where("key <> ''")
    last = Window.partitionBy("key").orderBy(*[F.desc(c) for c in order])
    return named.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def conservation(source: DataFrame, target: DataFrame, scope: str, name: str) -> DataFrame:
    """(scope, source_n, target_n, missing, extra, kept): rows of both sides by scope and the names that only one has, sorted; ``kept`` where nothing is lost or new."""
    side = lambda d, n: d.groupBy(scope).agg(F.count(F.lit(1)).alias(f"{n}_n"), F.array_sort(F.collect_set(name)).alias(f"_{n}"))
    both = side(source, "source").join(side(target, "target"), scope, "full_outer")
    none = F.array().cast(both.schema["_source"].dataType)
    a, b = F.coalesce("_source", none), F.coalesce("_target", none)
    count = lambda n: F.coalesce(f"{n}_n", F.lit(0).cast("long"))
    rows = both.select(scope, count("source").alias("source_n"), count("target").alias("target_n"), F.array_except(a, b).alias("missing"), F.array_except(b, a).alias("extra"))
    return rows.withColumn("kept", (F.col("source_n") == F.col("target_n")) & (F.size("missing") == 0) & (F.size("extra") == 0))


def cascade(sections: DataFrame, parts: dict[str, DataFrame], facts: dict[str, DataFrame], section: str = "section_id") -> dict[str, DataFrame]:
    """Parts of the sections that are left, then facts of which a part or section is left; facts without references stay.

    ``parts`` (section_id, id) by kind, ``facts`` (id, refs: array of struct(kind, id)) by family.  A fact that refers to another family's facts is
    judged after that family, in the order given.
    """
    kept = {kind: rows.join(sections.select(section), section, "left_semi") for kind, rows in parts.items()}
    live = sections.select(F.lit("section").alias("kind"), F.col(section).cast("string").alias("id"))
    for kind, rows in kept.items():
        live = live.unionByName(rows.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id")))
    for family, rows in facts.items():
        said = rows.select(F.col("id").alias("_of"), F.explode("refs").alias("_r")).select("_of", F.col("_r.kind").alias("kind"), F.col("_r.id").cast("string").alias("id"))
        held = said.join(live, ["kind", "id"], "left_semi").select(F.col("_of").alias("id")).distinct().withColumn("_live", F.lit(True))
        kept[family] = rows.join(held, "id", "left").where(F.col("_live") | (F.size(F.coalesce("refs", F.array().cast(rows.schema["refs"].dataType))) == 0)).drop("_live")
        live = live.unionByName(kept[family].select(F.lit(family).alias("kind"), F.col("id").cast("string").alias("id")))
    return kept


def type_counts(families: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(family, type, n) of several record families by the column that holds a record's type."""
    out = None
    for family, (rows, column) in families.items():
        one = rows.groupBy(F.col(column).cast("string").alias("type")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(family).alias("family"), "type", "n")
        out = one if out is None else out.unionByName(one)
    return out
