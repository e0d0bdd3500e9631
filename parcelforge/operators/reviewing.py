"""The review of section pairs: joins of both sides, decisions, filters, counts, ledgers, and the nested detail of sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelforge.operators.extraction import in_order

#: Columns that a search of the review table looks through.
SEARCHED = ("review_decision", "candidate_topic", "equivalence_type", "current_section_label", "current_section_title", "draft_section_label", "draft_section_title", "reviewer_notes")


def text_of(value: Column) -> Column:
    """A value as text, '' for null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def compact(value: Column) -> Column:
    """Trimmed text; null where nothing is left."""
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def preview(text: Column, most: int = 300) -> Column:
    """The first characters of a text on one line."""
    return F.left(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), F.lit(most))


def decision(status: Column) -> Column:
    return F.when(status.isin("accepted", "rejected"), status).otherwise("needs_review")


def review_rows(pairs: DataFrame, sections: DataFrame) -> DataFrame:
    """Pairs with both sections' columns (prefixed current_ and draft_), the decision and the row's index from 0, in the order of current section, draft section and pair.

    ``sections`` (section_id, source_order, section_label, section_title, document_type, zone_code).
    """
    side = lambda p: sections.select(*[F.col(c).alias(f"{p}_{c}") for c in sections.columns])
    rows = pairs.join(side("current"), "current_section_id").join(side("draft"), "draft_section_id")
    order = Window.orderBy(F.asc_nulls_last("current_source_order"), F.asc_nulls_last("draft_source_order"), "section_equivalence_id")
    return indexed(rows.withColumn("review_decision", decision(F.col("review_status"))), order, "row_index")


def indexed(rows: DataFrame, order, name: str) -> DataFrame:
    """Rows with their place from 0 in one total order.  For review tables, which people read whole: one task numbers them."""
    return rows.withColumn(name, F.row_number().over(order) - 1)


def filter_rows(rows: DataFrame, query: str = "", wanted: str = "") -> DataFrame:
    """Rows with a decision, if one is given, that hold the query in one of the searched columns, case aside."""
    said = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in SEARCHED if c in rows.columns]))
    q = query.strip().lower()
    keep = F.contains(said, F.lit(q)) if q else F.lit(True)
    return rows.where(keep & (F.col("review_decision") == wanted if wanted else F.lit(True)))


def decision_counts(rows: DataFrame) -> DataFrame:
    """(review_decision, n)."""
    return rows.groupBy("review_decision").agg(F.count(F.lit(1)).alias("n"))


def review_summary(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row: how many rows there are and how many fulfil each condition."""
    return rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def top_groups(rows: DataFrame, key: str, most: int = 20) -> DataFrame:
    """(key, n) of the most frequent values, null too, by falling number and value."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(key)).limit(most)


def flag_counts(rows: DataFrame, flags: str) -> DataFrame:
    """(code, n) of an array of review flags."""
    return rows.select(F.explode(flags).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def decide(pairs: DataFrame, choices: DataFrame, note: str) -> DataFrame:
    """Pairs after decisions (section_equivalence_id, decision): accepted or rejected; a rejection makes the pair ``not_equivalent``, notes append on a new line; other rows stay."""
    one = choices.where(F.col("decision").isin("accepted", "rejected")).dropDuplicates(["section_equivalence_id"])
    rows = pairs.join(one, "section_equivalence_id", "left")
    hit = F.col("decision").isNotNull()
    said = F.concat_ws("\n", F.nullif("reviewer_notes", F.lit("")), F.concat(F.lit(note), F.col("decision"), F.lit(".")))
    return rows.withColumns({
        "review_status": F.coalesce("decision", "review_status"), "reviewer_notes": F.when(hit, said).otherwise(F.col("reviewer_notes")),
        "equivalence_type": F.when(F.col("decision") == "rejected", "not_equivalent").otherwise(F.col("equivalence_type")),
    }).select(*pairs.columns)


def upsert_candidates(current: DataFrame, incoming: DataFrame, method: str, reset: bool = False) -> tuple[DataFrame, DataFrame]:
    """(pairs, outcome counts) after a run of one candidate method.

    Pairs are keyed by current_key, draft_key and candidate_method.  Known pairs still open take the new scores, reviewed ones stay, new ones are added as
    candidates, open ones of the method that do not come again are pruned; other methods' pairs stay.  ``reset`` deletes the method's pairs, reviewed too, first.
    """
    keys = ["current_key", "draft_key", "candidate_method"]
    own = current.where(F.col("candidate_method") == method)
    others = current.where(F.col("candidate_method") != method)
    base = own.where(F.lit(not reset))
    fresh = incoming.withColumns({"candidate_method": F.lit(method), "review_status": F.lit("candidate")}).dropDuplicates(keys)
    reviewed = base.where("review_status <> 'candidate'")
    known = base.select(*keys, F.col("review_status").alias("_was"))
    marked = fresh.join(known, keys, "left")
    outcome = F.when(F.col("_was").isNull(), "inserted").when(F.col("_was") == "candidate", "updated").otherwise("preserved_reviewed")
    stale = base.where("review_status = 'candidate'").join(fresh.select(*keys), keys, "left_anti").select(F.lit("pruned_stale").alias("outcome"))
    removed = own.where(F.lit(reset)).select(F.lit("reset_deleted").alias("outcome"))
    counts = marked.select(outcome.alias("outcome")).unionByName(stale).unionByName(removed).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    after = others.unionByName(reviewed).unionByName(fresh.join(reviewed.select(*keys), keys, "left_anti").select(*current.columns))
    return after, counts


def section_texts(clauses: DataFrame, tables: DataFrame, cells: DataFrame) -> DataFrame:
    """(section_id, text, items): the clauses' texts, then those of the tables' cells that are not blank, each in order."""
    said = clauses.select("section_id", F.lit(0).alias("_k"), F.col("source_order").alias("_a"), F.lit(0).alias("_b"), F.lit(0).alias("_c"), F.col("text").alias("_t"))
    own = tables.select("section_id", "raw_table_id", F.col("source_order").alias("_a"))
    cell = cells.where(F.trim("text") != "").join(own, "raw_table_id").select("section_id", F.lit(1).alias("_k"), "_a", F.col("row_order").alias("_b"), F.col("column_order").alias("_c"), F.col("text").alias("_t"))
    return said.unionByName(cell).groupBy("section_id").agg(in_order(["_k", "_a", "_b", "_c"], "_t").alias("text"), F.count(F.lit(1)).alias("items"))


def review_ledger(pairs: DataFrame, sections: DataFrame, texts: DataFrame, method: str) -> DataFrame:
    """Review rows of a method with a preview of both sections' texts and their numbers of items; sections without text have empty ones."""
    rows = review_rows(pairs.where(F.col("candidate_method") == method), sections)
    for side in ("current", "draft"):
        own = texts.select(F.col("section_id").alias(f"{side}_section_id"), preview(F.col("text")).alias(f"{side}_text_preview"), F.col("items").alias(f"{side}_items"))
        rows = rows.join(own, f"{side}_section_id", "left").withColumns({f"{side}_text_preview": F.coalesce(f"{side}_text_preview", F.lit("")), f"{side}_items": F.coalesce(f"{side}_items", F.lit(0).cast("long"))})
    return rows.orderBy("row_index")


def tables_of_sections(sections: DataFrame, tables: DataFrame) -> DataFrame:
    """(section_id, raw_table_id, and the table's columns): tables by their section id, or by a natural key ``<section's key>|table|...``.

    The disjunction is a union of two equi-joins; a table that both find comes once.
    """
    rest = [c for c in tables.columns if c not in ("section_id",)]
    direct = sections.select("section_id").join(tables, "section_id").select("section_id", *rest)
    marked = tables.where(F.locate("|table|", F.col("natural_key")) > 0).withColumn("_at", F.explode(F.sequence(F.lit(1), F.size(F.split("natural_key", r"\|table\|")) - 1)))
    prefix = F.array_join(F.slice(F.split("natural_key", r"\|table\|"), F.lit(1), F.col("_at")), "|table|")
    keyed = sections.select("section_id", F.col("natural_key").alias("_key"))
    by_key = marked.withColumn("_key", prefix).drop("section_id", "_at").join(keyed, "_key").select("section_id", *rest)
    return direct.unionByName(by_key).dropDuplicates(["section_id", "raw_table_id"])


def section_detail(sections: DataFrame, clauses: DataFrame, tables: DataFrame, cells: DataFrame, family: str | None = None) -> DataFrame:
    """Sections with their clauses and tables, the tables' rows and their cells, as nested arrays in source order, built from the innermost out.

    ``sections`` (section_id, natural_key, path, ...), ``clauses`` (section_id, clause_id, label, text, source_order), ``tables`` (raw_table_id, section_id, natural_key,
    title, source_order), ``cells`` (raw_table_id, row_order, column_order, column_id, text).  ``family`` keeps the sections whose path starts with it.
    """
    if family is not None:
        sections = sections.where(F.startswith("path", F.lit(family)))
    listed = lambda order, *fields: F.transform(F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("_v")))), lambda s: s["_v"])
    rows = cells.groupBy("raw_table_id", "row_order").agg(listed(["column_order", "column_id"], "column_id", "text").alias("cells"))
    by_table = rows.groupBy("raw_table_id").agg(listed(["row_order"], "row_order", "cells").alias("rows"))
    own = tables_of_sections(sections, tables).join(by_table, "raw_table_id", "left")
    empty_rows = F.coalesce("rows", F.array().cast(by_table.schema["rows"].dataType))
    by_section = own.withColumn("rows", empty_rows).groupBy("section_id").agg(listed(["source_order", "raw_table_id"], "title", "source_order", "rows").alias("tables"))
    said = clauses.groupBy("section_id").agg(listed(["source_order", "clause_id"], "label", "text", "source_order").alias("clauses"))
    joined = sections.join(said, "section_id", "left").join(by_section, "section_id", "left")
    return joined.withColumns({"clauses": F.coalesce("clauses", F.array().cast(said.schema["clauses"].dataType)), "tables": F.coalesce("tables", F.array().cast(by_section.schema["tables"].dataType))})


def checked_members(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is wanted; the query fails if a wanted key has no row."""
    missing = wanted.select(key).distinct().join(rows.select(key).distinct(), key, "left_anti").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"))
    asserted = missing.select(F.assert_true(F.col("_n") == 0, F.concat(F.lit("no row for "), F.col("_first").cast("string"))).isNull().alias("_ok"))
    # one row of one flag
    return rows.join(wanted.select(key).distinct(), key, "left_semi").join(F.broadcast(asserted), F.col("_ok")).drop("_ok")
