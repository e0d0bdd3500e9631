"""Tables of documents: rebuilding from positioned words over pages, condition rows, patches, scoped alternatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelforge.functions import measure

def value_groups(value: Column) -> Column:
    """Measurements of a cell in order, an imperial equivalent with its metric value: ``6 m (20 ft) 8 m`` gives two."""
    return F.transform(measure.grouped(value), lambda g: g["raw"])


def condition_rows(rows: DataFrame, requirement: str, values: list[str], conditions: list[list[str]]) -> DataFrame:
    """Rows whose requirement ends in several conditions as one row per condition, with ``condition`` ('' elsewhere) and ``part`` (from 1).

    ``conditions`` are the known lists; a requirement ends in one when it ends in its members joined by blanks, the first list that fits
    counts.  Each value column must be empty or hold as many measurements as there are conditions; otherwise the row stays whole.
    """
    text = F.coalesce(F.col(requirement), F.lit(""))
    known = F.lit(None).cast("array<string>")
    for one in reversed(conditions):
        known = F.when(F.endswith(text, F.lit(" ".join(one))), F.array(*[F.lit(c) for c in one])).otherwise(known)
    rows = rows.withColumn("_known", known)
    empty = {c: F.coalesce(F.col(c), F.lit("")) == "" for c in values}
    fits = F.col("_known").isNotNull()
    for c in values:
        fits = fits & (empty[c] | (F.size(value_groups(F.col(c))) == F.size("_known")))
    rows = rows.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    rows = rows.select("*", F.posexplode(F.when(F.col("_fits"), F.col("_known")).otherwise(F.array(F.lit("")))).alias("_at", "condition"))
    stem = F.trim(F.left(text, F.length(text) - F.length(F.array_join("_known", " "))))
    out = {requirement: F.when(F.col("_fits"), stem).otherwise(F.col(requirement)), "part": F.col("_at") + 1}
    out |= {c: F.when(F.col("_fits") & ~empty[c], F.get(value_groups(F.col(c)), F.col("_at"))).otherwise(F.col(c)) for c in values}
    return rows.withColumns(out).drop("_known", "_fits", "_at")


def rebuild(words: DataFrame, doc: str, page: str, heading: str, near: float = 3.0, slack: float = 4.0) -> DataFrame:
    """(doc, table, row, column, label, text): tables over pages from words (doc, page, x, y from the top, text).

    Down a page, a word more than ``near`` below the one before it starts a line.  A line whose text matches ``heading`` opens a table on its page, and its words give
    the columns: each starts at its word's x.  Lines below it, on following pages too, belong to the table until the next heading.  A
    word stands in the last column that starts no more than ``slack`` to its right; a line with a word in the first column opens a row,
    others continue it.  Lines before the first heading belong to no table and are left out.
    """
    down = Window.partitionBy(doc, page).orderBy("y", "x", "text")
    fresh = F.coalesce((F.col("y") - F.lag("y").over(down) > near).cast("int"), F.lit(0))
    words = words.select(doc, page, "x", "y", "text", fresh.alias("_f")).withColumn("_l", F.sum("_f").over(down))
    placed = F.array_sort(F.collect_list(F.struct("x", "text")))
    lines = words.groupBy(doc, page, "_l").agg(placed.alias("_w"))
    joined = F.array_join(F.transform("_w", lambda w: w["text"]), " ")
    lines = lines.withColumn("_head", joined.rlike(heading))
    # one row per line here, so the window over a document holds its lines, not its words
    order = Window.partitionBy(doc).orderBy(page, "_l")
    lines = lines.withColumn("table", F.sum(F.col("_head").cast("int")).over(order)).withColumn("_cols", F.last(F.when(F.col("_head"), F.col("_w")), ignorenulls=True).over(order))
    body = lines.where("table > 0 AND NOT _head")
    at = lambda w: F.greatest(F.size(F.filter(F.col("_cols"), lambda c: c["x"] <= w["x"] + slack)) - 1, F.lit(0))
    body = body.withColumn("_w", F.transform("_w", lambda w: F.struct(at(w).alias("column"), w["x"].alias("x"), w["text"].alias("text"))))
    opens = F.exists("_w", lambda w: w["column"] == 0).cast("int")
    body = body.withColumn("row", F.sum(opens).over(Window.partitionBy(doc, "table").orderBy(page, "_l")))
    cells = body.select(doc, "table", "row", page, "_l", "_cols", F.inline("_w"))
    parts = F.array_sort(F.collect_list(F.struct(page, "_l", "x", "text")))
    out = cells.groupBy(doc, "table", "row", "column").agg(F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("text"), F.first("_cols").alias("_cols"))
    return out.select(doc, "table", "row", "column", F.get("_cols", F.col("column"))["text"].alias("label"), "text")


def apply_patches(rows: DataFrame, patches: DataFrame, key: str, columns: list[str], digest: str = "content_hash") -> DataFrame:
    """Rows with curated repairs (key, content_hash, patch map of column to text) and ``patched``.

    A patch holds for the contents it was made for: another hash leaves the row as it is and ``patched`` false, for review.  A
    row without a patch has null there; a key that the map does not name keeps its value.  Of several patches of a row the one with the
    greatest sequence of entries counts.
    """
    one = patches.groupBy(key, F.col(digest).alias("_for")).agg(F.max(F.array_sort(F.map_entries("patch"))).alias("_p"))
    stated = rows.join(one.groupBy(key).agg(F.lit(True).alias("_any")), key, "left")
    joined = stated.join(one.withColumnRenamed("_for", digest), [key, digest], "left").withColumn("_p", F.map_from_entries("_p"))
    new = {c: F.coalesce(F.element_at("_p", F.lit(c)).cast(rows.schema[c].dataType), F.col(c)) for c in columns}
    flag = F.when(F.col("_any"), F.col("_p").isNotNull())
    return joined.withColumns(new | {"patched": flag}).select(*rows.columns, "patched")


def scoped_alternatives(rows: DataFrame, keys: list[str], scopes: DataFrame, value: str) -> DataFrame:
    """Rows with the alternatives that a scope table (keys, scope, value) states for their clause, one row each; rows without one keep their value and a null scope."""
    named = scopes.select(*keys, "scope", F.col(value).alias("_value"))
    return rows.join(named, keys, "left").withColumn(value, F.coalesce("_value", value)).drop("_value")
