"""Operators over ordered rows: running context, ranges, islands, suffixes, ranks, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_context(rows: DataFrame, part: str, order: list[str], value: Column, name: str) -> DataFrame:
    """The last non-null value at or before each row."""
    upto = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(upto))


def page_ranges(headings: DataFrame, part: str, start: str, end: Column, name: str = "page_end") -> DataFrame:
    """Each heading runs to the row before the next; the last to ``end``."""
    return headings.withColumn(name, F.coalesce(F.lead(start).over(Window.partitionBy(part).orderBy(start)) - 1, end))


def islands(rows: DataFrame, part: str, order: list[str], kind: str) -> DataFrame:
    """Runs of consecutive rows of one kind: (part, run, kind, first, last, length) by the order's first column."""
    w = Window.partitionBy(part).orderBy(*order)
    fresh = F.when(F.col(kind).eqNullSafe(F.lag(kind).over(w)), 0).otherwise(1)
    marked = rows.withColumn("_new", fresh).withColumn("run", F.sum("_new").over(w))
    return marked.groupBy(part, "run").agg(
        F.min(kind).alias("kind"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count(F.lit(1)).alias("length")
    )


def dedupe_suffix(rows: DataFrame, key: str, order: str, name: str = "unique_key") -> DataFrame:
    """Keys made unique by ``__n`` from the second occurrence on."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn(name, F.when(n > 1, F.concat(F.col(key), F.lit("__"), n.cast("string"))).otherwise(F.col(key)))


def top_k(rows: DataFrame, part: str, order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each part; Spark limits each group before the shuffle's sort ends."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(part).orderBy(*order))).where(F.col("rank") <= k)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) by the smallest node reachable; columns a and b.

    Each round takes the least label of the neighbours and then the label's own label, so long chains shorten by more than half a round.  Where
    the session has a checkpoint folder each round is written there, else kept and the round before released.  Tables are merged: a written round is
    taken for as large as the plan behind it was thought to be, and labels of every node are no table for a broadcast.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    durable = edges.sparkSession.sparkContext.getCheckpointDir()
    both = both.checkpoint() if durable else both.persist()  # the edges may be dear to work out, and every round reads them
    labels, held = both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")), None
    for _ in range(rounds):
        near = both.join(labels.hint("merge"), both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("low"))
        low = labels.join(near.hint("merge"), labels["node"] == near["a"], "left").select("node", "component", F.least("component", F.coalesce("low", "component")).alias("mid"))
        jump = low.select(F.col("node").alias("_n"), F.col("mid").alias("_m"))
        grown = low.join(jump.hint("merge"), low["mid"] == jump["_n"], "left").select("node", "component", F.least("mid", F.coalesce("_m", "mid")).alias("new"))
        grown = grown.checkpoint() if durable else grown.persist()
        moved = grown.where("new <> component").count()  # works out all of it before the round before is released
        if held is not None and not durable:
            held.unpersist()
        held, labels = grown, grown.select("node", F.col("new").alias("component"))
        if not moved:
            if not durable:
                both.unpersist()
            return labels
    raise RuntimeError("components did not settle")


def key_lists(rows: DataFrame, key: str, most: int = 256, parts: int = 16) -> DataFrame:
    """Rows that differ only in ``key`` as one row with their keys as a list of ``most`` at most; null keys are left out.

    Keys are first gathered in ``parts`` parts; short parts become one list, long ones stay apart, so no task holds all keys of a very large group at once.
    """
    by = [c for c in rows.columns if c != key]
    some = rows.where(F.col(key).isNotNull()).groupBy(*by, F.pmod(F.xxhash64(key), F.lit(parts)).alias("_part")).agg(F.collect_list(key).alias(key))
    whole = some.groupBy(*by, F.when(F.size(key) < most, F.lit(-1)).otherwise(F.col("_part")).alias("_part")).agg(F.flatten(F.collect_list(key)).alias(key))
    return whole.withColumn(key, F.explode(F.transform(F.sequence(F.lit(1), F.size(key), F.lit(most)), lambda i: F.slice(key, i, F.lit(most))))).drop("_part")
