"""Connected components over link tables, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelforge.llm.spill import drop_table, write_table


#: Edges that one file holds; few edges need few tasks, however many partitions the session's shuffles have.
EDGES_A_FILE = 500_000


def _star(edges: DataFrame, large: bool, files: int) -> DataFrame:
    """One star step, written.  The least neighbours are written first: a plain join of two tables may split a hub's rows over tasks."""
    if large:  # each node sends its larger neighbours to the least of its neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = write_table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(files), "components")
        moved = edges.join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b")  # edges are a < b
    else:  # each node hangs itself and its smaller neighbours under the least of them
        least = write_table(edges.groupBy("b").agg(F.min("a").alias("m")).coalesce(files), "components")
        ends = F.explode(F.array_distinct(F.array(F.col("a"), F.col("b"))))
        moved = edges.join(least, "b").select("m", ends.alias("y")).where("m <> y").select(F.least("m", "y").alias("a"), F.greatest("m", "y").alias("b"))
    out = write_table(moved.distinct().coalesce(files), "components")
    drop_table(least)
    return out


def _is_stars(edges: DataFrame) -> tuple[int, bool]:
    """(edges, are they stars around the least node of each component): no node is the larger end twice, and no smaller end is a larger one."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("b").alias("d")).first()
    return row["n"], row["n"] == row["d"] and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def components(links: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has a link; component = smallest node reachable.

    ``links`` has columns ``a`` and ``b``; loops, repeats and direction do not
    matter, rows with a null end are dropped, no links give no rows.  Each round
    is written to the shared folder; only two numbers per round reach the driver.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = write_table(edges, "components")
    n, done = _is_stars(edges)
    for _ in range(max_rounds):
        if done:
            break
        large = _star(edges, True, n // EDGES_A_FILE + 1)
        drop_table(edges)
        edges = _star(large, False, n // EDGES_A_FILE + 1)
        drop_table(large)
        n, done = _is_stars(edges)
    if not done:
        raise RuntimeError("connected components did not settle")
    out = edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
    out._parcelforge_path = edges._parcelforge_path  # for drop_table, once the result has been used
    return out
