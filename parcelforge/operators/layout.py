"""Positioned words and blocks of pages to reading order; a page is the unit, so a group is bounded by one page."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _per_page(words: DataFrame, page: list[str], columns: str, assign) -> DataFrame:
    kinds = ", ".join(f"{c} {words.schema[c].dataType.simpleString()}" for c in page)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        made = assign(rows)
        for at, c in enumerate(page):
            made.insert(at, c, rows[c].iloc[0])
        return made

    return words.select(*page, "x", "y", "text").groupBy(*page).applyInPandas(one, f"{kinds}, {columns}")


def word_lines(words: DataFrame, page: list[str], gap: float = 5.0) -> DataFrame:
    """(page, line, y, text): words from the top, a new line where y is more than ``gap`` from the line's first word."""

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["y", "x", "text"])
        line, anchor, marks = -1, None, []
        for y in rows["y"]:
            if anchor is None or y - anchor > gap:
                line, anchor = line + 1, y
            marks.append(line)
        rows = rows.assign(line=marks).sort_values(["line", "x", "text"])
        return rows.groupby("line", as_index=False).agg(y=("y", "min"), text=("text", " ".join))

    return _per_page(words, page, "line long, y double, text string", assign)


def bucket_rows(words: DataFrame, page: list[str], near: float = 3.0) -> DataFrame:
    """(page, line, y, text) for y growing upwards: a word joins the first row whose running mean y is within ``near``."""

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["y", "x", "text"], ascending=[False, True, True])
        sums, sizes, marks = np.zeros(len(rows)), np.zeros(len(rows)), []
        used = 0
        for y in rows["y"]:
            hits = np.flatnonzero(np.abs(sums[:used] / np.maximum(sizes[:used], 1) - y) <= near)
            at = int(hits[0]) if len(hits) else used
            used = max(used, at + 1)
            sums[at] += y
            sizes[at] += 1
            marks.append(at)
        rows = rows.assign(_row=marks).sort_values(["_row", "x", "text"])
        out = rows.groupby("_row", as_index=False).agg(y=("y", "mean"), text=("text", " ".join)).sort_values("y", ascending=False)
        return out.assign(line=range(len(out)))[["line", "y", "text"]]

    return _per_page(words, page, "line long, y double, text string", assign)


def reading_order(blocks: DataFrame, page: list[str], middle: float = 306.0, gutter: float = 24.0, least: int = 4) -> DataFrame:
    """Adds ``column`` (0 spanning, 1 left, 2 right) and ``place`` of blocks (x0, x1, y0, text) on each page.

    A page has two columns when each side holds ``least`` blocks and spanning ones are no more than the fuller side; else all rows read from the top.
    """
    side = F.when(F.col("x1") <= middle + gutter, 1).when(F.col("x0") >= middle - gutter, 2).otherwise(0)
    on_page = Window.partitionBy(*page)
    n = [F.count_if(F.col("column") == i).over(on_page) for i in range(3)]
    rows = blocks.withColumn("column", side).withColumn("_two", (n[1] >= least) & (n[2] >= least) & (n[0] <= F.greatest(n[1], n[2])))
    order = Window.partitionBy(*page).orderBy(F.when(F.col("_two"), F.col("column")).otherwise(0), F.round("y0", 1), F.round("x0", 1), "text")
    return rows.withColumn("place", F.row_number().over(order)).drop("_two")
