"""Vector drawings as item tables: lines, rectangles, quadrilaterals and cubic curves to paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _point(c: Column, at: int) -> Column:
    return F.array(F.get(c, F.lit(at)), F.get(c, F.lit(at + 1)))


def cubic(p: Column, steps: int = 8) -> Column:
    """Points 1 to ``steps`` of the Bezier curve of coordinates (x0, y0, ..., x3, y3), without its start."""
    at = [F.get(p, F.lit(i)) for i in range(8)]

    def place(k: Column) -> Column:
        t = k / F.lit(float(steps))
        weights = [(1 - t) * (1 - t) * (1 - t), 3 * (1 - t) * (1 - t) * t, 3 * (1 - t) * t * t, t * t * t]
        return F.array(*[sum((w * at[2 * i + axis] for i, w in enumerate(weights)), F.lit(0.0)) for axis in (0, 1)])

    return F.transform(F.sequence(F.lit(1), F.lit(steps)), place)


def paths(items: DataFrame, keys: list[str], order: str, kind: str = "kind", coords: str = "coords", steps: int = 8) -> DataFrame:
    """(keys, path, points): drawing items in order to paths of at least two different points.

    Kinds: ``l`` (x0, y0, x1, y1), ``c`` (four points), ``re`` (x0, y0, x1, y1), ``qu`` (upper left, upper right, lower right, lower left).  A line or curve
    that starts where the one before ended continues its path; rectangles and quadrilaterals are closed paths of their own.
    """
    c, k = F.col(coords), F.col(kind)
    x0, y0, x1, y1 = (F.get(c, F.lit(i)) for i in range(4))
    box = F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0))
    quad = F.array(*[_point(c, i) for i in (0, 2, 4, 6, 0)])
    points = F.when(k == "re", box).when(k == "qu", quad).when(k == "l", F.array(_point(c, 0), _point(c, 2))).when(k == "c", F.concat(F.array(_point(c, 0)), cubic(c, steps)))
    drawn = Window.partitionBy(*keys).orderBy(order)
    rows = items.withColumn("_p", points).where("_p IS NOT NULL").withColumn("_open", k.isin("l", "c"))
    follows = F.col("_open") & F.lag("_open").over(drawn) & (F.get("_p", F.lit(0)) == F.element_at(F.lag("_p").over(drawn), -1))
    rows = rows.withColumn("path", F.sum(F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1)).over(drawn))
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_p").alias("p")))), lambda s: s["p"]))
    out = rows.groupBy(*keys, "path").agg(whole.alias("points"))
    # a point that repeats the one before it is no new point
    kept = F.filter("points", lambda p, i: (i == 0) | (p != F.get(F.col("points"), F.greatest(i - 1, F.lit(0)))))
    return out.withColumn("points", kept).where(F.size("points") >= 2)
