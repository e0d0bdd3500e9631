"""Rasters as pixel tables (row, col, r, g, b): sampling, colour classes, votes, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pixel_of(x: Column, y: Column, west: float, north: float, size: float) -> tuple[Column, Column]:
    """(row, col) of a place in a north-up raster."""
    return F.floor((F.lit(north) - y) / size), F.floor((x - F.lit(west)) / size)


def bilinear(u: Column, v: Column, corners: list[tuple[float, float]]) -> tuple[Column, Column]:
    """Map place of relative pixel coordinates (0 to 1) between the corners top left, top right, bottom right, bottom left."""
    weights = [(1 - u) * (1 - v), u * (1 - v), u * v, (1 - u) * v]
    return tuple(sum((w * c[i] for w, c in zip(weights, corners, strict=True)), F.lit(0.0)) for i in (0, 1))


def hex_rgb(r: Column, g: Column, b: Column) -> Column:
    return F.concat(F.lit("#"), *[F.lpad(F.lower(F.hex(F.round(c).cast("long"))), 2, "0") for c in (r, g, b)])


def usable(r: Column, g: Column, b: Column, alpha: Column | None = None, white: int = 242, black: int = 28) -> Column:
    """Neither transparent nor near white nor near black."""
    opaque = F.lit(True) if alpha is None else alpha != 0
    return opaque & ~(F.least(r, g, b) >= white) & ~(F.greatest(r, g, b) <= black)


def nearest_class(r: Column, g: Column, b: Column, classes: list[tuple[str, int, int, int, float]]) -> Column:
    """struct(d, i, code, reach) of the class (code, r, g, b, reach) of least distance, the earlier of equals; null code beyond its reach."""
    away = [
        F.struct(F.sqrt((r - c[1]) * (r - c[1]) + (g - c[2]) * (g - c[2]) + (b - c[3]) * (b - c[3])).alias("d"), F.lit(i).alias("i"), F.lit(c[0]).alias("code"), F.lit(float(c[4])).alias("reach"))
        for i, c in enumerate(classes)
    ]
    best = F.array_min(F.array(*away))
    return F.struct(best["d"].alias("distance"), F.when(best["d"] <= best["reach"], best["code"]).alias("code"))


def sample_points(parcels: DataFrame, key: str, box: str) -> DataFrame:
    """(key, place, x, y): a grid of 3, 5 or 7 points a side, by the box's area (over 1000, over 8000), at cell middles."""
    width, height = F.col(f"{box}.x1") - F.col(f"{box}.x0"), F.col(f"{box}.y1") - F.col(f"{box}.y0")
    rows = parcels.withColumn("_n", F.when(width * height > 8000, 7).when(width * height > 1000, 5).otherwise(3))
    rows = rows.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("_n") * F.col("_n") - 1)))
    x = F.col(f"{box}.x0") + (F.floor(F.col("place") / F.col("_n")) + 0.5) * width / F.col("_n")
    y = F.col(f"{box}.y0") + (F.col("place") % F.col("_n") + 0.5) * height / F.col("_n")
    return rows.select(key, "place", x.alias("x"), y.alias("y"))


def sample(points: DataFrame, pixels: DataFrame, west: float, north: float, size: float) -> DataFrame:
    """Points with the colour of their pixel, null outside: an equi-join on row and column.

    Pixels are rows in their millions whose size is guessed from few compressed columns; sorted and merged, no table passes through the driver.
    """
    row, col = pixel_of(F.col("x"), F.col("y"), west, north, size)
    return points.withColumns({"row": row, "col": col}).join(pixels.hint("merge"), ["row", "col"], "left")


def votes(samples: DataFrame, key: str, code: str, distance: str, order: str, unsure: float = 0.48, sure: float = 0.72) -> DataFrame:
    """Per key the class most samples have (ties: first met), its share of all samples, mean distance and the confidence of both."""
    # samples are read once: those without a class are counted as one more of a key's groups, so nothing is joined again
    counts = samples.groupBy(key, code).agg(F.count(F.lit(1)).alias("matched"), F.avg(distance).alias("mean_distance"), F.min(order).alias("_first"))
    vote = F.when(F.col(code).isNotNull(), F.struct("matched", (-F.col("_first")).alias("_f"), code, "mean_distance"))
    best = counts.groupBy(key).agg(F.sum("matched").alias("samples"), F.max(vote).alias("_b"))
    share = F.col("_b.matched") / F.col("samples")
    level = F.when((share >= sure) & (F.col("_b.mean_distance") <= 45), "high").when((share >= unsure) & (F.col("_b.mean_distance") <= 60), "medium").otherwise("low")
    return best.select(
        key, "samples", F.coalesce("_b.matched", F.lit(0)).alias("matched"), F.col(f"_b.{code}").alias(code), share.alias("share"),
        F.col("_b.mean_distance").alias("mean_distance"), level.alias("confidence"),
    )


def runs(pixels: DataFrame, code: str) -> DataFrame:
    """(row, code, col_start, col_end) of horizontal runs of one class."""
    lane = Window.partitionBy("row", code).orderBy("col")
    return pixels.withColumn("_g", F.col("col") - F.row_number().over(lane)).groupBy("row", code, "_g").agg(F.min("col").alias("col_start"), F.max("col").alias("col_end")).drop("_g")


def tiles(pixels: DataFrame, columns: list[str], size: int = 256) -> DataFrame:
    """(tile_row, tile_col, pixels): square tiles of at most ``size`` squared pixels, each sorted by row and column; the sink form of a raster."""
    at = [F.floor(F.col(c) / size).alias(f"tile_{c}") for c in ("row", "col")]
    return pixels.groupBy(*at).agg(F.array_sort(F.collect_list(F.struct("row", "col", *columns))).alias("pixels"))


def from_tiles(tiled: DataFrame) -> DataFrame:
    """The pixel table of tiles."""
    return tiled.select(F.inline("pixels"))
