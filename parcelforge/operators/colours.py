"""Colours of samples and pixels: class histograms, masked regions, mean and dominant colours of votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelforge.operators.raster import hex_rgb


def histogram(pixels: DataFrame, code: str) -> DataFrame:
    """(code, pixels) of all classes."""
    return pixels.groupBy(code).agg(F.count(F.lit(1)).alias("pixels"))


def masked(pixels: DataFrame, boxes: list[tuple[int, int, int, int]], code: str = "code") -> DataFrame:
    """Pixels without a class inside the given boxes (row and column of the first and of the first beyond): legends and titles of a map's sheet, which stand in the expression."""
    hidden = F.lit(False)
    for r0, c0, r1, c1 in boxes:
        hidden |= (F.col("row") >= r0) & (F.col("row") < r1) & (F.col("col") >= c0) & (F.col("col") < c1)
    return pixels.withColumn(code, F.when(~hidden, F.col(code)))


def sample_colours(samples: DataFrame, key: str, order: str) -> DataFrame:
    """(key, mean_rgb, dominant_rgb) of the samples that have a colour: the mean of each channel, and the colour most samples have, the first met of equals."""
    seen = samples.where("r IS NOT NULL")
    mean = seen.groupBy(key).agg(*[F.avg(c).alias(c) for c in "rgb"])
    counted = seen.groupBy(key, "r", "g", "b").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    best = counted.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))).where("_k = 1")
    named = mean.select(key, hex_rgb(F.col("r"), F.col("g"), F.col("b")).alias("mean_rgb"))
    return named.join(best.select(key, hex_rgb(F.col("r"), F.col("g"), F.col("b")).alias("dominant_rgb")), key)
