"""Validation of request arguments and ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit_of(value: object, fallback: int, most: int) -> int:
    """Whole part of a positive number, at most ``most``; else the fallback."""
    try:
        number = int(float(str(value)))
    except (TypeError, ValueError, OverflowError):
        return fallback
    return min(number, most) if number > 0 else fallback


def bbox_of(value: str) -> tuple[float, float, float, float]:
    """west,south,east,north in degrees; ValueError when malformed, reversed or out of range."""
    parts = [float(x) for x in value.split(",")]
    if len(parts) != 4:
        raise ValueError("four numbers are needed")
    west, south, east, north = parts
    if not (-180 <= west < east <= 180 and -90 <= south < north <= 90):
        raise ValueError("reversed or out of range")
    return west, south, east, north


def point_of(lon: object, lat: object) -> tuple[float, float]:
    """Degrees of a place; ValueError when they are no numbers or out of range."""
    x, y = float(str(lon)), float(str(lat))
    if not (-180 <= x <= 180 and -90 <= y <= 90):
        raise ValueError("out of range")
    return x, y


def search(rows: DataFrame, query: str, label: str, key: str, limit: int = 10) -> DataFrame:
    """Rows whose label starts with or contains the query, exact first; fewer than two characters find none."""
    q = query.strip().lower()
    text = F.lower(F.col(label))
    rank = F.when(text == q, 1).when(F.startswith(text, F.lit(q)), 2).otherwise(3)
    confidence = F.when(text == q, "high").when(F.startswith(text, F.lit(q)), "medium").otherwise("low")
    found = rows.where(F.contains(text, F.lit(q)) & F.lit(len(q) >= 2))
    return found.select(key, label, rank.alias("match_rank"), confidence.alias("confidence")).orderBy("match_rank", label, key).limit(limit)
