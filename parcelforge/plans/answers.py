"""Answers to map requests: features of a viewport, a parcel by id or place, current against draft zoning.

Tables: parcels (parcel_id, shape), zones (zone_id, code, shape), addresses (address_id, label, x, y).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelforge.functions.geo import boxes_meet, covers
from parcelforge.functions.text import zone_change
from parcelforge.operators import shapes
from parcelforge.operators.sequence import top_k


def _box(x0: float, y0: float, x1: float, y1: float) -> Column:
    return F.struct(*[F.lit(float(v)).alias(n) for n, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))])


def held(shape: Column, x: Column, y: Column) -> Column:
    """The point lies in an odd number of rings, boundaries included."""
    ring = lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return F.size(F.filter(shape, lambda r: covers(ring(r), x, y))) % 2 == 1


def viewport(features: DataFrame, key: str, box: tuple[float, float, float, float], limit: int) -> DataFrame:
    """The first ``limit`` features, by key, that meet the box: boxes first, then the true shapes."""
    near = features.where(boxes_meet(shapes.envelope(F.col("shape")), _box(*box)))
    window = shapes.make_envelope(*[F.lit(float(v)) for v in box])
    return near.where(shapes.meets(F.col("shape"), window)).orderBy(key).limit(limit)


def feature_collection(features: DataFrame, key: str, properties: list[str]) -> DataFrame:
    """One row with a GeoJSON FeatureCollection, features by key. For bounded answers, as ``viewport`` gives them."""
    body = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    one = F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(shapes.geojson(F.col("shape")), F.lit("null")), F.lit(',"properties":'), body, F.lit("}"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), one.alias("f"))))
    joined = F.array_join(F.transform(rows, lambda r: r["f"]), ",")
    return features.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}")).alias("geojson"))


def zoning(parcels: DataFrame, zones: DataFrame, size: float) -> DataFrame:
    """(parcel_id, zone_id, code, shared): the zone that shares most of each parcel, ties by zone id; parcels outside all zones: nulls."""
    # of equal zones the lowest id wins, and equal parcels have one answer: only different shapes are compared
    lowest = zones.groupBy(F.col("shape").alias("b")).agg(F.min(F.struct("zone_id", "code")).alias("_z"))
    met = shapes.shape_overlaps(parcels.select(F.col("shape").alias("a")).distinct(), lowest.select("b"), size)
    best = top_k(met.join(lowest, "b").select("a", "shared", "_z.zone_id", "_z.code"), "a", [F.desc("shared"), F.asc("zone_id")]).drop("rank")
    return parcels.select("parcel_id", F.col("shape").alias("a")).join(best, "a", "left").select("parcel_id", "zone_id", "code", "shared")


def comparison(parcels: DataFrame, current: DataFrame, draft: DataFrame, size: float) -> DataFrame:
    """(parcel_id, current_code, draft_code, change) of the given parcels, one or all."""
    a = zoning(parcels, current, size).select("parcel_id", F.col("code").alias("current_code"))
    b = zoning(parcels, draft, size).select("parcel_id", F.col("code").alias("draft_code"))
    return a.join(b, "parcel_id").withColumn("change", zone_change(F.col("current_code"), F.col("draft_code")))


def parcel_by_id(parcels: DataFrame, addresses: DataFrame, zones: DataFrame, parcel_id: object, size: float) -> DataFrame:
    """One parcel with its zone, centroid and the addresses inside it in order of id; no such parcel: no row."""
    one = parcels.where(F.col("parcel_id") == F.lit(parcel_id))
    box = one.select(shapes.envelope(F.col("shape")).alias("b")).first()  # the request is for one parcel; its box lets scans skip files
    edge = [float(v) if v is not None else 0.0 for v in (box["b"] if box else (None,) * 4)]
    within = F.col("x").between(edge[0], edge[2]) & F.col("y").between(edge[1], edge[3])
    zones = zones.where(boxes_meet(shapes.envelope(F.col("shape")), _box(*edge)))
    # the single parcel, filtered on its key, bounds the broadcast to one row
    inside = addresses.where(within).join(F.broadcast(one), held(F.col("shape"), F.col("x"), F.col("y")))
    labels = inside.groupBy("parcel_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("address_id", "label"))), lambda s: s["label"]).alias("addresses"))
    found = one.withColumn("centroid", shapes.centroid(F.element_at("shape", 1))).join(zoning(one, zones, size), "parcel_id")
    return found.join(labels, "parcel_id", "left").withColumn("addresses", F.coalesce("addresses", F.array()))


def parcel_at(parcels: DataFrame, addresses: DataFrame, x: float, y: float) -> DataFrame:
    """The smallest parcel that covers a place (ties by id) with the nearest address in it; outside all: no row."""
    box, at = shapes.envelope(F.col("shape")), (F.lit(float(x)), F.lit(float(y)))
    near = parcels.where(boxes_meet(box, _box(x, y, x, y)) & held(F.col("shape"), *at))
    one = near.withColumn("area", shapes.area(F.col("shape"))).orderBy("area", "parcel_id").limit(1)
    found = one.select(shapes.envelope(F.col("shape")).alias("b")).first()
    edge = [float(v) for v in found["b"]] if found else [0.0] * 4
    within = F.col("x").between(edge[0], edge[2]) & F.col("y").between(edge[1], edge[3])
    inside = addresses.where(within).join(F.broadcast(one.select("parcel_id", "shape")), held(F.col("shape"), F.col("x"), F.col("y")))
    nearest = inside.groupBy("parcel_id").agg(F.min(F.struct(shapes.distance(F.col("x"), F.col("y"), *at).alias("distance"), "address_id", "label")).alias("address"))
    return one.join(nearest, "parcel_id", "left")
