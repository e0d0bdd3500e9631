"""The parcel review table and the map layers of an answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelforge.operators import shapes
from parcelforge.operators.sequence import top_k

#: Columns of the review table that people fill in later, by type.
OPEN_TEXT = (
    "map_legend_code_guess", "zoning_code_guess", "final_class_code_guess", "zone_name_guess", "mean_rgb", "dominant_rgb", "ambiguous_group", "final_map_legend_code", "final_zoning_code", "final_class_code",
    "final_zone_name", "review_notes",
)
OPEN_NUMBERS = ("sample_match_fraction", "rgb_distance")
#: What the status columns may hold.
STATUSES = {"review_status": ("auto_assigned", "needs_review", "reviewed", "defer", "exclude"), "confidence": ("high", "medium", "low", "manual")}


def parcel_review(parcels: DataFrame, draft: DataFrame, size: float) -> DataFrame:
    """One row per parcel with its area, the draft zone that shares most of it (ties by code) and that share, and typed empty columns for the review.

    A parcel that only touches zones has one of them with share 0: where two shapes touch, their meeting is not empty.
    """
    met = shapes.overlaps(parcels.select("parcel_id", "shape"), draft.select("zone_id", "shape"), size).join(draft.select("zone_id", "code", "name"), "zone_id")
    best = top_k(met, "parcel_id", [F.desc("shared"), F.asc("code"), F.asc("zone_id")]).select("parcel_id", F.col("code").alias("draft_zone_code"), F.col("name").alias("draft_zone_name"), "shared")
    area = shapes.area(F.col("shape"))
    rows = parcels.select("parcel_id", area.alias("parcel_area_m2")).join(best, "parcel_id", "left")
    share = F.when((F.col("parcel_area_m2") > 0) & F.col("shared").isNotNull(), F.col("shared") / F.col("parcel_area_m2"))
    fixed = {"sample_count": F.lit(0), "matched_sample_count": F.lit(0), "pattern_detected": F.lit(False), "assignment_method": F.lit("draft_context_assist"), "confidence": F.lit("low"), "review_status": F.lit("needs_review"), "review_priority": F.lit(50)}
    empty = {c: F.lit(None).cast("string") for c in OPEN_TEXT} | {c: F.lit(None).cast("double") for c in OPEN_NUMBERS}
    return rows.withColumns({"draft_match_fraction": share, **fixed, **empty}).drop("shared")


def check_statuses(rows: DataFrame) -> DataFrame:
    """The same rows; the query fails on a status that is none, and on a final class that needs a zoning code and has none."""
    ok = F.lit(True)
    for column, allowed in STATUSES.items():
        ok &= F.col(column).isNull() | F.col(column).isin(*allowed)
    ok &= F.col("final_class_code").isNull() | F.col("final_class_code").isin("NA", "U") | F.col("final_zoning_code").isNotNull()
    return rows.where(F.assert_true(F.coalesce(ok, F.lit(False)), F.lit("a review row has a status that is none")).isNull())


def feature(key: Column, shape: Column, properties: Column) -> Column:
    """One GeoJSON feature as text; the properties are a JSON text."""
    return F.concat(F.lit('{"type":"Feature","id":"'), key.cast("string"), F.lit('","geometry":'), F.coalesce(shapes.geojson(shape), F.lit("null")), F.lit(',"properties":'), properties, F.lit("}"))


def _source(table: str, key: str) -> Column:
    return F.struct(F.lit(table).alias("table"), F.col(key).alias("featureKey"), F.col("is_valid").alias("isValid"), F.col("validation_reason").alias("validationReason")).alias("source")


def parcel_features(parcels: DataFrame, table: str) -> DataFrame:
    """(feature_key, feature) of parcels (feature_key, shape, attributes as JSON, is_valid, validation_reason), one row each."""
    body = F.struct(F.col("feature_key").alias("parcelId"), shapes.area(F.col("shape")).alias("areaM2"), F.col("attributes"), _source(table, "feature_key"))
    return parcels.select("feature_key", feature(F.col("feature_key"), F.col("shape"), F.to_json(body, {"ignoreNullFields": "false"})).alias("feature"))


def zone_features(zones: DataFrame, table: str, name: str | None = None) -> DataFrame:
    """(feature_key, feature) of current or draft zones; the code is the bylaw's, else the mapped, else the raw one; ``name`` names the column of a zone's name."""
    code = F.coalesce("bylaw_zone_code", "zone_code_normalized", "zone_code_raw")
    named = [F.col(name).alias("zoneName")] if name else []
    body = F.struct(
        code.alias("zoneCode"), *named, F.col("zone_code_raw").alias("zoneCodeRaw"), F.col("zone_code_normalized").alias("zoneCodeNormalized"), F.col("bylaw_zone_code").alias("bylawZoneCode"),
        F.col("match_method").alias("matchMethod"), shapes.area(F.col("shape")).alias("areaM2"), F.col("attributes"), _source(table, "feature_key"),
    )
    return zones.select("feature_key", feature(F.col("feature_key"), F.col("shape"), F.to_json(body, {"ignoreNullFields": "false"})).alias("feature"))


def search_addresses(addresses: DataFrame, query: str, limit: int) -> DataFrame:
    """(address_id, label, street_number, street_name, unit, community, pid, confidence): addresses (address_id, attributes as JSON) whose label holds the query or whose PID it is.

    A PID comes first, then labels that start with the query, then others; by label and id.  Fewer than two characters find none.
    """
    q = query.strip()
    part = lambda k: F.nullif(F.trim(F.get_json_object("attributes", f"$.{k}")), F.lit(""))
    rows = addresses.select("address_id", *[part(k).alias(n) for k, n in (("STREET_NO", "street_number"), ("STREET_NM", "street_name"), ("APT_NO", "unit"), ("COMM_NM", "community"), ("PID", "pid"))])
    street = F.concat_ws(" ", "street_number", "street_name", F.concat(F.lit("Unit "), "unit"))
    rows = rows.withColumn("label", F.concat_ws(", ", street, "community", F.concat(F.lit("PID "), "pid")))
    low, wanted = F.lower("label"), F.lit(q.lower())
    starts, holds, is_pid = F.startswith(low, wanted), F.contains(low, wanted), F.coalesce(F.col("pid") == q, F.lit(False))
    rank = F.when(is_pid, 0).when(starts, 1).otherwise(2)
    found = rows.where((holds | is_pid) & F.lit(len(q) >= 2)).withColumns({"confidence": F.when(starts, "high").when(holds, "medium").otherwise("low"), "_r": rank})
    return found.orderBy("_r", "label", "address_id").limit(limit).drop("_r")
