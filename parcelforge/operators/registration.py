"""Spatial layers: their contracts, the loading of features, links of zones to features, views of a layer, classes of map references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelforge.operators import shapes
from parcelforge.operators.records import merge_rows
from parcelforge.operators.spatial import expand


def row_json(rows: DataFrame, *without: str) -> Column:
    """A row as JSON, nulls included, without some columns."""
    return F.to_json(F.struct(*[c for c in rows.columns if c not in without]), {"ignoreNullFields": "false"})


def register_layers(current: DataFrame, contracts: DataFrame) -> DataFrame:
    """Layer contracts after registration: known layer keys take the new contract, others are added."""
    return merge_rows(current, contracts, ["layer_key"])


def layer_id(layers: DataFrame, key: str) -> DataFrame:
    """(spatial_layer_id) of the one layer of a key."""
    return layers.where(F.col("layer_key") == key).select("spatial_layer_id").limit(1)


def features(rows: DataFrame, layers: DataFrame, key: str, feature: str, geom: str = "geom", code: str | None = None, crosswalk: DataFrame | None = None, context: str | None = None) -> DataFrame:
    """Rows of a source table as features of the layer ``key``: key as text, raw and mapped zone code, attributes as JSON, shape, validity and its reason.

    ``crosswalk`` (context, source_code, target_code, status) holds tens of rows; its active ones of the context map codes, others stay as they are.  Without the layer there are no features.
    """
    attributes = row_json(rows, geom)
    raw = F.col(code).cast("string") if code else F.lit(None).cast("string")
    made = rows.select(F.col(feature).cast("string").alias("feature_key"), raw.alias("zone_code_raw"), attributes.alias("attributes"), F.col(geom).alias("geom"))
    if crosswalk is not None:
        known = crosswalk.where((F.col("context") == context) & (F.col("status") == "active")).select(F.col("source_code").alias("zone_code_raw"), "target_code")
        made = made.join(F.broadcast(known), "zone_code_raw", "left")
    target = F.col("target_code") if crosswalk is not None else F.lit(None).cast("string")
    made = made.withColumn("zone_code_normalized", F.coalesce(target, F.col("zone_code_raw")))
    made = made.withColumns({"is_valid": shapes.is_valid(F.col("geom")), "validation_reason": shapes.validity_reason(F.col("geom"))})
    # one layer has the key: a broadcast of one row
    made = made.withColumn("layer_key", F.lit(key)).join(F.broadcast(layers.where(F.col("layer_key") == key).select("layer_key", "spatial_layer_id")), "layer_key")
    return made.select("spatial_layer_id", "feature_key", "zone_code_raw", "zone_code_normalized", "attributes", "geom", "is_valid", "validation_reason")


def load_features(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Features after a load: one row for each layer and feature key, the incoming one where both have it."""
    return merge_rows(current, incoming, ["spatial_layer_id", "feature_key"])


def zone_links(found: DataFrame, layers: DataFrame, files: DataFrame, crosswalk: DataFrame, key: str, revision: int, context: str) -> DataFrame:
    """(document_revision_id, zone_code, spatial_layer_id, feature_key, match_method): features of a layer whose code is that of an active zone file of the revision."""
    active = files.where((F.col("document_revision_id") == revision) & (F.col("file_kind") == "zone") & F.col("is_active")).select("document_revision_id", "zone_code").distinct()
    known = crosswalk.where((F.col("context") == context) & (F.col("status") == "active"))
    known = known.select(F.col("source_code").alias("zone_code_raw"), F.col("target_code").alias("zone_code_normalized"), F.lit(True).alias("_mapped")).distinct()
    own = found.join(F.broadcast(layer_id(layers, key)), "spatial_layer_id")
    linked = own.join(active, own["zone_code_normalized"] == active["zone_code"]).join(F.broadcast(known), ["zone_code_raw", "zone_code_normalized"], "left")
    method = F.when(F.col("_mapped"), "zone_code_crosswalk").otherwise("direct_zone_code")
    return linked.select("document_revision_id", "zone_code", "spatial_layer_id", "feature_key", method.alias("match_method")).dropDuplicates(["document_revision_id", "zone_code", "spatial_layer_id", "feature_key"])


def of_kind(geom: Column, kind: Column, want: str) -> Column:
    """The shape itself; the query fails on a shape of another kind."""
    return F.when(F.assert_true(kind == want, F.concat(F.lit(f"a shape is no {want}: "), kind)).isNull(), geom)


def layer_view(found: DataFrame, layers: DataFrame, key: str, links: DataFrame | None = None) -> DataFrame:
    """Features of one layer, with the zone that each is linked to where links are given."""
    own = found.join(F.broadcast(layer_id(layers, key)), "spatial_layer_id")
    if links is None:
        return own
    named = links.select("spatial_layer_id", "feature_key", F.col("zone_code").alias("bylaw_zone_code"), "match_method")
    return own.join(named, ["spatial_layer_id", "feature_key"], "left")


def effective_code(*codes: str) -> Column:
    """The first code that is set, of the bylaw's, the mapped, the raw one and the map's."""
    return F.coalesce(*codes)


def materialise(view: DataFrame, path: str, size: float, geom: str = "geom") -> None:
    """A view written for reading by place: files in the order of grid cells of the shapes' lower-left corners, so that box filters skip most of them."""
    box = shapes.envelope(F.col(geom))
    cells = {"cell_x": F.floor(box["x0"] / size), "cell_y": F.floor(box["y0"] / size), "x0": box["x0"], "y0": box["y0"], "x1": box["x1"], "y1": box["y1"]}
    ordered = view.withColumns(cells).repartitionByRange("cell_x", "cell_y").sortWithinPartitions("cell_x", "cell_y")
    ordered.write.mode("overwrite").parquet(path)


def classify_references(references: DataFrame, layers: DataFrame, rules: list[tuple[int, str, str, str | None, str]], source: str = "map_reference_source_id") -> DataFrame:
    """Map references with classification, spatial_layer_id and notes.

    A rule is (revision, LIKE pattern, classification, layer key or null, note); the first that fits counts, others are ``text_only_reference``.  Layers that are not registered give no id.
    """
    kind, layer, note = F.lit("text_only_reference"), F.lit(None).cast("string"), F.lit("No layer is linked to this reference.")
    for revision, pattern, name, key, why in reversed(rules):
        hit = (F.col("document_revision_id") == revision) & F.col(source).like(pattern)
        kind, layer, note = F.when(hit, name).otherwise(kind), F.when(hit, F.lit(key)).otherwise(layer), F.when(hit, why).otherwise(note)
    ids = layers.select(F.col("layer_key").alias("_layer"), "spatial_layer_id")
    return references.withColumns({"classification": kind, "_layer": layer, "notes": note}).join(F.broadcast(ids), "_layer", "left").drop("_layer")


def zone_matches(zones: DataFrame, bylaws: DataFrame, plans: DataFrame, boundaries: DataFrame, size: float) -> DataFrame:
    """(zone_pk, target_feature_id, description, plan_name): boundaries of the zone's code, case aside, that meet the plan area which the bylaw's metadata name.

    ``bylaws`` hold JSON metadata, ``plans`` (plan_id, plan_name, geom), ``boundaries`` (source_feature_id, zone, description, geom).
    """
    named = bylaws.select("bylaw_pk", F.get_json_object("metadata", "$.community_plan_name").alias("plan_name")).where("plan_name is not null")
    areas = plans.join(named.select("plan_name").distinct(), "plan_name", "left_semi").select(F.col("plan_id").alias("zone_id"), F.col("geom").alias("shape"))
    met = shapes.overlaps(boundaries.select(F.col("source_feature_id").alias("parcel_id"), F.col("geom").alias("shape")), areas, size)
    met = met.select(F.col("parcel_id").alias("target_feature_id"), F.col("zone_id").alias("plan_id")).join(plans.select("plan_id", "plan_name"), "plan_id")
    coded = boundaries.select(F.col("source_feature_id").alias("target_feature_id"), F.upper("zone").alias("_code"), "description")
    asked = zones.select("zone_pk", "bylaw_pk", F.upper("zone_code").alias("_code")).join(named, "bylaw_pk").select("zone_pk", "plan_name", "_code").distinct()
    offered = met.join(coded, "target_feature_id").select("plan_name", "_code", "target_feature_id", "description").distinct()
    # the codes of a zone or boundary, as one set, are its class: classes meet first, and the pairs, which may be very many, are distinct without a shuffle of their own
    one = offered.groupBy("target_feature_id", "description", "plan_name").agg(F.array_sort(F.collect_set("_code")).alias("_codes"))
    sets = asked.groupBy("zone_pk", "plan_name").agg(F.array_sort(F.collect_set("_code")).alias("_asked"))
    classes = sets.select("plan_name", "_asked").distinct().join(one.select("plan_name", "_codes").distinct(), "plan_name").where(F.arrays_overlap("_asked", "_codes"))
    return expand(sets.join(classes, ["plan_name", "_asked"]), one, ["plan_name", "_codes"], "zone_pk").select("zone_pk", "target_feature_id", "description", "plan_name")
