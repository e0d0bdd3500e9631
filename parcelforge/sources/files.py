"""Document scans and sinks."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parcelforge.functions import classify


def json_documents(spark: SparkSession, root: str, skip: tuple[str, ...] = ("manifest.json",), strict: bool = False) -> DataFrame:
    """(path, name, payload) of all JSON objects below a folder, but for the names skipped.

    Files that do not parse, or hold no object, are left out; with ``strict`` the query fails on one.
    """
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("payload"))
    rows = rows.where(~F.col("name").isin(*skip))
    whole = F.startswith(F.schema_of_variant(F.try_parse_json("payload")), F.lit("OBJECT"))
    if strict:
        return rows.where(F.assert_true(F.coalesce(whole, F.lit(False)), F.concat(F.col("path"), F.lit(" is not a JSON object"))).isNull())
    return rows.where(F.coalesce(whole, F.lit(False)))


def rejected_documents(spark: SparkSession, root: str) -> DataFrame:
    """(path, name) of the JSON files that do not parse or hold no object."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    whole = F.startswith(F.schema_of_variant(F.try_parse_json("value")), F.lit("OBJECT"))
    return rows.where(~F.coalesce(whole, F.lit(False))).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"))


def two_levels(spark: SparkSession, roots: list[str], pattern: str = "*.json") -> DataFrame:
    """(root_rank, depth, path, payload) of the files one and two folders below each root; ordered by root, depth and path they are in reading order."""
    out = None
    for rank, root in enumerate(roots):
        rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
        tail = re.sub(r"^[a-z0-9]+:/*", "/", root).rstrip("/") + "/"
        below = F.size(F.split(F.substring_index(F.col("_metadata.file_path"), tail, -1), "/")) - 1
        rows = rows.select(F.lit(rank).alias("root_rank"), below.alias("depth"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload")).where("depth BETWEEN 1 AND 2")
        out = rows if out is None else out.unionByName(rows)
    return out


def classified_sources(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("pdf", "png", "jpg", "jpeg", "tif", "tiff"), skip: tuple[str, ...] = (".git", "node_modules")) -> DataFrame:
    """(path, filename, extension, bytes, domain, kind, extraction_hints) of source files below a folder, without those in skipped folders; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.col("path"), F.col("length").alias("bytes"))
    found = rows.select("path", classify.path_parts(F.col("path"))[1].alias("filename"), classify.extension(F.col("path")).alias("extension"), "bytes", classify.source_class(F.col("path")).alias("_c"))
    parts = F.split("path", "/")
    kept = found.where(F.col("extension").isin(*extensions) & ~F.arrays_overlap(parts, F.array(*[F.lit(s) for s in skip])))
    return kept.select("path", "filename", "extension", "bytes", "_c.domain", "_c.kind", classify.extraction_hints(F.col("_c.kind"), F.col("extension")).alias("extraction_hints"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, modified, sha256) of all files below a folder."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return rows.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def printed_pages(pages: DataFrame, text: str, pattern: str) -> DataFrame:
    """Pages with ``printed_page``, the number that ``pattern`` (its first group) finds in the text, and the text without lines that are nothing but it."""
    lines = F.filter(F.split(text, "\n"), lambda line: ~F.trim(line).rlike(f"^(?:{pattern})$"))
    return pages.withColumns({"printed_page": F.regexp_extract(text, pattern, 1).try_cast("int"), text: F.array_join(lines, "\n")})


def geojson_shapes(documents: DataFrame, payload: str) -> DataFrame:
    """(path, place, shape, properties): polygons of FeatureCollections, each part of a multi-polygon with its rings, closing points dropped."""
    feature = "struct<geometry:struct<type:string,coordinates:string>,properties:string>"
    parsed = F.from_json(payload, f"struct<features:array<{feature}>>")
    rows = documents.select("path", F.posexplode(parsed["features"]).alias("place", "_f"))
    one = F.array(F.from_json(F.col("_f.geometry.coordinates"), "array<array<array<double>>>"))
    many = F.from_json(F.col("_f.geometry.coordinates"), "array<array<array<array<double>>>>")
    kind = F.col("_f.geometry.type")
    rings = F.flatten(F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many))
    open_rings = F.transform(rings, lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r))
    return rows.select("path", "place", open_rings.alias("shape"), F.col("_f.properties").alias("properties")).where("shape is not null")


def page_lines(pages: DataFrame, text: str = "text") -> DataFrame:
    """One row per line with its place from 0."""
    return pages.select("*", F.posexplode(F.split(text, "\n")).alias("line_no", "line")).drop(text)


def write_csv(rows: DataFrame, path: str, header: list[str] | None = None) -> None:
    """All fields quoted, with a header; ``header`` fixes the columns and their order, missing ones are empty."""
    if header is not None:
        rows = rows.select(*[F.col(c).cast("string") if c in rows.columns else F.lit("").alias(c) for c in header])
    rows.write.mode("overwrite").option("quoteAll", True).option("header", True).csv(path)


def write_summary(rows: DataFrame, path: str, order: list[str], without: str = "geometry") -> None:
    """A summary table: no shapes, sorted, in one file."""
    rows.drop(without).orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def pretty(payload: Column) -> Column:
    """JSON text with sorted keys, indented by two, as documents are kept in folders."""

    @F.pandas_udf(StringType())
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else json.dumps(json.loads(t), indent=2, sort_keys=True, ensure_ascii=False) + "\n")

    return form(payload)


def reload_table(rows: DataFrame, path: str) -> None:
    """The table holds these rows and no others."""
    rows.write.mode("overwrite").parquet(path)


def mosaic(tiles: DataFrame, size: int) -> DataFrame:
    """(row, col, r, g, b) of a picture in tiles (tile_row, tile_col, content: rows of three bytes a pixel, ``size`` pixels wide)."""
    at = F.sequence(F.lit(0), F.floor(F.octet_length("content") / 3).cast("int") - 1)
    rows = tiles.where(F.octet_length("content") >= 3).select("tile_row", "tile_col", "content", F.explode(at).alias("_i"))
    value = lambda k: F.conv(F.hex(F.substring("content", F.col("_i") * 3 + k + 1, F.lit(1))), 16, 10).cast("int")
    return rows.select(
        (F.col("tile_row") * size + F.floor(F.col("_i") / size)).alias("row"), (F.col("tile_col") * size + F.col("_i") % size).alias("col"), value(0).alias("r"), value(1).alias("g"), value(2).alias("b")
    )
