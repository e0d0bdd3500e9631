"""Registered queries of sources and sinks: each writes a table in the form in question and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelforge import scratch
from parcelforge.functions import classify
from parcelforge.operators import importing, records, registration, shapes
from parcelforge.registry import register, table
from parcelforge.sources import files
from parcelforge.streaming import ingest


def _documents(spark, sf_dir, *levels: str) -> str:
    """One JSON file for each nation below the folders, in one file each."""
    root = scratch.folder(spark, "documents")
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    for at, level in enumerate(levels):
        rows.where(F.col("id") % len(levels) == at).coalesce(1).write.option("maxRecordsPerFile", 1).json(f"{root}/{level}")
    return root


@register("SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation")
def json_scan(spark, sf_dir):
    root = _documents(spark, sf_dir, "zones", "zones/deep", "schedules")
    payload = files.json_documents(spark, root, strict=True).select(F.from_json("payload", "id bigint, name string").alias("p"))
    return payload.select("p.id", "p.name")


@register("SELECT n_nationkey::BIGINT AS id, CASE n_nationkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 END AS depth, CASE WHEN n_nationkey % 4 < 2 THEN 0 ELSE 1 END AS root_rank FROM nation WHERE n_nationkey % 4 < 3")
def two_level_scan(spark, sf_dir):
    root = _documents(spark, sf_dir, "one/a", "one/a/b", "two/a", "two/a/b/c")
    found = files.two_levels(spark, [f"{root}/one", f"{root}/two"])
    return found.select(F.get_json_object("payload", "$.id").cast("bigint").alias("id"), "depth", "root_rank")


@register("SELECT n_nationkey::BIGINT AS id, length('{\"id\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}') + 1 AS size, sha256('{\"id\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}' || chr(10)) AS sha256 FROM nation")
def file_inventory(spark, sf_dir):
    root = _documents(spark, sf_dir, "zones")
    listed = files.inventory(spark, root).where(F.endswith("path", F.lit(".json"))).select(F.substring_index("path", "/", -1).alias("name"), "size", "sha256")
    known = files.json_documents(spark, root).select("name", F.get_json_object("payload", "$.id").cast("bigint").alias("id"))
    return listed.join(known, "name").select("id", "size", "sha256")


@register("SELECT 'land_use_regulation' AS domain, 'zoning_map' AS kind, 'png' AS extension, 'ocr_required,georeference_needed,legend_parsing_needed' AS hints, 1::BIGINT AS n")
def source_walk(spark, sf_dir):
    root = scratch.folder(spark, "sources")
    table(spark, sf_dir, "region").select(F.lit("x").alias("value")).limit(1).coalesce(1).write.text(f"{root}/docs/Zoning Map/sheet.png.d")
    spark.range(1).select(F.lit("x")).coalesce(1).write.text(f"{root}/node_modules/a")
    # a file of the wanted name: the written part, renamed
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(str(s.getPath()) for s in system.listStatus(hadoop(f"{root}/docs/Zoning Map/sheet.png.d")) if "part-" in str(s.getPath()))
    system.rename(hadoop(part), hadoop(f"{root}/docs/Zoning Map/sheet.png"))
    found = files.classified_sources(spark, root)
    return found.groupBy("domain", "kind", "extension", F.array_join("extraction_hints", ",").alias("hints")).agg(F.count(F.lit(1)).alias("n"))


@register("""SELECT n_nationkey AS id, '{' || chr(10) || '  "a": {' || chr(10) || '    "k": ' || n_nationkey || chr(10) || '  },' || chr(10) || '  "name": "' || n_name || '"' || chr(10) || '}' AS body FROM nation""")
def json_sink(spark, sf_dir):
    path = scratch.folder(spark, "json")
    payload = F.to_json(F.struct(F.col("n_name").alias("name"), F.struct(F.col("n_nationkey").alias("k")).alias("a")))
    rows = table(spark, sf_dir, "nation").select(F.rtrim(files.pretty(payload), F.lit("\n")).alias("body"), F.col("n_nationkey").alias("id"))
    files.write_json(rows, path)
    return spark.read.schema("id int, body string").json(path)


@register("SELECT p_partkey::VARCHAR AS part, p_name AS name, CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR END AS size, NULL::VARCHAR AS missing FROM part")
def csv_sink(spark, sf_dir):
    path = scratch.folder(spark, "csv")
    rows = table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("size"), F.col("p_partkey").alias("part"), F.col("p_name").alias("name"), F.lit(1).alias("extra"))
    files.write_csv(rows, path, ["part", "name", "size", "missing"])
    return spark.read.option("header", True).csv(path)


@register("SELECT p_brand AS brand, count(*)::VARCHAR AS n FROM part GROUP BY 1")
def csv_summary(spark, sf_dir):
    path = scratch.folder(spark, "summary")
    rows = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("n")).withColumn("geometry", F.array(F.array(F.lit(1.0))))
    files.write_summary(rows, path, ["brand"])
    return spark.read.option("header", True).csv(path)


@register("SELECT p_partkey, p_name, 'second' AS load FROM part WHERE p_size % 2 = 0")
def full_reload(spark, sf_dir):
    path = scratch.folder(spark, "reload")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    files.reload_table(part.drop("p_size").withColumn("load", F.lit("first")), path)
    files.reload_table(part.where("p_size % 2 = 0").drop("p_size").withColumn("load", F.lit("second")), path)
    return spark.read.parquet(path)


@register("SELECT o_orderkey AS k, 'third' AS load FROM orders WHERE o_orderkey % 3 = 0")
def staged_replace(spark, sf_dir):
    path = scratch.folder(spark, "staged")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    for name, keep in (("first", "k % 2 = 0"), ("third", "k % 3 = 0")):
        importing.replace_table(rows.where(keep).withColumn("load", F.lit(name)), path)
    try:  # a write that fails leaves the table as it was
        importing.replace_table(rows.select("k", F.assert_true(F.col("k") < 0).cast("string").alias("load")), path)
    except Exception as error:
        if "k < 0" not in str(error) and "USER_RAISED" not in str(error) and "is not true" not in str(error):
            raise
    return spark.read.parquet(path)


@register("SELECT unnest(['one', 'two', 'three']) AS name, unnest([1, 1, 2]) AS run")
def migrations(spark, sf_dir):
    path, done = scratch.folder(spark, "ledger"), []
    steps = [(name, lambda name=name: done.append(name)) for name in ("one", "two", "three")]
    first = importing.migrate(spark, path, steps[:2])
    second = importing.migrate(spark, path, steps)
    assert done == ["one", "two", "three"]
    return spark.createDataFrame([(n, 1) for n in first] + [(n, 2) for n in second], "name string, run int")


@register("SELECT 5 AS writes, 104 AS size")
def settled_size(spark, sf_dir):
    """A manifest that states its own size: the digits settle after few writes; one that grows with each write ends at the limit."""
    def write(size):
        return 101 + len(str(size or ""))

    def grow(size):
        grow.calls += 1
        return (size or 0) + 1

    grow.calls = 0
    importing.settled(grow)
    return spark.createDataFrame([(grow.calls, importing.settled(write))], "writes int, size int")


@register("SELECT p_partkey AS id, (p_partkey % 50)::DOUBLE AS x0 FROM part WHERE p_partkey % 50 < 10")
def clustered_view(spark, sf_dir):
    path = scratch.folder(spark, "view")
    x, y = F.col("p_partkey") % 50 * 1.0, F.col("p_size") * 1.0
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), shapes.make_envelope(x, y, x + 0.5, y + 0.5).alias("geom"))
    registration.materialise(rows, path, 5.0)
    return spark.read.parquet(path).where("x0 < 10").select("id", "x0")


@register("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS old, o_orderkey % 3 = 0 AS new, o_orderkey % 5 = 0 AS differs FROM orders) SELECT k::VARCHAR AS natural_key, CASE WHEN NOT old THEN 'added' WHEN differs THEN 'changed' ELSE 'unchanged' END AS change_status FROM o WHERE new""")
def streamed_import(spark, sf_dir):
    root = scratch.folder(spark, "stream")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("natural_key"))
    rows.where("k % 2 = 0").select("natural_key", F.lit("h").alias("content_hash"), F.lit(True).alias("is_active")).write.parquet(f"{root}/active")
    rows.where("k % 3 = 0").select("natural_key", F.when(F.col("k") % 5 == 0, "d").otherwise("h").alias("content_hash")).write.parquet(f"{root}/incoming")
    source = spark.readStream.schema("natural_key string, content_hash string").parquet(f"{root}/incoming")
    ingest.import_stream(spark, source, f"{root}/active", f"{root}/events", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/events").select("natural_key", "change_status")


@register("SELECT n_nationkey::BIGINT AS id, n_name AS name, 4.0::DOUBLE AS area FROM nation")
def geopackage_layer(spark, sf_dir):
    from parcelforge.sources.geopackage import GeoPackage

    spark.dataSource.register(GeoPackage)
    path = scratch.folder(spark, "zones").removeprefix("file://")
    box = shapes.make_envelope(F.col("n_nationkey") * 1.0, F.lit(0.0), F.col("n_nationkey") + 2.0, F.lit(2.0))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), box.alias("geom"))
    rows.write.format("geopackage").option("layer", "zones").mode("append").save(path)
    found = spark.read.format("geopackage").option("layer", "zones").load(path)
    return found.select("id", "name", F.round(shapes.area(F.col("geom")), 6).alias("area"))


@register("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'gis_layer' ELSE 'unknown' END AS source_type FROM part""")
def source_types(spark, sf_dir):
    path = F.concat(F.lit("a.b/x"), F.col("p_partkey"), F.element_at(F.array(F.lit(".PDF"), F.lit(".gpkg"), F.lit("")), (F.col("p_partkey") % 3 + 1).cast("int")))
    return table(spark, sf_dir, "part").select("p_partkey", classify.source_type(path).alias("source_type"))


@register("""SELECT 'a' AS family, count(*) AS n FROM part UNION ALL SELECT 'b', count(*) FROM supplier""")
def bundle_counts(spark, sf_dir):
    from parcelforge.operators import documents

    return documents.bundle_stats({"a": table(spark, sf_dir, "part"), "b": table(spark, sf_dir, "supplier")})


@register("""SELECT l_orderkey, count(*) AS n, count(*) FILTER (o_orderkey IS NULL) AS unknown FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def relinked_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("k"), "o_orderkey").alias("natural"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("k"), "l_orderkey").alias("ref"))
    found = records.relink(rows, {"ref": (orders, "natural", "o_orderkey")})
    return found.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ref").isNull()).alias("unknown"))
