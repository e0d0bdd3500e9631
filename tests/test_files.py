"""Scans, sinks and the incremental import on files."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from parcelforge.sources import files
from parcelforge.streaming.ingest import import_stream


def test_scans(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text(json.dumps({"k": 1}))
    (tmp_path / "in" / "deep" / "b.json").write_text("[1]")
    (tmp_path / "in" / "manifest.json").write_text("{}")
    assert [r["name"] for r in files.json_documents(spark, str(tmp_path / "in")).collect()] == ["a.json"]
    assert files.inventory(spark, str(tmp_path / "in")).count() == 3
    lines = files.page_lines(spark.createDataFrame([(1, "x\ny")], "page int, text string")).collect()
    assert [(r["line_no"], r["line"]) for r in lines] == [(0, "x"), (1, "y")]
    files.write_csv(spark.createDataFrame([("a", 1)], "k string, n int").coalesce(1), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert text == '"k","n"\n"a","1"\n'


def test_replayed_import_is_unchanged(spark, tmp_path):
    schema = "natural_key string, content_hash string"
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], schema)
    rows.withColumn("is_active", F.lit(True)).write.parquet(str(tmp_path / "active"))
    spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4")], schema).write.parquet(str(tmp_path / "source"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "source"))
    import_stream(spark, source, str(tmp_path / "active"), str(tmp_path / "events"), str(tmp_path / "mark")).awaitTermination(60)
    got = {r["natural_key"]: r["change_status"] for r in spark.read.parquet(str(tmp_path / "events")).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "added"}
