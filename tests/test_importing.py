"""The versioned import, migrations, staged writes and reviews on small fixtures."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from parcelforge.operators import importing, reviewing

RECORDS = "record_table string, natural_key string, content_hash string, payload string"


def _of(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_stable_json(spark):
    value = {"b": [{"y": 1, "x": None}], "a": "é", "zone_id": 3, "confidence": "needs_review", "c": {"created_at": 1, "d_id": 2, "e": 5}}
    assert _of(spark, importing.stable_json(F.lit(json.dumps(value)))) == json.dumps(value, sort_keys=True, separators=(",", ":"))
    clean = {"a": "é", "b": [{"x": None, "y": 1}], "c": {"e": 5}}
    assert _of(spark, importing.content_hash(F.lit(json.dumps(value)))) == hashlib.sha256(json.dumps(clean, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert _of(spark, importing.stable_json(F.lit(None).cast("string"))) is None
    assert _of(spark, importing.needs_review(F.lit(json.dumps(value)))) == 1


def test_import_twice(spark):
    active = spark.createDataFrame([], RECORDS + ", record_id bigint, is_active boolean, superseded_by_id bigint")
    rows = [("clause", f"current|{i}", f"h{i}", f"p{i}") for i in range(6)]
    first, log = importing.import_records(active, spark.createDataFrame(rows, RECORDS), "current", 1)
    assert {r["change_status"] for r in log.collect()} == {"added"}
    first = spark.createDataFrame(first.collect(), first.schema)
    again, log = importing.import_records(first, spark.createDataFrame(rows, RECORDS), "current", 2)
    assert {r["change_status"] for r in log.collect()} == {"unchanged"} and sorted(again.collect()) == sorted(first.collect())
    changed = [("clause", "current|0", "new", "p"), *rows[2:], rows[2]]  # 0 changes, 1 goes, 2 comes twice
    after, log = importing.import_records(first, spark.createDataFrame(changed, RECORDS), "current", 3)
    status = {r["natural_key"]: r["change_status"] for r in log.collect()}
    assert status == {"current|0": "changed", "current|1": "removed", **{f"current|{i}": "unchanged" for i in range(2, 6)}}
    after = {(r["natural_key"], r["content_hash"]): r for r in after.collect()}
    old, new, gone = after["current|0", "h0"], after["current|0", "new"], after["current|1", "h1"]
    assert not old["is_active"] and new["is_active"] and old["superseded_by_id"] == new["record_id"] and not gone["is_active"] and gone["superseded_by_id"] is None
    # the other family is out of scope
    other, log = importing.import_records(first, spark.createDataFrame([], RECORDS), "draft", 4)
    assert log.collect() == [] and other.where("is_active").count() == 6


def test_batches_and_migrations(spark, tmp_path):
    batches = importing.batch_row(spark, 1, "draft", "root").unionByName(importing.batch_row(spark, 2, "draft", "root"))
    got = {r["import_batch_id"]: r["status"] for r in importing.finish_batch(batches, 2, "completed", {"n": 1}).collect()}
    assert got == {1: "running", 2: "completed"}
    ran = []

    def fails():
        raise ValueError("no")

    steps = [("a", lambda: ran.append("a")), ("b", fails)]
    ledger = str(tmp_path / "ledger")
    with pytest.raises(ValueError, match="no"):
        importing.migrate(spark, ledger, steps)
    assert importing.migrate(spark, ledger, [steps[0], ("b", lambda: ran.append("b"))]) == ["b"] and ran == ["a", "b"]


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    importing.replace_table(spark.range(3), path)
    importing.replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="never"):
        importing.replace_table(spark.range(2).select(F.raise_error(F.lit("never")).cast("bigint").alias("id")), path)
    assert spark.read.parquet(path).count() == 5


def test_settled():
    sizes = []
    assert importing.settled(lambda size: sizes.append(size) or 10 + len(str(size or ""))) == 12 and sizes == [None, 10, 12]


def test_tables_of_sections(spark):
    sections = spark.createDataFrame([(1, "k|1"), (2, "k|2"), (3, "k|1|table|x")], "section_id long, natural_key string")
    tables = spark.createDataFrame([(10, 1, "k|1|table|a"), (11, None, "k|2|table|b"), (12, 2, "odd"), (13, None, "k|1|table|x|table|y"), (14, None, "k|9|table|z")], "raw_table_id long, section_id long, natural_key string")
    got = {(r["section_id"], r["raw_table_id"]) for r in reviewing.tables_of_sections(sections, tables).collect()}
    want = {(s, t) for s, k in ((1, "k|1"), (2, "k|2"), (3, "k|1|table|x")) for t, own, key in ((10, 1, "k|1|table|a"), (11, None, "k|2|table|b"), (12, 2, "odd"), (13, None, "k|1|table|x|table|y"), (14, None, "k|9|table|z")) if own == s or key.startswith(f"{k}|table|")}
    assert got == want


def test_section_detail_empty(spark):
    sections = spark.createDataFrame([(1, "k", "p")], "section_id long, natural_key string, path string")
    clauses = spark.createDataFrame([], "section_id long, clause_id long, label string, text string, source_order int")
    tables = spark.createDataFrame([(5, 1, "k|table|1", "T", 1)], "raw_table_id long, section_id long, natural_key string, title string, source_order int")
    cells = spark.createDataFrame([], "raw_table_id long, row_order int, column_order int, column_id string, text string")
    (row,) = reviewing.section_detail(sections, clauses, tables, cells).collect()
    assert row["clauses"] == [] and [(t["title"], t["rows"]) for t in row["tables"]] == [("T", [])]


def test_checked_members(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    assert [r["k"] for r in reviewing.checked_members(rows, rows.where("k = 2"), "k").collect()] == [2]
    with pytest.raises(Exception, match="no row for 7"):
        reviewing.checked_members(rows, spark.createDataFrame([(7,)], "k long"), "k").collect()
