"""Text extraction, layout and record operators on small fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelforge.operators import extraction, layout, records


def _lines(spark, *texts):
    return spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc int, at int, line string")


def test_wrapped_lines(spark):
    got = extraction.merge_wrapped(_lines(spark, "Uses:", "(a) homes", "and sheds", " ", None, "Parking", "None,", "Ever"), ["doc"], ["at"], "line")
    assert [r["text"] for r in got.orderBy("line_group").collect()] == ["Uses: (a) homes and sheds", "Parking", "None, Ever"]


def test_blocks_and_sections(spark):
    lines = _lines(spark, "lead", ".1 first", "more", "(a) second", "(b)", ".2 third")
    got = extraction.labelled_blocks(lines, ["doc"], ["at"], "line", r"^(\.\d+|\([a-z]\))\s*(.*)$").orderBy("block").collect()
    assert [(r["label"], r["text"]) for r in got] == [("section", "lead"), (".1", "first more"), ("(a)", "second"), (".2", "third")]
    lines = _lines(spark, "loose", "2. 1 Uses", "body", "PART 3", "2.2", "other", "2.1 Uses", "again")
    got = extraction.sections(lines, ["doc"], ["at"], "line", r"^(\d+\.\s?\d+)\s*(.*)$", "^PART").orderBy("section").collect()
    assert [(r["section"], r["title"], r["text"]) for r in got] == [(None, "", "loose"), ("2.1", "Uses", "body again"), ("2.2", "", "other")]


def test_paths(spark):
    labels = ["section", "(a)", "i)", ".2", "(b)", "ii)", "3.4", "(c)", "section", "x)", "?!"]
    rows = spark.createDataFrame([(i, "9", t) for i, t in enumerate(labels)], "at int, section string, label string").withColumn("doc", F.lit(1))
    got = extraction.clause_paths(rows, ["doc"], ["at"], "section", "label").orderBy("at").collect()
    assert [r["clause_path"] for r in got] == [["9"], ["9", "a"], ["9", "i"], ["9", "2"], ["9", "2", "b"], ["9", "2", "b", "ii"], ["3.4"], ["9", "4", "c"], ["9"], ["9", "4", "x"], None]


def test_definitions(spark):
    text = "Lot means a piece of land. Abutting Lot means short. Yard means an open space on a lot"
    got = extraction.definitions(spark.createDataFrame([(text,)], "text string"), "text").collect()
    assert [(r["term"], r["meaning"]) for r in got] == [("Lot", "a piece of land."), ("Yard", "an open space on a lot")]
    entry = lambda t: tuple(spark.range(1).select(extraction.definition_entry(F.lit(t)).alias("e")).first()["e"])
    assert entry("Sign includes boards") == ("Sign", "includes boards", "active")
    assert entry("Shed Repealed 2019") == ("Shed", "Repealed 2019", "repealed")
    assert entry("odd") == ("odd", "odd", "active")


def test_outline():
    state, out = extraction.Outline(), []
    for page, line in ((1, "noise"), (1, "12 Uses"), (1, "These:"), (1, "(a) one:"), (2, "(i) deep"), (2, "(ii) deeper"), (2, "(b) two"), (2, "900 metres"), (3, "14A Repealed")):
        out += state.feed(page, line)
    out += state.end()
    assert [(r[2], r[4], r[5]) for r in out] == [("12", "These:", "active"), ("12(a)", "one:", "active"), ("12(a)(i)", "deep", "active"), ("12(a)(ii)", "deeper", "active"), ("12(b)", "two 900 metres", "active"), ("14A", "", "active")]
    assert out[4][6:] == (2, 2) and out[0][3] == ["12"]


def test_regions_and_allowed(spark):
    got = extraction.drop_regions(_lines(spark, "a", "[1] note", "b", "Dated May", "c"), ["doc"], ["at"], "line", r"^\[", "^Dated")
    assert sorted(r["line"] for r in got.collect()) == ["a", "c"]
    ok = lambda v: spark.range(1).select(extraction.in_allowed(F.lit(v), F.array(F.lit("2")))).first()[0]
    assert (ok("2"), ok("2.1"), ok("21")) == (True, True, False)


def test_permissions(spark):
    items = spark.createDataFrame([(1, 5.0, "Shop"), (1, 100.0, "●"), (1, 160.0, "●①"), (1, 131.0, "-")], "row int, x double, text string")
    got = {r["zone"]: (r["symbols"], r["status"]) for r in extraction.permission_cells(items, ["row"], [("A", 100.0), ("B", 160.0)], "●①").collect()}
    assert got == {"A": ("●", "permitted"), "B": ("●①", "permitted_with_conditions")}
    notes = F.create_map(F.lit("①"), F.lit("corner lots"))
    assert spark.range(1).select(extraction.footnote_texts(F.lit("●①②"), notes, "●").alias("t")).first()["t"] == ["corner lots"]


def test_layout(spark):
    words = spark.createDataFrame([(1, 5.0, 10.0, "b"), (1, 1.0, 12.0, "a"), (1, 1.0, 15.5, "c"), (1, 1.0, 30.0, "d")], "page int, x double, y double, text string")
    assert [r["text"] for r in layout.word_lines(words, ["page"]).orderBy("line").collect()] == ["a b", "c", "d"]
    assert [r["text"] for r in layout.bucket_rows(words, ["page"]).orderBy("line").collect()] == ["d", "c", "a b"]
    assert layout.word_lines(words.limit(0), ["page"]).collect() == []
    blocks = spark.createDataFrame([(1, 10.0 + 320 * (i % 2), 200.0 + 320 * (i % 2), float(i), str(i)) for i in range(8)], "page int, x0 double, x1 double, y0 double, text string")
    assert [r["text"] for r in layout.reading_order(blocks, ["page"]).orderBy("place").collect()] == list("02461357")


def test_inclusion_and_merges(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "a string, b string")
    got = {(r["root"], r["member"]): (r["depth"], r["cyclic"]) for r in records.inclusion(edges).collect()}
    assert got[("a", "a")] == (3, True) and got[("d", "c")] == (3, False) and ("a", "d") not in got
    rows = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert {tuple(r) for r in records.merge_rows(rows, spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string"), ["k"]).collect()} == {(1, "x"), (2, "y"), (3, "z")}
    assert [r["k"] for r in records.delete_where(rows, F.col("v") == "x").collect()] == [2]
    names = spark.createDataFrame([(7, "p")], "id int, name string")
    assert {tuple(r) for r in records.relink(spark.createDataFrame([("p",), ("q",)], "ref string"), {"ref": (names, "name", "id")}).collect()} == {(7,), (None,)}


def test_enrichment(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "clause string")
    conditions = spark.createDataFrame([("a", "z"), ("a", "k"), ("a", "z")], "clause string, condition string")
    got = {r["clause"]: r["conditions"] for r in records.enrich(rows, "clause", rows.where("clause = 'c'"), conditions).collect()}
    assert got == {"a": ["k", "z"], "b": []}
    part = lambda *v: spark.createDataFrame([("s", at, i) for at, i in v], "section string, at int, id string")
    order = records.content_order([(part((1, "c1"), (2, "c2")), "clause"), (part((1, "t1")), "table")], "section", ["at"])
    assert [r["id"] for r in order.orderBy("place").collect()] == ["c1", "t1", "c2"]
