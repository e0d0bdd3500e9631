"""The pipeline against a brute-force version, and rows with null or repeated ids."""

from __future__ import annotations

import hashlib
import re

import corpus_pipeline
import pytest

from parcelforge.llm import packing, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SHARED = " ".join(f"shared{i}" for i in range(55))


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus():
    calm = [f"calm words about topic {i} and " + " ".join(f"t{i}w{j}" for j in range(12 + i % 9)) for i in range(60)]
    rude = [f"you awful idiot number {i} " + " ".join(f"r{i}w{j}" for j in range(8)) for i in range(20)]
    texts = calm + rude
    texts += [calm[0].upper(), calm[0], None, "", "  ", calm[1] + " end", SHARED + " first " + calm[2], "lead " + SHARED + " second", "é" * 30_000, " ".join(f"long{i}" for i in range(9_000))]
    near = " ".join(f"n{i}" for i in range(80))
    texts += [near, near + " tail", "head " + near]
    return [(i, t) for i, t in enumerate(texts)]


def brute(rows, network):
    kept = []
    for i, t in rows:  # toxicity: the score of the whole text alone
        data, offsets = toxicity._layout([t or ""])
        if network.scores(data, offsets)[0] < 0.5:
            kept.append((i, t))
    top = {}
    for i, t in kept:
        top[low(t)] = max(i, top.get(low(t), i))
    kept = [(i, t) for i, t in kept if top[low(t)] == i]
    sets = {}
    for i, t in kept:
        w = WORD.findall(low(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    kept = [(i, t) for i, t in kept if label[i] == i]
    starts = {}
    for i, t in sorted(kept):
        w = WORD.findall(t or "")
        for j in range(len(w) - 49):
            starts.setdefault(tuple(w[j : j + 50]), i)
    out = {}
    for i, t in kept:
        w = WORD.findall(t or "")
        gone = {k for j in range(len(w) - 49) if starts[tuple(w[j : j + 50])] < i for k in range(j, j + 50)}
        out[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t or ""
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(60 <= i < 80)) for i in range(80)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline(spark, folder):
    network = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    want = brute(corpus(), network)
    assert not {i for i in want if 60 <= i < 80} and len(want) > 50  # the rude go, the calm stay
    assert 0 not in want and 81 in want and 82 not in want and 83 in want and 84 in want  # of equal texts the largest id stays
    pieces = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        body = r["content"].encode()
        assert len(body) == r["used"] <= r["size"] and r["size"] in packing.SIZES
        for i, piece, offset, length in zip(r["doc_ids"], r["pieces"], r["offsets"], r["lengths"], strict=True):
            pieces.setdefault(i, []).append((piece, body[offset : offset + length]))
    # every byte of the text that is left stands in one place
    assert {i: b"".join(x for _, x in sorted(own)).decode() for i, own in pieces.items()} == want


def test_stages_keep_texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    network = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = brute(corpus(), network)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in docs.collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_null_and_repeated_ids(spark, folder):
    rows = [(None, "same text here", "en", "s", 1), (7, "same text here", None, None, None), (5, "Other text", "en", "s", 1), (9, "other text", "en", "s", 1), (5, "its own text", "en", "s", 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    exact = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_copies(spark, docs, folder).collect())
    assert exact == [(5, "its own text"), (7, "same text here"), (9, "other text")]
    near = [(r["doc_id"], r["component_id"], r["kept"]) for r in corpus_pipeline.neardup.near_duplicates(docs).collect() if r["doc_id"] in (None, 7)]
    assert sorted(near, key=str) == [(7, 7, True), (None, 7, False)]
    assert sum(r["n_words"] for r in corpus_pipeline.repeats.deduplicate(docs).collect()) == 13


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_near_copies_by_id_and_text(spark, folder):
    near = " ".join(f"n{i}" for i in range(80))
    rows = [(None, near, "en", "s", 1), (7, near + " tail", None, None, None), (7, "quite another text that shares the id", "en", "s", 1), (9, near + " tail", "en", "t", 1), (None, "alone with no id", "en", "s", 1), (12, None, "en", "s", 0), (13, "", "en", "s", 0)]
    kept = sorted((str(r["doc_id"]), r["text"] or "") for r in corpus_pipeline.drop_near_copies(spark, table(spark, rows), folder).collect())
    assert kept == [("12", ""), ("13", ""), ("7", near + " tail"), ("7", "quite another text that shares the id"), ("None", "alone with no id")]


def test_every_stage_takes_an_empty_table(spark, folder):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, []), folder).collect() == [], name


def test_clashing_columns_and_null_labels(spark, folder, tmp_path):
    rows = [(i, f"calm text number {i} " + " ".join(f"w{i}x{j}" for j in range(9)), "en", "s", 1, "x", 2, "y") for i in range(12)]
    docs = spark.createDataFrame(rows, COLUMNS + ", _digest string, kept int, _toxicity string")
    spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r["doc_id"] for r in out.collect()} == set(range(12))
    assert {i for r in corpus_pipeline.pack(spark, docs, str(tmp_path)).collect() for i in r["doc_ids"]} == set(range(12))
