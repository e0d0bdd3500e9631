"""Training-data operators: brute force, libraries and edge cases on small fixtures."""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from parcelforge.llm import bytebpe, chat, exactdup, graph, licences, neardup, packing, repeats, simhash, tokencount, toxicity

SCHEMA = "doc_id bigint, text string, n bigint, fp string, places string"
PASSAGE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, "The quick brown fox " + PASSAGE), (2, "the QUICK brown fox " + PASSAGE), (3, "the QUICK brown fox " + PASSAGE), (4, None), (5, ""), (6, "  \t\n"),
    (7, "one"), (8, "a " + PASSAGE + " b"), (9, "Released under the MIT License. " * 3), (10, "é" * 40_000), (11, "x y " * 20_000), (12, "a <|endoftext|> b"), (12, "a <|endoftext|> b"),
    (13, "x y " * 20_000 + "z"),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "clash", None) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _ops():
    path, many = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
    return {
        "tokens": lambda d: tokencount.count_tokens(d, path, P.PATTERN),
        "bpe": lambda d: bytebpe.round_trip(d, many, P.PATTERN),
        "simhash": lambda d: simhash.fingerprint_report(d),
        "exact": lambda d: exactdup.deduplicate(d),
        "near": lambda d: neardup.near_duplicates(d),
        "repeats": lambda d: repeats.deduplicate(d),
        "licences": lambda d: licences.scan(d),
        "packing": lambda d: packing.pack_documents(d),
        "toxicity": lambda d: toxicity.score(d, toxicity.train(["good", "bad idiot"] * 20, [0, 1] * 20)),
    }


@pytest.mark.parametrize("name", sorted(_ops()))
def test_empty_table_gives_empty_result(empty, name):
    assert _ops()[name](empty).collect() == []


@pytest.mark.parametrize("name", sorted(set(_ops()) - {"packing"}))
def test_one_result_per_row(docs, name):
    assert sorted(r["doc_id"] for r in _ops()[name](docs).collect()) == sorted(i for i, _ in ROWS)


def test_tokens_match_the_libraries(docs):
    import tiktoken
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in tokencount.count_tokens(docs, P.path("byte_bpe_50k.json"), P.PATTERN).collect():
        text = dict(ROWS)[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(lib.encode(text, add_special_tokens=False).ids))
    many = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(many, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bytebpe.round_trip(docs, many, P.PATTERN).collect():
        text = dict(ROWS)[r["doc_id"]] or ""
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, enc.encode_ordinary(text))).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_exact(docs):
    got = {r["doc_id"]: r for r in exactdup.deduplicate(docs).collect()}
    assert [(got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) for i in (1, 2, 3, 4, 5, 7)] == [(3, 3, False), (3, 3, False), (3, 3, True), (5, 2, False), (5, 2, True), (7, 1, True)]
    assert got[12]["group_size"] == 2 and got[1]["text_sha256"] == hashlib.sha256(low(ROWS[0][1]).encode()).hexdigest()


def test_binary_fuse():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    fuse = exactdup.BinaryFuse.build(keys)
    assert fuse.contains(keys).all() and fuse.contains(keys + np.uint64(7)).mean() < 0.01
    assert exactdup.BinaryFuse.build(keys[:0]).contains(keys).sum() <= 1000


@pytest.mark.parametrize("shingle", [2, 5])
def test_near(docs, shingle):
    sets, links = {}, {}
    for i, t in ROWS:
        w = WORD.findall(low(t))
        sets[i] = {tuple(w[j : j + shingle]) for j in range(max(1, len(w) - shingle + 1))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs, shingle=shingle).collect()}
    assert got == {i: (len(sets[i]), label[i]) for i in sets}


def test_sketches():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 2**63, 100, dtype=np.uint64)]))
    both = np.unique(np.concatenate([a, b]))
    one, two, union = (neardup.registers(x, np.array([len(x)])) for x in (a, b, both))
    assert (neardup.merge(one, two) == union).all()
    true = len(np.intersect1d(a, b)) / len(both)
    assert abs(neardup.estimate(one, two, np.array([len(a)]), np.array([len(b)]))[0] - true) < 0.12


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (51, 51)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 51: 50}


def test_repeats(docs):
    seen, want = {}, {}
    for i, t in sorted(ROWS, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        keep = [True] * len(w)
        for j in range(len(w) - 49):
            if seen.setdefault(tuple(w[j : j + 50]), i) < i:
                keep[j : j + 50] = [False] * 50
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        want[i] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:4] for r in repeats.deduplicate(docs).collect()}
    assert got == want


def test_simhash(spark, docs):
    got = {r["doc_id"]: r for r in simhash.fingerprint_report(docs).collect()}
    assert got[4]["fingerprint"] == got[5]["fingerprint"] == "0" * 16 and got[2]["fingerprint"] == got[3]["fingerprint"]
    text = dict(ROWS)
    for i, nxt in ((1, 2), (7, 8), (10, 11), (13, 1)):
        half = len(text[i]) // 2
        edited = text[i][: len(text[i]) - half] + text[nxt][:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, 30)
    prints = [int(x) ^ int(m) for x in base for m in (0, 1, 5, 1 << 40 | 3, 15)]
    index = spark.createDataFrame([(p, 1) for p in set(prints)], "fp long, n long")
    found = {(r["query"], r["fp"]) for r in simhash.within_radius(index, index.select("fp")).collect()}
    assert found == {(a, b) for a in set(prints) for b in set(prints) if bin((a ^ b) & (2**64 - 1)).count("1") <= 3}


def test_licences(docs):
    got = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    assert (got[9]["n_base"], got[9]["first_word"], got[9]["last_word"], got[9]["labels"], got[9]["score"]) == (3, 3, 13, "mit", 1.0)
    assert (got[4]["n_words"], got[4]["first_word"], got[4]["labels"], got[4]["score"]) == (0, None, "", 0.0)
    form = licences.Automaton("licensed under [[the nice]] terms of {{who:1-2}} here")
    for text, want in (("licensed under terms of us here", True), ("licensed under the nice terms of you all here", True), ("licensed under the terms of us here", False), ("licensed under terms of a b c here", False)):
        words = licences.hash_words(text.split())
        assert form.accepts(words, 0, len(words)) is want


def test_chat(spark):
    rows = [(1, 1, "assistant", "<s>[ANS]\nx\n[/ANS]</s>"), (1, 0, "user", "\\[INST] and \\\\</s>"), (1, 2, "tool é", None), (2, 0, None, "[ROLE ff]"), (3, 0, "system", "\\")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for conv in (1, 2, 3):
        turns = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])]
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest()
    with pytest.raises(ValueError):
        chat.parse("<s>[INST]\nno end")


def test_toxicity_learns():
    rng = np.random.default_rng(0)
    words = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(400):
        w = list(rng.choice(words, 120))
        if i % 4 == 0:
            w[int(rng.integers(120))] = f"nasti{rng.choice(['er', 'ly', 'st', 'ness'])}"
        texts.append(" ".join(w))
        labels.append(int(i % 4 == 0))
    net = toxicity.train(texts[:300], labels[:300])
    got = net.scores(*toxicity._layout(texts[300:])) >= 0.5
    assert (got == np.array(labels[300:], dtype=bool)).mean() > 0.95
    assert toxicity.train(["a"], [0]).scores(*toxicity._layout(["", "x"])).tolist() == [1 / 3, 1 / 3]


def test_toxicity_gradients():
    net = toxicity.Network(1)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    words = toxicity.Words(*toxicity._layout(["this is a short text of some words " * 6]))
    ids, _ = words.windows()
    table, cache = net.inputs(words), {}
    net.forward(table, ids, cache)
    grads = net.backward(words, table, ids, cache, np.ones(len(ids)))
    for k, at in (("Uf", (1, 2)), ("Wb", (3, 5)), ("A", (2, 1)), ("a", (0,)), ("o", (4,)), ("bf", (7,))):
        keep, step = net.p[k][at], 1e-3
        net.p[k][at] = keep + step
        up = net.forward(net.inputs(words), ids).sum()
        net.p[k][at] = keep - step
        down = net.forward(net.inputs(words), ids).sum()
        net.p[k][at] = keep
        assert abs((up - down) / (2 * step) - grads[k][at]) < 1e-2 * max(1, abs(grads[k][at]))


def test_near_long_sets(spark):
    """Sets kept in parts: pairs of one level and over a level, and one that shares its id with another text."""
    base = [f"w{i}" for i in range(70_000)]
    rows = [(1, base), (2, base[:64_000]), (3, base[:60_000] + [f"z{i}" for i in range(10_000)]), (4, base[:50_000] + [f"y{i}" for i in range(20_000)]), (4, ["short", "text"]), (4, ["short", "text"])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for _, w in rows]
    linked = {(a, b) for a in range(3) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked == {(1, 0), (2, 1)} and 100 * len(sets[3] & sets[0]) < 80 * len(sets[3] | sets[0])
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect())
    assert got == [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (4, 4, True), (4, 4, True)]


def test_near_null_and_repeated_ids(spark):
    near = " ".join(f"n{i}" for i in range(80))
    rows = [(None, near), (7, near + " tail"), (7, "quite another text that stays"), (None, "alone"), (None, "lead " + PASSAGE), (None, PASSAGE + " tail"), (9, near + " tail")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, k int")
    got = {r["_carry"]["k"]: (r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, carry=["k"]).collect()}
    assert {k: got[k] for k in (0, 1, 2, 3, 6)} == {0: (7, False), 1: (7, True), 2: (7, True), 3: (None, True), 6: (7, False)}
    assert sorted(got[k][1] for k in (4, 5)) == [False, True] and got[4][0] is got[5][0] is None


def test_exact_split_by_bytes(docs, monkeypatch):
    """One digest for several texts: the classes are those of the texts."""
    monkeypatch.setattr(exactdup, "digests", lambda d, **k: _short_digests(d, **k))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exactdup.deduplicate(docs).collect()}
    monkeypatch.undo()
    assert got == {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exactdup.deduplicate(docs).collect()}


def _short_digests(documents, *, id_col="doc_id", text_col="text", with_text=False):
    rows = documents.select(F.col(id_col).alias("id"), exactdup._normalised(F.col(text_col)).alias("norm"))
    return rows.select("id", F.sha2(F.substring("norm", 1, 1), 256).alias("digest"), *["norm"] * with_text)


def word_hash(word):
    import xxhash

    return xxhash.xxh64(word.encode(), seed=42).intdigest()


def plain_fingerprint(text):
    """Each word votes with its weight for the bits of its hash; a bit is set by more than half of the weight."""
    votes, total = [0] * 64, 0
    for word in WORD.findall(text):
        weight = 1 if len(word) <= 3 else len(word)
        total += weight
        for j in range(64):
            votes[j] += weight * (word_hash(word) >> j & 1)
    return sum(1 << j for j in range(64) if 2 * votes[j] > total)


def test_simhash_equals_plain_votes(docs):
    rows = sorted({i: t or "" for i, t in ROWS}.items())
    want = {}
    for k, (i, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        one, two, three = (plain_fingerprint(t) for t in (text, edited, nxt))
        want[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{one:016x}", f"{two:016x}", 1 - (one ^ two).bit_count() / 64, 1 - (one ^ three).bit_count() / 64)
    got = {r["doc_id"]: tuple(r[c] for c in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")) for r in simhash.fingerprint_report(docs.dropDuplicates(["doc_id"])).collect()}
    assert got == want
    near = {i: sum((int(want[i][2], 16) ^ int(w[2], 16)).bit_count() <= 3 for w in want.values()) for i in want if i % 100 == 0}
    found = {r["doc_id"]: r["n_near"] for r in simhash.fingerprint_report(docs.dropDuplicates(["doc_id"])).collect()}
    assert {i: found[i] for i in near} == near and all(found[i] is None for i in want if i % 100)
