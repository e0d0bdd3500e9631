"""Best-fit packing against a plain best-fit packer, against the least possible cost, and its contents against the rows."""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from parcelforge.llm import packing

SCHEMA = "doc_id bigint, text string, ids string, content int"


def cost(size):
    return size + size * size / packing.KNEE + packing.BIN_COST


def plain_best_fit(lengths, sizes):
    """The rule in words, by loops: longest first, ties by place; the fullest open bin that fits, the older of equals; else the cheapest new one."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    opened, held = [], []
    for k, i in enumerate(order):
        fitting = [(size - used, b) for b, (size, used) in enumerate(opened) if size - used >= lengths[i] and size > used]
        if fitting:
            b = min(fitting)[1]
        else:
            rest, options = sorted(lengths[j] for j in order[k + 1 :]), []
            for size in sizes:
                if size >= lengths[i]:
                    filled, taken = lengths[i], 0
                    for x in rest:  # the shortest pieces still to come that would fit one by one
                        if x > size - lengths[i]:
                            break
                        taken += x
                    options.append((cost(size) / max(min(size, filled + taken), 1), size))
            b = len(opened)
            opened.append([min(options)[1], 0])
            held.append([])
        opened[b][1] += lengths[i]
        held[b].append(i)
    return [(min(s for s in sizes if s >= used), used, own) for (_, used), own in zip(opened, held, strict=True)]


@pytest.mark.parametrize("seed", range(12))
def test_equals_plain_best_fit(seed):
    rng = np.random.default_rng(seed)
    sizes = (8, 20, 50)
    lengths = rng.integers(0 if seed % 2 else 1, 51, rng.integers(1, 60))
    bins, offsets, size = packing.pack(lengths, sizes)
    for b, (want, used, own) in enumerate(plain_best_fit(lengths.tolist(), sizes)):
        assert sorted(own) == np.flatnonzero(bins == b).tolist() and set(size[own]) == {want}
        assert offsets[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist() and used <= want
    assert bins.max() == len(plain_best_fit(lengths.tolist(), sizes)) - 1


def test_near_the_least_cost():
    """All partitions of six pieces: the packer's cost is never over 1.5 times the least one."""
    sizes, rng = (8, 20, 50), np.random.default_rng(3)
    for _ in range(40):
        lengths = rng.integers(1, 51, 6)
        least = min(
            sum(cost(min(s for s in sizes if s >= x)) for x in sums.values())
            for deal in product(range(6), repeat=6)
            if max((sums := Counter({b: sum(int(lengths[i]) for i in range(6) if deal[i] == b) for b in set(deal)})).values()) <= 50
        )
        bins, _, size = packing.pack(lengths, sizes)
        assert sum(cost(int(size[bins == b][0])) for b in np.unique(bins)) <= 1.5 * least


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(3)


def check(got, rows, unit):
    """Every token of every row stands in one place, in a sequence of the least size that holds it."""
    back = {}
    for r in got:
        assert r["used"] == len(unit(r["content"])) <= r["size"] and r["size"] == min(s for s in packing.SIZES if s >= r["used"])
        at = 0
        for i, row, piece, start, offset, length in zip(*(r[c] for c in ("ids", "rows", "pieces", "starts", "offsets", "lengths")), strict=True):
            assert offset == at
            back.setdefault((i, row), []).append((piece, start, unit(r["content"])[offset : offset + length]))
            at += length
        assert at == r["used"]
    texts = []
    for (i, _), pieces in back.items():
        copies = len([p for p in pieces if p[0] == 0])
        whole = sorted(set(pieces))
        assert len(pieces) == copies * len(whole) and [p[0] for p in whole] == list(range(len(whole)))
        at = 0
        for _, start, body in whole:
            assert start == at
            at += len(body)
        texts += [(i, b"".join(bytes(p[2]) if isinstance(p[2], bytes) else str(list(p[2])).encode() for p in whole))] * copies
    assert sorted(texts, key=str) == sorted(rows, key=str)


def test_contents(spark):
    rows = [(i, f"text {i} " * (i % 90)) for i in range(300)] + [(5, "other text of 5"), (5, "other text of 5"), (None, "no id"), (7, None), (8, ""), (9, "é€😀" * 9_000), (10, "x" * 16_384), (11, "y" * 16_385)]
    got = packing.pack_documents(rows_of(spark, rows)).collect()
    check(got, [(i, (t or "").encode()) for i, t in rows], lambda c: c.encode())
    assert len({r["sequence_id"] for r in got}) == len(got)
    # small blocks pack the same rows
    check(packing.pack_documents(rows_of(spark, rows), block_pieces=7, block_bytes=50_000).collect(), [(i, (t or "").encode()) for i, t in rows], lambda c: c.encode())


def test_token_arrays(spark):
    rows = [(i, list(range(i))) for i in range(120)] + [(200, None), (201, list(range(40_000)))]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens array<int>")
    got = packing.pack_documents(df, tokens_col="tokens").collect()
    assert sum(r["used"] for r in got) == sum(len(t or ()) for _, t in rows) and {i for r in got for i in r["ids"]} == {i for i, _ in rows}
    own = sorted((p, r["content"][o : o + n]) for r in got for i, p, o, n in zip(r["ids"], r["pieces"], r["offsets"], r["lengths"], strict=True) if i == 201)
    assert [x for _, part in own for x in part] == list(range(40_000)) and [p for p, _ in own] == [0, 1, 2]


def test_repeatable(spark):
    rows = [(i, hashlib.sha256(str(i).encode()).hexdigest() * (i % 50)) for i in range(200)]
    one, two = ({(r["size"], r["content"]) for r in packing.pack_documents(rows_of(spark, x)).collect()} for x in (rows, rows[::-1]))
    assert one == two
