"""Operator 2: near-duplicate documents by SetSketch registers.

A document's set of word shingles is sketched by registers that hold truncated
minima of exponential variables on a scale spaced by ``BASE``; registers of a
union are the element-wise maximum, and equal registers grow likelier with the
Jaccard similarity.  Bands of register values propose partners, a joint
likelihood over the registers drops hopeless ones, and the full shingle sets
confirm each link.  Links become groups by connected components.

No bucket is expanded into its pairs.  Its members are compared with one hub, the
member that meets most others.  The members of buckets that still hold several
groups are then joined on their rarest shingles, which every linked pair shares
(the prefix filter of set-similarity joins), and only across groups.  The
likelihood only sorts pairs: those it drops are still in such a bucket, and the
exact join decides them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelforge.llm.arrowtext import WORD, gram_hashes, lower, mix, segment, slices, word_hashes
from parcelforge.llm.graph import components
from parcelforge.llm.spill import drop_table, lean, result_table, write_table

#: 40 bands of 5 registers: a pair of similarity 0.8 meets in no band with probability 1.2e-7.
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE = 1.02
#: Hub pairs whose estimate lies this far below the threshold are left to the exact join.
SLACK = 0.18
#: Sets of more shingles are kept in parts of about so many, cut at fixed places of the hash range.
PART_BITS = 16
#: Shingles of members that meet one copy of a hub's set in a task; larger hubs are dealt over several copies.
HUB_SHINGLES = 1 << 20

_rng = np.random.default_rng(7)
_MUL = (_rng.integers(0, 2**31, size=REGISTERS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, size=REGISTERS, dtype=np.uint32)
_ROW_KEYS = _rng.integers(1, 2**63, size=(BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_KEYS = _rng.integers(1, 2**63, size=BANDS, dtype=np.uint64)


def document_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all documents, lengths).  Fewer words than a shingle: the whole sequence is one."""
    low = lower(data)
    starts, ends, first = segment(low, offsets, WORD)
    words = word_hashes(low, starts, ends)
    grams = gram_hashes(words, shingle)
    out, sizes = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for d, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if hi - lo >= shingle:
            got = np.unique(grams[lo : hi - shingle + 1])
        elif hi > lo:
            got = gram_hashes(words[lo:hi], hi - lo)
        else:
            continue
        out.append(got)
        sizes[d] = len(got)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def registers(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SetSketch registers (documents x REGISTERS, uint16) of non-empty sets laid end to end."""
    starts = np.cumsum(sizes) - sizes
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.empty((REGISTERS, len(sizes)), dtype=np.uint32)
    y, z = np.empty_like(x), np.empty_like(x)
    for j in range(REGISTERS):
        np.multiply(x, _MUL[j], out=y)
        np.add(y, _ADD[j], out=y)
        np.right_shift(y, 15, out=z)
        np.bitwise_xor(y, z, out=y)
        np.multiply(y, np.uint32(0x2C1B3C6D), out=y)
        np.right_shift(y, 13, out=z)
        np.bitwise_xor(y, z, out=y)
        low[j] = np.minimum.reduceat(y, starts)
    value = -np.log1p(-(low.T.astype(np.float64) + 0.5) / 2.0**32)  # minimum of exponentials of rate 1
    return np.clip(np.floor(1.0 - np.log(value) / math.log(BASE)), 0, 65535).astype(np.uint16)


def merge(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, two)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(documents x BANDS) 64-bit keys of the bands."""
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix((parts * _ROW_KEYS).sum(axis=2, dtype=np.uint64) + _BAND_KEYS)


def estimate(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood Jaccard similarity of pairs of sketches with known set sizes.

    With shares u, v of the two sizes, a register of the first exceeds the
    second's with probability p(u - vJ), falls short with p(v - uJ), and is equal
    otherwise, where p(x) = -log_b(1 - x (b-1)/b); the log likelihood is concave
    in J and its maximum found by golden-section search.
    """
    above = (one > two).sum(axis=1).astype(float)
    below = (one < two).sum(axis=1).astype(float)
    equal = one.shape[1] - above - below
    u = n_one / (n_one + n_two)
    v = 1.0 - u
    scale, log_base = (BASE - 1) / BASE, math.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p = -np.log1p(-np.clip(u - v * j, 0, 1) * scale) / log_base
        q = -np.log1p(-np.clip(v - u * j, 0, 1) * scale) / log_base
        tiny = 1e-12
        return above * np.log(p + tiny) + below * np.log(q + tiny) + equal * np.log(np.maximum(1 - p - q, tiny))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        left = likelihood(a) > likelihood(b)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2


def _vertex(one: str = "id", digest: str = "set_a") -> Column:
    """What stands for a set: its smallest id (a null id after all others) and a digest, since an id may repeat with other texts."""
    return F.struct(F.col(one).isNull().alias("none"), F.col(one).alias("id"), F.col(digest).alias("digest"))


def sketch(documents: DataFrame, *, shingle: int, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """(id, n, set_a, set_b, regs, bands[, _carry]): set_a/set_b are a 128-bit digest of the set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "_text"):
                shingles, sizes = document_sets(data, offsets, shingle)
                full = np.flatnonzero(sizes)
                digests = np.zeros((2, len(sizes)), dtype=np.uint64)
                regs = np.zeros((len(full), REGISTERS), dtype=np.uint16)
                if len(full):
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    digests[0, full] = np.add.reduceat(mix(shingles + np.uint64(1)), starts)
                    digests[1, full] = np.add.reduceat(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    regs = registers(shingles, sizes[full])
                keys = band_keys(regs).view(np.int64) if len(full) else np.zeros((0, BANDS), np.int64)
                have = sizes > 0
                edges = np.concatenate([[0], np.cumsum(have)]).astype(np.int32)
                raw = regs.astype("<u2").tobytes()
                blob = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges * np.int32(2 * REGISTERS)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        *rows.columns[2:],
                        pa.array(sizes),
                        pa.array(digests[0].view(np.int64)),
                        pa.array(digests[1].view(np.int64)),
                        blob,
                        pa.ListArray.from_arrays(pa.array(edges * np.int32(BANDS)), pa.array(keys.ravel())),
                    ],
                    names=["id", *rows.schema.names[2:], "n", "set_a", "set_b", "regs", "bands"],
                )

    more = [F.struct(*carry).alias("_carry")] if carry else []
    texts = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *more)
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in texts.schema if f.name != "_text")
    return texts.mapInArrow(lean(run), own + "n bigint, set_a bigint, set_b bigint, regs binary, bands array<bigint>")


def _level(n: Column) -> Column:
    """Binary digits of the number of parts that a set of ``n`` shingles is kept in."""
    over = F.shiftright(n - 1, PART_BITS)
    return F.when(over <= 0, 0).otherwise(F.length(F.bin(over))).cast("int")


def _parts(shingles: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, shingles) of one ascending set."""
    level = (max(len(shingles) - 1, 0) >> PART_BITS).bit_length()
    if not level:
        yield 0, shingles
        return
    edges = np.searchsorted(shingles >> np.uint64(64 - level), np.arange((1 << level) + 1, dtype=np.uint64))
    for part, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        yield part, shingles[lo:hi]


def _shingle_sets(documents: DataFrame, wanted: DataFrame, *, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(id, part, shingles array<long>) of the vertices in ``wanted`` (id), and of other texts that share their ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "_text"):
                shingles, sizes = document_sets(data, offsets, shingle)
                full = np.flatnonzero(sizes)
                if not len(full):
                    continue
                ends = np.cumsum(sizes[full])
                digest = np.add.reduceat(mix(shingles + np.uint64(1)), ends - sizes[full])
                owner, parts, pieces = [], [], []
                for d, end, n in zip(range(len(full)), ends.tolist(), sizes[full].tolist(), strict=True):
                    for part, piece in _parts(shingles[end - n : end]):
                        owner.append(d)
                        parts.append(part)
                        pieces.append(piece)
                edges = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(pieces).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(full[owner])), pa.array(digest.view(np.int64)[owner]), pa.array(parts, pa.int32()), lists],
                    names=["id", "digest", "part", "shingles"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    texts = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    ids = wanted.select(F.col("id.id").alias("_wanted")).distinct()
    texts = texts.join(ids, texts["id"].eqNullSafe(ids["_wanted"]), "left_semi")
    found = texts.mapInArrow(lean(run), f"id {kind}, digest bigint, part int, shingles array<bigint>")
    return found.select(_vertex("id", "digest").alias("id"), "part", "shingles")


def _likely(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, na, nb, ra, rb) whose joint estimate is at least ``least``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype="<u2").reshape(-1, REGISTERS) for k in (4, 5)
            )
            got = estimate(one, two, *(batch.column(k).to_numpy().astype(float) for k in (2, 3)))
            yield batch.filter(pa.array(got >= least)).select(["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(lean(run), f"a {kind}, b {kind}")


def _rare_partners(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels that can reach the threshold, from (id, n, label, shingles).

    Two sets of similarity t share one of the n - ceil(t n) + 1 shingles that come
    first in each under any common order; with the rarest first, few sets do.  Of a
    pair, the smaller set needs only its first n - ceil(2 t n / (1 + t)) + 1, so
    those alone are one side of the join.
    """
    tokens = write_table(rows.select("id", "n", "label", F.explode("shingles").alias("token")), "op2-tokens")
    count = write_table(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "op2-counts")
    # a sort, not arrays, ranks the shingles of a set, so that long texts spill; equal ranks are repeats of one row
    order = Window.partitionBy("id", "label").orderBy("df", "token")
    ranked = tokens.join(count, "token").withColumn("place", F.dense_rank().over(order) - 1)
    placed = ranked.where(f"place < n - ceil(n * {percent} / 100) + 1 and df > 1").distinct()
    rare = write_table(placed.select("id", "n", "label", "place", "token"), "op2-rare")
    drop_table(tokens)
    drop_table(count)
    mixed = rare.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
    mixed = write_table(mixed, "op2-mixed")
    live = write_table(rare.join(mixed, "token"), "op2-live")
    drop_table(rare)
    drop_table(mixed)
    # at the first shingle that both hold, at least `need` must be left in each, itself included
    need = f"ceil({percent} * (n + h.n) / {100 + percent})"
    small = live.where(f"n - place >= ceil(2 * {percent} * n / {100 + percent})")
    large = live.select("token", F.struct("id", "n", "label", "place").alias("h"))
    ordered = "(n < h.n OR n = h.n AND id < h.id)"
    met = small.join(large, "token").where(f"{ordered} and label <> h.label and 100 * n >= {percent} * h.n and n - place >= {need} and h.n - h.place >= {need}")
    pairs = write_table(met.select(F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b")).distinct(), "op2-pairs")
    drop_table(live)
    return pairs


def near_duplicates(
    documents: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """(id, n_shingles, component_id, kept[, _carry]) for every row.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+`` of the whole text.  Two
    documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of
    ``shingle``-word shingles (fewer words: the whole sequence is one shingle).
    ``component_id`` is the smallest id reachable over links and ``kept`` marks the
    document that carries it.

    A null or empty text has an empty set, n_shingles 0, is linked with nothing
    and kept.  Equal sets are one vertex until the end, so large groups of copies
    cost one sketch each.  Rows that repeat an id are judged by their own texts;
    of a group, the rows with the smallest id and that row's set are kept (of two
    sets with that id the one with the smaller digest).  A null id comes after
    all others, so it is kept, and ``component_id`` is null, only where a group
    has no other.  An empty table gives an empty result; ``carry`` names columns
    that come along in a struct ``_carry``, others are not read.
    """
    sketches = write_table(sketch(documents, shingle=shingle, id_col=id_col, text_col=text_col, carry=carry), "op2-sketches")
    classes = write_table(
        sketches.where("n > 0").groupBy("n", "set_a", "set_b").agg(F.min(_vertex()).alias("rep")), "op2-classes"
    )
    heads = sketches.where("n > 0").select(_vertex().alias("id"), "n", "set_a", "set_b", "regs", "bands").join(
        classes.withColumnRenamed("rep", "id"), ["n", "set_a", "set_b", "id"], "left_semi"
    ).dropDuplicates(["id"])
    heads = write_table(heads.select("id", "n", "regs", "bands"), "op2-heads")
    bands = heads.select("id", "n", F.explode("bands").alias("key"))
    # aggregates are written before the joins that use them, so that adaptive execution may split a hot key of the other side
    buckets = bands.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("members"))
    buckets = write_table(buckets.where("least < most").select("key", "members"), "op2-buckets")
    met = write_table(bands.join(buckets, "key").select("key", "id", "n", "members"), "op2-met")
    drop_table(buckets)
    # the hub is the member that meets most others over all its buckets: the one the others are copies of, if it is there
    fame = met.groupBy("id").agg(F.sum("members").alias("fame"))
    fame = write_table(fame, "op2-fame")
    famed = write_table(met.join(fame, "id").select("key", "id", "n", "fame"), "op2-met")
    drop_table(met)
    drop_table(fame)
    met = famed
    hubs = met.groupBy("key").agg(F.min(F.struct((-F.col("fame")).alias("fame"), "id", "n")).alias("h"))
    sets = write_table(
        _shingle_sets(documents, met.select("id").distinct(), shingle=shingle, id_col=id_col, text_col=text_col), "op2-sets"
    )
    if sets.count() > sets.select("id", "part").distinct().count():  # rows that repeat id and set
        once = write_table(sets.dropDuplicates(["id", "part"]), "op2-sets")
        drop_table(sets)
        sets = once
    brief = heads.select("id", "n", "regs")

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose joint estimate lets them be links."""
        pairs = pairs.join(brief.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra")), "a")
        pairs = pairs.join(brief.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb")), "b")
        return _likely(pairs, percent / 100 - SLACK)

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links on their full sets.

        The end that has more pairs is the hub: its set is copied once for each
        HUB_SHINGLES of its members, while each member's set travels with its pair.
        """
        many = write_table(pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("k")), "op2-degrees")
        one, two = (many.select(F.col("id").alias(c), F.col("k").alias(f"k{c}")) for c in "ab")
        turned = pairs.join(one, "a").join(two, "b").select(
            F.when(F.col("ka") >= F.col("kb"), F.col("a")).otherwise(F.col("b")).alias("hub"),
            F.when(F.col("ka") >= F.col("kb"), F.col("b")).otherwise(F.col("a")).alias("id"),
        )
        sizes = brief.select("id", "n")
        turned = turned.join(sizes, "id").join(sizes.select(F.col("id").alias("hub"), F.col("n").alias("hub_n")), "hub")
        turned = turned.withColumn("level", F.least(_level(F.col("n")), _level(F.col("hub_n"))))  # at which the parts of both are compared
        turned = write_table(turned, "op2-turned")
        copies = write_table(
            turned.groupBy("hub", "level").agg((F.floor(F.sum("n") / HUB_SHINGLES) + 1).cast("int").alias("copies")), "op2-copies"
        )
        met = turned.join(copies, ["hub", "level"]).withColumn("copy", F.pmod(F.xxhash64("id"), F.col("copies")).cast("int")).drop("copies")
        coarse = lambda part, n: F.expr(f"shiftright({part}, {n} - level)")
        met = met.join(sets.select("id", F.col("part").alias("at"), F.col("shingles").alias("one")), "id")
        met = met.withColumn("own", _level(F.col("n"))).withColumn("part", coarse("at", "own"))
        hubs = sets.join(copies.withColumnRenamed("hub", "id"), "id").join(sizes, "id").withColumn("own", _level(F.col("n")))
        hubs = hubs.select(
            F.col("id").alias("hub"), "level", coarse("part", "own").alias("part"), F.col("shingles").alias("two"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
        )
        met = met.join(hubs, ["hub", "level", "copy", "part"]).select("hub", "id", "n", "hub_n", F.size(F.array_intersect("one", "two")).alias("both"))
        met = met.groupBy("hub", "id", "n", "hub_n").agg(F.sum("both").alias("both"))
        met = met.where(f"100 * both >= {percent} * (n + hub_n - both)")
        links = write_table(met.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")), "op2-links")
        for table in (many, turned, copies):
            drop_table(table)
        return links

    def ordered(one: str, two: str) -> list:
        return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]

    close = f"100 * least(n, h.n) >= {percent} * greatest(n, h.n)"  # no link without it
    hubs = write_table(hubs, "op2-hubs")
    tried = write_table(likely(met.join(hubs, "key").where(f"id <> h.id and {close}").select(*ordered("id", "h.id")).distinct()), "op2-tried")
    drop_table(hubs)
    links = verified(tried)
    found = components(links)
    labels = write_table(found, "op2-labels")
    drop_table(found)
    marked = met.join(labels.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("label"))
    marked = write_table(marked, "op2-marked")
    mixed = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    mixed = write_table(mixed, "op2-mixed")
    unsure = write_table(marked.join(mixed, "key").select("id", "n", "label").distinct(), "op2-open")
    for table in (met, marked, mixed):
        drop_table(table)
    pairs = _rare_partners(sets.join(unsure, "id"), percent)
    fresh = write_table(pairs.join(tried, ["a", "b"], "left_anti"), "op2-fresh")
    more = verified(fresh)
    if not more.isEmpty():  # the later links join whole components
        of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
        between = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        found = components(between)
        tops = write_table(found, "op2-tops")
        drop_table(found)
        top = tops.select(F.col("node").alias("component"), F.col("component").alias("_top"))
        alone = tops.withColumnRenamed("component", "_top").join(labels.select("node"), "node", "left_anti")
        joined = labels.join(top, "component", "left").select("node", F.coalesce("_top", "component").alias("component"))
        grown = write_table(joined.unionByName(alone.select("node", F.col("_top").alias("component"))), "op2-labels")
        drop_table(labels)
        drop_table(tops)
        labels = grown
    for table in (heads, sets, links, more, tried, pairs, fresh, unsure):
        drop_table(table)
    whole = classes.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "n", "set_a", "set_b", F.coalesce("component", "rep").alias("component")
    )
    out = sketches.drop("regs", "bands").join(whole, ["n", "set_a", "set_b"], "left")
    own = F.when(F.col("n") > 0, _vertex())
    out = out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component.id")).otherwise(F.col("id")).alias("component_id"),
        own.eqNullSafe(F.col("component")).alias("kept"),
        *["_carry"] * bool(carry),
    )
    out = result_table(out, "op2-result")
    for table in (sketches, classes, labels):
        drop_table(table)
    return out
