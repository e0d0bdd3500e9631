"""Operator 5: document fingerprints by SimHash, with DataFrame functions only.

Each word's 64-bit hash votes, with a weight by its length, on 64 signed bits.
Two vote counters share one 64-bit sum (bits j and j+32), so that a document costs
32 sums that combine before any shuffle.  Fingerprints within a Hamming radius
are found with permuted block tables: the 64 bits are cut into ``radius + 2``
blocks, two fingerprints within the radius agree on at least two of them, and
there is one table per pair of blocks, keyed by the bits of both.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelforge.llm.spill import write_table

#: Rows of a bucket of neighbouring ids aimed at, and the most buckets (bounds the broadcast of their first ids).
BUCKET_ROWS, MOST_BUCKETS, KNOTS = 256, 65_536, 64
_LANES = 0x0000000100000001


def _weight(word: Column) -> Column:
    """0 for no word, 1 for short words, else the length."""
    return F.when(word == "", 0).when(F.length(word) <= 3, 1).otherwise(F.length(word)).cast("long")


def fingerprints(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(keys, fp long) with one row per distinct ``keys``; texts without words get 0."""
    words = texts.select(*keys, F.explode(F.split(text_col, r"[\x20\x09-\x0D]+")).alias("_word"))
    votes = words.select(*keys, F.xxhash64("_word").alias("_h"), _weight(F.col("_word")).alias("_w"))
    lane = F.lit(_LANES)
    sums = [F.sum(F.shiftrightunsigned("_h", j).bitwiseAND(lane) * F.col("_w")).alias(f"_s{j}") for j in range(32)]
    tallied = votes.groupBy(*keys).agg(F.sum("_w").alias("_all"), *sums)
    bits = F.lit(0).cast("long")
    for j in range(32):
        low = F.col(f"_s{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_s{j}", 32)
        bits = bits.bitwiseOR(F.when(low * 2 > F.col("_all"), F.lit(1 << j)).otherwise(F.lit(0)).cast("long"))
        top = (1 << (j + 32)) - (1 << 64 if j == 31 else 0)
        bits = bits.bitwiseOR(F.when(high * 2 > F.col("_all"), F.lit(top)).otherwise(F.lit(0)).cast("long"))
    return tallied.select(*keys, bits.alias("fp"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(one: Column, two: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(one.bitwiseXOR(two)) / F.lit(64.0)


def _dealt(documents: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(id -> bucket column added, first ids of the buckets with the bucket before each)."""
    ids = documents.select(F.col(id_col).alias("_id"))
    row = ids.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_id", [i / KNOTS for i in range(KNOTS + 1)], 10_000).alias("knots")).first()
    knots = sorted(set(row["knots"] or [0]))
    per_knot = max(1, min(row["n"] // BUCKET_ROWS, MOST_BUCKETS) // max(1, len(knots)))
    array = F.array(*[F.lit(k).cast("long") for k in knots])
    step = F.array(*[F.lit(max(1, -(-(b - a) // per_knot))).cast("long") for a, b in zip(knots, [*knots[1:], knots[-1] + 1], strict=True)])
    at = F.greatest(F.size(F.filter(array, lambda k: k <= F.coalesce(F.col("_id"), F.lit(knots[0])))), F.lit(1))
    inside = F.floor((F.coalesce(F.col("_id"), F.lit(knots[0])) - F.element_at(array, at)) / F.element_at(step, at))
    bucket = (at * F.lit(per_knot) + F.least(F.greatest(inside, F.lit(0)), F.lit(per_knot - 1))).cast("int")
    return bucket, ids.select("_id", bucket.alias("_bucket"))


def with_next(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_bucket, _ahead, _rank, _id, _text, _next): each text with that of the next larger id (the largest: the smallest's).

    Neighbouring ids meet in buckets; the first row of a bucket also goes, marked
    ``_ahead``, to the end of the bucket before.  The texts are shuffled once.
    """
    bucket, placed = _dealt(documents, id_col)
    firsts = placed.groupBy("_bucket").agg(F.min(F.struct("_id")).alias("_first"))
    everywhere = Window.orderBy("_bucket")
    # at most MOST_BUCKETS rows of 16 bytes, hence one task and a broadcast
    firsts = firsts.select(
        F.col("_first._id").alias("_first"),
        F.coalesce(F.lag("_bucket").over(everywhere), F.max("_bucket").over(Window.partitionBy())).alias("_before"),
    )
    rows = documents.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_bucket", bucket)
    rows = rows.join(F.broadcast(firsts), rows["_id"].eqNullSafe(firsts["_first"]), "left")
    here = F.struct(F.col("_bucket"), F.lit(False).alias("_ahead"))
    there = F.struct(F.col("_before").alias("_bucket"), F.lit(True).alias("_ahead"))
    rows = rows.select("_id", "_text", F.explode(F.when(F.col("_before").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("_p"))
    rows = rows.select("_p._bucket", "_p._ahead", "_id", "_text")
    order = Window.partitionBy("_bucket").orderBy("_ahead", "_id", F.xxhash64("_text"))
    return rows.withColumn("_next", F.lead("_text").over(order)).withColumn("_rank", F.row_number().over(order))


def edit_report(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, fp) for every row.

    The edited text has its last floor(n_chars/2) code points replaced by the
    first as many (or all) of the next document by ascending id; after the last
    comes the first; ids are whole numbers.  A null text counts as empty, texts without words have
    fingerprint 0; rows that repeat an id follow each other in the order of a hash
    of their text; a null id comes first; one row is its own next; an empty table
    gives an empty result; other columns are not read.
    """
    near = with_next(documents, id_col=id_col, text_col=text_col)
    n = F.length("_text")
    edited = F.concat(F.expr("left(_text, length(_text) - length(_text) div 2)"), F.expr("left(_next, int(length(_text) div 2))"))
    both = near.select("_bucket", "_rank", "_ahead", "_id", n.cast("long").alias("_n"), "_text", F.when(~F.col("_ahead"), edited).alias("_edited"))
    both = both.withColumn("_sha", F.sha2("_edited", 256))
    # the digest travels as five numbers of 52 bits: fixed-width group values keep the aggregation in its fast form
    parts = [F.conv(F.substring("_sha", 1 + 13 * i, 13), 16, 10).cast("long").alias(f"_d{i}") for i in range(5)]
    meta = ["_ahead", "_id", "_n", *[f"_d{i}" for i in range(5)]]
    kinds = F.array(F.struct(F.lit(0).alias("k"), F.col("_text").alias("t")), F.struct(F.lit(1).alias("k"), F.col("_edited").alias("t")))
    rows = both.select("_bucket", "_rank", "_ahead", "_id", "_n", *parts, F.explode(kinds).alias("_x")).where("_x.t is not null")
    rows = rows.select("_bucket", "_rank", F.col("_x.k").alias("_kind"), *meta, F.col("_x.t").alias("_t"))
    prints = fingerprints(rows, ["_bucket", "_rank", "_kind", *meta], "_t")
    one = prints.groupBy("_bucket", "_rank").agg(
        *[F.max(c).alias(c) for c in meta],
        F.max(F.when(F.col("_kind") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("_kind") == 1, F.col("fp"))).alias("_efp"),
    )
    one = one.withColumn("_nfp", F.lead("fp").over(Window.partitionBy("_bucket").orderBy("_rank"))).where(~F.col("_ahead"))
    sha = F.concat(*[F.lower(F.lpad(F.hex(f"_d{i}"), 13 if i < 4 else 12, "0")) for i in range(5)])
    return one.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_chars"),
        sha.alias("edited_sha256"),
        hexadecimal(F.col("fp")).alias("fingerprint"),
        hexadecimal(F.col("_efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("_efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("_nfp")).alias("near_next"),
        "fp",
    )


def block_keys(fp: Column, radius: int) -> Column:
    """Array of (table, bits): one entry for each pair of the ``radius + 2`` blocks."""
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    cut = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(
        *[
            F.struct(F.lit(t).alias("table"), F.shiftleft(cut[i], edges[j + 1] - edges[j]).bitwiseOR(cut[j]).alias("bits"))
            for t, (i, j) in enumerate(combinations(range(blocks), 2))
        ]
    )


def within_radius(index: DataFrame, queries: DataFrame, *, radius: int = 3) -> DataFrame:
    """(query, fp, n): all fingerprints of ``index`` (fp, n) within ``radius`` bits of each of ``queries`` (fp), exactly."""
    keyed = index.select("fp", "n", F.explode(block_keys(F.col("fp"), radius)).alias("key"))
    asked = queries.select(F.col("fp").alias("query"), F.explode(block_keys(F.col("fp"), radius)).alias("key"))
    near = keyed.join(asked, "key").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("query"))) <= radius)
    return near.select("query", "fp", "n").distinct()


def fingerprint_report(documents: DataFrame, *, radius: int = 3, every: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``edit_report`` with ``n_near``: for ids divisible by ``every``, the rows whose fingerprint lies within ``radius`` bits (itself too); else null."""
    report = write_table(edit_report(documents, id_col=id_col, text_col=text_col), "op5-report", native=True)
    index = report.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    asked = (F.col(id_col) % every) == 0
    found = within_radius(index, report.where(asked).select("fp").distinct(), radius=radius)
    counts = found.groupBy(F.col("query").alias("fp")).agg(F.sum("n").alias("n_near"))
    return report.join(counts, "fp", "left").withColumn("n_near", F.when(asked, F.col("n_near"))).drop("fp")
