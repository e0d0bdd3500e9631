"""Operator 6: exact dedup with static binary-fuse filters.

A snapshot is an immutable table of the distinct digests of a batch, dealt into
buckets by digest, with one binary-fuse filter per bucket.  The distinct digests
of a new batch are first screened by the filters: negatives are certainly new and
are grouped among themselves only; positives join the exact buckets.  Every group
of two or more is then confirmed on the bytes of its texts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelforge.llm.arrowtext import mix
from parcelforge.llm.spill import drop_table, result_table, write_table

#: Digests per bucket aimed at; bounds a filter's size and a task's memory.
BUCKET = 8192
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class BinaryFuse:
    """Three-wise binary-fuse filter with 16-bit fingerprints over 64-bit keys (no false negatives)."""

    def __init__(self, seed: int, segment: int, span: int, table: np.ndarray):
        self.seed, self.segment, self.span, self.table = seed, segment, span, table

    @staticmethod
    def _slots(keys: np.ndarray, seed: int, segment: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
        base = ((h >> np.uint64(32)) * np.uint64(span)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        one = (base + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        two = (base + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([base, one, two]).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray, attempts: int = 100) -> BinaryFuse:
        keys = np.unique(keys)
        n = len(keys)
        segment = 4 if n < 2 else 1 << min(18, int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
        factor = 1.125 if n < 2 else max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        span = max(1, math.ceil(n * factor / segment) - 2) * segment
        for seed in range(attempts):
            slots, prints = cls._slots(keys, seed, segment, span)
            degree = np.bincount(slots.ravel(), minlength=span + 2 * segment)
            alive, peeled = np.arange(n), []
            while len(alive):
                single = degree[slots[:, alive]] == 1
                free = single.any(axis=0)
                if not free.any():
                    break
                gone = alive[free]
                peeled.append((gone, single[:, free].argmax(axis=0)))
                np.subtract.at(degree, slots[:, gone].ravel(), 1)
                alive = alive[~free]
            if len(alive):
                continue
            table = np.zeros(span + 2 * segment, dtype=np.uint16)
            for gone, which in reversed(peeled):
                own = slots[which, gone]
                table[own] = 0
                table[own] = prints[gone] ^ np.bitwise_xor.reduce(table[slots[:, gone]], axis=0)
            return cls(seed, segment, span, table)
        raise RuntimeError("no seed peels this key set")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = self._slots(keys, self.seed, self.segment, self.span)
        return np.bitwise_xor.reduce(self.table[slots], axis=0) == prints


def _keys(hashes: pd.Series) -> np.ndarray:
    return hashes.to_numpy(dtype=np.int64).view(np.uint64)


def _normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def digest_of(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text with only A-Z lower-cased; null counts as empty."""
    return F.sha2(_normalised(text), 256)


def digests(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(id, digest[, norm]): SHA-256 (lower-case hex) of the text with only A-Z lower-cased; null counts as empty."""
    rows = documents.select(F.col(id_col).alias("id"), _normalised(F.col(text_col)).alias("norm"))
    return rows.select("id", F.sha2("norm", 256).alias("digest"), *["norm"] * with_text)


def snapshot(distinct: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(exact buckets, filters) of distinct digests: a table with ``bucket`` and one filter row per bucket."""
    dealt = write_table(distinct.withColumns({"bucket": _bucket(buckets), "key": F.xxhash64("digest")}), "op6-buckets")

    def build(part: pd.DataFrame) -> pd.DataFrame:
        fuse = BinaryFuse.build(_keys(part["key"]))
        return pd.DataFrame(
            {"bucket": [part["bucket"].iloc[0]], "seed": [fuse.seed], "segment": [fuse.segment], "span": [fuse.span], "table": [fuse.table.tobytes()]}
        )

    schema = "bucket int, seed int, segment int, span long, table binary"
    filters = dealt.select("bucket", "key").groupBy("bucket").applyInPandas(build, schema)
    return dealt, write_table(filters, "op6-filters")


def _bucket(buckets: int):
    return (F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % buckets).cast("int")


def screen(distinct: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """(digest) of those that the filters do not rule out."""

    def probe(part: pd.DataFrame, filter_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(filter_rows):
            return pd.DataFrame({"digest": pd.Series([], dtype=str)})
        row = filter_rows.iloc[0]
        fuse = BinaryFuse(int(row["seed"]), int(row["segment"]), int(row["span"]), np.frombuffer(row["table"], dtype=np.uint16))
        return part.loc[fuse.contains(_keys(part["key"])), ["digest"]]

    dealt = distinct.select("digest", F.xxhash64("digest").alias("key"), _bucket(buckets).alias("bucket"))
    return dealt.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest string")


def _by_bytes(documents: DataFrame, rows: DataFrame, split: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with their classes where a digest stands for several texts: members of such digests find their class by their bytes."""
    clashing = split.where("texts > 1").select("digest")
    plain = rows.join(split.where("texts = 1"), "digest", "left").join(clashing, "digest", "left_anti")
    texts = digests(documents, id_col=id_col, text_col=text_col, with_text=True).join(clashing.hint("merge"), "digest")
    found = texts.join(classes.select("norm", "keep_id", "group_size"), "norm").select("id", "digest", "keep_id", "group_size")
    return plain.select("id", "digest", "keep_id", "group_size").unionByName(found)


def deduplicate(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row.

    The table is taken as two batches dealt by a hash of the id: the first
    becomes the immutable snapshot, the second arrives against it.  Texts are
    equal when identical after lower-casing A-Z only (null counts as empty); of
    equal texts the largest id stays.  ``group_size`` counts rows, repeated ones
    too; rows that repeat both id and text repeat their result (each is kept when
    its id is the largest).  A null id is below every other; a group of null ids
    only has a null keep_id and keeps its rows.  An empty table gives an empty
    result; other columns are not read.
    """
    rows = write_table(
        digests(documents, id_col=id_col, text_col=text_col).withColumn("batch", F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(2))),
        "op6-rows",
    )
    grouped = write_table(rows.groupBy("batch", "digest").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")), "op6-groups")
    buckets = max(64, 1 << math.ceil(math.log2(max(1, grouped.count()) / BUCKET + 1e-9)) if grouped.count() > BUCKET else 64)
    old, new = grouped.where("batch = 0").drop("batch"), grouped.where("batch = 1").drop("batch")
    exact, filters = snapshot(old, buckets)
    positive = write_table(screen(new, filters, buckets), "op6-positive")
    across = (
        positive.join(exact.select("digest"), "digest").select("digest")
    )
    repeated = write_table(
        across.unionByName(grouped.where("n > 1").select("digest")).distinct(), "op6-repeated"
    )
    # Byte checks: texts of repeated digests only, grouped by their bytes; one join strategy at every size.  The join may
    # split a hot digest over tasks, and the grouping by text sends one row of each text and task.
    same = digests(documents, id_col=id_col, text_col=text_col, with_text=True).join(repeated.hint("merge"), "digest")
    classes = same.groupBy("norm").agg(F.first("digest").alias("digest"), F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = write_table(classes, "op6-texts")
    split = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    split = write_table(split, "op6-classes")
    clash = split.where("texts > 1").count()
    out = _by_bytes(documents, rows, split, classes, id_col, text_col) if clash else rows.join(split, "digest", "left")
    for table in (grouped, exact, filters, positive, repeated):
        drop_table(table)
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    out = out.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.col("digest").alias("text_sha256")
    )
    out = result_table(out, "op6-result")
    for table in (rows, split, classes):
        drop_table(table)
    return out
