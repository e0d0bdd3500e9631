"""Operator 8: substring dedup with fixed-block anchors.

A repeat is a run of ``window`` words that also starts in a document with a
smaller id.  Any such run contains, wherever it lies, one whole block of
``window // 2`` words that begins at a multiple of that length in the reference
document.  So the non-overlapping blocks of the documents are the index, every
rolling window of that length probes it, and hits are extended to exact runs of
``window`` words, whose union over a document are its maximal exact repeats.

Rolling probes over all words would shuffle several times the input.  Before
them, a lossless screen drops most places: of each run of ``window`` words, the
smallest hash among its runs of ``SCREEN`` words is chosen by content, so two
equal runs choose the same one, and only surroundings of choices that two
documents share are indexed and probed.  Documents with equal texts are probed
once; the later ones are repeats as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelforge.llm.arrowtext import WORD, gram_hashes, ragged, segment, slices, word_hashes
from parcelforge.llm.spill import drop_table, lean, result_table, write_table

WINDOW = 50
SCREEN = 10
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over each run of ``width`` values, by doubling."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def chosen(words: np.ndarray, first: np.ndarray, window: int, screen: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the screen runs that some window of their document chooses; ties are all chosen."""
    grams = gram_hashes(words, screen)
    width = window - screen + 1
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc_end = np.repeat(first[1:], np.diff(first))[: len(grams)]
    long_enough = np.repeat(np.diff(first) >= window, np.diff(first))[: len(grams)]
    whole = (np.arange(len(grams)) + screen <= doc_end) & long_enough
    grams = np.where(whole, grams, _FULL)
    low = sliding(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    best = sliding(np.concatenate([edge, low, edge]), width, np.maximum)
    at = np.flatnonzero((best == grams) & whole)
    return at, grams[at]


def _keyed(documents: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    more = [F.struct(*carry).alias("_carry")] if carry else []
    return documents.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_t"), text.alias("_text"), *more)


def repeat_starts(documents: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _t, whole, starts): documents that hold repeats; ``starts`` are the word places of repeated windows.

    ``whole`` marks documents whose entire text equals that of a smaller id.
    """
    block = window // 2
    keyed = _keyed(documents, id_col, text_col)
    kind = keyed.schema["_id"].dataType.simpleString()

    def screen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "_text"):
                starts, ends, first = segment(data, offsets, WORD)
                at, value = chosen(word_hashes(data, starts, ends), first, window, SCREEN)
                doc = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(doc)),
                        rows.column(1).take(pa.array(doc)),
                        pa.array((at - first[doc]).astype(np.int32)),
                        pa.array(value.view(np.int64)),
                    ],
                    names=["_id", "_t", "place", "choice"],
                )

    digests = keyed.select("_id", "_t", F.sha2("_text", 256).alias("digest"))
    # aggregates are written before the joins that use them, so that adaptive execution may split a hot key of the other side
    least = digests.groupBy("digest").agg(F.min("_id").alias("least"), F.max("_id").alias("most")).where("least < most")
    least = write_table(least, "op8-least")
    copies = write_table(digests.join(least, "digest").where("_id > least").select("_id", "_t").distinct(), "op8-copies")

    choices = keyed.mapInArrow(lean(screen), f"_id {kind}, _t bigint, place int, choice bigint")
    choices = write_table(choices.join(copies, ["_id", "_t"], "left_anti"), "op8-choices")
    shared = choices.groupBy("choice").agg(F.min("_id").alias("low"), F.max("_id").alias("high")).where("low < high").select("choice")
    shared = write_table(shared, "op8-shared")
    places = choices.join(shared, "choice").groupBy("_id", "_t").agg(F.collect_list("place").alias("places"))

    def candidates(one: np.ndarray, first: np.ndarray, marks: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Per word: may the window that starts there be repeated?  Only if its own choice, the least of its screen runs, is shared."""
        grams = gram_hashes(one, SCREEN)
        if len(grams) < window - SCREEN + 1:
            return np.zeros(0, dtype=bool)
        doc_end = np.repeat(first[1:], np.diff(first))
        grams = np.where(np.arange(len(grams)) + SCREEN <= doc_end[: len(grams)], grams, _FULL)
        shared = np.full(len(grams), _FULL)
        spots = first[doc] + marks
        shared[spots] = grams[spots]
        low = sliding(grams, window - SCREEN + 1, np.minimum)
        equal = low == sliding(shared, window - SCREEN + 1, np.minimum)
        return equal & (np.arange(len(low)) + window <= doc_end[: len(low)])

    def marked(rows: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
        lists = rows.column(name)
        sizes = np.array([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64)
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(rows.num_rows), sizes)

    def spread(at: np.ndarray, before: int, after: int, size: int) -> np.ndarray:
        """Mask of all places from ``before`` before to ``after`` after some place in ``at``."""
        reach = np.zeros(size + 1, dtype=np.int64)
        np.add.at(reach, np.maximum(at - before, 0), 1)
        np.add.at(reach, np.minimum(at + after + 1, size), -1)
        return np.cumsum(reach[:-1]) > 0

    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "_text"):
                starts, ends, first = segment(data, offsets, WORD)
                one = word_hashes(data, starts, ends, 0)
                may = np.flatnonzero(candidates(one, first, *marked(rows, "places")))
                if not len(may):
                    continue
                at = np.flatnonzero(spread(may, 0, window - block, len(starts)))  # the blocks inside such windows
                doc = np.searchsorted(first, at, side="right") - 1
                value = (gram_hashes(one, block)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(doc)), pa.array((at - first[doc]).astype(np.int32)), pa.array(value)], names=["_id", "place", "block"]
                )

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "_text"):
                starts, ends, first = segment(data, offsets, WORD)
                one, two = word_hashes(data, starts, ends, 0), word_hashes(data, starts, ends, 1)
                may = candidates(one, first, *marked(rows, "places"))
                hits, doc = marked(rows, "hits")
                at = first[doc] + hits
                at = at[at < first[doc + 1]]
                if not len(at) or not len(may):
                    continue
                at = np.flatnonzero(may & spread(at, window - block, 0, len(starts))[: len(may)])
                doc = np.searchsorted(first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(doc)),
                        rows.column(1).take(pa.array(doc)),
                        pa.array((at - first[doc]).astype(np.int32)),
                        pa.array(gram_hashes(one, window)[at].view(np.int64)),
                        pa.array(gram_hashes(two, window, 1)[at].view(np.int64)),
                    ],
                    names=["_id", "_t", "place", "run_a", "run_b"],
                )

    places = write_table(places, "op8-places")
    near = keyed.join(places, ["_id", "_t"]).select("_id", "_t", "_text", "places")
    # 32 bits of a block's hash do for a probe: a false hit costs one window more, whose 128-bit hash decides
    rolling = write_table(near.select("_id", "_text", "places"), "op8-probes", through=(probe, f"_id {kind}, place int, block int"))
    drop_table(choices)
    # the index holds the non-overlapping blocks of the documents with the smallest document of each; every rolling window probes it
    index = rolling.where(F.col("place") % block == 0).groupBy("block").agg(F.min("_id").alias("ref"))
    index = write_table(index, "op8-index")
    probes = rolling.groupBy("block").agg(F.max("_id").alias("top"))  # of the windows with one block that of the largest id decides
    anchors = write_table(probes.join(index, "block").where("top > ref").select("block"), "op8-anchors")
    hits = write_table(rolling.join(anchors, "block").groupBy("_id").agg(F.collect_list("place").alias("hits")), "op8-hits")
    for table in (rolling, index, anchors, shared, least):
        drop_table(table)
    near = keyed.join(places.join(hits, "_id"), ["_id", "_t"]).select("_id", "_t", "_text", "places", "hits")
    extended = write_table(near, "op8-runs", through=(extend, f"_id {kind}, _t bigint, place int, run_a bigint, run_b bigint"))
    firsts = extended.groupBy("run_a", "run_b").agg(F.min("_id").alias("low"), F.max("_id").alias("high")).where("low < high")
    firsts = write_table(firsts, "op8-firsts")
    found = extended.join(firsts, ["run_a", "run_b"]).where("_id > low").groupBy("_id", "_t").agg(F.collect_list("place").alias("starts"))
    out = write_table(
        found.select("_id", "_t", F.lit(False).alias("whole"), "starts").unionByName(
            copies.select("_id", "_t", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("starts"))
        ),
        "op8-found",
    )
    for table in (places, hits, extended, firsts, copies):
        drop_table(table)
    return out


def deduplicate(
    documents: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, carry: list[str] | None = None
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256[, kept_text]) for every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, unchanged.  A word goes
    when a window of ``window`` words that covers it also starts in a document
    with a smaller id; windows are judged on the input, so a window that stands
    twice in one document only is kept.  ``kept_text`` is the text itself where
    nothing goes, else the kept words joined by one space; ``carry`` names columns
    that come along in a struct ``_carry``.

    A null or empty text has no words; texts shorter than the window lose
    nothing; rows that repeat an id repeat their result and never remove each
    other; a null id is neither smaller nor larger, so its row keeps all; an
    empty table gives an empty result; other columns are not read.
    """
    keyed = _keyed(documents, id_col, text_col, carry)
    kind = keyed.schema["_id"].dataType.simpleString()
    found = repeat_starts(documents, window=window, id_col=id_col, text_col=text_col)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                raw = data.tobytes()
                totals, removed, digests, texts = [], [], [], []
                edges = offsets.tolist()
                for d, (whole, starts) in enumerate(zip(rows.column(2).to_pylist(), rows.column(3), strict=True)):
                    text = raw[edges[d] : edges[d + 1]]
                    words = text.split()
                    n, gone = len(words), 0
                    if whole and n >= window:
                        words, gone = [], n
                    elif starts.is_valid and len(starts):
                        at = starts.values.to_numpy()
                        cover = np.zeros(n + window + 1, dtype=np.int64)
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + window, -1)
                        keep = np.cumsum(cover)[:n] == 0
                        words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                        gone = n - len(words)
                    joined = b" ".join(words)
                    totals.append(n)
                    removed.append(gone)
                    digests.append(hashlib.sha256(joined).hexdigest())
                    if with_text:
                        texts.append((joined if gone else text).decode("utf-8"))
                columns = [rows.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
                names = [id_col, "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array(texts, pa.string()))
                    names.append("kept_text")
                if carry:
                    columns.append(rows.column(4))
                    names.append("_carry")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_col}` {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text
    if carry:
        schema += f", _carry {keyed.schema['_carry'].dataType.simpleString()}"
    joined = keyed.join(found, ["_id", "_t"], "left").select("_id", F.col("_text").alias("text"), "whole", "starts", *["_carry"] * bool(carry))
    out = joined.mapInArrow(lean(cut), schema)
    if with_text:  # as large as the input: not written twice
        return out
    out = result_table(out, "op8-result")
    drop_table(found)
    return out
