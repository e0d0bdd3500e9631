"""Operator 7: variable-capacity best-fit packing.

Pieces go, longest first, into the open bin with the least room that still holds
them; without one, a bin is opened whose permitted size has the least cost per
token it can be expected to hold, and at the end every bin shrinks to the
smallest permitted size for its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelforge.llm.arrowtext import buffers, ragged
from parcelforge.llm.spill import lean

#: Permitted sequence lengths in tokens; a sequence of size s costs s + s*s/KNEE + BIN_COST.
SIZES = (2048, 4096, 8192, 16384)
BIN_COST, KNEE = 256.0, 65536.0
#: Pieces and bytes packed together in one task's memory.
BLOCK_PIECES, BLOCK_BYTES = 8192, 1 << 25


def pack(lengths: np.ndarray, sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, size of the bin) of each piece; lengths are at most max(sizes).  Ties go by position."""
    sizes = tuple(sorted(sizes))
    order = np.argsort(-lengths, kind="stable")
    sorted_down = lengths[order]
    ascending = sorted_down[::-1]
    mass = np.concatenate([[0], np.cumsum(ascending)])
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room: list[tuple[int, int]] = []  # (free, bin), ascending
    used: list[int] = []
    for place, (item, length) in enumerate(zip(order.tolist(), sorted_down.tolist(), strict=True)):
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, where = room.pop(at)
        else:
            left = n - place - 1  # the pieces still to come are the `left` shortest
            best = None
            for size in sizes:
                if size >= length:
                    fit = min(left, int(np.searchsorted(ascending, size - length, side="right")))
                    filled = min(size, length + int(mass[fit]))
                    best = min(best or (np.inf, 0), ((size + size * size / KNEE + BIN_COST) / max(filled, 1), size))
            free, where = best[1], len(used)
            used.append(0)
        bins[item], offsets[item] = where, used[where]
        used[where] += length
        if free > length:
            insort(room, (free - length, where))
    final = np.array([next(s for s in sizes if s >= u) for u in used], dtype=np.int64)
    return bins, offsets, final[bins] if n else bins


def cut(data: np.ndarray, offsets: np.ndarray, largest: int, whole_characters: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, number in the row, start in ``data``, length) of the pieces: rows of at most ``largest`` are one piece, also empty ones.

    With ``whole_characters`` the data are UTF-8 and a piece ends before a character that would not fit whole.
    """
    rows, numbers, starts, lengths = [], [], [], []
    for row, (at, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        number = 0
        while True:
            to = min(at + largest, end)
            if whole_characters and to < end:
                while data[to] & 0xC0 == 0x80:  # a continuation byte
                    to -= 1
            rows.append(row)
            numbers.append(number)
            starts.append(at)
            lengths.append(to - at)
            at, number = to, number + 1
            if at >= end:
                break
    return np.array(rows, np.int64), np.array(numbers, np.int64), np.array(starts, np.int64), np.array(lengths, np.int64)


def _sequences(rows: pa.Table, tokens: bool, sizes: tuple[int, ...], first_id: int, names: list[str]) -> pa.RecordBatch:
    """One row per bin, of rows (id, row, content)."""
    content = rows.column(2).combine_chunks()
    if isinstance(content, pa.ChunkedArray):
        content = content.combine_chunks()
    if tokens:
        lists = pc.fill_null(content, []) if content.null_count else content
        data = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    else:
        data, offsets = buffers(content)
    row, number, start, length = cut(data, offsets, max(sizes), not tokens)
    bins, place, size = pack(length, sizes)
    order = np.lexsort((place, length == 0, bins))  # empty pieces share a place with what follows them
    edge = np.flatnonzero(np.diff(bins[order], prepend=-1))
    lists_at = pa.array(np.append(edge, len(order)).astype(np.int32))
    used = np.add.reduceat(length[order], edge)
    filled = data[ragged(start[order], length[order])]
    ends = pa.array(np.concatenate([[0], np.cumsum(used)]).astype(np.int64 if not tokens else np.int32))
    if tokens:
        body = pa.ListArray.from_arrays(ends, pa.array(filled))
    else:
        body = pa.LargeStringArray.from_buffers(len(used), ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(filled))).cast(pa.string())
    taken = row[order]
    listed = [
        rows.column(0).combine_chunks().take(pa.array(taken)), rows.column(1).combine_chunks().take(pa.array(taken)), pa.array(number[order], pa.int32()),
        pa.array(start[order] - offsets[taken]), pa.array(place[order], pa.int32()), pa.array(length[order], pa.int32()),
    ]
    plain = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in listed]
    ids = pa.array(first_id + np.arange(len(used), dtype=np.int64))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(size[order][edge], pa.int32()), pa.array(used, pa.int32()), *[pa.ListArray.from_arrays(lists_at, x) for x in plain], body], names=names
    )


def pack_documents(
    documents: DataFrame,
    *,
    sizes: tuple[int, ...] = SIZES,
    block_pieces: int = BLOCK_PIECES,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens_col: str | None = None,
) -> DataFrame:
    """One row per training sequence: (sequence_id, size, used, ids, rows, pieces, starts, offsets, lengths, content).

    The tokens are the bytes of UTF-8 texts (``content`` is a text), or, with
    ``tokens_col``, the ids in that column (``content`` is an array).  The lists
    say, in the order of the content, from which row (id and a hash of its
    content, as an id may repeat) and from which start a piece comes, and where
    it lies in the sequence.  A row longer than the largest size is cut into
    pieces, texts between characters; every token of every row stands in one
    place.

    Rows are dealt by a hash and packed in blocks of ``block_pieces`` pieces or
    ``block_bytes``, in the order of id and hash, so a task holds one block.  Of
    pieces of one length the earlier row goes first; of bins with the same room
    the older is filled.  Null and empty rows are one piece of length 0; rows that
    repeat another are packed again; null ids are packed as others; an empty
    table gives an empty result; other columns are not read.
    """
    content = F.col(tokens_col).cast("array<int>") if tokens_col else F.coalesce(F.col(text_col), F.lit(""))
    rows = documents.select(F.col(id_col).alias("_id"), content.alias("_content"))
    rows = rows.select("_id", F.xxhash64("_content").alias("_row"), "_content")
    dealt = rows.repartition(F.xxhash64("_id", "_row")).sortWithinPartitions("_id", "_row")
    kind = documents.schema[id_col].dataType.simpleString()
    names = ["sequence_id", "size", "used", "ids", "rows", "pieces", "starts", "offsets", "lengths", "content"]
    largest, width = max(sizes), 4 if tokens_col else 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held, pieces, size = [], 0, 0

        def emit() -> pa.RecordBatch:
            nonlocal held, pieces, size, number
            out = _sequences(pa.Table.from_batches(held), tokens_col is not None, sizes, number, names)
            number += out.num_rows
            held, pieces, size = [], 0, 0
            return out

        for batch in batches:
            column = batch.column(2)
            lengths = (pc.list_value_length(column) if tokens_col else pc.binary_length(column)).fill_null(0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                # rows until the block is full; a single row may overfill it
                many = np.cumsum(np.maximum(-(-lengths[at:] // largest), 1))
                mass = np.cumsum(lengths[at:] * width)
                fits = int(min(np.searchsorted(many, block_pieces - pieces, side="right"), np.searchsorted(mass, block_bytes - size, side="right")))
                if not fits and held:
                    yield emit()
                    continue
                fits = max(1, fits)
                held.append(batch.slice(at, fits))
                pieces, size, at = pieces + int(many[fits - 1]), size + int(mass[fits - 1]), at + fits
        if held:
            yield emit()

    schema = (
        f"sequence_id bigint, size int, used int, ids array<{kind}>, rows array<bigint>, pieces array<int>, starts array<bigint>, offsets array<int>, "
        f"lengths array<int>, content {'array<int>' if tokens_col else 'string'}"
    )
    return dealt.mapInArrow(lean(run), schema)
