"""Byte-level text primitives over Arrow string buffers (numpy only).

Texts arrive as one UTF-8 buffer with offsets; words are found with a 256-entry
class table, and words or word windows are hashed with prefix sums of a
polynomial modulo 2**64 followed by a finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_KEPT = (1 << 18) + 2
_BYTE_VALUES = np.random.default_rng(20240917).integers(1, 2**63, size=(2, 256), dtype=np.uint64)


def class_table(members: bytes | None = None, *, without: bytes | None = None) -> np.ndarray:
    """Boolean table over byte values: the given members, or all but ``without``."""
    table = np.zeros(256, dtype=bool) if members is not None else np.ones(256, dtype=bool)
    table[list(members if members is not None else without)] = members is not None
    return table


#: ``[^\x20\x09-\x0D]+``
WORD = class_table(without=b"\x20\x09\x0a\x0b\x0c\x0d")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on text whose A-Z are lower-cased
ALNUM = class_table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte unchanged."""
    return _LOWER[data]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, off, raw = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole rows of about ``limit`` text bytes: (rows, bytes, offsets)."""
    if batch.num_rows == 0:
        return
    data, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def segment(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as (starts, ends, first): ``first[d]`` is the index of document d's first word."""
    inside = table[data]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = inside[edges]
    finish[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, _KEPT)
        out = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            out.append(np.cumprod(row, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= _KEPT:  # tables for longer texts go with them
            _POWERS[which] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of ``values[starts[i]:ends[i]]`` for each i, independent of the place."""
    power, inverse = _powers(len(values) + 1, which)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each word; long texts go in runs of words of about _KEPT bytes, which bounds the memory beyond the result."""
    out, at = np.empty(len(starts), dtype=np.uint64), 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _KEPT - 2, side="right")))
        out[at:to] = span_hash(_BYTE_VALUES[which][data[base : int(ends[to - 1])]], starts[at:to] - base, ends[at:to] - base, which)
        at = to
    return out


def gram_hashes(words: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of each run of k consecutive words; runs over document ends are for the caller to drop."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    at = np.arange(n)
    return span_hash(words, at, at + k, which)


def ragged(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges firsts[i] .. firsts[i]+lengths[i]-1."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    skip = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(firsts - skip, lengths)
