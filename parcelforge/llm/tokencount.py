"""Operator 3: token counts by rank-synchronous array merging.

Unique pre-tokens of a batch of texts are laid out as one ragged numpy array of
symbols.  In each round every sequence finds its lowest-ranked adjacent pair and
all its occurrences are merged at once; sequences without a mergeable pair leave
the array, and the symbols they still have are their token count.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from parcelforge.llm.arrowtext import buffers

#: Pre-token counts kept for reuse in each of two generations (the older one goes and is recomputed when met again), and the longest pre-token kept.
CACHE_ENTRIES, CACHE_PIECE = 200_000, 64
_NONE = np.int64(1) << 40


def byte_symbols() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies -> byte value."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Counts the symbols that survive all merges of a byte-level BPE vocabulary."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocabulary.values()) + 1
        self.first = np.zeros(256, dtype=np.int64)
        for symbol, byte in byte_symbols().items():
            self.first[byte] = vocabulary[symbol]
        left = np.array([vocabulary[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in merges], dtype=np.int64)
        self.result = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        self.size = size
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.rank_of = key[order], order.astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], _NONE)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each non-empty piece."""
        out = np.zeros(len(pieces), dtype=np.int64)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        alive = np.flatnonzero(lengths)
        lengths = lengths[alive]
        symbols = self.first[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        if not len(alive):
            return out
        rank = np.full(len(symbols), _NONE)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        rank[np.cumsum(lengths) - 1] = _NONE
        while True:
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NONE
            if done.any():
                out[alive[done]] = lengths[done]
                stay = ~done
                keep = np.repeat(stay, lengths)
                symbols, rank = symbols[keep], rank[keep]
                alive, lengths, lowest = alive[stay], lengths[stay], lowest[stay]
                if not len(alive):
                    return out
            hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
            if len(hit) > 1:  # in a run of overlapping occurrences every second one merges
                fresh = np.ones(len(hit), dtype=bool)
                fresh[1:] = np.diff(hit) != 1
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbols[hit] = self.result[rank[hit]]
            last = np.zeros(len(symbols), dtype=bool)
            last[np.cumsum(lengths) - 1] = True
            last[hit] |= last[hit + 1]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            ends = np.cumsum(lengths)
            gone = np.concatenate([[0], np.cumsum(~keep)])
            lengths = lengths - (gone[ends] - gone[ends - lengths])
            place = hit - gone[hit]
            symbols, rank, last = symbols[keep], rank[keep], last[keep]
            touched = np.concatenate([place, place[place > 0] - 1])
            rank[touched] = _NONE
            touched = touched[~last[touched]]
            rank[touched] = self.ranks(symbols[touched], symbols[touched + 1])


class TokenCounter:
    """Counts tokens of whole texts; added special strings inside texts count as one token each."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ", 1)) for m in model["model"]["merges"]]
        self.merger = RankMerger(model["model"]["vocab"], merges)
        self.split = regex.compile(pattern).findall
        added = sorted((t["content"] for t in model.get("added_tokens") or []), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _learn(self, fresh: list[str]) -> None:
        if len(self.known) > CACHE_ENTRIES:
            self.older, self.known = self.known, {}
        old, unseen = self.older, []
        for piece in fresh:
            n = old.get(piece)
            if n is None:
                unseen.append(piece)
            else:
                self.known[piece] = n
        if unseen:
            self.known.update(zip(unseen, self.merger.counts([p.encode("utf-8") for p in unseen]).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        pieces, extra = [], []
        for text in texts:
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                pieces.append([x for part in parts for x in self.split(part)])
                extra.append(len(parts) - 1)
            else:
                pieces.append(self.split(text))
                extra.append(0)
        fresh = set().union(*pieces).difference(self.known) if pieces else set()
        if len(self.known) + len(fresh) > CACHE_ENTRIES:
            self._learn(list(set().union(*pieces)))
        else:
            self._learn(list(fresh))
        try:
            out = [sum(map(self.known.__getitem__, p)) + e for p, e in zip(pieces, extra, strict=True)]
        except KeyError:  # the cache turned over between: learn all of this batch anew
            self._learn(list(set().union(*pieces)))
            out = [sum(map(self.known.__getitem__, p)) + e for p, e in zip(pieces, extra, strict=True)]
        for piece in [p for p in fresh if len(p) > CACHE_PIECE]:  # long ones seldom come again and would fill the memory
            self.known.pop(piece, None)
        return out


_COUNTERS: dict[tuple[str, str], TokenCounter] = {}


def counter(path: str, pattern: str) -> TokenCounter:
    """One counter per vocabulary and worker process."""
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = TokenCounter(path, pattern)
    return _COUNTERS[path, pattern]


def count_tokens(
    documents: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row.

    ``path`` is the vocabulary file as the workers see it and ``pattern`` its
    pre-token pattern.  A null text counts as empty (0 bytes, 0 tokens); repeated
    rows give repeated results; an empty table gives an empty result; columns
    beyond the two named are not read.  Memory is bounded by one Arrow batch and
    the pre-token cache.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(path, pattern)
        for batch in batches:
            _, offsets = buffers(batch.column(1))
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [x or "" for x in rows.column(1).to_pylist()]
                sizes = np.diff(offsets[at : at + rows.num_rows + 1])
                tokens = np.array(tool.count(texts), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                    names=[id_col, "n_bytes", "n_tokens", "over_limit"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
