"""Operator 10: byte-level BPE encoding and decoding by backtracking.

Token bytes are read as Latin-1 strings so that a pyahocorasick automaton finds
all tokens in a pre-token at once.  The longest match is tried first; a token is
accepted when it is compatible with its left neighbour, i.e. when merging the two
neighbours' bytes alone would leave exactly these two tokens.  Compatibility is
memoised, dead positions are marked, and so the work is linear in the text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Encoded pre-tokens kept for reuse (in each of two generations), the longest pre-token kept, and the pairs of tokens whose compatibility is kept: these bound a worker's memory.
CACHE_ENTRIES, CACHE_PIECE, CACHE_PAIRS = 250_000, 64, 1_000_000


class ByteBpe:
    """Encoder and decoder of a ranked byte vocabulary (id = rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.text_of = {str(i): b for b, i in ranks.items()}
        self.ids = {b.decode("latin-1"): i for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for word, i in self.ids.items():
            self.automaton.add_word(word, i)
        self.automaton.make_automaton()
        self.widest = max(self.length.values())
        self.shorter = {i: self._prefix(word) for word, i in self.ids.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        for i in sorted(self.bytes_of):
            self._derive(i)
        self.fits.clear()
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        return cls({base64.b64decode(a): int(b) for a, b in rows}, pattern)

    def _prefix(self, word: str) -> int | None:
        for n in range(len(word) - 1, 0, -1):
            if (i := self.ids.get(word[:n])) is not None:
                return i
        return None

    def _derive(self, i: int) -> None:
        """Find the pair whose merge makes token i; single bytes and underivable tokens stay whole."""
        word = self.bytes_of[i].decode("latin-1")
        self.halves[i] = (i, i)
        left = self.shorter[i]
        while left is not None:
            right = self.ids.get(word[self.length[left] :])
            if right is not None and left < i and right < i and self.compatible(left, right):
                self.halves[i] = (left, right)
                self.joined[left, right] = i
                return
            left = self.shorter[left]

    def compatible(self, left: int, right: int) -> bool:
        """True when the two tokens stand side by side after merging their joint bytes."""
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > CACHE_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._compatible(left, right)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        # Undo merges from the last one backwards: a merge across the boundary that ranks below
        # everything undone so far would have come first.
        bound = 1 << 62
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < bound:
                return False
            for side in (0, 1) if a > b else (1, 0):
                if side == 0 and self.halves[a][1] != a:
                    bound, a = a, self.halves[a][1]
                    break
                if side == 1 and self.halves[b][0] != b:
                    bound, b = b + 1, self.halves[b][0]
                    break
            else:
                return True

    def _longest(self, word: str, at: int) -> int:
        """The longest token that starts at this place of a pre-token."""
        n = self.automaton.longest_prefix(word[at : at + self.widest])
        while n:
            token = self.ids.get(word[at : at + n])
            if token is not None:
                return token
            n -= 1
        raise ValueError("the vocabulary cannot spell this text")

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        word = piece.decode("latin-1")
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        length, fits, shorter, size = self.length, self.fits, self.shorter, len(word)
        dead: set[int] = set()
        out: list[int] = []
        last, at = -1, 0
        token = self._longest(word, 0)
        while True:
            end = at + length[token]
            if end not in dead:
                fit = True if last < 0 else fits.get((last, token))
                if fit is None:
                    fit = self.compatible(last, token)
                if fit:
                    out.append(token)
                    if end == size:
                        return out
                    last, at = token, end
                    token = self._longest(word, at)
                    continue
            token = shorter[token]
            if token is None:
                if not out:
                    raise ValueError("the vocabulary cannot spell this text")
                dead.add(at)
                token = out.pop()
                at -= length[token]
                last = out[-1] if out else -1

    def encode_csv(self, text: str) -> str:
        """Decimal ids of a whole text joined by commas."""
        known = self.known
        pieces = self.split(text)
        try:
            return ",".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        parts = []
        for piece in pieces:
            got = known.get(piece)
            if got is None:
                got = self.older.get(piece)
                if got is None:
                    got = ",".join(map(str, self.encode_piece(piece.encode("utf-8"))))
                if len(piece) <= CACHE_PIECE:
                    if len(known) >= CACHE_ENTRIES:
                        self.older = known
                        known = self.known = {}
                    known[piece] = got
            parts.append(got)
        return ",".join(parts)

    def encode(self, text: str) -> list[int]:
        csv = self.encode_csv(text)
        return [int(x) for x in csv.split(",")] if csv else []

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_TOOLS: dict[tuple[str, str], ByteBpe] = {}


def tool(path: str, pattern: str) -> ByteBpe:
    """One encoder per vocabulary and worker process."""
    if (path, pattern) not in _TOOLS:
        _TOOLS[path, pattern] = ByteBpe.from_file(path, pattern)
    return _TOOLS[path, pattern]


def encode(documents: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row.

    A null text gives an empty array, repeated rows and ids repeat, ties do not arise (merges are ordered by rank), an empty table gives an empty
    result, extra columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tool(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [bpe.encode(x or "") for x in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id") -> DataFrame:
    """(id, decoded binary) from ``encode``'s rows; a null array decodes to no bytes, repeated rows repeat, an empty table gives an empty result."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tool(path, pattern)
        for batch in batches:
            out = [bpe.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def round_trip(documents: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode every whole text, decode the ids, digest both.

    A null text counts as empty (0 tokens, digests of no bytes).  Ties do not
    arise: merges are totally ordered by rank.  Repeated rows give repeated
    results, an empty table an empty one; extra columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tool(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                counts, ids, back = [], [], []
                for text in rows.column(1).to_pylist():
                    csv = bpe.encode_csv(text or "")
                    parts = csv.split(",") if csv else []
                    counts.append(len(parts))
                    ids.append(hashlib.sha256(csv.encode("ascii")).hexdigest())
                    back.append(hashlib.sha256(b"".join(map(bpe.text_of.__getitem__, parts))).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
