"""Operator 1: toxicity by a bidirectional gated recurrent network, trained and run in numpy.

Each word enters with a word embedding and the element-wise maximum of its
character n-gram embeddings (both hashed).  Two gated recurrent layers read a
window in both directions, attention pools their states, and a logistic unit
scores the window.  All windows of WIDTH words at STRIDE are scored, so that
each word lies in four of them and any run of 25 words whole in one; a document's
score is that of its highest window.  The first dimension of each embedding is
set, before training, to the clipped excess of its bucket among toxic documents
of one half of the sample (a log-odds table); the rest is random.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelforge.llm.arrowtext import ALNUM, _BYTE_VALUES, lower, ragged, segment, slices, span_hash, word_hashes
from parcelforge.llm.spill import lean

#: Words of a window, words between the starts of neighbours when scoring, and when training.
WIDTH, STRIDE, TRAINING_STRIDE = 32, 8, 16
BUCKETS, DIM, HIDDEN, ATTENTION = 1 << 15, 8, 8, 8
#: Bound of the training sample: labelled rows of each class (those with the least hash of the id) and their longest text.
SAMPLE_PER_CLASS, SAMPLE_BYTES = 2000, 65_536
#: Windows that go through the network together.
BLOCK = 4096
EPOCHS, LEAST_STEPS, BATCH, RATE = 6, 300, 32, 0.01
GRAMS = (3, 4, 5)


class Words:
    """The distinct words of a run of texts and their character n-grams, as hash buckets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = lower(data)
        starts, ends, self.first = segment(low, offsets, ALNUM)
        hashes = word_hashes(low, starts, ends)
        unique, at, self.word = np.unique(hashes, return_index=True, return_inverse=True)
        self.bucket = (unique % np.uint64(BUCKETS)).astype(np.int64)
        # distinct words laid out with a mark on both sides
        sizes = (ends - starts)[at] + 2
        begin = np.cumsum(sizes) - sizes
        text = np.full(int(sizes.sum()), 0x20, dtype=np.uint8)
        inner = ragged(begin + 1, sizes - 2)
        text[inner] = low[ragged(starts[at], sizes - 2)]
        grams, owners = [], []
        for k in GRAMS:
            count = np.maximum(sizes - k + 1, 0) if k > 3 else np.maximum(sizes - k + 1, 1)
            place = ragged(begin, count)
            end = np.minimum(place + k, np.repeat(begin + sizes, count))
            grams.append((span_hash(_BYTE_VALUES[1][text], place, end, 1) % np.uint64(BUCKETS)).astype(np.int64) if len(place) else place)
            owners.append(np.repeat(np.arange(len(at)), count))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.gram, self.gram_first = np.concatenate(grams)[order].astype(np.int32), np.searchsorted(owner[order], np.arange(len(at) + 1))

    def starts(self, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word of each window, end of its document, first window of each document); at least one window per document."""
        count = np.diff(self.first)
        each = np.maximum(1, -(-(count - (WIDTH - stride)) // stride))
        start = np.repeat(self.first[:-1], each) + stride * ragged(np.zeros(len(each), np.int64), each)
        return start, np.repeat(self.first[1:], each), np.concatenate([[0], np.cumsum(each)])

    def words_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Windows x WIDTH word numbers, -1 beyond the text."""
        at = start[:, None] + np.arange(WIDTH)
        inside = at < end[:, None]
        ids = np.full(at.shape, -1, dtype=np.int32)
        ids[inside] = self.word[at[inside]]
        return ids

    def windows(self, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all windows, first window of each document)."""
        start, end, first = self.starts(stride)
        return self.words_of(start, end), first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Network:
    """Parameters and passes of the network."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)

        def make(*shape: int, scale: float | None = None) -> np.ndarray:
            return (rng.normal(size=shape) * (scale or 1 / np.sqrt(shape[0]))).astype(np.float32)

        self.p = {"word": make(BUCKETS, DIM, scale=0.05), "gram": make(BUCKETS, DIM, scale=0.05)}
        for side in "fb":
            self.p |= {f"W{side}": make(2 * DIM, 3 * HIDDEN), f"U{side}": make(HIDDEN, 3 * HIDDEN), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": make(2 * HIDDEN, ATTENTION), "a": make(ATTENTION), "o": make(2 * HIDDEN), "c": np.array([-2.0], np.float32)}
        self.constant: float | None = None  # the score of everything, when there was nothing to learn from

    def inputs(self, words: Words) -> np.ndarray:
        """(distinct words x 2 DIM): word part and character part."""
        if not len(words.bucket):
            return np.zeros((0, 2 * DIM), np.float32)
        chars = np.maximum.reduceat(self.p["gram"][words.gram], words.gram_first[:-1], axis=0)
        return np.concatenate([self.p["word"][words.bucket], chars], axis=1)

    def _direction(self, side: str, table: np.ndarray, ids: np.ndarray, keep: list | None) -> np.ndarray:
        u, n = self.p[f"U{side}"], len(ids)
        states = np.zeros((WIDTH, n, HIDDEN), np.float32)
        h = np.zeros((n, HIDDEN), np.float32)
        for t in range(WIDTH) if side == "f" else range(WIDTH - 1, -1, -1):
            now = ids[:, t]
            live = now >= 0
            if live.any():
                x = table[now]
                hu = h @ u
                gates = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
                r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
                nxt = np.where(live[:, None], new + z * (h - new), h)
                if keep is not None:
                    keep.append((t, live, h, hu, r, z, new))
                h = nxt
            states[t] = h * live[:, None]
        return states

    def forward(self, table_in: np.ndarray, ids: np.ndarray, cache: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        keeps = {"f": [], "b": []} if cache is not None else {"f": None, "b": None}
        pad = np.zeros((1, 3 * HIDDEN), np.float32)
        states = np.concatenate(
            [self._direction(s, np.concatenate([table_in @ self.p[f"W{s}"] + self.p[f"b{s}"], pad]), ids, keeps[s]) for s in "fb"], axis=2
        )
        hidden = np.tanh(states @ self.p["A"])
        weight = hidden @ self.p["a"]
        weight = np.where(ids.T >= 0, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        if cache is not None:
            cache.update(keeps=keeps, states=states, hidden=hidden, weight=weight, pooled=pooled)
        return pooled @ self.p["o"] + self.p["c"][0]

    def backward(self, words: Words, table_in: np.ndarray, ids: np.ndarray, cache: dict, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of sum(slope * logit)."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        states, hidden, weight = cache["states"], cache["hidden"], cache["weight"]
        g["o"], g["c"] = cache["pooled"].T @ slope, np.array([slope.sum()], np.float32)
        d_pool = slope[:, None] * p["o"]
        d_states = weight[:, :, None] * d_pool
        d_weight = (states * d_pool).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["a"] = np.tensordot(d_score, hidden, axes=([0, 1], [0, 1]))
        d_hidden = d_score[:, :, None] * p["a"] * (1 - hidden**2)
        g["A"] = np.tensordot(states, d_hidden, axes=([0, 1], [0, 1]))
        d_states = d_states + d_hidden @ p["A"].T
        d_in = np.zeros_like(table_in)
        for s, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            d_h = np.zeros((len(ids), HIDDEN), np.float32)
            d_table = np.zeros((len(table_in) + 1, 3 * HIDDEN), np.float32)
            for t, live, h, hu, r, z, new in reversed(cache["keeps"][s]):
                mask = live[:, None]
                d_h = d_h + d_states[t][:, part] * mask
                d_new = d_h * (1 - z) * (1 - new**2) * mask
                d_z = d_h * (h - new) * z * (1 - z) * mask
                d_r = d_new * hu[:, 2 * HIDDEN :] * r * (1 - r)
                d_x = np.concatenate([d_r, d_z, d_new], axis=1)
                d_hu = np.concatenate([d_r, d_z, d_new * r], axis=1)
                g[f"U{s}"] += h.T @ d_hu
                np.add.at(d_table, ids[:, t], d_x)
                d_h = np.where(mask, d_h * z, d_h) + d_hu @ p[f"U{s}"].T
            d_table = d_table[:-1]
            g[f"W{s}"], g[f"b{s}"] = table_in.T @ d_table, d_table.sum(axis=0)
            d_in += d_table @ p[f"W{s}"].T
        np.add.at(g["word"], words.bucket, d_in[:, :DIM])
        hit = np.flatnonzero(np.abs(d_in).sum(axis=1))
        for w in hit.tolist():  # the maximum passes its slope to the n-gram that gave it
            own = words.gram[words.gram_first[w] : words.gram_first[w + 1]]
            best = own[p["gram"][own].argmax(axis=0)]
            np.add.at(g["gram"], (best, np.arange(DIM)), d_in[w, DIM:])
        return g

    def scores(self, data: np.ndarray, offsets: np.ndarray, stride: int = STRIDE) -> np.ndarray:
        """Score of each document: that of its highest window."""
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        words = Words(data, offsets)
        table = self.inputs(words)
        start, end, first = words.starts(stride)
        # windows go in blocks, so the states in memory do not grow with the text
        logits = [self.forward(table, words.words_of(start[at : at + BLOCK], end[at : at + BLOCK])) for at in range(0, len(start), BLOCK)]
        return _sigmoid(np.maximum.reduceat(np.concatenate(logits), first[:-1]).astype(np.float64))


def _odds(texts: list[str], labels: np.ndarray, chunk: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Excess of each word and n-gram bucket among toxic documents, counted by document; 0 where it is no more than chance."""
    counts = np.zeros((2, 2, BUCKETS))  # word or n-gram, label, bucket
    for at in range(0, len(texts), chunk):  # a few documents at a time bound the memory
        words, own = Words(*_layout(texts[at : at + chunk])), labels[at : at + chunk]
        doc = np.repeat(np.arange(len(own)), np.diff(words.first))
        if not len(doc):
            continue
        pairs = np.unique(doc * len(words.bucket) + words.word)
        doc, word = pairs // len(words.bucket), pairs % len(words.bucket)
        many = np.diff(words.gram_first)[word]
        grams = words.gram[ragged(words.gram_first[word], many)]
        for kind, d, bucket in ((0, doc, words.bucket[word]), (1, np.repeat(doc, many), grams)):
            key = np.unique(d * BUCKETS + bucket)
            np.add.at(counts[kind], (own[key // BUCKETS], key % BUCKETS), 1)
    n_none, n_one = max(1, (labels == 0).sum()), max(1, (labels == 1).sum())
    rate = counts.sum(axis=1) / (n_one + n_none)
    excess = (counts[:, 1] - n_one * rate) / np.sqrt(n_one * rate * (1 - rate) * n_none / (n_one + n_none) + 1.0)
    out = (np.clip(excess - 2.0, 0, 6) / 2).astype(np.float32)
    return out[0], out[1]


def _layout(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def train(texts: list[str], labels: list[int], weights: tuple[float, float] = (1.0, 1.0), seed: int = 5) -> Network:
    """Fit a network on labelled texts.  ``weights`` are those of the classes 0 and 1.

    One half of the sample sets the first embedding dimension (its log odds), the
    other half trains all parameters on the highest window of each document.
    Without both classes the network is the constant rate of ones, without any text 0.
    """
    net, y = Network(seed), np.array(labels, dtype=np.int64)
    if not len(y) or y.min() == y.max():
        net.constant = (int(y.sum()) + 1) / (len(y) + 2) if len(y) else 0.0
        return net
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    half = order[: len(order) // 2]
    word_odds, gram_odds = _odds([texts[i] for i in half], y[half])
    net.p["word"][:, 0], net.p["gram"][:, 0] = word_odds, gram_odds
    rest = order[len(order) // 2 :]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step, epochs = 0, max(EPOCHS, -(-LEAST_STEPS * BATCH // len(rest)))
    batches = []
    for at in range(0, len(rest), BATCH):
        pick = rest[at : at + BATCH]
        words = Words(*_layout([texts[i] for i in pick]))
        batches.append((pick, words, *words.windows(TRAINING_STRIDE)))
    for epoch in range(epochs):
        rng.shuffle(batches)
        for pick, words, ids, first in batches:
            table = net.inputs(words)
            if epoch == 0:  # where the odds point, before the network can tell
                odds = np.append(table[:, 0] + table[:, DIM], 0.0)
                logits = odds[ids].sum(axis=1)
            else:
                logits = net.forward(table, ids)
            best = np.array([lo + int(logits[lo:hi].argmax()) for lo, hi in zip(first[:-1], first[1:], strict=True)])
            cache: dict = {}
            logit = net.forward(table, ids[best], cache)
            scale = np.where(y[pick] == 1, weights[1], weights[0]) / len(pick)
            slope = ((_sigmoid(logit) - y[pick]) * scale).astype(np.float32)
            grads = net.backward(words, table, ids[best], cache, slope)
            step += 1
            rate = RATE * (1 - epoch / (epochs + 1))
            for k, v in net.p.items():
                m, s = moments[k]
                if k in ("word", "gram"):
                    rows = np.unique(words.bucket if k == "word" else words.gram)
                    m[rows] = 0.9 * m[rows] + 0.1 * grads[k][rows]
                    s[rows] = 0.999 * s[rows] + 0.001 * grads[k][rows] ** 2
                    v[rows] -= 0.1 * rate * m[rows] / (np.sqrt(s[rows]) + 1e-4)
                else:
                    m += 0.1 * (grads[k] - m)
                    s += 0.001 * (grads[k] ** 2 - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-6)
    return net


def held_out(id_column):
    """crc32 of the id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))), F.lit(5)) == 0


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
    text_bytes: int = SAMPLE_BYTES,
) -> Network:
    """Train on a bounded sample of the labelled rows outside the held-out fifth (null labels and null texts are left out).

    The bound is ``per_class`` ids of each class, those with the least hash of the
    id, with one text of at most ``text_bytes`` bytes each, the shortest; the
    classes are weighted back to their counts among all such ids.  An id with
    several labels counts as the largest.  Without both classes in the sample the
    score is a constant, 0 without any labelled text.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y")).where("_id is not null")
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}  # two rows
    picked = None
    for y in (0, 1):
        some = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    texts = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.octet_length("_text") <= text_bytes)
    one = texts.join(F.broadcast(picked), "_id").groupBy("_id", "_y").agg(F.min(F.struct(F.octet_length("_text").alias("n"), "_text")).alias("_t"))
    rows = one.select("_id", "_t._text", "_y").collect()  # at most 2 * per_class texts of text_bytes
    rows.sort(key=lambda r: r["_id"])
    ys = [r["_y"] for r in rows]
    weights = tuple(counts.get(y, 0) / max(1, ys.count(y)) for y in (0, 1))
    mean = sum(weights[y] for y in ys) / max(1, len(ys))
    return train([r["_text"] for r in rows], ys, (weights[0] / mean, weights[1] / mean) if ys else (1.0, 1.0))


def score(documents: DataFrame, network: Network, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``documents`` with ``score_col`` (0 to 1) added, from the whole text alone.

    A null or empty text is one window without words and scores as the bias
    says; repeated rows repeat; an empty table gives an empty result.
    A column of the documents that has the name ``score_col`` already is replaced.
    """
    documents = documents.drop(score_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, text_col):
                got = pa.array(network.scores(data, offsets), pa.float64())
                yield pa.RecordBatch.from_arrays([*rows.columns, got], names=[*rows.schema.names, score_col])

    schema = documents.select("*", F.lit(0.0).alias(score_col)).schema
    return documents.mapInArrow(lean(run), schema)
