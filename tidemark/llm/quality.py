"""Quality classifier with supervised subword embeddings.

Words and character n-grams are hashed to learned vectors, averaged over a document and put through a softmax layer; all weights are
trained by stochastic gradient descent in numpy. Of word n-grams only those count that begin and end with the same word: whatever the word, they share
one vector for each length, so that repetition is learned from few labels. For scoring, the two layers fold into one weight per bucket (the difference of
the two classes' outputs), so a whole corpus costs one look-up a feature.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_column, in_sample, safe_pieces, sample_limits, steps

BUCKETS = 1 << 17
#: Lengths of the character n-grams.
GRAMS = (3, 4)
#: Distances at which a word that comes again is a feature; each has a row of its own behind the buckets.
LAGS = (1, 2, 3, 4)
ROWS = BUCKETS + len(LAGS)
DIM = 8
#: About so many different labelled texts a fit reads, as many of each label, picked by a hash of the text: the documented bound of the sample.
FIT_ROWS = 6_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACES = (9, 10, 11, 12, 13, 32)
#: Longer texts are counted in pieces of that many bytes.
PIECE = 2 << 20
_STEP = 0x100000001B3


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd step and of its inverse, modulo 2^64, up to 2^bits of them."""
    n = 1 << bits
    rows = [np.full(n, np.uint64(x)) for x in (_STEP, pow(_STEP, -1, 2**64))]
    for r in rows:
        r[0] = 1
    return tuple(np.multiply.accumulate(r) for r in rows)


def _points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def _grams(a: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and buckets of the n-grams of code points that hold no zero."""
    m = len(a) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    code, ok = np.full(m, n, np.uint32), np.ones(m, bool)
    for k in range(n):
        code = code * np.uint32(0x01000193) + a[k : m + k]
        ok &= a[k : m + k] != 0
    code ^= code >> np.uint32(15)
    at = np.flatnonzero(ok)
    return at, (code * np.uint32(2654435761) >> np.uint32(32 - 17))[at]


def _words(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words between white space."""
    gap = np.isin(a, (0, *_SPACES))
    starts = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
    ends = np.flatnonzero(~gap & np.r_[gap[1:], True]) + 1
    up, down = _powers(max(10, len(a).bit_length()))
    total = np.r_[np.uint64(0), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], dtype=np.uint64)]
    return starts, (total[ends] - total[starts]) * down[starts]


def _word_bucket(word: np.ndarray) -> np.ndarray:
    return ((word ^ (word >> np.uint64(29))) * _ODD >> np.uint64(64 - 17)).astype(np.uint32)


def features(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(document, row) of every word, of every 3-gram and 4-gram of characters, and of every word that comes again at one of LAGS; joined: documents between zero bytes. Case and signs count."""
    a = _points(joined)
    doc = np.cumsum(a == 0)
    out_d, out_b = [], []
    for n in GRAMS:
        at, b = _grams(a, n)
        out_d.append(doc[at])
        out_b.append(b)
    starts, word = _words(a)
    of = doc[starts]
    out_d.append(of)
    out_b.append(_word_bucket(word))
    for k, lag in enumerate(LAGS):
        again = of[lag:][(word[lag:] == word[:-lag]) & (of[lag:] == of[:-lag])]
        out_d.append(again)
        out_b.append(np.full(len(again), BUCKETS + k, np.uint32))
    return np.concatenate(out_d), np.concatenate(out_b)


def _long_rows(text: bytes, size: int) -> Iterator[np.ndarray]:
    """The rows of one text's features, piece by piece; each piece brings the last characters and words of the one before, so that all are as in the whole."""
    tail, before = np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    for piece in safe_pieces(text, size):
        a = _points(piece)
        near = np.r_[tail, a]
        for n in GRAMS:
            yield _grams(near[max(0, len(tail) - n + 1) :], n)[1]
        _, word = _words(a)
        yield _word_bucket(word)
        words = np.r_[before, word]
        for k, lag in enumerate(LAGS):
            at = np.arange(len(before), len(words))
            at = at[at >= lag]
            yield np.full(int((words[at] == words[at - lag]).sum()), BUCKETS + k, np.uint32)
        tail, before = near[-max(GRAMS) + 1 :], words[-max(LAGS) :]


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a text's features, ascending, and how often each occurs."""
    text = text.replace(b"\0", b" ")
    if len(text) <= PIECE:
        return np.unique(features(text)[1], return_counts=True)
    total = sum((np.bincount(b, minlength=ROWS) for b in _long_rows(text, PIECE)), np.zeros(ROWS, np.int64))
    found = np.flatnonzero(total)
    return found.astype(np.uint32), total[found]


@dataclass
class Model:
    """weight: of each row, for label 1 against label 0; bias likewise."""

    weight: np.ndarray
    bias: float


def scores(texts: list[bytes | None], model: Model) -> np.ndarray:
    """Probability of label 1. No feature (null, empty): that of the bias alone."""
    out = np.empty(len(texts))
    for s, e in steps(texts, PIECE):
        part = [(t or b"").replace(b"\0", b" ") for t in texts[s:e]]
        if len(part) == 1 and len(part[0]) > PIECE:
            total = n = np.zeros(1)
            for b in _long_rows(part[0], PIECE):
                total, n = total + model.weight[b].sum(dtype=np.float64), n + len(b)
        else:
            d, b = features(b"\0".join(part))
            total, n = np.bincount(d, model.weight[b], e - s), np.bincount(d, minlength=e - s)
        out[s:e] = 1 / (1 + np.exp(-(total / np.maximum(n, 1) + model.bias)))
    return out


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, rate: float = 1.0, batch: int = 16, seed: int = 5) -> Model:
    """Embeddings (ROWS x DIM) and a softmax layer of two classes, by mini-batch stochastic gradient descent with a falling rate. docs: rows and counts, as by ``counted``."""
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / DIM, 1 / DIM, (ROWS, DIM)).astype(np.float32)
    layer, bias = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    docs = [(ids, (n / max(1, n.sum())).astype(np.float32)) for ids, n in docs]
    y = labels.astype(int)
    classes = np.maximum(np.bincount(y, minlength=2), 1)
    at = 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for s in range(0, len(order), batch):
            chosen = order[s : s + batch]
            lr = rate * (1 - at / (epochs * len(docs)))
            at += len(chosen)
            mean = np.stack([docs[i][1] @ embedding[docs[i][0]] for i in chosen])
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            # both classes weigh alike, however rare one is
            p *= (len(y) / (2 * classes[y[chosen]]))[:, None] / len(chosen)
            back = p @ layer.T
            layer -= lr * mean.T @ p
            bias -= lr * p.sum(axis=0)
            # the mean over hundreds of features damps each one's gradient, so the embeddings step further
            for i, g in zip(chosen, back, strict=True):
                ids, share = docs[i]
                embedding[ids] -= np.outer(share, (lr * 40) * g)
    fold = embedding @ (layer[:, 1] - layer[:, 0])
    return Model(fold.astype(np.float32), float(bias[1] - bias[0]))


def _packed(ids: np.ndarray, n: np.ndarray) -> bytes:
    return zlib.compress(np.stack([np.diff(ids.astype(np.int32), prepend=np.int32(0)), n.astype(np.int32)]).tobytes(), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps_, n = np.frombuffer(zlib.decompress(packed), np.int32).reshape(2, -1)
    return np.cumsum(steps_, dtype=np.int32), n


def fit(docs: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text", label: str = "label", fit_rows: int = FIT_ROWS) -> Model:
    """From rows with label 0 or 1, which docs carry or ``labels`` (key, label) give; null texts and labels teach nothing, and a text of one label teaches once, however many rows repeat it.

    Without both labels: every score is the share of label 1, or one half of none. Labels meet hashes of texts first; of the texts, only those of the sample are moved.
    """
    kind = F.col(label).cast("int").alias("y")
    known = docs.where(F.col(text).isNotNull()).select(*([F.col(key).alias("k")] if labels is not None else [F.when(F.col(label).isin(0, 1), kind).alias("y")]), F.col(text).cast("binary").alias("t"), F.xxhash64(text).alias("h"))
    marks = None if labels is None else labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("label_of"), kind)
    with_label = lambda rows: rows.where("y is not null") if marks is None else rows.join(marks, F.col("k") == F.col("label_of"))
    limits = sample_limits(with_label(known.drop("t")), "h", fit_rows, "y")
    if limits:
        known = known.where(F.shiftrightunsigned("h", 1) < max(limits.values()))
    rows = with_label(known)
    rows = (rows.where(in_sample(limits, "h", "y")) if limits else rows).dropDuplicates(["h", "y"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(2).to_pylist()):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([_packed(*counted(t))])], ["h", "y", "counts"])

    # counts, not texts: a text of any length gives ROWS of them at most
    got = rows.select("h", "y", "t").mapInArrow(count, "h long, y int, counts binary").toArrow().sort_by([("h", "ascending"), ("y", "ascending")])
    y = got.column("y").to_numpy().astype(int)
    if len(set(y.tolist())) < 2:
        share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
        return Model(np.zeros(ROWS, np.float32), float(np.log(share / (1 - share))))
    return train([_unpacked(x) for x in got.column("counts").to_pylist()], y)


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Probability of label 1 for each row's whole text, by that text alone. Null and empty texts, and those without a word, have the probability of the bias; repeated rows have equal ones, and no row is dropped. Other columns are ignored."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # one float for each of ROWS, whatever the corpus

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(scores(byte_column(column), held.value), pa.float64())

    return run(F.col(text))
