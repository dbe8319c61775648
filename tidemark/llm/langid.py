"""Language identification as multilingual mixture inference.

Learned: for each language, frequencies of hashed byte 4-grams of lower-cased text. Inferred, per document: a mixture
of languages. A document starts with its best single language; the language along which the likelihood rises
fastest is added, proportions are refitted by expectation-maximisation, and the larger set stays only if the gain
in log-likelihood exceeds a penalty of half the log of the sample size for each added proportion. All steps run over
numpy arrays of many documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_column, safe_pieces, sampled, steps

GRAM = 4
BUCKETS = 1 << 16
#: About so many different labelled texts a fit reads, as many of each language, picked by a hash of the text.
FIT_ROWS = 20_000
#: Longer texts are counted in pieces of that many bytes.
PIECE = 1 << 20
UND = "und"
_PLAIN = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def has_letter(text: bytes | None) -> bool:
    """Whether any character is of a letter category (digits, fractions and signs are not)."""
    return text is not None and any(map(str.isalpha, text.decode("utf-8", "replace")))


@dataclass
class Model:
    """Languages in code-point order, log probabilities (language, bucket), and how many grams taught each language."""

    names: list[str]
    logp: np.ndarray
    taught: np.ndarray


def _buckets(text: bytes) -> np.ndarray:
    """Gram buckets in text order; text: lower-cased UTF-8 with documents between zero bytes. Grams across documents or with two spaces in a row get -1."""
    a = np.frombuffer(text, np.uint8)
    if len(a) < GRAM:
        return np.empty(0, np.int64)
    x = a.astype(np.uint32)
    code = x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24
    h = (code * np.uint32(2654435761)) >> np.uint32(16)
    gap = a == 32
    bad = a == 0
    off = bad[:-3] | bad[1:-2] | bad[2:-1] | bad[3:]
    pair = gap[:-1] & gap[1:]
    off |= pair[:-2] | pair[1:-1] | pair[2:]
    return np.where(off, -1, h.astype(np.int64))


def _plain(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode().translate(_PLAIN)


def _long_counts(text: bytes, size: int) -> np.ndarray:
    """Counts of all buckets of a text, piece by piece; each piece brings the end of the one before, so no gram is lost or counted twice."""
    total, tail = np.zeros(BUCKETS, np.int64), b" "
    for piece in [*safe_pieces(text, size), None]:
        now = tail + (b" " if piece is None else _plain(piece))
        h = _buckets(now)
        total += np.bincount(h[h >= 0], minlength=BUCKETS)
        tail = now[-(GRAM - 1) :]
    return total


def gram_counts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document index, bucket, count) of whole texts, sorted by document. A long text that comes alone is counted in pieces, with the same counts."""
    if len(texts) == 1 and len(texts[0] or b"") > PIECE:
        total = _long_counts(texts[0], PIECE)
        found = np.flatnonzero(total)
        return np.zeros(len(found), np.int64), found, total[found]
    joined = b"\0".join(b" " + _plain(t or b"") + b" " for t in texts)
    h = _buckets(joined)
    doc = np.cumsum(np.frombuffer(joined, np.uint8) == 0)[: len(h)]
    key = np.sort((doc * BUCKETS + h)[h >= 0])
    if not len(key):
        return key, key, key
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first] // BUCKETS, key[first] % BUCKETS, np.diff(np.r_[first, len(key)])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Add-half smoothed gram frequencies of each language.

    Rows with a null language teach nothing. About ``fit_rows`` texts are read at most, in equal shares of the languages, so a rare one keeps its texts: the documented bound of the sample. A text
    of one language teaches once, however many rows repeat it. With no labelled row the model has no language, and every document is ``und``.
    """
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    rows = sampled(rows, "h", fit_rows, "l").dropDuplicates(["l", "h"]).select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), byte_column(batch.column(1))
            for s, e in steps(texts):
                d, b, c = gram_counts(texts[s:e])
                for name in set(langs[s:e]):
                    mine = np.array([x == name for x in langs[s:e]])[d] if len(d) else np.zeros(0, bool)
                    if name not in seen:
                        seen[name] = np.zeros(BUCKETS, np.int64)
                    seen[name] += np.bincount(b[mine], c[mine], BUCKETS).astype(np.int64)
        for name, total in seen.items():
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int32)), pa.array(total[found])], ["l", "b", "n"])

    got = rows.mapInArrow(count, "l string, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(got.column("l").to_pylist()))
    counts = np.zeros((len(names), BUCKETS))
    at = {x: i for i, x in enumerate(names)}
    counts[[at[x] for x in got.column("l").to_pylist()], got.column("b").to_numpy()] = got.column("n").to_numpy()
    p = counts + 0.5
    return Model(names, np.log(p / p.sum(axis=1, keepdims=True)).astype(np.float32), counts.sum(axis=1))


def _mix(q: np.ndarray, c: np.ndarray, starts: np.ndarray, total: np.ndarray, doc: np.ndarray, pi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: q (gram, language) likelihoods relative to some base, pi (document, language) proportions, 0 where not in the set."""
    for _ in range(rounds):
        part = q * pi[doc]
        part *= (c / part.sum(axis=1))[:, None]
        pi = np.add.reduceat(part, starts, axis=0) / total[:, None]
    return pi, np.add.reduceat(c * np.log((q * pi[doc]).sum(axis=1)), starts)


def infer(texts: list[bytes | None], logp: np.ndarray, rounds: int = 20, penalty: float = 1.0) -> np.ndarray:
    """(document, language) proportions that sum to 1; all 0 for a document without a gram."""
    langs = len(logp)
    out = np.zeros((len(texts), langs))
    doc, bucket, count = gram_counts(texts)
    if not len(doc) or not langs:
        return out
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    ids = doc[starts]
    c = count.astype(np.float32)
    total = np.add.reduceat(c, starts)
    lp = logp[:, bucket].T
    single = np.add.reduceat(lp * c[:, None], starts, axis=0)
    pi = np.zeros((len(ids), langs), np.float32)
    pi[np.arange(len(ids)), single.argmax(axis=1)] = 1
    # overlapping grams repeat what a character says, GRAM times over
    need = penalty * 0.5 * np.log(np.maximum(total / GRAM, 2)) * GRAM
    gain = np.zeros(len(ids), np.float32)
    q = np.exp(lp - lp.max(axis=1, keepdims=True))
    open_ = np.arange(len(ids)) if langs > 1 else np.arange(0)
    size = np.diff(np.r_[starts, len(doc)])
    base = np.add.reduceat(c * lp.max(axis=1), starts)
    gain[:] = single.max(axis=1) - base
    while len(open_):
        rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[open_], size[open_], strict=True)])
        d = np.repeat(np.arange(len(open_)), size[open_])
        s = np.r_[0, np.cumsum(size[open_])[:-1]]
        density = (q[rows] * pi[open_][d]).sum(axis=1)
        slope = np.add.reduceat(q[rows] * (c[rows] / density)[:, None], s, axis=0) - total[open_][:, None]
        slope[pi[open_] > 0] = -np.inf
        add = slope.argmax(axis=1)
        rise = np.flatnonzero(slope[np.arange(len(open_)), add] > 0)
        if not len(rise):
            break
        keep = np.isin(d, rise)
        rows, n = rows[keep], size[open_[rise]]
        d, s = np.repeat(np.arange(len(rise)), n), np.r_[0, np.cumsum(n)[:-1]]
        open_ = open_[rise]
        trial = pi[open_] * 0.75
        trial[np.arange(len(open_)), add[rise]] = 0.25
        trial, got = _mix(q[rows], c[rows], s, total[open_], d, trial, rounds)
        better = got - gain[open_] > need[open_]
        open_ = open_[better]
        pi[open_], gain[open_] = trial[better], got[better]
        open_ = open_[(pi[open_] > 0).sum(axis=1) < langs]
    out[ids] = pi / pi.sum(axis=1, keepdims=True)
    return out


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column expression over ``docs``: lang_pred, score (its share of the text), langs (those of the set, by share).

    Null text, or no letter in it: ``und``, 0.0, no languages. A text whose letters form no gram at all has the language most was learned of, with that
    language's share of what was learned as its score; one whose grams are all unknown has the best single language.
    """
    names, logp = model.names, model.logp
    most = int(model.taught.argmax()) if names else 0
    prior = float(model.taught[most] / max(1.0, model.taught.sum())) if names else 0.0
    held = docs.sparkSession.sparkContext.broadcast(logp)  # languages x BUCKETS floats: bounded by the number of languages

    @F.arrow_udf("lang_pred string, score double, langs array<string>")
    def run(column: pa.Array) -> pa.Array:
        texts, rows = byte_column(column), []
        for s, e in steps(texts):
            share = infer(texts[s:e], held.value)
            best = share.argmax(axis=1) if names else np.zeros(e - s, int)
            for t, p, k in zip(texts[s:e], share, best, strict=True):
                if not names or not has_letter(t):
                    rows.append((UND, 0.0, []))
                elif not p[k]:
                    rows.append((names[most], prior, [names[most]]))
                else:
                    rows.append((names[k], float(min(1.0, p[k])), [names[j] for j in np.argsort(-p, kind="stable") if p[j] > 0]))
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.StructArray.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.list_(pa.string()))], ["lang_pred", "score", "langs"])

    return run(F.col(text))


def keep_identified(docs: DataFrame, model: Model, text: str = "text", min_share: float = 0.2) -> DataFrame:
    """The input rows, columns untouched, whose text has a language that fills at least ``min_share`` of it. ``und`` goes."""
    marked = docs.withColumn("__tm_language", predict(docs, model, text))
    return marked.where((F.col("__tm_language.lang_pred") != UND) & (F.col("__tm_language.score") >= min_share)).drop("__tm_language")
