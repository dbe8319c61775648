"""Ranked lexical search, score at a time over an impact-ordered index.

``index`` keeps documents in blocks, each a row of its own: for every asked term its postings grouped by exact impact, largest first, and beside them the same
postings by document. ``search`` takes a block's groups of an item's terms in descending order, level by level, and adds them to the documents' scores. It stops only
when what the terms can still add proves that no document outside of a set of candidates can be among the best; the candidates' scores are then completed from
their own postings, so all scores are exact. A task's best scores so far are a bound for its later blocks, which often end before they begin.

Items are a stated query set: they stream through the driver into batches of bounded size, and each batch has an index of its terms. A block is bounded by its postings, so
memory does not follow the table, a hot term or a group of copies.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_column, word_blocks
from tidemark.storage import contained, materialize

#: UTF-8 bytes of terms: letters and digits of ASCII, A-Z lower-cased, and all beyond ASCII; any other is a space.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Postings of a block (its last document may go beyond), and different terms of all items of a batch together.
POSTINGS, BATCH_TERMS = 1 << 17, 200_000
#: Fixed values of the ranking: saturation, and the share of a document's length, in hundredths.
SATURATION, LENGTH_SHARE = 12, 25

_BLOCK = "upto binary, terms binary, impacts binary, term_list binary, term_upto binary, group_impact binary, group_upto binary, postings binary"


@dataclass(frozen=True)
class Batch:
    """Items of one batch: ``items`` has for each (number, term numbers, times); ``terms`` numbers the different terms."""

    terms: dict[bytes, int]
    items: list[tuple[int, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Index:
    """blocks: rows of ``key`` (array of document keys) and the packed postings; weights: of the batch's terms by number, 0 for a term that no document holds."""

    blocks: DataFrame
    batch: Batch
    weights: np.ndarray


def term_counts(text: bytes | None) -> dict[bytes, int]:
    """Terms of a text and how often each occurs."""
    out: dict[bytes, int] = {}
    for words in word_blocks((text or b"").translate(TERMS)):
        for w in words:
            out[w] = out.get(w, 0) + 1
    return out


def batches(items: DataFrame, text: str, limit: int = BATCH_TERMS) -> Iterator[Batch]:
    """items: a column ``q``, the item's number, and its text. The terms of a batch are ``limit`` in all, but for a longer single item."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for q, t in zip(part.column(0).to_pylist(), byte_column(part.column(1)), strict=True):
                found = term_counts(t)
                yield pa.RecordBatch.from_arrays([pa.array([q], pa.int64()), pa.array([list(found)], pa.list_(pa.binary())), pa.array([list(found.values())], pa.list_(pa.int64()))], ["q", "terms", "times"])

    terms, found, size = {}, [], 0
    for row in items.select("q", text).mapInArrow(run, "q long, terms array<binary>, times array<long>").toLocalIterator():
        if not row.terms:
            continue
        if found and size + len(row.terms) > limit:
            yield Batch(terms, found)
            terms, found, size = {}, [], 0
        numbers = [terms.setdefault(bytes(t), len(terms)) for t in row.terms]
        found.append((row.q, np.array(numbers, np.int64), np.array(row.times, np.int64)))
        size += len(numbers)
    if found:
        yield Batch(terms, found)


def _counted(terms: dict[bytes, int]):
    """(k, n, terms, times): a document's number of terms, and which of the asked ones it holds how often."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = terms.get
        for part in parts:
            n, held, times = [], [], []
            for t in byte_column(part.column(1)):
                total, numbers, counts = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
                for words in word_blocks((t or b"").translate(TERMS)):
                    total += len(words)
                    more, of = np.unique(np.array([x for w in words if (x := get(w)) is not None], np.int64), return_counts=True)
                    if len(numbers):
                        numbers, at = np.unique(np.concatenate([numbers, more]), return_inverse=True)
                        counts = np.bincount(at, np.concatenate([counts, of]), len(numbers)).astype(np.int64)
                    else:
                        numbers, counts = more, of
                n.append(total)
                held.append(numbers.astype(np.uint32).tobytes())
                times.append(counts.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(held, pa.binary()), pa.array(times, pa.binary())], ["k", "n", "terms", "times"])

    return run


def _statistics(size: int):
    """Sums of a part: term -2 counts documents with a term, -1 all terms, others the documents that hold the term."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held = np.zeros(2, np.int64), np.zeros(size, np.int64)
        for part in parts:
            n = part.column(0).to_numpy()
            docs += (np.count_nonzero(n), n.sum())
            held += np.bincount(np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, some]), pa.array(np.r_[docs, held[some]])], ["term", "n"])

    return run


def _blocks(docs: int, length: int, limit: int):
    """Blocks of documents: postings by document, and by term in groups of one impact, largest first. Documents stand by key in a block, nulls last."""

    def block(keys: pa.Array, n: np.ndarray, terms: list[bytes], times: list[bytes]) -> pa.RecordBatch:
        order = pc.sort_indices(keys)
        at = order.to_numpy()
        size = np.array([len(terms[i]) // 4 for i in at])
        of, tf = np.frombuffer(b"".join(terms[i] for i in at), np.uint32).astype(np.int64), np.frombuffer(b"".join(times[i] for i in at), np.int64)
        m = np.repeat(100 - LENGTH_SHARE + LENGTH_SHARE * n[at] * docs // length, size)
        impact = 1_000_000_000 * tf // (1000 * tf + SATURATION * m)
        doc = np.repeat(np.arange(len(at)), size)
        by = np.lexsort((doc, -impact, of))
        new_term = np.r_[True, of[by][1:] != of[by][:-1]]
        new_group = new_term | np.r_[True, impact[by][1:] != impact[by][:-1]]
        ends = lambda starts, total: np.r_[np.flatnonzero(starts)[1:], total]
        packed = (np.cumsum(size), of, impact, of[by][new_term], ends(new_term[new_group], np.count_nonzero(new_group)), impact[by][new_group], ends(new_group, len(by)), doc[by])
        sorted_keys = keys.take(order)
        whole = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), sorted_keys)
        return pa.RecordBatch.from_arrays([whole, *[pa.array([x.astype(np.uint32).tobytes()], pa.binary()) for x in packed]], ["key", *[c.split()[0] for c in _BLOCK.split(", ")]])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, terms, times, held = [], [], [], [], 0
        for part in parts:
            own, last = [part.column(i).to_pylist() for i in (2, 3)], 0
            for i, t in enumerate(own[0]):
                held += len(t) // 4
                if held >= limit or i + 1 == part.num_rows:
                    piece = part.slice(last, i + 1 - last)
                    keys.append(piece.column(0))
                    n.append(piece.column(1).to_numpy())
                    terms += own[0][last : i + 1]
                    times += own[1][last : i + 1]
                    last = i + 1
                    if held >= limit:
                        yield block(pa.concat_arrays(keys), np.concatenate(n), terms, times)
                        keys, n, terms, times, held = [], [], [], [], 0
        if held:
            yield block(pa.concat_arrays(keys), np.concatenate(n), terms, times)

    return run


def index(docs: DataFrame, batch: Batch, key: str = "doc_id", text: str = "text", postings: int = POSTINGS) -> Index:
    """The index of a batch's terms over all documents. Null or termless texts have no postings and count in no statistic; a repeated row is a document of its own."""
    size = len(batch.terms)
    counted = materialize(docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(_counted(batch.terms), f"k {docs.schema[key].dataType.simpleString()}, n long, terms binary, times binary"), "counted")
    # a row a term of the batch
    sums = {r.term: r.n for r in counted.select("n", "terms").mapInArrow(_statistics(size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n, length = sums.get(-2, 0), sums.get(-1, 0)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * sums[t] + 1))) if t in sums else 0 for t in range(size)], np.int64)
    rows = counted.where(F.octet_length("terms") > 0).mapInArrow(_blocks(n, max(length, 1), postings), f"key array<{docs.schema[key].dataType.simpleString()}>, {_BLOCK}")
    return Index(materialize(rows, "impacts"), batch, weights)


class _Block:
    def __init__(self, packed: list[bytes], size: int):
        self.upto, self.terms, self.impacts, held, term_upto, impact, group_upto, self.docs = (np.frombuffer(x, np.uint32).astype(np.int64) for x in packed)
        self.end, self.group = np.r_[0, group_upto], -impact
        self.slot = np.full(size, -1)
        self.slot[held] = np.arange(len(held))
        self.first = np.r_[0, term_upto]

    def best(self, terms: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores): the ``k`` best of at least ``floor``, ties by number. weight: of each term, greater than 0."""
        slot = self.slot[terms]
        weight, terms, slot = weight[slot >= 0], terms[slot >= 0], slot[slot >= 0]
        at, last = self.first[slot], self.first[slot + 1]
        following = -self.group[at] * weight if len(at) else weight
        score = np.zeros(len(self.upto), np.int64)
        while True:
            rest = int(following.sum())
            low = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0)
            if rest < low:
                found = np.flatnonzero(score + rest >= low)
                if not len(found):
                    return found, found
                # another level is worth its while as long as more postings are left than the candidates have
                if not rest or len(found) * len(self.terms) <= int((self.end[last] - self.end[at]).sum()) * len(self.upto):
                    break
            level = (int(following.max()) + 1) // 2
            for i in np.flatnonzero(following >= level).tolist():
                w = int(weight[i])
                to = at[i] + np.searchsorted(self.group[at[i] : last[i]], -level // w, "right")
                docs = self.docs[self.end[at[i]] : self.end[to]]
                # a term has a document once
                score[docs] += w * np.repeat(-self.group[at[i] : to], np.diff(self.end[at[i] : to + 1]))
                at[i] = to
                following[i] = -self.group[to] * w if to < last[i] else 0
        exact = score[found] if not rest else self.complete(found, terms, weight)
        kept = exact >= floor
        order = np.lexsort((found[kept], -exact[kept]))[:k]
        return found[kept][order], exact[kept][order]

    def complete(self, docs: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        of = np.zeros(len(self.slot), np.int64)
        of[terms] = weight
        start = np.r_[0, self.upto][docs]
        size = self.upto[docs] - start
        begin = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(start - begin, size)
        return np.add.reduceat(self.impacts[at] * of[self.terms[at]], begin)


def _found(batch: Batch, weights: np.ndarray, k: int):
    asked = []
    for q, terms, times in batch.items:
        weight = times * weights[terms]
        asked.append((q, terms[weight > 0], weight[weight > 0]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[int]] = {}
        for part in parts:
            for row in range(part.num_rows):
                block = _Block([part.column(i)[row].as_py() for i in range(1, part.num_columns)], len(weights))
                qs, docs, scores = [], [], []
                for q, terms, weight in asked:
                    known = best.setdefault(q, [])
                    found, score = block.best(terms, weight, k, known[0] if len(known) == k else 1)
                    qs.append(np.full(len(found), q))
                    docs.append(found)
                    scores.append(score)
                    for s in score.tolist():
                        (heapq.heappush if len(known) < k else heapq.heappushpop)(known, s)
                keys = part.column(0)[row].values
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(qs), pa.int64()), keys.take(pa.array(np.concatenate(docs), pa.int64())), pa.array(np.concatenate(scores), pa.int64())], ["q", "k", "score"])

    return run


def best_of(found: Index, k: int) -> DataFrame:
    """(q, k, score): among them each item's ``k`` best documents. A task gives no more than ``k`` of a block and none that k better ones of its own exclude."""
    kind = found.blocks.schema["key"].dataType.elementType.simpleString()
    return found.blocks.mapInArrow(_found(found.batch, found.weights, k), f"q long, k {kind}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", batch_terms: int = BATCH_TERMS, postings: int = POSTINGS) -> DataFrame:
    """(item, rank, doc, score): each item's ``k`` documents of the highest scores above 0, fewer if there are no more; ties by key, nulls last.

    Null texts and texts without a term find nothing and are not found. Repeated rows of either table are items or documents of their own, so a repeated key comes back as often.
    Empty tables give an empty result; other columns are ignored, whatever their names.
    """
    spark: SparkSession = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()

    def ranks() -> DataFrame:
        numbered = materialize(items.select(F.monotonically_increasing_id().alias("q"), F.col(item_key).alias("item"), F.col(item_text).alias("t")), "items")
        parts = [materialize(best_of(index(docs, b, key, text, postings), k), "found") for b in batches(numbered, "t", batch_terms)]
        found = reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], f"q long, k {kind}, score long")
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("k"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.join(numbered.select("q", "item"), "q").select("item", "rank", F.col("k").alias("doc"), "score")

    return contained(spark, "ranks", ranks)
