"""Filter interaction audit as a product of incidence matrices.

Every document has a mask of the filters that it fails. A part's masks, counted for all of its documents, for the good and for the toxic ones, are rows of 32 numbers; stacked, they
are multiplied by integer matrices of 32 rows and a column for each step of each order of the filters (120 orders, 5 steps), one matrix for each outcome: kept, removed, redundant, unique.
So all orders cost one pass over the texts, and the product is as small as the number of parts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_column, word_blocks
from tidemark.storage import contained, materialize

#: A: fewer than MIN_WORDS words; B: less than DISTINCT % of the words differ; C: over UPPER % of the code points are A-Z; D: one of SYMBOLS; E: text of a smaller key.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT, UPPER, SYMBOLS = 50, 65, 5, b"#$%&*|"
CAPITALS, CONTINUED = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
#: Bytes of text whose different words are held at once.
WORD_BYTES = 8 << 20
#: Parts that one product takes.
STACK = 64


def different(text: bytes, size: int = WORD_BYTES) -> tuple[int, int]:
    """(words, different words). Those of a long text are counted class by class of a hash, so memory follows ``size`` and the count stays exact."""
    classes = len(text) // size + 1
    if classes == 1:
        words = text.split()
        return len(words), len(set(words))
    n = distinct = 0
    for c in range(classes):
        seen: set[bytes] = set()
        for block in word_blocks(text):
            n += len(block) if not c else 0
            seen.update(w for w in block if zlib.crc32(w) % classes == c)
        distinct += len(seen)
    return n, distinct


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words, distinct = different(text)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (words < MIN_WORDS, 100 * distinct < DISTINCT * words, 100 * capitals > UPPER * len(text.translate(None, CONTINUED)), len(text.translate(None, SYMBOLS)) < len(text))
    return sum(1 << i for i, f in enumerate(fails) if f)


@dataclass(frozen=True)
class Outcomes:
    """Columns are the steps of all orders: ``order`` and ``step`` name them; kept, removed, redundant, unique: int64, 32 rows (masks) each."""

    order: list[str]
    step: np.ndarray
    letter: np.ndarray
    kept: np.ndarray
    removed: np.ndarray
    redundant: np.ndarray
    unique: np.ndarray


def outcomes(filters: str = FILTERS) -> Outcomes:
    masks, n = np.arange(1 << len(filters)), len(filters)
    orders = list(permutations(range(n)))
    letter = np.array(orders).reshape(-1)
    own = 1 << letter
    earlier = np.array([[sum(1 << f for f in o[:i]) for i in range(n)] for o in orders]).reshape(-1)
    fails, gone = (masks[:, None] & own) > 0, (masks[:, None] & earlier) > 0
    steps = (~fails & ~gone, fails & ~gone, fails & gone, masks[:, None] == own)
    return Outcomes(["".join(filters[f] for f in o) for o in orders for _ in range(n)], np.tile(np.arange(1, n + 1), len(orders)), letter, *[x.astype(np.int64) for x in steps])


def marks(docs: DataFrame, key: str = "doc_id", part: str = "source", text: str = "text") -> DataFrame:
    """(k, part, mask, digest) per row: the bits of A to D, and SHA-256 of the text. Null text or part: empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in byte_column(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([text_mask(t) for t in texts], pa.int32()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], ["k", "part", "mask", "digest"])

    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("t"))
    return rows.mapInArrow(run, f"k {docs.schema[key].dataType.simpleString()}, part string, mask int, digest binary")


def histograms(marked: DataFrame, labels: DataFrame, label_key: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic), mask with the bit of E. labels: quality 1 is good, toxic 1 is toxic; several labels of a key count together.

    A key fails E if the least key of its text is smaller; a null key is neither smaller nor larger than any. A text's copies never meet: they are reduced to their least key where they
    lie, and that key alone is looked up again.
    """
    labelled = labels.groupBy(F.col(label_key).alias("label_key")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    least = marked.groupBy("digest").agg(F.min("k").alias("least")).where("least is not null").withColumnRenamed("digest", "of")
    rows = marked.join(labelled, F.col("k") == F.col("label_key"), "left").join(least, (F.col("k") == F.col("least")) & (F.col("digest") == F.col("of")), "left")
    copy = F.col("least").isNull() & F.col("k").isNotNull()
    mask = F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    return rows.groupBy("part", mask.alias("mask")).agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part, order and step, zeros included."""
    m = outcomes()
    n, width = len(FILTERS), len(m.order)
    order, step = pa.array(m.order, pa.string()), pa.array(m.step, pa.int32())
    product = np.concatenate([m.kept, m.removed, m.redundant, m.unique], axis=1)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STACK):
                rows = batch.slice(at, STACK).to_pylist()
                stack = np.zeros((3, len(rows), 1 << n), np.int64)
                for i, r in enumerate(rows):
                    for x in r["counts"]:
                        stack[:, i, x["mask"]] += (x["n"], x["good"], x["toxic"])
                kept, removed, redundant, unique = np.split(stack[0] @ product, 4, axis=1)
                good, toxic = (stack[1:].reshape(-1, 1 << n) @ m.removed).reshape(2, len(rows), width)
                by_letter = np.stack([removed[:, m.letter == f].sum(axis=1) for f in range(n)], axis=1)
                columns = [kept, removed, redundant, unique, good, toxic, by_letter[:, m.letter]]
                part = pa.array([r["part"] for r in rows for _ in range(width)], pa.string())
                yield pa.RecordBatch.from_arrays([part, pa.concat_arrays([order] * len(rows)), pa.concat_arrays([step] * len(rows)), *[pa.array(x.reshape(-1), pa.int64()) for x in columns]], names)

    # a part has 32 masks at most
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return per_part.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names[3:]))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "source", text: str = "text", label_key: str = "doc_id") -> DataFrame:
    """``interactions`` of the five filters over whole texts. Repeated rows count each; equal keys with equal texts are no copies of each other.

    Null texts are empty ones (and copies of each other), null parts the part ''. Labels of unknown or null keys count nowhere. No documents: no rows. Other columns are ignored.
    """
    return contained(docs.sparkSession, "audit", lambda: interactions(histograms(materialize(marks(docs, key, part, text), "marks"), labels, label_key)))
