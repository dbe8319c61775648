"""Document fingerprints by locally consistent parsing.

A text is cut into tokens: at white space, at every character of scripts without spaces, and inside words where a hash of the last three bytes says so, whatever the
word's length, so that unspaced text is cut alike wherever it stands. A token's name is the hash of its bytes.
Level by level, deterministic coin tossing groups names into phrases: a run of one name is a phrase; elsewhere names are
reduced to labels below six by the lowest bit in which neighbours differ, and phrases start at local maxima of the labels
and at minima between them. A phrase's name is the hash of its parts, and phrases of a level are the next level's text. Where to cut
depends on a few neighbours only, so equal substrings have equal phrases inside, at any offset, on every level.
The fingerprint holds the top name and the ``k`` smallest hashes among the phrase names of all levels, each occurrence counted. All documents of a
block are parsed at once in numpy, a long text in pieces.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import STEP_BYTES

K = 64
#: One in so many places inside a word is a cut.
CUT_ONE_IN = 16
_STEP = 0x100000001B3
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd step and of its inverse, modulo 2^64."""
    n = 1 << bits
    rows = [np.full(n, np.uint64(x)) for x in (_STEP, pow(_STEP, -1, 2**64))]
    for r in rows:
        r[0] = 1
    return tuple(np.multiply.accumulate(r) for r in rows)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes or names that one numpy step of parsing holds; on either side of a step, more than a cut depends on.
PIECE, MARGIN = 3 << 20, 16


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomials of values[s:e] for each range, alike at every offset."""
    up, down = _powers(max(10, len(values).bit_length() + 1))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def _hashed(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return _scramble(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class _Names:
    """Names of consecutive ranges that come in pieces; the last one of a piece may go on in the next."""

    def __init__(self) -> None:
        self.sum = self.length = 0

    def add(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray, goes_on: bool) -> np.ndarray:
        """Names of the ranges that end here. goes_on: the first range continues the one left open; the last one is left open if it reaches the end of ``values``."""
        sums, lengths = _sums(values, starts, ends), ends - starts
        if goes_on and len(sums):
            sums[0] = np.uint64((self.sum + pow(_STEP, self.length, 2**64) * int(sums[0])) % 2**64)
            lengths[0] += self.length
        if len(ends) and ends[-1] == len(values):
            self.sum, self.length = int(sums[-1]), int(lengths[-1])
            sums, lengths = sums[:-1], lengths[:-1]
        return _hashed(sums, lengths)

    def close(self) -> np.ndarray:
        return _hashed(np.array([self.sum], np.uint64), np.array([self.length]))


def _ranges(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names of the ranges that start there and end at the next start."""
    if len(values) <= PIECE:
        return _hashed(_sums(values, starts, ends := np.r_[starts[1:], len(values)]), ends - starts)
    names, out = _Names(), []
    for at in range(0, len(values), PIECE):
        end = min(at + PIECE, len(values))
        own = starts[np.searchsorted(starts, at) : np.searchsorted(starts, end)] - at
        if at and len(own) and not own[0]:
            out.append(names.close())
        goes_on = bool(at) and not (len(own) and not own[0])
        begin = np.r_[0, own] if goes_on else own
        out.append(names.add(values[at:end], begin, np.r_[begin[1:], end - at], goes_on))
    return np.concatenate([*out, names.close()])


def _cuts(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where a token starts, where there is none) in bytes that start at a text or three bytes and a code point before what counts."""
    gap = _SPACE[a]
    inside = ~gap
    start = inside & np.r_[True, gap[:-1]]
    lead = (a & 0xC0) != 0x80
    if len(a) > 3:
        # three bytes of the word itself stand before a cut
        within = inside[:-3] & inside[1:-2] & inside[2:-1] & inside[3:] & lead[3:]
        x = a.astype(np.uint32)
        last = x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16)
        start[3:] |= within & ((last * np.uint32(2654435761)) >> np.uint32(16) < np.uint32((1 << 16) // CUT_ONE_IN))
    # every code point of these scripts, and what follows one, is a token of its own: lead bytes E3 and above
    wide = a >= 0xE3
    if wide.any():
        owner = np.maximum.accumulate(np.where(lead, np.arange(len(a)), 0))
        of_wide = wide[owner]
        start |= inside & lead & (wide | np.r_[False, of_wide[:-1]])
    return start, gap


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, name) of every token, in order. Memory follows ``PIECE`` and the number of tokens."""
    a = np.frombuffer(b" ".join(texts), np.uint8)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    docs, out, names, open_at = [np.zeros(0, np.int32)], [np.zeros(0, np.uint64)], _Names(), None
    owner = lambda at: (np.searchsorted(bounds, at, side="right") - 1).astype(np.int32)
    for p in range(0, len(a), PIECE):
        end, low = min(p + PIECE, len(a)), max(0, p - MARGIN)
        start, gap = (x[p - low :] for x in _cuts(a[low:end]))
        at, stop = np.flatnonzero(start), np.flatnonzero(gap)
        if open_at is not None and (start[0] or gap[0]):
            out.append(names.close())
            docs.append(owner(np.array([open_at])))
            open_at = None
        goes_on = open_at is not None
        if goes_on:
            at = np.r_[0, at]
        if not len(at):
            continue
        ends = np.minimum(np.r_[at[1:], end - p], np.r_[stop, end - p][np.searchsorted(stop, at)])
        found = names.add(a[p:end].astype(np.uint64), at, ends, goes_on)
        where = at + p
        if goes_on:
            where[0] = open_at
        out.append(found)
        docs.append(owner(where[: len(found)]))
        open_at = int(where[-1]) if len(found) < len(where) else None
    if open_at is not None:
        out.append(names.close())
        docs.append(owner(np.array([open_at])))
    return np.concatenate(docs), np.concatenate(out)


def _toss(now: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Twice the lowest bit position in which a name differs from its left neighbour, plus the name's bit there."""
    x = now ^ before
    low = x & (~x + np.uint64(1))
    position = np.bitwise_count(low - np.uint64(1)).astype(np.uint64)
    return position * np.uint64(2) + ((now >> position) & np.uint64(1))


def phrases(doc: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Starts of the phrases of one level, in pieces: a cut depends on a few neighbours only."""
    if len(name) <= PIECE:
        return _starts(doc, name)
    out = []
    for at in range(0, len(name), PIECE):
        low, end = max(0, at - MARGIN), min(len(name), at + PIECE)
        found = _starts(doc[low : end + MARGIN], name[low : end + MARGIN]) + low
        out.append(found[np.searchsorted(found, at) : np.searchsorted(found, end)])
    return np.concatenate(out)


def _starts(doc: np.ndarray, name: np.ndarray) -> np.ndarray:
    n = len(name)
    first = np.r_[True, doc[1:] != doc[:-1]]
    same = np.r_[False, (name[1:] == name[:-1])] & ~first
    run = same | np.r_[same[1:], False]  # members of runs
    cut = first | (run & ~same) | (~run & np.r_[False, run[:-1]])
    # stretches without runs: starts at cuts; labels from the left neighbour, the first from its own lowest bit
    label, head = name, cut | run
    for _ in range(4):
        before = np.empty_like(label)
        before[0] = 0
        before[1:] = label[:-1]
        label = _toss(label, np.where(head, label ^ np.uint64(1), before))
    left = np.arange(n) - np.maximum.accumulate(np.where(cut, np.arange(n), 0))
    last = np.r_[cut[1:], True]
    prev, nxt = np.r_[label[:1], label[:-1]], np.r_[label[1:], label[-1:]]
    inner = ~run & (left >= 2) & ~last
    high = inner & (label > prev) & (label > nxt)
    near = np.r_[False, high[:-1]] | np.r_[high[1:], False]
    low = inner & (label < prev) & (label < nxt) & ~near
    return np.flatnonzero(cut | high | low)


def sketches(texts: list[bytes], k: int = K) -> list[str]:
    """Fingerprints: 16 hexadecimal digits of the top name, then 8 for each kept hash, ascending."""
    doc, name = tokens(texts)
    top = np.zeros(len(texts), np.uint64)
    docs, kept, level = [], [], 0
    if len(doc):
        size = np.bincount(doc, minlength=len(texts))
        lone = (size == 1)[doc]  # a single token is its own phrase
        docs.append(doc[lone])
        kept.append(name[lone])
    while len(doc):
        size = np.bincount(doc, minlength=len(texts))
        done = (size == 1)[doc]
        if done.any():
            top[doc[done]] = _scramble(name[done] + np.uint64(level))
            doc, name = doc[~done], name[~done]
            if not len(doc):
                break
        at = phrases(doc, name)
        name = _ranges(name, at)
        doc = doc[at]
        level += 1
        docs.append(doc)
        kept.append(name)
    if not docs:
        return ["0" * 16] * len(texts)
    key = np.concatenate([d.astype(np.int64) << 32 | (_scramble(n) >> np.uint64(32)).astype(np.int64) for d, n in zip(docs, kept, strict=True)])
    del docs, kept
    key.sort()
    least = np.zeros(0, np.int64)
    for at in range(0, len(key), PIECE):
        part = key[at : at + PIECE]
        # a phrase counts as often as it occurs: its n-th occurrence has a hash of its own
        first = np.r_[True, part[1:] != part[:-1]]
        nth = np.arange(len(part)) - np.maximum.accumulate(np.where(first, np.arange(len(part)), 0))
        before = at - int(np.searchsorted(key, part[0]))
        nth[part == part[0]] += before
        h = _scramble((part & 0xFFFFFFFF).astype(np.uint64) + (nth.astype(np.uint64) << np.uint64(32))) >> np.uint64(32)
        both = np.concatenate([least, (part >> 32) << 32 | h.astype(np.int64)])
        both.sort()
        both = both[np.r_[True, both[1:] != both[:-1]]]
        # the smallest of each document are enough to go on with
        new = np.r_[True, (both[1:] ^ both[:-1]) >> 32 != 0]
        place = np.arange(len(both))
        least = both[place - np.maximum.accumulate(np.where(new, place, 0)) < k]
    d = least >> 32
    bounds = np.searchsorted(d, np.arange(len(texts) + 1))
    h = (least & 0xFFFFFFFF).astype(">u4")
    return [f"{int(t):016x}" + h[s:e].tobytes().hex() for t, s, e in zip(top, bounds, bounds[1:], strict=False)]


def likeness(a: str, b: str, k: int = K) -> float:
    """Share of phrases that two texts have in common (Dice), estimated from the smallest hashes of their union. Equal fingerprints: 1; only one empty: 0."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f[16:]), ">u4") for f in (a, b))
    if not len(x) or not len(y):
        return 0.0
    both = np.concatenate([x, y])
    both.sort()
    whole = both[np.r_[True, both[1:] != both[:-1]]]
    # of a full sketch, hashes above its largest are unknown: the union counts up to the smaller of these
    limit = min(int(s[-1]) if len(s) >= k else 1 << 32 for s in (x, y))
    union = int(np.searchsorted(whole, limit, side="right"))
    twice = both[1:][both[1:] == both[:-1]]
    j = int(np.searchsorted(twice, limit, side="right")) / max(1, union)
    return 2 * j / (1 + j)


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(key, fingerprint) per input row; null text counts as empty, whose fingerprint is 16 zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_by_steps(texts, k))], ["k", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, fingerprint string").withColumnRenamed("k", key)


def _by_steps(texts: list[bytes], k: int) -> list[str]:
    out: list[str] = []
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > STEP_BYTES:
            out += sketches(texts[start:i], k)
            start, size = i, 0
        size += len(t)
    return out + sketches(texts[start:], k) if start < len(texts) else out


def _schema(kind: str) -> str:
    return f"k {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(k: int, names: list[str]):
    """Over rows sorted by range, guest, order: each row with the text of the next one of its range; the first guest ends a range."""

    def of(kinds: pa.Array, rows: list[tuple[int, str, str]]) -> Iterator[pa.RecordBatch]:
        own = [t.encode() for _, t, _ in rows]
        new = [edited(t, f).encode() for _, t, f in rows]
        fp, fp_new = _by_steps(own, k), _by_steps(new, k)
        # the next text is the following row's own, but where a range or a batch ends
        other = [i for i, (_, _, f) in enumerate(rows) if i + 1 == len(rows) or rows[i + 1][1] is not f]
        fp_next = [*fp[1:], ""]
        for i, x in zip(other, _by_steps([rows[i][2].encode() for i in other], k), strict=True):
            fp_next[i] = x
        yield pa.RecordBatch.from_arrays(
            [kinds.take(pa.array([i for i, _, _ in rows], pa.int64())), pa.array([len(t) for _, t, _ in rows], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in new]), pa.array(fp), pa.array(fp_new), pa.array([likeness(x, y, k) for x, y in zip(fp, fp_new, strict=True)]), pa.array([likeness(x, y, k) for x, y in zip(fp, fp_next, strict=True)])],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # range, key as an array of one, text
        for batch in batches:
            keys = batch.column(0)
            rows: list[tuple[int, str, str]] = []
            size = 0
            now: tuple | None = None  # range, row, text
            for i, (t, r, g) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if held is not None:
                    if held[0] == r:
                        yield from of(held[1], [(0, held[2], t)])
                    held = None
                elif now is not None and now[0] == r:
                    rows.append((now[1], now[2], t))
                    size += len(now[2])
                    if size > STEP_BYTES:
                        yield from of(keys, rows)
                        rows, size = [], 0
                now = (r, i, t) if g == 0 else None
            if rows:
                yield from of(keys, rows)
            held = (now[0], keys.slice(now[1], 1), now[2]) if now else None

    return run


def _position(key: Column, cuts: Column, n: int) -> Column:
    """How many of the ``n`` ascending cuts are at or below the key: a binary search."""
    halves = F.array(*[F.lit(1 << b) for b in range(max(1, n).bit_length() - 1, -1, -1)])
    return F.aggregate(halves, F.lit(0), lambda at, s: F.when((at + s <= n) & (F.get(cuts, at + s - 1) <= key), at + s).otherwise(at))


def _literal(values: list[int | None]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _share(h: Column, n: Column) -> Column:
    """0 to n - 1: in which of n equal parts of its range a 64-bit hash lies."""
    return F.least(F.floor((h.cast("double") / 2.0**64 + 0.5) * n), n - 1).cast("int")


def with_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, rows_per_range: int = 1500, max_ranges: int = 20_000) -> DataFrame:
    """One row per input row: (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document stands by descending integer key, and the first after the last. Edited: the last half of the code points
    (rounded down) replaced by the first as many of the next text, or all. Keys are cut into ranges by quantiles; a text
    travels once, to its range, and the first of a range also to the range before, so texts are neither joined nor gathered.
    Null keys stand last; rows that share a key stand by the hash of their text, then the text. A key with the rows of several ranges, null too, is cut into ranges of that hash, so only
    rows alike in key and text share a task. A lone row's next is itself. Null text: empty. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    n, known = rows.agg(F.count("*"), F.count("k")).first()
    wanted = min(max_ranges, max(64, n // rows_per_range))
    got = rows.select(F.col("k").cast("long").alias("k")).approxQuantile("k", [i / wanted for i in range(1, wanted)], 0.2 / wanted) if known else []
    met = Counter(int(x) for x in got)
    # at most twice max_ranges numbers; a key that is several quantiles has ranges of its own, as many as quantiles
    cuts = sorted({*met, *(c + 1 for c, m in met.items() if m > 1 and c < 2**63 - 1)})
    slots = [1, *(max(1, met[c]) for c in cuts)]
    below = np.r_[0, np.cumsum(slots[::-1])].tolist()
    nulls = max(1, -(-(n - known) * wanted // max(1, n)))
    # range 0 has the largest keys, null keys the last ranges
    at = _position(F.col("k").cast("long"), _literal(cuts), len(cuts))
    start = F.get(_literal(below), F.lit(len(cuts)) - at).cast("int")
    rows = rows.withColumn("h", F.xxhash64("t")).withColumn("r", F.when(F.col("k").isNull(), F.lit(below[-1]) + _share(F.col("h"), F.lit(nulls))).otherwise(start + _share(F.col("h"), F.get(_literal(slots), at))))
    # the first row of each range: largest key, least hash
    first = {x.r: (x.f.k, x.f.h) for x in rows.groupBy("r").agg(F.min_by(F.struct(F.col("k").cast("long").alias("k"), "h"), F.struct(-F.col("k").cast("decimal(20,0)"), F.col("h"))).alias("f")).collect()}  # one row a range
    order = sorted(first)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the last range ends with the first row of all
    spread = range(below[-1] + nulls)
    top = _literal([first[r][0] if r in first else None for r in spread]), _literal([first[r][1] if r in first else None for r in spread])
    to = _literal([before.get(r, 0) for r in spread])
    stay = F.struct(F.col("r"), F.lit(0).alias("g"))
    guest = F.struct(F.get(to, F.col("r")).cast("int").alias("r"), F.lit(1).alias("g"))
    leads = F.col("k").cast("long").eqNullSafe(F.get(top[0], F.col("r"))) & (F.col("h") == F.get(top[1], F.col("r")))
    dealt = rows.select("k", "t", "h", F.explode(F.when(leads, F.array(stay, guest)).otherwise(F.array(stay))).alias("c")).select("k", "t", "h", "c.r", "c.g")
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "r").sortWithinPartitions("r", "g", F.col("k").desc_nulls_last(), "h", "t").drop("h")
    names = ["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return dealt.mapInArrow(_pairs(k, names), _schema(kind)).withColumnRenamed("k", key)
