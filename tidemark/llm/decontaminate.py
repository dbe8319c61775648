"""Benchmark decontamination with a generalised suffix automaton of test items.

The automaton is built over word numbers of all items of a block. Training texts stream through it: each word moves to the
longest suffix of what was read that occurs in some item, and its length is tracked. Once the length reaches a
window, the last words are hit and the state names the items. A sieve in front skips words that no window
can cover: every window holds a whole k-gram that starts at a multiple of the stride, so only surroundings of
strided k-grams that occur in an item go through the automaton; that never loses a match.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, byte_column
from tidemark.storage import materialize

WINDOW = 10
#: Words of test items in one automaton, and so in one broadcast; more items make more automata, applied one after the other.
BLOCK_WORDS = 500_000
#: Lower-cased UTF-8: digits, a-z and every byte outside ASCII form words.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def normal_words(text: bytes | None) -> list[bytes]:
    return WORD.findall((text or b"").translate(LOWER))


class _Builder:
    """States with transitions as dicts, while items are read."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        new = self._state(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][c]
            link[new] = q if length[p] + 1 == length[q] else self._clone(p, c, q)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.length[p] + 1)
        self.next[twin] = dict(self.next[q])
        self.link[twin] = self.link[q]
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin


@dataclass
class Automaton:
    """keys, targets: transitions (state, word number) in order and where they lead; link, length of each state; items: what holds the state's strings; ends: short items that end there, by length.

    Flat arrays: about 12 bytes a transition and 8 a state, a tenth of what a dict for each state takes.
    """

    window: int
    ids: dict[bytes, int] = field(default_factory=dict)
    keys: array = field(default_factory=lambda: array("q"))
    targets: array = field(default_factory=lambda: array("i"))
    link: array = field(default_factory=lambda: array("i", [-1]))
    length: array = field(default_factory=lambda: array("i", [0]))
    items: dict[int, list[str]] = field(default_factory=dict)
    ends: dict[int, dict[int, set[str]]] = field(default_factory=dict)
    grams: set[tuple[bytes, ...]] = field(default_factory=set)
    k: int = 0
    stride: int = 1

    def step(self, state: int, c: int) -> int:
        """The state after one more word, or -1."""
        key = state << 32 | c
        i = bisect_left(self.keys, key)
        return self.targets[i] if i < len(self.keys) and self.keys[i] == key else -1


def build(items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> Automaton:
    """items: (name, words). An item without words is in no window."""
    a, made = Automaton(window), _Builder()
    items = [(name, words) for name, words in items if words]
    coded = [(name, [a.ids.setdefault(w, len(a.ids)) for w in words]) for name, words in items]
    for _, codes in coded:
        last = 0
        for c in codes:
            last = made.extend(last, c)
    holders: dict[int, set[str]] = {}
    for name, codes in coded:
        state = 0
        for c in codes:
            state = made.next[state][c]
            up = state
            while up > 0 and made.length[up] >= window and name not in holders.setdefault(up, set()):
                holders[up].add(name)
                up = made.link[up]
        if len(codes) < window:
            while state > 0 and made.length[made.link[state]] >= len(codes):
                state = made.link[state]
            a.ends.setdefault(state, {}).setdefault(len(codes), set()).add(name)
    # most states are held by the same items as their neighbours
    shared: dict[tuple[str, ...], list[str]] = {}
    a.items = {s: shared.setdefault(key, list(key)) for s, names in holders.items() if (key := tuple(sorted(names)))}
    for state, out in enumerate(made.next):
        for c in sorted(out):
            a.keys.append(state << 32 | c)
            a.targets.append(out[c])
    a.link, a.length = array("i", made.link), array("i", made.length)
    least = min([window, *(len(w) for _, w in items)], default=window)
    a.k = (least + 1) // 2
    a.stride = least - a.k + 1
    a.grams = {tuple(words[i : i + a.k]) for _, words in items for i in range(len(words) - a.k + 1)}
    return a


def match(a: Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged spans [start, end) of hit words, and the items with an occurring window."""
    k, w = a.k, a.window
    if not a.grams or len(words) < k:
        return [], set()
    probes = zip(*(words[j :: a.stride] for j in range(k)), strict=False)
    grams = a.grams
    spans: list[list[int]] = []
    found: set[str] = set()
    areas: list[list[int]] = []
    for n, gram in enumerate(probes):
        if gram in grams:
            i = n * a.stride
            s, e = max(0, i + k - w), min(len(words), i + w)
            if areas and s <= areas[-1][1]:
                areas[-1][1] = e
            else:
                areas.append([s, e])
    step, link, length, ids = a.step, a.link, a.length, a.ids
    for s, e in areas:
        state = size = 0
        for j in range(s, e):
            c = ids.get(words[j])
            if c is None:
                state = size = 0
                continue
            to = step(state, c)
            while state and to < 0:
                state = link[state]
                size = length[state]
                to = step(state, c)
            if to >= 0:
                state = to
                size += 1
            hit = 0
            if size >= w:
                up = state
                while length[link[up]] >= w:
                    up = link[up]
                found.update(a.items[up])
                hit = w
            if a.ends:
                up = state
                while up > 0:
                    for n, names in a.ends.get(up, {}).items():
                        if n <= size:
                            found |= names
                            hit = max(hit, n)
                    up = link[up]
            if hit:
                if spans and j + 1 - hit <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], j + 1 - hit)
                    spans[-1][1] = j + 1
                else:
                    spans.append([j + 1 - hit, j + 1])
    while any(y[0] <= x[1] for x, y in zip(spans, spans[1:], strict=False)):
        spans = _merged(spans)
    return [(s, e) for s, e in spans], found


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


class Automata:
    """The automata of a benchmark's items, one for each ``block_words`` words, built one at a time whenever they are gone through; never two at once."""

    def __init__(self, benchmark: DataFrame, item: str, text: str, window: int, block_words: int):
        self.rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text))
        self.window, self.block_words = window, block_words
        self.first = self.lone = None

    def __iter__(self) -> Iterator[Automaton]:
        if self.lone:
            yield self.first
            return
        block, size, none = [], 0, True
        for name, t in self.rows.toLocalIterator():
            words = normal_words(t.encode() if t is not None else None)
            block.append((name, words))
            size += len(words)
            if size >= self.block_words:
                yield build(block, self.window)
                block, size, none = [], 0, False
        if block or none:
            yield build(block, self.window)

    def single(self) -> Automaton | None:
        """The only automaton, if all items fit one; it is kept."""
        if self.lone is None:
            both = iter(self)
            first = next(both)
            self.lone = next(both, None) is None
            self.first = first if self.lone else None
        return self.first


def automata(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Automata:
    """Items stream to the driver one at a time; it holds the automaton of one block. Null texts have no words, a null item is named ''."""
    return Automata(benchmark, item, text, window, block_words)


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
_HITS = "spans array<struct<s:int,e:int>>, items array<string>"


def _matched(texts: list[bytes | None], automaton: Automaton) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
    """Number of words, spans and items of each text."""
    sizes, spans, items = [], [], []
    for t in texts:
        words = normal_words(t)
        got, names = match(automaton, words)
        sizes.append(len(words))
        spans.append(got)
        items.append(sorted(names))
    return sizes, spans, items


def _struct(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"s": s, "e": e} for s, e in x] for x in spans], _SPANS)


def _hits(rows: DataFrame, found: Automata) -> DataFrame:
    """rows: (row, t), row a number of its own for each. Returns (row, spans, items) of those that any block hits; block after block, each writing its hits only."""
    sc, parts = rows.sparkSession.sparkContext, []
    for automaton in found:
        held = sc.broadcast(automaton)  # at most block_words words and one item more

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, spans, items = _matched(byte_column(batch.column(1)), held.value)
                hit = pa.array([i for i, x in enumerate(spans) if x], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), _struct(spans), pa.array(items, pa.list_(pa.string()))], ["row", "spans", "items"]).take(hit)

        parts.append(materialize(rows.select("row", "t").mapInArrow(run, f"row long, {_HITS}"), "hits"))
        held.destroy()
    every = reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return materialize(every, "hits")


def scan(docs: DataFrame, found: Automata, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_words, n_hit, n_items, items_sha256, items array<string>, contaminated.

    Null or wordless text: zeros, the hash of the empty string, false. An empty benchmark contaminates nothing. Other columns are ignored.
    One block of items: one pass over the texts, nothing is shuffled. More: the texts are written once with row numbers, each block writes its hits, and these are joined by row.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    names = ["k", "n_words", "n_hit", "items", "items_sha256"]

    def told(batch: pa.RecordBatch, sizes: list[int], spans: list, items: list[list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array([sum(e - s for s, e in x) for x in spans], pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items])], names)

    if (one := found.single()) is not None:
        held = spark.sparkContext.broadcast(one)  # at most block_words words and one item more

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield told(batch, *_matched(byte_column(batch.column(1)), held.value))

    else:
        rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
        sizes = F.coalesce(F.regexp_count(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")), F.lit(0))
        rows = rows.select("k", sizes.alias("n"), "row").join(_hits(rows, found), "row", "left").select("k", "n", "spans", "items")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                spans = [_merged([[x["s"], x["e"]] for x in y or ()]) for y in batch.column(2).to_pylist()]
                yield told(batch, batch.column(1).to_pylist(), spans, [sorted(x or ()) for x in batch.column(3).to_pylist()])

    df = rows.mapInArrow(run, f"k {kind}, n_words long, n_hit long, items array<string>, items_sha256 string")
    return df.select(F.col("k").alias(key), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", "items", (F.col("n_hit") > 0).alias("contaminated"))


def _without(text: str, spans: list[list[int]], first: bool, max_coverage: float) -> str | None:
    """The text without the words of the spans; None if it is a document's first cut and they cover more than ``max_coverage``."""
    raw = text.encode()
    at = [m.span() for m in WORD.finditer(raw.translate(LOWER))]
    if first and sum(e - s for s, e in spans) > max_coverage * len(at):
        return None
    pieces, end = [], 0
    for s, e in spans:
        pieces.append(raw[end : at[s][0]])
        end = at[e - 1][1]
    return b"".join([*pieces, raw[end:]]).decode("utf-8", "replace")


def cut(text: str, automaton: Automaton, max_coverage: float, min_span: int) -> str | None:
    """The text without its hit spans of at least ``min_span`` words, until none is left; None if such spans cover more than ``max_coverage`` of its words."""
    first = True
    while True:
        spans = [list(x) for x in match(automaton, normal_words(text.encode()))[0] if x[1] - x[0] >= min_span]
        if not spans:
            return text
        text = _without(text, spans, first, max_coverage)
        if text is None:
            return None
        first = False


def _shorter(first: bool, max_coverage: float, min_span: int):
    @F.arrow_udf("string")
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        merged = ([x for x in _merged([[y["s"], y["e"]] for y in z]) if x[1] - x[0] >= min_span] for z in spans.to_pylist())
        return pa.array([t if not m else _without(t, m, first, max_coverage) for t, m in zip(texts.to_pylist(), merged, strict=True)], pa.string())

    return run


def remove(docs: DataFrame, found: Automata, text: str = "text", max_coverage: float = 0.5, min_span: int = 1) -> DataFrame:
    """The input rows and columns with hit spans cut out of the text; rows where they cover more than ``max_coverage`` go. Null texts stay null.

    More than one block of items: each round goes through the blocks one at a time and cuts what any of them hits; only texts that were cut come to the next round.
    """
    if (one := found.single()) is not None:
        held = docs.sparkSession.sparkContext.broadcast(one)  # at most block_words words and one item more

        @F.arrow_udf("gone boolean, text string")
        def run(column: pa.Array) -> pa.Array:
            out = [None if t is None else cut(t, held.value, max_coverage, min_span) for t in column.to_pylist()]
            gone = [t is None and was.is_valid for t, was in zip(out, column, strict=True)]
            return pa.StructArray.from_arrays([pa.array(gone), pa.array(out, pa.string())], ["gone", "text"])

        # declared nondeterministic so that Spark doesn't run it once for the filter and again for the text; it is the same at each run
        marked = docs.withColumn("__tm_cut", run.asNondeterministic()(F.col(text))).where(~F.col("__tm_cut.gone"))
        return marked.withColumn(text, F.col("__tm_cut.text")).drop("__tm_cut")

    whole = materialize(docs.withColumn("__tm_row", F.monotonically_increasing_id()), "texts")
    todo, done, first = whole.select(F.col("__tm_row").alias("row"), F.col(text).alias("t")), None, True
    while True:
        now = todo.join(_hits(todo, found), "row").select("row", F.col("t").alias("was"), _shorter(first, max_coverage, min_span)(F.col("t"), F.col("spans")).alias("t"))
        now = materialize(now.where("t is null or t <> was").select("row", "t"), "cut")
        done = now if done is None else done.join(now.select("row"), "row", "left_anti").unionByName(now)
        todo = now.where("t is not null")
        if todo.isEmpty():
            break
        first = False
    done = materialize(done.select(F.col("row").alias("__tm_at"), F.col("t").alias("__tm_text")), "cut")
    rows = whole.join(done, F.col("__tm_row") == F.col("__tm_at"), "left").where("__tm_at is null or __tm_text is not null")
    return rows.withColumn(text, F.coalesce("__tm_text", F.col(text))).drop("__tm_row", "__tm_at", "__tm_text")
