"""Secret scan, DataFrame functions only: three fixed patterns and a comparison of character Markov models.

Spans come from splitting a text by a pattern and pairing the pieces with the matches: their lengths add up to offsets.
For tokens that no pattern covers, two first-order Markov chains over characters, one of random strings and one of
ordinary identifiers, are compared by log-likelihood ratio a character. Both are trained from labelled samples: strings made by rule, and
tokens of a corpus, labelled by whether a fixed pattern finds them.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, parts, running, sampled

KINDS = ("assign", "access", "hex", "random")
#: The patterns of the base kinds.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a shorter match ends where a longer one would, so the length can stand in the pattern
HEX = r"[0-9a-f]{24,}"
#: Candidates of the method: runs of at least this many token characters, with a digit and a letter.
TOKEN_CHARS = 20
TOKEN = rf"[A-Za-z0-9+/_-]{{{TOKEN_CHARS},}}"
CLASSES = {"d": "0123456789", "l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "p": "+/_-"}
ALPHABET = "".join(CLASSES.values())
#: Mean log-likelihood ratio a character from which on a token counts as random.
THRESHOLD = 0.5
#: About so many texts of a corpus give labelled tokens to a fit, picked by a hash of the text, copies counted once: the documented bound of the sample.
FIT_TEXTS = 20_000
#: Characters of the shortest token that teaches.
TAUGHT_CHARS = 8
_NONE = "array<struct<s:int,k:int,e:int,m:string>>"
#: Words that the identifier sample is put together from.
WORDS = "get set max min user name file path list item count index value table column row key data time date start end first last next config default error message handler request response server client session parser writer reader buffer cache query result format string number version update delete insert create build check test main init load save open close read write node tree graph edge order price total account address email phone city country street image page link title body header footer event listener thread pool queue stack map array vector matrix model train score label class method field state status code type size length width height color und der die das nicht einer werden kein mit von haben ist que para como una con por los las del esta cuando les des est dans pour une avec sur pas plus tout".split()


def random_samples(n: int = 4000, seed: int = 7) -> list[str]:
    """Labelled random strings, by rule: seeded draws from hexadecimal, base-32, base-62 and base-64 alphabets."""
    r = random.Random(seed)
    kinds = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", CLASSES["d"] + CLASSES["l"] + CLASSES["u"], CLASSES["d"] + CLASSES["l"] + CLASSES["u"] + "+/"]
    return ["".join(r.choice(kinds[i % 4]) for _ in range(r.randint(20, 48))) for i in range(n)]


def identifier_samples(n: int = 4000, seed: int = 11) -> list[str]:
    """Labelled ordinary identifiers, by rule: words joined in the usual styles, with a counter, a year or a date now and then."""
    r, out = random.Random(seed), []
    for i in range(n):
        words = [r.choice(WORDS) for _ in range(r.randint(2, 5))]
        style = i % 6
        name = "_".join(words) if style == 0 else "-".join(words) if style == 1 else "/".join(words) if style == 2 else words[0] + "".join(w.title() for w in words[1:]) if style == 3 else "".join(words) if style == 4 else "_".join(words).upper()
        if r.random() < 0.4:
            name += r.choice(["", "_", "-"]) + r.choice([str(r.randint(1, 99)), str(r.randint(1990, 2030)), f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}"])
        out.append(name)
    return out


Counts = dict[str, dict[str, float]]


def _counted(samples: Iterable[str]) -> Counts:
    """How often each character follows another (``^``: the start)."""
    out: Counts = {}
    for s in samples:
        for a, b in zip("^" + s, s, strict=False):
            if a in ALPHABET + "^" and b in ALPHABET:
                row = out.setdefault(a, {})
                row[b] = row.get(b, 0) + 1
    return out


@cache
def _rule_counts() -> tuple[Counts, Counts]:
    return _counted(random_samples()), _counted(identifier_samples())


def _chain(rule: Counts, taught: Counts) -> dict[str, float]:
    """Log probabilities of a character after another, add-half smoothed. What a corpus taught weighs up to a half, by how often the first character was seen."""
    out = {}
    for a in "^" + ALPHABET:
        rows = [x.get(a, {}) for x in (rule, taught)]
        sums = [sum(x.values()) for x in rows]
        share = 0.5 * sums[1] / (sums[1] + 200)
        for b in ALPHABET:
            p, q = ((x.get(b, 0) + 0.5) / (n + 0.5 * len(ALPHABET)) for x, n in zip(rows, sums, strict=True))
            out[a + b] = math.log((1 - share) * p + share * q)
    return out


def ratio_model(random_pairs: Counts | None = None, ordinary_pairs: Counts | None = None) -> list[float]:
    """Log-likelihood ratios of all character pairs, in the order of the alphabet: row of the first (``^`` last), then the second."""
    rand, plain = (_chain(rule, taught or {}) for rule, taught in zip(_rule_counts(), (random_pairs, ordinary_pairs), strict=True))
    return [round(rand[a + b] - plain[a + b], 6) for a in ALPHABET + "^" for b in ALPHABET]


@cache
def rule_model() -> list[float]:
    """The model of the samples by rule alone."""
    return ratio_model()


def samples_of(docs: DataFrame, text: str = "text", fit_texts: int = FIT_TEXTS) -> DataFrame:
    """(token, label) of about ``fit_texts`` different texts: 1 for what a fixed pattern finds, 0 for tokens of texts without such a span. Null texts give none."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("t"), F.xxhash64(text).alias("h"))
    few = sampled(rows, "h", fit_texts).groupBy("h").agg(F.first("t").alias("t"))
    found = few.select("t", base_spans(F.col("t")).alias("spans"))
    plain = F.regexp_extract_all("t", F.lit(rf"[A-Za-z0-9+/_-]{{{TAUGHT_CHARS},}}"), F.lit(0))
    value = lambda x: F.when(x.k == 0, F.regexp_extract(x.m, ASSIGN_VALUE, 1)).otherwise(x.m)
    random_ = F.transform("spans", lambda x: F.struct(value(x).alias("token"), F.lit(1).alias("label")))
    ordinary = F.transform(plain, lambda x: F.struct(x.alias("token"), F.lit(0).alias("label")))
    return found.select(F.explode(F.when(F.size("spans") > 0, random_).otherwise(ordinary)).alias("x")).select("x.*")


def fit(samples: DataFrame, token: str = "token", label: str = "label") -> list[float]:
    """From labelled tokens (1: random, 0: ordinary) beside those by rule. Counted where they lie: two tables of character pairs come back. Nulls teach nothing."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(F.col(token))), lambda i: F.substring(F.concat(F.lit("^"), F.col(token)), i, F.lit(2)))
    rows = samples.where((F.length(F.col(token)) > 0) & F.col(label).isin(0, 1)).select(F.col(label).alias("l"), F.explode(pairs).alias("p"))
    counts: tuple[Counts, Counts] = ({}, {})
    # characters outside the alphabet go, so at most 2 x 65 x 64 rows
    for x in rows.where(F.rlike("p", F.lit(r"^[A-Za-z0-9+/_^-][A-Za-z0-9+/_-]$"))).groupBy("l", "p").count().collect():
        counts[x.l].setdefault(x.p[0], {})[x.p[1]] = x["count"]
    return ratio_model(counts[1], counts[0])


def spans_of(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<s, k, e, m>> of the leftmost non-overlapping matches: code points from 0, end exclusive."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.zip_with(F.split(text, pattern, -1), matches, lambda p, m: F.struct(F.length(p).alias("p"), m.alias("m")))

    def spans(rows: Column) -> Column:
        ends = running(F.transform(rows, lambda x: x.p + F.length(x.m)), lambda a, b: a + b)
        return F.zip_with(rows, ends, lambda x, e: F.struct((e - F.length(x.m)).alias("s"), F.lit(kind).alias("k"), e.alias("e"), x.m.alias("m")))

    # the text behind the last match has no match of its own
    return let(F.filter(found, lambda x: x.m.isNotNull()), spans)


def _score(token: Column, model: Column) -> Column:
    """Mean log-likelihood ratio a character; positive: more like a random string."""
    n = len(ALPHABET)
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    codes = F.filter(codes, lambda x: x >= 0)
    start = F.struct(F.lit(n).alias("before"), F.lit(0.0).alias("sum"))
    return F.aggregate(codes, start, lambda acc, x: F.struct(x.alias("before"), (acc.sum + F.get(model, acc.before * n + x)).alias("sum")), lambda acc: acc.sum) / F.length(token)


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e, m>> of the three fixed kinds, kind by kind. Each pattern runs only over texts that hold its fixed part, which changes no result."""
    none, low = F.array().cast(_NONE), F.lower(text)
    words = F.contains(low, F.lit("passw")) | F.contains(low, F.lit("secret")) | F.contains(low, F.lit("token")) | F.contains(low, F.lit("api"))
    assign = F.filter(spans_of(text, ASSIGN, 0), lambda x: F.length(F.regexp_extract(x.m, ASSIGN_VALUE, 1)) >= 6)
    return F.concat(F.when(words, assign).otherwise(none), F.when(F.contains(text, F.lit("AKIA")), spans_of(text, ACCESS, 1)).otherwise(none), F.when(F.rlike(text, F.lit(HEX)), spans_of(text, HEX, 2)).otherwise(none))


def random_spans(text: Column, model: list[float], threshold: float) -> Column:
    """array<struct<s, k, e, m>> of tokens with a digit and a letter that the models find more like random strings."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    mixed = F.rlike(text, F.lit(r"[A-Za-z+/_-][0-9]|[0-9][A-Za-z+/_-]"))
    tokens = F.filter(spans_of(text, TOKEN, 3), lambda x: F.rlike(x.m, F.lit("[0-9]")) & F.rlike(x.m, F.lit("[A-Za-z]")))
    return F.when(mixed, F.filter(tokens, lambda x: _score(x.m, table) > threshold)).otherwise(F.array().cast(_NONE))


def find(text: Column, model: list[float], threshold: float = THRESHOLD) -> Column:
    """array<struct<s, k, e>> by start, then kind (0 assign, 1 access, 2 hex, 3 random), of a text column; null or empty text: none.

    Base spans of different kinds may overlap and all stay; a span of the method is added only where it meets no base span. Time goes with the
    text and with n log n of its spans.
    """
    t = F.coalesce(text, F.lit(""))
    every = F.array_sort(F.transform(F.concat(base_spans(t), random_spans(t, model, threshold)), lambda x: F.struct(x.s.alias("s"), x.k.alias("k"), x.e.alias("e"))))

    def free(rows: Column) -> Column:
        # in this order a base span that meets a span of the method starts before it and ends within or behind it, or starts next within it
        ends = running(F.transform(rows, lambda x: F.when(x.k < 3, x.e).otherwise(F.lit(-1))), F.greatest)
        starts = running(F.transform(rows, lambda x: F.when(x.k < 3, x.s).otherwise(F.lit(2**31 - 1))), F.least, backwards=True)
        return let(F.struct(ends.alias("ends"), starts.alias("starts")), lambda b: F.filter(rows, lambda x, i: (x.k < 3) | ((F.get(b.ends, i) <= x.s) & (F.get(b.starts, i) >= x.e))))

    return let(every, lambda rows: F.when(F.exists(rows, lambda x: x.k == 3) & F.exists(rows, lambda x: x.k < 3), free(rows)).otherwise(rows))


def name(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x.k), x.s.cast("string"), x.e.cast("string"))), ",")


def scan(docs: DataFrame, model: list[float] | None = None, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: (key, spans array<struct<s, k, e>>). Other columns are ignored; repeated rows come back repeated. No model: that of the samples by rule."""
    return docs.select(F.col(key), find(F.col(text), model or rule_model(), threshold).alias("spans"))


def redact(docs: DataFrame, model: list[float] | None = None, text: str = "text", mask: str = "[SECRET]", threshold: float = THRESHOLD) -> DataFrame:
    """The input rows and columns, each run of overlapping spans in the text replaced by ``mask``. Null stays null."""
    t, spans = F.col(text), F.col("__tm_spans")

    def runs(rows: Column) -> Column:
        """What stays: the stretches between runs of overlapping spans."""
        ends = running(F.transform(rows, lambda x: x.e), F.greatest)
        first = let(ends, lambda e: F.filter(F.transform(rows, lambda x, i: F.struct(F.when(i == 0, F.lit(0)).otherwise(F.get(e, i - 1)).alias("s"), x.s.alias("e"))), lambda c: c.s <= c.e))
        return F.concat(first, F.array(F.struct(F.array_max(F.transform(rows, lambda x: x.e)).alias("s"), F.length(t).alias("e"))))

    clean = F.array_join(parts(t, runs(spans)), mask)
    return docs.withColumn("__tm_spans", find(t, model or rule_model(), threshold)).withColumn(text, F.when(t.isNotNull() & (F.size(spans) > 0), clean).otherwise(t)).drop("__tm_spans")
