"""What several operators share: reading tables, the held-out rule, blocks of words and of Arrow rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z on UTF-8 bytes; all else stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of text that one numpy step holds.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves that remainder; a null key counts as the empty string."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus) == remainder


def rate_limit(rate: float) -> int:
    """Hashes shifted right by one bit that lie below this are a share ``rate`` of all; never none of them."""
    return max(1, min(2**63 - 1, int(rate * 2**63)))


def sample_limits(rows: DataFrame, h: str, wanted: int, by: str | None = None) -> dict | None:
    """Below which shifted hash rows of each value of ``by`` (None: of all rows) are in a sample of about ``wanted`` different hashes ``h`` (64-bit), in equal shares; None where there are no more.

    Different hashes are counted (by sketches, within a few percent), so copies use up no share; copies of a picked row all come.
    """
    counts = rows.groupBy(*([by] if by else [])).agg(F.approx_count_distinct(h, 0.02).alias("n")).collect()  # one row a value
    if sum(x.n for x in counts) <= wanted:
        return None
    share = wanted / max(1, len(counts))
    return {x[by] if by else None: rate_limit(share / x.n) for x in counts if x.n}


def in_sample(limits: dict, h: str, by: str | None = None) -> Column:
    limit = F.element_at(F.create_map(*[F.lit(v) for pair in limits.items() for v in pair]), F.col(by)) if by else F.lit(limits[None])
    return F.shiftrightunsigned(h, 1) < limit


def sampled(rows: DataFrame, h: str, wanted: int, by: str | None = None) -> DataFrame:
    """The rows of such a sample."""
    limits = sample_limits(rows, h, wanted, by)
    return rows if limits is None else rows.where(in_sample(limits, h, by))


#: Keys with more than this share of all rows are hot; there are fewer than ``HOT_KEYS`` of them.
HOT_KEYS = 1_000


def attach(rows: DataFrame, values: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """``rows`` with the columns of their key, an inner join. values: (key, n, ...), one row a key, n rows of ``rows`` having that key; n goes. total: the sum of n, if known.

    Hot keys meet their rows where these are, by a broadcast of fewer than HOT_KEYS rows; the others are joined by key, so a
    task never gets the rows of a hot key.
    """
    limit = (values.agg(F.sum("n")).first()[0] or 0 if total is None else total) / HOT_KEYS
    hot, rest = (values.where(c).drop("n") for c in (F.col("n") > limit, F.col("n") <= limit))
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return rows.join(F.broadcast(hot), key).unionByName(others)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often body names it, in lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Powers of two: an array of Spark has fewer than 2^31 elements.
_SPANS = tuple(1 << b for b in range(31))


def running(values: Column, op: Callable[[Column, Column], Column], backwards: bool = False) -> Column:
    """Array of op over all elements up to each one (or from it on): about n log n steps by doubling, where growing an array inside an aggregate takes n^2."""

    def double(x: Column, d: Column) -> Column:
        if backwards:
            return F.transform(x, lambda v, i: F.when(i + d < F.size(x), op(v, F.get(x, i + d))).otherwise(v))
        return F.transform(x, lambda v, i: F.when(i >= d, op(F.get(x, i - d), v)).otherwise(v))

    def all_of(x: Column) -> Column:
        return F.aggregate(F.filter(F.array(*[F.lit(d) for d in _SPANS]), lambda d: d < F.size(x)), x, double)

    return let(values, all_of)


#: Code points in a block of ``parts``.
PART_CHARS = 1024


def parts(text: Column, cuts: Column) -> Column:
    """Substrings of a text at ascending cuts, an array of struct<s, e> (code points from 0, end exclusive; int).

    A substring is found by walking from the start of its string, so many of one long text would take quadratic time: the text is first cut into
    blocks, and each part walks through blocks of its own only.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART_CHARS}}}"), F.lit(0))

    def one(b: Column, c: Column) -> Column:
        first, last = F.floor(c.s / PART_CHARS).cast("int"), F.floor((c.e - 1) / PART_CHARS).cast("int")
        start, end = c.s - first * PART_CHARS, c.e - last * PART_CHARS
        head = F.substring(F.get(b, first), start + 1, F.lit(PART_CHARS))
        middle = F.array_join(F.slice(b, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        long = F.concat(head, middle, F.substring(F.get(b, last), F.lit(1), end))
        return F.when(c.e <= c.s, F.lit("")).when(first == last, F.substring(F.get(b, first), start + 1, c.e - c.s)).otherwise(long)

    return let(blocks, lambda b: F.transform(cuts, lambda c: one(b, c)))


def byte_column(column: pa.Array) -> list[bytes | None]:
    """UTF-8 of each string, without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def steps(texts: list[bytes | None], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def safe_pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that end behind white space, so no word is cut; a longer word makes a longer piece."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end - 1] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end]
        at = end


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words between bytes 0x09-0x0D and 0x20, in lists that cover the whole text; memory follows ``size``, not the text."""
    if len(text) <= size:
        yield text.split()
        return
    at, n = 0, len(text)
    spaces = b" \t\n\r\x0b\x0c"
    while at < n:
        end = min(n, at + size)
        while end < n and text[end] not in spaces:
            end += 1
        yield text[at:end].split()
        at = end
