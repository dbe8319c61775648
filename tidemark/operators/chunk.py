"""Chunking: sections at headings, pieces of bounded size with overlap, breadcrumbs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import breadcrumb
from tidemark.operators.batches import by_bytes

_HEADING = re.compile(r"^(#{1,4})[ \t]+(.*\S)\s*$")
CHUNKS = "array<struct<chunk_index:int,text:string,start_index:int,h1:string,h2:string,h3:string,h4:string>>"
_KIND = pa.list_(pa.struct([("chunk_index", pa.int32()), ("text", pa.string()), ("start_index", pa.int32()), *((f"h{n}", pa.string()) for n in range(1, 5))]))


def sections(text: str) -> list[tuple[int, str, tuple[str | None, ...]]]:
    """(start, text, headings h1 to h4) of each part that a heading opens; the heading's line stays in its part. A deeper heading ends with the next one above it."""
    out, start, at, fence = [], 0, 0, False
    heads: list[str | None] = [None] * 4
    for line in text.splitlines(keepends=True):
        if line.lstrip().startswith(("```", "~~~")):
            fence = not fence
        m = None if fence else _HEADING.match(line.rstrip("\n"))
        if m:
            if text[start:at].strip():
                out.append((start, text[start:at], tuple(heads)))
            n = len(m[1])
            heads[n - 1 :] = [m[2]] + [None] * (4 - n)
            start = at
        at += len(line)
    if text[start:].strip():
        out.append((start, text[start:], tuple(heads)))
    return out


def pieces(text: str, size: int, overlap: int) -> list[tuple[int, str]]:
    """(start, piece): each at most ``size`` characters, cut at the coarsest of paragraph, line, word or character that fits; the next one starts up to ``overlap`` before, at a word."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = min(n, at + size)
        if end < n:
            for mark in ("\n\n", "\n", " "):
                cut = text.rfind(mark, at + max(1, overlap), end)
                if cut > at:
                    end = cut + len(mark)
                    break
        piece = text[at:end]
        lead = len(piece) - len(piece.lstrip())
        if piece.strip():
            out.append((at + lead, piece.strip()))
        if end >= n:
            break
        back = max(at + 1, end - overlap)
        if overlap:
            gap = text.find(" ", back, end)
            back = gap + 1 if gap >= 0 else back
        else:
            back = end
        at = back
    return out


def split(text: str | None, size: int, overlap: int) -> list[dict]:
    out = []
    for base, part, heads in sections(text or ""):
        for start, piece in pieces(part, size, min(overlap, size - 1)):
            out.append({"chunk_index": len(out), "text": piece, "start_index": base + start} | {f"h{n + 1}": h for n, h in enumerate(heads)})
    return out


def chunk(docs: DataFrame, text: str = "markdown", size: int = 1024, overlap: int = 150) -> DataFrame:
    """One row per chunk: the document's columns without its text, chunk_index, chunk_total, text with its breadcrumb, start_index, h1 to h4. Blank texts have none."""

    @F.arrow_udf(CHUNKS)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in (x for column in columns for x in by_bytes(column)):
            yield pa.array([split(t, size, overlap) for t in part.to_pylist()], _KIND)

    rows = docs.where(F.rlike(F.col(text), F.lit(r"\S"))).withColumn("_chunks", run(F.col(text))).drop(text)
    rows = rows.withColumn("chunk_total", F.size("_chunks"))
    rows = rows.select("*", F.explode("_chunks").alias("_c")).select("*", "_c.*").drop("_chunks", "_c")
    return rows.withColumn("text", breadcrumb(F.col("text"), F.col("h1"), F.col("h2"), F.col("h3")))
