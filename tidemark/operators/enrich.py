"""Chunk metadata, neighbour context and identity prefixes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import extension, file_name, metadata, prefix, section_path, table_like
from tidemark.functions.values import ACCESS_FIELDS, SYSTEM_KEYS
from tidemark.operators.calls import in_groups
from tidemark.plans.config import MetadataField, RetrievalConfig


def standard(rows: DataFrame, job_id: str, ingested_at: Column) -> DataFrame:
    """Fields that every chunk has; a column of the same name that is there already (an extra of the source) stays."""
    fields = {"job_id": F.lit(job_id), "file_name": file_name(F.col("full_path")), "file_extension": F.substring(extension(file_name(F.col("full_path"))), 2, 2**31 - 1), "ingested_at": ingested_at}
    return rows.withColumns({k: v for k, v in fields.items() if k not in rows.columns})


def extras(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """What a source tells of its documents beside the standard fields, as columns; they win over standard fields of the same name."""
    return rows.withColumns({n: F.try_element_at("extra_metadata", F.lit(n)) for n in names}) if names else rows


def custom(rows: DataFrame, schema: list[MetadataField]) -> DataFrame:
    """Declared fields as columns; they win over whatever has their name."""
    return rows.withColumns(metadata(schema, F.col("full_path"), file_name(F.col("full_path")))) if schema else rows


def neighbours(chunks: DataFrame, doc: list[str], index: str = "chunk_index", text: str = "text") -> DataFrame:
    """``window``: two chunks before and after, 400 characters each, around 800 of the chunk itself, in order."""
    order = Window.partitionBy(*doc).orderBy(index)
    part = lambda label, c, n: F.concat(F.lit(f"[{label}]\n"), F.substring(c, 1, n))
    around = [part("chunk before", F.lag(text, k).over(order), 400) for k in (2, 1)] + [part("CURRENT CHUNK", F.col(text), 800)] + [part("chunk after", F.lead(text, k).over(order), 400) for k in (1, 2)]
    return chunks.withColumn("window", F.concat_ws("\n\n---\n\n", *around))


def contextualise(chunks: DataFrame, model: Callable[[pd.DataFrame], pd.Series], doc: list[str], tables_only: bool = False, concurrency: int = 3, batch: int = 16, rate: float | None = None) -> DataFrame:
    """Chunks with a model's sentence in front. model: from rows (section, window, text up to 1,500 characters) to texts or nulls.

    Under 20 characters count as none, 500 are kept. A task makes ``concurrency`` calls of ``batch`` rows at once, ``rate`` a second at most; a call that fails is made again row by row, and a row whose
    call fails keeps its chunk as it is. Only chunks that need it reach the model.
    """
    rows = neighbours(chunks, doc).withColumn("section", section_path(*(F.col(f"h{n}") for n in range(1, 5))))
    wanted = table_like(F.col("text")) if tables_only else F.lit(True)
    schema = rows.schema.add("context", "string")

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            asked = b[["section", "window"]].assign(text=b["text"].str.slice(0, 1500))
            parts = lambda some: list(model(asked.iloc[some]))  # noqa: B023, E731  called before the next batch
            # the hook is foreign code, and a chunk without context is still a chunk
            got = [x for x, _ in in_groups(list(range(len(b))), parts, batch, concurrency, rate)]
            yield b.assign(context=pd.Series(got, index=b.index, dtype=object))

    said = F.regexp_replace(F.col("context"), r"(?U)^\s+|\s+$", "")
    done = rows.where(wanted).mapInPandas(call, schema)
    done = done.withColumn("text", F.when(F.length(said) >= 20, F.concat(F.substring(said, 1, 500), F.lit("\n\n"), F.col("text"))).otherwise(F.col("text")))
    return done.select(chunks.columns).unionByName(rows.where(~wanted).select(chunks.columns))


def identity(chunks: DataFrame, retrieval: RetrievalConfig, schema: list[MetadataField], extra: Sequence[str] = ()) -> DataFrame:
    """Text under its identity prefix. Values: extractable fields, else filterable ones but for access, else all others in the schema's order."""
    if retrieval.extractable_fields:
        names = retrieval.extractable_fields
    elif retrieval.filterable_fields:
        names = [f for f in retrieval.filterable_fields if f not in ACCESS_FIELDS]
    else:
        names = [f for f in dict.fromkeys([*(f.field_name for f in schema if f.field_name), *extra]) if f not in SYSTEM_KEYS]
    p = prefix([F.col(n) for n in names if n in chunks.columns], file_name(F.col("full_path")), F.col("h1"), F.col("h2"), F.col("h3"))
    return chunks.withColumn("text", F.when(p != "", F.concat(p, F.lit("\n"), F.col("text"))).otherwise(F.col("text")))
