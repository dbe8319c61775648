"""From raw documents to a training mix: language ID, near-duplicates, benchmark passages, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and all that the one before kept; but for the last, it returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, mixing, secrets, simhash
from tidemark.llm.common import table
from tidemark.storage import delete, fresh, scratch, written


def _recount(docs: DataFrame) -> DataFrame:
    """n_chars follows a text that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the input's own labels; documents without a letter, or without a language that fills a fifth of them, go. Mixtures stay."""
    return langid.keep_identified(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that of the smallest doc_id. SimHash fingerprints within three bits are candidates, as in op8, and minhash cells bring those that more bits part (README); links are 0.8 alike in five-word shingles, by the sets themselves."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly benchmark text goes."""
    return _recount(decontaminate.remove(docs, decontaminate.automata(table(spark, sf_dir, "benchmark"))))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays. The models learn from the input's own tokens too."""
    return _recount(secrets.redact(docs, secrets.fit(secrets.samples_of(docs))))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: one row per document with its repetitions (0: not in the mix)."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "epochs", "taken")


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secret_scan", secret_scan), ("source_mix", source_mix)]
#: The stages learn, parse and cluster in ways that SQL has no words for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage leaves in the shared folder, unmasked secrets among it, goes once the next one is written; the input of the last stage stays, as its rows are read from it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for n, (name, stage) in enumerate(STAGES):
        if n + 1 == len(STAGES):
            return stage(spark, docs, sf_dir)
        path = fresh(spark, name)
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), path)
        if before:
            delete(spark, before)
        before = path
    raise AssertionError("unreachable")
