"""The registered queries opN_<name>: each operator with production parameters over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import audit, chat, decontaminate, fingerprint, html, impact, langid, mixing, quality, secrets, simhash, urls, warc
from tidemark.llm.common import held_out, table
from tidemark.storage import contained

#: Conversation -1 of the formatting query: control strings inside texts.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"
RULES = (urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"))


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out("doc_id", 4, 2)
    model = langid.fit(docs.where(~out))
    got = docs.select("doc_id", out.alias("held_out"), langid.predict(docs, model).alias("p"))
    return got.select("doc_id", "held_out", "p.lang_pred", "p.score", F.array_join("p.langs", ",").alias("langs"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    kinds = {f.name: f.dataType for f in turns.schema}
    extra = spark.range(2).select(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat.read_back(chat.format_conversations(turns.select("conv_id", "turn", "role", "text").unionByName(extra)))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "size", "source", "source_size", "target", "epochs", "taken"]
    return contained(spark, "mix", lambda: mixing.mix(table(spark, sf_dir, "documents")).select(names))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.when(F.col("quality") == 0, 1).when(F.col("quality").isNotNull(), 0).alias("bad"))
    return contained(spark, "verdicts", lambda: urls.judge(table(spark, sf_dir, "pages"), outcomes, RULES))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.automata(table(spark, sf_dir, "benchmark"))
    return decontaminate.scan(table(spark, sf_dir, "documents"), found).drop("items")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out("doc_id", 3, 1)
    model = quality.fit(docs.where(~out), table(spark, sf_dir, "labels"), label="quality")
    got = docs.select("doc_id", out.alias("held_out"), quality.score(docs, model).alias("score"))
    return got.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_neighbours(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contained(spark, "classes", lambda: simhash.near_duplicates(table(spark, sf_dir, "documents")))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = secrets.scan(docs, secrets.fit(secrets.samples_of(docs)))
    of = lambda k: F.size(F.filter("spans", lambda x: x.k == k)).cast("long").alias(f"n_{secrets.KINDS[k]}")
    base = F.filter("spans", lambda x: x.k < 3)
    return got.select("doc_id", of(0), of(1), of(2), F.sha2(secrets.name(base).cast("binary"), 256).alias("base_sha256"), secrets.name(F.col("spans")).alias("spans"))


def op11_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = impact.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)
    return got.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_langid, op2_chat, op3_mixing, op4_urls, op5_decontaminate, op6_quality, op7_fingerprint, op8_simhash, op9_html, op10_secrets, op11_impact, op12_audit, op13_warc, pipeline)
    return {f.__name__: f for f in named}
