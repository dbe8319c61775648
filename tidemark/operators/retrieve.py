"""Filtered vector, lexical and hybrid retrieval with access boundaries."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.config import FilterRequest, RetrievalConfig
from tidemark.storage import contained, materialize

RRF = 60


def scoped(chunks: DataFrame, tenant: str, repos: list[str]) -> DataFrame:
    """Never without tenant and repositories; both prune partitions."""
    if not tenant or not repos:
        raise ValueError("a tenant and at least one repository are needed")
    return chunks.where((F.col("tenant_id") == tenant) & F.col("repo_id").isin(*repos))


def general_or(config: RetrievalConfig, application: list[str]) -> Column:
    """An application's documents, or those flagged as general."""
    own = F.col("application").isin(*application)
    return own | (F.col(config.general_flag_field) == config.general_flag_value) if config.general_flag_field else own


def extract(question: str, known: dict[str, list[str]]) -> dict[str, list[str]]:
    """Known values that a question names, whole or by initials, without regard to case. Stands in for a model."""
    words = re.findall(r"\w+", question.lower())
    text = f" {' '.join(words)} "
    out = {}
    for field, values in known.items():
        hits = []
        for v in values:
            parts = re.findall(r"\w+", v.lower())
            initials = "".join(p[0] for p in parts)
            if parts and f" {' '.join(parts)} " in text or len(initials) > 1 and initials in words:
                hits.append(v)
        if hits:
            out[field] = hits
    return out


def known_values(chunks: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value): distinct values, unpivoted before the one shuffle."""
    rows = chunks.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select("x.*")
    return rows.where("value is not null").distinct()


def named_values(chunks: DataFrame, fields: list[str], question: str) -> dict[str, list[str]]:
    """Known values that a question names, as ``extract`` finds them. Tested where the chunks lie, so only hits reach the driver; a question has room for few."""
    words = re.findall(r"\w+", question.lower())
    if not words or not fields:
        return {}
    plain = F.trim(F.regexp_replace(F.lower("value"), r"(?U)\W+", " "))
    initials = F.array_join(F.transform(F.split(plain, " "), lambda w: F.substring(w, 1, 1)), "")
    whole = (plain != "") & F.contains(F.lit(f" {' '.join(words)} "), F.concat(F.lit(" "), plain, F.lit(" ")))
    hits = known_values(chunks, fields).where(whole | (F.length(initials) > 1) & initials.isin(*words))
    return {r.field: sorted(r.values) for r in hits.groupBy("field").agg(F.collect_list("value").alias("values")).collect()}


def predicate(request: FilterRequest, config: RetrievalConfig, question: str = "", known: dict[str, list[str]] | None = None) -> Column:
    """Which chunks of a repository may answer.

    Must filters always hold; one on a field that the repository can't filter by closes it. Should filters narrow to what the question
    names within them, else to all of them; fields that the repository can't filter by are left out. Without should filters,
    auto-extraction looks among the known values.
    """
    allowed = set(config.filterable_fields)
    if any(f not in allowed for f in request.must):
        return F.lit(False)
    parts = [F.col(f).isin(*v) for f, v in request.must.items()]
    named = {}
    if request.auto_extract:
        among = request.should or {f: v for f, v in (known or {}).items() if f in (config.extractable_fields or config.filterable_fields)}
        named = extract(question, {f: v for f, v in among.items() if f not in request.must})
    for f in dict.fromkeys([*request.should, *named]):
        if f in allowed and f not in request.must:
            parts.append(F.col(f).isin(*(named.get(f) or request.should[f])))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def cosine(a: Column, b: Column) -> Column:
    """In doubles; 0 where a vector is null or has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.coalesce(F.when(norm > 0, dot(a, b) / norm), F.lit(0.0))


def vector_topk(chunks: DataFrame, query: list[float], k: int, key: str, by: str | None = "repo_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest, in each repository if ``by``; ties by key. The query is a literal, so every chunk is scored where it lies, and only k of a partition move."""
    scored = chunks.withColumn("score", cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in query])))
    if by is None:
        return scored.orderBy(F.desc("score"), key).limit(k)
    order = Window.partitionBy(by).orderBy(F.desc("score"), key)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def merged(candidates: DataFrame, k: int, key: str) -> DataFrame:
    """The best ``k`` of all repositories; each of them gives twice as many candidates."""
    return candidates.orderBy(F.desc("score"), key).limit(k)


def bm25(docs: DataFrame, query: str, k: int, key: str, text: str = "text", k1: float = 1.2, b: float = 0.75, by: str | None = None) -> DataFrame:
    """(key, score) of the best ``k`` by Okapi BM25; with ``by``, (by, key, score) of each of its values, with that value's own statistics, in the same pass. Terms are runs of letters and digits of any script, without regard to case.

    Documents are reduced to counts of the query's few terms where they lie, once; these counts are written, as totals and scores both need them, and nothing else moves.
    """
    spark, terms = docs.sparkSession, sorted(set(re.findall(r"[^\W_]+", query.lower())))
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    own = r"[\p{L}\p{N}]"
    count = lambda t: F.when(F.contains(low, F.lit(t)), F.regexp_count(low, F.lit(f"(?<!{own}){t}(?!{own})"))).otherwise(0)

    own_by = [by] if by else []

    def best() -> DataFrame:
        rows = materialize(docs.select(*own_by, key, F.regexp_count(low, F.lit(f"{own}+")).alias("_len"), *[count(t).alias(f"_f{i}") for i, t in enumerate(terms)]), "terms")
        totals = rows.groupBy(*own_by).agg(F.count("*").alias("_docs"), F.avg("_len").alias("_length"), *[F.count_if(F.col(f"_f{i}") > 0).alias(f"_d{i}") for i in range(len(terms))])
        if by:
            # a row for each value, as many as a question has repositories
            rows = rows.join(F.broadcast(totals), by)
            known = {n: F.col(n) for n in totals.columns}
        else:
            known = {n: F.lit(v) for n, v in totals.first().asDict().items()}
        score = F.lit(0.0)
        for i in range(len(terms)):
            idf = F.log(1 + (known["_docs"] - known[f"_d{i}"] + 0.5) / (known[f"_d{i}"] + 0.5))
            f = F.col(f"_f{i}")
            score = score + idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("_len") / F.greatest(F.coalesce(known["_length"], F.lit(0.0)), F.lit(1e-9))))
        found = rows.select(*own_by, key, score.alias("score")).where("score > 0")
        if not by:
            return found.orderBy(F.desc("score"), key).limit(k)
        order = Window.partitionBy(by).orderBy(F.desc("score"), key)
        return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")

    return contained(spark, "ranked", best)


def fuse(vectors: DataFrame, words: DataFrame, key: str, alpha: float | Column = 0.7, by: str | None = None) -> DataFrame:
    """(key, score): reciprocal rank fusion of two top-k lists (key, score), of each value of ``by`` if given. Both are as short as their k; alpha: the share of the vectors, a number or by ``by``."""
    own, weight = [by] if by else [], alpha if isinstance(alpha, Column) else F.lit(alpha)
    ranked = lambda d, n: d.select(*own, key, F.row_number().over(Window.partitionBy(*own).orderBy(F.desc("score"), key)).alias(n))
    part = lambda r, w: F.coalesce(w / (RRF + F.col(r)), F.lit(0.0))
    return ranked(vectors, "_v").join(ranked(words, "_w"), [*own, key], "full").select(key, (part("_v", weight) + part("_w", 1 - weight)).alias("score"))


def rerank_candidates(rows: DataFrame, top_k: int, key: str, text: str = "text") -> DataFrame:
    """What a reranker sees: 3 k candidates, 20 at least and 30 at most, 400 characters each."""
    n = min(max(3 * top_k, 20), 30)
    return rows.orderBy(F.desc("score"), key).limit(n).withColumn(text, F.substring(text, 1, 400))


def rerank(rows: DataFrame, top_k: int, key: str, scorer: Callable[[pd.DataFrame], list[float]] | None = None, text: str = "text") -> DataFrame:
    """The best ``top_k`` by a scorer's one call over all candidates; without one, or if it fails, by score."""
    few = rerank_candidates(rows, top_k, key, text)
    if scorer is None:
        return few.orderBy(F.desc("score"), key).limit(top_k)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", key], ascending=[False, True])
        try:
            return pdf.assign(score=scorer(pdf)).sort_values(["score", key], ascending=[False, True]).head(top_k)
        except Exception:  # the hook is foreign code; the order so far stands
            return pdf.head(top_k)

    return few.groupBy().applyInPandas(run, few.schema)


def repositories(repos: DataFrame, tenant: str) -> DataFrame:
    return repos.where((F.col("tenant_id") == tenant) & F.col("is_active")).select("repo_id", "name", "filterable_fields")
