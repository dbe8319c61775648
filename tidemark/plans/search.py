"""One question over a tenant's repositories: scope, filters, vector and lexical search, fusion, merge and rerank; and an answer through a model hook."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import retrieve
from tidemark.operators.embed import Provider
from tidemark.operators.known import KnownValues
from tidemark.plans.config import FilterRequest, RetrievalConfig

KEY = "chunk_key"


def _filters(rows: DataFrame, question: str, repos: dict[str, RetrievalConfig], request: FilterRequest, tenant: str, view: KnownValues | None) -> Column:
    """Each repository's own predicate. Known values are looked up only if there is no other scope to extract from."""
    known = {}
    if request.auto_extract and not request.should:
        fields = {f for c in repos.values() for f in c.extractable_fields or c.filterable_fields} & set(rows.columns)
        asked = sorted(fields - set(request.must))
        known = view.named(question, asked, tenant, list(repos)) if view else retrieve.named_values(rows, asked, question)
    return reduce(lambda a, b: a | b, [(F.col("repo_id") == r) & retrieve.predicate(request, c, question, known) for r, c in repos.items()])


def search(
    chunks: DataFrame, tenant: str, repos: dict[str, RetrievalConfig], question: str, provider: Provider, top_k: int = 10,
    request: FilterRequest | None = None, scorer: Callable[[pd.DataFrame], list[float]] | None = None, known: KnownValues | None = None,
) -> DataFrame:
    """The ``top_k`` best chunks with ``chunk_key`` and ``score``; fewer if fewer may answer, none if no repository admits the filters.

    Every repository gives twice ``top_k`` candidates. If one of them is hybrid, all scores are reciprocal ranks within their repository, so that they
    compare; else they are cosines. A scorer sees the candidates of ``retrieve.rerank_candidates``; whole texts come back. Ties go by key.
    known: the view of known values; without it they are looked for among the chunks. chunks: tenant_id, repo_id, source_id, chunk_index, text, embedding, and the fields of the filters.
    """
    rows = retrieve.scoped(chunks, tenant, list(repos))
    rows = rows.where(_filters(rows, question, repos, request or FilterRequest(), tenant, known))
    rows = rows.withColumn(KEY, F.concat_ws("\x1f", "repo_id", "source_id", F.lpad(F.col("chunk_index").cast("string"), 10, "0")))
    vector = [float(x) for x in provider.embed_documents([question])[0]]
    near = retrieve.vector_topk(rows, vector, 2 * top_k, KEY)
    if any(c.hybrid_enabled for c in repos.values()):
        hybrid = [r for r, c in repos.items() if c.hybrid_enabled]
        words = retrieve.bm25(rows.where(F.col("repo_id").isin(*hybrid)), question, 2 * top_k, KEY, by="repo_id")
        share = reduce(lambda a, r: a.when(F.col("repo_id") == r, F.lit(float(repos[r].hybrid_alpha))), hybrid, F).otherwise(F.lit(1.0))
        near = retrieve.fuse(near.select("repo_id", KEY, "score"), words, KEY, share, by="repo_id")
    best = retrieve.merged(near.select(KEY, "score"), max(min(max(3 * top_k, 20), 30), top_k) if scorer else top_k, KEY)
    # the list is as short as the limit above
    found = rows.drop("score").join(F.broadcast(best), KEY)
    if scorer:
        order = retrieve.rerank(found.select(KEY, "text", "score"), top_k, KEY, scorer).select(KEY, "score")
        found = found.drop("score").join(F.broadcast(order), KEY)
    return found.orderBy(F.desc("score"), KEY)


def answer(found: DataFrame, question: str, model: Callable[[str], str]) -> str | None:
    """The model's answer from the chunks found, which a search has limited to its top k; None without chunks or if the model fails."""
    rows = found.select("text", "score", KEY).orderBy(F.desc("score"), KEY).collect()
    if not rows:
        return None
    context = "\n\n".join(f"[{n}] {r.text}" for n, r in enumerate(rows, 1))
    try:
        return model(f"Answer from the numbered passages alone and name the numbers used.\n\n{context}\n\nQuestion: {question}")
    except Exception:  # the hook is foreign code; the passages stand without an answer
        return None
