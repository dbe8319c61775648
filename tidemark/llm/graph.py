"""Connected components by alternating stars (large-star, small-star), with minimum aggregates and joins only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach
from tidemark.storage import materialize


def _contract(limit: int):
    """Replace the links of a part by stars; ``limit`` links at a time, so memory is bounded and no link is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.get(x, x)) != x:
                parent[x] = parent.get(p, p)
                x = p
            return x

        def stars() -> pa.RecordBatch:
            kids = [(x, r) for x in parent if (r := root(x)) != x]
            v, r = np.array(kids, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v)), pa.array(np.ascontiguousarray(r))], ["v", "u"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    parent.setdefault(min(x, y), min(x, y))
            if len(parent) > limit:
                yield stars()
                parent.clear()
        if parent:
            yield stars()

    return run


def components(pairs: DataFrame, limit: int = 500_000) -> DataFrame:
    """pairs: two long columns, any names. Returns (node, root) for every node of a pair; root is the component's smallest node.

    Links are contracted where they lie before anything is shuffled, so of a node with many links only one a part is left unless it is a root; roots
    with many nodes meet these by a broadcast (see ``attach``). Each step of a round is written: a round as one plan has
    about 30 exchanges, and Spark's driver keeps every plan, described anew for each stage that ends.
    """
    a, b = pairs.columns
    edges = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").mapInArrow(_contract(limit), "v long, u long").where("v <> u").distinct()
    edges = materialize(edges, "edges")
    state = lambda e: tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.lit(0))).first())
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = materialize(both.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")).select("v", F.least("v", "m").alias("m"), "n"), "low")
        large = attach(both.where("u > v"), low, "v", 2 * before[0]).select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        ordered = materialize(large.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")), "large")
        low = materialize(ordered.groupBy("v").agg(F.min("u").alias("m")), "low")
        moved = ordered.join(low, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = materialize(moved.union(low.select("v", F.col("m").alias("u"))).where("v <> u").distinct(), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
