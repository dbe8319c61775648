"""A vector index: cells around centroids, searched in order of what they can hold at best."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidemark.operators.retrieve import cosine
from tidemark.storage import contained, create, materialize, names

#: Vectors that centroids are learned from, at most; every vector is indexed.
SAMPLE, ROUNDS = 50_000, 12
#: Rows of a file of a cell.
FILE_ROWS = 1_000_000


def centroids_of(vectors: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means; started from vectors far from each other."""
    r = np.random.default_rng(seed)
    chosen = [int(r.integers(len(vectors)))]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(cells, len(vectors)):
        gap = np.maximum(1 - near, 0)
        if gap.sum() <= 1e-12:
            break
        chosen.append(int(r.choice(len(vectors), p=gap / gap.sum())))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    c = vectors[chosen].copy()
    for _ in range(ROUNDS):
        of = (vectors @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, of, vectors)
        length = np.linalg.norm(sums, axis=1)
        c[length > 0] = sums[length > 0] / length[length > 0][:, None]
    return c


def _unit(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors as doubles, which rows have a direction)."""
    rows = [x if x is not None and len(x) == dimensions and None not in x else [0.0] * dimensions for x in column.to_pylist()]
    v = np.array(rows, np.float64).reshape(len(rows), dimensions)
    length = np.linalg.norm(v, axis=1)
    good = np.isfinite(length) & (length > 0)
    v[good] /= length[good][:, None]
    return v, good


class VectorIndex:
    """``data`` by cell, ``cells`` with centroid, radius (the largest angle of its vectors to it) and number of rows, under versions that a log names.

    No vector of a cell is nearer to a question than the angle to the centroid less the radius, so cells have bounds, and a search that goes on until the next bound lies below its k-th score is exact. Vectors without a
    direction (null, zero, or of other dimensions) have the cell -1 and the score 0.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def build(self, rows: DataFrame, vector: str = "embedding", cells: int | None = None, sample: int = SAMPLE) -> None:
        """Indexes all rows in place of what was there, columns and all. cells: about the square root of the rows, 4,096 at most, if not given. Centroids are learned from ``sample`` vectors at most, chosen by hash."""
        n = rows.count()
        some = rows.select(F.col(vector).alias("v")).where(F.col("v").isNotNull())
        picked = some.where(F.pmod(F.xxhash64("v"), F.lit(max(1, n))) < sample).limit(2 * sample).collect()  # bounded
        dimensions = len(picked[0].v) if picked else 0
        unit, good = _unit(pa.array([x.v for x in picked], pa.list_(pa.float64())), dimensions)
        c = centroids_of(unit[good], cells or max(1, min(4096, math.isqrt(n)))) if good.any() else np.zeros((0, dimensions))
        shared = self.spark.sparkContext.broadcast(c)  # 4,096 centroids at most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    part = batch.slice(at, 2048)
                    v, good = _unit(part.column(vector), dimensions)
                    cell, angle = np.full(len(v), -1, np.int32), np.zeros(len(v))
                    if len(c):
                        near = v @ c.T
                        best = near.argmax(axis=1)
                        cell[good] = best[good]
                        angle[good] = np.arccos(np.clip(near[np.arange(len(v)), best], -1, 1))[good]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(angle)], [*part.schema.names, "_cell", "_angle"])

        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        version = uuid.uuid4().hex

        def written() -> DataFrame:
            placed = materialize(rows.mapInArrow(run, f"{kind}, _cell int, _angle double"), "placed")
            sizes = materialize(placed.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_angle").alias("radius")), "sizes")
            # a cell may hold a third of all rows: it has several files
            files = F.ceil(F.col("n") / FILE_ROWS).cast("int")
            dealt = placed.join(F.broadcast(sizes.select(F.col("_cell").alias("_c"), files.alias("_files"))), F.col("_cell") == F.col("_c"))
            dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(vector), F.col("_files")))
            dealt.repartition("_cell", "_file").drop("_c", "_files", "_file", "_angle").write.partitionBy("_cell").parquet(f"{self.path}/data/version={version}")
            return sizes

        sizes = contained(self.spark, "cells", written).collect()  # a row a cell
        cells_ = [{"cell": x["_cell"], "n": x.n, "radius": x.radius, "centroid": c[x["_cell"]].tolist() if x["_cell"] >= 0 else None} for x in sizes]
        number = len(names(self.spark, f"{self.path}/log")) + 1
        body = json.dumps({"version": version, "columns": rows.schema.json(), "vector": vector, "cells": cells_})
        if not create(self.spark, f"{self.path}/log/{number:012d}.json", body.encode()):
            raise RuntimeError(f"build {number} of {self.path} was published meanwhile")

    def _state(self) -> dict:
        last = names(self.spark, f"{self.path}/log")[-1]
        return json.loads(self.spark.read.text(f"{self.path}/log/{last}", wholetext=True).first().value)

    def bounds(self, query: list[float], state: dict | None = None) -> list[tuple[float, int, int]]:
        """(highest cosine that a cell can hold, cell, rows), best first."""
        state, q = state or self._state(), np.array(query, np.float64)
        length = np.linalg.norm(q)
        out = []
        for x in state["cells"]:
            if x["cell"] < 0 or not length:
                best = 0.0
            else:
                angle = math.acos(float(np.clip(np.dot(x["centroid"], q) / length, -1, 1)))
                best = math.cos(max(0.0, angle - x["radius"]))
            out.append((best, x["cell"], x["n"]))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def topk(self, query: list[float], k: int, key: str, share: float = 0.2, exact: bool = False, where: Column | None = None) -> DataFrame:
        """The ``k`` nearest rows with ``score``, ties by key.

        First the cells nearest by centroid, until they have ``share`` of all rows and ``k`` of them; with ``exact``, then all cells whose bound reaches the k-th score so far, so that none nearer is left out.
        """
        state = self._state()
        kind = StructType.fromJson(json.loads(state["columns"])).add("_cell", IntegerType())
        data = self.spark.read.schema(kind).parquet(f"{self.path}/data/version={state['version']}")
        data = data if where is None else data.where(where)
        score = cosine(F.col(state["vector"]), F.array(*[F.lit(float(x)) for x in query]))
        best = lambda cells: data.where(F.col("_cell").isin(cells)).drop("_cell").withColumn("score", score).orderBy(F.desc("score"), key).limit(k)
        length = float(np.linalg.norm(query)) or 1.0
        near = sorted(state["cells"], key=lambda x: (-(float(np.dot(x["centroid"], query)) / length if x["cell"] >= 0 else 0.0), x["cell"]))
        total, held, chosen = sum(x["n"] for x in near), 0, []
        for x in near:
            if held >= k and held >= share * total:
                break
            chosen.append(x["cell"])
            held += x["n"]
        if not exact:
            return best(chosen)
        found = best(chosen).select("score").collect()  # k rows
        floor = found[-1].score if len(found) == k else -2.0
        # angles and cosines are rounded
        return best([cell for bound, cell, _ in self.bounds(query, state) if bound >= floor - 1e-9])
