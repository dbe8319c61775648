"""Links within groups that are too large for a task: dealt in blocks, contracted to a few members a block, and then only what is not in a group's largest class meets the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.storage import materialize

#: From payloads to links (i, j) whose classes are those of all links among them, i being a smaller position than j or found earlier.
Forest = Callable[[list[bytes]], list[tuple[int, int]]]
_OUT = "cell long, a long, b long, payload binary"


def _blocks(forest: Forest, heads: bool):
    """Over rows (block, cell, node, payload) sorted by block: links (a, b); with ``heads``, also one member at least of each class within a block, as (cell, a = node, payload)."""

    def close(cells: list[int], nodes: list[int], payloads: list[bytes]) -> pa.RecordBatch:
        found = forest(payloads)
        lead = sorted(set(range(len(nodes))) - {j for _, j in found}) if heads else []
        cell = [None] * len(found) + [cells[i] for i in lead]
        a, b = [nodes[i] for i, _ in found] + [nodes[i] for i in lead], [nodes[j] for _, j in found] + [None] * len(lead)
        return pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([None] * len(found) + [payloads[i] for i in lead], pa.binary())], ["cell", "a", "b", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, ([], [], [])
        for batch in batches:
            for b, *row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if b != block:
                    if held[0]:
                        yield close(*held)
                    block, held = b, ([], [], [])
                for part, x in zip(held, row, strict=True):
                    part.append(x)
        if held[0]:
            yield close(*held)

    return run


def in_blocks(dealt: DataFrame, forest: Forest, heads: bool = False) -> DataFrame:
    """dealt: (block, cell, node, payload); each block must fit a task."""
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.select("block", "cell", "node", "payload").repartition(n, "block").sortWithinPartitions("block").mapInArrow(_blocks(forest, heads), _OUT)


def _sized(rows: DataFrame, block_bytes: int, name: str) -> DataFrame:
    """(cell, name: how many blocks of ``block_bytes`` its rows fill)."""
    return rows.groupBy(F.col("cell").alias(f"{name}_cell")).agg(F.ceil(F.sum(F.length("payload") + 16) / block_bytes).alias(name))


def _part(n: str, level: int = 0):
    return F.pmod(F.xxhash64("node", F.lit(level)), F.col(n))


def _meeting(one: DataFrame, other: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks in which every row of ``one`` meets every row of ``other`` of its cell at least once."""
    sizes = _sized(one, block_bytes, "n").join(_sized(other, block_bytes, "m"), F.col("n_cell") == F.col("m_cell")).select("n_cell", "n", "m")
    sizes = materialize(sizes, "sizes")  # one row a large group: broadcast by Spark if small, else joined by key, hot keys split by AQE
    deal = lambda rows, own, across, flip: rows.join(sizes, F.col("cell") == F.col("n_cell")).withColumn("i", _part(own)).select("cell", "node", "payload", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col(across) - 1)).alias("j")).select(
        F.xxhash64("cell", *(("j", "i") if flip else ("i", "j"))).alias("block"), "cell", "node", "payload"
    )
    return deal(one, "n", "m", False).unionByName(deal(other, "m", "n", True))


def links_in_large_groups(members: DataFrame, forest: Forest, block_bytes: int) -> DataFrame:
    """(a, b) links whose classes are those of all links within cells. members: (cell long, node long, payload binary), of cells above ``block_bytes``.

    Each round deals what is left of a group in blocks and keeps one member of each class that a block finds; a group of near copies is down to a few after one round. When a
    round does not halve what is left, its members meet in pairs of blocks. By then most of a group is one class, as a rule: its members need
    not be compared with each other again, only what is outside of it with all. So work goes with a group's size times what is outside of its largest class; no pair that could join two classes is left out.
    """
    whole = materialize(members, "large")
    left, found, level, before = whole, [], 0, None
    while True:
        sizes = materialize(_sized(left, block_bytes, "n"), "sizes")
        blocks, rows = sizes.agg(F.max("n")).first()[0] or 0, left.count()
        if blocks <= 1 or before is not None and 2 * rows > before:
            break
        dealt = left.join(sizes, F.col("cell") == F.col("n_cell")).withColumn("block", F.xxhash64("cell", _part("n", level)))
        out = materialize(in_blocks(dealt, forest, heads=True), "dealt")
        found.append(out.where("b is not null").select("a", "b"))
        left, level, before = out.where("b is null").select("cell", F.col("a").alias("node"), "payload"), level + 1, rows
    last = in_blocks(_meeting(left, left, block_bytes), forest) if blocks > 1 else in_blocks(left.withColumn("block", F.col("cell")), forest)
    found.append(materialize(last, "dealt").select("a", "b"))
    links = reduce(DataFrame.unionByName, found)
    stars = materialize(components(links), "classes").select(F.col("node").alias("v"), "root")
    marked = materialize(whole.join(stars, F.col("node") == F.col("v"), "left").select("cell", "node", "payload", F.coalesce("root", "node").alias("class")), "large")
    largest = materialize(marked.groupBy("cell", "class").agg(F.count("*").alias("n")).groupBy(F.col("cell").alias("c")).agg(F.max_by("class", F.struct("n", "class")).alias("top")), "largest")
    outside = materialize(marked.join(largest, F.col("cell") == F.col("c")).where("class <> top").select("cell", "node", "payload"), "outside")
    if outside.isEmpty():
        return links
    return links.unionByName(in_blocks(_meeting(outside, whole, block_bytes), forest).select("a", "b"))
