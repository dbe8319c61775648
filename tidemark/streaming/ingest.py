"""Feeds as streams: each micro-batch is decided against the registry; the checkpoint takes the place of delta tokens and last-run times."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import delta
from tidemark.operators.registry import RegistryTable
from tidemark.sources.drive import items_stream
from tidemark.sources.scan import DRIVE_ITEM, drive_items


def drive_stream(spark: SparkSession, cfg: dict[str, Any]) -> DataFrame:
    return drive_items(spark.readStream.schema(DRIVE_ITEM).json(cfg["path"]), cfg)


def drive_delta_stream(spark: SparkSession, cfg: dict[str, Any], checkpoint: str) -> DataFrame:
    """A drive's changes from the service itself (see ``sources.drive``), going on where the checkpoint ends; ``listing`` tells rows of a full listing."""
    return drive_items(items_stream(spark, cfg, checkpoint), cfg)


def latest(batch: DataFrame, order: str) -> DataFrame:
    """One row a document: of several in a batch the last one counts; of those of one time a deletion, else the largest hash."""
    names = [c for c in batch.columns if c not in delta.KEYS]
    rank = F.struct(F.col(order), (F.col("change") == "deleted").alias("gone"), F.col("content_hash"), F.to_json(F.struct(*names)).alias("row"))
    return batch.groupBy(*delta.KEYS).agg(F.max_by(F.struct(*names), rank).alias("_r")).select(*delta.KEYS, "_r.*")


def apply_stream(feed: DataFrame, registry: RegistryTable, decisions: str, checkpoint: str, order: str = "last_modified_at_source") -> StreamingQuery:
    """feed: keys, change, content_hash and the registry's other source fields. Writes each batch's decisions to ``decisions`` and the new registry, then stops when all that is there has been read.

    With a column ``listing``, rows of change ``listed`` end a full listing: active documents of its repository that none of its batches held are deleted.
    """
    listed = "listing" in feed.columns

    def one(batch: DataFrame, n: int) -> None:
        spark, rows = batch.sparkSession, latest(batch.where("change <> 'listed'"), order)
        known = registry.rows_of(rows, n - 1)
        more = [F.col("listing")] if listed else []
        got = delta.decide(rows.where("change = 'upsert'"), known).select(*delta.KEYS, "content_hash", order, "decision", *more)
        gone = delta.native_deletes(rows, known).select(*delta.KEYS, "content_hash", order, F.lit("deleted").alias("decision"), *more)
        got.unionByName(gone).withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{decisions}/batch={n}")
        kinds = {x.split()[0]: x.split()[1] for x in delta.REGISTRY.split(", ")}
        new = rows.where("change = 'upsert'").withColumns({"status": F.lit("active"), "last_ingested_at": F.col(order)})
        new = new.select(*[F.col(c).cast(kinds[c]) if c in new.columns else F.lit(None).cast(kinds[c]).alias(c) for c in kinds])
        gone = gone.select(*delta.KEYS)
        for end in batch.where("change = 'listed'").select("tenant_id", "repo_id", "listing").distinct().collect() if listed else []:  # one row a repository
            own = (F.col("tenant_id") == end.tenant_id) & (F.col("repo_id") == end.repo_id)
            seen = spark.read.parquet(decisions).where((F.col("listing") == end.listing) & (F.col("batch") <= n) & own)
            lost = registry.absent(seen, own, n - 1).join(new.select(*delta.KEYS), delta.KEYS, "left_anti")
            gone = gone.unionByName(lost.select(*delta.KEYS))
        left = delta.mark_deleted(registry.rows_of(gone, n - 1), gone, F.lit(None).cast("timestamp"))
        registry.write(new.unionByName(left), n)

    return feed.writeStream.queryName(f"delta-{uuid.uuid4().hex[:8]}").foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
