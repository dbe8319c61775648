"""Change detection as set algebra between a scan and the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["tenant_id", "repo_id", "source_id"]
REGISTRY = "tenant_id string, repo_id string, source_id string, job_id string, file_name string, full_path string, source_url string, mime_type string, content_hash string, last_modified_at_source timestamp, last_ingested_at timestamp, chunk_count int, status string"


def decide(scan: DataFrame, registry: DataFrame, revive_deleted: bool = False) -> DataFrame:
    """The scan with ``decision``: new, unchanged or changed. Whatever the registry's status, unless ``revive_deleted``: then a deleted document is new."""
    known = registry.where("status <> 'deleted'") if revive_deleted else registry
    known = known.select(*KEYS, F.col("content_hash").alias("_known_hash"), F.lit(True).alias("_known"))
    same = F.col("_known_hash").eqNullSafe(F.col("content_hash"))
    got = scan.join(known, KEYS, "left").withColumn("decision", F.when(F.col("_known").isNull(), "new").when(same, "unchanged").otherwise("changed"))
    return got.drop("_known_hash", "_known")


def native_deletes(feed: DataFrame, registry: DataFrame) -> DataFrame:
    """Deletions of the feed that the registry knows."""
    return feed.where("change = 'deleted'").join(registry.select(*KEYS), KEYS, "left_semi")


def implicit_deletes(registry: DataFrame, seen: DataFrame, full_listing: bool = True) -> DataFrame:
    """Active documents that a scan no longer holds. A scan of changes alone proves nothing: without a full listing there are none."""
    active = registry.where("status = 'active'")
    return active.join(seen.select(*KEYS), KEYS, "left_anti") if full_listing else active.where("false")


def upsert(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows replace those of the same key; of several, the one last ingested stays."""
    both = registry.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    order = Window.partitionBy(*KEYS).orderBy(F.desc("_new"), F.desc_nulls_last("last_ingested_at"), F.desc_nulls_last("content_hash"))
    return both.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_new")


def mark_deleted(registry: DataFrame, gone: DataFrame, at: Column) -> DataFrame:
    keys = gone.select(*KEYS).distinct().withColumn("_gone", F.lit(True))
    rows = registry.join(keys, KEYS, "left")
    rows = rows.withColumn("last_ingested_at", F.when(F.col("_gone"), at).otherwise(F.col("last_ingested_at")))
    return rows.withColumn("status", F.when(F.col("_gone"), "deleted").otherwise(F.col("status"))).select(registry.columns)


def since(rows: DataFrame, column: str, last_run: object | None) -> DataFrame:
    """Rows changed after the last run; all of them without one. The predicate reaches the scan."""
    return rows if last_run is None else rows.where(F.col(column) > F.lit(last_run))


def force_reingest(registry: DataFrame, where: Column) -> DataFrame:
    """So that the next scan finds these rows changed."""
    return registry.withColumn("content_hash", F.when(where, "__force__").otherwise(F.col("content_hash")))
