"""Job statistics, state and notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "tenant_id string, repo_id string, source_id string, full_path string, status string, chunks_created int, chunks_deleted int, error string"


def stats(results: DataFrame, deletions: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """Counters of a job. results: status new, updated, skipped or failed; deletions: chunks_deleted, counted as deleted but not as scanned."""
    rows = results.select(*(by or []), "status", "chunks_created", "chunks_deleted")
    if deletions is not None:
        rows = rows.unionByName(deletions.select(*(by or []), F.lit("deleted").alias("status"), F.lit(0).alias("chunks_created"), "chunks_deleted"))
    count = lambda s: F.count_if(F.col("status") == s)
    total = lambda c, *s: F.coalesce(F.sum(F.when(F.col("status").isin(*s), F.col(c))), F.lit(0)).cast("long")
    got = rows.groupBy(*(by or [])).agg(
        F.count_if(F.col("status") != "deleted").alias("documents_scanned"), count("new").alias("documents_new"), count("updated").alias("documents_updated"), count("skipped").alias("documents_skipped"), count("failed").alias("documents_failed"),
        count("deleted").alias("documents_deleted"), total("chunks_created", "new", "updated").alias("chunks_created"), total("chunks_deleted", "updated", "deleted").alias("chunks_deleted"),
    )
    return got.withColumn("status", F.when(F.col("documents_failed") > 0, "partial").otherwise(F.lit("completed")))


def failed(spark: SparkSession, error: str) -> DataFrame:
    """The statistics row of a job that itself failed, whatever its documents came to: zeros, the status and the error."""
    counters = ["documents_scanned", "documents_new", "documents_updated", "documents_skipped", "documents_failed", "documents_deleted", "chunks_created", "chunks_deleted"]
    return spark.range(1).select(*[F.lit(0).cast("long").alias(c) for c in counters], F.lit("failed").alias("status"), F.lit(error).alias("error"))


def rollup_stats(results: DataFrame) -> DataFrame:
    """Scanned documents by tenant and repository, with subtotals; an extension."""
    return results.rollup("tenant_id", "repo_id").agg(F.count("*").alias("documents_scanned"), F.grouping_id().alias("level"))


def error_log(results: DataFrame, by: list[str]) -> DataFrame:
    """Failed documents of a job as one list, in order of path."""
    entry = F.struct(F.col("full_path").alias("file"), F.col("error"))
    return results.where("status = 'failed'").groupBy(*by).agg(F.sort_array(F.collect_list(entry)).alias("errors"))


def duration(started: Column, ended: Column) -> Column:
    return F.timestamp_diff("SECOND", started, ended)


def notifies(triggers: Column) -> Column:
    """Whether a stats row calls for a notification; without triggers, always."""
    failed = (F.col("status") == "failed") | (F.col("documents_failed") > 0)
    changed = F.col("documents_new") + F.col("documents_updated") + F.col("documents_deleted") > 0
    has = lambda t: F.array_contains(triggers, t)
    return (F.size(triggers) == 0) | has("always") | (has("on_failure") & failed) | (has("on_change") & changed)


def payload(detail: str, *lists: str) -> Column:
    """JSON of a stats row: ``summary``, or ``full`` with the named list columns."""
    names = ["status", "documents_scanned", "documents_new", "documents_updated", "documents_skipped", "documents_failed", "documents_deleted", "chunks_created", "chunks_deleted"]
    return F.to_json(F.struct(*names, *(lists if detail == "full" else ())))


def may_start(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requests for repositories without an active job; the rest are conflicts."""
    active = jobs.where(F.col("status").isin("queued", "running"))
    return requests.join(active.select("repo_id").distinct(), "repo_id", "left_anti")
