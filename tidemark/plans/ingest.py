"""One ingestion run as one lineage: scan, decide, load, rewrite tables, chunk, enrich, embed; then chunks, registry and statistics."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import chunk, delta, embed, enrich, images, jobs, load, notify, tables
from tidemark.operators.known import KnownValues
from tidemark.operators.registry import RegistryTable
from tidemark.operators.store import ChunkStore
from tidemark.plans.config import IngestionSettings, MetadataField, RetrievalConfig, merge_settings
from tidemark.storage import folder, materialize, scratch, written

KEYS = delta.KEYS


@dataclass
class Plan:
    tenant: str
    repo: str
    settings: IngestionSettings = field(default_factory=lambda: merge_settings(None, None))
    schema: list[MetadataField] = field(default_factory=list)
    retrieval: RetrievalConfig = field(default_factory=RetrievalConfig)
    provider: embed.Provider = field(default_factory=embed.HashingProvider)
    #: Hooks: PDF pages, their OCR, repair of complex documents, descriptions of images, a model's sentence for a chunk (used where the settings ask for it).
    pdf: load.PdfExtractor | None = None
    ocr: load.Ocr | None = None
    repair: Callable[[str], str] | None = None
    describe: images.Describe | None = None
    context: Callable[[pd.DataFrame], pd.Series] | None = None
    #: The view of known values that a run keeps up with its chunks.
    known: KnownValues | None = None
    #: Keys of the source's extra_metadata that become columns (see ``scan.EXTRAS``).
    extras: Sequence[str] = ()
    #: Where a run puts its messages for the channels of its repository (rows as of ``notify.CHANNEL``).
    outbox: notify.Outbox | None = None
    channels: DataFrame | None = None
    trigger: str = "manual"


def prepare(changed: DataFrame, plan: Plan, job_id: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(results, chunks) of changed documents: one result a document, whatever happens to it."""
    loaded = materialize(load.load(changed, plan.pdf, plan.ocr, plan.repair, plan.settings.document_concurrency, bool(plan.describe)).drop("content").withColumn("markdown", tables.to_prose(F.col("markdown"))), "loaded")
    if plan.describe:
        loaded = materialize(images.described(loaded, KEYS, plan.describe, plan.settings.document_concurrency), "loaded")
    blank = ~F.rlike(F.coalesce(F.col("markdown"), F.lit("")), F.lit(r"\S"))
    loaded = loaded.withColumn("status", F.coalesce("status", F.when(blank, "skipped"), F.when(F.col("decision") == "new", "new").otherwise("updated")))
    chunks = chunk.chunk(loaded.where("status in ('new', 'updated')"), "markdown", plan.settings.chunk_size, plan.settings.chunk_overlap)
    if plan.settings.contextual and plan.context:
        chunks = enrich.contextualise(chunks, plan.context, KEYS, tables_only=plan.settings.contextual_mode == "tables_only", concurrency=plan.settings.contextual_concurrency)
    chunks = enrich.extras(enrich.standard(chunks, job_id, now), plan.extras)
    chunks = enrich.identity(enrich.custom(chunks, plan.schema), plan.retrieval, plan.schema, plan.extras)
    chunks = embed.embed(chunks, plan.provider, batch=plan.settings.embedding_batch_size, concurrency=plan.settings.embedding_concurrency)
    return loaded, chunks.drop("decision", "loader", "status", "error", "record", "change")


#: Changed keys that are sent to the feed's rows; more are joined by key, which moves the contents of the feed once.
SENT_KEYS = 1_000_000
_BODY = ["content", "record"]


def changed_contents(feed: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of the feed that are among the changed ones (keys, content_hash, decision), read from the source again, with their decision. What reads otherwise than it did when it was decided is left out."""
    few = changed.count() <= SENT_KEYS
    asked = changed.select(*KEYS, F.col("content_hash").alias("_hash"), "decision")
    same = F.col("content_hash").eqNullSafe(F.col("_hash"))
    return feed.where("change = 'upsert'").join(F.broadcast(asked) if few else asked, KEYS).where(same).drop("_hash")


def run(feed: DataFrame, registry: DataFrame | RegistryTable, store: ChunkStore, plan: Plan, job_id: str, now: Column, full_listing: bool = True, native_deletes: bool = False) -> tuple[DataFrame, DataFrame]:
    """Applies a feed. Returns (registry, statistics row); the store is replaced along the way, after everything that can fail has run.

    A registry given as a table gets a version of the rows that changed; one given as rows comes back whole. The feed is read for keys and hashes first; contents are read again, and written, of changed documents only. A document that changes between the two readings
    fails in this run and is changed for the next one. Intermediate tables are gone when this returns.
    """
    spark, table, began = feed.sparkSession, registry if isinstance(registry, RegistryTable) else None, time.time()
    registry_path, stats_path = folder(spark, "registry"), folder(spark, "stats")
    with scratch(spark):
        changed, gone, stats, seen, chunks, good, documents = _decided(feed, registry, store, plan, job_id, now, full_listing, native_deletes, stats_path)
        if table:
            left = delta.mark_deleted(table.rows_of(gone), gone, now)
            table.write(changed.unionByName(left), table.version() + 1)
        else:
            registry = written(delta.mark_deleted(delta.upsert(registry, changed), gone, now), registry_path)
        out = gone.unionByName(good.select(*KEYS))
        before = store.read(plan.tenant, plan.repo, upto=seen) if plan.known else None
        store.replace(chunks, out, seen)
        if plan.known:
            plan.known.update(chunks, None if before is None else before.join(out.distinct(), KEYS, "left_semi"))
        if plan.outbox:
            _notify(plan, stats, documents, job_id, began)
    return table.read() if table else registry, stats


def _notify(plan: Plan, stats: DataFrame, documents: DataFrame | None, job_id: str, began: float) -> None:
    """Messages of a run that is over, or failed, to its outbox; posting them is not part of the run."""
    if plan.outbox is None or plan.channels is None:
        return
    job = {"tenant_id": F.lit(plan.tenant), "repo_id": F.lit(plan.repo), "job_id": F.lit(job_id)}
    row = stats.withColumns(job | {"trigger": F.lit(plan.trigger), "started_at": F.timestamp_seconds(F.lit(began)), "completed_at": F.timestamp_seconds(F.lit(time.time()))})
    plan.outbox.put(notify.messages(row, plan.channels, None if documents is None else documents.withColumns(job)))


def _decided(feed: DataFrame, registry: DataFrame | RegistryTable, store: ChunkStore, plan: Plan, job_id: str, now: Column, full_listing: bool, native_deletes: bool, stats_path: str) -> tuple[DataFrame, DataFrame, DataFrame, int, DataFrame, DataFrame, DataFrame]:
    """(rows for the registry, keys that go, statistics, the store's number, chunks, documents ingested, what a notification lists)."""
    feed = feed.withColumns({"tenant_id": F.lit(plan.tenant), "repo_id": F.lit(plan.repo)})
    own = (F.col("tenant_id") == plan.tenant) & (F.col("repo_id") == plan.repo)
    seen = store.last()
    listed = materialize(feed.drop(*_BODY), "listed")
    upserts = listed.where("change = 'upsert'")
    mine = registry.rows_of(listed) if isinstance(registry, RegistryTable) else registry.where(own)
    decided = materialize(delta.decide(upserts, mine).select(*upserts.columns, "decision"), "decided")
    changed = decided.where("decision <> 'unchanged'")
    loaded, chunks = prepare(changed_contents(feed, changed.select(*KEYS, "content_hash", "decision").distinct()), plan, job_id, now)
    chunks = materialize(chunks, "chunks")
    lost = changed.join(loaded.select(*KEYS), KEYS, "left_anti").select(*KEYS, "full_path", F.lit("failed").alias("status"))
    if native_deletes:
        gone = delta.native_deletes(listed, mine)
    elif isinstance(registry, RegistryTable) and full_listing:
        gone = registry.absent(upserts, own)
    else:
        gone = delta.implicit_deletes(mine, upserts, full_listing)
    gone = materialize(gone.select(*KEYS).distinct(), "gone")
    good = loaded.where("status in ('new', 'updated')")
    live = store.read(plan.tenant, plan.repo, upto=seen)
    touched = loaded.select(*KEYS).unionByName(gone).distinct()
    none = touched.where("false").withColumn("chunks_deleted", F.lit(0))
    # old chunks are counted for what changes, by the keys alone
    old = none if live is None else materialize(live.select(*KEYS).join(touched, KEYS, "left_semi").groupBy(*KEYS).agg(F.count("*").cast("int").alias("chunks_deleted")), "old")
    counts = chunks.groupBy(*KEYS).agg(F.count("*").cast("int").alias("chunks_created"))
    unchanged = decided.where("decision = 'unchanged'").select(*KEYS, "full_path", F.lit("skipped").alias("status"))
    results = loaded.select(*KEYS, "full_path", "status").unionByName(lost).join(counts, KEYS, "left").join(old, KEYS, "left").unionByName(unchanged, allowMissingColumns=True).na.fill(0, ["chunks_created", "chunks_deleted"])
    stats = written(jobs.stats(results, gone.join(old, KEYS, "left").na.fill(0, ["chunks_deleted"])), stats_path)
    rows = good.join(counts, KEYS, "left").select(*KEYS, F.lit(job_id).alias("job_id"), "file_name", "full_path", "source_url", "mime_type", "content_hash", "last_modified_at_source", now.alias("last_ingested_at"), F.coalesce("chunks_created", F.lit(0)).alias("chunk_count"), F.lit("active").alias("status"))
    documents = loaded.select("source_id", "full_path", "status", "error").unionByName(lost.select("source_id", "full_path", "status", F.lit("changed while it was read").alias("error")))
    if plan.outbox:
        paths = gone.join(mine.select(*KEYS, "full_path"), KEYS, "left").select("source_id", "full_path", F.lit("deleted").alias("status"), F.lit(None).cast("string").alias("error"))
        documents = materialize(documents.unionByName(paths), "documents")
    return materialize(rows, "rows"), gone, stats, seen, chunks, good, documents


def run_job(feed: Callable[[], DataFrame], registry: DataFrame | RegistryTable, store: ChunkStore, plan: Plan, job_id: str, now: Column, full_listing: bool = True, native_deletes: bool = False) -> tuple[DataFrame, DataFrame]:
    """``run`` as a job: an error of the source or of the run itself leaves registry and store as they were and makes a statistics row with status ``failed``."""
    began = time.time()
    try:
        return run(feed(), registry, store, plan, job_id, now, full_listing, native_deletes)
    except Exception as e:  # whatever stops a job is its outcome
        stats = jobs.failed(store.spark, f"{type(e).__name__}: {e}")
        _notify(plan, stats, None, job_id, began)
        return registry.read() if isinstance(registry, RegistryTable) else registry, stats
