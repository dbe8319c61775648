"""Notifications of jobs: messages as rows, signed in expressions, delivered by tasks that leave a receipt for each message."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.operators import jobs
from tidemark.operators.calls import in_order
from tidemark.storage import names

JOB = ["tenant_id", "repo_id", "job_id"]
CHANNEL = "tenant_id string, repo_id string, url string, triggers array<string>, detail string, secret binary"
MESSAGE = "message_id string, url string, body string, signature string"
RECEIPT = "message_id string, status string, attempts int, http int, error string"
#: Documents that a message lists on average; longer lists go out as several messages.
LISTED = 1_000
_SALTS = 64
_COUNTERS = ["documents_scanned", "documents_new", "documents_updated", "documents_skipped", "documents_deleted", "documents_failed", "chunks_created", "chunks_deleted"]
_LISTS = {"new": "new", "updated": "updated", "deleted": "deleted", "errors": "failed"}


def hmac_sha256(key: Column, message: Column) -> Column:
    """HMAC-SHA256 of a binary column under a binary key column, in hex; null if one of them is. The key is a column, so that no plan shows it."""
    short = F.when(F.octet_length(key) > 64, F.unhex(F.sha2(key, 256))).otherwise(key)
    digits = F.rpad(F.hex(short), 128, "0")

    def mixed(byte: int) -> Column:
        one = lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("long").bitwiseXOR(F.lit(byte).cast("long"))
        return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.lpad(F.hex(one(i)), 2, "0")), ""))

    return F.when(key.isNotNull(), F.sha2(F.concat(mixed(0x5C), F.unhex(F.sha2(F.concat(mixed(0x36), message), 256))), 256))


def document_lists(documents: DataFrame, by: Sequence[str] = JOB, listed: int = LISTED) -> DataFrame:
    """One row per job and part: (by, part, parts, documents: new, updated, deleted, errors), each list by path.

    documents: by, source_id, full_path, status, error; skipped ones are on no list. A job's documents are dealt to its parts by hash, so that none is left out and no list grows with the job. A job
    without such documents has no row. Null paths and repeated rows stay, as entries of their own.
    """
    rows = documents.where(F.col("status").isin(*_LISTS.values())).withColumn("_h", F.pmod(F.xxhash64("source_id", "full_path"), F.lit(2**40)))
    parts = rows.groupBy(*by).agg(F.ceil(F.count("*") / listed).alias("parts"))
    # a job may hold most rows: its one row here has a copy for each salt
    salted = parts.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    placed = rows.withColumn("_s", (F.col("_h") % _SALTS).cast("int")).join(salted, [*by, "_s"]).withColumn("part", F.shiftright("_h", 6) % F.col("parts") + 1)
    some = lambda status, entry: F.sort_array(F.collect_list(F.when(F.col("status") == status, entry)))
    entry = {k: F.col("full_path") if k != "errors" else F.struct(F.col("full_path").alias("file"), F.col("error")) for k in _LISTS}
    # a list leaves nulls out, so a null path is an empty one
    lists = [some(s, F.coalesce(entry[k], F.lit("")) if k != "errors" else entry[k]).alias(k) for k, s in _LISTS.items()]
    got = placed.groupBy(*by, "part").agg(*lists)
    # a part that no document was dealt to is there all the same, so that a reader can wait for all of them
    every = parts.withColumn("part", F.explode(F.sequence(F.lit(1).cast("long"), F.col("parts"))))
    empty = lambda k: F.coalesce(F.col(k), F.array().cast(got.schema[k].dataType)).alias(k)
    return every.join(got, [*by, "part"], "left").select(*by, "part", "parts", F.struct(*map(empty, _LISTS)).alias("documents"))


def messages(stats: DataFrame, channels: DataFrame, documents: DataFrame | None = None, listed: int = LISTED) -> DataFrame:
    """Messages (see ``MESSAGE``) of jobs to the channels of their repositories whose triggers fit.

    stats: a row per job as of ``jobs.stats``, with job, trigger, started_at, completed_at and, for failed jobs, error. detail ``full`` adds the lists of ``documents``, in as many messages as they need, ``part`` of ``parts``; a job
    without documents has empty lists. A message's id follows from job, channel and part, so the same one has the same id. With a secret, ``signature`` is that of the body.
    """
    full = F.col("detail") == "full"
    rows = stats.join(channels, ["tenant_id", "repo_id"]).where(jobs.notifies(F.coalesce("triggers", F.array().cast("array<string>"))))
    kind = "struct<new: array<string>, updated: array<string>, deleted: array<string>, errors: array<struct<file: string, error: string>>>"
    if documents is None:
        rows = rows.withColumns({"part": F.lit(None).cast("long"), "parts": F.lit(None).cast("long"), "documents": F.lit(None).cast(kind)})
    else:
        lists = document_lists(documents, JOB, listed).withColumn("_full", F.lit(True))
        rows = rows.withColumn("_full", full).join(lists, [*JOB, "_full"], "left").drop("_full")
    none = F.from_json(F.lit('{"new":[],"updated":[],"deleted":[],"errors":[]}'), kind)
    error = F.col("error") if "error" in stats.columns else F.lit(None).cast("string")
    at = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX").alias(c)
    body = F.struct(
        F.lit("ingestion.completed").alias("event"), *JOB, "trigger", "status", at("started_at"), at("completed_at"), jobs.duration(F.col("started_at"), F.col("completed_at")).alias("duration_seconds"),
        F.struct(*_COUNTERS).alias("summary"), error.alias("error"), F.when(full, F.coalesce("part", F.lit(1))).alias("part"), F.when(full, F.coalesce("parts", F.lit(1))).alias("parts"), F.when(full, F.coalesce("documents", none)).alias("documents"),
    )
    rows = rows.select("url", "secret", F.to_json(body).alias("body"), F.sha2(F.to_json(F.array(*JOB, "url", F.coalesce("part", F.lit(1)).cast("string"))), 256).alias("message_id"))
    return rows.select("message_id", "url", "body", hmac_sha256(F.col("secret"), F.encode("body", "utf-8")).alias("signature"))


@dataclass
class Sent(WriterCommitMessage):
    """What one task did; receipts hold the rest."""

    counts: dict[str, int]


class WebhookWriter(DataSourceWriter):
    """Posts messages. A message that was taken or refused has a receipt of its name, written as soon as it is known, and is not posted again by whoever finds it; the message's id goes along as ``Idempotency-Key`` for the
    case that a task is lost between the two."""

    def __init__(self, options: dict[str, str]):
        self.path, self.attempts, self.backoff = options["path"], int(options.get("attempts", 3)), float(options.get("backoff", 2))
        self.timeout, self.width, self.rate = float(options.get("timeout", 10)), int(options.get("width", 4)), float(options.get("rate", 0)) or None

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def post(self, m: Row) -> dict:
        """Receipt of one message: sent (2xx), refused (4xx, not tried again) or failed (all attempts in vain); waits twice as long before each further attempt."""
        headers = {"Content-Type": "application/json", "Idempotency-Key": m.message_id} | ({"X-Signature": f"sha256={m.signature}"} if m.signature else {})
        got: dict = {"message_id": m.message_id, "status": "failed", "attempts": 0, "http": None, "error": None}
        for n in range(1, self.attempts + 1):
            got |= {"attempts": n, "http": None, "error": None}
            try:
                with urllib.request.urlopen(urllib.request.Request(m.url, m.body.encode(), headers, method="POST"), timeout=self.timeout) as answer:
                    return got | {"status": "sent", "http": answer.status}
            except urllib.error.HTTPError as e:
                got |= {"http": e.code, "error": f"HTTP {e.code}"}
                if 400 <= e.code < 500:
                    return got | {"status": "refused"}
            except Exception as e:  # no answer, or no such address: what stops a message is its outcome
                got |= {"error": f"{type(e).__name__}: {e}"}
            if n < self.attempts:
                time.sleep(self.backoff * 2 ** (n - 1))
        return got

    def write(self, iterator: Iterator[Row]) -> Sent:
        files, root = self._files()
        counts = dict.fromkeys(("sent", "refused", "failed", "known"), 0)

        def deliver(m: Row) -> str:
            folder = f"{root}/receipts/{m.message_id[:2]}"
            final, other = f"{folder}/{m.message_id}.json", f"{folder}/{m.message_id}.failed.json"
            if files.get_file_info(final).type == fs.FileType.File:
                return "known"
            got = self.post(m)
            files.create_dir(folder, recursive=True)
            with files.open_output_stream(other if got["status"] == "failed" else final) as out:
                out.write(json.dumps(got).encode())
            return got["status"]

        for kind, error in in_order(iterator, deliver, self.width, self.rate):
            if error:
                raise error
            counts[kind] += 1
        return Sent(counts)

    def commit(self, messages: list[Sent | None]) -> None:
        files, root = self._files()
        files.create_dir(f"{root}/runs", recursive=True)
        with files.open_output_stream(f"{root}/runs/{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({k: sum(m.counts[k] for m in messages if m) for k in ("sent", "refused", "failed", "known")}).encode())

    def abort(self, messages: list[Sent | None]) -> None:
        """Receipts stay: what was posted was posted."""


class WebhookSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_webhook"

    def schema(self) -> str:
        return MESSAGE

    def writer(self, schema: StructType, overwrite: bool) -> WebhookWriter:
        return WebhookWriter(dict(self.options))


class Outbox:
    """Messages in a folder that driver and executors share, with the receipts of their delivery. ``put`` belongs to a job, ``deliver`` can run at any time and as often as wanted."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, rows: DataFrame) -> None:
        rows.select(*[c.split()[0] for c in MESSAGE.split(", ")]).write.mode("append").parquet(f"{self.path}/messages")

    def receipts(self) -> DataFrame:
        """The last outcome of each message that was tried: a final one before a failure."""
        if not names(self.spark, f"{self.path}/receipts"):
            return self.spark.createDataFrame([], RECEIPT)
        rows = self.spark.read.schema(RECEIPT).option("recursiveFileLookup", True).json(f"{self.path}/receipts")
        cols = [c.split()[0] for c in RECEIPT.split(", ")]
        return rows.groupBy("message_id").agg(F.max_by(F.struct(*cols[1:]), F.col("status") != "failed").alias("r")).select("message_id", "r.*")

    def waiting(self) -> DataFrame:
        """Messages without a final outcome, one row each however often they were put."""
        if not names(self.spark, f"{self.path}/messages"):
            return self.spark.createDataFrame([], MESSAGE)
        rows = self.spark.read.schema(MESSAGE).parquet(f"{self.path}/messages")
        return rows.join(self.receipts().where("status <> 'failed'").select("message_id"), "message_id", "left_anti").dropDuplicates(["message_id"])

    def deliver(self, attempts: int = 3, backoff: float = 2, timeout: float = 10, width: int = 4, rate: float | None = None) -> DataFrame:
        """Posts what waits, ``width`` at once and ``rate`` a second in each task, and returns the receipts."""
        self.spark.dataSource.register(WebhookSink)
        options = {"path": self.path, "attempts": str(attempts), "backoff": str(backoff), "timeout": str(timeout), "width": str(width), "rate": str(rate or 0)}
        self.waiting().write.format(WebhookSink.name()).options(**options).mode("append").save()
        return self.receipts()
