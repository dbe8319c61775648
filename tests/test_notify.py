import hashlib
import hmac
import http.server
import json
import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import delta, embed, notify
from tidemark.operators.store import ChunkStore
from tidemark.plans.ingest import Plan, run, run_job

LISTS = "repo_id string, tenant_id string, job_id string, source_id string, full_path string, status string, error string"


class Hook:
    """Takes posts; /bad refuses, /busy answers 503 twice, /down always."""

    def __init__(self):
        self.seen, self.asked = [], {}
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                body, key = self.rfile.read(int(self.headers["Content-Length"])), self.headers["Idempotency-Key"]
                n = outer.asked[key] = outer.asked.get(key, 0) + 1
                status = 400 if self.path == "/bad" else 503 if self.path == "/down" or (self.path == "/busy" and n < 3) else 204
                if status == 204:
                    outer.seen.append((key, self.headers.get("X-Signature"), body))
                self.send_response(status)
                self.send_header("Content-Length", "0")
                self.end_headers()

            def log_message(self, *a):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"


@pytest.fixture
def hook():
    h = Hook()
    yield h
    h.server.shutdown()


def test_hmac_of_any_key(spark):
    cases = [(b"", b""), (b"k", "ü\x00".encode()), (b"\xff" * 64, b"a" * 1000), (b"long" * 40, b"x")]
    got = spark.createDataFrame([(bytearray(k), bytearray(m)) for k, m in cases], "k binary, m binary").select("k", "m", notify.hmac_sha256(F.col("k"), F.col("m")).alias("h")).collect()
    assert all(r.h == hmac.new(bytes(r.k), bytes(r.m), hashlib.sha256).hexdigest() for r in got) and len(got) == 4
    assert spark.createDataFrame([(None, bytearray(b"x"))], "k binary, m binary").select(notify.hmac_sha256(F.col("k"), F.col("m"))).first()[0] is None


def test_lists_are_whole_in_parts(spark):
    rows = [("r", "t", "j", str(i), f"/{i:03d}", ("new", "updated", "deleted", "failed", "skipped")[i % 5], "e" if i % 5 == 3 else None) for i in range(200)]
    rows += [("s", "t", "j", "1", None, "new", None), ("s", "t", "j", "1", None, "new", None), ("q", "t", "j", "1", "/x", "skipped", None)]
    got = notify.document_lists(spark.createDataFrame(rows, LISTS), listed=7).collect()
    mine = [r for r in got if r.repo_id == "r"]
    assert sorted(r.part for r in mine) == list(range(1, 24)) and {r.parts for r in mine} == {23}
    for kind, n in (("new", 0), ("updated", 1), ("deleted", 2)):
        assert sorted(x for r in mine for x in r.documents[kind]) == [f"/{i:03d}" for i in range(200) if i % 5 == n]
    assert sorted((e.file, e.error) for r in mine for e in r.documents.errors) == [(f"/{i:03d}", "e") for i in range(200) if i % 5 == 3]
    assert [(r.part, r.parts, r.documents.new) for r in got if r.repo_id == "s"] == [(1, 1, ["", ""])] and not [r for r in got if r.repo_id == "q"]
    assert notify.document_lists(spark.createDataFrame([], LISTS)).count() == 0


def _messages(spark, hook):
    counters = {c: F.lit(1).cast("long") for c in ["documents_scanned", "documents_new", "documents_updated", "documents_skipped", "documents_deleted", "documents_failed", "chunks_created", "chunks_deleted"]}
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stats = spark.createDataFrame([("t", "r", "j", "manual", "partial")], "tenant_id string, repo_id string, job_id string, trigger string, status string").withColumns(counters | {"started_at": at, "completed_at": at})
    channels = [("t", "r", f"{hook.url}/{p}", [], "summary", bytearray(b"key") if p == "ok" else None) for p in ("ok", "bad", "busy", "down")] + [("t", "r", f"{hook.url}/full", ["on_failure"], "full", None), ("t", "other", f"{hook.url}/other", [], "summary", None), ("t", "r", "no url", None, None, None)]
    docs = spark.createDataFrame([("r", "t", "j", str(i), f"/{i}", "new", None) for i in range(30)], LISTS)
    return notify.messages(stats, spark.createDataFrame(channels, notify.CHANNEL), docs, listed=10)


def test_delivery_retries_refuses_and_repeats_nothing(spark, tmp_path, hook):
    box = notify.Outbox(spark, str(tmp_path))
    assert box.waiting().count() == 0 and box.deliver().count() == 0
    sent = _messages(spark, hook)
    box.put(sent)
    box.put(sent)
    got = {r.message_id: r for r in box.deliver(backoff=0.01, timeout=5).collect()}
    by = {m.url.rpartition("/")[2]: got[m.message_id] for m in sent.collect()}
    assert len(got) == 8 and [tuple(by[p])[1:4] for p in ("ok", "bad", "busy", "down")] == [("sent", 1, 204), ("refused", 1, 400), ("sent", 3, 204), ("failed", 3, 503)]
    assert by["no url"].status == "failed" and by["no url"].http is None and by["no url"].error
    assert sorted(x for _, _, b in hook.seen if b'"parts":3' in b for x in json.loads(b)["documents"]["new"]) == sorted(f"/{i}" for i in range(30))
    signed = [(s, b) for _, s, b in hook.seen if s]
    assert [s for s, _ in signed] == ["sha256=" + hmac.new(b"key", b, hashlib.sha256).hexdigest() for _, b in signed] and len(signed) == 1
    before = len(hook.seen)
    again = {r.message_id: r.status for r in box.deliver(attempts=1, backoff=0.01).collect()}
    assert len(hook.seen) == before == len({k for k, _, _ in hook.seen}) and again == {k: r.status for k, r in got.items()}
    assert hook.asked[by["down"].message_id] == 4 and hook.asked[by["bad"].message_id] == 1
    assert sum(json.loads(p.read_text())["sent"] for p in (tmp_path / "runs").iterdir()) == before


def test_a_task_that_dies_half_way_repeats_nothing(spark, tmp_path, hook):
    rows = [SimpleNamespace(message_id=hashlib.sha256(bytes([i])).hexdigest(), url=f"{hook.url}/ok", body="{}", signature=None) for i in range(20)]
    writer = notify.WebhookWriter({"path": str(tmp_path), "backoff": "0.01"})

    def lost():
        yield from rows[:9]
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(lost())
    assert writer.write(iter(rows)).counts == {"sent": 11, "refused": 0, "failed": 0, "known": 9}
    assert len(hook.seen) == len({k for k, _, _ in hook.seen}) == 20


def test_runs_put_messages_with_their_documents(spark, tmp_path, hook):
    feed = lambda *texts: spark.createDataFrame([(f"d{i}", "upsert", f"/a/d{i}.txt", "text/plain", bytearray(t.encode()), hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(texts)], "source_id string, change string, full_path string, mime_type string, content binary, content_hash string").withColumns(
        {"content_type": F.lit("file"), "structured_source_type": F.lit(None).cast("string"), "record": F.lit(None).cast("string"), "file_name": F.element_at(F.split("full_path", "/"), -1), "source_url": F.lit(None).cast("string"), "last_modified_at_source": F.lit("2024-01-01").cast("timestamp")}
    )
    box = notify.Outbox(spark, str(tmp_path / "box"))
    channels = spark.createDataFrame([("t", "r", f"{hook.url}/full", [], "full", None), ("t", "r", f"{hook.url}/quiet", ["on_failure"], "summary", None)], notify.CHANNEL)
    plan, store, now = Plan("t", "r", provider=embed.HashingProvider(dimensions=4), outbox=box, channels=channels), ChunkStore(spark, str(tmp_path / "chunks")), F.lit("2024-01-01").cast("timestamp")
    reg, _ = run(feed("one", "two", "three"), spark.createDataFrame([], delta.REGISTRY), store, plan, "j1", now)
    reg, _ = run(feed("one", "2"), reg, store, plan, "j2", now)

    def broken():
        raise OSError("no source")

    run_job(broken, reg, store, plan, "j3", now)
    box.deliver(backoff=0.01)
    got = {}
    for _, _, b in hook.seen:
        got.setdefault((x := json.loads(b))["job_id"], []).append(x)
    assert got["j1"][0]["documents"] == {"new": ["/a/d0.txt", "/a/d1.txt", "/a/d2.txt"], "updated": [], "deleted": [], "errors": []} and len(got["j1"]) == 1
    assert got["j2"][0]["documents"] == {"new": [], "updated": ["/a/d1.txt"], "deleted": ["/a/d2.txt"], "errors": []} and got["j2"][0]["summary"]["documents_skipped"] == 1
    assert len(got["j3"]) == 2 and all(x["status"] == "failed" and "no source" in x["error"] for x in got["j3"])
