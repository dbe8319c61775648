import http.server
import json
import threading
import urllib.parse

import pytest
from pyspark.sql import functions as F

from tidemark.operators.registry import RegistryTable
from tidemark.sources import drive, scan
from tidemark.streaming.ingest import apply_stream, drive_delta_stream


class Drive:
    """A service with a log of changes: full listings and deltas in pages of two, links that expire, contents apart."""

    def __init__(self):
        self.log, self.oldest, self.asked = [], 0, []
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                outer.asked.append(self.path)
                where, query = urllib.parse.urlparse(self.path), urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query)
                if where.path == "/content":
                    text = query["of"][0]
                    self.send_response(404 if "missing" in text else 200)
                    self.end_headers()
                    self.wfile.write(text.encode())
                    return
                assert self.headers["Authorization"] == "Bearer t"
                status, body = outer.page(query.get("token", [""])[0])
                self.send_response(status)
                self.end_headers()
                self.wfile.write(json.dumps(body).encode())

            def log_message(self, *a):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.root = f"http://127.0.0.1:{self.server.server_port}"
        self.cfg = {"url": f"{self.root}/delta", "headers": {"Authorization": "Bearer t"}, "root_folder": "Docs"}

    def page(self, token):
        kind, k, at = (token or f"full-{len(self.log)}-0").split("-")
        k, at = int(k), int(at)
        if kind == "full":
            live = {}
            for item in self.log[:k]:
                live[item["id"]] = item
            rows = [x for _, x in sorted(live.items()) if "deleted" not in x]
        elif k < self.oldest:
            return 410, {"error": "resyncRequired"}
        else:
            rows = self.log[k:]
            k = len(self.log) if at + 2 >= len(rows) else k
        more = at + 2 < len(rows)
        link = f"{self.root}/delta?token=" + (f"{kind}-{k}-{at + 2}" if more else f"since-{k}-0")
        return 200, {"value": rows[at : at + 2], ("@odata.nextLink" if more else "@odata.deltaLink"): link}

    def put(self, key, text, folder="/drive/root:/Docs", name=None):
        self.log.append({"id": key, "name": name or f"{key}.md", "size": len(text), "file": {}, "parentReference": {"path": folder}, "lastModifiedDateTime": f"2024-01-01T00:00:{len(self.log):02d}Z", "@microsoft.graph.downloadUrl": f"{self.root}/content?of={urllib.parse.quote(text)}"})

    def remove(self, key):
        self.log.append({"id": key, "deleted": {"state": "deleted"}})


@pytest.fixture
def service():
    d = Drive()
    yield d
    d.server.shutdown()


def test_drive_stream_pages_restarts_and_expires(spark, tmp_path, service):
    reg = RegistryTable(spark, str(tmp_path / "reg"))

    def start():
        feed = drive_delta_stream(spark, service.cfg, str(tmp_path / "cp")).withColumns({"tenant_id": F.lit("t"), "repo_id": F.lit("r")})
        apply_stream(feed, reg, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    def go():
        before = reg.version()
        start()
        return sorted((x.source_id, x.decision) for x in spark.read.parquet(str(tmp_path / "out")).where(F.col("batch") > before).collect()) if reg.version() > before else []

    status = lambda: {x.source_id: x.status for x in reg.read().collect()}
    for key in "abcde":
        service.put(key, f"text {key}")
    service.log.append({"id": "folder", "name": "Docs", "folder": {}, "parentReference": {"path": "/drive/root:"}})
    service.put("x", "elsewhere", "/drive/root:/Other%20place")
    service.put("m", "missing", "/drive/root:/Docs/in%20ner")
    assert go() == [(k, "new") for k in "abcdem"] and go() == []
    service.put("b", "changed")
    service.remove("c")
    service.put("f", "text f")
    service.remove("never seen")
    service.put("a", "text a")
    assert go() == [("a", "unchanged"), ("b", "changed"), ("c", "deleted"), ("f", "new")]
    # a batch that is stopped in its middle is listed again between the same links; what came meanwhile is left for the next one
    service.put("g", "text g")
    service.put("h", "text h")
    service.put("i", "text i")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(RegistryTable, "write", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division"):
            start()
    service.put("j", "text j")
    service.remove("g")
    first = reg.version()
    while go():
        pass
    rows = spark.read.parquet(str(tmp_path / "out")).where(F.col("batch") > first).collect()
    assert {(x.source_id, x.decision) for x in rows} >= {("h", "new"), ("i", "new"), ("j", "new")} and len({(x.batch, x.source_id) for x in rows}) == len(rows)
    assert status() == {k: "deleted" if k == "c" or k == "g" and ("g", "deleted") in {(x.source_id, x.decision) for x in rows} else "active" for k in status()} and {"h", "i", "j"} <= set(status())
    # the link expires: a full listing, and what it lacks is deleted
    service.remove("d")
    service.put("e", "new e")
    service.oldest = len(service.log)
    service.put("k", "text k")
    got = go()
    assert ("e", "changed") in got and ("k", "new") in got and ("a", "unchanged") in got and go() == []
    assert {k for k, v in status().items() if v == "active"} == {"a", "b", "e", "f", "h", "i", "j", "k", "m"}


def test_drive_feed_since_a_token(spark, service):
    for key in "abc":
        service.put(key, f"text {key}")
    rows, token = drive.items(spark, service.cfg)
    got = {x.id: x for x in rows.where("id is not null").collect()}
    assert set(got) == {"a", "b", "c"} and bytes(got["a"].content) == b"text a" and got["a"].path == "/Docs"
    service.put("b", "again")
    service.remove("a")
    rows, later = drive.items(spark, service.cfg, token)
    assert sorted((x.id, x.deleted) for x in rows.collect()) == [("a", True), ("b", False)] and json.loads(later)["listing"] == 1
    feed = {x.source_id: x for x in scan.scan(spark, "SharePoint", {**service.cfg, "token": token}).collect()}
    assert feed["a"].change == "deleted" and feed["b"].full_path == "/Docs/b.md" and feed["b"].mime_type == "text/markdown"


def test_blob_ids_below_odd_roots(spark, tmp_path):
    for root in ("docs/docs", "C++ (x", "a.b", "per%20cent"):
        folder = tmp_path / root / "docs"
        folder.mkdir(parents=True)
        (tmp_path / root / "a.md").write_text("x")
        (folder / "b.md").write_text("y")
        got = scan.scan(spark, "azure_blob", {"path": str(tmp_path / root), "container": "c"}).collect()
        assert {x.source_id for x in got} == {"azureblob:c:a.md", "azureblob:c:docs/b.md"} and {x.full_path for x in got} == {"/a.md", "/docs/b.md"}
