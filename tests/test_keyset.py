import http.server
import json
import re
import threading
import urllib.parse

import pytest

from tidemark.sources import scan


class Table:
    """A service that sorts and filters by key, to which records are added between pages."""

    def __init__(self, keys, counted=True):
        self.rows, self.counted, self.pages = {k: {"sys_id": k, "kind": "x"} for k in keys}, counted, 0
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                asked = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
                status, body = 200, outer.answer(asked)
                self.send_response(status)
                if outer.counted:
                    self.send_header("X-Total-Count", str(len(outer.rows)))
                self.end_headers()
                self.wfile.write(json.dumps({"result": body}).encode())

            def log_message(self, *a):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.lock = threading.Lock()

    def answer(self, asked):
        with self.lock:
            rows = list(self.rows.values())
            for part in asked.get("sysparm_query", "").split("^"):
                if m := re.fullmatch(r"sys_id>(.*)", part):
                    rows = [r for r in rows if r["sys_id"] > m[1]]
                    self.pages += 1
                    # what comes and goes meanwhile lies before what is read next
                    self.rows[f"!{self.pages}"] = {"sys_id": f"!{self.pages}", "kind": "late"}
                elif m := re.fullmatch(r"sys_id<=(.*)", part):
                    rows = [r for r in rows if r["sys_id"] <= m[1]]
                elif part == "ORDERBYsys_id":
                    rows.sort(key=lambda r: r["sys_id"])
            at = int(asked["sysparm_offset"])
            return rows[at : at + int(asked["sysparm_limit"])]


@pytest.mark.parametrize("counted", [True, False])
def test_pages_by_key_lose_and_double_nothing(spark, counted):
    keys = [f"aaa{i:04d}" for i in range(90)] + ["b", "bé", "z'1"]
    service = Table(keys, counted)
    cfg = {"url": f"http://127.0.0.1:{service.server.server_port}/t", "table": "t", "page_size": 7, "keyset": True, "ranges": 5}
    try:
        rows = scan.scan(spark, "servicenow", cfg)
        got = [x.source_id.removeprefix("t/") for x in rows.collect()]
        assert sorted(k for k in got if not k.startswith("!")) == sorted(keys) and len(got) == len(set(got)) and service.pages > 10
        assert rows.rdd.getNumPartitions() == (5 if counted else 1)
    finally:
        service.server.shutdown()


@pytest.mark.parametrize("column, parts", [("NAME", 4), ("N", 3), ("MOMENT", 4)])
def test_ranges_of_skewed_and_string_keys(spark, column, parts):
    url = f"jdbc:derby:memory:keyset{column};create=true"
    rows = [(f"k'{i:03d}" if i % 10 else f"zz{i}", 10 ** (i // 20) + i, f"2024-01-{i % 28 + 1:02d} 00:00:00") for i in range(100)]
    table = spark.createDataFrame(rows, "NAME string, N long, MOMENT string").selectExpr("NAME", "N", "cast(MOMENT as timestamp) AS MOMENT")
    table.write.option("createTableColumnTypes", "NAME VARCHAR(40)").jdbc(url, "ITEMS", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    cfg = {"table": "ITEMS", "primary_key": "NAME", "partition_column": column, "partitions": parts, "jdbc": {"url": url, "driver": "org.apache.derby.jdbc.EmbeddedDriver"}}
    got = scan.scan(spark, "sql", cfg)
    assert sorted(x.source_id for x in got.collect()) == sorted(f"ITEMS/{n}" for n, _, _ in rows)
    sizes = got.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
    assert len(sizes) == parts and max(sizes) <= 2 * 100 / parts
