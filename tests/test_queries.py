"""Every registered query of the base package against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from tidemark.queries import QUERIES, SQL

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{D}/{f}')")
    return c


def norm(rows):
    return sorted(tuple(round(x, 5) if isinstance(x, float) and not math.isnan(x) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, D)
    names = sorted(got.columns)
    rows = got.select(names).collect()
    if name in SQL:
        assert norm(rows) == norm(db.sql(f"select {', '.join(names)} from ({SQL[name]})").fetchall())
    else:
        assert rows


def test_promotion_runs_over_a_store_of_all_documents(spark, monkeypatch):
    from tidemark import queries

    stored = []
    # the query's stores would be gone with its other intermediate files
    monkeypatch.setattr(queries, "contained", lambda spark, label, make: make())
    replace = queries.store.ChunkStore.replace
    monkeypatch.setattr(queries.store.ChunkStore, "replace", lambda self, rows, *a, **b: (stored.append(self), replace(self, rows, *a, **b))[1])
    queries.q30_promotion(spark, D).collect()
    docs = queries.documents(spark, D)
    mine = {x.doc_id for x in docs.where("tenant_id = 't1' and repo_id = 'src1'").collect()}
    assert {x.doc_id for x in stored[0].read().collect()} == {x.doc_id for x in docs.collect()} - mine
    assert {x.doc_id: x.text for x in stored[-1].read().collect()} == {x.doc_id: x.text for x in docs.collect() if x.doc_id in mine}


def test_queries_leave_nothing_but_what_their_results_read(spark):
    from pathlib import Path

    from tidemark.storage import shared_dir

    shared = Path(shared_dir(spark)) / "tidemark"
    for name in ("q25_bm25_topk", "q30_promotion", "q38_ingest_run"):
        before = set(shared.iterdir()) if shared.exists() else set()
        QUERIES[name](spark, D).collect()
        assert len(set(shared.iterdir()) - before) == 1
