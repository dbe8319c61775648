import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import retrieve, textindex, vectorindex
from tidemark.operators.textindex import TextIndex
from tidemark.operators.vectorindex import VectorIndex


def test_text_index_follows_its_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK", 8)
    monkeypatch.setattr(textindex, "GATHERED", 300)
    r = random.Random(1)
    words = [f"w{i}" for i in range(30)] + ["Straße", "ÉTÉ", "日本"]
    text = lambda: " ".join(r.choices(words, [1 / (i + 1) for i in range(len(words))], k=r.randint(0, 40)))
    docs = {f"d{i}": text() for i in range(120)} | {"none": None, "rare": "unheard w0 été"}
    frame = lambda some: spark.createDataFrame([(k, t, 1) for k, t in some.items()], "id string, body string, n int")
    index = TextIndex(spark, str(tmp_path / "i"), buckets=4)
    assert index.topk("w1", 3).count() == 0

    def same():
        rows = frame(docs)
        for q in ("w0 w1 w20", "straße", "unheard w3", "日本 nothing", "nothing", "", "w0"):
            got = [(x.key, round(x.score, 9)) for x in index.topk(q, 7).collect()]
            want = [(x.id, round(x.score, 9)) for x in retrieve.bm25(rows, q, 7, "id", "body").collect()] if q else []
            assert [s for _, s in got] == [s for _, s in want] and {x for x in got if x[1] > (want[-1][1] if want else 0)} == {x for x in want if x[1] > want[-1][1]}

    index.put(frame(docs), "id", "body")
    same()
    changed = {f"d{i}": text() for i in range(0, 120, 7)} | {"new": "w20 w20 w3", "rare": "w1"}
    docs |= changed
    del docs["d1"], docs["none"]
    index.put(frame(changed), "id", "body", gone=frame({"d1": None, "none": None, "unknown": None}))
    same()
    docs |= {"d1": "w20 back again", "new": None}
    index.put(frame({"d1": docs["d1"], "new": None}), "id", "body")
    same()
    assert {x.key for x in index.live().collect()} == set(docs)
    plan = index.lists(["w20", "w3"], index._log())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0] and "In(term" in plan


def test_blocks_that_cannot_reach_the_best_are_not_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK", 10)
    rows = spark.createDataFrame([(str(i), "apple " * (5 if i < 10 else 1) + "filler " * (1 if i < 10 else 20 + i)) for i in range(200)], "id string, body string")
    index = TextIndex(spark, str(tmp_path / "i"), buckets=2)
    index.put(rows.coalesce(1), "id", "body")
    scored = []
    real = TextIndex.lists
    monkeypatch.setattr(TextIndex, "lists", lambda self, terms, log: scored.append(real(self, terms, log)) or scored[-1])
    got = index.topk("apple", 5).collect()
    assert [x.key for x in got] == ["0", "1", "2", "3", "4"]
    blocks = scored[0].select("block", "most").distinct().collect()
    assert len(blocks) == 20 and sum(x.most == 5 for x in blocks) == 1


def clustered(n, dimensions, groups, seed=3):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(groups, dimensions))
    return centers[r.integers(groups, size=n)] + 0.6 * r.normal(size=(n, dimensions))


def test_vector_index_recall_and_exactness(spark, tmp_path):
    vectors = clustered(3000, 16, 20)
    rows = [(i, [float(x) for x in v], "a" if i % 3 else "b") for i, v in enumerate(vectors)]
    rows += [(9000, None, "a"), (9001, [0.0] * 16, "a"), (9002, rows[5][1], "a"), (9003, rows[5][1], "b")]
    docs = spark.createDataFrame(rows, "id long, embedding array<double>, repo string")
    index = VectorIndex(spark, str(tmp_path / "v"))
    index.build(docs, sample=500)
    data = spark.read.parquet(str(tmp_path / "v" / "data"))
    assert data.count() == len(rows) and {x.id for x in data.where("_cell = -1").collect()} == {9000, 9001}
    hits, read = 0, []
    for q in (7, 100, 555, 1234, 2999):
        query = [float(x) for x in vectors[q] + 0.1]
        want = [(x.id, round(x.score, 9)) for x in retrieve.vector_topk(docs, query, 10, "id", by=None).collect()]
        assert [(x.id, round(x.score, 9)) for x in index.topk(query, 10, "id", exact=True).collect()] == want
        hits += len({x.id for x in index.topk(query, 10, "id").collect()} & {i for i, _ in want})
        floor = want[-1][1]
        read.append(sum(n for bound, _, n in index.bounds(query) if bound >= floor) / len(rows))
    assert hits >= 45 and min(read) < 0.8
    mine = index.topk([float(x) for x in vectors[5]], 3, "id", exact=True, where=F.col("repo") == "b").collect()
    assert mine[0].id in (5, 9003) and {x.repo for x in mine} == {"b"}
    plan = index.topk([1.0] * 16, 5, "id", share=0.01)._jdf.queryExecution().executedPlan().toString()
    assert "_cell" in plan.split("PartitionFilters")[1].split("]")[0]
    index.build(docs.where("id < 50"))
    assert {x.id for x in index.topk([1.0] * 16, 100, "id", exact=True).collect()} == set(range(50))


def test_vector_index_of_nothing(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path / "v"))
    index.build(spark.createDataFrame([], "id long, embedding array<float>"))
    assert index.topk([1.0, 2.0], 3, "id", exact=True).count() == 0
    index.build(spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "id long, embedding array<float>"))
    assert [(x.id, x.score) for x in index.topk([1.0, 2.0], 3, "id", exact=True).collect()] == [(1, 0.0), (2, 0.0)]


def test_centroids_are_units():
    c = vectorindex.centroids_of(np.eye(5), 9)
    assert len(c) == 5 and np.linalg.norm(c, axis=1) == pytest.approx(1)


def test_lists_are_made_in_columns(monkeypatch):
    """Equal to lists by term and block made one by one, in a few times the time that counting takes."""
    import time
    from collections import Counter

    import pyarrow as pa

    monkeypatch.setattr(textindex, "BLOCK", 64)
    r = random.Random(3)
    words = [f"word{i}" for i in range(5000)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 500))) for _ in range(2000)] + [None, "", "--"]
    batch = pa.RecordBatch.from_pydict({"key": [f"k{i}" for i in range(len(texts))], "text": texts})
    began = time.process_time()
    counts = {f"k{i}": Counter(textindex.terms_of(t)) for i, t in enumerate(texts)}
    counted = time.process_time() - began
    began = time.process_time()
    made = list(textindex._blocks()([batch]))
    took = time.process_time() - began
    rows = [x for part in made for x in part.to_pylist()]
    order = sorted(counts, key=lambda k: (counts[k].total(), k))
    want = {}
    for at, key in enumerate(order):
        for term, n in counts[key].items():
            want.setdefault((at // 64, term), []).append((key, n, counts[key].total()))
    lists = [x for x in rows if x["term"] is not None]
    got = {(order.index(x["keys"][0]) // 64, x["term"]): list(zip(x["keys"], x["counts"], x["lengths"], strict=True)) for x in lists}
    assert got == want and len(lists) == len(want) and len({x["block"] for x in lists}) == len({b for b, _ in want})
    assert all(x["most"] == max(x["counts"]) and x["least"] == min(x["lengths"]) for x in lists)
    assert {x["block"]: (sorted(x["keys"]), x["lengths"]) for x in rows if x["term"] is None} == {k: (sorted(c), [c.total()]) for k, c in counts.items()}
    assert took < 6 * counted
