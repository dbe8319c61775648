import base64
import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import audit, impact, warc

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def slow_search(docs, items, k):
    held = [(key, Counter(t), len(t)) for key, text in docs if (t := terms_of(text))]
    n, length = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c, size in held:
            m = 100 - 25 + 25 * size * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms_of(text) if t in c)
            if s > 0:
                scores.append((-s, key is None, key or 0, key))
        out += [(item, r, key, -s) for r, (s, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(str, out))


def found(spark, docs, items, k, **sizes):
    rows = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, score string")
    asked = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, rank int")
    return sorted(str((x.item, x.rank, x.doc, x.score)) for x in impact.search(rows.repartition(3), asked, k, **sizes).collect())


def test_search_against_brute_force(spark):
    r = random.Random(11)
    words = [f"w{i}" for i in range(40)] + ["Straße", "É", "ünd", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(r.choices(words, weights, k=n)).replace(" ", r.choice([" ", ",", "\n", "_"]), 3)
    docs = [(i, text(r.randint(1, 60))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(30)] + [(3, docs[3][1])] * 2 + [(None, docs[3][1]), (300, None), (301, ""), (302, "., !"), (303, "w1 " * 3000)]
    items = [(i, text(r.randint(1, 12))) for i in range(12)] + [(1, docs[3][1]), (1, docs[3][1]), (None, "w0 w1"), (50, None), (51, "?"), (52, "never heard"), (53, "W1 w1 w1 É")]
    for k in (1, 5, 20):
        assert found(spark, docs, items, k) == slow_search(docs, items, k)
    assert found(spark, docs, items, 7, postings=30, batch_terms=9) == slow_search(docs, items, 7)
    assert found(spark, [], items, 3) == found(spark, docs, [], 3) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), min_size=6, max_size=6), min_size=1, max_size=40), st.lists(st.integers(1, 5), min_size=6, max_size=6), st.integers(1, 6), st.integers(1, 60))
def test_levels_find_what_all_scores_find(impacts, weight, k, floor):
    """A block by hand: every document has some of six terms."""
    held = [[(t, x) for t, x in enumerate(row) if x > 3] or [(0, row[0])] for row in impacts]
    of, impact_of, doc = (np.array(x) for x in zip(*[(t, x, d) for d, row in enumerate(held) for t, x in row], strict=True))
    by = np.lexsort((doc, -impact_of, of))
    term_list = np.unique(of)
    groups = [(t, x) for t in term_list for x in sorted(set(impact_of[of == t]), reverse=True)]
    packed = [np.cumsum([len(x) for x in held]), of, impact_of, term_list, np.cumsum([sum(g[0] == t for g in groups) for t in term_list]), [g[1] for g in groups], np.cumsum([((of == t) & (impact_of == x)).sum() for t, x in groups]), doc[by]]
    block = impact._Block([np.array(x, np.uint32).tobytes() for x in packed], 6)
    docs, scores = block.best(np.arange(6), np.array(weight), k, floor)
    every = sorted(((sum(x * weight[t] for t, x in row), -d) for d, row in enumerate(held)), reverse=True)
    assert [(s, -d) for s, d in zip(scores.tolist(), docs.tolist(), strict=True)] == [x for x in every[:k] if x[0] >= floor]


def test_bound_of_a_block_ends_the_next_ones(spark):
    """The bound of the first block ends the others at their best groups."""
    rows = spark.createDataFrame([(i, "rare rare rare" if i == 0 else "common filler") for i in range(200)], "doc_id long, text string")
    batch = next(impact.batches(spark.createDataFrame([(0, "rare common")], "q long, text string"), "text"))
    index = impact.index(rows.coalesce(1), batch, postings=40)
    assert index.blocks.count() == 5 and [int(x > 0) for x in index.weights] == [1, 1]
    assert {x.k for x in impact.best_of(index, 1).collect()} == {0}


def test_long_texts_count_in_pieces():
    text = ("Ab1 é_x " * 700_000).encode()
    assert impact.term_counts(text) == {b"ab1": 700_000, "é".encode(): 700_000, b"x": 700_000}


def slow_audit(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    rows = []
    for d, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t]}
        rows.append((source or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out, total = [], Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {x[0] for x in rows}:
            left = [x for x in rows if x[0] == part]
            for step, f in enumerate(order, 1):
                own = [x for x in rows if x[0] == part and f in x[1]]
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[part, f] += len(gone)
                out.append([part, order, step, len(left), len(gone), len(own) - len(gone), sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)])
    return sorted(str((*x, total[x[0], x[1][x[2] - 1]])) for x in out)


def test_audit_against_brute_force(spark):
    r = random.Random(12)
    texts = [" ".join(r.choice(["alpha", "Beta", "GAMMA", "x|y", "é", "delta"] + [f"v{i}" for i in range(90)]) for _ in range(n)) for n in (3, 49, 50, 51, 80, 200)]
    texts += ["word " * 60, "a b\x0bc\x1cd " * 30, "%", "A" * 5 + "b" * 95, "A" * 6 + "b" * 94, None, ""]
    docs = [(i, r.choice(texts), r.choice(["s0", "s0", "s1", None, ""])) for i in range(120)]
    docs += [docs[5]] * 3 + [(None, docs[5][1], "s1"), (None, None, "s2"), (7, docs[5][1], "s0")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1)]
    rows = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, source string, mask int")
    marks = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, source string")
    got = audit.audit(rows.repartition(3), marks)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == names and sorted(str(tuple(x)) for x in got.collect()) == slow_audit(docs, labels)
    assert audit.audit(rows.where("false"), marks).count() == 0 and audit.audit(rows, marks.where("false")).agg(F.sum("good_lost")).first()[0] == 0


def test_different_words_of_long_texts():
    text = " ".join(f"w{i % 5000}" for i in range(40_000)).encode()
    assert audit.different(text, 1 << 12) == audit.different(text) == (40_000, 5000) and audit.different(b"") == (0, 0)
    m = audit.outcomes()
    assert m.kept.shape == (32, 600) and ((m.kept + m.removed).sum(axis=0) > 0).all() and (m.removed[:, m.letter == 0].sum(axis=1) == [0 if not x & 1 else sum(o.index(0) < min([o.index(f) for f in range(5) if x >> f & 1 and f], default=9) for o in permutations(range(5))) for x in range(32)]).all()


PAGES = [(1, "http://a/%41", "<p>é</p>"), (2, None, None), (3, "http://a/\r\nX: y", ""), (4, "", "<p>é</p>"), (0, "http://z", "<p>é</p>"), (7, "u", "one\r\n\r\nWARC/1.1\r\n"), (7, "u", "one\r\n\r\nWARC/1.1\r\n"), (7, "t", "one\r\n\r\nWARC/1.1\r\n"), (None, "n", "only null"), (None, None, "one\r\n\r\nWARC/1.1\r\n"), (9, "c", "tiny"), (8, "c", "tiny")]


def test_archive_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string")
    warc.write(pages.repartition(3), str(tmp_path / "a"))
    back = warc.read(spark, str(tmp_path / "a"))
    got = back.withColumn("record", warc.serialized(back)).collect()
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == 5 and all(x.verified for x in got)
    clean = lambda u: None if u is None else u.replace("\r", "%0D").replace("\n", "%0A")
    assert sorted(str((x.key, x.url, bytes(x.payload).decode())) for x in got) == sorted(str((k, clean(u), t or "")) for k, u, t in PAGES)
    for x in got:
        head, http, rest = bytes(x.record).split(b"\r\n\r\n", 2)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest.endswith(b"\r\n\r\n") and bytes(x.record) == bytes(x.header) + (bytes(x.payload) if x.record_type == "response" else b"") + b"\r\n\r\n"
        assert int(fields["Content-Length"]) == len(bytes(x.record)) - len(head) - 8
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(bytes(x.payload)).digest()).decode()
        assert f"Content-Length: {len(x.payload)}".encode() in http and ("WARC-Refers-To" in fields) == (x.record_type == "revisit")
    types = Counter((x.key, x.record_type, x.refers_to) for x in got)
    assert types == Counter([(0, "response", None), (1, "revisit", 0), (4, "revisit", 0), (2, "response", None), (3, "revisit", 2), (7, "response", None), (7, "revisit", 7), (7, "revisit", 7), (None, "response", None), (None, "revisit", 7), (8, "response", None), (9, "revisit", 8)])
    again = warc.round_trip(pages, least_bytes=5)
    assert {x.record_type for x in again.where("payload_bytes < 5").collect()} == {"response"} and again.where("record_type = 'revisit'").count() == 5
    assert warc.round_trip(pages.where("false")).count() == 0


def test_archive_hot_payload_and_damage(spark, tmp_path):
    rows = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.concat(F.lit("p"), "id")).alias("html"))
    got = warc.round_trip(rows)
    assert got.where("record_type = 'revisit' and refers_to = 1").count() == 1999 and got.count() == 3000
    assert not [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Python" in x or "Arrow" in x]
    warc.write(rows.limit(3).coalesce(1), str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a" / "payloads")).collect()
    spark.createDataFrame([(x.digest, bytes(x.payload) + b"!") for x in stored[:1]] + [(x.digest, bytes(x.payload)) for x in stored[1:]], "digest string, payload binary").write.parquet(str(tmp_path / "b" / "payloads"))
    spark.read.parquet(str(tmp_path / "a" / "records")).write.parquet(str(tmp_path / "b" / "records"))
    assert {x.verified for x in warc.read(spark, str(tmp_path / "b")).collect()} == {True, False}


def test_base32(spark):
    for text in ("", "a", "é" * 99):
        digest = hashlib.sha1(text.encode())
        assert spark.range(1).select(warc.base32(F.lit(digest.hexdigest()))).first()[0] == base64.b32encode(digest.digest()).decode()
    with pytest.raises(Exception, match="digest"):
        spark.range(1).select(F.raise_error(F.lit("a payload's digest"))).collect()
