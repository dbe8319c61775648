import math
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import common, dealing, graph, simhash
from tidemark.storage import materialize


def slow_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_classes(prints, radius):
    root = list(range(len(prints)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def corpus(r, n=120):
    words = [f"w{i}é" for i in range(400)]
    texts = []
    for i in range(n):
        if i % 4 and texts:
            base = r.choice(texts).split(" ")
            for _ in range(r.randint(0, 2)):
                base[r.randrange(len(base))] = r.choice(words)
            texts.append(" ".join(base))
        else:
            texts.append(" ".join(r.choice(words) for _ in range(r.choice([1, 2, 3, 40, 300]))))
    return texts


def test_fingerprints_match_the_definition(monkeypatch):
    r = random.Random(1)
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "É é a\x0bb\x85c d", *corpus(r, 30)]
    for t in texts:
        assert simhash.simhash(t.encode() if t is not None else None) & (2**64 - 1) == slow_simhash(t), t
    long = " ".join(str(i % 977) for i in range(150_000))
    monkeypatch.setattr(simhash, "word_blocks", lambda t, size=0: iter([t.split()[i : i + 7777] for i in range(0, 150_000, 7777)]))
    parts = simhash.simhash(long.encode())
    monkeypatch.undo()
    assert parts == simhash.simhash(long.encode())


def test_classes_equal_brute_force(spark):
    texts = [*corpus(random.Random(2)), None, "", " "]
    docs = spark.createDataFrame([(i * 3, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, component_id int")
    got = {x.doc_id: x for x in simhash.near_duplicates(docs).collect()}
    assert len(got) == len(texts)
    want = slow_classes([slow_simhash(t) for t in texts], 3)
    assert [got[i * 3].component_id for i in range(len(texts))] == [w * 3 for w in want]


@pytest.mark.parametrize("limit", [2, 5, 10_000])
def test_dense_cells_lose_no_link(spark, limit):
    r = np.random.default_rng(3)
    base = int(r.integers(0, 2**62))
    prints = {base ^ sum(1 << int(b) for b in r.choice(14, r.integers(0, 5), replace=False)) for _ in range(150)} | {int(x) for x in r.integers(0, 2**62, 50)}
    prints = sorted(prints)
    rows = spark.createDataFrame([(p,) for p in prints], "fp long")
    stars = {x.node: x.root for x in graph.components(simhash.links(rows, 3, limit)).collect()}
    want = [prints[i] for i in slow_classes(prints, 3)]
    assert [stars.get(p, p) for p in prints] == want


@pytest.mark.parametrize("groups", [6, 9, 12])
def test_groups_change_no_class(spark, groups):
    r = np.random.default_rng(5)
    base = [int(x) for x in r.integers(0, 2**62, 30)]
    prints = sorted({b ^ sum(1 << int(x) for x in r.choice(64, r.integers(0, 4), replace=False) if x < 63) for b in base for _ in range(6)})
    stars = {x.node: x.root for x in graph.components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), groups=groups)).collect()}
    assert [stars.get(p, p) for p in prints] == [prints[i] for i in slow_classes(prints, 3)]
    assert [simhash.groups_for(n, 3) for n in (0, 10**7, 10**10, 10**13)] == [6, 6, 9, 12]


def test_grid_meets_every_pair_within_the_radius():
    r = np.random.default_rng(4)
    for groups, axes in ((6, 32), (9, 32), (12, 32), (6, 64), (12, 64)):
        masks = simhash.cell_masks(3, groups, axes)
        assert len(masks) == math.comb(groups, 3) and all(int(m).bit_count() >= 30 for m in masks)
        near = embedded = 0
        for _ in range(60):
            a = r.integers(0, 2**63, dtype=np.uint64)
            b = a ^ np.uint64(sum(1 << int(bit) for bit in r.choice(64, 3, replace=False)))
            x, y = simhash.embed(np.array([a, b])) if axes == 32 else (a, b)
            near += any((x & m) == (y & m) for m in masks)
            embedded += np.bitwise_count(x ^ y) <= 3
        assert near == embedded == 60


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (41, 40)] * 2
    got = {x.node: x.root for x in graph.components(spark.createDataFrame(pairs, "a long, b long"), limit=5).collect()}
    assert all(got[i] == 0 for i in range(42)) and all(got[100 + i] == 100 for i in range(60)) and len(got) == 102
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_written_steps_keep_small_plans(spark, monkeypatch):
    """The driver keeps every plan, described anew for each stage that ends: a round as one plan had 29 exchanges here."""
    seen = []

    def spied(df, label):
        seen.append((label, len(re.findall(r"\bExchange\b|ReusedExchange|BroadcastExchange", df._jdf.queryExecution().executedPlan().toString()))))
        return materialize(df, label)

    for module in (graph, simhash, dealing):
        monkeypatch.setattr(module, "materialize", spied)
    r = random.Random(3)
    texts = corpus(r, 200)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {x.doc_id for x in simhash.keep_one(docs).collect()} <= set(range(200))
    assert {x.component_id for x in simhash.near_duplicates(docs).collect()} <= set(range(200))
    assert sum(label == "edges" for label, _ in seen) >= 6 and max(n for _, n in seen) <= 12, seen


def test_null_keys_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "same text here"), (5, "same text here"), (5, "same text here"), (9, "same text here"), (2, "quite another story told")], "doc_id long, text string")
    got = sorted((x.doc_id is None, x.doc_id, x.component_id) for x in simhash.near_duplicates(docs).collect())
    assert got == [(False, 2, 2), (False, 5, 5), (False, 5, 5), (False, 9, 5), (True, None, 5)]
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    kept = simhash.keep_one(docs.withColumn("k", F.lit(1)))
    assert sorted((x.doc_id or -1, x.text) for x in kept.collect()) == [(-1, "same text here"), (2, "quite another story told"), (5, "same text here")]
    assert kept.columns == ["doc_id", "text", "k"]
    assert simhash.keep_one(docs.where("false")).count() == 0


def test_similar_documents_meet_and_others_stay(spark):
    r = random.Random(6)
    words = [f"t{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(25):
        base = [r.choice(words) for _ in range(200)]
        copy = list(base)
        for _ in range(3):
            copy[r.randrange(200)] = r.choice(words)
        far = base[:100] + [r.choice(words) for _ in range(100)]
        for text in (base, copy, far):
            rows.append((n, " ".join(text)))
            n += 1
    rows.append((n, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {x.doc_id for x in simhash.keep_one(docs).collect()}
    assert left == {i for i in range(n + 1) if i % 3 != 1 or i == n}


def test_wide_prints_do_not_depend_on_blocks(monkeypatch):
    text = (" ".join(str(i * i % 7919) for i in range(5000))).encode()
    whole = simhash.wide_prints(text)
    monkeypatch.setattr(simhash, "word_blocks", lambda t, size=0: iter([t.split()[i : i + 3] for i in range(0, 5000, 3)]))
    assert simhash.wide_prints(text) == whole
    monkeypatch.undo()
    assert simhash.wide_prints(b"") == simhash.wide_prints(None) == (bytes(64), bytes(64))
    assert simhash.wide_prints(b"one two") == simhash.wide_prints(b"ONE  two\n") != simhash.wide_prints(b"one")


def test_hot_and_other_keys_are_all_named(spark, monkeypatch):
    rows = [(i, 7) for i in range(300)] + [(1000 + i, 100 + i // 2) for i in range(300)]
    marked = spark.createDataFrame(rows, "k long, fp long")
    classes = marked.groupBy("fp").agg(F.min("k").alias("component_id"), F.count("*").alias("n"))
    for hot in (1, 10, 1000):
        monkeypatch.setattr(common, "HOT_KEYS", hot)
        got = {x.k: x.component_id for x in common.attach(marked, classes, "fp").collect()}
        assert got == {k: 0 if f == 7 else 1000 + 2 * (f - 100) for k, f in rows}
    assert common.attach(marked.where("false"), classes.where("false"), "fp").count() == 0


def alike(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def contiguous(r, words, n):
    """A text and a copy with one passage swapped, cut or appended, 0.8 to 0.85 alike; sizes of ``n`` words."""
    while True:
        base = [r.choice(words) for _ in range(n)]
        k, at = r.randint(1, max(1, n // 5)), r.randrange(n)
        fresh = [r.choice(words) for _ in range(k)]
        copy = r.choice([base[:at] + fresh + base[at + k :], base[:at] + base[at + k :], base + fresh])
        texts = " ".join(base), " ".join(copy)
        if 0.8 <= alike(*texts) <= 0.85:
            return texts


def test_pairs_with_one_edited_passage_are_not_lost(spark):
    r = random.Random(11)
    words = [f"t{i}" for i in range(5000)]
    texts = [t for i in range(240) for t in contiguous(r, words, (30, 60, 400, 1500)[i % 4])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.similar_classes(docs).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_fingerprints_within_three_bits_meet_without_the_wide_search(spark, monkeypatch):
    r = random.Random(21)
    words = [f"t{i}" for i in range(5000)]
    texts, line = [], " ".join(r.choice(words) for _ in range(13))
    for _ in range(30):
        base = [r.choice(words) for _ in range(300)]
        texts += [" ".join(base), " ".join([*base, r.choice(words)])]
    # alike in fingerprints, not in sets
    texts += [f"{(line + ' ') * 200}{' '.join(r.choice(words) for _ in range(20))}" for _ in range(2)]
    prints = [simhash.simhash(t.encode()) for t in texts]
    bits = [((prints[i] ^ prints[i + 1]) & (2**64 - 1)).bit_count() for i in range(0, len(texts), 2)]
    near = [b <= 3 for b in bits]
    assert near[30] and sum(near[:30]) >= 20 and alike(*texts[60:]) < 0.8
    monkeypatch.setattr(simhash, "wide_links", lambda cells, *_: cells.select("node", "node").toDF("a", "b").where("false"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in simhash.similar_classes(docs).collect()}
    assert got == {i: i - i % 2 if i < 60 and near[i // 2] else i for i in range(len(texts))}


def test_links_are_confirmed_on_the_shingle_sets(spark):
    r = random.Random(12)
    words = [f"t{i}" for i in range(5000)]
    texts, line = [], " ".join(r.choice(words) for _ in range(12))
    for _ in range(60):
        base = [r.choice(words) for _ in range(150)]
        k = r.randint(16, 24)
        texts += [" ".join(base), " ".join([r.choice(words) for _ in range(k)] + base[k:])]
    # different texts that share a line, repeated often
    texts += [f"{(line + ' ') * 30}{' '.join(r.choice(words) for _ in range(40))}" for _ in range(6)]
    want = list(range(len(texts)))
    for i in range(0, 120, 2):
        if alike(texts[i], texts[i + 1]) >= 0.8:
            want[i + 1] = i
    assert len(set(want)) > 100 and len(set(want)) < len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.doc_id: x.component_id for x in simhash.similar_classes(docs).collect()} == dict(enumerate(want))


def test_large_groups_are_dealt_without_losing_links(spark):
    r = random.Random(14)
    chain = [" ".join(f"t{k}" for k in range(i, i + 60)) for i in range(0, 90, 3)]
    base = [f"b{i}" for i in range(200)]
    copies = [" ".join([*base[:i], "new", *base[i + 1 :]]) for i in range(0, 200, 2)]
    # alone, in pairs, and one text that only a single copy is alike to
    rest = [" ".join(f"r{r.randrange(10**6)}" for _ in range(60)) for _ in range(20)]
    rest += [x + " end" for x in rest[:8]] + [" ".join([*copies[50].split()[:185], *(f"e{i}" for i in range(15))])]
    texts = [*chain, *copies, *rest]
    want, seen = list(range(len(texts))), [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(seen[i] & seen[j]) >= 4 * len(seen[i] | seen[j]) and want[i] != want[j]:
                old, new = max(want[i], want[j]), min(want[i], want[j])
                want = [new if x == old else x for x in want]
    assert want[29] == 0 and want[129] == 30 and len(set(want)) > 12
    named = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    rows = [(simhash._name(x), 1, i, len(x)) for i, t in enumerate(texts) if (x := simhash.shingle_set(t.encode())) is not None]
    groups, node = spark.createDataFrame(rows, "node long, root long, least long, size int"), {x[0]: x[2] for x in rows}
    for size in (1 << 24, 1 << 15, 1 << 12):
        got = {node[x.node]: x.root for x in graph.components(simhash.confirm(groups, named, size)).collect()}
        classes = {}
        for i in range(len(texts)):
            classes.setdefault(got.get(i, ("alone", i)), set()).add(i)
        assert sorted(map(sorted, classes.values())) == sorted([i for i in range(len(texts)) if want[i] == w] for w in set(want))


@pytest.mark.parametrize("limit", [4, 30])
def test_dense_cells_of_sketches_are_dealt_without_losing_links(spark, limit):
    r = np.random.default_rng(15)
    base = r.integers(0, 2**63, simhash.WIDE, dtype=np.uint64)
    prints = []
    for _ in range(90):
        x = base.copy()
        for bit in r.choice(512, int(r.choice([2, 5, 60])), replace=False):
            x[bit // 64] ^= np.uint64(1 << int(bit % 64))
        prints.append(x)
    cells = spark.createDataFrame([(7, i, bytearray(x.tobytes())) for i, x in enumerate(prints)], "cell long, node long, print binary")
    got = {x.node: x.root for x in graph.components(simhash.wide_links(cells, 9, limit)).collect()}
    want = slow_classes([int.from_bytes(x.tobytes(), "little") for x in prints], 9)
    assert [got.get(i, i) for i in range(90)] == want and 2 < len(set(want)) < 80


def template(r, n, shared=180, own=60):
    base = r.integers(0, 2**63, shared, dtype=np.uint64)
    return [np.unique(np.concatenate([base, r.integers(0, 2**63, own, dtype=np.uint64)])) for _ in range(n)]


def test_exact_links_equal_brute_force_over_all_pairs():
    r = np.random.default_rng(4)

    def classes(n, pairs):
        up = list(range(n))

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[max(root(a), root(b))] = min(root(a), root(b))
        return [root(i) for i in range(n)]

    for _ in range(150):
        bases = [r.choice(40, size=r.integers(1, 40), replace=False) for _ in range(4)]
        sets = []
        for _ in range(24):
            x = bases[r.integers(4)]
            x = x[r.random(len(x)) >= r.choice([0, 0.05, 0.1, 0.2])]
            x = np.unique(np.concatenate([x, r.integers(0, 60, r.integers(0, 3))])).astype(np.uint64)
            sets += [x] if len(x) else []
        alike = lambda x, y: 5 * (both := len(np.intersect1d(x, y))) >= 4 * (len(x) + len(y) - both)
        every = [(i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j])]
        found = simhash.exact_forest(sets)
        assert classes(len(sets), found) == classes(len(sets), every) and all(alike(sets[a], sets[b]) for a, b in found)
    assert simhash.exact_forest([np.zeros(0, np.uint64)]) == []


def test_templates_below_the_threshold_cost_their_own_size():
    """20,000 sets of 0.6 similarity in one group: all pairs would be 2e8 comparisons."""
    r = np.random.default_rng(5)
    sets = template(r, 20_000) + template(r, 2, 228, 12)
    began = time.perf_counter()
    found = simhash.exact_forest(sets)
    assert found == [(20_000, 20_001)] and time.perf_counter() - began < 30


def test_documents_of_one_template_stay(spark):
    r = random.Random(6)
    base = [f"t{i}" for i in range(180)]
    rows = [(i, " ".join([*(f"d{i}w{j}" for j in range(60)), *base])) for i in range(3000)]
    rows += [(5000, rows[7][1] + " more"), (5001, rows[8][1].replace("t90", "other"))]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in simhash.keep_one(docs).collect()} == set(range(3000))
