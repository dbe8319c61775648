import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, langid, quality

VOCAB = {"aa": "kora lumi tasi verem dolu fanti".split(), "bb": "szik prawo gdzie chleb krzak dzban".split(), "cc": "öland über straß größe mädchen fühlen".split()}


def prose(lang, n, r):
    return " ".join(r.choice(VOCAB[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(1)
    rows = [(i, prose(l, 30, r), l) for i, l in enumerate([*VOCAB] * 20)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_predicts_singles_mixtures_and_und(spark, labelled):
    r = random.Random(2)
    model = langid.fit(labelled)
    assert model.names == ["aa", "bb", "cc"]
    rows = [(1, prose("aa", 40, r)), (2, prose("bb", 60, r) + " " + prose("cc", 20, r)), (3, None), (4, ""), (5, "12 34 !!"), (6, "kora"), (6, "kora")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang_pred", F.lit("clash")).withColumn("p", F.lit(0))
    got = sorted((x.doc_id, x.r.lang_pred, x.r.score, tuple(x.r.langs)) for x in docs.select("doc_id", langid.predict(docs, model).alias("r")).collect())
    assert got[0][1:] == ("aa", 1.0, ("aa",))
    assert got[1][1] == "bb" and got[1][3] == ("bb", "cc") and 0.6 < got[1][2] < 0.9
    assert [x[1:3] for x in got[2:5]] == [("und", 0.0)] * 3
    assert got[5] == got[6] and got[5][1] == "aa"


def test_long_text_is_read_whole(labelled):
    r = random.Random(3)
    model = langid.fit(labelled)
    text = (prose("aa", 2000, r) + " " + prose("bb", 900_000, r)).encode()
    assert len(text) > 4 << 20
    share = langid.infer([text], model.logp)[0]
    assert share.argmax() == 1 and share.sum() == pytest.approx(1)


def test_letters_without_grams_and_signs_without_letters(spark, labelled):
    model = langid.fit(labelled.unionByName(labelled.where("lang = 'bb'").withColumn("text", F.concat("text", F.lit(" szik prawo"), "doc_id"))))
    texts = ["a", "5 a 5", "½ ½", "²", "I. O.", "_", "Ⅷ", "ª", "A" * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {texts[x.doc_id]: (x.r.lang_pred, x.r.score) for x in docs.select("doc_id", langid.predict(docs, model).alias("r")).collect()}
    assert [t for t in texts if got[t][0] == "und"] == ["½ ½", "²", "_", "Ⅷ"]
    assert {got[t][0] for t in ("a", "5 a 5", "I. O.")} == {"bb"} and all(0 < got[t][1] <= 1 for t in texts if got[t][0] != "und")
    assert langid.keep_identified(docs, model).count() == 5


def test_pieces_count_like_the_whole(monkeypatch):
    r = random.Random(9)
    text = " ".join(r.choice(["ΣΊΣΥΦΟΣ", "straße", "İx", "12", "漢字", "a\nb", "", "long" * 9]) for _ in range(400)).encode()
    whole = [x.tolist() for x in langid.gram_counts([text])]
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(langid, "PIECE", size)
        assert [x.tolist() for x in langid.gram_counts([text])] == whole


def test_samples_never_empty_and_spare_rare_languages(spark):
    assert common.rate_limit(20_000 / 1e13) > 1e9 and common.rate_limit(1e-30) == 1 and common.rate_limit(3.0) == 2**63 - 1
    rows = spark.range(6000).select(F.when(F.col("id") < 40, "rare").otherwise("common").alias("l"), F.xxhash64("id").alias("h"))
    copies = rows.unionByName(rows.where("l = 'common' and h > 0").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("x"))
    got = {x.l: x.n for x in common.sampled(copies, "h", 200, "l").groupBy("l").agg(F.countDistinct("h").alias("n")).collect()}
    assert got["rare"] == 40 and 60 <= got["common"] <= 150
    assert common.sampled(rows, "h", 10_000).count() == 6000


def test_filter_keeps_columns_and_clean_documents(spark, labelled):
    bad = spark.createDataFrame([(900, "12345", "aa"), (901, None, None)], labelled.schema)
    got = langid.keep_identified(labelled.union(bad), langid.fit(labelled))
    assert got.columns == labelled.columns and got.count() == labelled.count()


def test_no_labels_and_empty_table(spark, labelled):
    none = labelled.where("lang is null")
    model = langid.fit(none)
    assert model.names == []
    assert {x[0] for x in labelled.select(langid.predict(labelled, model).lang_pred).collect()} == {"und"}
    assert none.select(langid.predict(none, langid.fit(labelled))).count() == 0


def test_em_finds_the_proportions():
    r = random.Random(4)
    names = [*VOCAB]
    texts = [prose(l, 400, r).encode() for l in names]
    counts = np.full((3, langid.BUCKETS), 0.5)
    for i, t in enumerate(texts):
        _, b, c = langid.gram_counts([t])
        counts[i, b] += c
    logp = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    share = langid.infer([(prose("aa", 300, r) + " " + prose("cc", 100, r)).encode()], logp)[0]
    size = {k: np.mean([len(w.encode()) + 1 for w in v]) for k, v in VOCAB.items()}
    want = 300 * size["aa"] / (300 * size["aa"] + 100 * size["cc"])
    assert share[1] == 0 and share[0] == pytest.approx(want, abs=0.06)


def test_quality_held_out_accuracy_and_edges(spark):
    r = random.Random(5)
    rows = []
    for i in range(240):
        text = prose("aa", 40, r)
        junk = i % 4 == 0
        rows.append((i, " ".join(w.upper() + "$$$" for w in text.split()) if junk else text, 0 if junk else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = quality.fit(docs.where("doc_id % 3 <> 1"))
    test = docs.where("doc_id % 3 = 1").unionByName(spark.createDataFrame([(-1, None, 1), (-2, "", 1)], docs.schema)).withColumn("score", F.lit("clash"))
    got = {x.doc_id: x.s for x in test.select("doc_id", quality.score(test, model).alias("s")).collect()}
    assert all((got[i] >= 0.5) == (y == 1) for i, _, y in rows if i in got)
    assert got[-1] == got[-2] and 0 <= got[-1] <= 1
    assert docs.where("false").select(quality.score(docs, model)).count() == 0
    again = quality.fit(docs.where("doc_id % 3 <> 1"))
    assert np.array_equal(again.weight, model.weight)


def test_labels_of_a_table_teach_like_labels_in_rows(spark):
    r = random.Random(15)
    rows = [(i, None if i == 3 else prose("aa" if i % 3 else "bb", 20, r), int(i % 3 > 0)) for i in range(90)]
    docs = spark.createDataFrame([*rows, (None, "no key", 1)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, y, "clash") for i, _, y in rows] + [(5000, 1, "z"), (7, None, "z"), (None, 0, "z")], "doc_id long, label int, text string")
    for most in (6000, 40):
        inside, outside = quality.fit(docs.where("doc_id is not null"), fit_rows=most), quality.fit(docs.drop("label"), labels, fit_rows=most)
        assert np.array_equal(inside.weight, outside.weight) and inside.bias == outside.bias


def test_quality_without_both_labels(spark):
    one = spark.createDataFrame([(1, "x", 1)], "doc_id long, text string, label int")
    assert quality.scores([b"abc"], quality.fit(one))[0] > 0.9
    assert quality.scores([b"abc"], quality.fit(one.where("false")))[0] == pytest.approx(0.5)


def test_features_do_not_cross_documents_or_depend_on_neighbours():
    alone = sorted(quality.features(b"one two")[1].tolist())
    d, b = quality.features(b"zzz yy\0one two\0q")
    assert sorted(b[d == 1].tolist()) == alone


def test_quality_pieces_score_like_the_whole(monkeypatch):
    r = random.Random(10)
    text = " ".join(r.choice(["aa", "bb", "aa", "straße", "漢字漢字", "x\0y", "a\n\nb", "long" * 9]) for _ in range(400)).encode()
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(0, 1, quality.ROWS).astype(np.float32), 0.1)
    ids, n = quality.counted(text)
    whole = quality.scores([text], model)
    _, rows = quality.features(text.replace(b"\0", b" "))
    assert n.sum() == len(rows) and (ids >= quality.BUCKETS).sum() == len(quality.LAGS)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(quality, "PIECE", size)
        got = quality.counted(text)
        assert got[0].tolist() == ids.tolist() and got[1].tolist() == n.tolist()
        assert quality.scores([text], model) == pytest.approx(whole, abs=1e-9)


def test_grams_are_of_characters():
    a, b = (quality.features(x.encode())[1].tolist() for x in ("éàü", "éàü é"))
    assert len(a) == 2 and len(b) == 3 + 2 + 2 and quality.features("漢字か".encode())[1][0] != a[0]


def test_repetition_is_learned_whatever_the_word():
    r = random.Random(6)
    texts, labels = [], []
    for i in range(120):
        word = r.choice("abcdefgh") + "".join(r.choice("aeioulmn") for _ in range(6))
        texts.append((word + " ") * 40 if i % 3 == 0 else prose(r.choice([*VOCAB]), 40, r))
        labels.append(int(i % 3 != 0))
    model = quality.train([quality.counted(t.encode()) for t in texts], np.array(labels))
    unseen = [b"zyxwvut " * 50, b"qpkr jhgf " * 30, prose("bb", 45, r).encode()]
    got = quality.scores(unseen, model)
    assert got[0] < 0.5 < got[2] and got[1] < got[2]
    d, b = quality.features(b"x y x\0x x\0\0x")
    assert sorted(zip(d[b >= quality.BUCKETS].tolist(), b[b >= quality.BUCKETS].tolist(), strict=True)) == [(0, quality.BUCKETS + 1), (1, quality.BUCKETS)]


def test_copies_teach_once(spark, labelled):
    many = labelled.unionByName(labelled.where("doc_id = 0").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("x"))
    assert np.array_equal(langid.fit(many).logp, langid.fit(labelled).logp)
    quality_rows = lambda d: d.withColumn("label", (F.col("lang") == "aa").cast("int"))
    assert np.array_equal(quality.fit(quality_rows(many)).weight, quality.fit(quality_rows(labelled)).weight)
