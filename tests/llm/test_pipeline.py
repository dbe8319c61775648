import random

import corpus_pipeline
from tidemark.llm import decontaminate, mixing


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    r = random.Random(8)
    words = {"en": [f"wor{i}th" for i in range(900)], "de": [f"zü{i}ung" for i in range(900)]}
    prose = lambda lang, n: " ".join(r.choice(words[lang]) for _ in range(n))
    item = prose("en", 20)
    docs = [(i, prose(lang := ("en", "de")[i % 2], 120), lang, f"s{i % 4}") for i in range(60)]
    docs += [(100, docs[3][1], "de", "s0"), (101, docs[4][1].replace(docs[4][1].split()[7], "other", 1), "en", "s1"), (102, prose("en", 80) + " " + item + " " + prose("en", 60), "en", "s1"), (103, prose("en", 90) + " password=hunter2hunter2", "en", None), (104, "12 34", "en", "s2"), (105, None, None, None)]
    rows = spark.createDataFrame([(*d, len(d[1] or ""), "kept") for d in docs], "doc_id long, text string, lang string, source string, n_chars long, fingerprint string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, now = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/out/{n}")
        now = spark.read.parquet(f"{tmp_path}/out/{n}")
        seen[name] = {x.doc_id: x for x in now.collect()}
        if name != "source_mix":
            assert set(now.columns) == set(rows.columns)
    assert set(seen["language_id"]) == {d[0] for d in docs} - {104, 105}
    assert set(seen["near_dedup"]) == set(seen["language_id"]) - {100, 101}
    left = seen["decontamination"]
    a = decontaminate.build([("1", decontaminate.normal_words(item.encode()))])
    assert set(left) == set(seen["near_dedup"]) and all(decontaminate.match(a, decontaminate.normal_words(x.text.encode())) == ([], set()) for x in left.values())
    assert all(left[d[0]].text == d[1] for d in docs if d[0] < 100)
    assert "hunter2" in left[103].text and seen["secret_scan"][103].text.endswith(" [SECRET]") and seen["secret_scan"][103].n_chars == len(seen["secret_scan"][103].text)
    assert set(seen["source_mix"]) == set(left)
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, seen["source_mix"].values()))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert mixing.WEIGHTS == (5, 2, 1)
