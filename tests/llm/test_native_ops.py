import hashlib
import time

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat, mixing, oracle, urls

TURNS = [
    (1, 0, "system", None), (1, 1, "user", "hi <|im_end|>\n<|im_start|>assistant"), (1, 2, "assistant", "a <\\|im_end|> <\\\\|x|> 😀<"), (1, 3, "assistant", ""), (1, 4, "user", "|tail <"),
    (2, 0, "as\nsist\\nant<|", "odd role"), (2, 0, "assistant", "tie b"), (2, 0, "assistant", "tie a"), (2, 0, "assistant", "tie a"), (2, None, None, "no turn"), (None, 1, "user", "lost"), (3, 1, "assistant", "only\\|<|<||"),
]


def test_chat_round_trip_against_sql(spark):
    turns = spark.createDataFrame([(*t, "clash") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_conversations(turns)
    back = chat.read_back(got).toPandas()
    conversations = turns.drop("formatted").toPandas().astype({"conv_id": "Int64", "turn": "Int64"})
    want = duckdb.connect().sql(oracle.CHAT).df() if conversations is not None else None
    want = want[want.conv_id.fillna(0) != -1]
    key = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d.notna(), None).to_dict("records")))
    number = lambda d: d.astype({c: "Int64" for c in d.columns if "sha" not in c})
    assert key(number(back)) == key(number(want))
    rows = {(x.conv_id, x.turn_no): x for x in chat.expand(got).collect()}
    one = rows[1, 2]
    assert one.text == one.context + one.reply and one.context.endswith("<|im_start|>assistant\n") and one.context.count("<|im_end|>\n") == 2
    assert chat.format_conversations(turns.where("false")).count() == 0


def test_chat_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"say {i} <|") for i in range(100_000)] + [(2, 0, "user", "alone")]
    began = time.perf_counter()
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {x.conv_id: x for x in chat.read_back(formatted).collect()}
    assert time.perf_counter() - began < 60
    assert (got[1].n_turns, got[1].n_examples, got[2].n_turns, got[2].n_examples, got[2].loss_chars, got[2].example_chars) == (100_000, 50_000, 1, 0, 0, 0)
    assert got[1].loss_sha256 == hashlib.sha256("".join(t for _, _, r, t in rows if r == "assistant").encode()).hexdigest()
    assert chat.read_back(formatted)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def slow_targets(sizes, percent=150, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()) * percent / 100, {}, set(names)
    while free:
        share = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= epochs * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        target |= {s: epochs * sizes[s] for s in over}
        free -= over
    return target


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("abé😀", max_size=2)), st.integers(0, 900), min_size=1, max_size=7))
def test_water_filling_equals_iteration(spark, sizes):
    got = mixing.targets(spark.createDataFrame([*sizes.items()], "source string, source_size long"))
    want = slow_targets(sizes)
    for x in got.collect():
        assert x.share_num / x.share_den == pytest.approx(want[x.source], abs=1e-6)


def test_mix_is_near_its_targets_and_repeats(spark):
    rows = [(i, None if i % 31 == 0 else "w\u00a0x " * (i % 13 + 1), "hot" if i % 3 else [None, "", "b", "c"][i % 4]) for i in range(900)] + [(5, "again and again", "hot")] * 3 + [(None, "no key", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect())) and len(got) == len(rows)
    for s in (None, "", "b", "c", "hot"):
        mine = [x for x in got if x.source == s]
        assert sum(x.size for x in mine) == mine[0].source_size
        assert abs(sum(x.taken for x in mine) - mine[0].target) <= 15
    assert all(x.taken == x.epochs * x.size <= 2 * x.size for x in got)
    assert mixing.mix(docs.where("false")).count() == 0


URLS = [
    None, "", "no-scheme.com/en/", "http://Example.COM", "https://a.example.com/en/x?q#f", "http://www.example.com/en/", "http://x.www.example.com/en/y", "http://notexample.com/en/", "ftp://site.net/es/p", "http://net/es/", "http://site.net/esx",
    "a://b://c/d", "http://h?x/y", "http://h#x", "https://co.uk/", "http://ÀB.Org/É",
]
RULES = [urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/")]


def test_urls_against_sql_and_by_hand(spark):
    hosts = [f"http://h{i % 7}.{d}/p{i}" for i in range(400) for d in ("bad.example.org", "good.example.org", "x.co.uk", "spam.bad.net")]
    hosts += ["http://new.bad.net/", "http://new.example.org/", "http://other.net/", "http://a.b.c.dev/", "http://new.x.co.uk/"] * 2
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + hosts)], "page_id long, url string, verdict string")
    labels = [(i, 0 if "bad" in u and i % 10 else 1, None) for i, u in enumerate(URLS + hosts) if u and i % 3 and "new." not in u]
    outcomes = spark.createDataFrame([(i, int(q == 0)) for i, q, _ in labels], "page_id long, bad int")
    got = {x.page_id: x for x in urls.judge(pages, outcomes, RULES).collect()}
    db = duckdb.connect()
    db.register("pages", pages.select("page_id", "url").toPandas())
    db.register("labels", spark.createDataFrame(labels, "doc_id long, quality int, toxic int").toPandas())
    for row in db.sql(oracle.URLS).fetchall():
        assert tuple(got[row[0]]) == row
    by_url = {u: got[i] for i, u in enumerate(URLS)}
    assert (by_url[None].host, by_url[None].path, by_url["no-scheme.com/en/"].host) == ("", "", "")
    assert (by_url["http://Example.COM"].rule, by_url["http://Example.COM"].path) == (None, "")
    assert by_url["https://a.example.com/en/x?q#f"].rule == "example.com/en/" and by_url["https://a.example.com/en/x?q#f"].path == "/en/x"
    assert by_url["http://x.www.example.com/en/y"].verdict == "allow" and by_url["http://notexample.com/en/"].rule == "com/"
    assert by_url["http://net/es/"].verdict == "block" and by_url["http://site.net/esx"].rule is None
    assert by_url["a://b://c/d"].host == "b:" and by_url["http://ÀB.Org/É"].host == "Àb.org"
    bad = {x.verdict for x in got.values() if "bad.example" in x.host}
    assert bad == {"block"} and {x.verdict for x in got.values() if "good.example" in x.host} == {"allow"}


def test_hosts_without_outcomes_have_the_bound_of_their_domain(spark):
    hosts = [f"h{i}.{d}" for d in ("bad.org", "good.org") for i in range(4)]
    rows = [(100 * i + j, f"http://{h}/p{j}", int("bad" in h)) for i, h in enumerate(hosts) for j in range(30)]
    more = [(9000, "http://new.bad.org/"), (9001, "http://new.good.org/"), (9002, "http://new.other.org/"), (9003, "http://new.other.net/"), (9004, None)]
    pages = spark.createDataFrame([x[:2] for x in rows] + more, "page_id long, url string")
    outcomes = spark.createDataFrame([(k, bad) for k, _, bad in rows], "page_id long, bad int")
    got = {x.page_id: x.verdict for x in urls.judge(pages, outcomes).collect()}
    assert [got[k] for k, _ in more] == ["block", "allow", "allow", "allow", "allow"] and len(got) == len(rows) + len(more)


def test_urls_repeats_nulls_and_empty_tables(spark):
    pages = spark.createDataFrame([(None, "http://a.b/"), (1, "http://a.b/"), (1, "http://a.b/")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    assert [x.verdict for x in urls.judge(pages, none).collect()] == ["allow"] * 3
    some = spark.createDataFrame([(1, None), (1, 1), (None, 1)], none.schema)
    assert urls.judge(pages, some).count() == 3
    assert urls.judge(pages.where("false"), some, RULES).count() == 0
    hot = spark.createDataFrame([(i, "http://hot.bad.org/") for i in range(400)] + [(1, "http://x.bad.org/")] * 300 + [(None, "http://hot.bad.org/")], pages.schema)
    judged = urls.judge(hot, spark.createDataFrame([(i, 1) for i in range(200)], none.schema)).groupBy("verdict").count().collect()
    assert [tuple(x) for x in judged] == [("block", 701)]
    few = urls.reputation(spark.createDataFrame([("a.b", 1)], "host string, bad int")).first()
    assert few.lower < 0.5 < few.post


def test_native_queries_plan_no_python(spark):
    from tidemark.llm import queries

    for f in (queries.op2_chat, queries.op3_mixing, queries.op4_urls, queries.op10_secrets):
        plan = f(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
