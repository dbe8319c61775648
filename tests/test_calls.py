import threading
import time

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import embed, enrich
from tidemark.operators.calls import in_groups, in_order


def test_order_width_errors_and_rate():
    running, most, taken, lock = 0, 0, 0, threading.Lock()

    def call(x):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        time.sleep(0.03 if x % 5 else 0.1)
        with lock:
            running -= 1
        if x == 7:
            raise ValueError("seven")
        return x * x

    def rows():
        nonlocal taken
        for x in range(40):
            taken += 1
            yield x

    got, ahead = [], 0
    for result in in_order(rows(), call, 4):
        got.append(result)
        ahead = max(ahead, taken - len(got))
    assert [x for x, _ in got] == [None if x == 7 else x * x for x in range(40)] and most == 4 and ahead <= 8
    assert [i for i, (_, e) in enumerate(got) if e] == [7] and str(got[7][1]) == "seven"
    began = time.monotonic()
    assert len(list(in_order(range(6), lambda x: x, 6, rate=20))) == 6 and time.monotonic() - began > 0.2
    assert list(in_order([], call)) == []


def test_a_bad_row_of_a_group_fails_alone():
    asked = []

    def call(some):
        asked.append(list(some))
        if 3 in some:
            raise RuntimeError("three")
        return some[:-1] if 8 in some and len(some) > 1 else [x + 1 for x in some]

    got = in_groups(list(range(10)), call, 4, 2)
    assert [x for x, _ in got] == [1, 2, 3, None, *range(5, 11)] and [i for i, (_, e) in enumerate(got) if e] == [3]
    assert [0, 1, 2, 3] in asked and [3] in asked and [8] in asked and [4] not in asked


def test_settings_take_effect(spark):
    rows = [("d", i, f"text {i} " * 9, None, None, None, None) for i in range(40)]
    chunks = spark.createDataFrame(rows, "doc string, chunk_index int, text string, h1 string, h2 string, h3 string, h4 string").coalesce(1)

    def model(b: pd.DataFrame):
        if any("text 13 " in t for t in b["text"]):
            raise RuntimeError
        time.sleep(0.2)
        return [f"A sentence about {t[:8]} from its document." for t in b["text"]]

    def took(concurrency):
        began = time.monotonic()
        got = {x.chunk_index: x.text for x in enrich.contextualise(chunks, model, ["doc"], concurrency=concurrency, batch=2).collect()}
        assert got[13] == rows[13][2] and all(got[i] == f"A sentence about {rows[i][2][:8]} from its document.\n\n{rows[i][2]}" for i in range(40) if i != 13)
        return time.monotonic() - began

    took(20)
    assert took(1) - took(20) > 2

    class Slow:
        model_name, dimensions = "slow", 2

        def embed_documents(self, texts):
            time.sleep(0.1)
            return np.array([[len(t), 1.0] for t in texts])

    began = time.monotonic()
    got = embed.embed(chunks, Slow(), batch=1, concurrency=20).collect()
    assert all(x.embedding == [len(x.text), 1.0] for x in got) and time.monotonic() - began < 4

    class Broken(Slow):
        def embed_documents(self, texts):
            raise RuntimeError("no answer")

    with pytest.raises(Exception, match="no answer"):
        embed.embed(chunks, Broken()).collect()
