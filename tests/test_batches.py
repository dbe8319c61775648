import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators import chunk, embed
from tidemark.operators.batches import by_bytes, by_known


def test_slices_are_bounded_and_whole():
    texts = [None, "", "a" * 30, "b" * 500, None, *["c" * 9] * 40]
    for make in (lambda c: by_bytes(c, 100), lambda c: by_known(c, 7)):
        for column in (pa.array(texts), pa.array([None, *texts]).slice(1)):
            assert [x for part in make(column) for x in part.to_pylist()] == texts
        assert list(make(pa.array([], pa.string()))) == []
    assert max(len(p) for p in by_bytes(pa.array(texts), 100)) <= 100 and all(sum(len(x or "") for x in p.to_pylist()[:-1]) < 100 for p in by_bytes(pa.array(texts), 100))
    assert [sum(x is not None for x in p.to_pylist()) for p in by_known(pa.array(texts), 7)] == [7] * 6 + [1]


class Resident:
    """Stands in for a model of 3,072 dimensions; the first one is the memory of its process in MB."""

    model_name, dimensions = "resident", 3072

    def embed_documents(self, texts):
        import numpy as np

        out = np.ones((len(texts), self.dimensions), np.float32)
        with open("/proc/self/statm") as f:
            out[:, 0] = int(f.read().split()[1]) / 256
        return out


def test_vectors_leave_python_call_by_call(spark):
    rows = spark.range(0, 9_000, 1, 1).withColumn("text", F.col("id").cast("string"))
    got = embed.embed(rows, Resident()).select(F.get("embedding", F.lit(0)).alias("mb"), F.size("embedding").alias("n")).agg(F.count("*"), F.min("n"), F.max("mb") - F.min("mb")).first()
    # all vectors of a batch are 105 MB
    assert got[0] == 9_000 and got[1] == 3072 and got[2] < 60


def test_chunks_of_long_and_short_texts_in_steps(spark):
    texts = [None, "# A\n\n" + "word " * 300_000, "short", " ", *[f"text {i}" for i in range(50)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, markdown string").coalesce(1)
    got = {x.id: x.n for x in chunk.chunk(docs, "markdown", 1000, 100).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert got == {i: len(chunk.split(t, 1000, 100)) for i, t in enumerate(texts) if t and t.strip()}
