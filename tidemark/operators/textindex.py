"""An inverted index for lexical search: postings in blocks by term, updated by document."""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import contained, create, materialize, names

TERM = re.compile(r"[^\W_]+")
#: Documents of a block, and postings that a task gathers before it cuts blocks.
BLOCK, GATHERED = 512, 1 << 20
_POSTINGS = "bucket int, term string, block string, keys array<string>, counts array<int>, lengths array<int>, most int, least int"
_LOG = "n long, version string, docs long, length long"


def terms_of(text: str | None) -> list[str]:
    """Runs of letters and digits of any script, without regard to case."""
    return TERM.findall((text or "").lower())


def _blocks():
    """(bucket, term, block, keys, counts, lengths, most, least): a row for each term of a block; documents of a length share a block, so that the bounds of blocks differ. Rows without a term are those of the documents themselves, with their terms in ``keys``."""

    kind = pa.schema([("term", pa.string()), ("block", pa.string()), ("keys", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())), ("most", pa.int32()), ("least", pa.int32())])

    def offsets(sizes: np.ndarray) -> pa.Array:
        return pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())

    def close(docs: list[tuple[int, str, Counter]]) -> Iterator[pa.RecordBatch]:
        docs.sort(key=lambda x: (x[0], x[1]))
        keys, length, sizes = pa.array([k for _, k, _ in docs], pa.string()), np.array([n for n, _, _ in docs], np.int32), np.array([len(c) for _, _, c in docs], np.int64)
        terms = pa.array(list(chain.from_iterable(c for _, _, c in docs)), pa.string())
        counts = np.fromiter(chain.from_iterable(c.values() for _, _, c in docs), np.int32, len(terms))
        parts = [pa.RecordBatch.from_arrays([pa.nulls(len(docs), pa.string()), keys, pa.ListArray.from_arrays(offsets(sizes), terms), pa.nulls(len(docs), kind.field("counts").type), pa.ListArray.from_arrays(offsets(np.ones(len(docs))), pa.array(length)), *[pa.nulls(len(docs), pa.int32())] * 2], schema=kind)]
        if len(terms):
            found, doc = terms.dictionary_encode(), np.repeat(np.arange(len(docs)), sizes)
            list_ = doc // BLOCK * len(found.dictionary) + found.indices.to_numpy()
            order = np.argsort(list_, kind="stable")  # by block and term, documents in their order
            list_, doc, counts = list_[order], doc[order], counts[order]
            starts = np.flatnonzero(np.r_[True, list_[1:] != list_[:-1]])
            at = pa.array(np.r_[starts, len(doc)], pa.int32())
            names = pa.array([uuid.uuid4().hex for _ in range(0, len(docs), BLOCK)])
            lists = [pa.ListArray.from_arrays(at, x) for x in (keys.take(pa.array(doc)), pa.array(counts), pa.array(length[doc]))]
            bounds = [pa.array(np.maximum.reduceat(counts, starts)), pa.array(np.minimum.reduceat(length[doc], starts))]
            parts.append(pa.RecordBatch.from_arrays([found.dictionary.take(pa.array(list_[starts] % len(found.dictionary))), names.take(pa.array(doc[starts] // BLOCK)), *lists, *bounds], schema=kind))
        for part in parts:
            for i in range(0, part.num_rows, 4096):
                yield part.slice(i, 4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms_of(text)
                counts = Counter(found)
                docs.append((len(found), key, counts))
                held += len(counts)
                if held >= GATHERED:
                    yield from close(docs)
                    docs, held = [], 0
        if docs:
            yield from close(docs)

    return run


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


class TextIndex:
    """Versions of postings, of documents with their terms, of replaced keys, and of what a write adds to and takes from the terms' document counts; a log names them.

    A write costs what its documents hold. Postings lie by bucket of their term and sorted by it, so a question reads the lists of its terms only; those of documents that were replaced later
    are left out by key, and statistics are sums of signed counts, so they are always those of the live documents. Documents without a term count too.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _log(self) -> list:
        files = [f"{self.path}/log/{x}" for x in names(self.spark, f"{self.path}/log")]
        return self.spark.read.schema(_LOG).json(files).orderBy("n").collect() if files else []  # a row a write

    def _read(self, folder: str, kind: str, log: list) -> DataFrame:
        """Rows of live versions, with ``n`` of their write."""
        numbers = F.broadcast(self.spark.createDataFrame([(x.version, x.n) for x in log], "version string, n long"))
        rows = self.spark.read.schema(f"{kind}, version string").option("basePath", f"{self.path}/{folder}").parquet(*[f"{self.path}/{folder}/version={x.version}" for x in log])
        return rows.join(numbers, "version").drop("version")

    def _later(self, log: list) -> DataFrame | None:
        """(key, gone): the last write that replaced a key; None if none but the first has been."""
        return self._read("gone", "key string", log[1:]).groupBy(F.col("key").alias("_key")).agg(F.max("n").alias("_gone")) if len(log) > 1 else None

    def put(self, docs: DataFrame, key: str, text: str, gone: DataFrame | None = None) -> None:
        """Documents take the place of former ones of their keys; keys of ``gone`` lose theirs. Keys are read as strings and are different."""

        def written() -> DataFrame:
            log, version = self._log(), uuid.uuid4().hex
            rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
            keys = rows.select("key") if gone is None else rows.select("key").union(gone.select(F.col(key).cast("string"))).distinct()
            made = materialize(rows.mapInArrow(_blocks(), _POSTINGS.removeprefix("bucket int, ")), "postings")
            lists = made.where("term is not null").withColumn("bucket", _bucket(F.col("term"), self.buckets))
            # a term's lists may be a third of all, so a bucket has several tasks
            lists.repartition(self.buckets * 4, "bucket", F.pmod(F.xxhash64("block"), F.lit(4))).sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{self.path}/postings/version={version}")
            forward = made.where("term is null").select(F.col("block").alias("key"), F.col("keys").alias("terms"), F.get("lengths", F.lit(0)).alias("length"))
            forward.write.parquet(f"{self.path}/docs/version={version}")
            keys.write.parquet(f"{self.path}/gone/version={version}")
            lost = self.live(log).join(keys.withColumnRenamed("key", "_k"), F.col("key") == F.col("_k"), "left_semi") if log else None
            signed = forward.withColumn("sign", F.lit(1))
            signed = materialize(signed if lost is None else signed.unionByName(lost.withColumn("sign", F.lit(-1)).select(signed.columns)), "signed")
            stats = signed.select(F.explode("terms").alias("term"), "sign").groupBy("term").agg(F.sum("sign").alias("df")).where("df <> 0").withColumn("bucket", _bucket(F.col("term"), self.buckets))
            stats.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{self.path}/stats/version={version}")
            return signed.agg(F.coalesce(F.sum("sign"), F.lit(0)).alias("docs"), F.coalesce(F.sum(F.col("sign") * F.col("length")), F.lit(0)).alias("length"), F.lit(version).alias("version"), F.lit(log[-1].n + 1 if log else 1).alias("n"))

        done = contained(self.spark, "indexed", written).first()
        if not create(self.spark, f"{self.path}/log/{done.n:012d}.json", json.dumps(done.asDict()).encode()):
            raise RuntimeError(f"write {done.n} of {self.path} was published meanwhile")

    def live(self, log: list | None = None) -> DataFrame:
        """(key, terms, length) of the documents that are there now."""
        log = self._log() if log is None else log
        rows, later = self._read("docs", "key string, terms array<string>, length int", log), self._later(log)
        return (rows if later is None else rows.join(later, F.col("key") == F.col("_key"), "left").where("_gone is null or _gone <= n").drop("_key", "_gone")).drop("n")

    def topk(self, query: str, k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """(key, score) of the best ``k`` by Okapi BM25, as ``retrieve.bm25`` finds them; ties by key.

        Bounds come first, from the largest count and the least length of each list: the blocks of the highest bounds are scored until they hold ``k`` documents, and of the others only those whose bound
        reaches the last score of these are read.
        """
        return contained(self.spark, "ranked", lambda: self._topk(sorted(set(terms_of(query))), k, k1, b))

    def lists(self, terms: list[str], log: list) -> DataFrame:
        """The asked terms' lists: their buckets by name, their rows by the file's own statistics."""
        of = {r.b for r in self.spark.createDataFrame([(t,) for t in terms], "t string").select(_bucket(F.col("t"), self.buckets).alias("b")).collect()}
        rows = self._read("postings", _POSTINGS.replace("bucket int, ", "") + ", bucket int", log)
        return rows.where(F.col("bucket").isin(*of) & F.col("term").isin(*terms))

    def _topk(self, terms: list[str], k: int, k1: float, b: float) -> DataFrame:
        log, none = self._log(), self.spark.createDataFrame([], "key string, score double")
        docs, length = sum(x.docs for x in log), sum(x.length for x in log)
        if not terms or not docs:
            return none
        buckets = [r.b for r in self.spark.createDataFrame([(t,) for t in terms], "t string").select(_bucket(F.col("t"), self.buckets).alias("b")).collect()]
        counts = self._read("stats", "term string, df long, bucket int", log).where(F.col("bucket").isin(*buckets) & F.col("term").isin(*terms))
        df = {r.term: r.df for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect() if r.df > 0}
        if not df:
            return none
        mean = max(length / docs, 1e-9)
        idf = reduce(lambda a, t: a.when(F.col("term") == t, F.log(F.lit(1 + (docs - df[t] + 0.5) / (df[t] + 0.5)))), df, F)
        part = lambda f, n: idf * f * (k1 + 1) / (f + k1 * (1 - b + b * n / mean))
        lists = self.lists(list(df), log)
        # bounds grow with the count and fall with the length
        bounds = materialize(lists.groupBy("block").agg(F.sum(part(F.col("most"), F.col("least"))).alias("bound"), F.max(F.size("keys")).alias("held")), "bounds")
        later = self._later(log)

        def scores(blocks: DataFrame) -> DataFrame:
            some = lists.join(blocks.select("block"), "block", "left_semi")
            rows = some.select("n", "term", F.explode(F.arrays_zip("keys", "counts", "lengths")).alias("x")).select("n", F.col("x.keys").alias("key"), part(F.col("x.counts"), F.col("x.lengths")).alias("s"))
            if later is not None:
                rows = rows.join(later, F.col("key") == F.col("_key"), "left").where("_gone is null or _gone <= n")
            return rows.groupBy("key").agg(F.sum("s").alias("score"))

        best = lambda rows: rows.orderBy(F.desc("score"), "key").limit(k)
        ahead = max(2, -(-4 * k // BLOCK))
        first = bounds.orderBy(F.desc("bound"), "block").limit(ahead)
        found = best(scores(first)).collect()  # k rows
        floor = found[-1].score if len(found) == k else 0.0
        # sums of the same parts in another order may differ in their last digits
        return best(scores(bounds.where(F.col("bound") >= floor * (1 - 1e-9))))
