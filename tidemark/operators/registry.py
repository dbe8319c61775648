"""The registry as a table that a scan meets where it lies."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import delta
from tidemark.storage import delete, names

#: Keys that are looked for by name in a whole version's files instead of by a join.
NAMED_KEYS = 10
#: Rows of a bucket of a whole version.
BUCKET_ROWS = 2_000_000


class RegistryTable:
    """The registry as a folder of versions, one a batch or run. A version holds the rows that changed, each ``whole_every``-th one all rows; so a run writes what it touches.

    A whole version is bucketed and sorted by key, one file a bucket, with Bloom filters of the ids: a scan's keys are shuffled to the buckets, the registry never is, and
    a new whole version is made bucket by bucket. A number names its version, so a batch that runs again writes the same one.
    """

    def __init__(self, spark: SparkSession, path: str, whole_every: int = 16, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.whole_every, self.bucket_rows = spark, path, whole_every, bucket_rows

    def _known(self) -> list[tuple[int, int]]:
        """(number, buckets; 0: a version of changes) of what has been written to its end, in order."""
        done = [x for x in names(self.spark, self.path) if "_SUCCESS" in names(self.spark, f"{self.path}/{x}")]
        return sorted((int(x.split("-")[0]), int(x.split("-")[2]) if "-whole-" in x else 0) for x in done)

    def versions(self) -> list[tuple[int, bool]]:
        """(number, whether it holds all rows), in order."""
        return [(n, buckets > 0) for n, buckets in self._known()]

    def version(self) -> int:
        return max((n for n, _ in self._known()), default=-1)

    def _table(self, n: int) -> str:
        return f"tidemark_registry_{hashlib.sha1(self.path.encode()).hexdigest()[:16]}_{n}"

    def close(self) -> None:
        """The session forgets the whole versions; the files stay, and another session finds them by their folder."""
        for n, buckets in self._known():
            if buckets:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(n)}")

    def _parts(self, upto: int | None) -> tuple[DataFrame | None, DataFrame | None]:
        """(the last whole version, the last state of what changed since), None where there is none."""
        known = [x for x in self._known() if upto is None or x[0] <= upto]
        start, buckets = max(((n, b) for n, b in known if b), default=(-1, 0))
        since = [self.spark.read.schema(delta.REGISTRY).parquet(f"{self.path}/{n}").withColumn("_n", F.lit(n)) for n, b in known if n > start and not b]
        base = None
        if buckets:
            if not self.spark.catalog.tableExists(self._table(start)):
                keys = ", ".join(delta.KEYS)
                self.spark.sql(f"CREATE TABLE {self._table(start)} ({delta.REGISTRY}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{self.path}/{start}-whole-{buckets}'")
            base = self.spark.table(self._table(start))
        if not since:
            return base, None
        rows = reduce(DataFrame.unionByName, since)
        rest = [c for c in rows.columns if c not in (*delta.KEYS, "_n")]
        return base, rows.groupBy(*delta.KEYS).agg(F.max_by(F.struct(*rest), "_n").alias("_r")).select(*delta.KEYS, "_r.*")

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], delta.REGISTRY)

    def read(self, before: int | None = None) -> DataFrame:
        """All rows as of a version, the last one if not given."""
        base, since = self._parts(before)
        if base is None or since is None:
            return self._empty() if base is since else since if base is None else base
        return base.join(since.select(*delta.KEYS), delta.KEYS, "left_anti").unionByName(since)

    def rows_of(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Rows of those keys. Of the registry, nothing is moved but what is found."""
        base, since = self._parts(before)
        asked = keys.select(*delta.KEYS).distinct()
        new = self._empty() if since is None else since.join(asked, delta.KEYS, "left_semi")
        if base is None:
            return new
        few = [r.source_id for r in asked.select("source_id").distinct().limit(NAMED_KEYS + 1).collect()]
        if len(few) <= NAMED_KEYS:
            base = base.where(F.col("source_id").isin(few))
        found = base.join(asked, delta.KEYS, "left_semi")
        return (found if since is None else found.join(since.select(*delta.KEYS), delta.KEYS, "left_anti")).unionByName(new)

    def absent(self, seen: DataFrame, where: Column, before: int | None = None) -> DataFrame:
        """Active rows that a full listing does not hold (see ``delta.implicit_deletes``), of those that ``where`` picks."""
        base, since = self._parts(before)
        mine = lambda rows: delta.implicit_deletes(rows.where(where), seen)
        if base is None or since is None:
            return self._empty() if base is since else mine(since if base is None else base)
        return mine(base.join(since.select(*delta.KEYS), delta.KEYS, "left_anti")).unionByName(mine(since))

    def write(self, changed: DataFrame, n: int) -> None:
        """The rows that a batch changed, whole rows of different keys."""
        if (n + 1) % self.whole_every:
            changed.write.mode("overwrite").parquet(f"{self.path}/{n}")
            return
        for x in names(self.spark, self.path):
            if x.startswith(f"{n}-whole-"):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(n)}")
                delete(self.spark, f"{self.path}/{x}")
        changed.write.mode("overwrite").parquet(f"{self.path}/{n}")
        base, since = self._parts(n)
        rows = (0 if base is None else base.count()) + since.count()
        buckets = max([b for m, b in self._known() if b and m < n], default=0)
        if base is None or rows > 2 * buckets * self.bucket_rows:
            buckets = -(-rows // self.bucket_rows) or 1
            base = (self._empty() if base is None else base).repartition(buckets, *delta.KEYS)
        # a bucket's rows are together on both sides, and stay so: a task writes one bucket
        rest = [c for c in base.columns if c not in delta.KEYS]
        merged = base.select(*delta.KEYS, F.struct(*rest).alias("_old")).join(since.select(*delta.KEYS, F.struct(*rest).alias("_new")), delta.KEYS, "full_outer")
        merged = merged.select(*delta.KEYS, F.coalesce("_new", "_old").alias("_r")).select(*delta.KEYS, "_r.*")
        where = f"{self.path}/{n}-whole-{buckets}"
        merged.write.bucketBy(buckets, *delta.KEYS).sortBy(*delta.KEYS).option("path", where).option("parquet.bloom.filter.enabled#source_id", "true").saveAsTable(self._table(n))
        delete(self.spark, f"{self.path}/{n}")
