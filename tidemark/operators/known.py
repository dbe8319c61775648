"""Known values of the filterable fields as a maintained view of the chunks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import names

_KEY = ["tenant_id", "repo_id", "field", "value"]
_ROW = "tenant_id string, repo_id string, field string, value string, plain string, initials string, n long"


def plain(value: Column) -> Column:
    """Words of a value as a question's words are compared: lower case, one space between."""
    return F.trim(F.regexp_replace(F.lower(value), r"(?U)\W+", " "))


class KnownValues:
    """Counts of chunks by tenant, repository, field and value, as versions of signed changes; each ``fold_every``-th version holds all that is left.

    An update costs the chunks that came and went; a question looks its word sequences up by name. No chunk is read for either.
    """

    def __init__(self, spark: SparkSession, path: str, fields: list[str], fold_every: int = 16):
        self.spark, self.path, self.fields, self.fold_every = spark, path, fields, fold_every

    def _known(self) -> list[tuple[int, str]]:
        done = [x for x in names(self.spark, self.path) if "_SUCCESS" in names(self.spark, f"{self.path}/{x}")]
        return sorted((int(x.split("-")[0]), x) for x in done)

    def _rows(self, known: list[tuple[int, str]]) -> DataFrame:
        start = max((n for n, x in known if x.endswith("-whole")), default=-1)
        paths = [f"{self.path}/{x}" for n, x in known if n > start or n == start and x.endswith("-whole")]
        return self.spark.read.schema(_ROW).parquet(*paths) if paths else self.spark.createDataFrame([], _ROW)

    def _counted(self, chunks: DataFrame, sign: int) -> DataFrame:
        held = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in self.fields if f in chunks.columns]
        rows = chunks.select("tenant_id", "repo_id", F.explode(F.array(*held)).alias("x")) if held else chunks.select("tenant_id", "repo_id", F.lit(None).cast("struct<field:string,value:string>").alias("x"))
        return rows.select("tenant_id", "repo_id", "x.*", F.lit(sign).alias("n")).where("value is not null")

    def update(self, new: DataFrame, old: DataFrame | None = None) -> None:
        """Chunks that came, and those that went with documents replaced or deleted."""
        changed = self._counted(new, 1) if old is None else self._counted(new, 1).unionByName(self._counted(old, -1))
        sums = changed.groupBy(*_KEY).agg(F.sum("n").alias("n")).where("n <> 0").withColumn("plain", plain(F.col("value")))
        sums = sums.withColumn("initials", F.array_join(F.transform(F.split("plain", " "), lambda w: F.substring(w, 1, 1)), ""))
        known = self._known()
        n = known[-1][0] + 1 if known else 0
        columns = [c.split()[0] for c in _ROW.split(", ")]
        sums.select(columns).write.parquet(f"{self.path}/{n}")  # fails if another writer has this number
        if (n + 1) % self.fold_every == 0:
            whole = self._rows(self._known()).groupBy(*_KEY, "plain", "initials").agg(F.sum("n").alias("n")).where("n > 0")
            whole.select(columns).sortWithinPartitions("plain").write.parquet(f"{self.path}/{n}-whole")

    def _live(self, where: Column) -> DataFrame:
        return self._rows(self._known()).where(where).groupBy("tenant_id", "repo_id", "field", "value").agg(F.sum("n").alias("n")).where("n > 0")

    def values(self, tenant: str | None = None, repos: list[str] | None = None) -> DataFrame:
        """(field, value): different values of all, a tenant's or some repositories."""
        return self._live(self._scope(tenant, repos)).select("field", "value").distinct()

    def _scope(self, tenant: str | None, repos: list[str] | None) -> Column:
        parts = [] if tenant is None else [F.col("tenant_id") == tenant]
        parts += [] if repos is None else [F.col("repo_id").isin(*repos)]
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    def named(self, question: str, fields: list[str], tenant: str | None = None, repos: list[str] | None = None) -> dict[str, list[str]]:
        """Values that a question names, whole or by initials, as ``retrieve.named_values`` finds them in chunks."""
        words = re.findall(r"\w+", question.lower())
        if not words or not fields:
            return {}
        grams = [" ".join(words[i:j]) for i in range(len(words)) for j in range(i + 1, len(words) + 1)]
        hit = F.col("plain").isin(*set(grams)) | (F.length("initials") > 1) & F.col("initials").isin(*set(words))
        found = self._live(self._scope(tenant, repos) & F.col("field").isin(*fields) & hit).select("field", "value").distinct()
        return {r.field: sorted(r.values) for r in found.groupBy("field").agg(F.collect_list("value").alias("values")).collect()}  # a question has room for few
