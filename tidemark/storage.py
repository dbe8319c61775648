"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_OPEN: ContextVar[list[str] | None] = ContextVar("tidemark_scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a local master may do without: it has a temporary folder then; elsewhere a local folder would lose rows, so that is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = spark.conf.get("tidemark.local.shared.dir", "") or tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("tidemark.local.shared.dir", found)
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it isn't there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def create(spark: SparkSession, path: str, content: bytes) -> bool:
    """Whether the file could be created; False if it is there already."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    out.write(bytearray(content))
    out.close()
    return True


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes within go when the block ends: what is read later must be ``written`` before."""
    made: list[str] = []
    token = _OPEN.set(made)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in made:
            delete(spark, path)


def fresh(spark: SparkSession, label: str) -> str:
    """A name in the shared folder that nothing has yet."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def folder(spark: SparkSession, label: str) -> str:
    """A name like that of ``fresh``; what is put there goes with the tables of the scratch block around, if there is one."""
    path = fresh(spark, label)
    if (made := _OPEN.get()) is not None:
        made.append(path)
    return path


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: its plan restarts there, and no lost executor takes it along."""
    return written(df, folder(df.sparkSession, label))


def contained(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written to one table; all tables that it materialized on the way are gone."""
    path = folder(spark, label)
    with scratch(spark):
        return written(make(), path)
