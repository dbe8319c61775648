"""The chunk table: Parquet by tenant and repository, replaced on write by keys and merged on read.

A write adds data files with the new chunks and, beside them, files of the keys that it replaces or deletes; nothing that is there is read or written again. A reader
takes a snapshot of the log and leaves out chunks whose key was replaced later. ``compact`` packs small and replaced files of a repository into new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.storage import create, delete, names

KEYS = ["tenant_id", "repo_id", "source_id"]
PARTS = ["tenant_id", "repo_id"]
#: A line of the log. kind: data or gone (files of chunks or of replaced keys of one repository), or columns (of a version's chunks). why: what wrote it.
LINE = "n long, why string, kind string, dropped boolean, tenant_id string, repo_id string, version string, rows long, bytes long, columns string"


def collection(base: str, mode: str = "shared", name: str | None = None, tenant: str | None = None, repo: str | None = None) -> str:
    """Where a repository's chunks are: a name of its own, or the shared, the tenant's or the repository's table."""
    if name:
        return f"{base}/{name}"
    return {"shared": f"{base}/vector_store", "tenant": f"{base}/vector_store_{tenant}", "repo": f"{base}/vector_store_{tenant}_{repo}"}[mode]


class Conflict(RuntimeError):
    """Another writer has published one of the same repositories since this one read them."""


def _key(*columns: str) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(F.col(n), F.lit("\x1e")) for n in columns])


def bins_of(sizes: Iterable[tuple[str, int]], target: int) -> list[list[str]]:
    """Names in bins of at most ``target`` bytes, the largest first into the first bin that has room; a larger one has a bin of its own."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        for i, (held, inside) in enumerate(bins):
            if held + size <= target:
                bins[i] = (held + size, [*inside, name])
                break
        else:
            bins.append((size, [name]))
    return [inside for _, inside in bins]


@dataclass
class ChunkStore:
    """``data`` and ``gone`` hold versions, by tenant and repository; a version is what one write made. The log names the live ones, and a write becomes visible when its log file is there.

    Keys of ``gone`` hide the chunks of earlier log numbers than their own. A log file is created under its number or not at all, so of two writers with the same number one tries the
    next, unless they wrote the same repository: that is a ``Conflict``. Every ``checkpoint_every``-th write leaves the whole state of the log beside it, so a reader lists the folder and reads
    what came since. A crash before a log file leaves the old state; ``vacuum`` removes what no log file names any more.
    """

    spark: SparkSession
    path: str
    checkpoint_every: int = 16

    @property
    def _log(self) -> str:
        return f"{self.path}/_log"

    def last(self) -> int:
        """The number of the last write, 0 before the first."""
        return max((int(x.removesuffix(".json")) for x in names(self.spark, self._log) if x.endswith(".json")), default=0)

    def _lines(self, upto: int, after: int = 0) -> DataFrame:
        files = [f"{self._log}/{x}" for x in names(self.spark, self._log) if x.endswith(".json") and after < int(x.removesuffix(".json")) <= upto]
        return self.spark.read.schema(LINE).json(files) if files else self.spark.createDataFrame([], LINE)

    def _state(self, upto: int) -> DataFrame:
        """Live lines as of a log number: the last checkpoint and what came since."""
        kept = [int(x.removesuffix(".checkpoint")) for x in names(self.spark, self._log) if x.endswith(".checkpoint")]
        kept = [n for n in sorted(kept) if n <= upto and "_SUCCESS" in names(self.spark, f"{self._log}/{n:012d}.checkpoint")]
        lines = self._lines(upto, kept[-1] if kept else 0)
        if kept:
            lines = lines.unionByName(self.spark.read.schema(LINE).parquet(f"{self._log}/{kept[-1]:012d}.checkpoint"))
        rest = [F.max_by(c, F.when(~F.col("dropped"), F.col("n"))).alias(c) for c in ("why", "rows", "bytes", "columns")]
        state = lines.groupBy("kind", *PARTS, "version").agg(F.min("n").alias("n"), F.bool_or("dropped").alias("dropped"), *rest)
        return state.where("not dropped").select(*[c.split()[0] for c in LINE.split(", ")])

    def files(self, upto: int | None = None) -> DataFrame:
        """(n, kind, tenant_id, repo_id, version, rows, bytes): what a snapshot holds, a row for each version and repository."""
        return self._state(self.last() if upto is None else upto).where("kind <> 'columns'").select("n", "kind", *PARTS, "version", "rows", "bytes")

    def read(self, tenant: str | None = None, repo: str | None = None, among: DataFrame | None = None, upto: int | None = None) -> DataFrame | None:
        """Chunks of all, a tenant's or one repository, or of those (tenant_id, repo_id) ``among``; None without any. One snapshot, the last or that of a log number. Partitions are pruned by name."""
        state = self._state(self.last() if upto is None else upto)
        mine = state
        for name, value in zip(PARTS, (tenant, repo), strict=True):
            mine = mine if value is None else mine.where(F.col(name) == value)
        if among is not None:
            mine = mine.join(among.select(*PARTS).distinct(), PARTS, "left_semi")
        found = mine.where("kind <> 'columns'").collect()  # a row for each version of a repository; compaction keeps these few
        rows = self._rows(found, {x.version: x.columns for x in state.where("kind = 'columns'").collect()})
        return None if rows is None else rows.drop("version")

    def _rows(self, found: list[Row], columns: dict[str, str]) -> DataFrame | None:
        data, gone = ([x for x in found if x.kind == kind] for kind in ("data", "gone"))
        if not data:
            return None
        fields: dict[str, StructField] = {}
        for c in sorted({columns[x.version] for x in data}):
            for f in StructType.fromJson(json.loads(c)):
                fields.setdefault(f.name, f)
        kind = StructType([*fields.values(), StructField("version", StringType())])
        rows = self._scan("data", kind, data)
        # replaced keys matter only where older chunks are
        oldest: dict[tuple, int] = {}
        for x in data:
            at = (x.tenant_id, x.repo_id)
            oldest[at] = min(oldest.get(at, x.n), x.n)
        later = [x for x in gone if x.n > oldest.get((x.tenant_id, x.repo_id), x.n)]
        if not later:
            return rows
        touched = {(x.tenant_id, x.repo_id) for x in later}
        clean, dirty = ([x for x in data if ((x.tenant_id, x.repo_id) in touched) == hit] for hit in (False, True))
        number = lambda some: self.spark.createDataFrame(sorted({(x.version, x.n) for x in some}), "version string, _n long")  # noqa: E731  a row a version
        keys = self._scan("gone", StructType([StructField(c, StringType()) for c in (*KEYS, "version")]), later)
        last = keys.join(F.broadcast(number(later)), "version").groupBy(*KEYS).agg(F.max("_n").alias("_gone"))
        merged = self._scan("data", kind, dirty).join(F.broadcast(number(dirty)), "version").join(last, KEYS, "left").where("_gone is null or _gone <= _n").drop("_gone", "_n")
        return merged if not clean else merged.unionByName(self._scan("data", kind, clean))

    def _scan(self, folder: str, kind: StructType, some: list[Row]) -> DataFrame:
        versions = sorted({x.version for x in some})
        rows = self.spark.read.schema(kind).option("basePath", f"{self.path}/{folder}").parquet(*[f"{self.path}/{folder}/version={v}" for v in versions])
        return rows.where(_key("version", *PARTS).isin([_joined(x) for x in some]))

    def _written(self, rows: DataFrame, kind: str, version: str) -> list[dict]:
        """Writes rows as files of a version; a line for each of their repositories, counted without reading columns."""
        folder = f"{self.path}/{kind}"
        rows.write.partitionBy(*PARTS).parquet(f"{folder}/version={version}")
        there = self.spark.read.schema(StructType([StructField(c, StringType()) for c in (*PARTS, "version")])).option("basePath", folder).parquet(f"{folder}/version={version}")
        files = there.groupBy(*PARTS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count("*").alias("rows"))
        sums = files.groupBy(*PARTS).agg(F.sum("rows").alias("rows"), F.sum("size").alias("bytes")).collect()  # a row a repository
        return [{"kind": kind, "dropped": False, "version": version} | r.asDict() for r in sums]

    def _publish(self, lines: list[dict], seen: int, why: str) -> None:
        """Makes lines visible under one log number. seen: the last number when their writer read what it depends on."""
        touched = {(x["tenant_id"], x["repo_id"]) for x in lines if x["kind"] != "columns"}
        n = seen + 1
        while not create(self.spark, f"{self._log}/{n:012d}.json", "".join(json.dumps({"n": n, "why": why} | x) + "\n" for x in lines).encode()):
            others = self._lines(n, n - 1).where("kind <> 'columns'").select("why", *PARTS).distinct().collect()
            # a compaction changes no chunk, so it is in nobody's way but another's
            if touched & {(r.tenant_id, r.repo_id) for r in others if why != "replace" or r.why != "compact"}:
                raise Conflict(f"number {n} of {self.path} was published meanwhile")
            n += 1
        if n % self.checkpoint_every == 0:
            state = self._state(n)
            files = state.where("kind <> 'columns'")
            used = state.where("kind = 'columns'").join(files.select("version").distinct(), "version", "left_semi")
            files.unionByName(used).write.mode("overwrite").parquet(f"{self._log}/{n:012d}.checkpoint")

    def replace(self, chunks: DataFrame, gone: DataFrame | None = None, seen: int | None = None) -> None:
        """Chunks take the place of all former ones of their documents; documents of ``gone`` (keys) lose theirs. What is written follows the chunks and keys given, not the repository.

        seen: the log number that the caller's decisions are based on; the last one if not given.
        """
        seen = self.last() if seen is None else seen
        version = uuid.uuid4().hex
        lines = self._written(chunks, "data", version)
        keys = chunks.select(*KEYS)
        keys = (keys if gone is None else keys.unionByName(gone.select(*KEYS))).distinct()
        # only repositories that have chunks have any to hide
        held = self.files(seen).where("kind = 'data'").select(_key(*PARTS).alias("_held")).distinct()
        old = keys.join(held, _key(*PARTS) == F.col("_held"), "left_semi")
        lines += self._written(old, "gone", version)
        if lines:
            self._publish([*lines, {"kind": "columns", "dropped": False, "tenant_id": None, "repo_id": None, "version": version, "columns": chunks.schema.json()}], seen, "replace")

    def delete(self, gone: DataFrame) -> int:
        """How many chunks went."""
        seen = self.last()
        before = self.read(among=gone, upto=seen)
        if before is None:
            return 0
        n = before.join(gone.select(*KEYS).distinct(), KEYS, "left_semi").count()
        if n:
            self.replace(before.where("false"), gone, seen)
        return n

    def promote(self, target: ChunkStore, tenant: str, repo: str) -> None:
        """Moves a repository to a table of its own: written there first, then dropped here."""
        seen = self.last()
        rows = self.read(tenant, repo, upto=seen)
        if rows is not None:
            target.replace(rows)
            self._publish(_drops(self.files(seen).where((F.col("tenant_id") == tenant) & (F.col("repo_id") == repo)).collect()), seen, "promote")

    def compact(self, small: int = 64 << 20, target: int = 256 << 20) -> int:
        """Packs files of a repository that are small, or hold replaced chunks, into files of about ``target`` bytes without these; how many files went. Readers of older snapshots are not disturbed."""
        seen = self.last()
        state = self._state(seen)
        found = state.where("kind <> 'columns'").collect()  # a row for each version of a repository
        columns = {x.version: x.columns for x in state.where("kind = 'columns'").collect()}
        repos: dict[tuple, list[Row]] = {}
        for x in found:
            repos.setdefault((x.tenant_id, x.repo_id), []).append(x)
        chosen, drops, bins = [], [], {}
        for files in repos.values():
            data, gone = ([x for x in files if x.kind == kind] for kind in ("data", "gone"))
            by_name = {_joined(x): x for x in data}
            last = max((x.n for x in gone), default=0)
            sizes = [(name, x.bytes) for name, x in by_name.items() if x.bytes < small or x.n < last]
            groups = [g for g in bins_of(sizes, target) if len(g) > 1 or by_name[g[0]].n < last]
            picked = [name for g in groups for name in g]
            bins |= {name: i for i, g in enumerate(groups, len(bins)) for name in g}
            chosen += [*(by_name[name] for name in picked), *(gone if picked else [])]
            oldest = min((x.n for name, x in by_name.items() if name not in picked), default=seen + 1)
            drops += [by_name[name] for name in picked] + [x for x in gone if x.n <= oldest]
        if not drops:
            return 0
        version, lines = uuid.uuid4().hex, []
        rows = self._rows(chosen, columns)
        if rows is not None:
            bin_of = self.spark.createDataFrame(list(bins.items()), "_file string, _bin int")  # a row for each file that goes
            rows = rows.join(F.broadcast(bin_of), _key("version", *PARTS) == F.col("_file")).drop("_file", "version")
            lines = self._written(rows.repartition(len(set(bins.values())), "_bin").drop("_bin"), "data", version)
            rows = rows.drop("_bin")
            lines.append({"kind": "columns", "dropped": False, "tenant_id": None, "repo_id": None, "version": version, "columns": rows.schema.json()})
        self._publish(lines + _drops(drops), seen, "compact")
        return len(drops)

    def vacuum(self) -> int:
        """Deletes files and log entries that the last snapshot does not need; how many repositories' versions went. Not while others read older snapshots or write."""
        last = self.last()
        live = {(x.kind, _joined(x)) for x in self.files(last).collect()}
        gone = 0
        for kind in ("data", "gone"):
            if not names(self.spark, f"{self.path}/{kind}"):
                continue
            there = self.spark.read.schema(StructType([StructField(c, StringType()) for c in ("version", *PARTS)])).parquet(f"{self.path}/{kind}")
            folders = there.select("version", *PARTS, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder")).distinct().collect()
            for x in folders:
                if (kind, _joined(x)) not in live:
                    delete(self.spark, x.folder)
                    gone += 1
        return gone


def _joined(x: Row) -> str:
    return "\x1f".join("\x1e" if v is None else v for v in (x.version, x.tenant_id, x.repo_id))


def _drops(some: list[Row]) -> list[dict]:
    return [{"kind": x.kind, "dropped": True, "tenant_id": x.tenant_id, "repo_id": x.repo_id, "version": x.version} for x in some]


def duplicates(chunks: DataFrame) -> DataFrame:
    """Rows that break the unique key (document, chunk index); empty if all is well."""
    return chunks.groupBy(*KEYS, "chunk_index").count().where("count > 1")
