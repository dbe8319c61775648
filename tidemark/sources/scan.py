"""Sources: each turns its settings into a change feed, a DataFrame of documents or records."""

from __future__ import annotations

import datetime
import decimal
import json
import os
from collections import deque
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import content_hash, etag_hash, extension, file_name, mime_type, row_hash
from tidemark.functions.values import HIDDEN, MAX_FILE_BYTES, MIME
from tidemark.sources import drive as drive_service
from tidemark.sources.paged import PagedSource
from tidemark.storage import materialize

FEED = ["change", "content_type", "content", "mime_type", "record", "structured_source_type", "source_id", "file_name", "full_path", "source_url", "content_hash", "last_modified_at_source", "extra_metadata"]


def feed(rows: DataFrame, kind: str, values: dict[str, Column], more: list[Column] | None = None) -> DataFrame:
    null = F.lit(None)
    base = {"change": F.lit("upsert"), "content_type": F.lit(kind), "content": null.cast("binary"), "mime_type": null.cast("string"), "record": null.cast("string"), "structured_source_type": null.cast("string"), "last_modified_at_source": null.cast("timestamp"), "extra_metadata": null.cast("map<string,string>"), "content_hash": null.cast("string")}
    return rows.select(*[(base | values)[c].alias(c) for c in FEED], *(more or []))


def allowed(name: Column, include: list[str], exclude: list[str], hidden: tuple[str, ...]) -> Column:
    """By extension (exclude wins) and without hidden names."""
    ext, ok = extension(name), F.lit(True)
    if exclude:
        ok = ok & ~ext.isin(*exclude)
    if include:
        ok = ok & ext.isin(*include)
    for h in hidden:
        ok = ok & ~F.startswith(name, F.lit(h))
    return ok


_LISTED = "path string, name string, length long, modified double"


#: Names that the driver lists itself; what is below the folders left then is listed by tasks, one level of folders a round.
DRIVER_NAMES = 10_000


def _entries(folder: str, wanted: Callable[[str, int], bool]) -> tuple[list[tuple[str, str, int, float]], list[str]]:
    """(files, folders) in a folder. Links to files count as files, links to folders as nothing; what can't be read or is gone by now is left out."""
    files, folders = [], []
    try:
        with os.scandir(folder) as found:
            for x in found:
                try:
                    if x.is_dir():
                        folders += [] if x.is_symlink() else [x.path]
                    elif wanted(x.name, (of := x.stat()).st_size):
                        files.append((x.path, x.name, of.st_size, of.st_mtime))
                except OSError:
                    continue
    except OSError:
        pass
    return files, folders


def _listing(spark: SparkSession, root: str, recursive: bool, wanted: Callable[[str, int], bool]) -> DataFrame:
    """Files below a folder: by the driver as long as they are few, else level by level in tasks, so that no process holds all names."""
    files, todo = [], deque([root])
    while todo and len(files) + len(todo) <= DRIVER_NAMES:
        own, below = _entries(todo.popleft(), wanted)
        files += own
        todo.extend(below if recursive else [])
    out = spark.createDataFrame(files, _LISTED)

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                own, below = _entries(folder, wanted)
                rows = [(*f, False) for f in own] + [(f, None, None, None, True) for f in below if recursive]
                for at in range(0, len(rows), 4096):
                    part = list(zip(*rows[at : at + 4096], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, (pa.string(), pa.string(), pa.int64(), pa.float64(), pa.bool_()), strict=True)], ["path", "name", "length", "modified", "folder"])

    folders = spark.createDataFrame([(f,) for f in todo], "path string")
    while todo:
        found = materialize(folders.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(level, f"{_LISTED}, folder boolean"), "listing")
        out = out.unionByName(found.where("not folder").drop("folder"))
        folders = found.where("folder").select("path")
        if folders.isEmpty():
            break
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents, one file at a time; null for a file that can't be read, which then is a failed document and not a missing one."""
    for batch in batches:
        for i, path in enumerate(batch.column(0).to_pylist()):
            try:
                with open(path, "rb") as f:
                    content = f.read()
            except OSError:
                content = None
            one = batch.slice(i, 1)
            yield pa.RecordBatch.from_arrays([*one.columns, pa.array([content], pa.binary())], [*one.schema.names, "content"])


def local_files(spark: SparkSession, cfg: dict[str, Any], last_run: Any = None) -> DataFrame:
    """Files under a folder that driver and executors see, listed with sizes and times and filtered first; only what is left is opened, in the tasks.

    Names that start with ``.`` or ``~$`` are hidden (``_`` is a name like others); ``max_bytes`` is without limit unless given.
    """
    root = cfg["path"].removeprefix("file://").rstrip("/")
    include, exclude, most = cfg.get("include", []), cfg.get("exclude", [".tmp", ".log"]), cfg.get("max_bytes")

    def wanted(name: str, size: int) -> bool:
        ext = f".{name.rpartition('.')[2].lower()}" if "." in name else ""
        return not name.startswith((".", "~$")) and ext not in exclude and (not include or ext in include) and (most is None or size <= most)

    files = _listing(spark, root, cfg.get("recursive", True), wanted)
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    if n:
        files = files.repartition(min(n, max(spark.sparkContext.defaultParallelism, size >> 26)))
    files = files.mapInArrow(_read, f"{_LISTED}, content binary")
    rel = F.substring("path", len(root) + 1, 2**31 - 1)
    return feed(files, "file", {"content": F.col("content"), "mime_type": mime_type(F.col("name")), "source_id": rel, "file_name": F.col("name"), "full_path": rel, "source_url": F.concat(F.lit("file:"), F.col("path")), "content_hash": content_hash(F.col("content")), "last_modified_at_source": F.timestamp_seconds("modified")})


def blobs(spark: SparkSession, cfg: dict[str, Any], last_run: Any = None) -> DataFrame:
    """Objects under a prefix: supported extensions, no hidden or empty ones, 50 MB at most, changed since the last run."""
    root = f"{cfg['path'].rstrip('/')}/{cfg.get('prefix', '')}".rstrip("/")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if last_run is not None:
        reader = reader.option("modifiedAfter", str(last_run).replace(" ", "T"))
    name = file_name(F.col("path"))
    # paths come with scheme and authority, as the file system itself names the root
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString().rstrip("/")
    rel = F.substring("path", len(base) + 2, 2**31 - 1)
    rows = reader.load(root).where(F.col("length").between(1, cfg.get("max_bytes", MAX_FILE_BYTES)) & allowed(name, cfg.get("include") or list(MIME), cfg.get("exclude", []), HIDDEN))
    return feed(rows, "file", {"content": F.col("content"), "mime_type": mime_type(name), "source_id": F.concat(F.lit(f"azureblob:{cfg.get('container', '')}:"), rel), "file_name": name, "full_path": F.concat(F.lit("/"), rel), "source_url": F.col("path"), "content_hash": content_hash(F.col("content")), "last_modified_at_source": F.col("modificationTime")})


def _quantiles(reader: Callable[[], Any], table: str, column: str, parts: int) -> list[str]:
    """SQL literals of values that cut a column's rows in ``parts`` of about equal size; fewer where values repeat."""
    n = reader().option("query", f"SELECT count({column}) AS n FROM {table}").load().first()[0]
    found = []
    for i in range(1, parts):
        at = f"SELECT {column} AS v FROM {table} WHERE {column} IS NOT NULL ORDER BY {column} OFFSET {i * n // parts} ROWS FETCH NEXT 1 ROWS ONLY"
        found += [r[0] for r in reader().option("query", at).load().collect()]  # one row
    quoted = lambda v: str(v) if isinstance(v, (int, float, decimal.Decimal)) else f"{{ts '{v}'}}" if isinstance(v, datetime.datetime) else f"{{d '{v}'}}" if isinstance(v, datetime.date) else "'" + str(v).replace("'", "''") + "'"
    return [quoted(v) for v in dict.fromkeys(found)]


def table_rows(spark: SparkSession, cfg: dict[str, Any], last_run: Any = None) -> DataFrame:
    """Rows of a table: a DataFrame, a Parquet path, or a JDBC table. Columns and the delta predicate reach the scan.

    A JDBC table is read in ``partitions`` ranges of ``partition_column`` (the key if not given) of about equal numbers of rows: their ends are values that the database is asked for, so neither
    skewed numbers nor strings make a range larger than its share. Rows without a value are in the first one.
    """
    table, key, delta = cfg["table"], cfg["primary_key"], cfg.get("delta_column")
    if "dataframe" in cfg:
        rows = cfg["dataframe"]
    elif "path" in cfg:
        rows = spark.read.parquet(cfg["path"])
    else:
        reader = lambda: spark.read.format("jdbc").options(**cfg["jdbc"])
        parts, column = cfg.get("partitions", 1), cfg.get("partition_column", key)
        ends = _quantiles(reader, table, column, parts) if parts > 1 else []
        if ends:
            bounds = [f"{column} < {ends[0]} OR {column} IS NULL", *(f"{column} >= {a} AND {column} < {b}" for a, b in zip(ends, ends[1:], strict=False)), f"{column} >= {ends[-1]}"]
            rest = {k: v for k, v in cfg["jdbc"].items() if k != "url"}
            rows = spark.read.jdbc(cfg["jdbc"]["url"], table, predicates=bounds, properties=rest)
        else:
            rows = reader().option("dbtable", table).load()
    names = list(dict.fromkeys([*(cfg.get("columns") or rows.columns), key, *([delta] if delta else [])]))
    names = [n for n in names if n not in cfg.get("exclude", [])]
    if delta and last_run is not None:
        rows = rows.where(F.col(delta) > F.lit(last_run))
    path = F.concat(F.lit(f"{table}/"), F.col(key).cast("string"))
    return feed(rows, "structured", {"structured_source_type": F.lit("sql"), "record": F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), "source_id": path, "file_name": path, "full_path": F.concat(F.lit("/"), path), "source_url": F.concat(F.lit("sql://"), path), "content_hash": row_hash({n: F.col(n) for n in names}), "last_modified_at_source": F.col(delta).cast("timestamp") if delta else F.lit(None).cast("timestamp"), "extra_metadata": F.create_map(F.lit("table_name"), F.lit(table), F.lit("primary_key"), F.col(key).cast("string"), F.lit("schema"), F.lit(cfg.get("schema", "")))})


def _stripped(value: Column, skip: list[str]) -> Column:
    """A JSON object without some of its top-level keys; as it is if it has none of them."""
    kept = F.map_filter(F.from_json(value, "map<string,variant>"), lambda k, v: ~k.isin(*skip))
    return F.when(F.exists(F.json_object_keys(value), lambda k: k.isin(*skip)), F.to_json(kept)).otherwise(value)


def json_records(spark: SparkSession, cfg: dict[str, Any], last_run: Any = None) -> DataFrame:
    """Documents of a collection, one JSON object a line. The text stays as it is but for ``skip_fields`` (``__v`` if not given), which neither the record nor its hash holds.

    ``filter_query``: values by JSON path (``status`` or ``$.a.b``; a list means any of them) that a document must have.
    """
    where = f"{cfg['database']}/{cfg['collection']}"
    rows = spark.read.text(cfg["path"]).where(F.rlike("value", F.lit(r"\S"))) if "path" in cfg else cfg["dataframe"].select(F.col(cfg["column"]).alias("value"))
    rows = rows.withColumn("id", F.coalesce(F.get_json_object("value", "$._id.$oid"), F.get_json_object("value", "$._id")))
    delta = F.get_json_object("value", f"$.{cfg['delta_field']}").cast("timestamp") if cfg.get("delta_field") else F.lit(None).cast("timestamp")
    rows = rows.withColumn("at", delta)
    if cfg.get("delta_field") and last_run is not None:
        rows = rows.where(F.col("at") > F.lit(last_run))
    for name, wanted in cfg.get("filter_query", {}).items():
        known = F.get_json_object("value", name if name.startswith("$") else f"$.{name}")
        rows = rows.where(known.isin(*[str(x).lower() if isinstance(x, bool) else str(x) for x in (wanted if isinstance(wanted, list) else [wanted])]))
    rows = rows.withColumn("value", _stripped(F.col("value"), cfg.get("skip_fields", ["__v"])))
    path = F.concat(F.lit(f"{where}/"), F.col("id"))
    meta = F.create_map(F.lit("database"), F.lit(cfg["database"]), F.lit("collection"), F.lit(cfg["collection"]), F.lit("document_id"), F.col("id"))
    return feed(rows, "structured", {"structured_source_type": F.lit("mongodb"), "record": F.col("value"), "source_id": path, "file_name": path, "full_path": F.concat(F.lit("/"), path), "source_url": F.concat(F.lit("mongodb://"), path), "content_hash": content_hash(F.col("value")), "last_modified_at_source": F.col("at"), "extra_metadata": meta})


DRIVE_ITEM = "id string, name string, path string, size long, eTag string, sha256 string, sha1 string, webUrl string, lastModified timestamp, folder boolean, deleted boolean, content binary"


def drive_items(items: DataFrame, cfg: dict[str, Any]) -> DataFrame:
    """A drive's delta items as a feed: folders go, deletions stay as such, the rest is filtered by folder, name, extension and size before contents are used.

    kind ``site``: folder names without regard to case, hash given by the drive or of the content; ``user``: exact folder names, paths
    without the root folder, supported extensions only, hash of eTag and size.
    """
    user = cfg.get("kind") == "user"
    root = "/" + cfg.get("root_folder", "").strip("/")
    listing = [F.col("listing")] if "listing" in items.columns else []
    # the mark at the end of a full listing
    mark = F.col("id").isNull() & listing[0].isNotNull() if listing else F.lit(False)
    rows = items.where(~F.coalesce(F.col("folder"), F.lit(False)))
    deleted = F.coalesce(F.col("deleted"), F.lit(False))
    path = F.concat(F.lit("/"), F.ltrim(F.coalesce(F.col("path"), F.lit("")), F.lit("/")))
    full = F.concat(F.when(path == "/", F.lit("")).otherwise(path), F.lit("/"), F.col("name"))
    inside = F.lit(True) if root == "/" else F.startswith(F.concat(path, F.lit("/")), F.lit(root + "/")) if user else F.startswith(F.lower(F.concat(path, F.lit("/"))), F.lit(root.lower() + "/"))
    include = cfg.get("include") or (list(MIME) if user else [])
    good = inside & allowed(F.col("name"), include, cfg.get("exclude", []), HIDDEN) & (F.col("size") <= cfg.get("max_bytes", MAX_FILE_BYTES)) & (F.col("name") != "root" if user else F.lit(True))
    rows = rows.where(deleted | F.coalesce(good, F.lit(False)) | mark)
    shown = F.substring(full, len(root) + 1, 2**31 - 1) if user and root != "/" else full
    digest = F.when(F.col("eTag").isNotNull(), etag_hash(F.col("eTag"), F.col("size"))).otherwise(content_hash(F.col("content"))) if user else F.coalesce("sha256", "sha1", content_hash(F.col("content")))
    keep = lambda c: F.when(~deleted, c)
    return feed(rows, "file", {"change": F.when(mark, "listed").when(deleted, "deleted").otherwise("upsert"), "content": keep(F.col("content")), "mime_type": keep(mime_type(F.col("name"))), "source_id": F.col("id"), "file_name": F.col("name"), "full_path": keep(shown), "source_url": F.col("webUrl"), "content_hash": keep(digest), "last_modified_at_source": F.col("lastModified")}, listing)


def drive(spark: SparkSession, cfg: dict[str, Any], last_run: Any = None) -> DataFrame:
    """A drive's delta pages: of the service itself (``url``, from ``token`` on; see ``drive.items`` for the next token), or as JSON files that a downloader has left."""
    if "url" in cfg:
        return drive_items(drive_service.items(spark, cfg, cfg.get("token"))[0].drop("listing").where("id is not null"), cfg)
    return drive_items(spark.read.schema(DRIVE_ITEM).json(cfg["path"]), cfg)


def paged_records(spark: SparkSession, cfg: dict[str, Any], last_run: Any = None) -> DataFrame:
    """Records of a table behind a paged HTTP interface (see ``paged``). The delta field is asked of the service, so unchanged records are never sent. ``keyset``: by ranges of the key instead of offsets."""
    table, key, delta = cfg["table"], cfg.get("primary_key", "sys_id"), cfg.get("delta_field", "sys_updated_on")
    spark.dataSource.register(PagedSource)
    options = {"url": cfg["url"], "pagesize": str(cfg.get("page_size", 500)), "headers": json.dumps(cfg.get("headers", {}))} | ({"key": key, "ranges": str(cfg.get("ranges", 8))} if cfg.get("keyset") else {})
    if last_run is not None:
        options |= {"query": cfg.get("delta_query", "{field}>{value}").format(field=delta, value=last_run)}
    rows = spark.read.format(PagedSource.name()).options(**options).load().select("record", F.get_json_object("record", f"$.{key}").alias("id"), F.get_json_object("record", f"$.{delta}").cast("timestamp").alias("at"))
    path = F.concat(F.lit(f"{table}/"), F.col("id"))
    return feed(rows, "structured", {"structured_source_type": F.lit("sql"), "record": F.col("record"), "source_id": path, "file_name": path, "full_path": F.concat(F.lit("/"), path), "source_url": F.concat(F.lit(cfg["url"].rstrip("/") + "/"), F.col("id")), "content_hash": content_hash(F.col("record")), "last_modified_at_source": F.col("at")})


SOURCES: dict[str, Callable[..., DataFrame]] = {"local": local_files, "sql": table_rows, "mongodb": json_records, "azure_blob": blobs, "sharepoint": drive, "onedrive": drive, "servicenow": paged_records}
#: What tells a source's changes: by hash only, by a time, or by the source's own feed with deletions.
NATIVE_DELETES = frozenset({"sharepoint", "onedrive"})
#: Keys of extra_metadata that each source gives, to be columns of its chunks.
EXTRAS = {"mongodb": ("database", "collection", "document_id"), "sql": ("table_name", "primary_key", "schema")}


def scan(spark: SparkSession, source_type: str, cfg: dict[str, Any], last_run: Any = None) -> DataFrame:
    kind = source_type.lower()
    if kind not in SOURCES:
        raise ValueError(f"unknown source type {source_type!r}; known: {', '.join(sorted(SOURCES))}")
    return SOURCES[kind](spark, {"kind": "user"} | cfg if kind == "onedrive" else cfg, last_run)
