"""A drive's changes as a data source whose offset is the delta link.

A drive lists its items in pages: each names the next one, the last names the link that will list what changes later. A page is a partition; the driver follows the links,
tasks read the items and their contents. As a stream, a batch ends at a link, and Spark's checkpoint is where it is kept: a batch that was not finished is listed again between the same two links. A link that
has expired (410) starts a full listing, whose items carry its number and whose end is marked, so that what it no longer holds can be found.
"""

from __future__ import annotations

import datetime
import http.client
import json
import urllib.parse
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.sources.paged import Gone, fetch

SCHEMA = "id string, name string, path string, size long, eTag string, sha256 string, sha1 string, webUrl string, lastModified timestamp, folder boolean, deleted boolean, content binary, listing string"


@dataclass
class ItemPage(InputPartition):
    """One page; listing: the number of the full listing that it belongs to, if any; last: its end is the listing's."""

    url: str
    listing: int | None
    last: bool


def walk(position: dict, root: str, headers: dict[str, str], limit: int | None = None, until: str | None = None) -> tuple[list[ItemPage], dict, bool]:
    """(pages from a position on, the position behind them, whether they hold an item). A position: ``link`` ('': none yet), ``listing`` and whether it is ``within`` that full listing.

    Ends at a delta link, after ``limit`` pages, or where the next link is ``until``.
    """
    link, listing, within = position["link"], position["listing"], position["within"]
    if not link:
        link, within, listing = root, True, listing + 1
    pages, filled = [], False
    while True:
        try:
            found = json.loads(fetch(link, headers)[0])
        except Gone:
            if link == root:
                raise
            link, within, listing, pages, filled = root, True, listing + 1, [], True
            continue
        after = found.get("@odata.nextLink") or found.get("@odata.deltaLink") or link
        ends = not found.get("@odata.nextLink")
        pages.append(ItemPage(link, listing if within else None, within and ends))
        filled = filled or within or bool(found.get("value"))
        within = within and not ends
        link = after
        if ends or link == until or len(pages) == limit:
            return pages, {"link": link, "listing": listing, "within": within}, filled


class DriveSource(DataSource):
    """Options: url (the full listing's first page), headers (a JSON object), maxbytes, maxpages (of a batch; none if not given), start (a position as JSON)."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_drive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DriveReader:
        return DriveReader(dict(self.options))

    def streamReader(self, schema) -> DriveStream:
        return DriveStream(dict(self.options))


class _Pages:
    def __init__(self, options: dict[str, str]):
        self.url, self.headers = options["url"], json.loads(options.get("headers", "{}"))
        self.most = int(options.get("maxbytes", str(50 << 20)))
        self.limit = int(options["maxpages"]) if "maxpages" in options else None
        self.position = json.loads(options["start"]) if options.get("start") else {"link": "", "listing": 0, "within": False}

    def read(self, partition: ItemPage) -> Iterator[tuple]:
        listing = None if partition.listing is None else str(partition.listing)
        for item in json.loads(fetch(partition.url, self.headers)[0]).get("value", []):
            if item.get("id"):
                yield (*self._row(item), listing)
        if partition.last:
            yield (*[None] * 12, listing)

    def _row(self, item: dict[str, Any]) -> tuple:
        file, parent = item.get("file", {}), item.get("parentReference", {}).get("path", "")
        hashes, deleted, folder = file.get("hashes", {}), "deleted" in item, "folder" in item
        path = urllib.parse.unquote(parent.partition("root:")[2]) or "/"
        at = item.get("lastModifiedDateTime")
        at = datetime.datetime.fromisoformat(at.replace("Z", "+00:00")) if at else None
        content = None
        where = item.get("@microsoft.graph.downloadUrl")
        if where and not deleted and not folder and item.get("size", 0) <= self.most:
            try:
                content = fetch(where)[0]
            except (Gone, OSError, http.client.HTTPException):
                pass  # a document without content is a failed one, not a missing one
        return (item["id"], item.get("name"), path, item.get("size"), item.get("eTag"), hashes.get("sha256Hash"), hashes.get("sha1Hash"), item.get("webUrl"), at, folder, deleted, content)


class DriveReader(_Pages, DataSourceReader):
    """All pages from the start position to the delta link."""

    def partitions(self) -> list[ItemPage]:
        return walk(self.position, self.url, self.headers)[0]


class DriveStream(_Pages, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.known: tuple[dict, dict, list[ItemPage]] | None = None

    def initialOffset(self) -> dict:
        return self.position

    def latestOffset(self) -> dict:
        pages, end, filled = walk(self.position, self.url, self.headers, self.limit)
        if not filled:
            return self.position
        self.known = (self.position, end, pages)
        return end

    def partitions(self, start: dict, end: dict) -> list[ItemPage]:
        if self.known and self.known[:2] == (start, end):
            pages = self.known[2]
        else:  # a batch of a stream that was stopped within it
            pages = walk(start, self.url, self.headers, until=end["link"])[0]
        self.position, self.known = end, None
        return pages

    def commit(self, end: dict) -> None:
        """Nothing to let go: the service keeps what a link needs."""


def position_of(spark: SparkSession, checkpoint: str) -> str:
    """The position that a stream's checkpoint ends with, as JSON; empty for a new stream."""
    try:
        last = spark.read.text(f"{checkpoint}/offsets", wholetext=True).select("value", F.regexp_extract(F.input_file_name(), r"([0-9]+)$", 1).cast("long").alias("n")).orderBy(F.desc("n")).first()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return ""
        raise
    return next((x for x in last.value.splitlines() if x.startswith('{"link"')), "") if last else ""


def _options(cfg: dict[str, Any], start: str) -> dict[str, str]:
    named = {"url": cfg["url"], "headers": json.dumps(cfg.get("headers", {})), "start": start, "maxbytes": str(cfg.get("max_bytes", 50 << 20))}
    return named | ({"maxpages": str(cfg["max_pages"])} if "max_pages" in cfg else {})


def items_stream(spark: SparkSession, cfg: dict[str, Any], checkpoint: str) -> DataFrame:
    """Items as a stream that goes on where ``checkpoint`` ends."""
    spark.dataSource.register(DriveSource)
    return spark.readStream.format(DriveSource.name()).options(**_options(cfg, position_of(spark, checkpoint))).load()


def items(spark: SparkSession, cfg: dict[str, Any], token: str | None = None) -> tuple[DataFrame, str]:
    """(items since a token, all without one; the token to use next time once these have been applied)."""
    spark.dataSource.register(DriveSource)
    options = _options(cfg, token or "")
    end = walk(DriveReader(options).position, cfg["url"], cfg.get("headers", {}))[1]
    return spark.read.format(DriveSource.name()).options(**options).load(), json.dumps(end)
