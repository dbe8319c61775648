"""A data source for record tables behind HTTP that are read by offset: one page is one partition."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from email.message import Message

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ATTEMPTS = 3
TIMEOUT_SECONDS = 60


class Gone(RuntimeError):
    """The service no longer knows what the address names."""


def fetch(url: str, headers: dict[str, str] | None = None) -> tuple[bytes, Message]:
    """(body, headers) of an answer. Overload and faults of the service are tried again, after the pause it asks for; other refusals are final."""
    request = urllib.request.Request(url, headers=headers or {})
    for attempt in range(1, ATTEMPTS + 1):
        try:
            with urllib.request.urlopen(request, timeout=TIMEOUT_SECONDS) as answer:
                return answer.read(), answer.headers
        except urllib.error.HTTPError as e:
            if e.code == 410:
                raise Gone(url) from e
            if attempt == ATTEMPTS or e.code != 429 and e.code < 500:
                raise
            wait = e.headers.get("Retry-After") or ""
            time.sleep(float(wait) if wait.isdigit() else 2**attempt)
    raise AssertionError("unreachable")


class Page(InputPartition):
    """Records from ``offset``; ``last`` pages go on until the service has no more."""

    def __init__(self, offset: int, last: bool):
        super().__init__(offset)
        self.offset, self.last = offset, last


class Range(InputPartition):
    """Records with keys above ``after`` and up to ``upto``; None: without a bound."""

    def __init__(self, after: str | None, upto: str | None):
        super().__init__((after, upto))
        self.after, self.upto = after, upto


class PagedSource(DataSource):
    """Options: url, pagesize, query (the service's own filter), headers (a JSON object), key, ranges. Rows: ``record``, a JSON object each.

    The service answers ``{"result": [...]}`` and may tell a total in the header X-Total-Count. Without ``key``, pages are read by offset: in parallel with a total, by a single task without one; what is
    inserted meanwhile shifts them. With ``key``, a field of different values by which the service can sort, records are read in ``ranges`` ranges of about equal size, whose
    ends are keys that the service is asked for, and within a range by ``key > last`` in order of the key: so neither skew nor records that come or go between two pages lose or double one. A lost task reads its range again.
    """

    @classmethod
    def name(cls) -> str:
        return "tidemark_paged"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.size, self.query = options["url"], int(options.get("pagesize", "500")), options.get("query")
        self.headers = json.loads(options.get("headers", "{}"))
        self.key, self.ranges = options.get("key"), int(options.get("ranges", "8"))

    def _get(self, offset: int, limit: int, query: str | None = None) -> tuple[list[dict], str | None]:
        query = query or self.query
        asked = {"sysparm_offset": offset, "sysparm_limit": limit} | ({"sysparm_query": query} if query else {})
        body, headers = fetch(f"{self.url}?{urllib.parse.urlencode(asked)}", {"Accept": "application/json"} | self.headers)
        return json.loads(body)["result"], headers.get("X-Total-Count")

    def _within(self, after: str | None, upto: str | None) -> str:
        """The service's filter for a range, in order of the key."""
        parts = [self.query, f"{self.key}>{after}" if after is not None else None, f"{self.key}<={upto}" if upto is not None else None, f"ORDERBY{self.key}"]
        return "^".join(x for x in parts if x)

    def partitions(self) -> list[InputPartition]:
        total = self._get(0, 1)[1]
        if self.key:
            ends = []
            for i in range(1, self.ranges if total else 1):
                found = self._get(i * int(total) // self.ranges, 1, self._within(None, None))[0]
                ends += [str(found[0][self.key])] if found else []
            ends = list(dict.fromkeys(ends))
            return [Range(a, b) for a, b in zip([None, *ends], [*ends, None], strict=True)]
        if total is None:
            return [Page(0, True)]
        starts = range(0, max(int(total), 1), self.size)
        return [Page(at, at == starts[-1]) for at in starts]

    def read(self, partition: InputPartition) -> Iterator[tuple[str]]:
        if isinstance(partition, Range):
            yield from self._range(partition)
            return
        at = partition.offset
        while True:
            rows, _ = self._get(at, self.size)
            for r in rows:
                yield (json.dumps(r, ensure_ascii=False),)
            at += self.size
            if not partition.last or len(rows) < self.size:
                return

    def _range(self, partition: Range) -> Iterator[tuple[str]]:
        after = partition.after
        while True:
            rows, _ = self._get(0, self.size, self._within(after, partition.upto))
            for r in rows:
                yield (json.dumps(r, ensure_ascii=False),)
            if not rows:
                return
            last = str(rows[-1][self.key])
            if last == after:
                raise ValueError(f"{self.key} has the value {last!r} more than {self.size} times, so pages cannot go on behind it")
            after = last
