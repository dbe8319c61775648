"""Markdown tables inside a text as prose, one line a row: a scan over lines that needs what it has written so far, hence an Arrow UDF."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.operators.batches import by_bytes

MAX_COLUMNS = 4
_RULE = re.compile(r"^\|[\s\-|:]+\|$")


def _is_row(line: str) -> bool:
    s = line.strip()
    return len(s) > 2 and s[0] == s[-1] == "|" and "|" in s[1:-1]


def _is_rule(line: str) -> bool:
    return bool(_RULE.match(line.strip()))


def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def _context(out: list[str]) -> tuple[str, int | None]:
    """The caption: the nearest plain line above, however far, even behind a nearer heading; the nearest heading where there is none. And where it stands."""
    heading: tuple[str, int | None] = "", None
    for i in range(len(out) - 1, -1, -1):
        s = out[i].strip()
        if not s or s.startswith("*") and s.endswith("*") or " | " in s and ":" in s:
            continue
        if not s.startswith("#"):
            return s, i
        if heading[1] is None:
            heading = s.lstrip("#").strip(), i
    return heading


def tables_to_prose(text: str | None, keep_context: bool = False) -> str | None:
    """Tables of up to four columns become ``context — Header: cell | Header: cell`` lines, the caption line goes blank.

    Wider tables and tables without body rows stay, and lose their caption unless ``keep_context``. Null stays null.
    """
    if text is None:
        return None
    lines, out, i = text.split("\n"), [], 0
    while i < len(lines):
        if not _is_row(lines[i]):
            out.append(lines[i])
            i += 1
            continue
        block = []
        while i < len(lines) and (_is_row(lines[i]) or _is_rule(lines[i])):
            block.append(lines[i])
            i += 1
        rows = [c for c in (_cells(x) for x in block if not _is_rule(x)) if any(c)]
        context, at = _context(out)
        if rows and len(rows[0]) <= MAX_COLUMNS and len(rows) > 1:
            head, made = rows[0], []
            for row in rows[1:]:
                pairs = [f"{h}: {c}" if h else c for h, c in zip(head, row, strict=False) if c]
                if pairs:
                    made.append((f"{context} — " if context else "") + " | ".join(pairs))
        else:
            made = block
        if made and at is not None and not (keep_context and made is block):
            out[at] = ""
        out += made
    return "\n".join(out)


@F.arrow_udf(StringType())
def to_prose(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in (x for text in texts for x in by_bytes(text)):
        yield pa.array([tables_to_prose(t) for t in part.to_pylist()], pa.string())
