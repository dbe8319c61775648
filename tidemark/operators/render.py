"""Rows and records as Markdown. Flat rows stay inside the JVM; nested records need an Arrow UDF for their recursion."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.values import SKIP_FIELDS


def cell(c: Column) -> Column:
    return F.coalesce(F.replace(c.cast("string"), F.lit("|"), F.lit("\\|")), F.lit("_null_"))


def row_markdown(table: Column, key: Column, fields: dict[str, Column], schema: Column | None = None) -> Column:
    """A heading and a table of columns and values, nulls as ``_null_``; lists come in as text, comma-joined."""
    heading = F.concat(F.lit("## "), F.coalesce(F.concat(schema, F.lit(".")), F.lit("")) if schema is not None else F.lit(""), table, F.lit(" — "), key.cast("string"))
    rows = [F.concat(F.lit(f"| {name} | "), cell(c), F.lit(" |")) for name, c in fields.items()]
    return F.concat_ws("\n", heading, F.lit(""), F.lit("| Column | Value |"), F.lit("| --- | --- |"), *rows)


def record_block(key: Column, fields: dict[str, Column], descriptions: dict[str, str] | None = None, skip: tuple[str, ...] = SKIP_FIELDS) -> Column:
    """The alternate style: ``**name**: value`` lines with descriptions in italics; null as a dash, booleans as Yes and No."""
    lines = [F.concat(F.lit("## Record: "), key.cast("string")), F.lit("")]
    for name, c in fields.items():
        if name not in skip:
            lines.append(F.concat(F.lit(f"**{name}**: "), F.coalesce(c.cast("string"), F.lit("—"))))
            if (descriptions or {}).get(name):
                lines.append(F.lit(f"*{descriptions[name]}*"))
    return F.concat_ws("\n", *lines)


def batch_markdown(rows: DataFrame, table: str, block: Column, order: str, by: list[str] | None = None) -> DataFrame:
    """All blocks of a table, or of each group, under one heading; meant for small groups, whose text is one document anyway."""
    got = rows.select(*(by or []), F.struct(F.col(order).alias("o"), block.alias("b")).alias("r")).groupBy(*(by or [])).agg(F.sort_array(F.collect_list("r")).alias("r"))
    return got.select(*(by or []), F.concat(F.lit(f"# Table: {table}\n\n"), F.array_join(F.transform("r", lambda x: x.b), "\n\n")).alias("markdown"))


def pairs_prose(names: Column, values: Column, context: Column | None = None) -> Column:
    """``Name: value | Name: value`` of two arrays: empty values go, a blank name leaves the bare value; a context stands in front."""
    one = lambda n, v: F.when(F.trim(v) == "", F.lit(None)).otherwise(F.when(F.trim(n) == "", F.trim(v)).otherwise(F.concat(F.trim(n), F.lit(": "), F.trim(v))))
    body = F.array_join(F.filter(F.zip_with(names, F.slice(values, F.lit(1), F.size(names)), one), lambda x: x.isNotNull()), " | ")
    return body if context is None else F.when(body != "", F.concat(context, F.lit(" — "), body)).otherwise(body)


#: Levels below a top-level key that are written out, items of a list that are, and characters of what lies deeper.
MAX_DEPTH, MAX_ITEMS, MAX_JSON = 3, 20, 200
_TOP_SKIPPED = ("_id", "__v")


def _scalar(v: object) -> str:
    return "_null_" if v is None else str(v).lower() if isinstance(v, bool) else str(v)


def _bullets(v: object, depth: int) -> list[str]:
    """Bullets of a nested value; objects in lists are numbered items, lists in lists one line each."""
    pad = "  " * (depth - 1) + "- "
    if depth > MAX_DEPTH:
        return [pad + json.dumps(v, default=str)[:MAX_JSON]]
    if isinstance(v, dict):
        named = [(f"**{k}**:", x, isinstance(x, (dict, list))) for k, x in v.items() if k not in _TOP_SKIPPED]
        more = 0
    else:
        named = [(f"Item {n}:" if isinstance(x, dict) else "", x, isinstance(x, dict)) for n, x in enumerate(v[:MAX_ITEMS], 1)]
        more = len(v) - MAX_ITEMS
    out = []
    for label, x, deep in named:
        out += [pad + label, *_bullets(x, depth + 1)] if deep else [pad + f"{label} {_scalar(x)}".lstrip()]
    return [*out, f"{pad}_... {more} more items_"] if more > 0 else out


def _object(record: str | None) -> dict | None:
    try:
        value = json.loads(record) if record else None
    except ValueError:
        return None
    return value if isinstance(value, dict) and value else None


def record_markdown(title: str, record: str | None) -> str | None:
    """A JSON object as Markdown: scalars under ``### Fields``, a section for each nested key. Null, empty or no object: null."""
    value = _object(record)
    if value is None:
        return None
    value = {k: v for k, v in value.items() if k not in _TOP_SKIPPED}
    nested = {k: v for k, v in value.items() if isinstance(v, (dict, list))}
    flat = [f"- **{k}**: {_scalar(v)}" for k, v in value.items() if k not in nested]
    parts = [[f"## {title}"], *([["### Fields", "", *flat]] if flat else []), *([f"### {k}", "", *_bullets(v, 1)] for k, v in nested.items())]
    return "\n\n".join("\n".join(p) for p in parts) + "\n"


def row_record_markdown(title: str, record: str | None) -> str | None:
    """The same of a table's row, in the form of ``row_markdown``: lists comma-joined. Null, empty or no object: null."""
    value = _object(record)
    if value is None:
        return None
    shown = lambda v: "_null_" if v is None else ", ".join(map(str, v)) if isinstance(v, list) else str(v) if isinstance(v, dict) else _scalar(v).replace("|", "\\|")
    return "\n".join([f"## {title}", "", "| Column | Value |", "| --- | --- |", *(f"| {k} | {shown(v)} |" for k, v in value.items())])


@F.arrow_udf(StringType())
def records_markdown(title: pa.Array, record: pa.Array) -> pa.Array:
    return pa.array([record_markdown(t, r) for t, r in zip(title.to_pylist(), record.to_pylist(), strict=True)], pa.string())


@F.arrow_udf(StringType())
def row_records_markdown(title: pa.Array, record: pa.Array) -> pa.Array:
    return pa.array([row_record_markdown(t, r) for t, r in zip(title.to_pylist(), record.to_pylist(), strict=True)], pa.string())
