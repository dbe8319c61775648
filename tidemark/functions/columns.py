"""Column expressions used by several operators; all run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import LOADER_OF_MIME, MIME, NOISE_WORDS, OCTETS
from tidemark.plans.config import MetadataField


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    """Lower-cased, with its dot; empty without one."""
    return F.when(F.contains(name, F.lit(".")), F.concat(F.lit("."), F.lower(F.substring_index(name, ".", -1)))).otherwise(F.lit(""))


def mime_type(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair])
    return F.coalesce(F.try_element_at(table, extension(name)), F.lit(OCTETS))


def loader(content_type: Column, mime: Column, structured: Column) -> Column:
    """Loader of a file by MIME type, of a record by its source type; null where there is none."""
    table = F.create_map(*[F.lit(x) for pair in LOADER_OF_MIME.items() for x in pair])
    return F.when(content_type == "file", F.try_element_at(table, mime)).when(content_type == "structured", F.when(structured.isin("sql", "mongodb"), structured))


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def row_hash(fields: dict[str, Column]) -> Column:
    """Of a record: its fields in name order, null kept apart from empty. Hashes are compared among themselves only."""
    parts = [F.concat(F.lit(k + "="), F.coalesce(F.concat(F.lit("s"), c.cast("string")), F.lit("n"))) for k, c in sorted(fields.items())]
    return F.sha2(F.concat_ws("\u0001", *parts).cast("binary"), 256)


def etag_hash(etag: Column, size: Column) -> Column:
    return F.sha2(F.concat(etag, size.cast("string")).cast("binary"), 256)


def stem(name: Column) -> Column:
    """Before the last dot, unless that is the first character."""
    return F.regexp_replace(name, r"(?s)^(.+)\.[^.]*$", "$1")


def folders(path: Column) -> Column:
    """Non-empty parts without the last, but for a lone part, which stays."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.when(F.size(parts) > 1, F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1)))).otherwise(parts)


def segment(path: Column, index: int) -> Column:
    """Of the folders; negative from the end; null out of range."""
    return F.try_element_at(folders(path), F.lit(index + 1 if index >= 0 else index))


def metadata(schema: list[MetadataField], path: Column, name: Column) -> dict[str, Column]:
    """Columns of a declarative schema, in its order. A computed field sees those before it; fields without a name or source are left out."""
    out: dict[str, Column] = {}
    for f in schema:
        if not f.field_name or not f.source:
            continue
        default = F.lit(f.default)
        if f.source == "path_segment":
            value = F.coalesce(segment(path, f.segment), default)
        elif f.source == "file_name":
            value = F.when(F.contains(name, F.lit(".")), F.regexp_replace(name, r"(?s)\.[^.]*$", "")).otherwise(name)
        elif f.source == "path_segment_equals":
            value = F.when(F.coalesce(segment(path, f.segment), F.lit("")) == f.equals, f.true_value).otherwise(F.lit(f.false_value))
        elif f.source == "computed" and f.formula:
            names = re.findall(r"\{(\w+)\}", f.formula)
            value, ok = F.lit(f.formula), F.lit(True)
            for n in dict.fromkeys(names):
                known = out.get(n, F.lit(None).cast("string"))
                ok = ok & known.isNotNull() & ~known.isin("", "unknown")
                value = F.replace(value, F.lit("{" + n + "}"), known)
            value = F.when(F.coalesce(ok, F.lit(False)), value).otherwise(default)
        else:
            value = default
        out[f.field_name] = value
    return out


def meaningful(c: Column) -> Column:
    low = F.lower(strip(c))
    return F.coalesce(~low.isin("", *NOISE_WORDS) & (F.length(low) > 1) & ~F.rlike(low, F.lit(r"^\p{Nd}+$")), F.lit(False))


def readable_stem(name: Column) -> Column:
    """``_`` and ``-`` as spaces, white space collapsed; null if one character or less is left."""
    text = strip(F.regexp_replace(F.regexp_replace(stem(name), "[_-]", " "), r"(?U)\s+", " "))
    return F.when(F.length(text) > 1, text)


def heading(h1: Column, h2: Column, h3: Column) -> Column:
    """The first of h2, h1, h3 that is meaningful and has 80 characters at most."""
    good = lambda h: F.when(meaningful(h) & (F.length(strip(h)) <= 80), strip(h))
    return F.coalesce(good(h2), good(h1), good(h3))


def prefix(values: list[Column], name: Column, h1: Column, h2: Column, h3: Column) -> Column:
    """``[value | value | stem | heading]``: three meaningful values at most, then stem and heading unless there already; empty string if nothing is left."""
    kept = F.slice(F.filter(F.array(*[v.cast("string") for v in values]), meaningful), 1, 3) if values else F.array().cast("array<string>")
    kept = F.transform(kept, strip)
    add = lambda parts, x: F.when(x.isNotNull() & ~F.array_contains(parts, F.coalesce(x, F.lit(""))), F.concat(parts, F.array(x))).otherwise(parts)
    parts = add(add(kept, readable_stem(name)), heading(h1, h2, h3))
    return F.when(F.size(parts) > 0, F.concat(F.lit("["), F.array_join(parts, " | "), F.lit("]"))).otherwise(F.lit(""))


def section_path(h1: Column, h2: Column, h3: Column, h4: Column) -> Column:
    got = F.concat_ws(" > ", *[F.when(h != "", h) for h in (h1, h2, h3, h4)])
    return F.when(got != "", got).otherwise(F.lit("Document body"))


def breadcrumb(text: Column, h1: Column, h2: Column, h3: Column) -> Column:
    """Up to three headings above the text, unless it starts with just these."""
    crumb = F.concat_ws("\n", *[F.when(h != "", F.concat(F.lit("#" * (n + 1) + " "), h)) for n, h in enumerate((h1, h2, h3))])
    return F.when((crumb == "") | F.startswith(text, crumb), text).otherwise(F.concat(crumb, F.lit("\n"), text))


def table_like(text: Column) -> Column:
    return F.contains(text, F.lit(" | ")) & F.contains(text, F.lit(": "))
