"""Bytes and records to Markdown, by loader. A failure is a status of its row."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import file_name, loader, stem
from tidemark.operators.calls import in_order
from tidemark.operators.render import records_markdown, row_records_markdown
from tidemark.sources import office

#: PDF bytes to the texts of their pages; given by the caller, as no PDF reader is at hand.
PdfExtractor = Callable[[bytes], list[str]]
#: Page images that hold too little text, to their texts.
Ocr = Callable[[bytes, int], str]
SPARSE_CHARS, SPARSE_SHARE, OCR_PAGES = 50, 0.5, 30
#: Images of a file in the order of their places.
IMAGES = "array<struct<place: int, label: string, otherwise: string, sha: string, content: binary>>"
_IMAGES = pa.list_(pa.struct([("place", pa.int32()), ("label", pa.string()), ("otherwise", pa.string()), ("sha", pa.string()), ("content", pa.binary())]))


def is_scanned(chars: list[int]) -> bool:
    """Whether more than half of the pages hold almost no text."""
    return sum(n < SPARSE_CHARS for n in chars) > SPARSE_SHARE * len(chars) if chars else False


def scanned_by_pages(pages: DataFrame, doc: list[str], text: str = "text") -> DataFrame:
    """The same where pages are rows."""
    sparse = F.avg((F.length(F.coalesce(F.col(text), F.lit(""))) < SPARSE_CHARS).cast("double"))
    return pages.groupBy(*doc).agg((sparse > SPARSE_SHARE).alias("is_scanned"))


def with_loader(docs: DataFrame) -> DataFrame:
    """``loader``, and status ``skipped`` where there is none."""
    got = docs.withColumn("loader", loader(F.col("content_type"), F.col("mime_type"), F.col("structured_source_type")))
    return got.withColumn("status", F.when(F.col("loader").isNull(), "skipped"))


def decode(content: Column) -> Column:
    """UTF-8 with replacement characters for what is not."""
    return F.make_valid_utf8(content.cast("string"))


def title(docs: DataFrame) -> Column:
    """Of a record: ``[schema.]table — key`` or ``[database.]collection — id`` from what its source tells of it, else from its id."""
    extra = lambda *names: F.coalesce(*[F.try_element_at("extra_metadata", F.lit(n)) for n in names]) if "extra_metadata" in docs.columns else F.lit(None).cast("string")
    place = F.concat(F.coalesce(F.concat(F.nullif(extra("schema", "database"), F.lit("")), F.lit(".")), F.lit("")), extra("table_name", "collection"))
    return F.coalesce(F.concat(place, F.lit(" — "), extra("primary_key", "document_id")), F.col("source_id"))


def load(docs: DataFrame, pdf: PdfExtractor | None = None, ocr: Ocr | None = None, repair: Callable[[str], str] | None = None, concurrency: int = 1, images: bool = False) -> DataFrame:
    """Documents with loader, markdown, status and error. content: bytes of files; record: JSON of structured ones.

    Rows go to the branch of their loader before anything runs, so Python sees office files and PDFs only. No loader, or a PDF without an
    extractor: skipped. No text, or a broken file: failed, with the reason. images: slides and documents have a column ``images`` more, for ``images.described``.
    """
    kinds_ = "markdown string, status string, error string" + (f", images {IMAGES}" if images else "")
    more = {"images": F.lit(None).cast(IMAGES)} if images else {}
    rows = with_loader(docs)
    none = F.lit(None).cast("string")
    text = rows.where("loader = 'text'").withColumns({"markdown": decode(F.col("content")), "error": none})
    records = [rows.where(F.col("loader") == kind).withColumn("markdown", render(title(rows), F.col("record"))) for kind, render in (("sql", row_records_markdown), ("mongodb", records_markdown))]
    flat = records[0].unionByName(records[1]).withColumn("error", F.when(F.col("markdown").isNull(), "no fields"))
    lost = rows.where("loader is null").withColumns({"markdown": none, "error": none})

    def parse(kind: str, content: bytes, name: str) -> tuple[str | None, str | None, str | None, list[dict]]:
        found: list[office.Image] | None = [] if images else None
        got = markdown(kind, content, name, found)
        numbered = enumerate(found or ()) if got[0] is not None else ()
        return *got, [{"place": i, "label": x.label, "otherwise": x.otherwise, "sha": hashlib.sha256(x.content).hexdigest() if x.content else None, "content": x.content or None} for i, x in numbered]

    def markdown(kind: str, content: bytes, name: str, found: list[office.Image] | None) -> tuple[str | None, str | None, str | None]:
        try:
            if kind == "xlsx":
                return office.workbook(content, name), None, None
            if kind == "pptx":
                return office.slides(content, found), None, None
            if kind == "docx":
                got, complex_ = office.document(content, found)
                return (repair(got) if complex_ and repair else got), None, None
            if pdf is None:
                return None, "skipped", None
            pages = pdf(content)
            if ocr and is_scanned([len(p) for p in pages]):
                pages = [ocr(content, i) if i < OCR_PAGES and len(p) < SPARSE_CHARS else p for i, p in enumerate(pages)]
            got = "\n\n".join(p.strip() for p in pages if p.strip())
            return (got, None, None) if got else (None, "failed", "no text in the file")
        except Exception as e:  # any broken file is a failed row
            return None, "failed", f"{type(e).__name__}: {e}"

    @F.arrow_udf(kinds_)
    def run(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for kinds, contents, names in parts:
            # hooks may wait for services; ``parse`` raises nothing
            got = [x for x, _ in in_order(zip(kinds.to_pylist(), contents.to_pylist(), names.to_pylist(), strict=True), lambda x: parse(*x), concurrency if pdf or ocr or repair else 1)]
            names = ["markdown", "status", "error", *(["images"] if images else [])]
            yield pa.array([dict(zip(names, g[: len(names)], strict=True)) for g in got], pa.struct([(n, pa.string() if n != "images" else _IMAGES) for n in names]))

    office_rows = rows.where("loader in ('xlsx', 'pptx', 'docx', 'pdf')").withColumn("_p", run.asNondeterministic()(F.col("loader"), F.col("content"), stem(file_name(F.col("full_path")))))
    office_rows = office_rows.withColumns({"status": F.col("_p.status"), "markdown": F.col("_p.markdown"), "error": F.col("_p.error")} | ({"images": F.col("_p.images")} if images else {})).drop("_p")
    done = text.unionByName(flat).unionByName(lost).withColumns(more).unionByName(office_rows) if images else text.unionByName(flat).unionByName(lost).unionByName(office_rows)
    return done.withColumn("status", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("status")))
