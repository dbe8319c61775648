import datetime
import hashlib
import http.server
import io
import json
import threading
import urllib.parse
import zipfile
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import chunk, delta, embed, enrich, jobs, load, render, retrieve, tables
from tidemark.operators.store import ChunkStore, Conflict, bins_of, duplicates
from tidemark import storage
from tidemark.plans import ingest, search
from tidemark.plans.config import ApiConfig, FilterRequest, MetadataField, RetrievalConfig, merge_settings, resolve_api
from tidemark.plans.ingest import Plan, run, run_job
from tidemark.sources import office, scan
from tidemark.streaming.ingest import RegistryTable, apply_stream

KEY = ("t", "r")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_table_examples():
    assert tables.tables_to_prose("# Team\nContacts\n| Role | Name |\n|---|---|\n| Primary | Ann |\n| Backup | |") == "# Team\n\nContacts — Role: Primary | Name: Ann\nContacts — Role: Backup"
    assert tables.tables_to_prose("Para\n\n# H\n| a | b |\n| 1 | 2 |") == "\n\n# H\nPara — a: 1 | b: 2"
    assert tables.tables_to_prose("# G\n# H\n| a | b |\n| 1 | 2 |") == "# G\n\nH — a: 1 | b: 2"
    wide = "# T\n| a | b | c | d | e |\n|---|---|---|---|---|\n| 1 | 2 | 3 | 4 | 5 |"
    assert tables.tables_to_prose(wide) == wide.replace("# T", "", 1) and tables.tables_to_prose(wide, keep_context=True) == wide
    assert tables.tables_to_prose("## h\n| Column | Value |\n|---|---|\n| name | x\\|y |") == "\nh — Column: name | Value: x\\"
    assert tables.tables_to_prose(None) is None and tables.tables_to_prose("a | b") == "a | b"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab #\n.", max_size=300), st.integers(5, 60), st.integers(0, 30))
def test_chunks_cover_the_text_and_keep_their_size(text, size, overlap):
    overlap = min(overlap, size - 1)
    seen = set()
    for c in chunk.split(text, size, overlap):
        assert 0 < len(c["text"]) <= size and text[c["start_index"] :].startswith(c["text"])
        seen |= set(range(c["start_index"], c["start_index"] + len(c["text"])))
    assert all(ch.isspace() or i in seen for i, ch in enumerate(text))


def test_chunk_headings_and_breadcrumb(spark):
    docs = spark.createDataFrame([(1, "intro\n# A\ntext a\n## B\nfoo\n# C\nbar"), (2, "  \n"), (3, None)], "doc int, markdown string")
    got = chunk.chunk(docs).orderBy("chunk_index").collect()
    assert [(x.h1, x.h2, x.text, x.chunk_total) for x in got] == [(None, None, "intro", 4), ("A", None, "# A\ntext a", 4), ("A", "B", "# A\n## B\n## B\nfoo", 4), ("C", None, "# C\nbar", 4)]


def test_prefix_examples(spark):
    p = lambda vals, name, *h: one(spark, C.prefix([F.lit(v) for v in vals], F.lit(name), *[F.lit(x).cast("string") for x in h]))
    assert p(["App A", "D1"], "Ops_Runbook.docx", None, "Contacts", None) == "[App A | D1 | Ops Runbook | Contacts]"
    assert p(["general", "12", "x", None], "Ops_Runbook.docx", None, "Contacts", None) == "[Ops Runbook | Contacts]"
    assert p([], "a.md", None, None, None) == ""
    assert p(["Ops Runbook"], "Ops-Runbook.md", "H" * 81, None, None) == "[Ops Runbook]"


CASES = [("root/D1/App A/general/x.docx", "D1", "App A", "general", "false", "App A::general"), ("root/D1/App A/restricted/y.docx", "D1", "App A", "restricted", "false", "App A::restricted"), ("Policy.pdf", "general", "general", "general", "false", "general::general")]
SCHEMA = [MetadataField("domain", "path_segment", 1, "general"), MetadataField("application", "path_segment", 2, "general"), MetadataField("access_group", "path_segment", 3, "general"), MetadataField("is_general", "path_segment_equals", 1, equals="general"), MetadataField("access_key", "computed", formula="{application}::{access_group}", default="unknown::unknown"), MetadataField(None, "static"), MetadataField("odd", "nonsense")]


def test_metadata_schema(spark):
    rows = spark.createDataFrame([(c[0],) for c in CASES], "full_path string")
    got = {x.full_path: x for x in enrich.custom(rows, SCHEMA).collect()}
    for path, *want in CASES:
        x = got[path]
        assert [x.domain, x.application, x.access_group, x.is_general, x.access_key, x.odd] == [*want, "unknown"]
    assert one(spark, F.coalesce(C.segment(F.lit("/a/b/c.md"), -3), F.lit("-"))) == "-"


def test_decisions_and_deletes(spark):
    reg = spark.createDataFrame([(*KEY, "same", "h", "active"), (*KEY, "old", "h", "active"), (*KEY, "back", "h", "deleted"), (*KEY, "gone", "h", "active"), (*KEY, "null", None, "active")], "tenant_id string, repo_id string, source_id string, content_hash string, status string")
    seen = spark.createDataFrame([(*KEY, i, h) for i, h in (("same", "h"), ("old", "x"), ("back", "h"), ("fresh", "h"), ("null", None))], "tenant_id string, repo_id string, source_id string, content_hash string")
    got = {x.source_id: x.decision for x in delta.decide(seen, reg).collect()}
    assert got == {"same": "unchanged", "old": "changed", "back": "unchanged", "fresh": "new", "null": "unchanged"}
    assert {x.source_id: x.decision for x in delta.decide(seen, reg, revive_deleted=True).collect()}["back"] == "new"
    assert [x.source_id for x in delta.implicit_deletes(reg, seen).collect()] == ["gone"]
    assert delta.implicit_deletes(reg, seen, full_listing=False).count() == 0
    forced = delta.force_reingest(reg, F.col("source_id") == "same")
    assert {x.source_id: x.decision for x in delta.decide(seen, forced).collect()}["same"] == "changed"


def test_job_stats_example(spark):
    res = spark.createDataFrame([("new", 3, 0), ("updated", 2, 5), ("skipped", 0, 0), ("failed", 0, 0)], "status string, chunks_created int, chunks_deleted int")
    x = jobs.stats(res, spark.createDataFrame([(4,)], "chunks_deleted int")).first()
    assert tuple(x) == (4, 1, 1, 1, 1, 1, 5, 9, "partial")
    now = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, jobs.duration(now("2024-01-01 00:00:00"), now("2024-01-01 00:15:25.9"))) == 925
    roll = jobs.rollup_stats(spark.createDataFrame([("a", "x"), ("a", "y")], "tenant_id string, repo_id string")).collect()
    assert {(r.tenant_id, r.repo_id): r.documents_scanned for r in roll}[None, None] == 2


def test_settings_merge():
    s = merge_settings({"chunk_size": 0, "chunk_overlap": 10, "contextual_enrichment_enabled": False}, {"chunk_size": 512, "contextual_enrichment_enabled": True}, "m")
    assert (s.chunk_size, s.chunk_overlap, s.contextual, s.embedding_batch_size) == (512, 10, False, 512)
    assert merge_settings(None, {"contextual_enrichment_enabled": True}).contextual is False
    assert resolve_api(ApiConfig("k"), ApiConfig("d", "u"), ApiConfig("o", "o", "o")) == (ApiConfig("k", "u", "o"), True)


def test_record_markdown():
    got = render.record_markdown("d.c — 1", '{"_id": 1, "ok": true, "n": null, "s": "x", "d": {"__v": 1, "a": [1, {"b": {"c": {"e": 1}}}, [2, "z"]]}, "l": %s}' % list(range(22)))
    assert got == "\n".join(
        ["## d.c — 1", "", "### Fields", "", "- **ok**: true", "- **n**: _null_", "- **s**: x", "", "### d", "", "- **a**:", "  - 1", "  - Item 2:", "    - **b**:", '      - {"c": {"e": 1}}', "  - [2, 'z']", "", "### l", "", *(f"- {i}" for i in range(20)), "- _... 2 more items_", ""]
    )
    assert all(render.record_markdown("t", x) is None and render.row_record_markdown("t", x) is None for x in ("[1]", None, "{bad", "{}"))
    assert render.row_record_markdown("s.t — 2", '{"a": "x|y", "b": null, "c": [1, "z"], "d": 1.50}') == "## s.t — 2\n\n| Column | Value |\n| --- | --- |\n| a | x\\|y |\n| b | _null_ |\n| c | 1, z |\n| d | 1.5 |"


def packed(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
BOOK = packed({
    "xl/workbook.xml": f'<workbook {REL}><sheets><sheet name="People" r:id="a"/><sheet name="Secret" state="hidden" r:id="b"/><sheet name="README" r:id="b"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<R><Relationship Id="a" Type="x/worksheet" Target="worksheets/s1.xml"/><Relationship Id="b" Type="x/worksheet" Target="/xl/worksheets/s1.xml"/></R>',
    "xl/sharedStrings.xml": "<sst><si><t>Quarterly report</t></si><si><r><t>Na</t></r><r><t>me</t></r></si><si><t>Score</t></si></sst>",
    "xl/worksheets/_rels/s1.xml.rels": '<R><Relationship Id="h" Type="x/hyperlink" Target="http://a.b" TargetMode="External"/></R>',
    "xl/worksheets/s1.xml": f'<worksheet {REL}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2" t="s"><v>2</v></c></row><row r="4"><c r="A4" t="inlineStr"><is><t>Ann</t></is></c><c r="B4"><v>12</v></c><c r="C4" t="inlineStr"><is><t>here</t></is></c></row><row r="5"/></sheetData><mergeCells><mergeCell ref="A4:A5"/></mergeCells><hyperlinks><hyperlink ref="C4" r:id="h"/></hyperlinks></worksheet>',
})
DECK = packed({
    "ppt/presentation.xml": f'<p {REL}><sldIdLst><sldId r:id="s"/></sldIdLst></p>',
    "ppt/_rels/presentation.xml.rels": '<R><Relationship Id="s" Type="x/slide" Target="slides/s1.xml"/></R>',
    "ppt/slides/_rels/s1.xml.rels": '<R><Relationship Id="n" Type="x/notesSlide" Target="../notes/n1.xml"/></R>',
    "ppt/slides/s1.xml": '<s><sp><ph type="title"/><p><t>Plan</t></p></sp><sp><p><t>One</t></p><p><pPr lvl="1"/><t>Two</t></p></sp><pic><cNvPr name="Logo"/></pic><tbl><tr><tc><t>a</t></tc><tc><t>b</t></tc></tr></tbl></s>',
    "ppt/notes/n1.xml": '<s><sp><ph type="body"/><p><t>Say this</t></p></sp></s>',
})
W = 'xmlns:w="http://w"'
TEXT = packed({"word/document.xml": f'<d {W}><body><p><pPr><pStyle w:val="Heading2"/></pPr><t>Head</t></p><p><t>Body</t></p><p><pPr><numPr><ilvl w:val="1"/></numPr></pPr><t>item</t></p><tbl><tr><tc><p><t>x|y</t></p></tc></tr></tbl></body></d>'})


def test_office_files():
    assert office.workbook(BOOK, "q1") == "# q1\n\n## People\n\nName: Ann | Score: 12 | [Link](http://a.b)\nName: Ann"
    assert office.slides(DECK) == "## Slide 1 — Plan\n\n- One\n  - Two\n[Image: Logo]\n\n| a | b |\n| --- | --- |\n\n\n> Say this"
    assert office.document(TEXT) == ("## Head\n\nBody\n\n  - item\n\n| x\\|y |\n| --- |", False)
    assert office.header_row([["Quarterly report", ""], ["Name", "Score"], ["Ann", "12"]]) == 1
    assert [office.letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_load_routes_and_reports(spark):
    rows = [("file", C.MIME[".xlsx"], None, BOOK, "/a/q1.xlsx", None), ("file", C.MIME[".docx"], None, b"broken", "/b.docx", None), ("file", "text/plain", None, b"ok \xff", "/c.txt", None), ("file", C.MIME[".pdf"], None, b"%PDF", "/d.pdf", None), ("file", "text/html", None, b"<p>", "/e.html", None), ("structured", None, "mongodb", None, "/f", '{"a": 1}'), ("structured", None, "sql", None, "/g", "nothing")]
    docs = spark.createDataFrame([(*r[:5], r[5], r[4]) for r in rows], "content_type string, mime_type string, structured_source_type string, content binary, full_path string, record string, source_id string")
    got = {x.full_path: (x.status, x.markdown) for x in load.load(docs).collect()}
    assert got["/a/q1.xlsx"][1].startswith("# q1") and got["/b.docx"][0] == "failed" and got["/c.txt"] == (None, "ok �")
    assert got["/d.pdf"][0] == got["/e.html"][0] == "skipped" and got["/f"] == (None, "## /f\n\n### Fields\n\n- **a**: 1\n") and got["/g"][0] == "failed"
    pages = lambda c: ["", "x" * 60, ""]
    assert load.load(docs.where("mime_type like '%pdf'"), pages, lambda c, i: f"page {i}").first().markdown == "page 0\n\n" + "x" * 60 + "\n\npage 2"
    assert load.is_scanned([10, 60]) is False and load.is_scanned([10, 20, 60]) is True


def test_contextualise_guards(spark):
    rows = [("d", i, t, None, None, None, None) for i, t in enumerate(["plain", "a | b: c", "x | y: z"])]
    chunks = spark.createDataFrame(rows, "doc string, chunk_index int, text string, h1 string, h2 string, h3 string, h4 string")
    model = lambda b: [None if "x |" in t else "  " + "word " * 200 for t in b["text"]]
    got = {x.chunk_index: x.text for x in enrich.contextualise(chunks, model, ["doc"], tables_only=True).collect()}
    assert got[0] == "plain" and got[2] == "x | y: z" and got[1] == ("word " * 100) + "\n\na | b: c"

    def fails(b):
        raise RuntimeError

    assert {x.text for x in enrich.contextualise(chunks, fails, ["doc"]).collect()} == {"plain", "a | b: c", "x | y: z"}


APPS = ["Alpha One", "Beta", "Gamma"]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(a, g, f"{a}::{g}") for a in [*APPS, "Forbidden"] for g in ("general", "restricted")]
    return spark.createDataFrame(rows, "application string, access_group string, access_key string")


@pytest.mark.parametrize(("must", "should", "auto", "question", "want"), [
    ([f"{a}::general" for a in APPS], APPS, True, "what of AO?", {"Alpha One::general"}),
    (["Beta::general", "Beta::restricted", "Gamma::general"], APPS, True, "beta please", {"Beta::general", "Beta::restricted"}),
    ([f"{a}::general" for a in APPS], APPS, True, "nothing named", {f"{a}::general" for a in APPS}),
    (["Alpha One::general", "Beta::general"], ["Alpha One", "Beta"], True, "tell me of Forbidden", {"Alpha One::general", "Beta::general"}),
    (["Alpha One::general"], [], False, "Beta", {"Alpha One::general"}),
])
def test_access_matrix_never_leaks(corpus, must, should, auto, question, want):
    config = RetrievalConfig(filterable_fields=("access_key", "application"))
    request = FilterRequest({"access_key": must}, {"application": should} if should else {}, auto)
    got = {x.access_key for x in corpus.where(retrieve.predicate(request, config, question)).collect()}
    assert got == want and got <= set(must)
    assert corpus.where(retrieve.predicate(request, RetrievalConfig(filterable_fields=("application",)), question)).count() == 0


def test_extraction_from_known_values(corpus):
    known = {x.field: [] for x in retrieve.known_values(corpus, ["application"]).collect()} | {"application": [*APPS, "Forbidden"]}
    p = retrieve.predicate(FilterRequest(auto_extract=True), RetrievalConfig(filterable_fields=("application",)), "gamma?", known)
    assert {x.application for x in corpus.where(p).collect()} == {"Gamma"}
    with pytest.raises(ValueError):
        retrieve.scoped(corpus, "", ["r"])


def test_rerank(spark):
    rows = spark.createDataFrame([(i, "t" * i, float(i % 10)) for i in range(60)], "id int, text string, score double")
    assert retrieve.rerank_candidates(rows, 2, "id").count() == 20 and retrieve.rerank_candidates(rows, 50, "id").count() == 30
    got = retrieve.rerank(rows, 3, "id", lambda pdf: pdf["text"].str.len().astype(float)).collect()
    assert len(got) == 3 and got[0].score >= got[-1].score
    assert [x.id for x in retrieve.rerank(rows, 2, "id", lambda pdf: 1 / 0).collect()] == [x.id for x in retrieve.rerank(rows, 2, "id").collect()] == [9, 19]


def test_embedding_is_stable(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None), (4, "")], "id int, text string")
    got = {x.id: x.embedding for x in embed.embed(docs, embed.HashingProvider(dimensions=16), batch=1).collect()}
    assert got[1] == got[2] and len(got[1]) == 16 and got[3] is None and sum(got[4]) == 0
    assert embed.HashingProvider("x-small").dimensions == 1536 and embed.HashingProvider("x").dimensions == 3072


def test_four_runs(spark, tmp_path):
    folder = tmp_path / "files"
    (folder / "en").mkdir(parents=True)
    for n in range(3):
        (folder / "en" / f"f{n}.md").write_text(f"# Title {n}\n" + "words and more " * 120)
    (folder / "en" / "page.html").write_text("<p>no loader</p>")
    (folder / "en" / "~$lock.md").write_text("hidden")
    store, reg = ChunkStore(spark, str(tmp_path / "store")), spark.createDataFrame([], delta.REGISTRY)
    plan = Plan("t", "r", schema=[MetadataField("lang", "path_segment", 0)], provider=embed.HashingProvider(dimensions=8))
    now = F.lit("2024-01-01").cast("timestamp")

    def go(n):
        nonlocal reg
        reg, stats = run(scan.scan(spark, "Local", {"path": str(folder)}), reg, store, plan, f"job{n}", now)
        return stats.first()

    first = go(1)
    assert (first.documents_new, first.documents_skipped, first.documents_failed, first.status) == (3, 1, 0, "completed")
    chunks = store.read("t", "r")
    total = chunks.count()
    assert total == first.chunks_created > 3 and duplicates(chunks).isEmpty()
    x = chunks.where("chunk_index = 0").orderBy("source_id").first()
    assert x.text.startswith("[en | f0 | Title 0]\n# Title 0\n") and x.lang == "en" and len(x.embedding) == 8
    second = go(2)
    assert (second.documents_new, second.documents_updated, second.documents_skipped) == (0, 0, 4)
    (folder / "en" / "f1.md").write_text("# Title 1\nshort now")
    third = go(3)
    assert (third.documents_updated, third.documents_skipped) == (1, 3) and third.chunks_deleted == total // 3
    (folder / "en" / "f2.md").unlink()
    fourth = go(4)
    assert (fourth.documents_deleted, fourth.documents_scanned) == (1, 3)
    assert {y.source_id for y in store.read("t", "r").select("source_id").distinct().collect()} == {"/en/f0.md", "/en/f1.md"}
    assert {y.source_id: y.status for y in reg.collect()} == {"/en/f0.md": "active", "/en/f1.md": "active", "/en/f2.md": "deleted"}


def test_run_writes_what_changed(spark, tmp_path):
    words = lambda n, v: hashlib.sha256(f"{n} {v}".encode()).hexdigest() * 40
    kind = "id string, text string"

    def feed(rows, name):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        return scan.feed(docs, "file", {"content": F.col("text").cast("binary"), "mime_type": F.lit("text/plain"), "source_id": F.col("id"), "file_name": F.col("id"), "full_path": F.concat(F.lit("/"), F.col("id")), "source_url": F.col("id"), "content_hash": C.content_hash(F.col("text"))})

    shared = Path(storage.shared_dir(spark)) / "tidemark"
    sizes = lambda: {str(f): f.stat().st_size for d in (shared, tmp_path) for f in d.rglob("*") if f.is_file()}
    plan, now = Plan("t", "r", provider=embed.HashingProvider(dimensions=8)), F.lit("2024-01-01").cast("timestamp")
    store, reg = ChunkStore(spark, str(tmp_path / "store")), RegistryTable(spark, str(tmp_path / "registry"), whole_every=2)
    rows = {f"d{n}": words(n, 0) for n in range(300)}
    _, stats = run(feed(list(rows.items()), "in1"), reg, store, plan, "j1", now)
    assert stats.first().documents_new == 300
    first = feed([*rows.items(), ("extra", words(1, 1))], "in2")
    run(first, reg, store, plan, "j2", now)
    assert reg.versions() == [(0, False), (1, True)]
    rows |= {"d7": words(7, 1), "d8": "now short"}
    del rows["d9"]
    source = feed([*rows.items(), ("extra", words(1, 1))], "in3")
    before, held = sizes(), sum(len(t) for t in rows.values())
    written = []
    write = DataFrameWriter.parquet
    with pytest.MonkeyPatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: (write(self, path, *a, **b), written.append(sum(f.stat().st_size for f in Path(path).rglob("*") if f.is_file())))[0])
        after, stats = run(source, reg, store, plan, "j3", now)
    got = stats.first()
    assert (got.documents_updated, got.documents_skipped, got.documents_deleted, got.documents_failed) == (2, 298, 1, 0)
    # what was unchanged is in no table that the run wrote, intermediate ones included, but for keys and hashes
    assert len(written) > 8 and sum(written) < held / 4
    assert {x.source_id: (x.content_hash, x.status) for x in after.collect()} == {n: (hashlib.sha256(t.encode()).hexdigest(), "active") for n, t in {**rows, "extra": words(1, 1)}.items()} | {"d9": (hashlib.sha256(words(9, 0).encode()).hexdigest(), "deleted")}
    assert {x.source_id for x in store.read().select("source_id").distinct().collect()} == {*rows, "extra"} and store.read("t", "r").where("source_id = 'd8'").count() == 1
    left = {f.split("/tidemark/")[1].split("-")[0] for f in sizes() if f not in before and "/tidemark/" in f}
    assert left == {"stats"}


def test_a_document_that_changes_while_it_is_read_fails_for_this_run(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.md").write_text("one")
    (tmp_path / "f" / "b.md").write_text("two")
    feed = scan.scan(spark, "local", {"path": str(tmp_path / "f")})
    real, store = ingest.changed_contents, ChunkStore(spark, str(tmp_path / "s"))

    def slow(*args):
        (tmp_path / "f" / "b.md").write_text("three")
        return real(*args)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(ingest, "changed_contents", slow)
        reg, stats = run(feed, spark.createDataFrame([], delta.REGISTRY), store, Plan("t", "r", provider=embed.HashingProvider(dimensions=4)), "j", F.lit("2024-01-01").cast("timestamp"))
    assert (stats.first().documents_new, stats.first().documents_failed, stats.first().status) == (1, 1, "partial")
    assert [x.source_id for x in reg.collect()] == [x.source_id for x in store.read().collect()] == ["/a.md"]


def test_registry_is_met_where_it_lies(spark, tmp_path):
    kinds = [x.strip().split(" ") for x in delta.REGISTRY.split(",")]
    given = {"tenant_id": F.lit("t"), "repo_id": F.lit("r"), "source_id": F.col("id").cast("string"), "status": F.lit("active")}
    rows = lambda a, b, h: spark.range(a, b).select(*[(given | {"content_hash": F.lit(h)}).get(n, F.lit(None)).cast(k).alias(n) for n, k in kinds])
    reg = RegistryTable(spark, str(tmp_path / "reg"), whole_every=2, bucket_rows=1000)
    reg.write(rows(0, 3000, "0"), 0)
    reg.write(rows(2990, 3100, "1"), 1)
    assert len(list((tmp_path / "reg" / "1-whole-4").glob("*.parquet"))) == 4  # one a bucket
    reg.write(rows(10, 20, "2"), 2)
    rows(0, 3200, "x").write.parquet(str(tmp_path / "scan"))
    scanned = spark.read.parquet(str(tmp_path / "scan"))
    assert {(x.content_hash, x.n) for x in reg.rows_of(scanned).groupBy("content_hash").agg(F.count("*").alias("n")).collect()} == {("0", 2980), ("1", 110), ("2", 10)}
    assert reg.absent(rows(0, 3000, ""), F.lit(True)).count() == 100
    assert {(x.source_id, x.content_hash) for x in reg.rows_of(rows(8, 12, "")).collect()} == {("8", "0"), ("9", "0"), ("10", "2"), ("11", "2")}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plan in (reg.rows_of(scanned), reg.absent(scanned, F.lit(True))):
            text = plan._jdf.queryExecution().executedPlan().toString()
            at = text.index("tidemark_registry_")
            # from the registry's scan up to the union or the root: sorts and joins, no exchange
            depth, above = [len(x) - len(x.lstrip(" :+-")) for x in text.splitlines()], []
            line = text[:at].count("\n")
            for i in range(line, -1, -1):
                if depth[i] < depth[line] or i == line:
                    line = i
                    above.append(text.splitlines()[i])
            assert "Bucketed: true" in text and not any("Exchange" in x for x in above)
        reg.write(rows(5, 6, "3"), 3)
        assert reg.versions()[-1] == (3, True) and reg.read().count() == 3100 and len(list((tmp_path / "reg" / "3-whole-4").glob("*.parquet"))) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_run_uses_rows_hooks_extras_and_context(spark, tmp_path):
    table = spark.createDataFrame([(1, "pipes | here", None), (2, "plain", 3)], "id int, v string, n int")
    feed = scan.scan(spark, "sql", {"table": "items", "primary_key": "id", "dataframe": table, "schema": "s"}).unionByName(scan.scan(spark, "mongodb", {"database": "d", "collection": "c", "dataframe": spark.createDataFrame([('{"_id": 5, "a": "b"}',)], "j string"), "column": "j"}))
    pdf = feed.limit(1).withColumns({"content_type": F.lit("file"), "mime_type": F.lit("application/pdf"), "structured_source_type": F.lit(None).cast("string"), "source_id": F.lit("p"), "full_path": F.lit("/p.pdf"), "file_name": F.lit("p.pdf"), "content": F.lit(b"%PDF"), "content_hash": F.lit("h")})
    settings = merge_settings({"contextual_enrichment_enabled": True, "contextual_enrichment_mode": "all_chunks"}, None, "m")
    plan = Plan(*KEY, settings=settings, provider=embed.HashingProvider(dimensions=4), pdf=lambda b: ["page one " * 9], context=lambda b: ["This chunk is part of a record."] * len(b), extras=("table_name", "database"))
    store = ChunkStore(spark, str(tmp_path / "s"))
    _, stats = run(feed.unionByName(pdf), spark.createDataFrame([], delta.REGISTRY), store, plan, "j", F.lit("2024-01-01").cast("timestamp"))
    assert stats.first().documents_new == 4
    got = {x.source_id: x for x in store.read().collect()}
    head = "s.items — 1 — Column: "
    assert got["items/1"].text == f"[items]\nThis chunk is part of a record.\n\n{head}id | Value: 1\n{head}v | Value: pipes \\\n{head}n | Value: _null_"
    assert (got["items/1"].table_name, got["items/1"].database, got["d/c/5"].database) == ("items", None, "d")
    assert "## d.c — 5" in got["d/c/5"].text and got["p"].text.endswith("page one") and "This chunk" in got["p"].text


def test_sources(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", datetime.datetime(2024, 1, 1), "x"), (2, None, datetime.datetime(2024, 2, 1), "y")], "id int, v string, at timestamp, drop string")
    cfg = {"table": "t", "primary_key": "id", "delta_column": "at", "dataframe": rows, "exclude": ["drop"]}
    got = scan.scan(spark, "sql", cfg, datetime.datetime(2024, 1, 15)).collect()
    assert [(x.source_id, x.full_path, x.source_url) for x in got] == [("t/2", "/t/2", "sql://t/2")] and '"v":null' in got[0].record and "drop" not in got[0].record
    (tmp_path / "docs.json").write_text('{"_id": {"$oid": "abc"}, "u": "2024-03-01T00:00:00Z"}\n\n{"_id": 7, "u": "2023-01-01T00:00:00Z"}\n')
    got = scan.scan(spark, "mongodb", {"database": "d", "collection": "c", "path": str(tmp_path / "docs.json"), "delta_field": "u"}, datetime.datetime(2024, 1, 1)).collect()
    assert [x.source_id for x in got] == ["d/c/abc"] and got[0].extra_metadata["document_id"] == "abc"
    blob = tmp_path / "blob" / "sub"
    blob.mkdir(parents=True)
    for name, data in (("a.txt", "x"), ("empty.txt", ""), ("$h.txt", "x"), ("b.exe", "x")):
        (blob / name).write_text(data)
    assert [x.source_id for x in scan.scan(spark, "azure_blob", {"path": str(tmp_path / "blob"), "container": "c"}).collect()] == ["azureblob:c:sub/a.txt"]
    with pytest.raises(ValueError, match="unknown source"):
        scan.scan(spark, "ftp", {})


def test_local_listing_filters_before_it_reads(spark, tmp_path):
    for name in ("_part.md", "a.md", ".hid.md", "~$x.md", "big.tmp", "sub/b.TXT", "sub/_dir/c.md", "long.md"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name * (100 if name == "long.md" else 1))
    (tmp_path / "big.tmp").chmod(0)
    (tmp_path / "gone.md").symlink_to(tmp_path / "nowhere")
    got = {x.source_id: x for x in scan.scan(spark, "local", {"path": str(tmp_path), "max_bytes": 100}).collect()}
    assert set(got) == {"/_part.md", "/a.md", "/sub/b.TXT", "/sub/_dir/c.md"} and got["/sub/b.TXT"].mime_type == "text/plain" and bytes(got["/a.md"].content) == b"a.md"
    assert {x.source_id for x in scan.scan(spark, "local", {"path": str(tmp_path), "recursive": False, "include": [".md"]}).collect()} == {"/_part.md", "/a.md", "/long.md"}
    assert scan.scan(spark, "local", {"path": str(tmp_path), "include": [".none"]}).count() == 0


def test_document_store_filters_and_skips(spark, tmp_path):
    lines = ['{"_id": 1, "s": "on", "n": {"k": 5}, "__v": 3, "x": 1.50}', '{"_id": 2, "s": "off", "n": {"k": 5}}', '{"_id": 3, "s": "on", "n": {"k": 6}, "secret": "q"}', '{"_id": 4, "s": "on", "n": {"k": 5}}']
    (tmp_path / "c.json").write_text("\n".join(lines))
    cfg = {"database": "d", "collection": "c", "path": str(tmp_path / "c.json")}
    got = {x.source_id: json.loads(x.record) for x in scan.scan(spark, "mongodb", {**cfg, "filter_query": {"s": "on", "$.n.k": [5, 7]}}).collect()}
    assert got == {"d/c/1": {"_id": 1, "s": "on", "n": {"k": 5}, "x": 1.5}, "d/c/4": json.loads(lines[3])}
    got = scan.scan(spark, "mongodb", {**cfg, "skip_fields": ["secret", "n"]}).where("source_id = 'd/c/3'").first()
    assert json.loads(got.record) == {"_id": 3, "s": "on"}


def test_store_versions_conflicts_and_vacuum(spark, tmp_path):
    kind = "tenant_id string, repo_id string, source_id string, chunk_index int, text string"
    row = lambda r, s, t="007": (t, r, s, 0, f"{r}{s}")
    store = ChunkStore(spark, str(tmp_path / "s"))
    assert store.read() is None and store.vacuum() == 0
    store.replace(spark.createDataFrame([row("a", "1"), row("b", "1"), row("a/b=c", "1", "x y")], kind))
    store.replace(spark.createDataFrame([(*row("a", "2"), 5)], kind + ", more int"))
    assert sorted((x.tenant_id, x.repo_id, x.source_id, x.more) for x in store.read().collect()) == [("007", "a", "1", None), ("007", "a", "2", 5), ("007", "b", "1", None), ("x y", "a/b=c", "1", None)]
    assert store.vacuum() == 0 and store.read().count() == 4
    seen = store.last()
    one, other = (spark.createDataFrame([row(r, "9")], kind) for r in ("a", "z"))
    store.replace(one)
    with pytest.raises(Conflict):
        store.replace(one, seen=seen)
    store.replace(other, seen=seen)
    assert store.read("007", "z").count() == 1 and store.read("007", "a").count() == 3


def tree(path):
    return {str(f): f.stat().st_size for f in path.rglob("*.parquet")}


def test_store_writes_what_changed_and_readers_keep_their_snapshot(spark, tmp_path):
    kind = "tenant_id string, repo_id string, source_id string, chunk_index int, text string"
    store = ChunkStore(spark, str(tmp_path / "s"), checkpoint_every=3)
    text = lambda s, v: hashlib.sha256(f"{s}-{v}".encode()).hexdigest() * 20
    chunks = lambda docs, v, n=3: spark.createDataFrame([("t", r, str(s), i, text(s, v)) for r in ("a", "b") for s in docs for i in range(n)], kind)
    store.replace(chunks(range(400), 0).coalesce(1))
    whole = sum(tree(tmp_path).values())
    want = {(r, str(s), i): text(s, 0) for r in ("a", "b") for s in range(400) for i in range(3)}
    held = lambda df: {(x.repo_id, x.source_id, x.chunk_index): x.text for x in df.collect()}
    snapshots = [(store.last(), dict(want))]
    for n in range(1, 8):
        before = tree(tmp_path)
        docs = [n, n + 1, 400 + n]
        gone = spark.createDataFrame([("t", "a", str(n + 100)), ("t", "a", "unknown")], "tenant_id string, repo_id string, source_id string")
        store.replace(chunks(docs, n, 2).coalesce(1), gone)
        want = {k: v for k, v in want.items() if int(k[1]) not in docs and k[:2] != ("a", str(n + 100))} | {(r, str(s), i): text(s, n) for r in ("a", "b") for s in docs for i in range(2)}
        now = tree(tmp_path)
        assert all(now[f] == size for f, size in before.items())
        assert sum(size for f, size in now.items() if f not in before and ".checkpoint" not in f) < whole / 10
        assert held(store.read()) == want
        snapshots.append((store.last(), dict(want)))
    for n, rows in snapshots:
        assert held(store.read(upto=n)) == rows
    assert "Join" not in ChunkStore(spark, store.path).read(upto=1)._jdf.queryExecution().executedPlan().toString()
    files = store.files().count()
    assert store.compact(small=1 << 20, target=1 << 20) > 2 and held(store.read()) == want and store.files().count() < files
    assert held(store.read(upto=snapshots[-1][0])) == want and store.compact(small=1, target=1) == 0
    assert "Join" not in store.read()._jdf.queryExecution().executedPlan().toString()
    assert store.vacuum() > 0 and store.vacuum() == 0 and held(store.read()) == want
    assert store.delete(spark.createDataFrame([("t", "a", "1"), ("t", "b", "nobody")], "tenant_id string, repo_id string, source_id string")) == 2
    assert held(store.read()) == {k: v for k, v in want.items() if k[:2] != ("a", "1")}


def test_compaction_is_in_nobodys_way_but_keeps_what_came_meanwhile(spark, tmp_path):
    kind = "tenant_id string, repo_id string, source_id string, chunk_index int, text string"
    row = lambda s, text: spark.createDataFrame([("t", "r", s, 0, text)], kind)
    store = ChunkStore(spark, str(tmp_path / "s"))
    store.replace(row("a", "1"))
    store.replace(row("b", "1"))
    seen = store.last()
    assert store.compact() == 3
    store.replace(row("a", "2"), seen=seen)
    assert sorted((x.source_id, x.text) for x in store.read().collect()) == [("a", "2"), ("b", "1")]
    lines = store._lines(store.last(), store.last() - 1).where("kind = 'data'").collect()
    with pytest.raises(Conflict):
        store._publish([x.asDict() for x in lines], seen, "compact")
    assert bins_of([("a", 5), ("b", 4), ("c", 3), ("d", 9)], 8) == [["d"], ["a", "c"], ["b"]]


def test_job_error_is_an_outcome(spark, tmp_path):
    reg = spark.createDataFrame([(*KEY, "s", *[None] * 10)], delta.REGISTRY)

    def broken():
        raise OSError("no route")

    got, stats = run_job(broken, reg, ChunkStore(spark, str(tmp_path)), Plan(*KEY), "j", F.current_timestamp())
    assert got is reg and (stats.first().status, stats.first().error, stats.first().documents_scanned) == ("failed", "OSError: no route", 0)


def test_registry_versions_hold_changes_only(spark, tmp_path):
    reg = RegistryTable(spark, str(tmp_path / "reg"), whole_every=3)
    row = lambda s, h: spark.createDataFrame([(*KEY, s, "j", *[None] * 4, h, *[None] * 3, "active")], delta.REGISTRY)
    for n, (s, h) in enumerate([("a", "1"), ("b", "1"), ("a", "2"), ("c", "1"), ("a", "3")]):
        reg.write(row(s, h), n)
        reg.write(row(s, h), n)
    assert [n for n, whole in reg.versions() if whole] == [2] and reg.version() == 4
    assert {x.source_id: x.content_hash for x in reg.read().collect()} == {"a": "3", "b": "1", "c": "1"}
    assert {x.source_id: x.content_hash for x in reg.read(2).collect()} == {"a": "2", "b": "1"}


def test_scratch_tables_go_and_kept_ones_stay(spark):
    rows = spark.range(3)
    with storage.scratch(spark):
        gone, kept = storage.materialize(rows, "gone"), storage.written(storage.materialize(rows, "step"), storage.fresh(spark, "kept"))
        assert gone.count() == 3
    assert kept.count() == 3 and storage.materialize(rows, "later").count() == 3
    with pytest.raises(Exception, match="NOT_EXIST|not exist|NOT_FOUND"):
        gone.count()


def test_bm25_terms_of_any_script(spark):
    docs = spark.createDataFrame([(1, "Das ist für Sie"), (2, "f und r"), (3, "слово здесь"), (4, None)], "id int, text string")
    assert [x.id for x in retrieve.bm25(docs, "FÜR", 5, "id").collect()] == [1] and [x.id for x in retrieve.bm25(docs, "Слово", 5, "id").collect()] == [3]


def test_header_rules():
    assert office.header_row([["Name", "http://a.b"], ["Name", "Score"]]) == 1 and office.header_row([["12", "13"]]) is None
    assert office.header_row([["a", "b"], ["a", "b"]]) == 0 and office.header_row([["x" * 61, "y" * 61], ["only", ""]]) is None


def test_drive_feeds(spark):
    base = {"path": "/Docs/Sub", "size": 10, "eTag": "e", "sha256": "s", "sha1": None, "webUrl": "w", "folder": False, "deleted": None, "content": bytearray(b"c"), "lastModified": None}
    rows = [{**base, "id": "1", "name": "a.md"}, {**base, "id": "2", "name": "a.md", "path": "/docs"}, {**base, "id": "3", "name": "a.exe"}, {**base, "id": "4", "name": "big.md", "size": 99 << 20}, {**base, "id": "5", "name": None, "deleted": True}, {**base, "id": "6", "name": "d", "folder": True}, {**base, "id": "7", "name": "o.md", "path": "/Docs2"}]
    items = spark.createDataFrame(rows, scan.DRIVE_ITEM)
    site = {x.source_id: x for x in scan.drive_items(items, {"root_folder": "Docs"}).collect()}
    assert set(site) == {"1", "2", "3", "5"} and site["5"].change == "deleted" and site["1"].content_hash == "s" and site["1"].full_path == "/Docs/Sub/a.md"
    user = {x.source_id: x for x in scan.drive_items(items, {"root_folder": "Docs", "kind": "user"}).collect()}
    assert set(user) == {"1", "5"} and user["1"].full_path == "/Sub/a.md" and user["1"].content_hash not in ("s", None)


def test_stream_decides_by_batches(spark, tmp_path):
    kind = "tenant_id string, repo_id string, source_id string, change string, content_hash string, last_modified_at_source timestamp"
    day = lambda n: datetime.datetime(2024, 1, n)
    reg = RegistryTable(spark, str(tmp_path / "reg"))

    def go(rows):
        spark.createDataFrame([("t", "r", *x) for x in rows], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = apply_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), reg, str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination()
        return {(x.source_id, x.decision) for x in spark.read.parquet(str(tmp_path / "out")).where(F.col("batch") == reg.version()).collect()}

    assert go([("a", "upsert", "1", day(1)), ("a", "upsert", "2", day(2)), ("b", "upsert", "1", day(1)), ("z", "deleted", None, day(1))]) == {("a", "new"), ("b", "new")}
    assert go([("a", "upsert", "2", day(3)), ("b", "deleted", None, day(3))]) == {("a", "unchanged"), ("b", "deleted")}
    assert {x.source_id: x.status for x in reg.read().collect()} == {"a": "active", "b": "deleted"}


class Letters:
    """Vectors by counts of two letters."""

    model_name, dimensions = "letters", 2

    def embed_documents(self, texts):
        return np.array([[t.count("a") + 1e-3, t.count("b") + 1e-3] for t in texts])


def test_search_stays_in_scope_and_fuses(spark):
    rows = [("t", "r1", "s1", 0, "aaa ab", "Alpha One"), ("t", "r1", "s1", 1, "bbb zebra", "Beta"), ("t", "r2", "s2", 0, "abab", "Alpha One"), ("t", "r2", "s2", 1, "aa zebra", "Beta"), ("t", "r3", "s3", 0, "aaaa", "Alpha One"), ("u", "r1", "s4", 0, "aaaa", "Alpha One")]
    chunks = embed.embed(spark.createDataFrame(rows, "tenant_id string, repo_id string, source_id string, chunk_index int, text string, application string"), Letters())
    plain = RetrievalConfig(filterable_fields=("application",))
    key = lambda d: [(x.repo_id, x.chunk_index) for x in d.collect()]
    got = search.search(chunks, "t", {"r1": plain, "r2": plain}, "aaa", Letters(), 2)
    assert key(got) == [("r1", 0), ("r2", 1)] and search.KEY in got.columns
    named = search.search(chunks, "t", {"r1": plain, "r2": plain}, "aaa of AO?", Letters(), 5, FilterRequest(auto_extract=True))
    assert key(named) == [("r1", 0), ("r2", 0)]
    assert key(search.search(chunks, "t", {"r1": plain}, "a", Letters(), 5, FilterRequest(must={"owner": ["x"]}))) == []
    hybrid = RetrievalConfig(filterable_fields=("application",), hybrid_enabled=True, hybrid_alpha=0.1)
    mixed = search.search(chunks, "t", {"r1": hybrid, "r2": hybrid}, "zebra a", Letters(), 2)
    assert sorted(key(mixed)) == [("r1", 1), ("r2", 1)]
    again = search.search(chunks, "t", {"r1": plain, "r2": plain}, "aaa", Letters(), 1, scorer=lambda pdf: pdf["text"].str.count("b").astype(float))
    assert [x.text for x in again.collect()] == ["bbb zebra"]
    assert search.answer(got, "q?", lambda p: p.rsplit("Question: ")[1]) == "q?" and search.answer(got.where("false"), "q", str) is None and search.answer(got, "q", lambda p: 1 / 0) is None


def test_named_values_are_those_that_extract_finds(spark):
    values = ["Alpha One", "beta", "Straße 7", "--", "x-y z", "Gamma"]
    rows = spark.createDataFrame([(v,) for v in [*values, "beta"]], "f string")
    for q in ("what of AO and BETA", "in der straße 7", "", "xyz!", "alpha", "x y z"):
        want = {k: sorted(v) for k, v in retrieve.extract(q, {"f": values}).items()}
        assert retrieve.named_values(rows, ["f"], q) == want, q


@pytest.mark.parametrize("counted", [True, False])
def test_paged_source(spark, counted):
    table = [{"sys_id": str(i), "v": "é", "sys_updated_on": f"2024-01-{i + 1:02d} 00:00:00"} for i in range(10)]
    refused = []

    class Service(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
            if not refused:
                refused.append(1)
                self.send_response(429)
                self.send_header("Retry-After", "0")
                self.end_headers()
                return
            rows = [r for r in table if r["sys_updated_on"] > asked.get("sysparm_query", ">").split(">")[1]]
            at = int(asked["sysparm_offset"])
            self.send_response(200)
            if counted:
                self.send_header("X-Total-Count", str(len(rows)))
            self.end_headers()
            self.wfile.write(json.dumps({"result": rows[at : at + int(asked["sysparm_limit"])]}).encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    cfg = {"url": f"http://127.0.0.1:{server.server_port}/api/now/table/incident", "table": "incident", "page_size": 4}
    try:
        got = scan.scan(spark, "ServiceNow", cfg).collect()
        assert sorted(x.source_id for x in got) == sorted(f"incident/{i}" for i in range(10)) and json.loads(got[0].record)["v"] == "é"
        later = scan.scan(spark, "servicenow", cfg, "2024-01-08 00:00:00").collect()
        assert sorted(x.source_id for x in later) == ["incident/8", "incident/9"]
        assert scan.scan(spark, "servicenow", cfg, "2025-01-01 00:00:00").count() == 0
    finally:
        server.shutdown()
