import hashlib
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import embed, images, load
from tidemark.plans.ingest import Plan, prepare
from tidemark.sources import office

REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
BIG, OTHER, BAD, ICON = b"\x89PNG" + b"a" * 3000, b"GIF8" + b"b" * 3000, b"bad" + b"c" * 3000, b"i" * 2047


def packed(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


def deck(*pictures):
    """One slide for each list of pictures; None: one that is elsewhere."""
    files = {"ppt/presentation.xml": f"<p {REL}><sldIdLst>" + "".join(f'<sldId r:id="s{n}"/>' for n in range(len(pictures))) + "</sldIdLst></p>"}
    files["ppt/_rels/presentation.xml.rels"] = "<R>" + "".join(f'<Relationship Id="s{n}" Type="x/slide" Target="slides/s{n}.xml"/>' for n in range(len(pictures))) + "</R>"
    for n, some in enumerate(pictures):
        files[f"ppt/slides/s{n}.xml"] = f"<s {REL}><sp><p><t>Text {n}</t></p></sp>" + "".join(f'<pic><cNvPr name="P"/><blipFill><blip r:embed="i{k}"/></blipFill></pic>' for k in range(len(some))) + "</s>"
        files[f"ppt/slides/_rels/s{n}.xml.rels"] = "<R>" + "".join(f'<Relationship Id="i{k}" Type="x/image" Target="../media/{n}-{k}.png"/>' if x else f'<Relationship Id="i{k}" Type="x/image" TargetMode="External" Target="http://a.b/c.png"/>' for k, x in enumerate(some)) + "</R>"
        files |= {f"ppt/media/{n}-{k}.png": x for k, x in enumerate(some) if x}
    return packed(files)


def letter(*pictures):
    body = "<p><t>Dear</t></p>" + "".join(f'<p><drawing><blip r:embed="i{k}"/></drawing></p>' for k in range(len(pictures)))
    rels = "<R>" + "".join(f'<Relationship Id="i{k}" Type="x/image" Target="media/{k}.png"/>' for k in range(len(pictures))) + "</R>"
    return packed({"word/document.xml": f"<d {REL}><body>{body}</body></d>", "word/_rels/document.xml.rels": rels} | {f"word/media/{k}.png": x for k, x in enumerate(pictures)})


@pytest.fixture
def docs(spark):
    rows = [("deck", ".pptx", deck([BIG, ICON], [OTHER, None, BIG])), ("letter", ".docx", letter(BIG, BAD, ICON)), ("plain", ".docx", letter()), ("broken", ".pptx", b"no zip"), ("text", ".txt", b"a text")]
    rows = [("file", C.MIME[e], None, bytearray(b), f"/{k}{e}", None, k) for k, e, b in rows]
    return spark.createDataFrame(rows, "content_type string, mime_type string, structured_source_type string, content binary, full_path string, record string, source_id string")


def test_each_image_is_described_once_and_stands_in_its_place(spark, docs, tmp_path):
    calls = str(tmp_path)

    def describe(data):
        with open(f"{calls}/{os.urandom(8).hex()}", "w") as f:
            f.write(hashlib.sha256(data).hexdigest())
        if data.startswith(b"bad"):
            raise ValueError("no description")
        return f"  kind {data[:4]!r},\n {len(data)} bytes "

    loaded = load.load(docs, images=True).drop("content").cache()
    got = {r.source_id: r for r in images.described(loaded, ["source_id"], describe, concurrency=3).collect()}
    big, other = f"kind {BIG[:4]!r}, {len(BIG)} bytes", f"kind {OTHER[:4]!r}, {len(OTHER)} bytes"
    assert got["deck"].markdown == f"## Slide 1\n\n- Text 0\n**[Image 1, Slide 1]**: {big}\n[Image 2, Slide 1]\n\n---\n\n## Slide 2\n\n- Text 1\n**[Image 1, Slide 2]**: {other}\n[Image 2, Slide 2]\n**[Image 3, Slide 2]**: {big}"
    icon = f"kind {ICON[:4]!r}, {len(ICON)} bytes"
    assert got["letter"].markdown == f"Dear\n\n## Embedded Images\n\n**[Image 1]**: {big}\n\n**[Image 2]**: _Image could not be described_\n\n**[Image 3]**: {icon}"
    assert got["plain"].markdown == "Dear" and got["text"].markdown == "a text" and got["broken"].status == "failed" and len(got) == 5
    assert sorted(open(f"{calls}/{n}").read() for n in os.listdir(calls)) == sorted(hashlib.sha256(x).hexdigest() for x in (BIG, OTHER, BAD, ICON))
    assert "images" not in got["deck"].asDict()


def test_without_images_nothing_changes(spark, docs):
    got = {r.source_id: r.markdown for r in load.load(docs).collect()}
    assert got["deck"].count("[Image: P]") == 5 and got["letter"] == "Dear" and "\0" not in "".join(x or "" for x in got.values())
    none = images.described(load.load(docs.where("source_id = 'plain'"), images=True), ["source_id"], lambda b: "x")
    assert none.first().markdown == "Dear" and images.described(load.load(docs.where(F.lit(False)), images=True), ["source_id"], lambda b: "x").count() == 0


def test_limits_of_size_and_numbers():
    found = []
    text = office.slides(deck([b"x" * 2048, b"x" * 2047]), found)
    assert [x.content is not None for x in found] == [True, False] and text.endswith("\0" + "0\0\n\0" + "1\0")


def test_ingestion_uses_the_hook(spark, docs):
    more = {"tenant_id": F.lit("t"), "repo_id": F.lit("r"), "decision": F.lit("new"), "change": F.lit("upsert"), "file_name": F.element_at(F.split("full_path", "/"), -1), "source_url": F.lit(None).cast("string"), "content_hash": F.lit("h"), "last_modified_at_source": F.lit("2024-01-01").cast("timestamp")}
    plan = Plan("t", "r", provider=embed.HashingProvider(dimensions=4), describe=lambda b: f"shows {len(b)}")
    loaded, chunks = prepare(docs.withColumns(more), plan, "j", F.lit("2024-01-01").cast("timestamp"))
    assert {r.source_id: r.status for r in loaded.collect()} == {"deck": "new", "letter": "new", "plain": "new", "broken": "failed", "text": "new"}
    text = "\n".join(str(r.asDict()) for r in chunks.where("source_id = 'deck'").collect())
    assert "**[Image 1, Slide 1]**: shows 3004" in text and "\0" not in text and "images" not in chunks.columns
