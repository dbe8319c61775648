"""Registered queries for the operators, over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import chunk, delta, embed, enrich, jobs, known, load, notify, render, retrieve, store, tables, textindex, vectorindex
from tidemark.operators.registry import RegistryTable
from tidemark.plans import ingest, search
from tidemark.plans.config import FilterRequest, MetadataField, RetrievalConfig, resolve_schema
from tidemark.sources import scan
from tidemark.storage import contained, folder, materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents as files of tenants and repositories."""
    rows = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return rows.select("doc_id", "text", "lang", "source", F.concat(F.lit("t"), (F.col("doc_id") % 3).cast("string")).alias("tenant_id"), F.col("source").alias("repo_id"), F.col("doc_id").cast("string").alias("source_id"), F.concat(F.lit("/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("full_path"), C.content_hash(F.col("text")).alias("content_hash"))


_DOCS = """docs AS (SELECT doc_id, text, lang, source, 't' || (doc_id % 3)::VARCHAR AS tenant_id, source AS repo_id, doc_id::VARCHAR AS source_id,
  '/' || lang || '/' || source || '/doc_' || doc_id::VARCHAR || '.md' AS full_path, sha256(text) AS content_hash FROM documents)"""
_REGISTRY = """registry AS (SELECT tenant_id, repo_id, source_id, CASE WHEN doc_id % 10 = 1 THEN 'stale' ELSE content_hash END AS content_hash, 'active' AS status FROM docs WHERE doc_id % 10 <> 0
  UNION ALL SELECT tenant_id, repo_id, (doc_id + 1000000)::VARCHAR, 'ghost', CASE WHEN doc_id % 40 = 3 THEN 'deleted' ELSE 'active' END FROM docs WHERE doc_id % 20 = 3)"""


def registry(docs: DataFrame) -> DataFrame:
    """A tenth of the documents unknown, a tenth stale, and ghosts that no scan holds."""
    known = docs.where("doc_id % 10 <> 0").select("tenant_id", "repo_id", "source_id", F.when(F.col("doc_id") % 10 == 1, "stale").otherwise(F.col("content_hash")).alias("content_hash"), F.lit("active").alias("status"))
    ghosts = docs.where("doc_id % 20 = 3").select("tenant_id", "repo_id", (F.col("doc_id") + 1000000).cast("string").alias("source_id"), F.lit("ghost").alias("content_hash"), F.when(F.col("doc_id") % 40 == 3, "deleted").otherwise("active").alias("status"))
    return known.unionByName(ghosts)


@query("SELECT doc_id, sha256(text) AS content_hash FROM documents")
def q01_content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", C.content_hash(F.col("text")).alias("content_hash"))


_DECIDED = f"""WITH {_DOCS}, {_REGISTRY}, decided AS (SELECT d.*, CASE WHEN r.source_id IS NULL THEN 'new' WHEN r.content_hash = d.content_hash THEN 'unchanged' ELSE 'changed' END AS decision
  FROM docs d LEFT JOIN registry r USING (tenant_id, repo_id, source_id))"""


@query(f"{_DECIDED} SELECT tenant_id, decision, count(*)::BIGINT AS n FROM decided GROUP BY ALL")
def q02_delta_decisions(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return delta.decide(docs.drop("text"), registry(docs)).groupBy("tenant_id", "decision").agg(F.count("*").alias("n"))


@query(f"WITH {_DOCS}, {_REGISTRY} SELECT r.tenant_id, r.repo_id, r.source_id FROM registry r ANTI JOIN docs d USING (tenant_id, repo_id, source_id) WHERE status = 'active'")
def q03_implicit_deletes(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return delta.implicit_deletes(registry(docs), docs).select(*delta.KEYS)


@query(f"WITH {_DOCS}, {_REGISTRY} SELECT tenant_id, repo_id, source_id FROM docs d SEMI JOIN registry r USING (tenant_id, repo_id, source_id) WHERE doc_id % 5 = 0")
def q04_native_delete_guard(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    feed = docs.where("doc_id % 5 = 0").select(*delta.KEYS, F.lit("deleted").alias("change"))
    return delta.native_deletes(feed, registry(docs)).select(*delta.KEYS)


@query(f"""{_DECIDED}, new AS (SELECT tenant_id, repo_id, source_id, content_hash, 'active' AS status FROM decided WHERE decision <> 'unchanged')
SELECT coalesce(n.tenant_id, r.tenant_id) AS tenant_id, coalesce(n.repo_id, r.repo_id) AS repo_id, coalesce(n.source_id, r.source_id) AS source_id, coalesce(n.content_hash, r.content_hash) AS content_hash, coalesce(n.status, r.status) AS status
FROM registry r FULL JOIN new n ON r.tenant_id = n.tenant_id AND r.repo_id = n.repo_id AND r.source_id = n.source_id""")
def q05_registry_upsert(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    known = registry(docs).withColumn("last_ingested_at", F.lit("2024-01-01").cast("timestamp"))
    new = delta.decide(docs.drop("text"), known).where("decision <> 'unchanged'").select(*delta.KEYS, "content_hash", F.lit("active").alias("status"), F.lit("2024-02-01").cast("timestamp").alias("last_ingested_at"))
    return delta.upsert(known, new).drop("last_ingested_at")


_RESULTS = """results AS (SELECT tenant_id, repo_id, full_path, CASE WHEN doc_id % 17 = 5 THEN 'failed' WHEN decision = 'new' THEN 'new' WHEN decision = 'changed' THEN 'updated' ELSE 'skipped' END AS status,
  (ceil(length(text) / 1024.0))::INT AS chunks_created, (doc_id % 4)::INT AS chunks_deleted, 'error ' || doc_id::VARCHAR AS error FROM decided)"""
_STATS = f"""{_DECIDED}, {_RESULTS}, gone AS (SELECT r.tenant_id, r.repo_id FROM registry r ANTI JOIN docs d USING (tenant_id, repo_id, source_id) WHERE status = 'active'),
allr AS (SELECT tenant_id, repo_id, status, chunks_created, chunks_deleted FROM results UNION ALL SELECT tenant_id, repo_id, 'deleted', 0, 3 FROM gone),
stats AS (SELECT repo_id, count(*) FILTER (status <> 'deleted')::BIGINT AS documents_scanned, count(*) FILTER (status = 'new')::BIGINT AS documents_new, count(*) FILTER (status = 'updated')::BIGINT AS documents_updated,
  count(*) FILTER (status = 'skipped')::BIGINT AS documents_skipped, count(*) FILTER (status = 'failed')::BIGINT AS documents_failed, count(*) FILTER (status = 'deleted')::BIGINT AS documents_deleted,
  coalesce(sum(chunks_created) FILTER (status IN ('new', 'updated')), 0)::BIGINT AS chunks_created, coalesce(sum(chunks_deleted) FILTER (status IN ('updated', 'deleted')), 0)::BIGINT AS chunks_deleted,
  CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'partial' ELSE 'completed' END AS status FROM allr GROUP BY repo_id)"""


def _results(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = documents(spark, d)
    status = F.when(F.col("doc_id") % 17 == 5, "failed").when(F.col("decision") == "new", "new").when(F.col("decision") == "changed", "updated").otherwise("skipped")
    got = delta.decide(docs, registry(docs)).select(*delta.KEYS, "full_path", status.alias("status"), F.ceil(F.length("text") / 1024).cast("int").alias("chunks_created"), (F.col("doc_id") % 4).cast("int").alias("chunks_deleted"), F.concat(F.lit("error "), F.col("doc_id").cast("string")).alias("error"))
    return got, delta.implicit_deletes(registry(docs), docs).withColumn("chunks_deleted", F.lit(3))


@query(f"{_STATS} SELECT * FROM stats")
def q06_job_stats(spark: SparkSession, d: str) -> DataFrame:
    return jobs.stats(*_results(spark, d), by=["repo_id"])


@query(f"{_DECIDED}, {_RESULTS} SELECT repo_id, count(*)::BIGINT AS n, string_agg(full_path || ': ' || error, chr(10) ORDER BY full_path) AS errors FROM results WHERE status = 'failed' GROUP BY repo_id")
def q07_error_log(spark: SparkSession, d: str) -> DataFrame:
    log = jobs.error_log(_results(spark, d)[0], ["repo_id"])
    return log.select("repo_id", F.size("errors").cast("long").alias("n"), F.array_join(F.transform("errors", lambda e: F.concat(e.file, F.lit(": "), e.error)), "\n").alias("errors"))


_PATH_SCHEMA = [MetadataField("lang_seg", "path_segment", 0), MetadataField("repo_seg", "path_segment", 1, "none"), MetadataField("last_seg", "path_segment", -1), MetadataField("far_seg", "path_segment", 5, "far"), MetadataField("is_en", "path_segment_equals", 0, equals="en"), MetadataField("stem", "file_name"), MetadataField("fixed", "static", default="x")]


@query(f"WITH {_DOCS} SELECT doc_id, lang AS lang_seg, source AS repo_seg, source AS last_seg, 'far' AS far_seg, CASE WHEN lang = 'en' THEN 'true' ELSE 'false' END AS is_en, 'doc_' || doc_id::VARCHAR AS stem, 'x' AS fixed FROM docs")
def q08_path_segments(spark: SparkSession, d: str) -> DataFrame:
    rows = enrich.custom(documents(spark, d).select("doc_id", "full_path"), _PATH_SCHEMA)
    return rows.drop("full_path")


_ACCESS_SCHEMA = [MetadataField("application", "path_segment", 1), MetadataField("access_group", "path_segment", 2, "general"), MetadataField("access_key", "computed", formula="{application}::{access_group}", default="unknown::unknown"), MetadataField("bad_key", "computed", formula="{application}::{later}", default="none"), MetadataField("later", "static")]


@query(f"WITH {_DOCS} SELECT doc_id, source AS application, 'general' AS access_group, source || '::general' AS access_key, 'none' AS bad_key, 'unknown' AS later FROM docs")
def q09_access_key(spark: SparkSession, d: str) -> DataFrame:
    return enrich.custom(documents(spark, d).select("doc_id", "full_path"), _ACCESS_SCHEMA).drop("full_path")


@query(f"WITH {_DOCS} SELECT doc_id, 'doc_' || doc_id::VARCHAR || '.md' AS file_name, 'md' AS file_extension, 'text/markdown' AS mime_type, 'job-1' AS job_id, TIMESTAMP '2024-01-01 00:00:00' AS ingested_at FROM docs")
def q10_standard_metadata(spark: SparkSession, d: str) -> DataFrame:
    rows = enrich.standard(documents(spark, d).select("doc_id", "full_path"), "job-1", F.lit("2024-01-01").cast("timestamp"))
    return rows.withColumn("mime_type", C.mime_type(F.col("file_name"))).select("doc_id", "file_name", "file_extension", "mime_type", "job_id", "ingested_at")


@query(f"WITH {_DOCS} SELECT doc_id, CASE tenant_id WHEN 't0' THEN lang WHEN 't1' THEN 'from_tenant' END AS field FROM docs")
def q11_schema_priority(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "tenant_id", "full_path")
    repo, tenant = [MetadataField("field", "path_segment", 0)], [MetadataField("field", "static", default="from_tenant")]
    parts = []
    for name, schema in (("t0", resolve_schema(repo, tenant)), ("t1", resolve_schema(None, tenant)), ("t2", resolve_schema(None, None))):
        rows = enrich.custom(docs.where(F.col("tenant_id") == name), schema)
        parts.append(rows.select("doc_id", F.col("field") if schema else F.lit(None).cast("string").alias("field")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT c_custkey, '## customer — ' || c_custkey::VARCHAR || chr(10) || chr(10) || '| Column | Value |' || chr(10) || '| --- | --- |' || chr(10) || '| c_name | ' || replace(c_name, '|', '\\|') || ' |' || chr(10)
|| '| c_nationkey | ' || c_nationkey::VARCHAR || ' |' || chr(10) || '| c_acctbal | ' || c_acctbal::VARCHAR || ' |' || chr(10) || '| c_mktsegment | ' || CASE WHEN c_custkey % 7 = 0 THEN '_null_' ELSE c_mktsegment END || ' |' AS markdown FROM customer""")
def q12_sql_row_markdown(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")))
    fields = {n: F.col(n) for n in ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")}
    return rows.select("c_custkey", render.row_markdown(F.lit("customer"), F.col("c_custkey"), fields).alias("markdown"))


@query("""SELECT o_orderkey, 'Orders — ' || concat_ws(' | ', 'Status: ' || o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Priority: ' || o_orderpriority END, o_custkey::VARCHAR) AS prose FROM orders""")
def q13_kv_prose(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(F.lit("Status"), F.lit("Priority"), F.lit(" "))
    values = F.array("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")), F.col("o_custkey").cast("string"), F.lit("beyond the header"))
    return table(spark, d, "orders").select("o_orderkey", render.pairs_prose(names, values, F.lit("Orders")).alias("prose"))


@query(f"""WITH {_DOCS}, files AS (SELECT 'd' || doc_id::VARCHAR AS id, 'text/markdown' AS mime_type, 'text' AS loader FROM docs UNION ALL SELECT 'p' || page_id::VARCHAR, CASE WHEN regexp_matches(lower(regexp_extract(url, '^[^?#]*')), '\\.html?$') THEN 'text/html' ELSE 'application/octet-stream' END, NULL FROM pages)
SELECT id, mime_type, loader, CASE WHEN loader IS NULL THEN 'skipped' END AS status FROM files""")
def q14_loader_routing(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select(F.concat(F.lit("d"), F.col("source_id")).alias("id"), C.file_name(F.col("full_path")).alias("name"))
    pages = table(spark, d, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), C.file_name(F.regexp_extract("url", "^[^?#]*", 0)).alias("name"))
    rows = docs.unionByName(pages).withColumns({"content_type": F.lit("file"), "mime_type": C.mime_type(F.col("name")), "structured_source_type": F.lit(None).cast("string")})
    return load.with_loader(rows).select("id", "mime_type", "loader", "status")


@query("""SELECT r_name, '# Table: nation' || chr(10) || chr(10) || string_agg('## Record: ' || n_nationkey::VARCHAR || chr(10) || chr(10) || '**n_nationkey**: ' || n_nationkey::VARCHAR || chr(10) || '**n_name**: ' || n_name || chr(10) || '*Name of the nation*', chr(10) || chr(10) ORDER BY n_nationkey) AS markdown
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def q15_batch_markdown(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    block = render.record_block(F.col("n_nationkey"), {"n_nationkey": F.col("n_nationkey"), "n_name": F.col("n_name")}, {"n_name": "Name of the nation"})
    return render.batch_markdown(rows, "nation", block, "n_nationkey", ["r_name"])


_HEADED = """heads AS (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN 'Part ' || (doc_id % 4)::VARCHAR END AS h1, CASE WHEN doc_id % 3 = 0 THEN 'Section ' || (doc_id % 6)::VARCHAR END AS h2, CASE WHEN doc_id % 5 = 0 THEN 'general' END AS h3, NULL::VARCHAR AS h4 FROM docs)"""


def _headed(spark: SparkSession, d: str) -> DataFrame:
    named = lambda m, word, k: F.when(F.col("doc_id") % m == 0, F.concat(F.lit(word), (F.col("doc_id") % k).cast("string")))
    return documents(spark, d).withColumns({"h1": named(2, "Part ", 4), "h2": named(3, "Section ", 6), "h3": F.when(F.col("doc_id") % 5 == 0, "general"), "h4": F.lit(None).cast("string")})


@query(f"""WITH {_DOCS}, {_HEADED} SELECT d.doc_id, '[' || concat_ws(' | ', d.source, d.lang, 'doc ' || d.doc_id::VARCHAR, coalesce(h2, h1)) || ']' || chr(10) || d.text AS text FROM docs d JOIN heads h ON d.doc_id = h.doc_id""")
def q16_prefix(spark: SparkSession, d: str) -> DataFrame:
    rows = _headed(spark, d).withColumn("flag", F.lit("general"))
    return enrich.identity(rows, RetrievalConfig(extractable_fields=("source", "flag", "lang")), []).select("doc_id", "text")


@query("""SELECT conv_id, turn, concat_ws(chr(10) || chr(10) || '---' || chr(10) || chr(10), '[chunk before]' || chr(10) || left(lag(text, 2) OVER w, 400), '[chunk before]' || chr(10) || left(lag(text, 1) OVER w, 400), '[CURRENT CHUNK]' || chr(10) || left(text, 800),
'[chunk after]' || chr(10) || left(lead(text, 1) OVER w, 400), '[chunk after]' || chr(10) || left(lead(text, 2) OVER w, 400)) AS context FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def q17_neighbour_context(spark: SparkSession, d: str) -> DataFrame:
    rows = enrich.neighbours(table(spark, d, "conversations"), ["conv_id"], "turn")
    return rows.select("conv_id", "turn", F.col("window").alias("context"))


@query(f"""WITH {_DOCS}, {_HEADED}, c AS (SELECT *, coalesce(nullif(concat_ws(' > ', h1, h2, h3), ''), 'Document body') AS section, concat_ws(chr(10), '# ' || h1, '## ' || h2, '### ' || h3) AS crumb FROM heads)
SELECT doc_id, section, CASE WHEN crumb = '' OR starts_with(text, crumb) THEN text ELSE crumb || chr(10) || text END AS text FROM c""")
def q18_section_path_breadcrumb(spark: SparkSession, d: str) -> DataFrame:
    h = [F.col(f"h{n}") for n in range(1, 5)]
    return _headed(spark, d).select("doc_id", C.section_path(*h).alias("section"), C.breadcrumb(F.col("text"), *h[:3]).alias("text"))


@query("SELECT doc_id FROM documents WHERE contains(text, ' | ') AND contains(text || CASE WHEN doc_id % 2 = 0 THEN ': ' ELSE '' END, ': ')")
def q19_table_chunk_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").withColumn("text", F.concat("text", F.when(F.col("doc_id") % 2 == 0, ": ").otherwise("")))
    return rows.where(C.table_like(F.col("text"))).select("doc_id")


_VECTOR = [((i * 37) % 64 - 31.5) / 64 for i in range(64)]
_QUERY = "[" + ", ".join(f"{x!r}::DOUBLE" for x in _VECTOR) + "]"
_SCORED = f"scored AS (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], {_QUERY}) AS score FROM embeddings)"


@query(f"WITH {_SCORED} SELECT vec_id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, vec_id LIMIT 10")
def q20_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    return retrieve.vector_topk(table(spark, d, "embeddings"), _VECTOR, 10, "vec_id", by=None).select("vec_id", F.round("score", 6).alias("score"))


@query(f"WITH {_SCORED} SELECT vec_id, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, vec_id LIMIT 10")
def q41_vector_index(spark: SparkSession, d: str) -> DataFrame:
    """The question of q20 asked of an index, which reads cells until no other can hold a nearer vector."""

    def nearest() -> DataFrame:
        index = vectorindex.VectorIndex(spark, folder(spark, "vectors"))
        index.build(table(spark, d, "embeddings"))
        return index.topk(_VECTOR, 10, "vec_id", exact=True).select("vec_id", F.round("score", 6).alias("score"))

    return contained(spark, "nearest", nearest)


@query(f"WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS n FROM scored) SELECT vec_id, label, round(score, 6) AS score FROM r WHERE n <= 10 ORDER BY r.score DESC, vec_id LIMIT 5")
def q21_per_repo_topk_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = retrieve.vector_topk(table(spark, d, "embeddings"), _VECTOR, 10, "vec_id", by="label")
    return retrieve.merged(rows, 5, "vec_id").select("vec_id", "label", F.round("score", 6).alias("score"))


@query(f"""WITH {_DOCS} SELECT doc_id FROM docs WHERE tenant_id = 't1' AND repo_id IN ('src1', 'src2', 'src3', 'src4') AND source IN ('src1', 'src2', 'src3') AND lang = 'de'""")
def q22_must_should_filter(spark: SparkSession, d: str) -> DataFrame:
    request = FilterRequest(must={"source": ["src1", "src2", "src3"]}, should={"lang": ["en", "de", "fr"]}, auto_extract=True)
    open_ = retrieve.predicate(request, RetrievalConfig(filterable_fields=("source", "lang")), "Was steht im Text, de?")
    closed = retrieve.predicate(request, RetrievalConfig(filterable_fields=("lang",)), "de")
    docs = retrieve.scoped(documents(spark, d), "t1", ["src1", "src2", "src3", "src4"])
    return docs.where(open_).unionByName(docs.where(closed)).select("doc_id")


@query("SELECT doc_id FROM documents WHERE source IN ('src1') OR (CASE WHEN doc_id % 7 = 0 THEN 'true' ELSE 'false' END) = 'true'")
def q23_general_or(spark: SparkSession, d: str) -> DataFrame:
    rows = documents(spark, d).withColumns({"application": F.col("source"), "is_general": F.when(F.col("doc_id") % 7 == 0, "true").otherwise("false")})
    return rows.where(retrieve.general_or(RetrievalConfig(general_flag_field="is_general"), ["src1"])).select("doc_id")


@query("SELECT DISTINCT 'lang' AS field, lang AS value FROM documents WHERE lang IS NOT NULL UNION ALL SELECT DISTINCT 'source', source FROM documents WHERE source IS NOT NULL")
def q24_known_values(spark: SparkSession, d: str) -> DataFrame:
    return retrieve.known_values(documents(spark, d), ["lang", "source"])


@query("SELECT DISTINCT 'lang' AS field, lang AS value FROM documents WHERE lang IS NOT NULL UNION ALL SELECT DISTINCT 'source', source FROM documents WHERE source IS NOT NULL")
def q42_known_values_view(spark: SparkSession, d: str) -> DataFrame:
    """The values of q24 from a view that has seen more: all documents, those of one language under another name, and their retraction."""

    def values() -> DataFrame:
        docs, view = documents(spark, d).select("tenant_id", "repo_id", "lang", "source"), known.KnownValues(spark, folder(spark, "known"), ["lang", "source"], fold_every=2)
        other = docs.where("lang = 'de'").withColumn("lang", F.lit("xx"))
        view.update(docs.where("lang is null or lang <> 'de'").unionByName(other))
        view.update(docs.where("lang = 'de'"), other)
        view.update(other, other)
        return view.values()

    return contained(spark, "values", values)


_TERMS = ("erheble", "stupid", "the", "zu")
_BM25 = """toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS t FROM documents),
tf AS (SELECT doc_id, len(t) AS n, """ + ", ".join(f"len(list_filter(t, lambda x: x = '{t}')) AS f{i}" for i, t in enumerate(_TERMS)) + """ FROM toks),
tot AS (SELECT count(*) AS nn, avg(n) AS av, """ + ", ".join(f"count(*) FILTER (f{i} > 0) AS d{i}" for i in range(len(_TERMS))) + """ FROM tf),
bm AS (SELECT doc_id, """ + " + ".join(f"ln(1 + (nn - d{i} + 0.5) / (d{i} + 0.5)) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * n / av))" for i in range(len(_TERMS))) + """ AS score FROM tf, tot)"""


@query(f"WITH {_BM25} SELECT doc_id, round(score, 6) AS score FROM bm WHERE score > 0 ORDER BY round(bm.score, 9) DESC, doc_id LIMIT 20")
def q25_bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    got = retrieve.bm25(table(spark, d, "documents"), " ".join(_TERMS), 60, "doc_id")
    return got.orderBy(F.desc(F.round("score", 9)), "doc_id").limit(20).select("doc_id", F.round("score", 6).alias("score"))


@query(f"WITH {_BM25} SELECT doc_id, round(score, 6) AS score FROM bm WHERE score > 0 ORDER BY round(bm.score, 9) DESC, doc_id LIMIT 20")
def q40_index_topk(spark: SparkSession, d: str) -> DataFrame:
    """The question of q25 asked of an inverted index that was written three times: all documents, some with another text; some deleted; both put right again."""

    def ranked() -> DataFrame:
        docs, index = table(spark, d, "documents").select("doc_id", "text", "source", "lang"), textindex.TextIndex(spark, folder(spark, "index"), buckets=8)
        index.put(docs.withColumn("text", F.when(F.col("source") == "src1", F.concat(F.lit("stupid the the "), "text")).otherwise(F.col("text"))), "doc_id", "text")
        index.put(docs.where("false"), "doc_id", "text", gone=docs.where("lang = 'fr'"))
        index.put(docs.where("lang = 'fr' or source = 'src1'"), "doc_id", "text")
        return index.topk(" ".join(_TERMS), 60).select(F.col("key").cast("long").alias("doc_id"), "score")

    got = contained(spark, "ranked", ranked)
    return got.orderBy(F.desc(F.round("score", 9)), "doc_id").limit(20).select("doc_id", F.round("score", 6).alias("score"))


@query(f"""WITH {_BM25}, {_SCORED}, w AS (SELECT doc_id, row_number() OVER (ORDER BY s DESC, doc_id) AS r FROM (SELECT doc_id, round(score, 9) AS s FROM bm WHERE score > 0 ORDER BY s DESC, doc_id LIMIT 20)),
v AS (SELECT vec_id AS doc_id, row_number() OVER (ORDER BY score DESC, vec_id) AS r FROM (SELECT * FROM scored ORDER BY score DESC, vec_id LIMIT 20))
SELECT coalesce(v.doc_id, w.doc_id) AS doc_id, round(coalesce(0.7 / (60 + v.r), 0) + coalesce((1 - 0.7) / (60 + w.r), 0), 6) AS score FROM v FULL JOIN w ON v.doc_id = w.doc_id""")
def q26_rrf_hybrid(spark: SparkSession, d: str) -> DataFrame:
    words = retrieve.bm25(table(spark, d, "documents"), " ".join(_TERMS), 60, "doc_id").withColumn("score", F.round("score", 9)).orderBy(F.desc("score"), "doc_id").limit(20)
    vectors = retrieve.vector_topk(table(spark, d, "embeddings").withColumnRenamed("vec_id", "doc_id"), _VECTOR, 20, "doc_id", by=None)
    return retrieve.fuse(vectors, words, "doc_id", 0.7).select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT doc_id, substring(text, 1, 400) AS text FROM documents ORDER BY n_chars DESC, doc_id LIMIT 24")
def q27_rerank_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "text", F.col("n_chars").alias("score"))
    return retrieve.rerank_candidates(rows, 8, "doc_id").select("doc_id", "text")


@query("SELECT 'orders/' || o_orderkey::VARCHAR AS source_id, 'upsert' AS change, o_orderdate AS last_modified_at_source FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-01 00:00:00'")
def q28_delta_predicate(spark: SparkSession, d: str) -> DataFrame:
    cfg = {"table": "orders", "primary_key": "o_orderkey", "delta_column": "o_orderdate", "columns": ["o_orderstatus"], "path": f"{d}/orders.parquet"}
    import datetime

    rows = scan.scan(spark, "SQL", cfg, datetime.datetime(1997, 6, 1))
    return rows.select("source_id", "change", "last_modified_at_source")


@query(f"""{_STATS} SELECT repo_id, documents_failed > 0 AS on_failure, documents_new + documents_updated + documents_deleted > 0 AS on_change, true AS always FROM stats""")
def q29_notify_predicate(spark: SparkSession, d: str) -> DataFrame:
    rows = jobs.stats(*_results(spark, d), by=["repo_id"])
    on = lambda *t: jobs.notifies(F.array(*map(F.lit, t)).cast("array<string>"))
    return rows.select("repo_id", on("on_failure").alias("on_failure"), on("on_change").alias("on_change"), on().alias("always"))


_HOOK_KEY = b"not a secret"
_PADDED = {n: bytes(b ^ n for b in _HOOK_KEY.ljust(64, b"\0")).hex() for n in (0x36, 0x5C)}
_COUNTS = ["documents_scanned", "documents_new", "documents_updated", "documents_skipped", "documents_deleted", "documents_failed", "chunks_created", "chunks_deleted"]
_BODY = " || ',' || ".join(f"""'"{c}":' || {c}""" for c in _COUNTS)
_DIGEST = "count(*)::BIGINT AS n, sum(('0x' || substr(md5(entry), 1, 8))::BIGINT)::VARCHAR AS digest"


@query(f"""{_STATS}, bodies AS (SELECT repo_id, '{{"event":"ingestion.completed","tenant_id":"all","repo_id":"' || repo_id || '","job_id":"job-1","trigger":"manual","status":"' || status
    || '","started_at":"2024-01-01T00:00:00Z","completed_at":"2024-01-01T00:01:30Z","duration_seconds":90,"summary":{{' || {_BODY} || '}}}}' AS body FROM stats WHERE repo_id IS NOT NULL),
  listed AS (SELECT repo_id, CASE status WHEN 'failed' THEN 'errors' ELSE status END AS kind, CASE status WHEN 'failed' THEN full_path || ': ' || error ELSE full_path END AS entry FROM results WHERE status <> 'skipped'
    UNION ALL SELECT r.repo_id, 'deleted', r.source_id FROM registry r ANTI JOIN docs d USING (tenant_id, repo_id, source_id) WHERE status = 'active')
SELECT repo_id, 'signature' AS kind, 1::BIGINT AS n, sha256(unhex('{_PADDED[0x5C]}') || unhex(sha256(unhex('{_PADDED[0x36]}') || encode(body)))) AS digest FROM bodies
UNION ALL SELECT repo_id, kind, {_DIGEST} FROM listed WHERE repo_id IS NOT NULL AND repo_id IN (SELECT repo_id FROM stats WHERE documents_failed > 0) GROUP BY repo_id, kind""")
def q44_notifications(spark: SparkSession, d: str) -> DataFrame:
    """Messages of a job of each repository: the signed summary, and what all parts of the full ones list."""
    return contained(spark, "notifications", lambda: _notifications(spark, d))


def _notifications(spark: SparkSession, d: str) -> DataFrame:
    results, gone = _results(spark, d)
    # read for the statistics, the number of parts and the lists
    results = materialize(results.select("repo_id", "source_id", "full_path", "status", "chunks_created", "chunks_deleted", "error"), "results")
    gone = materialize(gone.select("repo_id", "source_id", "chunks_deleted"), "gone")
    job = {"tenant_id": F.lit("all"), "job_id": F.lit("job-1")}
    at = lambda t: F.lit(t).cast("timestamp")
    stats = jobs.stats(results, gone, by=["repo_id"]).withColumns(job | {"trigger": F.lit("manual"), "started_at": at("2024-01-01 00:00:00"), "completed_at": at("2024-01-01 00:01:30")})
    stats = materialize(stats, "stats")
    listed = results.select("repo_id", "source_id", "full_path", "status", "error").unionByName(gone.select("repo_id", "source_id", F.col("source_id").alias("full_path"), F.lit("deleted").alias("status"), F.lit(None).cast("string").alias("error")))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("detail"), F.array(*map(F.lit, t)).cast("array<string>").alias("triggers"), F.lit(s).alias("secret")) for k, t, s in (("summary", [], _HOOK_KEY), ("full", ["on_failure"], None))]))
    channels = stats.select("tenant_id", "repo_id", F.concat(F.lit("https://hooks.example/"), F.col("repo_id")).alias("url"), kinds.alias("c")).select("tenant_id", "repo_id", "url", "c.*")
    got = notify.messages(stats, channels, listed.withColumns(job), listed=50)
    names = "new array<string>, updated array<string>, deleted array<string>, errors array<struct<file: string, error: string>>"
    body = got.select("signature", F.from_json("body", f"repo_id string, documents struct<{names.replace(' array', ': array')}>").alias("b")).select("signature", "b.*")
    signed = body.where("signature is not null").select("repo_id", F.lit("signature").alias("kind"), F.lit(1).cast("long").alias("n"), F.col("signature").alias("digest"))
    errors = F.transform("documents.errors", lambda e: F.concat(e.file, F.lit(": "), e.error))
    entries = F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in ("new", "updated", "deleted", "errors")]), F.array("documents.new", "documents.updated", "documents.deleted", errors))).alias("kind", "entries")
    entries = body.where("signature is null").select("repo_id", entries).select("repo_id", "kind", F.explode("entries").alias("entry"))
    number = F.conv(F.substring(F.md5("entry"), 1, 8), 16, 10).cast("long")
    return signed.unionByName(entries.groupBy("repo_id", "kind").agg(F.count("*").alias("n"), F.sum(number).cast("string").alias("digest")))


@query(f"WITH {_DOCS} SELECT 'promoted' AS place, doc_id FROM docs WHERE tenant_id = 't1' AND repo_id = 'src1' UNION ALL SELECT 'shared', doc_id FROM docs WHERE NOT (tenant_id = 't1' AND repo_id = 'src1')")
def q30_promotion(spark: SparkSession, d: str) -> DataFrame:
    def promoted() -> DataFrame:
        base = folder(spark, "promotion")
        shared, own = store.ChunkStore(spark, store.collection(base)), store.ChunkStore(spark, store.collection(base, "repo", tenant="t1", repo="src1"))
        shared.replace(documents(spark, d).withColumn("chunk_index", F.lit(0)))
        shared.promote(own, "t1", "src1")
        return own.read().select(F.lit("promoted").alias("place"), "doc_id").unionByName(shared.read().select(F.lit("shared").alias("place"), "doc_id"))

    return contained(spark, "promoted", promoted)


@query("SELECT doc_id, lang || ' ' || source || ' ' || doc_id::VARCHAR AS stem FROM documents")
def q31_prefix_stem(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat("lang", F.lit("__"), "source", F.lit("-_ "), F.col("doc_id").cast("string"), F.lit(".tar.md"))
    return table(spark, d, "documents").select("doc_id", C.readable_stem(F.regexp_replace(name, r"\.tar", "")).alias("stem"))


@query()
def q32_recursive_chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = documents(spark, d).select("doc_id", F.col("text").alias("markdown"))
    return chunk.chunk(rows).select("doc_id", "chunk_index", "chunk_total", "start_index", "text")


@query("""SELECT c_custkey, chr(10) || chr(10) || string_agg('customer — ' || c_custkey::VARCHAR || ' — Column: ' || name || ' | Value: ' || value, chr(10) ORDER BY n) AS prose
FROM (SELECT c_custkey, unnest([1, 2, 3]) AS n, unnest(['c_name', 'c_acctbal', 'c_mktsegment']) AS name, unnest([c_name, c_acctbal::VARCHAR, c_mktsegment]) AS value FROM customer) GROUP BY c_custkey""")
def q33_table_to_prose(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer")
    md = render.row_markdown(F.lit("customer"), F.col("c_custkey"), {n: F.col(n) for n in ("c_name", "c_acctbal", "c_mktsegment")})
    return rows.select("c_custkey", tables.to_prose(md).alias("prose"))


@query("""SELECT event_id, '## app.events — ' || event_id::VARCHAR || chr(10) || chr(10) || '### Fields' || chr(10) || chr(10) || '- **user**: ' || user_id::VARCHAR || chr(10) || chr(10)
|| '### detail' || chr(10) || chr(10) || '- **k**: ' || json_extract_string(props, '$.k') || chr(10) || chr(10)
|| '### marks' || chr(10) || chr(10) || '- ' || event_id::VARCHAR || chr(10) || '- Item 2:' || chr(10) || '  - **kind**: ' || event_type || chr(10) AS markdown FROM events""")
def q34_nested_document_markdown(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events")
    number = lambda c: F.col(c).cast("string")
    record = F.concat(F.lit('{"_id": 1, "user": '), number("user_id"), F.lit(', "detail": '), F.col("props"), F.lit(', "marks": ['), number("event_id"), F.lit(', {"kind": "'), F.col("event_type"), F.lit('"}]}'))
    return rows.select("event_id", render.records_markdown(F.concat(F.lit("app.events — "), number("event_id")), record).alias("markdown"))


@query("""SELECT user_id::VARCHAR AS source_id, sha256(props) AS content_hash, ts AS last_modified_at_source, 'new' AS decision FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type = 'logout' DESC, sha256(props) DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'logout'""")
def q35_stream_delta(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.streaming.ingest import apply_stream

    kind = table(spark, d, "events").schema
    rows = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{d}/events.parquet*")
    change = F.when(F.col("event_type") == "logout", "deleted").otherwise("upsert")
    feed = rows.select(F.lit("t0").alias("tenant_id"), F.lit("events").alias("repo_id"), F.col("user_id").cast("string").alias("source_id"), change.alias("change"), C.content_hash(F.col("props")).alias("content_hash"), F.col("ts").alias("last_modified_at_source"))

    def decided() -> DataFrame:
        base = folder(spark, "stream")
        apply_stream(feed, RegistryTable(spark, f"{base}/registry"), f"{base}/decisions", f"{base}/checkpoint").awaitTermination()
        return spark.read.parquet(f"{base}/decisions").select("source_id", "content_hash", "last_modified_at_source", "decision")

    return contained(spark, "decided", decided)


@query()
def q36_embed_hash(spark: SparkSession, d: str) -> DataFrame:
    rows = embed.embed(table(spark, d, "documents").select("doc_id", "text"), embed.HashingProvider(dimensions=64))
    return rows.select("doc_id", "embedding")


class _Question:
    """Stands in for a model: every text has the query vector."""

    model_name, dimensions = "fixed", len(_VECTOR)

    def embed_documents(self, texts: list[str]) -> list[list[float]]:
        return [_VECTOR for _ in texts]


@query(f"""WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id::VARCHAR) AS n FROM scored WHERE label IN (0, 1, 2) AND vec_id % 3 IN (0, 1))
SELECT vec_id, 'r' || label::VARCHAR AS repo_id, round(score, 6) AS score, length(text)::BIGINT AS n_chars FROM r LEFT JOIN documents ON doc_id = vec_id WHERE n <= 10 ORDER BY r.score DESC, repo_id, vec_id::VARCHAR LIMIT 5""")
def q37_search(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    chunks = table(spark, d, "embeddings").join(texts, "vec_id", "left").select("vec_id", F.lit("t").alias("tenant_id"), F.concat(F.lit("r"), F.col("label").cast("string")).alias("repo_id"), F.col("vec_id").cast("string").alias("source_id"), F.lit(0).alias("chunk_index"), "text", (F.col("vec_id") % 3).cast("string").alias("rest"), "embedding")
    config = RetrievalConfig(filterable_fields=("rest",))
    found = search.search(chunks, "t", {f"r{n}": config for n in range(3)}, "", _Question(), 5, FilterRequest(must={"rest": ["0", "1"]}))
    return found.select("vec_id", "repo_id", F.round("score", 6).alias("score"), F.length("text").cast("long").alias("n_chars"))


_WORD_COUNTS = ", ".join(f"len(list_filter(t, lambda x: x = '{t}')) AS f{i}" for i, t in enumerate(_TERMS))
_HOLDERS = ", ".join(f"count(*) FILTER (f{i} > 0) AS d{i}" for i in range(len(_TERMS)))
_SUM = " + ".join(f"ln(1 + (nn - d{i} + 0.5) / (d{i} + 0.5)) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * n / av))" for i in range(len(_TERMS)))


@query(f"""WITH {_SCORED}, t AS (SELECT vec_id, 'r' || label::VARCHAR AS repo_id, score, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS t FROM scored LEFT JOIN documents ON doc_id = vec_id WHERE label IN (0, 1, 2)),
tf AS (SELECT vec_id, repo_id, score, len(t) AS n, {_WORD_COUNTS} FROM t), tot AS (SELECT repo_id, count(*) AS nn, avg(n) AS av, {_HOLDERS} FROM tf GROUP BY repo_id),
bm AS (SELECT vec_id, repo_id, {_SUM} AS bm FROM tf JOIN tot USING (repo_id) WHERE repo_id <> 'r2'),
v AS (SELECT vec_id, repo_id, row_number() OVER (PARTITION BY repo_id ORDER BY score DESC, vec_id::VARCHAR) AS r FROM t QUALIFY r <= 10),
w AS (SELECT vec_id, repo_id, row_number() OVER (PARTITION BY repo_id ORDER BY bm DESC, vec_id::VARCHAR) AS r FROM bm WHERE bm > 0 QUALIFY r <= 10),
f AS (SELECT vec_id, repo_id, CASE WHEN repo_id = 'r2' THEN coalesce(1.0 / (60 + v.r), 0) ELSE coalesce(0.7 / (60 + v.r), 0) + coalesce((1 - 0.7) / (60 + w.r), 0) END AS score FROM v FULL JOIN w USING (vec_id, repo_id))
SELECT vec_id, repo_id, round(score, 6) AS score FROM f ORDER BY round(f.score, 12) DESC, repo_id, vec_id::VARCHAR LIMIT 5""")
def q43_hybrid_search(spark: SparkSession, d: str) -> DataFrame:
    """A question with words over three repositories, two of them hybrid: each with its own statistics and ranks, fused, then merged."""
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    chunks = table(spark, d, "embeddings").join(texts, "vec_id", "left").select("vec_id", F.lit("t").alias("tenant_id"), F.concat(F.lit("r"), F.col("label").cast("string")).alias("repo_id"), F.col("vec_id").cast("string").alias("source_id"), F.lit(0).alias("chunk_index"), "text", "embedding")
    found = search.search(chunks, "t", {f"r{n}": RetrievalConfig(hybrid_enabled=n < 2) for n in range(3)}, " ".join(_TERMS), _Question(), 5)
    return found.select("vec_id", "repo_id", F.round("score", 6).alias("score"))


@query(f"""WITH {_DOCS}, known AS (SELECT doc_id::VARCHAR AS source_id, CASE WHEN doc_id % 10 = 1 THEN 'stale' ELSE content_hash END AS content_hash, 'active' AS status FROM docs WHERE doc_id % 10 <> 0
  UNION ALL SELECT (doc_id + 1000000)::VARCHAR, 'ghost', CASE WHEN doc_id % 40 = 3 THEN 'deleted' ELSE 'active' END FROM docs WHERE doc_id % 20 = 3),
seen AS (SELECT source_id, content_hash, regexp_matches(coalesce(text, ''), '\\S') AS filled FROM docs)
SELECT coalesce(s.source_id, k.source_id) AS source_id, CASE WHEN s.filled THEN s.content_hash ELSE k.content_hash END AS content_hash, CASE WHEN s.source_id IS NULL THEN 'deleted' ELSE 'active' END AS status,
  coalesce(s.filled AND s.content_hash IS DISTINCT FROM k.content_hash, false) AS in_store
FROM seen s FULL JOIN known k ON s.source_id = k.source_id WHERE s.filled OR k.source_id IS NOT NULL""")
def q38_ingest_run(spark: SparkSession, d: str) -> DataFrame:
    """One ingestion of all documents into one repository: the registry that it leaves, and which documents have chunks in the store."""
    rows = documents(spark, d)
    known = registry(rows).withColumns({"tenant_id": F.lit("t"), "repo_id": F.lit("all")})
    kinds = [x.strip().split(" ", 1) for x in delta.REGISTRY.split(",")]
    known = known.select(*[F.col(n) if n in known.columns else F.lit(None).cast(kind).alias(n) for n, kind in kinds])
    feed = scan.feed(rows, "file", {"content": F.col("text").cast("binary"), "mime_type": F.lit("text/markdown"), "source_id": F.col("source_id"), "file_name": C.file_name(F.col("full_path")), "full_path": F.col("full_path"), "source_url": F.col("full_path"), "content_hash": F.col("content_hash")})

    def ingested() -> DataFrame:
        chunks = store.ChunkStore(spark, folder(spark, "run"))
        plan = ingest.Plan("t", "all", provider=embed.HashingProvider(dimensions=8))
        after, _ = ingest.run(feed, known, chunks, plan, "job-1", F.lit("2024-01-01").cast("timestamp"))
        stored = chunks.read()
        held = (after.limit(0) if stored is None else stored).select("source_id").distinct().withColumn("held", F.lit(True))
        return after.join(held, "source_id", "left").select("source_id", "content_hash", "status", F.coalesce("held", F.lit(False)).alias("in_store"))

    return contained(spark, "ingested", ingested)


_RUNS = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source, coalesce(lang, '') AS lang FROM documents),
run(n) AS (VALUES (1), (2), (3)),
seen AS (SELECT n, doc_id, source, sha256(CASE WHEN n = 2 AND lang = 'de' OR n = 3 AND source = 'src3' THEN text || ' run ' || n::VARCHAR ELSE text END) AS content_hash FROM d, run
  WHERE CASE n WHEN 1 THEN source <> 'src1' WHEN 2 THEN lang <> 'fr' ELSE source <> 'src2' END)"""


@query(f"""{_RUNS} SELECT s.doc_id::VARCHAR AS source_id, s.content_hash, s.source FROM seen s WHERE s.n = 3""")
def q39_store_after_runs(spark: SparkSession, d: str) -> DataFrame:
    """Three full listings of the documents, each decided against the registry as a table and put in one store: what is new, changed and gone differs each time. The store holds the last listing, each document once, however it came there (one that went and comes back is new again); compaction between the runs changes nothing."""

    def stored() -> DataFrame:
        base = folder(spark, "runs")
        docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("source_id"), "doc_id", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "source", "lang")])
        held, listed_before = store.ChunkStore(spark, f"{base}/store", checkpoint_every=2), RegistryTable(spark, f"{base}/registry", whole_every=2)
        there = (F.col("source") != "src1", F.col("lang") != "fr", F.col("source") != "src2")
        edited = (F.lit(False), F.col("lang") == "de", F.col("source") == "src3")
        for n, (listed, new) in enumerate(zip(there, edited, strict=True), 1):
            text = F.when(new, F.concat("text", F.lit(f" run {n}"))).otherwise(F.col("text"))
            rows = docs.where(listed).withColumns({"tenant_id": F.lit("t"), "repo_id": F.col("source"), "text": text, "content_hash": C.content_hash(text), "chunk_index": F.lit(0)})
            keys = rows.select(*delta.KEYS, "content_hash")
            seen = held.last()
            decided = delta.decide(keys, listed_before.rows_of(keys), revive_deleted=True).where("decision <> 'unchanged'")
            gone = materialize(listed_before.absent(keys, F.lit(True)).select(*delta.KEYS), "gone")
            held.replace(rows.join(decided.select(*delta.KEYS), delta.KEYS, "left_semi"), gone, seen)
            kinds = {x.split()[0]: x.split()[1] for x in delta.REGISTRY.split(", ")}
            new_rows = decided.withColumn("status", F.lit("active"))
            new_rows = new_rows.select(*[F.col(c) if c in new_rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()])
            listed_before.write(new_rows.unionByName(delta.mark_deleted(listed_before.rows_of(gone), gone, F.lit(None).cast("timestamp"))), n)
            if n == 2:
                held.compact()
        listed_before.close()
        return held.read().select("source_id", "content_hash", "source")

    return contained(spark, "stored", stored)
