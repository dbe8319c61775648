"""Content-addressed web archive (WARC 1.1), DataFrame functions only.

``write`` stores each different payload once, under its SHA-256, and each record's exact header bytes apart from it; both are Parquet tables in one folder. Of
records with equal payloads one is the response, the others revisit it. ``read`` joins headers and payloads to the original records again and
verifies the digests; ``serialized`` gives the bytes of a WARC file's record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.storage import fresh, materialize, scratch

# Names and forms of the archive format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
#: A record's id is this and its page's key.
ID = "urn:page:"
#: Records that meet one copy of a payload while originals are rebuilt: a share of all, so that a hot payload has several.
SHARE, LEAST = 1024, 64


def base32(sha1_hex: Column) -> Column:
    """Base32 of a SHA-1 in hex: 160 bits are four groups of 40, eight digits each."""
    groups = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), HEX32, BASE32)


def _line(name: str, value: Column) -> Column:
    """A header line, nothing where there is no value; line ends within a value would end it, so they are escaped."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(END)), F.lit(""))


def field(header: Column, name: str) -> Column:
    """A field's value in a record's header bytes (the archive's own part of it); null if it isn't there."""
    return F.get(F.regexp_extract_all(F.substring_index(F.decode(header, "UTF-8"), END + END, 1), F.lit(rf"\r\n{name}: ([^\r\n]*)"), F.lit(1)), F.lit(0))


def _headers(date: str) -> Column:
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END + END))
    revisit = F.col("refers").isNotNull()
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    lines = [
        F.lit(VERSION + END),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("k").cast("string"), F.lit("")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.col("refers")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(END),
        http,
    ]
    return F.concat(*lines).cast("binary")


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archives pages under ``path``: ``payloads`` (digest, payload) and ``records`` (digest, header).

    The payload is the page in UTF-8, null: empty. Of equal payloads of ``least_bytes`` or more, the record of the smallest key (nulls last, then by url) is the response and the
    others refer to it; smaller ones are all responses. Of rows that are wholly equal, one is the response. Keys and urls come back as they are, but for line ends in a url.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    # a row's name is exact: digest, key and url
    named = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("id", F.to_json(F.struct("digest", "k", "url")))
    marked = materialize(named.select("id", "digest", "k", "url", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1")), "digests")
    # copies are reduced where they lie
    order = F.struct(F.col("k").isNull().alias("no"), "k", F.col("url").isNull().alias("none"), "url", "id")
    first = marked.groupBy("digest").agg(F.min(order).alias("f"))
    first = materialize(first.select("digest", F.col("f.id").alias("first"), F.col("f.k").alias("fk")), "first")
    # the row that a payload is stored from is found by its name, so no task gets a payload's copies
    chosen = named.select("id", "digest", "payload").join(first.select(F.col("first").alias("id")), "id", "left_semi")
    chosen.groupBy("id").agg(F.any_value("digest").alias("digest"), F.any_value("payload").alias("payload")).drop("id").write.parquet(f"{path}/payloads")
    refers = F.when(F.col("payload_bytes") >= least_bytes, F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("fk").cast("string"), F.lit("")), F.lit(">")))
    met = _met(marked, first, "digest")
    # only rows that are wholly equal can be first more than once
    again = F.row_number().over(Window.partitionBy("id").orderBy(F.lit(0)))
    one = met.where("id = first").withColumn("no", again).withColumn("refers", F.when(F.col("no") > 1, refers)).drop("no")
    both = one.unionByName(met.where("id <> first").withColumn("refers", refers))
    both.select("digest", _headers(date).alias("header")).write.parquet(f"{path}/records")


def _met(rows: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of their key; values: one row a key. A hot key's value is copied, one copy for each share of the rows, so no task gets them all; only the numbers of copies are broadcast."""
    share = max(LEAST, rows.count() // SHARE)
    found = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > share).select(key, F.ceil(F.col("n") / share).cast("int").alias("copies"))
    hot = F.broadcast(rows.sparkSession.createDataFrame(found.collect(), found.schema))  # fewer than SHARE rows
    copies = F.coalesce("copies", F.lit(1))
    spread = values.join(hot, key, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
    dealt = rows.join(hot, key, "left").withColumn("copy", F.pmod(F.xxhash64(*rows.columns), copies).cast("int")).drop("copies")
    return dealt.join(spread, [key, "copy"]).drop("copy")


def read(spark: SparkSession, path: str, key_type: str = "long") -> DataFrame:
    """(key, url, record_type, refers_to, header, payload, verified) per record of an archive: the original record, payload and all, for revisits too.

    refers_to: the key of the response that a revisit refers to. verified: the payload's SHA-256 is the one it is stored under, and its SHA-1 is that of the header.
    """
    records, payloads = spark.read.schema("digest string, header binary").parquet(f"{path}/records"), spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    rows = _met(records, payloads, "digest")
    page = lambda name: F.nullif(F.regexp_extract(field(F.col("header"), name), f"^<{ID}(.*)>$", 1), F.lit(""))
    right = (F.sha2("payload", 256) == F.col("digest")) & F.coalesce(field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32(F.sha1("payload"))), F.lit(False))
    return rows.select(page("WARC-Record-ID").cast(key_type).alias("key"), field(F.col("header"), "WARC-Target-URI").alias("url"), field(F.col("header"), "WARC-Type").alias("record_type"), page("WARC-Refers-To").cast(key_type).alias("refers_to"), "header", "payload", right.alias("verified"))


def serialized(records: DataFrame) -> Column:
    """A record's bytes in a WARC file: a revisit's end with its header."""
    return F.concat(F.col("header"), F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload")), F.lit((END + END).encode()))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) as read back from an archive of the pages in the shared folder; a payload that does not verify is an error."""
    spark = pages.sparkSession
    path = fresh(spark, "warc")
    with scratch(spark):
        write(pages, path, key, url, html, least_bytes)
    got = read(spark, path, pages.schema[key].dataType.simpleString())
    sound = F.when(F.col("verified"), F.col("payload")).otherwise(F.raise_error(F.lit("a payload's digest is not the one it is stored under")).cast("binary"))
    return got.withColumn("payload", sound).select(F.col("key").alias(key), F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"), "record_type", "refers_to")
