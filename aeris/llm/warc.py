r"""WARC archives through a chunked record table.

``chunk_table`` turns pages into rows (record, chunk number, data) of bounded
size, each with the length and SHA-256 of the payload so far, so that the last row
of a record knows both for the whole without anything holding the whole twice.
Only those last rows, without data, are kept to find equal payloads; the chunks
are made again when the archives are written, and reach them through one shuffle.
Archives are plain WARC 1.1 files that Spark's text writer makes: one row
is one record, the record separator is the line separator; files are gzipped.  A payload of more than one
chunk becomes a segmented record (first segment and ``continuation`` records), so no row grows
with its payload.

Reading splits the files at the version line.  So that no payload can pass for one, a
chunk also ends inside every ``WARC/1.1`` that a payload holds (its end, where CRLF follows, included), and a URL that ends so is
written with %2F.  A gzip file is read by one task, so files are bounded by ``FILE_RECORDS`` records of a chunk
each; Content-Length is checked for every record.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the smallest page_id (null
ids last) is ``response``, the others are ``revisit`` records without payload.  Defined cases: null html counts as empty; a null page_id or url is written as an empty
header and read back as null; rows that share a page_id are records of their own, of one type where the html is equal too; an empty table gives
an empty archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeris.llm.common import Scratch, materialize, read_table
from aeris.session import scratch_path

CHUNK = 1 << 16  # characters
LEAST_REVISIT = 100  # bytes
DATE = "2000-01-01T00:00:00Z"
TOKEN = "WARC/1.1"
VERSION = f"{TOKEN}\r\n"
FILE_RECORDS = 1 << 13  # in one archive file, at most: gzip files are read by one task each
_BATCH = 1 << 23  # bytes of data a batch of chunks holds, about
_CHUNK_SCHEMA = ("record long, page_id long, url string, chunk int, data string, bytes_so_far long, "
                 "digest_so_far string, last boolean, payload_bytes long, payload_digest string")


def pieces(text: str, size: int = CHUNK):
    """The text in pieces of at most ``size`` characters; none holds the token that starts a version line."""
    start, n = 0, len(text)
    while True:
        end = min(start + size, n)
        mark = text.find(TOKEN, start, end)
        if mark >= 0:
            end = mark + len(TOKEN) // 2
        yield text[start:end]
        start = end
        if start >= n:
            return


def chunk_table(pages: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows (record, page_id, url, chunk, data, bytes_so_far, digest_so_far, last, payload_bytes, payload_digest).

    ``record`` holds the chunks of one row together; a task that is run again gives the same numbers.
    """
    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                          F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    names = [f.split()[0] for f in _CHUNK_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.bool_(),
             pa.int64(), pa.string()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=names)

    def run(batches):
        rows, held, number = [], 0, TaskContext.get().partitionId() << 33
        for b in batches:
            for page, url, html in zip(*b.columns, strict=True):
                text, number = html.as_py(), number + 1
                whole, length = hashlib.sha256(), 0
                for part in pieces(text, size):
                    raw = part.encode("utf-8")
                    whole.update(raw)
                    length += len(raw)
                digest, total, done = hashlib.sha256(), 0, 0
                for k, part in enumerate(pieces(text, size)):
                    raw = part.encode("utf-8")
                    digest.update(raw)
                    total += len(raw)
                    held += len(raw)
                    done += len(part)
                    rows.append((number, page.as_py(), url.as_py(), k, part, total, digest.hexdigest(), done == len(text),
                                 length, whole.hexdigest()))
                    if held >= _BATCH:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    return source.mapInArrow(run, _CHUNK_SCHEMA)


def revisits(chunks: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the records whose payload an earlier page has."""
    whole = chunks.filter("last").select("page_id", F.col("bytes_so_far").alias("n"), F.col("digest_so_far").alias("payload_digest"))
    whole = materialize(whole.filter(F.col("n") >= least).groupBy("page_id", "payload_digest").agg(F.count(F.lit(1)).alias("n")),
                        "warc-digests")
    shared = whole.groupBy("payload_digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("x"), F.col("page_id").alias("p"))).alias("first"))
    return whole.drop("n").join(shared.filter("n > 1").select("payload_digest", "first"), "payload_digest").filter(
        ~F.col("page_id").eqNullSafe(F.col("first.p"))).select("page_id", "payload_digest", F.col("first.p").alias("refers_to"))


def _urn(page: Column, digest: Column, chunk: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("null")), digest, chunk.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[h.substr(a, n) for a, n in
                                                           ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line; none where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write_archive(chunks: DataFrame, revisits: DataFrame, path: str, date: str = DATE) -> None:
    """Write the chunk table as WARC files under ``path``; revisits keep their headers only."""
    again_ = revisits.select(F.col("page_id").alias("_p"), F.col("payload_digest").alias("_d"), "refers_to", F.lit(True).alias("revisit"))
    rows = chunks.join(again_, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("payload_digest") == F.col("_d")), "left")
    rows = rows.withColumn("revisit", F.coalesce("revisit", F.lit(False))).filter(~F.col("revisit") | (F.col("chunk") == 0))
    first, again = F.col("chunk") == 0, F.col("revisit")
    segmented = ~again & (~first | ~F.col("last"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(F.when(first, http).otherwise(F.lit("")), F.when(again, F.lit("")).otherwise(F.col("data")))
    kind = F.when(again, F.lit("revisit")).when(first, F.lit("response")).otherwise(F.lit("continuation"))
    url = F.regexp_replace(F.regexp_replace(F.col("url"), r"[\x00-\x20\x7f]", "%20"), re.escape(TOKEN) + "$", quote(TOKEN, safe=""))
    record = F.concat(
        F.lit(VERSION), _header("WARC-Type", kind), _header("WARC-Record-ID", _urn(F.col("page_id"), F.col("payload_digest"), F.col("chunk"))),
        _header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", url),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha256:"), F.col("payload_digest")))),
        _header("WARC-Profile", F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", F.when(again, _urn(F.col("refers_to"), F.col("payload_digest"), F.lit(0)))),
        _header("WARC-Segment-Number", F.when(segmented, F.col("chunk") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(segmented & ~first, _urn(F.col("page_id"), F.col("payload_digest"), F.lit(0)))),
        _header("WARC-Segment-Total-Length", F.when(segmented & F.col("last"),
                                                    F.col("payload_bytes") + F.octet_length(http))),
        _header("Record-Number", F.col("record")), _header("Page-Id", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        _header("Refers-To-Page-Id", F.when(again, F.coalesce(F.col("refers_to").cast("string"), F.lit("")))),
        _header("Content-Length", F.octet_length("_block")), F.lit("\r\n"), F.col("_block"))
    rows.withColumn("_block", block).select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS).text(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record below ``path``: its headers and its part of the payload (null for revisits)."""
    raw = spark.read.option("lineSep", VERSION).text(path).filter(F.length("value") > 0)
    head = F.substring_index("value", "\r\n\r\n", 1)

    def named(name: str) -> Column:
        return F.nullif(F.regexp_extract(F.concat(F.lit("\r\n"), F.col("_head")), rf"\r\n{name}: ?([^\r]*)", 1), F.lit(""))

    body = F.expr("substring(value, length(_head) + 5, length(value) - length(_head) - 8)")
    rows = raw.withColumn("_head", head).select(
        named("WARC-Type").alias("type"), named("Record-Number").cast("long").alias("record"),
        named("Page-Id").cast("long").alias("page_id"), named("WARC-Target-URI").alias("url"),
        F.coalesce(named("WARC-Segment-Number").cast("int"), F.lit(0)).alias("segment"),
        F.substring_index(named("WARC-Payload-Digest"), ":", -1).alias("stated_digest"),
        named("Refers-To-Page-Id").cast("long").alias("refers_to"),
        named("Content-Length").cast("long").alias("length"), body.alias("block"))
    sound = rows.withColumn("block", F.when(F.octet_length("block") == F.col("length"), F.col("block")).otherwise(
        F.raise_error(F.concat(F.lit("record cut short: "), F.col("record").cast("string")))))
    http = F.when(F.col("type") == "continuation", F.lit("")).otherwise(
        F.concat(F.substring_index("block", "\r\n\r\n", 1), F.lit("\r\n\r\n")))
    return sound.withColumn("_http", http).select(
        "type", "record", "page_id", "url", "segment", "stated_digest", "refers_to",
        F.nullif(F.regexp_extract("_http", r"\r\nContent-Length: ?(\d+)", 1), F.lit("")).cast("long").alias("stated_bytes"),
        F.when(F.col("type") != "revisit", F.expr("substring(block, length(_http) + 1)")).alias("data"))


_RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                  "url string, stated_digest string")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: length and digest of the payload that was read, its type and the page it refers to.

    Records in one piece are digested where they are read.  Segments of larger ones are brought
    together in order and digested one after the other, never joined.
    """
    parts = read_segments(spark, path)
    full = F.col("type") == "response"
    single = parts.filter(F.col("segment") == 0).select(
        "page_id", F.when(full, F.octet_length("data").cast("long")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(full, F.sha2(F.col("data").cast("binary"), 256)).otherwise(F.col("stated_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(~full, F.col("refers_to")).alias("refers_to"), "url", "stated_digest")
    segments = parts.filter(F.col("segment") > 0).select("record", "segment", "page_id", "url", "stated_digest", "data")
    in_order = segments.repartition("record").sortWithinPartitions("record", "segment")
    names = [f.split()[0] for f in _RECORD_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def fold_segments(batches):
        open_, digest, total, done = None, None, 0, []

        def closed():
            record, page, url, stated = open_
            return (page, total, digest.hexdigest(), "response", None, url, stated)

        for b in batches:
            for record, _, page, url, stated, data in zip(*b.columns, strict=True):
                if open_ is None or open_[0] != record.as_py():
                    if open_ is not None:
                        done.append(closed())
                    open_, digest, total = (record.as_py(), page.as_py(), url.as_py(), stated.as_py()), hashlib.sha256(), 0
                part = (data.as_py() or "").encode("utf-8")
                digest.update(part)
                total += len(part)
        if open_ is not None:
            done.append(closed())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
                                             names=names)

    whole = single.unionByName(in_order.mapInArrow(fold_segments, _RECORD_SCHEMA))
    return whole.withColumn("payload_digest", F.when(F.col("payload_digest") == F.col("stated_digest"), F.col("payload_digest"))
                            .otherwise(F.raise_error(F.concat(F.lit("digest differs: page "), F.col("page_id").cast("string"))))
                            ).drop("stated_digest")


def archive(pages: DataFrame, path: str | None = None, size: int = CHUNK) -> str:
    """Write ``pages`` as archives and give their folder; nothing else is left behind."""
    path = path or scratch_path(pages.sparkSession, "warc")
    chunks = chunk_table(pages, size)
    with Scratch(pages.sparkSession):
        write_archive(chunks, revisits(chunks), path)
    return path


def op8_warc(spark, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return read_archive(spark, archive(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
