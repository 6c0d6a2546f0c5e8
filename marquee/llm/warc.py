"""WARC archives with revisit records instead of repeated payloads."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import cut_lineage, fits_broadcast

# Fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 16_000_000
DATE = "1970-01-01T00:00:00Z"


def classified(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(id, url, payload, size, digest, original): ``original`` is the id of the response with the same payload.

    Only headers (digest, size, id) are reduced by digest, before the shuffle; the one row a digest has is then
    joined back (broadcast when measured small), so a payload that a third of all pages share is one row on that
    side, and its pages can be split over tasks.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("bigint").alias("size"), F.sha1("payload").alias("digest"))
    headers = rows.filter(F.col("size") >= least).groupBy("digest").agg(F.max("id").alias("largest"), F.count(F.lit(1)).alias("n"))
    headers = cut_lineage(headers.filter("n > 1 AND largest IS NOT NULL").select(F.col("digest").alias("of"), "largest"))
    side = F.broadcast(headers) if fits_broadcast(headers) else headers
    joined = rows.join(side, F.col("digest") == F.col("of"), "left")
    original = F.when(F.col("id").isNull() | (F.col("id") != F.col("largest")), F.col("largest"))
    return joined.select("id", "url", "payload", "size", "digest", original.alias("original"))


def _header(*lines: tuple[str, Column | str]) -> Column:
    parts = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF)) for name, value in lines if name]
    return F.concat(F.lit(VERSION + CRLF), *[F.coalesce(p, F.lit("")) for p in parts], F.lit(CRLF))


def _uri(ident: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(ident.cast("string"), F.lit("null")), F.lit(">"))


def records(classified_pages: DataFrame) -> DataFrame:
    """One text a record: fresh headers, and the payload for responses only."""
    revisit = F.col("original").isNotNull()
    url = F.regexp_replace("url", r"[\r\n]+", "%0A")
    head = _header(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", _uri(F.col("id"))),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        ("WARC-Refers-To", F.when(revisit, _uri(F.col("original")))),
        ("X-Payload-Length", F.col("size").cast("string")),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
    )
    return classified_pages.select(F.concat(head, F.when(revisit, "").otherwise(F.col("payload"))).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write ``pages`` as gzipped WARC files under ``path``, any folder Spark can write.

    A record ends with two line ends, which is how Spark's text writer ends a row here, so the archives are
    committed by Spark's own protocol and survive lost executors. Payloads go from the scan to the files; a file
    holds as many records as make about ``FILE_BYTES`` on average.
    """
    rows = classified(pages, id_col, url_col, payload_col)
    size, count = pages.agg(F.coalesce(F.sum(F.octet_length(payload_col)), F.lit(0)), F.count(F.lit(1))).first()
    each = max(1, FILE_BYTES * count // size) if size else 10_000
    records(rows).write.mode("overwrite").option("compression", "gzip").option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", each).text(path)


FIELD = re.compile(rb"([^:\r\n]+): ([^\r\n]*)")


def parse(data: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and content of each record of an unpacked archive, by content length, a record at a time."""
    while line := data.readline():
        head = {}
        while line != b"\r\n":
            if m := FIELD.match(line):
                head[m[1].decode()] = m[2].decode("utf-8", "replace")
            line = data.readline()
            if not line:
                raise ValueError("an archive breaks off in a record's headers")
        body = data.read(int(head["Content-Length"]))
        if data.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head.get('WARC-Record-ID')} does not end where its length says")
        yield head, body


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("content", pa.binary())])
    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for head, body in parse(gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer()))):
                names = ("WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Refers-To")
                kind, ident, url, digest, refers = (head.get(n) for n in names)
                rows.append((kind, ident, url, digest.removeprefix("sha1:"), refers, int(head["X-Payload-Length"]), body))
                size += len(body)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record under ``path``: (page_id, url, record_type, refers_to, payload_digest, payload_bytes, content).

    The digest and size of a response are made anew from its content; a revisit has those of its headers, and no
    content. A task holds one packed file and a few records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    found = files.mapInArrow(_read, "record_type string, record_id string, url string, digest string, refers_to string, payload_bytes bigint, content binary")
    revisit = F.col("record_type") == "revisit"

    def page(c):
        return F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")

    return found.select(
        page("record_id").alias("page_id"),
        "url",
        "record_type",
        page("refers_to").alias("refers_to"),
        F.when(revisit, F.col("digest")).otherwise(F.sha1("content")).alias("payload_digest"),
        F.when(revisit, F.col("payload_bytes")).otherwise(F.octet_length("content").cast("bigint")).alias("payload_bytes"),
        F.when(~revisit, F.col("content")).alias("content"),
    )


def resolved(archived: DataFrame) -> DataFrame:
    """Records with the content of the response each revisit refers to; joined by page, revisits without one keep null."""
    original = archived.filter("record_type = 'response'").select(F.col("page_id").alias("of"), F.col("payload_digest").alias("own"), F.col("content").alias("found")).dropDuplicates(["of", "own"])
    revisits = archived.filter("record_type = 'revisit'").drop("content")
    full = revisits.join(original, (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("own")), "left")
    return archived.filter("record_type = 'response'").unionByName(full.drop("of", "own").withColumnRenamed("found", "content"))
