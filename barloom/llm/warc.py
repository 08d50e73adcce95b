"""WARC archives: writing captures, reading records, assembling transactions.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record;
the request and the metadata name the response in WARC-Concurrent-To. Archives are written
by Spark's own text writer, with the blank lines that close a record as line separator, so
they go to any file system Spark writes and take part in its commit protocol. They are read
as whole files of bounded size and parsed by Content-Length.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 32 << 20

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("concurrent_to", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("warc_date", T.StringType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("block_bytes", T.LongType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("computed_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()),
])


def base32_sha1(content: Column) -> Column:
    """Bare upper-case base32 SHA-1, from built-in functions: 160 bits are 32 groups of 5."""
    bits = F.concat(*[
        F.lpad(F.conv(F.substring(F.sha1(content), 1 + 10 * i, 10), 16, 2), 40, "0")
        for i in range(4)])
    letters = [F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
                           F.conv(F.substring(bits, 1 + 5 * i, 5), 2, 10).cast("int") + 1, 1)
               for i in range(32)]
    return F.concat(*letters)


def _uri(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"<urn:capture:{kind}:"), key, F.lit(">"))


def _clean(value: Column) -> Column:
    """Header values hold no line ends."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), "[\r\n]+", " ")


def plan_captures(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                  html: str = "html", least: int = 0) -> DataFrame:
    """One row per page: capture key, payload, its SHA-1 and the page whose record it revisits.

    Of pages with equal payloads of at least `least` bytes, the one with the largest id is
    the response. Equal payloads are found by length and SHA-1. Only groups of two or more are
    joined back, as a plain equi join that Spark splits when one payload is hot. Pages with a
    NULL id are responses of their own; a row that repeats the largest id is a response too.
    """
    base = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"))
    base = base.withColumn("sha1", F.sha1("payload")).withColumn(
        "size", F.octet_length("payload").cast("long"))
    groups = (base.where((F.col("size") >= least) & F.col("page_id").isNotNull())
              .groupBy("sha1", "size")
              .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("sha1", "size", "first_id"))
    return base.join(groups, ["sha1", "size"], "left").select(
        "page_id", "url", "payload", "size", "sha1",
        F.when(F.col("first_id") != F.col("page_id"), F.col("first_id")).alias("refers_to"))


def _block(kind: str, record_id: Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit(f"{VERSION}{LINE}WARC-Type: {kind}{LINE}WARC-Record-ID: "), record_id]
    for name, value in headers:
        lines += [F.when(value.isNotNull(), F.concat(F.lit(f"{LINE}{name}: "), value))
                  .otherwise(F.lit(""))]
    lines += [F.lit(f"{LINE}Content-Length: "), F.octet_length(block).cast("string"),
              F.lit(LINE * 2), block]
    return F.concat(*lines)


def write_archives(captures: DataFrame, path: str, warc_date: str = "2020-01-01T00:00:00Z",
                   file_bytes: int = FILE_BYTES) -> None:
    """Write the rows of `plan_captures` as gzipped WARC files of about file_bytes of content.

    The capture key is the payload's SHA-1 and the page id, or `null-` and a fresh UUID where
    there is none, so that pages which share an id are captures of their own. Rows that repeat
    id and payload write their records again under the same key; `assemble` counts them.
    """
    captures = captures.withColumn("key", F.concat("sha1", F.lit(":"), F.coalesce(
        F.col("page_id").cast("string"), F.concat(F.lit("null-"), F.expr("uuid()")))))
    key = F.col("key")
    uri = _clean(F.col("url"))
    date = F.lit(warc_date)
    anchor = _uri("response", key)
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))
    head = F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE * 2}")
    common = [("WARC-Target-URI", uri), ("WARC-Date", date)]
    response = _block("response", anchor, [
        *common, ("WARC-Payload-Digest", digest),
        ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(head, F.col("payload")))
    revisit = _block("revisit", anchor, [
        *common, ("WARC-Payload-Digest", digest), ("WARC-Profile", F.lit(PROFILE)),
        ("WARC-Refers-To", _uri("response", F.concat("sha1", F.lit(":"), F.col("refers_to").cast("string")))),
        ("Content-Type", F.lit("application/http; msgtype=response"))], head)
    request = _block("request", _uri("request", key), [
        *common, ("WARC-Concurrent-To", anchor),
        ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{LINE * 2}")))
    metadata = _block("metadata", _uri("metadata", key), [
        *common, ("WARC-Concurrent-To", anchor), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("payloadLength: "), F.col("size").cast("string"), F.lit(LINE)))
    close = F.lit(LINE * 2)
    record = F.concat(request, close,
                      F.when(F.col("refers_to").isNull(), response).otherwise(revisit), close, metadata)
    # Records a file: so many pages of mean size; the mean of the whole table is one cheap pass.
    mean = captures.agg(F.avg("size")).first()[0] or 0
    per_file = max(1, int(file_bytes / (mean + 1500)))
    (captures.select(record.alias("value")).write
     .option("lineSep", LINE * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def _inflate(content: bytes) -> bytes:
    """All gzip members, or the bytes as they are."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content) + member.flush())
        content = member.unused_data
        if content[:2] != b"\x1f\x8b":
            break
    return b"".join(out)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record; Content-Length alone bounds a block."""
    data, at = _inflate(content), 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record header at byte {at}")
        headers = {}
        for line in data[at:end].decode("utf-8", "replace").split(LINE)[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        if len(data) < end + 4 + size:
            raise ValueError(f"record at byte {at} is cut short")
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size


def _row(headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind = headers.get("warc-type")
    fields, payload = {}, None
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    elif headers.get("content-type", "").startswith("application/warc-fields"):
        for line in block.decode("utf-8", "replace").split("\n"):
            name, colon, value = line.partition(":")
            if colon:
                fields[name.strip()] = value.strip()
    digest = None
    if kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload or b"").digest()).decode()
    return {
        "record_id": headers.get("warc-record-id"), "record_type": kind,
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"),
        "warc_date": headers.get("warc-date"),
        "payload_digest": headers.get("warc-payload-digest"), "fields": list(fields.items()),
        "block_bytes": len(block), "payload_bytes": None if payload is None else len(payload),
        "computed_digest": digest, "payload": payload if payloads else None,
    }


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives under path. payloads=False leaves the payload bytes out;
    lengths and digests are computed all the same."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = pa.schema([
        *[(n, pa.string()) for n in ("record_id", "record_type", "concurrent_to", "refers_to",
                                     "target_uri", "warc_date", "payload_digest")],
        ("fields", pa.map_(pa.string(), pa.string())), ("block_bytes", pa.int64()),
        ("payload_bytes", pa.int64()), ("computed_digest", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for headers, block in parse_records(batch.column(0)[i].as_py()):
                    rows.append(_row(headers, block, payloads))
                    held += len(block) if payloads else 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: request, response (or revisit) and metadata.

    The key is the record that request and metadata are concurrent to. Partial aggregates
    only: of several records of one kind under a key, the one with the smallest id (then
    date) stays and `copies` has how many there were. Requests or metadata without a
    response give a row whose response is NULL.
    """
    anchor = F.col("record_type").isin("response", "revisit", "resource")
    kinds = {"request": F.col("record_type") == "request", "response": anchor,
             "metadata": F.col("record_type") == "metadata"}
    body = F.struct("record_id", "warc_date", *[c for c in records.columns
                                                if c not in ("record_id", "warc_date", "fields")],
                    F.map_entries("fields").alias("fields"))
    key = F.when(anchor, F.col("record_id")).otherwise(
        F.coalesce(F.col("concurrent_to"), F.col("record_id")))
    keyed = records.where(F.col("record_type").isin(
        "request", "response", "revisit", "resource", "metadata")).withColumn("capture_id", key)
    return keyed.groupBy("capture_id").agg(
        *[F.min(F.when(test, body)).alias(name) for name, test in kinds.items()],
        F.struct(*[F.count(F.when(test, 1)).alias(name)
                   for name, test in kinds.items()]).alias("copies"))
