"""WARC archives of pages: written, read back and assembled into captures.

Every page gives three records: a request, a response (or a revisit of an equal
payload) and a metadata record that names the page. Request and metadata point
at the response through WARC-Concurrent-To. Records are text with a UTF-8
payload, so Spark's text writer makes the files: a record is a line, and the
line separator is the two CRLFs that end a record. Files are gzip streams of a
bounded number of records; the reader inflates them piece by piece and holds one
record and one batch at a time. It goes by Content-Length, so payloads may contain
separators and whole records.

Of equal payloads (by length and SHA-1) the largest page_id is the response;
rows that repeat this page_id and payload are responses as well. Record ids name the
page_id and the payload, so rows of one page_id with different payloads are captures
of their own. A null page_id is smaller than any other; a null html is an empty
payload. Rows that repeat a page_id give one capture each.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS_PER_FILE = 3000
PIECE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"  # captures carry no time of their own

# The alphabet of base 32, and the digits of Spark's conv.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(text: Column) -> Column:
    """SHA-1 of a UTF-8 text in upper-case base 32: four groups of 40 bits, eight digits each."""
    digest = F.sha1(text.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), _CONV, _BASE32)


def _record_id(kind: str, page_id: Column) -> Column:
    """Id of a record of the page and payload (columns digest and size) at hand."""
    name = F.concat_ws(":", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("null")), "size", "digest")
    digest = F.md5(name.cast("binary"))
    parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str | Column, own: Column, fields: dict[str, Column], block: Column) -> Column:
    head = [F.lit("WARC/1.1" + CRLF + "WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind, F.lit(CRLF + "WARC-Record-ID: "), own, F.lit(CRLF + f"WARC-Date: {DATE}" + CRLF)]
    for name, value in fields.items():
        head.append(F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block)


def write_archive(pages: DataFrame, path: str) -> None:
    """Write request, response or revisit, and metadata records of pages (page_id, url, html) under ``path``."""
    rows = pages.select(F.col("page_id").cast("long"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html"))).withColumn("size", F.octet_length("html"))
    tops = rows.groupBy("digest", "size").agg(F.max("page_id").alias("top"))
    rows = rows.join(tops, ["digest", "size"])
    page, top = F.col("page_id"), F.col("top")
    again = ~(page.eqNullSafe(top))
    own, url = _record_id("response", page), F.col("url")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    response = _record(
        F.when(again, "revisit").otherwise("response"), own,
        {"WARC-Target-URI": url, "WARC-Payload-Digest": F.concat(F.lit("sha1:"), "digest"),
         "WARC-Profile": F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
         "WARC-Refers-To": F.when(again, _record_id("response", top)), "Content-Type": F.lit("application/http;msgtype=response")},
        F.when(again, http).otherwise(F.concat(http, "html")))
    request = _record("request", _record_id("request", page), {"WARC-Target-URI": url, "WARC-Concurrent-To": own, "Content-Type": F.lit("application/http;msgtype=request")},
                      F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1" + CRLF + CRLF)))
    metadata = _record("metadata", _record_id("metadata", page), {"WARC-Target-URI": url, "WARC-Concurrent-To": own, "Content-Type": F.lit("application/warc-fields")},
                       F.concat(F.lit("page-id: "), F.coalesce(page.cast("string"), F.lit("null")), F.lit(CRLF)))
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.mode("overwrite").option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_FIELDS = ("kind", "record_id", "target", "concurrent_to", "refers_to", "digest")
_HEADERS = (b"warc-type", b"warc-record-id", b"warc-target-uri", b"warc-concurrent-to", b"warc-refers-to", b"warc-payload-digest")
RECORD_SCHEMA = ", ".join(f"{f} string" for f in _FIELDS) + ", payload_bytes long, payload_digest string, page string"


def parse_records(pieces: Iterable[bytes]):
    """(header fields by lower-case name, block) of each record of an uncompressed archive that comes in pieces."""
    pieces, data = iter(pieces), bytearray()

    def more() -> bool:
        piece = next((p for p in pieces if p), None)
        data.extend(piece or b"")
        return piece is not None

    while data or more():
        while (end := data.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("archive ends inside a record header")
        lines = bytes(data[:end]).split(b"\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:])}
        start, size = end + 4, int(fields[b"content-length"])
        while len(data) < start + size + 4:
            if not more():
                raise ValueError("archive ends inside a record")
        yield fields, bytes(data[start:start + size])
        del data[:start + size + 4]


def _inflated(content: memoryview):
    """Pieces of a gzip stream, each of at most PIECE_BYTES."""
    stream = zlib.decompressobj(31)
    for at in range(0, len(content), PIECE_BYTES):
        rest = content[at:at + PIECE_BYTES]
        while len(rest):
            yield stream.decompress(rest, PIECE_BYTES)
            rest = stream.unconsumed_tail
    yield stream.flush()


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``: RECORD_SCHEMA, and ``payload`` binary when asked for."""
    types = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [*_FIELDS, "payload_bytes", "payload_digest", "page", "payload"]
    keep = 10 if with_payload else 9

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for fields, block in parse_records(_inflated(memoryview(content.as_buffer()))):
                    values = [fields[h].decode() if h in fields else None for h in _HEADERS]
                    kind, payload, page = values[0], None, None
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                    elif kind == "metadata":
                        page = block.partition(b":")[2].strip().decode()
                    values += [None if payload is None else len(payload), None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode(), page, payload]
                    rows.append(values[:keep])
                    held += len(payload or b"") if with_payload else 0
                    if held > BATCH_BYTES or len(rows) >= RECORDS_PER_FILE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names[:keep])
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names[:keep])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, RECORD_SCHEMA + (", payload binary" if with_payload else ""))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page_id, request, response (response or revisit, with the payload it stands for) and metadata.

    ``records`` is read once per kind of record: pass a written table.
    """
    extra = ["payload"] if "payload" in records.columns else []
    of = {kind: records.where(F.col("kind") == kind) for kind in ("request", "metadata")}
    asked = of["request"].groupBy(F.col("concurrent_to").alias("asked_by")).agg(F.min(F.struct("record_id", "target")).alias("request"))
    about = of["metadata"].groupBy(F.col("concurrent_to").alias("told_by")).agg(F.min(F.struct("record_id", "page")).alias("metadata"))
    answers = records.where(F.col("kind").isin("response", "revisit"))
    captures = answers.join(asked, F.col("record_id") == F.col("asked_by"), "left").join(about, F.col("record_id") == F.col("told_by"), "left")
    page = F.expr("try_cast(metadata.page AS bigint)")
    body = ["payload_bytes", "payload_digest", *extra]
    first = captures.where("kind = 'response'").select(page.alias("page_id"), "kind", "record_id", "target", F.lit(None).cast("long").alias("refers_to"), *body, "request", "metadata")
    sources = first.groupBy("record_id").agg(F.min(F.struct("page_id", *body)).alias("source")).withColumnRenamed("record_id", "source_id")
    again = captures.where("kind = 'revisit'").join(sources, F.col("refers_to") == F.col("source_id"), "left").select(
        page.alias("page_id"), "kind", "record_id", "target", F.col("source.page_id").alias("refers_to"),
        "source.payload_bytes", F.coalesce("source.payload_digest", F.regexp_replace("digest", "^sha1:", "")).alias("payload_digest"), *(f"source.{c}" for c in extra), "request", "metadata")
    return first.unionByName(again).select("page_id", F.struct("kind", "record_id", "target", "refers_to", *body).alias("response"), "request", "metadata")
