"""WARC archives with revisit records for payloads that were captured before.

A first write puts each page into an archive as a response. Its headers are read back and
shuffled by payload digest: of equal payloads the capture with the smallest id stays a
response, the others become revisits that refer to it. The archives are then written anew
with fresh headers, and revisits without payload. Readers follow the record lengths.

Archives are written and read through Spark, so they may lie in any store that it reaches.
A file is gzip text of one task's records; tasks are bounded by the input split, and
``FILE_RECORDS`` bounds the records of a file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table
from tidemark.session import scratch_path

#: Most records of one archive file.
FILE_RECORDS = 10_000
#: Payloads of fewer bytes are never revisits.
LEAST_PAYLOAD = 0
_END = "\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + _END
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a UTF-8 string: five hexadecimal digits make four."""
    digest = F.sha1(payload.cast("binary"))
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def _record(kind: str, record_id: Column, lines: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its closing line ends; lines with a null value are left out."""
    head = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <"), record_id, F.lit(">")]
    for name, value in lines:
        head.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit("")))
    length = F.octet_length(block).cast("string")
    return F.concat(*head, F.lit("\r\nContent-Length: "), length, F.lit(_END), block)


def _safe(value: Column) -> Column:
    """A header value without blanks and control characters."""
    return F.regexp_replace(value, r"[\x00-\x20\x7F]+", "%20")


def _response(record_id: Column, page: Column, url: Column, digest: Column, html: Column) -> Column:
    lines = [
        ("WARC-Target-URI", _safe(url)),
        ("WARC-Date", F.lit(_DATE)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        ("X-Page-ID", page),
        ("X-Payload-Length", F.octet_length(html)),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ]
    return _record("response", record_id, lines, F.concat(F.lit(_HTTP), html))


def _revisit(
    record_id: Column, page: Column, url: Column, digest: Column, size: Column, to: Column
) -> Column:
    lines = [
        ("WARC-Target-URI", _safe(url)),
        ("WARC-Date", F.lit(_DATE)),
        ("WARC-Profile", F.lit(_PROFILE)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        ("WARC-Refers-To", F.concat(F.lit("<"), to, F.lit(">"))),
        ("X-Page-ID", page),
        ("X-Payload-Length", size),
        ("Content-Type", F.lit("application/http; msgtype=response")),
    ]
    return _record("revisit", record_id, lines, F.lit(_HTTP))


def _write(records: DataFrame, path: str) -> None:
    (
        records.select("record")
        .write.option("lineSep", _END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


def _stream(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, plain or gzip of any members."""
    buffer, source = bytearray(), io.BytesIO(raw)
    unpack = zlib.decompressobj(wbits=31) if raw[:2] == b"\x1f\x8b" else None

    def fill() -> bool:
        nonlocal unpack
        piece = source.read(1 << 20)
        if unpack is None:
            buffer.extend(piece)
            return bool(piece)
        while piece:
            buffer.extend(unpack.decompress(piece))
            piece = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(wbits=31)
                if not piece:
                    break
        return source.tell() < len(raw) or bool(piece)

    at, more = 0, True
    while True:
        while (end := buffer.find(b"\r\n\r\n", at)) < 0 and more:
            more = fill()
        if end < 0:
            return
        lines = buffer[at:end].decode("utf-8", "replace").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        begin, size = end + 4, int(headers["Content-Length"])
        while len(buffer) < begin + size + 4 and more:
            more = fill()
        yield headers, bytes(buffer[begin : begin + size])
        at = begin + size + 4
        if at > 1 << 20:
            del buffer[:at]
            at = 0


_HEADERS = (
    "record_id string, record_type string, url string, digest string, page_id long, "
    "payload_bytes long, refers_to string, payload_ok boolean"
)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Headers of all records below ``path``, with ``payload`` (bytes) if asked for.

    ``payload_ok`` tells whether a response's payload has the length and digest that its
    headers state; null for revisits.
    """

    def parse(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                held = 0
                for headers, block in _stream(content.as_py()):
                    body = block.partition(b"\r\n\r\n")[2]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, ok = headers["WARC-Type"], None
                    size = int(headers["X-Payload-Length"])
                    if kind == "response":
                        actual = base64.b32encode(hashlib.sha1(body).digest()).decode()
                        ok = actual == digest and len(body) == size
                    page = headers.get("X-Page-ID")
                    rows.append(
                        (
                            headers["WARC-Record-ID"].strip("<>"),
                            kind,
                            headers.get("WARC-Target-URI"),
                            digest,
                            None if page is None else int(page),
                            size,
                            headers.get("WARC-Refers-To", "").strip("<>") or None,
                            ok,
                            body if payloads else None,
                        )
                    )
                    held += len(body) if payloads else 200
                    if held > 1 << 22:
                        yield _batch(rows, payloads)
                        rows, held = [], 0
                yield _batch(rows, payloads)

    schema = _HEADERS + (", payload binary" if payloads else "")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path)
    return files.select("content").mapInArrow(parse, schema)


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.string(), pa.bool_(), pa.binary()]
    names = re.findall(r"(\w+) \w+", _HEADERS) + ["payload"]
    width = len(names) if payloads else len(names) - 1
    columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(width)]
    return pa.RecordBatch.from_arrays(columns, names[:width])


def write_captures(pages: DataFrame, path: str) -> None:
    """One response record per row of ``page_id, url, html`` (null html: an empty payload)."""
    html = F.coalesce("html", F.lit(""))
    record = _response(
        F.concat(F.lit("urn:uuid:"), F.expr("uuid()")),
        F.col("page_id"),
        F.coalesce("url", F.lit("about:blank")),
        payload_digest(html),
        html,
    )
    _write(pages.select(record.alias("record")), path)


def resolve_revisits(headers: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """``record_id, refers_to`` of the records that become revisits of another one.

    Captures with equal digest and length are one group; its smallest ``(page_id,
    record_id)`` stays, ids before null.
    """
    group = ["digest", "payload_bytes"]
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")
    original = (
        headers.filter(F.col("payload_bytes") >= least_payload)
        .groupBy(*group)
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select(*group, F.col("first.record_id").alias("original"))
    )
    return (
        headers.join(original, group)
        .filter("record_id != original")
        .select("record_id", F.col("original").alias("refers_to"))
    )


def deduplicate_archives(
    spark: SparkSession, source: str, target: str, least_payload: int = LEAST_PAYLOAD
) -> None:
    """Write the archives below ``source`` again, with revisits for repeated payloads."""
    headers = staged(read_archives(spark, source), "warc-headers")
    revisits = staged(resolve_revisits(headers, least_payload), "warc-revisits")
    records = read_archives(spark, source, payloads=True).select(
        "record_id", "url", "digest", "page_id", "payload_bytes", "payload"
    )
    joined = records.join(revisits, "record_id", "left")
    html = F.col("payload").cast("string")
    fresh = F.when(
        F.col("refers_to").isNull(),
        _response(F.col("record_id"), F.col("page_id"), F.col("url"), F.col("digest"), html),
    ).otherwise(
        _revisit(
            F.col("record_id"),
            F.col("page_id"),
            F.col("url"),
            F.col("digest"),
            F.col("payload_bytes"),
            F.col("refers_to"),
        )
    )
    _write(joined.select(fresh.alias("record")), target)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """What the deduplicated archives say about every page.

    Null html is an empty payload; repeated rows are captures of their own, of which one
    stays a response. An empty table gives an empty result.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    captured, final = scratch_path(spark, "warc-captured"), scratch_path(spark, "warc-final")
    write_captures(pages, captured)
    deduplicate_archives(spark, captured, final)
    rows = staged(read_archives(spark, final), "warc-read")
    responses = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("original_page")
    )
    return rows.join(responses, "refers_to", "left").select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("original_page").alias("refers_to"),
    )
