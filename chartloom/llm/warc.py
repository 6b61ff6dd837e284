"""WARC archives: writing, streamed reading, and revisit resolution.

Archives are gzip files of WARC/1.1 records. Spark's text source writes and reads them: a record ends with two line ends, so two line
ends are the row separator, and what a task reads is put together again to the file's bytes and cut by ``Content-Length``. A payload
may therefore hold separators or whole records; a reader holds one record and one Arrow batch, never an archive.

Deduplication resolves revisits in three steps. Headers (key, digest, length) are shuffled by payload digest, folded per task, and give
the largest key of every payload that repeats. The records of such a payload, found by joining their headers with it, become revisits,
but for the original. The decisions meet the payloads again by record, and archives with fresh headers are written: responses whole,
revisits as ``identical-payload-digest`` records that hold the HTTP header only. Payloads are shuffled once, by record, so a payload
that a third of all records share loads no task; its headers are folded before they are shuffled, and the narrow join is one that the
adaptive skew join can split, because the originals are a written table.

Equality is that of SHA-1, length and a second 64-bit hash together.

Defined cases: a NULL payload is empty; a NULL or blank URI gives no ``WARC-Target-URI``; a NULL key is smaller than any other, and of
records that tie in key and payload all are the same record, written as often. Equal keys with different payloads are different
records. No rows give no records. Archives cut short give the whole records before the cut; uncompressed ones are refused, because
Spark would split them inside records. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import quoted, release, scan, written
from chartloom.session import shared_folder

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records in one archive: bounds the size of files, one of which is one reading task.
RECORDS_PER_FILE = 50_000
BATCH_BYTES = 8 << 20
#: RFC 4648 base32 digits beside the digits that base conversion gives (fixed values).
CONVERTED, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = (
    "type string, record_id string, key string, uri string, refers_to string, date string, header_digest string,"
    " payload_bytes long, payload_digest string, block_bytes long, payload binary"
)


def base32_sha1(value: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits at a time."""
    digits = F.sha1(value)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), CONVERTED, BASE32)


def record_id(key: Column, digest: Column) -> Column:
    """A URN that depends on key and payload only, so that retries write the same records."""
    h = F.md5(F.concat_ws(":", F.coalesce(key, F.lit("-")), digest).cast("binary"))
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Per row: key (text), uri, payload, digest, n_bytes, check."""
    payload = F.coalesce(quoted(payload_col).cast("string"), F.lit(""))
    uri = F.regexp_replace(F.trim(quoted(uri_col).cast("string")), r"[\x00-\x20\x7F]+", "%20")
    rows = pages.select(quoted(id_col).alias("id"), F.nullif(uri, F.lit("")).alias("uri"), payload.alias("payload"))
    return rows.select(
        "id", "uri", "payload", base32_sha1(F.col("payload").cast("binary")).alias("digest"),
        F.octet_length("payload").cast("long").alias("n_bytes"), F.xxhash64("payload").alias("check"),
    )


PAYLOAD = ["digest", "n_bytes", "check"]


def resolve(found: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The records that become revisits: id, digest, n_bytes, check and ``original``, the largest id with this payload."""
    headers = found.select("id", *PAYLOAD).filter(F.col("n_bytes") >= min_bytes)
    shared = headers.groupBy(*PAYLOAD).agg(F.max("id").alias("original"), F.count("*").alias("n")).filter("n > 1 AND original IS NOT NULL")
    originals = written(shared.select(*PAYLOAD, "original"), "warc-originals")
    return headers.join(originals, PAYLOAD).filter("id IS NULL OR id <> original").distinct()


def _lines(*fields: tuple[str, Column | str]) -> Column:
    """``name: value`` lines; a field without a value is left out."""
    made = [F.concat(F.lit(name + ": "), value if isinstance(value, Column) else F.lit(value)) for name, value in fields]
    return F.concat_ws("\r\n", F.lit("WARC/1.1"), *made)


def write_archives(found: DataFrame, path: str, revisits: DataFrame | None = None, date: str | None = None) -> None:
    """Writes one WARC record per row of ``records``; those named in ``revisits`` without their payload."""
    if revisits is None:
        rows = found.withColumn("original", F.lit(None).cast(found.schema["id"].dataType)).withColumn("again", F.lit(False))
    else:
        marks = revisits.select(
            F.col("id").alias("r_id"), *(F.col(c).alias("r_" + c) for c in PAYLOAD), "original", F.lit(True).alias("again")
        )
        same = F.col("id").eqNullSafe(F.col("r_id"))
        for c in PAYLOAD:
            same &= F.col(c) == F.col("r_" + c)
        rows = found.join(marks, same, "left").withColumn("again", F.coalesce("again", F.lit(False)))
    now = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    key = F.url_encode(F.col("id").cast("string"))
    original = F.url_encode(F.col("original").cast("string"))
    urn = lambda k: F.concat(F.lit("<urn:uuid:"), record_id(k, F.col("digest")), F.lit(">"))
    again = F.col("again")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    header = _lines(
        ("WARC-Type", F.when(again, "revisit").otherwise("response")),
        ("WARC-Record-ID", urn(key)),
        ("WARC-Date", now),
        ("WARC-Target-URI", F.col("uri")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(again, PROFILE)),
        ("WARC-Refers-To", F.when(again, urn(original))),
        ("X-Record-Key", key),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    text = rows.select(F.concat(header, F.lit(END), block).alias("value"))
    text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


class Cutter:
    """Cuts the bytes of an archive, given piece by piece, into records."""

    def __init__(self) -> None:
        self.held, self.size, self.need, self.header = [], 0, 0, None

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.held.append(piece)
        self.size += len(piece)
        if self.header is not None and self.size < self.need:
            return
        data, at = b"".join(self.held), 0
        while True:
            if self.header is None:
                while data.startswith(b"\r\n", at):  # line ends left of a record that ended early
                    at += 2
                end = data.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                first, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
                fields = (line.partition(":") for line in lines)
                header = {name.strip().lower(): value.strip() for name, _, value in fields}
                if not first.startswith("WARC/") or not header.get("content-length", "").isdigit():
                    raise ValueError(f"not a WARC record: {first[:80]!r}")
                self.header, at = header, end + 4
            length = int(self.header["content-length"])
            if len(data) - at < length:
                break
            yield self.header, data[at : at + length]
            self.header, at = None, at + length
        self.held, self.size = [data[at:]], len(data) - at
        self.need = int(self.header["content-length"]) if self.header is not None else 0


def _named(value: str | None) -> str | None:
    return value.strip("<>").removeprefix("urn:uuid:") if value else None


def _row(header: dict[str, str], block: bytes, keep: bool) -> tuple:
    """A record's columns; the digest and length of a response are those of the payload as read."""
    kind = header.get("warc-type", "")
    http = header.get("content-type", "").startswith("application/http")
    head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    if kind == "revisit":
        digest, size, payload = None, None, None
    key = header.get("x-record-key")
    return (
        kind, _named(header.get("warc-record-id")), None if key is None else unquote_plus(key), header.get("warc-target-uri"),
        _named(header.get("warc-refers-to")), header.get("warc-date"), header.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        size, digest, len(block), payload if keep else None,
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the gzip archives of a folder (columns: ``RECORD``); without ``payloads`` only their lengths and digests.

    ``payload_bytes`` and ``payload_digest`` are computed from what was read (NULL for a revisit); ``header_digest`` is what the
    header claims.
    """
    lines = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    types = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(",")]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, file, out, size = Cutter(), None, [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            values = batch.column("value").cast(pa.large_binary() if pa.types.is_large_string(batch.column("value").type) else pa.binary())
            for value, here in zip(values.to_pylist(), batch.column("file").to_pylist(), strict=True):
                if here != file:
                    cutter, file = Cutter(), here  # what an archive cut short left over is dropped
                else:
                    value = b"\r\n\r\n" + value
                for header, block in cutter.feed(value):
                    out.append(_row(header, block, payloads))
                    size += 300 + (len(block) if payloads else 0)
                    if size > BATCH_BYTES:
                        yield packed()
                        out, size = [], 0
        if out:
            yield packed()
        release()

    return scan(lines, per_task, RECORD)


def resolved(archive: DataFrame) -> DataFrame:
    """Records with, for every revisit, length, digest and key of the response it refers to (``original_*``, NULL if there is none)."""
    index = archive.filter("type = 'response'").select(
        F.col("record_id").alias("original_id"), F.col("key").alias("original_key"),
        F.col("payload_bytes").alias("original_bytes"), F.col("payload_digest").alias("original_digest"),
    )
    index = written(index.dropDuplicates(["original_id"]), "warc-index")
    return archive.join(index, F.col("refers_to") == F.col("original_id"), "left")


def deduplicated(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = 0, path: str | None = None,
    date: str | None = None,
) -> DataFrame:
    """Writes deduplicated archives to ``path`` (a new shared folder by default) and reads them back.

    Of equal payloads of at least ``min_bytes`` bytes the one with the largest id is a response, the others revisit it. Returns per
    row: id, uri, payload_bytes, payload_digest (of the payload read, for a revisit of its response), record_type, refers_to.
    """
    spark = pages.sparkSession
    path = path or shared_folder(spark, "warc-archives")
    found = records(pages, id_col, uri_col, payload_col)
    write_archives(found, path, resolve(found, min_bytes), date)
    narrow = written(read_archives(spark, path, payloads=False).drop("payload"), "warc-headers")
    kind = pages.schema[id_col].dataType
    return resolved(narrow).select(
        F.col("key").cast(kind).alias("id"), "uri",
        F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "original_digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("original_key").cast(kind).alias("refers_to"),
    )
