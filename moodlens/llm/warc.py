"""Content-addressed WARC archive by DataFrame functions; WARC files are written and read too.

``write_archive`` stores every payload once, under its SHA-256 digest (rows meet by their bytes, and a
digest that met other bytes would fail the write), and the exact header block of every record in a second
table.  ``read_archive`` checks each stored payload against its digest while it scans it and joins the
headers to it.  Payload bytes are shuffled once, on writing, after the copies within a task have met;
reading moves them only if the caller asks for the records' bytes.
"""

from __future__ import annotations

import gzip
import io
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload):
    """Bare upper-case base32 SHA-1: four times 40 bits, each as eight digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _header(kind, date: str):
    """The header block of a record, up to and with its empty line."""
    one_line = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]+", " ")
    record_id = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(":"), F.col("row").cast("string"), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), one_line),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce(F.col("first_id").cast("string"), F.lit("none")), F.lit(":"), F.col("first_row").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per page below ``path``: ``payloads`` (sha, payload) and ``headers``.

    Input: ``page_id``, ``url``, ``html`` (others are ignored, whatever their names); null html is an empty
    payload, null url an empty one.  Of records with equal payloads of at least ``min_bytes`` bytes, the one
    with the smallest page_id (null last; of ties exactly one) is the response and the others revisit it;
    records of smaller payloads are all responses.  An empty table writes an empty archive.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha2("payload", 256))

    # Copies meet by all their bytes; a task sums its own before the shuffle.  A digest must stand for one payload.
    stored = rows.groupBy("sha", "payload").agg(F.count("*").alias("copies"))
    stored.write.parquet(f"{path}/payloads", compression="zstd")
    met = spark.read.parquet(f"{path}/payloads").groupBy("sha").agg(F.count("*").alias("n")).where("n > 1")
    if met.head(1):
        raise ValueError("two payloads share one SHA-256 digest")

    # Written first without types: a row's number must not change when a task runs again.
    plain = rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "sha", sha1_base32(F.col("payload")).alias("digest"), F.length("payload").cast("long").alias("bytes"))
    plain.write.parquet(f"{path}/records")
    plain = spark.read.parquet(f"{path}/records")
    first = plain.groupBy("sha").agg(F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select("sha", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    headers = plain.join(first, "sha", "left")
    again = (F.col("first_row") != F.col("row")) & (F.col("bytes") >= min_bytes)
    kind = F.when(again, "revisit").otherwise("response")
    headers.select("sha", _header(kind, date).alias("header")).write.parquet(f"{path}/headers", compression="zstd")


def header_field(name: str):
    """A field of the header block, empty if it has none."""
    return F.regexp_extract("header", f"(?m)^{name}: (.*?)\\r?$", 1)


def _page_of(name: str):
    """The page_id in a record id of a header field (null if it names none)."""
    return F.regexp_extract(header_field(name), "^<urn:page:(-?[0-9]+):", 1).try_cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: page_id, header, payload (the full payload, for revisits too), payload_bytes,
    payload_digest, record_type, refers_to; all but the payload and its length parsed from the header blocks.

    Fails if a stored payload does not have its digest, or a header not its payload's length and digest.
    """
    headers = spark.read.parquet(f"{path}/headers")
    stored = spark.read.parquet(f"{path}/payloads").drop("copies")
    stored = stored.select("sha", "payload", F.length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("payload_digest"), (F.sha2("payload", 256) == F.col("sha")).alias("sound"))

    digest = header_field("WARC-Payload-Digest")
    agrees = F.col("sound") & (header_field("Content-Length") == F.col("payload_bytes").cast("string")) & (digest == F.concat(F.lit("sha1:"), F.col("payload_digest")))
    kind = F.when(agrees, header_field("WARC-Type")).otherwise(F.raise_error(F.concat(F.lit("damaged record: "), F.col("header"))))
    fields = [_page_of("WARC-Record-ID").alias("page_id"), "header", "payload", "payload_bytes", F.substring(digest, 6, 32).alias("payload_digest"), kind.alias("record_type"), _page_of("WARC-Refers-To").alias("refers_to")]
    return headers.join(stored, "sha").select(*fields)


def export_warc(records: DataFrame, path: str) -> None:
    """Write records of ``read_archive`` as WARC files (gzip): a record is its header block, its payload and two line ends."""
    whole = F.concat("header", F.decode("payload", "UTF-8"))
    records.select(whole.alias("value")).write.text(path, compression="gzip", lineSep=CRLF + CRLF)


def _records(content: bytes):
    """(header block, payload) of each record of a WARC file, compressed or not, read as a stream."""
    file = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content))
    while True:
        line = file.readline()
        while line in (b"\r\n", b"\n"):
            line = file.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should start")
        head, size = [line], None
        while (line := file.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("a WARC header without an end")
            head.append(line)
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                size = int(value)
        payload = file.read(size or 0)
        if len(payload) < (size or 0):
            raise ValueError("a WARC record shorter than its Content-Length")
        yield b"".join(head).decode("utf-8", "replace") + line.decode(), payload


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files (gzip or plain): file, header, payload, payload_bytes, payload_digest, record_type,
    refers_to (the record id that ``WARC-Refers-To`` names, else null); the last three as the header says.

    A file is read in one task, record by record: its compressed bytes are in memory, of its contents one batch.
    A damaged file is an error.  A path without files is one too, as for every reader of Spark.
    """

    def parse(batches):
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                rows, size = [], 0
                for record in _records(content):
                    rows.append((name, *record))
                    size += len(record[1])
                    if size > 16 << 20 or len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "header", "payload"])
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "header", "payload"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    records = files.mapInArrow(parse, "file string, header string, payload binary")
    digest, refers = header_field("WARC-Payload-Digest"), header_field("WARC-Refers-To")
    return records.select(
        "file", "header", "payload", F.length("payload").cast("long").alias("payload_bytes"), F.regexp_replace(digest, "^sha1:", "").alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"), F.when(refers != "", refers).alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read it back."""
    path = os.path.join(ensure_checkpoint_dir(pages.sparkSession), "warc", uuid.uuid4().hex)
    write_archive(pages, path, min_bytes)
    return read_archive(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH d AS (SELECT page_id, sha1(coalesce(html, '')) AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM d GROUP BY h),
b AS (SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * g, 5) AS BIGINT) >> (15 - 5 * k)) & 31 AS INTEGER), 1), '' ORDER BY g, k) AS payload_digest
      FROM f, range(8) AS a(g), range(4) AS c(k) GROUP BY h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d JOIN f USING (h) JOIN b USING (h)
"""
