"""Conversion of legacy ARC records to WARC, archives in the shared folder, and reading them back.

An ARC record is one header line, the declared number of bytes, and a line feed. Version 1 headers
have five fields (URL, IP, date, type, length); version 2 headers have ten (URL, IP, date, type,
result code, checksum, location, offset, file name, length). Fields are parsed from the right,
because old crawlers left blanks in URLs.

Null payloads are empty. A null URL becomes ``about:blank``. A record whose declared length does
not fit raises ``ValueError``. Equal payloads of at least ``min_revisit`` bytes have one response,
that of the largest key; equal keys with equal payloads are all responses.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import query, rows_to_table, shared_files, table, texts, write_shared
from millrace.session import new_path

# Fixed values of the archive formats.
ARC_FIELDS = {1: 5, 2: 10}
ARC_DATE = "20240101000000"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 8 << 20


@dataclass
class ArcRecord:
    """One parsed legacy record."""

    version: int
    url: str
    ip: str
    date: str
    mime: str
    status: int
    payload: bytes


def arc_record(version: int, url: str, payload: bytes, ip="0.0.0.0", date=ARC_DATE, mime="text/html") -> bytes:
    """The bytes of one ARC record."""
    middle = f" 200 - - 0 {'-'}" if version == 2 else ""
    return f"{url} {ip} {date} {mime}{middle} {len(payload)}\n".encode() + payload + b"\n"


def parse_arc(record: bytes, version: int) -> ArcRecord:
    """Read the header line of its version and as many bytes as it declares."""
    line, _, rest = record.partition(b"\n")
    fields = line.decode("utf-8", "replace").rsplit(" ", ARC_FIELDS[version] - 1)
    if len(fields) != ARC_FIELDS[version] or not fields[-1].isdigit():
        raise ValueError(f"no ARC version {version} header: {line[:80]!r}")
    length = int(fields[-1])
    if len(rest) < length or rest[length:] not in (b"", b"\n"):
        raise ValueError(f"ARC record declares {length} bytes and has {len(rest)}")
    status = int(fields[4]) if version == 2 and fields[4].isdigit() else 200
    return ArcRecord(version, fields[0], fields[1], fields[2], fields[3], status, rest[:length])


def warc_date(date: str) -> str:
    """ARC's digits as an ISO instant; missing parts of short dates are their first values."""
    digits = date + "19700101000000"[len(date) :]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def record_id(key: str, digest: str) -> str:
    """A record identifier that is the same on every run."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{key}:{digest}')}>"


def to_warc(arc: ArcRecord, key: str, refers_to: str | None = None) -> bytes:
    """A WARC response or, if ``refers_to`` names the key of an equal payload, a revisit."""
    digest = hashlib.sha1(arc.payload).hexdigest()
    http = f"HTTP/1.1 {arc.status} OK\r\nContent-Type: {arc.mime}\r\nContent-Length: {len(arc.payload)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to else arc.payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Date: {warc_date(arc.date)}",
        f"WARC-Target-URI: {arc.url}",
        f"WARC-IP-Address: {arc.ip}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        f"X-Source-Key: {key}",
    ]
    if refers_to:
        head += [
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Key: {refers_to}",
            f"WARC-Profile: {REVISIT_PROFILE}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, by declared lengths. Digests of blocks are checked."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(": ")
            head[name] = value.removesuffix("\r\n")
        block = stream.read(int(head["Content-Length"]))
        if f"sha1:{hashlib.sha1(block).hexdigest()}" != head["WARC-Block-Digest"] or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"damaged WARC record {head['WARC-Record-ID']}")
        yield head, block


def with_originals(pages: DataFrame, key: str, payload: str, min_revisit: int) -> DataFrame:
    """Add ``_original``: for a payload that others have too, the largest key among them.

    Digests are aggregated first, so a payload that fills a third of the table is one row per task.
    Only digests met under several keys remain for the join.
    """
    digest = F.sha1(F.coalesce(F.col("_payload"), F.lit("")).cast("binary"))
    keyed = pages.select(F.col(key).alias("_key"), F.col(payload).alias("_payload"), "_url")
    keyed = keyed.withColumn("_digest", digest)
    large = F.octet_length(F.coalesce(F.col("_payload"), F.lit(""))) >= min_revisit
    groups = (
        keyed.filter(large).groupBy("_digest").agg(F.max("_key").alias("_original"), F.min("_key").alias("_least"))
    )
    shared = groups.filter("_original != _least").select(F.col("_digest").alias("_same"), "_original")
    return keyed.join(shared, large & (F.col("_digest") == F.col("_same")), "left").drop("_same")


def convert_archive(pages: DataFrame, folder: str, min_revisit: int = 1000, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``_key, _url, _payload, _original`` rows as gzipped WARC files; one row per file.

    Each row is put into legacy form, parsed from it by its version's rules, and synthesised anew.
    Odd keys come as version 2. File names derive from the content, so a repeated task writes the
    same files again.
    """

    def write(batches):
        parts: list[bytes] = []
        size = records = 0

        def flush():
            data = b"".join(parts)
            path = f"{folder}/{hashlib.sha1(data).hexdigest()}.warc.gz"
            write_shared(path, data)
            return rows_to_table({"path": [path], "records": pa.array([records], pa.int64())})

        for batch in batches:
            columns = [batch.column(n) for n in ("_key", "_url", "_original")]
            for k, url, original, payload in zip(*[c.to_pylist() for c in columns], texts(batch.column("_payload")), strict=True):
                version = 2 if (k or 0) % 2 else 1
                url = re.sub(r"[\r\n]", "", url or "about:blank")
                arc = parse_arc(arc_record(version, url, payload), version)
                refers = None if original is None or original == k else str(original)
                packer = zlib.compressobj(1, wbits=31)
                parts.append(packer.compress(to_warc(arc, str(k), refers)) + packer.flush())
                size, records = size + len(parts[-1]), records + 1
                if size >= file_bytes:
                    yield flush()
                    parts, size, records = [], 0, 0
        if parts:
            yield flush()

    return pages.select("_key", "_url", "_payload", "_original").mapInArrow(write, "path string, records long")


def read_archive(paths: DataFrame) -> DataFrame:
    """Records of the WARC files named in ``path``: key, type, digest, length, payload, what they revisit."""

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, local = shared_files(path)
                out: list[tuple] = []
                with files.open_input_stream(local, compression=None) as source, gzip.open(source) as stream:
                    for head, block in parse_warc(stream):
                        http, _, body = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        key = head["X-Source-Key"]
                        refers = head.get("X-Refers-To-Key")
                        out.append(
                            (
                                None if key == "None" else int(key),
                                length,
                                head["WARC-Payload-Digest"].removeprefix("sha1:"),
                                head["WARC-Type"],
                                int(refers) if refers else None,
                                head["WARC-Target-URI"],
                                head["WARC-Date"],
                                head["WARC-Record-ID"],
                                None if refers else body,
                            )
                        )
                        if len(out) >= 500:
                            yield rows_to_table(dict(zip(NAMES, arrays(out), strict=True)))
                            out = []
                if out:
                    yield rows_to_table(dict(zip(NAMES, arrays(out), strict=True)))

    def arrays(out):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        return [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]

    return paths.mapInArrow(
        read,
        "key long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "target_uri string, warc_date string, record_id string, payload binary",
    )


NAMES = (
    "key payload_bytes payload_digest record_type refers_to target_uri warc_date record_id payload"
).split()


def archive_pages(spark: SparkSession, pages: DataFrame, key: str, url: str, payload: str, min_revisit: int = 1000) -> DataFrame:
    """Write all pages as WARC archives and return the records read back from them."""
    folder = new_path(spark, "warc")
    rows = with_originals(pages.select(key, payload, F.col(url).alias("_url")), key, payload, min_revisit)
    listing = new_path(spark, "warc-files")
    convert_archive(rows, folder, min_revisit).write.parquet(listing)
    files = spark.read.schema("path string, records long").parquet(listing)
    return read_archive(files.repartition(spark.sparkContext.defaultParallelism * 4, "path"))


@query(
    "op1_warc_archive",
    """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY 1
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN g ON p.payload_bytes >= 1000 AND p.payload_digest = g.payload_digest
""",
)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """Payload digest per page. The archive's digest is held against the payload read back."""
    records = archive_pages(spark, table(spark, sf, "pages"), "page_id", "url", "html")
    checked = F.when(F.col("payload").isNull() | (F.sha1("payload") == F.col("payload_digest")), F.col("payload_digest"))
    return records.select(
        F.col("key").alias("page_id"), "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to"
    )
