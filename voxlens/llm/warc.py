"""WARC archives: write, read, and resolve revisits.

Records are written by Spark's text writer with the record end as line separator, so archives
go to any file system that Spark writes, under its commit protocol. They are read as whole
files of a bounded number of records and cut by Content-Length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.llm.groups import with_group

#: Records of one archive file, which is read whole by one task.
RECORDS_PER_ARCHIVE = 2000
#: The date of records whose pages have none.
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
HEADER_FIELDS = (
    "record_id string, page_id bigint, uri string, date string, kind string, digest string, bytes bigint, "
    "refers_to string"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value stays on its line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def record(page_id: int | None, record_id: str, uri: str | None, date: str, payload: bytes, digest: str,
           original: tuple[str, str | None, str] | None = None) -> bytes:
    """One record without its end. With ``original`` (record id, URI, date) it is a revisit:
    the HTTP headers of the response and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}".encode()
    block = http if original else http + payload
    fields = [("WARC-Type", "revisit" if original else "response"), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
              ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", _clean(uri)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if original:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{original[0]}>"),
                   ("WARC-Refers-To-Date", original[2])]
        if original[1] is not None:
            fields.append(("WARC-Refers-To-Target-URI", _clean(original[1])))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block


def parse(data: bytes):
    """(headers, payload) of every record of an archive; header names in lower case."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start = stop + 4
        at = start + int(headers["content-length"])
        body = data.index(b"\r\n\r\n", start, at) + 4
        yield headers, data[body:at]
        at += 4


def _uuid(urn: str | None) -> str | None:
    return urn.removeprefix("<urn:uuid:").removesuffix(">") if urn else None


def _encode(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            payload = (row["html"] or "").encode()
            name = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{row['page_id']}/{row['row']}"))
            out.append(record(row["page_id"], name, row["url"], DATE, payload, payload_digest(payload)).decode())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def _fields(headers: dict, payload: bytes) -> tuple:
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and payload_digest(payload) != digest:
        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    page = headers.get("x-page-id")
    return (_uuid(headers["warc-record-id"]), int(page) if page else None, headers.get("warc-target-uri"),
            headers["warc-date"], kind, digest, len(payload) if kind == "response" else None,
            _uuid(headers.get("warc-refers-to")))


def _decode(with_payload: bool):
    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows = [
                    (archive.as_py(), *_fields(headers, payload), *([payload] if with_payload else ()))
                    for headers, payload in parse(gzip.decompress(content.as_py()))
                ]
                kinds = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
                names = ["archive", *(f.split()[0] for f in HEADER_FIELDS.split(", ")), "payload"]
                columns = list(zip(*rows)) or [[]] * (len(names) - (not with_payload))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=names[: len(columns)]
                )
    return run


def _rewrite(batches):
    """The records of each archive anew, the decided ones as revisits."""
    for batch in batches:
        for content, decided in zip(batch.column(0), batch.column(1)):
            first = {d["record_id"]: (d["first_id"], d["first_uri"], d["first_date"]) for d in decided.as_py() or ()}
            out = []
            for headers, payload in parse(gzip.decompress(content.as_py())):
                name, page, uri, date, _, digest, _, _ = _fields(headers, payload)
                out.append(record(page, name, uri, date, payload, digest, first.get(name)).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def _save(records: DataFrame, path: str) -> None:
    records.write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_ARCHIVE
    ).text(path)


def write_archives(pages: DataFrame, path: str) -> None:
    """A response record per row of ``pages`` (page_id, url, html); html is the payload in
    UTF-8, null the empty payload. Null ids and addresses leave their header out; rows that
    repeat are records of their own. Other columns are not read."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
                        F.monotonically_increasing_id().alias("row"))
    _save(rows.mapInArrow(_encode, "value string"), path)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: ``archive`` (its file), ``record_id``, ``page_id``, ``uri``, ``date``, ``kind``, ``digest``
    (SHA-1, base32; payloads are checked against it), ``bytes`` (null for revisits),
    ``refers_to`` (record id) and, if asked for, ``payload``."""
    return _archives(spark, path).mapInArrow(
        _decode(with_payload), "archive string, " + HEADER_FIELDS + (", payload binary" if with_payload else "")
    )


def _archives(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.col("path").alias("archive"), "content")


def resolve_revisits(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Write the archives of ``source`` anew below ``target``: of records with equal payloads
    of at least ``min_bytes`` bytes the one with the smallest page id (null last, then by
    record id) stays a response, the others become revisits of it. Smaller payloads all stay.

    Only headers are shuffled by digest; a digest that holds a third of all records is split.
    The decisions, at most one per record of an archive, then meet the archives, which move
    compressed.
    """
    headers = read_archives(spark, source)
    first = F.struct(F.col("page_id").isNull().alias("n"), F.col("page_id").alias("p"),
                     F.col("record_id").alias("first_id"), F.col("uri").alias("first_uri"), F.col("date").alias("first_date"))
    large = with_group(headers.where(F.col("bytes") >= min_bytes), ["digest"], first, F.col("record_id"))
    decided = large.where(F.col("record_id") != F.col("__first.first_id")).select(
        "archive", F.struct("record_id", "__first.first_id", "__first.first_uri", "__first.first_date").alias("d")
    ).groupBy("archive").agg(F.collect_list("d").alias("decided"))
    met = _archives(spark, source).join(decided, "archive", "left").select("content", "decided")
    _save(met.mapInArrow(_rewrite, "value string"), target)


def payload_table(spark: SparkSession, path: str) -> DataFrame:
    """Per record of deduplicated archives: ``page_id``, ``payload_bytes`` and
    ``payload_digest`` of the full payload (a revisit takes them from its response),
    ``record_type``, ``refers_to`` (page id of the response, null for responses)."""
    records = read_archives(spark, path)
    response = F.struct((F.col("kind") != "response").alias("k"), F.col("page_id").isNull().alias("n"),
                        F.col("page_id").alias("p"), F.col("bytes").alias("b"))
    met = with_group(records, ["digest"], response, F.col("record_id"))
    revisit = F.col("kind") == "revisit"
    return met.select(
        "page_id", F.when(revisit, F.col("__first.b")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.when(revisit, F.col("__first.p")).alias("refers_to"),
    )
