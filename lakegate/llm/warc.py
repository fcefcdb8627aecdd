"""WARC archives with an index, and reads of chosen records by coalesced byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import groupby
from uuid import UUID, uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm import files
from lakegate.llm.common import content, partitions, pick, ship, stage

#: An archive is closed when it has grown to this size.
ARCHIVE_BYTES = 256 * 1024 * 1024
#: WARC-Date of every record, unless the caller gives one: results must not depend on the clock.
WRITTEN_AT = "1970-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "path string, offset bigint, length bigint, page_id bigint, url string, digest string, record_type string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A URN that holds the page id, so that a revisit names its response."""
    return UUID(int=0 if page_id is None else 1 << 127 | (page_id & (2**64 - 1))).urn


def page_of(urn: str) -> int | None:
    value = UUID(urn).int
    if not value >> 127:
        return None
    low = value & (2**64 - 1)
    return low - 2**64 if low >> 63 else low


def record(page_id, url, payload: bytes, digest: str, response_id, date: str) -> bytes:
    """One gzip member: a response with its payload, or a revisit that refers to the response."""
    head = [
        VERSION,
        f"WARC-Type: {'response' if response_id is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id(page_id)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    block = HTTP_HEAD + payload
    if response_id is not None:
        block = HTTP_HEAD
        head += [f"WARC-Profile: {IDENTICAL_PAYLOAD}", f"WARC-Refers-To: <{record_id(response_id)}>"]
    head.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record; a damaged record raises."""
    whole = zlib.decompress(member, wbits=31)
    head, rest = whole.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.split(b"\r\n\r\n", 1)[1]
    if fields["WARC-Type"] == "response" and f"sha1:{payload_digest(payload)}" != fields["WARC-Payload-Digest"]:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return fields, payload


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, digest and response_id of the pages whose payload another page answers for.

    Pages with equal payloads of at least ``min_bytes`` are a group; the largest id answers.
    Only digests are shuffled; a hot payload meets in partial aggregates, and adaptive execution
    splits its rows in the join.
    """
    keys = pages.select(
        "page_id", F.sha1("html").alias("digest"), F.md5("html").alias("second"), F.octet_length("html").alias("bytes")
    )
    groups = (
        keys.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "second", "bytes")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1")
    )
    return (
        keys.join(stage(groups, "warc-groups"), ["digest", "second", "bytes"])
        .where(~F.col("page_id").eqNullSafe(F.col("response_id")))
        .select("page_id", "digest", "response_id")
        .distinct()
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    date: str = WRITTEN_AT,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write ``folder``: archives (``*.warc.gz``, one gzip member per record) and ``index``.

    The index row of a record (offset, length, URL, digest) is written with it. Each page is moved
    once, to be joined with what it revisits; records are written where they lie.

    NULL html is an empty payload, a NULL url an empty one. Rows repeated with the id that answers
    are responses. Pages whose id is NULL answer only if their whole group has no id; else they
    revisit. Extra columns are not written. An empty table writes an empty index.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", content("html").alias("html")
    )
    folder = folder.rstrip("/")
    files.make_folder(f"{folder}/archives")
    other = stage(revisits(rows, min_bytes), "warc-revisits")
    known = other.select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "response_id")
    joined = (
        rows.withColumn("digest", F.sha1("html"))
        .join(known, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest")), "left")
        .select("page_id", "url", "html", "response_id")
    )
    joined.mapInArrow(_writer(f"{folder}/archives", date, archive_bytes), INDEX).write.mode("overwrite").parquet(f"{folder}/index")


def _writer(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = path = None
        offset = 0
        try:
            for batch in batches:
                rows: dict[str, list] = {name.split()[0]: [] for name in INDEX.split(", ")}
                for page_id, url, html, response_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or offset >= archive_bytes:
                        if out is not None:
                            out.close()
                        path, offset = f"{folder}/{uuid4().hex}.warc.gz", 0
                        system, place = files.filesystem(path)
                        out = system.open_output_stream(place, compression=None)
                    digest = payload_digest(html)
                    member = record(page_id, url, html, digest, response_id, date)
                    out.write(member)
                    kind = "response" if response_id is None else "revisit"
                    row = (path, offset, len(member), page_id, url, digest, kind)
                    for values, value in zip(rows.values(), row, strict=True):
                        values.append(value)
                    offset += len(member)
                types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_pydict(
                    {n: pa.array(v, t) for (n, v), t in zip(rows.items(), types, strict=True)}
                )
        finally:
            if out is not None:
                out.close()

    return run


def read_warc(index: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """Records of an index, or of any selection of it, from the archives.

    Returns page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for,
    payload (NULL for a revisit). The reads of an archive are sorted and coalesced; archives are
    dealt out over the tasks.
    """
    spark = index.sparkSession
    ship(spark)
    reads = index.select("path", "offset", "length")
    reads = reads.repartition(partitions(spark), "path").sortWithinPartitions("path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        for batch in batches:
            found: list[tuple] = []
            triples = zip(*(batch[c].to_pylist() for c in ("path", "offset", "length")), strict=True)
            for path, group in groupby(triples, key=lambda r: r[0]):
                for member in files.read_ranges(path, ((r[1], r[2]) for r in group)):
                    fields, payload = parse(member)
                    response = fields["WARC-Type"] == "response"
                    refers = None if response else page_of(fields["WARC-Refers-To"].strip("<>"))
                    found.append(
                        (
                            page_of(fields["WARC-Record-ID"].strip("<>")),
                            fields["WARC-Target-URI"],
                            len(payload) if response else int(fields["X-Payload-Length"]),
                            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            fields["WARC-Type"],
                            refers,
                            payload if with_payload and response else None,
                        )
                    )
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            keep = len(names) if with_payload else len(names) - 1
            yield pa.RecordBatch.from_arrays(arrays[:keep], names=list(names[:keep]))

    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return reads.mapInArrow(run, schema + (", payload binary" if with_payload else ""))
