"""WARC records of pages in ZIP packages: written once, read back by range."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestone.llm import zip_archive as Z
from lodestone.session import durable

#: An archive is closed once its records hold this much; one longer record makes a longer archive.
ARCHIVE_BYTES = 4 << 20
DATA, INDEX = "archive/pages.warc", "indexes/pages.cdx"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def classify(pages: DataFrame, least: int, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, record_type, refers_to)``: which records revisit others.

    Of payloads of at least ``least`` bytes that are equal, the one with the smallest
    page_id is the response and the others revisit it; rows that share that page_id are
    all responses. A null payload is empty; a null page_id never becomes a reference
    while the payload has another. Other columns are ignored.
    """
    payload = F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= least)
    repeated = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = durable(repeated.select("digest", "first"), "warc-repeated")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (
        rows.join(repeated, "digest", "left")
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("first")))
        .select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    )


def _name(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, which tells the payload's length, and no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += payload if kind == "response" else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_name(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:?#[]@!$&()*+,;=~')}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(text: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in text.decode("utf-8").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse(data: bytes) -> tuple:
    """The fields of ``RECORDS`` of one record; a response's length and digest come from its bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    named = _headers(head)
    block = rest[: int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page, kind = _page(named["warc-record-id"]), named["warc-type"]
    if kind == "revisit":
        length, digest = int(_headers(http)["content-length"]), named["warc-payload-digest"].removeprefix("sha256:")
        return page, named.get("warc-target-uri"), length, digest, kind, _page(named["warc-refers-to"]), None
    return page, named.get("warc-target-uri"), len(payload), hashlib.sha256(payload).hexdigest(), kind, None, payload


def write_archives(records: DataFrame) -> DataFrame:
    """``(name, content)``: ZIP packages of the rows of ``classify``, a few MB each.

    Each holds the records one after another in a stored member and their offsets and
    lengths in an index member. A task holds one package at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, index, size = [], [], 0

        def close() -> pa.RecordBatch:
            content = Z.package([(DATA, pieces), (INDEX, ["".join(index).encode()])])
            name = f"{hashlib.sha256(content).hexdigest()[:32]}.wacz"
            return pa.record_batch([pa.array([name]), pa.array([content], pa.large_binary())], names=["name", "content"])

        for batch in batches:
            for row in range(batch.num_rows):
                piece = record(*(column[row].as_py() for column in batch.columns))
                index.append(f"{size} {len(piece)}\n")
                pieces.append(piece)
                size += len(piece)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    pieces, index, size = [], [], 0
        if pieces:
            yield close()

    ordered = records.select("page_id", "url", "payload", "digest", "record_type", "refers_to")
    return ordered.mapInArrow(run, "name string, content binary")


def read_records(read_at: Z.ReadAt, size: int) -> Iterator[tuple]:
    """The records of one package, each read by the range that the index gives."""
    members = Z.directory(read_at, size)
    index = members[INDEX]
    listed = read_at(Z.data_start(read_at, index), index.size).decode()
    start = Z.data_start(read_at, members[DATA])
    for line in listed.splitlines():
        offset, length = map(int, line.split())
        yield parse(read_at(start + offset, length))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Rows of ``RECORDS`` for all records of ``(name, content)`` packages; null payload for revisits.

    Without ``payloads`` they are read and measured but not returned. An empty table gives no rows.
    """
    schema = RECORDS if payloads else RECORDS.removesuffix(", payload binary")
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held = memoryview(content.as_buffer())
                rows = list(read_records(lambda at, length: bytes(held[at : at + length]), len(held)))
                columns = list(zip(*rows))[: len(names)]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return archives.select("content").mapInArrow(run, schema)


def round_trip(pages: DataFrame, least: int = 100, payloads: bool = False) -> DataFrame:
    """Write all pages as packages to the shared folder and read every record back."""
    return read_archives(durable(write_archives(classify(pages, least)), "warc"), payloads)
