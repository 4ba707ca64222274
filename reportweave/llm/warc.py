"""WARC archives with an index, and reads of selected records by byte ranges.

Every task writes its pages to archives of its own (one gzip member per record) in the shared
folder and reports where each record lies. The index is a table; a read selects rows of it, and
every task reads its part of them in order of archive and offset, with neighbouring ranges
fetched together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.llm.batches import slices
from reportweave.sources.stored import new_path, store
from reportweave.sources.tables import read_table

REVISIT_BYTES = 100  # smaller payloads are always stored again
ARCHIVE_BYTES = 256 * 1024 * 1024  # an archive is closed when it is this long
TASK_BYTES = 64 << 20  # of packed records that one task reads
CHUNK_BYTES = 4 << 20  # of an archive that stay in one task
RANGE_GAP = 64 * 1024  # records this near to each other are fetched together
RANGE_BYTES = 8 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

INDEX = (
    "page_id bigint, url string, record_type string, digest string, archive string,"
    " offset bigint, length bigint"
)
RECORD = "page_id bigint, record_type string, refers_to bigint, digest string, payload binary"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    number = (record_id or "none").strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def build_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record, uncompressed. A revisit has the HTTP head but not the payload."""
    revisit = refers_to is not None
    block = HTTP_HEAD + b"Content-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "urn:none", safe=":/?#[]@!$&'()*+,;=%~")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        head += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _revisits(pages: DataFrame, id: str, html: str) -> DataFrame:
    """``id, digest, refers_to`` of pages whose payload another page holds."""
    digests = store(
        pages.select(
            F.col(id).cast("bigint").alias("id"),
            _digest(html).alias("digest"),
            F.octet_length(F.coalesce(html, F.lit(""))).alias("size"),
        ).where(F.col("size") >= REVISIT_BYTES),
        "payload-digests",
    )
    shared = digests.groupBy("digest").agg(
        F.min("id").alias("refers_to"), F.count("*").alias("pages")
    ).where("pages > 1 AND refers_to IS NOT NULL")
    shared = store(shared, "shared-payloads")
    others = digests.join(shared, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to")))
    return others.select("id", "digest", "refers_to").distinct()


def _digest(html: str) -> Column:
    return F.sha2(F.coalesce(F.col(html), F.lit("")).cast("binary"), 256)


def write_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Writes one record per row of ``pages`` and returns the stored index of ``INDEX``.

    The payload is the page in UTF-8; a null page is empty. Of equal payloads of at least 100
    bytes the smallest id is the response and the others revisit it; a null id only refers,
    and is stored again where no page with an id holds the payload. Repeated rows are repeated
    records. A null address is written as ``urn:none``; control characters are percent-coded.
    Other columns are ignored; no rows write nothing.

    ``folder`` must be shared by all machines. An attempt that fails leaves files that no index
    row names; only attempts that Spark accepts are in the index.
    """
    rows = pages.select(
        F.col(id).cast("bigint").alias("id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"), _digest(html).alias("digest"),
    )
    twins = _revisits(pages, id, html).withColumnRenamed("id", "_id").withColumnRenamed("digest", "_digest")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    marked = rows.join(twins, same, "left").select("id", "url", "html", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        task = TaskContext.get()
        number = 0
        out, index = None, []

        def close() -> pa.RecordBatch:
            out.close()
            columns = list(zip(*index, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

        names = [field.split()[0] for field in INDEX.split(", ")]
        types = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64()]
        for whole in batches:
            for batch in slices(whole):
                for page, address, body, digest, refers in zip(*[c.to_pylist() for c in batch], strict=True):
                    if out is None:
                        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                        out, at = system.open_output_stream(f"{path}/{name}", compression=None), 0
                        number += 1
                    record = build_record(page, address, body.encode(), digest, refers)
                    packer = zlib.compressobj(5, wbits=31)
                    packed = packer.compress(record) + packer.flush()
                    out.write(packed)
                    kind = "response" if refers is None else "revisit"
                    index.append((page, address, kind, digest, name, at, len(packed)))
                    at += len(packed)
                    if at >= ARCHIVE_BYTES:
                        yield close()
                        out, index = None, []
        if out is not None:
            yield close()

    return store(marked.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``RECORD`` rows of the records that ``index`` (rows of ``write_archives``) selects.

    ``payload`` is null for a revisit. Chunks of ``CHUNK_BYTES`` of the archives are dealt over tasks
    of about ``TASK_BYTES``, and over all cores at least. A record whose payload does not match its
    digest, or whose range holds no record, is an error.
    """
    spots = index.select("archive", "offset", "length")
    # Index rows are small and payloads are not, so the parts are counted and cut by payload bytes.
    total = spots.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    chunk = F.floor(F.col("offset") / CHUNK_BYTES)
    parts = spots.repartition(tasks, "archive", chunk).sortWithinPartitions("archive", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            for archive, begin, stop, spans in _ranges(batch):
                if archive != name:
                    name, file = archive, system.open_input_file(f"{path}/{archive}")
                raw = file.read_at(stop - begin, begin)
                yield _records(raw[at - begin : at - begin + size] for at, size in spans)

    return parts.mapInArrow(read, RECORD)


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Byte ranges that cover neighbouring records of a sorted batch."""
    current: tuple[str, int, int, list[tuple[int, int]]] | None = None
    for archive, at, size in zip(*[c.to_pylist() for c in batch], strict=True):
        if current and archive == current[0] and at - current[2] <= RANGE_GAP and at + size - current[1] <= RANGE_BYTES:
            current[3].append((at, size))
            current = (archive, current[1], max(current[2], at + size), current[3])
        else:
            if current:
                yield current
            current = (archive, at, at + size, [(at, size)])
    if current:
        yield current


def _records(members: Iterator[bytes]) -> pa.RecordBatch:
    rows = []
    for member in members:
        headers, payload = parse_record(zlib.decompress(member, wbits=31))
        revisit = headers["WARC-Type"] == "revisit"
        rows.append((
            _page_id(headers["WARC-Record-ID"]),
            headers["WARC-Type"],
            _page_id(headers.get("WARC-Refers-To")),
            headers["WARC-Payload-Digest"].removeprefix("sha256:"),
            None if revisit else payload,
        ))
    columns = list(zip(*rows, strict=True))
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [field.split()[0] for field in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def resolve(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the records.

    A revisit takes the size from the response it refers to, whose digest must be the same.
    """
    actual = F.sha2("payload", 256)
    damaged = F.raise_error(F.concat(F.lit("damaged record of page "), F.col("page_id").cast("string")))
    sized = store(
        records.select(
            "page_id", "record_type", "refers_to", "digest",
            F.when(F.col("payload").isNotNull() & (actual != F.col("digest")), damaged.cast("bigint"))
            .otherwise(F.octet_length("payload")).alias("bytes"),
        ),
        "warc-records",
    )
    held = sized.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "digest", F.col("bytes").alias("held_bytes")
    ).where("refers_to IS NOT NULL").distinct()
    return sized.join(held, ["refers_to", "digest"], "left").select(
        "page_id",
        F.coalesce("bytes", "held_bytes").cast("bigint").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_path(spark, "warc")
    index = write_archives(read_table(spark, sf, "pages"), folder)
    return resolve(read_records(index, folder))


SQL = """
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM (SELECT *, octet_length(payload) >= 100 AND page_id <> first AS again
      FROM (SELECT page_id, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS digest,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages))"""
