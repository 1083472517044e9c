"""WARC archives: write pages with revisit records for repeated payloads, read archives, resolve revisits."""

from __future__ import annotations

import gzip
import io
import uuid
from base64 import b32encode
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import map_batches, same_type, stored
from tidemark.session import workspace

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

# Records of one archive file at most; a reader holds one file of this many records at a time.
RECORDS_PER_FILE = 2_000

_URN = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace of name-based UUIDs


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return b32encode(sha1(payload).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_URN, name)}>"


def _clean(value: str) -> str:
    """A header's value on one line."""
    return " ".join(value.split())


def record(kind: str, page: str, url: str | None, payload: bytes, sha: str, refers: str | None, date: str) -> bytes:
    """One record with fresh headers, with the two line ends that close it."""
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if kind == "revisit" else head + payload
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(url or '')}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Page-ID: {page}",
        f"Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines[5:5] = [f"WARC-Refers-To: {record_id(refers)}", f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page: {refers}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def parse(stream: io.BufferedIOBase):
    """The records of an archive as ``(headers, block)``, cut by their Content-Length; a payload may hold anything,
    also what looks like a record. An archive that ends within a record is an error."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("the archive ends within a record's headers")
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends within a record")
        yield headers, block


def _digested(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload, sha, bytes)``; a null html is an empty payload."""
    frame = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("payload"))
    schema = StructType([*frame.schema, StructField("sha", StringType()), StructField("bytes", LongType())])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            payloads = [p.as_py().encode() for p in batch.column("payload")]
            more = [pa.array(map(digest, payloads), pa.string()), pa.array(map(len, payloads), pa.int64())]
            return pa.record_batch([*batch.columns, *more], schema.names)

        return run

    return map_batches(frame, make, schema)


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", per_file: int = RECORDS_PER_FILE
) -> None:
    """Write a record per page into gzip archives under ``folder``: of equal payloads of ``min_bytes`` or more the one
    with the largest page_id as response, the others as revisit records that name it; all else as response.

    Only payloads' digests meet: ``(digest, largest page_id)`` of those that occur twice is joined to the pages, which
    are shuffled once, by digest. Both sides are stored or scanned, so that the rows of one very common payload are
    split. Records are text in UTF-8, and Spark's text writer puts them one after the other.
    """
    digested = _digested(pages)
    heads = _digested(pages).select("page_id", "sha", "bytes").where(F.col("bytes") >= min_bytes)
    copied = heads.groupBy("sha").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1")
    copied = stored(copied.select("sha", "original"), "originals")
    marked = digested.join(copied.hint("merge"), "sha", "left")

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "original")), strict=True):
                page, url, payload, sha, original = row
                kind = "revisit" if original is not None and page != original else "response"
                made = record(kind, str(page), url, payload.encode(), sha, str(original), date)
                out.append(made.decode()[:-1])  # the writer ends each with the last line feed
            return pa.record_batch([pa.array(out, pa.string())], ["value"])

        return run

    lines = map_batches(marked.select("page_id", "url", "payload", "sha", "original"), make, "value string")
    writer = lines.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", per_file)
    writer.mode("errorifexists").text(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(record_type, page, refers_to, uri, sha, bytes, payload)``, one row per record: bytes of the payload that
    the record itself holds, null payload for revisits. Archives may be gzip or plain."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("content")
    names = ("record_type", "page", "refers_to", "uri", "sha")
    schema = StructType(
        [StructField(n, StringType()) for n in names] + [StructField("bytes", LongType()), StructField("payload", BinaryType())]
    )

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                data = io.BytesIO(content.as_py())
                stream = io.BufferedReader(gzip.GzipFile(fileobj=data)) if data.getvalue()[:2] == b"\x1f\x8b" else data
                rows: list[list] = [[] for _ in schema]
                held = 0

                def flush():
                    types = [pa.string()] * len(names) + [pa.int64(), pa.binary()]
                    return pa.record_batch([pa.array(r, t) for r, t in zip(rows, types, strict=True)], schema.names)

                for headers, block in parse(stream):
                    kind = headers["warc-type"]
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    values = (kind, headers.get("x-page-id"), headers.get("x-refers-to-page"), headers.get("warc-target-uri"))
                    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    if payload is not None and digest(payload) != told:
                        raise ValueError(f"the payload of page {headers.get('x-page-id')} is damaged")
                    for column, value in zip(rows, (*values, told, len(payload or b""), payload), strict=True):
                        column.append(value)
                    held += len(payload or b"")
                    if held > 16_000_000:
                        yield flush()
                        rows, held = [[] for _ in schema], 0
                yield flush()

    return files.mapInArrow(run, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give each revisit the length of the payload it stands for, by joining it to the response it names; a revisit of
    an unknown response keeps null bytes."""
    responses = records.where("record_type = 'response'").select(F.col("page").alias("refers_to"), F.col("bytes").alias("full"), F.col("sha").alias("sha_full"))
    joined = records.where("record_type = 'revisit'").join(
        responses.dropDuplicates(["refers_to", "sha_full"]).withColumnRenamed("sha_full", "sha").hint("merge"), ["refers_to", "sha"], "left"
    )
    own = [c for c in records.columns if c not in ("bytes",)]
    return records.where("record_type <> 'revisit'").unionByName(joined.select(*own, F.col("full").alias("bytes")))


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of each page, told by the archives that
    were written of them and read back.

    A null html is an empty payload, and null urls an empty target. A page without id is a response if its payload
    has no other page, else a revisit; rows that share the largest id are all responses. Repeated rows stay. Other
    columns are ignored; no rows give no rows.
    """
    spark = pages.sparkSession
    folder = workspace(spark, "warc")
    write_archives(pages, folder, min_bytes)
    kind = pages.schema["page_id"].dataType
    heads = stored(read_archives(spark, folder).drop("payload", "uri"), "records")

    def back(c: str):
        return F.when(F.col(c) != "None", F.col(c)).cast(kind)

    return resolve_revisits(heads).select(
        back("page").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("sha").alias("payload_digest"),
        "record_type",
        back("refers_to").alias("refers_to"),
    )
