"""WARC archives: pages to monolithic gzip files, those to one gzip member per record.

    write_archives   one record per page; a file is one gzip stream, as a crawler leaves it
    normalise        inflates every file once, from its first byte to its last, writes each
                     record as a member of its own and, beside the archives, an index of
                     where each member lies
    read_archives    inflates member by member, computes size and digest of every payload
                     from its bytes, and holds each record against the index

All files are written by Spark's own writers, so any file system Spark knows will do, and a
task that runs again after an executor is lost replaces what it had written. A record is the
largest thing a task holds, beside the compressed bytes of one archive when it is read back;
``FILE_RECORDS`` bounds those.

Of records with equal payloads of at least ``LEAST_BYTES`` the one with the smallest
identifier is a response, the others refer to it. Payloads are told apart by length and
SHA-256; copies are counted in part before they are sent. Only payloads that occur twice are
joined back, a table that Spark broadcasts if it is small and joins by shuffle otherwise.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.tables import table
from marquee.session import scratch_path, written

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
RECORD, NO_IDENTIFIER = "urn:x-page:", "urn:x-page-without-identifier"

LEAST_BYTES = 100
FILE_RECORDS = 20_000
DATE = "1970-01-01T00:00:00Z"
LEVEL = 4
_ROWS = 500  # in a batch a task gives out
_STEP = 1 << 16  # compressed bytes inflated at once

INDEXED = (
    "part int, chunk int, offset bigint, length bigint, record_type string, record_id string, "
    "target_uri string, payload_bytes bigint, payload_digest string, refers_to string"
)


def _urn(identifier: Column) -> Column:
    name = F.concat(F.lit(RECORD), F.url_encode(identifier.cast("string")))
    return F.coalesce(name, F.lit(NO_IDENTIFIER))


def _identifier(urn: str, kind) -> Column:
    return F.when(F.col(urn) != NO_IDENTIFIER, F.url_decode(F.substring(urn, len(RECORD) + 1, 1 << 30))).cast(kind)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """``value``: the text of one record per row of ``pages``, without the two line ends that
    close a record.

    A null payload counts as empty. A null identifier is larger than all others; rows that
    repeat the smallest identifier of equal payloads are all responses. White space and
    control characters of a URL are written as ``%20``; a page without URL has none in its
    record.
    """
    rows = pages.select(
        pages[page_id].alias("page_id"),
        pages[url].cast("string").alias("url"),
        F.coalesce(pages[html].cast("string"), F.lit("")).alias("payload"),
    )
    sized = rows.select("*", F.octet_length("payload").alias("n"), F.sha2("payload", 256).alias("digest"))
    copied = written(
        sized.where(F.col("n") >= LEAST_BYTES)
        .groupBy("digest", "n")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1"),
        "copied-payloads",
    )
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    known = sized.join(copied, ["digest", "n"], "left").select("*", revisit.alias("revisit"))

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    answer = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.lit("Content-Length: "), F.col("n").cast("string"), F.lit(END),
    )
    block = F.octet_length(answer) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("n"))
    none = F.lit("")
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<"), _urn(F.col("page_id")), F.lit(">"))),
        line("WARC-Date", date),
        F.coalesce(line("WARC-Target-URI", target), none),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(
            F.col("revisit"),
            F.concat(
                line("WARC-Profile", PROFILE),
                line("WARC-Refers-To", F.concat(F.lit("<"), _urn(F.col("first")), F.lit(">"))),
            ),
        ).otherwise(none),
        line("Content-Type", "application/http;msgtype=response"),
        line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
    )
    payload = F.when(F.col("revisit"), none).otherwise(F.col("payload"))
    return known.select(F.concat(head, answer, payload).alias("value"))


def write_archives(pages: DataFrame, folder: str, file_records: int = FILE_RECORDS, **columns: str) -> None:
    """Monolithic archives of all ``pages`` below ``folder``: every file one gzip stream of
    at most ``file_records`` records."""
    (
        records(pages, **columns)
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")  # these files are rewritten
        .option("maxRecordsPerFile", file_records)
        .text(folder)
    )


def fields_of(head: bytes) -> dict[str, str]:
    """The named fields of a record's or an answer's head, names in lower case."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs if name}


class Stream:
    """Bytes of one archive as they come, and the whole records among them."""

    def __init__(self, name: str):
        self.name, self.held = name, bytearray()

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """Fields and bytes, closing line ends included, of every record that is complete."""
        at = 0
        while (body := self.held.find(b"\r\n\r\n", at) + 4) > 3:
            if not self.held.startswith(b"WARC/", at):
                raise ValueError(f"{self.name}: no record begins where one should")
            fields = fields_of(bytes(self.held[at:body]))
            stop = body + int(fields["content-length"]) + 4
            if stop > len(self.held):
                break
            if self.held[stop - 4 : stop] != b"\r\n\r\n":
                raise ValueError(f"{self.name}: a record is not as long as it says")
            yield fields, bytes(self.held[at:stop])
            at = stop
        del self.held[:at]

    def close(self) -> None:
        if self.held.strip():
            raise ValueError(f"{self.name}: the last record is cut off")


def member(record: bytes, level: int = LEVEL) -> bytes:
    """The record as a gzip member. Its last byte is always zero: a member ends with the
    length of its content, and one of 16 MiB or more is followed by an empty member."""
    made = b""
    for content in (record, b""):
        deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
        made += deflate.compress(content) + deflate.flush()
        if made[-1] == 0:
            break
    return made


def _bare(name: str | None) -> str | None:
    return name[1:-1] if name and name[0] == "<" else name


def _payload_bytes(fields: dict[str, str], record: bytes) -> tuple[int, str | None, bytes | None]:
    """Size, digest and, if the record holds it, content of a record's payload."""
    block = record[record.index(b"\r\n\r\n") + 4 : -4]
    told = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    if not fields.get("content-type", "").startswith("application/http"):
        return len(block), told, block
    head, _, payload = block.partition(b"\r\n\r\n")
    if fields.get("warc-type") == "revisit":
        return int(fields_of(head).get("content-length", 0)), told, None
    return len(payload), told, payload


def normalise(spark: SparkSession, source: str, target: str, file_records: int = FILE_RECORDS, level: int = LEVEL) -> None:
    """Rewrites the gzip archives below ``source``: ``target/archives`` holds files of one
    member per record, at most ``file_records`` each, ``target/index`` one row per record
    with the number of its task, of that task's file, and the member's place in the file.

    A file is inflated once, as a stream; a record is known by its Content-Length, whatever
    its bytes. A file that breaks off or does not begin with a record fails with its name.
    The rewritten records are kept on the executors' disks while archives and index are
    written; what is lost there is computed again, with the same bytes.
    """
    begin = f"{END}{VERSION}\r\n"
    schema = pa.schema(
        [("part", pa.int32()), ("chunk", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
        + [(n, pa.string()) for n in ("record_type", "record_id", "target_uri")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("member", pa.binary())]
    )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, offset = TaskContext.get().partitionId(), 0, 0
        stream, rows, size = None, [], 0
        separator = begin.encode()

        def row(fields: dict[str, str], record: bytes) -> tuple:
            nonlocal number, offset
            if number % file_records == 0:
                offset = 0
            made = member(record, level)
            n, digest, payload = _payload_bytes(fields, record)
            if digest is None and payload is not None:
                digest = hashlib.sha256(payload).hexdigest()
            place = (part, number // file_records, offset, len(made))
            told = (fields.get("warc-type"), _bare(fields.get("warc-record-id")), fields.get("warc-target-uri"))
            number, offset = number + 1, offset + len(made)
            # The writer adds the zero byte.
            return *place, *told, n, digest, _bare(fields.get("warc-refers-to")), made[:-1]

        def batch() -> pa.RecordBatch:
            nonlocal rows, size
            made = pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
            rows, size = [], 0
            return made

        for pieces in batches:
            for name, piece in zip(pieces.column(0), pieces.column(1), strict=True):
                if stream is None or stream.name != name.as_py():
                    if stream is not None:
                        stream.close()
                    stream = Stream(name.as_py())
                else:
                    stream.held += separator
                stream.held += piece.as_buffer()
                # What precedes a separator is a record, or part of one whose payload holds
                # the separator; its closing line ends come with the next piece.
                for fields, record in stream.records():
                    rows.append(row(fields, record))
                    size += len(rows[-1][-1])
                    if len(rows) >= _ROWS or size > 4 << 20:
                        yield batch()
        if stream is not None:
            stream.close()
        if rows:
            yield batch()

    pieces = spark.read.option("lineSep", begin).text(source).select("_metadata.file_path", F.col("value").cast("binary"))
    made = pieces.mapInArrow(rewrite, f"{INDEXED}, member binary").persist(StorageLevel.DISK_ONLY)
    try:
        (
            made.select(F.col("member").cast("string").alias("value"))
            .write.option("lineSep", "\0")
            .option("compression", "none")
            .option("maxRecordsPerFile", file_records)
            .text(f"{target}/archives")
        )
        made.drop("member").write.parquet(f"{target}/index")
    finally:
        made.unpersist()


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and content of every gzip member; an empty one counts to the one before."""
    view, at, last = memoryview(content), 0, None
    while at < len(view):
        inflate, start, out = zlib.decompressobj(31), at, []
        while not inflate.eof:
            if at >= len(view):
                raise ValueError("a gzip member is cut off")
            out.append(inflate.decompress(view[at : at + _STEP]))
            at = min(at + _STEP, len(view)) - len(inflate.unused_data)
        record = b"".join(out)
        if record:
            if last:
                yield last
            last = (start, at - start, record)
        elif last:
            last = (last[0], at - last[0], last[2])
    if last:
        yield last


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEXED).parquet(f"{folder}/index")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record below ``folder``, as ``normalise`` wrote it: part, chunk, offset,
    length, record_type, record_id, target_uri, payload_bytes, payload_digest, refers_to,
    payload (null for a revisit).

    Size and digest of a response are those of its bytes, those of a revisit what it states.
    A digest that is not the stated one, a member the index does not name, or an entry
    without its member fails the read.
    """
    schema = pa.schema(
        [("part", pa.int32()), ("chunk", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
        + [(n, pa.string()) for n in ("record_type", "record_id", "target_uri")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())]
    )

    def inflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for part, chunk, content in zip(*files.columns, strict=True):
                rows, size = [], 0
                for offset, length, record in members(content.as_buffer()):
                    fields = fields_of(record[: record.index(b"\r\n\r\n") + 4])
                    n, told, payload = _payload_bytes(fields, record)
                    digest = told if payload is None else hashlib.sha256(payload).hexdigest()
                    if told not in (None, digest):
                        raise ValueError(f"payload of {fields.get('warc-record-id')} does not have its digest")
                    place = (part.as_py(), chunk.as_py(), offset, length)
                    who = (fields.get("warc-type"), _bare(fields.get("warc-record-id")), fields.get("warc-target-uri"))
                    rows.append((*place, *who, n, digest, _bare(fields.get("warc-refers-to")), payload))
                    size += len(record)
                    if len(rows) >= _ROWS or size > 16 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    name = r"/part-(\d+)-[^/]*-c(\d+)[^/]*$"
    files = spark.read.format("binaryFile").load(f"{folder}/archives").select(
        F.regexp_extract("path", name, 1).cast("int").alias("part"),
        F.regexp_extract("path", name, 2).cast("int").alias("chunk"),
        "content",
    )
    return files.mapInArrow(inflate, f"{INDEXED}, payload binary")


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """The records of ``read_archives`` without their payloads, each held against its entry
    of the index: one that differs, or is missing on either side, fails."""
    place = ["part", "chunk", "offset"]
    facts = ["length", "record_type", "record_id", "payload_bytes", "payload_digest", "refers_to"]
    found = read_archives(spark, folder).select(*place, *facts, F.struct(*facts).alias("found"))
    named = read_index(spark, folder).select(*place, F.struct(*facts).alias("named"))
    wrong = F.raise_error(F.concat(F.lit("archive and index differ at "), F.concat_ws(":", *place))).cast("boolean")
    return found.join(named, place, "full").where(F.when(F.col("found").eqNullSafe(F.col("named")), True).otherwise(wrong)).drop("found", "named")


def warc(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", file_records: int = FILE_RECORDS) -> DataFrame:
    """Writes ``pages`` as archives below ``folder``, normalises them and reads them back:
    page_id, payload_bytes, payload_digest, record_type, refers_to, and the member's place
    (part, chunk, offset, length), one row per row of ``pages``.

    Null payloads count as empty; null and repeated identifiers as in ``records``. An empty
    table leaves archives without a record and gives no rows. Other columns are left out.
    """
    spark, kind = pages.sparkSession, pages.schema[page_id].dataType
    folder = folder or scratch_path(spark, "warc")
    write_archives(pages, f"{folder}/crawled", file_records, page_id=page_id, url=url, html=html)
    normalise(spark, f"{folder}/crawled", f"{folder}/normalised", file_records)
    return checked(spark, f"{folder}/normalised").select(
        _identifier("record_id", kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        _identifier("refers_to", kind).alias("refers_to"), "part", "chunk", "offset", "length",
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = """
WITH sized AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first, count(*) OVER (PARTITION BY payload_digest) AS copies
    FROM sized
), typed AS (
    SELECT *, payload_bytes >= 100 AND copies > 1 AND page_id IS DISTINCT FROM first AS revisit FROM firsts
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN first END AS refers_to
FROM typed
"""
