"""WARC archives with revisit records in place of repeated payloads.

Writing: headers (name, page id, digest, length) are shuffled by payload digest. Of equal
payloads of at least ``LEAST`` bytes the one with the largest page id is written as a
``response``; the others meet it in a join by digest and become ``revisit`` records that
refer to it and carry no payload. Every record gets fresh headers. Texts take no part in the
shuffle by digest; they meet the list of revisits by row, which no hot digest can skew, and
are not shuffled at all while Spark finds that list short enough to send to all tasks.

An archive is a gzipped file of records, each ended by two line breaks, written by Spark's
text writer, so it can lie in any store that Spark knows. Reading goes by Content-Length,
record by record, whatever a payload holds, and joins revisits by digest and record id with
the responses that they refer to.

``pages`` must give the same rows in the same order when it is evaluated again, as a scan of
files does: rows are named by their place.

Defined results: a null payload counts as empty; a null page id is smaller than any other and
a header less; a null address is a header less; of repeated ids with one payload, the
row with the largest address, then the last one, is the response; an empty table gives an
empty archive; other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import settle

#: Shorter payloads are always written: a revisit record would save little.
LEAST = 1_000
#: Records of an archive, at most.
RECORDS = 2_000

VERSION = "WARC/1.1"
BREAK = "\r\n"
END = BREAK * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = (
    "record_type string, record_id string, page_id long, target_uri string, payload_digest string, "
    "refers_to_id string, payload_bytes long, payload binary"
)


def _named(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("digest"),
    )


def revisits(headers: DataFrame, least: int = LEAST) -> DataFrame:
    """(row, original) of the headers whose payload another header of the same payload holds.

    ``headers``: (row, page_id, url, payload_bytes, digest, check), ``check`` being a second
    hash, so that payloads made to collide in the digest are not taken for equal.
    """
    payload = ["digest", "payload_bytes", "check"]
    large = headers.where(F.col("payload_bytes") >= least)
    last = F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "url", "row"))
    held = large.groupBy(*payload).agg(last.alias("original"), F.count("*").alias("copies")).where("copies > 1")
    met = large.join(settle(held.select(*payload, "original"), "originals"), payload)
    return met.where(F.col("row") != F.col("original.row")).select("row", F.col("original.row").alias("first_row"), F.col("original.url").alias("first_url"))


def _header(name: str, value: Column) -> Column:
    """One header line, none for null. Line breaks in a value are written as in an address."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(BREAK)), F.lit(""))


def _record_id(run: str, row: Column) -> Column:
    digits = F.md5(F.concat(F.lit(run), row.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _record(run: str, date: str) -> Column:
    """The text of a record without its end, from a row of :func:`_named` and where it was met first, if it is a revisit."""
    again = F.col("first_row").isNotNull()
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=UTF-8{BREAK}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    of_revisit = F.concat(
        _header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To", _record_id(run, F.col("first_row"))),
        _header("WARC-Refers-To-Target-URI", F.col("first_url")), _header("WARC-Refers-To-Date", F.lit(date)),
    )
    return F.concat(
        F.lit(VERSION + BREAK),
        _header("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _record_id(run, F.col("row"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, of_revisit).otherwise(F.lit("")),
        _header("Page-ID", F.col("page_id")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(http) + F.octet_length(body)),
        F.lit(BREAK), http, body,
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST) -> None:
    """Write ``pages`` (page_id, url, html) as archives in the folder ``path``."""
    spark, run = pages.sparkSession, uuid.uuid4().hex
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    named = _named(pages)
    headers = settle(named.withColumn("check", F.xxhash64("payload")).drop("payload"), "headers")
    known = settle(revisits(headers, least), "revisits")
    records = named.join(known, "row", "left").select(_record(run, date).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


def _parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by name in lower case, and block of every record."""
    with gzip.open(io.BytesIO(archive)) as file:
        while line := file.readline():
            if line != f"{VERSION}{BREAK}".encode():
                raise ValueError(f"not the start of a record: {line[:80]!r}")
            fields = {}
            while (line := file.readline()) != BREAK.encode():
                name, colon, value = line.decode("utf-8", "replace").partition(":")
                if not colon:
                    raise ValueError(f"not a header: {line[:80]!r}")
                fields[name.lower()] = value.strip()
            block = file.read(length := int(fields["content-length"]))
            if len(block) != length or file.read(len(END)) != END.encode():
                raise ValueError(f"record {fields.get('warc-record-id')} does not end where it says")
            yield fields, block


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in ``path``: (record_type, record_id, page_id, target_uri, payload_digest, refers_to_id, payload_bytes, payload).

    Digest and length of a response are taken from the payload as it was read, which must
    have the digest that its header names; those of a revisit are what its header says. An
    archive is read whole by one task. Without ``payloads`` that column is null.
    """
    schema = pa.schema([
        ("record_type", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()),
        ("payload_digest", pa.string()), ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ])

    def row(fields: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(END.encode())
        kind, named = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        digest, size = named, None
        if kind == "response":
            digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
            if digest != named:
                raise ValueError(f"record {fields['warc-record-id']} does not have the payload of its digest")
        page = fields.get("page-id")
        return kind, fields["warc-record-id"], None if page is None else int(page), fields.get("warc-target-uri"), digest, fields.get("warc-refers-to"), size, payload if payloads and kind == "response" else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for fields, block in _parsed(archive.as_py()):
                    rows.append(row(fields, block))
                    held += len(block) if payloads else 0
                    if len(rows) == RECORDS or held > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORD_SCHEMA)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with every revisit's length, payload and ``refers_to``, the page id of the response it refers to."""
    first = records.where("record_type = 'response'")
    again = records.where("record_type = 'revisit'").drop("payload_bytes", "payload")
    target = first.select(
        F.col("payload_digest").alias("d"), F.col("record_id").alias("r"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload"
    )
    met = again.join(target, (again["payload_digest"] == target["d"]) & (again["refers_to_id"] == target["r"]), "left")
    columns = [*records.columns, "refers_to"]
    return first.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(met.select(*columns))
