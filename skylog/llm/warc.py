"""A content-addressed web archive.

The archive is two tables. ``payloads`` holds the bytes of every distinct
payload once, under their SHA-256. ``records`` holds a line per capture: the
exact bytes of its WARC header and of the HTTP head before its payload, and the
address of the payload. Joining them gives the original records back, byte for
byte; a payload is only trusted if its bytes still hash to its address.

Pages carry no HTTP head and no date of their own. A record of type ``response``
must have a head, so each gets the plainest one (``HTTP_HEAD``); the date is
the ``date_column``'s, or the time of writing. Record ids name the archive, the
page and the row, so that no two records share one.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylog.llm.common import materialise, scratch_path

# A payload shorter than this is written as a response every time: a revisit would save nothing.
REVISIT_BYTES = 1000
CRLF = "\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _record_id(archive: str, page: Column, row: Column) -> Column:
    number = F.coalesce(page.cast("string"), F.lit("null"))
    return F.concat(F.lit(f"<urn:page:{archive}:"), number, F.lit(":"), row.cast("string"), F.lit(">"))


def _header_block(archive: str) -> Column:
    """The WARC header with its empty line, and the HTTP head. A revisit's block is the head alone."""
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(archive, F.col("page_id"), F.col("row"))),
        _header("WARC-Date", F.col("date")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            revisit,
            F.concat(
                _header("WARC-Profile", F.lit(PROFILE)),
                _header("WARC-Refers-To", _record_id(archive, F.col("keep.page_id"), F.col("keep.row"))),
                _header("WARC-Refers-To-Target-URI", F.col("keep.url")),
                _header("WARC-Refers-To-Date", F.col("keep.date")),
            ),
        ).otherwise(F.lit("")),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", (F.lit(len(HTTP_HEAD)) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))).cast("string")),
        F.lit(CRLF + HTTP_HEAD),
    )


def write_archive(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", revisit_bytes: int = REVISIT_BYTES, date_column: str | None = None, archive: str | None = None) -> None:
    """Write ``pages`` as an archive under ``path``.

    Of records with equal payloads of at least ``revisit_bytes`` the one with the
    largest id is the response, and the others are revisits that name it; null
    ids come last, and of rows that repeat an id one is the response. Shorter
    payloads are responses each time. A null payload counts as empty, a null URL
    as an empty one; line breaks in a URL, which would end its header, are
    escaped. ``date_column`` is a timestamp in the session's zone; without it, and
    where it is null, the date is that of writing. ``archive`` is the name in the
    record ids, a random one where none is given. Other columns are not read. An
    empty table makes an empty archive. Equal means equal SHA-256 and length;
    SHA-1 is only what the header says.
    """
    archive = archive or uuid.uuid4().hex
    url = F.replace(F.replace(F.coalesce(F.col(url_column).cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    taken = F.coalesce(F.col(date_column).cast("timestamp_ltz"), F.current_timestamp()) if date_column else F.current_timestamp()
    date = F.date_format(F.to_utc_timestamp(taken, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.coalesce(F.encode(F.col(payload_column).cast("string"), "UTF-8"), F.lit(b""))
    captures = pages.select(F.col(id_column).alias("page_id"), url.alias("url"), date.alias("date"), payload.alias("payload"))
    addressed = captures.withColumn("address", F.unhex(F.sha2("payload", 256)))

    # Once per address. Partial aggregation leaves one row per task for a payload that many captures share.
    addressed.groupBy("address").agg(F.first("payload").alias("payload")).write.parquet(os.path.join(path, "payloads"))

    lines = addressed.select(
        "page_id", "url", "date", "address",
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    lines = materialise(lines, "captures")
    longest = lines.where(F.col("payload_bytes") >= revisit_bytes)
    kept = longest.groupBy("address").agg(F.max(F.struct("page_id", "row", "url", "date")).alias("keep"))
    # A shared address makes this join uneven; both sides are plain shuffles, which adaptive execution splits.
    decided = lines.join(kept, "address", "left")
    revisit = F.coalesce(F.col("keep.row") != F.col("row"), F.lit(False))
    decided = decided.withColumns(
        {"record_type": F.when(revisit, "revisit").otherwise("response"), "refers_to": F.when(revisit, F.col("keep.page_id"))}
    )
    records = decided.select("page_id", F.encode(_header_block(archive), "UTF-8").alias("header"), "address")
    records.write.parquet(os.path.join(path, "records"))


def _field(block: Column, name: str, pattern: str) -> Column:
    found = F.regexp_extract(block, f"(?m)^{name}: {pattern}\\r?$", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One line per record: ``page_id, url, record_type, refers_to, payload_digest, header, payload``.

    ``header`` ends with the HTTP head. Fields come from the header bytes, the payload by its address. A payload
    that does not hash to its address, one that is missing, or one that does not
    have the digest its header states, fails the query.
    """
    records = spark.read.parquet(os.path.join(path, "records"))
    payloads = spark.read.parquet(os.path.join(path, "payloads"))
    whole = F.unhex(F.sha2("payload", 256)) == F.col("address")
    stored = payloads.select(
        F.col("address").alias("stored"),
        F.when(whole, F.col("payload")).otherwise(F.raise_error(F.lit("archive: a payload does not match its address"))).alias("payload"),
    )
    joined = records.join(stored, records["address"] == stored["stored"], "left")
    block = F.decode("header", "UTF-8")
    parsed = joined.select(
        "header",
        "payload",
        _field(block, "WARC-Record-ID", "<urn:page:[^:]*:(-?\\d+):\\d+>").cast("long").alias("page_id"),
        F.regexp_extract(block, "(?m)^WARC-Target-URI: ([^\\r\\n]*)", 1).alias("url"),
        _field(block, "WARC-Type", "(\\w+)").alias("record_type"),
        _field(block, "WARC-Refers-To", "<urn:page:[^:]*:(-?\\d+):\\d+>").cast("long").alias("refers_to"),
        _field(block, "WARC-Payload-Digest", "sha1:([0-9a-f]+)").alias("stated"),
    )
    digest = F.sha1("payload")
    agreed = F.when(F.coalesce(digest == F.col("stated"), F.lit(False)), digest).otherwise(
        F.raise_error(F.lit("archive: a payload is missing or does not have the digest of its header"))
    )
    return parsed.select("page_id", "url", "record_type", "refers_to", agreed.alias("payload_digest"), "header", "payload")


def original_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records as bytes: ``page_id, record``. A revisit's block is its HTTP head alone; a response has its payload behind it."""
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit((CRLF * 2).encode())
    return read_archive(spark, path).select("page_id", F.concat("header", block, end).alias("record"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to a new archive in the shared folder and describe what reading it back gives."""
    path = scratch_path(pages.sparkSession, "archive")
    write_archive(pages, path)
    records = read_archive(pages.sparkSession, path)
    return records.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
