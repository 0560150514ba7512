"""Web archives with equal payloads stored once: WARC 1.0 files and their resolution."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsync.llm.common import stage
from docsync.storage import new_folder

# The base32 alphabet and the names of the format.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
#: Records of one archive file at most.
FILE_RECORDS = 1000
END = "\r\n"


def sha1_base32(payload: Column) -> Column:
    """Bare base32 SHA-1 of a text's UTF-8 bytes: 160 bits are 8 groups of 20, of 4 letters each."""
    digest = F.sha1(payload.cast("binary"))
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(bits, move).bitwiseAND(F.lit(31)) + 1,
                                F.lit(1)) for move in (15, 10, 5, 0)]
    return F.concat(*letters)


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.sha2(F.concat_ws("|", digest, F.coalesce(page_id.cast("string"), F.lit(""))), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[
        F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field without a value is left out."""
    return F.concat(*[F.when(v.isNull(), F.lit("")).otherwise(
        F.concat(F.lit(f"{k}: "), F.regexp_replace(v, r"[\r\n]+", " "), F.lit(END)))
        for k, v in fields])


def originals(pages: DataFrame, least: int = 0) -> DataFrame:
    """Payload digests that occur more than once, with the page that keeps the payload.

    Headers only are shuffled by digest, after a minimum in each task; payloads never move.
    """
    payload = F.coalesce(pages["html"], F.lit(""))
    heads = pages.select(sha1_base32(payload).alias("digest"), F.struct(
        pages["page_id"].isNull().alias("none"), pages["page_id"].cast("long").alias("page_id"),
        pages["url"].alias("url")).alias("page"), F.octet_length(payload).alias("bytes"))
    return heads.filter(F.col("bytes") >= least).groupBy("digest").agg(
        F.count("*").alias("records"), F.min("page").alias("page")).filter("records > 1").select(
        "digest", F.col("page.page_id").alias("first_id"), F.col("page.url").alias("first_url"))


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """One WARC record per page, as text without the record's closing empty lines."""
    # Written, so that its size decides whether the pages are shuffled to meet it. It has one
    # row per repeated payload only.
    first = stage(originals(pages, least), "originals")
    payload = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"),
                        payload.alias("payload"), sha1_base32(payload).alias("digest"),
                        F.octet_length(payload).alias("bytes"))
    rows = rows.join(first.withColumnRenamed("digest", "first_digest"),
                     F.col("digest") == F.col("first_digest"), "left")
    again = F.col("first_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (
        F.col("bytes") >= least)
    size = F.col("bytes").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}"), _lines(
        ("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", size)), F.lit(END))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(F.lit(f"WARC/1.0{END}"), _lines(
        ("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(again, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(again, _record_id(F.col("first_id"), F.col("digest")))),
        ("WARC-Refers-To-Target-URI", F.when(again, F.col("first_url"))),
        ("WARC-Refers-To-Date", F.when(again, F.lit(DATE))),
        ("Page-Id", F.col("page_id").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string"))), F.lit(END))
    return rows.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Archives of (page_id, url, html) rows. Each text line of Spark's writer is one record; the
    line separator is the two empty lines that end it, so the files are plain WARC."""
    (records(pages, least).write.mode("overwrite").option("lineSep", END + END)
     .option("maxRecordsPerFile", FILE_RECORDS).text(folder))


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive, by its Content-Length."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(archive[at:end])}
        start = end + 4
        stop = start + int(fields["content-length"])
        yield fields, archive[start:stop]
        at = stop + 4


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_id", "record_type", "digest", "bytes", "refers", "payload"]
    for batch in batches:
        for archive in batch["content"]:
            out = []
            for fields, block in parsed(archive.as_py()):
                head, _, payload = block.partition(b"\r\n\r\n")
                http = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(head)}
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                kind, size = fields["warc-type"], int(http["content-length"])
                if kind == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != digest or len(payload) != size:
                        raise ValueError(f"damaged record {fields['warc-record-id']}")
                page = fields.get("page-id")
                out.append((None if page is None else int(page), fields["warc-record-id"], kind,
                            digest, size, fields.get("warc-refers-to"),
                            payload.decode("utf-8") if kind == "response" else None))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(),
                     pa.string()]
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives of a folder; the payload of responses is checked and returned."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(_read, (
        "page_id long, record_id string, record_type string, digest string, bytes long, "
        "refers string, payload string"))


def resolved(found: DataFrame) -> DataFrame:
    """Records with the page that a revisit refers to."""
    rows = found.drop("payload")
    targets = rows.filter("refers IS NOT NULL").select(F.col("refers").alias("target")).distinct()
    kept = rows.filter("record_type = 'response'").join(
        targets, F.col("record_id") == F.col("target"), "left_semi").groupBy("record_id").agg(
        F.min("page_id").alias("first_id")).withColumnRenamed("record_id", "first_record")
    out = rows.join(kept, F.col("refers") == F.col("first_record"), "left")
    return out.select("page_id", F.col("bytes").alias("payload_bytes"),
                      F.col("digest").alias("payload_digest"), "record_type",
                      F.col("first_id").alias("refers_to"))


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages through archives and back: one row per page, as read from its record.

    A null html is an empty payload; payloads of fewer than ``least`` bytes are never revisits. Of
    equal payloads the smallest page_id keeps it (rows that repeat that page_id keep it too);
    null page_ids come last. A null url has no target line. An empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, least)
    # Heads only are written down: the result reads archives once, whatever is done with it.
    return resolved(stage(read_archives(spark, folder).drop("payload").withColumn(
        "payload", F.lit(None).cast("string")), "heads"))
