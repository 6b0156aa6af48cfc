"""Content-addressed WARC archives: each payload stored once, headers kept exactly, records rejoined.

An archive is a folder with two tables. ``payloads`` holds the bytes of each distinct payload under its
SHA-256, ``records`` the exact header block of each record with the digest of what follows it.
Joining the two gives the original records byte for byte.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The WARC 1.1 line ends and the profile of a revisit by identical payload.
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # records of equal input are equal; pages carry no crawl date
MIN_SHARED = 1000  # bytes; smaller payloads are never written as revisits


def record_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _payloads(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, payload, sha256, sha1, bytes) per page."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    url = F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\r\n]", "")
    return pages.select(
        F.col(id_col).alias("id"), url.alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("sha256"), F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )


def make_headers(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, header, sha256, kind, refers_to) per page; payloads are hashed in place, not moved.

    Of equal payloads of at least ``MIN_SHARED`` bytes the one with the largest id is the
    response and the others revisit it; smaller payloads are all responses. Rows with a null id
    are responses and are never revisited; of rows that repeat the response's id each is a response.
    A null payload is empty. A null url is an empty target.
    """
    rows = _payloads(pages, id_col, url_col, html_col).drop("payload")
    shared = rows.where((F.col("bytes") >= MIN_SHARED) & F.col("id").isNotNull())
    best = shared.groupBy("sha256").agg(F.max("id").alias("best"), F.count("*").alias("n"))
    best = best.where("n > 1").select("sha256", "best")
    rows = rows.join(best, "sha256", "left")
    revisit = F.col("best").isNotNull() & F.col("id").isNotNull() & (F.col("id") != F.col("best"))
    rows = rows.withColumn("kind", F.when(revisit, "revisit").otherwise("response"))
    rows = rows.withColumn("refers_to", F.when(revisit, F.col("best")))
    length = F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", F.col("kind")),
        _field("WARC-Record-ID", record_urn(F.col("id"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                _field("WARC-Refers-To", record_urn(F.col("refers_to"))),
                _field("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(""),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", length),
        F.lit(CRLF),
    )
    return rows.select("id", header.cast("binary").alias("header"), "sha256", "kind", "refers_to")


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """Write the pages below ``path``: payloads once each, headers with the digest of their block.

    Two different payloads under one SHA-256 would show as two lengths or two SHA-1 sums; that raises.
    """
    stored = _payloads(pages, id_col, url_col, html_col).groupBy("sha256").agg(
        F.any_value("payload").alias("payload"),
        F.min("bytes").alias("b0"), F.max("bytes").alias("b1"),
        F.min("sha1").alias("s0"), F.max("sha1").alias("s1"),
    )
    one = (F.col("b0") == F.col("b1")) & (F.col("s0") == F.col("s1"))
    verified = F.when(one, F.col("sha256")).otherwise(
        F.raise_error(F.lit("different payloads have the same digest"))
    )
    stored.select(verified.alias("sha256"), "payload").write.parquet(f"{path}/payloads")
    headers = make_headers(pages, id_col, url_col, html_col)
    block = F.when(F.col("kind") == "response", F.col("sha256"))
    headers.select("header", block.alias("sha256")).write.parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(record) the original records: header, block and the two line ends after it, as bytes.

    A block that is missing from the store, or whose bytes do not hash to its name, raises.
    """
    headers = spark.read.schema("header binary, sha256 string").parquet(f"{path}/records")
    stored = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    sound = stored.select(
        F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("sha256"))
        .otherwise(F.raise_error(F.lit("a stored payload does not match its digest")))
        .alias("sha256"),
        "payload",
    )
    joined = headers.join(sound, "sha256", "left")
    block = F.when(F.col("sha256").isNull(), F.lit(b"")).otherwise(
        F.coalesce("payload", F.raise_error(F.lit("a payload is missing")).cast("binary"))
    )
    return joined.select(F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"))


FIELD = re.compile(rb"([A-Za-z-]+): ?(.*)")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of the records in ``data``; blocks go by Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in lines[1:]:
            m = FIELD.fullmatch(line)
            if m is None:
                raise ValueError(f"bad header line in the record at byte {at}")
            fields[m[1].decode().lower()] = m[2].decode()
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, data[start:stop]
        at = stop + 4


PARSED = "id string, url string, kind string, sha1 string, bytes long, refers_to string, block binary"


def _page(urn: str | None) -> str | None:
    name = urn[len("<urn:page:") : -1] if urn else None
    return None if name in (None, "null") else name


def _parsed(raw: DataFrame, with_block: bool) -> DataFrame:
    """Columns of PARSED from one column of concatenated records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for data in b.column(0):
                for f, block in parse_records(data.as_py()):
                    sha1 = f["warc-payload-digest"].removeprefix("sha1:")
                    if f["warc-type"] == "response" and hashlib.sha1(block).hexdigest() != sha1:
                        raise ValueError(f"{f['warc-record-id']}: the block does not match its digest")
                    rows.append(
                        (_page(f["warc-record-id"]), f["warc-target-uri"], f["warc-type"], sha1,
                         int(f["warc-payload-length"]), _page(f.get("warc-refers-to")), block if with_block else None)
                    )
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
            cols = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                [x.split()[0] for x in PARSED.split(", ")],
            )

    return raw.mapInArrow(run, PARSED)


def parse_archive(records: DataFrame, with_block: bool = True) -> DataFrame:
    """Fields of each (record) row; a response's block must match its payload digest."""
    return _parsed(records.select("record"), with_block)


def write_warc_files(records: DataFrame, path: str) -> None:
    """Write (record) rows as plain .warc text files, one per partition; payloads are UTF-8."""
    body = F.substring("record", F.lit(1), F.octet_length("record") - 2).cast("string")
    # the writer adds the last line end of each record
    records.select(body.alias("value")).write.option("lineSep", CRLF).text(path)


def read_warc_files(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """Columns of PARSED from files written by ``write_warc_files``; a file is read by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return _parsed(files.select("content"), with_block)


def warc_round_trip(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write the pages' archive below ``path``, read it back, and describe each record.

    (id, payload_bytes, payload_digest, record_type, refers_to); length and digest of a revisit
    are those of the full payload.
    """
    write_archive(pages, path, id_col, url_col, html_col)
    kind = pages.schema[id_col].dataType
    back = parse_archive(read_archive(pages.sparkSession, path), with_block=False)
    return back.select(
        F.col("id").cast(kind).alias(id_col),
        F.col("bytes").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
