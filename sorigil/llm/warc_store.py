"""Content-addressed web archive: payload bytes once, record headers apart, records by joins.

Writing makes two tables below one folder: ``payloads`` (digest, payload), one row for each distinct payload,
and ``headers`` (record_id, digest, header), one row for each page with the exact header block of its WARC/1.1
record. Of the pages with equal payloads of at least ``LEAST_BYTES`` the one with the smallest id has a
``response`` record, the others are ``revisit`` records that refer to it; smaller payloads are not worth a reference, their
records are all responses (their bytes are stored once all the same).

Reading scans the payloads, recomputes every digest and length, joins them to the headers by digest and
compares with what the header says; any difference stops the job. ``records`` gives the whole original record.

The texts cross the network once, keyed by page, so a payload that a third of all pages share is no hot
key; the joins by digest are on narrow rows, with one row a digest on one side.

Results: null html is an empty payload. A null id is written as an empty record name, never referred to
while a page with an id has the same payload. Rows that repeat an id keep a record each. Line ends and other
control characters in an address are percent-encoded in the header; a null address has no header line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorigil.llm.common import work_folder

LEAST_BYTES = 100  # contract: smaller payloads are never revisited
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNNAMED = (1 << 63) - 1  # stands for a null id, behind all others


def described(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, payload, digest, n, key): every page with its payload's bytes, digest and length."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    one = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    return one.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("n"), F.coalesce("id", F.lit(UNNAMED)).alias("key"))


def header_block(date: str) -> Column:
    """The header lines of a record, from record_type, id, url, digest, n and keeper."""
    address = F.col("url")
    for code in (*range(32), 127):
        address = F.replace(address, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    revisit = F.col("record_type") == "revisit"

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))

    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", address), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("n").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("keeper").cast("string"), F.lit(">"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
    )


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """The two tables of the archive of ``pages``."""
    page = described(pages, id_col, url_col, html_col)
    narrow = page.select("key", "digest", "n")
    keepers = narrow.groupBy("digest").agg(F.min("key").alias("keeper"))
    kept = page.join(keepers.select(F.col("keeper").alias("key"), "digest"), ["key", "digest"], "left_semi")
    kept.select("key", "digest", "payload").dropDuplicates(["key", "digest"]).select("digest", "payload").write.option("compression", "zstd").parquet(f"{folder}/payloads")
    typed = page.select("id", "url", "digest", "n", "key").join(keepers, "digest").withColumn(
        "record_type", F.when((F.col("n") < LEAST_BYTES) | (F.col("key") == F.col("keeper")), "response").otherwise("revisit"))
    typed.select(F.col("id").alias("record_id"), "digest", header_block(date).alias("header")).write.option("compression", "zstd").parquet(f"{folder}/headers")


def field(name: str) -> Column:
    """The value of a header line, null where the header has none."""
    return F.regexp_extract("header", f"\n{name}: ([^\r]*)", 1)


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Every header joined to its verified payload: header, payload, payload_bytes, payload_digest and parsed fields."""
    stored = spark.read.parquet(f"{folder}/payloads")
    payloads = stored.select(
        "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), "digest"))).alias("payload_digest"),
    )
    headers = spark.read.parquet(f"{folder}/headers").withColumn("payload_digest", F.regexp_extract("header", "\nWARC-Payload-Digest: sha256:([0-9a-f]{64})", 1))
    joined = headers.join(payloads, "payload_digest", "left")
    same = field("X-Payload-Length").cast("long") == F.col("payload_bytes")
    return joined.select(
        "record_id", "header", "payload", "payload_digest",
        F.when(same, F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("no payload of the length in the header of "), F.col("payload_digest")))).alias("payload_bytes"),
        field("WARC-Type").alias("record_type"),
        F.nullif(F.regexp_extract("header", "\nWARC-Refers-To: <urn:page:([^>]*)>", 1), F.lit("")).alias("refers_to"),
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, record): the bytes of every original record; a revisit has an empty block."""
    block = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    end = F.lit(END).cast("binary")
    return read_back(spark, folder).select("record_id", F.concat(F.col("header").cast("binary"), end, block, end, end).alias("record"))


def archive_and_read(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Writes the archive of ``pages`` to the shared folder and reads it back, one row per page."""
    spark = pages.sparkSession
    folder = work_folder(spark, "warc")
    write_archive(pages, folder, id_col)
    back = read_back(spark, folder)
    return back.select(
        F.col("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(pages.schema[id_col].dataType).alias("refers_to")
    )
