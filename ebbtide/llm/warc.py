"""Content-addressed WARC archive.

An archive is a folder of two Parquet tables:

    payloads   digest (SHA-256, hex), payload      every payload once
    records    digest, header                      the exact bytes before the payload: WARC header, blank line,
                                                   HTTP header, blank line

A record is `header`, the payload of its digest if it is a response, and two line ends; `read_records` rebuilds it by a
join on the digest.  Revisit records have no payload of their own; their digest still leads to it.

Digests are verified: a digest whose payloads differ in length or in SHA-1 fails the write, a stored payload that does
not have its digest, or whose SHA-1 is not the one in the header, fails the read.

Payloads are deduplicated by aggregation, so copies are dropped before the shuffle.  Which record is
the response is decided on digests and ids only.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import new_folder, read_table

DATE = "2025-01-01T00:00:00Z"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex_digest: Column) -> Column:
    """Base 32 of 40 hex digits: five of them make four letters."""
    letters = []
    for group in range(8):
        value = F.conv(F.substring(hex_digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(_ALPHABET), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1))
            for shift in (15, 10, 5, 0)
        ]
    return F.concat(*letters)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  least_bytes: int = 0, date: str = DATE) -> None:
    """Write a record per row of `pages` to the archive at `path`; null html is an empty payload.

    Of records with equal payloads of at least `least_bytes` bytes, that with the largest id is the response and the
    others revisit it; rows that repeat the largest id are all responses.  Shorter payloads are always
    responses.  Null ids are smaller than any other and have an empty name; a null url has no header line, and line
    ends in a url are percent-encoded.  No rows make an empty archive."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"),
        F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))

    payloads = rows.groupBy("digest").agg(F.first("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{path}/payloads")

    light = rows.select("id", "url", "digest", F.octet_length("payload").alias("n"), F.sha1("payload").alias("sha1"))
    groups = light.groupBy("digest").agg(
        F.max("id").alias("holder"), F.min("n").alias("n_min"), F.max("n").alias("n_max"),
        F.min("sha1").alias("sha1_min"), F.max("sha1").alias("sha1_max"),
    )
    clash = (F.col("n_min") != F.col("n_max")) | (F.col("sha1_min") != F.col("sha1_max"))
    groups = groups.select("digest", F.when(
        clash, F.raise_error(F.concat(F.lit("different payloads with digest "), "digest")).cast("long")
    ).otherwise(F.col("holder")).alias("holder"))

    revisit = (F.col("n") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("holder"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n").cast("string"), F.lit("\r\n\r\n"),
    )
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("id")),
        F.lit(f"\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.col("url")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32(F.col("sha1")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), _record_id(F.col("holder")), F.lit(f"\r\nWARC-Profile: {_PROFILE}")))
        .otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))).cast("string"),
        F.lit("\r\n\r\n"), http,
    )
    records = light.join(groups, "digest").select("digest", header.cast("binary").alias("header"))
    records.write.option("compression", "zstd").parquet(f"{path}/records")


def _line(name: str) -> Column:
    """A line's value in the WARC header, or null."""
    value = F.regexp_extract("header", rf"^(?s:.*?)\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(F.instr("header", f"\r\n{name}: ") > 0, value)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the archive: page_id, record_type, refers_to, url, payload (also of revisits) and `record`, its exact bytes."""
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads").withColumn(
        "payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest")).cast("binary"))
    )
    records = spark.read.schema("digest string, header binary").parquet(f"{path}/records")
    joined = records.withColumnRenamed("header", "bytes").withColumn("header", F.col("bytes").cast("string")).join(payloads, "digest")
    kind = F.regexp_extract("header", r"^WARC/1\.1\r\nWARC-Type: ([a-z]+)\r\n", 1)
    sha1 = base32(F.sha1("payload"))

    def name(line: Column) -> Column:
        return F.nullif(F.regexp_extract(line, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")

    return joined.select(
        name(_line("WARC-Record-ID")).alias("page_id"), kind.alias("record_type"),
        name(_line("WARC-Refers-To")).alias("refers_to"), _line("WARC-Target-URI").alias("url"),
        F.when(_line("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), sha1), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("wrong payload for "), _line("WARC-Record-ID"))).cast("binary")).alias("payload"),
        F.concat("bytes", F.when(kind == "response", F.col("payload")).otherwise(F.lit(b"")), F.lit(b"\r\n\r\n")).alias("record"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archive")
    write_archive(read_table(spark, sf_dir, "pages"), path)
    return read_records(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"), "record_type", "refers_to",
    )
