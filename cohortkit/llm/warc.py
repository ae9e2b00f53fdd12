"""Content-addressed WARC archive.

Two tables make an archive: ``payloads`` holds the bytes of every distinct payload once under its
SHA-256, ``records`` the exact header bytes of every record (WARC header and HTTP header) with the
payload's digest. Reading back verifies each payload against its digest and the records' lengths,
and :func:`restore_records` rebuilds the original records by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.tables import Stages, join_unique

CRLF = "\r\n"
CAPTURED = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each five hex digits (20 bits) are four base-32 digits."""
    h = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def _record_id(page_id: Column, uid: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), uid.cast("string"), F.lit(">"))


def _headers(df: DataFrame) -> Column:
    url = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size"), F.lit(CRLF * 2))
    kind = F.when(F.col("is_response"), "response").otherwise("revisit")
    refers = F.when(F.col("is_response"), "").otherwise(F.concat(
        F.lit("WARC-Refers-To: "), _record_id(F.col("first.page_id"), F.col("first.uid")), F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}")))
    length = F.octet_length(http) + F.when(F.col("is_response"), F.col("size")).otherwise(0)
    return F.encode(F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind,
        F.lit(f"{CRLF}WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("uid")),
        F.lit(f"{CRLF}WARC-Date: {CAPTURED}{CRLF}WARC-Target-URI: "), url,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("sha1"), F.lit(CRLF), refers,
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), length, F.lit(CRLF * 2), http), "UTF-8")


def write_archive(stages: Stages, pages: DataFrame, min_bytes: int = 0) -> dict[str, str]:
    """Write ``pages`` (page_id, url, html) as an archive; returns the folders of its two tables.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id
    (null last, repeated ids by their place in the input) is the response, the others revisit it;
    smaller ones are all responses. Null html is an empty payload, a null url an empty one; CR and LF
    in a url are percent-encoded. Extra columns are ignored."""
    pay = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    p = pages.select("page_id", "url", pay.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    light = stages.put("light", p.select(
        F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), "url", "digest",
        F.octet_length("payload").cast("long").alias("size"), base32_sha1(F.col("payload")).alias("sha1")))
    rank = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "uid")
    first = light.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    joined = join_unique(light, first, "digest", ["first"], "n", light.count())
    joined = joined.withColumn("is_response", F.col("first").isNull() | (F.col("first.uid") == F.col("uid")))
    folders = {"payloads": stages.path("payloads"), "records": stages.path("records")}
    joined.select("digest", "is_response", _headers(joined).alias("header")).write.parquet(folders["records"])
    p.select("digest", "payload").dropDuplicates(["digest"]).write.parquet(folders["payloads"])
    return folders


def read_archive(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """One row per record: the fields of its header and, of responses, the verified ``payload``.

    A payload that does not match its digest, or a record whose payload is missing or of another
    length, raises an error."""
    rec = spark.read.parquet(folders["records"])
    text = F.decode("header", "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+):", 1)
    opt = lambda c: F.when(c != "", c).cast("long")
    rec = rec.select(
        "header", "digest", "is_response", field("WARC-Type").alias("record_type"),
        opt(page(field("WARC-Record-ID"))).alias("page_id"), opt(page(field("WARC-Refers-To"))).alias("refers_to"),
        field("WARC-Target-URI").alias("url"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        F.regexp_extract(text, r"(?s)\r\n\r\n.*\r\nContent-Length: (\d+)\r\n", 1).cast("long").alias("payload_bytes"))
    pay = spark.read.parquet(folders["payloads"])
    broken = F.raise_error(F.concat(F.lit("payload does not match its record: "), F.col("digest")))
    full = rec.where("is_response").join(pay, "digest", "left")
    fits = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("payload_bytes")) & (
        base32_sha1(F.col("payload")) == F.col("payload_digest"))
    full = full.withColumn("payload", F.when(F.coalesce(fits, F.lit(False)), F.col("payload")).otherwise(broken.cast("binary")))
    return full.unionByName(rec.where("NOT is_response").withColumn("payload", F.lit(None).cast("binary"))).drop("is_response")


def restore_records(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(page_id, record): the bytes of each record as a WARC file has them, and of revisits the full
    ``payload`` they stand for, by joining the headers with the payloads."""
    rec = read_archive(spark, folders)
    record = F.concat("header", F.coalesce("payload", F.lit(b"")), F.lit((CRLF * 2).encode()))
    same = spark.read.parquet(folders["payloads"]).withColumnRenamed("payload", "full_payload")
    return rec.withColumn("record", record).join(same, "digest").select("page_id", "url", "record_type", "record", "full_payload")


def op8_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = write_archive(Stages(spark), spark.read.parquet(f"{sf_dir}/pages.parquet"))
    back = read_archive(spark, folders)
    size = F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes")
    sha1 = F.coalesce(base32_sha1(F.col("payload")), "payload_digest")
    return back.select("page_id", size.alias("payload_bytes"), sha1.alias("payload_digest"), "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html),
d AS (SELECT p.page_id, p.html, f.first_id, sha1(p.html) AS hex FROM p JOIN f USING (html))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
           (CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
