import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import warc
from cohortkit.llm.tables import Stages

SCHEMA = "page_id bigint, url string, html string"
ROWS = [(5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, "http://a/9", "same"), (1, "http://a/1", "own é 中"), (2, None, None), (4, "http://a/4", ""),
        (6, "http://a/\r\nX: y", "crlf url"), (None, "http://a/n", "same"), (7, "http://a/7", "twice"), (7, "http://a/7", "twice"),
        (8, "http://a/8", "long\r\n\r\n" * 30000)]


def read(spark, rows, **options):
    stages = Stages(spark)
    folders = warc.write_archive(stages, spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit(1)).withColumn("uid", F.lit(2)), **options)
    return folders, warc.read_archive(spark, folders)


def test_round_trip(spark):
    folders, back = read(spark, ROWS)
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in back.collect())
    first = {}
    for p, _, h in ROWS:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    want, seen = [], set()
    for p, _, h in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)):
        h = h or ""
        new = h not in seen
        seen.add(h)
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want.append((p or 0, "response" if new else "revisit", None if new else first[h], len(h.encode()), digest))
    assert sorted(want, key=str) == sorted(got, key=str)
    assert spark.read.parquet(folders["payloads"]).count() == len({h or "" for _, _, h in ROWS})


def test_restored_records_are_well_formed(spark):
    folders, _ = read(spark, ROWS)
    rows = warc.restore_records(spark, folders).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        block = rest[:-4]
        assert rest.endswith(b"\r\n\r\n") and int(fields[b"Content-Length"]) == len(block)
        body = block.partition(b"\r\n\r\n")[2]
        assert body == (bytes(r.full_payload) if r.record_type == "response" else b"")
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(bytes(r.full_payload)).digest())


def test_small_payloads_are_not_deduplicated(spark):
    _, back = read(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], min_bytes=3)
    assert sorted((r.page_id, r.record_type) for r in back.collect()) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_changed_payload_is_noticed(spark, tmp_path):
    folders, _ = read(spark, ROWS)
    bad = f"{tmp_path}/payloads"
    spark.read.parquet(folders["payloads"]).withColumn("payload", F.concat("payload", F.lit(b"x"))).write.parquet(bad)
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, {**folders, "payloads": bad}).collect()


def test_empty_table(spark):
    assert read(spark, [])[1].count() == 0
