import base64
import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

from stowage.llm import warc

ROWS = [(1, "http://a", "<p>x</p>"), (2, None, None), (3, "http://b\r\nWARC-Type: revisit WARC-Type: revisit", "<p>x</p>"),
        (4, "http://c", ""), (5, "http://d", "é" * 5000), (6, "", "<p>x</p>"), (6, "", "<p>x</p>"), (None, "http://e", "<p>x</p>"),
        (None, "http://f", "alone"), (7, "http://g", "\r\n\r\nWARC-Type: x\r\n")]


@pytest.fixture(scope="module")
def archived(spark):
    path = tempfile.mkdtemp(prefix="warc-")
    pages = spark.createDataFrame([(*r, "z", b"q") for r in ROWS], "page_id long, url string, html string, sha256 string, payload binary")
    warc.archive(pages, path)
    return path


def test_records_come_back(spark, archived):
    rows = warc.restored(spark, archived).collect()
    assert len(rows) == len(ROWS)
    largest = {}
    for i, _, body in ROWS:
        largest[body or ""] = max((x for x in (largest.get(body or ""), i) if x is not None), default=None)
    expected = []
    for i, _, body in ROWS:
        data, holder = (body or "").encode(), largest[body or ""]
        again = holder is not None and holder != i
        expected.append((i, data, base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                         str(holder) if again else None))
    got = [(r.page_id, bytes(r.payload), r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    for r in rows:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and sum(x.startswith("WARC-Type: ") for x in lines) == 1
        length = int(next(x for x in lines if x.startswith("Content-Length: ")).split()[1])
        assert len(rest) == length + 4 and rest.endswith(b"\r\n\r\n")
        if r.record_type == "response":
            assert rest[:-4].endswith(bytes(r.payload))


def test_each_payload_is_stored_once(spark, archived):
    stored = spark.read.parquet(f"{archived}/payloads").collect()
    assert sorted(bytes(r.payload) for r in stored) == sorted({(b or "").encode() for _, _, b in ROWS})
    assert all(hashlib.sha256(bytes(r.payload)).hexdigest() == r.sha256 for r in stored)


def test_damage_is_seen(spark, archived):
    broken = tempfile.mkdtemp(prefix="warc-")
    spark.read.parquet(f"{archived}/headers").write.mode("overwrite").parquet(f"{broken}/headers")
    spark.read.parquet(f"{archived}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!"))).write.mode(
        "overwrite").parquet(f"{broken}/payloads")
    with pytest.raises(Exception, match="missing or damaged"):
        warc.restored(spark, broken).collect()


def test_smaller_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    rows = warc.headers(warc.digested(pages), smallest=4).select("page_id", F.decode("header", "UTF-8").alias("h")).collect()
    assert {r.page_id for r in rows if "WARC-Type: revisit" in r.h} == {3}


def test_empty_table(spark):
    path = tempfile.mkdtemp(prefix="warc-")
    warc.archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.restored(spark, path).collect() == []
