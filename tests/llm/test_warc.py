import base64
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from regline.llm import warc

SCHEMA = "page_id bigint, url string, html string, value string, digest string"
EVIL = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n"
ROWS = [
    (1, "http://a/\r\nWARC/1.1", EVIL), (2, None, EVIL), (3, "u", None), (4, "u", ""), (None, "u", "zz"), (5, "u", "zz"), (5, "u", "zz"),
    (6, "u", EVIL * 3), (7, "u", "ends\r\n"), (8, "WARC/1.0", "é" * 500 + "\r\n\r\n"), (9, "u", "y" * 300_000),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "v", "d") for r in rows], SCHEMA)


def page_of(record_id):
    return record_id.split(":")[2]


@pytest.mark.parametrize("range_bytes", [61, 1000, 1 << 25])
def test_what_is_written_is_read(spark, tmp_path, range_bytes):
    warc.write(table(spark, ROWS).repartition(2), str(tmp_path / "w"))
    got = warc.read(spark, str(tmp_path / "w"), range_bytes).collect()
    assert len(got) == len(ROWS)
    responses = {r.record_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    assert sorted(responses.values()) == sorted({h or "" for _, _, h in ROWS})
    assert sorted(map(page_of, responses)) == ["2", "4", "5", "6", "7", "8", "9"]
    for r in got:
        if r.record_type == "revisit":
            assert bytes(r.payload) == b"" and r.refers_to in responses
            want = hashlib.sha1(responses[r.refers_to].encode()).digest()
            assert r.payload_digest == "sha1:" + base64.b32encode(want).decode()
    assert next(r.target_uri for r in got if page_of(r.record_id) == "1") == "http://a/%20%20WARC/1.1"


def test_small_payloads_may_stay_responses(spark, tmp_path):
    warc.write(table(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), str(tmp_path / "w"), min_bytes=3)
    got = {(page_of(r.record_id), r.record_type) for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert got == {("1", "response"), ("2", "response"), ("3", "revisit"), ("4", "response")}


def test_damaged_files(spark, tmp_path):
    def record(body, kind="resource"):
        return b"WARC/1.0\r\nWARC-Type: %s\r\nX:\r\n folded\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind.encode(), len(body), body)

    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "cut").write_bytes(record(b"one") + record(b"\xff\x00")[:-1])
    (tmp_path / "w" / "late").write_bytes(b"junk\r\n\r\n" + record(b"two"))
    (tmp_path / "w" / "empty").write_bytes(b"")
    (tmp_path / "w" / "good").write_bytes(record(b"\xff\x00") + record(b"") + record(b"\r\n\r\nWARC/1.0\r\n"))
    got = warc.read(spark, str(tmp_path / "w"), 50).collect()
    assert sorted(bytes(r.payload) for r in got) == sorted([b"one", b"\xff\x00", b"", b"\r\n\r\nWARC/1.0\r\n"])


def test_candidates_against_a_plain_walk():
    rng = random.Random(4)
    for _ in range(60):
        data = b""
        for _ in range(rng.randint(1, 8)):
            body = b"".join(rng.choice([b"\r\n", b"WARC/1.", b"0\r\n", b"\r\n\r\nWARC/1.1\r\nContent-Length: 2\r\n\r\n", b"q"]) for _ in range(rng.randint(0, 9)))
            data += b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
        file = io.BytesIO(data)

        def read(at, n, file=file):
            file.seek(at)
            return file.read(n)

        true, at = [], 0
        while at < len(data):
            true.append(at)
            at = warc.successor(read, at, len(data))
        size = rng.randint(20, 90)
        leaves = {}
        for start in range(0, len(data), size):
            leaves |= dict(warc.candidates_in(read, start, min(start + size, len(data)), len(data)))
        assert set(true) <= set(leaves)
        at = 0
        while at < len(data):
            assert at in true
            at = leaves[at]
        assert at == len(data)


def test_no_pages_and_digest(spark, tmp_path):
    warc.write(table(spark, []), str(tmp_path / "w"))
    assert warc.read(spark, str(tmp_path / "w")).count() == 0
    got = spark.createDataFrame([("",), ("abc",), ("é" * 1000,)], "t string").select("t", warc.sha1_base32(F.col("t")).alias("d"))
    assert all(r.d == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode() for r in got.collect())
