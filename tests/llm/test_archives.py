"""WARC archives: round trips, magic lines inside payloads, and archives in many splits."""

import base64
import hashlib
import os

import pytest

from tidepool.llm import warc
from tidepool.storage import scratch_path

SCHEMA = "page_id long, url string, html string, record_type string, end int"


def table(spark, rows):
    return spark.createDataFrame([(i, f"http://h/{i}", t, "x", 1) for i, t in rows], SCHEMA)


def expected(rows, least=0):
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        if i is not None and len(raw) >= least:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        again = raw in first and i != first[raw]
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if again else "response", first[raw] if again else None))
    return sorted(out, key=repr)


def round_trip(spark, rows, least=0, tasks=None):
    path = scratch_path(spark, "warc")
    pages = table(spark, rows)
    warc.write_warc(pages.repartition(tasks) if tasks else pages, path, least)
    got = warc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in got.collect()), key=repr)


WHOLE = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\n"
         "Content-Length: 30\r\n\r\nHTTP/1.1 200 OK\r\n\r\n0123456789a\r\n\r\n")
TRICKY = [
    "WARC/1.0\r\n", "xx WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n yy",
    WHOLE, "before " + WHOLE * 3 + "after", "\r\n\r\n", "WARC/1.0\r\nContent-Length: 99999999\r\n\r\n",
    "WARC/1.0\r\nContent-Length: x\r\n\r\n", "a\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    "WWARC/1.0\r\n", "WARC/1.0\r", "WARC/1.0\r\nContent-Length: 5\r\n\r\n" * 20]


def test_round_trip(spark, sf):
    rows = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:20])]
    assert round_trip(spark, rows) == expected(rows)


def test_magic_inside_payloads(spark):
    rows = list(enumerate([*TRICKY, "plain", *TRICKY[:3]]))
    assert round_trip(spark, rows, tasks=1) == expected(rows)
    assert round_trip(spark, rows, tasks=3) == expected(rows)


@pytest.mark.parametrize("size, n", [(211, 5), (1511, 24)])
def test_archives_in_many_splits(spark, size, n):
    rows = [(i, (TRICKY[i % len(TRICKY)] + "é" * (i * 37 % 400)) if i % 3 else "t" * (i * 53 % 900))
            for i in range(n)]
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        path = scratch_path(spark, "warc")
        warc.write_warc(table(spark, rows).coalesce(1), path)
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = warc.read_warc(spark, path).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_odd_rows(spark):
    rows = [(None, "same"), (5, "same"), (5, "same"), (7, "same"), (8, None), (9, ""), (None, "alone"),
            (-4, "negative"), (10, "big " * 300_000)]
    assert round_trip(spark, rows) == expected(rows)
    assert round_trip(spark, rows, least=5) == expected(rows, 5)
    assert round_trip(spark, []) == []
    pages = spark.createDataFrame(
        [(1, None, "a"), (2, "http://h/\r\nWARC/1.0\r\n", "b")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path)
    got = {r["page_id"]: r["target_uri"] for r in warc.read_warc(spark, path).collect()}
    assert got == {1: None, 2: "http://h/%0D%0AWARC/1.0%0D%0A"}


def test_a_broken_archive_ends_at_the_break(spark, tmp_path):
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, [(i, f"page {i}") for i in range(5)]).coalesce(1), path)
    name = next(f for f in os.listdir(path) if f.startswith("part-"))
    raw = open(f"{path}/{name}", "rb").read()
    third = raw.index(b"<urn:page:2>")
    broken = raw[:third] + raw[third:].replace(b"Content-Length", b"Content-Lengty", 1)
    for name, data in (("cut.warc", raw[:-30]), ("broken.warc", broken), ("late.warc", b"x" + raw)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / name).write_bytes(data)
    read = lambda name: sorted(
        r["page_id"] for r in warc.read_warc(spark, str(tmp_path / name)).collect())
    assert read("cut.warc") == [0, 1, 2, 3]
    assert read("broken.warc") == [0, 1]
    assert read("late.warc") == []


def test_both_versions_of_the_format(spark, tmp_path):
    def record(version, kind, page, payload):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
        return (f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{page}>\r\n"
                f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    (tmp_path / "a.warc").write_bytes(record("1.0", "response", 1, b"one WARC/1.1\r\n inside WARC/1.0\r\n x")
                                      + record("1.0", "response", 2, b"two"))
    (tmp_path / "b.warc").write_bytes(record("1.1", "warcinfo", 3, b"") + record("1.1", "response", 4, b"WARC/1.0"))
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["record_type"], r["payload_bytes"]) for r in got) == [
        (1, "response", 34), (2, "response", 3), (3, "warcinfo", 0), (4, "response", 8)]
