"""WARC archives: round trip, header-first reading, push-down, odd rows, broken files."""

import base64
import gzip
import hashlib
import io
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, LessThan, Not, StringStartsWith

from captally.llm import warc

PAGES = "page_id long, url string, html string"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/1", "<p>same</p>"), (5, "http://a/5", "<p>same</p>"), (3, None, "<p>same</p>"),
    (2, "http://a/2", "é" * 200_000), (4, "x\r\nWARC-Type: metadata\r\n\r\n", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (6, "http://a/6", None), (7, "http://a/7", ""), (8, "http://a/8", "one"), (8, "http://a/8b", "one"),  # repeated id
    (9, "u", "two"), (9, "u", "two"), (None, "u", "<p>same</p>"), (None, "u", "only"), (-4, "u", "<p>same</p>"),
]


def plain(rows, least=0):
    best = {}
    for i, _, html in rows:
        if i is not None:
            best[html or ""] = max(best.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        text = html or ""
        first = best.get(text) if len(text.encode()) >= least else None
        again = first is not None and (i is None or i < first)
        out.append((i, len(text.encode()), sha1(text), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 4, 12])
def test_pages_round_trip(spark, tmp, least):
    pages = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "'x' as payload", "1 as warc_type", "2 as first_id").repartition(4)
    got = warc.page_report(pages, least, f"{tmp}/a").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(ROWS, least)
    payloads = warc.read_warc(spark, f"{tmp}/a", ["record_id", "payload", "target_uri", "warc_type"]).where("warc_type = 'response'").collect()
    assert {bytes(r.payload).decode() for r in payloads} == {t or "" for _, _, t in ROWS}
    assert all("\r" not in (r.target_uri or "") for r in payloads)


def test_no_pages(spark):
    assert warc.page_report(spark.createDataFrame([], PAGES)).count() == 0


def test_files_roll_and_uncommitted_files_are_not_read(spark, tmp):
    pages = spark.createDataFrame([(i, "u", random.Random(i).randbytes(3000).hex()) for i in range(40)], PAGES).coalesce(1)
    warc.write_warc(warc.page_records(pages), f"{tmp}/a", max_file_bytes=20_000)
    files = [n for n in os.listdir(f"{tmp}/a") if n.endswith(".warc.gz")]
    assert len(files) > 3
    with open(f"{tmp}/a/part-left-by-a-lost-task.warc.gz", "wb") as f:
        f.write(b"half a record")
    assert warc.read_warc(spark, f"{tmp}/a", ["file"]).select("file").distinct().count() == len(files)
    warc.write_warc(warc.page_records(pages.limit(3)), f"{tmp}/a")
    assert warc.read_warc(spark, f"{tmp}/a", ["record_id"]).count() == 43
    warc.write_warc(warc.page_records(pages.limit(3)), f"{tmp}/a", mode="overwrite")
    assert warc.read_warc(spark, f"{tmp}/a", ["record_id"]).count() == 3


def record(kind, content, **more):
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x:{more.get('id', kind)}>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("Content-Type", more.get("type", "text/plain"))]
    return warc.record_bytes(fields, content)


HTTP = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\n"


@pytest.mark.parametrize("form", ["plain", "gzip", "one member", "split members"])
def test_foreign_archives(spark, tmp, form):
    raw = [record("warcinfo", b"software: x\r\n\r\n"), record("response", HTTP + b"hello", type="application/http; msgtype=response"),
           record("revisit", HTTP, type="application/http; msgtype=response"), record("resource", b"\x00\xff" * 50), record("metadata", b"")]
    whole = b"".join(raw)
    data = {"plain": whole, "gzip": b"".join(map(gzip.compress, raw)), "one member": gzip.compress(whole),
            "split members": gzip.compress(whole[:333]) + gzip.compress(b"") + gzip.compress(whole[333:])}[form]
    with open(f"{tmp}/x.warc", "wb") as f:
        f.write(data)
    got = {r.warc_type: r for r in warc.read_warc(spark, f"{tmp}/x.warc").collect()}
    assert list(got) == ["warcinfo", "response", "revisit", "resource", "metadata"]
    assert (bytes(got["response"].payload), got["response"].payload_sha1) == (b"hello", sha1("hello"))
    assert (got["revisit"].payload, got["revisit"].payload_bytes, got["revisit"].content_length) == (None, 5, len(HTTP))
    assert bytes(got["resource"].payload) == b"\x00\xff" * 50
    assert got["metadata"].payload_bytes == 0 and got["warcinfo"].headers["warc-date"] == "2020-01-01T00:00:00Z"
    if form == "plain":
        assert [r.offset for r in got.values()] == [sum(map(len, raw[:k])) for k in range(5)]
    if form == "gzip":
        assert [r.offset for r in got.values()] == [sum(len(gzip.compress(x)) for x in raw[:k]) for k in range(5)]


class Counting(io.BytesIO):
    """An archive that counts what is read of it."""

    taken = 0

    def read(self, n=-1):
        got = super().read(n)
        self.taken += len(got)
        return got

    def size(self):
        return len(self.getbuffer())


@pytest.mark.parametrize("zipped", [True, False])
def test_content_that_is_not_wanted_is_not_read(zipped):
    noise = random.Random(1).randbytes(4 << 20)
    raw = [record("response", noise, id=1), record("metadata", b"m"), record("response", noise, id=2), record("revisit", b"r")]
    data = b"".join(warc.gzip_member(x, 1) if zipped else x for x in raw)
    walk = lambda f, filters, wanted: list(warc.records((warc.GzipBytes if zipped else warc.PlainBytes)(f), filters, wanted))
    f = Counting(data)
    rows = walk(f, [Not(EqualTo(("warc_type",), "response"))], {"payload"})
    assert [(r["warc_type"], r["payload"]) for r in rows] == [("metadata", b"m"), ("revisit", None)]
    assert f.taken < len(data) / 4
    f = Counting(data)
    assert [r["record_id"] for r in walk(f, [], {"record_id"})] == ["<urn:x:1>", "<urn:x:metadata>", "<urn:x:2>", "<urn:x:revisit>"]
    assert f.taken < len(data) / 4
    f = Counting(data)
    assert sum(len(r["payload"] or b"") for r in walk(f, [], {"payload"})) >= 8 << 20
    assert f.taken >= len(data) - 10


def test_filters_are_taken_from_spark(spark, tmp):
    warc.write_warc(warc.page_records(spark.createDataFrame(ROWS, PAGES)), f"{tmp}/a")
    rows = warc.read_warc(spark, f"{tmp}/a", ["record_id", "warc_type", "content_length", "target_uri"])
    taken = rows.where("warc_type in ('revisit', 'x') and content_length > 10 and target_uri is null and record_id not like 'a%'")
    filters = lambda df: " Filter " in df._jdf.queryExecution().executedPlan().toString()
    assert not filters(taken) and taken.count() == 1
    left = rows.where("length(target_uri) = 10 and target_uri > 'http://a/5'")  # a function and an order of text stay with Spark
    assert filters(left)
    assert {r.target_uri for r in left.collect()} == {"http://a/6", "http://a/7", "http://a/8"}


def test_filter_values():
    v = {"warc_type": "response", "refers_to": None, "content_length": 7}
    assert warc.decide(EqualTo(("warc_type",), "response"), v) is True
    assert warc.decide(Not(EqualTo(("refers_to",), "x")), v) is None
    assert warc.decide(IsNull(("refers_to",)), v) is True
    assert warc.decide(In(("warc_type",), ("a", None)), v) is None
    assert warc.decide(GreaterThan(("content_length",), 7), v) is False
    assert warc.decide(LessThan(("content_length",), 8), v) is True
    assert warc.decide(StringStartsWith(("warc_type",), "resp"), v) is True
    assert not warc.pushable(GreaterThan(("warc_type",), "a")) and not warc.pushable(EqualTo(("headers", "x"), "a"))


@pytest.mark.parametrize("harm", ["cut", "head", "checksum"])
def test_broken_archives(spark, tmp, harm):
    good = [warc.gzip_member(record("resource", f"c{i}".encode() * 300, id=i), 6) for i in range(3)]
    bad = {"cut": good[2][:-30], "head": gzip.compress(b"no WARC\r\n\r\n"), "checksum": good[2][:-5] + b"\x00" + good[2][-4:]}[harm]
    with open(f"{tmp}/x.warc.gz", "wb") as f:
        f.write(good[0] + good[1] + bad)
    with pytest.raises(PySparkException, match="x.warc.gz"):
        warc.read_warc(spark, f"{tmp}/x.warc.gz").collect()
    assert [r.record_id for r in warc.read_warc(spark, f"{tmp}/x.warc.gz", mode="skip").collect()] == ["<urn:x:0>", "<urn:x:1>"]


def test_missing_folder(spark, tmp):
    with pytest.raises(PySparkException, match="no WARC files"):
        warc.read_warc(spark, f"{tmp}/none").count()


def test_an_empty_page_table_writes_an_empty_list(spark, tmp):
    warc.write_warc(warc.page_records(spark.createDataFrame([], PAGES)), f"{tmp}/a")
    assert warc.read_warc(spark, f"{tmp}/a").agg(F.count("*")).first()[0] == 0
