from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lendworks.llm import revisits

START = datetime(2024, 1, 1)


def record(i, kind, url, second, headers=(), digest=None, payload=None, status=None):
    ts = None if second is None else START + timedelta(seconds=second)
    status = status if status is not None else 200 if kind == "response" else 304
    return (i, kind, url, ts, status, None if headers is None else [tuple(h) for h in headers], digest, payload)


def resolved(spark, rows):
    found = revisits.resolve(spark.createDataFrame(rows, revisits.RECORD)).collect()
    assert len(found) == len(rows)
    return {r["record_id"]: r for r in found}


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.COM:80/A/b/?b=2&utm_source=x&a=1#top": "example.com/A/b?a=1&b=2",
        "https://user:pw@example.com": "example.com/",
        "https://example.com:8443/?SID=4": "example.com:8443/",
        " http://example.com/x?ref=1 ": "example.com/x",
        "not a url": None,
        "": None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string").select("u", revisits.canonical_url(F.col("u")).alias("c"))
    assert dict(map(tuple, df.collect())) == cases


def test_headers_merge_as_permitted(spark):
    rows = [
        record(1, "response", "http://a.b/c", 0, [("ETag", '"1"'), ("Content-Type", "text/html"), ("Date", "old"), ("X-A", "1")], payload="body"),
        record(
            2,
            "revisit",
            "https://A.b/c/",
            5,
            [("etag", 'W/"1"'), ("DATE", "new"), ("content-type", "text/plain"), ("Content-Length", "0"), ("Connection", "x-hop"), ("X-Hop", "h")],
        ),
    ]
    found = resolved(spark, rows)[2]
    assert (found["resolution"], found["refers_to"], found["status"], found["payload"]) == ("resolved", 1, 200, "body")
    assert found["headers"] == ["content-type: text/html", "date: new", 'etag: W/"1"', "x-a: 1"]


def test_the_latest_earlier_response_counts(spark):
    tag = [("ETag", '"1"')]
    rows = [
        record(1, "response", "http://a/", 0, tag, payload="first"),
        record(2, "response", "http://a/", 10, [("ETag", '"2"')], payload="second"),
        record(3, "revisit", "http://a/", 10, tag),  # the response at the same time is not earlier
        record(4, "revisit", "http://a/", 11, tag),  # the latest has another tag
        record(5, "revisit", "http://a/", 0, tag),
        record(6, "response", "http://a/", 12, tag, payload="gone", status=404),
        record(7, "revisit", "http://a/", 13, [("ETag", '"2"')]),
        record(8, "response", "http://a/", 10, [("ETag", '"2"')], payload="tie"),  # the larger id of a tie
    ]
    found = resolved(spark, rows)
    assert [(found[i]["resolution"], found[i]["refers_to"]) for i in (3, 4, 5, 7)] == [
        ("resolved", 1),
        ("validator_mismatch", None),
        ("no_earlier_response", None),
        ("resolved", 8),
    ]


def test_dates_and_digests_validate(spark):
    day = [("Last-Modified", "Mon")]
    rows = [
        record(1, "response", "http://a/", 0, day, "d1", "x"),
        record(2, "revisit", "http://a/", 1, day, "d1"),
        record(3, "revisit", "http://a/", 1, day, "d2"),
        record(4, "revisit", "http://a/", 1, [("Last-Modified", "Tue")], "d1"),
        record(5, "revisit", "http://a/", 1, [], "d1"),
        record(6, "response", "http://b/", 0, None, None, "y"),
        record(7, "revisit", "http://b/", 1, None),
    ]
    found = resolved(spark, rows)
    assert [found[i]["resolution"] for i in (2, 3, 4, 5, 7)] == [
        "resolved", "validator_mismatch", "validator_mismatch", "validator_mismatch", "resolved",
    ]


def test_one_url_of_very_many_captures(spark):
    rng = random.Random(6)
    rows, last, wanted = [], None, {}
    for i, second in enumerate(sorted(rng.sample(range(100_000), 3_000))):
        if rng.random() < 0.1:
            rows.append(record(i, "response", "http://hot/", second, payload=f"p{i}"))
            last = i
        else:
            rows.append(record(i, "revisit", "http://hot/", second))
            wanted[i] = last
    rng.shuffle(rows)
    found = resolved(spark, rows)
    assert {i: found[i]["refers_to"] for i in wanted} == wanted
    assert all(found[i]["payload"] == (None if to is None else f"p{to}") for i, to in wanted.items())


def test_awkward_rows_and_empty_table(spark):
    rows = [
        record(1, "response", "http://a/", 0, payload="x"),
        record(2, "revisit", None, 5),
        record(3, "revisit", "http://a/", None),
        record(4, None, "http://a/", 5),
        record(5, "response", "http://a/", None, payload="z"),
        record(6, "response", "http://a/", 3, payload=None),
        record(None, "response", "http://a/", 4, payload="n"),
        record(8, "revisit", "http://a/", 9),
    ]
    found = resolved(spark, rows)
    assert [found[i]["resolution"] for i in (2, 3, 4, 8)] == ["no_earlier_response", "no_earlier_response", "response", "resolved"]
    assert found[8]["refers_to"] == 1
    twice = revisits.resolve(spark.createDataFrame([*rows, rows[0], rows[7]], revisits.RECORD).withColumn("key", F.lit(1)))
    assert [r["refers_to"] for r in twice.filter("record_id = 8").collect()] == [1, 1] and twice.count() == len(rows) + 2
    assert revisits.resolve(spark.createDataFrame([], revisits.RECORD)).collect() == []
