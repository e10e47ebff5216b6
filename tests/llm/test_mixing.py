from __future__ import annotations

import hashlib
import math

from pyspark.sql import functions as F

from lendworks.llm import mixing
from tests.llm.helpers import awkward, documents, none, rows_of


def brute_count(doc_id, rate: float, seed: int = 42) -> int:
    parts = max(math.ceil(rate / mixing.PART_RATE), 1)
    total = 0
    for part in range(1, parts + 1):
        u = (int(hashlib.md5(f"{seed}:{doc_id}:{part}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        mean, k, p, reached = rate / parts, 0, math.exp(-rate / parts), math.exp(-rate / parts)
        while reached < u and k <= mixing.TERMS:
            k += 1
            p *= mean / k
            reached += p
        total += k
    return total


def two_sources(spark):
    return documents(spark, [(i, f"t{i}") for i in range(300)], "a").union(
        documents(spark, [(i, f"t{i}") for i in range(1000, 1030)], "b")
    )


def test_counts_invert_the_distribution(spark):
    found = mixing.mix(two_sources(spark), {"a": 1.0, "b": 2.0}, epochs=2.0)
    counts = {r["doc_id"]: r["n"] for r in found.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    rates = {"a": 660 / 3 / 300, "b": 660 * 2 / 3 / 30}
    for i in [*range(300), *range(1000, 1030)]:
        assert counts.get(i, 0) == brute_count(i, rates["a" if i < 300 else "b"])


def test_sources_reach_their_weights(spark):
    docs = documents(spark, [(i, "t") for i in range(6_000)], "a").union(documents(spark, [(i, "t") for i in range(6_000, 6_600)], "b"))
    found = dict(mixing.mix(docs, {"a": 1.0, "b": 1.0}).groupBy("source").count().collect())
    assert abs(found["a"] - 3_300) < 250 and abs(found["b"] - 3_300) < 250


def test_copies_are_numbered_and_shuffled(spark):
    found = mixing.mix(two_sources(spark), epochs=3.0).collect()
    by_doc: dict[int, list[int]] = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r["copy"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in by_doc.values())
    order = [r["doc_id"] for r in found]
    assert order != sorted(order)


def test_many_sources_without_a_broadcast(spark, monkeypatch):
    docs = two_sources(spark)
    plain = rows_of(mixing.mix(docs, epochs=2.0))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert rows_of(mixing.mix(docs, epochs=2.0)) == plain


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("source", F.when(F.col("doc_id") > 3, F.col("source")))
    found = mixing.mix(docs, epochs=5.0)
    assert sorted(found.columns) == sorted(docs.columns) and dict(found.dtypes)["copy"] == "int"
    assert mixing.mix(docs, copy=None).columns == docs.columns
    assert {r["doc_id"] for r in found.collect()} <= {1, 2, 3, 4, 5, 6, 7, None}
    counts = found.filter("doc_id = 1").groupBy("copy").count().collect()
    assert {r["count"] for r in counts} <= {2}  # rows of one id get one count each


def test_unnamed_sources_and_empty_table(spark):
    assert {r["source"] for r in mixing.mix(two_sources(spark), {"b": 1.0}).collect()} == {"b"}
    assert mixing.mix(none(spark)).collect() == []


def test_plan_is_native(spark):
    plan = mixing.mix(two_sources(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
