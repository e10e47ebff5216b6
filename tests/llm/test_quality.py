from __future__ import annotations

import random
import zlib

import numpy as np

from lendworks.llm import quality
from lendworks.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents, none

LABELS = "doc_id long, quality int, toxic int"


def test_pair_sum_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)), np.zeros(1), np.ones(1))
    index, value = np.array([3, 9, 20, 41]), np.array([0.5, -1.0, 2.0, 0.1])
    raw = 0.3 + machine.linear[index] @ value
    for a in range(4):
        for b in range(a + 1, 4):
            raw += machine.factors[index[a]] @ machine.factors[index[b]] * value[a] * value[b]
    assert abs(machine.score(index, value) - 1 / (1 + np.exp(-raw))) < 1e-9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES["op6_quality"](spark, sf).collect()
    assert len(found) == 1_000 and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == q for p, q in judged) / len(judged) > 0.95
    assert all(p for p, q in judged if q)


def sample(spark):
    rng = random.Random(1)
    words = "the of and then there river stone light house green".split()
    good = [" ".join(rng.choice(words) for _ in range(40)) + "." for _ in range(60)]
    bad = [" ".join(rng.choice(words).upper() + "!!" for _ in range(40)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*good, *bad])]
    labels = [(i, int(i < 60), 0) for i in range(120)]
    return documents(spark, rows), spark.createDataFrame(labels, LABELS)


def test_labels_language_source_and_id_are_not_inputs(spark):
    docs, labels = sample(spark)
    machine = quality.fit(docs, labels)
    plain = {r["doc_id"]: r["score"] for r in quality.score(docs, machine).collect()}
    changed = docs.selectExpr("doc_id + 1000 AS doc_id", "text", "'xx' AS lang", "'other' AS source", "n_chars")
    assert {r["doc_id"] - 1000: r["score"] for r in quality.score(changed, machine).collect()} == plain


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = sample(spark)
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality", "toxic"
    )
    a, b = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()


def test_training_sample_is_bounded(spark, monkeypatch):
    docs, labels = sample(spark)
    seen = []
    monkeypatch.setattr(quality, "train", lambda examples, y: seen.append(len(y)) or quality.Machine(0, 0, 0, 0, 1))
    quality.fit(docs.union(docs).union(docs), labels, max_train=25)
    assert seen == [25]


def test_awkward_rows_labels_and_tables(spark):
    docs, labels = sample(spark)
    odd = awkward(spark)
    found = quality.classify(odd, labels)
    assert sorted(found.columns) == sorted(odd.columns) and found.count() == odd.count()
    by_text: dict = {}
    for r in found.collect():
        by_text.setdefault((r["text"] or "", r["n_chars"]), set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())
    no_labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], LABELS)
    assert {r["score"] for r in quality.classify(docs, no_labels).collect()} == {0.5}
    assert quality.classify(none(spark), labels).collect() == []
    assert quality.classify(docs, labels.filter("quality = 1")).filter("score < 0.99").collect() == []


def taken(spark, monkeypatch, docs, labels, max_train):
    """What the training gets: distinct examples, and their labels."""
    seen = []
    machine = quality.Machine(0, 0, 0, 0, 1)
    monkeypatch.setattr(quality, "train", lambda examples, y: seen.append((examples, y.tolist())) or machine)
    quality.fit(docs, labels, max_train=max_train)
    (examples, y), = seen
    return {tuple(part.tobytes() for part in e) for e in examples}, y


def smallest(labels) -> int:
    """The id that the sample takes first."""
    hashed = labels.filter("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 0").selectExpr("xxhash64(doc_id)", "doc_id")
    return min(map(tuple, hashed.collect()))[1]


def test_a_label_repeated_very_often_takes_one_place(spark, monkeypatch):
    docs, labels = sample(spark)
    hot = labels.filter(f"doc_id = {smallest(labels)}").selectExpr("doc_id", "quality", "toxic", "explode(sequence(1, 300))").drop("col")
    plain = taken(spark, monkeypatch, docs, labels, 25)
    found = taken(spark, monkeypatch, docs.union(docs), labels.union(hot), 25)
    assert found == plain and len(found[0]) == 25 and set(found[1]) == {0, 1}


def test_an_id_with_very_many_documents_leaves_a_place_to_each_label(spark, monkeypatch):
    docs, labels = sample(spark)
    hot = spark.range(300).selectExpr(f"{smallest(labels)}L AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'s' AS source")
    many = docs.unionByName(hot.selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars"))
    plain, found = taken(spark, monkeypatch, docs, labels, 25), taken(spark, monkeypatch, many, labels, 25)
    assert found[1] == plain[1] and len(found[0] & plain[0]) >= 24
    # Places beyond the labels' own go to further texts.
    usable = len(taken(spark, monkeypatch, docs, labels, 1_000)[1])
    whole = taken(spark, monkeypatch, many, labels, usable + 40)
    assert len(whole[1]) == len(whole[0]) == usable + 40
    assert len(taken(spark, monkeypatch, many, labels, 1_000)[1]) == usable + 300


def test_labels_without_documents_take_no_place(spark, monkeypatch):
    docs, labels = sample(spark)
    others = spark.range(1_000, 3_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert taken(spark, monkeypatch, docs, labels.union(others), 25) == taken(spark, monkeypatch, docs, labels, 25)
