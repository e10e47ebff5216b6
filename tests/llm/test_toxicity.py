from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lendworks.llm import toxicity
from lendworks.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents, none

LABELS = "doc_id long, quality int, toxic int"


def test_maximal_segments_against_their_definition():
    """Repeatedly the best remaining segment, ties to the shortest, then what lies left and right of it."""

    def best(scores, a, b):
        sums = [(round(sum(scores[i:j]), 9), i - j, -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
        top = max(sums, default=(0,))
        if top[0] <= 0:
            return []
        i, j = top[3:]
        return best(scores, a, i) + [(i, j, top[0])] + best(scores, j, b)

    rng = random.Random(2)
    for _ in range(400):
        scores = [rng.choice((-3.0, -1.0, -0.7, 0.0, 0.9, 2.3, 5.1)) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = [(a, b, round(s, 9)) for a, b, s in toxicity.maximal_segments(np.array(scores))]
        assert got == best(scores, 0, len(scores)), scores


def test_log_odds_follow_their_formula_and_need_evidence():
    toxic, clean = np.array([50.0, 3, 0, 1, 0]), np.array([2.0, 400, 600, 0, 0])
    got = toxicity.log_odds(toxic, clean, prior=100)
    both = toxic + clean
    own = 100 * both / both.sum()
    for i in range(4):
        y, z, a = toxic[i] + own[i], clean[i] + own[i], own.sum()
        ratio = np.log(y / (toxic.sum() + a - y)) - np.log(z / (clean.sum() + a - z))
        doubt = toxicity.DOUBT * np.sqrt(1 / y + 1 / z)
        assert np.isclose(got[i], np.sign(ratio) * max(abs(ratio) - doubt, 0))
    assert got[0] > 1 > 0 == got[3] == got[4]


def test_decay_solves_its_equation():
    scores, clean = np.array([-1.0, -0.5, 3.0, 2.0]), np.array([500.0, 480, 8, 12])
    x = toxicity.decay_of(scores, clean)
    assert x > 0 and abs((clean / clean.sum()) @ np.exp(x * scores) - 1) < 1e-6
    assert toxicity.decay_of(np.array([-1.0]), np.array([5.0])) == 1.0


def test_shares_rise_and_follow_the_prior():
    toxic, clean = np.zeros(toxicity.INTERVALS), np.zeros(toxicity.INTERVALS)
    toxic[60], toxic[40], clean[40], clean[20], clean[50] = 80, 20, 50, 940, 10
    shares = toxicity.rising_shares(toxic, clean, 0.1)
    assert (np.diff(shares) > 0).all() and shares[20] < 0.02 < 0.1 < shares[50] < shares[60] and shares[60] > 0.9


def sample(spark, n=400):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            at = rng.randint(0, 19)
            text[at:at] = [rng.choice(("Vile!", "foul", "NASTY")) for _ in range(3)]
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 4 == 0)))
    return documents(spark, rows), spark.createDataFrame(labels, LABELS)


def test_passages_are_where_the_toxic_words_are(spark):
    docs, labels = sample(spark)
    found = toxicity.classify(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    judged = [r for r in found if r["held_out"]]
    assert judged and all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in judged)
    for r in judged:
        tokens = toxicity.tokens(r["text"])
        said = {t for p in r["passages"] for t in tokens[p["start"] : p["end"]]}
        assert ({b"vile", b"foul", b"nasty"} & set(tokens)) <= said or r["doc_id"] % 4
        assert all(p["rarity"] >= -np.log(toxicity.ALPHA) - 1e-9 for p in r["passages"])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES["op11_toxicity"](spark, sf).collect()
    assert len(found) == 10_000 and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found)
    judged = [(r["score"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = ([s for s, t in judged if t == k] for k in (1, 0))
    above = np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean])
    assert above > 0.93
    assert np.mean([s >= 0.3 for s in toxic]) > 0.9 and np.mean([s < 0.3 for s in clean]) > 0.92


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = sample(spark, 200)
    held = toxicity.held_out(F.col("doc_id"))
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [{r["doc_id"]: r["score"] for r in toxicity.classify(docs, x).collect()} for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_language_source_and_id_are_not_inputs(spark):
    docs, labels = sample(spark, 200)
    model = toxicity.fit(docs, labels)
    plain = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    changed = docs.selectExpr("doc_id + 1000 AS doc_id", "text", "'xx' AS lang", "'other' AS source")
    assert {r["doc_id"] - 1000: r["score"] for r in toxicity.score(changed, model).collect()} == plain


def test_copies_and_repeated_labels_change_nothing(spark):
    docs, labels = sample(spark, 200)
    first = docs.filter("doc_id = 4")
    many = docs
    for _ in range(6):
        many = many.unionByName(first)
    repeated = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1, 1), (5, 1, None), (6, 1, 7)], LABELS))
    a = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.classify(many, repeated).collect()}
    assert a == b


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (5, 1, 0), (7, 1, 1), (2, 1, 0), (6, 0, 1)], LABELS)
    found = toxicity.classify(docs, labels)
    assert found.count() == docs.count() and set(docs.columns) < set(found.columns)
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    scores = {r["text"]: r["score"] for r in found.collect()}
    assert scores[None] == scores[""] == scores[" \n\t "]
    for only, share in ((0, 0.0), (1, 1.0)):
        one = toxicity.classify(docs, labels.filter(F.col("toxic") == only)).collect()
        assert all(r["score"] == share and r["passages"] == [] for r in one)
    assert all(r["score"] == 0 for r in toxicity.classify(docs, labels.limit(0)).collect())


def test_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0)], LABELS)
    assert toxicity.classify(none(spark), labels).count() == 0
    assert toxicity.classify(none(spark), labels.limit(0)).count() == 0
