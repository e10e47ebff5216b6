from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from lendworks.llm import exact
from tests.llm.helpers import awkward, documents, none


def brute(rows):
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept))
    return sorted(out, key=repr)


def run(docs, **options):
    return sorted(map(tuple, exact.exact_groups(docs, **options).drop("digest").collect()), key=repr)


def test_against_brute_force(spark):
    rows = [(i, f"text {i % 37}" if i % 5 else f"own {i}") for i in range(400)] + [(7, "text 7"), (399, "text 29")]
    assert run(documents(spark, rows)) == brute(rows)


def test_texts_of_one_digest_are_told_apart(spark):
    rows = [(i, "ab"[i % 2] * (1 + i % 3)) for i in range(60)] + [(100, None), (101, "")]
    assert run(documents(spark, rows), digest=lambda t: F.length(t).cast("string")) == brute(rows)


def test_one_group_of_very_many_copies(spark):
    rows = [(i, "same") for i in range(5_000)] + [(9_000, "other")]
    assert run(documents(spark, rows)) == brute(rows)


def test_many_copies_without_an_id_or_with_one_id(spark, monkeypatch):
    monkeypatch.setattr(exact, "COPIES", 64)
    for only in (None, 3):
        rows = [(only, "same")] * 500 + [(1, "other"), (1, "other"), (None, "x")]
        assert run(documents(spark, rows).repartition(5)) == brute(rows)


def test_only_digests_beyond_a_tasks_share_are_salted(spark, monkeypatch):
    rows = [(i, "same") for i in range(300)] + [(1_000 + i, f"t{i % 250}") for i in range(700)]
    for width in (1, 3, 50):
        monkeypatch.setattr(exact, "shuffle_width", lambda _: width)
        assert run(documents(spark, rows)) == brute(rows)


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert run(docs) == brute(rows)
    assert run(none(spark)) == []


def test_digest_is_of_the_text(spark):
    found = exact.exact_groups(documents(spark, [(1, "é"), (2, None)])).collect()
    assert {r["digest"] for r in found} == {hashlib.sha256(t.encode()).hexdigest() for t in ("é", "")}
