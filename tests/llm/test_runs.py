from __future__ import annotations

import hashlib
import random
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from lendworks.llm import runs
from lendworks.llm.queries import QUERIES, run_digests, with_planted_runs
from tests.llm.helpers import awkward, none

SF = "/root/testdata/sf0.001"


def brute_force(words: list, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """Every period, every maximal stretch that keeps it, unless a smaller period holds there."""
    n, found = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            if length >= max(min_length, min_exponent * q) and not any(
                all(stretch[x] == stretch[x + p] for x in range(length - p)) for p in range(1, q)
            ):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def fibonacci(n: int) -> str:
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def strings():
    rng = random.Random(5)
    yield from ("", "a", "aaaaaaa", "ab" * 9, "abaab" * 5 + "ab", fibonacci(200), "aabaabaaab" * 6, "abc" * 4 + "abd" * 4)
    for _ in range(300):
        made = ""
        for _ in range(rng.randint(1, 5)):
            root = "".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 6)))
            made += (root * rng.randint(1, 7))[rng.randint(0, len(root) - 1) :]
        yield made


@pytest.mark.parametrize("min_length, min_exponent", [(6, 4), (2, 2), (9, 3), (1, 4)])
def test_runs_against_brute_force(min_length, min_exponent):
    for s in strings():
        assert runs.runs_of(list(s), min_length, min_exponent) == brute_force(list(s), min_length, min_exponent), s


def test_lyndon_arrays_of_both_orders():
    """The longest Lyndon word at a place ends before the next smaller suffix."""
    for s in strings():
        ids = [ord(c) for c in s]
        for order in (ids, [-v for v in ids]):
            smaller = [next((j for j in range(i + 1, len(s)) if order[j:] < order[i:]), len(s)) for i in range(len(s))]
            assert runs.lyndon_array(order) == [j - i for i, j in enumerate(smaller)], s


def test_regions_lose_no_run():
    assert runs.repeating(6, 4) == 5 and runs.repeating(2, 2) == 1
    rng = random.Random(3)
    for _ in range(200):
        ids = np.array([rng.randint(0, 2) for _ in range(120)])
        whole = runs.rooted_runs(ids, 6, 4)
        assert sorted(whole, key=lambda r: (r[0], r[2])) == runs.runs_of(ids.tolist(), 6, 4)


def planted(doc_id, text) -> list[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text) -> tuple:
    words = planted(doc_id, text)
    # Stretches by period with a window of differences; the plain check above covers smaller texts.
    found = brute_force(words, 6, 4) if len(words) < 400 else stretches(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, digest(lines), digest(kept))


def stretches(words: list) -> list[tuple[int, int, int]]:
    place: dict = {}
    ids = np.array([place.setdefault(w, len(place)) for w in words])
    found: list[tuple[int, int, int]] = []
    for q in range(1, len(ids) // 4 + 1):
        equal = np.concatenate([[0], (ids[:-q] == ids[q:]).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(equal))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = b - a + q
            if length >= max(6, 4 * q) and not any(s <= a and a + length <= s + n and q % p == 0 for s, n, p in found):
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_word_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        assert got[r["doc_id"]] == expected(*r)
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = runs.periodic_runs(docs)
    assert set(docs.columns) | {"n_words", "runs", "collapsed"} == set(found.columns)
    assert found.count() == docs.count()
    by_text = {r["text"]: r for r in found.collect()}
    for text in (None, "", " \n\t "):
        assert (by_text[text]["n_words"], by_text[text]["runs"], by_text[text]["collapsed"]) == (0, [], "")
    assert runs.periodic_runs(found).columns.count("runs") == 1
    got = [tuple(r) for r in run_digests(runs.periodic_runs(with_planted_runs(docs))).collect()]
    assert sorted(got, key=repr) == sorted((expected(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)


def test_a_very_long_periodic_text(spark):
    rows = [(1, "tick tock " * 150_000), (2, " ".join(f"w{i}" for i in range(100_000)))]
    found = runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [tuple(r) for r in found[0]["runs"]] == [(0, 300_000, 2)] and found[0]["collapsed"] == "tick tock"
    assert found[1]["runs"] == [] and found[1]["collapsed"] == rows[1][1]


def test_empty_table(spark):
    found = runs.periodic_runs(none(spark))
    assert found.count() == 0 and dict(found.dtypes)["runs"] == runs.RUNS
    assert run_digests(runs.periodic_runs(with_planted_runs(none(spark)))).count() == 0


def test_a_run_shorter_than_two_periods_is_refused():
    with pytest.raises(ValueError):
        runs.runs_of(list("aaaa"), 1, 1)
