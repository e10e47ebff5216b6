from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from lendworks.llm import simhash
from lendworks.llm.links import components
from lendworks.llm.queries import QUERIES
from lendworks.staging import Stage
from tests.llm.helpers import awkward, documents, none


def brute_print(text: str | None, k: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(prints: dict, distance: int = 3) -> dict:
    """Id -> smallest id reachable."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 50)
    texts = ["", " \n", "One", "one TWO", "a b c", "É é\x0bÀ b", " ".join(f"w{i % 40}" for i in range(400)), "x" * 9]
    assert [simhash.fingerprint(t, 3) for t in texts] == [brute_print(t) for t in texts]


def test_manhattan_distance_is_a_lower_bound(spark):
    rng = random.Random(2)
    pairs = [(a := rng.getrandbits(64), a ^ sum(1 << rng.randrange(64) for _ in range(3)) & (2**64 - 1)) for _ in range(300)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(a), signed(b)) for a, b in pairs], "a long, b long")
    found = df.select("a", "b", simhash.embedding(df.a).alias("x"), simhash.embedding(df.b).alias("y")).collect()
    for r in found:
        counts = [[(v >> (2 * i) & 3).bit_count() for i in range(32)] for v in (r["a"], r["b"])]
        manhattan = sum(abs(p - q) for p, q in zip(*counts))
        assert ((r["x"] ^ r["y"]) & (2**64 - 1)).bit_count() == manhattan
        assert manhattan <= ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count()


def grown(rng, n: int) -> list[int]:
    """Fingerprints in chains and clusters of a few flipped bits."""
    out = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(out) < n:
        flipped = rng.choice(out)
        for _ in range(rng.randint(1, 5)):
            flipped ^= 1 << rng.randrange(64)
        out.append(flipped)
    return out


@pytest.mark.parametrize("distance,cell_rows", [(0, 4096), (1, 4096), (2, 4096), (3, 4096), (3, 5), (4, 4096), (5, 4096)])
def test_links_keep_every_component(spark, monkeypatch, distance, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    prints = dict(enumerate(dict.fromkeys(grown(random.Random(distance + cell_rows), 300))))
    signed = {i: p - (1 << 64) if p >> 63 else p for i, p in prints.items()}
    stage = Stage(spark)
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed.values()], "fp long"), distance, stage)
    links = stage.table("links", lambda: links)
    for r in links.collect():
        assert 0 < ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= distance
    root = {r["node"]: r["root"] for r in components(links, stage).collect()}
    wanted = brute_groups(prints, distance)
    by_root: dict = {}
    for i, p in signed.items():
        by_root.setdefault(root.get(p, p), set()).add(wanted[i])
    assert all(len(s) == 1 for s in by_root.values()) and len(by_root) == len(set(wanted.values()))


def test_a_crowded_group_gives_a_forest_not_all_pairs():
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = np.array(list({base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(900)}), np.uint64)
    keys, homes = np.zeros(len(prints), np.int64), np.ones(len(prints), np.int64)
    found = simhash._links(keys, homes, prints, 4)
    assert sum(len(a) for a, _ in found) == len(prints) - 1


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000 + 3 * i, 1000 + 3 * (i + 1)) for i in range(50)] + [(5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long"), Stage(spark)).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(201)} | {1000 + 3 * i: 1000 for i in range(51)}


def copies(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(800)]
    rows = []
    for g in range(12):
        text = [rng.choice(words) for _ in range(300)]
        for c in range(6):
            near = list(text)
            if c > 1:
                near[rng.randrange(300)] = "changed"
            rows.append((g * 10 + c, " ".join(near)))
    return rows


def test_groups_and_kept_documents(spark):
    rows = copies(spark)
    wanted = brute_groups({i: brute_print(t) for i, t in rows})
    docs = documents(spark, rows)
    found = simhash.near_groups(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {i: f"{brute_print(t):016x}" for i, t in rows}
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(wanted.values()))
    assert len(set(wanted.values())) < 40


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    found = simhash.near_groups(docs).collect()
    assert len(found) == docs.count()
    names = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in found}
    assert names[2, "0" * 16] == names[3, "0" * 16] == names[4, "0" * 16] == names[None, "0" * 16] == 2
    kept = simhash.near_dedup(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 2, 5, 6, 7]
    assert simhash.near_groups(none(spark)).collect() == [] and simhash.near_dedup(none(spark)).collect() == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    prints = {r["doc_id"]: brute_print(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op9_simhash"](spark, sf).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute_groups(prints)
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == prints
