from __future__ import annotations

import random

from lendworks.llm import line_dedup
from lendworks.llm.queries import QUERIES
from tests.llm.helpers import awkward, documents, none


def brute(rows: list[tuple], min_words: int) -> list[tuple]:
    """(text, lines removed) per row: a line goes if it lies in a run of enough words that also begins earlier.

    Every pair of equal lines that no equal lines precede begins a longest common run; of its two places the later
    one goes. Rows in id order, nulls first; equal rows count as one.
    """
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    lines = {k: [(n, s) for n, line in enumerate(k[2].split("\n")) if (s := line.strip())] for k in order}
    gone: dict = {k: set() for k in order}
    seen: dict[str, list] = {}
    for k in order:
        own = lines[k]
        for i, (_, line) in enumerate(own):
            for key, j in seen.get(line, ()):
                other = lines[key]
                if i and j and own[i - 1][1] == other[j - 1][1]:
                    continue
                n = words = 0
                while i + n < len(own) and j + n < len(other) and own[i + n][1] == other[j + n][1]:
                    words += len(own[i + n][1].split())
                    n += 1
                if words >= min_words:
                    gone[k] |= set(range(own[i][0], own[i + n - 1][0] + 1))
            seen.setdefault(line, []).append((k, i))
    kept = {k: "\n".join(t for n, t in enumerate(k[2].split("\n")) if n not in gone[k]) for k in order}
    return [(i, kept[key], len(gone[key])) for i, t in rows for key in [(i is not None, i or 0, t or "")]]


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randint(1, 6))) for _ in range(12)]
    rows = []
    for i in range(150):
        text = "\n".join(rng.choice([*pool, "", f"own {i} {rng.random()}"]) for _ in range(rng.randint(0, 14)))
        rows.append((i, text))
    rows += rows[:5]  # repeated rows
    found = line_dedup.line_dedup(documents(spark, rows), min_words=8).select("doc_id", "text", "lines_removed").collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, 8))
    assert sum(r["lines_removed"] for r in found) > 50


def test_long_passages_go_and_short_lines_stay(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"alpha\n{passage}\nend one"), (2, f"beta\n{passage}\nend two"), (3, "Licensed under X.\nc"), (4, "Licensed under X.\nd")]
    found = dict(line_dedup.line_dedup(documents(spark, rows)).select("doc_id", "text").collect())
    assert found == {1: rows[0][1], 2: "beta\nend two", 3: rows[2][1], 4: rows[3][1]}


def test_one_line_in_very_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own {i}\n{passage}") for i in range(2_000)]
    found = line_dedup.line_dedup(documents(spark, rows)).select("doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in found if passage in r["text"]) == [0]


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = line_dedup.line_dedup(docs)
    assert sorted(found.columns) == sorted(docs.columns)
    texts = sorted((r["text"] or "") for r in docs.collect())
    assert sorted((r["text"] or "") for r in found.collect()) == texts
    assert {r["lines_removed"] for r in found.collect()} == {0}


def test_empty_table(spark):
    assert line_dedup.line_dedup(none(spark)).collect() == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = QUERIES["op2_line_dedup"](spark, sf).select("doc_id", "text", "lines_removed").collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, line_dedup.MIN_WORDS))


def removed(spark, rows: list[tuple], **options) -> list[tuple]:
    found = line_dedup.line_dedup(documents(spark, rows), **options).select("doc_id", "text", "lines_removed").collect()
    return sorted(map(tuple, found), key=repr)


def test_a_run_is_followed_beyond_a_passage_that_a_third_document_holds_first(spark):
    head, shared, tail = (" ".join(f"{w}{i}" for i in range(n)) for w, n in (("x", 60), ("r", 95), ("y", 10)))
    rows = [(1, f"a\n{shared}"), (2, f"{head}\n{shared}\n{tail}"), (3, f"{head}\n{shared}\n{tail}")]
    assert removed(spark, rows) == [(1, rows[0][1], 0), (2, f"{head}\n{tail}", 1), (3, "", 3)]
    # The last lines of a run go as well where its first ones were first met in a document that lacks them.
    rows = [(1, f"a\n{shared}"), (2, f"{shared}\n{tail}"), (3, f"{shared}\n{tail}")]
    assert removed(spark, rows) == [(1, rows[0][1], 0), (2, tail, 1), (3, "", 2)]


def test_windows_reach_every_line_of_every_run():
    rng = random.Random(8)
    for _ in range(300):
        words = [rng.randint(1, 9) for _ in range(rng.randint(0, 20))]
        found = list(line_dedup.windows_of(words, 12))
        every = [(s, e) for s in range(len(words)) for e in range(s + 1, len(words) + 1) if sum(words[s:e]) >= 12]
        shortest = [(s, e) for s, e in every if sum(words[s : e - 1]) < 12 or sum(words[s + 1 : e]) < 12]
        assert sorted(found) == sorted(set(found)) and set(found) <= set(shortest)
        for s, e in every:
            assert {i for a, b in found if s <= a and b <= e for i in range(a, b)} == set(range(s, e))


def test_hot_lines_and_windows_are_met_through_a_broadcast(spark, monkeypatch):
    rng = random.Random(6)
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(6)) for i in range(4))
    rows = [(i, f"own {i}\n{passage}\n" + " ".join(rng.choice("abc") for _ in range(4))) for i in range(300)]
    monkeypatch.setattr(line_dedup, "shuffle_width", lambda _: 40)
    assert removed(spark, rows, min_words=12) == sorted(brute(rows, 12), key=repr)


def test_runs_through_passages_of_other_documents_against_brute_force(spark):
    rng = random.Random(5)
    line = lambda: " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 5)))
    rows = []
    for g in range(30):
        parts = [[line() for _ in range(rng.randint(4, 25))] for _ in range(4)]
        middle = "\n".join(parts[1] + ["", *parts[2]])
        whole = "\n".join(parts[0]) + "\n" + middle + "\n" + line()
        rows.append((10 * g, f"own {g}\n{middle}"))
        rows += [(10 * g + i, f"{whole}\n{line()}" if i % 2 else whole) for i in range(1, 5)]
        rows.append((10 * g + 5, "\n".join(parts[0] + parts[0])))
    rows += [(None, rows[1][1]), (None, rows[1][1]), rows[2], rows[2]]
    assert removed(spark, rows, min_words=12) == sorted(brute(rows, 12), key=repr)
