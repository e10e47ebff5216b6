from __future__ import annotations

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendworks.llm import trie
from lendworks.llm.queries import QUERIES, op13_conversation_trie

KINDS = "conv_id long, turn long, role string, text string"


def nodes_of(conversations: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """Every node by comparing prefixes, as the columns of the result."""
    members: dict[tuple, list[int]] = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = []
    for node, own in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in own if len(conversations[c]) == len(node))
        found.append(
            (
                min(own),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(own),
                sum(len(n) == len(node) + 1 for n in below),
                sum(not any(len(m) == len(n) + 1 and m[:-1] == n for m in below) for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*trie.RESULT).collect()), key=repr)


def as_rows(conversations) -> list[tuple]:
    return [(c, i, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]


def test_find_close_against_a_stack():
    rng = random.Random(4)
    shapes = [[1, 0], [1] * 700 + [0] * 700, [1] + [1, 0] * 500 + [0]]
    for _ in range(40):
        depth, made = 1, [1]
        for _ in range(rng.randint(0, 900)):
            up = depth == 1 or rng.random() < rng.choice((0.4, 0.5, 0.6))
            made.append(int(up))
            depth += 1 if up else -1
        shapes.append(made + [0] * depth)
    for shape in shapes:
        stack, close = [], {}
        for i, o in enumerate(shape):
            if o:
                stack.append(i)
            else:
                close[stack.pop()] = i
        at = np.flatnonzero(shape)
        assert trie.Parentheses(np.array(shape)).find_close(at).tolist() == [close[i] for i in at.tolist()]


def mixed(seed: int) -> dict[int, list[tuple[str, str]]]:
    """Shared openings, a third of all conversations equal, prefixes of each other, one long, some empty texts."""
    rng = random.Random(seed)
    openings = [("user", "hello"), ("user", ""), ("", "héllo \U0001f600"), ("system", "hello")]
    made = {}
    for c in rng.sample(range(1000), 150):
        turns = [rng.choice(openings[:2] if rng.random() < 0.7 else openings) for _ in range(rng.randint(0, 4))]
        made[c] = [("user", "hot"), ("assistant", "copy")] if rng.random() < 0.35 else turns
    made[2000] = [("user", f"t{i}") for i in range(300)]
    made[2001] = made[2000][:250]
    return made


@pytest.mark.parametrize("width", [1, 2, 7, 40])
def test_trie_against_brute_force_whatever_the_shards(spark, monkeypatch, width):
    made = mixed(width)
    monkeypatch.setattr(trie, "shuffle_width", lambda _: width)
    lists = trie.turn_lists(spark.createDataFrame(as_rows(made), KINDS))
    empty = [c for c, turns in made.items() if not turns]
    bare = spark.createDataFrame([(c,) for c in empty] or [(None,)], "conv_id long").filter("conv_id IS NOT NULL")
    lists = lists.unionByName(bare.withColumn("turns", F.expr("array()").cast(lists.schema["turns"].dataType)))
    assert got(trie.trie(trie.turn_paths(lists))) == nodes_of(made)


def rebuilt(made):
    whole = {}
    for c, turns in made.items():
        h = crc32(str(c).encode()) % 6
        whole[c] = made.get(c - c % 100, [])[:h] + turns[h:]
    return whole


def test_query_against_brute_force(spark, tmp_path):
    made = {c: turns for c, turns in mixed(9).items() if turns}
    made |= {100 * i: [("user", f"base {i % 3}"), ("assistant", "yes"), ("user", "go on")] for i in range(8)}
    rows = as_rows(made)
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, KINDS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_conversation_trie(spark, str(tmp_path))) == nodes_of(rebuilt(made))


def test_awkward_rows(spark, tmp_path):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "second"), (1, 1, "user", None), (None, 0, "user", "nobody's"),
        (2, None, "user", "first"), (2, 0, "", "second"), (2, 1, "user", ""),
        (3, 5, "a", "x" * 100_000), (3, 5, "a", "x" * 100_000), (3, None, None, None),
        (4, 1, "b", "tie"), (4, 1, "a", "tie"), (5, 1, "a", "tie"), (5, 1, "b", "tie"),
    ]
    frame = spark.createDataFrame(rows, KINDS)
    for name in ("path", "chars", "shard", "key", "depth", "turns", "digest"):
        frame = frame.withColumn(name, F.lit("x"))
    tie = sorted([("a", "tie"), ("b", "tie")], key=lambda t: hashlib.sha256(f"1:{t[0]}{t[1]}".encode()).hexdigest())
    one = [("user", "first"), ("", "second"), ("user", "")]
    made = {1: one, 2: one, 3: [("", ""), *[("a", "x" * 100_000)] * 2], 4: tie, 5: tie}
    assert got(trie.conversation_trie(frame)) == nodes_of(made)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_conversation_trie(spark, str(tmp_path))) == nodes_of(rebuilt(made))


def test_empty_table(spark):
    none = spark.createDataFrame([], KINDS)
    found = trie.conversation_trie(none)
    assert found.count() == 0 and tuple(found.columns) == trie.RESULT
    assert trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x")], KINDS)).count() == 0


def test_the_query_is_registered():
    assert QUERIES["op13_conversation_trie"] is op13_conversation_trie
