"""Prefix trie of conversations, in balanced parentheses per shard, the shards' shared spines merged.

A conversation is the sequence of its turns; a turn is known by 128 bits of the SHA-256 of its role and text, so a
conversation is a path of 16 bytes a turn and the trie's nodes are the paths' prefixes. Paths are sorted over all
shards by path and id. A shard writes its part of the trie as balanced parentheses: in blocks of BLOCK whose least and
greatest excess, gathered in pairs up to the whole, let findclose skip what cannot hold the end of a subtree. Between
a node's parentheses, the rank of the pairs "()" counts leaves, and running sums over the nodes in order of their
opening give members and savings.

A shard knows the last path before it and the first one after it. Nodes on these two spines reach over shards: each
shard counts for them what is new in it, a child or leaf being new where it is met first or last, so that their sums
over shards are their values. All other nodes are settled inside their shard. However many conversations start alike
or are equal, they are cut into shards by id, and a merged node costs a row a shard.

Defined results: rows without a conversation id belong to none. Null roles and texts count as empty. Turns come by
number, null first; turns of one number by the digest of role and text; repeated rows are turns of their own. A
conversation may have no turns, it then ends at the root. An empty table has no nodes. Other columns are not read.
One conversation's turns (28 bytes each) must fit a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendworks.llm.batches import bounded_batches
from lendworks.sizing import shuffle_width
from lendworks.staging import Stage

TURN_BYTES = 16
#: Parentheses a block.
BLOCK = 64

_FAR = np.int64(1) << 40

NODES = pa.schema(
    [
        ("shard", pa.int32()),
        ("shared", pa.bool_()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("ends", pa.string()),
    ]
)
NODE_KINDS = (
    "shard int, shared boolean, key binary, parent_key binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint,"
    " n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, ends string"
)
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
RESULT = ("conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256")


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as hexadecimal digest and code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The role's length keeps role and text apart.
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(whole, 256), 1, 2 * TURN_BYTES)
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"), digest.alias("digest"), F.length(text).alias("chars"))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    in_order = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(in_order.alias("turns"))


def turn_paths(lists: DataFrame) -> DataFrame:
    """``conv_id, path, chars`` of turn lists."""
    path = F.unhex(F.array_join(F.col("turns.digest"), ""))
    return lists.select("conv_id", path.alias("path"), F.col("turns.chars").alias("chars"))


class Parentheses:
    """Balanced parentheses with the least and greatest excess of blocks and of pairs of blocks, and so on."""

    def __init__(self, opens: np.ndarray):
        self.opens = np.asarray(opens, np.int8)
        excess = np.cumsum(2 * self.opens.astype(np.int64) - 1)
        n_blocks = max(1, 1 << (max(-(-len(excess) // BLOCK), 1) - 1).bit_length())
        low, high = np.full(n_blocks * BLOCK, _FAR), np.full(n_blocks * BLOCK, -_FAR)
        low[: len(excess)] = high[: len(excess)] = excess
        self.excess = low
        self.blocks = low.reshape(-1, BLOCK)
        self.least, self.most = [self.blocks.min(axis=1)], [high.reshape(-1, BLOCK).max(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))
            self.most.append(self.most[-1].reshape(-1, 2).max(axis=1))

    def _holds(self, level: int, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        return (self.least[level][node] <= target) & (target <= self.most[level][node])

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Places of the parentheses that close those opened at the given places: where the excess first falls below."""
        target, found = self.excess[at] - 1, np.full(len(at), -1, np.int64)
        pending, block = np.arange(len(at)), at // BLOCK
        beyond = []
        for step in range(1, BLOCK + 1):  # in the block itself
            place = at[pending] + step
            inside = place // BLOCK == block[pending]
            beyond.append(pending[~inside])
            pending, place = pending[inside], place[inside]
            hit = self.excess[place] == target[pending]
            found[pending[hit]] = place[hit]
            pending = pending[~hit]
        pending = np.concatenate(beyond)
        node, level_of = block[pending], np.full(len(pending), -1)
        for level in range(len(self.least)):  # up, to the first right neighbour that holds the target
            left = np.flatnonzero((level_of < 0) & (node % 2 == 0) & (node + 1 < len(self.least[level])))
            hit = left[self._holds(level, node[left] + 1, target[pending[left]])]
            node[hit] += 1
            level_of[hit] = level
            going = level_of < 0
            node[going] //= 2
        for level in range(len(self.least) - 1, 0, -1):  # down, to the first block that holds it
            own = np.flatnonzero(level_of >= level)
            left = 2 * node[own]
            node[own] = np.where(self._holds(level - 1, left, target[pending[own]]), left, left + 1)
        for start in range(0, len(pending), 1 << 14):
            part = slice(start, start + (1 << 14))
            inner = (self.blocks[node[part]] == target[pending[part], None]).argmax(axis=1)
            found[pending[part]] = node[part] * BLOCK + inner
        return found


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN_BYTES
    low, high = 0, n // TURN_BYTES
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low * TURN_BYTES : mid * TURN_BYTES] == b[low * TURN_BYTES : mid * TURN_BYTES] else (low, mid)
    return low


def key_of(path: bytes, depth: int) -> bytes:
    return depth.to_bytes(4, "big") + blake2b(path[: depth * TURN_BYTES], digest_size=16).digest()


def shard_nodes(
    shard: int, rows: list[tuple[bytes, int, list[int]]], before: bytes | None, after: bytes | None
) -> dict[str, list]:
    """Columns of the nodes of a shard's ``path, conv_id, chars``, sorted; the paths next to it are None at the ends."""
    opens = bytearray(b"\1")
    depth, chars, parent, place = [0], [0], [-1], [0]
    first_end, n_ends = [0], [0]
    stack, last = [0], b""
    for at, (path, _, sizes) in enumerate(rows):
        common = common_turns(last, path)
        opens += bytes(len(stack) - 1 - common)
        del stack[common + 1 :]
        for d in range(common, len(path) // TURN_BYTES):
            place.append(len(opens))
            opens.append(1)
            depth.append(d + 1)
            chars.append(sizes[d])
            parent.append(stack[-1])
            first_end.append(at)
            n_ends.append(0)
            stack.append(len(depth) - 1)
        if not n_ends[stack[-1]]:
            first_end[stack[-1]] = at
        n_ends[stack[-1]] += 1
        last = path
    opens += bytes(len(stack))
    right_spine = stack  # nodes of the last path, by depth

    first, final = rows[0][0], rows[-1][0]
    left_spine, child = [0], 1
    for d in range(len(first) // TURN_BYTES):
        left_spine.append(child + d)  # the first path's nodes open one after the other
    goes_back = -1 if before is None else common_turns(before, first)
    goes_on = -1 if after is None else common_turns(final, after)

    own = np.frombuffer(bytes(opens), np.int8)
    opened = np.array(place, np.int64)
    closed = Parentheses(own).find_close(opened)
    past = np.arange(len(place)) + (closed - opened + 1) // 2  # first node after the subtree

    leaf = np.zeros(len(own) + 1, np.int64)
    leaf[1:] = (own == 1) & np.append(own[1:] == 0, False)
    if after is not None and after.startswith(final):
        leaf[place[right_spine[-1]] + 1] = 0  # goes on in the next shard, or has children there
    leaf = np.cumsum(leaf)

    members = np.concatenate([[0], np.cumsum(n_ends)])
    n_convs = members[past] - members[:-1]
    known = np.zeros(len(place), np.int64)
    known[left_spine[: goes_back + 1]] = 1  # met in an earlier shard already
    saved = np.concatenate([[0], np.cumsum((n_convs - 1 + known) * np.array(chars, np.int64))])
    children = np.bincount(np.array(parent[1:], np.int64), minlength=len(place))
    children[left_spine[: max(goes_back, 0)]] -= 1

    smallest = [rows[a][1] if n else None for a, n in zip(first_end, n_ends)]
    for i in range(len(place) - 1, 0, -1):
        up = parent[i]
        if smallest[up] is None or smallest[i] < smallest[up]:
            smallest[up] = smallest[i]

    keys: dict[int, bytes] = {i: key_of(first, d) for d, i in enumerate(left_spine[: goes_back + 1])}
    keys |= {i: key_of(final, d) for d, i in enumerate(right_spine[: goes_on + 1])}
    ends = [",".join(str(rows[r][1]) for r in range(a, a + n)) for a, n in zip(first_end, n_ends)]
    return {
        "shard": [shard] * len(place),
        "shared": [i in keys for i in range(len(place))],
        "key": [keys.get(i) for i in range(len(place))],
        "parent_key": [keys.get(p) for p in parent],
        "depth": depth,
        "conv_id": smallest,
        "parent_conv_id": [None if p < 0 or p in keys else smallest[p] for p in parent],
        "n_convs": n_convs.tolist(),
        "n_children": children.tolist(),
        "n_leaves": (leaf[closed + 1] - leaf[opened]).tolist(),
        "saved_tokens": (saved[past] - saved[:-1]).tolist(),
        "ends_sha256": [None if i in keys else sha256(e.encode()).hexdigest() for i, e in enumerate(ends)],
        "ends": [e if i in keys else None for i, e in enumerate(ends)],
    }


def _spine_ends(shared: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of shared nodes at which conversations end: their ids, shard after shard, in one hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = own, sha256()
                digest.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["key", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    some = shared.filter("ends <> ''").select("key", "shard", "ends")
    dealt = some.repartition("key").sortWithinPartitions("key", "shard")
    return dealt.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def trie(paths: DataFrame) -> DataFrame:
    """A row per node of the trie of ``conv_id, path, chars``."""
    spark = paths.sparkSession
    bounded_batches(spark)
    stage = Stage(spark)
    kept = stage.table("paths", lambda: paths)  # read twice by the range partitioning
    width = shuffle_width(spark)
    sharded = stage.table(
        "shards", lambda: kept.repartitionByRange(width, "path", "conv_id").withColumn("shard", F.spark_partition_id())
    )
    bounds = stage.table("bounds", lambda: sharded.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")))
    # A number a shard.
    full = sorted(r["shard"] for r in bounds.select("shard").collect())
    beside = spark.createDataFrame(
        list(zip(full, [None, *full[:-1]], [*full[1:], None])), "shard int, previous int, following int"
    )
    halo = beside.join(bounds.select(F.col("shard").alias("previous"), F.col("last").alias("before")), "previous", "left")
    halo = halo.join(bounds.select(F.col("shard").alias("following"), F.col("first").alias("after")), "following", "left")

    def build(own: pa.Table, edges: pa.Table) -> pa.Table:
        if not own.num_rows:
            return NODES.empty_table()
        rows = list(zip(*(own.column(c).to_pylist() for c in ("path", "conv_id", "chars"))))
        rows.sort(key=lambda r: r[:2])
        edge = edges.to_pylist()[0]
        return pa.table(shard_nodes(edge["shard"], rows, edge["before"], edge["after"]), NODES)

    by_shard = sharded.groupBy("shard").cogroup(halo.select("shard", "before", "after").groupBy("shard"))
    nodes = stage.table("nodes", lambda: by_shard.applyInArrow(build, NODE_KINDS))

    shared = nodes.filter("shared")
    merged = shared.groupBy("key").agg(
        F.any_value("parent_key").alias("parent_key"),
        F.any_value("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in SUMS),
    )
    merged = stage.table("merged", lambda: merged.join(_spine_ends(shared), "key", "left"))
    heads = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    spine = merged.join(heads, "parent_key", "left").fillna({"ends_sha256": sha256().hexdigest()})
    # By shard and parent, so that the children of a node that most shards share stay spread.
    here = shared.select("shard", F.col("key").alias("parent_key")).join(heads, "parent_key")
    own = nodes.filter("NOT shared")
    hung = own.filter("parent_key IS NOT NULL").drop("parent_conv_id").join(here, ["shard", "parent_key"])
    settled = own.filter("parent_key IS NULL")
    return settled.select(*RESULT).unionByName(hung.select(*RESULT)).unionByName(spine.select(*RESULT))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    return trie(turn_paths(turn_lists(conversations)))


def with_shared_openings(lists: DataFrame, opening: Column, base: Column, longest: int) -> DataFrame:
    """Turn lists rebuilt: the first ``opening`` turns of conversation ``base``, then one's own turns after as many.

    ``opening`` is at most ``longest``, which bounds what is joined. A base that is missing gives no turns.
    """
    lists = Stage(lists.sparkSession).table("lists", lambda: lists)
    asked = lists.withColumn("_base", base).withColumn("_opening", opening.cast("int"))
    heads = lists.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, longest).alias("_head"))
    heads = heads.join(asked.select("_base").distinct(), "_base", "left_semi")
    own = F.slice("turns", F.col("_opening") + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_opening")), F.slice("turns", 1, 0))
    return asked.join(heads, "_base", "left").select("conv_id", F.concat(head, own).alias("turns"))
