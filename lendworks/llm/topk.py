"""Exact top-k inner-product search through a pivot-distance index.

Components are made integers, ``floor(256 x)``. With M the largest norm, a vector x gets one more component
that lifts it onto the sphere of radius M, and a query is scaled onto it: the angle between the two then falls
as the inner product rises, and angles obey the triangle inequality. Each vector is keyed by its nearest pivot
and its angle to it; the angles are cut into rings of fixed width, and each ring's members into blocks.

A query first searches a block of its own ring, which gives it a k-th best score to beat. Around every pivot
it then expands over the rings outwards: from the angles' difference, ``score <= |q| M cos(gap)``, and the
expansion stops where that bound falls below the score to beat, for all rings beyond have larger gaps. What is
left is joined block by block, queries in groups, and scored by matrix products. Ties go to the smaller id, so
a bound equal to the score to beat does not stop.

The pivots (at most PIVOTS vectors, those of smallest hashed ids) and the directory of rings (PIVOTS * RINGS
rows) are bounded by parameters; they alone are kept by the driver. Every vector is indexed.

Defined results: vectors that are null or hold null or non-finite components take no part, neither do null
ids. Components that a shorter vector lacks count as 0. A query's own row is never returned: rows that share
its id are its own. Rows equal in id and vector are one. With fewer candidates than k all are returned; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendworks.llm.batches import bounded_batches
from lendworks.staging import Stage

PIVOTS = 32
RINGS = 64
BLOCK_ROWS = 512
GROUP_QUERIES = 64
SCALE = 256
#: Allowance for rounding in bounds, as a share of M squared.
SLACK = 1e-9


def quantised(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v``: distinct usable rows with integer components."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite)
    return rows.select("vec_id", F.transform(v, lambda x: F.floor(x * SCALE)).alias("v")).distinct()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class Sphere:
    """The pivots on the sphere of the largest norm."""

    def __init__(self, pivots: np.ndarray, norm2: float):
        self.pivots, self.norm2 = pivots.astype(float), max(float(norm2), 1.0)
        self.lift = np.sqrt(np.maximum(self.norm2 - (self.pivots**2).sum(axis=1), 0))

    def angles(self, x: np.ndarray) -> np.ndarray:
        """Of members to every pivot."""
        x = x.astype(float)
        lift = np.sqrt(np.maximum(self.norm2 - (x**2).sum(axis=1), 0))
        return np.arccos(np.clip((x @ self.pivots.T + np.outer(lift, self.lift)) / self.norm2, -1, 1))

    def query_angles(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(float)
        norm = np.maximum(np.sqrt((q**2).sum(axis=1)), 1e-300)
        return np.arccos(np.clip(q @ self.pivots.T / (norm[:, None] * np.sqrt(self.norm2)), -1, 1))

    def bounds(self, q: np.ndarray, pivot: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest score that members of each ring can have, per query."""
        to = self.query_angles(q)[:, pivot]
        gap = np.maximum(0, np.maximum(low - to, to - high) - 1e-7)
        norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
        return norm[:, None] * np.sqrt(self.norm2) * np.cos(np.minimum(gap, np.pi)) + SLACK * self.norm2


def scores_of(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if largest < 2**53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q.astype(np.int64) @ x.T.astype(np.int64)


def best_of(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int, least: np.ndarray | None = None):
    """``query, id, score`` of the k best of a block per query; scores below ``least`` are left out."""
    scores = scores_of(q, x)
    order = np.argsort(x_ids, kind="stable")
    scores, x_ids = scores[:, order], x_ids[order]
    out = []
    for i in range(len(q_ids)):
        usable = x_ids != q_ids[i]
        if least is not None:
            usable &= scores[i] >= least[i]
        mine = np.flatnonzero(usable)
        if len(mine):
            top = mine[np.argsort(-scores[i, mine], kind="stable")[:k]]
            out.append((np.full(len(top), q_ids[i]), x_ids[top], scores[i, top]))
    return [np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(3)]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    pivots: int = PIVOTS,
    rings: int = RINGS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    stage = Stage(spark)
    rows = stage.table("vectors", lambda: quantised(vectors, vec_id, vector))
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    sizes = rows.agg(F.max(norm).alias("norm2"), F.max(F.size("v")).alias("width")).first()
    width = sizes["width"] or 0
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if sizes["width"] is None:
        return empty
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
    rows = rows.select("vec_id", F.concat("v", padding).alias("v")) if width else rows.withColumn("v", F.array(F.lit(0).cast("long")))
    width = max(width, 1)

    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).collect()
    sphere = Sphere(np.unique(np.array([p["v"] for p in picked]), axis=0), sizes["norm2"])
    ring_width = np.pi / rings

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angles = sphere.angles(matrix(batch.column(1), width))
                pivot = angles.argmin(axis=1)
                angle = angles[np.arange(len(pivot)), pivot]
                ring = np.minimum((angle / ring_width).astype(np.int64), rings - 1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(pivot.astype(np.int32)), pa.array(ring.astype(np.int32)), pa.array(angle)],
                    ["vec_id", "v", "pivot", "ring", "angle"],
                )

    index = stage.table(
        "index", lambda: rows.mapInArrow(assign, "vec_id long, v array<long>, pivot int, ring int, angle double")
    )
    found = index.groupBy("pivot", "ring").agg(
        F.min("angle").alias("low"),
        F.max("angle").alias("high"),
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.count_if(is_query) / GROUP_QUERIES), F.lit(1)).cast("int").alias("deals"),
    )
    directory = stage.table("directory", lambda: found)
    # At most pivots * rings rows, whatever the number of vectors.
    listed = directory.orderBy("pivot", "ring").collect()
    d_pivot, d_ring, d_low, d_high, d_blocks = (np.array([r[i] for r in listed]) for i in range(5))

    placed = index.join(F.broadcast(directory.select("pivot", "ring", "blocks")), ["pivot", "ring"])
    members = F.collect_list(F.struct("vec_id", "v")).alias("members")
    blocks = stage.table(
        "blocks",
        lambda: placed.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int"))
        .groupBy("pivot", "ring", "block")
        .agg(members),
    )
    def block_of(column: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = column.slice(i, 1).flatten()
        return own.field("vec_id").to_numpy(zero_copy_only=False), matrix(own.field("v"), width)

    # First look: queries against one block of their own ring, about GROUP_QUERIES at a time.
    deal = F.pmod(F.xxhash64("vec_id", "v"), F.col("deals")).cast("int")
    homes = (
        index.filter(is_query)
        .join(F.broadcast(directory.select("pivot", "ring", "deals")), ["pivot", "ring"])
        .groupBy("pivot", "ring", deal.alias("deal"))
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    )
    first_blocks = blocks.groupBy("pivot", "ring").agg(F.min("block").alias("block"))
    first_blocks = first_blocks.join(blocks.hint("merge"), ["pivot", "ring", "block"])

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q = block_of(batch.column(0), i)
                x_ids, x = block_of(batch.column(1), i)
                by, _, scores = best_of(q_ids, q, x_ids, x, k)
                least = [np.sort(scores[by == one])[0] if (by == one).sum() == k else None for one in q_ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids), pa.array(list(q), pa.list_(pa.int64())), pa.array(least, pa.int64())],
                    ["vec_id", "v", "least"],
                )

    looked = stage.table(
        "looked",
        lambda: homes.join(first_blocks.hint("merge"), ["pivot", "ring"])
        .select("queries", "members")
        .mapInArrow(look, "vec_id long, v array<long>, least long"),
    )

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP_QUERIES):
                batch = whole.slice(at, GROUP_QUERIES)
                q = matrix(batch.column(1), width)
                least = np.array([-np.inf if s is None else s for s in batch.column(2).to_pylist()])
                bounds = sphere.bounds(q, d_pivot, d_low, d_high)
                out = []
                for cell in range(len(d_pivot)):
                    mine = np.flatnonzero(bounds[:, cell] >= least)
                    if len(mine):
                        ids = batch.column(0).take(pa.array(mine)).to_numpy()
                        wanted = least[mine]
                        payload = (ids.astype("<i8").tobytes(), wanted.astype("<f8").tobytes(), q[mine].astype("<i8").tobytes())
                        out += [(int(d_pivot[cell]), int(d_ring[cell]), b, *payload) for b in range(int(d_blocks[cell]))]
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                names = ["pivot", "ring", "block", "ids", "least", "vectors"]
                # A few at a time: each row carries a group's vectors.
                for start in range(0, len(out), 64):
                    rows_out = out[start : start + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in rows_out], kinds[i]) for i in range(6)], names)

    wanted = looked.mapInArrow(expand, "pivot int, ring int, block int, ids binary, least binary, vectors binary")
    # Neither side has a bound, and the estimate of a Python function's rows is no measure: join by a shuffle.
    pairs = wanted.join(blocks.hint("merge"), ["pivot", "ring", "block"]).select("ids", "least", "vectors", "members")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids = np.frombuffer(batch.column(0)[i].as_py(), "<i8")
                least = np.frombuffer(batch.column(1)[i].as_py(), "<f8")
                q = np.frombuffer(batch.column(2)[i].as_py(), "<i8").reshape(len(q_ids), width)
                x_ids, x = block_of(batch.column(3), i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in best_of(q_ids, q, x_ids, x, k, least)], ["query_id", "vec_id", "score"]
                )

    hits = pairs.mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
