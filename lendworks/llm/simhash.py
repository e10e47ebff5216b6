"""SimHash near-dedup through a segment-popcount embedding.

A fingerprint's 64 bits form 32 segments of two bits. The vector of the segments' bit counts is an embedding
in which the Manhattan distance never exceeds the Hamming distance. A grid range-join finds all pairs within
the wanted Manhattan distance d: the segments are dealt into d // 2 + 1 bands, so that a pair is at most 1
apart in some band. Each band is a grid with a cell per count vector; a fingerprint lies in its own cell and
also probes the cells one step up in one segment. Pairs that meet are verified on their exact bits.

Copies share a fingerprint and enter as one. Inside a crowded cell links are found breadth first and only
those of a spanning forest are given out, so no group's pairs are all emitted and none is lost to a component.
Cells beyond CELL_ROWS are cut into blocks, and every pair of blocks is a group of its own.

Defined results: A-Z are lower-cased; words are runs without ASCII white space. A text of fewer words than a
shingle is one shingle; a null, empty or blank text has fingerprint zero and links like any other. Null ids
lose to any other as a component's name. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendworks.llm.batches import bounded_batches, packed, slices, texts_of, unpacked
from lendworks.llm.links import components
from lendworks.staging import Stage

SEED = 42
BITS = 64
SEGMENTS = 32
LOW_BITS = 0x5555555555555555
#: Shingles whose bits are counted at once, for very long texts.
CHUNK = 16_384
#: Rows of a cell that one task handles together.
CELL_ROWS = 4_096
#: Up to this size a cell's rows are simply compared with one another.
PLAIN_ROWS = 24


def fingerprint(text: str, shingle: int) -> int:
    """The SimHash of a text: bit i is set if over half of the shingles' XXH64 have it set."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    ends = ends[shingle - 1 :] or ends[-1:]
    counts, n = np.zeros(BITS, np.int64), len(ends)
    for at in range(0, n, CHUNK):
        hashes = [xxh64_intdigest(line[s : e - 1], SEED) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])]
        bits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """``doc_id, text_hash, fp`` (signed) per row."""
    bounded_batches(docs.sparkSession)
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("text_hash"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            prints = np.array([fingerprint(t, shingle) for t in texts_of(batch.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "text_hash", "fp"]
            )

    return source.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def embedding(fp: Column) -> Column:
    """The segments' bit counts in unary (0: 00, 1: 01, 2: 11), so that differing bits are Manhattan distance."""
    shifted = F.shiftrightunsigned(fp, 1)
    either = fp.bitwiseOR(shifted).bitwiseAND(F.lit(LOW_BITS))
    both = fp.bitwiseAND(shifted).bitwiseAND(F.lit(LOW_BITS))
    return F.shiftleft(both, 1).bitwiseOR(either)


def cells(prints: DataFrame, distance: int) -> DataFrame:
    """``band, cell, home, fp``: each fingerprint in its own cell of every band and in those one step up."""
    bands = distance // 2 + 1
    per_band = [[s for s in range(SEGMENTS) if s * bands // SEGMENTS == b] for b in range(bands)]
    vectors = prints.select("fp", embedding(F.col("fp")).alias("v"))
    out = None
    for band, segments in enumerate(per_band):
        mask = sum(3 << (2 * s) for s in segments)
        inside = F.col("v").bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask))
        rows = vectors.select("fp", inside.alias("own"))
        homes = F.array(F.struct(F.lit(True).alias("home"), F.col("own").alias("cell")))
        places = homes
        if distance % bands or distance >= bands:
            low, high = F.lit(2 * segments[0]), F.lit(2 * segments[-1])

            def up(shift: Column) -> Column:
                field = F.call_function("shiftrightunsigned", F.col("own"), shift).bitwiseAND(F.lit(3))
                step = F.call_function("shiftleft", F.when(field == 0, F.lit(1)).otherwise(F.lit(2)).cast("long"), shift)
                return F.struct(F.lit(False).alias("home"), F.when(field != 3, F.col("own").bitwiseOR(step)).alias("cell"))

            steps = F.transform(F.sequence(low, high, F.lit(2)), up)
            places = F.concat(homes, F.filter(steps, lambda s: s["cell"].isNotNull()))
        rows = rows.select(F.lit(band).alias("band"), F.explode(places).alias("p"), "fp").select(
            "band", F.col("p.cell").alias("cell"), F.col("p.home").alias("home"), "fp"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _forest(prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of the graph of all pairs within the distance, breadth first."""
    rest = np.unique(prints)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                found = rest[near]
                yield np.full(len(found), at), found
                queue.extend(found)
                rest = rest[~near]


def _links(keys: np.ndarray, homes: np.ndarray, prints: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Verified links of whole cells; ``keys`` numbers the cells in ascending order."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    wanted = (np.add.reduceat(homes, starts) > 0) & (sizes > 1)
    found = []
    for at, n in zip(starts[wanted & (sizes > PLAIN_ROWS)], sizes[wanted & (sizes > PLAIN_ROWS)]):
        found += _forest(prints[at : at + n], distance)
    small = np.repeat(wanted & (sizes <= PLAIN_ROWS), sizes)
    keys, homes, prints = keys[small], homes[small], prints[small]
    for apart in range(1, min(PLAIN_ROWS, len(keys))):
        a, b = prints[:-apart], prints[apart:]
        meets = (keys[:-apart] == keys[apart:]) & ((homes[:-apart] + homes[apart:]) > 0)
        if not meets.any():
            break
        near = meets & (a != b) & (np.bitwise_count(a ^ b) <= distance)
        found.append((a[near], b[near]))
    return found


def linked(groups: DataFrame, distance: int) -> DataFrame:
    """Links ``a, b`` found inside the groups ``band, cell, part``."""
    key = ["band", "cell", "part"]
    dealt = groups.select(*key, "home", "fp").repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            change = np.zeros(len(columns[0]), bool)
            for c in columns[:3]:
                change[1:] |= c[1:] != c[:-1]
            found = _links(np.cumsum(change), columns[3].astype(np.int64), columns[4].view(np.uint64), distance)
            ends = [np.concatenate([f[i] for f in found] or [np.zeros(0, np.uint64)]).view(np.int64) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(e) for e in ends], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            last = np.logical_and.reduce([c == c[-1] for c in now[:3]])
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            held = [c[cut:] for c in now]
            if cut:
                yield links([c[:cut] for c in now])
        if held is not None:
            yield links(held)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_links(prints: DataFrame, distance: int, stage: Stage) -> DataFrame:
    """Links between distinct fingerprints ``fp`` that keep every component within ``distance`` bits whole."""
    rows = cells(prints, distance)
    crowded = stage.table(
        "crowded",
        lambda: rows.groupBy("band", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL_ROWS),
    )
    if crowded.isEmpty():
        return linked(rows.withColumn("part", F.lit(0).cast("long")), distance)
    marked = rows.join(crowded, ["band", "cell"], "left")
    blocks = F.ceil(F.col("n") / CELL_ROWS)
    own = F.pmod(F.xxhash64("fp"), blocks)
    # Block pair (i, j), i <= j, has the number i * blocks + j; a row of block k joins every pair with k in it.
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1), lambda k: F.least(k, own) * blocks + F.greatest(k, own)
    )
    parts = F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs)
    return linked(marked.withColumn("part", F.explode(parts)), distance)


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """``doc_id, text_hash, fingerprint, component_id, first_hash`` per row.

    ``component_id`` is the smallest id reachable over links, ``first_hash`` tells apart rows that share it.
    """
    stage = Stage(docs.sparkSession)
    rows = stage.table("prints", lambda: with_fingerprints(docs, doc_id, text, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    classes = stage.table("classes", lambda: rows.groupBy("fp").agg(first))
    links = stage.table("links", lambda: near_links(classes.select("fp"), distance, stage))
    rooted = components(links, stage)
    in_groups = classes.join(rooted, classes["fp"] == rooted["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = in_groups.groupBy("root").agg(F.min("first").alias("first"))
    named = in_groups.select("fp", "root").join(firsts, "root").select("fp", "first")
    return rows.join(named, "fp").select(
        "doc_id",
        "text_hash",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        F.col("first.text_hash").alias("first_hash"),
    )


def near_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """The documents without near copies: of each component the row of the smallest id stays, with all columns."""
    groups = near_groups(docs, doc_id, text, shingle, distance)
    stays = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash")))
    stays = stays.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    rows = packed(docs).withColumns(
        {
            "_own_id": F.col(f"_row.`{doc_id}`"),
            "_own_hash": F.xxhash64(F.coalesce(F.col(f"_row.`{text}`").cast("string"), F.lit(""))),
        }
    )
    same = Window.partitionBy("_own_hash", "_own_id").orderBy("_own_id")
    kept = rows.join(stays, (F.col("_own_hash") == F.col("_hash")) & F.col("_own_id").eqNullSafe(F.col("_id")), "left_semi")
    return kept.withColumn("_nth", F.row_number().over(same)).filter("_nth = 1").select(*unpacked(kept, docs.columns))
