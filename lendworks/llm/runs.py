"""Periodic runs of words by Baier grouping: Lyndon arrays of both orders, Lyndon roots extended into runs.

A run is a stretch of words with smallest period q that no neighbouring word extends. The first phase of Baier's
suffix sorter groups the suffixes by their longest Lyndon prefix, from the highest group down: of every member the
nearest suffix to the left in a lower group takes the member's prefix over, so when a group's turn comes its prefix
length is final, and the lengths are the Lyndon array. Every run holds a Lyndon root that is the longest Lyndon word
at its place under one of the two opposite orders of words, hence the roots of both arrays, extended to both sides
as far as words a period apart agree, are all runs.

Before that, a text is cut to the places that a wanted run can cover: with at least ``max(min_length, min_exponent *
q)`` words, every k words in a row inside a run occur in it twice, k being ``repeating`` words. Places outside
chains of such k-grams are in no run and extend none. Equal k-grams are found by hash; a collision only leaves more
places to sort.

Words are maximal stretches without ASCII white space. Defined results: null, empty and blank texts have no words and
no runs, their collapsed text is empty. Rows are taken one by one, so repeated rows and ties give equal results; a
text of any length is one task's work, linear in its words but for sorting k-grams. Other columns are kept; columns
with the names of added ones are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendworks.llm.batches import bounded_batches, packed, unpacked

MIN_LENGTH = 6
MIN_EXPONENT = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_array(ids: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, by the first phase of Baier's suffix sorter."""
    n = len(ids)
    place = {v: g for g, v in enumerate(sorted(set(ids)))}
    group = [place[v] for v in ids]
    members: list[list[int]] = [[] for _ in place]
    for i, g in enumerate(group):
        members[g].append(i)
    width = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    # Suffixes whose group is still to come, as a linked list; the last cells are the ends.
    left, right = [*range(-1, n)], [*range(1, n + 1), 0]
    lengths = [0] * n
    now = len(members) - 1
    while now >= 0:
        own = sorted(i for i in members[now] if group[i] == now)
        members[now] = []
        length, taken = width[now], {}
        for i in own:
            lengths[i] = length
            lower, higher = left[i], right[i]
            right[lower], left[higher] = higher, lower
            if lower >= 0:
                taken[lower] = taken.get(lower, 0) + 1
        by_times: dict[int, list[int]] = {}
        for i, times in taken.items():
            by_times.setdefault(times, []).append(i)
        # New groups go right above the one they come from, so the fewest copies end up lowest.
        for times in sorted(by_times, reverse=True):
            made: dict[int, int] = {}
            for i in by_times[times]:
                old = group[i]
                new = made.get(old)
                if new is None:
                    new = made[old] = len(width)
                    width.append(width[old] + times * length)
                    members.append([])
                    over = above[old]
                    below.append(old)
                    above.append(over)
                    above[old] = new
                    if over >= 0:
                        below[over] = new
                group[i] = new
                members[new].append(i)
        now = below[now]
    return lengths


def common_ahead(ids: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` and from ``b > a`` on are pairwise equal."""
    done, block = 0, 16
    while b + done < len(ids):
        m = min(block, len(ids) - b - done)
        differ = np.flatnonzero(ids[a + done : a + done + m] != ids[b + done : b + done + m])
        if len(differ):
            return done + int(differ[0])
        done, block = done + m, min(block * 2, 1 << 16)
    return done


def rooted_runs(ids: np.ndarray, min_length: int, min_exponent: int) -> set[tuple[int, int, int]]:
    """``start, length, period`` of all runs long enough."""
    n, found = len(ids), set()
    back, top = ids[::-1], int(ids.max(initial=0))
    for order in (ids, top - ids):
        lengths = np.array(lyndon_array(order.tolist()), np.int64)
        roots = np.flatnonzero(np.arange(n) + lengths < n)
        roots = roots[ids[roots] == ids[roots + lengths[roots]]]
        if min_exponent >= 3:  # such a run holds its root twice in a row
            roots = roots[lengths[roots + lengths[roots]] == lengths[roots]]
        reached: dict[int, int] = {}
        for i, period in zip(roots.tolist(), lengths[roots].tolist()):
            if i + period < reached.get(period, 0):
                continue  # inside the last run of this period
            end = i + period + common_ahead(ids, i, i + period)
            start = i - common_ahead(back, n - i - period, n - i)
            reached[period] = end
            if end - start >= max(min_length, min_exponent * period):
                found.add((start, end - start, period))
    return found


def repeating(min_length: int, min_exponent: int) -> int:
    """The most words k for which every k-gram inside a run is sure to occur in it twice.

    A run of length L and period q repeats its k-grams a period on or a period back if ``k <= L - 2 q + 1``.
    """
    return max(1, min(max(min_length, min_exponent * q) - 2 * q + 1 for q in range(1, ceil(min_length / min_exponent) + 2)))


def regions(ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Stretches covered by chains of k-grams that occur more than once."""
    n = len(ids) - k + 1
    if n < 2:
        return []
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n].astype(np.uint64) + np.uint64(1)
    order = np.argsort(grams, kind="stable")
    equal = grams[order][1:] == grams[order][:-1]
    again = np.zeros(n + 2, np.int8)
    again[order[1:][equal] + 1] = again[order[:-1][equal] + 1] = 1
    edges = np.flatnonzero(np.diff(again))
    return [(a, b + k - 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def runs_of(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs ``start, length, period`` of at least ``max(min_length, min_exponent * period)`` words, by start."""
    if min_exponent < 2:
        raise ValueError("a run is at least two periods long")
    if len(words) < min_length:
        return []
    place: dict = {}
    ids = np.array([place.setdefault(w, len(place)) for w in words], np.int64)
    found = []
    for a, b in regions(ids, repeating(min_length, min_exponent)):
        found += [(s + a, n, q) for s, n, q in rooted_runs(ids[a:b], min_length, min_exponent)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def first_periods(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that any run repeats after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, text: str = "text"
) -> DataFrame:
    """Add ``n_words``, ``runs`` by start and period, and ``collapsed``: the text's words with each run cut to one period."""
    bounded_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    made = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    @F.arrow_udf(f"struct<n_words:bigint,runs:{RUNS},collapsed:string>")
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            words = (value.as_py() or "").encode("utf-8").split()  # on ASCII white space only
            runs = runs_of(words, min_length, min_exponent)
            rows.append(
                {
                    "n_words": len(words),
                    "runs": [{"start": s, "length": n, "period": q} for s, n, q in runs],
                    "collapsed": b" ".join(first_periods(words, runs)).decode("utf-8"),
                }
            )
        return pa.array(rows, made)

    added = ("n_words", "runs", "collapsed")
    kept = [c for c in docs.columns if c.lower() not in added]
    rows = packed(docs).withColumn("_made", found(F.col(f"_row.`{text}`").cast("string")))
    return rows.select(*unpacked(rows, kept), *(F.col(f"_made.{c}").alias(c) for c in added))
