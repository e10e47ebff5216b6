"""Line dedup by winnowing over line hashes.

The non-blank lines of a document, stripped, form a sequence of hashes. A window is a shortest run of at least
``min_words`` words: one starts at every line, and one, mirrored, ends at every line. Of each window the line with
the smallest hash is selected, the last of equals: equal windows select equal lines, so every repeated run of that
many words is sure to share a selected line, while far fewer lines than windows are selected. The positions of
selected lines are joined by line hash; where one occurs again, its windows are verified by content, each against the
first equal one in the order of document id, text and line. Forward and mirrored windows carry a match to both its
ends, whichever documents hold its parts first: a line goes if and only if it lies in a run of at least ``min_words``
words that also begins earlier. Blank lines among the lines of such a run go with them.

A window's content is the 128-bit hash of its lines' 128-bit hashes. Keys that hold more rows than a shuffle task
should (line hashes, contents) are counted first, and met through a broadcast of just those keys, of which there are
fewer than shuffle tasks; no key's rows are gathered, and a line that thousands share never makes pairs.

Defined results: null and empty texts and those below ``min_words`` words are kept as they are. Rows of one id
and text count as one document: each gets the same lines deleted. A document may lose all lines and is then
empty. Null ids come first. A run that repeats inside one document is deleted where it repeats; of a single
line repeated over and over the first stays. Extra columns are kept; a column with the name of the count of
deleted lines is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendworks.llm.batches import bounded_batches, packed, slices, texts_of, unpacked
from lendworks.sizing import shuffle_width
from lendworks.staging import Stage

MIN_WORDS = 50

WINDOW = "struct<first_line:int,last_line:int,digest:binary>"
DIGEST_BYTES = 16
#: Text whose windows a task holds at once, in bytes; they take a multiple of it.
PRINT_BYTES = 1_000_000


def lines_of(text: str) -> list[tuple[int, str]]:
    return [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip())]


def windows_of(words: list[int], min_words: int) -> Iterator[tuple[int, int]]:
    """Shortest runs ``start, end`` of lines with at least so many words, from every line and up to every line."""
    upto = [0, *accumulate(words)]
    n, end, starts = len(words), 0, {}
    for start in range(n):
        while end < n and upto[end] - upto[start] < min_words:
            end += 1
        if upto[end] - upto[start] < min_words:
            break
        starts[end] = start  # the last start with this end is the mirrored window
        yield start, end
    start = 0
    for end in range(1, n + 1):
        if upto[end] < min_words:
            continue
        while upto[end] - upto[start + 1] >= min_words:
            start += 1
        if starts.get(end) != start:
            yield start, end


def selected_lines(text: str, min_words: int) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """For each selected line its hash and the windows that select it: numbers of the first and last lines, digest."""
    from xxhash import xxh3_128_digest

    lines = lines_of(text)
    words = [len(s.split()) for _, s in lines]
    if sum(words) < min_words:
        return
    digests = [xxh3_128_digest(s.encode("utf-8")) for _, s in lines]
    hashes = [int.from_bytes(d[:8], "big", signed=True) for d in digests]
    whole = b"".join(digests)
    chosen: dict[int, list[tuple[int, int, bytes]]] = {}
    for start, end in windows_of(words, min_words):
        place = min(range(start, end), key=lambda i: (hashes[i], -i))
        digest = xxh3_128_digest(whole[DIGEST_BYTES * start : DIGEST_BYTES * end])
        chosen.setdefault(place, []).append((lines[start][0], lines[end - 1][0], digest))
    for place, found in chosen.items():
        yield hashes[place], found


def fingerprints(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id, text_hash, line_hash, windows``: a row per selected line."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["first_line", "last_line", "digest"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, PRINT_BYTES):
            owner, hashes, upto = [], [], [0]
            windows: list[tuple[int, int, bytes]] = []
            for i, text in enumerate(texts_of(batch.column(2))):
                for line_hash, found in selected_lines(text, min_words):
                    owner.append(i)
                    hashes.append(line_hash)
                    windows += found
                    upto.append(len(windows))
            take = pa.array(owner, pa.int32())
            first, last, digests = zip(*windows) if windows else ((), (), ())
            columns = [pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(digests, pa.binary())]
            lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays(columns, names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(hashes, pa.int64()), lists],
                ["doc_id", "text_hash", "line_hash", "windows"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, text_hash bigint, line_hash bigint, windows array<{WINDOW}>")


def met(rows: DataFrame, found: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``found`` (unique by ``key``, ``n`` rows each) where the key is found.

    Keys with more than a shuffle task's share of ``total`` rows are fewer than shuffle tasks: they are broadcast,
    and their rows are not dealt out by key at all.
    """
    most = max(total // max(shuffle_width(rows.sparkSession), 1), 1)
    heavy = F.broadcast(found.filter(F.col("n") > most).drop("n"))
    usual = rows.join(heavy.select(key), key, "left_anti").join(found.filter(F.col("n") <= most).drop("n"), key)
    return usual.unionByName(rows.join(heavy, key))


def repeated_runs(docs: DataFrame, min_words: int, stage: Stage) -> DataFrame:
    """``doc_id, text_hash, runs``: first and last lines of each document's windows that occur earlier."""
    prints = stage.table("fingerprints", lambda: fingerprints(docs, min_words))
    again = prints.groupBy("line_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = stage.table("again", lambda: again)
    windows = met(prints, again, "line_hash", prints.count()).select("doc_id", "text_hash", F.explode("windows").alias("w"))
    windows = stage.table(
        "windows",
        lambda: windows.select(
            "w.digest", F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "text_hash", "w.first_line").alias("place"), "w.last_line"
        ),
    )
    firsts = windows.groupBy("digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = stage.table("firsts", lambda: firsts)
    later = met(windows, firsts, "digest", windows.count()).filter(F.col("place") > F.col("first"))
    # Once each, however often a document's row is repeated.
    runs = later.select("place.doc_id", "place.text_hash", "place.first_line", "last_line").distinct()
    return runs.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first_line", "last_line")).alias("runs"))


def without_lines(text: str, first: np.ndarray, last: np.ndarray) -> tuple[str, int]:
    """The text without the lines of the runs, and how many lines went."""
    lines = text.split("\n")
    edges = np.zeros(len(lines) + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + 1, -1)
    gone = np.cumsum(edges[:-1]) > 0
    return "\n".join(line for line, g in zip(lines, gone.tolist()) if not g), int(gone.sum())


def line_dedup(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    count: str | None = "lines_removed",
) -> DataFrame:
    """The documents with later repeated runs deleted from ``text``; ``count`` tells the lines that went."""
    bounded_batches(docs.sparkSession)
    stage = Stage(docs.sparkSession)
    hashed = F.xxhash64(F.col(f"_row.`{text}`").cast("string"))
    rows = packed(docs).select("_row", F.col(f"_row.`{doc_id}`").alias("_id"), hashed.alias("_hash"))
    source = rows.select(
        F.col("_id").alias("doc_id"), F.col("_hash").alias("text_hash"), F.col(f"_row.`{text}`").cast("string").alias("text")
    )
    runs = (
        repeated_runs(source, min_words, stage)
        .select(F.col("doc_id").alias("_run_id"), F.col("text_hash").alias("_run_hash"), F.col("runs").alias("_runs"))
    )
    runs = stage.table("runs", lambda: runs)
    # A merge join at every size: the runs grow with the documents, so their broadcast would not last.
    matched = rows.join(
        runs.hint("merge"), F.col("_id").eqNullSafe(F.col("_run_id")) & (F.col("_hash") == F.col("_run_hash")), "left"
    )

    @F.arrow_udf("struct<text:string,gone:int>")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        made: list[tuple[str, int] | None] = []
        for text, runs in zip(texts, found):
            if not text.is_valid or not runs.is_valid:
                made.append(None)
                continue
            first, last = (runs.values.field(c).to_numpy() for c in ("first_line", "last_line"))
            made.append(without_lines(text.as_py(), first, last))
        return pa.array(
            [None if m is None else {"text": m[0], "gone": m[1]} for m in made],
            pa.struct([("text", pa.string()), ("gone", pa.int32())]),
        )

    old = F.col(f"_row.`{text}`")
    # Texts that lose nothing stay on the JVM's side.
    done = matched.withColumn("_cut", cut(F.when(F.col("_runs").isNotNull(), old.cast("string")), F.col("_runs")))
    columns = []
    for c, column in zip(docs.columns, unpacked(done, docs.columns)):
        if c == text:
            column = F.when(F.col("_cut").isNull(), old).otherwise(F.col("_cut.text")).alias(c)
        if count is None or c.lower() != count.lower():
            columns.append(column)
    if count:
        columns.append(F.coalesce(F.col("_cut.gone"), F.lit(0)).alias(count))
    return done.select(*columns)
