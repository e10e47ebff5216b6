"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text becomes a sparse vector: its words hashed into WORD_SLOTS slots with damped counts of unit length, its
structure statistics (standardised, and as intervals) and the document's stated length. The machine scores
``w0 + <w, x> + sum over pairs <v_i, v_j> x_i x_j`` with the pair sum taken in linear time as half of
``|sum v_i x_i|^2 - sum |v_i x_i|^2``. It is trained by gradient descent on at most ``max_train`` labelled
texts: one of each label, those with the smallest hashed ids, and if places are left, further texts of the labelled
ids by hash of id and text. Repeated labels and documents count once. Everything else covers all documents.

Labels, language, source and id are never inputs of a score. Labels are learnt only from ids outside the
held-out fold: the CRC-32 of the id as text leaves a remainder other than 0 by 5.

Defined results: a null text counts as empty and is scored like any text; a missing length is the text's. Null
ids count as the empty text, which is held out. Null labels are not learnt from. Without labels of both kinds
the score is the share of good labels, one half if there are none. Rows are scored one by one; an empty table
gives an empty result. Other columns are kept; columns with the names of added ones are replaced.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendworks.llm.batches import bounded_batches, packed, slices, texts_of, unpacked
from lendworks.staging import Stage

WORD_SLOTS = 1 << 13
FOLDS = 5
MAX_TRAIN = 4_000
THRESHOLD = 0.3
RANK = 8
EPOCHS = 12
BATCH = 64
RATE = 0.08
DECAY = 1e-4
#: Interval borders of a standardised statistic.
BORDERS = np.array([-1.5, -0.5, 0.5, 1.5, 3.0])

# Classes of a text's UTF-8 bytes. Bytes beyond ASCII count as letters.
_LETTER, _UPPER, _DIGIT, _STOP, _COMMA, _QUOTE, _MARK, _SPACE = range(8)
_CLASS = np.full(256, _LETTER, np.uint8)
_CLASS[:33] = _SPACE
_CLASS[33:127] = _MARK
for _characters, _kind in (
    (string.ascii_lowercase, _LETTER),
    (string.ascii_uppercase, _UPPER),
    (string.digits, _DIGIT),
    (".!?", _STOP),
    (",;:", _COMMA),
    ("'\"-", _QUOTE),
):
    _CLASS[list(_characters.encode())] = _kind

STATISTICS = (
    "chars",
    "words",
    "lines",
    "upper",
    "digit",
    "marks",
    "stops",
    "commas",
    "runs",
    "after_letter",
    "shouted",
    "word_length",
    "distinct_words",
    "top_word",
    "distinct_lines",
    "short_lines",
    "unended_lines",
    "words_a_line",
    "long_words",
    "stated_chars",
)
SIZE = WORD_SLOTS + len(STATISTICS) * (len(BORDERS) + 2)


@lru_cache(maxsize=50_000)
def _slot(word: str) -> int:
    return crc32(word.encode("utf-8")) % WORD_SLOTS


def features(text: str, stated_chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots (ascending), their values, and the raw statistics."""
    words = text.split()
    counts = Counter(words)
    by_slot: Counter[int] = Counter()
    for word, n in counts.items():
        by_slot[_slot(word)] += n
    slots = np.fromiter(by_slot.keys(), np.int32, len(by_slot))
    values = np.log1p(np.fromiter(by_slot.values(), np.float32, len(by_slot)))
    order = np.argsort(slots)
    norm = float(np.sqrt((values**2).sum())) or 1.0
    lines = [s for line in text.split("\n") if (s := line.strip())]
    n_chars, n_words, n_lines = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    kinds = _CLASS[raw]
    of_kind = np.bincount(kinds, minlength=8)
    sign = (kinds == _MARK) | (kinds == _STOP)
    statistics = [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        of_kind[_UPPER] / n_chars,
        of_kind[_DIGIT] / n_chars,
        of_kind[_MARK] / n_chars,
        of_kind[_STOP] / n_words,
        of_kind[_COMMA] / n_words,
        np.count_nonzero(sign[1:] & (raw[1:] == raw[:-1])) / n_words,
        np.count_nonzero((kinds[1:] == _MARK) & (kinds[:-1] <= _UPPER)) / n_words,
        sum(n for word, n in counts.items() if word.isupper() and len(word) > 1) / n_words,
        sum(map(len, words)) / n_words,
        len(counts) / n_words,
        max(counts.values(), default=0) / n_words,
        len(set(lines)) / n_lines,
        sum(len(line) < 30 for line in lines) / n_lines,
        sum(line[-1] not in ".!?:\"'" for line in lines) / n_lines,
        np.log1p(n_words / n_lines),
        sum(n for word, n in counts.items() if len(word) > 20) / n_words,
        np.log1p(max(stated_chars if stated_chars is not None else len(text), 0)),
    ]
    return slots[order], (values / norm)[order], np.array(statistics, np.float32)


@dataclass
class Machine:
    """Trained parameters, a few hundred kB."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def vector(self, slots: np.ndarray, values: np.ndarray, statistics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((statistics - self.mean) / self.spread, -4, 4)
        width = len(BORDERS) + 2
        base = WORD_SLOTS + np.arange(len(z)) * width
        interval = base + 1 + np.searchsorted(BORDERS, z)
        return (
            np.concatenate([slots, base, interval]),
            np.concatenate([values, z / 4, np.full(len(z), 0.5)]).astype(np.float32),
        )

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        part = self.factors[index] * value[:, None]
        total = part.sum(axis=0)
        pairs = 0.5 * float(total @ total - (part * part).sum())
        return float(1 / (1 + np.exp(-np.clip(self.bias + float(self.linear[index] @ value) + pairs, -40, 40))))


def train(examples: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss over shuffled batches; both kinds of label weigh the same as given."""
    rng = np.random.default_rng(seed)
    statistics = np.array([e[2] for e in examples], np.float64).reshape(len(examples), len(STATISTICS))
    good = float(labels.mean()) if len(labels) else 0.5
    known = len(labels) and 0 < good < 1
    machine = Machine(
        float(np.log(good / (1 - good))) if known else {0.0: -40.0, 1.0: 40.0}.get(good, 0.0),
        np.zeros(SIZE, np.float32),
        rng.normal(0, 0.02, (SIZE, RANK)).astype(np.float32) if known else np.zeros((SIZE, RANK), np.float32),
        statistics.mean(axis=0) if known else np.zeros(len(STATISTICS)),
        statistics.std(axis=0) + 1e-3 if known else np.ones(len(STATISTICS)),
    )
    if not known:
        return machine
    rows = [machine.vector(*e) for e in examples]
    seen_linear, seen_factors = np.full(SIZE, 1e-2, np.float32), np.full((SIZE, RANK), 1e-2, np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            picked = order[at : at + BATCH]
            index = np.concatenate([rows[i][0] for i in picked])
            value = np.concatenate([rows[i][1] for i in picked])
            sizes = np.array([len(rows[i][0]) for i in picked])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            own = machine.factors[index]
            part = own * value[:, None]
            total = np.add.reduceat(part, starts)
            pairs = 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((part**2).sum(axis=1), starts))
            raw = machine.bias + np.add.reduceat(machine.linear[index] * value, starts) + pairs
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[picked]) / len(picked)
            each = np.repeat(error, sizes).astype(np.float32)
            slots, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, each * value, len(slots)).astype(np.float32) + DECAY * machine.linear[slots]
            wide = (each * value)[:, None] * (np.repeat(total, sizes, axis=0) - part)
            deep = np.stack([np.bincount(place, wide[:, f], len(slots)) for f in range(RANK)], axis=1).astype(np.float32)
            deep += DECAY * machine.factors[slots]
            seen_linear[slots] += step**2
            seen_factors[slots] += deep**2
            machine.linear[slots] -= RATE * step / np.sqrt(seen_linear[slots])
            machine.factors[slots] -= RATE * deep / np.sqrt(seen_factors[slots])
            machine.bias -= RATE * float(error.sum())
    return machine


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _stated(df: DataFrame, prefix: str = "") -> Column:
    return F.col(f"{prefix}n_chars").cast("long") if "n_chars" in df.columns else F.lit(None).cast("long")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Machine:
    """Train on at most ``max_train`` labelled documents; their features, not their texts, reach the driver."""
    bounded_batches(docs.sparkSession)
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _stated(docs).alias("stated"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    labelled = rows.drop("text").join(usable, "doc_id")
    stage, names = Stage(docs.sparkSession), ["doc_id", "quality", "text_hash", "stated"]
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality")]
    # However many documents an id has, each label has a place before any has a second one.
    first = labelled.groupBy("doc_id", "quality").agg(F.min(F.struct("text_hash", "stated")).alias("own"))
    first = first.select("doc_id", "quality", "own.*").orderBy(*order).limit(max_train)
    sample = stage.table("first", lambda: first).withColumn("turn", F.lit(0))
    left = max_train - sample.count()
    if left > 0:
        keys = ["doc_id", "quality", "text_hash"]
        further = labelled.join(F.broadcast(sample), keys, "left_anti").groupBy(*keys).agg(F.min("stated").alias("stated"))
        further = further.select(*names).orderBy(F.xxhash64("doc_id", "text_hash"), *keys).limit(left)
        sample = sample.unionByName(stage.table("further", lambda: further).withColumn("turn", F.lit(1)))
    # The sample has max_train rows at most, whatever the tables' sizes.
    rows = rows.drop("stated").join(F.broadcast(sample), ["doc_id", "text_hash"])
    rows = rows.dropDuplicates(["doc_id", "quality", "text_hash"]).orderBy("turn", *order, "text_hash").limit(max_train)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            made = [features(t, n) for t, n in zip(texts_of(batch.column(0)), batch.column(1).to_pylist())]
            columns = [pa.array([m[i].tobytes() for m in made], pa.binary()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(2)], ["slots", "values", "statistics", "quality"])

    found = rows.select("text", "stated", "quality").mapInArrow(
        run, "slots binary, values binary, statistics binary, quality int"
    )
    kept = found.collect()
    examples = [
        (np.frombuffer(r["slots"], np.int32), np.frombuffer(r["values"], np.float32), np.frombuffer(r["statistics"], np.float32))
        for r in kept
    ]
    return train(examples, np.array([r["quality"] for r in kept], np.float32))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Add ``held_out``, ``score`` and ``predicted`` to every document."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def scored(texts: pa.Array, stated: pa.Array) -> pa.Array:
        own = shared.value
        values = [
            own.score(*own.vector(*features(t.as_py() or "", n.as_py()))) for t, n in zip(texts, stated)
        ]
        return pa.array(values, pa.float64())

    added = {"held_out", "score", "predicted"}
    kept = [c for c in docs.columns if c.lower() not in added]
    rows = packed(docs).withColumn("_score", scored(F.col("_row.text").cast("string"), _stated(docs, "_row.")))
    return rows.select(
        *unpacked(rows, kept),
        held_out(F.col("_row.doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    return score(docs, fit(docs, labels, max_train))
