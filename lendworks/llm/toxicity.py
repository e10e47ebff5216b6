"""Toxicity: maximum-scoring segment search over token log-odds, judged by extreme-value statistics.

Tokens are runs of bytes without ASCII white space or punctuation, lower-cased in ASCII and hashed into SLOTS. A
slot's log-odds between toxic and clean texts have an informative Dirichlet prior, dealt like the whole corpus and
PRIOR_SHARE as large as the smaller kind, so rare tokens stay near zero. Less a drift (the DRIFT_SHARE quantile of the log-odds over clean tokens) the
scores are negative almost everywhere in clean text, and a linear-time scan finds all maximal-scoring segments: the
toxic passages. For clean text of n tokens, segments of score S or more come in ``E = K n exp(-lambda S)`` expected
cases: lambda solves ``sum p exp(lambda s) = 1``, K is the maximum-likelihood value over clean texts. A passage is
significant if E is at most ALPHA. A text's evidence is the sum of ``-ln E`` over its significant passages, or that
of its best passage if none is; the score is the share of toxic texts at such evidence, made monotone.

Evidence for K and for the shares comes from texts that the log-odds did not see: texts fall into two halves by hash,
and each is judged by the other half's log-odds. Learning reads at most ``max_train`` different labelled texts of
each kind, those with the smallest hashes; a token counts once a text. Only sums per slot and per interval of
evidence reach the driver. Labels, language, source and id are never inputs of a score. Labels are learnt only from
ids outside the held-out fold: the CRC-32 of the id as text leaves 2 by 4.

Defined results: a null text counts as empty; a text without tokens has no passage and the lowest score that the
intervals give. Null ids count as the empty text, null labels are not learnt from, repeated labels count once.
Without labels of both kinds the score is the share of toxic labels, 0 if there are none. Rows are scored one by one,
so equal texts score alike; an empty table gives an empty result. Other columns are kept; those with the names of
added ones are replaced.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendworks.llm.batches import bounded_batches, packed, slices, unpacked
from lendworks.staging import Stage

SLOTS = 1 << 18
PRIOR_SHARE = 0.1
DRIFT_SHARE = 0.99
#: Standard deviations by which a log-odds ratio must differ from zero.
DOUBT = 2.0
LEAST_DRIFT = 0.5
ALPHA = 0.05
FOLDS, HELD_OUT = 4, 2
MAX_TRAIN = 10_000
THRESHOLD = 0.3
#: Evidence is counted in intervals of this width between these ends.
LOWEST, HIGHEST, WIDTH = -8.0, 40.0, 0.5
INTERVALS = int((HIGHEST - LOWEST) / WIDTH) + 1
#: Words whose scores a Python worker keeps at most.
CACHE_WORDS = 200_000

_TOKEN_BYTES = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_TOKEN_BYTES).split()


def slot(token: bytes) -> int:
    return crc32(token) & (SLOTS - 1)


def log_odds(toxic: np.ndarray, clean: np.ndarray, prior: float | None = None) -> np.ndarray:
    """Log-odds ratio of each slot under a Dirichlet prior that follows the joint counts, less its uncertainty.

    What lies within DOUBT standard deviations of zero counts as zero: a token seen once tells nothing.
    """
    both = toxic + clean
    if prior is None:
        prior = PRIOR_SHARE * min(toxic.sum(), clean.sum())
    own = prior * both / max(both.sum(), 1.0)
    total = own.sum()
    seen = both > 0

    def odds(counts: np.ndarray) -> np.ndarray:
        got = np.where(seen, counts + own, 1.0)
        return np.log(got) - np.log(np.maximum(counts.sum() + total - got, 1e-12))

    ratio = odds(toxic) - odds(clean)
    spread = np.sqrt(1 / np.where(seen, toxic + own, 1.0) + 1 / np.where(seen, clean + own, 1.0))
    return np.where(seen, np.sign(ratio) * np.maximum(np.abs(ratio) - DOUBT * spread, 0), 0.0)


def drift_of(odds: np.ndarray, clean: np.ndarray) -> float:
    """The least value that DRIFT_SHARE of the clean tokens' log-odds do not exceed."""
    order = np.argsort(odds)
    upto = np.cumsum(clean[order])
    if not upto[-1]:
        return LEAST_DRIFT
    return max(float(odds[order][np.searchsorted(upto, DRIFT_SHARE * upto[-1])]), LEAST_DRIFT)


def decay_of(scores: np.ndarray, clean: np.ndarray) -> float:
    """The positive root of ``sum p exp(x s) = 1``: how fast large scores get rare in clean text."""
    seen = clean > 0
    p, s = clean[seen] / max(clean.sum(), 1.0), scores[seen]
    if not seen.any() or s.max() <= 0:
        return 1.0
    low, high = 0.0, 1.0
    while float(p @ np.exp(np.minimum(high * s, 700))) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if float(p @ np.exp(np.minimum(mid * s, 700))) < 1 else (low, mid)
    return high


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)`` in one scan, by start.

    Only positive scores can begin a segment, so the scan visits those and takes the rest from running sums. A
    candidate is joined to the last one that starts lower, if it ends higher, with all between; else it stands alone.
    """
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    sums = np.cumsum(scores)
    found: list[list] = []  # start, end, sum before, sum at the end, index of the last candidate starting lower
    for at, right, own in zip(places.tolist(), sums[places].tolist(), scores[places].tolist()):
        start, end, left = at, at + 1, right - own
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, end, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(start, end, right - left) for start, end, left, right, _ in found]


@dataclass
class Segmenter:
    """Scores of the slots and the statistics of their segments in clean text."""

    scores: np.ndarray
    decay: float
    scale: float = 1.0

    def __post_init__(self):
        self.known: dict[bytes, float] = {}

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        words, known = tokens(text), self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        found = list(map(known.get, words))
        if None in found:
            for i, value in enumerate(found):
                if value is None:
                    found[i] = known[words[i]] = float(self.scores[slot(words[i])])
        return len(words), maximal_segments(np.array(found, np.float64))

    def rarity(self, score: float, n: int) -> float:
        """``-ln E`` of a segment in a text of n tokens."""
        return self.decay * score - float(np.log(self.scale * max(n, 1)))

    def passages(self, text: str | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        """The text's evidence, and its significant passages as start, end, score and rarity."""
        n, found = self.segments(text)
        judged = [(a, b, s, self.rarity(s, n)) for a, b, s in found]
        kept = [j for j in judged if j[3] >= -np.log(ALPHA)]
        return (sum(j[3] for j in kept) if kept else max((j[3] for j in judged), default=LOWEST)), kept


@dataclass
class Model:
    segmenter: Segmenter
    shares: np.ndarray  # of toxic texts by interval of evidence

    def score(self, evidence: float) -> float:
        return float(np.interp(evidence, LOWEST + WIDTH * np.arange(INTERVALS), self.shares))


def interval(evidence: float) -> int:
    return int(min(max((evidence - LOWEST) / WIDTH + 0.5, 0), INTERVALS - 1))


def rising_shares(toxic: np.ndarray, clean: np.ndarray, prior: float) -> np.ndarray:
    """Share of toxic texts per interval, pooled until it rises; ``prior`` is their share among the labels.

    The counts are of as many labels of each kind as the sample took, so they are weighted back to the prior. A
    slight slope keeps texts of pooled intervals in the order of their evidence.
    """
    weights = [prior * toxic / max(toxic.sum(), 1.0), (1 - prior) * clean / max(clean.sum(), 1.0)]
    spare = 0.5 / max(toxic.sum() + clean.sum(), 1.0)
    pools: list[list[float]] = []
    for t, c in zip(weights[0] + spare * prior / INTERVALS, weights[1] + spare * (1 - prior) / INTERVALS):
        pools.append([t, t + c, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    level = np.concatenate([np.full(int(n), t / w) for t, w, n in pools])
    return np.clip(level * 0.98 + 0.02 * np.arange(INTERVALS) / INTERVALS, 0, 1)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _sample(docs: DataFrame, labels: DataFrame, max_train: int, stage: Stage) -> tuple[DataFrame, int, int]:
    """``text, toxic, half`` of at most ``max_train`` texts of each kind, and how many labels of each kind there are."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("hash"))
    # Copies of a text count once, so that no group of copies makes its own words telling.
    known = rows.select("doc_id", "hash").join(usable, "doc_id").groupBy("hash", "toxic").agg(F.min("doc_id").alias("doc_id"))
    kinds = [known.filter(F.col("toxic") == k).orderBy("hash", "doc_id").limit(max_train) for k in (0, 1)]
    chosen = stage.table("chosen", lambda: kinds[0].unionByName(kinds[1]))
    # Twice max_train rows at most, whatever the tables' sizes.
    texts = rows.join(F.broadcast(chosen), ["doc_id", "hash"]).dropDuplicates(["hash", "toxic"])
    half = F.pmod(F.xxhash64(F.lit("half"), "hash"), F.lit(2)).cast("int").alias("half")
    return stage.table("texts", lambda: texts.select("text", "toxic", half)), counts.get(1, 0), counts.get(0, 0)


def _slot_counts(texts: DataFrame) -> np.ndarray:
    """Texts that hold a slot, by half, kind and slot; tasks add up their own before anything is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches, 0):
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                kind = 2 * half + toxic
                own = sums.setdefault(kind, np.zeros(SLOTS, np.int64))
                own[np.fromiter({slot(t) for t in set(tokens(text))}, np.int64)] += 1
        for kind, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(own[at])],
                ["kind", "slot", "n"],
            )

    made = texts.select("text", "toxic", "half").mapInArrow(run, "kind int, slot int, n bigint")
    # A row a slot at most, whatever the tables' sizes.
    by_slot = made.groupBy("slot").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)))
    found = by_slot.toArrow()
    counts = np.zeros((4, SLOTS))
    for k in range(4):
        counts[k, found.column("slot").to_numpy()] = found.column(f"n{k}").to_numpy()
    return counts.reshape(2, 2, SLOTS)


def segmenter(clean: np.ndarray, toxic: np.ndarray, unseen: np.ndarray) -> Segmenter:
    """Scores from the counts of both kinds; ``unseen`` are clean counts to judge large scores by."""
    odds = log_odds(toxic, clean)
    scores = odds - drift_of(odds, clean)
    return Segmenter(scores.astype(np.float32), decay_of(scores, unseen))


def _tallied(texts: DataFrame, halves: list[Segmenter]) -> tuple[float, float, np.ndarray]:
    """Over texts judged by the other half: clean texts, their sum of ``n exp(-lambda S)``, and counts by evidence."""
    shared = texts.sparkSession.sparkContext.broadcast(halves)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean, reached, counts = 0, 0.0, np.zeros((2, INTERVALS), np.int64)
        for batch in slices(batches, 0):
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
                judge = shared.value[1 - half]
                counts[toxic, interval(judge.passages(text)[0])] += 1
                if not toxic:
                    n, found = judge.segments(text)
                    clean += 1
                    reached += max(n, 1) * float(np.exp(-judge.decay * max((s for *_, s in found), default=0.0)))
        kinds, at = np.nonzero(counts)
        values = [*counts[kinds, at].astype(float), float(clean), reached]
        places = [*(kinds * INTERVALS + at), 2 * INTERVALS, 2 * INTERVALS + 1]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(values, pa.float64())], ["place", "value"])

    sums = texts.select("text", "toxic", "half").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    flat = np.zeros(2 * INTERVALS + 2)
    for row in sums.collect():  # a row an interval and kind at most
        flat[row["place"]] = row["value"]
    return flat[-2], flat[-1], flat[:-2].reshape(2, INTERVALS)


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model | float:
    """A model, or the constant score if there are no labels of both kinds."""
    bounded_batches(docs.sparkSession)
    texts, toxic, clean = _sample(docs, labels, max_train, Stage(docs.sparkSession))
    if not toxic or not clean:
        return float(toxic > 0)
    counts = _slot_counts(texts)
    halves = [segmenter(*counts[h], counts[1 - h][0]) for h in (0, 1)]
    n, reached, _ = _tallied(texts, halves)
    scale = n / reached if reached else 1.0
    for half in halves:
        half.scale = scale
    _, _, seen = _tallied(texts, halves)
    whole = segmenter(*counts.sum(axis=0), counts[:, 0].sum(axis=0))
    whole.decay = (halves[0].decay + halves[1].decay) / 2
    whole.scale = scale
    return Model(whole, rising_shares(seen[1], seen[0], toxic / (toxic + clean)))


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """Add ``held_out``, ``score``, ``predicted``, and the significant ``passages`` by token number."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    passage = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("rarity", pa.float64())])
    made = pa.struct([("score", pa.float64()), ("passages", pa.list_(passage))])

    @F.arrow_udf("struct<score:double,passages:array<struct<start:int,end:int,score:double,rarity:double>>>")
    def judged(texts: pa.Array) -> pa.Array:
        own, rows = shared.value, []
        for text in texts:
            if isinstance(own, float):
                rows.append({"score": own, "passages": []})
                continue
            evidence, kept = own.segmenter.passages(text.as_py())
            found = [{"start": a, "end": b, "score": s, "rarity": r} for a, b, s, r in kept]
            rows.append({"score": own.score(evidence), "passages": found})
        return pa.array(rows, made)

    added = {"held_out", "score", "predicted", "passages"}
    kept = [c for c in docs.columns if c.lower() not in added]
    rows = packed(docs).withColumn("_judged", judged(F.col("_row.text").cast("string")))
    return rows.select(
        *unpacked(rows, kept),
        held_out(F.col("_row.doc_id")).alias("held_out"),
        F.col("_judged.score").alias("score"),
        F.when(F.col("_judged.score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        F.col("_judged.passages").alias("passages"),
    )


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    return score(docs, fit(docs, labels, max_train))
