"""Mixing sources to target weights by Poisson replication, in built-in functions only.

Each source has a target weight. With ``epochs`` times the corpus as the wanted size, a document of a source
is repeated at the mean rate ``weight share * wanted size / documents of the source``. Its count is drawn by
inverting the Poisson distribution at a uniform number hashed from seed and document id, so any task computes
the same count again. Rates above PART_RATE are split into equal parts, each inverted on its own; sums of
Poisson counts are Poisson counts.

Defined results: a null source is a source of its own; a null id is hashed like the text 'null'. Rows with one
id get one count each. A document may get no copy: that is the distribution. Sources that the weights don't
name have weight 0 unless ``default_weight`` says otherwise. An empty table gives an empty result. An input
column with the name of the copy column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendworks.sizing import shuffle_width
from lendworks.staging import Stage

PART_RATE = 16.0
#: Values in a part's table: the rest of the distribution beyond it weighs less than the hash can tell.
TERMS = 80
HASH_BITS = 52
#: Rate tables up to so many sources are broadcast (under 1 kB a source); longer ones are joined with salts.
BROADCAST_SOURCES = 10_000


def uniform(seed: int, doc_id: Column, part: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 sum."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), part.cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**HASH_BITS))


def cumulative(rate: Column) -> Column:
    """P(X <= k) of a Poisson variable for k = 0, 1, ... as an array."""
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), F.array(first).alias("sums"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda state: state["sums"])


def source_rates(
    docs: DataFrame,
    source: str,
    weights: dict[str, float] | None,
    default_weight: float,
    temperature: float,
    epochs: float,
) -> DataFrame:
    """``source, rate, parts, sums`` per source, staged; the counts cover all documents."""
    counts = Stage(docs.sparkSession).table(
        "counts", lambda: docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    )
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(float(default_weight))
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    weighted = counts.withColumn("weight", weight)
    total = weighted.agg(F.sum("n").alias("n"), F.sum("weight").alias("w")).first()
    wanted = float(total["n"] or 0) * epochs
    rate = F.lit(wanted) * F.col("weight") / F.lit(total["w"] or 1.0) / F.col("n")
    parts = F.greatest(F.ceil(rate / PART_RATE), F.lit(1)).cast("int")
    return weighted.select("source", rate.alias("rate"), parts.alias("parts")).withColumn(
        "sums", cumulative(F.col("rate") / F.col("parts"))
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    *,
    default_weight: float = 0.0,
    temperature: float = 0.5,
    epochs: float = 1.0,
    seed: int = 42,
    doc_id: str = "doc_id",
    source: str = "source",
    copy: str | None = "copy",
) -> DataFrame:
    """Every document as often as drawn, in an order hashed over the whole corpus.

    Without ``weights`` a source weighs its number of documents to the power ``temperature``. ``copy`` names a
    column that counts a document's copies from 1; None leaves it out.
    """
    rates = source_rates(docs, source, weights, default_weight, temperature, epochs)
    columns = [c for c in docs.columns if copy is None or c.lower() != copy.lower()]
    row = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
        F.col(f"`{doc_id}`").alias("id"),
        F.col(f"`{source}`").alias("of"),
    )
    if rates.count() <= BROADCAST_SOURCES:
        rated = row.join(F.broadcast(rates), F.col("of").eqNullSafe(F.col("source")))
    else:
        salts = shuffle_width(docs.sparkSession)
        spread = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        row = row.withColumn("salted", F.pmod(F.xxhash64("id", "row"), F.lit(salts)).cast("int"))
        rated = row.join(spread, F.col("of").eqNullSafe(F.col("source")) & (F.col("salted") == F.col("salt")))

    # The draws are an array of their own, so that each is hashed once and not once per value of the table.
    draws = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda part: uniform(seed, F.col("id"), part))
    count = F.aggregate(draws, F.lit(0), lambda total, u: total + F.size(F.filter(F.col("sums"), lambda s: s < u)))
    copies = (
        rated.select("row", "id", count.alias("copies"))
        .filter("copies > 0")
        .select("row", "id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("nth"))
    )
    order = F.xxhash64(F.lit(seed), F.col("id"), F.col("nth"))
    shuffled = copies.withColumn("place", order).repartition("place").sortWithinPartitions("place")
    return shuffled.select(
        *(F.col("row").getField(c).alias(c) for c in columns), *([F.col("nth").alias(copy)] if copy else [])
    )
