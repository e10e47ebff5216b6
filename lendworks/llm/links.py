"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendworks.staging import Stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (long), root being the smallest node reached.

    Large stars hang a node's larger neighbours under its smallest one, small stars its smaller neighbours and
    itself. Both keep connectivity, never make more links, and end in one star per component after a number of
    rounds that is logarithmic in practice. Each round is written, so a lost executor costs no earlier round.
    """
    now = stage.table(
        "links_0",
        lambda: links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(),
    )
    before, turn = None, 0
    while (state := _state(now)) != before and state[0]:
        before, turn = state, turn + 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("l"))
            .select(F.col("l.b").alias("a"), F.col("l.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        now = stage.table(f"links_{turn}", lambda: small)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
