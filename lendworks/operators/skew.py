"""Operators that stay balanced when one key holds a large share of the rows.

``heavy_keys`` finds such keys with a bounded sketch. The other functions take its result as plain
values, so they stay lazy, and give the same rows whichever keys are listed: the list only changes
how the rows are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendworks.sizing import shuffle_width

# A key counts as heavy from the mean number of rows in a shuffle task on. The sketch can tell shares down to
# about its number of items; beyond MOST_HEAVY tasks the share stays at one in MOST_HEAVY.
MOST_HEAVY = 50_000
SKETCH_ITEMS = 20  # tracked per key that can qualify

# Up to this many listed keys are written into the plan; more travel as a broadcast table.
LITERALS = 100
# Identical copies of a row that one task writes out again.
COPIES = 50_000


def heavy_keys(df: DataFrame, columns: Sequence[str], share: float | None = None) -> dict[str, list]:
    """Values of each column that fill at least ``share`` of the rows, by default a shuffle task's share.

    One column-pruned pass with a mergeable frequent-items sketch per column: partial sketches are
    built map-side, so nothing but sketches is shuffled. At most ``1/share`` values per column can
    qualify, which bounds both what returns to the driver and whatever is broadcast from it.
    """
    if not columns:
        return {}
    share = share or 1 / min(max(shuffle_width(df.sparkSession), 2), MOST_HEAVY)
    limit = max(int(1 / share), 1)
    tracked = min(limit * SKETCH_ITEMS, 1_000_000)
    top = [F.expr(f"approx_top_k(CAST(`{c}` AS STRING), {limit}, {tracked})").alias(c) for c in columns]
    row = df.select(*columns).agg(F.count(F.lit(1)).alias("_rows"), *top).first()
    floor = max(share * row["_rows"], 2)
    return {c: [t["item"] for t in row[c] or [] if t["count"] >= floor] for c in columns}


def is_any_of(column: Column, values: Iterable) -> Column:
    """Null-safe membership: NULL in ``values`` matches NULL, and the result is never NULL."""
    values = list(values)
    present = [v for v in values if v is not None]
    hit = F.coalesce(column.isin(*present), F.lit(False)) if present else F.lit(False)
    return hit | column.isNull() if None in values else hit


def split_heavy(df: DataFrame, column: str, hot: Iterable) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not listed, and rows whose key is; each row is in one of the two."""
    hot = list(hot)
    if len(hot) <= LITERALS:
        listed = is_any_of(F.col(column), hot)
        return df.filter(~listed), df.filter(listed)
    # At most one key in MOST_HEAVY of the rows can be listed, which bounds the broadcast.
    keys = F.broadcast(df.sparkSession.createDataFrame([(v,) for v in hot], "_listed string"))
    same = F.col(column).eqNullSafe(F.col("_listed"))
    return df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi")


def flag_duplicates(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    flag: str,
    hot: Iterable = (),
) -> DataFrame:
    """Add ``flag``: FALSE for the first row of each key by ``order``, TRUE for all others.

    Every row crosses one shuffle. Rows of ordinary keys are ranked by a window. Rows of listed keys are merged
    with their identical copies, map-side first, and so dealt out by content; the best of each key, found the same
    way and broadcast, tells which content survives, and of its copies the first one does.
    """
    hot = list(hot)
    ranked = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    if not hot:
        return df.withColumn(flag, ranked > 1)

    ordinary, heavy = split_heavy(df, key, hot)
    columns = [F.col(f"`{c}`") for c in df.columns]
    content = heavy.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    # Tasks keep one row a key before the shuffle, so a listed key costs a row a task.
    best = content.withColumn("_rank", ranked).filter("_rank = 1")
    best = best.select(F.col(f"`{key}`").alias("_best_key"), F.struct(*columns, "_copies").alias("_best"))
    same = F.struct(*columns, "_copies").eqNullSafe(F.col("_best"))
    judged = content.join(F.broadcast(best), F.col(f"`{key}`").eqNullSafe(F.col("_best_key"))).select(
        *columns, "_copies", same.alias("_survives")
    )
    # Rows that very many copies share are written out by several tasks. The number is given, as adaptive execution
    # would merge the parts: a part is a few bytes before its copies are written out.
    last = ((F.col("_copies") - 1) / COPIES).cast("long")
    many = judged.filter(F.col("_copies") > COPIES).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    many = many.repartition(shuffle_width(df.sparkSession), "_part", *columns).withColumn(
        "_here", F.least(F.lit(COPIES).cast("long"), F.col("_copies") - F.col("_part") * COPIES)
    )
    few = judged.filter(F.col("_copies") <= COPIES).select("*", F.lit(0).cast("long").alias("_part"), F.col("_copies").alias("_here"))
    copies = few.unionByName(many).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_here"))))
    first = F.col("_survives") & (F.col("_part") == 0) & (F.col("_copy") == 1)
    return ordinary.withColumn(flag, ranked > 1).unionByName(copies.select(*columns, (~first).alias(flag)))


def _listed_rows(lookup: DataFrame, on: str, hot: list) -> DataFrame:
    """Lookup rows of listed keys; NULL matches no lookup row, and a short list reaches the scan."""
    named = [v for v in hot if v is not None]
    if len(named) <= LITERALS:
        return lookup.filter(F.col(on).isin(*named))
    return split_heavy(lookup, on, named)[1]


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: str,
    hot: Iterable = (),
) -> DataFrame:
    """Left join to a lookup whose key ``on`` is unique, keeping every row of ``df`` once.

    Spark picks the join strategy for ordinary keys. Rows with a listed key pass it by: they get their values from
    a broadcast of just the listed lookup rows, at most one per listed key, and are not shuffled.
    """
    hot = list(hot)
    extra = _extra(lookup, on)
    if not hot:
        return df.join(lookup, on, "left").select(*df.columns, *extra)

    ordinary, heavy = split_heavy(df, on, hot)
    # Grouping keeps it to one row per listed key even where the lookup's key is not unique after all.
    few = _listed_rows(lookup, on, hot).groupBy(on).agg(F.min(F.struct(F.lit(0).alias("_"), *extra)).alias("_values"))
    few = few.select(on, *(F.col("_values").getField(c).alias(c) for c in extra))
    return (
        ordinary.join(lookup, on, "left")
        .select(*df.columns, *extra)
        .unionByName(heavy.join(F.broadcast(few), on, "left").select(*df.columns, *extra))
    )


def missing_rows(df: DataFrame, known: DataFrame, on: str, hot: Iterable = ()) -> DataFrame:
    """Rows whose key is not in ``known``; NULL is in none. Listed keys are settled by a broadcast of those found."""
    hot = list(hot)
    keys = known.select(F.col(known.columns[0]).alias(on))
    if not hot:
        return df.join(keys, on, "left_anti").select(*df.columns)
    ordinary, heavy = split_heavy(df, on, hot)
    found = F.broadcast(_listed_rows(keys, on, hot).distinct())
    rest = heavy.join(found, on, "left_anti").select(*df.columns)
    return ordinary.join(keys, on, "left_anti").select(*df.columns).unionByName(rest)


def _extra(lookup: DataFrame, on: str) -> list[str]:
    return [c for c in lookup.columns if c != on]
