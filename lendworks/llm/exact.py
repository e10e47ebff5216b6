"""Exact dedup by skew-safe combining, in built-in operators.

Copies are reduced in stages that all compare whole texts: inside each map task (partial aggregation), among the
rows of one digest and salt, and among the salts' winners of one digest. Digests are counted first. One that holds
more rows than a shuffle task should is salted, by as many salts as tasks its rows would fill; all others need no
salt and are combined in one shuffle. Decisions return to the documents by digest: to those of ordinary digests by a
join, to those of salted ones from a broadcast of their groups, fewer than there are shuffle tasks. No stage gathers
a group of copies.

Defined results: a null text counts as empty. Of equal texts the row with the largest id stays; a null id
loses against any other. Of rows that also share that id, exactly one stays. Two texts with one digest are
kept apart by their content. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lendworks.sizing import shuffle_width
from lendworks.staging import Stage

#: Rows of one id and text that a task writes out.
COPIES = 50_000

RESULT = ("doc_id", "digest", "keep_id", "group_size", "kept")


def _grouped(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """``digest, text, keep_id, group_size`` of every group of equal texts."""
    best, size = F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    usual = rows.join(heavy, "digest", "left_anti").groupBy("digest", "text").agg(best, size)
    # Any salt will do, for nothing is looked up by it; the task tells copies with one id apart.
    salt = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.col("salts"))
    salted = rows.join(heavy, "digest").withColumn("salt", salt)
    winners = salted.groupBy("digest", "salt", "text").agg(best, size)
    merged = winners.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return usual.unionByName(merged)


def _one_kept(rows: DataFrame) -> DataFrame:
    """Rows that share their group's ``keep_id``: one of each group is kept.

    They are alike, so they are counted and written out again, by several tasks where they are very many.
    """
    columns = [c for c in RESULT if c != "kept"]
    alike = rows.groupBy(*columns, "class").agg(F.count(F.lit(1)).alias("n"))
    last = ((F.col("n") - 1) / COPIES).cast("long")
    many = alike.filter(F.col("n") > COPIES).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    many = many.repartition("part", "digest", "doc_id")
    few = alike.filter(F.col("n") <= COPIES).withColumn("part", F.lit(0).cast("long"))
    here = F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("part") * COPIES)
    out = few.unionByName(many).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), here)))
    return out.select(*columns, ((F.col("part") == 0) & (F.col("copy") == 1)).alias("kept"))


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = lambda text: F.sha2(text, 256),
) -> DataFrame:
    """One row per document: ``doc_id, digest, keep_id, group_size, kept``."""
    spark = docs.sparkSession
    stage = Stage(spark)
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("digest", digest(F.col("text")))
    slim = stage.table("slim", lambda: rows.drop("text"))
    most = max(slim.count() // max(shuffle_width(spark), 1), 1)
    counts = slim.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    heavy = counts.select("digest", F.ceil(F.col("n") / most).alias("salts"))
    heavy = F.broadcast(stage.table("heavy", lambda: heavy))  # fewer rows than shuffle tasks

    groups = stage.table("groups", lambda: _grouped(rows, heavy).drop("text"))
    several = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    several = stage.table("several", lambda: several)
    usual = slim.join(heavy, "digest", "left_anti").join(groups.join(heavy, "digest", "left_anti"), "digest")
    found = usual.unionByName(slim.join(F.broadcast(groups.join(heavy.drop("salts"), "digest")), "digest"))
    found = found.withColumn("class", F.lit(""))
    if not several.isEmpty():
        # Digests that several texts share: those documents are matched by text instead.
        own = rows.join(several, "digest", "left_semi")
        told = own.join(_grouped(own, heavy), ["digest", "text"]).withColumnRenamed("text", "class")
        found = found.join(several, "digest", "left_anti").unionByName(told)
    leads = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rest = found.filter(~leads).withColumn("kept", F.lit(False))
    return rest.select(*RESULT).unionByName(_one_kept(found.filter(leads)).select(*RESULT))
