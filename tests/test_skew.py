from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lendworks import sizing
from lendworks.operators.skew import flag_duplicates, heavy_keys, is_any_of, lookup_join, missing_rows
from tests.helpers import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows over 6 tasks: a third one exact copy, a sixth with no key, the rest ordinary."""
    n = F.col("id")
    key = (
        F.when(n % 3 == 0, F.lit("hot"))
        .when(n % 6 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), (n % 700).cast("string")))
    )
    version = F.when(n % 3 == 0, F.lit(7)).otherwise(n % 11)
    return spark.range(0, 3000, 1, 6).select(key.alias("k"), version.alias("v"))


def test_heavy_keys_finds_the_large_groups_only(skewed):
    assert set(heavy_keys(skewed, ["k"], share=0.01)["k"]) == {"hot", None}
    # By default the share of one of the session's eight shuffle tasks.
    assert set(heavy_keys(skewed, ["k"])["k"]) == {"hot", None}
    assert heavy_keys(skewed.filter("k <> 'hot' OR k IS NULL"), ["k"]) == {"k": [None]}
    assert heavy_keys(skewed, []) == {}


def test_every_key_above_a_tasks_share_is_found(spark):
    df = spark.range(40_000).selectExpr("CASE WHEN id % 4 = 0 THEN id ELSE id % 90 END AS k").selectExpr("CAST(k AS STRING) AS k")
    found = heavy_keys(df, ["k"], share=0.002)["k"]
    counts = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert set(found) == {k for k, n in counts.items() if n >= 0.002 * 40_000}


def test_heavy_keys_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k string")
    assert heavy_keys(empty, ["k"]) == {"k": []}


def test_membership_is_null_safe(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    picked = lambda values: [r[0] for r in df.filter(is_any_of(F.col("k"), values)).collect()]
    assert picked(["a", None]) == ["a", None]
    assert picked(["a"]) == ["a"]
    assert picked([]) == []
    assert df.filter(~is_any_of(F.col("k"), ["a"])).count() == 2


@pytest.mark.parametrize("hot", [["hot"], ["hot", None], ["k1", "absent"], [None]])
def test_hot_keys_do_not_change_which_rows_are_duplicates(skewed, hot):
    order = [F.col("v").desc()]
    plain = flag_duplicates(skewed, "k", order, "dup")
    spread = flag_duplicates(skewed, "k", order, "dup", hot)
    assert rows(spread) == rows(plain)
    survivors = spread.filter("not dup").groupBy("k").count()
    assert survivors.filter("count != 1").count() == 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_heavy_keys_cross_one_shuffle(spark, tmp_path, skewed):
    skewed.write.parquet(str(tmp_path / "feed"))
    stored = spark.read.parquet(str(tmp_path / "feed"))
    flagged = flag_duplicates(stored, "k", [F.col("v").desc()], "dup", ["hot"])
    plan = plan_of(flagged)
    assert "WindowGroupLimit" in plan and "partial_count" in plan and "_salt" not in plan
    # Rows of the feed are dealt once, ordinary ones by key, listed ones by content and merged map-side before.
    by_key = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(k#\d+, \d+\)", line)]
    assert len(by_key) == 3  # ordinary rows, and a row a task of the listed key, for single and for split copies
    assert rows(flagged) == rows(flag_duplicates(stored, "k", [F.col("v").desc()], "dup"))


@pytest.mark.parametrize("copies", [1, 7, 8, 9, 300])
def test_many_identical_copies_leave_one_survivor(spark, monkeypatch, copies):
    from lendworks.operators import skew

    monkeypatch.setattr(skew, "COPIES", 8)
    same = spark.range(0, copies, 1, 3).selectExpr("'hot' AS k", "5 AS v")
    other = spark.createDataFrame([("hot", 4), ("hot", 4), ("b", 1), (None, 2), (None, 2)], "k string, v int")
    df = same.unionByName(other)
    for hot in (["hot"], ["hot", None]):
        flagged = flag_duplicates(df, "k", [F.col("v").desc()], "dup", hot)
        assert flagged.count() == copies + 5
        assert rows(flagged.filter("NOT dup")) == rows(spark.createDataFrame([("hot", 5, False), ("b", 1, False), (None, 2, False)], flagged.schema))
        assert flagged.filter("dup AND k = 'hot' AND v = 5").count() == copies - 1


def test_very_many_copies_are_written_out_by_several_tasks(spark, monkeypatch):
    from lendworks.operators import skew

    monkeypatch.setattr(skew, "COPIES", 8)
    same = spark.range(0, 400, 1, 3).selectExpr("'hot' AS k", "5 AS v")
    flagged = flag_duplicates(same, "k", [F.col("v").desc()], "dup", ["hot"])
    per_task = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 400 and max(per_task) <= 200


def test_long_lists_travel_as_a_broadcast(spark, skewed, monkeypatch):
    from lendworks.operators import skew

    plain = flag_duplicates(skewed, "k", [F.col("v").desc()], "dup")
    lookup = skewed.select("k").distinct().filter("k is not null").withColumn("name", F.concat(F.lit("n-"), "k"))
    monkeypatch.setattr(skew, "LITERALS", 1)
    spread = flag_duplicates(skewed, "k", [F.col("v").desc()], "dup", ["hot", None, "k1"])
    assert rows(spread) == rows(plain) and " IN (" not in plan_of(spread)
    assert rows(lookup_join(skewed, lookup, "k", ["hot", None, "k1"])) == rows(skewed.join(lookup, "k", "left"))


@pytest.mark.parametrize("hot", [[], ["hot"], ["hot", None], ["absent"]])
def test_missing_rows_by_anti_joins(skewed, hot):
    known = skewed.select("k").distinct().filter("k is not null and k not in ('k5', 'k7')")
    for parents in (known, known.filter("k <> 'hot'")):
        found = missing_rows(skewed, parents, "k", hot)
        plan = plan_of(found)
        # Where no listed key can be known, the optimiser drops their join.
        assert plan.count("LeftAnti") >= 1 and "LeftOuter" not in plan
        if parents is known:
            assert plan.count("LeftAnti") == (2 if hot else 1)
        assert rows(found) == rows(skewed.join(parents, "k", "left_anti"))


def test_hot_rows_pass_the_shuffle_of_a_lookup_by(spark, tmp_path, skewed):
    skewed.write.parquet(str(tmp_path / "feed"))
    stored = spark.read.parquet(str(tmp_path / "feed"))
    lookup = stored.select("k").distinct().withColumn("name", F.lit("x"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(lookup_join(stored, lookup, "k", ["hot"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    hot_side = plan.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "SortMergeJoin" in plan and "Exchange" not in hot_side and "FileScan" in hot_side


def test_a_lookup_of_heavy_keys_reaches_the_scan_and_stays_bounded(spark, skewed, tmp_path):
    lookup = skewed.selectExpr("k", "concat('n-', k) AS name").distinct()
    lookup.union(lookup).write.parquet(str(tmp_path / "lookup"))
    stored = spark.read.parquet(str(tmp_path / "lookup"))
    joined = lookup_join(skewed.filter("k = 'hot'"), stored, "k", ["hot"])
    assert "In(k, [hot])" in joined._jdf.queryExecution().toString() or "EqualTo(k,hot)" in joined._jdf.queryExecution().toString()
    assert joined.count() == 1000  # a key that is listed twice in the lookup multiplies nothing


@pytest.mark.parametrize("hot", [[], ["hot"], ["hot", None], ["k1", "absent"]])
def test_lookup_join_keeps_every_row_once(spark, skewed, hot):
    lookup = skewed.select("k").distinct().filter("k is not null and k != 'k5'")
    lookup = lookup.withColumn("name", F.concat(F.lit("n-"), "k"))
    got = lookup_join(skewed, lookup, "k", hot)
    assert got.columns == ["k", "v", "name"]
    assert rows(got) == rows(skewed.join(lookup, "k", "left"))


def test_heavy_rows_of_a_lookup_are_broadcast_and_spread(spark, skewed):
    lookup = skewed.select("k").distinct().withColumn("name", F.col("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(skewed, lookup, "k", ["hot"])
        per_task = joined.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("k") == "hot"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        shares = [r[1] for r in per_task.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert sum(shares) == 1000 and max(shares) < 1000


def test_each_run_is_sized_by_its_input(spark):
    def width(size):
        sizing.size_session(spark, size)
        return sizing.shuffle_width(spark)

    scans = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        assert width(10 * 2**20) == 8
        assert width(64 * 2**30) == 2048
        assert width(100 * 2**40) == 100 * 2**40 * sizing.EXPANSION // sizing.TARGET_BYTES
        assert width(64 * 2**30) == 2048
        assert width(10 * 2**20) == 8 and spark.conf.get(sizing.INITIAL, None) is None
        spark.conf.set(sizing.INITIAL, 500)  # the user's own
        assert width(64 * 2**30) == 500
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == scans
    finally:
        spark.conf.unset(sizing.INITIAL)
        spark.conf.unset(sizing.WRITERS)
    assert sizing.stored_bytes(spark, ["/nonexistent"]) == 0
