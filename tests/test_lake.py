from __future__ import annotations

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lendworks.catalogue.lake import JOINED, Lake
from lendworks.sizing import EXPANSION, TARGET_BYTES, tasks_for
from tests.helpers import rows

AT = datetime(1995, 2, 3)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A lake over a handful of rows of its own."""
    folder = str(tmp_path_factory.mktemp("small"))
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(n, f"N{n}", 0) for n in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"C{k}", k % 3, 100.0 * k, "AUTO") for k in range(1, 9)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(k, f"S{k}", k % 3, 10.0) for k in range(1, 5)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "orders": ([(k, 1 + (k or 0) % 8, "O", 1000.0, AT, "1-URGENT") for k in [*range(1, 20), None, 7]], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (
            [(k, k, 1 + k % 4, n, 1.0, 50.0, 0.0, 0.0, "N", "O", AT) for k in range(1, 20) for n in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
        "events": ([(k, AT, k, "x", 5.0, "") for k in range(10)], "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return Lake(spark, folder)


def _scans(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_joined_views_are_joined_once_for_all_checks_of_silver_and_raw_files(small):
    for source in JOINED:
        assert rows(small.saved[source]) == rows(small.raw[source])
        assert "Join" in _scans(small.bronze[source]) and "Join" not in _scans(small.saved_bronze[source])
        assert rows(small.standard(source, saved=True)) == rows(small.standard(source))
    assert set(small.saved_bronze) == set(small.raw) and "nothing" not in small.saved_bronze


def test_raw_files_are_compressed_and_hold_every_row_as_it_is(small):
    for source, view in small.raw.items():
        folder = small.csv_folder(source)
        assert glob.glob(f"{folder}/*.csv.gz") and not glob.glob(f"{folder}/*.csv")
        assert small.ingested(source).count() == view.count()
    assert rows(small.ingested("customers").select("gender").distinct()) == [(" m",), ("F",)]  # blanks are kept
    plain = small.csv_folder("customers", "none")
    assert glob.glob(f"{plain}/*.csv") and not glob.glob(f"{plain}/*.gz")


def test_published_gold_is_written_once(small):
    database = small.published()
    assert not glob.glob(f"{small.stage.path.removeprefix('file:')}/stamped_*")
    published = small.spark.table(f"{database}.stg_loan_default_risk_summary").drop("gold_processed_timestamp", "pipeline_layer")
    assert rows(published) == rows(small.gold.loan_default_risk_summary())
    layers = small.spark.table(f"{database}.gold_portfolio_kpis").select("pipeline_layer", F.col("gold_processed_timestamp").cast("string"))
    assert rows(layers) == [("GOLD", "2026-06-30 00:00:00")]


def test_loan_mart_is_not_saved_twice(small):
    tables = small.gold_tables()
    saved = {p.rpartition("/")[2] for p in glob.glob(f"{small.stage.path.removeprefix('file:')}/*")}
    assert {f"gold_{n}" for n in tables} - saved == {"gold_loan_default_risk_summary"} and "loan_risk" in saved


def test_tasks_follow_the_input():
    assert tasks_for(0) == 1 and tasks_for(10 * TARGET_BYTES) == 10 * EXPANSION
