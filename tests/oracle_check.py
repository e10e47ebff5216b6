"""Run every registered query against its SQL oracle: python tests/oracle_check.py SF_DIR [names].

HOT_SHARE=0.0001 lists every key above that share as heavy; by default it is the share of a shuffle task.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def normal(table) -> list[tuple]:
    """Rows with columns in name order and exact values, sorted."""
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(r) for r in zip(*columns)), key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both sides hold the same columns and rows, else what differs."""
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(set(got.column_names) ^ set(want.column_names))}"
    kinds = [
        (n, str(got.schema.field(n).type), str(want.schema.field(n).type))
        for n in got.column_names
        if got.schema.field(n).type != want.schema.field(n).type
    ]
    a, b = normal(got), normal(want)
    if a != b:
        odd = [x for x in zip(a, b) if x[0] != x[1]][:2]
        return f"rows {len(a)} vs {len(b)}, types {kinds}, first differences {odd}"
    return f"types {kinds}" if kinds else None


def main() -> None:
    import __spark_entry__ as e
    from lendworks.operators import skew
    from tests.conftest import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    if "HOT_SHARE" in os.environ:
        skew.heavy_keys.__defaults__ = (float(os.environ["HOT_SHARE"]),)
    spark, con = build_session(), duck(sf_dir)
    oracles = e.oracle_sql()
    bad = 0
    for name, run in e.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            if name in oracles:
                problem = differences(run(spark, sf_dir), con, oracles[name])
            else:
                problem = f"no oracle, {run(spark, sf_dir).count()} rows"
        except Exception as x:  # report and go on with the next query
            problem = f"{type(x).__name__}: {str(x)[:600]}"
        bad += problem is not None
        print(f"{name:36s} {time.time() - t:6.2f}s {problem or 'ok'}", flush=True)
    print("problems:", bad, "missing queries:", sorted(set(oracles) - set(e.queries())))


if __name__ == "__main__":
    main()
