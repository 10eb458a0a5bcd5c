"""Runs every registered query beside its SQL twin; not collected by pytest.

Usage: python tests/check_oracles.py [table folder] [query ...]
"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parents[1]), str(pathlib.Path(__file__).resolve().parent)]

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from oracle_compare import TABLES, compare  # noqa: E402
from quarterdeck.session import build_session  # noqa: E402


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "oracles", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    oracles = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = fn(spark, folder)
            outcome = compare(frame, con, oracles[name]) if name in oracles else f"rows only {frame.count()}"
        except Exception as exc:  # noqa: BLE001
            outcome = f"ERROR {type(exc).__name__}: {str(exc)[:600]}"
        print(f"{name:24s} {time.time() - start:6.1f}s {outcome}", flush=True)
        if not outcome.startswith(("ok", "rows only")):
            failed.append(name)
    print("failed:", failed)


main()
