"""Compares registered queries with their SQL on DuckDB.

``python tests/compare.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if hasattr(value, "tzinfo"):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is not None, v) for v in row),
    )


def differences(spark, con, folder: str, query, sql: str) -> str | None:
    """None when both give the same columns and the same rows."""
    df = query(spark, folder)
    found = df.collect()
    wanted = con.execute(sql)
    names = [c[0] for c in wanted.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    ours, theirs = _rows(df.columns, found), _rows(names, wanted.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows instead of {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from hotrank.session import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        began = time.time()
        try:
            problem = differences(spark, con, folder, queries()[name], oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"RESULT {name}: {problem or 'equal'} ({time.time() - began:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
