"""Run queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    listed = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(listed, key=lambda r: [(v is None, str(v)) for v in r])


def compare(spark, con, name, folder, queries, oracles):
    """(ok, message, seconds) of one query."""
    began = time.time()
    df = queries[name](spark, folder)
    got_cols, got = rows_of(df.columns, df.collect())
    spent = time.time() - began
    if name not in oracles:
        return True, f"rows only: {len(got)}", spent
    cursor = con.execute(oracles[name])
    want_cols, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return False, f"columns differ: spark {set(got_cols) - set(want_cols)}, sql {set(want_cols) - set(got_cols)}", spent
    if len(got) != len(want):
        return False, f"{len(got)} rows, expected {len(want)}", spent
    for a, b in zip(got, want):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(got_cols, a, b) if x != y]
            return False, f"first difference {bad}", spent
    return True, f"{len(got)} rows", spent


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from fieldtide.session import spark_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = spark_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, q, o = duck(folder), queries(), oracle_sql()
    failed = []
    for name in names or q:
        try:
            ok, message, spent = compare(spark, con, name, folder, q, o)
        except Exception as error:  # noqa: BLE001
            ok, message, spent = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {spent:6.2f}s {message}", flush=True)
    print(f"{len(failed)} failed of {len(names or q)}: {failed}")


if __name__ == "__main__":
    main()
