"""Runs registered queries beside their SQL and compares names, row counts and values.

    python tests/oracle.py SF_DIR [KEY ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0 if value != 0 else 0.0)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


SAME_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, con, sql: str) -> list[str]:
    """Differences found; empty if the results are the same."""
    expected = con.execute(sql)
    names, kinds = [d[0] for d in expected.description], [str(d[1]) for d in expected.description]
    wanted = _rows(names, expected.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    types = dict(zip(names, kinds))
    for name, kind in df.dtypes:
        if SAME_TYPES.get(kind, kind) != types[name]:
            problems.append(f"type of {name}: {kind} != {types[name]}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(wanted):
        problems.append(f"rows {len(got)} != {len(wanted)}")
    elif got != wanted:
        bad = [(g, w) for g, w in zip(got, wanted) if g != w]
        problems.append(f"{len(bad)} rows differ, first {bad[0]}")
    return problems


def main(folder: str, keys: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from grainmill.session import build_session

    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(folder), oracle_sql(), 0
    for key, run in queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problems = compare(df, con, sqls[key]) if key in sqls else ([] if df.collect() else ["no rows"])
        except Exception as error:  # noqa: BLE001  (report and go on)
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        kind = "sql " if key in sqls else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {key:14} {time.time() - start:6.2f}s {'; '.join(problems)}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
