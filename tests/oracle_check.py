"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf_dir] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(type(v)), v) for v in r])


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when Spark and SQL agree in columns, types as Python sees them, and values."""
    df = queries()[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    want = _rows(columns, result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{got[0]}: {a} != {b}"
    return None


def main() -> int:
    from tidewater.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or queries():
        started = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
