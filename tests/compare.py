"""Run registered queries beside their SQL twins: python tests/compare.py <sf dir> [name prefix ...]"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, type(v).__name__, v) for v in r))


def kinds(rows):
    """Type names per column, floats and ints told apart, so both sides hash alike."""
    if not rows:
        return []
    return [sorted({type(v).__name__ for v in col if v is not None}) for col in zip(*rows)]


def compare(spark, con, fn, sql, sf):
    """None when both sides agree, else a text that says where they do not."""
    df = fn(spark, sf)
    left_cols, left = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(left)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right_cols, right = normal(names, cur.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}", len(left)
    if len(left) != len(right):
        extra = [r for r in left if r not in set(right)][:3] if len(left) < 100_000 else []
        missing = [r for r in right if r not in set(left)][:3] if len(left) < 100_000 else []
        return f"rows {len(left)} != {len(right)}; extra {str(extra)[:600]} missing {str(missing)[:600]}", len(left)
    if left != right:
        bad = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(bad)} rows differ, first {str(bad[0])[:800]}", len(left)
    if kinds(left) != kinds(right):
        return f"types {kinds(left)} != {kinds(right)} for {left_cols}", len(left)
    return None, len(left)


def main() -> int:
    import __spark_entry__ as entry
    from ludoscope.session import build_session

    sf, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = build_session(
        "compare", f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if prefixes and not any(name.split("_")[0] == p or name.startswith(p + "_") or (p.isalpha() and name[0] == p) for p in prefixes):
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, fn, oracles.get(name), sf)
        except Exception as error:  # noqa: BLE001 - reported and counted
            text = str(error)
            problem, n = f"{type(error).__name__}: {text[:1500]}", -1
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += problem is not None
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5} {name:32} rows={n:<8} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main() and 1)
