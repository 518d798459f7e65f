"""Run registered queries and their SQL counterparts side by side: `python tests/compare.py [name …]`."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return round(float(value), 6) + 0.0
    return str(value)


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_frame, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    left_columns, left = normalised(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    cursor = con.execute(sql)
    right_columns, right = normalised([c[0] for c in cursor.description], cursor.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} != {right_columns}"
    if len(left) != len(right):
        ours, theirs = set(left), set(right)
        missing = [r for r in right if r not in ours][:2]
        extra = [r for r in left if r not in theirs][:2]
        return f"rows {len(left)} != {len(right)}; only sql {str(missing)[:400]}; only spark {str(extra)[:400]}"
    if left != right:
        bad = [(a, b) for a, b in zip(left, right) if a != b]
        return f"{len(bad)} rows differ, e.g. {str(bad[0][0])[:500]} != {str(bad[0][1])[:500]}"
    return None


def main() -> None:
    import __spark_entry__ as contract
    from murmuro.runtime import session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracle = contract.queries(), contract.oracle_sql()
    names = sys.argv[1:] or list(queries)
    failed = []
    for name in names:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in oracle:
                problem = difference(frame, con, oracle[name])
                word = "ok" if problem is None else "DIFF"
            else:
                rows, problem, word = frame.collect(), None, "rows"
                word = f"rows={len(rows)}"
                if os.environ.get("SHOW"):
                    print(rows[:8])
        except Exception as error:
            problem, word = f"{type(error).__name__}: {str(error)[:1500]}", "ERROR"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{word:8} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
