"""Runs a registered query and its SQL twin and compares the row sets.

`python tests/oracle.py [--sf DIR] [names...]` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import pandas as pd

DATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(frame, columns):
    values = []
    for row in frame[columns].itertuples(index=False, name=None):
        values.append(tuple("NULL" if pd.isna(v) else _text(v) for v in row))
    return sorted(values)


def _text(value) -> str:
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    return str(value)


def compare(got, want) -> str:
    """Empty when both frames hold the same rows."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    columns = sorted(got.columns)
    a, b = _rows(got, columns), _rows(want, columns)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"{len(diff)} rows differ, first: {str(diff[0])[:600]}"
    kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in columns if got[c].dtype != want[c].dtype and not got[c].isna().all()]
    if kinds and len(got):
        return f"types {kinds}"
    return ""


def check(spark, con, name, queries, sql, sf_dir):
    start = time.time()
    got = queries[name](spark, sf_dir).toPandas()
    took = time.time() - start
    if name not in sql:
        return took, len(got), "rows only"
    start = time.time()
    want = con.execute(sql[name]).df()
    if time.time() - start > 5:
        print(f"     SQL took {time.time() - start:.1f}s", flush=True)
    return took, len(got), compare(got, want)


def main():
    import __spark_entry__ as entry
    from presslens.session import build_session

    args = sys.argv[1:]
    sf_dir = f"{DATA}/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    names = list(queries)
    if args[:1] == ["--from"]:
        names, args = names[names.index(args[1]) :], []
    for name in args or names:
        try:
            took, n, problem = check(spark, con, name, queries, sql, sf_dir)
        except Exception as error:
            took, n, problem = -1, -1, f"{type(error).__name__}: {str(error)[:700]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem not in ("", "rows only")
        print(f"{'ok  ' if not problem else problem[:4] if problem == 'rows only' else 'FAIL'} {took:6.2f}s {n:8d} {name} {problem}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
