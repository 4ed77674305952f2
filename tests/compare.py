"""Run registered queries on Spark and DuckDB and report differences.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    want = rows_of([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if [type(x) for x in a] != [type(x) for x in b] or a != b]
    if bad:
        return f"{len(bad)} of {len(want[1])} rows differ, e.g. spark {bad[0][0]} duckdb {bad[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as e
    from clickscore.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    con = duck(folder)
    queries, oracle = e.queries(), e.oracle_sql()
    assert set(oracle) <= set(queries), set(oracle) - set(queries)
    failed = 0
    for name, query in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = query(spark, folder)
            if name in oracle:
                note = difference(df, con, oracle[name])
            else:
                note = None if df.count() >= 0 else "no rows"
        except Exception as exc:  # report and go on with the next query
            note = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += note is not None
        kind = "sql " if name in oracle else "rows"
        print(f"{'ok  ' if note is None else 'FAIL'} {kind} {time.time() - t0:6.2f}s {name} {note or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
