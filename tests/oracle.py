"""Compares registered queries with their SQL in DuckDB, as bags of rows."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return db


def compare(spark, db, name, run, sql, folder):
    """(rows, seconds) if the results agree; raises AssertionError with a sample otherwise."""
    start = time.time()
    df = run(spark, folder)
    columns = sorted(df.columns)
    df = df.select(*[f"`{c}`" for c in columns])
    got = Counter(tuple(map(str, r)) for r in df.collect())
    seconds = time.time() - start
    plan = df._jdf.queryExecution().executedPlan().toString()
    for pairwise in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert pairwise not in plan, f"{name}: {pairwise}"
    if sql is None:
        return sum(got.values()), seconds
    cursor = db.execute(sql)
    assert sorted(d[0] for d in cursor.description) == columns, f"{name}: {[d[0] for d in cursor.description]} {columns}"
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    want = Counter(tuple(str(r[i]) for i in order) for r in cursor.fetchall())
    extra, lacking = got - want, want - got
    assert not extra and not lacking, (
        f"{name}: {sum(got.values())} rows, SQL {sum(want.values())}; columns {columns}\n"
        f" only Spark {sum(extra.values())}: {list(extra)[:3]}\n only SQL {sum(lacking.values())}: {list(lacking)[:3]}"
    )
    assert got, f"{name}: no rows"
    return sum(got.values()), seconds


if __name__ == "__main__":
    from idtrail.queries import QUERIES, SQL
    from idtrail.session import local_session

    folder = f"{DATA}/{sys.argv[1]}"
    names = sys.argv[2:] or list(QUERIES)
    spark, db = local_session(8, 8), database(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for n in names:
        try:
            print(n, "ok", *("%.1f" % x if isinstance(x, float) else x for x in compare(spark, db, n, QUERIES[n], SQL.get(n), folder)), flush=True)
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(n, "FAILED", type(e).__name__, str(e)[:900], flush=True)
    print("failed:", bad, "of", len(names))
