"""Compare registered queries with their SQL form in DuckDB. Also a script: python tests/oracle.py [names]."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def difference(df, con, sql: str) -> str | None:
    """None when rows and columns agree exactly, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    got = [tuple(_plain(r[c]) for c in order) for r in df.collect()]
    want = [tuple(_plain(r[names.index(c)]) for c in order) for r in expected]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "no rows on either side"
    got.sort(key=repr)
    want.sort(key=repr)
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        only_got, only_want = sorted(set(got) - set(want), key=repr), sorted(set(want) - set(got), key=repr)
        return f"{len(only_got)} of {len(got)} rows differ in {order}, e.g.\n  {only_got[:2]}\n  {only_want[:2]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as spark_entry
    from tickloom.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("SLICES"):
        spark.conf.set("spark.sql.shuffle.partitions", os.environ["SLICES"])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    con, sql = connect(sf_dir), spark_entry.oracle_sql()
    bad = 0
    for name, run in spark_entry.queries().items():
        if sys.argv[1:] and not any(a in name for a in sys.argv[1:]):
            continue
        start = time.time()
        try:
            found = difference(run(spark, sf_dir), con, sql[name]) if name in sql else f"rows only: {run(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found) and not str(found).startswith("rows only")
        print(f"{'ok  ' if found is None else 'FAIL'} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} wrong")
