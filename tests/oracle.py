"""Compare queries with their SQL twins: same columns, same rows, any order."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(path: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return str(value)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(plain(row[i]) for i in order) for row in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, path, name, fn, sql):
    """None when equal, else a description of the difference."""
    df = fn(spark, path)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = digest(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got[:2] == want[:2]:
        return None
    extra = [x for x in got[2] if x not in set(want[2])][:3]
    missing = [x for x in want[2] if x not in set(got[2])][:3]
    return f"rows {got[0]} vs {want[0]}; only here {extra}; only there {missing}"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    path = sys.argv[1]
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(path)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, path, name, fn, oracles[name])
            else:
                problem = None if fn(spark, path).count() >= 0 else "no rows"
        except Exception as e:  # noqa: BLE001  (report and go on)
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)
