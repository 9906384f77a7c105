"""Compare registered queries with their SQL twins; also runnable by hand.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, Decimal):
        v = float(v) if v % 1 else int(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return "NULL" if v is None else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), _rows(names, cur.fetchall())


def compare(spark, con, folder, name, fn, sql):
    """'' when equal, else what differs."""
    cols, got = spark_rows(fn(spark, folder))
    want_cols, want = duck_rows(con, sql)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if got == want:
        return "" if got else "both empty"
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows vs {len(want)}; only spark {str(extra)[:600]}; only sql {str(missing)[:600]}"


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                said = compare(spark, con, folder, name, fn, sqls[name])
            else:
                said = "no sql" if fn(spark, folder).count() else "empty"
        except Exception as e:  # report and go on with the next query
            said = f"{type(e).__name__}: {str(e)[:1200]}"
        bad += said not in ("", "no sql")
        print(f"{'ok ' if said in ('', 'no sql') else 'BAD'} {time.time() - start:6.2f}s {name} {said}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main() != 0)
