"""Side-by-side run of registered queries in Spark and of their SQL in DuckDB.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns differ: only Spark {set(df.columns) - set(columns)}, only SQL {set(columns) - set(df.columns)}"
    if mine != theirs:
        only_mine, only_theirs = mine - theirs, theirs - mine
        shown = [sorted(side, key=repr)[:2] for side in (only_mine, only_theirs)]
        return (
            f"rows {sum(mine.values())} / {sum(theirs.values())}, differing {sum(only_mine.values())}\n"
            f"  columns {sorted(columns)}\n  Spark {shown[0]}\n  SQL   {shown[1]}"
        )
    return None


def main():
    import __spark_entry__ as registry
    from tallyline.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    queries, statements = registry.queries(), registry.oracle_sql()
    failed = []
    for name in sys.argv[2:] or queries:
        if name not in statements:
            print(f"{name:24s} no SQL", flush=True)
            continue
        began = time.time()
        try:
            difference = compare(spark, con, name, queries[name], statements[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{name:24s} {'ok' if difference is None else difference} ({time.time() - began:.1f}s)", flush=True)
        if difference:
            failed.append(name)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main()
