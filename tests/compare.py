"""Run registered queries beside their SQL and compare rows as bags.

Usage: python -m tests.compare [--sf 0.01] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    mine = spark_df.collect()
    cursor = con.execute(sql)
    theirs_columns = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(theirs_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(theirs_columns)}"
    a, b = bag(mine, spark_df.columns), bag(theirs, theirs_columns)
    if a == b:
        return None
    return f"{len(mine)} rows vs {len(theirs)}; only spark {list((a - b).items())[:2]}; only sql {list((b - a).items())[:2]}"


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for key in argv or queries:
        start = time.time()
        try:
            df = queries[key](spark, sf_dir)
            if key in oracles:
                diff = differences(df, con, oracles[key])
                rows = df.count() if diff is None and len(argv) else ""
            else:
                rows, diff = df.count(), None
        except Exception as error:
            diff, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {key} {rows} {time.time() - start:.1f}s {'' if key in oracles else '(rows only)'} {(diff or '')[:3000]}", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
