"""Run registered queries next to their SQL in DuckDB and report differences."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(query, spark, sf_dir):
    df = query(spark, sf_dir)
    return rows_of(df.columns, df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def difference(ours, theirs):
    """None when equal, else a short description."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    left, right = set(map(repr, ours[1])), set(map(repr, theirs[1]))
    return (
        f"{len(ours[1])} rows against {len(theirs[1])}; "
        f"only here {[r[:300] for r in sorted(left - right)[:3]]}; "
        f"only SQL {[r[:300] for r in sorted(right - left)[:3]]}"
    )


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    from rankloom.workload import oracle_sql, queries

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connection(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            ours = spark_rows(query, spark, sf_dir)
            spent = time.time() - start
            start = time.time()
            problem = difference(ours, sql_rows(con, sqls[name])) if name in sqls else "no SQL"
            print(
                f"{name:28s} {len(ours[1]):8d} rows {spent:6.1f}s sql {time.time() - start:5.1f}s "
                f"{'OK' if problem is None else problem}",
                flush=True,
            )
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = str(error)
            print(f"{name:28s} ERROR {type(error).__name__} {problem[:700]}", flush=True)
        bad += problem is not None and problem != "no SQL"
    print("different:", bad)


if __name__ == "__main__":
    main()
