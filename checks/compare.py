"""Run registered queries and their SQL side by side: python -m checks.compare [sf_dir] [names...]"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, run, sql, sf_dir):
    """(rows, differences): differences is empty when columns and all rows agree."""
    df = run(spark, sf_dir)
    got = _sorted(df.columns, df.collect())
    result = connection.sql(sql)
    want = _sorted(result.columns, result.fetchall())
    if got[0] != want[0]:
        return len(got[1]), [("columns", got[0], want[0])]
    if len(got[1]) != len(want[1]):
        return len(got[1]), [("rows", len(got[1]), len(want[1]))]
    return len(got[1]), [(a, b) for a, b in zip(got[1], want[1]) if repr(a) != repr(b)]


def main(sf_dir="/root/testdata/sf0.01", *names):
    from pyspark.sql import SparkSession

    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLE:
                rows, differences = compare(spark, connection, QUERIES[name], ORACLE[name], sf_dir)
            else:
                rows, differences = QUERIES[name](spark, sf_dir).count(), []
        except Exception as error:
            rows, differences = 0, [str(error)[:1500]]
        bad += bool(differences)
        verdict = f"DIFFERS ({len(differences)})" if differences else "ok" if name in ORACLE else "rows only"
        print(f"{name:28} {rows:8} rows {time.time() - start:6.2f}s  {verdict}", flush=True)
        for d in differences[:2]:
            print("   ", d)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
