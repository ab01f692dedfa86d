"""Run queries and their SQL side by side: python -m checks.compare SF_DIR [NAME ...]"""

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(threads: str = "8") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{threads}]").appName("editflow")
    for key, value in {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(ordered, key=repr)


def compare(df: DataFrame, connection, name: str) -> tuple[str, int]:
    got = rows_of(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return "rows only", len(got[1])
    result = connection.execute(sql)
    want = rows_of([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns differ: {got[0]} / {want[0]}", len(got[1])
    if got[1] != want[1]:
        odd = [pair for pair in zip(got[1], want[1]) if pair[0] != pair[1]][:1]
        return f"rows differ: {len(got[1])} / {len(want[1])} {odd}", len(got[1])
    return "equal", len(got[1])


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, connection = session(), database(sf_dir)
    for name in names or queries():
        begun = time.perf_counter()
        try:
            outcome, size = compare(queries()[name](spark, sf_dir), connection, name)
        except Exception as error:
            outcome, size = f"failed: {type(error).__name__} {str(error)[:600]}", 0
        print(f"{name:24s} {size:7d} {time.perf_counter() - begun:6.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
