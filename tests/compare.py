"""Compare registered queries with their SQL on the same tables, as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from verification.inputs import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def rows_of_sql(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    return names, Counter(tuple(_plain(r[p]) for p in places) for r in result.fetchall())


def main(sf_dir: str, wanted: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    registered, sql = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(registered) - set(sql)), "unknown:", sorted(set(sql) - set(registered)))
    bad = 0
    for name in wanted or registered:
        started = time.time()
        try:
            columns, got = rows_of_spark(registered[name](spark, sf_dir))
            took = time.time() - started
            if name not in sql:
                print(f"{name:28s} rows={sum(got.values())} {took:.1f}s no SQL", flush=True)
                continue
            expected_columns, expected = rows_of_sql(connection, sql[name])
            same = columns == expected_columns and got == expected
            oracle_took = time.time() - started - took
            print(f"{name:28s} rows={sum(got.values())} {took:.1f}s sql {oracle_took:.1f}s {'ok' if same else 'DIFFERS'}", flush=True)
            if not same:
                bad += 1
                print("   columns", columns, expected_columns, sum(expected.values()))
                print("   only spark", list((got - expected).items())[:3])
                print("   only sql  ", list((expected - got).items())[:3], flush=True)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} FAILED {type(error).__name__} {str(error)[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
