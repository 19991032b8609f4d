"""Runs registered queries and their SQL side by side and compares rows as sorted values."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float, decimal.Decimal)):
        return (2, f"{float(value):.6f}")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return (3, value.isoformat())
    return (4, str(value))


def normalized(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return normalized(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    return normalized([d[0] for d in cursor.description], cursor.fetchall())


def main(root: str, names: list[str]) -> int:
    import __spark_entry__ as spark_entry
    from tillwright.session import build_session

    spark = build_session(master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(root), spark_entry.oracle_sql(), 0
    for name, run in spark_entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = spark_rows(run(spark, root))
            seconds, start = time.time() - start, time.time()
            want = sql_rows(con, sqls[name]) if name in sqls else None
            status = "no sql" if want is None else "ok" if got == want else "DIFFERS"
            print(f"{status:8} {name:34} rows={len(got[1]):7} spark={seconds:6.2f}s sql={time.time() - start:5.2f}s",
                  flush=True)
            if status == "DIFFERS":
                bad += 1
                print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
                for a, b in [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]:
                    print("   spark", a, "\n   sql  ", b)
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"FAILED   {name}: {str(error)[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
