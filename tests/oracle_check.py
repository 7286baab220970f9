"""Compare registered queries with their SQL on DuckDB.

Rows are compared as multisets, columns by name. Run as a script for a report:
``python tests/oracle_check.py [folder] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    con.execute(sql)
    names = [d[0] for d in con.description]
    types = {d[0]: str(d[1]) for d in con.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
    }
    for name, kind in df.dtypes:
        if kinds.get(kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    want = _rows(names, con.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return None
    return (f"rows {sum(got.values())} != {sum(want.values())}; "
            f"extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}")


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    plans, sqls = queries(), oracle_sql()
    for name in sys.argv[2:] or plans:
        start = time.time()
        try:
            problem = compare(plans[name](spark, folder), con, sqls[name])
        except Exception as err:  # report and go on
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f} s  {problem or 'equal'}", flush=True)
    spark.stop()
