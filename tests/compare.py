"""Run registered queries beside their SQL in DuckDB and compare the rows.

    python tests/compare.py [sf dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("f", "nan" if value != value else repr(value))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, (dt.date, dt.datetime)):
        return ("t", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if got == want:
        return None
    return (f"rows {sum(got.values())} / {sum(want.values())}; only spark {list((got - want).items())[:3]}; "
            f"only sql {list((want - got).items())[:3]}")


def main() -> None:
    import __spark_entry__ as entry
    from calipers.runtime import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.001"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                    "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in args[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                verdict = compare(df, con, oracles[name]) or "same"
            else:
                verdict = f"no sql, {df.count()} rows"
        except Exception as e:  # report and go on with the next query
            verdict = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        print(f"{name}: {time.time() - start:.1f}s {verdict}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
