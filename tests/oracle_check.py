"""Run registered queries next to their SQL in DuckDB: ``python tests/oracle_check.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    """Comparable form of a cell."""
    if value is None or isinstance(value, (str, bool)):
        return value
    number = float(value)
    return "nan" if math.isnan(number) else number + 0.0


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, sql: str) -> str | None:
    """None when columns and all rows agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got_names, got = rows_of(df.columns, df.collect())
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    want_names, want = rows_of(names, relation.fetchall())
    if got_names != want_names:
        return f"columns {got_names} against {want_names}"
    if got != want:
        extra, missing = sorted(set(got) - set(want), key=repr), sorted(set(want) - set(got), key=repr)
        return f"rows {len(got)} against {len(want)}; only here {len(extra)} {extra[:3]}; only in SQL {len(missing)} {missing[:3]}"
    return None


if __name__ == "__main__":
    from lexigrade.session import build_session

    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    con, oracles = connect(sf_dir), entry.oracle_sql()
    bad = []
    for name in wanted or entry.queries():
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, name, oracles[name])
            else:
                problem = None
                n = len(entry.queries()[name](spark, sf_dir).collect())
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        state = "DIFF " + problem if problem else ("ok" if name in oracles else f"rows {n}")
        bad += [name] if problem else []
        print(f"{name:22s} {time.time() - start:6.1f}s {state}", flush=True)
    print("differing:", bad)
