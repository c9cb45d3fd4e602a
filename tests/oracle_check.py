"""Runs registered queries next to their SQL and compares the rows.

``python tests/oracle_check.py sf0.01 [query ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def database(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, Counter(tuple(_plain(row[c]) for c in columns) for row in df.collect())


def duckdb_rows(con, sql):
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())


def kinds(df, con, sql):
    """Column types that differ in family between the two results."""
    spark_kinds = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    described = {row[0]: row[1].lower() for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    same = {"string": "varchar", "int": "integer"}
    return {
        name: (kind, described.get(name))
        for name, kind in spark_kinds.items()
        if same.get(kind, kind) != described.get(name)
    }


def main() -> int:
    import __spark_entry__ as entry
    from subtide import build_session

    sf_dir = f"{TESTDATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session(master="local[8]", spark_ui_enabled="false", spark_ui_showConsoleProgress="false", spark_sql_shuffle_partitions="8",
                          spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            columns, got = spark_rows(df)
            took = time.time() - start
            names, want = duckdb_rows(con, oracle[name])
            ok = columns == names and got == want
            note = kinds(df, con, oracle[name])
            print(f"{'ok  ' if ok else 'BAD '} {name} rows={sum(got.values())} {took:.1f}s {note or ''}", flush=True)
            if not ok:
                bad += 1
                print("   columns", set(columns) ^ set(names), "want rows", sum(want.values()))
                print("   extra  ", list((got - want).items())[:3])
                print("   missing", list((want - got).items())[:3], flush=True)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {str(error)[:600]}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
