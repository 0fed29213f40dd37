"""Run registered queries next to their SQL: `python tests/check_oracle.py [sf_dir] [name ...]`."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), ignore_index=True)


def difference(spark, con, sf_dir: str, name: str) -> str:
    """Empty when equal, else what differs first."""
    ours = _ordered(entry_module.queries()[name](spark, sf_dir).toPandas())
    theirs = _ordered(con.execute(entry_module.oracle_sql()[name]).fetchdf())
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} / {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for c in ours.columns:
        a, b = ours[c], theirs[c]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = int((~same).idxmax())
            return f"{(~same).sum()} rows differ in {c}: {ours.loc[at].to_dict()} / {theirs.loc[at].to_dict()}"
    return "" if len(ours) else "no rows"


if __name__ == "__main__":
    from weftmill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        master="local[8]", spark__driver__memory="16g", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    session.sparkContext.setLogLevel("OFF")
    names = sys.argv[2:] or list(entry_module.queries())
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(session, con, folder, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {found}", flush=True)
    print(f"{bad} of {len(names)} differ")
