"""Run registered queries against their SQL text and report differences.

    python tools/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from wattloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].copy()
    for name in out.columns:
        kind = out[name].dtype
        if str(kind).startswith("datetime"):
            out[name] = out[name].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(kind):
            out[name] = out[name].map(lambda v: "None" if pd.isna(v) else repr(float(v) + 0.0))
        else:
            out[name] = out[name].map(lambda v: "None" if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)) else str(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> str:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return f"rows {len(spark_df)} != {len(oracle_df)}"
    a, b = normal(spark_df), normal(oracle_df)
    if a.equals(b):
        return "ok"
    bad = (a != b).any(axis=1)
    first = bad.idxmax()
    return f"values differ in {bad.sum()} rows, e.g.\n{a.loc[first].to_dict()}\n{b.loc[first].to_dict()}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from wattloom.registry import ORACLE, QUERIES

    folder = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(args.cpus), connect(folder)
    failed = []
    for name in args.names or list(QUERIES):
        try:
            t0 = time.time()
            df = QUERIES[name](spark, folder)
            got = df.toPandas()
            t1 = time.time()
            if name not in ORACLE:
                print(f"{name:32s} rows-only {len(got)} rows  spark {t1 - t0:.2f}s")
                continue
            want = con.execute(ORACLE[name]).df()
            t2 = time.time()
            verdict = compare(got, want)
            kinds = dict(con.execute("DESCRIBE " + ORACLE[name]).fetchall() and [(r[0], r[1]) for r in con.execute("DESCRIBE " + ORACLE[name]).fetchall()])
            print(f"{name:32s} {verdict}  {len(got)} rows  spark {t1 - t0:.2f}s duckdb {t2 - t1:.2f}s")
            simple = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}
            odd = {f.name: (f.dataType.simpleString(), kinds.get(f.name)) for f in df.schema.fields if simple.get(f.dataType.simpleString()) != kinds.get(f.name)}
            if odd:
                print("    types:", odd)
            if verdict != "ok":
                failed.append(name)
        except Exception as error:  # report and go on with the next query
            failed.append(name)
            print(f"{name:32s} ERROR {str(error)[:1500]}")
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
