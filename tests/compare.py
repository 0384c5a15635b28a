"""Run registered queries beside their SQL in DuckDB and report differences.

    python -m tests.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import time

import duckdb
import numpy as np
import pandas as pd

import __spark_entry__ as entry
from seqtables.session import local_session


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(f).removesuffix(".parquet")
        f = f"{f}/*.parquet" if os.path.isdir(f) else f
        con.execute(f"create view {name} as select * from read_parquet('{f}')")
    return con


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    for ours, theirs in (("varchar", "string"), ("integer", "int"), ("timestamp_ntz", "timestamp"), ("hugeint", "bigint")):
        dtype = theirs if dtype == ours else dtype
    return dtype


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    clean = lambda v: None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)) else \
        (float(v) if isinstance(v, (int, float, np.integer, np.floating)) and not isinstance(v, (bool, np.bool_)) else str(v))
    return sorted((tuple(clean(v) for v in row) for row in frame.itertuples(index=False)), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'' when the results agree, else what differs."""
    got = entry.queries()[name](spark, sf_dir)
    types = {c.lower(): _kind(t) for c, t in got.dtypes}
    want = con.sql(entry.oracle_sql()[name])
    want_types = {c.lower(): _kind(str(t)) for c, t in zip(want.columns, want.types)}
    if [c for c in sorted(got.columns)] != sorted(want.columns):
        return f"columns {sorted(got.columns)} <> {sorted(want.columns)}"
    if types != want_types:
        return f"types { {c: (types[c], want_types[c]) for c in types if types[c] != want_types[c]} }"
    a, b = _rows(got.toPandas()), _rows(want.df())
    if len(a) != len(b):
        return f"rows {len(a)} <> {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark, con = local_session(), connection(opts.sf)
    for name in opts.names or entry.queries():
        start = time.time()
        if name not in entry.oracle_sql():
            print(f"{name}: rows only, {entry.queries()[name](spark, opts.sf).count()} rows")
            continue
        try:
            diff = compare(spark, con, name, opts.sf)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{name}: {'ok' if not diff else diff}  ({time.time() - start:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
