"""Comparison of a registered query with its SQL twin."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for row in pdf.itertuples(index=False):
        rows.append(tuple(_text(v) for v in row))
    return sorted(rows)


def _text(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "null"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v) + 0.0)
    return str(v)


def differences(spark_rows: pd.DataFrame, duck_rows: pd.DataFrame) -> list[str]:
    """What differs, first few only; empty when equal."""
    if sorted(spark_rows.columns) != sorted(duck_rows.columns):
        return [f"columns {sorted(spark_rows.columns)} against {sorted(duck_rows.columns)}"]
    ours, theirs = _canonical(spark_rows), _canonical(duck_rows)
    if ours == theirs:
        return []
    only_ours = [r for r in ours if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(ours)][:3]
    return [f"{len(ours)} rows against {len(theirs)}", f"only ours {only_ours}", f"only theirs {only_theirs}"]
