"""Compares a registered query with its SQL on the same Parquet tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def normalised(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns in name order, missing values as None."""

    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return None
        if isinstance(value, (pd.Timestamp,)):
            return value.isoformat()
        if hasattr(value, "item"):
            value = value.item()
        return value.isoformat() if hasattr(value, "isoformat") else value

    columns = sorted(frame.columns)
    rows = [tuple(cell(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)
