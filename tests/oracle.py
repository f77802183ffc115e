"""Compare a query's rows with those of its SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.sql(f"create view {name} as select * from read_parquet('{path}')")
    return db


def _tidy(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]")
        elif str(frame[name].dtype) == "Int64":
            # Whole numbers with nulls: one side has them as floats with gaps.
            frame[name] = frame[name].astype("float64" if frame[name].isna().any() else "int64")
        elif frame[name].dtype == object or str(frame[name].dtype).startswith("str"):
            frame[name] = frame[name].astype(object).where(frame[name].notna(), None)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def assert_same(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> None:
    """Equal columns, types, rows and values, to the last bit, in any order."""
    left, right = _tidy(spark_rows), _tidy(sql_rows)
    assert list(left.columns) == list(right.columns)
    assert len(left) == len(right), f"{len(left)} rows, SQL has {len(right)}"
    pd.testing.assert_frame_equal(left, right, check_exact=True)
