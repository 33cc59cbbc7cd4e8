"""Compare a Spark result with DuckDB on the same tables, ignoring row order."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def oracle(sql: str, sf_dir: str = SF_DIR) -> pd.DataFrame:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection.sql(sql).df()


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text with a NULL mark, rows sorted."""
    texts = {}
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.dt.strftime("%Y-%m-%d")
        if pd.api.types.is_float_dtype(column):
            column = column.astype("Int64")
        texts[name] = ["<null>" if pd.isna(v) else str(v) for v in column]
    return pd.DataFrame(texts).sort_values(sorted(texts)).reset_index(drop=True)


def assert_same(result: DataFrame, sql: str, sf_dir: str = SF_DIR) -> None:
    got, want = canonical(result.toPandas()), canonical(oracle(sql, sf_dir))
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert len(want) > 0
    pd.testing.assert_frame_equal(got, want)
