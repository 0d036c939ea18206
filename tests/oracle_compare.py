"""Run a query in Spark and its counterpart in DuckDB, and compare all rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return db


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    values = frame.astype(object).where(frame.notna(), None)
    return sorted((tuple(map(_plain, row)) for row in values.itertuples(index=False)), key=repr)


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def difference(spark_rows: pd.DataFrame, oracle_rows: pd.DataFrame) -> str:
    """What differs, or an empty text."""
    if sorted(spark_rows.columns) != sorted(oracle_rows.columns):
        return f"columns {sorted(spark_rows.columns)} against {sorted(oracle_rows.columns)}"
    if len(spark_rows) != len(oracle_rows):
        return f"{len(spark_rows)} rows against {len(oracle_rows)}"
    for ours, theirs in zip(_rows(spark_rows), _rows(oracle_rows)):
        if ours != theirs:
            return f"{ours} against {theirs}"
    return ""
