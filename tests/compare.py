"""Order-insensitive comparison of a Spark result with DuckDB's answer."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    keys = frame.map(lambda v: "" if v is None else repr(v) if not isinstance(v, float) else f"{v:.9g}")
    order = keys.sort_values(list(keys.columns)).index
    return keys.loc[order].reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(oracle_frame.columns)}"
    if len(spark_frame) != len(oracle_frame):
        return f"rows {len(spark_frame)} != {len(oracle_frame)}"
    kinds = {c: (spark_frame[c].dtype.kind, oracle_frame[c].dtype.kind) for c in spark_frame.columns}
    wrong = {c: k for c, k in kinds.items() if k[0] != k[1] and len(spark_frame)}
    if wrong:
        return f"types {wrong}"
    left, right = _normal(spark_frame), _normal(oracle_frame)
    if not left.equals(right):
        rows = (left != right).any(axis=1)
        return f"{int(rows.sum())} rows differ:\n{left[rows].head(3)}\n{right[rows].head(3)}"
    return None
