"""Compare a query with its expected result: same columns, same rows in any order."""

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _comparable(frame: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=frame.index)
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_numeric_dtype(column):
            number = column.astype("float64")
            out[name] = [None if np.isnan(v) else f"{v:.9g}" for v in number]
        else:
            out[name] = [None if pd.isna(v) else str(v) for v in column]
    out = out.astype(object).where(out.notna(), "\0")
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def differences(found: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(found.columns) != sorted(expected.columns):
        return f"columns {sorted(found.columns)} != {sorted(expected.columns)}"
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    left, right = _comparable(found), _comparable(expected)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ\n{left[unequal].head()}\n{right[unequal].head()}"
    return None
