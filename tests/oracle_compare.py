"""Spark result vs DuckDB oracle: same row multiset on the same columns."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    out = [tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def compare(spark_df, con, sql: str, limit_diff: int = 5) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    sc, sr = rows(s)
    dc, dr = rows(d)
    if sc != dc:
        return False, f"columns differ: spark-only={set(sc)-set(dc)} oracle-only={set(dc)-set(sc)}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} oracle={len(dr)}"
    diffs = [(a, b) for a, b in zip(sr, dr) if a != b]
    if diffs:
        return False, f"{len(diffs)} rows differ, e.g. {diffs[:limit_diff]} cols={sc}"
    return True, f"{len(sr)} rows match"
