"""Joins on keys in which NULL is a key like any other, as in a window's
PARTITION BY or a GROUP BY."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on equal or both NULL ``keys``: the keys
    once, then the other columns of both sides."""
    other = {k: f"_jk_{k}" for k in keys}
    renamed = right.withColumnsRenamed(other)
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()]
    key_cols = [(F.coalesce(k, o).alias(k) if how == "full" else F.col(k)) for k, o in other.items()]
    rest = [c for df in (left, right) for c in df.columns if c not in other]
    return left.join(renamed, same, how).select(*key_cols, *rest)
