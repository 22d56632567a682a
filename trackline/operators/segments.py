"""Gaps-and-islands: number the segments of an ordered series.

A row starts a new segment when ``starts`` is true; the segment number is
the running count of starts (``SUM(flag) ROWS UNBOUNDED PRECEDING``), so
the first row of each key always opens segment 1 when ``starts`` holds
for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str,
                    starts: Column, out: str, flag: str | None = None,
                    strategy: str = "split", bucket: str | None = None) -> DataFrame:
    """Add ``out`` (bigint segment number) and, if ``flag`` is given, the
    0/1 start flag itself.  With a single integer order column the running
    sum goes through :func:`~trackline.operators.ordered.ordered_window`
    (a hot key is split); several order columns use one window per key."""
    from trackline.operators.ordered import ordered_window

    order = [order] if isinstance(order, str) else list(order)
    f = F.when(starts, F.lit(1)).otherwise(F.lit(0))
    tmp = flag or "_seg_flag"
    res = df.withColumn(tmp, f)
    if len(order) == 1:
        res = ordered_window(res, keys, order[0], running_sum=[(tmp, "_seg_sum")], strategy=strategy, bucket=bucket)
        res = res.withColumn(out, F.col("_seg_sum").cast("bigint")).drop("_seg_sum")
    else:
        w = Window.partitionBy(*keys).orderBy(*order)
        res = res.withColumn(out, F.sum(tmp).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"))
    return res if flag else res.drop(tmp)
