"""Ordered per-key windows that do not need a whole key in one task.

``ordered_window`` computes, per ``keys`` and in ``order`` (an integer such
as the lap number), any of: LAG by 1 or 2 rows, LEAD by 1 row, running SUM
(ROWS frame), running MIN (RANGE frame: peers included), ROW_NUMBER and the
AVG over the current and up to two preceding rows.

The order axis of each key is cut into equi-depth buckets (``depth.py``);
the windows run per (key, bucket); a per-bucket summary (row count, sum,
min, first and last two values) is carried across buckets with a window over
the summaries (one row per bucket, tiny) and joined back on (key, bucket), by a
broadcast when their counted number allows.  A key without cuts is one bucket
and needs no summary.  It is one exact form at
every size; ``strategy='plain'`` (one window partition per key) is the
definition, which tests compare with.  As in SQL, rows that tie on ``order``
have no defined order among themselves for LAG / LEAD / ROW_NUMBER.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.operators.asof import per_key_side
from trackline.operators.depth import CUTS, bucket_of, cuts_size, depth_cuts
from trackline.operators.keys import join_keys

_BUCKET, _RN, _N = "_ow_b", "_ow_rn", "_ow_n"
# metadata of a bucket column
BUCKETS, KEYS = "trackline.buckets", "trackline.keys"


def _sum3(parts: list[Column]) -> tuple[Column, Column]:
    """(sum of the non-null parts, their count); parts in frame order."""
    s, n = None, None
    for p in parts:
        term = F.coalesce(p, F.lit(0.0))
        one = F.when(p.isNotNull(), F.lit(1)).otherwise(F.lit(0))
        s = term if s is None else s + term
        n = one if n is None else n + one
    return s, n


def ordered_window(df: DataFrame, keys: Sequence[str], order: str, *,
                   lags: Sequence[tuple[str, int, str]] = (),
                   leads: Sequence[tuple[str, str]] = (),
                   running_sum: Sequence[tuple[str, str]] = (),
                   running_min: Sequence[tuple[str, str]] = (),
                   row_number: str | None = None,
                   avg_last3: Sequence[tuple[str, str]] = (),
                   strategy: str = "split", rows_per_bucket: int = 4096,
                   tiebreak: Sequence[str] = (), bucket: str | None = None) -> DataFrame:
    """Add the requested window columns (names given as the last element of
    each spec).  ``lags`` take k in (1, 2).  Rows are ordered by ``order``
    then ``tiebreak`` (ascending); buckets are cut on ``order`` only, so
    rows that tie on it share a bucket and the full ordering is exact.
    ``bucket`` names a column of :func:`with_buckets` on the same ``order``
    and on ``keys`` or some of them: several windows then share one bucketing
    (and its shuffle); the column stays."""
    keys = list(keys)
    if any(k not in (1, 2) for _, k, _ in lags):
        raise ValueError("lag offsets 1 and 2 are supported")
    if strategy == "plain":
        return _plain(df, keys, order, lags, leads, running_sum, running_min, row_number, avg_last3,
                      list(tiebreak))
    if strategy != "split":
        raise ValueError("strategy must be split or plain")
    return _split(df, keys, order, lags, leads, running_sum, running_min, row_number, avg_last3,
                  rows_per_bucket, list(tiebreak), bucket)


def _plain(df, keys, order, lags, leads, running_sum, running_min, row_number, avg_last3, tiebreak=()):
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first(),
                                          *[F.col(t).asc_nulls_first() for t in tiebreak])
    rows = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rng = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.lag(c, k).over(w).alias(o) for c, k, o in lags]
    cols += [F.lead(c).over(w).alias(o) for c, o in leads]
    cols += [F.sum(c).over(rows).alias(o) for c, o in running_sum]
    cols += [F.min(c).over(rng).alias(o) for c, o in running_min]
    if row_number:
        cols.append(F.row_number().over(w).cast("bigint").alias(row_number))
    for c, o in avg_last3:
        s, n = _sum3([F.lag(c, 2).over(w), F.lag(c, 1).over(w), F.col(c)])
        cols.append(F.when(n > 0, s / n).alias(o))
    return df.select("*", *cols)


def with_buckets(df: DataFrame, keys: Sequence[str], order: str, out: str, rows_per_bucket: int = 4096, whole: bool = False) -> DataFrame:
    """``df`` with ``out``: the number of its row's equi-depth bucket among the
    rows of its key (NULL ``order`` values, which sort first, have the lowest).
    With ``whole`` it is 0 for a key without cuts, which is one bucket, and above
    0 for others' values; the column's metadata says how many buckets the keys
    with cuts have at most.
    One small job counts keys and cuts for checked broadcasts."""
    o = F.col(order)
    # all narrow columns take part in the choice of cuts, so that ties on ``order`` are chosen apart
    plain = [f.name for f in df.schema.fields if f.name not in keys and f.dataType.typeName() in ("long", "integer", "double", "timestamp_ntz")]
    cuts = depth_cuts(df.select(*keys, *plain).where(o.isNotNull()), keys, order, rows_per_bucket)
    number = F.when(o.isNull(), F.lit(-(2 ** 62))).otherwise(bucket_of(o, F.coalesce(CUTS, F.array().cast(cuts.schema[CUTS].dataType))))
    n_keys, longest = cuts_size(cuts)
    j = join_keys(df, per_key_side(cuts, n_keys, longest), keys, "left")
    if not whole:
        return j.select(*df.columns, number.alias(out))
    number = F.when(F.col(CUTS).isNotNull(), number + 1).otherwise(0).cast("bigint")
    return j.select(*df.columns, number.alias(out, metadata={BUCKETS: n_keys * (longest + 2), KEYS: list(keys)}))


def _summaries(b: DataFrame, keys: list[str], bucket: str) -> int | None:
    """How many buckets of keys with cuts ``b`` has at most, if that is known."""
    known = b.schema[bucket].metadata or {}
    rows = known.get(BUCKETS)
    return rows if rows == 0 or known.get(KEYS) == keys else None


def _split(df, keys, order, lags, leads, running_sum, running_min, row_number, avg_last3, rpb, tiebreak=(), bucket=None):
    o, _B = F.col(order), bucket or _BUCKET
    b = df if bucket else with_buckets(df, keys, order, _B, rpb, whole=True)

    w = Window.partitionBy(*keys, _B).orderBy(o.asc_nulls_first(), *[F.col(t).asc_nulls_first() for t in tiebreak])
    rows = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rng = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys, _B)
    lag_cols = {c for c, _, _ in lags} | {c for c, _ in avg_last3}
    lead_cols = {c for c, _ in leads}
    sum_cols = {c for c, _ in running_sum}
    min_cols = {c for c, _ in running_min}

    inner = [F.row_number().over(w).alias(_RN), F.count(F.lit(1)).over(whole).alias(_N)]
    inner += [F.lag(c, 1).over(w).alias(f"_ow_l1_{c}") for c in lag_cols]
    inner += [F.lag(c, 2).over(w).alias(f"_ow_l2_{c}") for c in lag_cols]
    inner += [F.lead(c, 1).over(w).alias(f"_ow_d1_{c}") for c in lead_cols]
    inner += [F.sum(c).over(rows).alias(f"_ow_s_{c}") for c in sum_cols]
    inner += [F.min(c).over(rng).alias(f"_ow_m_{c}") for c in min_cols]
    x = b.select("*", *inner)

    n_summ = _summaries(b, list(keys), _B)
    # per-bucket summary; positions from the in-bucket row number so that
    # "last" and "first" agree with the window's own order
    rn, n = F.col(_RN), F.col(_N)
    agg = [F.count(F.lit(1)).alias("_ow_bn")]
    agg += [F.max_by(F.col(c), F.when(rn == n, F.lit(1))).alias(f"_ow_last1_{c}") for c in lag_cols]
    agg += [F.max_by(F.col(c), F.when(rn == n - 1, F.lit(1))).alias(f"_ow_last2_{c}") for c in lag_cols]
    agg += [F.max_by(F.col(c), F.when(rn == 1, F.lit(1))).alias(f"_ow_first_{c}") for c in lead_cols]
    agg += [F.sum(c).alias(f"_ow_bs_{c}") for c in sum_cols]
    agg += [F.min(c).alias(f"_ow_bm_{c}") for c in min_cols]
    summ = (x.where(F.col(_B) != 0) if BUCKETS in (b.schema[_B].metadata or {}) else x).groupBy(*keys, _B).agg(*agg)
    ws = Window.partitionBy(*keys).orderBy(_B)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    carry = [F.coalesce(F.sum("_ow_bn").over(before), F.lit(0)).alias("_ow_cb")]
    carry += [F.lag("_ow_bn").over(ws).alias("_ow_pn")]
    for c in lag_cols:
        carry += [F.lag(f"_ow_last1_{c}").over(ws).alias(f"_ow_p1_{c}"),
                  F.lag(f"_ow_last2_{c}").over(ws).alias(f"_ow_p2_{c}"),
                  F.lag(f"_ow_last1_{c}", 2).over(ws).alias(f"_ow_pp1_{c}")]
    carry += [F.lead(f"_ow_first_{c}").over(ws).alias(f"_ow_nf_{c}") for c in lead_cols]
    carry += [F.sum(f"_ow_bs_{c}").over(before).alias(f"_ow_sb_{c}") for c in sum_cols]
    carry += [F.min(f"_ow_bm_{c}").over(before).alias(f"_ow_mb_{c}") for c in min_cols]
    carried = summ.select(*keys, _B, *carry)
    j = x if n_summ == 0 else join_keys(x, per_key_side(carried, n_summ), list(keys) + [_B], "left")

    def brought(name):
        return F.lit(None) if n_summ == 0 else F.col(name)

    def lag1(c):
        return F.when(rn == 1, brought(f"_ow_p1_{c}")).otherwise(F.col(f"_ow_l1_{c}"))

    def lag2(c):
        first = F.when(brought("_ow_pn") >= 2, brought(f"_ow_p2_{c}")).otherwise(brought(f"_ow_pp1_{c}"))
        return (F.when(rn >= 3, F.col(f"_ow_l2_{c}")).when(rn == 2, brought(f"_ow_p1_{c}"))
                .otherwise(first))

    out = [lag1(c).alias(o_) if k == 1 else lag2(c).alias(o_) for c, k, o_ in lags]
    out += [F.when(rn == n, brought(f"_ow_nf_{c}")).otherwise(F.col(f"_ow_d1_{c}")).alias(o_) for c, o_ in leads]
    for c, o_ in running_sum:
        s_in, s_b = F.col(f"_ow_s_{c}"), brought(f"_ow_sb_{c}")
        out.append(F.when(s_in.isNull() & s_b.isNull(), F.lit(None))
                   .otherwise(F.coalesce(s_b, F.lit(0)) + F.coalesce(s_in, F.lit(0))).alias(o_))
    out += [F.least(F.col(f"_ow_m_{c}"), brought(f"_ow_mb_{c}")).alias(o_) for c, o_ in running_min]
    if row_number:
        out.append((F.coalesce(brought("_ow_cb"), F.lit(0)) + rn).cast("bigint").alias(row_number))
    for c, o_ in avg_last3:
        s, cnt = _sum3([lag2(c), lag1(c), F.col(c)])
        out.append(F.when(cnt > 0, s / cnt).alias(o_))
    return j.select(*df.columns, *out)
