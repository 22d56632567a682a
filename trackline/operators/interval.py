"""Interval join: points whose timestamp lies in a half-open [start, end).

Plain Spark plans this as an equi-join on the keys plus a residual range
filter, which compares every point of a (session, driver) with every lap
of it and sends a hot key to one task.  Here both sides also carry a time
bucket: a point falls in exactly one bucket, an interval is replicated to
the buckets it overlaps, and the equi-join runs on keys + bucket.  The
result is the same rows (a point meets each interval that contains it
exactly once, in that point's bucket), the join key space grows with time
so a hot key spreads over many tasks, and the interval side stays a plain
join input: AQE broadcasts it when its measured size is below the
broadcast threshold and falls back to a sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.scalar import epoch_micros

_BKT = "_tl_bucket"


def _copies(start: str, end: str, b: int):
    lo = F.floor(epoch_micros(start) / F.lit(b))
    hi = F.floor((epoch_micros(end) - 1) / F.lit(b))
    return lo, hi


def _length_stats(intervals: DataFrame, start: str, end: str) -> tuple[int | None, int | None]:
    """(median, max) interval length in microseconds - one small aggregate
    over the interval side."""
    length = epoch_micros(end) - epoch_micros(start)
    row = intervals.agg(F.percentile_approx(length, 0.5, 1000).alias("m"), F.max(length).alias("x")).first()
    return (row["m"], row["x"]) if row is not None else (None, None)


def suggest_bucket_us(intervals: DataFrame, start: str, end: str,
                      minimum_us: int = 1_000_000) -> int:
    """Median interval length: an interval is then replicated to about two
    buckets and a bucket holds about one interval per key."""
    med, _ = _length_stats(intervals, start, end)
    return int(max(minimum_us, med or 3_600_000_000))


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str],
                  ts: str, start: str, end: str, how: str = "inner",
                  bucket_us: int | None = None, max_copies: int = 64) -> DataFrame:
    """Rows of ``points`` joined to every interval with equal ``keys`` and
    ``start <= ts < end``.  ``how`` is ``inner`` or ``left``.

    Intervals with a NULL bound or with ``end <= start`` can never match
    and are dropped before the replication.  An interval that would be copied
    to more than ``max_copies`` buckets (e.g. a lap whose end is days later)
    goes to a coarser level, whose buckets are ``max_copies`` times as wide,
    and so on; a point has one bucket on each level that the longest interval
    calls for (mostly one).  An interval lives on one level, so every match
    is found once, and no interval leaves the bucketed join.  Output: all
    point columns, then the interval columns except the keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if max_copies < 2:
        raise ValueError("max_copies must be at least 2")
    keys = list(keys)
    iv = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull()
                         & (F.col(end) > F.col(start)))
    med, longest = _length_stats(iv, start, end)
    widths = [int(bucket_us or max(1_000_000, med or 3_600_000_000))]
    # an interval of length L touches at most ceil(L / width) + 1 buckets
    while longest is not None and -(-int(longest) // widths[-1]) + 1 > max_copies:
        widths.append(widths[-1] * max_copies)

    def spot(level: int, bucket: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), bucket.alias("bucket"))

    def covered(level: int) -> Column:
        lo, hi = _copies(start, end, widths[level])
        return F.when(hi - lo < max_copies, F.transform(F.sequence(lo, hi), lambda x: spot(level, x)))

    levels = range(len(widths))
    ivb = iv.withColumn(_BKT, F.explode(F.coalesce(*map(covered, levels)))).alias("_iv")
    own = [spot(level, F.floor(epoch_micros(ts) / F.lit(widths[level]))) for level in levels]
    pb = points.withColumn(_BKT, own[0] if len(own) == 1 else F.explode(F.array(*own))).alias("_pt")
    cond = [F.col(f"_pt.{k}") == F.col(f"_iv.{k}") for k in keys]
    cond += [F.col(f"_pt.{_BKT}.level") == F.col(f"_iv.{_BKT}.level"),
             F.col(f"_pt.{_BKT}.bucket") == F.col(f"_iv.{_BKT}.bucket"),
             F.col(f"_pt.{ts}") >= F.col(f"_iv.{start}"),
             F.col(f"_pt.{ts}") < F.col(f"_iv.{end}")]
    out = [F.col(f"_pt.{c}") for c in points.columns]
    out += [F.col(f"_iv.{c}") for c in intervals.columns if c not in keys]
    if how == "inner" or len(widths) == 1:
        return pb.join(ivb, cond, how).select(*out)

    # left: points without any match keep one row with NULL interval columns
    inner = pb.join(ivb, cond, "inner").select(*out)
    matched = inner.select(*points.columns).distinct().alias("_m")
    same = [F.col(f"_p.{c}").eqNullSafe(F.col(f"_m.{c}")) for c in points.columns]
    unmatched = points.alias("_p").join(matched, same, "left_anti").select(*points.columns)
    pad = [F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema.fields if f.name not in keys]
    return inner.unionByName(unmatched.select(*points.columns, *pad))


def interval_join_plain(points: DataFrame, intervals: DataFrame, keys: Sequence[str],
                        ts: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Reference form (equi-join + residual); used by tests to check the
    bucketed form row for row."""
    p, i = points.alias("_pt"), intervals.alias("_iv")
    cond = [F.col(f"_pt.{k}") == F.col(f"_iv.{k}") for k in keys]
    cond += [F.col(f"_pt.{ts}") >= F.col(f"_iv.{start}"), F.col(f"_pt.{ts}") < F.col(f"_iv.{end}")]
    out = [F.col(f"_pt.{c}") for c in points.columns]
    out += [F.col(f"_iv.{c}") for c in intervals.columns if c not in keys]
    return p.join(i, cond, how).select(*out)
