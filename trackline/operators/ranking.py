"""Arg-min rows, group ranks and deltas to a group's best.

* :func:`first_by` - the row with the smallest ordering per group, as a
  ``min_by`` aggregate: map-side partial aggregation, no sort of the group,
  and no QUALIFY (Spark has none).
* :func:`group_rank` - ``RANK() OVER (PARTITION BY p ORDER BY x)`` computed
  without putting a whole partition into one task: rows are counted per
  (group, value), a rank is one more than the rows of lower values, and the
  ranks are joined back to the rows.  The counts of a group are summed over
  ranges of its values (equi-depth buckets of the different values, ``depth.py``)
  and inside each range, so neither a large group nor a value that very many
  rows share meets in one task; a group without cuts is one range.
* :func:`with_group_min` - ``MIN(x) OVER (PARTITION BY p)`` as a partial
  aggregate joined back (small per-group table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.operators.asof import per_key_side
from trackline.operators.depth import CUTS, bucket_of, cuts_size, depth_cuts
from trackline.operators.keys import join_keys


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
             columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple
    (rows whose whole tuple is NULL never win)."""
    keys = list(keys)
    cols = [c for c in (columns or df.columns) if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), ordering).alias("_fb"))
    return picked.select(*keys, *[F.col(f"_fb.{c}").alias(c) for c in cols])


# different values of a group in a range that is summed on its own
RANGE_ROWS = 4096


def value_ranks(df: DataFrame, partition: Sequence[str], order: str, out: str) -> DataFrame:
    """(partition, order, out) once for each different value of a group: its
    RANK() by ``order`` ascending, NULLs first.  NULL keys are a group.  One
    small job counts groups and cuts for checked broadcasts."""
    keys, x = list(partition), F.col(order)
    counts = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_gr_n"))
    cuts = depth_cuts(df.select(*keys, order), keys, order, RANGE_ROWS)
    n_keys, longest = cuts_size(cuts)
    # range id: NULLs first (-1), then the number of cut points not above x
    rid = F.when(F.col(CUTS).isNotNull(), F.when(x.isNull(), F.lit(-1)).otherwise(bucket_of(x)))
    placed = join_keys(counts, per_key_side(cuts, n_keys, longest), keys, "left").select(*keys, order, "_gr_n", rid.alias("_gr_r"))
    ranges = placed.where("_gr_r is not null").groupBy(*keys, "_gr_r").agg(F.sum("_gr_n").alias("_gr_s"))
    lower = Window.partitionBy(*keys).orderBy("_gr_r").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select(*keys, "_gr_r", F.coalesce(F.sum("_gr_s").over(lower), F.lit(0)).alias("_gr_before"))
    inside = Window.partitionBy(*keys, "_gr_r").orderBy(x.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_gr_local", F.coalesce(F.sum("_gr_n").over(inside), F.lit(0)))
    rank = F.col("_gr_local") + 1
    if n_keys:
        local = join_keys(local, per_key_side(before, n_keys * (longest + 2)), [*keys, "_gr_r"], "left")
        rank = F.coalesce("_gr_before", F.lit(0)) + rank
    return local.select(*keys, order, rank.cast("bigint").alias(out))


def group_rank(df: DataFrame, partition: Sequence[str], order: str, out: str) -> DataFrame:
    """Add ``out`` = RANK() over ``partition`` ordered by ``order`` ascending,
    NULLs first (as RANK does in Spark and in the reference's engine)."""
    ranks = value_ranks(df, partition, order, out)
    return join_keys(df, ranks, [*partition, order]).select(*[c for c in df.columns if c != out], out)


def with_group_min(df: DataFrame, partition: Sequence[str], col: str, out: str) -> DataFrame:
    """Add ``out`` = MIN(col) over the whole ``partition`` group (NULL keys
    are a group, as in a window)."""
    keys = list(partition)
    mins = df.groupBy(*keys).agg(F.min(col).alias(out)).select(*[F.col(k).alias(f"_gm_{k}") for k in keys], out)
    same = [F.col(k).eqNullSafe(F.col(f"_gm_{k}")) for k in keys]
    rest = [c for c in df.columns if c not in keys]
    return df.join(mins, same, "left").select(*keys, *rest, out)
