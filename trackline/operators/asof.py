"""As-of fill: the last known non-null value of each column at every row.

Semantics (per value column ``v``, for every row r of ``df``): among rows
of the same ``keys`` whose (ts, tie) is <= r's (ts, tie) and whose ``v``
is not NULL, take the ``v`` of the greatest (ts, tie, v).  This is
``LAST_VALUE(v IGNORE NULLS) OVER (PARTITION BY keys ORDER BY ts, tie, v
NULLS FIRST ROWS UNBOUNDED PRECEDING)`` evaluated at rows that carry no
value themselves, with a deterministic answer when several context rows
share an instant.  NULL timestamps sort first (as in the reference's
engine): they form an initial state seen by every row of the key.

The plain window form partitions by ``keys`` only, so a session is one
task.  Here the time axis of each key is cut into buckets and the work is
split in three parts, all exact:

1. per key: cut points of equi-depth buckets (``depth.py``), so that a
   bucket holds about ``rows_per_bucket`` rows wherever they lie in time;
   they come from the context rows and an optional cheap scan shaped like
   the big side, never from ``df`` itself, so ``df``'s plan runs once;
2. per (key, bucket) the last value of each column among the rows that
   carry values (partial aggregation, tiny), a running ``last`` over those
   buckets, and that state spread to every later bucket up to the next
   bucket with values ("carry-in", one row per bucket in the context span;
   beyond the last one the key's final state applies);
3. a window partitioned by (keys, bucket) for the in-bucket part, then
   ``coalesce(in_bucket, carry_in, initial)``.

The window and the carry-in join share the (keys, bucket) partitioning, so
the big side is shuffled once; the per-key table is one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.functions.scalar import epoch_micros
from trackline.operators.depth import CUTS, bucket_of, cuts_size, depth_cuts
from trackline.operators.keys import join_keys

_US, _TIE, _BKT = "_af_us", "_af_tie", "_af_bkt"
_LAST = "_af_last"


def _last_key(v: str, with_ts: bool = True) -> Column:
    parts = [F.col(_US)] if with_ts else []
    return F.when(F.col(v).isNotNull(), F.struct(*parts, F.col(_TIE), F.col(v)))


# A per-key table (one row per key) is broadcast explicitly when its counted
# rows take at most this many bytes (Spark conf ``trackline.broadcast.maxBytes``);
# beyond it the join is left to the planner (AQE broadcast or a shuffled join).
MAX_BROADCAST_BYTES = 64 << 20
# bytes allowed for a scalar field of such a row
FIELD_BYTES = 64


def max_broadcast_bytes(spark) -> int:
    return int(spark.conf.get("trackline.broadcast.maxBytes", str(MAX_BROADCAST_BYTES)))


def per_key_side(table: DataFrame, n_keys: int | None, array_items: int = 0) -> DataFrame:
    """Broadcast a one-row-per-key table when its key count is known and its
    bytes (``array_items`` longs a row besides its scalar fields) are within
    the bound; otherwise leave the choice to the planner."""
    row_bytes = FIELD_BYTES * len(table.columns) + 8 * array_items
    if n_keys is not None and n_keys * row_bytes <= max_broadcast_bytes(table.sparkSession):
        return F.broadcast(table)
    return table


def asof_fill(df: DataFrame, keys: Sequence[str], ts: str, tie: Column | str | None,
              values: Sequence[str], out: Mapping[str, str] | None = None,
              rows_per_bucket: int = 4096, density: DataFrame | None = None,
              strategy: str = "split") -> DataFrame:
    """Add one filled column per name in ``values`` (named by ``out``,
    default ``<v>_filled``).  ``tie`` orders rows that share a timestamp
    (smaller first).

    A bucket holds about ``rows_per_bucket`` rows of the context rows plus
    ``density`` (keys + ``ts`` columns; pass a cheap scan that has the row
    density of the big side, e.g. the raw samples).  The cuts never read
    ``df`` as a whole, so ``df``'s plan is evaluated once.  With ``density``
    small jobs count the keys with cuts and those with an initial state; the
    per-key tables and the carry-in rows are broadcast when their bytes are
    within the bound.  A key without cuts is one bucket and needs no carry-in.
    Rows with a NULL key form a key of their own, as in a window.

    ``strategy='plain'`` is one window partition per key: the definition,
    which tests compare with.
    """
    keys = list(keys)
    values = list(values)
    if strategy == "plain":
        return asof_fill_plain(df, keys, ts, tie, values, out)
    if strategy != "split":
        raise ValueError("strategy must be split or plain")
    out = dict(out or {v: f"{v}_filled" for v in values})
    tie_c = F.lit(0) if tie is None else (F.col(tie) if isinstance(tie, str) else tie)
    base = df.withColumn(_US, epoch_micros(ts)).withColumn(_TIE, tie_c)
    idx = {v: i for i, v in enumerate(values)}

    has_value = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values])
    ctx = base.where(has_value).select(*keys, _US, _TIE, *values)

    # initial state: context rows without a timestamp sort before all others
    init = (ctx.where(F.col(_US).isNull()).groupBy(*keys)
            .agg(*[F.max_by(v, _last_key(v, with_ts=False)).alias(f"_af_i{idx[v]}") for v in values]))

    # 1. cut points per key
    ctx_t = ctx.where(F.col(_US).isNotNull())
    pts = ctx_t.select(*keys, _US, _TIE)
    if density is not None:
        pts = pts.unionByName(density.select(*keys, epoch_micros(ts).alias(_US), F.lit(None).alias(_TIE))
                              .where(F.col(_US).isNotNull()))
    cuts = depth_cuts(pts, keys, _US, rows_per_bucket)
    n_keys, longest = cuts_size(cuts) if density is not None else (None, 0)
    bucket = bucket_of(F.col(_US), F.coalesce(CUTS, F.array().cast("array<bigint>")))

    # 2. per-bucket last values, running state, carry-in rows
    ctx_b = join_keys(ctx_t, per_key_side(cuts, n_keys, longest), keys).withColumn(_BKT, bucket)
    summ = ctx_b.groupBy(*keys, _BKT).agg(
        *[F.max_by(v, _last_key(v)).alias(f"_af_s{idx[v]}") for v in values])
    wk = Window.partitionBy(*keys).orderBy(_BKT)
    run = wk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = summ.select(*keys, _BKT, F.lead(_BKT).over(wk).alias("_af_next"),
                      *[F.last(f"_af_s{i}", ignorenulls=True).over(run).alias(f"_af_c{i}")
                        for i in idx.values()])
    carry = (cum.where(F.col("_af_next").isNotNull())
             .select(*keys, F.explode(F.sequence(F.col(_BKT) + 1, F.col("_af_next"))).alias(_BKT),
                     *[f"_af_c{i}" for i in idx.values()]))
    final = cum.where(F.col("_af_next").isNull()).select(
        *keys, F.col(_BKT).alias(_LAST), *[F.col(f"_af_c{i}").alias(f"_af_f{i}") for i in idx.values()])
    per_key = join_keys(cuts, final, keys, "left")

    # 3. big side: bucket, carry-in, in-bucket window.  Rows without a
    # timestamp only see the initial state; they get ids far below any real
    # bucket, spread by a hash so that they do not pile into one window
    # partition per key.
    null_bkt = F.lit(-(2 ** 62)) - F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(1024))
    big = join_keys(base, per_key_side(per_key, n_keys, longest), keys, "left")
    big = big.withColumn(_BKT, F.when(F.col(_US).isNull(), null_bkt).otherwise(bucket)).drop(CUTS)
    # a key has fewer carry-in rows than buckets
    big = join_keys(big, per_key_side(carry, None if n_keys is None else n_keys * (longest + 1)), keys + [_BKT], "left")
    n_init = init.count() if density is not None else None
    if n_init != 0:
        big = join_keys(big, per_key_side(init, n_init), keys, "left")
    w = (Window.partitionBy(*keys, _BKT).orderBy(_US, _TIE)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    filled = []
    for v in values:
        i = idx[v]
        first = F.lit(None) if n_init == 0 else F.col(f"_af_i{i}")
        in_bucket = F.max_by(v, _last_key(v)).over(w)
        carried = F.when(F.col(_BKT) > F.col(_LAST), F.col(f"_af_f{i}")).otherwise(F.col(f"_af_c{i}"))
        filled.append(F.when(F.col(_US).isNull(), first).otherwise(F.coalesce(in_bucket, carried, first)).alias(out[v]))
    return big.select(*df.columns, *filled)


def asof_fill_plain(df: DataFrame, keys: Sequence[str], ts: str, tie: Column | str | None,
                    values: Sequence[str], out: Mapping[str, str] | None = None) -> DataFrame:
    """Single-window form of :func:`asof_fill` (tests compare)."""
    values = list(values)
    out = dict(out or {v: f"{v}_filled" for v in values})
    tie_c = F.lit(0) if tie is None else (F.col(tie) if isinstance(tie, str) else tie)
    base = df.withColumn(_US, epoch_micros(ts)).withColumn(_TIE, tie_c)
    # NULL-timestamp rows are peers of each other (each sees the key's whole
    # NULL-timestamp context); their tie only ranks values in the max_by key
    peer_tie = F.when(F.col(_US).isNull(), F.lit(None)).otherwise(F.col(_TIE))
    w = (Window.partitionBy(*keys).orderBy(F.col(_US).asc_nulls_first(), peer_tie.asc_nulls_first())
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return base.select(*df.columns, *[
        F.max_by(v, F.when(F.col(v).isNotNull(),
                           F.struct(F.coalesce(F.col(_US), F.lit(-(2 ** 62))), F.col(_TIE), F.col(v)))).over(w)
        .alias(out[v]) for v in values])
