"""Equi-depth buckets: an ordered axis cut, per key, where the rows are.

:func:`depth_cuts` takes about one row in ``rows_per_bucket`` of each key as
a cut point, chosen by a hash of the row, so that a bucket holds about so many
rows wherever they lie: an outlier or a dense stretch changes nothing.  The
choice depends on the rows alone, not on how they are partitioned or on a
retry, so every use of the cuts sees the same buckets.  A key keeps at most
``MAX_CUTS`` cuts, evenly thinned; a key with more rows than that many buckets
hold gets larger buckets, not more.  Rows that share a value share a bucket.
The table of cuts holds keys that have a cut and no other: about one key in
``rows_per_bucket`` rows at most, however many keys there are.

:func:`bucket_of` is the number of cuts not above a value, by binary search.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 10
MAX_CUTS = (1 << BITS) - 1
CUTS = "_dp_cuts"


def depth_cuts(points: DataFrame, keys: Sequence[str], order: str, rows_per_bucket: int) -> DataFrame:
    """(keys, ``_dp_cuts``): one row per key of ``points`` that has cuts, its
    sorted cuts of ``order``.  NULL values are no cuts; a NULL key is a key.
    Rows equal in all columns of ``points`` are chosen together."""
    chosen = F.pmod(F.xxhash64(*[F.col(c) for c in points.columns]), F.lit(rows_per_bucket)) == 0
    cuts = points.where(chosen & F.col(order).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_set(order)).alias(CUTS))
    n = F.size(CUTS)
    thinned = F.transform(F.sequence(F.lit(1), F.lit(MAX_CUTS)),
                          lambda i: F.get(CUTS, F.floor(i.cast("bigint") * n / (MAX_CUTS + 1)).cast("int")))
    return cuts.withColumn(CUTS, F.when(n > MAX_CUTS, thinned).otherwise(F.col(CUTS)))


def bucket_of(value: Column, cuts: Column | str = CUTS) -> Column:
    """Bucket number (bigint, from 0) of ``value`` among its key's ``cuts``;
    0 for a NULL value or a key without cuts."""
    cuts = F.col(cuts) if isinstance(cuts, str) else cuts
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(BITS))])
    found = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(cuts, at + s - 1) <= value, at + s).otherwise(at))
    return F.when(F.size(cuts) > 0, found).otherwise(0).cast("bigint")


def cuts_size(cuts: DataFrame) -> tuple[int, int]:
    """(keys, cuts of the longest list) of a table of cuts: one small job."""
    row = cuts.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(CUTS)), F.lit(0))).first()
    return int(row[0]), int(row[1])
