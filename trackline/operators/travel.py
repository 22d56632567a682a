"""Distance travelled, marks passed, and readings between two others.

Speeds are whole km/h and times whole microseconds, so a distance is a whole
number of half km/h microseconds (``METRE`` of them are one metre): prefix
sums are exact and the same however a key's readings are split.

* :func:`legs` - per key the legs between successive readings with the
  distance at both ends: LEAD and a running sum by :func:`ordered_window`,
  which splits a key's time axis over buckets.
* :func:`crossings` - when each key passes every multiple of a distance.
* :func:`between` - two-sided as-of join: the legs around given instants (by
  the bucketed interval join) and the distance interpolated there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.functions.scalar import epoch_micros
from trackline.operators.interval import interval_join
from trackline.operators.ordered import ordered_window, with_buckets

# (km/h + km/h) * microseconds in one metre
METRE = 7_200_000


def _instant(us: str):
    return F.timestamp_micros(us).cast("timestamp_ntz")


def legs(readings: DataFrame, keys: Sequence[str], ts: str, speed: str, strategy: str = "split") -> DataFrame:
    """(keys, leg_start, leg_end, start_us, end_us, start_d, length): one row per pair of
    successive readings of a key, travelled at the mean of both speeds.
    Readings without time or speed are left out; of several at one instant the
    greatest speed counts."""
    keys = list(keys)
    r = readings.where(F.col(ts).isNotNull() & F.col(speed).isNotNull()).select(*keys, epoch_micros(ts).alias("start_us"), F.col(speed).cast("bigint").alias("_v"))
    r = r.groupBy(*keys, "start_us").agg(F.max("_v").alias("_v"))
    bucket = "_readings" if strategy == "split" else None
    r = with_buckets(r, keys, "start_us", bucket, whole=True) if bucket else r
    r = ordered_window(r, keys, "start_us", leads=[("start_us", "end_us"), ("_v", "_next")], strategy=strategy, bucket=bucket).where("end_us is not null")
    r = r.withColumn("length", (F.col("_v") + F.col("_next")) * (F.col("end_us") - F.col("start_us")))
    r = ordered_window(r, keys, "start_us", running_sum=[("length", "_end_d")], strategy=strategy, bucket=bucket)
    return r.select(*keys, _instant("start_us").alias("leg_start"), _instant("end_us").alias("leg_end"), "start_us", "end_us",
                    (F.col("_end_d") - F.col("length")).alias("start_d"), "length")


def crossings(travel: DataFrame, keys: Sequence[str], every_m: int) -> DataFrame:
    """(keys, mark, at_us): the instant at which a key has travelled ``mark``
    times ``every_m`` metres, for every mark from 1 on that it passes."""
    step = every_m * METRE
    first = F.greatest(F.lit(1), F.expr(f"(start_d + {step - 1}) div {step}")).cast("bigint")
    last = F.expr(f"(start_d + length + {step - 1}) div {step} - 1").cast("bigint")
    at = travel.where(first <= last).withColumn("mark", F.explode(F.sequence(first, last)))
    part = (F.col("mark") * step - F.col("start_d")) / F.col("length").cast("double")
    return at.select(*keys, "mark", (F.col("start_us") + F.floor(part * (F.col("end_us") - F.col("start_us")))).alias("at_us"))


def between(points: DataFrame, travel: DataFrame, keys: Sequence[str], at: str, out: str) -> DataFrame:
    """``points`` with ``out``: the distance travelled at ``at``, interpolated
    between the readings before and after it (NULL outside all readings)."""
    cols = [*keys, "leg_start", "leg_end", "start_us", "end_us", "start_d", "length"]
    j = interval_join(points, travel.select(*cols), keys, at, "leg_start", "leg_end", how="left")
    part = (epoch_micros(at) - F.col("start_us")) / (F.col("end_us") - F.col("start_us")).cast("double")
    return j.select(*points.columns, (F.col("start_d") + F.floor(part * F.col("length"))).alias(out))
