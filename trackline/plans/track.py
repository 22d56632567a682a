"""Analyses on the track: corners and the speed in them, gaps between cars,
driving style, and the order of the race over time."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackline.functions.scalar import epoch_micros
from trackline.operators.asof import asof_fill, per_key_side
from trackline.operators.geometry import nearest_mark, resample, with_corners
from trackline.operators.ordered import ordered_window, with_buckets
from trackline.operators.travel import METRE, between, crossings, legs
from trackline.plans.silver import DRIVER_KEYS, lap_boundaries
from trackline.session import checkpoint_root

# driving style: a press of the pedal by this much at once, and the bands of
# throttle and of lap rates (per cent) that histograms count
THROTTLE_JUMP, THROTTLE_BANDS, BAND = 40, 5, 20
RATE_BIN, RATE_BINS = 5, 21
STYLE = ("brake_applications", "throttle_jumps", "gear_shifts")


# -- corners -------------------------------------------------------------------
def session_circuits(sessions: DataFrame, meetings: DataFrame) -> DataFrame:
    """(session_key, circuit_key) of sessions whose meeting has a circuit."""
    m = meetings.where("circuit_key is not null").groupBy("meeting_key").agg(F.min("circuit_key").alias("circuit_key"))
    return sessions.select("session_key", "meeting_key").join(m, "meeting_key").select("session_key", "circuit_key").distinct()


def located(samples: DataFrame, circuits: DataFrame) -> DataFrame:
    """Samples inside a lap with speed and place, with their circuit."""
    have = samples.dropna(subset=["lap_number", "speed", "x", "y"])
    return have.join(circuits, "session_key")


def _kept(df: DataFrame) -> DataFrame:
    """``df``, a few rows a circuit, computed once (in the shared checkpoint
    folder) for all that reads it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def circuit_marks(points: DataFrame, marks: int = 200, min_points: int = 5, min_turn: float = math.pi / 6, reach: int = 5) -> DataFrame:
    """The line of each circuit, resampled and with corners: that of its
    fastest lap (ties: session, driver, lap) with at least ``min_points``
    readings at different places or times."""
    timed = points.where((F.col("lap_duration") > 0) & ~F.coalesce("is_pit_out_lap", F.lit(False)))
    lap = [*DRIVER_KEYS, "lap_number"]
    readings = timed.select("circuit_key", *lap, "lap_duration", "telemetry_timestamp", "x", "y").distinct()
    laps = readings.groupBy("circuit_key", *lap, "lap_duration").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_points)
    best = _kept(laps.groupBy("circuit_key").agg(F.min(F.struct("lap_duration", *lap)).alias("b")).select("circuit_key", "b.*"))
    line = readings.join(per_key_side(best, best.count()), ["circuit_key", *lap, "lap_duration"], "left_semi")
    return _kept(with_corners(resample(line, "circuit_key", ["telemetry_timestamp", "x", "y"], marks), "circuit_key", min_turn, reach))


def corner_v_min(samples: DataFrame, sessions: DataFrame, meetings: DataFrame, **line) -> DataFrame:
    """One row per lap and corner: the least speed near the corner, when it was
    first driven, and where the corner is."""
    points = located(samples, session_circuits(sessions, meetings))
    marks = circuit_marks(points, **line)
    near = nearest_mark(points, marks, "circuit_key", ["corner"]).where("corner is not null")
    per = near.groupBy("circuit_key", *DRIVER_KEYS, "lap_number", "corner").agg(
        F.min(F.struct("speed", "telemetry_timestamp")).alias("s"), F.count(F.lit(1)).alias("n_samples"))
    corners = marks.where("is_corner").select("circuit_key", "corner", F.col("mark").alias("corner_mark"), F.round("x", 6).alias("corner_x"),
                                              F.round("y", 6).alias("corner_y"), F.round(F.degrees("turn"), 6).alias("corner_angle"))
    return per.join(per_key_side(corners, corners.count()), ["circuit_key", "corner"]).select(
        "circuit_key", *DRIVER_KEYS, "lap_number", F.col("corner").alias("corner_number"), "corner_mark", "corner_x", "corner_y", "corner_angle",
        "n_samples", F.col("s.speed").alias("corner_v_min"), F.col("s.telemetry_timestamp").alias("v_min_timestamp"))


# -- gaps ----------------------------------------------------------------------
def track_gaps(telemetry: DataFrame, every_m: int, strategy: str = "split") -> DataFrame:
    """At every ``every_m`` metres of a session the order in which drivers get
    there: place, the driver ahead, the gap in seconds, and the gap in metres
    at the moment in which the driver ahead passed the mark (NULL before the
    driver's first reading)."""
    travel = legs(telemetry, DRIVER_KEYS, "date", "speed", strategy)
    at = crossings(travel, DRIVER_KEYS, every_m)
    # one row per driver of a session meets at a mark: a starting grid
    w = Window.partitionBy("session_key", "mark").orderBy("at_us", "driver_number")
    order = at.select(*DRIVER_KEYS, "mark", "at_us", F.row_number().over(w).cast("bigint").alias("place"),
                      F.lag("driver_number").over(w).alias("driver_ahead"), F.lag("at_us").over(w).alias("_ahead_us"))
    order = order.withColumn("_ahead", F.timestamp_micros("_ahead_us").cast("timestamp_ntz"))
    placed = between(order, travel, DRIVER_KEYS, "_ahead", "_d")
    return placed.select("session_key", "mark", "place", "driver_number", "driver_ahead", F.timestamp_micros("at_us").cast("timestamp_ntz").alias("passed_at"),
                         ((F.col("at_us") - F.col("_ahead_us")) / F.lit(1e6)).alias("gap_seconds"),
                         ((F.col("mark") * (every_m * METRE) - F.col("_d")) / F.lit(float(METRE))).alias("gap_metres"))


# -- driving style -------------------------------------------------------------
def lap_style(tl: DataFrame, strategy: str = "split") -> DataFrame:
    """Mergeable counts per (session, driver, lap): samples, changes of state
    against the sample before (which may lie in the lap before), and a
    histogram of throttle bands."""
    s = tl.where("lap_number is not null and telemetry_timestamp is not null").groupBy(
        *DRIVER_KEYS, "lap_number", epoch_micros("telemetry_timestamp").alias("_us")).agg(*[F.max(c).alias(c) for c in ("throttle", "brake", "n_gear")])
    s = ordered_window(s, DRIVER_KEYS, "_us", tiebreak=["lap_number"], strategy=strategy, lags=[(c, 1, f"_{c}") for c in ("throttle", "brake", "n_gear")])
    band = F.least(F.floor(F.col("throttle") / BAND), F.lit(THROTTLE_BANDS - 1))
    return s.groupBy(*DRIVER_KEYS, "lap_number").agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if((F.col("brake") > 0) & (F.coalesce("_brake", F.lit(0)) <= 0)).alias("brake_applications"),
        F.count_if(F.col("throttle") - F.col("_throttle") >= THROTTLE_JUMP).alias("throttle_jumps"),
        F.count_if(F.col("n_gear") != F.col("_n_gear")).alias("gear_shifts"),
        *[F.count_if(band == k).alias(f"band_{k}") for k in range(THROTTLE_BANDS)])


def driver_aggression(tl: DataFrame, strategy: str = "split") -> DataFrame:
    """One row per (session, driver).  ``aggression``: for each lap and each of
    three rates (brake applications, throttle jumps and gear shifts a sample),
    the share of the session's laps with a lower rate plus half of those with
    the same, averaged; rates are compared in bins of 5 per cent, so the field
    is a small histogram.  ``throttle_difference``: half the sum of differences
    between the driver's shares of throttle bands and the field's."""
    laps = lap_style(tl, strategy)
    rates = laps.select(*DRIVER_KEYS, F.explode(F.array(*[
        F.struct(F.lit(i).alias("rate"), F.least(F.expr(f"(100 * {c}) div (n_samples * {RATE_BIN})"), F.lit(RATE_BINS - 1)).alias("bin"))
        for i, c in enumerate(STYLE)])).alias("r")).select(*DRIVER_KEYS, "r.*")
    own = rates.groupBy(*DRIVER_KEYS, "rate", "bin").agg(F.count(F.lit(1)).alias("n"))
    # the field: three rates of RATE_BINS bins a session
    w = Window.partitionBy("session_key", "rate").orderBy("bin")
    field = own.groupBy("session_key", "rate", "bin").agg(F.sum("n").alias("same"))
    field = field.select("session_key", "rate", "bin", "same", F.coalesce(F.sum("same").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"),
                         F.sum("same").over(Window.partitionBy("session_key", "rate")).alias("total"))
    score = own.join(field, ["session_key", "rate", "bin"]).groupBy(*DRIVER_KEYS).agg(
        F.sum(F.col("n") * (2 * F.col("below") + F.col("same"))).alias("_p"), F.sum(F.col("n") * 2 * F.col("total")).alias("_q"))
    bands = [f"band_{k}" for k in range(THROTTLE_BANDS)]
    drivers = laps.groupBy(*DRIVER_KEYS).agg(F.count(F.lit(1)).alias("n_laps"), *[F.sum(c).alias(c) for c in ("n_samples", *STYLE, *bands)])
    all_ = drivers.groupBy("session_key").agg(F.sum("n_samples").alias("_n"), *[F.sum(b).alias(f"_{b}") for b in bands])
    share = sum((F.abs(F.col(b) / F.col("n_samples") - F.col(f"_{b}") / F.col("_n")) for b in bands), F.lit(0.0)) / 2
    return drivers.join(all_, "session_key").join(score, DRIVER_KEYS).select(
        *DRIVER_KEYS, "n_laps", "n_samples", *STYLE, F.round(share, 6).alias("throttle_difference"), F.round(F.col("_p") / F.col("_q"), 6).alias("aggression"))


# -- race order ----------------------------------------------------------------
def position_changes(positions: DataFrame, strategy: str = "split") -> DataFrame:
    """The feed's readings collapsed to intervals [valid_from, valid_to) of one
    position (the last one open), with the count of readings in each.  Of
    several readings at one instant the best position counts."""
    p = positions.where("date is not null and position is not null").groupBy(*DRIVER_KEYS, epoch_micros("date").alias("_us")).agg(F.min("position").alias("position"))
    bucket = "_readings" if strategy == "split" else None
    p = with_buckets(p, DRIVER_KEYS, "_us", bucket, whole=True) if bucket else p
    p = ordered_window(p, DRIVER_KEYS, "_us", lags=[("position", 1, "_before")], strategy=strategy, bucket=bucket)
    new = F.when(F.col("_before").isNull() | (F.col("_before") != F.col("position")), 1).otherwise(0)
    p = ordered_window(p.withColumn("_new", new), DRIVER_KEYS, "_us", running_sum=[("_new", "_run")], strategy=strategy, bucket=bucket)
    runs = p.groupBy(*DRIVER_KEYS, "_run").agg(F.min("position").alias("position"), F.min("_us").alias("_from"), F.count(F.lit(1)).alias("n_readings"))
    runs = ordered_window(runs, DRIVER_KEYS, "_run", leads=[("_from", "_to")], strategy=strategy)
    return runs.select(*DRIVER_KEYS, "position", F.timestamp_micros("_from").cast("timestamp_ntz").alias("valid_from"),
                       F.timestamp_micros("_to").cast("timestamp_ntz").alias("valid_to"), "n_readings")


def positions_at(points: DataFrame, changes: DataFrame, at: str, strategy: str = "split") -> DataFrame:
    """``points`` (with session, driver and the instant ``at``) with the
    ``position`` held then (a change at that instant counts; NULL before the
    first)."""
    seen = changes.select(*DRIVER_KEYS, F.col("valid_from").alias(at), F.col("position").alias("_seen"), F.lit(0).alias("_tie"))
    both = points.withColumn("_tie", F.lit(1)).withColumn("_point", F.lit(True)).unionByName(seen, allowMissingColumns=True)
    filled = asof_fill(both, DRIVER_KEYS, at, "_tie", ["_seen"], {"_seen": "position"}, density=points.select(*DRIVER_KEYS, at), strategy=strategy)
    return filled.where("_point").select(*points.columns, "position")


def positions_at_lap(laps_raw: DataFrame, positions: DataFrame, strategy: str = "split") -> DataFrame:
    """Position of each driver at the start and end of each lap, and the places
    gained in it."""
    bounds = lap_boundaries(laps_raw, strategy)
    ends = bounds.select(*DRIVER_KEYS, "lap_number", F.explode(F.array(F.struct(F.lit("start").alias("end"), F.col("lap_start").alias("at")),
                                                                         F.struct(F.lit("end").alias("end"), F.col("lap_end").alias("at")))).alias("e"))
    ends = ends.select(*DRIVER_KEYS, "lap_number", "e.end", "e.at").where("at is not null")
    held = positions_at(ends, position_changes(positions, strategy), "at", strategy)
    per = held.groupBy(*DRIVER_KEYS, "lap_number").agg(*[F.min(F.when(F.col("end") == k, F.col("position"))).alias(f"position_at_{k}") for k in ("start", "end")])
    return per.withColumn("places_gained", F.col("position_at_start") - F.col("position_at_end"))


def overtakes(sessions: DataFrame, positions: DataFrame, first: float = 0.25, second: float = 0.75, strategy: str = "split") -> DataFrame:
    """Per (session, driver): position at two instants of the session (shares
    of its duration), and how many drivers were ahead at the first and behind
    at the second (``made``) or the other way round (``suffered``).

    Inversions are counted between groups of drivers with the same two
    positions - at most the square of the places a session has - and not
    between drivers."""
    changes = position_changes(positions, strategy)
    lo, hi = epoch_micros("session_start"), epoch_micros("session_end")
    at = lambda share: F.timestamp_micros(lo + F.floor((hi - lo) * share)).cast("timestamp_ntz")
    when = sessions.select("session_key", F.explode(F.array(F.struct(F.lit(1).alias("k"), at(first).alias("at")),
                                                            F.struct(F.lit(2).alias("k"), at(second).alias("at")))).alias("e")).select("session_key", "e.*")
    points = changes.select(*DRIVER_KEYS).distinct().join(when.where("at is not null"), "session_key")
    held = positions_at(points, changes, "at", strategy)
    pairs = held.groupBy(*DRIVER_KEYS).agg(*[F.min(F.when(F.col("k") == k, F.col("position"))).alias(f"position_{k}") for k in (1, 2)])
    pairs = pairs.where("position_1 is not null and position_2 is not null")
    cells = pairs.groupBy("session_key", "position_1", "position_2").agg(F.count(F.lit(1)).alias("n"))
    other = cells.select("session_key", F.col("position_1").alias("q1"), F.col("position_2").alias("q2"), F.col("n").alias("m"))
    passed = (F.col("q1") < F.col("position_1")) & (F.col("q2") > F.col("position_2"))
    lost = (F.col("q1") > F.col("position_1")) & (F.col("q2") < F.col("position_2"))
    counted = cells.join(other, "session_key").groupBy("session_key", "position_1", "position_2").agg(
        F.sum(F.when(passed, F.col("m")).otherwise(0)).alias("made"), F.sum(F.when(lost, F.col("m")).otherwise(0)).alias("suffered"))
    return pairs.join(counted, ["session_key", "position_1", "position_2"]).select(*DRIVER_KEYS, "position_1", "position_2", "made", "suffered")
