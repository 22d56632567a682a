"""Dashboard frames derived from serving results (A12-A16, X12-X17, O2-O4,
J11): KPIs, labels, podium and default selection, axis ranges.

The reference computes these in pandas on a fetched result.  Here each is
a DataFrame transformation; ``keys`` (default: none) lets one call compute
the frame for every session at once instead of one fetched session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackline.functions.scalar import (
    PLACEHOLDER,
    conditions_label,
    driver_label,
    epoch_micros,
    format_lap_time,
    session_label,
    speed_label,
    thousands,
)
from trackline.operators.ranking import first_by, with_group_min

# fixed values of the dashboard
AXIS_PADDING = 0.05
BRAKE_SCALE = 100          # brake (0/1) drawn on the 0-100 throttle scale
PODIUM_SIZE = 3
DEFAULT_SELECTION = 3


def fastest_laps(laps: DataFrame, keys: Sequence[str] = ("driver_number",)) -> DataFrame:
    """Each driver's fastest timed lap (whole row); ties -> lowest lap."""
    clean = laps.where(F.col("lap_duration").isNotNull() & ~F.isnan("lap_duration"))
    return first_by(clean, list(keys), ["lap_duration", "lap_number"])


def session_leaderboard(laps: DataFrame, keys: Sequence[str] = ("driver_number",)) -> DataFrame:
    """Best lap per driver with the leaderboard columns."""
    # sorted by lap time with unknown times last, ties -> lowest lap
    best = first_by(laps, list(keys), [F.col("lap_duration").isNull(), "lap_duration", "lap_number"])
    extra = [k for k in keys if k != "driver_number"]
    return best.select(*extra, "driver_number", "name_acronym", "team_name", "lap_number", "lap_duration",
                       "top_speed", "tire_compound")


def overview_metrics(laps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Fastest lap (formatted) and its driver, top speed, lap count.
    Without keys an empty input still yields one row of placeholders."""
    g = laps.groupBy(*keys) if keys else laps
    agg = g.agg(
        F.min("lap_duration").alias("_fast"),
        # first occurrence of the minimum, made deterministic; laps without a time never win
        F.min_by("name_acronym", F.when(F.col("lap_duration").isNotNull(),
                                        F.struct("lap_duration", "lap_number", "driver_number"))).alias("_drv"),
        F.max("top_speed").alias("_top"),
        F.count(F.lit(1)).alias("_n"))
    return agg.select(
        *keys,
        format_lap_time("_fast").alias("fastest_lap"),
        F.coalesce(F.col("_drv").cast("string"), F.lit(PLACEHOLDER)).alias("fastest_driver"),
        speed_label("_top").alias("top_speed"),
        thousands("_n").alias("lap_count"))


def season_metrics(races: DataFrame, drivers: DataFrame) -> DataFrame:
    """Season KPIs as one row.  The two inputs are tagged and
    aggregated in one pass (no join of the two single-row results)."""
    r = races.select(F.lit(1).alias("_is_race"), "fastest_lap", "fastest_driver", "lap_count",
                     "session_start")
    d = drivers.select(F.lit(0).alias("_is_race"))
    both = r.unionByName(d, allowMissingColumns=True)
    agg = both.agg(
        F.count_if(F.col("_is_race") == 1).alias("_races"),
        F.count_if(F.col("_is_race") == 0).alias("_drivers"),
        F.sum(F.when(F.col("_is_race") == 1, F.col("lap_count"))).alias("_laps"),
        F.min("fastest_lap").alias("_fast"),
        F.min_by("fastest_driver", F.when((F.col("_is_race") == 1) & F.col("fastest_lap").isNotNull(),
                                           F.struct("fastest_lap", "session_start")))
        .alias("_drv"))
    empty = F.col("_races") == 0
    return agg.select(
        thousands("_races").alias("race_count"),
        F.when(empty, F.lit("0")).otherwise(thousands("_drivers")).alias("driver_count"),
        thousands(F.coalesce(F.col("_laps"), F.lit(0))).alias("lap_count"),
        F.when(empty, F.lit(PLACEHOLDER)).otherwise(format_lap_time("_fast")).alias("fastest_lap"),
        F.when(empty, F.lit(PLACEHOLDER)).otherwise(F.coalesce(F.col("_drv").cast("string"), F.lit("None")))
        .alias("fastest_driver"))


def elapsed_time(telemetry: DataFrame, keys: Sequence[str] = (), ts: str = "telemetry_timestamp",
                 out: str = "elapsed_seconds") -> DataFrame:
    """Seconds since the first sample (of the group)."""
    us = epoch_micros(ts)
    t = telemetry.withColumn("_el_us", us)
    # the first instant is an aggregate joined back (a one-row table when
    # there are no keys), not a window over the whole frame in one task
    if keys:
        t = with_group_min(t, list(keys), "_el_us", "_el_min")
    else:
        # one row by construction: broadcast it so no task receives every row
        first = t.agg(F.min("_el_us").alias("_el_min")).withColumn("_el_all", F.lit(0))
        t = t.withColumn("_el_all", F.lit(0)).join(F.broadcast(first), "_el_all")
    return (t.withColumn(out, (F.col("_el_us") - F.col("_el_min")) / F.lit(1e6))
            .drop("_el_us", "_el_min", "_el_all"))


def axis_range(df: DataFrame, col: str, keys: Sequence[str] = (), padding: float = AXIS_PADDING) -> DataFrame:
    """(axis_min, axis_max) padded by 5 % of the span; equal ends ->
    +-1; no values -> NULLs."""
    v = F.col(col).cast("double")
    g = df.where(v.isNotNull() & ~F.isnan(v))
    agg = (g.groupBy(*keys) if keys else g).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    close = F.abs(lo - hi) <= F.lit(1e-9) * F.greatest(F.abs(lo), F.abs(hi))
    margin = (hi - lo) * F.lit(padding)
    return agg.select(*keys,
                      F.when(close, lo - 1).otherwise(lo - margin).alias("axis_min"),
                      F.when(close, hi + 1).otherwise(hi + margin).alias("axis_max"))


def race_conditions(races: DataFrame) -> DataFrame:
    """X14 on the season race table: formatted fastest lap and conditions."""
    return races.select("session_key", "meeting_name", "circuit_short_name", "fastest_driver",
                        format_lap_time("fastest_lap").alias("fastest_lap_formatted"), "top_speed",
                        "driver_count", "lap_count", conditions_label("was_wet").alias("conditions"))


def session_labels(sessions: DataFrame) -> DataFrame:
    """Selector label per session."""
    return sessions.select("session_key", session_label("meeting_name", "session_name", "season").alias("label"))


def driver_labels(drivers: DataFrame) -> DataFrame:
    """Selector label per (session, driver)."""
    return drivers.select("session_key", "driver_number", driver_label("name_acronym", "team_name").alias("label"))


def season_options(sessions: DataFrame) -> DataFrame:
    """Distinct seasons (serve newest first)."""
    return sessions.select(F.col("season").cast("bigint").alias("season")).distinct()


def lap_options(laps: DataFrame) -> DataFrame:
    """The distinct lap numbers of each driver (serve ascending)."""
    return laps.where(F.col("lap_number").isNotNull()).select("session_key", "driver_number",
                                                              "lap_number").distinct()


def podium(results: DataFrame) -> DataFrame:
    """O2: the first three of each race's classification.  A race has at
    most one row per car, so the per-race window is bounded by the grid."""
    w = Window.partitionBy("session_key").orderBy("finishing_position", "driver_number")
    return (results.withColumn("podium_place", F.row_number().over(w).cast("bigint"))
            .where(F.col("podium_place") <= PODIUM_SIZE)
            .select("session_key", "driver_number", "finishing_position", "podium_place"))


def default_drivers(results: DataFrame, drivers: DataFrame) -> DataFrame:
    """O3: per race, the podium drivers present among the race's drivers;
    when none is, the first three drivers in (team, number) order."""
    keys = ["session_key", "driver_number"]
    pod = podium(results).join(drivers.select(*keys), keys, "left_semi").select(*keys)
    w = Window.partitionBy("session_key").orderBy("team_name", "driver_number")
    first3 = (drivers.withColumn("_pos", F.row_number().over(w)).where(F.col("_pos") <= DEFAULT_SELECTION)
              .select(*keys))
    fallback = first3.join(pod.select("session_key"), "session_key", "left_anti")
    return pod.unionByName(fallback)


def v_min_with_drivers(v_min: DataFrame, drivers: DataFrame) -> DataFrame:
    """V-min points with driver attributes (left join)."""
    d = drivers.select("session_key", "driver_number", "full_name", "name_acronym", "team_colour_hex")
    return v_min.join(d, ["session_key", "driver_number"], "left")


def clean_lap_table(laps: DataFrame) -> DataFrame:
    """Lap table of the analysis tab: laps that are not pit-out laps, with
    the formatted time."""
    return laps.where(~F.col("is_pit_out_lap")).select(
        "session_key", "name_acronym", "lap_number", format_lap_time("lap_duration").alias("formatted_time"),
        "delta_to_driver_best", "tire_compound", "tire_age_at_lap_end")


def telemetry_trace(telemetry: DataFrame, keys: Sequence[str] = ("driver_number",)) -> DataFrame:
    """A telemetry trace ready to draw - seconds since the
    driver's first sample of the trace and the brake on the 0-100 scale."""
    t = elapsed_time(telemetry, keys)
    return t.withColumn("brake_pct", F.col("brake") * F.lit(BRAKE_SCALE))
