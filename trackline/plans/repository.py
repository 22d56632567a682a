"""Serving queries (R1-R11) over the gold and silver tables.

Each takes the model graph (:class:`trackline.plans.models.Models`) and
optional parameters.  A parameter left as ``None`` means "all": the query
then runs over the whole table (one row per group it would return for one
session / season).  An empty driver list returns an empty frame that keeps
its schema (the reference returns a frame without columns).

Ordering is applied at the serving edge only (``ordered=True``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.operators.ranking import first_by


def _eq(col: str, value) -> Column:
    return F.lit(True) if value is None else (F.col(col) == F.lit(value))


def _among(col: str, values: Sequence[int] | None) -> Column:
    if values is None:
        return F.lit(True)
    if len(values) == 0:
        return F.lit(False)
    return F.col(col).isin(list(values))


def _order(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    return df.orderBy(*cols) if ordered else df


SESSION_COLUMNS = ["session_key", "meeting_name", "session_name", "season", "circuit_short_name",
                   "country_name", "location", "session_start"]


def sessions(m, ordered: bool = False) -> DataFrame:
    """Analytics-ready sessions, newest first."""
    return _order(m.dim_sessions.select(*SESSION_COLUMNS), ordered, F.col("session_start").desc())


def season_races(m, season: int | None = None, ordered: bool = False) -> DataFrame:
    """R2: one row per race of the season with lap KPIs."""
    laps = m.dashboard_laps.where(_eq("season", season))
    s = m.dim_sessions.select("session_key", "session_start")
    g = laps.join(s, "session_key").groupBy("session_key").agg(
        F.any_value("meeting_name").alias("meeting_name"),
        F.any_value("circuit_short_name").alias("circuit_short_name"),
        F.any_value("country_name").alias("country_name"),
        F.any_value("location").alias("location"),
        F.any_value("session_start").alias("session_start"),
        F.count_distinct("driver_number").alias("driver_count"),
        F.count(F.lit(1)).alias("lap_count"),
        F.min("lap_duration").alias("fastest_lap"),
        # ARRAY_AGG(... ORDER BY lap_duration LIMIT 1)[0]; ties -> lowest
        # lap, then driver number
        F.min_by("name_acronym", F.struct("lap_duration", "lap_number", "driver_number"))
        .alias("fastest_driver"),
        F.max("top_speed").alias("top_speed"),
        F.bool_or("rained_during_lap").alias("was_wet"))
    return _order(g, ordered, "session_start")


def _latest(col: str) -> Column:
    """ANY_VALUE made deterministic: the value of the latest session (a
    driver can change team during a season)."""
    return F.max_by(col, "session_key").alias(col)


DRIVER_ATTRS = ["full_name", "name_acronym", "team_name", "team_colour_hex"]


def season_drivers(m, season: int | None = None, ordered: bool = False) -> DataFrame:
    """One row per driver of the season."""
    laps = m.dashboard_laps.where(_eq("season", season))
    g = laps.groupBy("driver_number").agg(
        *[_latest(c) for c in DRIVER_ATTRS],
        F.count_distinct("session_key").alias("races"),
        F.count(F.lit(1)).alias("laps"),
        F.min("lap_duration").alias("fastest_lap"),
        F.avg("delta_to_driver_best").alias("average_delta_to_best"),
        F.max("top_speed").alias("top_speed"))
    return _order(g, ordered, "fastest_lap")


def season_winners(m, season: int | None = None, ordered: bool = False) -> DataFrame:
    """Drivers with at least one win in the season."""
    r = m.race_results.where(_eq("season", season))
    g = r.groupBy("driver_number").agg(
        *[_latest(c) for c in DRIVER_ATTRS],
        F.count_if(F.col("finishing_position") == 1).alias("wins"),
        F.count_if(F.col("finishing_position") <= 3).alias("podiums"),
        F.sum("points").alias("points"))
    return _order(g.where(F.col("wins") > 0), ordered, F.col("wins").desc(), F.col("points").desc())


RESULT_COLUMNS = ["result_id", "session_key", "driver_number", "full_name", "name_acronym", "team_name",
                  "team_colour_hex", "finishing_position", "number_of_laps", "points", "gap_to_leader",
                  "result_status"]


def race_results(m, session_key: int | None = None, ordered: bool = False) -> DataFrame:
    """Official classification of a race."""
    r = m.race_results.where(_eq("session_key", session_key)).select(*RESULT_COLUMNS)
    return _order(r, ordered, "finishing_position")


DRIVER_COLUMNS = ["driver_session_id", "session_key", "driver_number", "full_name", "name_acronym",
                  "team_name", "team_colour_hex"]


def drivers(m, session_key: int | None = None, ordered: bool = False) -> DataFrame:
    """Drivers of a race, by team then number."""
    d = m.dim_drivers.where(_eq("session_key", session_key)).select(*DRIVER_COLUMNS)
    return _order(d, ordered, "team_name", "driver_number")


def laps(m, session_key: int | None = None, driver_numbers: Sequence[int] | None = None,
         ordered: bool = False) -> DataFrame:
    """Dashboard laps of the selected drivers."""
    d = m.dashboard_laps.where(_eq("session_key", session_key) & _among("driver_number", driver_numbers))
    return _order(d, ordered, "lap_number", "driver_number")


def tire_degradation(m, session_key: int | None = None, driver_numbers: Sequence[int] | None = None,
                     ordered: bool = False) -> DataFrame:
    """Degradation rows of the selected drivers."""
    d = m.tire_degradation.where(_eq("session_key", session_key) & _among("driver_number", driver_numbers))
    return _order(d, ordered, "driver_number", "lap_number")


V_MIN_COLUMNS = ["session_key", "driver_number", "lap_number", "v_min_timestamp", "lap_v_min", "v_min_gear",
                 "v_min_throttle", "v_min_brake", "x", "y", "tire_compound", "current_tire_age", "track_flag"]


def v_min_points(m, session_key: int | None = None, driver_numbers: Sequence[int] | None = None,
                 ordered: bool = False) -> DataFrame:
    """Lap V-min points of the selected drivers."""
    d = (m.corner_performance.where(_eq("session_key", session_key) & _among("driver_number", driver_numbers))
         .select(*V_MIN_COLUMNS))
    return _order(d, ordered, "driver_number", "lap_number")


TELEMETRY_COLUMNS = ["telemetry_timestamp", "speed", "rpm", "n_gear", "throttle", "brake", "drs", "x", "y"]


def telemetry(m, session_key: int | None = None, driver_number: int | None = None,
              lap_number: int | None = None, ordered: bool = False) -> DataFrame:
    """Enriched samples of one lap (all laps when unset)."""
    e = m.enriched.where(_eq("session_key", session_key) & _eq("driver_number", driver_number)
                         & _eq("lap_number", lap_number)).select(*TELEMETRY_COLUMNS)
    return _order(e, ordered, "telemetry_timestamp")


def fastest_laps_of(m, session_key: int | None = None,
                    driver_numbers: Sequence[int] | None = None) -> DataFrame:
    """Each driver's quickest timed lap that is not a pit-out lap (ties ->
    lowest lap number); one row per (session, driver)."""
    d = m.dashboard_laps.where(_eq("session_key", session_key) & _among("driver_number", driver_numbers)
                               & F.col("lap_duration").isNotNull() & ~F.col("is_pit_out_lap"))
    return first_by(d, ["session_key", "driver_number"], ["lap_duration", "lap_number"],
                    columns=["lap_number"])


def fastest_lap_telemetry(m, session_key: int | None = None, driver_numbers: Sequence[int] | None = None,
                          ordered: bool = False) -> DataFrame:
    """Samples of each selected driver's fastest clean lap."""
    fl = fastest_laps_of(m, session_key, driver_numbers)
    t = m.enriched.where(_eq("session_key", session_key)).select(
        "session_key", "driver_number", "lap_number", "telemetry_timestamp", "speed", "throttle", "brake")
    d = m.dim_drivers.select("session_key", "driver_number", "full_name", "name_acronym", "team_colour_hex")
    j = t.join(fl, ["session_key", "driver_number", "lap_number"]).join(d, ["session_key", "driver_number"])
    out = j.select("telemetry_timestamp", "driver_number", "full_name", "name_acronym", "team_colour_hex",
                   "lap_number", "speed", "throttle", "brake")
    return _order(out, ordered, "driver_number", "telemetry_timestamp")
