"""Gold models (M12-M18): lap leaderboard, dimensions, dashboard laps,
tyre degradation, lap V-min points and official results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.functions.scalar import composite_key, round_half_up, safe_ratio
from trackline.operators.ordered import ordered_window, with_buckets
from trackline.operators.ranking import first_by, group_rank, value_ranks
from trackline.operators.segments import number_segments

DRIVER_KEYS = ["session_key", "driver_number"]
LAP_KEYS = ["session_key", "driver_number", "lap_number"]


def lap_aggregates(enriched: DataFrame) -> DataFrame:
    """Per (lap, compound) telemetry aggregates (A1-A3).  A NULL compound is
    its own group, so a lap can yield two rows."""
    return enriched.groupBy(*LAP_KEYS, "lap_duration", "tire_compound").agg(
        F.bool_or("is_pit_out_lap").alias("is_pit_out_lap"),
        F.max("speed").alias("top_speed"),
        F.min("speed").alias("v_min"),
        F.avg("throttle").alias("avg_throttle"),
        F.avg("brake").alias("avg_brake"),
        F.avg("track_temperature").alias("avg_track_temp"),
        F.bool_or("is_raining").alias("rained_during_lap"),
        F.max("current_tire_age").alias("tire_age_at_lap_end"),
        F.max("pit_stop_duration_seconds").alias("pit_stop_time"))


LEADERBOARD_COLUMNS = [
    "session_key", "driver_number", "lap_number", "lap_duration", "tire_compound", "is_pit_out_lap",
    "top_speed", "v_min", "avg_throttle", "avg_brake", "avg_track_temp", "rained_during_lap",
    "tire_age_at_lap_end", "pit_stop_time", "fastest_lap_rank", "throttle_brake_ratio"]


def lap_leaderboard(enriched: DataFrame) -> DataFrame:
    """Positive-duration laps ranked within their session (the filter
    applies before the rank)."""
    return rank_laps(lap_aggregates(enriched))


def rank_laps(lap_aggs: DataFrame) -> DataFrame:
    """The leaderboard from lap aggregates (a materialised lap-grain table
    in the warehouse build, so the rank's counts and the rank read laps,
    not samples)."""
    laps = lap_aggs.where(F.col("lap_duration") > 0)
    ranked = group_rank(laps, ["session_key"], "lap_duration", "fastest_lap_rank")
    return ranked.withColumn(
        "throttle_brake_ratio", round_half_up(safe_ratio("avg_throttle", "avg_brake"), 2)
    ).select(*LEADERBOARD_COLUMNS)


DIM_SESSION_COLUMNS = [
    "session_key", "meeting_key", "session_name", "session_type", "session_start", "session_end",
    "season", "meeting_name", "circuit_key", "circuit_short_name", "circuit_type", "country_name",
    "location", "meeting_start", "meeting_end"]


def dim_sessions(sessions: DataFrame, meetings: DataFrame, leaderboard: DataFrame) -> DataFrame:
    """Sessions that have leaderboard laps (semi join), with meeting
    attributes (left join)."""
    available = leaderboard.select("session_key")
    s = sessions.join(available, "session_key", "left_semi")
    return s.join(meetings.drop("season"), "meeting_key", "left").select(*DIM_SESSION_COLUMNS)


def dim_drivers(drivers: DataFrame, leaderboard: DataFrame) -> DataFrame:
    """Drivers of a session that have leaderboard laps."""
    return drivers.join(leaderboard.select(*DRIVER_KEYS), DRIVER_KEYS, "left_semi")


DASHBOARD_COLUMNS = [
    "lap_id", "driver_session_id", "session_key", "meeting_key", "driver_number", "lap_number",
    "full_name", "name_acronym", "team_name", "team_colour_hex", "meeting_name", "session_name",
    "season", "circuit_short_name", "country_name", "location", "lap_duration", "fastest_lap_rank",
    "driver_fastest_lap_rank", "delta_to_session_best", "delta_to_driver_best", "top_speed", "v_min",
    "avg_throttle", "avg_brake", "throttle_brake_ratio", "tire_compound", "tire_age_at_lap_end",
    "is_pit_out_lap", "pit_stop_time", "avg_track_temp", "rained_during_lap"]


def dashboard_laps(leaderboard: DataFrame, drivers: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per leaderboard lap with driver and session context,
    rank within the driver and deltas to the session / driver best."""
    d = drivers.select(*DRIVER_KEYS, "driver_session_id", "full_name", "name_acronym", "team_name",
                       "team_colour_hex")
    s = sessions.select("session_key", "meeting_key", "meeting_name", "session_name", "season",
                        "circuit_short_name", "country_name", "location")
    # ranks and bests come from the laps' keys and times alone; the wide rows
    # are joined once
    times = leaderboard.select(*DRIVER_KEYS, "lap_duration").join(d.select(*DRIVER_KEYS), DRIVER_KEYS).join(s.select("session_key"), "session_key")
    ranks = value_ranks(times, DRIVER_KEYS, "lap_duration", "driver_fastest_lap_rank")
    bests = times.groupBy(*DRIVER_KEYS).agg(F.min("lap_duration").alias("_driver_best"))
    bests = bests.join(bests.groupBy("session_key").agg(F.min("_driver_best").alias("_session_best")), "session_key")
    j = leaderboard.join(d, DRIVER_KEYS).join(s, "session_key").join(bests, DRIVER_KEYS)
    j = j.join(ranks, [*DRIVER_KEYS, "lap_duration"])
    return j.select(
        composite_key("session_key", "driver_number", "lap_number").alias("lap_id"), "*",
        (F.col("lap_duration") - F.col("_session_best")).alias("delta_to_session_best"),
        (F.col("lap_duration") - F.col("_driver_best")).alias("delta_to_driver_best"),
    ).select(*DASHBOARD_COLUMNS)


def clean_laps(laps: DataFrame) -> DataFrame:
    """racing laps for degradation - not a pit-out lap (NULL counts as
    not clean), no pit stop, compound and tyre age known."""
    return laps.where(~F.col("is_pit_out_lap") & F.col("pit_stop_time").isNull()
                      & F.col("tire_compound").isNotNull() & F.col("tire_age_at_lap_end").isNotNull())


def stint_starts(laps: DataFrame, strategy: str = "split", bucket: str | None = None) -> DataFrame:
    """A lap starts a strategy stint when it is the driver's first clean
    lap, the compound changes, or the tyre age does not increase."""
    lagged = ordered_window(laps, DRIVER_KEYS, "lap_number", strategy=strategy, bucket=bucket,
                            lags=[("tire_compound", 1, "_prev_c"), ("tire_age_at_lap_end", 1, "_prev_a")])
    prev_c, prev_a = F.col("_prev_c"), F.col("_prev_a")
    return lagged.withColumn("starts_new_stint", F.when(prev_c.isNull(), 1)
                             .when(F.col("tire_compound") != prev_c, 1)
                             .when(F.col("tire_age_at_lap_end") <= prev_a, 1).otherwise(0)
                             ).drop("_prev_c", "_prev_a")


DEGRADATION_COLUMNS = [
    "degradation_id", "lap_id", "driver_session_id", "session_key", "driver_number", "full_name",
    "name_acronym", "team_name", "team_colour_hex", "lap_number", "strategy_stint_number",
    "lap_in_stint", "tire_compound", "tire_age_at_lap_end", "lap_duration", "delta_to_stint_best",
    "rolling_three_lap_average", "avg_track_temp", "rained_during_lap"]


def tire_degradation(laps: DataFrame, strategy: str = "split") -> DataFrame:
    """Clean laps in inferred stints with running degradation metrics.

    The stint window orders by lap; ``delta_to_stint_best`` is to the best
    lap *so far* in the stint (running MIN), as in the reference.  The three
    windows share one bucketing of a car's laps: a stint's laps are some of
    its car's.
    """
    clean, bucket = clean_laps(laps), None
    if strategy == "split":
        bucket = "_laps"
        clean = with_buckets(clean, DRIVER_KEYS, "lap_number", bucket, whole=True)
    s = stint_starts(clean, strategy, bucket)
    s = number_segments(s, DRIVER_KEYS, "lap_number", F.col("starts_new_stint") == 1,
                        "strategy_stint_number", strategy=strategy, bucket=bucket)
    s = ordered_window(s, DRIVER_KEYS + ["strategy_stint_number"], "lap_number", strategy=strategy, bucket=bucket,
                       row_number="lap_in_stint", running_min=[("lap_duration", "_stint_best")],
                       avg_last3=[("lap_duration", "rolling_three_lap_average")])
    return s.select(
        F.concat(F.col("lap_id"), F.lit("-stint-"), F.col("strategy_stint_number").cast("string"))
        .alias("degradation_id"), "*",
        (F.col("lap_duration") - F.col("_stint_best")).alias("delta_to_stint_best"),
    ).select(*DEGRADATION_COLUMNS)


V_MIN_COLUMNS = [
    "session_key", "driver_number", "lap_number", "v_min_timestamp", "lap_v_min", "v_min_gear",
    "v_min_throttle", "v_min_brake", "x", "y", "tire_compound", "current_tire_age", "track_flag",
    "track_temperature", "is_raining"]


def corner_performance(enriched: DataFrame) -> DataFrame:
    """The lap's slowest sample with a known position (earliest on a
    speed tie) - an arg-min aggregate, no sort of the lap's samples."""
    pts = enriched.where(F.col("lap_number").isNotNull() & F.col("speed").isNotNull()
                         & F.col("x").isNotNull() & F.col("y").isNotNull())
    cols = ["telemetry_timestamp", "speed", "n_gear", "throttle", "brake", "x", "y", "tire_compound",
            "current_tire_age", "track_flag", "track_temperature", "is_raining"]
    # speed, then time; the remaining columns only make exact duplicates
    # (pit fan-out) pick deterministically
    best = first_by(pts, LAP_KEYS, ["speed", "telemetry_timestamp"] + cols[2:], columns=cols)
    return best.select(*LAP_KEYS, F.col("telemetry_timestamp").alias("v_min_timestamp"),
                       F.col("speed").alias("lap_v_min"), F.col("n_gear").alias("v_min_gear"),
                       F.col("throttle").alias("v_min_throttle"), F.col("brake").alias("v_min_brake"),
                       "x", "y", "tire_compound", "current_tire_age", "track_flag", "track_temperature",
                       "is_raining")


RACE_RESULT_COLUMNS = [
    "result_id", "session_key", "meeting_key", "season", "meeting_name", "session_name",
    "session_start", "circuit_short_name", "country_name", "location", "driver_number", "full_name",
    "name_acronym", "team_name", "team_colour_hex", "finishing_position", "number_of_laps", "points",
    "race_duration_seconds", "gap_to_leader", "gap_to_leader_seconds", "result_status", "dnf", "dns",
    "dsq"]


def race_results(results: DataFrame, sessions: DataFrame, drivers: DataFrame) -> DataFrame:
    """Classified results of sessions and drivers that have laps."""
    s = sessions.select("session_key", "meeting_key", "season", "meeting_name", "session_name",
                        "session_start", "circuit_short_name", "country_name", "location")
    d = drivers.select(*DRIVER_KEYS, "full_name", "name_acronym", "team_name", "team_colour_hex")
    return (results.join(s, ["session_key", "meeting_key"]).join(d, DRIVER_KEYS)
            .select(*RACE_RESULT_COLUMNS))
