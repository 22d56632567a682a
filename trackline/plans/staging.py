"""Staging models (M1-M9): renames, keys and light normalisation.

Each takes the bronze DataFrame and returns a lazy DataFrame (a view:
never cached, so filters and column pruning reach the bronze scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.functions.scalar import (
    ONGOING_STINT_LAP_END,
    composite_key,
    hex_colour,
    result_status,
    safe_double,
)

# race-control categories kept for telemetry analysis (fixed values)
STAGED_RACE_CONTROL_CATEGORIES = ("Flag", "SafetyCar", "Drs")


def stg_drivers(driver_raw: DataFrame) -> DataFrame:
    return driver_raw.select(
        composite_key("session_key", "driver_number").alias("driver_session_id"),
        "session_key", "driver_number", "broadcast_name", "full_name", "name_acronym", "team_name",
        hex_colour("team_colour").alias("team_colour_hex"))


def stg_location(location_raw: DataFrame) -> DataFrame:
    return location_raw.select("session_key", "driver_number",
                               F.col("date").alias("location_timestamp"), "x", "y", "z")


def stg_meetings(meetings_metadata: DataFrame) -> DataFrame:
    return meetings_metadata.select(
        "meeting_key", "circuit_key", "meeting_name", "circuit_short_name", "circuit_type",
        "country_name", "location", F.col("date_start").alias("meeting_start"),
        F.col("date_end").alias("meeting_end"), F.col("year").alias("season"))


def stg_pits(pits_raw: DataFrame) -> DataFrame:
    return pits_raw.select("session_key", "driver_number", "lap_number",
                           F.col("date").alias("pit_entry_timestamp"),
                           F.col("stop_duration").alias("pit_stop_duration_seconds"))


def stg_race_control(race_control_raw: DataFrame) -> DataFrame:
    return (race_control_raw
            .where(F.col("category").isin(*STAGED_RACE_CONTROL_CATEGORIES))
            .select("session_key", F.col("date").alias("event_timestamp"), "driver_number",
                    "category", "flag", "message", "lap_number"))


def stg_session_results(session_results_raw: DataFrame) -> DataFrame:
    return (session_results_raw
            .where(F.col("position").isNotNull())
            .select(
                composite_key("session_key", "driver_number").alias("result_id"),
                "session_key", "meeting_key", "driver_number",
                F.col("position").alias("finishing_position"), "number_of_laps", "points",
                F.col("duration").alias("race_duration_seconds"), "gap_to_leader",
                safe_double("gap_to_leader").alias("gap_to_leader_seconds"),
                "dnf", "dns", "dsq",
                result_status("dsq", "dns", "dnf").alias("result_status")))


def stg_sessions(sessions_metadata: DataFrame) -> DataFrame:
    return sessions_metadata.select(
        "session_key", "meeting_key", "session_name", "session_type",
        F.col("date_start").alias("session_start"), F.col("date_end").alias("session_end"),
        F.col("year").alias("season"))


def stg_stints(stints_raw: DataFrame) -> DataFrame:
    return stints_raw.select(
        "session_key", "driver_number", "stint_number",
        F.upper("compound").alias("tire_compound"), "tyre_age_at_start", "lap_start",
        F.coalesce(F.col("lap_end"), F.lit(ONGOING_STINT_LAP_END).cast("bigint")).alias("lap_end"))


def stg_weather(weather_raw: DataFrame) -> DataFrame:
    return weather_raw.select(
        "session_key", F.col("date").alias("weather_timestamp"), "air_temperature",
        "track_temperature", "humidity", "pressure", "wind_direction", "wind_speed",
        F.col("rainfall").alias("is_raining"))


STAGING = {
    "stg_drivers": (stg_drivers, "driver_raw"),
    "stg_location": (stg_location, "location_raw"),
    "stg_meetings": (stg_meetings, "meetings_metadata"),
    "stg_pits": (stg_pits, "pits_raw"),
    "stg_race_control": (stg_race_control, "race_control_raw"),
    "stg_session_results": (stg_session_results, "session_results_raw"),
    "stg_sessions": (stg_sessions, "sessions_metadata"),
    "stg_stints": (stg_stints, "stints_raw"),
    "stg_weather": (stg_weather, "weather_raw"),
}


def staged(tables, name: str) -> DataFrame:
    fn, src = STAGING[name]
    return fn(tables[src])
