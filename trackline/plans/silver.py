"""Silver models: telemetry assigned to laps (M10) and enriched with the
as-of context of weather, track flags and car position, tyre stint and pit
stop (M11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.scalar import DEFAULT_TRACK_FLAG, add_seconds_ms
from trackline.operators.asof import asof_fill
from trackline.operators.bands import band_join
from trackline.operators.interval import interval_join
from trackline.operators.ordered import ordered_window
from trackline.plans import staging as stg

DRIVER_KEYS = ["session_key", "driver_number"]
SAMPLE_COLUMNS = ["speed", "rpm", "n_gear", "throttle", "brake", "drs"]

# Order of streams that share one instant (fixed): context recorded at the
# same instant is visible to the car sample.
RECORD_RANK = {"weather": 0, "race_control": 1, "location": 2, "telemetry": 3}
# race-control rows that set the track status (fixed values)
TRACK_STATUS_CATEGORIES = ("Flag", "SafetyCar")
IGNORED_FLAG = "BLUE"


def lap_boundaries(laps_raw: DataFrame, strategy: str = "split") -> DataFrame:
    """[lap_start, lap_end): the next lap's start, else start + duration."""
    laps = laps_raw.select(*DRIVER_KEYS, "lap_number", "date_start", "lap_duration", "is_pit_out_lap")
    nxt = ordered_window(laps, DRIVER_KEYS, "lap_number", leads=[("date_start", "_next_start")],
                         strategy=strategy)
    return nxt.select(
        *DRIVER_KEYS, "lap_number", F.col("date_start").alias("lap_start"),
        F.coalesce(F.col("_next_start"), add_seconds_ms("date_start", "lap_duration")).alias("lap_end"),
        "lap_duration", "is_pit_out_lap")


def telemetry_laps(tables, bucket_us: int | None = None) -> DataFrame:
    """Every car sample inside a lap, tagged with that lap."""
    bounds = lap_boundaries(tables["laps_raw"])
    t = tables["telemetry_raw"].select(*DRIVER_KEYS, "date", *SAMPLE_COLUMNS)
    j = interval_join(t, bounds, DRIVER_KEYS, "date", "lap_start", "lap_end", bucket_us=bucket_us)
    return j.select(*DRIVER_KEYS, "lap_number", F.col("date").alias("telemetry_timestamp"),
                    *SAMPLE_COLUMNS, "is_pit_out_lap", "lap_duration")


def track_status_rows(race_control: DataFrame) -> DataFrame:
    """Race-control rows that change the track status (a NULL flag and the
    BLUE flag are not status changes)."""
    return race_control.where(F.col("category").isin(*TRACK_STATUS_CATEGORIES)
                              & (F.col("flag") != IGNORED_FLAG))


def _tagged(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("record_type", F.lit(kind)).withColumn("_rank", F.lit(RECORD_RANK[kind]))


def _car_rows(tl: DataFrame) -> DataFrame:
    return _tagged(tl.withColumnRenamed("telemetry_timestamp", "ts"), "telemetry")


def _weather_rows(weather: DataFrame) -> DataFrame:
    return _tagged(weather.select("session_key", F.col("weather_timestamp").alias("ts"),
                                  F.col("air_temperature").alias("air_temp"),
                                  F.col("track_temperature").alias("track_temp"),
                                  F.col("is_raining").alias("raining")), "weather")


def _flag_rows(race_control: DataFrame) -> DataFrame:
    return _tagged(track_status_rows(race_control).select(
        "session_key", F.col("event_timestamp").alias("ts"), F.col("flag").alias("track_flag")),
        "race_control")


def _location_rows(location: DataFrame) -> DataFrame:
    return _tagged(location.select(*DRIVER_KEYS, F.col("location_timestamp").alias("ts"), "x", "y"),
                   "location")


def _union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def unified_stream(tl: DataFrame, weather: DataFrame, race_control: DataFrame,
                   location: DataFrame) -> DataFrame:
    """Four differently shaped streams on one ``ts`` axis (UNION ALL padded
    with NULLs), tagged with ``record_type``."""
    return _union(_car_rows(tl), _weather_rows(weather), _flag_rows(race_control),
                  _location_rows(location))


def telemetry_context(tl: DataFrame, weather: DataFrame, race_control: DataFrame,
                      location: DataFrame, rows_per_bucket: int = 4096,
                      samples: DataFrame | None = None, strategy: str = "split") -> DataFrame:
    """Car samples with the last known weather / flag (per session) and
    position (per driver) at their instant.

    Session-wide context and per-driver position are two as-of fills with
    different keys; weather and flag rows carry no driver, so they are kept
    out of the per-driver fill (only car samples are kept afterwards).
    ``samples`` (session_key, driver_number, ts) gives the fills the row
    density of the car data without evaluating ``tl`` twice.
    """
    session_ctx = _union(_car_rows(tl), _weather_rows(weather), _flag_rows(race_control))
    filled = asof_fill(session_ctx, ["session_key"], "ts", "_rank",
                       ["air_temp", "track_temp", "raining", "track_flag"],
                       rows_per_bucket=rows_per_bucket, strategy=strategy,
                       density=samples.select("session_key", "ts") if samples is not None else None)
    cars = filled.where(F.col("record_type") == "telemetry").drop(
        "air_temp", "track_temp", "raining", "track_flag")
    driver_ctx = _union(cars, _location_rows(location))
    filled2 = asof_fill(driver_ctx, DRIVER_KEYS, "ts", "_rank", ["x", "y"],
                        rows_per_bucket=rows_per_bucket, density=samples, strategy=strategy)
    cars2 = filled2.where(F.col("record_type") == "telemetry")
    return cars2.select(
        *DRIVER_KEYS, "lap_number", F.col("ts").alias("telemetry_timestamp"), *SAMPLE_COLUMNS,
        "is_pit_out_lap", "lap_duration",
        F.col("air_temp_filled").alias("air_temperature"),
        F.col("track_temp_filled").alias("track_temperature"),
        F.col("raining_filled").alias("is_raining"),
        F.coalesce(F.col("track_flag_filled"), F.lit(DEFAULT_TRACK_FLAG)).alias("track_flag"),
        F.col("x_filled").alias("x"), F.col("y_filled").alias("y"))


def stint_bounds(stints: DataFrame, strategy: str = "split") -> DataFrame:
    """Stints closed at the lap before the next stint starts (W2); stints
    are ordered by their first lap, unknown first laps first."""
    s = stints.select(*DRIVER_KEYS, "lap_start", "lap_end", "tire_compound", "tyre_age_at_start")
    nxt = ordered_window(s, DRIVER_KEYS, "lap_start", leads=[("lap_start", "_next_start")], strategy=strategy)
    return nxt.select(
        *DRIVER_KEYS, "lap_start",
        F.coalesce(F.col("_next_start") - 1, F.col("lap_end")).alias("clean_lap_end"),
        "tire_compound", "tyre_age_at_start")


def with_stints(df: DataFrame, stints: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    """LEFT band join on lap_number BETWEEN lap_start AND clean_lap_end."""
    j = band_join(df, stint_bounds(stints), DRIVER_KEYS, "lap_number", "lap_start", "clean_lap_end",
                  how="left", domain=laps.select(*DRIVER_KEYS, "lap_number") if laps is not None else None)
    age: Column = F.col("tyre_age_at_start") + (F.col("lap_number") - F.col("lap_start"))
    return j.withColumn("current_tire_age", age).drop("lap_start", "clean_lap_end", "tyre_age_at_start")


def with_pits(df: DataFrame, pits: DataFrame) -> DataFrame:
    """LEFT equi join on (session, driver, lap); several pit rows of one lap
    fan the samples out, as in the reference."""
    p = pits.select(*DRIVER_KEYS, "lap_number", "pit_stop_duration_seconds")
    return df.join(p, DRIVER_KEYS + ["lap_number"], "left")


ENRICHED_COLUMNS = [
    "session_key", "driver_number", "lap_number", "telemetry_timestamp", *SAMPLE_COLUMNS,
    "is_pit_out_lap", "lap_duration", "air_temperature", "track_temperature", "is_raining",
    "track_flag", "x", "y", "tire_compound", "current_tire_age", "pit_stop_duration_seconds"]


def enriched_telemetry(tables, tl: DataFrame | None = None, rows_per_bucket: int = 4096,
                       strategy: str = "split") -> DataFrame:
    """M11 at (sample x pit row) grain."""
    tl = tl if tl is not None else telemetry_laps(tables)
    ctx = telemetry_context(tl, stg.staged(tables, "stg_weather"),
                            stg.staged(tables, "stg_race_control"),
                            stg.staged(tables, "stg_location"), rows_per_bucket=rows_per_bucket,
                            samples=tables["telemetry_raw"].select(*DRIVER_KEYS, F.col("date").alias("ts")),
                            strategy=strategy)
    s = with_stints(ctx, stg.staged(tables, "stg_stints"), tables["laps_raw"])
    p = with_pits(s, stg.staged(tables, "stg_pits"))
    return p.select(*ENRICHED_COLUMNS)
