"""Bronze table schemas and per-feed validation specs (fixed values).

Bronze schemas are declared, never inferred.  A validation spec lists each
field of a landed record with its type and whether it is required; the
reference validates every record against such a class before landing.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

L, D, S, B, T = LongType(), DoubleType(), StringType(), BooleanType(), TimestampNTZType()
DL = ArrayType(DoubleType())


def _st(*fields: tuple[str, object], required: tuple[str, ...] = ()) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in fields])


# Bronze external tables: name -> schema (partition columns included).
BRONZE_SCHEMAS: dict[str, StructType] = {
    "telemetry_raw": _st(("date", T), ("speed", L), ("rpm", L), ("n_gear", L), ("throttle", L),
                         ("brake", L), ("drs", L), ("session_key", L), ("driver_number", L)),
    "laps_raw": _st(("lap_number", L), ("date_start", T), ("lap_duration", D), ("duration_sector_1", D),
                    ("duration_sector_2", D), ("duration_sector_3", D), ("segments_sector_1", DL),
                    ("segments_sector_2", DL), ("segments_sector_3", DL), ("st_speed", L),
                    ("is_pit_out_lap", B), ("session_key", L), ("driver_number", L)),
    "location_raw": _st(("date", T), ("x", D), ("y", D), ("z", D), ("session_key", L), ("driver_number", L)),
    "position_raw": _st(("date", T), ("position", L), ("session_key", L), ("driver_number", L)),
    "stints_raw": _st(("stint_number", L), ("compound", S), ("tyre_age_at_start", L), ("lap_start", L),
                      ("lap_end", L), ("session_key", L), ("driver_number", L)),
    "pits_raw": _st(("date", T), ("lap_number", L), ("lane_duration", D), ("stop_duration", D),
                    ("session_key", L), ("driver_number", L)),
    "weather_raw": _st(("date", T), ("air_temperature", D), ("track_temperature", D), ("humidity", D),
                       ("pressure", D), ("wind_direction", D), ("wind_speed", D), ("rainfall", B),
                       ("session_key", L)),
    "race_control_raw": _st(("driver_number", L), ("date", T), ("category", S), ("flag", S),
                            ("lap_number", L), ("sector", L), ("scope", S), ("message", S), ("session_key", L)),
    "driver_raw": _st(("driver_number", L), ("broadcast_name", S), ("full_name", S), ("name_acronym", S),
                      ("team_name", S), ("team_colour", S), ("session_key", L)),
    "session_results_raw": _st(("session_key", L), ("meeting_key", L), ("driver_number", L), ("position", L),
                               ("number_of_laps", L), ("points", D), ("duration", D), ("gap_to_leader", S),
                               ("dnf", B), ("dns", B), ("dsq", B),
                               required=("session_key", "meeting_key", "driver_number", "points", "dnf",
                                         "dns", "dsq")),
    "sessions_metadata": _st(("session_key", L), ("session_name", S), ("session_type", S), ("meeting_key", L),
                             ("date_start", T), ("date_end", T), ("year", L)),
    "meetings_metadata": _st(("circuit_key", L), ("circuit_short_name", S), ("circuit_type", S),
                             ("country_name", S), ("meeting_key", L), ("meeting_name", S), ("location", S),
                             ("date_start", T), ("date_end", T), ("is_cancelled", B), ("year", L)),
}

# Hive partition columns of each landed table (directory names).
PARTITIONS: dict[str, tuple[str, ...]] = {
    "telemetry_raw": ("session_key", "driver_number"), "laps_raw": ("session_key", "driver_number"),
    "location_raw": ("session_key", "driver_number"), "position_raw": ("session_key", "driver_number"), "stints_raw": ("session_key", "driver_number"),
    "pits_raw": ("session_key", "driver_number"), "weather_raw": ("session_key",),
    "race_control_raw": ("session_key",), "driver_raw": ("session_key",), "session_results_raw": ("session_key",),
    "sessions_metadata": ("year",), "meetings_metadata": ("year",),
}

# Tables whose landed JSON may carry fields outside the schema (ignored);
# the results table is strict.
STRICT_TABLES = ("session_results_raw",)

# Validation specs: feed -> {field: (kind, required)}.  kinds: int, float,
# str, bool, ts, float_list (NULLs stripped, NULL list -> []), text (a
# number or a string, kept as its text).
REQ, OPT = True, False
FEED_SPECS: dict[str, dict[str, tuple[str, bool]]] = {
    "car_data": {"date": ("ts", REQ), "session_key": ("int", REQ), "meeting_key": ("int", REQ),
                 "driver_number": ("int", REQ), "speed": ("int", REQ), "rpm": ("int", REQ),
                 "n_gear": ("int", REQ), "throttle": ("int", REQ), "brake": ("int", REQ), "drs": ("int", REQ)},
    "laps": {"session_key": ("int", REQ), "meeting_key": ("int", REQ), "driver_number": ("int", REQ),
             "lap_number": ("int", REQ), "date_start": ("ts", OPT), "lap_duration": ("float", OPT),
             "duration_sector_1": ("float", OPT), "duration_sector_2": ("float", OPT),
             "duration_sector_3": ("float", OPT), "segments_sector_1": ("float_list", OPT),
             "segments_sector_2": ("float_list", OPT), "segments_sector_3": ("float_list", OPT),
             "st_speed": ("int", OPT), "is_pit_out_lap": ("bool", REQ)},
    "stints": {"session_key": ("int", REQ), "meeting_key": ("int", REQ), "driver_number": ("int", REQ),
               "stint_number": ("int", REQ), "compound": ("str", REQ), "tyre_age_at_start": ("int", REQ),
               "lap_start": ("int", OPT), "lap_end": ("int", OPT)},
    "pits": {"session_key": ("int", REQ), "meeting_key": ("int", REQ), "driver_number": ("int", REQ),
             "date": ("ts", REQ), "lap_number": ("int", REQ), "lane_duration": ("float", OPT),
             "stop_duration": ("float", OPT)},
    "location": {"date": ("ts", REQ), "driver_number": ("int", REQ), "session_key": ("int", REQ),
                 "x": ("float", REQ), "y": ("float", REQ), "z": ("float", REQ)},
    "position": {"date": ("ts", REQ), "driver_number": ("int", REQ), "session_key": ("int", REQ),
                 "meeting_key": ("int", REQ), "position": ("int", REQ)},
    "meetings": {"circuit_key": ("int", REQ), "circuit_short_name": ("str", REQ), "circuit_type": ("str", REQ),
                 "country_name": ("str", REQ), "meeting_key": ("int", REQ), "meeting_name": ("str", REQ),
                 "location": ("str", REQ), "date_start": ("ts", REQ), "date_end": ("ts", OPT),
                 "year": ("int", REQ), "is_cancelled": ("bool", REQ)},
    "sessions": {"session_key": ("int", REQ), "session_name": ("str", REQ), "session_type": ("str", REQ),
                 "meeting_key": ("int", REQ), "date_start": ("ts", REQ), "date_end": ("ts", OPT),
                 "year": ("int", REQ)},
    "drivers": {"driver_number": ("int", REQ), "broadcast_name": ("str", REQ), "full_name": ("str", REQ),
                "name_acronym": ("str", REQ), "team_name": ("str", REQ), "team_colour": ("str", REQ),
                "session_key": ("int", REQ)},
    "weather": {"meeting_key": ("int", REQ), "session_key": ("int", REQ), "date": ("ts", REQ),
                "air_temperature": ("float", REQ), "track_temperature": ("float", REQ),
                "humidity": ("float", REQ), "pressure": ("float", REQ), "wind_direction": ("int", REQ),
                "wind_speed": ("float", REQ), "rainfall": ("bool", REQ)},
    "race_control": {"session_key": ("int", REQ), "meeting_key": ("int", REQ), "date": ("ts", REQ),
                     "category": ("str", REQ), "flag": ("str", OPT), "lap_number": ("int", OPT),
                     "message": ("str", REQ), "sector": ("int", OPT), "driver_number": ("int", OPT),
                     "scope": ("str", OPT)},
    "session_result": {"session_key": ("int", REQ), "meeting_key": ("int", REQ),
                       "driver_number": ("int", REQ), "position": ("int", OPT),
                       "number_of_laps": ("int", OPT), "points": ("float", REQ), "duration": ("float", OPT),
                       "gap_to_leader": ("text", OPT), "dnf": ("bool", REQ), "dns": ("bool", REQ),
                       "dsq": ("bool", REQ)},
}

# landed file name per feed and the bronze table it feeds
FEED_FILES = {"car_data": ("car_data.json", "telemetry_raw"), "laps": ("laps.json", "laps_raw"),
              "stints": ("stints.json", "stints_raw"), "pits": ("pits.json", "pits_raw"),
              "location": ("locations.json", "location_raw"), "position": ("position.json", "position_raw"), "drivers": ("drivers.json", "driver_raw"),
              "weather": ("weather.json", "weather_raw"), "race_control": ("race_control.json", "race_control_raw"),
              "session_result": ("session_result.json", "session_results_raw"),
              "meetings": ("meetings.json", "meetings_metadata"), "sessions": ("sessions.json", "sessions_metadata")}
