from trackline.functions.scalar import (  # noqa: F401
    DEFAULT_TRACK_FLAG,
    ONGOING_STINT_LAP_END,
    PLACEHOLDER,
    RESULT_STATUSES,
    TIRE_COMPOUNDS,
    add_seconds_ms,
    composite_key,
    conditions_label,
    driver_label,
    epoch_micros,
    format_lap_time,
    hex_colour,
    result_status,
    round_half_up,
    safe_double,
    safe_ratio,
    session_label,
    speed_label,
    thousands,
)
