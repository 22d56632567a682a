"""Column -> Column helpers shared by the models and serving frames.

Everything here is a built-in Spark expression (stays inside whole-stage
codegen); nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output.
PLACEHOLDER = "—"                       # shown for a missing lap time / KPI
RESULT_STATUSES = ("Classified", "DNF", "DNS", "DSQ")
TIRE_COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
ONGOING_STINT_LAP_END = 999             # lap_end of a stint that has not ended
DEFAULT_TRACK_FLAG = "GREEN"            # flag before the first race-control message


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def composite_key(*parts: Column | str, sep: str = "-") -> Column:
    """``a-b[-c]`` from the string forms of the parts; any NULL part -> NULL.

    ``concat`` (not ``concat_ws``) keeps the NULL-propagation of SQL CONCAT.
    """
    items: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            items.append(F.lit(sep))
        items.append(_c(p).cast("string"))
    return F.concat(*items)


def hex_colour(colour: Column | str) -> Column:
    return F.concat(F.lit("#"), _c(colour))


def safe_double(text: Column | str) -> Column:
    """SAFE_CAST(text AS FLOAT64): NULL on a failed cast (ANSI stays on)."""
    return _c(text).try_cast("double")


def result_status(dsq: Column | str, dns: Column | str, dnf: Column | str) -> Column:
    """Priority DSQ > DNS > DNF > Classified (a NULL flag counts as false)."""
    return (F.when(_c(dsq), "DSQ").when(_c(dns), "DNS").when(_c(dnf), "DNF")
            .otherwise("Classified"))


def add_seconds_ms(ts: Column | str, seconds: Column | str) -> Column:
    """ts + seconds, at millisecond precision, the seconds*1000 rounded
    half away from zero (the reference's float->int cast rounds)."""
    ms = F.round(_c(seconds) * 1000).cast("bigint")
    return F.timestamp_add("MILLISECOND", ms, _c(ts))


def round_half_up(x: Column | str, scale: int) -> Column:
    """ROUND on the decimal value: cast to DECIMAL first so half-way
    doubles round the same in every engine, then back to double."""
    return F.round(_c(x).cast("decimal(38,12)"), scale).cast("double")


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / NULLIF(den, 0)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def format_lap_time(seconds: Column | str) -> Column:
    """``M:SS.mmm``; NULL or NaN -> the placeholder.  Like the reference,
    59.9996 formats as ``0:60.000`` (the remainder is rounded after the
    minute split)."""
    s = _c(seconds).cast("double")
    minutes = F.floor(s / 60)
    rem = s - minutes * 60
    text = F.format_string("%d:%06.3f", minutes, rem)
    return F.when(s.isNull() | F.isnan(s), F.lit(PLACEHOLDER)).otherwise(text)


def conditions_label(wet: Column | str) -> Column:
    return F.when(_c(wet), "Wet").when(~_c(wet), "Dry").otherwise("Unknown")


def thousands(n: Column | str) -> Column:
    """``f"{n:,}"`` for integers."""
    return F.format_number(_c(n).cast("bigint"), 0)


def speed_label(kmh: Column | str) -> Column:
    """``f"{int(round(v))} km/h"``: Python rounds half to even -> bround."""
    v = _c(kmh)
    return F.when(v.isNull() | F.isnan(v.cast("double")), F.lit(PLACEHOLDER)).otherwise(
        F.concat(F.bround(v.cast("double"), 0).cast("bigint").cast("string"), F.lit(" km/h")))


def session_label(meeting: Column | str, session: Column | str, season: Column | str) -> Column:
    """``meeting · session (season)``."""
    return F.format_string("%s · %s (%s)", _c(meeting), _c(session), _c(season).cast("string"))


def driver_label(acronym: Column | str, team: Column | str) -> Column:
    """``ACR · team``."""
    return F.format_string("%s · %s", _c(acronym), _c(team))


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ (the
    session time zone is UTC, so the NTZ -> TIMESTAMP cast is exact)."""
    return F.unix_micros(_c(ts).cast("timestamp"))
