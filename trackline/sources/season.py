"""Season discovery and race-ingest summary (V5-V7).

Guards are evaluated in one aggregate over the calendar before anything
is returned or written; the session keys stay a DataFrame (sorted at the
edge), never a driver-side list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_SUPPORTED_SEASON = 2018   # fixed: earliest season the feed serves
RACE_SESSION_TYPE = "Race"


class DiscoveryError(ValueError):
    pass


def discover_sessions(meetings: DataFrame, sessions: DataFrame, years: Sequence[int],
                      check: bool = True) -> DataFrame:
    """Distinct race session keys of the requested seasons (V5, V6).

    Guards (all before returning): every year >= 2018, each year has at
    least one meeting and one race session, no race session of a meeting
    of the year belongs to another season.
    """
    years = sorted({int(y) for y in years})
    if not years:
        raise DiscoveryError("no season requested")
    if years[0] < FIRST_SUPPORTED_SEASON:
        raise DiscoveryError(f"season discovery supports years from {FIRST_SUPPORTED_SEASON}")
    m = meetings.where(F.col("year").isin(years))
    s = sessions.where(F.col("session_type") == RACE_SESSION_TYPE)
    s_year = s.where(F.col("year").isin(years))
    if check:
        per_year = (m.select("year", F.lit(1).alias("_m"), F.lit(0).alias("_s"))
                    .unionByName(s_year.select("year", F.lit(0).alias("_m"), F.lit(1).alias("_s")))
                    .groupBy("year").agg(F.sum("_m").alias("meetings"), F.sum("_s").alias("races")))
        stray = (s.join(m.select("meeting_key", F.col("year").alias("_my")), "meeting_key")
                 .where(F.col("year") != F.col("_my")).count())
        stats = {r["year"]: (r["meetings"], r["races"]) for r in per_year.collect()}  # one row per year
        for y in years:
            nm, nr = stats.get(y, (0, 0))
            if not nm:
                raise DiscoveryError(f"no meetings returned for {y}")
            if not nr:
                raise DiscoveryError(f"no race sessions returned for {y}")
        if stray:
            raise DiscoveryError("race sessions outside the requested seasons")
    return s_year.select("session_key").distinct()


def ingest_summary(drivers: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """(session_key, drivers) per ingested race (V7); a race without any
    driver is an error."""
    out = drivers.groupBy("session_key").agg(F.count_distinct("driver_number").alias("drivers"))
    if sessions is not None:
        missing = sessions.select("session_key").join(out, "session_key", "left_anti")
        first = missing.first()
        if first is not None:
            raise DiscoveryError(f"no drivers returned for session {first['session_key']}")
    return out
