"""The model graph: staging -> silver -> gold, built lazily from any mapping
of bronze table name -> DataFrame (adapter views, NDJSON bronze, or the
parquet written by :mod:`trackline.plans.materialize`)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from trackline.plans import gold, silver
from trackline.plans import staging as stg


class Models:
    """Every model as a lazily built, memoised DataFrame.

    ``silver_tables`` / ``gold_tables`` (optional mappings) substitute
    materialised layers, so the gold models read the silver table instead
    of recomputing it (the reference materialises these as tables too).
    """

    def __init__(self, tables, silver_tables=None, gold_tables=None, persist=None):
        self.tables = tables
        self._silver = dict(silver_tables or {})
        self._gold = dict(gold_tables or {})
        # persist(name, df) -> df: write the layer and read it back (cuts
        # lineage so later models plan against a table, not the recipe)
        self._persist = persist or (lambda name, df: df)

    def stg(self, name: str) -> DataFrame:
        return stg.staged(self.tables, name)

    # -- staging (views) -----------------------------------------------------
    @cached_property
    def stg_drivers(self) -> DataFrame:
        return self.stg("stg_drivers")

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return self.stg("stg_sessions")

    @cached_property
    def stg_meetings(self) -> DataFrame:
        return self.stg("stg_meetings")

    @cached_property
    def stg_session_results(self) -> DataFrame:
        return self.stg("stg_session_results")

    # -- silver ----------------------------------------------------------------
    @cached_property
    def telemetry_laps(self) -> DataFrame:
        if "fct_telemetry_laps" in self._silver:
            return self._silver["fct_telemetry_laps"]
        return self._persist("fct_telemetry_laps", silver.telemetry_laps(self.tables))

    @cached_property
    def enriched(self) -> DataFrame:
        if "fct_telemetry_enriched" in self._silver:
            return self._silver["fct_telemetry_enriched"]
        return self._persist("fct_telemetry_enriched",
                             silver.enriched_telemetry(self.tables, tl=self.telemetry_laps))

    # -- gold ------------------------------------------------------------------
    def _g(self, name: str, build):
        return self._gold[name] if name in self._gold else self._persist(name, build())

    @cached_property
    def lap_aggregates(self) -> DataFrame:
        """Lap-grain aggregates of the enriched samples (silver)."""
        if "fct_lap_aggregates" in self._silver:
            return self._silver["fct_lap_aggregates"]
        return self._persist("fct_lap_aggregates", gold.lap_aggregates(self.enriched))

    @cached_property
    def lap_leaderboard(self) -> DataFrame:
        return self._g("fct_lap_leaderboard", lambda: gold.rank_laps(self.lap_aggregates))

    @cached_property
    def dim_sessions(self) -> DataFrame:
        return self._g("dim_sessions", lambda: gold.dim_sessions(
            self.stg_sessions, self.stg_meetings, self.lap_leaderboard))

    @cached_property
    def dim_drivers(self) -> DataFrame:
        return self._g("dim_drivers", lambda: gold.dim_drivers(self.stg_drivers, self.lap_leaderboard))

    @cached_property
    def dashboard_laps(self) -> DataFrame:
        return self._g("fct_dashboard_laps", lambda: gold.dashboard_laps(
            self.lap_leaderboard, self.dim_drivers, self.dim_sessions))

    @cached_property
    def tire_degradation(self) -> DataFrame:
        return self._g("fct_tire_degradation", lambda: gold.tire_degradation(self.dashboard_laps))

    @cached_property
    def corner_performance(self) -> DataFrame:
        return self._g("fct_corner_performance", lambda: gold.corner_performance(self.enriched))

    @cached_property
    def race_results(self) -> DataFrame:
        return self._g("fct_race_results", lambda: gold.race_results(
            self.stg_session_results, self.dim_sessions, self.dim_drivers))


# materialised layer name -> Models attribute (bronze feeds excluded)
SILVER = {"fct_telemetry_laps": "telemetry_laps", "fct_telemetry_enriched": "enriched",
          "fct_lap_aggregates": "lap_aggregates"}
GOLD = {"fct_lap_leaderboard": "lap_leaderboard", "dim_sessions": "dim_sessions",
        "dim_drivers": "dim_drivers", "fct_dashboard_laps": "dashboard_laps",
        "fct_tire_degradation": "tire_degradation", "fct_corner_performance": "corner_performance",
        "fct_race_results": "race_results"}
