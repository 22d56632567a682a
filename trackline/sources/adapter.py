"""Race-shaped bronze tables derived from the driver's parquet tables.

The test data is a generic star schema plus an ``events`` stream.  This
adapter maps it onto the eleven landed race feeds (same columns as the
bronze NDJSON tables) so every model runs on data that grows with the
inputs.  The derivation rules are fixed values shared with the DuckDB
oracle (``trackline.queries.oracle_ctes``), which states them in SQL:

* session_key = 9000 + floor((day(ts) - 1) / 10); one driver per user.
* laps: one per ``signup`` event, numbered by (ts, event_id) within the
  (session, driver); date_start NULL when event_id % 17 = 0; lap_duration
  NULL when event_id % 19 = 0, 0.0 when event_id % 23 = 0, else
  3600 + value * 60; pit-out when lap_number > 1 and lap_number % 5 = 1.
* car samples: ``view``/``click``/``purchase``; weather: ``error``;
  race control: ``purchase`` except on the first day of a session;
  location: ``click``; stints every 5th lap; pits on laps % 5 = 0.
* positions: ``view`` with event_id % 3 = 0, place 1 + (event_id div 64 + user) % 20.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")

RACE_TABLES = ("laps_raw", "telemetry_raw", "weather_raw", "race_control_raw",
               "location_raw", "stints_raw", "pits_raw", "driver_raw",
               "sessions_metadata", "meetings_metadata", "session_results_raw", "position_raw")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


class RaceTables:
    """Lazy race feeds over one scale-factor directory."""

    # feeds that are derived from another one
    DERIVED = {"stints_raw": "laps_raw", "pits_raw": "laps_raw"}

    def use(self, name: str, table: DataFrame) -> None:
        """Derive from ``table``, the feed ``name`` as it was written, so that
        it is not computed again."""
        self.__dict__[name] = table

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        # one DataFrame per source table: DataFrames are immutable and lazy,
        # so sharing them only saves repeated file listing and analysis
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.sf_dir, name)
        return self._raw[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RACE_TABLES:
            raise KeyError(name)
        return getattr(self, name)

    # -- events keyed by session -------------------------------------------
    @cached_property
    def ev(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            "event_id", "ts", "user_id", "event_type", "value",
            (F.lit(9000) + F.floor((F.dayofmonth("ts") - 1) / 10.0)).cast("bigint").alias("session_key"))

    @cached_property
    def laps_raw(self) -> DataFrame:
        # lap number = position of the signup in (ts, event_id) order per
        # driver and session; ordered_window splits a driver with a very
        # large number of signups instead of numbering them in one task
        from trackline.operators.ordered import ordered_window

        sign = (self.ev.where(F.col("event_type") == "signup")
                .withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp"))))
        s = ordered_window(sign, ["session_key", "user_id"], "_us", tiebreak=["event_id"],
                           row_number="lap_number").drop("_us")
        return s.select(
            "session_key",
            F.col("user_id").alias("driver_number"),
            "lap_number",
            F.when(F.col("event_id") % 17 == 0, _null("timestamp_ntz")).otherwise(F.col("ts")).alias("date_start"),
            F.when(F.col("event_id") % 19 == 0, _null("double"))
             .when(F.col("event_id") % 23 == 0, F.lit(0.0))
             .otherwise(F.lit(3600.0) + F.col("value") * 60).alias("lap_duration"),
            ((F.col("lap_number") > 1) & (F.col("lap_number") % 5 == 1)).alias("is_pit_out_lap"),
        )

    @cached_property
    def telemetry_raw(self) -> DataFrame:
        e = self.ev.where(F.col("event_type").isin("view", "click", "purchase"))
        return e.select(
            "session_key", F.col("user_id").alias("driver_number"), F.col("ts").alias("date"),
            (F.floor("value").cast("bigint") + 60).alias("speed"),
            (F.lit(8000) + F.col("event_id") % 4000).alias("rpm"),
            (F.col("event_id") % 9).alias("n_gear"),
            (F.col("event_id") % 101).alias("throttle"),
            (F.col("event_id") % 2).alias("brake"),
            (F.col("event_id") % 15).alias("drs"),
        )

    @cached_property
    def weather_raw(self) -> DataFrame:
        e = self.ev.where(F.col("event_type") == "error")
        return e.select(
            "session_key", F.col("ts").alias("date"),
            F.col("value").alias("air_temperature"),
            (F.col("value") + 10).alias("track_temperature"),
            _null("double").alias("humidity"), _null("double").alias("pressure"),
            _null("double").alias("wind_direction"), _null("double").alias("wind_speed"),
            (F.col("value") > 100).alias("rainfall"),
        )

    @cached_property
    def race_control_raw(self) -> DataFrame:
        e = self.ev.where((F.col("event_type") == "purchase")
                          & ((F.dayofmonth("ts") - 1) % 10 >= 1))
        m4 = F.col("event_id") % 4
        m3 = F.col("event_id") % 3
        return e.select(
            "session_key", F.col("ts").alias("date"),
            _null("bigint").alias("driver_number"),
            F.when(m4 == 0, "SafetyCar").when(m4 == 1, "Drs").when(m4 == 2, "Other")
             .otherwise("Flag").alias("category"),
            F.when((m4 == 0) & (F.col("event_id") % 8 == 0), _null("string"))
             .when(m3 == 0, "BLUE").when(m3 == 1, "YELLOW").otherwise("RED").alias("flag"),
            _null("bigint").alias("lap_number"), _null("bigint").alias("sector"),
            _null("string").alias("scope"), _null("string").alias("message"),
        )

    @cached_property
    def location_raw(self) -> DataFrame:
        e = self.ev.where(F.col("event_type") == "click")
        return e.select(
            "session_key", F.col("user_id").alias("driver_number"), F.col("ts").alias("date"),
            F.col("value").alias("x"), (F.col("event_id") % 1000).cast("double").alias("y"),
            F.lit(0.0).alias("z"),
        )

    @cached_property
    def stints_raw(self) -> DataFrame:
        lp = self.laps_raw.where((F.col("lap_number") % 5 == 1) & (F.col("driver_number") % 7 != 6))
        k3 = (F.col("driver_number") + F.col("lap_number")) % 3
        return lp.select(
            "session_key", "driver_number",
            ((F.col("lap_number") + 4) / 5).cast("bigint").alias("stint_number"),
            F.when(k3 == 0, "soft").when(k3 == 1, "medium").otherwise("hard").alias("compound"),
            (F.col("driver_number") % 4).alias("tyre_age_at_start"),
            F.col("lap_number").alias("lap_start"),
            F.when(F.col("driver_number") % 5 == 0, _null("bigint"))
             .otherwise(F.col("lap_number") + 4).alias("lap_end"),
        )

    @cached_property
    def pits_raw(self) -> DataFrame:
        lp = self.laps_raw.where(F.col("lap_number") % 5 == 0)
        return lp.select(
            "session_key", "driver_number", "lap_number",
            _null("timestamp_ntz").alias("date"), _null("double").alias("lane_duration"),
            (F.lit(2.0) + (F.col("driver_number") % 30) / 10.0).alias("stop_duration"),
        )

    @cached_property
    def position_raw(self) -> DataFrame:
        e = self.ev.where((F.col("event_type") == "view") & (F.col("event_id") % 3 == 0))
        return e.select("session_key", F.col("user_id").alias("driver_number"), F.col("ts").alias("date"),
                        (F.lit(1) + (F.floor(F.col("event_id") / 64.0) + F.col("user_id")) % 20).cast("bigint").alias("position"))

    @cached_property
    def _driver_sessions(self) -> DataFrame:
        return (self.ev.groupBy("session_key", F.col("user_id").alias("driver_number"))
                .agg(F.sum("value").alias("total_value"), F.count(F.lit(1)).alias("n")))

    @cached_property
    def driver_raw(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_name", "c_nationkey")
        n = self.raw("nation").select("n_nationkey", "n_name")
        d = self._driver_sessions
        j = (d.join(c, d.driver_number == c.c_custkey)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
        return j.select(
            "session_key", "driver_number",
            F.upper("c_name").alias("broadcast_name"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lit("D"), F.col("driver_number").cast("string")).alias("name_acronym"),
            F.col("n_name").alias("team_name"),
            F.lpad(((F.col("n_nationkey") * 37123) % 1000000).cast("string"), 6, "0").alias("team_colour"),
        )

    @cached_property
    def sessions_metadata(self) -> DataFrame:
        g = self.ev.groupBy("session_key").agg(F.min("ts").alias("date_start"), F.max("ts").alias("date_end"))
        return g.select(
            "session_key", F.lit("Race").alias("session_name"), F.lit("Race").alias("session_type"),
            (F.lit(100) + F.col("session_key") % 5).alias("meeting_key"),
            "date_start", "date_end", F.lit(2024).cast("bigint").alias("year"),
        )

    @cached_property
    def meetings_metadata(self) -> DataFrame:
        r = self.raw("region")
        return r.select(
            (F.lit(100) + F.col("r_regionkey")).cast("bigint").alias("meeting_key"),
            F.col("r_regionkey").cast("bigint").alias("circuit_key"),
            F.concat("r_name", F.lit(" GP")).alias("meeting_name"),
            F.col("r_name").alias("circuit_short_name"),
            F.lit("Permanent").alias("circuit_type"),
            F.col("r_name").alias("country_name"),
            F.col("r_name").alias("location"),
            _null("timestamp_ntz").alias("date_start"), _null("timestamp_ntz").alias("date_end"),
            F.lit(False).alias("is_cancelled"),
            F.lit(2024).cast("bigint").alias("year"),
        )

    @cached_property
    def session_results_raw(self) -> DataFrame:
        w = Window.partitionBy("session_key").orderBy(
            F.round("total_value", 2).cast("decimal(18,2)").desc(), "driver_number")
        d = self._driver_sessions.withColumn("rk", F.row_number().over(w).cast("bigint"))
        dn = F.col("driver_number")
        return d.select(
            "session_key", (F.lit(100) + F.col("session_key") % 5).alias("meeting_key"), "driver_number",
            F.when(dn % 29 == 28, _null("bigint")).otherwise(F.col("rk")).alias("position"),
            F.col("n").alias("number_of_laps"),
            F.when(F.col("rk") <= 10, (26 - 2 * F.col("rk")).cast("double")).otherwise(F.lit(0.0)).alias("points"),
            _null("double").alias("duration"),
            F.when(F.col("rk") == 1, "0").when(dn % 5 == 0, "+1 LAP")
             .otherwise((F.col("rk") * 7).cast("string")).alias("gap_to_leader"),
            (dn % 29 == 28).alias("dnf"), (dn % 31 == 30).alias("dns"), (dn % 37 == 36).alias("dsq"),
        )


def race_tables(spark: SparkSession, sf_dir: str) -> RaceTables:
    return RaceTables(spark, sf_dir)
