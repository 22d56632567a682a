"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole input.  Layers below the query's own step come from the
application's :class:`~trackline.plans.materialize.Lakehouse` (written
once, like the reference's warehouse build); the query computes its own
step on them.  Oracles restate the same result in DuckDB SQL over the
driver's tables (``WITH`` the CTEs of ``oracle_ctes``).

Float averages are rounded to 6 places on both sides (summation order
differs between engines); every other value is compared as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.functions import scalar as fx
from trackline.operators.asof import asof_fill
from trackline.operators.interval import interval_join
from trackline.operators.ranking import first_by, group_rank
from trackline.plans import gold, metrics, quality, repository, silver
from trackline.plans import staging as stg
from trackline.plans.materialize import lakehouse_for
from trackline.queries.oracle_ctes import cte, with_ctes
from trackline.sources import season as seasons
from trackline.sources.schemas import FEED_SPECS
from trackline.sources.validate import split, strip_nulls, validate

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

SEASON = 2024  # the season present in the test data (the parameter of R2-R4)
AVG_COLUMNS = ("avg_throttle", "avg_brake", "avg_track_temp", "average_delta_to_best",
               "rolling_three_lap_average")


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn
    return deco


def _lh(spark, sf_dir):
    return lakehouse_for(spark, sf_dir)


def _m(spark, sf_dir):
    return _lh(spark, sf_dir).models


def r6(df: DataFrame) -> DataFrame:
    """Round the float averages to 6 places (compare hygiene)."""
    return df.select(*[F.round(c, 6).alias(c) if c in AVG_COLUMNS else F.col(c) for c in df.columns])


def _r6sql(cols: list[str], src: str, where: str = "") -> str:
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in AVG_COLUMNS else c for c in cols)
    return f"SELECT {sel} FROM {src} {where}"


# ---------------------------------------------------------------------------
# ingest and sources (V1-V7)
# ---------------------------------------------------------------------------
def landed_car_lines(spark, sf_dir) -> DataFrame:
    """The car feed as landed JSON lines, derived from the events: the speed
    arrives as a float (value + 60), so non-integral speeds are invalid."""
    ev = _lh(spark, sf_dir).source.ev.where(F.col("event_type").isin("view", "click", "purchase"))
    rec = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"), "session_key",
        (F.lit(100) + F.col("session_key") % 5).alias("meeting_key"),
        F.col("user_id").alias("driver_number"), (F.col("value") + 60).alias("speed"),
        (F.lit(8000) + F.col("event_id") % 4000).alias("rpm"), (F.col("event_id") % 9).alias("n_gear"),
        (F.col("event_id") % 101).alias("throttle"), (F.col("event_id") % 2).alias("brake"),
        (F.col("event_id") % 15).alias("drs"))
    return ev.select(F.to_json(rec).alias("value"))


_CAR_ORACLE_SRC = """(SELECT ts AS date, session_key, 100 + session_key % 5 AS meeting_key,
  user_id AS driver_number, value + 60 AS fspeed, 8000 + event_id % 4000 AS rpm, event_id % 9 AS n_gear,
  event_id % 101 AS throttle, event_id % 2 AS brake, event_id % 15 AS drs
  FROM ev WHERE event_type IN ('view', 'click', 'purchase')) c"""


@query("ingest_validate", f"""
SELECT date, session_key, meeting_key, driver_number, CAST(fspeed AS BIGINT) AS speed, rpm, n_gear, throttle,
       brake, drs
FROM {_CAR_ORACLE_SRC} WHERE fspeed = floor(fspeed)""")
def q_ingest_validate(spark, sf_dir):
    good, _ = split(validate(landed_car_lines(spark, sf_dir), FEED_SPECS["car_data"]))
    return good


@query("ingest_rejects", f"""
SELECT 'speed: invalid int' AS error, count(*) AS n FROM {_CAR_ORACLE_SRC} WHERE fspeed != floor(fspeed)""")
def q_ingest_rejects(spark, sf_dir):
    _, bad = split(validate(landed_car_lines(spark, sf_dir), FEED_SPECS["car_data"]))
    return bad.select(F.explode("_errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


# a record of each kind of right and wrong value, by event_id % 16
TYPED_SPEC = {"n": ("int", True), "f": ("float", False), "s": ("str", False), "b": ("bool", False), "t": ("ts", False)}


def landed_typed_lines(spark, sf_dir) -> DataFrame:
    """Landed lines of every event whose fields take turns at being texts,
    numbers and booleans where others are due, unknown, absent or cut off."""
    ev = _lh(spark, sf_dir).source.raw("events")
    eid, seconds = F.col("event_id").cast("string"), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    field = lambda name, *parts: F.concat(F.lit(f'"{name}":'), *[F.lit(x) if isinstance(x, str) else x for x in parts])
    turn = F.col("event_id") % 16
    plain = field("n", eid)
    n = (F.when(turn == 1, field("n", '" ', eid, ' "')).when(turn == 2, field("n", '"', eid, 'd"')).when(turn == 3, field("n", eid, ".5"))
         .when(turn == 4, field("n", "9007199254740993")).when(turn == 14, field("m", eid)).otherwise(plain))
    t = (F.when(turn == 5, field("t", '"10:00"')).when(turn == 6, field("t", seconds)).when(turn == 7, field("t", '"', seconds, '000"'))
         .otherwise(field("t", '"', iso, 'Z"')))
    text = F.when(turn == 8, field("s", "5")).when(turn == 9, field("s", "true")).otherwise(field("s", '"x', eid, '"'))
    b = F.when(turn == 10, field("b", '"YES"')).when(turn == 11, field("b", "2")).otherwise(field("b", "false"))
    f = F.when(turn == 12, field("f", '"1_0', '00.5"')).otherwise(field("f", (F.floor("value") / 2).cast("string")))
    line = F.concat(F.lit("{"), F.concat_ws(",", n, t, text, b, f), F.when(turn == 13, F.lit(',"extra":[1]}')).when(turn == 15, F.lit(',"n"')).otherwise(F.lit("}")))
    return ev.select(line.alias("value"))


@query("ingest_typed_values", """
SELECT CASE WHEN event_id % 16 = 4 THEN 9007199254740993 ELSE event_id END AS n, CASE WHEN event_id % 16 = 12 THEN 1000.5::DOUBLE ELSE floor(value) / 2 END AS f,
       'x' || CAST(event_id AS VARCHAR) AS s, event_id % 16 = 10 AS b, CASE WHEN event_id % 16 IN (6, 7) THEN date_trunc('second', ts) ELSE ts END AS t
FROM events WHERE event_id % 16 NOT IN (2, 3, 5, 8, 9, 11, 13, 14, 15)""")
def q_ingest_typed_values(spark, sf_dir):
    good, _ = split(validate(landed_typed_lines(spark, sf_dir), TYPED_SPEC, strict=True))
    return good


@query("ingest_typed_rejects", """
SELECT unnest(CASE event_id % 16 WHEN 2 THEN ['n: invalid int'] WHEN 3 THEN ['n: invalid int'] WHEN 5 THEN ['t: invalid ts'] WHEN 8 THEN ['s: invalid str']
              WHEN 9 THEN ['s: invalid str'] WHEN 11 THEN ['b: invalid bool'] WHEN 13 THEN ['extra: unexpected field']
              WHEN 14 THEN ['n: field required', 'm: unexpected field'] WHEN 15 THEN ['line: not a JSON object'] ELSE [] END) AS error, count(*) AS n
FROM events GROUP BY error""")
def q_ingest_typed_rejects(spark, sf_dir):
    _, bad = split(validate(landed_typed_lines(spark, sf_dir), TYPED_SPEC, strict=True))
    return bad.select(F.explode("_errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("array_null_strip", """
SELECT l_orderkey, l_linenumber, CAST(len(s) AS BIGINT) AS n_segments,
       list_reduce(list_prepend(0.0::DOUBLE, s), lambda a, b: a + b) AS segments_total,
       s[1] AS first_segment
FROM (SELECT l_orderkey, l_linenumber,
             COALESCE(list_filter(CASE WHEN l_linenumber % 7 = 0 THEN NULL
                      ELSE [l_quantity, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END, l_tax] END,
                      lambda x: x IS NOT NULL), CAST([] AS DOUBLE[])) AS s
      FROM lineitem) z""")
def q_array_null_strip(spark, sf_dir):
    li = _lh(spark, sf_dir).source.raw("lineitem")
    arr = F.when(F.col("l_linenumber") % 7 == 0, F.lit(None).cast("array<double>")).otherwise(
        F.array(F.col("l_quantity"),
                F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("l_discount")),
                F.col("l_tax")))
    s = li.select("l_orderkey", "l_linenumber", strip_nulls(arr).alias("s"))
    return s.select("l_orderkey", "l_linenumber", F.size("s").cast("bigint").alias("n_segments"),
                    F.aggregate("s", F.lit(0.0), lambda a, b: a + b).alias("segments_total"),
                    F.get("s", 0).alias("first_segment"))


@query("ingest_gap_normalize", "SELECT session_key, driver_number, gap_to_leader FROM session_results_raw")
def q_gap(spark, sf_dir):
    r = _lh(spark, sf_dir)["session_results_raw"]
    gap = F.col("gap_to_leader")
    js = F.when(gap.isNull(), F.lit("null")).when(gap.try_cast("double").isNotNull(), gap).otherwise(
        F.to_json(F.struct(gap.alias("g"))).substr(F.lit(6), F.length(F.to_json(F.struct(gap.alias("g")))) - 6))
    line = F.concat(F.lit('{"session_key":'), F.col("session_key").cast("string"), F.lit(',"driver_number":'),
                    F.col("driver_number").cast("string"), F.lit(',"gap_to_leader":'), js, F.lit("}"))
    spec = {k: FEED_SPECS["session_result"][k] for k in ("session_key", "driver_number", "gap_to_leader")}
    good, _ = split(validate(r.select(line.alias("value")), spec))
    return good


@query("season_discovery", "SELECT DISTINCT session_key FROM sessions_metadata WHERE year = 2024 AND session_type = 'Race'")
def q_season(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    return seasons.discover_sessions(lh["meetings_metadata"], lh["sessions_metadata"], [SEASON])


@query("ingest_summary", "SELECT session_key, count(DISTINCT driver_number) AS drivers FROM driver_raw GROUP BY session_key")
def q_ingest_summary(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    return seasons.ingest_summary(lh["driver_raw"], lh["sessions_metadata"])


# ---------------------------------------------------------------------------
# staging (M1-M9)
# ---------------------------------------------------------------------------
def _staging_query(name: str) -> None:
    @query(name, f"SELECT * FROM {name}")
    def q(spark, sf_dir, _n=name):
        return stg.staged(_lh(spark, sf_dir), _n)


for _name in stg.STAGING:
    _staging_query(_name)


# ---------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------
@query("composite_key", """
SELECT session_key, driver_number, lap_number,
       CAST(session_key AS VARCHAR) || '-' || CAST(driver_number AS VARCHAR) AS driver_session_id,
       CAST(session_key AS VARCHAR) || '-' || CAST(driver_number AS VARCHAR) || '-' || CAST(lap_number AS VARCHAR) AS lap_id
FROM laps_raw""")
def q_composite_key(spark, sf_dir):
    lp = _lh(spark, sf_dir)["laps_raw"]
    return lp.select("session_key", "driver_number", "lap_number",
                     fx.composite_key("session_key", "driver_number").alias("driver_session_id"),
                     fx.composite_key("session_key", "driver_number", "lap_number").alias("lap_id"))


@query("safe_cast", """
SELECT session_key, driver_number, gap_to_leader, TRY_CAST(gap_to_leader AS DOUBLE) AS gap_to_leader_seconds
FROM session_results_raw""")
def q_safe_cast(spark, sf_dir):
    r = _lh(spark, sf_dir)["session_results_raw"]
    return r.select("session_key", "driver_number", "gap_to_leader",
                    fx.safe_double("gap_to_leader").alias("gap_to_leader_seconds"))


@query("result_status", """
SELECT session_key, driver_number, dnf, dns, dsq,
       CASE WHEN dsq THEN 'DSQ' WHEN dns THEN 'DNS' WHEN dnf THEN 'DNF' ELSE 'Classified' END AS result_status
FROM session_results_raw""")
def q_result_status(spark, sf_dir):
    r = _lh(spark, sf_dir)["session_results_raw"]
    return r.select("session_key", "driver_number", "dnf", "dns", "dsq",
                    fx.result_status("dsq", "dns", "dnf").alias("result_status"))


_FMT = "CASE WHEN {x} IS NULL OR isnan({x}) THEN '—' ELSE printf('%d:%06.3f', CAST(floor({x} / 60) AS BIGINT), {x} - floor({x} / 60) * 60) END"


@query("format_lap_time", f"""
SELECT session_key, driver_number, lap_number, lap_duration, {_FMT.format(x='lap_duration')} AS lap_time
FROM laps_raw""")
def q_format_lap_time(spark, sf_dir):
    lp = _lh(spark, sf_dir)["laps_raw"]
    return lp.select("session_key", "driver_number", "lap_number", "lap_duration",
                     fx.format_lap_time("lap_duration").alias("lap_time"))


@query("throttle_brake_ratio", """
SELECT session_key, driver_number, lap_number, tire_compound, round(avg_throttle, 6) AS avg_throttle,
       round(avg_brake, 6) AS avg_brake, throttle_brake_ratio
FROM leaderboard""")
def q_ratio(spark, sf_dir):
    lb = gold.lap_leaderboard(_m(spark, sf_dir).enriched)
    return r6(lb.select("session_key", "driver_number", "lap_number", "tire_compound", "avg_throttle",
                        "avg_brake", "throttle_brake_ratio"))


@query("elapsed_time", """
SELECT session_key, driver_number, lap_number, telemetry_timestamp,
       (epoch_us(telemetry_timestamp) - min(epoch_us(telemetry_timestamp)) OVER (PARTITION BY session_key, driver_number, lap_number)) / 1e6 AS elapsed_seconds
FROM enriched""")
def q_elapsed(spark, sf_dir):
    e = _m(spark, sf_dir).enriched.select("session_key", "driver_number", "lap_number", "telemetry_timestamp")
    return metrics.elapsed_time(e, ["session_key", "driver_number", "lap_number"])


_SEASON_RACES_SQL = """
SELECT l.session_key, any_value(l.meeting_name) AS meeting_name, any_value(l.circuit_short_name) AS circuit_short_name,
       any_value(l.country_name) AS country_name, any_value(l.location) AS location,
       any_value(s.session_start) AS session_start, count(DISTINCT l.driver_number) AS driver_count,
       count(*) AS lap_count, min(l.lap_duration) AS fastest_lap,
       first(l.name_acronym ORDER BY l.lap_duration, l.lap_number, l.driver_number) AS fastest_driver,
       max(l.top_speed) AS top_speed, bool_or(l.rained_during_lap) AS was_wet
FROM dashboard_laps l JOIN dim_sessions s ON l.session_key = s.session_key
WHERE l.season = 2024 GROUP BY l.session_key"""


@query("race_conditions", f"""
SELECT session_key, meeting_name, circuit_short_name, fastest_driver, {_FMT.format(x='fastest_lap')} AS fastest_lap_formatted,
       top_speed, driver_count, lap_count,
       CASE WHEN was_wet THEN 'Wet' WHEN NOT was_wet THEN 'Dry' ELSE 'Unknown' END AS conditions
FROM ({_SEASON_RACES_SQL}) r""")
def q_race_conditions(spark, sf_dir):
    return metrics.race_conditions(repository.season_races(_m(spark, sf_dir), SEASON))


@query("session_labels", """
SELECT session_key, meeting_name || ' · ' || session_name || ' (' || CAST(season AS VARCHAR) || ')' AS label
FROM dim_sessions""")
def q_session_labels(spark, sf_dir):
    return metrics.session_labels(_m(spark, sf_dir).dim_sessions)


@query("driver_labels", "SELECT session_key, driver_number, name_acronym || ' · ' || team_name AS label FROM dim_drivers")
def q_driver_labels(spark, sf_dir):
    return metrics.driver_labels(_m(spark, sf_dir).dim_drivers)


# ---------------------------------------------------------------------------
# silver operators
# ---------------------------------------------------------------------------
@query("lap_boundaries", "SELECT * FROM bounds")
def q_bounds(spark, sf_dir):
    # pinned to the split form of the per-car LEAD so the oracle checks it
    return silver.lap_boundaries(_lh(spark, sf_dir)["laps_raw"], strategy="split")


@query("interval_join", """
SELECT t.*, l.lap_number, l.lap_start, l.lap_end, l.lap_duration, l.is_pit_out_lap
FROM telemetry_raw t JOIN bounds l ON t.session_key = l.session_key AND t.driver_number = l.driver_number
WHERE t.date >= l.lap_start AND t.date < l.lap_end""")
def q_interval_join(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    return interval_join(lh["telemetry_raw"], silver.lap_boundaries(lh["laps_raw"]),
                         ["session_key", "driver_number"], "date", "lap_start", "lap_end")


@query("telemetry_laps", "SELECT * FROM tl")
def q_tl(spark, sf_dir):
    return silver.telemetry_laps(_lh(spark, sf_dir))


@query("unified_stream", "SELECT * EXCLUDE (rk) FROM ustream")
def q_unified(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    u = silver.unified_stream(lh.models.telemetry_laps, stg.staged(lh, "stg_weather"),
                              stg.staged(lh, "stg_race_control"), stg.staged(lh, "stg_location"))
    return u.drop("_rank")


@query("race_flags", "SELECT * FROM stg_race_control WHERE category IN ('Flag', 'SafetyCar') AND flag != 'BLUE'")
def q_race_flags(spark, sf_dir):
    return silver.track_status_rows(stg.staged(_lh(spark, sf_dir), "stg_race_control"))


def _context(spark, sf_dir) -> DataFrame:
    lh = _lh(spark, sf_dir)
    return silver.telemetry_context(
        lh.models.telemetry_laps, stg.staged(lh, "stg_weather"), stg.staged(lh, "stg_race_control"),
        stg.staged(lh, "stg_location"),
        samples=lh["telemetry_raw"].select("session_key", "driver_number", F.col("date").alias("ts")))


@query("forward_fill_session", """
SELECT session_key, driver_number, lap_number, telemetry_timestamp, air_temperature, track_temperature, is_raining,
       track_flag
FROM conditions""")
def q_ffill_session(spark, sf_dir):
    return _context(spark, sf_dir).select("session_key", "driver_number", "lap_number", "telemetry_timestamp",
                                          "air_temperature", "track_temperature", "is_raining", "track_flag")


@query("forward_fill_driver", """
SELECT session_key, driver_number, lap_number, telemetry_timestamp, x, y FROM conditions""")
def q_ffill_driver(spark, sf_dir):
    return _context(spark, sf_dir).select("session_key", "driver_number", "lap_number", "telemetry_timestamp",
                                          "x", "y")


@query("asof_weather", """
SELECT session_key, driver_number, ts AS telemetry_timestamp, air AS air_temperature, track AS track_temperature,
       rain AS is_raining
FROM (SELECT *,
        last_value(air_temp IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY ts, rk, air_temp NULLS FIRST ROWS UNBOUNDED PRECEDING) AS air,
        last_value(track_temp IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY ts, rk, track_temp NULLS FIRST ROWS UNBOUNDED PRECEDING) AS track,
        last_value(raining IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY ts, rk, raining NULLS FIRST ROWS UNBOUNDED PRECEDING) AS rain
      FROM (SELECT session_key, driver_number, date AS ts, 1 AS rk, CAST(NULL AS DOUBLE) AS air_temp,
                   CAST(NULL AS DOUBLE) AS track_temp, CAST(NULL AS BOOLEAN) AS raining FROM telemetry_raw
            UNION ALL
            SELECT session_key, NULL, weather_timestamp, 0, air_temperature, track_temperature, is_raining
            FROM stg_weather) u) z
WHERE rk = 1""")
def q_asof_weather(spark, sf_dir):
    """Every car sample (not only those inside a lap) with the weather in
    force at its instant: an as-of join written as union + fill."""
    lh = _lh(spark, sf_dir)
    cars = lh["telemetry_raw"].select("session_key", "driver_number", F.col("date").alias("ts"),
                                      F.lit(1).alias("_rank"))
    w = stg.staged(lh, "stg_weather").select(
        "session_key", F.col("weather_timestamp").alias("ts"), F.lit(0).alias("_rank"),
        F.col("air_temperature").alias("air_temp"), F.col("track_temperature").alias("track_temp"),
        F.col("is_raining").alias("raining"))
    u = cars.unionByName(w, allowMissingColumns=True)
    # pinned to the bucketed form so the oracle checks the scalable path
    f = asof_fill(u, ["session_key"], "ts", "_rank", ["air_temp", "track_temp", "raining"],
                  density=cars.select("session_key", "ts"), strategy="split")
    return f.where(F.col("_rank") == 1).select(
        "session_key", "driver_number", F.col("ts").alias("telemetry_timestamp"),
        F.col("air_temp_filled").alias("air_temperature"), F.col("track_temp_filled").alias("track_temperature"),
        F.col("raining_filled").alias("is_raining"))


@query("asof_location", """
SELECT session_key, driver_number, ts AS telemetry_timestamp, speed, fx AS x, fy AS y
FROM (SELECT *,
        last_value(x IGNORE NULLS) OVER (PARTITION BY session_key, driver_number ORDER BY ts, rk, x NULLS FIRST ROWS UNBOUNDED PRECEDING) AS fx,
        last_value(y IGNORE NULLS) OVER (PARTITION BY session_key, driver_number ORDER BY ts, rk, y NULLS FIRST ROWS UNBOUNDED PRECEDING) AS fy
      FROM (SELECT session_key, driver_number, date AS ts, speed, 1 AS rk, CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y
            FROM telemetry_raw
            UNION ALL
            SELECT session_key, driver_number, location_timestamp, NULL, 0, x, y FROM stg_location) u) z
WHERE rk = 1""")
def q_asof_location(spark, sf_dir):
    """Every car sample with the car's last known position."""
    lh = _lh(spark, sf_dir)
    cars = lh["telemetry_raw"].select("session_key", "driver_number", F.col("date").alias("ts"), "speed",
                                      F.lit(1).alias("_rank"))
    loc = stg.staged(lh, "stg_location").select("session_key", "driver_number",
                                                 F.col("location_timestamp").alias("ts"), F.lit(0).alias("_rank"),
                                                 "x", "y")
    u = cars.unionByName(loc, allowMissingColumns=True)
    f = asof_fill(u, ["session_key", "driver_number"], "ts", "_rank", ["x", "y"],
                  density=cars.select("session_key", "driver_number", "ts"), strategy="split")
    return f.where(F.col("_rank") == 1).select("session_key", "driver_number",
                                               F.col("ts").alias("telemetry_timestamp"), "speed",
                                               F.col("x_filled").alias("x"), F.col("y_filled").alias("y"))


@query("stint_boundaries", "SELECT * FROM sbounds")
def q_stint_bounds(spark, sf_dir):
    # pinned to the split form so the oracle checks it
    return silver.stint_bounds(stg.staged(_lh(spark, sf_dir), "stg_stints"), strategy="split")


@query("stint_band_join", """
SELECT t.*, s.tire_compound, s.tyre_age_at_start + (t.lap_number - s.lap_start) AS current_tire_age
FROM tl t LEFT JOIN sbounds s ON t.session_key = s.session_key AND t.driver_number = s.driver_number
     AND t.lap_number BETWEEN s.lap_start AND s.clean_lap_end""")
def q_band(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    return silver.with_stints(lh.models.telemetry_laps, stg.staged(lh, "stg_stints"), lh["laps_raw"])


@query("pit_join", """
SELECT t.*, p.pit_stop_duration_seconds FROM tl t
LEFT JOIN stg_pits p ON t.session_key = p.session_key AND t.driver_number = p.driver_number AND t.lap_number = p.lap_number""")
def q_pit_join(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    return silver.with_pits(lh.models.telemetry_laps, stg.staged(lh, "stg_pits"))


@query("enriched_telemetry", "SELECT * FROM enriched")
def q_enriched(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    return silver.enriched_telemetry(lh, tl=lh.models.telemetry_laps)


# ---------------------------------------------------------------------------
# gold models
# ---------------------------------------------------------------------------
@query("lap_leaderboard", _r6sql(gold.LEADERBOARD_COLUMNS, "leaderboard"))
def q_leaderboard(spark, sf_dir):
    return r6(gold.lap_leaderboard(_m(spark, sf_dir).enriched))


@query("dim_sessions", "SELECT * FROM dim_sessions")
def q_dim_sessions(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.dim_sessions(m.stg_sessions, m.stg_meetings, m.lap_leaderboard)


@query("dim_drivers", "SELECT * FROM dim_drivers")
def q_dim_drivers(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.dim_drivers(m.stg_drivers, m.lap_leaderboard)


@query("dashboard_laps", _r6sql(gold.DASHBOARD_COLUMNS, "dashboard_laps"))
def q_dashboard(spark, sf_dir):
    m = _m(spark, sf_dir)
    return r6(gold.dashboard_laps(m.lap_leaderboard, m.dim_drivers, m.dim_sessions))


@query("tire_degradation", _r6sql(gold.DEGRADATION_COLUMNS, "tire_deg"))
def q_tire(spark, sf_dir):
    return r6(gold.tire_degradation(_m(spark, sf_dir).dashboard_laps))


@query("v_min_points", "SELECT * FROM vmin")
def q_vmin(spark, sf_dir):
    return gold.corner_performance(_m(spark, sf_dir).enriched)


@query("race_results", "SELECT * FROM race_res")
def q_race_results(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.race_results(m.stg_session_results, m.dim_sessions, m.dim_drivers)


# ---------------------------------------------------------------------------
# windows as single operators
# ---------------------------------------------------------------------------
@query("fastest_lap_rank", "SELECT session_key, driver_number, lap_number, tire_compound, lap_duration, fastest_lap_rank FROM leaderboard")
def q_fastest_rank(spark, sf_dir):
    return gold.lap_leaderboard(_m(spark, sf_dir).enriched).select(
        "session_key", "driver_number", "lap_number", "tire_compound", "lap_duration", "fastest_lap_rank")


@query("driver_lap_rank", "SELECT lap_id, tire_compound, lap_duration, driver_fastest_lap_rank FROM dashboard_laps")
def q_driver_rank(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.dashboard_laps(m.lap_leaderboard, m.dim_drivers, m.dim_sessions).select(
        "lap_id", "tire_compound", "lap_duration", "driver_fastest_lap_rank")


@query("delta_to_best", "SELECT lap_id, tire_compound, delta_to_session_best, delta_to_driver_best FROM dashboard_laps")
def q_delta_best(spark, sf_dir):
    m = _m(spark, sf_dir)
    return gold.dashboard_laps(m.lap_leaderboard, m.dim_drivers, m.dim_sessions).select(
        "lap_id", "tire_compound", "delta_to_session_best", "delta_to_driver_best")


@query("price_rank_by_status", """
SELECT o_orderkey, o_orderstatus, o_totalprice,
       CAST(rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice NULLS FIRST) AS BIGINT) AS price_rank
FROM orders""")
def q_price_rank(spark, sf_dir):
    """RANK over a heavily skewed partition key (three order statuses)."""
    o = _lh(spark, sf_dir).source.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return group_rank(o, ["o_orderstatus"], "o_totalprice", "price_rank")


@query("clean_laps", """
SELECT lap_id, session_key, driver_number, lap_number, tire_compound, tire_age_at_lap_end FROM usable_laps""")
def q_clean_laps(spark, sf_dir):
    return gold.clean_laps(_m(spark, sf_dir).dashboard_laps).select(
        "lap_id", "session_key", "driver_number", "lap_number", "tire_compound", "tire_age_at_lap_end")


@query("stint_starts", "SELECT lap_id, tire_compound, tire_age_at_lap_end, starts_new_stint FROM stint_marks")
def q_stint_starts(spark, sf_dir):
    return gold.stint_starts(gold.clean_laps(_m(spark, sf_dir).dashboard_laps)).select(
        "lap_id", "tire_compound", "tire_age_at_lap_end", "starts_new_stint")


def _deg(spark, sf_dir, strategy: str = "split") -> DataFrame:
    return gold.tire_degradation(_m(spark, sf_dir).dashboard_laps, strategy=strategy)


@query("stint_numbers", "SELECT lap_id, strategy_stint_number FROM stints_counted")
def q_stint_numbers(spark, sf_dir):
    return _deg(spark, sf_dir).select("lap_id", "strategy_stint_number")


@query("lap_in_stint", "SELECT degradation_id, lap_in_stint FROM tire_deg")
def q_lap_in_stint(spark, sf_dir):
    return _deg(spark, sf_dir, "split").select("degradation_id", "lap_in_stint")


@query("delta_to_stint_best", "SELECT degradation_id, delta_to_stint_best FROM tire_deg")
def q_delta_stint(spark, sf_dir):
    return _deg(spark, sf_dir, "split").select("degradation_id", "delta_to_stint_best")


@query("rolling_average", "SELECT degradation_id, round(rolling_three_lap_average, 6) AS rolling_three_lap_average FROM tire_deg")
def q_rolling(spark, sf_dir):
    return r6(_deg(spark, sf_dir, "split").select("degradation_id", "rolling_three_lap_average"))


@query("qualify_row_number", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_extendedprice NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
             l_quantity NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
             l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) = 1""")
def q_qualify(spark, sf_dir):
    """QUALIFY ROW_NUMBER() = 1 as an arg-min aggregate: the cheapest line
    of every order (ties broken by the remaining columns)."""
    li = _lh(spark, sf_dir).source.raw("lineitem")
    order = ["l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    return first_by(li, ["l_orderkey"], order).select(*li.columns)


# ---------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------
@query("bool_or_agg", """
SELECT session_key, driver_number, bool_or(is_raining) AS rained, bool_or(is_pit_out_lap) AS any_pit_out_lap
FROM enriched GROUP BY session_key, driver_number""")
def q_bool_or(spark, sf_dir):
    e = _m(spark, sf_dir).enriched
    return e.groupBy("session_key", "driver_number").agg(F.bool_or("is_raining").alias("rained"),
                                                         F.bool_or("is_pit_out_lap").alias("any_pit_out_lap"))


@query("count_distinct", """
SELECT session_key, count(DISTINCT driver_number) AS drivers, count(*) AS laps FROM dashboard_laps GROUP BY session_key""")
def q_count_distinct(spark, sf_dir):
    d = _m(spark, sf_dir).dashboard_laps
    return d.groupBy("session_key").agg(F.count_distinct("driver_number").alias("drivers"),
                                        F.count(F.lit(1)).alias("laps"))


@query("arg_min", """
SELECT session_key, first(name_acronym ORDER BY lap_duration, lap_number, driver_number) AS fastest_driver,
       min(lap_duration) AS fastest_lap
FROM dashboard_laps GROUP BY session_key""")
def q_arg_min(spark, sf_dir):
    d = _m(spark, sf_dir).dashboard_laps
    return d.groupBy("session_key").agg(
        F.min_by("name_acronym", F.struct("lap_duration", "lap_number", "driver_number")).alias("fastest_driver"),
        F.min("lap_duration").alias("fastest_lap"))


@query("distinct_keys", "SELECT DISTINCT session_key, driver_number FROM leaderboard")
def q_distinct(spark, sf_dir):
    return _m(spark, sf_dir).lap_leaderboard.select("session_key", "driver_number").distinct()


@query("fastest_laps", """
SELECT lap_id, session_key, driver_number, lap_number, lap_duration, name_acronym, top_speed
FROM dashboard_laps WHERE lap_duration IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY session_key, driver_number ORDER BY lap_duration, lap_number) = 1""")
def q_fastest_laps(spark, sf_dir):
    f = metrics.fastest_laps(_m(spark, sf_dir).dashboard_laps, ["session_key", "driver_number"])
    return f.select("lap_id", "session_key", "driver_number", "lap_number", "lap_duration", "name_acronym",
                    "top_speed")


@query("session_leaderboard", """
SELECT session_key, driver_number, name_acronym, team_name, lap_number, lap_duration, top_speed, tire_compound
FROM dashboard_laps
QUALIFY row_number() OVER (PARTITION BY session_key, driver_number ORDER BY lap_duration NULLS LAST, lap_number) = 1""")
def q_session_lb(spark, sf_dir):
    return metrics.session_leaderboard(_m(spark, sf_dir).dashboard_laps, ["session_key", "driver_number"])


@query("overview_metrics", f"""
SELECT session_key, {_FMT.format(x='fast')} AS fastest_lap, drv AS fastest_driver,
       CAST(CAST(round_even(CAST(top AS DOUBLE), 0) AS BIGINT) AS VARCHAR) || ' km/h' AS top_speed, format('{{:,}}', n) AS lap_count
FROM (SELECT session_key, min(lap_duration) AS fast,
             first(name_acronym ORDER BY lap_duration, lap_number, driver_number) AS drv,
             max(top_speed) AS top, count(*) AS n
      FROM dashboard_laps GROUP BY session_key) z""")
def q_overview(spark, sf_dir):
    return metrics.overview_metrics(_m(spark, sf_dir).dashboard_laps, ["session_key"])


_SEASON_DRIVERS_SQL = """
SELECT driver_number, arg_max(full_name, session_key) AS full_name, arg_max(name_acronym, session_key) AS name_acronym,
       arg_max(team_name, session_key) AS team_name, arg_max(team_colour_hex, session_key) AS team_colour_hex,
       count(DISTINCT session_key) AS races, count(*) AS laps, min(lap_duration) AS fastest_lap,
       avg(delta_to_driver_best) AS average_delta_to_best, max(top_speed) AS top_speed
FROM dashboard_laps WHERE season = 2024 GROUP BY driver_number"""


cte("season_races_2024", _SEASON_RACES_SQL)
cte("season_drivers_2024", _SEASON_DRIVERS_SQL)


@query("season_metrics", f"""
SELECT format('{{:,}}', (SELECT count(*) FROM season_races_2024)) AS race_count,
       CASE WHEN (SELECT count(*) FROM season_races_2024) = 0 THEN '0'
            ELSE format('{{:,}}', (SELECT count(*) FROM season_drivers_2024)) END AS driver_count,
       format('{{:,}}', CAST((SELECT COALESCE(sum(lap_count), 0) FROM season_races_2024) AS BIGINT)) AS lap_count,
       COALESCE((SELECT {_FMT.format(x='fastest_lap')} FROM season_races_2024 ORDER BY fastest_lap, session_start LIMIT 1), '—') AS fastest_lap,
       COALESCE((SELECT fastest_driver FROM season_races_2024 ORDER BY fastest_lap, session_start LIMIT 1), '—') AS fastest_driver""")
def q_season_metrics(spark, sf_dir):
    m = _m(spark, sf_dir)
    return metrics.season_metrics(repository.season_races(m, SEASON), repository.season_drivers(m, SEASON))


@query("axis_range", """
SELECT session_key,
       CASE WHEN abs(lo - hi) <= 1e-9 * greatest(abs(lo), abs(hi)) THEN lo - 1 ELSE lo - (hi - lo) * 0.05 END AS axis_min,
       CASE WHEN abs(lo - hi) <= 1e-9 * greatest(abs(lo), abs(hi)) THEN hi + 1 ELSE hi + (hi - lo) * 0.05 END AS axis_max
FROM (SELECT session_key, min(lap_duration) AS lo, max(lap_duration) AS hi FROM dashboard_laps
      WHERE lap_duration IS NOT NULL AND NOT isnan(lap_duration) GROUP BY session_key) z""")
def q_axis(spark, sf_dir):
    return metrics.axis_range(_m(spark, sf_dir).dashboard_laps, "lap_duration", ["session_key"])


# ---------------------------------------------------------------------------
# serving queries (R1-R11) - parameters set to "all"
# ---------------------------------------------------------------------------
@query("repo_sessions", f"SELECT {', '.join(repository.SESSION_COLUMNS)} FROM dim_sessions")
def q_repo_sessions(spark, sf_dir):
    return repository.sessions(_m(spark, sf_dir))


@query("season_races", _SEASON_RACES_SQL)
def q_season_races(spark, sf_dir):
    return repository.season_races(_m(spark, sf_dir), SEASON)


@query("season_drivers", f"""
SELECT driver_number, full_name, name_acronym, team_name, team_colour_hex, races, laps, fastest_lap,
       round(average_delta_to_best, 6) AS average_delta_to_best, top_speed
FROM ({_SEASON_DRIVERS_SQL}) d""")
def q_season_drivers(spark, sf_dir):
    return r6(repository.season_drivers(_m(spark, sf_dir), SEASON))


@query("season_winners", """
SELECT * FROM (
  SELECT driver_number, arg_max(full_name, session_key) AS full_name, arg_max(name_acronym, session_key) AS name_acronym,
         arg_max(team_name, session_key) AS team_name, arg_max(team_colour_hex, session_key) AS team_colour_hex,
         CAST(count_if(finishing_position = 1) AS BIGINT) AS wins,
         CAST(count_if(finishing_position <= 3) AS BIGINT) AS podiums, sum(points) AS points
  FROM race_res WHERE season = 2024 GROUP BY driver_number) w
WHERE wins > 0""")
def q_season_winners(spark, sf_dir):
    return repository.season_winners(_m(spark, sf_dir), SEASON)


@query("repo_race_results", f"SELECT {', '.join(repository.RESULT_COLUMNS)} FROM race_res")
def q_repo_results(spark, sf_dir):
    return repository.race_results(_m(spark, sf_dir))


@query("repo_drivers", f"SELECT {', '.join(repository.DRIVER_COLUMNS)} FROM dim_drivers")
def q_repo_drivers(spark, sf_dir):
    return repository.drivers(_m(spark, sf_dir))


@query("laps_for_drivers", _r6sql(gold.DASHBOARD_COLUMNS, "dashboard_laps"))
def q_laps_for(spark, sf_dir):
    return r6(repository.laps(_m(spark, sf_dir)))


@query("tires_for_drivers", _r6sql(gold.DEGRADATION_COLUMNS, "tire_deg"))
def q_tires_for(spark, sf_dir):
    return r6(repository.tire_degradation(_m(spark, sf_dir)))


@query("v_min_for_drivers", f"SELECT {', '.join(repository.V_MIN_COLUMNS)} FROM vmin")
def q_vmin_for(spark, sf_dir):
    return repository.v_min_points(_m(spark, sf_dir))


@query("single_lap_telemetry", f"SELECT {', '.join(repository.TELEMETRY_COLUMNS)} FROM enriched")
def q_single_lap(spark, sf_dir):
    return repository.telemetry(_m(spark, sf_dir))


@query("fastest_lap_telemetry", """
SELECT t.telemetry_timestamp, t.driver_number, d.full_name, d.name_acronym, d.team_colour_hex, t.lap_number,
       t.speed, t.throttle, t.brake
FROM enriched t
JOIN (SELECT session_key, driver_number, first(lap_number ORDER BY lap_duration, lap_number) AS lap_number
      FROM dashboard_laps WHERE lap_duration IS NOT NULL AND NOT is_pit_out_lap
      GROUP BY session_key, driver_number) f
  ON t.session_key = f.session_key AND t.driver_number = f.driver_number AND t.lap_number = f.lap_number
JOIN dim_drivers d ON t.session_key = d.session_key AND t.driver_number = d.driver_number""")
def q_fastest_tel(spark, sf_dir):
    return repository.fastest_lap_telemetry(_m(spark, sf_dir))


# -- serving with its parameters set -------------------------------------------
SERVED_SESSION, SERVED_DRIVERS, SERVED_LAP = 9001, [1, 5, 14], 3
_SERVED = f"session_key = {SERVED_SESSION} AND driver_number IN ({', '.join(map(str, SERVED_DRIVERS))})"


@query("served_laps", _r6sql(gold.DASHBOARD_COLUMNS, f"(SELECT * FROM dashboard_laps WHERE {_SERVED}) z"))
def q_served_laps(spark, sf_dir):
    return r6(repository.laps(_m(spark, sf_dir), SERVED_SESSION, SERVED_DRIVERS, ordered=True))


@query("served_laps_none", _r6sql(gold.DASHBOARD_COLUMNS, "(SELECT * FROM dashboard_laps WHERE FALSE) z"))
def q_served_none(spark, sf_dir):
    return r6(repository.laps(_m(spark, sf_dir), SERVED_SESSION, [], ordered=True))


@query("served_tires", _r6sql(gold.DEGRADATION_COLUMNS, f"(SELECT * FROM tire_deg WHERE {_SERVED}) z"))
def q_served_tires(spark, sf_dir):
    return r6(repository.tire_degradation(_m(spark, sf_dir), SERVED_SESSION, SERVED_DRIVERS, ordered=True))


@query("served_v_min", f"SELECT {', '.join(repository.V_MIN_COLUMNS)} FROM vmin WHERE {_SERVED}")
def q_served_v_min(spark, sf_dir):
    return repository.v_min_points(_m(spark, sf_dir), SERVED_SESSION, SERVED_DRIVERS, ordered=True)


@query("served_lap_telemetry", f"""SELECT {', '.join(repository.TELEMETRY_COLUMNS)} FROM enriched
WHERE session_key = {SERVED_SESSION} AND driver_number = {SERVED_DRIVERS[0]} AND lap_number = {SERVED_LAP}""")
def q_served_lap(spark, sf_dir):
    return repository.telemetry(_m(spark, sf_dir), SERVED_SESSION, SERVED_DRIVERS[0], SERVED_LAP, ordered=True)


@query("served_race_results", f"SELECT {', '.join(repository.RESULT_COLUMNS)} FROM race_res WHERE session_key = {SERVED_SESSION}")
def q_served_results(spark, sf_dir):
    return repository.race_results(_m(spark, sf_dir), SERVED_SESSION, ordered=True)


@query("served_drivers", f"SELECT {', '.join(repository.DRIVER_COLUMNS)} FROM dim_drivers WHERE session_key = {SERVED_SESSION}")
def q_served_drivers(spark, sf_dir):
    return repository.drivers(_m(spark, sf_dir), SERVED_SESSION, ordered=True)


@query("telemetry_trace", """
SELECT *, (epoch_us(telemetry_timestamp) - min(epoch_us(telemetry_timestamp)) OVER (PARTITION BY session_key, driver_number)) / 1e6 AS elapsed_seconds,
       brake * 100 AS brake_pct
FROM (SELECT t.session_key, t.telemetry_timestamp, t.driver_number, d.full_name, d.name_acronym, d.team_colour_hex,
             t.lap_number, t.speed, t.throttle, t.brake
      FROM enriched t
      JOIN (SELECT session_key, driver_number, first(lap_number ORDER BY lap_duration, lap_number) AS lap_number
            FROM dashboard_laps WHERE lap_duration IS NOT NULL AND NOT is_pit_out_lap
            GROUP BY session_key, driver_number) f
        ON t.session_key = f.session_key AND t.driver_number = f.driver_number AND t.lap_number = f.lap_number
      JOIN dim_drivers d ON t.session_key = d.session_key AND t.driver_number = d.driver_number) z""")
def q_trace(spark, sf_dir):
    """The fastest-lap trace of every driver of every race, prepared for
    drawing (elapsed seconds per driver, brake scaled)."""
    m = _m(spark, sf_dir)
    fl = repository.fastest_laps_of(m)
    t = m.enriched.select("session_key", "driver_number", "lap_number", "telemetry_timestamp", "speed",
                          "throttle", "brake")
    d = m.dim_drivers.select("session_key", "driver_number", "full_name", "name_acronym", "team_colour_hex")
    j = t.join(fl, ["session_key", "driver_number", "lap_number"]).join(d, ["session_key", "driver_number"])
    return metrics.telemetry_trace(j, ["session_key", "driver_number"])


# ---------------------------------------------------------------------------
# dashboard frames
# ---------------------------------------------------------------------------
@query("podium", """
SELECT session_key, driver_number, finishing_position, podium_place FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY session_key ORDER BY finishing_position, driver_number) AS BIGINT) AS podium_place
  FROM race_res) z WHERE podium_place <= 3""")
def q_podium(spark, sf_dir):
    return metrics.podium(_m(spark, sf_dir).race_results)


cte("podium_present", """
SELECT p.session_key, p.driver_number FROM (
  SELECT session_key, driver_number,
         row_number() OVER (PARTITION BY session_key ORDER BY finishing_position, driver_number) AS rn
  FROM race_res) p
JOIN dim_drivers d ON p.session_key = d.session_key AND p.driver_number = d.driver_number
WHERE p.rn <= 3""")
cte("first_three_drivers", """
SELECT session_key, driver_number FROM (
  SELECT session_key, driver_number,
         row_number() OVER (PARTITION BY session_key ORDER BY team_name, driver_number) AS rn
  FROM dim_drivers) z WHERE rn <= 3""")


@query("default_drivers", """
SELECT * FROM podium_present
UNION ALL
SELECT * FROM first_three_drivers WHERE session_key NOT IN (SELECT session_key FROM podium_present)""")
def q_default_drivers(spark, sf_dir):
    m = _m(spark, sf_dir)
    return metrics.default_drivers(m.race_results, m.dim_drivers)


@query("season_options", "SELECT DISTINCT CAST(season AS BIGINT) AS season FROM dim_sessions")
def q_season_options(spark, sf_dir):
    return metrics.season_options(_m(spark, sf_dir).dim_sessions)


@query("lap_options", """
SELECT DISTINCT session_key, driver_number, lap_number FROM dashboard_laps WHERE lap_number IS NOT NULL""")
def q_lap_options(spark, sf_dir):
    return metrics.lap_options(_m(spark, sf_dir).dashboard_laps)


@query("v_min_with_drivers", """
SELECT v.*, d.full_name, d.name_acronym, d.team_colour_hex FROM vmin v
LEFT JOIN dim_drivers d ON v.session_key = d.session_key AND v.driver_number = d.driver_number""")
def q_vmin_drivers(spark, sf_dir):
    m = _m(spark, sf_dir)
    return metrics.v_min_with_drivers(m.corner_performance, m.dim_drivers)


@query("clean_lap_table", f"""
SELECT session_key, name_acronym, lap_number, {_FMT.format(x='lap_duration')} AS formatted_time,
       delta_to_driver_best, tire_compound, tire_age_at_lap_end
FROM dashboard_laps WHERE NOT is_pit_out_lap""")
def q_clean_table(spark, sf_dir):
    return metrics.clean_lap_table(_m(spark, sf_dir).dashboard_laps)


# ---------------------------------------------------------------------------
# data quality
# ---------------------------------------------------------------------------
ORACLE_TABLE = {"stg_drivers": "stg_drivers", "stg_sessions": "stg_sessions", "stg_meetings": "stg_meetings",
                "stg_session_results": "stg_session_results", "dim_sessions": "dim_sessions",
                "dim_drivers": "dim_drivers", "fct_lap_leaderboard": "leaderboard",
                "fct_dashboard_laps": "dashboard_laps", "fct_tire_degradation": "tire_deg",
                "fct_corner_performance": "vmin", "fct_race_results": "race_res"}


def _tests(kind: str):
    for t, spec in quality.SCHEMA_TESTS.items():
        for c, s in spec.items():
            if kind in s and s[kind]:
                yield t, c, s[kind]


def _not_null_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS failures "
        f"FROM {ORACLE_TABLE[t]}"
        for t, c, _ in _tests("not_null"))


def _unique_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS failures FROM "
        f"(SELECT {c} FROM {ORACLE_TABLE[t]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) z"
        for t, c, _ in _tests("unique"))


def _relationships_sql(with_parent: bool = True) -> str:
    parts = []
    for t, c, (pt, pc) in _tests("relationships"):
        parent = f", '{pt}' AS parent_table" if with_parent else ""
        parts.append(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name{parent}, count(*) AS failures FROM {ORACLE_TABLE[t]} ch "
            f"WHERE ch.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {ORACLE_TABLE[pt]} p WHERE p.{pc} = ch.{c})")
    return "\nUNION ALL\n".join(parts)


def _accepted_sql() -> str:
    parts = []
    for t, c, values in _tests("accepted_values"):
        lst = ", ".join(f"'{v}'" for v in values)
        parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS failures FROM "
                     f"(SELECT {c} FROM {ORACLE_TABLE[t]} WHERE {c} NOT IN ({lst}) GROUP BY {c}) z")
    return "\nUNION ALL\n".join(parts)


_GRAIN_SQL = """SELECT session_key, driver_number, lap_number FROM dashboard_laps
GROUP BY session_key, driver_number, lap_number HAVING count(*) != 1"""
_LAP_METRICS_SQL = """SELECT * FROM dashboard_laps WHERE lap_duration <= 0 OR delta_to_session_best < 0
OR delta_to_driver_best < 0 OR top_speed < 0 OR v_min < 0"""
_POSITIONS_SQL = """SELECT session_key, finishing_position FROM race_res GROUP BY session_key, finishing_position
HAVING count(*) != 1 OR finishing_position < 1"""
_TIRE_METRICS_SQL = """SELECT * FROM tire_deg WHERE strategy_stint_number < 1 OR lap_in_stint < 1
OR tire_age_at_lap_end < 0 OR delta_to_stint_best < 0 OR rolling_three_lap_average <= 0"""


@query("dq_not_null", _not_null_sql())
def q_dq_not_null(spark, sf_dir):
    return quality.dq_not_null(_m(spark, sf_dir))


@query("dq_unique", _unique_sql())
def q_dq_unique(spark, sf_dir):
    return quality.dq_unique(_m(spark, sf_dir))


@query("dq_relationships", _relationships_sql())
def q_dq_rel(spark, sf_dir):
    return quality.dq_relationships(_m(spark, sf_dir))


@query("dq_accepted_values", _accepted_sql())
def q_dq_acc(spark, sf_dir):
    return quality.dq_accepted_values(_m(spark, sf_dir))


@query("dq_unique_grain", _GRAIN_SQL)
def q_dq_grain(spark, sf_dir):
    return quality.dq_unique_grain(_m(spark, sf_dir).dashboard_laps)


@query("dq_lap_metrics", _r6sql(gold.DASHBOARD_COLUMNS, f"({_LAP_METRICS_SQL}) z"))
def q_dq_lap_metrics(spark, sf_dir):
    return r6(quality.dq_lap_metrics(_m(spark, sf_dir).dashboard_laps))


@query("dq_positions", _POSITIONS_SQL)
def q_dq_positions(spark, sf_dir):
    return quality.dq_positions(_m(spark, sf_dir).race_results)


@query("dq_tire_metrics", _r6sql(gold.DEGRADATION_COLUMNS, f"({_TIRE_METRICS_SQL}) z"))
def q_dq_tire(spark, sf_dir):
    return r6(quality.dq_tire_metrics(_m(spark, sf_dir).tire_degradation))


def _summary_sql() -> str:
    def tagged(sql: str, check: str) -> str:
        return f"SELECT table_name, '{check}' AS check_name, column_name, CAST(failures AS BIGINT) AS failures FROM ({sql}) z"

    def singular(sql: str, table: str, check: str) -> str:
        return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '' AS column_name, "
                f"CAST(count(*) AS BIGINT) AS failures FROM ({sql}) z")

    return "\nUNION ALL\n".join([
        tagged(_not_null_sql(), "not_null"), tagged(_unique_sql(), "unique"),
        tagged(_relationships_sql(with_parent=False), "relationships"), tagged(_accepted_sql(), "accepted_values"),
        singular(_GRAIN_SQL, "fct_dashboard_laps", "lap_grain"),
        singular(_LAP_METRICS_SQL, "fct_dashboard_laps", "lap_metrics"),
        singular(_POSITIONS_SQL, "fct_race_results", "result_positions"),
        singular(_TIRE_METRICS_SQL, "fct_tire_degradation", "degradation_metrics")])


# the singular checks on the same tables with faults planted by key
@query("dq_unique_grain_planted", """SELECT session_key, driver_number, lap_number
FROM (SELECT * FROM dashboard_laps UNION ALL SELECT * FROM dashboard_laps WHERE driver_number % 3 = 0)
GROUP BY session_key, driver_number, lap_number HAVING count(*) != 1""")
def q_dq_grain_planted(spark, sf_dir):
    laps = _m(spark, sf_dir).dashboard_laps
    return quality.dq_unique_grain(laps.unionByName(laps.where("driver_number % 3 = 0")))


@query("dq_lap_metrics_planted", """SELECT lap_id, top_speed FROM dashboard_laps WHERE driver_number % 5 = 0 OR lap_number % 4 = 0
OR lap_duration <= 0 OR delta_to_session_best < 0 OR delta_to_driver_best < 0 OR top_speed < 0 OR v_min < 0""")
def q_dq_lap_metrics_planted(spark, sf_dir):
    laps = _m(spark, sf_dir).dashboard_laps
    bad = laps.withColumn("lap_duration", F.when(F.col("driver_number") % 5 == 0, -F.col("lap_duration")).otherwise(F.col("lap_duration")))
    bad = bad.withColumn("v_min", F.when(F.col("lap_number") % 4 == 0, F.lit(-1.0)).otherwise(F.col("v_min")))
    return quality.dq_lap_metrics(bad).select("lap_id", "top_speed")


@query("dq_positions_planted", """SELECT session_key, finishing_position - 1 AS finishing_position
FROM (SELECT * FROM race_res UNION ALL SELECT * FROM race_res WHERE finishing_position % 4 = 3)
GROUP BY session_key, finishing_position HAVING count(*) != 1 OR finishing_position < 2""")
def q_dq_positions_planted(spark, sf_dir):
    r = _m(spark, sf_dir).race_results
    bad = r.unionByName(r.where("finishing_position % 4 = 3"))
    return quality.dq_positions(bad.withColumn("finishing_position", F.col("finishing_position") - 1))


@query("dq_tire_metrics_planted", """SELECT degradation_id, lap_in_stint FROM tire_deg WHERE driver_number % 4 = 0
OR strategy_stint_number < 1 OR lap_in_stint < 1 OR tire_age_at_lap_end < 0 OR delta_to_stint_best < 0 OR rolling_three_lap_average <= 0""")
def q_dq_tire_planted(spark, sf_dir):
    deg = _m(spark, sf_dir).tire_degradation
    bad = deg.withColumn("tire_age_at_lap_end", F.when(F.col("driver_number") % 4 == 0, -1).otherwise(F.col("tire_age_at_lap_end")))
    return quality.dq_tire_metrics(bad).select("degradation_id", "lap_in_stint")


# the column tests on tables with faults planted by key: the same tests, with failures
_BAD_LAPS = """(SELECT CASE WHEN lap_number % 7 <> 0 THEN lap_id END AS lap_id, lap_duration, CASE WHEN driver_number % 3 = 0 THEN driver_session_id || '?' ELSE driver_session_id END AS driver_session_id,
 CASE WHEN lap_number % 5 = 0 THEN 'compound ' || driver_number % 4 ELSE tire_compound END AS tire_compound FROM dashboard_laps
 UNION ALL SELECT lap_id, NULL, driver_session_id, tire_compound FROM dashboard_laps WHERE driver_number % 4 = 1) z"""


def _bad_laps(spark, sf_dir) -> DataFrame:
    laps = _m(spark, sf_dir).dashboard_laps.select("lap_id", "lap_duration", "driver_session_id", "tire_compound", "lap_number", "driver_number")
    again = laps.where("driver_number % 4 = 1").withColumn("lap_duration", F.lit(None).cast("double"))
    odd = F.concat(F.lit("compound "), (F.col("driver_number") % 4).cast("string"))
    bad = laps.withColumn("lap_id", F.when(F.col("lap_number") % 7 != 0, F.col("lap_id")))
    bad = bad.withColumn("driver_session_id", F.when(F.col("driver_number") % 3 == 0, F.concat("driver_session_id", F.lit("?"))).otherwise(F.col("driver_session_id")))
    bad = bad.withColumn("tire_compound", F.when(F.col("lap_number") % 5 == 0, odd).otherwise(F.col("tire_compound")))
    return bad.unionByName(again).drop("lap_number", "driver_number")


@query("dq_columns_planted", f"""SELECT 'laps' AS table_name, 'not_null' AS check_name, 'lap_id' AS column_name, CAST(count_if(lap_id IS NULL) AS BIGINT) AS failures FROM {_BAD_LAPS}
UNION ALL SELECT 'laps', 'not_null', 'lap_duration', CAST(count_if(lap_duration IS NULL) AS BIGINT) FROM {_BAD_LAPS}
UNION ALL SELECT 'laps', 'unique', 'lap_id', count(*) FROM (SELECT lap_id FROM {_BAD_LAPS} WHERE lap_id IS NOT NULL GROUP BY lap_id HAVING count(*) > 1) y""")
def q_dq_columns_planted(spark, sf_dir):
    return quality.column_checks(_bad_laps(spark, sf_dir), {"lap_id": {"not_null": True, "unique": True}, "lap_duration": {"not_null": True}}, "laps")


@query("dq_relationships_planted", f"""SELECT lap_id, driver_session_id FROM {_BAD_LAPS} WHERE driver_session_id IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM dim_drivers p WHERE p.driver_session_id = z.driver_session_id)""")
def q_dq_relationships_planted(spark, sf_dir):
    bad = quality.relationship_violations(_bad_laps(spark, sf_dir), "driver_session_id", _m(spark, sf_dir).dim_drivers, "driver_session_id")
    return bad.select("lap_id", "driver_session_id")


@query("dq_accepted_values_planted", f"""SELECT tire_compound, count(*) AS n FROM {_BAD_LAPS}
WHERE tire_compound NOT IN ({", ".join(f"'{v}'" for v in quality.SCHEMA_TESTS["fct_dashboard_laps"]["tire_compound"]["accepted_values"])}) GROUP BY tire_compound""")
def q_dq_accepted_planted(spark, sf_dir):
    values = quality.SCHEMA_TESTS["fct_dashboard_laps"]["tire_compound"]["accepted_values"]
    return quality.accepted_value_violations(_bad_laps(spark, sf_dir), "tire_compound", values)


@query("dq_summary", _summary_sql())
def q_dq_summary(spark, sf_dir):
    return quality.run_checks(_m(spark, sf_dir))


# the landing of races, the analyses on the track and the served order register themselves
from trackline.queries import races, served, track  # noqa: E402,F401
