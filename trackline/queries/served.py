"""Serving calls with their parameters set, with the place of every row, so
that the order in which they are served is compared too."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackline.plans import repository
from trackline.queries.registry import _SERVED, SERVED_DRIVERS, SERVED_SESSION, _m, query


def placed(df: DataFrame) -> DataFrame:
    """``df`` with the ``place`` of its rows as they come (ids rise along the
    partitions of a sorted frame).  For what a page shows: one race's rows."""
    w = Window.orderBy("_at")
    return df.withColumn("_at", F.monotonically_increasing_id()).withColumn("place", F.row_number().over(w).cast("bigint")).drop("_at")


def _sql(columns: str, source: str, order: str) -> str:
    return f"SELECT {columns}, row_number() OVER (ORDER BY {order}) AS place FROM {source}"


@query("order_sessions", _sql("session_key, session_start", "dim_sessions", "session_start DESC"))
def q_order_sessions(spark, sf_dir):
    return placed(repository.sessions(_m(spark, sf_dir), ordered=True)).select("session_key", "session_start", "place")


@query("order_laps", _sql("lap_id", f"dashboard_laps WHERE {_SERVED}", "lap_number, driver_number"))
def q_order_laps(spark, sf_dir):
    return placed(repository.laps(_m(spark, sf_dir), SERVED_SESSION, SERVED_DRIVERS, ordered=True)).select("lap_id", "place")


@query("order_tires", _sql("degradation_id", f"tire_deg WHERE session_key = {SERVED_SESSION}", "driver_number, lap_number"))
def q_order_tires(spark, sf_dir):
    return placed(repository.tire_degradation(_m(spark, sf_dir), SERVED_SESSION, ordered=True)).select("degradation_id", "place")


@query("order_v_min", _sql("driver_number, lap_number, lap_v_min", f"vmin WHERE session_key = {SERVED_SESSION}", "driver_number, lap_number"))
def q_order_v_min(spark, sf_dir):
    return placed(repository.v_min_points(_m(spark, sf_dir), SERVED_SESSION, ordered=True)).select("driver_number", "lap_number", "lap_v_min", "place")


@query("order_drivers", _sql("driver_session_id", f"dim_drivers WHERE session_key = {SERVED_SESSION}", "team_name, driver_number"))
def q_order_drivers(spark, sf_dir):
    return placed(repository.drivers(_m(spark, sf_dir), SERVED_SESSION, ordered=True)).select("driver_session_id", "place")


@query("order_results", _sql("result_id", f"race_res WHERE session_key = {SERVED_SESSION}", "finishing_position"))
def q_order_results(spark, sf_dir):
    return placed(repository.race_results(_m(spark, sf_dir), SERVED_SESSION, ordered=True)).select("result_id", "place")


_FASTEST = f"""(SELECT t.telemetry_timestamp, t.driver_number, d.full_name, d.name_acronym, d.team_colour_hex, t.lap_number, t.speed, t.throttle, t.brake
 FROM enriched t JOIN dim_drivers d ON d.session_key = t.session_key AND d.driver_number = t.driver_number
 WHERE t.session_key = {SERVED_SESSION} AND t.lap_number = (
   SELECT arg_min(l.lap_number, (l.lap_duration, l.lap_number)) FROM dashboard_laps l
   WHERE l.session_key = t.session_key AND l.driver_number = t.driver_number AND l.lap_duration IS NOT NULL AND NOT l.is_pit_out_lap)
 AND t.driver_number IN (SELECT driver_number FROM dim_drivers WHERE session_key = {SERVED_SESSION} AND driver_number % 2 = 1)) f"""


@query("served_fastest_lap_telemetry", _sql("*", _FASTEST, "driver_number, telemetry_timestamp"))
def q_served_fastest(spark, sf_dir):
    m = _m(spark, sf_dir)
    # the selection of a page: the race's drivers with odd numbers
    chosen = [r[0] for r in repository.drivers(m, SERVED_SESSION).where("driver_number % 2 = 1").select("driver_number").collect()]
    return placed(repository.fastest_lap_telemetry(m, SERVED_SESSION, chosen, ordered=True))
