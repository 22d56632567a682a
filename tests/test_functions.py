"""Golden values of the dashboard helpers (the reference's own unit tests)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from trackline.functions import scalar as fx
from trackline.plans import metrics


def test_format_lap_time(spark):
    df = spark.createDataFrame([(80.5,), (None,), (float("nan"),), (59.9996,), (0.0,), (3725.25,)], "s double")
    got = [r[0] for r in df.select(fx.format_lap_time("s")).collect()]
    assert got == ["1:20.500", "—", "—", "0:60.000", "0:00.000", "62:05.250"]


def test_composite_key_null_part(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3)], "a long, b long, c long")
    got = [r[0] for r in df.select(fx.composite_key("a", "b", "c")).collect()]
    assert got == ["1-2-3", None]


def test_result_status_priority(spark):
    df = spark.createDataFrame([(True, True, True), (True, False, False), (False, True, True),
                                (False, False, True), (False, False, False), (None, None, None)],
                               "dnf boolean, dns boolean, dsq boolean")
    got = [r[0] for r in df.select(fx.result_status("dsq", "dns", "dnf")).collect()]
    assert got == ["DSQ", "DNF", "DSQ", "DSQ", "Classified", "Classified"]


def test_safe_double(spark):
    df = spark.createDataFrame([("0",), ("12.5",), ("+1 LAP",), (None,)], "g string")
    got = [r[0] for r in df.select(fx.safe_double("g")).collect()]
    assert got == [0.0, 12.5, None, None]


def test_add_seconds_rounds_half_away(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1.0005)], "t timestamp_ntz, s double")
    got = df.select(fx.add_seconds_ms("t", "s")).first()[0]
    assert got == dt.datetime(2025, 1, 1, 0, 0, 1, 1000)


def test_round_half_up_on_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (None,)], "x double")
    got = [r[0] for r in df.select(fx.round_half_up("x", 2)).collect()]
    assert got == [1.01, 2.68, None]


def test_conditions_label(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "w boolean")
    assert [r[0] for r in df.select(fx.conditions_label("w")).collect()] == ["Wet", "Dry", "Unknown"]


LAPS = [(4, "NOR", 81.234, 312, 1), (4, "NOR", 80.5, 315, 2), (1, "VER", 80.75, 318, 1)]
LAP_SCHEMA = "driver_number long, name_acronym string, lap_duration double, top_speed long, lap_number long"


def test_fastest_laps(spark):
    df = spark.createDataFrame(LAPS, LAP_SCHEMA)
    got = metrics.fastest_laps(df).orderBy("lap_duration").select("name_acronym", "lap_duration").collect()
    assert [tuple(r) for r in got] == [("NOR", 80.5), ("VER", 80.75)]


def test_overview_metrics(spark):
    df = spark.createDataFrame(LAPS, LAP_SCHEMA)
    r = metrics.overview_metrics(df).first().asDict()
    assert r == {"fastest_lap": "1:20.500", "fastest_driver": "NOR", "top_speed": "318 km/h", "lap_count": "3"}


def test_overview_metrics_empty(spark):
    df = spark.createDataFrame([], LAP_SCHEMA)
    r = metrics.overview_metrics(df).first().asDict()
    assert r == {"fastest_lap": "—", "fastest_driver": "—", "top_speed": "—", "lap_count": "0"}


def test_season_metrics(spark):
    races = spark.createDataFrame(
        [(80.5, "NOR", 921, dt.datetime(2024, 3, 1)), (91.1, "VER", 850, dt.datetime(2024, 3, 8))],
        "fastest_lap double, fastest_driver string, lap_count long, session_start timestamp_ntz")
    drivers = spark.createDataFrame([(1,), (4,), (16,)], "driver_number long")
    r = metrics.season_metrics(races, drivers).first().asDict()
    assert r == {"race_count": "2", "driver_count": "3", "lap_count": "1,771", "fastest_lap": "1:20.500",
                 "fastest_driver": "NOR"}


def test_season_metrics_empty(spark):
    races = spark.createDataFrame([], "fastest_lap double, fastest_driver string, lap_count long, "
                                      "session_start timestamp_ntz")
    drivers = spark.createDataFrame([], "driver_number long")
    r = metrics.season_metrics(races, drivers).first().asDict()
    assert r == {"race_count": "0", "driver_count": "0", "lap_count": "0", "fastest_lap": "—",
                 "fastest_driver": "—"}


def test_elapsed_time(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 16, 4, 0, 1),), (dt.datetime(2025, 3, 16, 4, 0, 3, 500000),)],
                               "telemetry_timestamp timestamp_ntz")
    got = sorted(r[0] for r in metrics.elapsed_time(df).select("elapsed_seconds").collect())
    assert got == [0.0, 2.5]


@pytest.mark.parametrize("values,expected", [([10.0, 10.0], (9.0, 11.0)), ([], None), ([0.0, 100.0], (-5.0, 105.0)),
                                             ([None, 3.0], (2.0, 4.0))])
def test_axis_range(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    r = metrics.axis_range(df, "v").first()
    got = None if r is None or r["axis_min"] is None else (r["axis_min"], r["axis_max"])
    if expected is None:
        assert got is None
    else:
        assert all(math.isclose(a, b) for a, b in zip(got, expected))


def test_speed_label_half_even(spark):
    df = spark.createDataFrame([(318.5,), (317.5,), (None,)], "v double")
    assert [r[0] for r in df.select(fx.speed_label("v")).collect()] == ["318 km/h", "318 km/h", "—"]


def test_thousands(spark):
    df = spark.createDataFrame([(1771,), (3,), (1234567,)], "n long")
    assert [r[0] for r in df.select(fx.thousands("n")).collect()] == ["1,771", "3", "1,234,567"]


def test_labels(spark):
    s = spark.createDataFrame([(1, "Bahrain GP", "Race", 2024)], "session_key long, meeting_name string, "
                                                                  "session_name string, season long")
    assert metrics.session_labels(s).first()["label"] == "Bahrain GP · Race (2024)"
    d = spark.createDataFrame([(1, 4, "NOR", "McLaren")], "session_key long, driver_number long, "
                                                             "name_acronym string, team_name string")
    assert metrics.driver_labels(d).first()["label"] == "NOR · McLaren"
