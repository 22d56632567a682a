"""Model semantics on hand-made bronze frames: the edge cases the generated
data does not cover (FIXTURES.md section 2)."""

import datetime as dt

import pytest

from trackline.plans.models import Models
from trackline.sources.schemas import BRONZE_SCHEMAS

T0 = dt.datetime(2025, 3, 16, 4, 0, 0)
S = 9693


def ts(sec):
    return None if sec is None else T0 + dt.timedelta(seconds=sec)


def frame(spark, table, records):
    schema = BRONZE_SCHEMAS[table]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(data, schema)


def lap(d, n, start, dur, pit=False):
    return {"session_key": S, "driver_number": d, "lap_number": n, "date_start": ts(start), "lap_duration": dur,
            "is_pit_out_lap": pit}


def car(d, t, speed=100, brake=0, throttle=50):
    return {"session_key": S, "driver_number": d, "date": ts(t), "speed": speed, "rpm": 10000, "n_gear": 5,
            "throttle": throttle, "brake": brake, "drs": 0}


@pytest.fixture(scope="module")
def models(spark):
    laps = [lap(1, 1, 0, 10.0), lap(1, 2, 10, 12.0), lap(1, 3, None, 11.0), lap(1, 4, 33, None)]
    # driver 2: clean laps for stint inference (100 s apart)
    laps += [lap(2, n, 100 * n, 90.0 + n, pit=(None if n == 8 else False)) for n in range(1, 9)]
    cars = [car(1, 1), car(1, 5, speed=80), car(1, 9.9996), car(1, 12, brake=1), car(1, 20, speed=300, brake=1),
            car(1, 21.9), car(1, 22), car(1, 35)]
    cars += [car(2, 100 * n + 1, speed=200 + n) for n in range(1, 9)]
    weather = [{"session_key": S, "date": ts(0.5), "air_temperature": 18.0, "track_temperature": 30.0,
                "rainfall": False},
               {"session_key": S, "date": ts(5), "air_temperature": 20.0, "track_temperature": 31.0,
                "rainfall": True}]
    rc = [{"session_key": S, "date": ts(2), "category": "SafetyCar", "flag": None, "message": "SC"},
          {"session_key": S, "date": ts(3), "category": "Flag", "flag": "BLUE", "message": "blue"},
          {"session_key": S, "date": ts(4), "category": "Flag", "flag": "YELLOW", "message": "y"},
          {"session_key": S, "date": ts(15), "category": "Drs", "flag": None, "message": "drs"}]
    loc = [{"session_key": S, "driver_number": 1, "date": ts(5), "x": 1.0, "y": 2.0, "z": 0.0}]
    stints = [  # driver 1: overlapping first stint, ongoing second stint
        {"session_key": S, "driver_number": 1, "stint_number": 1, "compound": "soft", "tyre_age_at_start": 3,
         "lap_start": 1, "lap_end": 3},
        {"session_key": S, "driver_number": 1, "stint_number": 2, "compound": "medium", "tyre_age_at_start": 0,
         "lap_start": 2, "lap_end": None},
        # driver 2: soft 1-3, medium 4-5, medium 6 (age equal to lap 5), medium 7- (age lower)
        {"session_key": S, "driver_number": 2, "stint_number": 1, "compound": "soft", "tyre_age_at_start": 0,
         "lap_start": 1, "lap_end": 3},
        {"session_key": S, "driver_number": 2, "stint_number": 2, "compound": "medium", "tyre_age_at_start": 5,
         "lap_start": 4, "lap_end": 5},
        {"session_key": S, "driver_number": 2, "stint_number": 3, "compound": "medium", "tyre_age_at_start": 6,
         "lap_start": 6, "lap_end": 6},
        {"session_key": S, "driver_number": 2, "stint_number": 4, "compound": "medium", "tyre_age_at_start": 2,
         "lap_start": 7, "lap_end": None},
    ]
    pits = [{"session_key": S, "driver_number": 1, "lap_number": 2, "stop_duration": 2.5},
            {"session_key": S, "driver_number": 1, "lap_number": 2, "stop_duration": 3.5}]
    drivers = [{"session_key": S, "driver_number": d, "broadcast_name": f"D{d}", "full_name": f"Driver {d}",
                "name_acronym": f"D{d}", "team_name": "Team", "team_colour": "FF8000"} for d in (1, 2, 3)]
    sessions = [{"session_key": S, "session_name": "Race", "session_type": "Race", "meeting_key": 1254,
                 "date_start": ts(0), "date_end": ts(3600), "year": 2025}]
    meetings = [{"meeting_key": 1254, "circuit_key": 10, "meeting_name": "Australian GP",
                 "circuit_short_name": "Melbourne", "circuit_type": "Temporary", "country_name": "Australia",
                 "location": "Melbourne", "date_start": ts(0), "is_cancelled": False, "year": 2025}]
    results = [
        {"session_key": S, "meeting_key": 1254, "driver_number": 1, "position": 1, "number_of_laps": 4,
         "points": 25.0, "gap_to_leader": "0", "dnf": False, "dns": False, "dsq": False},
        {"session_key": S, "meeting_key": 1254, "driver_number": 2, "position": 2, "number_of_laps": 8,
         "points": 18.0, "gap_to_leader": "+1 LAP", "dnf": True, "dns": False, "dsq": True},
        {"session_key": S, "meeting_key": 1254, "driver_number": 3, "position": 3, "number_of_laps": 0,
         "points": 15.0, "gap_to_leader": "12.5", "dnf": False, "dns": False, "dsq": False},
        {"session_key": S, "meeting_key": 1254, "driver_number": 4, "position": None, "number_of_laps": None,
         "points": 0.0, "gap_to_leader": None, "dnf": False, "dns": True, "dsq": False},
    ]
    tables = {
        "laps_raw": frame(spark, "laps_raw", laps), "telemetry_raw": frame(spark, "telemetry_raw", cars),
        "weather_raw": frame(spark, "weather_raw", weather), "race_control_raw": frame(spark, "race_control_raw", rc),
        "location_raw": frame(spark, "location_raw", loc), "stints_raw": frame(spark, "stints_raw", stints),
        "pits_raw": frame(spark, "pits_raw", pits), "driver_raw": frame(spark, "driver_raw", drivers),
        "sessions_metadata": frame(spark, "sessions_metadata", sessions),
        "meetings_metadata": frame(spark, "meetings_metadata", meetings),
        "session_results_raw": frame(spark, "session_results_raw", results),
    }
    return Models(tables)


def test_lap_assignment(models):
    tl = {(r["driver_number"], r["telemetry_timestamp"]): r["lap_number"] for r in models.telemetry_laps.collect()}
    # lap 2 ends at start + duration because lap 3 has no start; t=22 is outside
    assert {k[1]: v for k, v in tl.items() if k[0] == 1} == {ts(1): 1, ts(5): 1, ts(9.9996): 1, ts(12): 2,
                                                             ts(20): 2, ts(21.9): 2}


def test_context_fill(models):
    e = models.enriched.where("driver_number = 1").collect()
    by_t = {}
    for r in e:
        by_t.setdefault(r["telemetry_timestamp"], []).append(r)
    # same instant as the weather and the location rows: both are visible
    r5 = by_t[ts(5)][0]
    assert (r5["air_temperature"], r5["is_raining"], r5["x"], r5["y"]) == (20.0, True, 1.0, 2.0)
    # before any status change: GREEN (SafetyCar without flag and BLUE are ignored)
    r1 = by_t[ts(1)][0]
    assert (r1["track_flag"], r1["air_temperature"], r1["x"]) == ("GREEN", 18.0, None)
    assert r5["track_flag"] == "YELLOW"


def test_stints_and_pits(models):
    e = models.enriched.where("driver_number = 1").collect()
    lap1 = {(r["tire_compound"], r["current_tire_age"]) for r in e if r["lap_number"] == 1}
    lap2 = [r for r in e if r["lap_number"] == 2]
    assert lap1 == {("SOFT", 3)}  # overlapping stint closed at lap 1
    assert {(r["tire_compound"], r["current_tire_age"]) for r in lap2} == {("MEDIUM", 0)}  # ongoing stint
    assert len(lap2) == 6  # two pit rows double the 3 samples
    assert sorted({r["pit_stop_duration_seconds"] for r in lap2}) == [2.5, 3.5]


def test_leaderboard(models):
    lb = {(r["driver_number"], r["lap_number"]): r for r in models.lap_leaderboard.collect()}
    assert lb[(1, 1)]["throttle_brake_ratio"] is None  # brake average 0
    assert lb[(1, 2)]["pit_stop_time"] == 3.5
    assert lb[(1, 2)]["rained_during_lap"] is True
    assert lb[(1, 1)]["fastest_lap_rank"] == 1 and lb[(1, 2)]["fastest_lap_rank"] == 2
    assert lb[(2, 8)]["is_pit_out_lap"] is None


def test_tire_degradation(models):
    deg = {r["lap_number"]: r for r in models.tire_degradation.where("driver_number = 2").collect()}
    assert sorted(deg) == [1, 2, 3, 4, 5, 6, 7]  # lap 8 (NULL pit-out flag) is not clean
    assert [deg[n]["strategy_stint_number"] for n in range(1, 8)] == [1, 1, 1, 2, 2, 3, 4]
    assert [deg[n]["lap_in_stint"] for n in range(1, 8)] == [1, 2, 3, 1, 2, 1, 1]
    assert deg[3]["rolling_three_lap_average"] == pytest.approx((91 + 92 + 93) / 3)
    assert deg[5]["delta_to_stint_best"] == pytest.approx(1.0)
    assert deg[1]["degradation_id"] == f"{S}-2-1-stint-1"


def test_results(models):
    rr = {r["driver_number"]: r for r in models.race_results.collect()}
    assert sorted(rr) == [1, 2]  # driver 3 has no laps, driver 4 no position
    assert rr[2]["result_status"] == "DSQ" and rr[2]["gap_to_leader_seconds"] is None
    assert rr[1]["gap_to_leader_seconds"] == 0.0
    assert rr[1]["season"] == 2025 and rr[1]["meeting_name"] == "Australian GP"


def test_dims_and_dashboard(models):
    assert [r["session_key"] for r in models.dim_sessions.collect()] == [S]
    assert sorted(r["driver_number"] for r in models.dim_drivers.collect()) == [1, 2]
    d = {r["lap_id"]: r for r in models.dashboard_laps.collect()}
    assert d[f"{S}-1-2"]["delta_to_driver_best"] == pytest.approx(2.0)
    assert d[f"{S}-2-1"]["delta_to_session_best"] == pytest.approx(81.0)
    assert d[f"{S}-1-1"]["team_colour_hex"] == "#FF8000"


def test_v_min(models):
    v = {(r["driver_number"], r["lap_number"]): r for r in models.corner_performance.collect()}
    # only samples with a known position qualify
    assert set(v) == {(1, 1), (1, 2)}
    assert v[(1, 1)]["lap_v_min"] == 80 and v[(1, 1)]["v_min_timestamp"] == ts(5)
