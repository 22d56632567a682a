"""Track analyses on hand-made tracks and against plain Python."""

import datetime as dt
import math
import random

import pytest

from trackline.operators.geometry import nearest_mark, resample, with_corners
from trackline.operators.travel import METRE, between, crossings, legs
from trackline.plans import track

T0 = dt.datetime(2024, 5, 1, 12)
STRATEGIES = ("plain", "split")


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def square(side=100.0, n=20):
    """A square driven once, starting in the middle of its first side."""
    corners = [(0.5, 0), (1, 0), (1, 1), (0, 1), (0, 0), (0.5, 0)]
    out = []
    for (a, b), (c, d) in zip(corners, corners[1:], strict=False):
        out += [((a + (c - a) * k / n) * side, (b + (d - b) * k / n) * side) for k in range(n)]
    return [*out, (0.5 * side, 0.0)]


def line_frame(spark, points, line=1):
    return spark.createDataFrame([(line, i, float(x), float(y)) for i, (x, y) in enumerate(points)], "line long, i long, x double, y double")


def test_resample_spaces_marks_evenly(spark):
    marks = resample(line_frame(spark, square()), "line", ["i"], 80).orderBy("mark").collect()
    assert [m["mark"] for m in marks] == list(range(80)) and all(abs(m["step"] - 5) < 1e-9 for m in marks)
    for a, b in zip(marks, marks[1:], strict=False):
        assert abs(abs(b["x"] - a["x"]) + abs(b["y"] - a["y"]) - 5) < 1e-6


def test_resample_drops_lines_without_length(spark):
    still = line_frame(spark, [(1, 1)] * 5).unionByName(line_frame(spark, [(3, 3)], 2))
    assert resample(still, "line", ["i"], 10).count() == 0


def test_corners_of_a_square(spark):
    marks = with_corners(resample(line_frame(spark, square()), "line", ["i"], 80), "line", reach=3)
    got = {r["mark"]: r for r in marks.collect()}
    assert sorted(m for m, r in got.items() if r["is_corner"]) == [10, 30, 50, 70]
    assert all(abs(got[m]["turn"] - math.pi / 2) < 1e-6 for m in (10, 30, 50, 70))
    assert [got[m]["corner"] for m in (6, 7, 10, 13, 14, 28, 30, 47, 73, 74)] == [None, 1, 1, 1, None, 2, 2, 3, 4, None]


def test_between_two_corners_the_earlier_wins_a_tie(spark):
    zigzag = line_frame(spark, [(0, 0), (4, 0), (4, 4), (8, 4)])
    got = with_corners(resample(zigzag, "line", ["i"], 12), "line", reach=9).orderBy("mark").collect()
    assert [r["corner"] for r in got] == [1] * 7 + [2] * 5


def test_nearest_mark_against_all_marks(spark):
    rng = random.Random(4)
    lines = {k: [(rng.uniform(-50, 50), rng.uniform(-50, 50)) for _ in range(6)] for k in (1, 2)}
    marks = resample(line_frame(spark, lines[1]).unionByName(line_frame(spark, lines[2], 2)), "line", ["i"], 30)
    held = marks.collect()
    points = [(i, rng.choice([1, 2, 3, None]), rng.uniform(-70, 70), rng.uniform(-70, 70)) for i in range(800)]
    points += [(800 + k, r["line"], r["x"], r["y"]) for k, r in enumerate(held[:5])]
    df = spark.createDataFrame(points, "id long, line long, x double, y double")
    got = {r["id"]: r["mark"] for r in nearest_mark(df, marks, "line", ["step"]).collect()}
    want = {}
    for i, line, x, y in points:
        near = [((x - r["x"]) ** 2 + (y - r["y"]) ** 2, r["mark"]) for r in held if r["line"] == line]
        near = [n for n in near if n[0] <= max((2 * r["step"]) ** 2 for r in held if r["line"] == line)]
        if near:
            want[i] = min(near)[1]
    assert got == want and 100 < len(want) < 800


READINGS = "session_key long, driver_number long, date timestamp_ntz, speed long"


def drive(rng, n):
    rows = []
    for d in (1, 2, 3):
        t = rng.randint(0, 30)
        for _ in range(n):
            rows.append((9, d, at(t), rng.randint(0, 300)))
            t += rng.choice([1, 2, 5])
    rows += [(9, 1, rows[5][2], 1), (9, 1, None, 50), (9, 2, at(3), None), (9, 4, at(0), 100), (None, 1, at(0), 36), (None, 1, at(100), 36)]
    return rows


def positions_by_hand(rows):
    """driver -> [(t seconds, distance)] by trapezoids."""
    best = {}
    for s, d, t, v in rows:
        if t is not None and v is not None:
            key = (s, d, (t - T0).total_seconds())
            best[key] = max(v, best.get(key, v))
    out = {}
    for s, d, t in sorted(best, key=lambda k: (str(k[:2]), k[2])):
        path = out.setdefault((s, d), [])
        v = best[s, d, t]
        path.append((t, (path[-1][1] + (path[-1][2] + v) / 7.2 * (t - path[-1][0])) if path else 0.0, v))
    return out


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_legs_and_marks(spark, strategy):
    rows = drive(random.Random(7), 120)
    travel = legs(spark.createDataFrame(rows, READINGS), ["session_key", "driver_number"], "date", "speed", strategy)
    want = positions_by_hand(rows)
    got = {}
    for r in travel.collect():
        got.setdefault((r["session_key"], r["driver_number"]), []).append(((r["leg_start"] - T0).total_seconds(), r["start_d"] / METRE))
    for key, path in want.items():
        if len(path) > 1:
            for (t, d), (t2, d2, _) in zip(sorted(got[key]), path, strict=False):
                assert t == t2 and abs(d - d2) < 1e-6
    assert (9, 4) not in got
    for r in crossings(travel, ["session_key", "driver_number"], 500).collect():
        path, d = want[r["session_key"], r["driver_number"]], r["mark"] * 500
        i = max(k for k, p in enumerate(path) if p[1] <= d)
        t = path[i][0] + (d - path[i][1]) / (path[i + 1][1] - path[i][1]) * (path[i + 1][0] - path[i][0])
        assert abs(r["at_us"] / 1e6 - (t + T0.replace(tzinfo=dt.UTC).timestamp())) < 2e-6


def test_between_interpolates_on_both_sides(spark):
    rows = [(9, 1, at(0), 36), (9, 1, at(10), 36), (9, 1, at(30), 72)]
    travel = legs(spark.createDataFrame(rows, READINGS), ["session_key", "driver_number"], "date", "speed")
    asked = spark.createDataFrame([(i, 9, 1, at(t)) for i, t in enumerate((-1, 0, 5, 10, 20, 30))], "i long, session_key long, driver_number long, t timestamp_ntz")
    got = {r["i"]: r["d"] for r in between(asked, travel, ["session_key", "driver_number"], "t", "d").collect()}
    assert [None if got[i] is None else got[i] / METRE for i in range(6)] == [None, 0, 50, 100, 250, None]


def test_gaps_of_a_follower(spark):
    # the second car is 10 s behind the first all the way, at 36 km/h (10 m/s)
    rows = [(9, 1, at(t), 36) for t in range(0, 101, 10)] + [(9, 2, at(t + 10), 36) for t in range(0, 101, 10)]
    rows += [(9, 2, at(0), 0), (9, 2, at(5), 0)]
    got = track.track_gaps(spark.createDataFrame(rows, READINGS), 200).where("place = 2").orderBy("mark").collect()
    # standing still, then 5 s of speeding up from 0 to 36 km/h: 25 m on the way to the mark
    assert [(r["driver_number"], r["driver_ahead"]) for r in got] == [(2, 1)] * len(got) and len(got) >= 4
    assert all(abs(r["gap_seconds"] - 7.5) < 1e-5 and abs(r["gap_metres"] - 75) < 1e-3 for r in got[1:])


STYLE_ROWS = "session_key long, driver_number long, lap_number long, telemetry_timestamp timestamp_ntz, throttle long, brake long, n_gear long"


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_aggression(spark, strategy):
    calm = [(9, 1, lap, at(100 * lap + i), 50, 0, 5) for lap in (1, 2) for i in range(10)]
    wild = [(9, 2, lap, at(100 * lap + i), 100 * (i % 2), (i + 1) % 2, 4 + i % 3) for lap in (1, 2) for i in range(10)]
    odd = [(9, 3, None, at(0), 1, 1, 1), (9, 4, 1, None, 1, 1, 1), (9, 5, 1, at(1), None, None, None)]
    df = spark.createDataFrame(calm + wild + odd, STYLE_ROWS)
    got = {r["driver_number"]: r for r in track.driver_aggression(df, strategy).collect()}
    assert set(got) == {1, 2, 5}
    assert got[1]["brake_applications"] == got[1]["gear_shifts"] == 0 and got[1]["n_laps"] == 2
    # the state is carried over the lap's end: the second lap begins at brake on after off
    assert (got[2]["brake_applications"], got[2]["throttle_jumps"], got[2]["gear_shifts"]) == (10, 10, 18)
    assert got[2]["aggression"] > 0.7 > 0.5 > got[1]["aggression"]


POSITIONS = "session_key long, driver_number long, date timestamp_ntz, position long"


def race(rng, drivers=12):
    rows = []
    for d in range(drivers):
        for t in sorted(rng.sample(range(1000), 25)):
            rows.append((9, d, at(t), rng.randint(1, 6)))
    return rows + [(9, 0, None, 3), (9, 0, at(5), None), (9, 1, rows[30][2], rows[30][3] + 1)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_position_changes(spark, strategy):
    rows = race(random.Random(2))
    seen = {}
    for s, d, t, p in rows:
        if t is not None and p is not None:
            seen.setdefault(d, {})[t] = min(p, seen.get(d, {}).get(t, p))
    want = set()
    for d, path in seen.items():
        runs = []
        for t in sorted(path):
            if runs and runs[-1][0] == path[t]:
                runs[-1][2] += 1
            else:
                runs.append([path[t], t, 1])
        want |= {(9, d, p, t, nxt, n) for (p, t, n), nxt in zip(runs, [r[1] for r in runs[1:]] + [None], strict=True)}
    assert {tuple(r) for r in track.position_changes(spark.createDataFrame(rows, POSITIONS), strategy).collect()} == want


def test_overtakes_against_all_pairs(spark):
    rows = race(random.Random(3), 30)
    sessions = spark.createDataFrame([(9, at(0), at(1000)), (8, at(0), None)], "session_key long, session_start timestamp_ntz, session_end timestamp_ntz")
    df = spark.createDataFrame(rows, POSITIONS)

    def held(limit):
        out = {}
        for _, d, t, p in sorted((r for r in rows if r[2] is not None and r[3] is not None), key=lambda r: (r[2], -r[3])):
            if t <= at(limit):
                out[d] = p
        return out
    a, b = held(250), held(750)
    both = [d for d in a if d in b]
    want = {(9, d, a[d], b[d], sum(a[e] < a[d] and b[e] > b[d] for e in both), sum(a[e] > a[d] and b[e] < b[d] for e in both)) for d in both}
    assert {tuple(r) for r in track.overtakes(sessions, df).collect()} == want and len(want) > 10


def test_positions_at_lap(spark):
    laps = spark.createDataFrame([(9, 1, 1, at(0), 10.0, False), (9, 1, 2, at(10), 5.0, False), (9, 2, 1, None, None, False)],
                                 "session_key long, driver_number long, lap_number long, date_start timestamp_ntz, lap_duration double, is_pit_out_lap boolean")
    pos = spark.createDataFrame([(9, 1, at(0), 5), (9, 1, at(4), 4), (9, 1, at(10), 2), (9, 1, at(12), 3)], POSITIONS)
    got = {tuple(r) for r in track.positions_at_lap(laps, pos).collect()}
    assert got == {(9, 1, 1, 5, 2, 3), (9, 1, 2, 2, 3, -1)}
