"""Queries of the analyses on the track (corners, gaps, style, race order)
and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackline.plans import track
from trackline.queries.oracle_ctes import cte
from trackline.queries.registry import _lh, _m, query

# distance between gap marks: the test data's readings are hours apart
MARK_METRES = 500_000
MARKS, MIN_POINTS, REACH = 40, 4, 2

# -- corners -------------------------------------------------------------------
cte("circuit_points", """
SELECT m.circuit_key, e.* FROM enriched e JOIN stg_sessions s ON s.session_key = e.session_key JOIN stg_meetings m ON m.meeting_key = s.meeting_key
WHERE e.lap_number IS NOT NULL AND e.speed IS NOT NULL AND e.x IS NOT NULL AND e.y IS NOT NULL AND m.circuit_key IS NOT NULL""")
cte("line_readings", """
SELECT DISTINCT circuit_key, session_key, driver_number, lap_number, lap_duration, telemetry_timestamp, x, y
FROM circuit_points WHERE lap_duration > 0 AND is_pit_out_lap IS NOT TRUE""")
cte("line_laps", f"""
SELECT circuit_key, session_key, driver_number, lap_number FROM
 (SELECT *, row_number() OVER (PARTITION BY circuit_key ORDER BY lap_duration, session_key, driver_number, lap_number) AS nth
  FROM (SELECT circuit_key, session_key, driver_number, lap_number, lap_duration, count(*) AS n FROM line_readings GROUP BY ALL) g WHERE n >= {MIN_POINTS}) r
WHERE nth = 1""")
cte("line_legs", """
SELECT *, CAST(sum(len) OVER (PARTITION BY circuit_key ORDER BY i) - len AS BIGINT) AS done, CAST(sum(len) OVER (PARTITION BY circuit_key) AS BIGINT) AS total
FROM (SELECT a.circuit_key, a.i, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1,
             CAST(floor(sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) * 1000 + 0.5) AS BIGINT) AS len
      FROM line_points a JOIN line_points b ON a.circuit_key = b.circuit_key AND b.i = a.i + 1) g""")
cte("line_points", """
SELECT r.circuit_key, r.x, r.y, row_number() OVER (PARTITION BY r.circuit_key ORDER BY r.telemetry_timestamp, r.x, r.y) AS i
FROM line_readings r JOIN line_laps l USING (circuit_key, session_key, driver_number, lap_number)""")
cte("line_marks", f"""
SELECT circuit_key, mark, x0 + (x1 - x0) * part AS x, y0 + (y1 - y0) * part AS y, total / {MARKS * 1000}.0::DOUBLE AS step
FROM (SELECT l.*, m.mark, (m.mark * total - done * {MARKS}) / CAST(len * {MARKS} AS DOUBLE) AS part
      FROM line_legs l, range({MARKS}) m(mark) WHERE len > 0 AND done * {MARKS} <= m.mark * total AND m.mark * total < (done + len) * {MARKS}) g""")
cte("line_turns", """
SELECT m.*, abs(atan2((m.x - p.x) * (n.y - m.y) - (m.y - p.y) * (n.x - m.x), (m.x - p.x) * (n.x - m.x) + (m.y - p.y) * (n.y - m.y))) AS turn
FROM line_marks m LEFT JOIN line_marks p ON p.circuit_key = m.circuit_key AND p.mark = m.mark - 1
LEFT JOIN line_marks n ON n.circuit_key = m.circuit_key AND n.mark = m.mark + 1""")
cte("line_corners", """
SELECT m.*, row_number() OVER (PARTITION BY m.circuit_key ORDER BY m.mark) AS corner
FROM line_turns m LEFT JOIN line_turns p ON p.circuit_key = m.circuit_key AND p.mark = m.mark - 1
LEFT JOIN line_turns n ON n.circuit_key = m.circuit_key AND n.mark = m.mark + 1
WHERE m.turn >= pi() / 6 AND m.turn > coalesce(p.turn, -1) AND m.turn >= coalesce(n.turn, -1)""")
cte("line_stretches", f"""
SELECT m.circuit_key, m.mark, m.x, m.y, m.step,
       (SELECT min({{'d': abs(c.mark - m.mark), 'at': c.mark, 'no': c.corner}}) FROM line_corners c
        WHERE c.circuit_key = m.circuit_key AND abs(c.mark - m.mark) <= {REACH}).no AS corner
FROM line_marks m""")
cte("corner_samples", """
SELECT s.*, (SELECT min({'d': (s.x - m.x) * (s.x - m.x) + (s.y - m.y) * (s.y - m.y), 'mark': m.mark, 'corner': coalesce(m.corner, 0)})
             FROM line_stretches m WHERE m.circuit_key = s.circuit_key
               AND (s.x - m.x) * (s.x - m.x) + (s.y - m.y) * (s.y - m.y) <= (2 * m.step) * (2 * m.step)) AS near
FROM circuit_points s""")
cte("corner_best", """
SELECT circuit_key, session_key, driver_number, lap_number, near.corner AS corner, min({'v': speed, 't': telemetry_timestamp}) AS least, count(*) AS n
FROM corner_samples WHERE near.corner > 0 GROUP BY ALL""")

_CORNERS = """
SELECT b.circuit_key, b.session_key, b.driver_number, b.lap_number, b.corner AS corner_number, c.mark AS corner_mark, round(c.x, 6) AS corner_x,
       round(c.y, 6) AS corner_y, round(degrees(c.turn), 6) AS corner_angle, b.n AS n_samples, b.least.v AS corner_v_min, b.least.t AS v_min_timestamp
FROM corner_best b JOIN line_corners c ON c.circuit_key = b.circuit_key AND c.corner = b.corner"""


@query("corner_v_min", _CORNERS)
def q_corner_v_min(spark, sf_dir):
    m = _m(spark, sf_dir)
    return track.corner_v_min(m.enriched, m.stg_sessions, m.stg_meetings, marks=MARKS, min_points=MIN_POINTS, reach=REACH)


@query("circuit_lines", """
SELECT s.circuit_key, s.mark, round(s.x, 6) AS x, round(s.y, 6) AS y, round(t.turn, 6) AS turn, s.corner
FROM line_stretches s JOIN line_turns t USING (circuit_key, mark)""")
def q_circuit_lines(spark, sf_dir):
    m = _m(spark, sf_dir)
    points = track.located(m.enriched, track.session_circuits(m.stg_sessions, m.stg_meetings))
    marks = track.circuit_marks(points, MARKS, MIN_POINTS, reach=REACH)
    return marks.select("circuit_key", "mark", *[F.round(c, 6).alias(c) for c in ("x", "y", "turn")], "corner")


# -- gaps ----------------------------------------------------------------------
_STEP = MARK_METRES * 7_200_000
cte("speed_legs", """
SELECT *, CAST(sum(length) OVER (PARTITION BY session_key, driver_number ORDER BY start_us) - length AS BIGINT) AS start_d
FROM (SELECT session_key, driver_number, start_us, end_us, CAST((v + next_v) * (end_us - start_us) AS BIGINT) AS length
      FROM (SELECT *, lead(start_us) OVER w AS end_us, lead(v) OVER w AS next_v
            FROM (SELECT session_key, driver_number, epoch_us(date) AS start_us, max(speed) AS v FROM telemetry_raw
                  WHERE date IS NOT NULL AND speed IS NOT NULL GROUP BY ALL) r
            WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY start_us)) n
      WHERE end_us IS NOT NULL) g""")
cte("mark_times", f"""
SELECT session_key, driver_number, mark, start_us + CAST(floor((mark * {_STEP} - start_d) / CAST(length AS DOUBLE) * (end_us - start_us)) AS BIGINT) AS at_us
FROM (SELECT *, unnest(range(greatest(1, (start_d + {_STEP - 1}) // {_STEP}), (start_d + length + {_STEP - 1}) // {_STEP})) AS mark FROM speed_legs) g""")
cte("mark_order", """
SELECT *, row_number() OVER w AS place, lag(driver_number) OVER w AS driver_ahead, lag(at_us) OVER w AS ahead_us
FROM mark_times WINDOW w AS (PARTITION BY session_key, mark ORDER BY at_us, driver_number)""")


@query("gap_on_track", f"""
SELECT o.session_key, o.mark, o.place, o.driver_number, o.driver_ahead, make_timestamp(o.at_us) AS passed_at, (o.at_us - o.ahead_us) / 1e6 AS gap_seconds,
       (o.mark * {_STEP} - (l.start_d + CAST(floor((o.ahead_us - l.start_us) / CAST(l.end_us - l.start_us AS DOUBLE) * l.length) AS BIGINT))) / 7200000.0::DOUBLE AS gap_metres
FROM mark_order o LEFT JOIN speed_legs l
  ON l.session_key = o.session_key AND l.driver_number = o.driver_number AND l.start_us <= o.ahead_us AND o.ahead_us < l.end_us""")
def q_gap_on_track(spark, sf_dir):
    return track.track_gaps(_lh(spark, sf_dir)["telemetry_raw"], MARK_METRES, strategy="split")


# -- driving style -------------------------------------------------------------
cte("style_laps", """
SELECT session_key, driver_number, lap_number, count(*) AS n, count(*) FILTER (brake > 0 AND coalesce(was_brake, 0) <= 0) AS r0,
       count(*) FILTER (throttle - was_throttle >= 40) AS r1, count(*) FILTER (n_gear <> was_gear) AS r2,
       histogram(least(throttle // 20, 4)) AS bands
FROM (SELECT *, lag(brake) OVER w AS was_brake, lag(throttle) OVER w AS was_throttle, lag(n_gear) OVER w AS was_gear
      FROM (SELECT session_key, driver_number, lap_number, telemetry_timestamp, max(throttle) AS throttle, max(brake) AS brake, max(n_gear) AS n_gear
            FROM tl WHERE lap_number IS NOT NULL AND telemetry_timestamp IS NOT NULL GROUP BY ALL) s
      WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY telemetry_timestamp, lap_number)) g
GROUP BY ALL""")
cte("style_rates", """
SELECT session_key, driver_number, lap_number, unnest([0, 1, 2]) AS rate, unnest([least(100 * r0 // (5 * n), 20), least(100 * r1 // (5 * n), 20), least(100 * r2 // (5 * n), 20)]) AS bin
FROM style_laps""")
cte("style_ranks", """
SELECT a.session_key, a.driver_number, a.rate, a.lap_number, 2 * count(*) FILTER (b.bin < a.bin) + count(*) FILTER (b.bin = a.bin) AS p, 2 * count(*) AS q
FROM style_rates a JOIN style_rates b ON a.session_key = b.session_key AND a.rate = b.rate GROUP BY ALL""")
_BANDS = " + ".join(f"abs(CAST(d.b{k} AS DOUBLE) / CAST(d.n AS DOUBLE) - CAST(f.b{k} AS DOUBLE) / CAST(f.n AS DOUBLE))" for k in range(5))
cte("style_drivers", "SELECT session_key, driver_number, count(*) AS n_laps, sum(n) AS n, sum(r0) AS r0, sum(r1) AS r1, sum(r2) AS r2, "
    + ", ".join(f"sum(coalesce(bands[{k}], 0)) AS b{k}" for k in range(5)) + " FROM style_laps GROUP BY ALL")
cte("style_field", "SELECT session_key, sum(n) AS n, " + ", ".join(f"sum(b{k}) AS b{k}" for k in range(5)) + " FROM style_drivers GROUP BY session_key")


@query("driver_aggression", f"""
SELECT d.session_key, d.driver_number, d.n_laps, CAST(d.n AS BIGINT) AS n_samples, CAST(d.r0 AS BIGINT) AS brake_applications, CAST(d.r1 AS BIGINT) AS throttle_jumps,
       CAST(d.r2 AS BIGINT) AS gear_shifts, round((0.0::DOUBLE + {_BANDS}) / 2, 6) AS throttle_difference, round(CAST(s.p AS DOUBLE) / CAST(s.q AS DOUBLE), 6) AS aggression
FROM style_drivers d JOIN style_field f ON f.session_key = d.session_key
JOIN (SELECT session_key, driver_number, sum(p) AS p, sum(q) AS q FROM style_ranks GROUP BY ALL) s ON s.session_key = d.session_key AND s.driver_number = d.driver_number""")
def q_driver_aggression(spark, sf_dir):
    return track.driver_aggression(_m(spark, sf_dir).telemetry_laps, strategy="split")


# -- race order ----------------------------------------------------------------
cte("position_raw", """
SELECT session_key, user_id AS driver_number, ts AS date, 1 + (CAST(floor(event_id / 64.0) AS BIGINT) + user_id) % 20 AS position
FROM ev WHERE event_type = 'view' AND event_id % 3 = 0""")
cte("position_seen", """
SELECT session_key, driver_number, date, min(position) AS position FROM position_raw WHERE date IS NOT NULL AND position IS NOT NULL GROUP BY ALL""")
cte("position_runs", """
SELECT session_key, driver_number, position, min(date) AS valid_from, count(*) AS n_readings
FROM (SELECT *, row_number() OVER (PARTITION BY session_key, driver_number ORDER BY date)
             - row_number() OVER (PARTITION BY session_key, driver_number, position ORDER BY date) AS island FROM position_seen) g
GROUP BY session_key, driver_number, position, island""")


@query("position_intervals", """
SELECT session_key, driver_number, position, valid_from,
       lead(valid_from) OVER (PARTITION BY session_key, driver_number ORDER BY valid_from) AS valid_to, n_readings FROM position_runs""")
def q_position_intervals(spark, sf_dir):
    return track.position_changes(_lh(spark, sf_dir)["position_raw"], strategy="split")


@query("positions_at_lap", """
SELECT b.session_key, b.driver_number, b.lap_number, s.position AS position_at_start, e.position AS position_at_end, s.position - e.position AS places_gained
FROM bounds b
ASOF LEFT JOIN position_seen s ON s.session_key = b.session_key AND s.driver_number = b.driver_number AND s.date <= b.lap_start
ASOF LEFT JOIN position_seen e ON e.session_key = b.session_key AND e.driver_number = b.driver_number AND e.date <= b.lap_end
WHERE b.lap_start IS NOT NULL OR b.lap_end IS NOT NULL""")
def q_positions_at_lap(spark, sf_dir):
    lh = _lh(spark, sf_dir)
    return track.positions_at_lap(lh["laps_raw"], lh["position_raw"])


cte("two_instants", """
SELECT session_key, make_timestamp(epoch_us(session_start) + CAST(floor((epoch_us(session_end) - epoch_us(session_start)) * 0.25::DOUBLE) AS BIGINT)) AS t1,
       make_timestamp(epoch_us(session_start) + CAST(floor((epoch_us(session_end) - epoch_us(session_start)) * 0.75::DOUBLE) AS BIGINT)) AS t2 FROM stg_sessions""")
cte("two_positions", """
SELECT i.session_key, p.driver_number, arg_max(p.position, p.date) FILTER (p.date <= i.t1) AS position_1, arg_max(p.position, p.date) FILTER (p.date <= i.t2) AS position_2
FROM two_instants i JOIN position_seen p ON p.session_key = i.session_key GROUP BY ALL""")


@query("overtakes", """
SELECT a.session_key, a.driver_number, a.position_1, a.position_2, count(*) FILTER (b.position_1 < a.position_1 AND b.position_2 > a.position_2) AS made,
       count(*) FILTER (b.position_1 > a.position_1 AND b.position_2 < a.position_2) AS suffered
FROM two_positions a JOIN two_positions b ON a.session_key = b.session_key AND b.position_1 IS NOT NULL AND b.position_2 IS NOT NULL
WHERE a.position_1 IS NOT NULL AND a.position_2 IS NOT NULL GROUP BY ALL""")
def q_overtakes(spark, sf_dir):
    m = _m(spark, sf_dir)
    return track.overtakes(m.stg_sessions, _lh(spark, sf_dir)["position_raw"])
