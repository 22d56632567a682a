"""Data-quality checks (T1-T8) as Spark jobs.

Every check returns its failing rows (empty = pass).  The generic checks
(not_null, unique, relationships, accepted_values) are declared once in
``SCHEMA_TESTS`` and evaluated with one aggregate pass per table; the
singular checks are plain filters / grain aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.functions.scalar import RESULT_STATUSES, TIRE_COMPOUNDS

# Declared column tests per model (fixed values: the reference's schema
# tests).  relationships: (parent model, parent column); accepted: values.
SCHEMA_TESTS: dict[str, dict[str, dict]] = {
    "stg_drivers": {
        "driver_session_id": {"not_null": True, "unique": True},
        "session_key": {"not_null": True}, "driver_number": {"not_null": True},
        "full_name": {"not_null": True}, "team_colour_hex": {"not_null": True}},
    "stg_sessions": {
        "session_key": {"not_null": True, "unique": True},
        "meeting_key": {"not_null": True}, "session_start": {"not_null": True}},
    "stg_meetings": {
        "meeting_key": {"not_null": True, "unique": True},
        "meeting_name": {"not_null": True}, "circuit_short_name": {"not_null": True}},
    "dim_sessions": {
        "session_key": {"not_null": True, "unique": True}, "meeting_key": {"not_null": True},
        "meeting_name": {"not_null": True}, "circuit_short_name": {"not_null": True}},
    "dim_drivers": {
        "driver_session_id": {"not_null": True, "unique": True},
        "session_key": {"not_null": True, "relationships": ("dim_sessions", "session_key")},
        "driver_number": {"not_null": True}, "full_name": {"not_null": True},
        "team_colour_hex": {"not_null": True}},
    "fct_lap_leaderboard": {
        "session_key": {"not_null": True}, "driver_number": {"not_null": True},
        "lap_number": {"not_null": True}, "lap_duration": {"not_null": True},
        "is_pit_out_lap": {"not_null": True}},
    "fct_dashboard_laps": {
        "lap_id": {"not_null": True, "unique": True},
        "driver_session_id": {"not_null": True, "relationships": ("dim_drivers", "driver_session_id")},
        "session_key": {"not_null": True, "relationships": ("dim_sessions", "session_key")},
        "lap_duration": {"not_null": True},
        "tire_compound": {"not_null": True, "accepted_values": TIRE_COMPOUNDS},
        "team_colour_hex": {"not_null": True}},
    "fct_tire_degradation": {
        "degradation_id": {"not_null": True, "unique": True},
        "lap_id": {"not_null": True, "relationships": ("fct_dashboard_laps", "lap_id")},
        "strategy_stint_number": {"not_null": True}, "lap_in_stint": {"not_null": True},
        "tire_age_at_lap_end": {"not_null": True}, "lap_duration": {"not_null": True}},
    "fct_corner_performance": {
        "session_key": {"not_null": True}, "driver_number": {"not_null": True},
        "lap_number": {"not_null": True}, "lap_v_min": {"not_null": True},
        "v_min_timestamp": {"not_null": True}},
    "stg_session_results": {
        "result_id": {"not_null": True, "unique": True},
        "session_key": {"not_null": True}, "driver_number": {"not_null": True},
        "finishing_position": {"not_null": True},
        "result_status": {"not_null": True, "accepted_values": RESULT_STATUSES}},
    "fct_race_results": {
        "result_id": {"not_null": True, "unique": True},
        "session_key": {"not_null": True, "relationships": ("dim_sessions", "session_key")},
        "driver_number": {"not_null": True}, "full_name": {"not_null": True},
        "finishing_position": {"not_null": True}, "points": {"not_null": True},
        "result_status": {"not_null": True}},
}

MODEL_ATTR = {"stg_drivers": "stg_drivers", "stg_sessions": "stg_sessions", "stg_meetings": "stg_meetings",
              "stg_session_results": "stg_session_results", "dim_sessions": "dim_sessions",
              "dim_drivers": "dim_drivers", "fct_lap_leaderboard": "lap_leaderboard",
              "fct_dashboard_laps": "dashboard_laps", "fct_tire_degradation": "tire_degradation",
              "fct_corner_performance": "corner_performance", "fct_race_results": "race_results"}


def model_table(m, name: str) -> DataFrame:
    return getattr(m, MODEL_ATTR[name])


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# -- generic checks on one table ---------------------------------------------
def check_not_null(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """(table_name, column_name, failures) - one aggregate pass for all cols."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _nn{i}" for i, c in enumerate(cols))
    return agg.select(F.lit(table).alias("table_name"),
                      F.expr(f"stack({len(cols)}, {stack}) AS (column_name, failures)"))


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Non-null values occurring more than once (the failing rows)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def relationship_violations(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    p = parent.select(F.col(parent_col).alias(col)).where(F.col(col).isNotNull())
    return child.where(F.col(col).isNotNull()).join(p, col, "left_anti")


def accepted_value_violations(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the accepted list (NULL passes)."""
    return df.where(~F.col(col).isin(list(values))).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def _count(df: DataFrame, table: str, column: str, extra: dict | None = None) -> DataFrame:
    cols = [F.lit(table).alias("table_name"), F.lit(column).alias("column_name")]
    cols += [F.lit(v).alias(k) for k, v in (extra or {}).items()]
    return df.agg(F.count(F.lit(1)).alias("failures")).select(*cols, "failures")


# -- T1-T4 over all declared tests ---------------------------------------------
def dq_not_null(m) -> DataFrame:
    return _union([check_not_null(model_table(m, t), [c for c, s in spec.items() if s.get("not_null")], t)
                   for t, spec in SCHEMA_TESTS.items()])


def dq_unique(m) -> DataFrame:
    return _union([_count(unique_violations(model_table(m, t), c), t, c)
                   for t, spec in SCHEMA_TESTS.items() for c, s in spec.items() if s.get("unique")])


def dq_relationships(m) -> DataFrame:
    out = []
    for t, spec in SCHEMA_TESTS.items():
        for c, s in spec.items():
            if "relationships" in s:
                pt, pc = s["relationships"]
                v = relationship_violations(model_table(m, t), c, model_table(m, pt), pc)
                out.append(_count(v, t, c, {"parent_table": pt}))
    return _union(out)


def dq_accepted_values(m) -> DataFrame:
    return _union([_count(accepted_value_violations(model_table(m, t), c, s["accepted_values"]), t, c)
                   for t, spec in SCHEMA_TESTS.items() for c, s in spec.items() if "accepted_values" in s])


# -- T5-T8 singular checks --------------------------------------------------------
def dq_unique_grain(laps: DataFrame) -> DataFrame:
    """T5: lap keys that do not occur exactly once."""
    k = ["session_key", "driver_number", "lap_number"]
    return laps.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != 1).select(*k)


def dq_lap_metrics(laps: DataFrame) -> DataFrame:
    """Laps with a non-positive duration or a negative delta / speed."""
    return laps.where((F.col("lap_duration") <= 0) | (F.col("delta_to_session_best") < 0)
                      | (F.col("delta_to_driver_best") < 0) | (F.col("top_speed") < 0) | (F.col("v_min") < 0))


def dq_positions(results: DataFrame) -> DataFrame:
    """(race, position) pairs that repeat or are below 1."""
    k = ["session_key", "finishing_position"]
    return (results.groupBy(*k).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") != 1) | (F.col("finishing_position") < 1)).select(*k))


def dq_tire_metrics(deg: DataFrame) -> DataFrame:
    """Degradation rows with metrics out of range."""
    return deg.where((F.col("strategy_stint_number") < 1) | (F.col("lap_in_stint") < 1)
                     | (F.col("tire_age_at_lap_end") < 0) | (F.col("delta_to_stint_best") < 0)
                     | (F.col("rolling_three_lap_average") <= 0))


def column_checks(df: DataFrame, spec: dict[str, dict], table: str = "") -> DataFrame:
    """The not-null and uniqueness tests of one table in one pass over it:
    (table_name, check_name, column_name, failures).  Rows are grouped by the
    unique column, with the NULLs of the others counted on the way, so
    partial aggregation sees narrow rows only; a table without a unique
    column is one plain aggregate."""
    required = [c for c, s in spec.items() if s.get("not_null")]
    unique = [c for c, s in spec.items() if s.get("unique")]
    if len(unique) > 1:
        raise ValueError(f"{table}: one unique column a table is supported")
    rows = df.select(*dict.fromkeys([*required, *unique]))
    if unique:
        rows = rows.groupBy(unique[0]).agg(F.count(F.lit(1)).alias("_n"), *[
            F.count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(required)])
        found = [F.coalesce(F.sum(f"_nn{i}"), F.lit(0)) for i in range(len(required))]
        found.append(F.count_if(F.col(unique[0]).isNotNull() & (F.col("_n") > 1)))
    else:
        found = [F.count_if(F.col(c).isNull()) for c in required]
    tests = [("not_null", c) for c in required] + [("unique", c) for c in unique]
    agg = rows.agg(*[f.cast("bigint").alias(f"_f{i}") for i, f in enumerate(found)])
    stack = ", ".join(f"'{check}', '{c}', _f{i}" for i, (check, c) in enumerate(tests))
    return agg.select(F.lit(table).alias("table_name"), F.expr(f"stack({len(tests)}, {stack}) AS (check_name, column_name, failures)"))


def run_checks(m) -> DataFrame:
    """Every check as (table_name, check_name, column_name, failures); the
    not-null and uniqueness tests of a table share one pass over it."""
    def tag(df: DataFrame, check: str) -> DataFrame:
        return df.select("table_name", F.lit(check).alias("check_name"), "column_name",
                         F.col("failures").cast("bigint").alias("failures"))

    def singular(df: DataFrame, table: str, check: str) -> DataFrame:
        return tag(_count(df, table, ""), check)

    return _union([
        *[column_checks(model_table(m, t), spec, t) for t, spec in SCHEMA_TESTS.items()],
        tag(dq_relationships(m).drop("parent_table"), "relationships"),
        tag(dq_accepted_values(m), "accepted_values"),
        singular(dq_unique_grain(m.dashboard_laps), "fct_dashboard_laps", "lap_grain"),
        singular(dq_lap_metrics(m.dashboard_laps), "fct_dashboard_laps", "lap_metrics"),
        singular(dq_positions(m.race_results), "fct_race_results", "result_positions"),
        singular(dq_tire_metrics(m.tire_degradation), "fct_tire_degradation", "degradation_metrics"),
    ])
