"""Every registered query against its DuckDB oracle (sf0.001), the entry
point, and the parameterised serving paths."""

import pytest
from conftest import SF_SMALL, rows
from oracle_compare import compare, duck

import __spark_entry__ as entry_mod
from trackline.plans import repository

QUERIES = {name: fn for name, fn in entry_mod.queries().items() if name in entry_mod.QUERIES}
ORACLES = {name: sql for name, sql in entry_mod.oracle_sql().items() if name in entry_mod.ORACLES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert "fastest_lap_rank" in df.columns and df.count() > 0


@pytest.fixture(scope="module")
def models(spark):
    from trackline.plans.materialize import lakehouse_for
    return lakehouse_for(spark, SF_SMALL).models


def test_parameterised_serving(spark, models):
    laps = models.dashboard_laps
    s, d1, d2 = laps.select("session_key", "driver_number").orderBy("session_key", "driver_number").first()[0], \
        *[r[0] for r in laps.select("driver_number").distinct().orderBy("driver_number").take(2)]
    got = repository.laps(models, s, [d1, d2])
    ref = laps.where(f"session_key = {s} AND driver_number IN ({d1}, {d2})")
    assert rows(got) == rows(ref)
    empty = repository.laps(models, s, [])
    assert empty.count() == 0 and empty.columns == laps.columns
    assert repository.race_results(models, s).where(f"session_key != {s}").count() == 0
    ordered = repository.sessions(models, ordered=True).collect()
    assert [r["session_start"] for r in ordered] == sorted((r["session_start"] for r in ordered), reverse=True)


def test_fastest_lap_telemetry_per_driver(spark, models):
    t = repository.fastest_lap_telemetry(models)
    per = t.groupBy("driver_number").agg({"lap_number": "count"}).count()
    assert per > 0
    s = models.dim_sessions.first()["session_key"]
    one = repository.fastest_lap_telemetry(models, s, [])
    assert one.count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_hygiene(spark, name):
    """No cartesian / nested-loop joins and no Python UDFs in any plan."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<double>": "DOUBLE[]"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
           for f in df.schema.fields}
    rel = con.sql(ORACLES[name])
    want = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert got == want
