"""Races land with every feed or not at all."""

import json

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from trackline.queries.races import race_lines
from trackline.sources.adapter import race_tables
from trackline.sources.races import RaceLanding
from trackline.sources.validate import InvalidBatch


@pytest.fixture(scope="module")
def feeds(spark):
    return race_lines(spark, SF_SMALL)


def _other(feeds, feed, change):
    return {**feeds, feed: change(feeds[feed])}


def test_all_races_land_and_read_back(spark, feeds, tmp_path):
    landing = RaceLanding(spark, str(tmp_path / "bronze"))
    assert landing.open()["laps_raw"].count() == 0 and landing.marks() == {}
    got = landing.land(feeds)
    assert got and set(got.values()) == {None}
    source = race_tables(spark, SF_SMALL)
    for table in ("telemetry_raw", "laps_raw", "session_results_raw", "driver_raw", "sessions_metadata", "position_raw"):
        want = source[table]
        if table in ("laps_raw",):   # missing lists of segments are empty ones
            want = want.select(*[F.coalesce(F.col(c), F.array().cast("array<double>")).alias(c) if c.startswith("segments") else F.col(c) for c in want.columns])
        assert rows(landing.open()[table].select(*want.columns)) == rows(want), table


def test_bad_record_in_the_last_feed_leaves_no_trace(spark, feeds, tmp_path):
    landing = RaceLanding(spark, str(tmp_path / "bronze"))
    races = sorted(landing.land(feeds))
    before = {t: rows(landing.open()[t]) for t in ("driver_raw", "session_results_raw", "meetings_metadata")}
    spoilt = _other(feeds, "session_result", lambda d: d.withColumn("value", F.when(
        F.get_json_object("value", "$.session_key") == str(races[0]), F.replace("value", F.lit('"points":'), F.lit('"points":"p",'
        '"was":'))).otherwise(F.col("value"))))
    # the other feeds change too: no changed row may show
    spoilt = _other(spoilt, "drivers", lambda d: d.withColumn("value", F.replace("value", F.lit('"full_name":"'), F.lit('"full_name":"X '))))
    with pytest.raises(InvalidBatch, match=f"session {races[0]}: invalid record in session_results_raw"):
        landing.land(spoilt)
    assert set(landing.marks().values()) == {1}
    assert {t: rows(landing.open()[t]) for t in before} == before
    # the refused records can be read until the next batch
    bad = landing.rejected(2)
    assert {(r["table"], r["session_key"]) for r in bad.collect()} == {("session_results_raw", races[0])}
    # race by race: the others are served from the new batch, this one as before
    got = landing.land(spoilt, mode="race")
    assert [s for s, why in got.items() if why] == [races[0]]
    assert landing.marks() == {s: 1 if s == races[0] else 2 for s in races}
    names = landing.open()["driver_raw"].select("session_key", F.col("full_name").startswith("X ").alias("new")).distinct()
    assert {tuple(r) for r in names.collect()} == {(s, s != races[0]) for s in races}
    assert rows(landing.open()["meetings_metadata"]) == before["meetings_metadata"]
    files = landing.open().files("driver_raw")
    assert {(r["session_key"], f"/batch={1 if r['session_key'] == races[0] else 2}/" in r["path"]) for r in files.collect()} == {(s, True) for s in races}


def test_records_of_no_race_and_missing_parts(spark, feeds, tmp_path):
    landing = RaceLanding(spark, str(tmp_path / "bronze"))
    line = lambda text: spark.createDataFrame([(text,)], "value string")
    small = {f: d.where("false") for f, d in feeds.items()}
    small["sessions"], small["meetings"] = feeds["sessions"], feeds["meetings"]
    races = sorted(int(json.loads(r[0])["session_key"]) for r in feeds["sessions"].collect())
    got = landing.land(small, mode="race")
    assert got == dict.fromkeys(races, "no drivers") and landing.marks() == {}
    for feed, text, why in (("weather", '{"session_key": 1', "invalid record of no race in weather_raw"),
                            ("drivers", None, "session 77 in driver_raw is not in the sessions feed")):
        if text is None:
            text = json.dumps(dict(json.loads(feeds["drivers"].first()[0]), session_key=77))
        with pytest.raises(InvalidBatch, match=why):
            landing.land({**small, feed: line(text)}, mode="race")
    small["drivers"] = feeds["drivers"]
    assert set(landing.land({**small, "meetings": small["meetings"].where("false")}, mode="race").values()) == {"no meeting"}
    with pytest.raises(ValueError, match="missing"):
        landing.land({"laps": feeds["laps"]})
    assert set(landing.land({f: d for f, d in small.items() if f != "position"}).values()) == {None}
    assert landing.open()["position_raw"].count() == 0 and landing.open()["driver_raw"].count() == feeds["drivers"].count()


def test_folders_of_other_races_are_not_opened(spark, feeds, tmp_path):
    landing = RaceLanding(spark, str(tmp_path / "bronze"))
    races = sorted(landing.land(feeds))
    one = landing.open()["telemetry_raw"].where(F.col("session_key") == races[0])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "accepted" in plan.split("PartitionFilters")[1]
    assert {f"session_key={races[0]}" in f and "accepted=true" in f for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {True}


def test_files_grow_with_the_races_and_not_with_their_drivers(spark, feeds, tmp_path):
    landing = RaceLanding(spark, str(tmp_path / "bronze"))
    races = landing.land(feeds)
    for table in ("laps_raw", "telemetry_raw", "position_raw"):
        drivers = landing.open()[table].select("session_key", "driver_number").distinct().count()
        assert len(races) <= landing.open().files(table).count() <= 2 * len(races) < drivers, table
