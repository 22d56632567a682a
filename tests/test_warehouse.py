"""Layout of the written tables, and a warehouse opened and refreshed."""

import glob
import json
import os

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from trackline.plans import repository
from trackline.plans.materialize import Lakehouse, lakehouse_for
from trackline.plans.models import GOLD, SILVER
from trackline.plans.warehouse import Warehouse, fingerprints
from trackline.sources import bronze
from trackline.sources.adapter import RACE_TABLES, race_tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_serving_one_race_opens_its_folder_alone(spark):
    m = lakehouse_for(spark, SF_SMALL).models
    first = m.dashboard_laps.orderBy("session_key", "driver_number", "lap_number").first()
    for df in (repository.telemetry(m, first["session_key"], first["driver_number"], first["lap_number"]),
               repository.laps(m, first["session_key"], [first["driver_number"]])):
        text = plan(df)
        assert "PartitionFilters: [isnotnull(session_key" in text and "(driver_number" in text.split("PushedFilters")[1]
        assert df.inputFiles() and df.count() > 0
    silver = m.enriched
    assert silver.schema["session_key"].dataType.simpleString() == "bigint"
    assert {os.path.basename(os.path.dirname(f)) for f in silver.inputFiles()} == {f"session_key={r[0]}" for r in silver.select("session_key").distinct().collect()}


def test_gold_files_hold_ranges_of_drivers(spark, tmp_path):
    from trackline.plans.materialize import write_table
    df = spark.range(20_000).select(F.lit(7).cast("bigint").alias("session_key"), (F.col("id") * 7919 % 100).alias("driver_number"), "id").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(df, str(tmp_path / "t"), ["session_key", "driver_number"], by_session=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = glob.glob(str(tmp_path / "t" / "session_key=7" / "*.parquet"))
    spans = sorted(tuple(spark.read.parquet(f).agg(F.min("driver_number"), F.max("driver_number")).first()) for f in files)
    assert len(files) > 4 and all(a[1] < b[0] or a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


class Feeds:
    """Feeds that a test can change."""

    def __init__(self, source):
        self.source, self.changes = source, {}

    def __getitem__(self, name):
        df = self.source[name]
        return self.changes[name](df) if name in self.changes else df


def same(a, b):
    assert a.columns == b.columns or sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b.select(*a.columns))


def test_refresh_builds_what_changed_and_open_writes_nothing(spark, tmp_path):
    source = Feeds(race_tables(spark, SF_SMALL))
    root = str(tmp_path / "wh")
    house = Warehouse(spark, source, root)
    with pytest.raises(FileNotFoundError):
        house.open()
    built = house.refresh()
    assert len(built) == 3
    written = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}

    # a second application: opens, finds nothing to do, writes nothing
    again = Warehouse(spark, Feeds(race_tables(spark, SF_SMALL)), root)
    assert again.refresh() == []
    models = again.open()
    plain = lakehouse_for(spark, SF_SMALL).models
    for attr in ("dashboard_laps", "tire_degradation", "race_results", "corner_performance"):
        same(getattr(plain, attr), getattr(models, attr))
    same(plain.stg_drivers, models.stg_drivers)
    assert written == {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}

    # one session's laps change: it alone is built, the others' files stay
    s = built[1]
    source.changes["laps_raw"] = lambda df: df.where(~((F.col("session_key") == s) & (F.col("lap_number") % 2 == 0)))
    assert house.refresh() == [s]
    assert {f: os.path.getmtime(f) for f in written} == written
    fresh = Lakehouse(spark, source, str(tmp_path / "fresh")).models
    opened = house.open()
    for attr in ("dashboard_laps", "tire_degradation"):
        same(getattr(fresh, attr), getattr(opened, attr))

    # a session leaves the feeds: nothing is built, and its rows are no longer served
    for name in RACE_TABLES:
        if name != "meetings_metadata":
            before = source.changes.get(name, lambda df: df)
            source.changes[name] = lambda df, f=before: f(df).where(F.col("session_key") != built[0])
    assert house.refresh() == []
    left = house.open().dashboard_laps
    assert left.where(F.col("session_key") == built[0]).count() == 0 and left.count() > 0


def test_fingerprints_follow_rows_not_their_order(spark):
    source = Feeds(race_tables(spark, SF_SMALL))
    one = rows(fingerprints(source))
    source.changes["telemetry_raw"] = lambda df: df.orderBy(F.col("speed").desc())
    assert rows(fingerprints(source)) == one
    source.changes["telemetry_raw"] = lambda df: df.unionAll(df.limit(1))
    assert len(set(rows(fingerprints(source))) ^ set(one)) == 2


def test_landed_files_are_listed_unread(spark, tmp_path):
    folder = tmp_path / "weather_raw" / "session_key=9"
    folder.mkdir(parents=True)
    (folder / "weather.json").write_text(json.dumps({"air_temperature": 20.5}) + "\nbroken")
    got = bronze.NdjsonBronze(spark, str(tmp_path)).files("weather_raw").collect()
    assert [(r["session_key"], r["length"]) for r in got] == [(9, os.path.getsize(folder / "weather.json"))]
    assert set(SILVER) and set(GOLD)
