"""Ingest: validation and coercion, NDJSON bronze scan/sink, season
discovery, incremental landing (the reference's ingest tests as Spark)."""

import json
import os

import pytest
from conftest import rows

from pyspark.sql import functions as F
from trackline.sources import bronze, season
from trackline.sources.schemas import FEED_SPECS
from trackline.sources.validate import InvalidBatch, require_valid, split, validate

CAR = {"date": "2025-03-16T04:00:00Z", "session_key": 9693, "meeting_key": 1254, "driver_number": 4,
       "speed": 301, "rpm": 12000, "n_gear": 8, "throttle": 100, "brake": 0, "drs": 12}


def lines(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def test_valid_car_sample(spark):
    good, bad = split(validate(lines(spark, [CAR]), FEED_SPECS["car_data"]))
    assert bad.count() == 0
    r = good.first()
    assert (r["speed"], r["driver_number"], str(r["date"])) == (301, 4, "2025-03-16 04:00:00")


def test_invalid_record_rejects_batch(spark):
    v = validate(lines(spark, [CAR, {"speed": 301}]), FEED_SPECS["car_data"])
    with pytest.raises(InvalidBatch):
        require_valid(v, "fail")
    good, bad = require_valid(v, "quarantine")
    assert good.count() == 1 and bad.count() == 1
    assert "date: field required" in bad.first()["_errors"]


def test_int_coercion(spark):
    # a boolean is a whole number to the validation classes
    recs = [dict(CAR, speed=v) for v in (301.0, "302", True, 301.5, "fast", "12d", 1e30, [1])]
    v = validate(lines(spark, recs), FEED_SPECS["car_data"]).collect()
    assert [r["speed"] for r in v[:3]] == [301, 302, 1]
    assert all(r["_errors"] == ["speed: invalid int"] for r in v[3:])


VALUES = [True, False, 0, 1, 2, -3, 1.0, 1.5, 0.0, 1e300, 9007199254740993, "12", " 12 ", "+5", "-7", "1_000", "12.0", "12.5", "12d", "1e3", "0x10", "", "x",
          "inf", "nan", "-Infinity", ".5", "5.", "1e-3", " 2.5 ", "true", "TRUE", "Yes", "on", "T", "y", "1", "0", "off", "N", " true", "1.0", [1], {"a": 1}, "1__0",
          "2025-03-16T04:00:00Z", "2025-03-16 04:00:00", "2025-03-16T04:00", "2025-03-16", "10:00", "2025-03-16T04:00:00+02:00",
          "2025-03-16T04:00:00.123456789Z", "2025-03-16T04:00:00.5", "2025-03-16t04:00:00z", "2025-03-16T04:00:00+0200", "2025-03-16T04",
          "2025-03-16T24:00:00", "2025-03-16T04:00:60", "20250316T040000", "2025-3-16", "1742097600", "1742097600.5", "1742097600000", 1742097600,
          1742097600.25, 1742097600000, -5, 20000000000, 20000000001, "2025-02-30", "2025-03-16T04:00:00-02", " 2025-03-16T04:00:00", "2025-03-16T04:00:00,5"]


@pytest.mark.parametrize("kind", ["int", "float", "bool", "str", "ts"])
def test_coercion_against_the_validation_package(spark, kind):
    pydantic = pytest.importorskip("pydantic")
    from datetime import UTC, datetime
    adapter = pydantic.TypeAdapter({"int": int, "float": float, "bool": bool, "str": str, "ts": datetime}[kind])
    want = []
    for value in VALUES:
        try:
            got = adapter.validate_python(value)
            if isinstance(got, datetime):
                got = (got.astimezone(UTC) if got.tzinfo else got).replace(tzinfo=None)
            want.append(str(got))
        except pydantic.ValidationError:
            want.append(None)
    v = validate(lines(spark, [{"f": x} for x in VALUES]), {"f": (kind, True)}).collect()
    assert [None if r["_errors"] else str(r["f"]) for r in v] == want
    assert all(r["_errors"] in ([], [f"f: invalid {kind}"]) for r in v)


def test_nulls_absent_fields_and_broken_lines(spark):
    spec = {"a": ("int", True), "b": ("float", False), "c": ("float_list", False)}
    text = ['{"a":null}', '{"b":1}', '{"a":1,"b":null,"c":null}', '{"a":1,"c":[1,null,"2.5",true]}', '{"a":1,"c":[1,"x"]}', '{"a":1,"c":5}',
            '{"a":1', '{"a":1} {"a":2}', '[1]', '5', "", None, '{"a":1}] x', '{"a":1,"a":2}']
    v = validate(spark.createDataFrame([(t,) for t in text], "value string"), spec).collect()
    broken = ["line: not a JSON object"]
    assert [r["_errors"] for r in v] == [["a: invalid int"], ["a: field required"], [], [], ["c: invalid float_list"], ["c: invalid float_list"], *[broken] * 8]
    assert [r["c"] for r in v[2:4]] == [[], [1.0, 2.5, 1.0]]


def test_unknown_fields(spark):
    text = spark.createDataFrame([('{"a":1,"z":2,"y y":3}',), ('{"a":1}',)], "value string")
    spec = {"a": ("int", True)}
    assert [r["_errors"] for r in validate(text, spec).collect()] == [[], []]
    assert [r["_errors"] for r in validate(text, spec, strict=True).collect()] == [["y y: unexpected field", "z: unexpected field"], []]


def test_strict_table_fails_the_read(spark, tmp_path):
    rec = {"meeting_key": 1, "driver_number": 4, "points": 25, "dnf": False, "dns": False, "dsq": False, "gap_to_leader": "+1 LAP"}
    folder = tmp_path / "session_results_raw" / "session_key=9"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps(rec) + "\n")
    source = bronze.NdjsonBronze(spark, str(tmp_path))
    r = source["session_results_raw"].first()
    assert (r["session_key"], r["driver_number"], r["points"], r["gap_to_leader"], r["position"], r["dnf"]) == (9, 4, 25.0, "+1 LAP", None, False)
    (folder / "b.json").write_text(json.dumps(dict(rec, surprise=1)) + "\n")
    with pytest.raises(Exception, match="unexpected fields surprise"):
        source["session_results_raw"].collect()
    with pytest.raises(Exception, match="unexpected fields surprise"):
        source["session_results_raw"].count()
    (folder / "b.json").write_text('{"points": 2')
    with pytest.raises(Exception, match="(?i)malformed"):
        source["session_results_raw"].collect()


def test_lap_segments_and_optional_start(spark):
    lap = {"session_key": 9693, "meeting_key": 1254, "driver_number": 4, "lap_number": 1, "date_start": None,
           "is_pit_out_lap": False, "segments_sector_1": [1.0, None, 2.0], "segments_sector_2": None}
    good, bad = split(validate(lines(spark, [lap]), FEED_SPECS["laps"]))
    assert bad.count() == 0
    r = good.first()
    assert (r["segments_sector_1"], r["segments_sector_2"], r["segments_sector_3"], r["date_start"]) == \
        ([1.0, 2.0], [], [], None)


def test_gap_to_leader_text(spark):
    base = {"session_key": 9693, "meeting_key": 1254, "driver_number": 4, "points": 25, "dnf": False,
            "dns": False, "dsq": False}
    recs = [dict(base, position=1, gap_to_leader=0), dict(base, gap_to_leader="+1 LAP"),
            dict(base, gap_to_leader=12.5),
            dict(base, position=None, number_of_laps=None, duration=None, gap_to_leader=None, dns=True)]
    good, bad = split(validate(lines(spark, recs), FEED_SPECS["session_result"]))
    assert bad.count() == 0
    assert [r["gap_to_leader"] for r in good.collect()] == ["0", "+1 LAP", "12.5", None]


def test_bronze_roundtrip_partitions(spark, tmp_path):
    root = str(tmp_path / "bronze")
    good, _ = split(validate(lines(spark, [CAR, dict(CAR, driver_number=1, speed=290)]), FEED_SPECS["car_data"]))
    assert bronze.write_bronze(good, root, "telemetry_raw") is True
    assert os.path.isdir(os.path.join(root, "telemetry_raw", "session_key=9693", "driver_number=4"))
    back = bronze.read_bronze(spark, root, "telemetry_raw")
    assert sorted((r["driver_number"], r["speed"]) for r in back.collect()) == [(1, 290), (4, 301)]
    # dynamic overwrite: re-landing driver 4 replaces only its partition
    again, _ = split(validate(lines(spark, [dict(CAR, speed=305)]), FEED_SPECS["car_data"]))
    bronze.write_bronze(again, root, "telemetry_raw")
    back = bronze.read_bronze(spark, root, "telemetry_raw")
    assert sorted((r["driver_number"], r["speed"]) for r in back.collect()) == [(1, 290), (4, 305)]
    # partition pruning reaches the scan
    plan = back.where("driver_number = 4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "driver_number" in plan


def test_empty_batch_not_written(spark, tmp_path):
    empty = spark.createDataFrame([], "date timestamp_ntz, speed long, session_key long, driver_number long")
    assert bronze.write_bronze(empty, str(tmp_path), "telemetry_raw") is False
    assert not os.path.exists(os.path.join(str(tmp_path), "telemetry_raw"))


def test_strict_results_table(spark, tmp_path):
    root = tmp_path / "b" / "session_results_raw"
    root.mkdir(parents=True)
    rec = {"session_key": 1, "meeting_key": 2, "driver_number": 3, "points": 1.0, "dnf": False, "dns": False,
           "dsq": False}
    (root / "part.json").write_text(json.dumps(rec) + "\n" + json.dumps(dict(rec, surprise=1)) + "\n")
    df, extra = bronze.read_strict(spark, str(tmp_path / "b"), "session_results_raw")
    assert df.count() == 2 and extra.count() == 1


def _calendar(spark, years):
    meetings = spark.createDataFrame([(1254, 2025), (1255, 2025)], "meeting_key long, year long")
    sessions = spark.createDataFrame([(9694, "Race", 1254, years[0]), (9693, "Race", 1255, years[1]),
                                      (9694, "Race", 1254, years[0]), (9000, "Qualifying", 1254, 2025)],
                                     "session_key long, session_type string, meeting_key long, year long")
    return meetings, sessions


def test_season_discovery(spark):
    m, s = _calendar(spark, [2025, 2025])
    got = [r[0] for r in season.discover_sessions(m, s, [2025]).orderBy("session_key").collect()]
    assert got == [9693, 9694]


def test_season_discovery_guards(spark):
    m, s = _calendar(spark, [2025, 2024])
    with pytest.raises(season.DiscoveryError):
        season.discover_sessions(m, s, [2025])
    with pytest.raises(season.DiscoveryError):
        season.discover_sessions(m, s, [2017])
    with pytest.raises(season.DiscoveryError):
        season.discover_sessions(m, s, [2023])


def test_ingest_summary_requires_drivers(spark):
    d = spark.createDataFrame([(1, 4), (1, 1)], "session_key long, driver_number long")
    s = spark.createDataFrame([(1,), (2,)], "session_key long")
    assert rows(season.ingest_summary(d)) == [(1, 2)]
    with pytest.raises(season.DiscoveryError):
        season.ingest_summary(d, s)


def test_streaming_landing(spark, tmp_path):
    from trackline.streaming import land_feed

    landing = tmp_path / "landing"
    (landing / "session_key=9693" / "driver_number=4").mkdir(parents=True)
    (landing / "session_key=9693" / "driver_number=4" / "car_data.json").write_text(
        "\n".join(json.dumps(dict(CAR, speed=300 + i)) for i in range(3)))
    q = land_feed(spark, str(landing), "car_data", str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    back = bronze.read_bronze(spark, str(tmp_path / "bronze"), "telemetry_raw")
    assert sorted(r["speed"] for r in back.collect()) == [300, 301, 302]
    # a second run finds no new file and leaves the table as it is
    q = land_feed(spark, str(landing), "car_data", str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert bronze.read_bronze(spark, str(tmp_path / "bronze"), "telemetry_raw").count() == 3
    # a second file of the same partition adds to the first one's rows
    (landing / "session_key=9693" / "driver_number=4" / "late").mkdir()
    (landing / "session_key=9693" / "driver_number=4" / "late" / "car_data.json").write_text(json.dumps(dict(CAR, speed=100)))
    land_feed(spark, str(landing), "car_data", str(tmp_path / "bronze"), str(tmp_path / "ckpt")).awaitTermination(120)
    back = bronze.read_bronze(spark, str(tmp_path / "bronze"), "telemetry_raw")
    assert sorted(r["speed"] for r in back.collect()) == [100, 300, 301, 302]


def test_results_of_two_races_are_both_kept(spark, tmp_path):
    from trackline.sources.schemas import BRONZE_SCHEMAS

    schema = BRONZE_SCHEMAS["session_results_raw"]
    for key in (1, 2, 2):
        race = spark.range(1).select(*[(F.lit(key) if f.name == "session_key" else F.lit(None)).cast(f.dataType).alias(f.name)
                                       for f in schema.fields])
        bronze.write_bronze(race, str(tmp_path), "session_results_raw")
    back = bronze.read_bronze(spark, str(tmp_path), "session_results_raw")
    assert sorted(r["session_key"] for r in back.collect()) == [1, 2]


def test_out_of_range_int_is_invalid(spark):
    v = validate(lines(spark, [dict(CAR, speed=1e30)]), FEED_SPECS["car_data"]).first()
    assert v["speed"] is None and v["_errors"] == ["speed: invalid int"]


def test_bronze_schema_contract():
    from trackline.sources.schemas import BRONZE_SCHEMAS, FEED_FILES, PARTITIONS

    # the eleven landed tables and the position feed
    assert len(BRONZE_SCHEMAS) == 12 and set(PARTITIONS) == set(BRONZE_SCHEMAS)
    assert {t for _, t in FEED_FILES.values()} == set(BRONZE_SCHEMAS)
    laps = {f.name: f for f in BRONZE_SCHEMAS["laps_raw"].fields}
    results = {f.name: f for f in BRONZE_SCHEMAS["session_results_raw"].fields}
    assert laps["date_start"].nullable and results["number_of_laps"].nullable
    assert not any(results[c].nullable for c in ("session_key", "meeting_key", "driver_number", "points",
                                                  "dnf", "dns", "dsq"))
    for schema in BRONZE_SCHEMAS.values():
        assert all(f.name and f.dataType for f in schema.fields)


def test_malformed_line_fails_the_read(spark, tmp_path):
    folder = tmp_path / "weather_raw" / "session_key=1"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"air_temperature": 20.5}\n{"air_temperature": 2\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        bronze.read_bronze(spark, str(tmp_path), "weather_raw").collect()
