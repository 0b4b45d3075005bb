from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from conftest import ts
from pyspark.sql import functions as F

from slotwise import schemas
from slotwise.functions import time
from slotwise.operators import monitoring, rows
from slotwise.sources import sinks, snapshots, tables, weather
from slotwise.sources.tables import newest_date, newest_predictions

WEATHER = {
    "timestamp": "2024-01-15T09:00:00+00:00",
    "temperature_2m": 10.0,
    "apparent_temperature": 5.0,
    "precipitation": 1.5,
    "precipitation_probability": 80.0,
    "wind_speed_10m": 5.0,
    "weather_code": 61,
    "is_day": 1,
    "direct_radiation": 500.0,
}


def station(i, **changes):
    base = {
        "id": i,
        "number": str(i),
        "name": f"Station {i}",
        "activate": 1,
        "no_available": 0,
        "total_bases": 24,
        "dock_bikes": 10 + i,
        "free_bases": 14 - i,
        "geometry": {"type": "Point", "coordinates": [-3.7, 40.4]},
        "unknown": "ignored",
    }
    base.update(changes)
    return base


def document(at, stations, weather=WEATHER, code="00"):
    return {
        "ingestion_timestamp": at,
        "stations": {"code": code, "description": "", "datetime": at, "data": stations},
        "weather": weather,
    }


@pytest.fixture
def archive(tmp_path):
    def write(*documents):
        for i, d in enumerate(documents):
            text = d if isinstance(d, str) else json.dumps(d, indent=1)
            (tmp_path / f"{i}.json").write_text(text)
        return str(tmp_path)

    return write


def test_flatten_documents(spark, archive):
    path = archive(
        document("2024-01-15T10:07:31+01:00", [station(1), station(2, geometry={"type": "Point", "coordinates": [-3.7]})]),
        document("2024-01-15T09:15:00.250000+00:00", [station(1, geometry=None)], weather=None),
    )
    got = snapshots.read_raw_snapshots(spark, path).orderBy("snapshot_timestamp", "station_id").collect()
    first, short, bare = got
    assert first["snapshot_timestamp"] == ts("2024-01-15 09:00:00")
    assert first["raw_ts"] == ts("2024-01-15 09:07:31")
    assert (first["latitude"], first["longitude"]) == (40.4, -3.7)
    assert first["temperature_2m"] == 10.0 and first["seq"] == 0 and short["seq"] == 1
    assert short["latitude"] is None and short["longitude"] == -3.7
    assert bare["latitude"] is None and bare["temperature_2m"] is None
    assert bare["snapshot_timestamp"] == ts("2024-01-15 09:15:00")
    flat = set(snapshots.read_raw_snapshots(spark, path).columns) - {"raw_ts", "seq"}
    live = snapshots.scoring_frame(spark.createDataFrame([], schemas.STATION), "2024-01-15 09:00:00")
    assert flat == set(live.columns) == set(schemas.SNAPSHOT_COLUMNS)


def test_contract(spark, archive):
    at = "2024-01-15T09:00:00+00:00"
    path = archive(
        document(at, [station(1)]),
        document(at, [station(1)], code="90"),
        document(at, [station(1), station(2, dock_bikes=None)]),
        document(at, [station(1, geometry={"type": "Point"})]),
        document(at, []),
        {"ingestion_timestamp": at, "weather": None},
        "{not json",
    )
    documents = snapshots.read_documents(spark, path)
    ok, rejected = snapshots.validate_snapshots(documents)
    assert (ok.count(), rejected.count()) == (2, 5)


def test_forecast_arrays(spark, archive):
    hours = ["2024-01-15T08:00", "2024-01-15T09:00", "2024-01-15T10:00"]
    hourly = {"time": hours, **{c: [1, 2, 3] for c in schemas.WEATHER_COLUMNS}}
    hourly["precipitation_probability"] = [5, None, 7]
    docs = weather.read_forecasts(spark, archive({"hourly": hourly}))
    now = weather.current_weather(docs, rows.instant("2024-01-15 09:40:00")).first()
    assert (now["temperature_2m"], now["precipitation_probability"]) == (2.0, 0.0)
    assert now["timestamp"] == ts("2024-01-15 09:00:00")
    last = weather.current_weather(docs, rows.instant("2024-01-16 09:40:00")).first()
    assert last["temperature_2m"] == 3.0 and last["timestamp"] == ts("2024-01-15 10:00:00")
    local = weather.current_weather(docs, rows.instant("2024-01-15 08:40:00"), "Europe/Madrid").first()
    assert local["temperature_2m"] == 2.0
    assert weather.forecast_rows(docs).count() == 3


def _stations(spark, *items):
    return spark.read.schema(schemas.STATION).json(spark.sparkContext.parallelize([json.dumps(s) for s in items]))


def _weather(spark, **changes):
    data = {**WEATHER, **changes}
    return spark.createDataFrame(
        [(ts("2024-01-15 09:00:00"), *[data[c] for c in schemas.WEATHER_COLUMNS])],
        schemas.WEATHER_SNAPSHOT,
    )


def test_scoring_frame(spark):
    live = _stations(spark, station(1), station(2, geometry={"type": "Point", "coordinates": []}))
    got = {r["station_id"]: r for r in snapshots.scoring_frame(live, "2024-01-15 09:44:59", _weather(spark)).collect()}
    assert got[1]["snapshot_timestamp"] == ts("2024-01-15 09:30:00")
    assert got[1]["temperature_2m"] == 10.0 and got[2]["latitude"] is None
    bare = snapshots.scoring_frame(live, "2024-01-15 09:00:00").first()
    assert all(bare[c] == 0 for c in schemas.WEATHER_COLUMNS)
    empty = snapshots.scoring_frame(live, "2024-01-15 09:00:00", _weather(spark).limit(0)).first()
    assert empty["temperature_2m"] == 0.0
    kept = snapshots.scoring_frame(live, "2024-01-15 09:00:00", weather_nulls="keep").first()
    assert kept["temperature_2m"] is None


def test_table_round_trip_by_date(spark, tmp_path):
    path = str(tmp_path / "status")
    live = _stations(spark, station(1), station(2, activate=0))
    for at in ("2024-01-15 09:07:31", "2024-01-16 09:00:00"):
        fact = snapshots.attach_cycle(live, rows.instant(at), _weather(spark))
        assert sinks.append_snapshots(fact, path) == 2
    bare = snapshots.attach_cycle(live, rows.instant("2024-01-17 00:00:00"))
    assert sinks.append_snapshots(bare, path) == 2
    got = snapshots.read_snapshot_table(spark, path, "2024-01-15", "2024-01-15")
    only = got.collect()
    assert [(r["station_id"], r["snapshot_timestamp"]) for r in only] == [(1, ts("2024-01-15 09:00:00"))]
    assert only[0]["latitude"] == 40.4 and only[0]["temperature_2m"] == 10.0
    assert snapshots.read_snapshot_table(spark, path).count() == 3
    assert snapshots.read_snapshot_table(spark, path, start="2024-01-16", active_only=False).count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(activate,1)" in plan
    assert sinks.drop_expired(spark, path, date(2025, 1, 15)) == ["dt=2024-01-15"]
    assert snapshots.read_snapshot_table(spark, path).count() == 2


def test_appends_check_the_schema(spark, tmp_path):
    path = str(tmp_path / "predictions")
    at = ts("2024-01-19 12:00:00")
    row = spark.createDataFrame([(1, at, at + timedelta(hours=1), 4.0, "v1")], schemas.PREDICTIONS)
    assert sinks.append_predictions(row.withColumn("surplus", F.lit(1)), path) == 1
    with pytest.raises(ValueError, match="model_version"):
        sinks.append_predictions(row.drop("model_version"), path)
    got = tables.read_predictions(spark, path)
    assert got.columns == schemas.PREDICTIONS.fieldNames() and got.count() == 1
    assert tables.predictions_for(got, at + timedelta(hours=1)).count() == 1
    assert tables.predictions_for(got, at).count() == 0
    assert tables.read_predictions(spark, str(tmp_path / "absent")).count() == 0


def test_replacing_a_day_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "daily")

    def daily(day, n):
        return spark.createDataFrame([(day, 1, "v1", n, 1.0, 1.0)], schemas.STATION_DAILY)

    first, second = date(2024, 1, 18), date(2024, 1, 19)
    sinks.append_station_daily(daily(first, 1), path)
    for n in (2, 3):
        sinks.replace_partitions(daily(second, n), path, "station_daily_metrics")
    got = tables.read_table(spark, path, schemas.STATION_DAILY)
    assert {(r["date"], r["n_cycles"]) for r in got.collect()} == {(first, 1), (second, 3)}
    assert monitoring.table_freshness(got, "date").first()["n_rows"] == 2


def test_other_appends(spark, tmp_path):
    at = ts("2024-01-19 12:00:00")
    cycle = spark.createDataFrame([(at, "v1", 1, 1.0, 1.0, 1.0, 1.0, 1, 1.0, at)], schemas.CYCLE_METRICS)
    assert sinks.append_cycle_metrics(cycle, str(tmp_path / "c")) == 1
    total = spark.createDataFrame([(at.date(), "v1", 1, 1, 1.0, 1.0)], schemas.DAILY_TOTALS)
    assert sinks.append_daily_totals(total, str(tmp_path / "t")) == 1
    sinks.write_dataset(total, str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 1


def test_raw_archive_layout(spark, tmp_path):
    docs = spark.createDataFrame(
        [("2024-01-05T09:07:31+00:00",), ("2024-01-05T23:30:00+01:00",)], "ingestion_timestamp string"
    )
    path = tmp_path / "raw"
    sinks.write_raw(docs, str(path))
    assert sorted(str(p.relative_to(path)) for p in path.glob("dt=*/hh=*")) == [
        "dt=2024-01-05/hh=09",
        "dt=2024-01-05/hh=22",
    ]
    df = spark.createDataFrame([(ts("2024-01-05 09:07:31"),)], "t timestamp")
    got = df.select(time.partition_path(F.col("t")), time.version_name(F.col("t"))).first()
    assert tuple(got) == ("dt=2024-01-05/hh=09/mm=07", "v20240105_090731")


def test_summaries(spark, tmp_path):
    path = str(tmp_path / "summary")
    row = spark.createDataFrame([(date(2024, 1, 19), 2, 0.4, ["a", "b"], 10, 5)], schemas.DRIFT_SUMMARY)
    assert tables.read_drift_summary(spark, path, "2024-01-19").count() == 0
    sinks.write_summary(row, path)
    assert tables.read_drift_summary(spark, path, "2024-01-19").first() == row.first()
    assert tables.read_drift_summary(spark, path, "2024-01-20").count() == 0
    report = sinks.evaluation_report(spark.createDataFrame([(1.5,)], "mae double"), num_trees=7).first()
    assert report["feature_count"] == 36 and report["metrics"]["mae"] == 1.5
    assert report["model_info"]["num_trees"] == 7 and isinstance(report["generated_at"], datetime)


def test_retention_keeps_whole_days(spark):
    df = spark.createDataFrame([(date(2024, 1, 19) - timedelta(days=i),) for i in range(10)], "dt date")
    assert sinks.retained(df, date(2024, 1, 19), days=3).count() == 4


def test_skipped_and_union(frame):
    from conftest import row

    at = ts("2024-01-15 09:00:00")
    df = frame([row(1, at, 1), row(2, at, 1), row(3, at, 1, activate=0), row(4, at, 1, no_available=1)])
    assert [r[0] for r in rows.skipped_keys(df).collect()] == [3, 4]
    assert rows.active_for_training(df).count() == 3 and rows.active_for_scoring(df).count() == 2
    both = rows.union_history(df, df.drop("temperature_2m"))
    assert both.where("temperature_2m IS NULL").count() == 4
    assert rows.only_keys(df, df.where("station_id < 3")).count() == 2


def made(spark, *rows):
    data = [(s, ts(at), ts(at), 1.0, v) for s, at, v in rows]
    return spark.createDataFrame(data, schemas.PREDICTIONS)


def test_a_repeated_append_is_refused(spark, tmp_path):
    path = str(tmp_path / "p")
    day = [(1, "2024-01-01 23:45:00", "v1"), (2, "2024-01-02 00:00:00", "v1"), (None, "2024-01-02 00:00:00", "v1")]
    assert sinks.append_new(made(spark, *day), path, "predictions") == 3
    more = made(spark, *day, (1, "2024-01-03 00:00:00", "v1"), (2, "2024-01-02 00:00:00", "v2"), (2, "2024-01-02 00:00:00", "v2"))
    with pytest.raises(sinks.RepeatedRows) as refused:
        sinks.append_new(more, path, "predictions")
    assert (refused.value.stored, refused.value.doubled) == (3, 1)
    assert spark.read.parquet(path).count() == 3
    assert sinks.append_new(more, path, "predictions", "skip") == 2
    assert sinks.append_new(more, path, "predictions", "skip") == 0
    assert spark.read.parquet(path).count() == 5
    assert sinks.append_new(made(spark), path, "predictions") == 0
    with pytest.raises(ValueError):
        sinks.append_new(more, path, "predictions", "other")


def test_guarded_append_reads_the_touched_dates_only(spark, tmp_path):
    path = str(tmp_path / "p")
    for d in ("01", "02", "03"):
        sinks.append_predictions(made(spark, (1, f"2024-01-{d} 00:00:00", "v1")), path)
    rows = made(spark, (1, "2024-01-02 00:00:00", "v1")).withColumn("dt", F.to_date("prediction_made_at"))
    stored = sinks._stored_keys(rows, path, "predictions")
    assert len(stored.inputFiles()) == 3 and stored.count() == 1
    plan = stored._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-02" in filters and "GreaterThanOrEqual(prediction_made_at" in plan


def test_newest_date_is_found_without_reading_the_table(spark, tmp_path):
    path = str(tmp_path / "p")
    assert newest_date(spark, path) is None and newest_predictions(spark, path).count() == 0
    for d in ("01", "03", "02"):
        sinks.append_predictions(made(spark, (1, f"2024-01-{d} 00:00:00", "v1"), (2, f"2024-01-{d} 01:00:00", "v1"), (1, f"2024-01-{d} 02:00:00", "v1")), path)
    (tmp_path / "p" / "dt=2024-01-04").mkdir()
    assert newest_date(spark, path) == date(2024, 1, 3)
    latest = monitoring.latest_stored(spark, path)
    assert sorted((r["station_id"], r["prediction_made_at"].hour) for r in latest.collect()) == [(1, 2), (2, 1)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-03" in filters
    assert monitoring.latest_stored_of(spark, path, 2).count() == 1 and monitoring.latest_stored_of(spark, path, 9).count() == 0
    one = monitoring.latest_stored_of(spark, path, 2)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(station_id,2)" in one
    assert tuple(monitoring.stored_batch_health(spark, path).first()) == (2, ts("2024-01-03 02:00:00"))
    assert tuple(monitoring.stored_batch_health(spark, str(tmp_path / "none")).first()) == (0, None)
