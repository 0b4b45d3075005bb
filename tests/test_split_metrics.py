from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from conftest import row, series, ts
from pyspark.sql import functions as F

from slotwise import schemas
from slotwise.functions.numeric import rounded_count
from slotwise.operators import features, metrics, monitoring, rows
from slotwise.operators.quality import outside_ranges, range_violations
from slotwise.operators.split import data_profile, split_profile, temporal_split
from slotwise.plans.training import training_dataset, training_window


@pytest.fixture(scope="module")
def month(frame):
    return frame(series(1, "2024-01-01 00:00:00", [5] * 96 * 30) + series(2, "2024-01-01 00:00:00", [9] * 96 * 30))


def test_split_is_disjoint_and_complete(month):
    train, val, test, short = temporal_split(month)
    assert train.count() + val.count() + test.count() == month.count()
    assert not short
    hi = lambda df: df.agg(F.max("snapshot_timestamp")).first()[0]
    lo = lambda df: df.agg(F.min("snapshot_timestamp")).first()[0]
    assert hi(train) < lo(val) and hi(val) < lo(test)
    assert test.count() == 2 * 97 and val.count() == 2 * 96
    profile = {r["split"]: r["n_rows"] for r in split_profile(month).collect()}
    assert profile == {"train": train.count(), "val": val.count(), "test": test.count()}


def test_split_errors(frame, month):
    with pytest.raises(ValueError):
        temporal_split(month.limit(0))
    with pytest.raises(ValueError, match="val"):
        temporal_split(frame(series(1, "2024-01-01 00:00:00", [5] * 12)))
    *_, short = temporal_split(frame(series(1, "2024-01-01 00:00:00", [5] * 96 * 4)))
    assert short


def test_profile(month):
    got = data_profile(month).first()
    assert (got["n_rows"], got["n_stations"]) == (2 * 96 * 30, 2)
    empty = data_profile(month.limit(0)).first()
    assert (empty["n_rows"], empty["n_stations"], empty["last_slot"]) == (0, 0, None)


def test_training_dataset_trims_warmup_after_features(frame):
    data = series(1, "2024-01-01 00:00:00", list(range(24)) * 4 * 12)
    inactive = [row(1, ts("2024-01-13 00:00:00"), 3, activate=0)]
    out = training_dataset(frame(data + inactive), "2024-01-09", "2024-01-11")
    times = [r["snapshot_timestamp"] for r in out.select("snapshot_timestamp").collect()]
    assert min(times) == ts("2024-01-09 00:00:00")
    assert len(times) == 96 * 3 - 4  # last four rows have no target
    first = out.where(F.col("snapshot_timestamp") == rows.instant("2024-01-09")).first()
    assert first["dock_bikes_same_time_1w"] is not None and first["dock_bikes_lag_1h"] is not None
    assert [str(d) for d in training_window("2024-01-20")] == ["2024-01-11", "2024-01-20"]


def test_round_half_even_and_clip(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, -0.7, 3.2)], "p double")
    assert [r[0] for r in df.select(rounded_count(F.col("p"))).collect()] == [0.0, 2.0, 2.0, 0.0, 3.0]


def _scored(spark, triples):
    schema = "dock_bikes_now int, target_dock_bikes_1h double, prediction double, total_bases int"
    return spark.createDataFrame([(n, t, p, 20) for n, t, p in triples], schema)


def test_baseline(spark):
    df = _scored(spark, [(10, 8.0, 0.0), (5, 7.0, 0.0), (None, 3.0, 0.0), (4, None, 0.0)])
    got = metrics.naive_baseline(df).first()
    assert (got["n"], got["mae"], got["rmse"]) == (2, 2.0, 2.0)
    with pytest.raises(ValueError):
        metrics.naive_baseline_values(df.limit(0))
    with pytest.raises(ValueError):
        metrics.naive_baseline(df.drop("dock_bikes_now"))


def test_evaluate_against_plain_python(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 20), float(rng.randint(0, 20)), rng.uniform(-2, 22)) for _ in range(500)]
    got = metrics.evaluate_values(_scored(spark, data))
    pairs = [(t, max(round(p), 0)) for _, t, p in data]
    errors = [p - t for t, p in pairs]
    mean = sum(t for t, _ in pairs) / len(pairs)
    assert got["mae"] == pytest.approx(sum(map(abs, errors)) / 500)
    assert got["rmse"] == pytest.approx(math.sqrt(sum(e * e for e in errors) / 500))
    assert got["rmse"] >= got["mae"]
    sst = sum((t - mean) ** 2 for t, _ in pairs)
    assert got["r2"] == pytest.approx(1 - sum(e * e for e in errors) / sst)
    assert got["mae_normalized"] == pytest.approx(got["mae"] / mean)
    assert got["n_rows"] == 500.0


def test_evaluate_edges(spark):
    perfect = metrics.evaluate_values(_scored(spark, [(4, 4.0, 4.0), (4, 4.0, 4.2)]))
    assert perfect["mae"] == 0 and perfect["r2"] == 1.0 and perfect["improvement_pct"] == 0.0
    constant = metrics.evaluate_values(_scored(spark, [(4, 4.0, 5.0), (4, 4.0, 4.0)]))
    assert constant["r2"] == 0.0
    zeros = metrics.evaluate_values(_scored(spark, [(0, 0.0, 1.0)]))
    assert math.isnan(zeros["mae_normalized"])
    with pytest.raises(ValueError):
        metrics.evaluate_values(_scored(spark, [(4, None, 5.0)]))


def test_critical_states(spark):
    data = [(0, 0.0, 0.0), (0, 1.0, 3.0), (0, 5.0, 1.0), (0, 19.0, 20.0), (0, 20.0, 10.0), (0, None, 0.0)]
    got = metrics.critical_states(_scored(spark, data)).first()
    assert (got["empty_precision"], got["empty_recall"]) == (0.5, 0.5)
    assert (got["full_precision"], got["full_recall"]) == (1.0, 0.5)
    assert (got["n_empty_actual"], got["n_full_actual"]) == (2.0, 2.0)
    assert metrics.critical_states(_scored(spark, data).limit(0)).count() == 0
    calm = metrics.critical_states(_scored(spark, [(9, 9.0, 9.0)])).first()
    assert calm["empty_precision"] == calm["full_recall"] == 0.0


def test_ranges(spark):
    df = spark.createDataFrame([(0, 0, 1, 0), (24, 6, 12, 1439), (23, 7, 13, 1440)], "hour_of_day int, day_of_week int, month int, minutes_since_midnight int")
    got = {r["rule"]: r["violations"] for r in range_violations(df).collect()}
    assert got == {"hour_of_day": 1, "day_of_week": 1, "month": 1, "minutes_since_midnight": 1}
    assert outside_ranges(df).count() == 2


def test_sample_keeps_whole_series_and_is_stable(frame):
    df = frame([r for s in range(20) for r in series(s, "2024-01-15 09:00:00", [s % 20] * 5)])
    picked = rows.sample_series(df, 6)
    counts = {r["station_id"]: r["count"] for r in picked.groupBy("station_id").count().collect()}
    assert len(counts) == 6 and set(counts.values()) == {5}
    again = {r[0] for r in rows.sample_series(df.repartition(7), 6).select("station_id").distinct().collect()}
    assert again == set(counts)
    other = {r[0] for r in rows.sample_series(df, 6, seed=1).select("station_id").distinct().collect()}
    assert other != again


def test_baseline_needs_features(frame):
    with pytest.raises(ValueError, match="missing"):
        metrics.naive_baseline(frame([row(1, ts("2024-01-15 09:00:00"), 1)]))
    df = features.add_target(features.current_state(frame(series(1, "2024-01-15 09:00:00", range(8)))))
    assert metrics.naive_baseline_values(df) == {"mae": 4.0, "rmse": 4.0}


def test_ordered_parts(frame):
    start = ts("2024-01-01 00:00:00")
    data = [row(s, start + timedelta(hours=6 * i), i) for i in range(50) for s in (2, 1)]
    for part in temporal_split(frame(data[::-1]), ordered=True)[:3]:
        keys = [(r["snapshot_timestamp"], r["station_id"]) for r in part.collect()]
        assert keys == sorted(keys) and keys


def test_dashboard_frames(spark):
    at = ts("2024-01-19 12:00:00")
    cycles = [(at - timedelta(days=d), "v1", 1, float(d), 0.0, 0.0, 0.0, 1, 0.0, at) for d in (0, 1, 9)]
    daily = [(date(2024, 1, 19), s, "v1", 1, float(s), 0.0) for s in range(1, 15)]
    drift = [(date(2024, 1, d), 1, 0.5, ["a"], 1, 1) for d in (18, 19)]
    frames = monitoring.dashboard_frames(
        spark.createDataFrame(cycles, schemas.CYCLE_METRICS), spark.createDataFrame(daily, schemas.STATION_DAILY),
        spark.createDataFrame(drift, schemas.DRIFT_SUMMARY), "2024-01-19",
    )
    assert [r["avg_mae"] for r in frames["mae_by_day"].collect()] == [1.0, 0.0]
    assert [r["station_id"] for r in frames["worst_stations"].collect()] == list(range(14, 4, -1))
    assert [r["date"].day for r in frames["drift"].collect()] == [19]
