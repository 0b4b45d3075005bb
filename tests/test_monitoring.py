from __future__ import annotations

import math
import random
import statistics
from datetime import date, timedelta

import pytest
from conftest import ts
from pyspark.sql import functions as F

from slotwise import schemas
from slotwise.operators import monitoring as m
from slotwise.operators.rows import instant

T = ts("2024-01-19 12:00:00")
OBSERVED = "id long, ingestion_timestamp timestamp, dock_bikes int"


def preds(spark, pairs, target=T, version="v1"):
    data = [(s, target - timedelta(hours=1), target, float(p), version) for s, p in pairs]
    return spark.createDataFrame(data, schemas.PREDICTIONS)


def seen(spark, pairs, at=T):
    return spark.createDataFrame([(s, at, v) for s, v in pairs], OBSERVED)


def cycle(spark, predicted, observed):
    return m.cycle_metrics(preds(spark, predicted), seen(spark, observed), instant(T)).first()


@pytest.mark.parametrize(
    ("predicted", "observed", "expected"),
    [
        ([(1, 10), (2, 5)], [(1, 8), (2, 7)], {"n_predictions": 2, "mae": 2.0}),
        ([(1, 10), (2, 5)], [(1, 8), (2, 2)], {"mae": 2.5}),
        (
            [(1, 10), (2, 5)],
            [(1, 8), (2, 9)],
            {"rmse": math.sqrt(10), "worst_station_id": 2, "worst_station_error": 4.0},
        ),
        ([(1, 11), (2, 12), (3, 13)], [(1, 10), (2, 10), (3, 10)], {"p50_error": 2.0}),
        (
            [(i, 10 + i) for i in range(1, 11)],
            [(i, 10) for i in range(1, 11)],
            {"p50_error": 5.5, "p90_error": 9.0},
        ),
        ([(1, 10), (999, 5)], [(1, 8)], {"n_predictions": 1}),
        ([(7, 10), (3, 10)], [(7, 8), (3, 8)], {"worst_station_id": 3}),
    ],
)
def test_reconcile(spark, predicted, observed, expected):
    got = cycle(spark, predicted, observed)
    assert {k: got[k] for k in expected} == pytest.approx(expected)
    assert got["cycle_timestamp"] == T


def test_no_match_gives_no_row(spark):
    assert cycle(spark, [(1, 10)], [(2, 8)]) is None


def test_times_match_exactly_unless_aligned(spark):
    late = seen(spark, [(1, 8)], T + timedelta(minutes=4))
    p = preds(spark, [(1, 10)])
    assert m.cycle_metrics(p, late).count() == 0
    assert m.cycle_metrics(p, late, align=True).first()["mae"] == 2.0
    assert m.prediction_lookup(p, late).count() == 0
    assert m.prediction_lookup(p, late, align=True).count() == 1


def test_percentiles_with_copies_against_plain_python(spark):
    rng = random.Random(5)
    data, truth = [], {}
    for s in range(40):
        truth[s] = rng.randint(0, 20)
        data += [(s, rng.randint(0, 40) / 2)] * rng.randint(1, 9)
    got = cycle(spark, data, list(truth.items()))
    errors = sorted(abs(p - truth[s]) for s, p in data)
    assert got["n_predictions"] == len(errors)
    assert got["p50_error"] == statistics.median(errors)
    assert got["p90_error"] == errors[math.ceil(0.9 * len(errors)) - 1]
    assert got["mae"] == pytest.approx(statistics.fmean(errors))


def test_hot_copies_are_multiplied_not_emitted(spark):
    """A third of all rows on either side are copies of one row: the join stays tiny."""
    p = preds(spark, [(1, 10)]).unionByName(
        spark.range(20_000).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip((2, T - timedelta(hours=1), T, 5.0, "v1"), schemas.PREDICTIONS)])
    )
    s = seen(spark, [(1, 8)]).unionByName(
        spark.range(20_000).select(F.lit(2).cast("long").alias("id"), F.lit(T).alias("ingestion_timestamp"), F.lit(9).alias("dock_bikes"))
    )
    errors = m.matched_errors(p, s, unique=False)
    assert {(r["station_id"], r["n"]) for r in errors.collect()} == {(1, 1), (2, 400_000_000)}
    daily = {r["station_id"]: r for r in m.station_daily_metrics(p, s).collect()}
    assert daily[2]["n_cycles"] == 400_000_000 and daily[2]["daily_mae"] == 4.0


def test_daily_metrics_group_by_version_and_date(spark):
    p = preds(spark, [(1, 10), (2, 5)]).unionByName(preds(spark, [(1, 9)], version="v2"))
    p = p.unionByName(preds(spark, [(1, 1)], target=T + timedelta(days=1)))
    s = seen(spark, [(1, 8), (2, 7)]).unionByName(seen(spark, [(1, 8)], T + timedelta(days=1)))
    day = m.station_daily_metrics(p, s, "2024-01-19").collect()
    assert {(r["station_id"], r["model_version"]): r["daily_mae"] for r in day} == {
        (1, "v1"): 2.0,
        (2, "v1"): 2.0,
        (1, "v2"): 1.0,
    }
    totals = m.daily_totals(p, s)
    rows = {(str(r["date"]), r["model_version"]): r for r in totals.collect()}
    assert rows["2024-01-19", "v1"]["n_stations"] == 2
    assert rows["2024-01-20", "v1"]["daily_rmse"] == 7.0
    assert {r["model_version"] for r in m.pick_first(totals).collect()} == {"v2", "v1"}
    assert m.recent_totals(totals, 1).first()["date"] == date(2024, 1, 20)
    m.check_finite(totals)
    with pytest.raises(ValueError):
        m.check_finite(totals.withColumn("daily_mae", F.lit(float("inf"))))


def _cycles(spark, values):
    data = [(at, "v1", n, mae, mae, 1.0, 2.0, 1, 3.0, at) for at, n, mae in values]
    return spark.createDataFrame(data, schemas.CYCLE_METRICS)


def test_online_view_is_weighted_and_dashboard_is_not(spark):
    cycles = _cycles(spark, [(T, 1, 1.0), (T + timedelta(minutes=15), 3, 5.0)])
    view = m.online_mae(cycles).first()
    assert (view["mae"], view["total_predictions"], view["n_cycles"]) == (4.0, 4, 2)
    assert view["rmse"] == pytest.approx(math.sqrt((1 + 75) / 4))
    assert m.cycle_mae_by_day(cycles, "2024-01-20").first()["avg_mae"] == 3.0


@pytest.mark.parametrize(
    ("online", "training", "fired"),
    [
        (2.5, 2.0, True),
        (2.2, 2.0, False),
        (2.4, 2.0, False),
        (2.5, None, False),
        (2.5, 0.0, False),
        (2.5, float("nan"), False),
        (None, 2.0, False),
    ],
)
def test_performance_alert(spark, online, training, fired):
    cycles = _cycles(spark, [(T, 1, online)] if online is not None else [])
    assert m.performance_alert(cycles, training, "2024-01-20").first()["fired"] is fired


def test_alert_ignores_cycles_older_than_a_day(spark):
    cycles = _cycles(spark, [(ts("2024-01-18 23:00:00"), 1, 99.0)])
    assert m.performance_alert(cycles, 2.0, "2024-01-20").first()["fired"] is False


@pytest.mark.parametrize(("share", "fired"), [(0.35, 1), (0.301, 1), (0.20, 0), (0.30, 0)])
def test_drift_alert(spark, share, fired):
    summary = spark.createDataFrame([(date(2024, 1, 19), 1, share, ["a"], 5, 5)], schemas.DRIFT_SUMMARY)
    assert m.drift_alert(summary).count() == fired
    assert m.drift_alert(summary.limit(0)).count() == 0


def test_latest_predictions(spark):
    p = preds(spark, [(1, 1), (2, 2)], T - timedelta(days=1))
    p = p.unionByName(preds(spark, [(1, 3)], T)).unionByName(preds(spark, [(1, 4)], T + timedelta(hours=1)))
    got = m.latest_predictions(p).collect()
    assert [(r["station_id"], r["predicted_dock_bikes"]) for r in got] == [(1, 4.0)]
    health = m.latest_batch_health(p).first()
    assert (health[0], health[1]) == (1, T)
    empty = m.latest_batch_health(p.limit(0)).first()
    assert (empty[0], empty[1]) == (0, None)
    assert m.latest_prediction_of(p, 2).count() == 0


def test_worst_stations_breaks_ties_by_id(spark):
    data = [(date(2024, 1, 19), s, "v1", 1, float(s % 3), 1.0) for s in range(30)]
    daily = spark.createDataFrame(data, schemas.STATION_DAILY)
    got = [r["station_id"] for r in m.worst_stations(daily, "2024-01-19").collect()]
    assert got == [2, 5, 8, 11, 14, 17, 20, 23, 26, 29]


def test_lookup_keeps_every_prediction_once(spark):
    p = preds(spark, [(1, 10), (1, 10), (2, 4)])
    s = seen(spark, [(1, 8), (1, 9)])
    got = m.prediction_lookup(p, s).collect()
    assert [r["observed_dock_bikes"] for r in got] == [9, 9]
