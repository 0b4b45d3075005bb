from __future__ import annotations

import random
import threading
from datetime import datetime, timedelta

import pytest
from conftest import row, series, ts
from pyspark.sql import functions as F

from slotwise import schemas
from slotwise.config import DEFAULTS, Settings
from slotwise.ml import model as trees
from slotwise.ml import registry
from slotwise.ml.model import best_round
from slotwise.ml.scoring import score, score_slots, scoring_features, slot_features
from slotwise.operators import features
from slotwise.operators.metrics import naive_baseline_values
from slotwise.operators.rows import with_target
from slotwise.operators.split import temporal_split
from slotwise.plans.training import train_run
from slotwise.session import materialise

QUICK = {"maxIter": 8, "maxDepth": 5, "stepSize": 0.3, "minInstancesPerNode": 5}


@pytest.fixture(scope="module")
def wave(frame):
    """Bikes follow the hour, so the next hour can be learned."""
    rng = random.Random(11)
    start = ts("2024-01-01 00:00:00")
    data = []
    for station in (1, 2):
        for i in range(96 * 12):
            hour = (i // 4) % 24
            bikes = (2, 20)[(hour // 2) % 2] + rng.randint(0, 1)
            data.append(row(station, start + timedelta(minutes=15 * i), bikes))
    return frame(data)


@pytest.fixture(scope="module")
def parts(wave):
    data = materialise(with_target(features.all_features(wave)), "test-features")
    return temporal_split(data)[:3]


@pytest.fixture(scope="module")
def model(parts):
    return trees.train_model(parts[0], parts[1], QUICK)


def test_beats_the_baseline_on_a_learnable_series(model, parts):
    error = trees.validation_mae(model, parts[2])
    assert error < 0.5 * naive_baseline_values(parts[2])["mae"]
    assert 1 <= trees.num_trees(model) <= 8


def test_predictions_keep_rows_without_target(model, wave):
    featured = features.all_features(wave)
    got = trees.predict(model, featured)
    assert got.count() == featured.count()
    assert got.where(F.col("prediction").isNull() | F.isnan("prediction")).count() == 0


def test_unseen_categories_are_scored(model, parts):
    odd = parts[2].withColumn("distrito", F.lit("nowhere")).withColumn("station_id", F.lit(77).cast("long"))
    assert trees.predict(model, odd).where("prediction IS NOT NULL").count() == parts[2].count()


def test_category_means_are_the_train_parts(model, parts):
    means = {(r["column"], r["category"]): r["mean"] for r in model.means.collect()}
    per_key = parts[0].where(f"{schemas.TARGET} IS NOT NULL").groupBy("station_id").agg(F.avg(schemas.TARGET).alias("m"))
    for r in per_key.collect():
        assert means["station_id", str(r["station_id"])] == pytest.approx(r["m"])
    assert set(model.encoded) == {"station_id", "distrito"}


def test_many_keys_take_the_same_path(parts):
    """1,200 stations, each at its own level, are encoded like two."""
    spread = F.explode(F.sequence(F.lit(1), F.lit(1200)))
    many = [
        p.where("minutes_since_midnight < 60").withColumn("s", spread).withColumn("station_id", F.col("s").cast("long")).drop("s")
        for p in parts[:2]
    ]
    fitted = trees.train_model(*many, {**QUICK, "maxIter": 1})
    assert fitted.means.where("column = 'station_id'").count() == 1200
    assert trees.predict(fitted, many[1]).where("prediction IS NULL").count() == 0


def test_empty_parts_raise(parts):
    with pytest.raises(ValueError, match="training"):
        trees.train_model(parts[0].limit(0), parts[1])
    with pytest.raises(ValueError, match="validation"):
        trees.train_model(parts[0], parts[1].withColumn(schemas.TARGET, F.lit(None).cast("double")))


def test_tuning_picks_the_lowest_validation_error(parts):
    best, fitted, trials = trees.tune(parts[0], parts[1], trees.grid(maxDepth=[1, 5], maxIter=[2], stepSize=[0.3]))
    assert best == min(trials, key=lambda t: t[1])[0] and len(trials) == 2
    assert trees.validation_mae(fitted, parts[1]) == min(e for _, e in trials)
    with pytest.raises(ValueError):
        trees.tune(parts[0], parts[1], [])


@pytest.fixture
def side_by_side(monkeypatch):
    """Fits of one tree count that must meet another fit, and how often model inputs were built."""
    meet, fit, prepare, built = threading.Barrier(2, timeout=60), trees.fit_trees, trees.prepare, []

    def together(inputs, params):
        if params["maxIter"] == 1:
            meet.wait()
        return fit(inputs, params)

    monkeypatch.setattr(trees, "fit_trees", together)
    monkeypatch.setattr(trees, "prepare", lambda *a: built.append(1) or prepare(*a))
    return built


def test_tuning_fits_side_by_side(parts, side_by_side):
    _, _, trials = trees.tune(parts[0], parts[1], trees.grid(maxDepth=[1, 5], maxIter=[1], stepSize=[0.3]))
    assert [p["maxDepth"] for p, _ in trials] == [1, 5] and len(side_by_side) == 2


@pytest.mark.parametrize(
    ("errors", "patience", "trees"),
    [([3, 2, 1], 1, 3), ([3, 2, 2, 2, 1], 2, 2), ([3, 2, 2, 2, 1], 3, 5), ([3, 2, 4, 1, 5], None, 4), ([1], 5, 1), ([1, 1, 1], None, 1)],
)
def test_best_round(errors, patience, trees):
    assert best_round(errors, patience) == trees


def test_trees_after_the_best_round_are_cut(parts):
    train, val, _ = parts
    long = trees.train_model(train, val, {**QUICK, "maxIter": 12, "stepSize": 1.0, "patience": None})
    best = long.errors.index(min(long.errors)) + 1
    assert len(long.errors) == 12 and trees.num_trees(long) == best
    short = trees.train_model(train, val, {**QUICK, "maxIter": best, "stepSize": 1.0})
    same = lambda m: [r["prediction"] for r in trees.predict(m, val).orderBy("station_id", "snapshot_timestamp").collect()]
    assert same(long) == pytest.approx(same(short))
    hasty = trees.train_model(train, val, {**QUICK, "maxIter": 12, "stepSize": 1.0, "patience": 1})
    assert trees.num_trees(hasty) == trees.best_round(long.errors, 1)


def test_sampled_candidates():
    space = {"stepSize": trees.Range(0.01, 1.0, log=True), "maxDepth": trees.Range(2, 4, whole=True), "maxBins": [16, 32]}
    drawn = trees.sampled(space, 400, seed=3)
    assert drawn == trees.sampled(space, 400, seed=3) != trees.sampled(space, 400, seed=4)
    assert {d["maxDepth"] for d in drawn} == {2, 3, 4} and {d["maxBins"] for d in drawn} == {16, 32}
    assert all(0.01 <= d["stepSize"] <= 1.0 for d in drawn)
    assert 120 < sum(d["stepSize"] < 0.1 for d in drawn) < 280  # half of the decades


def test_search_drops_worse_candidates_early(parts):
    train, val, _ = parts
    space = {"maxDepth": [1, 5]}
    params, model, trials = trees.search(train, val, space, n=4, keep=2, rounds=8, seed=1, fixed=QUICK)
    assert [t.rounds for t in trials] == [2] * 4 + [4] * 2 + [8]
    for rounds, going in ((2, 2), (4, 1), (8, 1)):
        rung = [t for t in trials if t.rounds == rounds]
        kept, dropped = ([t.error for t in rung if t.kept is k] for k in (True, False))
        assert len(kept) == going and (not dropped or max(kept) <= min(dropped))
        assert {t.number for t in trials if t.rounds == 2 * rounds} <= {t.number for t in rung if t.kept}
    assert params == trials[-1].params
    again = trees.search(train, val, space, n=4, keep=2, rounds=8, seed=1, fixed=QUICK)
    assert again[2] == trials and trees.validation_mae(model, val) == trials[-1].error
    with pytest.raises(ValueError):
        trees.search(train, val, space, n=0)


def test_search_fits_side_by_side(parts, side_by_side):
    _, _, trials = trees.search(parts[0], parts[1], {"maxDepth": [1, 5]}, n=2, keep=2, rounds=2, seed=1, fixed=QUICK)
    assert [t.rounds for t in trials] == [1, 1, 2] and len(side_by_side) == 2


def test_importance(model, spark):
    got = trees.feature_importance(model, spark)
    rows = {r["feature"]: r for r in got.collect()}
    assert set(rows) == set(schemas.MODEL_COLUMNS)
    assert sum(r["gain_pct"] for r in rows.values()) == pytest.approx(100, abs=0.5)
    assert sum(r["split_pct"] for r in rows.values()) == pytest.approx(100, abs=0.5)
    top = [r["gain"] for r in trees.top_features(got).collect()]
    assert len(top) == 5 and top == sorted(top, reverse=True)
    assert top[0] > 0


def test_zero_importance_divides_by_one(spark):
    df = spark.createDataFrame([("a", 0.0, 0)], "feature string, gain double, split long")
    assert trees.with_shares(df).first()["gain_pct"] == 0.0


def test_train_run_and_registry(spark, wave, tmp_path):
    run = train_run(wave, "2024-01-12", {**QUICK, "maxIter": 2})
    assert run["metrics"].first()["n_rows"] > 0 and run["critical_states"].count() == 1
    store, runs, promotions = (str(tmp_path / n) for n in ("models", "runs", "promotions"))
    at = datetime(2024, 1, 12, 6, 5, 4)
    version = registry.version_of(at)
    assert version == "v20240112_060504"
    registry.save_model(run["model"], run["test"], store, version)
    loaded = registry.load_model(spark, store, version)
    test = registry.read_test_set(spark, store, version)
    assert trees.validation_mae(loaded, test) == run["metrics"].first()["mae"]
    assert registry.read_test_set(spark, store, "v1") is None

    with pytest.raises(LookupError):
        registry.latest_version(registry.read_runs(spark, runs))
    one = registry.run_row(spark, at, {"mae": 2.0}, ["a"], 2, [("a", 1.0)])
    two = registry.run_row(spark, at + timedelta(days=1), {"mae": 1.0}, ["a"])
    registry.log_run(one, runs)
    registry.log_run(two, runs)
    with pytest.raises(ValueError):
        registry.log_run(one, runs)
    known = registry.read_runs(spark, runs)
    assert registry.latest_version(known) == "v20240113_060504"
    assert registry.latest_run(known).first()["metrics"] == {"mae": 1.0}
    empty = spark.createDataFrame([], schemas.PROMOTIONS)
    assert registry.champion(known, empty).count() == 0
    assert spark.range(1).select(registry.champion_metric(known, empty)).first()[0] is None
    registry.promote(spark, promotions, version, at)
    promoted = spark.read.parquet(promotions)
    assert registry.champion(known, promoted).first()["version"] == version
    assert spark.range(1).select(registry.champion_metric(known, promoted)).first()[0] == 2.0


def test_promotion_rule(model, parts):
    test = parts[2]
    own = trees.validation_mae(model, test)
    assert registry.promote_if_better(model, "v2", None, None, test)["promoted"]
    assert not registry.promote_if_better(model, "v2", model, 99.0, test)["promoted"]
    assert registry.promote_if_better(model, "v2", None, own + 0.1, test)["promoted"]
    assert not registry.promote_if_better(model, "v2", None, own, test)["promoted"]
    stored = registry.promote_if_better(model, "v2", model, 2.0, None, challenger_mae=1.0)
    assert stored["promoted"] and stored["champion_mae"] == 2.0


def test_scoring(model, wave, frame):
    at = ts("2024-01-13 00:07:30")
    slot = ts("2024-01-13 00:00:00")
    live = frame(
        [row(1, slot, 3), row(2, slot, 4), row(3, slot, 5, activate=0), row(4, slot, 5, no_available=1)]
    )
    got = {r["station_id"]: r for r in score(model, "v1", live, at, wave).collect()}
    assert set(got) == {1, 2}
    assert got[1]["prediction_made_at"] == at and got[1]["target_time"] == at + timedelta(hours=1)
    assert all(r["predicted_dock_bikes"] >= 0 and r["predicted_dock_bikes"] % 1 == 0 for r in got.values())
    assert score(model, "v1", live, at).count() == 2
    assert score(model, "v1", live.where("activate = 0"), at, wave).count() == 0


def test_catch_up_scores_like_single_cycles(model, wave, frame):
    slots = [ts("2024-01-13 00:00:00") + timedelta(minutes=15 * i) for i in range(3)]
    batch = [row(s, t, 3 + i) for i, t in enumerate(slots) for s in (1, 2)]
    together = {
        (r["station_id"], r["prediction_made_at"]): r["predicted_dock_bikes"]
        for r in score_slots(model, "v1", frame(batch), wave).collect()
    }
    assert len(together) == 6
    single = {}
    for i, t in enumerate(slots):
        history = wave.unionByName(frame(batch[: 2 * i] or batch[:0]))
        for r in score(model, "v1", frame(batch[2 * i : 2 * i + 2]), t, history).collect():
            single[r["station_id"], t] = r["predicted_dock_bikes"]
    assert together == single


@pytest.mark.parametrize(
    ("at", "mode"),
    [("2024-03-31 01:20:00", "rows"), ("2024-04-01 00:05:00", "rows"), ("2024-04-02 22:50:00", "rows"), ("2024-03-31 01:20:00", "time")],
)
def test_slot_features_equal_the_windows(spark, frame, at, mode):
    r = random.Random(at)
    data, start = [], ts("2024-03-22 00:00:00")
    for s in range(1, 7):
        for i in range(96 * 13):
            if r.random() < (0.2, 0.9, 0.97, 0.995, 0.999, 1.0)[s - 1]:  # dense, sparse and nearly empty series
                continue
            for _ in range(1 + (r.random() < 0.1)):
                data.append(row(s, start + timedelta(minutes=15 * i), r.randint(0, 20), **({"dock_bikes": None} if r.random() < 0.05 else {})))
    history = frame(data).withColumn("seq", F.monotonically_increasing_id())
    slot = ts(at).replace(minute=ts(at).minute // 15 * 15, second=0)
    live = [row(s, slot, r.randint(0, 20), no_available=int(s == 5)) for s in range(1, 9)] + [row(1, slot, 7), row(1, slot, 7, station_id=None)]
    live = frame(live)
    for settings in (DEFAULTS, Settings(history_days=4, rolling_days=2, lookback_days=1, expanding_rows=1), Settings(history_days=None)):
        got = slot_features(live, history, at, settings, mode=mode)
        want = scoring_features(live, history, at, settings, mode=mode)
        assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
        one, two = ({r["station_id"]: r for r in df.collect()} for df in (got, want))
        assert set(one) == set(two) == {1, 2, 3, 4, 6, 7, 8}
        for s in one:
            for c in got.columns:
                assert one[s][c] == (pytest.approx(two[s][c], abs=1e-9) if isinstance(two[s][c], float) else two[s][c]), (s, c)


def test_slot_features_without_history(frame):
    live = frame([row(1, ts("2024-01-13 00:00:00"), 3)])
    got, want = (f(live, None, "2024-01-13 00:00:00") for f in (slot_features, scoring_features))
    assert got.columns == want.columns and got.collect() == want.collect()


def test_slot_features_scan_each_side_once_and_use_no_window(spark, frame, tmp_path):
    frame(series(1, "2024-01-01 00:00:00", range(200))).write.parquet(str(tmp_path / "history"))
    frame([row(1, ts("2024-01-03 02:00:00"), 3)]).write.parquet(str(tmp_path / "live"))
    live, history = (spark.read.parquet(str(tmp_path / n)) for n in ("live", "history"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = slot_features(live, history, "2024-01-03 02:00:00")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and "Window" not in plan
    assert "GreaterThanOrEqual(snapshot_timestamp" in plan and "LessThan(snapshot_timestamp" in plan
