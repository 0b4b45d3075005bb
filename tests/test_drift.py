from __future__ import annotations

import bisect
import math
import random
from collections import Counter
from datetime import date, datetime

import pytest
from conftest import series
from pyspark.sql import functions as F

from slotwise.functions.numeric import chi2_p_value, ks_p_value
from slotwise.operators import drift
from slotwise.plans.training import drift_job, drift_windows


def brute_ks(a, b):
    a, b = sorted(a), sorted(b)
    return max(
        abs(bisect.bisect_right(a, v) / len(a) - bisect.bisect_right(b, v) / len(b)) for v in a + b
    )


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_ks_statistic_is_exact_for_any_bucket_count(spark, buckets):
    rng = random.Random(1)
    ref = [rng.gauss(0, 1) for _ in range(900)] + [0.5] * 600
    cur = [rng.gauss(0.3, 1) for _ in range(400)] + [0.5] * 100
    r = spark.createDataFrame([(v, 1.0) for v in ref] + [(None, 1.0)], "x double, y double")
    c = spark.createDataFrame([(v, 1.0) for v in cur] + [(float("nan"), 1.0)], "x double, y double")
    counts = drift.value_counts(r, c, ["x", "y"], "double")
    got = {row["feature"]: row for row in drift.ks_statistic(counts, buckets).collect()}
    assert got["x"]["statistic"] == pytest.approx(brute_ks(ref, cur), abs=1e-12)
    assert (got["x"]["n_reference"], got["x"]["n_current"]) == (1500, 500)
    assert got["y"]["statistic"] == 0.0


def test_chi2_statistic(spark):
    rng = random.Random(2)
    ref = [rng.choice("aab c".replace(" ", "")) for _ in range(300)]
    cur = [rng.choice("abcd") for _ in range(200)]
    r = spark.createDataFrame([(v,) for v in ref] + [(None,)], "x string")
    c = spark.createDataFrame([(v,) for v in cur], "x string")
    got = drift.chi2_drift(r, c).first()
    rc, cc = Counter(ref), Counter(cur)
    want = 0.0
    for value in set(ref) | set(cur):
        total = rc[value] + cc[value]
        for observed, n in ((rc[value], 300), (cc[value], 200)):
            expected = total * n / 500
            want += (observed - expected) ** 2 / expected
    assert got["statistic"] == pytest.approx(want)
    assert got["df"] == 3
    # three degrees of freedom have an elementary tail
    tail = math.erfc(math.sqrt(want / 2)) + math.sqrt(2 * want / math.pi) * math.exp(-want / 2)
    assert got["p_value"] == pytest.approx(tail)


def test_chi2_tail_of_many_categories(spark):
    """Against the sum of Poisson terms, for even degrees of freedom up to ten million."""
    import numpy as np

    rows, want = [], []
    for df in (180, 200, 202, 400, 5_000, 100_000, 10_000_000):
        a = df // 2
        logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, a)))])
        for z in (-8.0, -3.0, -0.5, -0.001, 0.0, 0.001, 0.1, 1.0, 2.0, 3.5, 6.0):
            x = max(df + z * (2 * df) ** 0.5, 1e-3) / 2
            rows.append((2 * x, df))
            want.append(float(np.exp(np.arange(a) * np.log(x) - logs - x).sum()))
    df = spark.createDataFrame([(i, x, d) for i, (x, d) in enumerate(rows)], "i int, x double, df long")
    got = [r["q"] for r in df.withColumn("q", chi2_p_value(F.col("x"), F.col("df"))).orderBy("i").collect()]
    for (x, d), q, w in zip(rows, got, want):
        assert q == pytest.approx(w, rel=1e-4 if d > 1_000_000 else 1e-6, abs=1e-9), (x, d)
    odd = spark.createDataFrame([(x, d) for d in (201, 999) for x in (0.8 * d, 1.0 * d, 1.1 * d)], "x double, df long")
    for r in odd.select("x", "df", *[chi2_p_value(F.col("x"), F.col("df") + k).alias(f"q{k}") for k in (-1, 0, 1)]).collect():
        assert r["q-1"] < r["q0"] < r["q1"] and r["q0"] == pytest.approx((r["q-1"] + r["q1"]) / 2, abs=5e-4)
    assert spark.createDataFrame([(0.0, 10**7), (1e9, 10**7)], "x double, df long").select(chi2_p_value(F.col("x"), F.col("df")).alias("q")).collect() == [(1.0,), (0.0,)]


def test_chi2_tail_against_tables(spark):
    known = [
        (3.841459, 1, 0.05),
        (2.705543, 1, 0.10),
        (9.210340, 2, 0.01),
        (18.307038, 10, 0.05),
        (24.995790, 15, 0.05),
        (124.342113, 100, 0.05),
        (1074.679, 1000, 0.05),
        (5000.0, 3, 0.0),
        (0.0, 3, 1.0),
        (5.0, 0, 1.0),
    ]
    df = spark.createDataFrame(known, "x double, df long, p double")
    for r in df.withColumn("q", chi2_p_value(F.col("x"), F.col("df"))).collect():
        assert r["q"] == pytest.approx(r["p"], abs=2e-6), r


def test_kolmogorov_tail_against_tables(spark):
    known = [(1.3581, 0.05), (1.6276, 0.01), (1.2238, 0.10), (0.1, 1.0), (20.0, 0.0)]
    df = spark.createDataFrame([(x / 10, 200, 200, p) for x, p in known], "d double, a long, b long, p double")
    for r in df.withColumn("q", ks_p_value(F.col("d"), F.col("a"), F.col("b"))).collect():
        assert r["q"] == pytest.approx(r["p"], abs=1e-4), r


def test_feature_without_values_is_not_drifted(spark):
    r = spark.createDataFrame([(None, "a"), (None, "b")], "x double, y string")
    c = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, y string")
    got = {row["feature"]: row["drifted"] for row in drift.feature_drift(r, c).collect()}
    assert got == {"x": False, "y": False}


def test_summary(spark):
    tested = spark.createDataFrame([("b", True), ("a", True), ("c", False)], "feature string, drifted boolean")
    got = drift.drift_summary(tested, "2024-01-19", 4, 10, 5).first()
    assert (got["n_drifted_features"], got["share_drifted"]) == (2, 0.5)
    assert got["drifted_feature_names"] == ["a", "b"]
    assert got["date"] == date(2024, 1, 19)


def test_job_finds_a_shift_and_skips_missing_days(frame):
    rng = random.Random(4)
    calm = [v for _ in range(96 * 9) for v in [rng.randint(8, 12)]]
    data = series(1, "2024-01-01 00:00:00", calm + [rng.randint(18, 22) for _ in range(96 * 1)])
    job = drift_job(frame(data), "2024-01-10", datetime(2024, 1, 8))
    got = job.first()
    assert "dock_bikes_now" in got["drifted_feature_names"]
    assert "temperature_2m" not in got["drifted_feature_names"]
    assert got["n_current_rows"] == 96
    empty = drift_job(frame(data), "2024-03-01", datetime(2024, 1, 8)).first()
    assert (empty["n_drifted_features"], empty["share_drifted"], empty["drifted_feature_names"]) == (0, 0.0, [])


def test_reference_window_has_no_warmup_by_default(frame):
    data = frame(series(1, "2024-01-01 00:00:00", [3] * 96 * 16))
    reference, _ = drift_windows(data, "2024-01-16", datetime(2024, 1, 15))
    first = reference.agg(F.min("snapshot_timestamp")).first()[0]
    assert first == datetime(2024, 1, 8)
    week = F.col("dock_bikes_same_time_1w")
    assert reference.where(week.isNotNull()).count() == 96
    warm, _ = drift_windows(data, "2024-01-16", datetime(2024, 1, 15), equal_warmup=True)
    assert warm.where(week.isNull()).count() == 0
