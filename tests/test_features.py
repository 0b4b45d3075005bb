from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from conftest import FLAT, by_key, row, series, ts
from pyspark.sql import functions as F

from slotwise import schemas
from slotwise.config import Settings
from slotwise.functions.holidays import holiday_dim, is_holiday
from slotwise.operators import features, rows


def test_lags_target_and_state(raw_df):
    out = features.all_features(raw_df)
    got = by_key(
        out,
        "dock_bikes_lag_15m",
        "dock_bikes_lag_30m",
        "dock_bikes_lag_1h",
        "delta_dock_15m",
        "target_dock_bikes_1h",
    )
    at = lambda i: ts("2024-01-15 09:00:00") + timedelta(minutes=15 * i)
    assert got[1, at(0)] == (None, None, None, None, 14.0)
    assert got[1, at(1)][0] == 10.0 and got[1, at(1)][3] == 1.0
    assert got[1, at(2)][1] == 10.0
    assert got[1, at(4)][2] == 10.0
    assert [got[1, at(i)][4] for i in range(6, 10)] == [None] * 4
    assert got[2, at(0)][0] is None  # no leak from station 1
    assert by_key(out, "occupancy_rate_now")[1, at(0)] == 10 / 24


def test_columns_are_raw_plus_catalog_plus_target(raw_df):
    out = features.all_features(raw_df)
    assert set(out.columns) == set(raw_df.columns) | set(schemas.FEATURE_NAMES) | {schemas.TARGET}
    assert len(rows.without_identifiers(out).columns) == 42
    assert out.schema["is_day"].dataType.typeName() == "boolean"


def test_catalog():
    assert len(schemas.FEATURES) == 35 == len(set(schemas.FEATURE_NAMES))
    sizes = {g: len(schemas.features_by_group(g)) for g in ("lag", "temporal", "meteo", "stats", "static")}
    assert sizes == {"lag": 7, "temporal": 7, "meteo": 12, "stats": 5, "static": 4}
    assert schemas.features_by_group("nothing") == ()
    assert schemas.MODEL_COLUMNS[-1] == "station_id"


def test_keep_last_by_arrival(frame):
    same = ts("2024-01-15 09:00:00")
    df = frame([row(1, same, 10), row(1, same, 99)])
    df = df.withColumn("raw_ts", F.lit(0)).withColumn(
        "seq", F.when(F.col("dock_bikes") == 99, 2).otherwise(1)
    )
    assert [r["dock_bikes"] for r in rows.keep_last(df).collect()] == [99]
    flipped = df.withColumn("seq", -F.col("seq"))
    kept = rows.keep_last(flipped)
    assert [r["dock_bikes"] for r in kept.collect()] == [10]
    assert "seq" not in kept.columns


def test_hot_slot_is_cut_before_the_shuffle(frame):
    df = frame([row(1, ts("2024-01-15 09:00:00"), 1)]).withColumn("seq", F.lit(1))
    plan = rows.keep_last(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[1]


@pytest.mark.parametrize(
    ("utc", "hour", "minutes"),
    [
        ("2024-01-15 09:00:00", 10, 600),
        ("2024-07-15 09:00:00", 11, 660),
        ("2024-03-31 00:30:00", 1, 90),
        ("2024-03-31 01:00:00", 3, 180),
        ("2024-10-27 00:30:00", 2, 150),
        ("2024-10-27 01:30:00", 2, 150),
        ("2024-01-14 23:30:00", 0, 30),
    ],
)
def test_local_hour(frame, utc, hour, minutes):
    got = features.temporal_features(frame([row(1, ts(utc), 1)])).first()
    assert (got["hour_of_day"], got["minutes_since_midnight"]) == (hour, minutes)


@pytest.mark.parametrize(
    ("local", "rush"),
    [
        ("2024-01-15 06:45", False),
        ("2024-01-15 07:00", True),
        ("2024-01-15 09:30", True),
        ("2024-01-15 09:45", False),
        ("2024-01-15 17:00", True),
        ("2024-01-15 19:45", True),
        ("2024-01-15 20:00", False),
        ("2024-01-20 08:00", False),
        ("2024-01-01 08:00", True),
    ],
)
def test_rush_hour(frame, local, rush):
    utc = datetime.fromisoformat(local) - timedelta(hours=1)
    assert features.temporal_features(frame([row(1, utc, 1)])).first()["is_rush_hour"] is rush


def test_weekday_and_weekend(frame):
    got = features.temporal_features(
        frame([row(1, ts("2024-01-15 09:00:00"), 1), row(2, ts("2024-01-20 08:00:00"), 1)])
    )
    assert by_key(got, "day_of_week", "is_weekend") == {
        (1, ts("2024-01-15 09:00:00")): (0, False),
        (2, ts("2024-01-20 08:00:00")): (5, True),
    }


@pytest.mark.parametrize(
    ("day", "expected"),
    [
        ("2024-01-01", True),
        ("2024-01-06", True),
        ("2024-01-15", False),
        ("2025-04-17", True),
        ("2025-04-18", True),
        ("2024-05-01", True),
        ("2024-05-02", True),
        ("2026-05-02", True),
        ("2025-11-09", True),
        ("2026-12-25", True),
        ("2024-03-12", False),
        ("2028-01-01", True),
        ("2023-04-07", True),
        ("2023-04-10", False),
        ("2101-01-01", None),
    ],
)
def test_holidays(spark, day, expected):
    df = spark.createDataFrame([(date.fromisoformat(day),)], "d date")
    assert df.select(is_holiday("d")).first()[0] is expected


def test_holiday_dimension(spark):
    found = {r["date"]: r["name"] for r in holiday_dim(spark).collect()}
    assert len(found) == 4 * 13
    assert found[date(2024, 3, 29)] == "Good Friday"
    extra = ((date(2024, 7, 25), "St James"),)
    one_off = {r["date"]: r["name"] for r in holiday_dim(spark, extra=extra).collect()}
    assert one_off[date(2024, 7, 25)] == "St James"
    with pytest.raises(ValueError):
        is_holiday("d", (1800, 1900))


def test_easter_against_known_dates(spark):
    known = ["1981-04-19", "1954-04-18", "2000-04-23", "2008-03-23", "2024-03-31", "2038-04-25", "2049-04-18", "2076-04-19"]
    days = [(date.fromisoformat(d) - timedelta(days=2),) for d in known]
    df = spark.createDataFrame(days, "d date")
    assert df.where(is_holiday("d", (1900, 2099))).count() == len(known)


def test_holiday_uses_the_local_date(frame):
    got = features.temporal_features(frame([row(1, ts("2023-12-31 23:30:00"), 1)])).first()
    assert got["is_holiday"] is True


def test_weather_flags_and_nulls(frame):
    at = ts("2024-01-15 09:00:00")
    base = features.weather_features(frame([row(1, at, 1)])).first()
    assert base["is_raining"] and base["feels_cold"] and not base["feels_hot"]
    assert base["high_solar_radiation"] and base["is_day"] is True
    edge = dict(precipitation=0.0, apparent_temperature=8.0, direct_radiation=400.0)
    got = features.weather_features(frame([row(1, at, 1, **edge)])).first()
    assert not (got["is_raining"] or got["feels_cold"] or got["high_solar_radiation"])
    nulls = dict(precipitation=None, apparent_temperature=None, direct_radiation=None, is_day=None)
    got = features.weather_features(frame([row(1, at, 1, **nulls)])).first()
    assert got["is_raining"] is None and got["feels_hot"] is None and got["is_day"] is None


@pytest.mark.parametrize(
    ("lat", "lon", "name"),
    [
        (40.41, -3.70, "Centro"),
        (40.428, -3.70, "Centro"),  # also inside Chamberi, which comes later
        (40.43, -3.69, "Centro"),  # a corner of four boxes
        (40.44, -3.70, "Chamberi"),
        (40.38, -3.70, "Carabanchel"),
        (40.0, -3.70, None),
        (None, None, None),
    ],
)
def test_districts(frame, spark, lat, lon, name):
    df = frame([row(1, ts("2024-01-15 09:00:00"), 1, latitude=lat, longitude=lon)])
    assert features.station_features(df).first()["distrito"] == name
    if lat is not None:
        joined = features.first_box_join(df, schemas.district_boxes(spark)).first()
        assert joined["distrito"] == name


def test_zero_capacity_gives_null(frame):
    df = frame([row(1, ts("2024-01-15 09:00:00"), 0, total_bases=0)])
    assert features.lag_features(df).first()["occupancy_rate_now"] is None


def test_row_lags_jump_gaps_and_time_lags_do_not(frame):
    start = ts("2024-01-15 09:00:00")
    df = frame([row(1, start, 3), row(1, start + timedelta(hours=2), 7)])
    later = (1, start + timedelta(hours=2))
    assert by_key(features.lag_features(df), "dock_bikes_lag_15m")[later] == 3.0
    assert by_key(features.lag_features(df, mode="time"), "dock_bikes_lag_15m")[later] is None


def _brute_history(data):
    """Per (station, slot) the history features, in plain Python."""
    zone = ZoneInfo("Europe/Madrid")
    values = {(r[0], r[18]): r[6] for r in data}
    ordered = sorted(values)
    hour, weekday, change = defaultdict(list), defaultdict(list), defaultdict(float)
    previous = {}
    for s, t in ordered:
        local = t.replace(tzinfo=ZoneInfo("UTC")).astimezone(zone)
        hour[s, local.hour, t.date()].append(values[s, t])
        weekday[s, local.weekday(), local.hour, t.date()].append(values[s, t])
        change[s, t.date()] += abs(values[s, t] - previous[s]) if s in previous else 0
        previous[s] = values[s, t]

    def earlier(groups, prefix, day, n):
        days = sorted(k[-1] for k in groups if k[:-1] == prefix and k[-1] < day)[-n:]
        picked = [groups[(*prefix, d)] for d in days]
        return [statistics.fmean(p) if isinstance(p, list) else p for p in picked]

    out = {}
    for s, t in ordered:
        local = t.replace(tzinfo=ZoneInfo("UTC")).astimezone(zone)
        h = earlier(hour, (s, local.hour), t.date(), 7)
        w = earlier(weekday, (s, local.weekday(), local.hour), t.date(), 10_000)
        c = earlier(change, (s,), t.date(), 7)
        out[s, t] = (
            statistics.fmean(h) if h else None,
            statistics.stdev(h) if len(h) > 1 else None,
            statistics.fmean(w) if w else None,
            statistics.fmean(c) if c else None,
            values.get((s, t - timedelta(days=7))),
        )
    return out


def test_history_against_brute_force_over_dst(frame):
    import random

    rng = random.Random(7)
    start = ts("2024-03-20 22:00:00")
    data = []
    for station in (1, 2):
        for i in range(96 * 20):
            if rng.random() < 0.4:
                data.append(row(station, start + timedelta(minutes=15 * i), rng.randint(0, 24)))
    columns = (*features.SERIES_FEATURES[4:],)
    got = by_key(features.all_features(frame(data)), *columns)
    want = _brute_history(data)
    assert got.keys() == want.keys()
    for key, expected in want.items():
        assert got[key] == pytest.approx(expected, nan_ok=True), key


def test_history_constant_series(frame):
    data = series(1, "2024-01-01 00:00:00", [15] * 96 * 14) + series(
        2, "2024-01-01 00:00:00", [25 % 24] * 96 * 14
    )
    got = by_key(features.all_features(frame(data)), "avg_dock_same_hour_7d", "dock_bikes_same_time_1w")
    first = [v for (s, t), v in got.items() if s == 1 and t.date() == date(2024, 1, 1)]
    assert all(v == (None, None) for v in first)
    assert {v[0] for (s, _), v in got.items() if s == 1} == {None, 15.0}
    assert all((v[1] is None) == (t < datetime(2024, 1, 8)) for (s, t), v in got.items())


def test_expanding_mean_honours_its_row_cap(frame):
    data = [row(1, ts("2024-01-01 09:00:00") + timedelta(days=7 * i), v) for i, v in enumerate([1, 5, 9, 13])]
    df = features.temporal_features(frame(data))
    capped = features.weekday_stats(df, settings=Settings(expanding_rows=2))
    got = [r["avg_dock_same_weekday"] for r in capped.orderBy("_date").collect()]
    assert got == [None, 1.0, 3.0, 7.0]


def test_single_row_first_day_counts_as_zero_turnover(frame):
    data = [row(1, ts("2024-01-01 09:00:00"), 5), *series(1, "2024-01-02 09:00:00", [5, 9]), row(1, ts("2024-01-03 09:00:00"), 9)]
    got = features.daily_turnover(frame(data)).orderBy("_date").collect()
    assert [r["station_daily_turnover"] for r in got] == [None, 0.0, 2.0]


def test_null_keys_are_dropped(frame):
    at = ts("2024-01-01 09:00:00")
    df = frame([row(1, at, 5), row(1, None, 5), row(1, at, 5, station_id=None)])
    assert features.all_features(df).count() == 1


def test_frame_schema_matches_declared_columns():
    assert {f.name for f in FLAT} == set(schemas.SNAPSHOT_COLUMNS)


def test_boxes_of_any_extent_lie_in_few_cells(spark):
    rng = random.Random(4)
    boxes = [(0, "tiny", 40.0, 40.0, -3.0, -3.0), (1, "street", 40.0, 40.004, -3.001, -3.0), (2, "town", 39.9, 40.1, -3.2, -2.9)]
    boxes += [(3, "strip", -90.0, 90.0, -3.5, -3.49), (4, "country", 35.0, 44.0, -9.5, 3.5), (90, "world", -90.0, 90.0, -180.0, 180.0)]
    boxes += [(91, "everything", float("-inf"), float("inf"), float("-inf"), float("inf")), (5, "inverted", 50.0, 40.0, 0.0, 1.0)]
    boxes += [(10 + i, f"b{i}", y, y + h, x, x + w) for i in range(40) for y, x, h, w in [(rng.uniform(-80, 80), rng.uniform(-170, 170), 10 ** rng.uniform(-3, 2), 10 ** rng.uniform(-3, 2))]]
    points = [(40.0, -3.0), (40.002, -3.0005), (40.05, -3.1), (10.0, -3.495), (40.0, 2.0), (-60.0, 100.0), (89.0, -3.5), (200.0, 500.0)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(200)]
    df = spark.createDataFrame(boxes, "ordinal int, distrito string, lat_min double, lat_max double, lon_min double, lon_max double")
    sites = spark.createDataFrame(points, "latitude double, longitude double")
    joined = features.first_box_join(sites, df)
    got = {(r["latitude"], r["longitude"]): r["distrito"] for r in joined.collect()}
    for lat, lon in points:
        inside = [b for b in boxes if b[2] <= lat <= b[3] and b[4] <= lon <= b[5]]
        assert got[lat, lon] == (min(inside)[1] if inside else None)
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("explode") == 3 and "Cross" not in text
    alone = features.first_box_join(sites, df.where("distrito = 'world'"))
    assert alone.where("distrito = 'world'").count() == len(points) - 1
    assert features.first_box_join(sites, df.limit(0)).where("distrito IS NULL").count() == len(points)
