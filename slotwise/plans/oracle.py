"""The registered queries as SQL over the given tables, written independently of Spark."""

from __future__ import annotations

from slotwise.plans.canonical import AS_OF, REFERENCE_END, REFERENCE_START, TARGET_DATE
from slotwise.plans.canonical import TRAINING_END, TRAINING_START

WEATHER = (
    "temperature_2m, apparent_temperature, precipitation, precipitation_probability, "
    "wind_speed_10m, weather_code, is_day, direct_radiation"
)
FLAT = (
    "station_id, station_number, station_name, activate, no_available, total_bases, dock_bikes, "
    f"free_bases, longitude, latitude, {WEATHER}, snapshot_timestamp"
)
LOCAL = "(snapshot_timestamp AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid'"

RAW = """
ev AS (
  SELECT event_id, ts, event_type, floor(value)::INT AS v, user_id AS s, user_id % 8 AS p,
         json_extract(props, '$.k')::INT AS k
  FROM events
),
raw AS (
  SELECT s AS station_id, s::VARCHAR AS station_number, 'Station ' || s::VARCHAR AS station_name,
    CASE WHEN event_type = 'error' AND k < 10 THEN 0 ELSE 1 END::INT AS activate,
    CASE WHEN event_type = 'signup' AND k < 10 THEN 1 ELSE 0 END::INT AS no_available,
    (16 + 2 * p)::INT AS total_bases,
    (v % (17 + 2 * p))::INT AS dock_bikes,
    (16 + 2 * p - v % (17 + 2 * p))::INT AS free_bases,
    -3.75::DOUBLE + p * 0.015625::DOUBLE AS longitude,
    40.375::DOUBLE + p * 0.015625::DOUBLE AS latitude,
    k * 0.5::DOUBLE - 5.0::DOUBLE AS temperature_2m,
    k * 0.5::DOUBLE - 8.0::DOUBLE AS apparent_temperature,
    greatest(k - 80, 0) * 0.25::DOUBLE AS precipitation,
    k::DOUBLE AS precipitation_probability,
    (k % 40) * 0.5::DOUBLE AS wind_speed_10m,
    (k % 4)::INT AS weather_code,
    CASE WHEN extract('hour' FROM ts) BETWEEN 7 AND 20 THEN 1 ELSE 0 END::INT AS is_day,
    k * 8.0::DOUBLE AS direct_radiation,
    time_bucket(INTERVAL '15 minutes', ts) AS snapshot_timestamp,
    ts AS raw_ts, event_id AS seq
  FROM ev
),
snap AS (
  SELECT * EXCLUDE (raw_ts, seq) FROM raw
  QUALIFY row_number() OVER (PARTITION BY station_id, snapshot_timestamp
                             ORDER BY raw_ts DESC, seq DESC) = 1
)
"""

BOXES = """
boxes(ordinal, distrito, lat_min, lat_max, lon_min, lon_max) AS (
  SELECT o, n, a::DOUBLE, b::DOUBLE, c::DOUBLE, d::DOUBLE FROM (VALUES
  (0, 'Centro', 40.405, 40.430, -3.715, -3.690),
  (1, 'Arganzuela', 40.385, 40.410, -3.710, -3.680),
  (2, 'Retiro', 40.405, 40.430, -3.690, -3.660),
  (3, 'Salamanca', 40.420, 40.455, -3.690, -3.655),
  (4, 'Chamartin', 40.445, 40.480, -3.690, -3.650),
  (5, 'Tetuan', 40.445, 40.480, -3.720, -3.690),
  (6, 'Chamberi', 40.425, 40.455, -3.720, -3.690),
  (7, 'Fuencarral-El Pardo', 40.480, 40.560, -3.760, -3.650),
  (8, 'Moncloa-Aravaca', 40.415, 40.470, -3.760, -3.715),
  (9, 'Latina', 40.385, 40.425, -3.760, -3.715),
  (10, 'Carabanchel', 40.360, 40.395, -3.760, -3.700),
  (11, 'Usera', 40.380, 40.405, -3.710, -3.680),
  (12, 'Puente de Vallecas', 40.380, 40.415, -3.680, -3.640),
  (13, 'Moratalaz', 40.400, 40.430, -3.660, -3.620),
  (14, 'Ciudad Lineal', 40.430, 40.470, -3.670, -3.630),
  (15, 'Hortaleza', 40.465, 40.510, -3.660, -3.610),
  (16, 'Villaverde', 40.340, 40.380, -3.720, -3.660),
  (17, 'Villa de Vallecas', 40.360, 40.400, -3.650, -3.600),
  (18, 'Vicalvaro', 40.400, 40.440, -3.620, -3.570),
  (19, 'San Blas-Canillejas', 40.430, 40.470, -3.630, -3.580),
  (20, 'Barajas', 40.455, 40.500, -3.600, -3.540)
  ) AS t(o, n, a, b, c, d)
),
sites AS (
  SELECT p.latitude, p.longitude, min_by(b.distrito, b.ordinal) AS distrito
  FROM (SELECT DISTINCT latitude, longitude FROM raw) p
  LEFT JOIN boxes b ON p.latitude BETWEEN b.lat_min AND b.lat_max
                   AND p.longitude BETWEEN b.lon_min AND b.lon_max
  GROUP BY p.latitude, p.longitude
)
"""

HOLIDAYS = """
holidays AS (
  SELECT make_date(y, m, d) AS date, n AS name
  FROM (VALUES (2024), (2025), (2026), (2027)) AS years(y), (VALUES
    (1, 1, 'New Year'), (1, 6, 'Epiphany'), (5, 1, 'Labour Day'), (5, 2, 'Community Day'),
    (8, 15, 'Assumption'), (10, 12, 'National Day'), (11, 1, 'All Saints'),
    (11, 9, 'Almudena'), (12, 6, 'Constitution Day'), (12, 8, 'Immaculate Conception'),
    (12, 25, 'Christmas')) AS fixed(m, d, n)
  UNION ALL
  SELECT e::DATE - days, n
  FROM (VALUES ('2024-03-31'), ('2025-04-20'), ('2026-04-05'), ('2027-03-28')) AS easter(e),
       (VALUES (3, 'Holy Thursday'), (2, 'Good Friday')) AS rel(days, n)
)
"""


def features(source: str, prefix: str = "") -> str:
    """CTEs from ``source`` (one row per key and slot) to ``<prefix>feat``."""
    p = prefix
    return f"""
{p}tmp AS (
  SELECT *, {LOCAL} AS loc, snapshot_timestamp::DATE AS d,
         dock_bikes::DOUBLE AS v
  FROM {source}
),
{p}cal AS (
  SELECT *, extract('hour' FROM loc)::INT AS hour_of_day,
    (isodow(loc) - 1)::INT AS day_of_week,
    isodow(loc) >= 6 AS is_weekend,
    extract('month' FROM loc)::INT AS month,
    (extract('hour' FROM loc) * 60 + extract('minute' FROM loc))::INT AS minutes_since_midnight,
    loc::DATE IN (SELECT date FROM holidays) AS is_holiday
  FROM {p}tmp
),
{p}lagged AS (
  SELECT *, lag(v, 1) OVER w AS dock_bikes_lag_15m, lag(v, 2) OVER w AS dock_bikes_lag_30m,
    lag(v, 4) OVER w AS dock_bikes_lag_1h, lead(v, 4) OVER w AS target_dock_bikes_1h,
    v - lag(v, 1) OVER w AS delta_dock_15m,
    NOT is_weekend AND (minutes_since_midnight BETWEEN 420 AND 570
                        OR minutes_since_midnight BETWEEN 1020 AND 1199) AS is_rush_hour
  FROM {p}cal WINDOW w AS (PARTITION BY station_id ORDER BY snapshot_timestamp)
),
{p}h AS (
  SELECT station_id, d, hour_of_day,
    avg(m) OVER w AS avg_dock_same_hour_7d, stddev_samp(m) OVER w AS std_dock_same_hour_7d
  FROM (SELECT station_id, d, hour_of_day, avg(v) AS m FROM {p}lagged GROUP BY ALL)
  WINDOW w AS (PARTITION BY station_id, hour_of_day ORDER BY d
               ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
),
{p}wd AS (
  SELECT station_id, d, day_of_week, hour_of_day, avg(m) OVER w AS avg_dock_same_weekday
  FROM (SELECT station_id, d, day_of_week, hour_of_day, avg(v) AS m FROM {p}lagged GROUP BY ALL)
  WINDOW w AS (PARTITION BY station_id, day_of_week, hour_of_day ORDER BY d
               ROWS BETWEEN 10000 PRECEDING AND 1 PRECEDING)
),
{p}t AS (
  SELECT station_id, d, avg(c) OVER w AS station_daily_turnover
  FROM (SELECT station_id, d, coalesce(sum(abs(delta_dock_15m)), 0) AS c
        FROM {p}lagged GROUP BY ALL)
  WINDOW w AS (PARTITION BY station_id ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
),
{p}feat AS (
  SELECT l.station_id, l.snapshot_timestamp, l.station_number, l.station_name, l.activate,
    l.no_available, l.total_bases, l.dock_bikes, l.free_bases, l.longitude, l.latitude,
    l.temperature_2m, l.apparent_temperature, l.precipitation, l.precipitation_probability,
    l.wind_speed_10m, l.weather_code, l.is_day <> 0 AS is_day, l.direct_radiation,
    l.dock_bikes AS dock_bikes_now, l.free_bases AS free_bases_now,
    l.v / nullif(l.total_bases, 0) AS occupancy_rate_now,
    l.hour_of_day, l.day_of_week, l.is_weekend, l.month, l.minutes_since_midnight, l.is_holiday,
    l.is_rush_hour, l.precipitation AS precipitation_mm, l.precipitation > 0 AS is_raining,
    l.apparent_temperature < 8 AS feels_cold, l.apparent_temperature > 30 AS feels_hot,
    l.direct_radiation > 400 AS high_solar_radiation, s.distrito,
    l.dock_bikes_lag_15m, l.dock_bikes_lag_30m, l.dock_bikes_lag_1h, l.delta_dock_15m,
    round({p}h.avg_dock_same_hour_7d, 9) AS avg_dock_same_hour_7d,
    round({p}h.std_dock_same_hour_7d, 9) AS std_dock_same_hour_7d,
    round({p}wd.avg_dock_same_weekday, 9) AS avg_dock_same_weekday,
    round({p}t.station_daily_turnover, 9) AS station_daily_turnover,
    w.v AS dock_bikes_same_time_1w, l.target_dock_bikes_1h, l.d, l.loc::DATE AS local_date
  FROM {p}lagged l
  LEFT JOIN {p}h ON {p}h.station_id = l.station_id AND {p}h.d = l.d
       AND {p}h.hour_of_day = l.hour_of_day
  LEFT JOIN {p}wd ON {p}wd.station_id = l.station_id AND {p}wd.d = l.d
       AND {p}wd.day_of_week = l.day_of_week AND {p}wd.hour_of_day = l.hour_of_day
  LEFT JOIN {p}t ON {p}t.station_id = l.station_id AND {p}t.d = l.d
  LEFT JOIN {p}lagged w ON w.station_id = l.station_id
       AND w.snapshot_timestamp = l.snapshot_timestamp - INTERVAL '7 days'
  LEFT JOIN sites s ON s.latitude = l.latitude AND s.longitude = l.longitude
)
"""


BASE = f"WITH {RAW}"
FEATURES = f"WITH {RAW}, {BOXES}, {HOLIDAYS}, {features('snap')}"

ERRORS = """
pred AS (
  SELECT station_id, snapshot_timestamp AS prediction_made_at,
    snapshot_timestamp + INTERVAL '1 hour' AS target_time,
    dock_bikes::DOUBLE AS predicted_dock_bikes,
    CASE WHEN snapshot_timestamp < TIMESTAMP '2024-01-16' THEN 'v20240101_000000'
         ELSE 'v20240116_000000' END AS model_version
  FROM snap
),
pairs AS (
  SELECT p.*, s.dock_bikes AS observed_dock_bikes, p.predicted_dock_bikes - s.dock_bikes AS e
  FROM pred p JOIN snap s ON p.station_id = s.station_id AND p.target_time = s.snapshot_timestamp
),
cycles AS (
  SELECT target_time AS cycle_timestamp, max(model_version) AS model_version,
    count(*) AS n_predictions, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
    quantile_cont(abs(e), 0.5) AS p50_error, quantile_disc(abs(e), 0.9) AS p90_error,
    arg_max(station_id, abs(e) * 1000000 - station_id) AS worst_station_id,
    max(abs(e)) AS worst_station_error
  FROM pairs GROUP BY target_time
)
"""
MONITOR = f"WITH {RAW}, {ERRORS}"
CYCLE_COLUMNS = f"""cycle_timestamp, model_version, n_predictions, round(mae, 9) AS mae,
  round(rmse, 9) AS rmse, p50_error, p90_error, worst_station_id, worst_station_error,
  TIMESTAMP '{AS_OF}' AS reconciled_at"""

LIVE = """
live AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY raw_ts DESC, seq DESC) = 1
),
last_weather AS (SELECT * FROM raw ORDER BY raw_ts DESC, seq DESC LIMIT 1)
"""

# What keep-last over the raw rows of a date range gives, for the windows of jobs that
# read a part of the table.
def window_rows(name: str, first: str, last: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (raw_ts, seq) FROM raw
  WHERE activate = 1 AND snapshot_timestamp >= TIMESTAMP '{first}'
    AND snapshot_timestamp < TIMESTAMP '{last}' + INTERVAL '1 day'
  QUALIFY row_number() OVER (PARTITION BY station_id, snapshot_timestamp
                             ORDER BY raw_ts DESC, seq DESC) = 1
)
"""


WARMUP_START = "2024-01-03"
CURRENT_START = "2024-01-12"
DRIFT = f"""WITH {RAW}, {BOXES}, {HOLIDAYS},
{window_rows('ref_rows', REFERENCE_START, REFERENCE_END)}, {features('ref_rows', 'r_')},
{window_rows('cur_rows', CURRENT_START, TARGET_DATE)}, {features('cur_rows', 'c_')},
ref AS (SELECT * EXCLUDE (station_id, snapshot_timestamp, target_dock_bikes_1h, d, local_date)
        FROM r_feat),
cur AS (SELECT * EXCLUDE (station_id, snapshot_timestamp, target_dock_bikes_1h, d, local_date)
        FROM c_feat WHERE d = DATE '{TARGET_DATE}')
"""
TEXT_COLUMNS = (
    "station_number, station_name, is_day, is_weekend, is_holiday, is_rush_hour, is_raining, "
    "feels_cold, feels_hot, high_solar_radiation, distrito"
)
TEXT_CASTS = ", ".join(f"{c.strip()}::VARCHAR AS {c.strip()}" for c in TEXT_COLUMNS.split(","))
KS = f"""
long AS (
  SELECT feature, value, 1 AS r, 0 AS c FROM (
    UNPIVOT (SELECT COLUMNS(* EXCLUDE ({TEXT_COLUMNS}))::DOUBLE FROM ref)
    ON COLUMNS(*) INTO NAME feature VALUE value)
  UNION ALL
  SELECT feature, value, 0, 1 FROM (
    UNPIVOT (SELECT COLUMNS(* EXCLUDE ({TEXT_COLUMNS}))::DOUBLE FROM cur)
    ON COLUMNS(*) INTO NAME feature VALUE value)
),
running AS (
  SELECT feature, sum(r) OVER w AS r, sum(c) OVER w AS c,
    sum(r) OVER (PARTITION BY feature) AS n_reference,
    sum(c) OVER (PARTITION BY feature) AS n_current
  FROM long WINDOW w AS (PARTITION BY feature ORDER BY value)
),
ks AS (
  SELECT feature,
    max(abs(r / nullif(n_reference, 0)::DOUBLE - c / nullif(n_current, 0)::DOUBLE)) AS statistic,
    max(n_reference)::BIGINT AS n_reference, max(n_current)::BIGINT AS n_current
  FROM running GROUP BY feature
)
"""
CHI2 = f"""
cells AS (
  SELECT feature, value, sum(r) AS r, sum(c) AS c FROM (
    SELECT feature, value, 1 AS r, 0 AS c FROM (
      UNPIVOT (SELECT {TEXT_CASTS} FROM ref) ON COLUMNS(*) INTO NAME feature VALUE value)
    UNION ALL
    SELECT feature, value, 0, 1 FROM (
      UNPIVOT (SELECT {TEXT_CASTS} FROM cur) ON COLUMNS(*) INTO NAME feature VALUE value))
  GROUP BY ALL
),
totals AS (
  SELECT *, (sum(r) OVER f)::DOUBLE AS rt, (sum(c) OVER f)::DOUBLE AS ct FROM cells
  WINDOW f AS (PARTITION BY feature)
),
chi2 AS (
  SELECT feature,
    sum((r - (r + c) * rt / (rt + ct)) ** 2 / ((r + c) * rt / (rt + ct))
      + (c - (r + c) * ct / (rt + ct)) ** 2 / ((r + c) * ct / (rt + ct))) AS statistic,
    count(*) - 1 AS df, max(rt)::BIGINT AS n_reference, max(ct)::BIGINT AS n_current
  FROM totals GROUP BY feature
)
"""
# The Kolmogorov series, and one minus the power series of the incomplete gamma function.
SUMMARY = f"""{DRIFT}, {KS}, {CHI2},
ks_p AS (
  SELECT feature, statistic * sqrt(n_reference * n_current / (n_reference + n_current)::DOUBLE) AS x
  FROM ks
),
tested AS (
  SELECT feature, CASE WHEN x < 0.2 THEN 1.0 ELSE 2 * list_sum(list_transform(range(1, 101),
    lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * x * x))) END AS p
  FROM ks_p
  UNION ALL
  SELECT feature, CASE WHEN df = 0 OR statistic <= 0 THEN 1.0 ELSE 1 - list_sum(list_transform(
    range(0, 4000), lambda k: exp((df / 2.0 + k) * ln(statistic / 2) - statistic / 2
                                  - lgamma(df / 2.0 + k + 1)))) END
  FROM chi2
),
summary AS (
  SELECT DATE '{TARGET_DATE}' AS date, count(*) FILTER (p < 0.05) AS n_drifted_features,
    round(count(*) FILTER (p < 0.05) / 42::DOUBLE, 9) AS share_drifted,
    string_agg(feature, ',' ORDER BY feature) FILTER (p < 0.05) AS drifted_feature_names,
    (SELECT count(*) FROM ref) AS n_reference_rows, (SELECT count(*) FROM cur) AS n_current_rows
  FROM tested
)
"""

RULE = f"""{FEATURES},
scored AS (
  SELECT *, greatest(round_even(dock_bikes_now + 0.5::DOUBLE * coalesce(delta_dock_15m, 0), 0)::DOUBLE, 0)
    AS p, target_dock_bikes_1h AS y
  FROM feat WHERE target_dock_bikes_1h IS NOT NULL
)
"""


def _range_violation(column: str, low: int, high: int) -> str:
    return (
        f"SELECT '{column}' AS rule, count(*) FILTER (NOT {column} + weather_code - 1 BETWEEN {low} AND {high})"
        " AS violations FROM feat"
    )


def _catalog() -> str:
    from slotwise.schemas import FEATURES as catalog

    return "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{f.name}' AS feature, '{f.dtype}' AS dtype, "
        f"'{f.group}' AS feature_group, '{f.description}' AS description, count({f.name}) AS n_present FROM feat"
        for i, f in enumerate(catalog)
    )


def _group(group: str) -> str:
    from slotwise.schemas import features_by_group

    return ", ".join(f.name for f in features_by_group(group))


DAILY = """daily AS (
  SELECT target_time::DATE AS date, station_id, model_version, count(*) AS n_cycles,
    avg(abs(e)) AS daily_mae, sqrt(avg(e * e)) AS daily_rmse
  FROM pairs GROUP BY ALL
)"""
DAILY_COLUMNS = "round(daily_mae, 9) AS daily_mae, round(daily_rmse, 9) AS daily_rmse"
TOTALS = f"""{MONITOR}, totals AS (
  SELECT target_time::DATE AS date, model_version, count(DISTINCT station_id) AS n_stations,
    count(*) AS n_cycles, avg(abs(e)) AS daily_mae, sqrt(avg(e * e)) AS daily_rmse
  FROM pairs GROUP BY ALL
)"""
LATEST = f"""{MONITOR}, latest AS (
  SELECT * FROM pred
  WHERE prediction_made_at::DATE = (SELECT max(prediction_made_at)::DATE FROM pred)
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY prediction_made_at DESC) = 1
)"""
DOC_ROWS = f"""{BASE},
doc_weather AS (
  SELECT {WEATHER}, snapshot_timestamp FROM snap
  QUALIFY row_number() OVER (PARTITION BY snapshot_timestamp ORDER BY station_id DESC) = 1
),
doc_rows AS (
  SELECT s.station_id, CASE WHEN s.no_available = 0 THEN s.station_number END AS station_number,
    s.station_name, s.activate, s.no_available, s.total_bases, s.dock_bikes, s.free_bases,
    s.longitude, s.latitude, w.* EXCLUDE (snapshot_timestamp), s.snapshot_timestamp,
    s.snapshot_timestamp AS raw_ts
  FROM snap s JOIN doc_weather w USING (snapshot_timestamp)
)
SELECT * FROM doc_rows"""
CLOSED = "(SELECT max(cycle_timestamp) FROM cycles) - INTERVAL '1 hour'"


ORACLE: dict[str, str] = {
    "snapshots_canonical": f"{BASE} SELECT * FROM raw",
    "snapshots_keep_last": f"{BASE} SELECT * FROM snap",
    "active_rows": f"""{BASE} SELECT station_id, count(*) AS n_training,
        nullif(count(*) FILTER (no_available = 0), 0) AS n_scoring
        FROM snap WHERE activate = 1 GROUP BY station_id""",
    "holiday_dim": f"""WITH {RAW}, {HOLIDAYS}
        SELECT date, name, (SELECT count(*) FROM raw WHERE ({LOCAL})::DATE = h.date) AS n_snapshots
        FROM holidays h""",
    "holiday_flag": f"""{FEATURES} SELECT local_date, is_holiday, count(*) AS n_rows
        FROM feat GROUP BY ALL""",
    "partition_paths": f"""{BASE}
        SELECT strftime(snapshot_timestamp, 'dt=%Y-%m-%d/hh=%H/mm=%M') AS path,
          strftime(snapshot_timestamp, 'v%Y%m%d_%H%M%S') AS version, count(*) AS n_rows
        FROM raw GROUP BY ALL""",
    "feature_catalog_group": f"{FEATURES} {_catalog()}",
    "feature_range_violations": FEATURES
    + " UNION ALL ".join(
        [
            _range_violation("hour_of_day", 0, 23),
            _range_violation("day_of_week", 0, 6),
            _range_violation("month", 1, 12),
            _range_violation("minutes_since_midnight", 0, 1439),
        ]
    ),
    "data_profile": f"""{BASE} SELECT count(*) AS n_rows, count(DISTINCT station_id) AS n_stations,
        min(snapshot_timestamp) AS first_slot, max(snapshot_timestamp) AS last_slot FROM snap""",
    "station_sample": f"""{BASE} SELECT * FROM snap WHERE station_id IN (
        SELECT station_id FROM (SELECT DISTINCT station_id FROM snap)
        ORDER BY md5(station_id::VARCHAR || ':42'), station_id LIMIT 100)""",
    "retention_keep": f"""{BASE} SELECT raw_ts::DATE AS dt, count(*) AS n_rows FROM raw
        WHERE raw_ts::DATE >= DATE '{AS_OF[:10]}' - 7 GROUP BY ALL""",
    "lag_features": f"""{FEATURES} SELECT station_id, snapshot_timestamp, {_group('lag')}
        FROM feat""",
    "lag_features_by_time": f"""{BASE}
        SELECT a.station_id, a.snapshot_timestamp, b.dock_bikes::DOUBLE AS dock_bikes_lag_15m,
          c.dock_bikes::DOUBLE AS dock_bikes_lag_30m, d.dock_bikes::DOUBLE AS dock_bikes_lag_1h,
          (a.dock_bikes - b.dock_bikes)::DOUBLE AS delta_dock_15m
        FROM snap a
        LEFT JOIN snap b ON a.station_id = b.station_id
          AND b.snapshot_timestamp = a.snapshot_timestamp - INTERVAL '15 minutes'
        LEFT JOIN snap c ON a.station_id = c.station_id
          AND c.snapshot_timestamp = a.snapshot_timestamp - INTERVAL '30 minutes'
        LEFT JOIN snap d ON a.station_id = d.station_id
          AND d.snapshot_timestamp = a.snapshot_timestamp - INTERVAL '60 minutes'""",
    "temporal_features": f"""{FEATURES} SELECT station_id, snapshot_timestamp,
        {_group('temporal')} FROM feat""",
    "weather_features": f"""{FEATURES} SELECT station_id, snapshot_timestamp,
        {_group('meteo')} FROM feat""",
    "district_first_match": f"""WITH {RAW}, {BOXES}
        SELECT s.station_id, s.snapshot_timestamp, s.latitude, s.longitude, t.distrito
        FROM snap s LEFT JOIN sites t USING (latitude, longitude)""",
    "district_box_join": f"WITH {RAW}, {BOXES} SELECT * FROM sites",
    "hour_stats_7d": f"""{FEATURES} SELECT station_id, d AS utc_date, hour_of_day,
        round(avg_dock_same_hour_7d, 9) AS avg_dock_same_hour_7d,
        round(std_dock_same_hour_7d, 9) AS std_dock_same_hour_7d FROM h""",
    "weekday_expanding_mean": f"""{FEATURES} SELECT station_id, d AS utc_date, day_of_week,
        hour_of_day, round(avg_dock_same_weekday, 9) AS avg_dock_same_weekday FROM wd""",
    "daily_turnover": f"""{FEATURES} SELECT station_id, d AS utc_date,
        round(station_daily_turnover, 9) AS station_daily_turnover FROM t""",
    "same_time_last_week": f"""{BASE} SELECT a.station_id, a.snapshot_timestamp,
        b.dock_bikes::DOUBLE AS dock_bikes_same_time_1w
        FROM snap a LEFT JOIN snap b ON a.station_id = b.station_id
          AND b.snapshot_timestamp = a.snapshot_timestamp - INTERVAL '7 days'""",
    "historical_features": f"""{FEATURES} SELECT station_id, snapshot_timestamp,
        {_group('stats')} FROM feat""",
    "target_1h": f"""{BASE} SELECT station_id, snapshot_timestamp, dock_bikes,
        lead(dock_bikes::DOUBLE, 4) OVER (PARTITION BY station_id ORDER BY snapshot_timestamp)
          AS target_dock_bikes_1h FROM snap""",
    "all_features": f"{FEATURES} SELECT * EXCLUDE (d, local_date) FROM feat",
    "training_dataset": f"""WITH {RAW}, {BOXES}, {HOLIDAYS},
        {window_rows('part', WARMUP_START, TRAINING_END)}, {features('part')}
        SELECT * EXCLUDE (d, local_date) FROM feat
        WHERE target_dock_bikes_1h IS NOT NULL
          AND snapshot_timestamp >= TIMESTAMP '{TRAINING_START}'""",
    "temporal_split_counts": f"""{BASE}, cut AS (SELECT max(snapshot_timestamp) AS t FROM snap)
        SELECT CASE WHEN snapshot_timestamp >= t - INTERVAL '1 day' THEN 'test'
                    WHEN snapshot_timestamp >= t - INTERVAL '2 days' THEN 'val'
                    ELSE 'train' END AS split,
          count(*) AS n_rows, min(snapshot_timestamp) AS first_slot,
          max(snapshot_timestamp) AS last_slot
        FROM snap, cut GROUP BY 1""",
    "naive_baseline": f"""{FEATURES} SELECT count(*) AS n,
        round(avg(abs(dock_bikes_now - target_dock_bikes_1h)), 9) AS mae,
        round(sqrt(avg((dock_bikes_now - target_dock_bikes_1h) ** 2)), 9) AS rmse
        FROM feat WHERE target_dock_bikes_1h IS NOT NULL""",
    "naive_baseline_by_station": f"""{FEATURES} SELECT station_id, count(*) AS n,
        round(avg(abs(dock_bikes_now - target_dock_bikes_1h)), 9) AS mae,
        round(sqrt(avg((dock_bikes_now - target_dock_bikes_1h) ** 2)), 9) AS rmse
        FROM feat WHERE target_dock_bikes_1h IS NOT NULL GROUP BY station_id""",
    "evaluate_metrics": f"""{RULE}, m AS (SELECT avg(y) AS my FROM scored)
        SELECT round(avg(abs(p - y)), 9) AS mae, round(sqrt(avg((p - y) ** 2)), 9) AS rmse,
          round(avg(abs(p - y)) / avg(y), 9) AS mae_normalized,
          round(1 - sum((p - y) ** 2) / sum((y - my) ** 2), 9) AS r2,
          round(avg(abs(dock_bikes_now - y)), 9) AS baseline_mae,
          round(sqrt(avg((dock_bikes_now - y) ** 2)), 9) AS baseline_rmse,
          round((avg(abs(dock_bikes_now - y)) - avg(abs(p - y)))
                / avg(abs(dock_bikes_now - y)) * 100, 9) AS improvement_pct,
          count(*)::DOUBLE AS n_rows
        FROM scored, m""",
    "critical_states": f"""{RULE}
        SELECT round(coalesce(count(*) FILTER (y < 2 AND p < 2)
                 / nullif(count(*) FILTER (p < 2), 0)::DOUBLE, 0), 9) AS empty_precision,
          round(coalesce(count(*) FILTER (y < 2 AND p < 2)
                 / nullif(count(*) FILTER (y < 2), 0)::DOUBLE, 0), 9) AS empty_recall,
          round(coalesce(count(*) FILTER (y > total_bases - 2 AND p > total_bases - 2)
                 / nullif(count(*) FILTER (p > total_bases - 2), 0)::DOUBLE, 0), 9) AS full_precision,
          round(coalesce(count(*) FILTER (y > total_bases - 2 AND p > total_bases - 2)
                 / nullif(count(*) FILTER (y > total_bases - 2), 0)::DOUBLE, 0), 9) AS full_recall,
          (count(*) FILTER (y < 2))::DOUBLE AS n_empty_actual,
          (count(*) FILTER (y > total_bases - 2))::DOUBLE AS n_full_actual
        FROM scored""",
    "latest_predictions": f"{LATEST} SELECT * FROM latest",
    "latest_prediction_of_station": f"{LATEST} SELECT * FROM latest WHERE station_id = 3",
    "latest_batch_health": f"""{LATEST} SELECT count(*) AS predictions_available,
        max(prediction_made_at) AS latest_snapshot FROM latest""",
    "predictions_for_target_time": f"""{MONITOR} SELECT * FROM pred
        WHERE target_time = TIMESTAMP '{TARGET_DATE} 12:00:00'""",
    "prediction_lookup": f"{MONITOR} SELECT * EXCLUDE (e) FROM pairs",
    "cycle_metrics": f"{MONITOR} SELECT {CYCLE_COLUMNS} FROM cycles",
    "reconcile_one_cycle": f"""{MONITOR} SELECT {CYCLE_COLUMNS} FROM cycles
        WHERE cycle_timestamp = (SELECT min(cycle_timestamp) FROM cycles)""",
    "station_daily_metrics": f"""{MONITOR}, {DAILY}
        SELECT date, station_id, model_version, n_cycles, {DAILY_COLUMNS} FROM daily""",
    "station_daily_metrics_raw": f"""{MONITOR}
        SELECT p.target_time::DATE AS date, p.station_id, p.model_version, count(*) AS n_cycles,
          round(avg(abs(p.predicted_dock_bikes - r.dock_bikes)), 9) AS daily_mae,
          round(sqrt(avg((p.predicted_dock_bikes - r.dock_bikes) ** 2)), 9) AS daily_rmse
        FROM pred p JOIN raw r ON p.station_id = r.station_id
          AND p.target_time = r.snapshot_timestamp
        GROUP BY ALL""",
    "daily_totals": f"""{TOTALS} SELECT date, model_version, n_stations, n_cycles,
        {DAILY_COLUMNS} FROM totals""",
    "recent_daily_totals": f"""{TOTALS} SELECT date, model_version, n_stations, n_cycles,
        {DAILY_COLUMNS} FROM totals
        QUALIFY row_number() OVER (PARTITION BY date ORDER BY model_version DESC) = 1
        ORDER BY date DESC LIMIT 3""",
    "online_mae_view": f"""{MONITOR} SELECT cycle_timestamp::DATE AS prediction_date, model_version,
          count(*) AS n_cycles, sum(n_predictions)::BIGINT AS total_predictions,
          round(sum(mae * n_predictions) / sum(n_predictions), 9) AS mae,
          round(sqrt(sum(rmse * rmse * n_predictions) / sum(n_predictions)), 9) AS rmse,
          round(avg(p50_error), 9) AS avg_p50_error, max(p90_error) AS max_p90_error,
          max(worst_station_error) AS max_station_error
        FROM cycles GROUP BY ALL""",
    "cycle_mae_by_day": f"""{MONITOR} SELECT cycle_timestamp::DATE AS day,
          round(avg(mae), 9) AS avg_mae
        FROM cycles WHERE cycle_timestamp BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL '7 days'
          AND TIMESTAMP '{AS_OF}' GROUP BY ALL""",
    "top10_worst_stations": f"""{MONITOR}, {DAILY}
        SELECT station_id, model_version, {DAILY_COLUMNS}, n_cycles FROM daily
        WHERE date = DATE '{TARGET_DATE}'
        ORDER BY daily.daily_mae DESC, station_id, model_version DESC LIMIT 10""",
    "performance_alert": f"""WITH {RAW}, {ERRORS},
        tgt AS (SELECT dock_bikes - lead(dock_bikes, 4) OVER (PARTITION BY station_id
                  ORDER BY snapshot_timestamp) AS e FROM snap),
        a AS (SELECT (SELECT avg(abs(e)) FROM tgt) AS training_mae,
                (SELECT avg(mae) FROM cycles
                 WHERE cycle_timestamp BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL '24 hours'
                   AND TIMESTAMP '{AS_OF}') AS online_mae)
        SELECT round(online_mae, 9) AS online_mae, round(training_mae, 9) AS training_mae,
          round(training_mae * 1.2::DOUBLE, 9) AS threshold,
          coalesce(training_mae > 0 AND online_mae > training_mae * 1.2::DOUBLE, false) AS fired
        FROM a""",
    "table_freshness": f"""{MONITOR} SELECT count(*) AS n_rows, max(prediction_made_at) AS latest
        FROM pred""",
    "skipped_stations": f"""WITH {RAW}, {LIVE} SELECT station_id FROM live
        WHERE NOT (activate = 1 AND no_available = 0)""",
    "scoring_frame": f"""WITH {RAW}, {LIVE}
        SELECT l.* EXCLUDE ({WEATHER}, snapshot_timestamp, raw_ts, seq),
          w.* EXCLUDE (station_id, station_number, station_name, activate, no_available,
            total_bases, dock_bikes, free_bases, longitude, latitude, snapshot_timestamp,
            raw_ts, seq),
          TIMESTAMP '{AS_OF}' AS snapshot_timestamp
        FROM live l, last_weather w""",
    "scoring_frame_without_weather": f"""WITH {RAW}, {LIVE}
        SELECT l.* EXCLUDE ({WEATHER}, snapshot_timestamp, raw_ts, seq),
          0.0::DOUBLE AS temperature_2m, 0.0::DOUBLE AS apparent_temperature,
          0.0::DOUBLE AS precipitation, 0.0::DOUBLE AS precipitation_probability,
          0.0::DOUBLE AS wind_speed_10m, 0 AS weather_code, 0 AS is_day,
          0.0::DOUBLE AS direct_radiation, TIMESTAMP '{AS_OF}' AS snapshot_timestamp
        FROM live l""",
    "attach_cycle": f"""WITH {RAW}, {LIVE}
        SELECT l.station_id AS id, l.dock_bikes, l.latitude,
          TIMESTAMP '{AS_OF}' AS ingestion_timestamp,
          w.snapshot_timestamp AS weather_timestamp, w.temperature_2m
        FROM live l, last_weather w""",
    "union_history": f"""WITH {RAW}, {LIVE},
        ok AS (SELECT * FROM live WHERE activate = 1 AND no_available = 0)
        SELECT station_id, snapshot_timestamp, dock_bikes, temperature_2m, weather_code FROM snap
        WHERE snapshot_timestamp < TIMESTAMP '{AS_OF}' AND station_id IN (SELECT station_id FROM ok)
        UNION ALL
        SELECT station_id, TIMESTAMP '{AS_OF}', dock_bikes, NULL, NULL FROM ok""",
    "scoring_feature_rows": f"""WITH {RAW}, {BOXES}, {HOLIDAYS}, {LIVE},
        ok AS (SELECT * FROM live WHERE activate = 1 AND no_available = 0),
        part AS (
          SELECT * FROM snap WHERE snapshot_timestamp < TIMESTAMP '{AS_OF}'
            AND snapshot_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL '8 days'
            AND station_id IN (SELECT station_id FROM ok)
          UNION ALL BY NAME
          SELECT * EXCLUDE (raw_ts, seq) REPLACE (TIMESTAMP '{AS_OF}' AS snapshot_timestamp)
          FROM ok
        ), {features('part')}
        SELECT station_id, snapshot_timestamp, dock_bikes_now, dock_bikes_lag_15m,
          dock_bikes_lag_30m, dock_bikes_lag_1h, {_group('stats')}
        FROM feat WHERE snapshot_timestamp = TIMESTAMP '{AS_OF}'""",
    "raw_json_roundtrip": DOC_ROWS,
    "contract_rejects": f"""{BASE} SELECT snapshot_timestamp AS ingestion_timestamp,
          CASE WHEN extract('minute' FROM snapshot_timestamp) = 45 THEN '90' ELSE '00' END AS code,
          count(*) AS n_stations
        FROM snap GROUP BY ALL
        HAVING extract('minute' FROM snapshot_timestamp) = 45 OR max(no_available) = 1""",
    "forecast_current_hour": f"""{BASE}, hourly AS (
          SELECT station_id, date_trunc('hour', snapshot_timestamp) AS hr, {WEATHER} FROM snap
          QUALIFY row_number() OVER (PARTITION BY station_id, date_trunc('hour', snapshot_timestamp)
                                     ORDER BY snapshot_timestamp DESC) = 1
        )
        SELECT station_id, hr::DATE AS day, hr AS timestamp, {WEATHER} FROM hourly
        QUALIFY row_number() OVER (PARTITION BY station_id, hr::DATE
          ORDER BY (extract('hour' FROM hr) = 12)::INT DESC, hr DESC) = 1""",
    "forecast_hours": f"""{BASE} SELECT station_id, snapshot_timestamp AS time, {WEATHER}
        FROM snap""",
    "snapshot_table_scan": f"""{BASE} SELECT * EXCLUDE (seq) FROM raw WHERE activate = 1
        AND raw_ts::DATE BETWEEN DATE '{TRAINING_START}' AND DATE '{TRAINING_END}'""",
    "partition_replace": f"""{MONITOR}, {DAILY}
        SELECT date, station_id, model_version,
          CASE WHEN date >= DATE '{TARGET_DATE}' THEN n_cycles * 10 ELSE n_cycles END AS n_cycles,
          {DAILY_COLUMNS} FROM daily""",
    "ks_drift": f"""{DRIFT}, {KS}
        SELECT feature, round(statistic, 9) AS statistic, n_reference, n_current FROM ks""",
    "chi2_drift": f"""{DRIFT}, {CHI2}
        SELECT feature, round(statistic, 9) AS statistic, df, n_reference, n_current FROM chi2""",
    "drift_summary": f"{SUMMARY} SELECT * FROM summary",
    "drift_alert": f"""{SUMMARY} SELECT date, n_drifted_features, share_drifted FROM summary
        WHERE share_drifted > 0.10""",
    # Documents that break the contract are not stored.
    "stream_ingest": f"""{DOC_ROWS} WHERE snapshot_timestamp IN (
        SELECT snapshot_timestamp FROM snap GROUP BY ALL
        HAVING extract('minute' FROM snapshot_timestamp) <> 45 AND max(no_available) = 0)""",
    "stream_dedup": f"{BASE} SELECT DISTINCT station_id, snapshot_timestamp FROM raw",
    "stream_reconcile": f"""{MONITOR} SELECT cycle_timestamp AS target_time, n_predictions,
        round(mae, 9) AS mae, round(rmse, 9) AS rmse FROM cycles""",
    # Only windows the watermark has closed are emitted.
    "stream_error_windows": f"""{MONITOR}
        SELECT * FROM (
          SELECT date_trunc('day', cycle_timestamp)::TIMESTAMP AS window_start,
            (date_trunc('day', cycle_timestamp) + INTERVAL '1 day')::TIMESTAMP AS window_end,
            count(*) AS n_cycles, round(avg(mae), 9) AS avg_mae
          FROM cycles GROUP BY 1, 2)
        WHERE window_end <= {CLOSED}""",
    "stream_sliding_mae": f"""{MONITOR}, ends AS (
          SELECT DISTINCT cycle_timestamp + i * INTERVAL '15 minutes' AS window_end
          FROM cycles, range(1, 97) AS r(i)
        )
        SELECT w.window_end - INTERVAL '24 hours' AS window_start, w.window_end,
          count(*) AS n_cycles, round(avg(c.mae), 9) AS avg_mae
        FROM ends w JOIN cycles c ON c.cycle_timestamp >= w.window_end - INTERVAL '24 hours'
          AND c.cycle_timestamp < w.window_end
        WHERE w.window_end <= {CLOSED} GROUP BY ALL""",
}

# Other ways to the same rows.
ORACLE["scoring_slot_rows"] = ORACLE["scoring_feature_rows"]
ORACLE["latest_stored_predictions"] = ORACLE["latest_predictions"]
ORACLE["latest_stored_of_station"] = ORACLE["latest_prediction_of_station"]
ORACLE["stored_batch_health"] = ORACLE["latest_batch_health"]
ORACLE["stream_reconcile_cycles"] = ORACLE["cycle_metrics"]
ORACLE["guarded_append"] = f"""{MONITOR},
  early AS (SELECT count(*) AS n FROM pred WHERE prediction_made_at < TIMESTAMP '{TARGET_DATE} 00:00:00')
SELECT model_version, count(*) AS n_rows, (SELECT n FROM early) AS n_first, (SELECT n FROM early) AS n_refused,
  (SELECT count(*) FROM pred) - (SELECT n FROM early) AS n_added, 0::BIGINT AS n_again
FROM pred GROUP BY model_version"""
ORACLE["dashboard"] = f"""{MONITOR}, {DAILY}
SELECT 'mae' AS panel, (cycle_timestamp::DATE)::VARCHAR AS item, round(avg(mae), 9) AS value FROM cycles
WHERE cycle_timestamp BETWEEN TIMESTAMP '{TARGET_DATE} 23:59:59.999999' - INTERVAL '7 days'
  AND TIMESTAMP '{TARGET_DATE} 23:59:59.999999' GROUP BY cycle_timestamp::DATE
UNION ALL
SELECT * FROM (
  SELECT 'worst', station_id::VARCHAR, round(daily_mae, 9) FROM daily WHERE date = DATE '{TARGET_DATE}'
  ORDER BY daily_mae DESC, station_id, model_version DESC LIMIT 3)"""
