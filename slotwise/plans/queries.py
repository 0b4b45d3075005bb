"""Every registered query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas
from slotwise.config import SERIES
from slotwise.functions import holidays, time
from slotwise.ml import model as trees
from slotwise.ml import registry
from slotwise.ml.scoring import score, scoring_features, slot_features
from slotwise.operators import drift, features, metrics, monitoring, quality, rows, split
from slotwise.plans import canonical, training
from slotwise.plans.canonical import AS_OF, TARGET_DATE
from slotwise.session import materialise, scratch_dir, tune
from slotwise.sources import sinks, tables, weather
from slotwise.sources import snapshots as source
from slotwise.streaming import cycle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ("station_id", "snapshot_timestamp")
STATS = (
    "avg_dock_same_hour_7d",
    "std_dock_same_hour_7d",
    "avg_dock_same_weekday",
    "station_daily_turnover",
)
RUNS: dict[tuple[str, str], dict] = {}  # one training run per session and input serves all queries that score with it


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values, which compare alike in every engine."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(query(tune(spark), sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return query


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """Sums of fractions depend on their order; rounding makes them comparable. Nine digits,
    because the means here can end in a five at the seventh."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- snapshots, calendar, filters -----------------------------------------------------


@register
def snapshots_canonical(spark, sf_dir):
    return canonical.raw_snapshots(spark, sf_dir)


@register
def snapshots_keep_last(spark, sf_dir):
    return canonical.snapshots(spark, sf_dir)


@register
def active_rows(spark, sf_dir):
    """Rows that count for training and for scoring, per station."""
    df = canonical.snapshots(spark, sf_dir)
    for_training = rows.active_for_training(df).groupBy("station_id").agg(
        F.count("*").alias("n_training")
    )
    for_scoring = rows.active_for_scoring(df).groupBy("station_id").agg(
        F.count("*").alias("n_scoring")
    )
    return for_training.join(for_scoring, "station_id", "left")


@register
def holiday_dim(spark, sf_dir):
    """The holiday dimension with the snapshots that fall on each day."""
    local = F.to_date(time.to_local(F.col("snapshot_timestamp")))
    per_day = (
        canonical.raw_snapshots(spark, sf_dir)
        .groupBy(local.alias("date"))
        .agg(F.count("*").alias("n_snapshots"))
    )
    return (
        holidays.holiday_dim(spark)
        .join(per_day, "date", "left")
        .select("date", "name", F.coalesce("n_snapshots", F.lit(0)).alias("n_snapshots"))
    )


@register
def holiday_flag(spark, sf_dir):
    local = F.to_date(time.to_local(F.col("snapshot_timestamp")))
    df = features.temporal_features(canonical.snapshots(spark, sf_dir))
    return df.groupBy(local.alias("local_date"), "is_holiday").agg(F.count("*").alias("n_rows"))


@register
def partition_paths(spark, sf_dir):
    """Archive path and version name of every slot that has data."""
    ts = F.col("snapshot_timestamp")
    df = canonical.raw_snapshots(spark, sf_dir)
    return df.groupBy(
        time.partition_path(ts).alias("path"), time.version_name(ts).alias("version")
    ).agg(F.count("*").alias("n_rows"))


@register
def feature_catalog_group(spark, sf_dir):
    """The catalog with the number of present values of each feature."""
    df = features.all_features(canonical.raw_snapshots(spark, sf_dir))
    counts = df.agg(*[F.count(c).alias(c) for c in schemas.FEATURE_NAMES])
    present = counts.unpivot([], list(schemas.FEATURE_NAMES), "feature", "n_present")
    return schemas.feature_catalog(spark).join(present, "feature")


@register
def feature_range_violations(spark, sf_dir):
    """Calendar features moved by up to two, so that some leave their ranges."""
    df = features.temporal_features(canonical.snapshots(spark, sf_dir))
    moved = {c: F.col(c) + F.col("weather_code") - 1 for c in quality.RANGES}
    return quality.range_violations(df.withColumns(moved))


@register
def data_profile(spark, sf_dir):
    return split.data_profile(canonical.snapshots(spark, sf_dir))


@register
def station_sample(spark, sf_dir):
    return rows.sample_series(canonical.snapshots(spark, sf_dir))


@register
def retention_keep(spark, sf_dir):
    """Rows per day that a seven-day retention keeps."""
    df = canonical.raw_snapshots(spark, sf_dir).withColumn("dt", F.to_date("raw_ts"))
    kept = sinks.retained(df, date.fromisoformat(AS_OF[:10]), days=7)
    return kept.groupBy("dt").agg(F.count("*").alias("n_rows"))


# --- features -------------------------------------------------------------------------


@register
def lag_features(spark, sf_dir):
    df = features.lag_features(canonical.snapshots(spark, sf_dir))
    return df.select(*KEY, *[f.name for f in schemas.features_by_group("lag")])


@register
def lag_features_by_time(spark, sf_dir):
    """Lags by slot distance instead of by row."""
    df = features.lag_features(canonical.snapshots(spark, sf_dir), mode="time")
    return df.select(*KEY, *features.LAGS, "delta_dock_15m")


@register
def temporal_features(spark, sf_dir):
    df = features.temporal_features(canonical.snapshots(spark, sf_dir))
    return df.select(*KEY, *[f.name for f in schemas.features_by_group("temporal")])


@register
def weather_features(spark, sf_dir):
    df = features.weather_features(canonical.snapshots(spark, sf_dir))
    return df.select(*KEY, *[f.name for f in schemas.features_by_group("meteo")])


@register
def district_first_match(spark, sf_dir):
    df = features.station_features(canonical.snapshots(spark, sf_dir))
    return df.select(*KEY, "latitude", "longitude", "distrito")


@register
def district_box_join(spark, sf_dir):
    """The same lookup against the box table, per distinct position."""
    boxes = schemas.district_boxes(spark)
    return features.first_box_join(canonical.raw_snapshots(spark, sf_dir), boxes)


@register
def hour_stats_7d(spark, sf_dir):
    df = features.temporal_features(canonical.snapshots(spark, sf_dir))
    return rounded(features.hour_stats(df), *STATS[:2]).withColumnRenamed("_date", "utc_date")


@register
def weekday_expanding_mean(spark, sf_dir):
    df = features.temporal_features(canonical.snapshots(spark, sf_dir))
    return rounded(features.weekday_stats(df), STATS[2]).withColumnRenamed("_date", "utc_date")


@register
def daily_turnover(spark, sf_dir):
    df = canonical.snapshots(spark, sf_dir)
    return rounded(features.daily_turnover(df), STATS[3]).withColumnRenamed("_date", "utc_date")


@register
def same_time_last_week(spark, sf_dir):
    df = features.same_time_last_week(canonical.snapshots(spark, sf_dir))
    return df.select(*KEY, "dock_bikes_same_time_1w")


@register
def historical_features(spark, sf_dir):
    df = features.temporal_features(canonical.snapshots(spark, sf_dir))
    df = features.historical_features(df)
    return rounded(df.select(*KEY, *STATS, "dock_bikes_same_time_1w"), *STATS)


@register
def target_1h(spark, sf_dir):
    df = features.add_target(canonical.snapshots(spark, sf_dir))
    return df.select(*KEY, "dock_bikes", SERIES.target)


@register
def all_features(spark, sf_dir):
    return rounded(features.all_features(canonical.raw_snapshots(spark, sf_dir)), *STATS)


@register
def training_dataset(spark, sf_dir):
    df = training.training_dataset(
        canonical.raw_snapshots(spark, sf_dir),
        canonical.TRAINING_START,
        canonical.TRAINING_END,
    )
    return rounded(df, *STATS)


@register
def temporal_split_counts(spark, sf_dir):
    return split.split_profile(canonical.snapshots(spark, sf_dir))


# --- baseline and evaluation ----------------------------------------------------------


def _with_target(spark, sf_dir):
    return features.add_target(features.current_state(canonical.snapshots(spark, sf_dir)))


def _rule_scored(spark, sf_dir):
    """Half of the last change carried forward; the halves exercise even rounding."""
    df = features.add_target(features.lag_features(canonical.snapshots(spark, sf_dir)))
    trend = F.coalesce("delta_dock_15m", F.lit(0.0)) * 0.5
    return df.withColumn("prediction", F.col("dock_bikes_now") + trend)


@register
def naive_baseline(spark, sf_dir):
    return rounded(metrics.naive_baseline(_with_target(spark, sf_dir)), "mae", "rmse")


@register
def naive_baseline_by_station(spark, sf_dir):
    df = metrics.naive_baseline(_with_target(spark, sf_dir), ("station_id",))
    return rounded(df, "mae", "rmse")


@register
def evaluate_metrics(spark, sf_dir):
    df = metrics.evaluate(_rule_scored(spark, sf_dir))
    return rounded(df, *[c for c in df.columns if c != "n_rows"])


@register
def critical_states(spark, sf_dir):
    df = metrics.critical_states(_rule_scored(spark, sf_dir))
    return rounded(df, "empty_precision", "empty_recall", "full_precision", "full_recall")


# --- predictions and monitoring -------------------------------------------------------


def _cycles(spark, sf_dir):
    return monitoring.cycle_metrics(
        canonical.predictions(spark, sf_dir),
        canonical.observed(spark, sf_dir),
        reconciled_at=rows.instant(AS_OF),
    )


@register
def latest_predictions(spark, sf_dir):
    return monitoring.latest_predictions(canonical.predictions(spark, sf_dir))


@register
def latest_prediction_of_station(spark, sf_dir):
    return monitoring.latest_prediction_of(canonical.predictions(spark, sf_dir), 3)


@register
def latest_batch_health(spark, sf_dir):
    return monitoring.latest_batch_health(canonical.predictions(spark, sf_dir))


def _stored_predictions(spark, sf_dir) -> str:
    path = scratch_dir(spark, "stored-predictions")
    sinks.append_predictions(canonical.predictions(spark, sf_dir), path)
    return path


@register
def latest_stored_predictions(spark, sf_dir):
    """From the stored table, of which the newest date alone is read."""
    return monitoring.latest_stored(spark, _stored_predictions(spark, sf_dir))


@register
def latest_stored_of_station(spark, sf_dir):
    return monitoring.latest_stored_of(spark, _stored_predictions(spark, sf_dir), 3)


@register
def stored_batch_health(spark, sf_dir):
    return monitoring.stored_batch_health(spark, _stored_predictions(spark, sf_dir))


@register
def guarded_append(spark, sf_dir):
    """Predictions before the target date appended; then all, refused; then all that are new."""
    path = scratch_dir(spark, "guarded-predictions")
    predictions = canonical.predictions(spark, sf_dir)
    early = predictions.where(F.col("prediction_made_at") < rows.instant(TARGET_DATE))
    first = sinks.append_new(early, path, "predictions")
    try:
        sinks.append_new(predictions, path, "predictions")
        refused = 0
    except sinks.RepeatedRows as error:
        refused = error.stored
    added = sinks.append_new(predictions, path, "predictions", on_repeat="skip")
    again = sinks.append_new(predictions, path, "predictions", on_repeat="skip")
    stored = tables.read_predictions(spark, path)
    return stored.groupBy("model_version").agg(F.count("*").alias("n_rows")).withColumns(
        {
            "n_first": F.lit(first).cast("long"),
            "n_refused": F.lit(refused).cast("long"),
            "n_added": F.lit(added).cast("long"),
            "n_again": F.lit(again).cast("long"),
        }
    )


@register
def predictions_for_target_time(spark, sf_dir):
    at = datetime.fromisoformat(f"{TARGET_DATE} 12:00:00")
    return tables.predictions_for(canonical.predictions(spark, sf_dir), at)


@register
def prediction_lookup(spark, sf_dir):
    return monitoring.prediction_lookup(
        canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir)
    )


@register
def cycle_metrics(spark, sf_dir):
    return rounded(_cycles(spark, sf_dir), "mae", "rmse")


@register
def reconcile_one_cycle(spark, sf_dir):
    """The first cycle that has both predictions and observations."""
    predictions, observed = canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir)
    first = rows.utc(F.min("target_time")).cast("string").alias("at")
    at = monitoring.matched_errors(predictions, observed).agg(first).first()["at"]
    df = monitoring.reconcile_one(predictions, observed, at or AS_OF, rows.instant(AS_OF))
    return rounded(df, "mae", "rmse")


@register
def station_daily_metrics(spark, sf_dir):
    df = monitoring.station_daily_metrics(
        canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir)
    )
    return rounded(df, "daily_mae", "daily_rmse")


@register
def station_daily_metrics_raw(spark, sf_dir):
    """Against every raw snapshot: repeated observations of a slot all count."""
    raw = canonical.raw_snapshots(spark, sf_dir).select(
        F.col("station_id").alias("id"),
        F.col("snapshot_timestamp").alias("ingestion_timestamp"),
        "dock_bikes",
    )
    df = monitoring.station_daily_metrics(canonical.predictions(spark, sf_dir), raw)
    return rounded(df, "daily_mae", "daily_rmse")


@register
def daily_totals(spark, sf_dir):
    df = monitoring.daily_totals(
        canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir)
    )
    return rounded(df, "daily_mae", "daily_rmse")


@register
def recent_daily_totals(spark, sf_dir):
    df = monitoring.daily_totals(
        canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir)
    )
    return rounded(monitoring.recent_totals(monitoring.pick_first(df)), "daily_mae", "daily_rmse")


@register
def online_mae_view(spark, sf_dir):
    return rounded(monitoring.online_mae(_cycles(spark, sf_dir)), "mae", "rmse", "avg_p50_error")


@register
def cycle_mae_by_day(spark, sf_dir):
    return rounded(monitoring.cycle_mae_by_day(_cycles(spark, sf_dir), AS_OF), "avg_mae")


@register
def top10_worst_stations(spark, sf_dir):
    daily = monitoring.station_daily_metrics(
        canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir), TARGET_DATE
    )
    return rounded(monitoring.worst_stations(daily, TARGET_DATE), "daily_mae", "daily_rmse")


@register
def dashboard(spark, sf_dir):
    """The dashboard's error and station tables of the target date as (panel, item, value)."""
    daily = monitoring.station_daily_metrics(
        canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir), TARGET_DATE
    )
    drift_rows = spark.createDataFrame([], schemas.DRIFT_SUMMARY)
    frames = monitoring.dashboard_frames(_cycles(spark, sf_dir), daily, drift_rows, TARGET_DATE, n=3)
    by_day = frames["mae_by_day"].select(F.lit("mae").alias("panel"), F.col("day").cast("string").alias("item"), F.col("avg_mae").alias("value"))
    worst = frames["worst_stations"].select(F.lit("worst").alias("panel"), F.col("station_id").cast("string").alias("item"), F.col("daily_mae").alias("value"))
    return rounded(by_day.unionByName(worst), "value")


@register
def performance_alert(spark, sf_dir):
    """The last day's online error against the baseline error of all days."""
    reference = metrics.naive_baseline(_with_target(spark, sf_dir)).select("mae").scalar()
    df = monitoring.performance_alert(_cycles(spark, sf_dir), reference, AS_OF)
    return rounded(df, "online_mae", "training_mae", "threshold")


@register
def table_freshness(spark, sf_dir):
    return monitoring.table_freshness(
        canonical.predictions(spark, sf_dir), "prediction_made_at"
    )


# --- live snapshot and scoring frame --------------------------------------------------


def _live(spark, sf_dir):
    """The last raw row of every station."""
    raw = canonical.raw_snapshots(spark, sf_dir)
    return rows.keep_last(raw, keys=("station_id",), order=("raw_ts", "seq"))


def _as_stations(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.col("station_id").alias("id"),
        F.col("station_number").alias("number"),
        F.col("station_name").alias("name"),
        *schemas.SNAPSHOT_COLUMNS[3:8],
        F.struct(
            F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")
        ).alias("geometry"),
    )


def _last_weather(spark, sf_dir):
    raw = canonical.raw_snapshots(spark, sf_dir)
    last = raw.orderBy(F.col("raw_ts").desc(), F.col("seq").desc()).limit(1)
    return last.select(F.col("snapshot_timestamp").alias("timestamp"), *schemas.WEATHER_COLUMNS)


@register
def skipped_stations(spark, sf_dir):
    return rows.skipped_keys(_live(spark, sf_dir))


@register
def scoring_frame(spark, sf_dir):
    stations = _as_stations(_live(spark, sf_dir))
    return source.scoring_frame(stations, AS_OF, _last_weather(spark, sf_dir))


@register
def scoring_frame_without_weather(spark, sf_dir):
    return source.scoring_frame(_as_stations(_live(spark, sf_dir)), AS_OF)


@register
def attach_cycle(spark, sf_dir):
    stations = _as_stations(_live(spark, sf_dir))
    df = source.attach_cycle(stations, rows.instant(AS_OF), _last_weather(spark, sf_dir))
    return df.select(
        "id",
        "dock_bikes",
        F.col("geometry.coordinates")[1].alias("latitude"),
        "ingestion_timestamp",
        F.col("weather_snapshot.timestamp").alias("weather_timestamp"),
        F.col("weather_snapshot.temperature_2m").alias("temperature_2m"),
    )


@register
def union_history(spark, sf_dir):
    """Earlier rows of the scorable stations with the live rows, which lack weather."""
    live = rows.active_for_scoring(_live(spark, sf_dir))
    current = source.scoring_frame(_as_stations(live), AS_OF).drop(*schemas.WEATHER_COLUMNS)
    slot = time.floor_slot(rows.instant(AS_OF))
    past = rows.only_keys(rows.before(canonical.snapshots(spark, sf_dir), slot), live)
    both = rows.union_history(past, current)
    return both.select(*KEY, "dock_bikes", "temperature_2m", "weather_code")


@register
def scoring_feature_rows(spark, sf_dir):
    """Features of the live slot from history, as scoring uses them."""
    live = source.scoring_frame(_as_stations(_live(spark, sf_dir)), AS_OF)
    df = scoring_features(live, canonical.snapshots(spark, sf_dir), AS_OF)
    columns = ("dock_bikes_now", *features.LAGS, *STATS, "dock_bikes_same_time_1w")
    return rounded(df.select(*KEY, *columns), *STATS)


@register
def scoring_slot_rows(spark, sf_dir):
    """The same features from one state per station, without the windows."""
    live = source.scoring_frame(_as_stations(_live(spark, sf_dir)), AS_OF)
    df = slot_features(live, canonical.snapshots(spark, sf_dir), AS_OF)
    columns = ("dock_bikes_now", *features.LAGS, *STATS, "dock_bikes_same_time_1w")
    return rounded(df.select(*KEY, *columns), *STATS)


# --- documents, forecasts, tables -----------------------------------------------------


def _documents(spark, sf_dir):
    """One document per slot, as a cycle would have landed it."""
    flat = canonical.snapshots(spark, sf_dir)
    stations = _as_stations(flat)
    zipped = flat.select(
        "snapshot_timestamp",
        F.struct(*[c for c in _station_columns(flat)]).alias("s"),
        F.struct(
            F.date_format("snapshot_timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp"),
            *schemas.WEATHER_COLUMNS,
        ).alias("w"),
    )
    assert stations.columns == schemas.STATION.fieldNames()
    return zipped.groupBy("snapshot_timestamp").agg(
        F.array_sort(F.collect_list("s")).alias("data"), F.max_by("w", "s.id").alias("weather")
    ).select(
        F.date_format("snapshot_timestamp", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias(
            "ingestion_timestamp"
        ),
        F.struct(
            F.when(F.minute("snapshot_timestamp") == 45, "90").otherwise("00").alias("code"),
            F.lit("").alias("description"),
            F.date_format("snapshot_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("datetime"),
            "data",
        ).alias("stations"),
        "weather",
    )


def _station_columns(flat: DataFrame):
    yield F.col("station_id").alias("id")
    # A station that is not available lands without its number: a contract violation.
    yield F.when(F.col("no_available") == 0, F.col("station_number")).alias("number")
    yield F.col("station_name").alias("name")
    for c in schemas.SNAPSHOT_COLUMNS[3:8]:
        yield F.col(c)
    yield F.struct(
        F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")
    ).alias("geometry")


def _landed(spark, sf_dir) -> str:
    path = scratch_dir(spark, "documents")
    sinks.write_raw(_documents(spark, sf_dir), path)
    return path


@register
def raw_json_roundtrip(spark, sf_dir):
    """Documents written to the archive and read back as flat rows."""
    df = source.read_raw_snapshots(spark, _landed(spark, sf_dir), multiline=False)
    return df.drop("seq")


@register
def contract_rejects(spark, sf_dir):
    """Landed documents that break the contract, with their number of stations."""
    documents = source.read_documents(spark, _landed(spark, sf_dir), multiline=False)
    _, rejected = source.validate_snapshots(documents)
    return rejected.select(
        F.to_timestamp("ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("stations.code").alias("code"),
        F.size("stations.data").alias("n_stations"),
    )


def _each(array: str, field: str):
    """One field of every struct in an array."""
    return F.col(f"{array}.{field}")


@register
def forecast_current_hour(spark, sf_dir):
    """Hourly forecasts per (station, day) and their noon row, else the last one."""
    flat = canonical.snapshots(spark, sf_dir)
    hour = F.date_trunc("hour", "snapshot_timestamp")
    hourly = flat.groupBy("station_id", hour.alias("_hour")).agg(
        F.max_by(F.struct(*schemas.WEATHER_COLUMNS), "snapshot_timestamp").alias("w")
    )
    listed = hourly.groupBy("station_id", F.to_date("_hour").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("_hour", "w"))).alias("h")
    )
    documents = listed.select(
        "station_id",
        "day",
        F.struct(
            F.transform("h", lambda x: F.date_format(x["_hour"], "yyyy-MM-dd'T'HH:00")).alias("time"),
            *[_each("h", f"w.{c}").alias(c) for c in schemas.WEATHER_COLUMNS],
        ).alias("hourly"),
    )
    noon = F.col("day").cast("timestamp") + F.expr("INTERVAL '12:34' HOUR TO MINUTE")
    return weather.current_weather(documents, noon)


@register
def forecast_hours(spark, sf_dir):
    """All hours of the same forecasts as rows."""
    flat = canonical.snapshots(spark, sf_dir)
    listed = flat.groupBy("station_id", F.date_trunc("hour", "snapshot_timestamp").alias("_h")).agg(
        F.array_sort(F.collect_list(F.struct("snapshot_timestamp", *schemas.WEATHER_COLUMNS))).alias("r")
    )
    documents = listed.select(
        "station_id",
        F.struct(
            F.transform("r", lambda x: x["snapshot_timestamp"].cast("string")).alias("time"),
            *[_each("r", c).alias(c) for c in schemas.WEATHER_COLUMNS],
        ).alias("hourly"),
    )
    df = weather.forecast_rows(documents)
    return df.withColumn("time", F.to_timestamp("time"))


@register
def snapshot_table_scan(spark, sf_dir):
    """The nested fact table written by date, then active rows of an inclusive range."""
    raw = canonical.raw_snapshots(spark, sf_dir)
    fact = raw.select(
        F.col("station_id").alias("id"),
        F.col("station_number").alias("number"),
        F.col("station_name").alias("name"),
        *schemas.SNAPSHOT_COLUMNS[3:8],
        F.struct(
            F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")
        ).alias("geometry"),
        F.col("raw_ts").alias("ingestion_timestamp"),
        F.struct(F.col("raw_ts").alias("timestamp"), *schemas.WEATHER_COLUMNS).alias(
            "weather_snapshot"
        ),
    )
    path = scratch_dir(spark, "station-status")
    sinks.append_snapshots(fact, path)
    return source.read_snapshot_table(
        spark, path, canonical.TRAINING_START, canonical.TRAINING_END
    )


@register
def partition_replace(spark, sf_dir):
    """Daily metrics written, then the days from the target date on replaced."""
    daily = monitoring.station_daily_metrics(
        canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir)
    )
    path = scratch_dir(spark, "station-daily")
    sinks.append_station_daily(daily, path)
    again = daily.where(F.col("date") >= F.lit(TARGET_DATE).cast("date"))
    again = again.withColumn("n_cycles", F.col("n_cycles") * 10)
    sinks.replace_partitions(again, path, "station_daily_metrics")
    df = tables.read_table(spark, path, schemas.STATION_DAILY)
    return rounded(df, "daily_mae", "daily_rmse")


# --- drift ----------------------------------------------------------------------------


def _drift_windows(spark, sf_dir):
    saved_at = datetime.fromisoformat(f"{canonical.REFERENCE_END} 12:00:00")
    return training.drift_windows(canonical.raw_snapshots(spark, sf_dir), TARGET_DATE, saved_at)


@register
def ks_drift(spark, sf_dir):
    reference, current = [rows.without_identifiers(w) for w in _drift_windows(spark, sf_dir)]
    df = drift.ks_drift(reference, current).drop("p_value")
    return rounded(df, "statistic")


@register
def chi2_drift(spark, sf_dir):
    reference, current = [rows.without_identifiers(w) for w in _drift_windows(spark, sf_dir)]
    df = drift.chi2_drift(reference, current).drop("p_value")
    return rounded(df, "statistic")


def _drift_summary(spark, sf_dir):
    saved_at = datetime.fromisoformat(f"{canonical.REFERENCE_END} 12:00:00")
    return training.drift_job(canonical.raw_snapshots(spark, sf_dir), TARGET_DATE, saved_at)


@register
def drift_summary(spark, sf_dir):
    df = _drift_summary(spark, sf_dir)
    names = F.array_join("drifted_feature_names", ",").alias("drifted_feature_names")
    return rounded(df, "share_drifted").select(
        "date", "n_drifted_features", "share_drifted", names, "n_reference_rows", "n_current_rows"
    )


@register
def drift_alert(spark, sf_dir):
    """The summary through its JSON file, as the alert job reads it."""
    path = scratch_dir(spark, "drift-summary")
    sinks.write_summary(_drift_summary(spark, sf_dir), path)
    df = monitoring.drift_alert(tables.read_drift_summary(spark, path, TARGET_DATE), 0.10)
    return rounded(df, "share_drifted").select("date", "n_drifted_features", "share_drifted")


# --- models ---------------------------------------------------------------------------


def _trained(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in RUNS:
        raw = canonical.raw_snapshots(spark, sf_dir)
        RUNS[key] = training.train_run(raw, canonical.TRAINING_END)
    return RUNS[key]


def _split_data(spark, sf_dir):
    start, end = training.training_window(canonical.TRAINING_END)
    raw = canonical.raw_snapshots(spark, sf_dir)
    data = materialise(training.training_dataset(raw, start, end), "training")
    return split.temporal_split(data)[:3]


@register
def gbt_train_score(spark, sf_dir):
    """Train, then score the live snapshot with its history."""
    model = _trained(spark, sf_dir)["model"]
    live = source.scoring_frame(_as_stations(_live(spark, sf_dir)), AS_OF)
    return score(model, "v20240120_000000", live, AS_OF, canonical.snapshots(spark, sf_dir))


@register
def gbt_evaluate(spark, sf_dir):
    return _trained(spark, sf_dir)["metrics"]


@register
def gbt_tune(spark, sf_dir):
    train, val, _ = _split_data(spark, sf_dir)
    best, _, trials = trees.tune(train, val, trees.grid(maxDepth=[3, 6]))
    found = [(p["maxDepth"], error, p == best) for p, error in trials]
    return spark.createDataFrame(found, "max_depth int, val_mae double, chosen boolean")


@register
def gbt_search(spark, sf_dir):
    """Successive halving over sampled parameters: every trial with its trees and its error."""
    train, val, _ = _split_data(spark, sf_dir)
    _, _, trials = trees.search(train, val, n=4, keep=2, rounds=32)
    found = [(t.number, t.rounds, float(t.params["stepSize"]), int(t.params["maxDepth"]), t.error, t.kept) for t in trials]
    return spark.createDataFrame(found, "candidate int, rounds int, step_size double, max_depth int, val_mae double, kept boolean")


@register
def feature_importance(spark, sf_dir):
    return trees.feature_importance(_trained(spark, sf_dir)["model"], spark)


@register
def promote_if_better(spark, sf_dir):
    """Two runs logged in the run table; the later one challenges the first."""
    train, val, test = _split_data(spark, sf_dir)
    first = trees.train_model(train, val, {"maxDepth": 2})
    second = _trained(spark, sf_dir)["model"]
    runs, promotions = scratch_dir(spark, "model-runs"), scratch_dir(spark, "promotions")
    for model, day in ((first, 18), (second, 20)):
        error = trees.validation_mae(model, test)
        saved_at = datetime(2024, 1, day)
        registry.log_run(
            registry.run_row(
                spark, saved_at, {"mae": error}, list(schemas.MODEL_COLUMNS), trees.num_trees(model)
            ),
            runs,
        )
    registry.promote(spark, promotions, "v20240118_000000", datetime(2024, 1, 18))
    decision = registry.promote_if_better(
        second, registry.latest_version(registry.read_runs(spark, runs)), first, None, test
    )
    if decision["promoted"]:
        registry.promote(spark, promotions, decision["version"], datetime(2024, 1, 20))
    promoted = tables.read_table(spark, promotions, schemas.PROMOTIONS)
    best = registry.champion(registry.read_runs(spark, runs), promoted)
    return best.select("version", "num_trees", F.col("metrics")["mae"].alias("mae"), "promoted_at")


# --- streams --------------------------------------------------------------------------


def _finish(query) -> None:
    """Waits for a stream. Read its table by the stream's schema: one that kept no row has no file to infer it from."""
    query.awaitTermination()


@register
def stream_ingest(spark, sf_dir):
    """The landed documents through the ingest stream into a table."""
    stream = cycle.ingest_stream(cycle.document_stream(spark, _landed(spark, sf_dir), multiline=False))
    table, checkpoint = scratch_dir(spark, "ingested"), scratch_dir(spark, "checkpoint")
    _finish(cycle.start_table(stream, table, checkpoint))
    return tables.read_table(spark, table, stream.schema).drop("seq")


@register
def stream_dedup(spark, sf_dir):
    """(station, slot) pairs the stream keeps of the events."""
    events = spark.readStream.schema(canonical.EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stream = cycle.dedup_stream(canonical.snapshots_from_events(events))
    table, checkpoint = scratch_dir(spark, "deduplicated"), scratch_dir(spark, "checkpoint")
    _finish(cycle.start_table(stream, table, checkpoint))
    return tables.read_table(spark, table, stream.schema).select(*KEY)


@register
def stream_score(spark, sf_dir):
    """Every landed slot scored by the stream against the table's history."""
    model = _trained(spark, sf_dir)["model"]
    table = scratch_dir(spark, "snapshots")
    flat = canonical.snapshots(spark, sf_dir)
    flat.withColumn("dt", F.to_date(SERIES.time)).write.partitionBy("dt").parquet(table)
    out = scratch_dir(spark, "predictions")
    _finish(
        cycle.start_scoring(
            cycle.table_stream(spark, table, flat.schema).select(*flat.columns),
            cycle.table_history(spark, table, flat.schema),
            model,
            "v20240120_000000",
            out,
            scratch_dir(spark, "checkpoint"),
        )
    )
    return tables.read_predictions(spark, out)


@register
def stream_reconcile_cycles(spark, sf_dir):
    """Cycle rows kept by the stream while predictions and observations land in parts: the later
    half of the observations first, a third of them again with other values before, and predictions
    of half the stations after all observations."""
    predictions, observed = canonical.predictions(spark, sf_dir), canonical.observed(spark, sf_dir)
    names = ("predictions", "observed", "cycles", "checkpoint")
    stored, seen, cycles, checkpoint = (scratch_dir(spark, n) for n in names)
    arrivals = T.StructType([*observed.schema.fields, T.StructField("raw_ts", T.TimestampType())])

    def land(df: DataFrame, arrived: str) -> None:
        dated = df.withColumns({"raw_ts": rows.instant(arrived), "dt": F.to_date("ingestion_timestamp")})
        dated.write.mode("append").partitionBy("dt").parquet(seen)

    def run() -> None:
        _finish(
            cycle.start_reconcile(
                cycle.table_stream(spark, stored, schemas.PREDICTIONS),
                cycle.table_stream(spark, seen, arrivals),
                cycle.table_history(spark, stored, schemas.PREDICTIONS),
                cycle.table_history(spark, seen, arrivals),
                cycles,
                checkpoint,
                reconciled_at=rows.instant(AS_OF),
            )
        )

    half = F.col("station_id") % 2 == 0
    late = F.col("ingestion_timestamp") >= rows.instant("2024-01-16")
    sinks.append_new(predictions.where(half), stored, "predictions", "skip")
    wrong = observed.where((F.col("id") % 3 == 0) & late).withColumn("dock_bikes", F.col("dock_bikes") + 3)
    land(wrong, "2024-02-01 00:00:00")
    run()
    land(observed.where(late), "2024-02-01 01:00:00")
    run()
    land(observed, "2024-02-01 02:00:00")
    sinks.append_new(predictions, stored, "predictions", "skip")
    run()
    run()
    found = monitoring.current_cycles(tables.read_table(spark, cycles, schemas.CYCLE_METRICS))
    found = found.withColumn("reconciled_at", F.date_trunc("second", "reconciled_at"))
    return rounded(found, "mae", "rmse")


@register
def stream_reconcile(spark, sf_dir):
    """Predictions and observations joined as streams, then summed per cycle."""
    predictions = canonical.predictions(spark, sf_dir)
    observed = canonical.observed(spark, sf_dir)
    paths = [scratch_dir(spark, n) for n in ("predictions", "observed", "matched", "checkpoint")]
    predictions.write.parquet(paths[0])
    observed.write.parquet(paths[1])
    matched = cycle.matched_stream(
        cycle.table_stream(spark, paths[0], predictions.schema),
        cycle.table_stream(spark, paths[1], observed.schema),
    )
    _finish(cycle.start_table(matched, paths[2], paths[3], time=None))
    error = F.col("error")
    df = tables.read_table(spark, paths[2], matched.schema).groupBy("target_time").agg(
        F.count("*").alias("n_predictions"),
        metrics.mae(error).alias("mae"),
        metrics.rmse(error).alias("rmse"),
    )
    return rounded(df, "mae", "rmse")


def _error_stream(spark, sf_dir, **window):
    cycles = _cycles(spark, sf_dir).select("cycle_timestamp", "mae")
    paths = [scratch_dir(spark, n) for n in ("cycles", "windows", "checkpoint")]
    cycles.write.parquet(paths[0])
    stream = cycle.error_windows(cycle.table_stream(spark, paths[0], cycles.schema), **window)
    _finish(cycle.start_table(stream, paths[1], paths[2], time=None))
    return rounded(tables.read_table(spark, paths[1], stream.schema), "avg_mae")


@register
def stream_error_windows(spark, sf_dir):
    return _error_stream(spark, sf_dir)


@register
def stream_sliding_mae(spark, sf_dir):
    return _error_stream(spark, sf_dir, window="24 hours", slide="15 minutes")
