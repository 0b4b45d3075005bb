"""Predictions against what happened: cycle, station, day; latest predictions; alerts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.config import DEFAULTS, SERIES
from slotwise.functions.time import days_before, floor_slot
from slotwise.operators.rows import instant, on_date, trailing
from slotwise.sources.tables import newest_predictions

LATEST_KEYS = ("station_id", "prediction_made_at", "target_time", "predicted_dock_bikes", "model_version")


def latest_observed(snapshots: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """One observation per (id, ingestion time): the last by ``order``, else by the arrival
    columns it has, then by value."""
    order = order or tuple(c for c in SERIES.arrival if c in snapshots.columns)
    w = Window.partitionBy("id", "ingestion_timestamp").orderBy(
        *[F.col(c).desc_nulls_last() for c in (*order, "dock_bikes")]
    )
    ranked = snapshots.withColumn("_rank", F.row_number().over(w)).where("_rank = 1")
    return ranked.select("id", "ingestion_timestamp", "dock_bikes")


def _aligned(ts: Column, align: bool) -> Column:
    return floor_slot(ts) if align else ts


def prediction_lookup(
    predictions: DataFrame, snapshots: DataFrame, align: bool = False, order: tuple[str, ...] = ()
) -> DataFrame:
    """Predictions with the value observed at their target time; the rest is dropped.

    Times must be equal to the microsecond, or fall in one slot with ``align``. The
    observed side has one row per key, so copies of predictions cannot multiply.
    """
    seen = snapshots.withColumn("ingestion_timestamp", _aligned(F.col("ingestion_timestamp"), align))
    seen = latest_observed(seen, order).select(
        F.col("id").alias("station_id"),
        F.col("ingestion_timestamp").alias("_at"),
        F.col("dock_bikes").alias("observed_dock_bikes"),
    )
    wanted = predictions.withColumn("_at", _aligned(F.col("target_time"), align))
    return wanted.join(seen, ["station_id", "_at"]).drop("_at")


def matched_errors(
    predictions: DataFrame, snapshots: DataFrame, align: bool = False, unique: bool = True
) -> DataFrame:
    """(station, target time, version, error, n): distinct errors with their frequency.

    Equal rows are counted on both sides before the join. A prediction or snapshot that
    holds a third of all rows becomes one row per input task, and pairs of copies are
    multiplied as numbers instead of being emitted. ``unique`` keeps the last observation
    per station and time, as reconciliation does; daily metrics count every one.
    """
    p = (
        predictions.select(
            "station_id",
            _aligned(F.col("target_time"), align).alias("target_time"),
            "model_version",
            "predicted_dock_bikes",
        )
        .groupBy("station_id", "target_time", "model_version", "predicted_dock_bikes")
        .agg(F.count("*").alias("_np"))
    )
    at = _aligned(F.col("ingestion_timestamp"), align)
    s = snapshots.withColumn("ingestion_timestamp", at)
    if unique:
        s = latest_observed(s).withColumn("_ns", F.lit(1))
    else:
        s = s.groupBy("id", "ingestion_timestamp", "dock_bikes").agg(F.count("*").alias("_ns"))
    s = s.withColumnsRenamed({"id": "station_id", "ingestion_timestamp": "target_time"})
    return p.join(s, ["station_id", "target_time"]).select(
        "station_id",
        "target_time",
        "model_version",
        (F.col("predicted_dock_bikes") - F.col("dock_bikes")).alias("error"),
        (F.col("_np") * F.col("_ns")).alias("n"),
    )


def cycle_metrics(
    predictions: DataFrame,
    snapshots: DataFrame,
    reconciled_at: Column | None = None,
    align: bool = False,
) -> DataFrame:
    """One row per target time with errors, their median and nearest-rank 90th percentile,
    and the worst station (lowest id on ties).

    Errors are counted per (time, value) before anything is ordered, so a cycle's window
    holds its distinct error sizes, not its predictions.
    """
    errors = matched_errors(predictions, snapshots, align)
    sizes = (
        errors.withColumn("size", F.abs("error"))
        .groupBy("target_time", "size")
        .agg(
            F.sum("n").alias("n"),
            F.min("station_id").alias("station_id"),
            F.max("model_version").alias("model_version"),
        )
    )
    w = Window.partitionBy("target_time").orderBy("size")
    upto = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy("target_time"))
    ranked = sizes.withColumns({"_upto": upto, "_total": total})

    def at_rank(rank: str) -> Column:
        return F.min(F.when(F.col("_upto") >= F.expr(rank), F.col("size")))

    # 9/10 in integers: the exact ceiling of 0.9 n.
    result = ranked.groupBy("target_time").agg(
        F.max("model_version").alias("model_version"),
        F.sum("n").alias("n_predictions"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mae"),
        F.sqrt(F.sum(F.col("size") * F.col("size") * F.col("n")) / F.sum("n")).alias("rmse"),
        ((at_rank("(_total + 1) div 2") + at_rank("_total div 2 + 1")) / 2).alias("p50_error"),
        at_rank("(9 * _total + 9) div 10").alias("p90_error"),
        F.max_by("station_id", "size").alias("worst_station_id"),
        F.max("size").alias("worst_station_error"),
    )
    return result.withColumnRenamed("target_time", "cycle_timestamp").withColumn(
        "reconciled_at", reconciled_at if reconciled_at is not None else F.current_timestamp()
    )


def reconcile_one(
    predictions: DataFrame,
    snapshots: DataFrame,
    target_time: str | datetime,
    reconciled_at: Column | None = None,
) -> DataFrame:
    """The cycle row of one target time; no row when nothing matches."""
    at = instant(target_time)
    return cycle_metrics(
        predictions.where(F.col("target_time") == at),
        snapshots.where(F.col("ingestion_timestamp") == at),
        reconciled_at,
    )


def _error_sums(n: str = "n") -> list[Column]:
    return [
        F.sum(n).alias("n_cycles"),
        F.sum(F.abs("error") * F.col(n)).alias("_abs"),
        F.sum(F.col("error") * F.col("error") * F.col(n)).alias("_sq"),
    ]


def _daily_columns() -> list[Column]:
    return [
        F.col("n_cycles"),
        (F.col("_abs") / F.col("n_cycles")).alias("daily_mae"),
        F.sqrt(F.col("_sq") / F.col("n_cycles")).alias("daily_rmse"),
    ]


def _daily_errors(
    predictions: DataFrame, snapshots: DataFrame, day: str | date | None, align: bool
) -> DataFrame:
    if day is not None:
        predictions = on_date(predictions, day, "target_time")
        snapshots = on_date(snapshots, day, "ingestion_timestamp")
    errors = matched_errors(predictions, snapshots, align, unique=False)
    return errors.groupBy(
        F.to_date("target_time").alias("date"), "station_id", "model_version"
    ).agg(*_error_sums())


def station_daily_metrics(
    predictions: DataFrame,
    snapshots: DataFrame,
    day: str | date | None = None,
    align: bool = False,
) -> DataFrame:
    """Errors per (date, station, version); all dates when ``day`` is not given."""
    sums = _daily_errors(predictions, snapshots, day, align)
    return sums.select("date", "station_id", "model_version", *_daily_columns())


def daily_totals(
    predictions: DataFrame,
    snapshots: DataFrame,
    day: str | date | None = None,
    align: bool = False,
) -> DataFrame:
    """Errors per (date, version) with the number of stations, from the station sums."""
    sums = _daily_errors(predictions, snapshots, day, align)
    totals = sums.groupBy("date", "model_version").agg(
        F.count("station_id").alias("n_stations"),
        F.sum("n_cycles").alias("n_cycles"),
        F.sum("_abs").alias("_abs"),
        F.sum("_sq").alias("_sq"),
    )
    return totals.select("date", "model_version", "n_stations", *_daily_columns())


def pick_first(totals: DataFrame) -> DataFrame:
    """One version per date, the newest name: for callers that expect a single row."""
    w = Window.partitionBy("date").orderBy(F.col("model_version").desc())
    return totals.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def check_finite(totals: DataFrame) -> None:
    bad = totals.where(
        F.isnan("daily_mae") | F.col("daily_mae").isNull() | (F.abs("daily_mae") == float("inf"))
    )
    row = bad.select("date", "model_version").first()
    if row is not None:
        raise ValueError(f"daily error is not finite for {row['date']} {row['model_version']}")


def online_mae(cycles: DataFrame) -> DataFrame:
    """Cycle metrics re-aggregated per (date, version), weighted by predictions."""
    n = F.col("n_predictions")
    return (
        cycles.groupBy(F.to_date("cycle_timestamp").alias("prediction_date"), "model_version")
        .agg(
            F.count("*").alias("n_cycles"),
            F.sum(n).alias("total_predictions"),
            (F.sum(F.col("mae") * n) / F.sum(n)).alias("mae"),
            F.sqrt(F.sum(F.col("rmse") * F.col("rmse") * n) / F.sum(n)).alias("rmse"),
            F.avg("p50_error").alias("avg_p50_error"),
            F.max("p90_error").alias("max_p90_error"),
            F.max("worst_station_error").alias("max_station_error"),
        )
        .orderBy(F.col("prediction_date").desc(), F.col("model_version").desc())
    )


def cycle_mae_by_day(cycles: DataFrame, as_of: str | datetime, days: int = 7) -> DataFrame:
    """Plain mean of the cycle errors per day over the trailing days."""
    return (
        trailing(cycles, "cycle_timestamp", as_of, days * 24)
        .groupBy(F.to_date("cycle_timestamp").alias("day"))
        .agg(F.avg("mae").alias("avg_mae"))
        .orderBy("day")
    )


def worst_stations(station_daily: DataFrame, day: str | date, n: int = 10) -> DataFrame:
    """Top ``n`` stations of a date by error; the lower id first on ties."""
    return (
        station_daily.where(F.col("date") == F.lit(str(day)).cast("date"))
        .orderBy(F.col("daily_mae").desc(), "station_id", F.col("model_version").desc())
        .select("station_id", "model_version", "daily_mae", "daily_rmse", "n_cycles")
        .limit(n)
    )


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The newest prediction per station among those made on the newest date.

    The date is a scalar subquery over one narrow column; its day becomes a time range.
    """
    newest = F.date_trunc("day", predictions.agg(F.max("prediction_made_at")).scalar())
    last_day = predictions.where(
        (F.col("prediction_made_at") >= newest)
        & (F.col("prediction_made_at") < days_before(newest, -1))
    )
    return _newest_per_station(last_day)


def _newest_per_station(last_day: DataFrame) -> DataFrame:
    w = Window.partitionBy("station_id").orderBy(
        F.col("prediction_made_at").desc(),
        F.col("model_version").desc(),
        F.col("predicted_dock_bikes").desc(),
    )
    ranked = last_day.withColumn("_rank", F.row_number().over(w)).where("_rank = 1")
    return ranked.select(*LATEST_KEYS)


def latest_stored(spark: SparkSession, path: str) -> DataFrame:
    """:func:`latest_predictions` of the stored table, from its newest date alone."""
    return _newest_per_station(newest_predictions(spark, path))


def latest_stored_of(spark: SparkSession, path: str, station_id: int) -> DataFrame:
    """Point lookup in the newest date; the station prunes row groups, which are sorted by it."""
    return latest_stored(spark, path).where(F.col("station_id") == station_id)


def stored_batch_health(spark: SparkSession, path: str) -> DataFrame:
    return _health(latest_stored(spark, path))


def current_cycles(cycles: DataFrame) -> DataFrame:
    """One row per cycle: the one reconciled last."""
    last = F.max_by(F.struct(*cycles.columns), F.col("reconciled_at")).alias("row")
    return cycles.groupBy(F.col("cycle_timestamp").alias("_cycle")).agg(last).select("row.*")


def latest_prediction_of(predictions: DataFrame, station_id: int) -> DataFrame:
    """Point lookup in the latest batch; no row means not found."""
    return latest_predictions(predictions).where(F.col("station_id") == station_id)


def latest_batch_health(predictions: DataFrame) -> DataFrame:
    """How many stations have a latest prediction, and its time; 0 and null without data."""
    return _health(latest_predictions(predictions))


def _health(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count("*").alias("predictions_available"),
        F.max("prediction_made_at").alias("latest_snapshot"),
    )


def table_freshness(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.max(column).alias("latest"))


def recent_totals(totals: DataFrame, n: int = 3) -> DataFrame:
    return totals.orderBy(F.col("date").desc(), F.col("model_version").desc()).limit(n)


def performance_alert(
    cycles: DataFrame,
    training_mae: float | Column | None,
    as_of: str | datetime,
    hours: int = 24,
    factor: float = DEFAULTS.mae_factor,
) -> DataFrame:
    """One row: online error of the trailing hours against the training error.

    Fires only on a strict excess; missing data, a missing champion or a training error
    that is not above 0 do not fire.
    """
    reference = F.lit(training_mae).cast("double") if not isinstance(training_mae, Column) else training_mae
    online = trailing(cycles, "cycle_timestamp", as_of, hours).agg(F.avg("mae").alias("online_mae"))
    usable = (F.col("training_mae") > 0) & ~F.isnan("training_mae")
    return (
        online.withColumn("training_mae", reference)
        .withColumn("threshold", F.col("training_mae") * factor)
        .withColumn(
            "fired", F.coalesce(usable & (F.col("online_mae") > F.col("threshold")), F.lit(False))
        )
    )


def drift_alert(summaries: DataFrame, share: float = DEFAULTS.drift_share) -> DataFrame:
    """Summaries whose share of drifted features is strictly above ``share``."""
    return summaries.where(F.col("share_drifted") > share)


def dashboard_frames(
    cycles: DataFrame, station_daily: DataFrame, summaries: DataFrame, day: str | date, days: int = 7, n: int = 10
) -> dict[str, DataFrame]:
    """The tables of the dashboard of a date: the cycle error of the ``days`` up to its end, the ``n`` worst
    stations, and its drift summary."""
    end = f"{day} 23:59:59.999999"
    return {
        "mae_by_day": cycle_mae_by_day(cycles, end, days),
        "worst_stations": worst_stations(station_daily, day, n),
        "drift": summaries.where(F.col("date") == F.lit(str(day)).cast("date")),
    }
