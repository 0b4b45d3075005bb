"""Writers. Every table is partitioned by a UTC date column ``dt``."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise import schemas
from slotwise.config import DEFAULTS
from slotwise.session import materialise
from slotwise.sources.tables import date_folders, folder_of, note_retained

# Table name -> declared schema and the expression of its date partition.
TABLES = {
    "station_status_raw": (schemas.STATION_STATUS_RAW, "to_date(ingestion_timestamp)", "id"),
    "predictions": (schemas.PREDICTIONS, "to_date(prediction_made_at)", "station_id"),
    "cycle_metrics": (schemas.CYCLE_METRICS, "to_date(cycle_timestamp)", "model_version"),
    "station_daily_metrics": (schemas.STATION_DAILY, "date", "station_id"),
    "daily_totals": (schemas.DAILY_TOTALS, "date", "model_version"),
}

# Table name -> the columns that tell its rows apart, and the time among them that bounds a search.
KEYS = {
    "station_status_raw": (("id", "ingestion_timestamp"), "ingestion_timestamp"),
    "predictions": (("station_id", "prediction_made_at", "model_version"), "prediction_made_at"),
    "cycle_metrics": (("cycle_timestamp",), "cycle_timestamp"),
    "station_daily_metrics": (("date", "station_id", "model_version"), "date"),
    "daily_totals": (("date", "model_version"), "date"),
}


class RepeatedRows(ValueError):
    """Rows of an append are stored already, or stand in it more than once; nothing was written."""

    def __init__(self, table: str, stored: int, doubled: int):
        super().__init__(f"{table}: {stored} rows are stored already, {doubled} repeat a row of the same append")
        self.stored, self.doubled = stored, doubled


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns and types; a missing column or a value that does not
    fit is an error."""
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _by_date(df: DataFrame, day: Column, cluster: str) -> DataFrame:
    # Rebalancing gives each date a few even files and splits a date that is too large for
    # one task; sorting inside the files lets readers skip row groups by key.
    dated = df.withColumn("dt", day)
    return dated.hint("rebalance", "dt").sortWithinPartitions("dt", cluster)


def _write(df: DataFrame, path: str, mode: str, **options: str) -> int:
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("n"))
    observed.write.mode(mode).options(**options).partitionBy("dt").parquet(path)
    return counted.get["n"]


def append(df: DataFrame, path: str, table: str) -> int:
    """Append rows to a known table and return their number, without a second pass."""
    schema, day, cluster = TABLES[table]
    return _write(_by_date(conform(df, schema), F.expr(day), cluster), path, "append")


def _stored_keys(rows: DataFrame, path: str, table: str) -> DataFrame | None:
    """Keys the table holds on the dates of ``rows`` and between their first and last time.

    Dates prune folders, the times row groups. The driver gets one value per date.
    """
    keys, time = KEYS[table]
    days = [r["dt"] for r in rows.select("dt").distinct().collect()]
    span = rows.agg(F.min(time).cast("string").alias("lo"), F.max(time).cast("string").alias("hi")).first()
    try:
        stored = rows.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    dated = F.col("dt").isin([d for d in days if d is not None])
    if None in days:
        return stored.where(dated | F.col("dt").isNull()).select(*keys)
    bounds = [F.lit(span[c]).cast(rows.schema[time].dataType) for c in ("lo", "hi")]
    return stored.where(dated & F.col(time).between(*bounds)).select(*keys)


def append_new(df: DataFrame, path: str, table: str, on_repeat: str = "refuse") -> int:
    """Append rows whose key the table does not hold yet, and return their number.

    ``on_repeat="refuse"`` raises :class:`RepeatedRows` and writes nothing when any row is stored
    already or stands in ``df`` twice; ``"skip"`` writes the rest, of doubled rows one. So an
    append that is run again, by whatever job, leaves one copy: what a failed run did write is
    found by its keys. Null keys are equal to each other. Two writers at the same time are not
    kept apart.
    """
    if on_repeat not in ("refuse", "skip"):
        raise ValueError(f"unknown on_repeat {on_repeat!r}")
    schema, day, cluster = TABLES[table]
    keys, _ = KEYS[table]
    rows = materialise(conform(df, schema).withColumn("dt", F.expr(day)), f"append-{table}")
    once = rows.dropDuplicates(list(keys))
    stored = _stored_keys(rows, path, table)
    fresh = once
    if stored is not None:
        stored = stored.select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        fresh = once.join(stored, same, "left_anti")
    fresh = materialise(fresh, f"fresh-{table}")
    if on_repeat == "refuse":
        total, distinct, new = rows.count(), once.count(), fresh.count()
        if new < total:
            raise RepeatedRows(table, distinct - new, total - distinct)
    if fresh.isEmpty():
        return 0
    return _write(_by_date(fresh.drop("dt"), F.expr(day), cluster), path, "append")


def replace_partitions(df: DataFrame, path: str, table: str) -> int:
    """Overwrite only the dates present in ``df``: running a day again leaves one copy."""
    schema, day, cluster = TABLES[table]
    dated = _by_date(conform(df, schema), F.expr(day), cluster)
    return _write(dated, path, "overwrite", partitionOverwriteMode="dynamic")


def append_snapshots(df: DataFrame, path: str) -> int:
    return append(df, path, "station_status_raw")


def append_predictions(df: DataFrame, path: str) -> int:
    return append(df, path, "predictions")


def append_cycle_metrics(df: DataFrame, path: str) -> int:
    return append(df, path, "cycle_metrics")


def append_station_daily(df: DataFrame, path: str) -> int:
    return append(df, path, "station_daily_metrics")


def append_daily_totals(df: DataFrame, path: str) -> int:
    return append(df, path, "daily_totals")


def write_raw(documents: DataFrame, path: str, mode: str = "append") -> None:
    """Archive documents as JSON lines under ``dt=YYYY-MM-DD/hh=HH`` (UTC, zero-padded).

    The minute stays in the document; Spark names the files.
    """
    at = F.to_timestamp("ingestion_timestamp")
    dated = documents.withColumns(
        {"dt": F.date_format(at, "yyyy-MM-dd"), "hh": F.date_format(at, "HH")}
    )
    dated.hint("rebalance", "dt", "hh").write.mode(mode).partitionBy("dt", "hh").json(path)


def write_dataset(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_summary(row: DataFrame, path: str, mode: str = "append") -> None:
    """A one-row result as JSON."""
    row.coalesce(1).write.mode(mode).json(path)


def evaluation_report(
    metrics: DataFrame, generated_at: Column | None = None, num_trees: int | None = None
) -> DataFrame:
    """The one-row evaluation report: time, number of model columns, metrics, tree count."""
    return metrics.select(
        (generated_at if generated_at is not None else F.current_timestamp()).alias("generated_at"),
        F.lit(len(schemas.MODEL_COLUMNS)).alias("feature_count"),
        F.struct(*metrics.columns).alias("metrics"),
        F.struct(F.lit(num_trees).cast("int").alias("num_trees")).alias("model_info"),
    )


def retained(
    df: DataFrame, as_of: date, days: int = DEFAULTS.retention_days, column: str = "dt"
) -> DataFrame:
    """Rows of the last ``days`` whole days; on the partition column it prunes folders."""
    return df.where(F.col(column) >= F.lit(as_of - timedelta(days=days)))


def drop_expired(
    spark: SparkSession, path: str, as_of: date, days: int = DEFAULTS.retention_days
) -> list[str]:
    """Delete the ``dt=`` folders before the retention limit; returns their names.

    Works on folder names: no data is read or rewritten. The limit is noted in the table before
    anything goes, for :func:`slotwise.sources.tables.read_dated`: a table written by a stream keeps
    the names of its deleted files in the stream's log.
    """
    oldest = f"dt={as_of - timedelta(days=days)}"
    root, fs = folder_of(spark, path)
    expired = [d for d in date_folders(spark, path) if d < oldest]
    if expired:
        note_retained(spark, path, as_of - timedelta(days=days))
    for name in expired:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)
    return expired
