"""The 15-minute cycle as Structured Streaming.

Each function turns one stream into another or starts one query with its own checkpoint,
so that a failing scoring or reconcile query never stops the ingest.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from slotwise.config import DEFAULTS, SERIES, Settings
from slotwise.ml.model import TreeModel
from slotwise.ml.scoring import score_slots
from slotwise.operators.monitoring import current_cycles, cycle_metrics
from slotwise.operators.quality import document_is_valid
from slotwise.operators.rows import utc
from slotwise.schemas import CYCLE_METRICS, SNAPSHOT_DOCUMENT
from slotwise.session import materialise
from slotwise.sources.sinks import append_cycle_metrics, append_new, conform
from slotwise.sources.snapshots import flatten_documents
from slotwise.sources.tables import read_dated, read_table


def document_stream(spark: SparkSession, path: str, multiline: bool = True, **options) -> DataFrame:
    """Snapshot documents as they land."""
    reader = spark.readStream.schema(SNAPSHOT_DOCUMENT).option("multiLine", multiline)
    return reader.options(**options).json(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """New files of a parquet table."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def ingest_stream(documents: DataFrame) -> DataFrame:
    """Flat snapshot rows of the documents that keep the contract, as the batch path takes them.

    Documents with an unreadable time give null times, not a stop.
    """
    return flatten_documents(documents.where(document_is_valid(F.col("stations"))), strict=False)


def rejected_stream(documents: DataFrame) -> DataFrame:
    """The documents :func:`ingest_stream` leaves out, for a table of their own."""
    return documents.where(~document_is_valid(F.col("stations")))


def dedup_stream(snapshots: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop re-delivered (station, slot) rows that arrive within ``delay``.

    It keeps the first, batch keep-last the last: reports read the table through
    ``keep_last``.
    """
    return snapshots.withWatermark(SERIES.time, delay).dropDuplicatesWithinWatermark(
        [SERIES.key, SERIES.time]
    )


def start_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    time: str | None = SERIES.time,
) -> StreamingQuery:
    """Append a stream to a parquet table by date; ``every`` for a running query, without
    it the query handles what is there and stops."""
    partitions = []
    if time:
        stream, partitions = stream.withColumn("dt", F.to_date(time)), ["dt"]
    writer = stream.writeStream.format("parquet").outputMode("append").partitionBy(*partitions)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def table_history(spark: SparkSession, path: str, schema: T.StructType) -> Callable[[date, date], DataFrame]:
    """A reader of the flat snapshots that :func:`start_table` stored between two inclusive dates."""
    def between(first: date, last: date) -> DataFrame:
        return read_dated(spark, path, schema, first, last).drop("dt")

    return between


def _span(batch: DataFrame, column: str):
    """First and last time of a batch as UTC wall-clock times; two nulls without rows."""
    return batch.agg(utc(F.min(column)).alias("lo"), utc(F.max(column)).alias("hi")).first()


def start_scoring(
    snapshots: DataFrame,
    read_history: Callable[[date, date], DataFrame],
    model: TreeModel,
    version: str,
    predictions_path: str,
    checkpoint: str,
    every: str | None = None,
    settings: Settings = DEFAULTS,
) -> StreamingQuery:
    """Score every micro-batch against the last days of the snapshot table.

    Row lags are not allowed on streams, so the bounded history is read again per batch:
    ``read_history`` gets the first and last date and prunes by them. Predictions go to the
    table of the batch job, by date. Its keys are the ledger: a row is written unless the
    table has one of that station, arrival time and version, so a batch that runs again, after
    a failure or from a new checkpoint, adds what is missing and nothing twice.
    """
    def score_batch(batch: DataFrame, batch_id: int) -> None:
        span = _span(batch, SERIES.time)
        if span["lo"] is None:
            return
        first = (span["lo"] - timedelta(days=settings.history_days)).date()
        history = read_history(first, span["hi"].date())
        append_new(score_slots(model, version, batch, history, settings), predictions_path, "predictions", "skip")

    writer = snapshots.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def start_reconcile(
    predictions: DataFrame,
    observations: DataFrame,
    read_predicted: Callable[[date, date], DataFrame],
    read_observed: Callable[[date, date], DataFrame],
    cycles_path: str,
    checkpoint: str,
    every: str | None = None,
    reconciled_at: Column | None = None,
    horizon_days: int = 1,
) -> StreamingQuery:
    """Whole rows of ``cycle_metrics`` for every cycle that predictions or observations arrive for.

    Both streams only say which target times a micro-batch touches. Those cycles are read from
    the two tables, pruned by date (predictions are made up to ``horizon_days`` before their target),
    and reconciled as the batch job does: equal rows counted, the last observation per station
    kept, median and 90th percentile from counted error sizes. So a row that is late by any
    time, delivered again or corrected gives the same metrics as a batch over all rows, and no
    state grows with the stream. A cycle whose metrics did not change is not written again; one
    that did gets a further row, reconciled later than the one before, and
    :func:`slotwise.operators.monitoring.current_cycles` takes the last.
    """
    touched = predictions.select(F.col("target_time").alias("cycle")).unionAll(
        observations.select(F.col("ingestion_timestamp").alias("cycle"))
    )

    def reconcile(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        times = materialise(batch.where("cycle IS NOT NULL").distinct(), "touched-cycles")
        span = _span(times, "cycle")
        if span["lo"] is None:
            return
        first, last = span["lo"].date(), span["hi"].date()
        predicted = read_predicted(first - timedelta(days=horizon_days), last)
        predicted = predicted.join(times, F.col("target_time") == F.col("cycle"), "left_semi")
        observed = read_observed(first, last).join(times, F.col("ingestion_timestamp") == F.col("cycle"), "left_semi")
        found = materialise(cycle_metrics(predicted, observed, reconciled_at), "reconciled")
        same = [c for c in CYCLE_METRICS.fieldNames() if c not in ("cycle_timestamp", "reconciled_at")]
        stored = current_cycles(read_table(spark, cycles_path, CYCLE_METRICS, first, last))
        stored = stored.select("cycle_timestamp", F.col("reconciled_at").alias("_before"), F.struct(*same).alias("_known"))
        both = conform(found, CYCLE_METRICS).join(stored, "cycle_timestamp", "left")
        changed = both.where(~F.struct(*same).eqNullSafe(F.col("_known")))
        after = F.greatest("reconciled_at", F.col("_before") + F.expr("INTERVAL '0.000001' SECOND"))
        changed = conform(changed.withColumn("reconciled_at", after), CYCLE_METRICS)
        changed = materialise(changed, "changed-cycles")
        if not changed.isEmpty():
            append_cycle_metrics(changed, cycles_path)

    writer = touched.writeStream.foreachBatch(reconcile).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def matched_stream(predictions: DataFrame, snapshots: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Predictions joined with the snapshot of their target time, both as streams.

    Watermarks on both sides let Spark drop state once a target time is past. A snapshot
    delivered again within ``delay`` pairs once.
    """
    p = predictions.withWatermark("target_time", delay)
    s = snapshots.select(
        F.col("id").alias("_id"), "ingestion_timestamp", F.col("dock_bikes").alias("observed")
    ).withWatermark("ingestion_timestamp", delay)
    s = s.dropDuplicatesWithinWatermark(["_id", "ingestion_timestamp"])
    pairs = p.join(s, F.expr("station_id = _id AND target_time = ingestion_timestamp"))
    return pairs.select(
        "station_id",
        "target_time",
        "model_version",
        (F.col("predicted_dock_bikes") - F.col("observed")).alias("error"),
    )


def error_windows(
    cycles: DataFrame, window: str = "1 day", slide: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Cycles and their mean error per closed event-time window.

    Tumbling days by default; ``window="24 hours", slide="15 minutes"`` is the sliding
    error the performance alert reads. Rows later than ``delay`` are dropped here and
    repaired by the daily batch job.
    """
    w = F.window("cycle_timestamp", window, slide) if slide else F.window("cycle_timestamp", window)
    grouped = cycles.withWatermark("cycle_timestamp", delay).groupBy(w.alias("w"))
    sums = grouped.agg(F.count("*").alias("n_cycles"), F.avg("mae").alias("avg_mae"))
    return sums.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "n_cycles",
        "avg_mae",
    )


__all__ = [
    "dedup_stream",
    "document_stream",
    "error_windows",
    "ingest_stream",
    "matched_stream",
    "rejected_stream",
    "start_reconcile",
    "start_scoring",
    "start_table",
    "table_history",
    "table_stream",
]
