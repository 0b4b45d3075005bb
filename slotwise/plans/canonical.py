"""The given tables as raw snapshots, predictions and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.time import floor_slot
from slotwise.operators.rows import keep_last
from slotwise.session import tune

AS_OF = "2024-01-20 00:00:00"
TARGET_DATE = "2024-01-19"
TRAINING_START = "2024-01-10"
TRAINING_END = "2024-01-20"
REFERENCE_START, REFERENCE_END = "2024-01-07", "2024-01-14"

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def snapshots_from_events(events: DataFrame) -> DataFrame:
    """One raw snapshot per event; every user is a station, at one of eight positions.

    Constants are exact in binary.
    """
    base = events.selectExpr(
        "user_id AS station_id",
        "user_id % 8 AS p",
        "CAST(ts AS TIMESTAMP) AS raw_ts",
        "event_id AS seq",
        "CAST(16 + 2 * (user_id % 8) AS INT) AS total_bases",
        "CAST(floor(value) AS INT) AS v",
        "event_type",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    return base.selectExpr(
        "station_id",
        "CAST(station_id AS STRING) AS station_number",
        "concat('Station ', CAST(station_id AS STRING)) AS station_name",
        "CASE WHEN event_type = 'error' AND k < 10 THEN 0 ELSE 1 END AS activate",
        "CASE WHEN event_type = 'signup' AND k < 10 THEN 1 ELSE 0 END AS no_available",
        "total_bases",
        "v % (total_bases + 1) AS dock_bikes",
        "total_bases - v % (total_bases + 1) AS free_bases",
        "-3.75D + p * 0.015625D AS longitude",
        "40.375D + p * 0.015625D AS latitude",
        "k * 0.5D - 5.0D AS temperature_2m",
        "k * 0.5D - 8.0D AS apparent_temperature",
        "greatest(k - 80, 0) * 0.25D AS precipitation",
        "k * 1.0D AS precipitation_probability",
        "k % 40 * 0.5D AS wind_speed_10m",
        "k % 4 AS weather_code",
        "CAST(hour(raw_ts) BETWEEN 7 AND 20 AS INT) AS is_day",
        "k * 8.0D AS direct_radiation",
        "raw_ts",
        "seq",
    ).withColumn("snapshot_timestamp", floor_slot(F.col("raw_ts")))


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tune(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return snapshots_from_events(events)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshots after keep-last."""
    return keep_last(raw_snapshots(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence predictions, one per (station, slot)."""
    made = F.col("snapshot_timestamp")
    return snapshots(spark, sf_dir).select(
        "station_id",
        made.alias("prediction_made_at"),
        (made + F.expr("INTERVAL '1' HOUR")).alias("target_time"),
        (F.col("dock_bikes") * 1.0).alias("predicted_dock_bikes"),
        F.when(made < F.to_timestamp(F.lit("2024-01-16 00:00:00")), "v20240101_000000")
        .otherwise("v20240116_000000")
        .alias("model_version"),
    )


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots(spark, sf_dir).select(
        F.col("station_id").alias("id"),
        F.col("snapshot_timestamp").alias("ingestion_timestamp"),
        "dock_bikes",
    )
