"""Snapshot documents and the fact table as flat snapshot rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.time import floor_slot, parse_iso, trunc_minute
from slotwise.operators.quality import split_documents
from slotwise.operators.rows import instant
from slotwise.schemas import SNAPSHOT_COLUMNS, SNAPSHOT_DOCUMENT, WEATHER_COLUMNS

CORRUPT = "_corrupt"


def read_documents(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Documents as declared, folder dates (``dt``, ``hh``) included if there are any.

    ``multiline`` for one document per file, off for one per line (what
    :func:`slotwise.sources.sinks.write_raw` writes), which splits large files.
    """
    schema = T.StructType([*SNAPSHOT_DOCUMENT.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", multiline)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def validate_snapshots(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_documents(documents, CORRUPT if CORRUPT in documents.columns else None)


def flatten_documents(documents: DataFrame, strict: bool = True) -> DataFrame:
    """One row per station of each document; the document's weather on every row.

    ``raw_ts`` and ``seq`` keep the arrival order for keep-last.
    """
    raw_ts = parse_iso(F.col("ingestion_timestamp"), strict)
    rows = documents.select(
        raw_ts.alias("raw_ts"), "weather", F.posexplode("stations.data").alias("seq", "s")
    )
    return rows.select(
        F.col("s.id").alias("station_id"),
        F.col("s.number").alias("station_number"),
        F.col("s.name").alias("station_name"),
        *[F.col(f"s.{c}") for c in SNAPSHOT_COLUMNS[3:8]],
        F.get("s.geometry.coordinates", F.lit(0)).alias("longitude"),
        F.get("s.geometry.coordinates", F.lit(1)).alias("latitude"),
        *[F.col(f"weather.{c}") for c in WEATHER_COLUMNS],
        floor_slot(F.col("raw_ts")).alias("snapshot_timestamp"),
        "raw_ts",
        F.col("seq").cast("long").alias("seq"),
    )


def read_raw_snapshots(
    spark: SparkSession,
    path: str,
    start: str | date | None = None,
    end: str | date | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Flat rows of the raw archive; date bounds prune its ``dt=`` folders."""
    documents = read_documents(spark, path, multiline)
    if "dt" in documents.columns:
        documents = _between(documents, "dt", start, end)
    return flatten_documents(documents)


def _between(df: DataFrame, column: str, start, end) -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(str(end)).cast("date"))
    return df


def flatten_table(rows: DataFrame) -> DataFrame:
    """The nested fact table as flat snapshot rows."""
    ts = F.col("ingestion_timestamp")
    return rows.select(
        F.col("id").alias("station_id"),
        F.col("number").alias("station_number"),
        F.col("name").alias("station_name"),
        *SNAPSHOT_COLUMNS[3:8],
        F.get("geometry.coordinates", F.lit(0)).alias("longitude"),
        F.get("geometry.coordinates", F.lit(1)).alias("latitude"),
        *[F.col(f"weather_snapshot.{c}") for c in WEATHER_COLUMNS],
        floor_slot(trunc_minute(ts)).alias("snapshot_timestamp"),
        ts.alias("raw_ts"),
    )


def read_snapshot_table(
    spark: SparkSession,
    path: str,
    start: str | date | None = None,
    end: str | date | None = None,
    active_only: bool = True,
) -> DataFrame:
    """Active rows of the fact table between two inclusive UTC dates, either optional.

    The dates hit the ``dt`` partition column, so files of other days are not read.
    """
    rows = _between(spark.read.parquet(path), "dt", start, end)
    return flatten_table(rows.where("activate = 1") if active_only else rows)


def snapshots_between(
    snapshots: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    column: str = "snapshot_timestamp",
) -> DataFrame:
    """The same inclusive date range on a frame that has no date partition, as a time
    range that reaches the scan."""
    if start is not None:
        snapshots = snapshots.where(F.col(column) >= instant(start))
    if end is not None:
        snapshots = snapshots.where(F.col(column) < instant(end) + F.expr("INTERVAL '1' DAY"))
    return snapshots


def _weather_values(weather: DataFrame | None) -> Column | None:
    # At most one weather row belongs to a cycle; a second one is an error Spark raises.
    return weather.select(F.struct(*weather.columns)).scalar() if weather is not None else None


def attach_cycle(
    stations: DataFrame, ts: Column, weather: DataFrame | None = None
) -> DataFrame:
    """Fact rows of one cycle: every station with the cycle time and the weather struct."""
    from slotwise.schemas import WEATHER_SNAPSHOT

    values = _weather_values(weather)
    struct = values if values is not None else F.lit(None)
    return stations.withColumns(
        {"ingestion_timestamp": ts, "weather_snapshot": struct.cast(WEATHER_SNAPSHOT)}
    )


def scoring_frame(
    stations: DataFrame,
    ts: str | datetime,
    weather: DataFrame | None = None,
    weather_nulls: str = "zero",
) -> DataFrame:
    """The live station list in the shape of the history rows.

    Missing weather becomes zeros as in the reference; ``weather_nulls="keep"`` leaves
    nulls, as history rows have them.
    """
    from slotwise.schemas import WEATHER_FIELDS

    values = _weather_values(weather)
    columns = {}
    for name, kind in WEATHER_FIELDS:
        value = values[name] if values is not None else F.lit(None)
        value = value.cast(kind)
        columns[name] = F.coalesce(value, F.lit(0).cast(kind)) if weather_nulls == "zero" else value
    flat = stations.select(
        F.col("id").alias("station_id"),
        F.col("number").alias("station_number"),
        F.col("name").alias("station_name"),
        *SNAPSHOT_COLUMNS[3:8],
        F.get("geometry.coordinates", F.lit(0)).alias("longitude"),
        F.get("geometry.coordinates", F.lit(1)).alias("latitude"),
    )
    return flat.withColumns({**columns, "snapshot_timestamp": floor_slot(instant(ts))})
