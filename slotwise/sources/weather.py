"""Hourly forecast documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.schemas import FORECAST_DOCUMENT, WEATHER_COLUMNS, WEATHER_FIELDS


def read_forecasts(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(FORECAST_DOCUMENT).option("multiLine", multiline).json(path)


def forecast_rows(documents: DataFrame) -> DataFrame:
    """One row per forecast hour of each document, other document columns kept."""
    others = [c for c in documents.columns if c != "hourly"]
    fields = [F.col(f"hourly.{name}").alias(name) for name in ("time", *WEATHER_COLUMNS)]
    zipped = documents.select(*others, F.arrays_zip(*fields).alias("_z"))
    return zipped.select(*others, F.inline("_z"))


def current_weather(documents: DataFrame, as_of: Column, zone: str = "UTC") -> DataFrame:
    """The forecast of the hour ``as_of`` falls in, else the last one; one row per document.

    The hour is looked up inside the arrays, so nothing is exploded or shuffled. The
    document's local time text is stamped as UTC, as the reference does; ``zone`` says in
    which zone the hour of ``as_of`` is formatted. A missing rain probability is 0.
    """
    hour = F.date_format(F.from_utc_timestamp(as_of, zone), "yyyy-MM-dd'T'HH:00")
    times = F.col("hourly.time")
    found = F.array_position(times, hour)
    slot = F.when(found > 0, found).otherwise(F.size(times)).cast("int")
    at = {name: F.try_element_at(F.col(f"hourly.{name}"), slot) for name in WEATHER_COLUMNS}
    at["precipitation_probability"] = F.coalesce(at["precipitation_probability"], F.lit(0.0))
    others = [c for c in documents.columns if c != "hourly"]
    return documents.select(
        *others,
        F.to_timestamp(F.try_element_at(times, slot)).alias("timestamp"),
        *[at[name].cast(kind).alias(name) for name, kind in WEATHER_FIELDS],
    )
