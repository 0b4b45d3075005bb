"""Declared schemas, the feature catalog and the district boxes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


WEATHER_FIELDS = (
    ("temperature_2m", T.DoubleType()),
    ("apparent_temperature", T.DoubleType()),
    ("precipitation", T.DoubleType()),
    ("precipitation_probability", T.DoubleType()),
    ("wind_speed_10m", T.DoubleType()),
    ("weather_code", T.IntegerType()),
    ("is_day", T.IntegerType()),
    ("direct_radiation", T.DoubleType()),
)
WEATHER_COLUMNS = tuple(name for name, _ in WEATHER_FIELDS)

WEATHER = _struct(("timestamp", T.StringType()), *WEATHER_FIELDS)
GEOMETRY = _struct(("type", T.StringType()), ("coordinates", T.ArrayType(T.DoubleType())))
STATION = _struct(
    ("id", T.LongType()),
    ("number", T.StringType()),
    ("name", T.StringType()),
    ("activate", T.IntegerType()),
    ("no_available", T.IntegerType()),
    ("total_bases", T.IntegerType()),
    ("dock_bikes", T.IntegerType()),
    ("free_bases", T.IntegerType()),
    ("geometry", GEOMETRY),
)
STATIONS = _struct(
    ("code", T.StringType()),
    ("description", T.StringType()),
    ("datetime", T.StringType()),
    ("data", T.ArrayType(STATION)),
)
SNAPSHOT_DOCUMENT = _struct(
    ("ingestion_timestamp", T.StringType()), ("stations", STATIONS), ("weather", WEATHER)
)

WEATHER_SNAPSHOT = _struct(("timestamp", T.TimestampType()), *WEATHER_FIELDS)
STATION_STATUS_RAW = T.StructType(
    STATION.fields
    + _struct(
        ("ingestion_timestamp", T.TimestampType()), ("weather_snapshot", WEATHER_SNAPSHOT)
    ).fields
)

FORECAST_DOCUMENT = _struct(
    (
        "hourly",
        _struct(
            ("time", T.ArrayType(T.StringType())),
            *((name, T.ArrayType(kind)) for name, kind in WEATHER_FIELDS),
        ),
    )
)

SNAPSHOT_COLUMNS = (
    "station_id",
    "station_number",
    "station_name",
    "activate",
    "no_available",
    "total_bases",
    "dock_bikes",
    "free_bases",
    "longitude",
    "latitude",
    *WEATHER_COLUMNS,
    "snapshot_timestamp",
)

PREDICTIONS = _struct(
    ("station_id", T.LongType()),
    ("prediction_made_at", T.TimestampType()),
    ("target_time", T.TimestampType()),
    ("predicted_dock_bikes", T.DoubleType()),
    ("model_version", T.StringType()),
)
CYCLE_METRICS = _struct(
    ("cycle_timestamp", T.TimestampType()),
    ("model_version", T.StringType()),
    ("n_predictions", T.LongType()),
    ("mae", T.DoubleType()),
    ("rmse", T.DoubleType()),
    ("p50_error", T.DoubleType()),
    ("p90_error", T.DoubleType()),
    ("worst_station_id", T.LongType()),
    ("worst_station_error", T.DoubleType()),
    ("reconciled_at", T.TimestampType()),
)
STATION_DAILY = _struct(
    ("date", T.DateType()),
    ("station_id", T.LongType()),
    ("model_version", T.StringType()),
    ("n_cycles", T.LongType()),
    ("daily_mae", T.DoubleType()),
    ("daily_rmse", T.DoubleType()),
)
DAILY_TOTALS = _struct(
    ("date", T.DateType()),
    ("model_version", T.StringType()),
    ("n_stations", T.LongType()),
    ("n_cycles", T.LongType()),
    ("daily_mae", T.DoubleType()),
    ("daily_rmse", T.DoubleType()),
)
MODEL_RUNS = _struct(
    ("version", T.StringType()),
    ("saved_at", T.TimestampType()),
    ("feature_names", T.ArrayType(T.StringType())),
    ("num_trees", T.IntegerType()),
    ("metrics", T.MapType(T.StringType(), T.DoubleType())),
    (
        "top_features",
        T.ArrayType(_struct(("feature", T.StringType()), ("gain", T.DoubleType()))),
    ),
)
PROMOTIONS = _struct(("version", T.StringType()), ("promoted_at", T.TimestampType()))
DRIFT_SUMMARY = _struct(
    ("date", T.DateType()),
    ("n_drifted_features", T.LongType()),
    ("share_drifted", T.DoubleType()),
    ("drifted_feature_names", T.ArrayType(T.StringType())),
    ("n_reference_rows", T.LongType()),
    ("n_current_rows", T.LongType()),
)


class Feature(NamedTuple):
    name: str
    dtype: str
    group: str
    description: str


# Names, types and groups of the 35 model features in their contract order. The descriptions are ours.
FEATURES = (
    Feature("dock_bikes_now", "int", "lag", "bikes docked in this slot"),
    Feature("free_bases_now", "int", "lag", "free bases in this slot"),
    Feature("occupancy_rate_now", "float", "lag", "docked bikes as a share of all bases"),
    Feature("dock_bikes_lag_15m", "float", "lag", "bikes docked one row earlier"),
    Feature("dock_bikes_lag_30m", "float", "lag", "bikes docked two rows earlier"),
    Feature("dock_bikes_lag_1h", "float", "lag", "bikes docked four rows earlier"),
    Feature("delta_dock_15m", "float", "lag", "change of docked bikes since the row before"),
    Feature("hour_of_day", "int", "temporal", "local hour, 0 to 23"),
    Feature("day_of_week", "int", "temporal", "local weekday, Monday is 0"),
    Feature("is_weekend", "bool", "temporal", "Saturday or Sunday"),
    Feature("month", "int", "temporal", "local month, 1 to 12"),
    Feature("is_holiday", "bool", "temporal", "public holiday on the local date"),
    Feature("minutes_since_midnight", "int", "temporal", "minutes of the local day"),
    Feature("is_rush_hour", "bool", "temporal", "morning or evening rush of a working weekday"),
    Feature("temperature_2m", "float", "meteo", "air temperature, Celsius"),
    Feature("apparent_temperature", "float", "meteo", "felt temperature, Celsius"),
    Feature("precipitation_mm", "float", "meteo", "precipitation of the hour, millimetres"),
    Feature("precipitation_probability", "float", "meteo", "chance of precipitation, percent"),
    Feature("wind_speed_10m", "float", "meteo", "wind speed, kilometres an hour"),
    Feature("is_raining", "bool", "meteo", "any precipitation"),
    Feature("weather_code", "int", "meteo", "weather code of the forecast"),
    Feature("is_day", "bool", "meteo", "daylight"),
    Feature("direct_radiation", "float", "meteo", "direct solar radiation, watts a square metre"),
    Feature("feels_cold", "bool", "meteo", "felt temperature below 8"),
    Feature("feels_hot", "bool", "meteo", "felt temperature above 30"),
    Feature("high_solar_radiation", "bool", "meteo", "direct radiation above 400"),
    Feature("avg_dock_same_hour_7d", "float", "stats", "mean of this hour over the seven dates before"),
    Feature("std_dock_same_hour_7d", "float", "stats", "deviation of this hour over the seven dates before"),
    Feature("avg_dock_same_weekday", "float", "stats", "mean of this weekday and hour over all earlier dates"),
    Feature("station_daily_turnover", "float", "stats", "bikes moved a day, mean of the seven dates before"),
    Feature("dock_bikes_same_time_1w", "float", "stats", "bikes docked exactly one week before"),
    Feature("total_bases", "int", "static", "bases of the station"),
    Feature("latitude", "float", "static", "latitude of the station"),
    Feature("longitude", "float", "static", "longitude of the station"),
    Feature("distrito", "cat", "static", "district of the station"),
)
FEATURE_NAMES = tuple(f.name for f in FEATURES)
BOOL_FEATURES = tuple(f.name for f in FEATURES if f.dtype == "bool")
MODEL_COLUMNS = FEATURE_NAMES + ("station_id",)
TARGET = "target_dock_bikes_1h"


def features_by_group(group: str) -> tuple[Feature, ...]:
    return tuple(f for f in FEATURES if f.group == group)


def feature_catalog(spark: SparkSession) -> DataFrame:
    """The catalog as a 35-row DataFrame: position, name, dtype, group, description."""
    return spark.createDataFrame(
        [(i, *f) for i, f in enumerate(FEATURES)],
        "position int, feature string, dtype string, feature_group string, description string",
    )


class Box(NamedTuple):
    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# The 21 district boxes (WGS84). They overlap; the first match in order wins.
DISTRICT_BOXES = (
    Box("Centro", 40.405, 40.430, -3.715, -3.690),
    Box("Arganzuela", 40.385, 40.410, -3.710, -3.680),
    Box("Retiro", 40.405, 40.430, -3.690, -3.660),
    Box("Salamanca", 40.420, 40.455, -3.690, -3.655),
    Box("Chamartin", 40.445, 40.480, -3.690, -3.650),
    Box("Tetuan", 40.445, 40.480, -3.720, -3.690),
    Box("Chamberi", 40.425, 40.455, -3.720, -3.690),
    Box("Fuencarral-El Pardo", 40.480, 40.560, -3.760, -3.650),
    Box("Moncloa-Aravaca", 40.415, 40.470, -3.760, -3.715),
    Box("Latina", 40.385, 40.425, -3.760, -3.715),
    Box("Carabanchel", 40.360, 40.395, -3.760, -3.700),
    Box("Usera", 40.380, 40.405, -3.710, -3.680),
    Box("Puente de Vallecas", 40.380, 40.415, -3.680, -3.640),
    Box("Moratalaz", 40.400, 40.430, -3.660, -3.620),
    Box("Ciudad Lineal", 40.430, 40.470, -3.670, -3.630),
    Box("Hortaleza", 40.465, 40.510, -3.660, -3.610),
    Box("Villaverde", 40.340, 40.380, -3.720, -3.660),
    Box("Villa de Vallecas", 40.360, 40.400, -3.650, -3.600),
    Box("Vicalvaro", 40.400, 40.440, -3.620, -3.570),
    Box("San Blas-Canillejas", 40.430, 40.470, -3.630, -3.580),
    Box("Barajas", 40.455, 40.500, -3.600, -3.540),
)


def district_boxes(spark: SparkSession) -> DataFrame:
    """The district boxes as a DataFrame with their ordinal."""
    return spark.createDataFrame(
        [(i, *box) for i, box in enumerate(DISTRICT_BOXES)],
        "ordinal int, distrito string, lat_min double, lat_max double, "
        "lon_min double, lon_max double",
    )
