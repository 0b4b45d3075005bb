from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from slotwise.session import build_session

FLAT = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("station_id", T.LongType()),
            ("station_number", T.StringType()),
            ("station_name", T.StringType()),
            ("activate", T.IntegerType()),
            ("no_available", T.IntegerType()),
            ("total_bases", T.IntegerType()),
            ("dock_bikes", T.IntegerType()),
            ("free_bases", T.IntegerType()),
            ("longitude", T.DoubleType()),
            ("latitude", T.DoubleType()),
            ("temperature_2m", T.DoubleType()),
            ("apparent_temperature", T.DoubleType()),
            ("precipitation", T.DoubleType()),
            ("precipitation_probability", T.DoubleType()),
            ("wind_speed_10m", T.DoubleType()),
            ("weather_code", T.IntegerType()),
            ("is_day", T.IntegerType()),
            ("direct_radiation", T.DoubleType()),
            ("snapshot_timestamp", T.TimestampType()),
        )
    ]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "slotwise-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def row(station, ts, bikes, **changes):
    values = {
        "station_id": station,
        "station_number": str(station),
        "station_name": f"Station {station}",
        "activate": 1,
        "no_available": 0,
        "total_bases": 24,
        "dock_bikes": bikes,
        "free_bases": 24 - bikes,
        "longitude": -3.70 + 0.01 * station,
        "latitude": 40.42 + 0.01 * station,
        "temperature_2m": 10.0,
        "apparent_temperature": 5.0,
        "precipitation": 1.5,
        "precipitation_probability": 80.0,
        "wind_speed_10m": 5.0,
        "weather_code": 61,
        "is_day": 1,
        "direct_radiation": 500.0,
        "snapshot_timestamp": ts,
    }
    values.update(changes)
    return tuple(values[f.name] for f in FLAT)


def series(station, start, values, step=15, **changes):
    begin = datetime.fromisoformat(start)
    return [
        row(station, begin + timedelta(minutes=step * i), v, **changes)
        for i, v in enumerate(values)
    ]


@pytest.fixture(scope="session")
def frame(spark):
    def build(rows):
        return spark.createDataFrame(rows, FLAT)

    return build


@pytest.fixture(scope="session")
def raw_df(frame):
    start = "2024-01-15 09:00:00"
    return frame(series(1, start, range(10, 20)) + series(2, start, range(20, 30), total_bases=40))


def by_key(df, *columns):
    """Rows as {(station, slot): values}."""
    picked = df.select("station_id", "snapshot_timestamp", *columns).collect()
    return {(r[0], r[1]): tuple(r[2:]) if len(columns) > 1 else r[2] for r in picked}


def ts(text):
    return datetime.fromisoformat(text)
