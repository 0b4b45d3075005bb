"""Split by time, and the dataset profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.config import DEFAULTS, SERIES, SeriesSpec
from slotwise.functions.time import days_before
from slotwise.operators.rows import instant, utc


def label_split(
    df: DataFrame,
    val_days: int = DEFAULTS.val_days,
    test_days: int = DEFAULTS.test_days,
    spec: SeriesSpec = SERIES,
) -> DataFrame:
    """Add ``split``: the last ``test_days`` are test, the ``val_days`` before them val,
    everything earlier train. The latest time is a scalar subquery of the same plan."""
    latest = df.agg(F.max(spec.time)).scalar()
    test_from = days_before(latest, test_days)
    val_from = days_before(latest, test_days + val_days)
    time = F.col(spec.time)
    return df.withColumn(
        "split",
        F.when(time >= test_from, "test").when(time >= val_from, "val").otherwise("train"),
    )


def temporal_split(
    df: DataFrame,
    train_days: int = DEFAULTS.train_days,
    val_days: int = DEFAULTS.val_days,
    test_days: int = DEFAULTS.test_days,
    spec: SeriesSpec = SERIES,
    ordered: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """(train, val, test, train is shorter than ``train_days``).

    One small aggregate finds the cut-offs and the sizes; an empty frame, val or test
    raises ``ValueError``, a short train part does not. ``ordered`` sorts the parts by time and
    key, for callers that write or show them; nothing here needs it.
    """
    labelled = label_split(df, val_days, test_days, spec)
    sizes = {
        row["split"]: row
        for row in labelled.groupBy("split")
        .agg(F.count("*").alias("n"), utc(F.min(spec.time)).alias("lo"), utc(F.max(spec.time)).alias("hi"))
        .collect()
    }
    if not sizes or all(row["hi"] is None for row in sizes.values()):
        raise ValueError("nothing to split: no rows with a time")
    for part, days in (("val", val_days + test_days + 1), ("test", test_days + 1)):
        if part not in sizes:
            raise ValueError(f"{part} split is empty; at least {days} days of data are needed")
    latest = instant(sizes["test"]["hi"])
    test_from = days_before(latest, test_days)
    val_from = days_before(latest, test_days + val_days)
    time = F.col(spec.time)
    train = sizes.get("train")
    short = train is None or (train["hi"] - train["lo"]).days < train_days
    parts = [df.where(time < val_from), df.where((time >= val_from) & (time < test_from)), df.where(time >= test_from)]
    if ordered:
        parts = [part.orderBy(spec.time, spec.key) for part in parts]
    return (*parts, short)


def split_profile(df: DataFrame, **days: int) -> DataFrame:
    """Rows and time range of each part."""
    return (
        label_split(df, **days)
        .groupBy("split")
        .agg(
            F.count("*").alias("n_rows"),
            F.min(SERIES.time).alias("first_slot"),
            F.max(SERIES.time).alias("last_slot"),
        )
    )


def data_profile(df: DataFrame, spec: SeriesSpec = SERIES) -> DataFrame:
    """Rows, distinct keys and time range; counted per key first, so that no task sees all
    keys of all rows."""
    per_key = df.groupBy(spec.key).agg(
        F.count("*").alias("n"), F.min(spec.time).alias("lo"), F.max(spec.time).alias("hi")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(spec.key).alias("n_stations"),
        F.min("lo").alias("first_slot"),
        F.max("hi").alias("last_slot"),
    )
