"""Row selection: keep-last, activity, trimming, key sets, column choice, sampling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.config import DEFAULTS, SERIES, SeriesSpec
from slotwise.functions.time import days_before

IDENTIFIERS = ("station_id", "snapshot_timestamp", "target_dock_bikes_1h")


def instant(value: str | date | datetime) -> Column:
    """A UTC instant literal; a plain date means its midnight."""
    return F.to_timestamp(F.lit(str(value)))


def utc(column: Column) -> Column:
    """An instant as UTC wall-clock time, which reaches Python unchanged whatever the time
    zone of the driver's machine."""
    return column.cast("timestamp_ntz")


def keep_last(
    df: DataFrame,
    spec: SeriesSpec = SERIES,
    keys: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """One row per (key, slot): the one that arrived last.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so however many
    copies a hot slot has, each input task sends one row of it. The value breaks ties of
    the arrival columns, which makes every branch of a plan pick the same value.
    """
    keys = tuple(keys or (spec.key, spec.time))
    arrival = tuple(order or (c for c in spec.arrival if c in df.columns))
    last = [F.col(c).desc_nulls_last() for c in (*arrival, spec.value) if c in df.columns]
    w = Window.partitionBy(*keys).orderBy(*last)
    kept = df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
    return kept if order else kept.drop(*arrival)


def active_for_training(df: DataFrame) -> DataFrame:
    """``no_available`` is deliberately not looked at here."""
    return df.where("activate = 1")


def active_for_scoring(df: DataFrame) -> DataFrame:
    return df.where("activate = 1 AND no_available = 0")


def with_target(df: DataFrame, spec: SeriesSpec = SERIES) -> DataFrame:
    return df.where(F.col(spec.target).isNotNull())


def since(df: DataFrame, start: str | date, spec: SeriesSpec = SERIES) -> DataFrame:
    """Drop warm-up rows before the UTC midnight of ``start``; call it after the features."""
    return df.where(F.col(spec.time) >= instant(start))


def on_date(df: DataFrame, day: str | date, column: str = SERIES.time) -> DataFrame:
    """Rows of one UTC date, as a half-open range that reaches the file scan."""
    start = instant(day)
    return df.where((F.col(column) >= start) & (F.col(column) < days_before(start, -1)))


def at_slot(df: DataFrame, slot: Column, spec: SeriesSpec = SERIES) -> DataFrame:
    return df.where(F.col(spec.time) == slot)


def before(df: DataFrame, slot: Column, spec: SeriesSpec = SERIES) -> DataFrame:
    return df.where(F.col(spec.time) < slot)


def trailing(df: DataFrame, column: str, as_of: str | datetime, hours: int) -> DataFrame:
    """Rows of the ``hours`` up to ``as_of``, both ends included."""
    end = instant(as_of)
    start = end - F.expr(f"INTERVAL '{hours}' HOUR")
    return df.where((F.col(column) >= start) & (F.col(column) <= end))


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order."""
    return [c for c in columns if c in df.columns]


def without_identifiers(df: DataFrame) -> DataFrame:
    """Every column but the identifiers and the target."""
    return df.drop(*IDENTIFIERS)


def only_keys(df: DataFrame, keys: DataFrame, spec: SeriesSpec = SERIES) -> DataFrame:
    return df.join(keys.select(spec.key), spec.key, "left_semi")


def skipped_keys(snapshot: DataFrame, spec: SeriesSpec = SERIES) -> DataFrame:
    """Keys in the snapshot that cannot be scored, sorted."""
    active = active_for_scoring(snapshot).select(spec.key).distinct()
    skipped = snapshot.select(spec.key).distinct().join(active, spec.key, "left_anti")
    return skipped.orderBy(spec.key)


def union_history(history: DataFrame, current: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks become null."""
    return history.unionByName(current, allowMissingColumns=True)


def sample_series(
    df: DataFrame,
    n: int = 100,
    seed: int = DEFAULTS.seed,
    spec: SeriesSpec = SERIES,
) -> DataFrame:
    """All rows of ``n`` keys, picked by hash so that a re-run picks the same ones.

    Whole series are kept because lags over sampled rows would be meaningless.
    """
    chosen = (
        df.select(spec.key)
        .distinct()
        .orderBy(F.md5(F.concat(F.col(spec.key).cast("string"), F.lit(f":{seed}"))), spec.key)
        .limit(n)
    )
    return only_keys(df, chosen, spec)
