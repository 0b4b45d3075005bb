"""The training dataset, the training job and the drift job."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame

from slotwise.config import DEFAULTS, SERIES, Settings
from slotwise.ml import model as trees
from slotwise.operators.drift import categorical_columns, feature_drift, numeric_columns
from slotwise.operators.features import all_features
from slotwise.operators.metrics import critical_states, evaluate
from slotwise.operators.rows import (
    active_for_training,
    on_date,
    sample_series,
    since,
    with_target,
    without_identifiers,
)
from slotwise.operators.split import temporal_split
from slotwise.session import materialise
from slotwise.sources.snapshots import snapshots_between


def _date(value: str | date) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def training_dataset(
    snapshots: DataFrame,
    start: str | date | None = None,
    end: str | date | None = None,
    settings: Settings = DEFAULTS,
    **options,
) -> DataFrame:
    """Features and target of the active rows between two inclusive UTC dates.

    The warm-up days before ``start`` are read for the windows and trimmed after them:
    Spark cannot move a time filter below a window, so the bound is set here. ``options``
    (lag mode, one-off holidays) go to ``all_features``.
    """
    first = _date(start) - timedelta(days=settings.warmup_days) if start else None
    rows = active_for_training(snapshots_between(snapshots, first, end))
    featured = with_target(all_features(rows, settings=settings, **options))
    return since(featured, start) if start else featured


def training_window(end: str | date, settings: Settings = DEFAULTS) -> tuple[date, date]:
    """The sliding window of a training run that ends on ``end``."""
    days = settings.train_days + settings.val_days + settings.test_days
    return _date(end) - timedelta(days=days), _date(end)


def train_run(
    snapshots: DataFrame,
    end: str | date,
    params: dict | None = None,
    settings: Settings = DEFAULTS,
    **options,
) -> dict:
    """Dataset, split, fit, evaluation. The dataset is written once, as trees pass over it
    again and again."""
    start, last = training_window(end, settings)
    data = materialise(training_dataset(snapshots, start, last, settings, **options), "training")
    train, val, test, short = temporal_split(
        data, settings.train_days, settings.val_days, settings.test_days
    )
    model = trees.train_model(train, val, params)
    scored = trees.predict(model, test)
    return {
        "model": model,
        "test": test,
        "short_train": short,
        "metrics": evaluate(scored),
        "critical_states": critical_states(scored),
    }


def drift_windows(
    snapshots: DataFrame,
    day: str | date,
    saved_at: datetime,
    settings: Settings = DEFAULTS,
    equal_warmup: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(reference, current) feature frames.

    The current day has warm-up history. The reference window, the training days before
    the model was saved, has none unless ``equal_warmup``; its rows with null lags stay. With
    ``settings.drift_stations`` it is sampled by whole stations before the features are built.
    """
    warmup = timedelta(days=settings.warmup_days)
    rows = active_for_training(snapshots)
    current = all_features(snapshots_between(rows, _date(day) - warmup, day), settings=settings, **options)
    start = (saved_at - timedelta(days=settings.train_days)).date()
    first = start - warmup if equal_warmup else start
    window = snapshots_between(rows, first, saved_at.date())
    if settings.drift_stations is not None:
        window = sample_series(window, settings.drift_stations, settings.seed)
    reference = all_features(window, settings=settings, **options)
    if equal_warmup:
        reference = since(reference, start)
    return reference, on_date(current, day, SERIES.time)


def n_tested(df: DataFrame) -> int:
    """How many columns the drift tests look at."""
    features = without_identifiers(df)
    return len(numeric_columns(features)) + len(categorical_columns(features))


def drift_job(
    snapshots: DataFrame, day: str | date, saved_at: datetime, settings: Settings = DEFAULTS
) -> DataFrame:
    """The drift summary row of a date. Both windows are written once: each test and count
    would otherwise rebuild the features."""
    from slotwise.operators.drift import drift_summary

    reference, current = drift_windows(snapshots, day, saved_at, settings)
    reference = materialise(reference, "drift-reference")
    current = materialise(current, "drift-current")
    n_reference, n_current = reference.count(), current.count()
    if not n_reference or not n_current:
        return snapshots.sparkSession.createDataFrame(
            [(_date(day), 0, 0.0, [], n_reference, n_current)], _summary_schema()
        )
    tested = feature_drift(reference, current, settings.drift_p_value)
    return drift_summary(tested, day, n_tested(current), n_reference, n_current)


def _summary_schema():
    from slotwise.schemas import DRIFT_SUMMARY

    return DRIFT_SUMMARY
