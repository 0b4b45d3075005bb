"""Batch scoring of snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.config import DEFAULTS, SERIES, SeriesSpec, Settings
from slotwise.functions.numeric import rounded_count
from slotwise.functions.time import floor_slot, hours_after
from slotwise.ml.model import TreeModel, predict
from slotwise.operators.features import (
    DAY_SECONDS,
    LAGS,
    SERIES_FEATURES,
    all_features,
    current_state,
    station_features,
    temporal_features,
    weather_features,
)
from slotwise.operators.rows import (
    active_for_scoring,
    at_slot,
    before,
    instant,
    only_keys,
    union_history,
)
from slotwise.session import materialise


def scoring_features(
    snapshot: DataFrame,
    history: DataFrame | None,
    ts: str | datetime,
    settings: Settings = DEFAULTS,
    **options,
) -> DataFrame:
    """Features of the scorable stations at the slot of ``ts``.

    History is cut to those stations, to earlier slots and to ``settings.history_days`` before
    any window runs, and written once: as the result of a join by station it would be hashed by
    station already, so every branch of ``all_features`` would repeat the cut, with all its sorts,
    in the one stage of the windows. Without history the lag and statistics columns are null.
    ``options`` go to ``all_features``; give those the model was trained with.
    """
    slot = floor_slot(instant(ts))
    current = active_for_scoring(snapshot)
    if history is not None:
        past = only_keys(before(history, slot), current.select(SERIES.key).distinct())
        if settings.history_days is not None:
            first = F.date_trunc("day", slot) - F.expr(f"INTERVAL '{settings.history_days}' DAY")
            past = past.where(F.col(SERIES.time) >= first)
        current = materialise(union_history(past, current), "scoring-rows")
    return at_slot(all_features(current, settings=settings, **options), slot)


def _past_days(past: DataFrame, slot: Column, spec: SeriesSpec, settings: Settings) -> DataFrame:
    """Per (station, UTC date): the slot hour's means, the day's own turnover, its first, last and last four values.

    A slot delivered more than once counts with its last arrival. A day has at most one row per
    slot, so its array is bounded whatever the history.
    """
    value, at = F.col(spec.value).cast("double"), F.col(spec.time)
    arrival = [c for c in spec.arrival if c in past.columns]
    kept = past.groupBy(spec.key, spec.time).agg(F.max_by(spec.value, F.struct(*arrival, spec.value)).alias(spec.value))
    local = lambda c: F.from_utc_timestamp(c, settings.local_zone)
    this_hour = F.hour(local(at)) == F.hour(local(slot))
    this_weekday = this_hour & (F.weekday(local(at)) == F.weekday(local(slot)))
    back = lambda seconds: F.max(F.when(F.unix_seconds(at) == F.unix_seconds(slot) - seconds, value))
    step = settings.slot_minutes * 60
    days = kept.repartition(spec.key).groupBy(spec.key, F.to_date(at).alias("_date")).agg(
        F.max(this_hour).alias("has_hour"),
        F.avg(F.when(this_hour, value)).alias("hour_mean"),
        F.max(this_weekday).alias("has_weekday"),
        F.avg(F.when(this_weekday, value)).alias("weekday_mean"),
        back(settings.lookback_days * DAY_SECONDS).alias("week_ago"),
        *[back(n * step).alias(f"at_{name}") for name, n in LAGS.items()],
        F.transform(F.sort_array(F.collect_list(F.struct(F.unix_micros(at).alias("t"), value.alias("v")))), lambda x: x["v"]).alias("values"),
    )
    size = F.size("values")
    inner = F.aggregate(
        F.sequence(F.lit(1), size),
        F.lit(0.0),
        lambda total, i: total + F.when(i > 1, F.coalesce(F.abs(F.get("values", i - 1) - F.get("values", i - 2)), F.lit(0.0))).otherwise(0.0),
    )
    return days.withColumns(
        {
            "inner": inner,
            "first": F.get("values", F.lit(0)),
            "last": F.element_at("values", -1),
            "tail": F.slice("values", F.greatest(size - settings.horizon_rows + 1, F.lit(1)), F.lit(settings.horizon_rows)),
        }
    ).drop("values")


def _mean(values: Column) -> Column:
    known = F.filter(values, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def _deviation(values: Column) -> Column:
    """Sample deviation of an array's values; null below two of them."""
    known, mean = F.filter(values, lambda x: x.isNotNull()), _mean(values)
    squares = F.aggregate(known, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return F.when(F.size(known) > 1, F.sqrt(F.try_divide(squares, F.size(known) - 1)))


def _newest(rows: Column, n: int) -> Column:
    return F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), F.lit(n))


def past_state(
    history: DataFrame,
    slot: Column,
    settings: Settings = DEFAULTS,
    mode: str = "rows",
    spec: SeriesSpec = SERIES,
) -> DataFrame:
    """Per station what the features of one slot need of the slots before it.

    Three group-bys and no window: (station, slot) keeps the last arrival and adds up within
    each task before anything moves, (station, date) and (station) then work on the same
    placement. A station's last array has one entry per day.
    """
    if mode not in ("rows", "time"):
        raise ValueError(f"unknown lag mode {mode!r}")
    past = history.dropna(subset=[spec.key, spec.time]).where(F.col(spec.time) < slot)
    if settings.history_days is not None:
        first = F.date_trunc("day", slot) - F.expr(f"INTERVAL '{settings.history_days}' DAY")
        past = past.where(F.col(spec.time) >= first)
    days = _past_days(past, slot, spec, settings)
    fields = ("_date", "has_hour", "hour_mean", "has_weekday", "weekday_mean", "inner", "first", "last", "tail")
    state = days.groupBy(spec.key).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("days"),
        F.max("week_ago").alias("week_ago"),
        *[F.max(f"at_{name}").alias(f"at_{name}") for name in LAGS],
    )
    joints = F.transform(  # the change from the last value of the day before to the first of the day
        "days",
        lambda d, i: F.struct(
            d["_date"].alias("_date"),
            (d["inner"] + F.when(i > 0, F.coalesce(F.abs(d["first"] - F.get("days", i - 1)["last"]), F.lit(0.0))).otherwise(0.0)).alias("turnover"),
        ),
    )
    earlier = lambda rows: F.filter(rows, lambda d: d["_date"] < F.to_date(slot))
    hours = _newest(F.filter(earlier("days"), lambda d: d["has_hour"]), settings.rolling_days)
    weekdays = F.filter(earlier("days"), lambda d: d["has_weekday"])
    if settings.expanding_rows is not None:
        weekdays = _newest(weekdays, settings.expanding_rows)
    means = lambda rows, field: F.transform(rows, lambda d: d[field])
    last = F.flatten(F.transform("days", lambda d: d["tail"]))
    lags = {
        name: F.get(last, F.size(last) - n) if mode == "rows" else F.col(f"at_{name}") for name, n in LAGS.items()
    }
    return state.select(
        spec.key,
        *[c.alias(name) for name, c in lags.items()],
        _mean(means(hours, "hour_mean")).alias("avg_dock_same_hour_7d"),
        _deviation(means(hours, "hour_mean")).alias("std_dock_same_hour_7d"),
        _mean(means(weekdays, "weekday_mean")).alias("avg_dock_same_weekday"),
        _mean(means(_newest(earlier(joints), settings.rolling_days), "turnover")).alias("station_daily_turnover"),
        F.col("week_ago").alias("dock_bikes_same_time_1w"),
    )


def slot_features(
    snapshot: DataFrame,
    history: DataFrame | None,
    ts: str | datetime,
    settings: Settings = DEFAULTS,
    mode: str = "rows",
    spec: SeriesSpec = SERIES,
    one_off_holidays: tuple = (),
) -> DataFrame:
    """What :func:`scoring_features` gives, without computing the features of any other slot.

    ``snapshot`` holds the cycle's rows; it and the history are scanned once each. Rows of the
    snapshot at other slots are left out.
    """
    slot = floor_slot(instant(ts))
    current = at_slot(active_for_scoring(snapshot), slot, spec).dropna(subset=[spec.key])
    arrival = [c for c in spec.arrival if c in current.columns]
    row = F.struct(*[c for c in current.columns if c not in arrival])
    last = F.max_by(row, F.struct(*arrival, spec.value)).alias("row")
    wide = current_state(current.groupBy(F.col(spec.key).alias("_key")).agg(last).select("row.*"), spec)
    wide = temporal_features(wide, spec, settings, one_off_holidays)
    wide = station_features(weather_features(wide))
    columns = [c for c in wide.columns if c not in (spec.key, spec.time)]
    if history is None:
        state = wide.select(spec.key).limit(0)
        names = [c for c in SERIES_FEATURES if c != "delta_dock_15m"]
        state = state.withColumns({c: F.lit(None).cast("double") for c in names})
    else:
        state = past_state(history, slot, settings, mode, spec)
    joined = wide.join(state, spec.key, "left")
    joined = joined.withColumn("delta_dock_15m", F.col(spec.value).cast("double") - F.col("dock_bikes_lag_15m"))
    target = F.lit(None).cast("double").alias(spec.target)
    return joined.select(spec.key, spec.time, *columns, *SERIES_FEATURES, target)


def as_predictions(
    scored: DataFrame, made_at: Column, version: str, value: str = "prediction"
) -> DataFrame:
    """Prediction rows: counts rounded half to even, never negative, one hour ahead of the
    unfloored cycle time."""
    return scored.select(
        SERIES.key,
        made_at.alias("prediction_made_at"),
        hours_after(made_at, DEFAULTS.horizon_hours).alias("target_time"),
        rounded_count(F.col(value)).alias("predicted_dock_bikes"),
        F.lit(version).alias("model_version"),
    )


def score(
    model: TreeModel,
    version: str,
    snapshot: DataFrame,
    ts: str | datetime,
    history: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    **options,
) -> DataFrame:
    """Predictions for one cycle; empty if no station is active and available."""
    rows = predict(model, slot_features(snapshot, history, ts, settings, **options))
    return as_predictions(rows, instant(ts), version)


def score_slots(
    model: TreeModel,
    version: str,
    batch: DataFrame,
    history: DataFrame,
    settings: Settings = DEFAULTS,
    **options,
) -> DataFrame:
    """Predictions for every cycle in ``batch``, a catch-up of several slots included.

    A row sees the slots before its own, from the history and from the batch itself. A row
    both sides hold is taken once by keep-last. Predictions are made at the arrival time of the
    row (``raw_ts``) where the batch has it, else at its slot; the target lies an hour after.
    """
    rows = union_history(history, batch).where("activate = 1")
    made_at = F.col("raw_ts") if "raw_ts" in batch.columns else F.col(SERIES.time)
    made_at = F.coalesce(made_at, F.col(SERIES.time))
    wanted = active_for_scoring(batch).groupBy(SERIES.key, SERIES.time).agg(F.max(made_at).alias("_made_at"))
    featured = all_features(rows, settings=settings, **options).join(wanted, [SERIES.key, SERIES.time])
    return as_predictions(predict(model, featured), F.col("_made_at"), version)
