"""Feature groups over a keyed snapshot series.

Windows by key run on narrow rows (key, slot, value) after keep-last. A key then has at
most one row per slot, about 35,000 a year at 15 minutes, however many raw rows it had;
that bounds every group below. Wide rows are shuffled once, for keep-last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.config import DEFAULTS, SERIES, SeriesSpec, Settings
from slotwise.functions import geo, time
from slotwise.functions.holidays import is_holiday
from slotwise.functions.numeric import ratio
from slotwise.operators.rows import keep_last

DAY_SECONDS = 86_400
LAGS = {"dock_bikes_lag_15m": 1, "dock_bikes_lag_30m": 2, "dock_bikes_lag_1h": 4}


def _slots(spec: SeriesSpec):
    # Ordering by seconds serves row lags and the weekly range frame with one sort.
    return Window.partitionBy(spec.key).orderBy(F.unix_seconds(spec.time))


def _at_offset(value: Column, seconds: int, spec: SeriesSpec) -> Column:
    """The value exactly ``seconds`` away (negative: earlier); null if there is no such row."""
    return F.max(value).over(_slots(spec).rangeBetween(seconds, seconds))


def lag_columns(
    mode: str = "rows", spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> dict[str, Column]:
    """Lags 1, 2 and 4. ``rows`` counts rows as the reference does; ``time`` counts slots,
    so that a gap gives null instead of an older value."""
    value = F.col(spec.value).cast("double")
    if mode == "rows":
        lags = {name: F.lag(value, n).over(_slots(spec)) for name, n in LAGS.items()}
    elif mode == "time":
        slot = settings.slot_minutes * 60
        lags = {name: _at_offset(value, -n * slot, spec) for name, n in LAGS.items()}
    else:
        raise ValueError(f"unknown lag mode {mode!r}")
    return {**lags, "delta_dock_15m": value - lags["dock_bikes_lag_15m"]}


def target_column(
    mode: str = "rows", spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> Column:
    """The value four slots later; null on a key's last four rows."""
    value = F.col(spec.value).cast("double")
    if mode == "rows":
        return F.lead(value, settings.horizon_rows).over(_slots(spec))
    return _at_offset(value, settings.horizon_rows * settings.slot_minutes * 60, spec)


def last_week_column(spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS) -> Column:
    """The value exactly one week before, as a range frame instead of a self join."""
    value = F.col(spec.value).cast("double")
    return _at_offset(value, -settings.lookback_days * DAY_SECONDS, spec)


def current_state(df: DataFrame, spec: SeriesSpec = SERIES) -> DataFrame:
    return df.withColumns(
        {
            "dock_bikes_now": F.col(spec.value),
            "free_bases_now": F.col(spec.free),
            "occupancy_rate_now": ratio(F.col(spec.value), F.col(spec.capacity)),
        }
    )


def lag_features(
    df: DataFrame, mode: str = "rows", spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    """The seven current-state and lag features; needs one row per (key, slot)."""
    return current_state(df, spec).withColumns(lag_columns(mode, spec, settings))


def add_target(
    df: DataFrame, mode: str = "rows", spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    return df.withColumn(spec.target, target_column(mode, spec, settings))


def same_time_last_week(
    df: DataFrame, spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    return df.withColumn("dock_bikes_same_time_1w", last_week_column(spec, settings))


def _local(spec: SeriesSpec, settings: Settings) -> str:
    return f"from_utc_timestamp({spec.time}, '{settings.local_zone}')"


def _local_hour(spec: SeriesSpec, settings: Settings) -> dict[str, Column]:
    local = _local(spec, settings)
    return {"hour_of_day": F.expr(f"hour({local})"), "day_of_week": F.expr(f"weekday({local})")}


def _never_null(column: Column, filler: Column) -> Column:
    # Tells Spark that a join key cannot be null. Without it every join adds its own
    # not-null filter below the shuffle, and the branches no longer share one shuffle.
    return F.coalesce(column, filler)


def temporal_features(
    df: DataFrame,
    spec: SeriesSpec = SERIES,
    settings: Settings = DEFAULTS,
    one_off_holidays: tuple = (),
) -> DataFrame:
    """The seven calendar features, all on local wall-clock time."""
    local = _local(spec, settings)
    dow = F.expr(f"weekday({local})")
    minutes = F.expr(f"hour({local}) * 60 + minute({local})")
    return df.withColumns(
        {
            **_local_hour(spec, settings),
            "is_weekend": dow >= 5,
            "month": F.expr(f"month({local})"),
            "minutes_since_midnight": minutes,
            "is_holiday": is_holiday(f"to_date({local})", extra=one_off_holidays),
            "is_rush_hour": time.is_rush_hour(dow, minutes),
        }
    )


def weather_features(df: DataFrame) -> DataFrame:
    """Renames and strict-threshold flags; null weather gives null flags."""
    return df.withColumns(
        {
            "precipitation_mm": F.col("precipitation"),
            "is_day": F.col("is_day").cast("boolean"),
            "is_raining": F.col("precipitation") > 0.0,
            "feels_cold": F.col("apparent_temperature") < 8.0,
            "feels_hot": F.col("apparent_temperature") > 30.0,
            "high_solar_radiation": F.col("direct_radiation") > 400.0,
        }
    )


def station_features(df: DataFrame, boxes=geo.DISTRICT_BOXES) -> DataFrame:
    return df.withColumn("distrito", geo.first_box("latitude", "longitude", boxes))


LARGEST_LEVEL = 17  # cells of 0.01 * 2^17 degrees are larger than the globe


def first_box_join(points: DataFrame, boxes: DataFrame, cell: float = 0.01) -> DataFrame:
    """First matching box per distinct point, for a box table of any size.

    Points and boxes meet on the cells of a hierarchy of grids, so it is an equi join. A box lies
    on the grid whose cells are the first at least as large as itself, hence in four cells at
    most, whatever its extent; a point looks into one cell of each grid that has boxes, 18 at
    most. ``points`` has latitude and longitude, ``boxes`` ordinal, distrito and the four
    borders; a point without a match keeps a null name.
    """
    side = cell * (1 << LARGEST_LEVEL)
    clipped = lambda c: F.least(F.greatest(F.col(c), F.lit(-side)), F.lit(side))
    cell_of = lambda value, level: F.floor(value / (cell * F.pow(F.lit(2.0), level))).cast("long")

    def cells(low: str, high: str) -> Column:
        return F.explode(F.sequence(cell_of(clipped(low), F.col("_level")), cell_of(clipped(high), F.col("_level"))))

    extent = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"))
    level = F.least(F.ceil(F.log2(F.greatest(extent / cell, F.lit(1.0)))), F.lit(LARGEST_LEVEL)).cast("int")
    grid = boxes.where("lat_min <= lat_max AND lon_min <= lon_max")
    grid = grid.withColumn("_level", level)
    levels = F.array(*[F.lit(r["_level"]) for r in grid.select("_level").distinct().orderBy("_level").collect()]).cast("array<int>")
    grid = grid.withColumn("_y", cells("lat_min", "lat_max")).withColumn("_x", cells("lon_min", "lon_max"))
    sites = points.select("latitude", "longitude").distinct()
    looked = sites.withColumn("_level", F.explode(levels))
    looked = looked.withColumns(
        {"_y": cell_of(clipped("latitude"), F.col("_level")), "_x": cell_of(clipped("longitude"), F.col("_level"))}
    )
    inside = F.col("latitude").between(F.col("lat_min"), F.col("lat_max")) & F.col(
        "longitude"
    ).between(F.col("lon_min"), F.col("lon_max"))
    found = (
        looked.join(grid, ["_level", "_y", "_x"])
        .where(inside)
        .groupBy("latitude", "longitude")
        .agg(F.min_by("distrito", "ordinal").alias("distrito"))
    )
    return sites.join(found, ["latitude", "longitude"], "left")


def _with_date(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.withColumn(
        "_date", _never_null(F.to_date(spec.time), F.lit("1970-01-01").cast("date"))
    )


def hour_stats(
    df: DataFrame, spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    """Per (key, UTC date, local hour): mean and deviation of the hour's daily means over
    the previous seven dates that have the hour. Dates are UTC, hours local."""
    daily = (
        _with_date(df, spec)
        .groupBy(spec.key, "_date", "hour_of_day")
        .agg(F.avg(spec.value).alias("_mean"))
    )
    w = Window.partitionBy(spec.key, "hour_of_day").orderBy("_date")
    w = w.rowsBetween(-settings.rolling_days, -1)
    return daily.select(
        spec.key,
        "_date",
        "hour_of_day",
        F.avg("_mean").over(w).alias("avg_dock_same_hour_7d"),
        F.stddev_samp("_mean").over(w).alias("std_dock_same_hour_7d"),
    )


def weekday_stats(
    df: DataFrame, spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    """Per (key, UTC date, local weekday, local hour): mean of the same weekday's and
    hour's daily means on earlier dates; with ``settings.expanding_rows`` the last so many.

    That limit is the difference of two running sums; a sliding frame would be rescanned on
    every row.
    """
    daily = (
        _with_date(df, spec)
        .groupBy(spec.key, "_date", "day_of_week", "hour_of_day")
        .agg(F.avg(spec.value).alias("_mean"))
    )
    w = Window.partitionBy(spec.key, "day_of_week", "hour_of_day").orderBy("_date")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    total, rows = F.sum("_mean").over(past), F.count("_mean").over(past)
    if settings.expanding_rows is not None:
        expired = w.rowsBetween(Window.unboundedPreceding, -settings.expanding_rows - 1)
        total = total - F.coalesce(F.sum("_mean").over(expired), F.lit(0.0))
        rows = rows - F.count("_mean").over(expired)
    return daily.select(
        spec.key,
        "_date",
        "day_of_week",
        "hour_of_day",
        F.try_divide(total, rows).alias("avg_dock_same_weekday"),
    )


def daily_turnover(
    df: DataFrame, spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    """Per (key, UTC date): mean daily sum of absolute changes over the previous seven
    dates. A key's first row has no change; a day of only that row counts as 0."""
    value = F.col(spec.value)
    change = F.abs(value - F.lag(value, 1).over(_slots(spec)))
    daily = (
        _with_date(df, spec)
        .withColumn("_change", change)
        .groupBy(spec.key, "_date")
        .agg(F.coalesce(F.sum("_change"), F.lit(0)).alias("_turnover"))
    )
    w = Window.partitionBy(spec.key).orderBy("_date").rowsBetween(-settings.rolling_days, -1)
    return daily.select(
        spec.key, "_date", F.avg("_turnover").over(w).alias("station_daily_turnover")
    )


def historical_features(
    df: DataFrame, spec: SeriesSpec = SERIES, settings: Settings = DEFAULTS
) -> DataFrame:
    """The five history features; needs hour_of_day and day_of_week.

    Every group-by, window and join here has the key among its keys, so on input hashed by
    key nothing moves again. Only earlier dates enter a row's value.
    """
    return _join_day_stats(same_time_last_week(df, spec, settings), spec, settings)


def _join_day_stats(df: DataFrame, spec: SeriesSpec, settings: Settings) -> DataFrame:
    k = spec.key
    return (
        _with_date(df, spec)
        .join(hour_stats(df, spec, settings), [k, "_date", "hour_of_day"], "left")
        .join(weekday_stats(df, spec, settings), [k, "_date", "day_of_week", "hour_of_day"], "left")
        .join(daily_turnover(df, spec, settings), [k, "_date"], "left")
        .drop("_date")
    )


SERIES_FEATURES = (
    *LAGS,
    "delta_dock_15m",
    "avg_dock_same_hour_7d",
    "std_dock_same_hour_7d",
    "avg_dock_same_weekday",
    "station_daily_turnover",
    "dock_bikes_same_time_1w",
)


def series_features(
    rows: DataFrame,
    mode: str = "rows",
    spec: SeriesSpec = SERIES,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Lag, history and target columns per (key, slot), from the three columns they need."""
    narrow = rows.select(spec.key, spec.time, spec.value).repartition(spec.key)
    local = _local_hour(spec, settings)
    narrow = narrow.withColumns({name: _never_null(c, F.lit(-1)) for name, c in local.items()})
    slots = {
        **lag_columns(mode, spec, settings),
        "dock_bikes_same_time_1w": last_week_column(spec, settings),
        spec.target: target_column(mode, spec, settings),
    }
    full = _join_day_stats(narrow, spec, settings).withColumns(slots)
    return full.select(spec.key, spec.time, *SERIES_FEATURES, spec.target)


def all_features(
    raw: DataFrame,
    mode: str = "rows",
    spec: SeriesSpec = SERIES,
    settings: Settings = DEFAULTS,
    one_off_holidays: tuple = (),
) -> DataFrame:
    """All 35 features and the target from raw snapshots, one row per (key, slot).

    The wide rows stay hashed by (key, slot) from keep-last to the end; the narrow series
    result is moved to them.
    """
    rows = keep_last(raw.dropna(subset=[spec.key, spec.time]), spec)
    series = series_features(rows, mode, spec, settings).repartition(spec.key, spec.time)
    wide = current_state(rows, spec)
    wide = temporal_features(wide, spec, settings, one_off_holidays)
    wide = station_features(weather_features(wide))
    columns = [c for c in wide.columns if c not in (spec.key, spec.time)]
    return wide.join(series, [spec.key, spec.time], "left").select(
        spec.key, spec.time, *columns, *SERIES_FEATURES, spec.target
    )
