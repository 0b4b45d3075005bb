"""Error metrics as single-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.config import SERIES, SeriesSpec
from slotwise.functions.numeric import guarded_ratio, ratio, rounded_count
from slotwise.operators.rows import require_columns

NOW = "dock_bikes_now"


def mae(error: Column) -> Column:
    return F.avg(F.abs(error))


def rmse(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))


def baseline_errors(df: DataFrame, spec: SeriesSpec = SERIES) -> DataFrame:
    """Rows with the error of the forecast "as many bikes as now"."""
    require_columns(df, (NOW, spec.target))
    return df.dropna(subset=[NOW, spec.target]).withColumn(
        "_error", F.col(NOW).cast("double") - F.col(spec.target)
    )


def naive_baseline(df: DataFrame, by: tuple[str, ...] = (), spec: SeriesSpec = SERIES) -> DataFrame:
    """Count, MAE and RMSE of the persistence forecast, overall or per group."""
    rows = baseline_errors(df, spec)
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), mae(F.col("_error")).alias("mae"), rmse(F.col("_error")).alias("rmse")
    )


def naive_baseline_values(df: DataFrame, spec: SeriesSpec = SERIES) -> dict[str, float]:
    row = naive_baseline(df, spec=spec).first()
    if not row["n"]:
        raise ValueError("no rows with both the current value and the target")
    return {"mae": row["mae"], "rmse": row["rmse"]}


def evaluate(
    scored: DataFrame, prediction: str = "prediction", spec: SeriesSpec = SERIES
) -> DataFrame:
    """One row of model and baseline errors over the rows with a target.

    Sums of shifted squares avoid a second pass for R2: the total sum of squares is taken
    from ``var_pop``, which Spark merges stably between tasks. Baseline columns ignore
    rows whose current value is null.
    """
    require_columns(scored, (NOW, spec.target, prediction))
    y = F.col(spec.target)
    rows = scored.where(y.isNotNull()).select(
        y.alias("_y"),
        (rounded_count(F.col(prediction)) - y).alias("_e"),
        (F.col(NOW).cast("double") - y).alias("_b"),
    )
    sums = rows.agg(
        F.count("*").alias("n_rows"),
        mae(F.col("_e")).alias("mae"),
        rmse(F.col("_e")).alias("rmse"),
        F.avg("_y").alias("_mean"),
        F.sum(F.col("_e") * F.col("_e")).alias("_sse"),
        (F.var_pop("_y") * F.count("_y")).alias("_sst"),
        mae(F.col("_b")).alias("baseline_mae"),
        rmse(F.col("_b")).alias("baseline_rmse"),
    )
    perfect = F.when(F.col("_sse") == 0.0, 1.0).otherwise(0.0)
    return sums.select(
        "mae",
        "rmse",
        F.coalesce(ratio(F.col("mae"), F.col("_mean")), F.lit(float("nan"))).alias(
            "mae_normalized"
        ),
        F.coalesce(1.0 - ratio(F.col("_sse"), F.col("_sst")), perfect).alias("r2"),
        "baseline_mae",
        "baseline_rmse",
        F.coalesce(
            ratio(F.col("baseline_mae") - F.col("mae"), F.col("baseline_mae")) * 100.0, F.lit(0.0)
        ).alias("improvement_pct"),
        F.col("n_rows").cast("double").alias("n_rows"),
    ).where("n_rows > 0")


def evaluate_values(scored: DataFrame, prediction: str = "prediction") -> dict[str, float]:
    row = evaluate(scored, prediction).first()
    if row is None:
        raise ValueError("no rows with a target to evaluate")
    return row.asDict()


def critical_states(
    scored: DataFrame,
    empty_below: int = 2,
    full_offset: int = 2,
    prediction: str = "prediction",
    spec: SeriesSpec = SERIES,
) -> DataFrame:
    """Precision and recall of "almost empty" and "almost full"; no row without targets."""
    require_columns(scored, (spec.capacity, spec.target, prediction))
    y, p = F.col(spec.target), rounded_count(F.col(prediction))
    full_above = F.col(spec.capacity) - full_offset
    rows = scored.where(y.isNotNull()).select(
        (y < empty_below).alias("ae"),
        (p < empty_below).alias("pe"),
        (y > full_above).alias("af"),
        (p > full_above).alias("pf"),
    )
    counts = rows.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("ae") & F.col("pe")).alias("tp_e"),
        F.count_if("pe").alias("all_pe"),
        F.count_if("ae").alias("all_ae"),
        F.count_if(F.col("af") & F.col("pf")).alias("tp_f"),
        F.count_if("pf").alias("all_pf"),
        F.count_if("af").alias("all_af"),
    )
    return counts.where("n > 0").select(
        guarded_ratio(F.col("tp_e"), F.col("all_pe")).alias("empty_precision"),
        guarded_ratio(F.col("tp_e"), F.col("all_ae")).alias("empty_recall"),
        guarded_ratio(F.col("tp_f"), F.col("all_pf")).alias("full_precision"),
        guarded_ratio(F.col("tp_f"), F.col("all_af")).alias("full_recall"),
        F.col("all_ae").cast("double").alias("n_empty_actual"),
        F.col("all_af").cast("double").alias("n_full_actual"),
    )
