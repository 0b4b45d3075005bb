"""Feature drift between a reference and a current window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.config import DEFAULTS
from slotwise.functions.numeric import chi2_p_value, ks_p_value
from slotwise.operators.rows import without_identifiers
from slotwise.session import materialise

BUCKETS = 256


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def value_counts(
    reference: DataFrame, current: DataFrame, columns: list[str], kind: str
) -> DataFrame:
    """(feature, value, r, c): how often each value occurs in either window, nulls dropped.

    Counting is combined before the shuffle, so a value that fills a third of a window is
    one row per input task.
    """
    def tagged(df: DataFrame, r: int, c: int) -> DataFrame:
        cast = [F.col(name).cast(kind).alias(name) for name in columns]
        return df.select(*cast, F.lit(r).alias("_r"), F.lit(c).alias("_c"))

    both = tagged(reference, 1, 0).union(tagged(current, 0, 1))
    long = both.unpivot(["_r", "_c"], columns, "feature", "value").where("value IS NOT NULL")
    if kind == "double":
        long = long.where(~F.isnan("value"))
    return long.groupBy("feature", "value").agg(
        F.sum("_r").alias("r"), F.sum("_c").alias("c")
    )


def ks_statistic(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(feature, statistic, n_reference, n_current) from :func:`value_counts`.

    The running shares of a feature are not taken over one long window. Approximate
    quantiles of its distinct values cut it into buckets; each bucket is ordered on its
    own, on top of the totals of the buckets below. The cuts only place the borders, the
    statistic is exact. Both broadcast tables have at most ``buckets`` entries per feature.
    """
    shares = [i / buckets for i in range(1, buckets)]
    cuts = counts.groupBy("feature").agg(
        F.array_distinct(F.percentile_approx("value", shares, 10_000)).alias("_cuts")
    )
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("value")))
    placed = counts.join(F.broadcast(cuts), "feature").select(
        "feature", "value", "r", "c", below.alias("_bucket")
    )
    totals = placed.groupBy("feature", "_bucket").agg(F.sum("r").alias("_br"), F.sum("c").alias("_bc"))
    by_bucket = Window.partitionBy("feature").orderBy("_bucket")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "feature",
        "_bucket",
        F.coalesce(F.sum("_br").over(before), F.lit(0)).alias("_r0"),
        F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_c0"),
        F.sum("_br").over(whole).alias("n_reference"),
        F.sum("_bc").over(whole).alias("n_current"),
    )
    inside = Window.partitionBy("feature", "_bucket").orderBy("value")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select(
        "feature",
        "_bucket",
        F.sum("r").over(inside).alias("_r"),
        F.sum("c").over(inside).alias("_c"),
    ).join(F.broadcast(offsets), ["feature", "_bucket"])
    gap = F.abs(
        F.try_divide((F.col("_r0") + F.col("_r")).cast("double"), F.col("n_reference"))
        - F.try_divide((F.col("_c0") + F.col("_c")).cast("double"), F.col("n_current"))
    )
    return running.groupBy("feature").agg(
        F.max(gap).alias("statistic"),
        F.max("n_reference").alias("n_reference"),
        F.max("n_current").alias("n_current"),
    )


def ks_drift(
    reference: DataFrame, current: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per numeric feature.

    The counts are written to the shared scratch folder: three branches read them, and
    their input, the feature build of both windows, must run once.
    """
    columns = columns or numeric_columns(current)
    counts = materialise(value_counts(reference, current, columns, "double"), "value-counts")
    tested = ks_statistic(counts)
    p_value = ks_p_value(F.col("statistic"), F.col("n_reference"), F.col("n_current"))
    return tested.withColumn("p_value", F.when(F.col("statistic").isNotNull(), p_value))


def chi2_statistic(counts: DataFrame) -> DataFrame:
    """(feature, statistic, df, n_reference, n_current) of the 2 x k table, in one pass."""
    both = (F.col("r") + F.col("c")).cast("double")
    sums = counts.groupBy("feature").agg(
        F.sum("r").alias("n_reference"),
        F.sum("c").alias("n_current"),
        F.sum(F.col("r") * F.col("r") / both).alias("_rr"),
        F.sum(F.col("c") * F.col("c") / both).alias("_cc"),
        (F.count("*") - 1).alias("df"),
    )
    n = F.col("n_reference") + F.col("n_current")
    share = F.try_divide(F.col("_rr"), F.col("n_reference")) + F.try_divide(
        F.col("_cc"), F.col("n_current")
    )
    return sums.select(
        "feature",
        F.greatest(n * (share - 1.0), F.when(share.isNotNull(), 0.0)).alias("statistic"),
        "df",
        "n_reference",
        "n_current",
    )


def chi2_drift(
    reference: DataFrame, current: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Chi-square test of equal category shares per text or boolean feature."""
    columns = columns or categorical_columns(current)
    tested = chi2_statistic(value_counts(reference, current, columns, "string"))
    p_value = chi2_p_value(F.col("statistic"), F.col("df"))
    return tested.withColumn("p_value", F.when(F.col("statistic").isNotNull(), p_value))


def feature_drift(
    reference: DataFrame, current: DataFrame, threshold: float = DEFAULTS.drift_p_value
) -> DataFrame:
    """Both tests over all columns that are neither identifier nor target.

    One rule decides for counts and names alike: a p-value strictly below ``threshold``. A
    feature without values on one side cannot be tested and counts as not drifted.
    """
    reference, current = without_identifiers(reference), without_identifiers(current)
    columns = ["feature", "test", "statistic", "p_value"]
    ks = ks_drift(reference, current).withColumn("test", F.lit("ks")).select(columns)
    chi2 = chi2_drift(reference, current).withColumn("test", F.lit("chi2")).select(columns)
    return ks.union(chi2).withColumn(
        "drifted", F.coalesce(F.col("p_value") < threshold, F.lit(False))
    )


def drift_summary(
    per_feature: DataFrame,
    day: str | date,
    n_features: int,
    n_reference: int | None = None,
    n_current: int | None = None,
) -> DataFrame:
    """One row: how many of the ``n_features`` tested columns drifted, their share, names.

    A column that is null throughout leaves no row in ``per_feature``, so the denominator is
    passed in. The list holds feature names, so its length is bounded by the schema.
    """
    drifted = F.when(F.col("drifted"), F.col("feature"))
    return per_feature.agg(
        F.lit(str(day)).cast("date").alias("date"),
        F.count(drifted).alias("n_drifted_features"),
        (
            F.count(drifted).cast("double") / n_features if n_features else F.lit(0.0)
        ).alias("share_drifted"),
        F.array_sort(F.collect_list(drifted)).alias("drifted_feature_names"),
        F.lit(n_reference).cast("long").alias("n_reference_rows"),
        F.lit(n_current).cast("long").alias("n_current_rows"),
    )
