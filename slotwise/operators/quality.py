"""Contract and range checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inclusive bounds of the calendar features.
RANGES = {
    "hour_of_day": (0, 23),
    "day_of_week": (0, 6),
    "month": (1, 12),
    "minutes_since_midnight": (0, 1439),
}


def range_violations(df: DataFrame, ranges: dict[str, tuple[int, int]] = RANGES) -> DataFrame:
    """(rule, violations): rows outside the inclusive bounds, all rules in one pass."""
    counts = df.agg(
        *[F.count_if(~F.col(c).between(lo, hi)).alias(c) for c, (lo, hi) in ranges.items()]
    )
    return counts.unpivot([], list(ranges), "rule", "violations")


def outside_ranges(df: DataFrame, ranges: dict[str, tuple[int, int]] = RANGES) -> DataFrame:
    """The violating rows themselves."""
    bad = F.lit(False)
    for column, (lo, hi) in ranges.items():
        bad = bad | ~F.col(column).between(lo, hi)
    return df.where(bad)


REQUIRED = (
    "id",
    "number",
    "name",
    "activate",
    "no_available",
    "total_bases",
    "dock_bikes",
    "free_bases",
    "geometry",
)


def document_is_valid(stations: Column, corrupt: Column | None = None) -> Column:
    """Code "00", description, time, a station list, and every required field of every station."""
    complete = F.forall(
        stations["data"],
        lambda s: F.forall(
            F.array(*[s[name].isNotNull() for name in REQUIRED]), lambda present: present
        )
        & s["geometry"]["type"].isNotNull()
        & s["geometry"]["coordinates"].isNotNull()
        & F.forall(s["geometry"]["coordinates"], lambda x: x.isNotNull()),
    )
    head = stations["description"].isNotNull() & stations["datetime"].isNotNull()
    valid = (stations["code"] == "00") & head & stations["data"].isNotNull() & complete
    if corrupt is not None:
        valid = valid & corrupt.isNull()
    return F.coalesce(valid, F.lit(False))


def split_documents(
    documents: DataFrame, corrupt: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) documents; one bad station rejects its whole document."""
    valid = document_is_valid(F.col("stations"), F.col(corrupt) if corrupt else None)
    return documents.where(valid), documents.where(~valid)
