"""Public holidays as a rule on a date column, so that no lookup set has to be shipped."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (month, day) of the national, regional and city holidays.
FIXED_DAYS = (
    (1, 1, "New Year"),
    (1, 6, "Epiphany"),
    (5, 1, "Labour Day"),
    (5, 2, "Community Day"),
    (8, 15, "Assumption"),
    (10, 12, "National Day"),
    (11, 1, "All Saints"),
    (11, 9, "Almudena"),
    (12, 6, "Constitution Day"),
    (12, 8, "Immaculate Conception"),
    (12, 25, "Christmas"),
)
# Days relative to Easter Sunday.
EASTER_DAYS = ((-3, "Holy Thursday"), (-2, "Good Friday"))
FIRST_YEAR, LAST_YEAR = 2024, 2027  # of the dimension, unless told otherwise
RULE_YEARS = (1900, 2099)  # for which the Easter rule holds


def _days_from_easter(day: str) -> str:
    """SQL for the days from Easter Sunday by Gauss' rule, which holds for 1900 to 2099."""
    y = f"year({day})"
    d = f"({y} % 19 * 19 + 24) % 30"
    e = f"({y} % 4 * 2 + {y} % 7 * 4 + {d} * 6 + 5) % 7"
    late = f"({e}) = 6 AND (({d}) = 29 OR ({d}) = 28 AND {y} % 19 > 10)"
    offset = f"({d}) + ({e}) - CASE WHEN {late} THEN 7 ELSE 0 END"
    return f"datediff({day}, date_add(make_date({y}, 3, 22), {offset}))"


def _checked(years: tuple[int, int]) -> tuple[int, int]:
    if not RULE_YEARS[0] <= years[0] <= years[1] <= RULE_YEARS[1]:
        raise ValueError("the Easter rule covers the years {} to {}".format(*RULE_YEARS))
    return years


def holiday_name(
    day: str,
    years: tuple[int, int] = RULE_YEARS,
    extra: Iterable[tuple[date, str]] = (),
) -> Column:
    """The holiday's name, or null. ``day`` is the SQL of a date; ``extra`` holds one-off
    dates of single years."""
    first, last = _checked(years)
    month_day = f"month({day}) * 100 + day({day})"
    arms = [f"WHEN {month_day} = {m * 100 + d} THEN '{name}'" for m, d, name in FIXED_DAYS]
    arms += [f"WHEN {_days_from_easter(day)} = {n} THEN '{name}'" for n, name in EASTER_DAYS]
    arms += [f"WHEN {day} = DATE '{when}' THEN '{name}'" for when, name in extra]
    outside = f"WHEN year({day}) NOT BETWEEN {first} AND {last} THEN NULL"
    return F.expr(f"CASE {outside} {' '.join(arms)} END")


def is_holiday(
    day: str,
    years: tuple[int, int] = RULE_YEARS,
    extra: Iterable[tuple[date, str]] = (),
) -> Column:
    """True on a holiday, false on any other day; null for null and outside ``years``, of which nothing is known."""
    first, last = _checked(years)
    fixed = ", ".join(str(m * 100 + d) for m, d, _ in FIXED_DAYS)
    rules = [
        f"month({day}) * 100 + day({day}) IN ({fixed})",
        f"{_days_from_easter(day)} IN ({', '.join(str(n) for n, _ in EASTER_DAYS)})",
        *[f"{day} = DATE '{when}'" for when, _ in extra],
    ]
    return F.expr(f"CASE WHEN year({day}) BETWEEN {first} AND {last} THEN ({' OR '.join(rules)}) END")


def holiday_dim(
    spark: SparkSession,
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
    extra: Iterable[tuple[date, str]] = (),
) -> DataFrame:
    """All holidays of ``years`` as (date, name), for joins and reports."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(date(years[0], 1, 1)),
                F.lit(date(years[1], 12, 31)),
                F.expr("INTERVAL '1' DAY"),
            )
        ).alias("date")
    )
    return days.select("date", holiday_name("date", years, tuple(extra)).alias("name")).where(
        F.col("name").isNotNull()
    )
