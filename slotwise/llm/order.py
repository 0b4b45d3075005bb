"""Documents dealt into buckets that follow their order, without sorting them all in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STEP = 64


def bucket_bounds(ids: DataFrame, buckets: int) -> list[int]:
    """Up to ``buckets - 1`` numbers that cut the ``doc_id`` of ``ids`` into like parts.

    Approximate quantiles: the driver gets one number per bucket, never the ids.
    """
    if buckets < 2:
        return []
    shares = [k / buckets for k in range(1, buckets)]
    found = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * buckets))).first()[0]
    return sorted(set(found or []))


def bucket_of(doc_id: str, bounds: list[int]) -> Column:
    """How many bounds are not above ``doc_id``: compared with every 64th first, then within one step."""
    if not bounds:
        return F.lit(0)
    every = F.array(*(F.lit(b).cast("long") for b in bounds))
    below = lambda some: F.size(F.filter(some, lambda b: b <= F.col(doc_id)))
    if len(bounds) <= STEP:
        return below(every)
    coarse = F.array(*(F.lit(b).cast("long") for b in bounds[STEP - 1 :: STEP]))
    skipped = below(coarse) * STEP
    return skipped + below(F.slice(every, skipped + 1, STEP))
