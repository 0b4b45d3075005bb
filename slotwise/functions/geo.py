"""Point in the first matching box."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.schemas import DISTRICT_BOXES, Box


def first_box(lat: str, lon: str, boxes: Sequence[Box] = DISTRICT_BOXES) -> Column:
    """Name of the first box in order that holds the point, borders included; else null.

    For a short list known when the plan is built: one ``CASE``, no join. ``lat`` and
    ``lon`` are column names.
    """
    arms = " ".join(
        f"WHEN {lat} BETWEEN {b.lat_min}D AND {b.lat_max}D "
        f"AND {lon} BETWEEN {b.lon_min}D AND {b.lon_max}D THEN '{b.name}'"
        for b in boxes
    )
    return F.expr(f"CASE {arms} END") if boxes else F.lit(None).cast("string")
