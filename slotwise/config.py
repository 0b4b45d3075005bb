"""Parameters that change results, and the column names operators work on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Numeric parameters of the engine.

    The reference uses one number, 7, for three jobs. They are three fields here: days of
    history loaded before a window (``warmup_days``), rows of the rolling statistics
    (``rolling_days``) and the distance of the weekly lookback (``lookback_days``).
    ``expanding_rows`` and ``drift_stations`` limit the expanding mean and the drift reference;
    None, the default, means all.
    """

    train_days: int = 7
    val_days: int = 1
    test_days: int = 1
    warmup_days: int = 7
    rolling_days: int = 7
    lookback_days: int = 7
    expanding_rows: int | None = None
    slot_minutes: int = 15
    horizon_rows: int = 4
    horizon_hours: int = 1
    history_days: int = 8
    local_zone: str = "Europe/Madrid"
    drift_stations: int | None = None
    drift_p_value: float = 0.05
    drift_share: float = 0.30
    mae_factor: float = 1.20
    retention_days: int = 365
    seed: int = 42


@dataclass(frozen=True)
class SeriesSpec:
    """Column names of a keyed snapshot series."""

    key: str = "station_id"
    time: str = "snapshot_timestamp"
    value: str = "dock_bikes"
    free: str = "free_bases"
    capacity: str = "total_bases"
    target: str = "target_dock_bikes_1h"
    arrival: tuple[str, ...] = ("raw_ts", "seq")


DEFAULTS = Settings()
SERIES = SeriesSpec()
