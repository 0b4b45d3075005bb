"""Forecasting over keyed snapshot series, as plain Spark DataFrame operators."""

from slotwise.config import DEFAULTS, SERIES, SeriesSpec, Settings
from slotwise.session import build_session, scratch_dir, tune

__all__ = ["DEFAULTS", "SERIES", "SeriesSpec", "Settings", "build_session", "scratch_dir", "tune"]
