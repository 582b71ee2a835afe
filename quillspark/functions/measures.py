"""Durations, costs and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WAV_HEADER_BYTES = 44
BYTES_PER_SECOND = 32000


def duration_seconds(frames: Column, rate: Column) -> Column:
    return F.try_divide(frames.cast("double"), rate.cast("double"))


def estimate_duration(size: Column) -> Column:
    """From a file's size alone: 16-bit mono at 16 kHz behind a header; 0 for an unreadable file."""
    return F.coalesce(F.greatest(F.lit(0), size - WAV_HEADER_BYTES) / F.lit(float(BYTES_PER_SECOND)), F.lit(0.0))


def realtime_factor(audio: Column, elapsed: Column) -> Column:
    return F.when(elapsed > 0, audio / elapsed).otherwise(F.lit(0.0))


def exceeds_window(duration: Column, limit: float = 30.0) -> Column:
    return F.coalesce(duration > limit, F.lit(False))


def conforms(readable: Column, rate: Column, channels: Column, target: int = 16000, mono: bool = True) -> Column:
    ok = readable & (rate == target)
    return F.coalesce(ok & (channels == 1) if mono else ok, F.lit(False))
