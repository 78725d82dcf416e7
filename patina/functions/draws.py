"""Repeatable random draws keyed by seed, purpose and record.

A draw is a pure function of its key, so it does not depend on partitioning,
task retries or row order, and any engine with MD5 can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_DIGITS = 12
DRAW_RANGE = 16**DRAW_DIGITS


def draw_hex(seed: int, tag: str, *keys: Column) -> Column:
    """32 hex digits of MD5 over ``seed:tag:key:...``."""
    parts = [F.lit(f"{seed}:{tag}")] + [k.cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hex_to_long(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("bigint")


def draw(seed: int, tag: str, *keys: Column) -> Column:
    """Uniform integer in [0, 16**12)."""
    return hex_to_long(F.substring(draw_hex(seed, tag, *keys), 1, DRAW_DIGITS))


def draw_unit(seed: int, tag: str, *keys: Column) -> Column:
    """Uniform double in [0, 1)."""
    return draw(seed, tag, *keys) / F.lit(float(DRAW_RANGE))


def draw_between(lo: float, hi: float, seed: int, tag: str, *keys: Column) -> Column:
    return F.lit(lo) + F.lit(hi - lo) * draw_unit(seed, tag, *keys)
