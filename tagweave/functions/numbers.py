"""Keyed pseudo-random numbers, the same on any partitioning, and whole-number division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13
SPAN = float(16**HEX_DIGITS)


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """Uniform double in [0, 1) from the first 52 bits of md5(seed:key:key...)."""
    parts = [F.lit(str(seed))]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(SPAN)


def int_div(value: Column | str, by: int) -> Column:
    """Whole-number division, exact for all longs."""
    return F.call_function("div", F.col(value) if isinstance(value, str) else value, F.lit(by))
