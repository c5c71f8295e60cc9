"""Shared predicates over pitches and at-bats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Event types and pitch codes of the data model.
HITS = ("single", "double", "triple", "home_run")
NOT_AT_BAT = ("walk", "hit_by_pitch", "sac_fly", "sac_bunt", "sac_fly_double_play", "sac_bunt_double_play")
COUNTED_TYPES = ("FF", "SI", "SL", "CU", "CH", "FC", "FS")
FASTBALLS = ("FF", "SI")


def is_hit() -> Column:
    return F.col("event_type").isin(*HITS)


def is_at_bat() -> Column:
    return ~F.col("event_type").isin(*NOT_AT_BAT)


def is_event(name: str) -> Column:
    return F.col("event_type") == name


def is_whiff() -> Column:
    return F.col("is_strike") & ~F.col("is_in_play") & (F.col("call_code") == "S")


def bases() -> Column:
    """Bases of a hit: 1 to 4, else 0."""
    return sum((F.when(is_event(h), n).otherwise(0) for n, h in enumerate(HITS[1:], 2)), F.when(is_event("single"), 1).otherwise(0))
