"""Action weights and exponential decay, as column expressions."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of each action type (2 click, 3 like, 4 comment, 5 share).
# Every other type weighs nothing.
ACTION_WEIGHTS = {2: 1.0, 3: 2.0, 4: 3.0, 5: 3.0}

LONG_MIN = -(2**63)


def millis(span: timedelta | int) -> int:
    """Whole milliseconds of a duration; integers are taken as milliseconds."""
    if isinstance(span, timedelta):
        return span // timedelta(milliseconds=1)
    return int(span)


def decay_rate(half_life: timedelta | int) -> float:
    """Rate per millisecond at which a score halves over ``half_life``."""
    span = millis(half_life)
    if span <= 0:
        raise ValueError(f"half-life must be positive, got {half_life!r}")
    return math.log(2) / span


def action_weight(action_type: Column) -> Column:
    weight = F.lit(0.0)
    for code, value in ACTION_WEIGHTS.items():
        weight = F.when(action_type == code, F.lit(value)).otherwise(weight)
    return weight


def elapsed(later: Column, earlier: Column) -> Column:
    """Milliseconds from ``earlier`` to ``later``, never below zero.

    NULL when either side is NULL, so a missing predecessor can be told apart.
    """
    gap = later - earlier
    return F.when(gap < 0, F.lit(0).cast("long")).otherwise(gap)


def decay(rate: float, span: Column) -> Column:
    """Share of a score that is left after ``span`` milliseconds."""
    return F.exp(F.lit(-rate) * span)


def decayed_to(score: Column, last_ts: Column, at_ms: Column, rate: float) -> Column:
    """``score`` brought forward to ``at_ms``; unchanged when ``last_ts`` is NULL or ahead."""
    return score * decay(rate, elapsed(at_ms, F.coalesce(last_ts, at_ms)))
