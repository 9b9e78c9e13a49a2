"""Plain-Python models of what the operators compute, one element at a time."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

WEIGHTS = {2: 1.0, 3: 2.0, 4: 3.0, 5: 3.0}
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def at(ms: int) -> datetime:
    return EPOCH + timedelta(milliseconds=ms)


def fold(steps, half_life: int):
    """Scores of (time, type) pairs taken in the given order."""
    rate = math.log(2) / half_life
    score, last, out = 0.0, None, []
    for ts, kind in steps:
        if last is not None:
            score *= math.exp(-rate * max(0, ts - last))
        score += WEIGHTS.get(kind, 0.0)
        last = ts
        out.append(score)
    return out


class SortedSets:
    """Sorted sets per category, trimmed to ``n`` after every write."""

    def __init__(self, n):
        self.n = n
        self.sets = {}

    def write(self, category, member, score):
        if category is None:
            return
        entries = self.sets.setdefault(category, {})
        entries[member] = score
        while len(entries) > self.n:
            del entries[min(entries, key=lambda m: (entries[m], str(m)))]
