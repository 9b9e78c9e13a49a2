"""The running score inside tasks of the streaming job.

Consecutive actions of one creation add up to a *stretch*: the times of its first, last and
newest action, the clock it ran, and the score it ends with from zero. A stretch behaves like a
single action, so stretches built anywhere can be strung together in order.
"""

from __future__ import annotations

from math import exp
from operator import attrgetter

import numpy as np
import pandas as pd

ORDER = ["arrival_ts", "arrival_seq", "pos"]
STRETCH = [
    "first_ts", "last_ts", "clock", "gain", "newest_ts", "newest_clock", "newest_gain",
]
#: What is kept of a creation, beside its id.
STATE = ["category", "score", "last_ts", "seen_us"]


def decayed_scan(
    gain: np.ndarray, clock: np.ndarray, start: np.ndarray, rate: float
) -> np.ndarray:
    """Decayed sum of ``gain`` up to each place, from that place's ``start`` on.

    Doubles the reach of every sum in each round: log2(n) vector operations, and only factors
    of at most one.
    """
    total = gain.astype("float64")
    place = np.arange(len(total))
    reach = 1
    while True:
        at = np.flatnonzero(place - reach >= start)
        if len(at) == 0:
            return total
        faded = np.exp(-rate * (clock[at] - clock[at - reach]))
        total[at] = total[at] + total[at - reach] * faded
        reach *= 2


def stretches(rows: pd.DataFrame, rate: float) -> pd.DataFrame:
    """Sums up the actions of ``rows`` that share creation and ``arrival_ts``.

    Nothing can arrive between such actions if ``rows`` holds all of their part of the order.
    Creation rows pass through.
    """
    made = rows["is_creation"].to_numpy(bool)
    done = rows[~made].sort_values(["creation_id", *ORDER], kind="stable")
    out = _summed(done, _opens(done, "creation_id", "arrival_ts"), rate, at_end=False)
    return pd.concat([rows[made], out], ignore_index=True) if len(out) else rows[made]


def stretches_of_slices(rows: pd.DataFrame, rate: float) -> pd.DataFrame:
    """Sums up the actions of each creation and ``slice`` of arrival, from version to version.

    ``rows`` holds whole slices. A stretch arrives with its last action; ``until_us`` says when.
    """
    rows = rows.sort_values(["creation_id", *ORDER], kind="stable")
    made = rows["is_creation"].to_numpy(bool)
    done = rows[~made].assign(version=np.cumsum(made)[~made])
    opens = _opens(done, "creation_id", "slice", "version")
    out = _summed(done, opens, rate, at_end=True).drop(columns="version")
    return pd.concat([rows[made], out], ignore_index=True) if len(out) else rows[made]


def _opens(rows: pd.DataFrame, *keys: str) -> np.ndarray:
    """Where another group of the sorted ``rows`` starts."""
    opens = np.ones(len(rows), dtype=bool)
    opens[1:] = False
    for name in keys:
        key = rows[name].to_numpy()
        opens[1:] |= key[1:] != key[:-1]
    return opens


def _summed(rows: pd.DataFrame, opens: np.ndarray, rate: float, at_end: bool) -> pd.DataFrame:
    """One row per group of sorted actions, standing where its first or last one stood."""
    n = len(rows)
    if n == 0:
        return rows
    place = np.arange(n)
    start = np.maximum.accumulate(np.where(opens, place, 0))
    run = np.cumsum(opens)

    ts = rows["first_ts"].to_numpy()
    step = np.maximum(0, np.diff(ts, prepend=ts[:1]))
    step[opens] = 0
    clock = np.cumsum(step)
    clock = clock - clock[start]
    score = decayed_scan(rows["gain"].to_numpy(), clock, start, rate)

    first = np.flatnonzero(opens)
    last = np.append(first[1:], n) - 1
    by_newest = np.lexsort((place, ts, run))
    newest = by_newest[last]
    out = rows.iloc[last if at_end else first].copy()
    out["first_ts"] = ts[first]
    out["last_ts"] = ts[last]
    out["clock"] = clock[last]
    out["gain"] = score[last]
    out["newest_ts"] = ts[newest]
    out["newest_clock"] = clock[newest]
    out["newest_gain"] = score[newest]
    if at_end:
        out["from_us"] = rows["from_us"].to_numpy()[first]
    return out


def follow(rows, state: tuple | None, rate: float):
    """Carries one creation's state over its new rows, which may come in any order.

    ``state`` is (category, score, last action time), None while the creation is unknown; the
    time is None before its first action. Gives the scored rows, each standing for the newest
    action of its stretch, and the new state. Actions of an unknown creation leave no trace.
    """
    out = []
    for row in sorted(rows, key=attrgetter(*ORDER)):
        if row.is_creation:
            score, last_ts = (0.0, None) if state is None else state[1:]
            state = (row.category, score, last_ts)
        elif state is not None:
            category, score, last_ts = state
            gap = 0 if last_ts is None else max(0, row.first_ts - last_ts)
            newest = score * exp(-rate * (gap + row.newest_clock)) + row.newest_gain
            score = score * exp(-rate * (gap + row.clock)) + row.gain
            state = (category, score, row.last_ts)
            out.append((category, newest, row.newest_ts, *(row[c] for c in ORDER)))
    return out, state


def follow_all(
    rows: pd.DataFrame, states: dict[int, tuple], rate: float, ttl_us: int | None = None
) -> tuple[pd.DataFrame, dict[int, tuple | None]]:
    """``follow`` for all creations of ``rows`` at once, in vector operations.

    ``states`` has (category, score, last action time or None, last arrival in microseconds) of
    the creations known. Gives the scored rows and the new state of every creation that has rows,
    None where nothing is known. With ``ttl_us`` a creation is forgotten when so long nothing
    arrives for it: its rows then fall into islands, each of which starts from nothing.
    """
    rows = rows.sort_values(["creation_id", *ORDER], kind="stable")
    n = len(rows)
    place = np.arange(n)
    ids = rows["creation_id"].to_numpy()
    came = rows["arrival_us"].to_numpy()
    opens_key = _opens(rows, "creation_id")
    first = np.flatnonzero(opens_key)
    keys = ids[first].tolist()
    group = np.cumsum(opens_key) - 1
    held = [states.get(key) for key in keys]
    known = np.array([x is not None for x in held], bool)

    # Islands: where nothing came for too long, also since the state was left.
    opens = opens_key.copy()
    inherits = known.copy()
    if ttl_us is not None:
        before = np.concatenate([came[:1], rows["until_us"].to_numpy()[:-1]])
        before[first] = [x[3] if x is not None else came[i] for x, i in zip(held, first)]
        stale = rows["from_us"].to_numpy() - before >= ttl_us
        opens |= stale
        inherits &= ~stale[first]
    start = np.maximum.accumulate(np.where(opens, place, 0))
    inherits_row = inherits[group] & (start == first[group])

    made = rows["is_creation"].to_numpy(bool)
    version = np.maximum.accumulate(np.where(made, place, -1))
    has_version = version >= start
    alive = has_version | inherits_row
    old = np.array([x[0] if x is not None else None for x in held], object)
    category = np.where(
        has_version, rows["category"].to_numpy(object)[np.maximum(version, 0)], old[group])

    # Known actions, island by island; a score left before stands first as an action of its own.
    act = np.flatnonzero(~made & alive)
    island = np.cumsum(opens)
    left = [i for i, x in enumerate(held) if inherits[i] and x[2] is not None]
    left_island = island[first[left]] if left else np.zeros(0, np.int64)
    at = np.searchsorted(island[act], left_island)
    since = np.array([held[i][2] for i in left], np.int64)

    def column(name, inserted):
        return np.insert(rows[name].to_numpy()[act], at, inserted)

    of = np.insert(island[act], at, left_island)
    real = np.insert(np.ones(len(act), bool), at, False)
    first_ts, last_ts = column("first_ts", since), column("last_ts", since)
    clock = column("clock", 0)
    gain = np.insert(
        rows["gain"].to_numpy(np.float64)[act], at, np.array([held[i][1] for i in left], np.float64))
    begins = np.ones(len(of), bool)
    begins[1:] = of[1:] != of[:-1]
    gap = np.maximum(0, first_ts - np.concatenate([first_ts[:1], last_ts[:-1]]))
    gap[begins] = 0
    ran = np.cumsum(gap + clock)
    head = np.maximum.accumulate(np.where(begins, np.arange(len(of)), 0))
    total = decayed_scan(gain, ran, head, rate)
    earlier = np.concatenate([np.zeros(min(1, len(of))), total[:-1]])
    earlier[begins] = 0
    newest_clock = column("newest_clock", 0)
    score = earlier * np.exp(-rate * (gap + newest_clock)) + np.insert(
        rows["newest_gain"].to_numpy(np.float64)[act], at, 0.0)

    out = pd.DataFrame({
        "creation_id": ids[act], "category": category[act], "score": score[real],
        "last_action_ts": rows["newest_ts"].to_numpy()[act],
        **{name: rows[name].to_numpy()[act] for name in ORDER},
    })
    last = np.append(first[1:], n) - 1
    end = np.searchsorted(of, island[last], "right") - 1
    found = {}
    for key, i, e in zip(keys, last.tolist(), end.tolist()):
        if not alive[i]:
            found[key] = None
        elif e >= 0 and of[e] == island[i]:
            found[key] = (category[i], float(total[e]), int(last_ts[e]), int(came[i]))
        else:
            found[key] = (category[i], 0.0, None, int(came[i]))
    return out, found
