"""Vectorised state, slices, expiry and rows without an id."""

import math
import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row

from hotrank.operators.creations import enrich_as_of
from hotrank.operators.scoring import running_score, score_timeline
from hotrank.plans import ranking
from hotrank.schemas import ARRIVED_ACTION, ARRIVED_CREATION
from hotrank.streaming import fold, scores
from model import at
from test_streaming import HALF_LIFE, HOUR, SIZE, Files, by_key, history, in_batch

COLUMNS = [
    "creation_id", *fold.ORDER, "is_creation", "category", *fold.STRETCH,
    "arrival_us", "from_us", "until_us",
]
RATE = math.log(2) / 600_000
WEIGHTS = {2: 1.0, 3: 2.0, 4: 3.0, 5: 3.0}


def random_rows(rng, n, keys=4):
    rows = []
    for i in range(n):
        ms = rng.randrange(0, 5_000_000) // 1000 * 1000
        when, us = pd.Timestamp(ms, unit="ms"), ms * 1000
        key = rng.randrange(keys)
        if rng.random() < 0.2:
            rows.append((key, when, -(2**63), i, True, f"c{i}", 0, 0, 0, 0.0, 0, 0, 0.0, us, us, us))
        else:
            ts, w = rng.randrange(0, 5_000_000), WEIGHTS.get(rng.randrange(1, 7), 0.0)
            rows.append((key, when, i, 0, False, None, ts, ts, 0, w, ts, 0, w, us, us, us))
    return rows


def one_by_one(rows, states, ttl_us):
    """Each creation and island by itself, with the row-wise fold."""
    out, after = [], {}
    for key in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1:4])
        held = states.get(key)
        state, seen = (held[:3], held[3]) if held else (None, None)
        for r in mine:
            if ttl_us is not None and seen is not None and r[13] - seen >= ttl_us:
                state = None
            found, state = fold.follow([Row(*COLUMNS)(*r)], state, RATE)
            out += [(key, *f) for f in found]
            seen = r[13]
        after[key] = None if state is None else (*state, seen)
    return out, after


@pytest.mark.parametrize("ttl_us", [None, 400_000_000, 0])
def test_all_creations_at_once_as_one_by_one(ttl_us):
    rng = random.Random(11)
    states = {}
    for batch in range(12):
        rows = random_rows(rng, rng.choice([1, 3, 60]))
        # Later micro-batches arrive later.
        shift = batch * 6_000_000
        rows = [(r[0], r[1] + pd.Timedelta(shift, "ms"), *r[2:13], *(x + shift * 1000 for x in r[13:])) for r in rows]
        want, after = one_by_one(rows, states, ttl_us)
        frame = pd.DataFrame(rows, columns=COLUMNS).sample(frac=1, random_state=batch)
        known = {k: v for k, v in states.items() if v is not None}
        got, found = fold.follow_all(frame, known, RATE, ttl_us)
        got = [tuple(r) for r in got.itertuples(index=False)]
        assert [g[:2] + g[3:] for g in got] == [(w[0], w[1], *w[3:]) for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])
        assert found.keys() == after.keys()
        for key, state in after.items():
            assert (state is None) == (found[key] is None)
            if state is not None:
                assert (found[key][0], *found[key][2:]) == (state[0], *state[2:])
                assert found[key][1] == pytest.approx(state[1])
        states |= found


def test_slices_carry_what_single_rows_do():
    rng = random.Random(3)
    rows = random_rows(rng, 300, keys=3)
    frame = pd.DataFrame(rows, columns=COLUMNS)
    frame["slice"] = frame["arrival_us"] // 250_000_000
    combined = fold.stretches_of_slices(frame, RATE).drop(columns="slice")
    assert len(combined) < 0.6 * len(frame)
    singles, end = fold.follow_all(frame, {}, RATE)
    _, end_combined = fold.follow_all(combined, {}, RATE)
    assert end.keys() == end_combined.keys()
    for key in end:
        assert end_combined[key][1] == pytest.approx(end[key][1])
        assert (end_combined[key][0], *end_combined[key][2:]) == (end[key][0], *end[key][2:])


def test_no_task_gets_a_hot_creation_whole(spark):
    rows = [(1, 2, 7, HOUR + i * 1000, at(HOUR + i * 1000), i, 0) for i in range(6000)]
    made = [(7, None, "c", 1, at(HOUR), 1)]
    line = scores.stream_timeline(
        spark.createDataFrame(made, ARRIVED_CREATION), spark.createDataFrame(rows, ARRIVED_ACTION))
    sliced = scores.combine_in_slices(line, RATE, 60_000_000)
    # What is left of the creation for its one state: a row per slice, and its version.
    assert sliced.count() == 100 + 1
    sent = scores.combine_in_slices(line, RATE, 60_000_000)._jdf.queryExecution().executedPlan().toString()
    assert "creation_id" in sent and "slice" in sent and "MapInPandas" in sent


def test_slices_of_windows_change_nothing(spark, tmp_path):
    made, done = history()
    files = Files(spark, tmp_path)
    files.add("made", made, ARRIVED_CREATION)
    files.add("done", done, ARRIVED_ACTION)
    files.close()
    files.run(slice_size=scores.slice_of(SIZE), shards=3)
    assert by_key(files.result()) == pytest.approx(by_key(in_batch(spark, made, done)), abs=1e-9)
    # The state, read as a table: every creation's last category and score.
    states = scores.creation_states(spark, str(tmp_path / "checkpoint")).collect()
    scored = score_timeline(
        spark.createDataFrame(made, ARRIVED_CREATION), spark.createDataFrame(done, ARRIVED_ACTION),
        HALF_LIFE)
    last = {}
    for r in sorted(scored.collect(), key=lambda r: (r.arrival_ts, r.arrival_seq, r.pos)):
        last[r.creation_id] = (r.score, r.last_action_ts)
    assert {r.creation_id for r in states} == {m[0] for m in made}
    for r in states:
        assert r.category.startswith("d")
        assert (r.score, r.last_action_ts) == pytest.approx(last[r.creation_id])
    assert {r.shard for r in states} <= {0, 1, 2}


def test_slice_of_a_window():
    assert scores.slice_of(timedelta(minutes=5)) == 1000
    assert scores.slice_of(7) == 1
    assert scores.slice_of(timedelta(days=1)) == 288_000


def test_slices_end_within_what_is_remembered(spark, tmp_path):
    files = Files(spark, tmp_path)
    with pytest.raises(ValueError, match="slice"):
        files.scored(slice_size=SIZE, state_ttl=HALF_LIFE)


@pytest.mark.parametrize("segment_rows", [None, 40, 7])
def test_islands_across_segments(spark, segment_rows):
    made, done = history()
    # Quiet spells of more than an hour in every creation.
    done = [d for i, d in enumerate(done) if (i // 60) % 3 != 1]
    args = spark.createDataFrame(made, ARRIVED_CREATION), spark.createDataFrame(done, ARRIVED_ACTION)
    got = score_timeline(*args, HALF_LIFE, segment_rows=segment_rows, state_ttl=timedelta(minutes=55))
    rows = [(m[0], pd.Timestamp(m[4]), -(2**63), m[5], True, m[2], *[0] * 7) for m in made]
    rows += [(d[2], pd.Timestamp(d[4]), d[5], d[6], False, None, d[3], d[3], 0, WEIGHTS.get(d[1], 0.0),
              d[3], 0, WEIGHTS.get(d[1], 0.0)) for d in done]
    frame = pd.DataFrame(rows, columns=COLUMNS[:13])
    us = pd.to_datetime(frame["arrival_ts"], utc=True).astype("datetime64[us, UTC]").astype("int64")
    frame = frame.assign(arrival_us=us, from_us=us, until_us=us)
    want, _ = fold.follow_all(frame, {}, math.log(2) / (HALF_LIFE / timedelta(milliseconds=1)), 55 * 60 * 10**6)
    expected = {(r.creation_id, r.arrival_seq): (r.category, r.score) for r in want.itertuples()}
    found = {(r.creation_id, r.arrival_seq): (r.category, r.score) for r in got.collect()}
    assert found.keys() == expected.keys() and 0 < len(found) < len(done)
    for key, (category, score) in expected.items():
        assert found[key][0] == category and found[key][1] == pytest.approx(score, abs=1e-9)


def test_expiry_needs_arrival_order(spark):
    made, done = history()
    args = spark.createDataFrame(made, ARRIVED_CREATION), spark.createDataFrame(done, ARRIVED_ACTION)
    with pytest.raises(ValueError, match="arrival"):
        score_timeline(*args, HALF_LIFE, "action_ts", state_ttl=SIZE)


def test_actions_without_id_are_set_aside(spark):
    made, done = history()
    lost = [(1, 2, None, HOUR, at(HOUR + i), 10_000 + i, 0) for i in range(300)]
    actions = spark.createDataFrame(done + lost, ARRIVED_ACTION)
    creations = spark.createDataFrame(made, ARRIVED_CREATION)
    assert running_score(actions, HALF_LIFE).count() == len(done)
    for segment_rows in (None, 50):
        enriched = enrich_as_of(creations, actions, segment_rows)
        assert enriched.where("creation_id is null").isEmpty()
        got = ranking.windowed(creations, actions, SIZE, HALF_LIFE, HALF_LIFE, segment_rows=segment_rows)
        assert by_key(got) == pytest.approx(by_key(in_batch(spark, made, done)), abs=1e-9)


def test_state_is_sent_by_bucket_not_by_creation():
    """Every call to the state is a message: there are no more than buckets, however many creations."""

    class Held:
        def __init__(self):
            self.rows, self.calls = {}, 0

        def getValue(self, key):
            self.calls += 1
            return self.rows.get(key)

        def updateValue(self, key, value):
            self.calls += 1
            self.rows[key] = value

        def removeKey(self, key):
            self.calls += 1
            del self.rows[key]

        def iterator(self):
            return iter(self.rows.items())

    class Handle:
        timers = []
        state = Held()

        def getMapState(self, *args):
            return self.state

        def listTimers(self):
            return iter(self.timers)

        def registerTimer(self, at):
            self.timers.append(at)

    n, handle = 5000, Handle()
    keeper = scores.ScoreKeeper(1e-6, ttl_ms=1000)
    keeper.init(handle)
    rows = pd.DataFrame({
        "creation_id": np.arange(n) * 1024 - n, "arrival_ts": pd.Timestamp("2024-01-01"),
        "arrival_seq": -(1 << 63), "pos": np.arange(n), "is_creation": True, "category": "c",
        **{name: 0 for name in ("first_ts", "last_ts", "clock", "newest_ts", "newest_clock")},
        "gain": 0.0, "newest_gain": 0.0,
        **{name: np.arange(n) * 1000 for name in ("arrival_us", "from_us", "until_us")},
    })
    for _ in range(2):
        assert not list(keeper.handleInputRows((0,), iter([rows]), None))
        assert handle.state.calls <= 2 << scores.BUCKET_BITS
        handle.state.calls = 0
    held = {x: s for v in handle.state.rows.values() for x, s in scores._held(v).items()}
    assert held == {i * 1024 - n: ("c", 0.0, None, i * 1000) for i in range(n)}

    class Now:
        def getCurrentWatermarkInMs(self):
            return 1000 + n // 2

    assert not list(keeper.handleExpiredTimer((0,), Now(), None))
    left = {x for v in handle.state.rows.values() for x in scores._held(v)}
    assert left == {i * 1024 - n for i in range(n // 2, n)}
