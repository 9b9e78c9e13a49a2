import re
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hotrank.functions.decay import decay_rate
from hotrank.operators import creations, hotkeys, scoring
from hotrank.operators.windows import event_time_window_scores, latest_per_window
from hotrank.schemas import ARRIVED_ACTION, ARRIVED_CREATION, ARRIVAL_ORDER, EVENT_ORDER
from model import at, fold

TEN_MINUTES = 600_000
SPARK_SETTINGS = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def action_rows(keyed, arrivals=None):
    """(user, type, creation, time, arrival time, arrival number, position) per (key, time, type)."""
    return [
        (1, kind, key, ts, at(arrivals[i] if arrivals else i), i, 0)
        for i, (key, ts, kind) in enumerate(keyed)
    ]


def actions(spark, keyed, arrivals=None):
    return spark.createDataFrame(action_rows(keyed, arrivals), ARRIVED_ACTION)


def scores(df):
    return [r.score for r in df.orderBy("arrival_seq").collect()]


CASES = [
    ("arrival", [(0, 2), (600_000, 3), (1_200_000, 1)], [1, 2.5, 1.25]),
    ("arrival", [(600_000, 2), (0, 2), (600_000, 2)], [1, 2, 2]),
    ("action_ts", [(600_000, 2), (0, 2), (600_000, 2)], [1.5, 1, 2.5]),
]


@pytest.mark.parametrize("order_by, steps, expected", CASES)
@pytest.mark.parametrize("segment_rows", [None, 1, 2])
def test_hand_computed(spark, order_by, steps, expected, segment_rows):
    df = actions(spark, [(1, ts, kind) for ts, kind in steps])
    found = scoring.running_score(df, TEN_MINUTES, order_by, segment_rows)
    assert scores(found) == pytest.approx(expected, abs=1e-12)


def test_weights_of_first_actions(spark):
    df = actions(spark, [(kind, 0, kind) for kind in (1, 2, 3, 4, 5, 99)])
    found = scoring.running_score(df, TEN_MINUTES, "arrival", None)
    assert scores(found) == [0, 1, 2, 3, 3, 0]


@pytest.mark.parametrize("half_life", [0, -1, timedelta(0)])
def test_half_life_must_be_positive(half_life):
    with pytest.raises(ValueError):
        decay_rate(half_life)


def test_unknown_order_is_refused(spark):
    with pytest.raises(ValueError):
        scoring.running_score(actions(spark, [(1, 0, 2)]), TEN_MINUTES, "random")


KEYED = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 10**10), st.integers(1, 6)),
    min_size=1, max_size=60,
)


def by_model(keyed, half_life, order_by):
    expected = {}
    for key in {k for k, _, _ in keyed}:
        mine = [(i, ts, kind) for i, (k, ts, kind) in enumerate(keyed) if k == key]
        if order_by == "action_ts":
            mine.sort(key=lambda x: (x[1], x[0]))
        found = fold([(ts, kind) for _, ts, kind in mine], half_life)
        expected.update({i: s for (i, _, _), s in zip(mine, found)})
    return [expected[i] for i in range(len(keyed))]


@SPARK_SETTINGS
@given(KEYED, st.sampled_from(["arrival", "action_ts"]), st.sampled_from([None, 3]),
       st.sampled_from([TEN_MINUTES, 30 * 86_400_000]))
def test_equals_a_sequential_fold(spark, keyed, order_by, segment_rows, half_life):
    found = scores(
        scoring.running_score(actions(spark, keyed), half_life, order_by, segment_rows)
    )
    assert found == pytest.approx(by_model(keyed, half_life, order_by), abs=1e-9)
    assert min(found) >= 0


@pytest.mark.parametrize("order_by", ["arrival", "action_ts"])
def test_a_hot_key_is_split_and_scored_the_same(spark, order_by):
    keyed = [(7 if i % 3 == 0 else i % 50, (i * 7919) % 100_003 * 1000, i % 6) for i in range(6000)]
    df = actions(spark, keyed)
    order = ARRIVAL_ORDER if order_by == "arrival" else EVENT_ORDER
    split = hotkeys.split_hot_keys(df, "creation_id", order, 200)
    sizes = split.hot.groupBy("creation_id", "segment").count().collect()
    assert {r.creation_id for r in sizes} == {7}
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 800
    assert split.rest.count() + split.hot.count() == 6000
    found = scores(scoring.running_score(df, TEN_MINUTES, order_by, 200))
    assert found == pytest.approx(by_model(keyed, TEN_MINUTES, order_by), abs=1e-9)


def test_every_key_above_the_threshold_is_split(spark):
    keyed = [(i % 40, i * 1000, 2) for i in range(2000)]
    df = actions(spark, keyed)
    split = hotkeys.split_hot_keys(df, "creation_id", ARRIVAL_ORDER, 10)
    segments = split.hot.groupBy("creation_id").agg(F.countDistinct("segment").alias("n")).collect()
    assert len(segments) == 40 and min(r.n for r in segments) > 1
    assert split.rest.count() == 0
    found = scores(scoring.running_score(df, TEN_MINUTES, "arrival", 10))
    assert found == pytest.approx(by_model(keyed, TEN_MINUTES, "arrival"), abs=1e-9)


def test_hot_keys_are_counted_exactly_or_not_at_all(spark):
    ids = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE 100 + id END AS creation_id"
    df = spark.range(300_000).selectExpr(ids)
    found = hotkeys.hot_keys(df, "creation_id", 50_000)
    assert [tuple(r) for r in found.collect()] == [(7, 100_000)]
    assert hotkeys.hot_keys(df, "creation_id", 100_000) is None
    assert hotkeys.hot_keys(df.limit(0), "creation_id", 1) is None


def test_one_exchange_without_hot_keys(spark):
    made = spark.createDataFrame([], ARRIVED_CREATION)
    df = actions(spark, [(1, 0, 2)])
    for order_by in ("arrival", "action_ts"):
        scored = scoring.score_timeline(made, df, TEN_MINUTES, order_by, None)
        plan = latest_per_window(scored, TEN_MINUTES)._jdf.queryExecution().executedPlan()
        assert plan.toString().count("Exchange hashpartitioning") == 1


def test_tasks_of_whole_keys_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 200)
    keyed = [(i % 500, i * 1000, 2) for i in range(6000)]
    df = actions(spark, keyed + [(None, 0, 2)])
    made = spark.createDataFrame([], ARRIVED_CREATION)
    for order_by in ("arrival", "action_ts"):
        scored = scoring.running_score(df, TEN_MINUTES, order_by)
        assert scores(scored) == pytest.approx(by_model(keyed, TEN_MINUTES, order_by), abs=1e-9)
        sizes = [r[1] for r in scored.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 6000 and max(sizes) < 600
        for rows in (scored, scoring.score_timeline(made, df, TEN_MINUTES, order_by)):
            windows = latest_per_window(rows.withColumn("category", F.lit("x")), TEN_MINUTES)
            plan = windows._jdf.queryExecution().executedPlan().toString()
            exchanges = re.findall(r"Exchange hashpartitioning\((\w+)\S*, (\d+)\)", plan)
            assert exchanges == [("creation_id", "30")]
    # Few rows are left to the planner; without the pass nothing is known of their number.
    few = df.filter("creation_id < 5")
    assert not hotkeys.split_hot_keys(few, "creation_id", ARRIVAL_ORDER).placed
    assert not hotkeys.split_hot_keys(df, "creation_id", ARRIVAL_ORDER, None).placed
    split = hotkeys.split_hot_keys(df.unionByName(few), "creation_id", ARRIVAL_ORDER, 20)
    assert split.placed and split.rest.rdd.getNumPartitions() == 30
    assert split.rest.filter("creation_id IS NOT NULL").count() == 5940


@pytest.mark.parametrize("n_rows, tasks", [
    (0, 0), (500_000, 1), (500_001, 2), (100_000_000, 200), (100_000_001, 200),
    (250_000_000, 200), (250_000_001, 201), (10**10, 8000),
])
def test_tasks_up_to_what_a_shuffle_writes_unsorted(n_rows, tasks):
    assert hotkeys.tasks_for(n_rows, 200) == tasks


def test_event_time_cells_equal_the_general_way(spark):
    keyed = [(i % 5, (i * 7919) % 10_007 * 60_000, i % 6) for i in range(2000)]
    df = actions(spark, keyed, [ts for _, ts, _ in keyed]).withColumn("category", F.lit("x"))
    for half_life in (TEN_MINUTES, 86_400_000):
        for size in (TEN_MINUTES, 7 * 86_400_000):
            general = latest_per_window(
                scoring.running_score(df, half_life, "action_ts", None), size
            ).select("creation_id", "window_end", "last_action_ts", "score")
            cells = event_time_window_scores(df, half_life, size)
            expected = {tuple(r)[:3]: r.score for r in general.collect()}
            found = {
                (r.creation_id, r.window_end, r.last_action_ts): r.score for r in cells.collect()
            }
            assert found == pytest.approx(expected, rel=1e-9, abs=1e-12)


# --- enrichment ---------------------------------------------------------------------------


def made(spark, rows):
    """(creation, category, arrival time, arrival number)"""
    return spark.createDataFrame(
        [(key, None, category, 1, at(ts), seq) for key, category, ts, seq in rows],
        ARRIVED_CREATION,
    )


@pytest.mark.parametrize("segment_rows", [None, 1, 2])
def test_as_of_takes_the_version_before(spark, segment_rows):
    versions = made(spark, [(1, "a", 10, 0), (1, "b", 30, 1), (1, None, 50, 2), (2, "z", 100, 0)])
    times = [5, 10, 20, 30, 40, 50, 60]
    df = actions(spark, [(1, t, 2) for t in times] + [(2, 1, 2), (3, 1, 2)], [*times, 99, 99])
    found = creations.enrich_as_of(versions, df, segment_rows).orderBy("arrival_seq").collect()
    # The action at 5 comes too early; at equal times creations come first.
    assert [(r.creation_id, r.category) for r in found] == [
        (1, "a"), (1, "a"), (1, "b"), (1, "b"), (1, None), (1, None),
    ]


def test_lost_actions_leave_no_trace_in_the_score(spark):
    versions = made(spark, [(1, "a", 10, 0)])
    df = actions(spark, [(1, 0, 5), (1, 0, 2)], [5, 20])
    found = scoring.score_timeline(versions, df, TEN_MINUTES, segment_rows=None)
    assert [r.score for r in found.collect()] == [1.0]


@pytest.mark.parametrize("segment_rows", [None, 4, 50])
def test_timeline_equals_two_steps(spark, segment_rows):
    versions = made(spark, [(k, f"c{k}{v}", v * 400, v) for k in range(5) for v in (1, 2, 3)])
    keyed = [(i % 4, (i * 7919) % 1009 * 1000, i % 6) for i in range(1500)]
    df = actions(spark, keyed)
    whole = creations.enrich_as_of(versions, df, None)
    for order_by in ("arrival", "action_ts"):
        two = scoring.running_score(whole, TEN_MINUTES, order_by, None)
        one = scoring.score_timeline(versions, df, TEN_MINUTES, order_by, segment_rows)
        names = ["creation_id", "category", "last_action_ts", "arrival_seq"]
        assert one.select(names).exceptAll(two.select(names)).count() == 0
        assert scores(one) == pytest.approx(scores(two), abs=1e-9)


def test_latest_version_wins(spark):
    versions = made(spark, [(1, "a", 10, 0), (1, "b", 10, 1), (2, "c", 5, 0), (None, "n", 1, 0)])
    found = creations.latest_creations(versions).collect()
    assert {r.creation_id: r.category for r in found} == {1: "b", 2: "c"}
    joined = creations.enrich_latest(actions(spark, [(1, 0, 2), (9, 0, 2)]), versions)
    assert [r.category for r in joined.collect()] == ["b"]


DAY = 86_400_000
# Gaps whose decay comes near the end of what a double holds: up to some 7 days at 10 minutes.
FAR = st.lists(
    st.tuples(st.sampled_from([0, 1, 1000, TEN_MINUTES, DAY, 2 * DAY, 3 * DAY, 6 * DAY, 30 * DAY]),
              st.sampled_from([1, 1, 2, 5])),
    min_size=1, max_size=12,
)


@SPARK_SETTINGS
@given(FAR)
def test_old_history_is_never_cut(spark, gaps):
    steps, ts = [], 0
    for gap, kind in gaps:
        ts += gap
        steps.append((ts, kind))
    expected = fold(steps, TEN_MINUTES)
    df = actions(spark, [(1, ts, kind) for ts, kind in steps])
    for order_by, segment_rows in (("arrival", None), ("action_ts", None), ("arrival", 2)):
        found = scores(scoring.running_score(df, TEN_MINUTES, order_by, segment_rows))
        # abs: below this, doubles have too few digits to compare.
        assert found == pytest.approx(expected, rel=1e-9, abs=1e-300)


def test_scores_six_days_later_still_differ(spark):
    rows = [(1, 0, 2), (2, 0, 5), (1, 6 * DAY, 1), (2, 6 * DAY, 1)]
    one, two = scores(scoring.running_score(actions(spark, rows), TEN_MINUTES, segment_rows=None))[2:]
    assert 0 < one and two == pytest.approx(3 * one, rel=1e-9)
    same = actions(spark, rows, [ts for _, ts, _ in rows])
    found = {
        r.creation_id: r.score
        for r in event_time_window_scores(same, TEN_MINUTES, TEN_MINUTES).collect()
        if r.window_start >= 6 * DAY
    }
    assert found == pytest.approx({1: one, 2: two}, rel=1e-9)
