import random
from datetime import timedelta

import pytest

from hotrank.operators import leaderboard, windows
from hotrank.plans import ranking
from hotrank.streaming.board import BoardTable, mirror_board, write_sorted_sets
from model import SortedSets, at

SCORED = (
    "creation_id bigint, category string, score double, last_action_ts bigint, "
    "arrival_ts timestamp, arrival_seq bigint, pos bigint"
)
WINDOWED = "category string, creation_id bigint, score double, window_end bigint"
FIVE, TEN = timedelta(minutes=5), timedelta(minutes=10)


def windowed(spark, *rows):
    """(score, last time, arrival ms, arrival number)"""
    data = [(1, "x", s, ts, at(arrival), seq, 0) for s, ts, arrival, seq in rows]
    found = windows.windowed_scores(spark.createDataFrame(data, SCORED), FIVE, TEN)
    return [tuple(r) for r in found.orderBy("window_end").collect()]


def test_decay_to_window_end(spark):
    row = windowed(spark, (2.5, 600_000, 650_000, 0))[0]
    assert row[2] == pytest.approx(1.767767, abs=1e-6)
    assert row[4:] == (600_000, 900_000)


def test_no_decay_when_action_is_ahead_or_unknown(spark):
    assert windowed(spark, (2.5, 950_000, 650_000, 0))[0][2] == 2.5
    assert windowed(spark, (2.5, None, 650_000, 0))[0][2:4] == (2.5, None)


def test_latest_row_of_a_window(spark):
    tie = windowed(spark, (1.0, 5, 10, 1), (2.0, 5, 10, 2))
    assert tie[0][2] == pytest.approx(2.0, rel=0.3) and len(tie) == 1
    older_later = windowed(spark, (2.0, 9, 10, 1), (3.0, 4, 10, 2))
    assert older_later[0][3] == 9
    unknown_is_lowest = windowed(spark, (2.0, None, 10, 2), (3.0, -5, 10, 1))
    assert unknown_is_lowest[0][3] == -5


def test_end_is_exclusive(spark):
    assert windowed(spark, (1.0, 0, 900_000, 0))[0][4:] == (900_000, 1_200_000)
    assert len(windowed(spark, (1.0, 0, 899_999, 0), (1.0, 0, 900_000, 1))) == 2


def test_plain_columns(spark):
    data = [("x", 1, 1.0, 5, 0, 300)]
    df = spark.createDataFrame(
        data, "category string, creation_id bigint, score double, last_action_ts bigint, "
        "window_start bigint, window_end bigint")
    assert windows.without_window(df).columns == [
        "creation_id", "category", "score", "last_action_ts",
    ]


# --- boards -------------------------------------------------------------------------------


def rows(spark, *data):
    return spark.createDataFrame(list(data), WINDOWED)


def held(board):
    return {(r.category, r.creation_id): r.score for r in board.collect()}


def after(spark, writes, n):
    """Board after one window per write."""
    df = rows(spark, *[(c, m, s, end) for end, (c, m, s) in enumerate(writes, start=1)])
    return ranking.replay_board(df, n)


BOARDS = [
    ([("x", 1, 1.0), ("x", 2, 2.0), ("x", 3, 3.0), ("x", 3, 0.5)], {("x", 2): 2.0, ("x", 3): 0.5}),
    ([("x", 1, 1.0), ("x", 2, 2.0), ("x", 1, 3.0)], {("x", 1): 3.0, ("x", 2): 2.0}),
    ([("x", 10, 1.0), ("x", 9, 1.0), ("x", 8, 1.0)], {("x", 9): 1.0, ("x", 8): 1.0}),
    ([("x", 1, 1.0), ("y", 1, 2.0)], {("x", 1): 1.0, ("y", 1): 2.0}),
    ([(None, 1, 1.0), ("", 2, 1.0)], {("", 2): 1.0}),
]


@pytest.mark.parametrize("writes, expected", BOARDS)
def test_board_cases(spark, writes, expected):
    assert held(after(spark, writes, 2)) == expected


def test_stateless_top_forgets_history(spark):
    df = rows(spark, ("x", 1, 1.0, 1), ("x", 2, 2.0, 2), ("x", 3, 3.0, 3), ("x", 3, 0.5, 4))
    assert held(leaderboard.hot_top(df, 2)) == {("x", 2): 2.0, ("x", 1): 1.0}


def test_cap_of_a_hundred(spark):
    df = rows(spark, *[("x", i, float(i), 1) for i in range(101)])
    top = leaderboard.hot_top(df).collect()
    assert len(top) == 100 and min(r.creation_id for r in top) == 1
    assert sorted(r["rank"] for r in top) == list(range(1, 101))


def test_long_rankings_agree_with_short_ones(spark):
    df = rows(spark, *[(f"c{i % 2}", i, float(i * 7919 % 5003), 1) for i in range(5000)])
    long = leaderboard.hot_top(df, 2000)
    assert long.count() == 4000
    assert long.filter("rank <= 10").exceptAll(leaderboard.hot_top(df, 10)).count() == 0


def test_rows_are_cut_before_the_category_shuffle(spark):
    df = rows(spark, ("x", 1, 1.0, 1))
    plan = leaderboard.top_n(df, 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning(category")
    assert "Partial" in plan


def test_writing_a_batch_twice_changes_nothing(spark):
    board = after(spark, BOARDS[0][0], 2)
    batch = rows(spark, ("x", 5, 1.5, 9), ("x", 2, 0.1, 9))
    once = leaderboard.leaderboard_update(board, batch, 2)
    assert held(leaderboard.leaderboard_update(once, batch, 2)) == held(once)


@pytest.mark.parametrize("run_rows", [100_000, 20, 4])
def test_replay_equals_sorted_sets(spark, monkeypatch, run_rows):
    monkeypatch.setattr(leaderboard, "RUN_ROWS", run_rows)
    rng = random.Random(3)
    data, sets = [], SortedSets(4)
    for end in range(1, 13):
        written = {(rng.choice("xy"), rng.randrange(12)): rng.randrange(50) / 4 for _ in range(6)}
        data += [(c, m, s, end) for (c, m), s in written.items()]
        # Members already held first, then new ones: one of the possible orders.
        known = {(c, m) for c, e in sets.sets.items() for m in e}
        for key in sorted(written, key=lambda k: k not in known):
            sets.write(key[0], key[1], written[key])
    board = ranking.replay_board(rows(spark, *data), 4)
    assert held(board) == {(c, m): s for c, e in sets.sets.items() for m, s in e.items()}


def test_jobs_do_not_grow_with_windows(spark):
    def jobs(count):
        group = f"replay-{count}"
        df = rows(spark, *[("x", i % 7, float(i % 5), i) for i in range(count)])
        spark.sparkContext.setJobGroup(group, group)
        ranking.replay_board(df, 3).collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs(3), jobs(40)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert many <= few + 2


def test_board_table_is_idempotent_and_keeps_few_versions(spark, tmp_path):
    table = BoardTable(str(tmp_path / "board"), 2, keep=3)
    assert table.read(spark).count() == 0
    table.write_batch(rows(spark, ("x", 1, 1.0, 1), ("x", 2, 2.0, 1)), 0)
    table.write_batch(rows(spark), 1)
    assert table.versions(spark) == [0]
    for _ in range(2):
        table.write_batch(rows(spark, ("x", 3, 3.0, 2), ("x", 3, 0.5, 3)), 2)
        assert held(table.read(spark)) == {("x", 2): 2.0, ("x", 3): 0.5}
    for batch in range(3, 9):
        table.write_batch(rows(spark, ("x", 1, float(batch), batch)), batch)
    assert table.versions(spark) == [5, 6, 7, 8]


def file_client():
    """A client class of its own module, so that tasks get it by value."""

    class FakeClient:
        """Sorted sets in files, so tasks in other processes can share them."""

        def __init__(self, uri):
            self.path = uri

        def _load(self):
            import json
            import os

            if not os.path.exists(self.path):
                return {}
            with open(self.path) as f:
                return json.load(f)

        def _save(self, sets):
            import json

            with open(self.path, "w") as f:
                json.dump(sets, f)

        def zadd(self, key, members):
            sets = self._load()
            sets.setdefault(key, {}).update(members)
            self._save(sets)

        def zremrangebyrank(self, key, first, last):
            sets = self._load()
            ranked = sorted(sets[key], key=lambda m: (sets[key][m], m))
            for member in ranked[first : len(ranked) + last + 1 if last < 0 else last + 1]:
                del sets[key][member]
            self._save(sets)

        def close(self):
            pass

    return FakeClient


def test_outside_sorted_sets(spark, tmp_path):
    uri = str(tmp_path / "sets.json")
    client = file_client()
    batch = rows(
        spark, ("x", 1, 1.0, 1), ("x", 2, 2.0, 1), ("x", 3, 3.0, 1), ("x", 3, 0.5, 2),
        (None, 4, 9.0, 1), ("", 5, 1.0, 1),
    ).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        write_sorted_sets(batch, uri, 2, client)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert client(uri)._load() == {"hot:x": {"2": 2.0, "3": 0.5}, "hot:": {"5": 1.0}}


def transaction_client():
    """Sorted sets in one file per set, changed by whole transactions, each of which is logged."""

    class Transactions:
        def __init__(self, uri):
            self.folder, self.steps = uri, []

        def pipeline(self, transaction):
            assert transaction
            self.steps = []
            return self

        def delete(self, key):
            self.steps.append((key, None))

        def zadd(self, key, members):
            self.steps.append((key, members))

        def execute(self):
            import json
            import os

            (key, nothing), (same, members) = self.steps
            assert nothing is None and same == key
            os.makedirs(self.folder, exist_ok=True)
            with open(f"{self.folder}/{key}.json", "w") as f:
                json.dump(members, f)

        def close(self):
            pass

    return Transactions


def outside_sets(folder):
    import json

    return {f.stem: json.loads(f.read_text()) for f in folder.glob("*.json")}


def test_a_repeated_batch_leaves_outside_sets_unchanged(spark, tmp_path):
    """Also one that is repeated after a failure between the board and the sets, or among these."""
    sets, client = tmp_path / "sets", transaction_client()
    table = BoardTable(str(tmp_path / "board"), 2)
    batches = [
        rows(spark, ("x", 1, 5.0, 1), ("x", 2, 2.0, 1), ("y", 7, 1.0, 1), (None, 4, 9.0, 1)),
        # 1 sinks below 3 and 4 in a later window of the same batch, and 3 is written twice.
        rows(spark, ("x", 3, 9.0, 2), ("x", 1, 0.5, 3), ("x", 3, 3.0, 3), ("x", 4, 4.0, 3)),
    ]
    for batch_id, batch in enumerate(batches):
        seen = []
        for attempt in range(3):
            table.write_batch(batch, batch_id)
            if attempt != 1:
                mirror_board(table.read(spark), batch, str(sets), client)
            seen.append(outside_sets(sets))
        assert seen[0] == seen[1] == seen[2]
    wanted = {}
    for r in table.read(spark).collect():
        wanted.setdefault(f"hot:{r.category}", {})[str(r.creation_id)] = r.score
    assert outside_sets(sets) == wanted
    assert wanted["hot:x"] == {"3": 3.0, "4": 4.0} and wanted["hot:y"] == {"7": 1.0}


def test_interleaved_trims_keep_exactly_n(tmp_path):
    one, two = (file_client()(str(tmp_path / "sets.json")) for _ in range(2))
    one.zadd("hot:x", {"1": 1.0, "2": 2.0, "3": 3.0})
    two.zadd("hot:x", {"4": 4.0, "5": 5.0, "6": 6.0})
    for client in (one, two):
        client.zremrangebyrank("hot:x", 0, -(2 + 1))
    assert one._load() == {"hot:x": {"5": 5.0, "6": 6.0}}
