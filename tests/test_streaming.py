"""The same rows through streams, in several ways of cutting them, give the batch answer."""

import math
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from hotrank.operators import leaderboard
from hotrank.options import KafkaSourceOptions, RankingOptions
from hotrank.plans import ranking
from hotrank.schemas import ARRIVED_ACTION, ARRIVED_CREATION
from hotrank.streaming import fold, pipeline, scores
from hotrank.streaming.board import BoardTable
from hotrank.streaming.intake import Intake, decoded
from model import at
from model import fold as model_fold

HOUR = 3_600_000
SIZE, HALF_LIFE = timedelta(hours=1), timedelta(minutes=30)
TICKS = "arrival_ts timestamp"


def history():
    made, done = [], []
    # Nothing at the very epoch: that is where a stream's watermark begins.
    for key in range(6):
        made.append((key, None, f"c{key % 2}", 1, at(HOUR + key * 600_000), key))
        made.append((key, None, f"d{key % 2}", 1, at(5 * HOUR + key), 100 + key))
    for i in range(600):
        arrival = HOUR + i * 60_000
        acted = max(0, arrival - (i * 7919) % (2 * HOUR))
        done.append((1, i % 6, 5 if i % 3 == 0 else i % 8, acted, at(arrival), i, 0))
    return made, done


def in_batch(spark, made, done):
    return ranking.windowed(
        spark.createDataFrame(made, ARRIVED_CREATION),
        spark.createDataFrame(done, ARRIVED_ACTION),
        SIZE, HALF_LIFE, HALF_LIFE, segment_rows=None,
    )


def by_key(df):
    return {
        (r.creation_id, r.category, r.last_action_ts, r.window_start, r.window_end): r.score
        for r in df.collect()
    }


class Files:
    """Inputs of a stream, one file at a time."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        for name in ("made", "done", "ticks"):
            (folder / name).mkdir()

    def add(self, name, rows, schema):
        df = self.spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(str(self.folder / name))

    def close(self):
        self.add("ticks", [(at(10_000 * HOUR),)], TICKS)

    def read(self, name, schema):
        reader = self.spark.readStream.schema(schema)
        return reader.parquet(str(self.folder / name))

    def scored(self, **options):
        return scores.score_stream(
            self.read("made", ARRIVED_CREATION),
            self.read("done", ARRIVED_ACTION),
            HALF_LIFE,
            ticks=self.read("ticks", TICKS),
            **options,
        )

    def run(self, **options):
        """Runs until everything present is worked off; continues from its checkpoint."""
        windows = scores.windowed_stream(self.scored(**options), SIZE, HALF_LIFE)
        query = (
            windows.writeStream.format("parquet")
            .option("path", str(self.folder / "out"))
            .option("checkpointLocation", str(self.folder / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query

    def result(self):
        return self.spark.read.parquet(str(self.folder / "out"))


def chunks(rows, n):
    size = math.ceil(len(rows) / n)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


@pytest.mark.parametrize("n_files", [1, 3, 10])
def test_stream_equals_batch_across_restarts(spark, tmp_path, n_files):
    made, done = history()
    files = Files(spark, tmp_path)
    since = at(0)
    for part in chunks(done, n_files):
        until = part[-1][4]
        files.add("done", part, ARRIVED_ACTION)
        files.add("made", [m for m in made if since < m[4] <= until], ARRIVED_CREATION)
        since = until
        # Each run starts anew from the checkpoint of the last.
        assert scores.dropped_rows(files.run()) == 0
    files.close()
    files.run()
    expected = by_key(in_batch(spark, made, done))
    assert by_key(files.result()) == pytest.approx(expected, abs=1e-9)


def test_combining_in_tasks_changes_nothing(spark, tmp_path):
    made, done = history()
    # Everything that shares a time lies in one file, as in one range of a partition.
    done = [(*row[:4], at(HOUR + (i // 100) * 100 * 60_000 + 1), row[5], 0) for i, row in enumerate(done)]
    files = Files(spark, tmp_path)
    files.add("made", made, ARRIVED_CREATION)
    files.add("done", done, ARRIVED_ACTION)
    files.close()
    files.run(combine=True)
    expected = by_key(in_batch(spark, made, done))
    assert by_key(files.result()) == pytest.approx(expected, abs=1e-9)


def test_late_rows_are_counted(spark, tmp_path):
    files = Files(spark, tmp_path)
    files.add("made", [(1, None, "x", 1, at(HOUR), 0)], ARRIVED_CREATION)
    files.add("done", [(1, 2, 1, 0, at(5 * HOUR), 0, 0)], ARRIVED_ACTION)
    files.run()
    files.add("done", [(1, 2, 1, 0, at(1 * HOUR), 1, 0)], ARRIVED_ACTION)
    assert scores.dropped_rows(files.run()) == 1


def test_an_intake_keeps_what_spark_would_drop(spark, tmp_path):
    """Its late rows are as many as score_stream drops; a batch that runs again changes nothing."""
    import json

    files = Files(spark, tmp_path)
    first = [(1, 2, 1, i, at(HOUR + i), i, 0) for i in range(5)]
    then = [(1, 2, 1, 9, at(t), 100 + t, 0) for t in (HOUR, HOUR + 4, HOUR + 5, 2 * HOUR)]
    made = [(1, None, "x", 1, at(HOUR), 0)]
    files.add("made", made, ARRIVED_CREATION)
    files.add("done", first, ARRIVED_ACTION)
    files.run()
    files.add("done", then, ARRIVED_ACTION)
    dropped = scores.dropped_rows(files.run())

    def raw(rows, text):
        found = [(bytearray(json.dumps(text(r)).encode()), r[4], r[5]) for r in rows]
        return spark.createDataFrame(found, "value binary, arrival_ts timestamp, arrival_seq long")

    creation = lambda r: {"creationId": r[0], "category": r[2]}
    action = lambda r: {
        "actionTypeList": f"{r[1]}", "creationIdList": f"{r[2]}", "timestampList": f"{r[3]}", "userId": 1}
    intake = Intake(str(tmp_path / "intake"), HALF_LIFE)
    batches = [decoded(raw(made, creation), raw(first, action)), decoded(raw([], creation), raw(then, action))]
    for _ in range(2):
        for i, batch in enumerate(batches):
            intake.write_batch(batch, i)
    left_out = intake.quarantine(spark).collect()
    assert dropped == 2 == len(left_out)
    assert {(r.source, r.reason) for r in left_out} == {("action_batch", "late")}
    # A batch cut short before it was published judges its rows as it did the first time.
    import shutil

    shutil.rmtree(tmp_path / "intake" / "rows" / "1")
    intake.write_batch(batches[1], 1)
    assert len(intake.quarantine(spark).collect()) == 2
    assert spark.read.parquet(f"{intake.path}/rows/1").count() == 2
    # An allowance lets them in.
    patient = Intake(str(tmp_path / "patient"), HALF_LIFE, "10 minutes")
    for i, batch in enumerate(batches):
        patient.write_batch(batch, i)
    assert patient.quarantine(spark).count() == 0


def test_raw_messages_to_board(spark, tmp_path):
    """Decoding, splitting, scoring, windows and the board in one stream."""
    made, done = history()
    names = ["creation_id", "user_id", "category", "status"]
    creations_raw = spark.createDataFrame(made, ARRIVED_CREATION).select(
        F.to_json(F.struct(*names)).cast("binary").alias("value"), "arrival_ts", "arrival_seq"
    )
    text = {
        "action_type": "actionTypeList", "creation_id": "creationIdList",
        "action_ts": "timestampList",
    }
    actions_raw = spark.createDataFrame(done, ARRIVED_ACTION).select(
        F.to_json(
            F.struct(
                *[F.col(c).cast("string").alias(n) for c, n in text.items()],
                F.col("user_id").alias("userId"),
            )
        ).cast("binary").alias("value"),
        "arrival_ts", "arrival_seq",
    )
    bad = spark.createDataFrame([(bytearray(b"{bad"), at(HOUR), 10**6)], actions_raw.schema)
    creations_raw.coalesce(1).write.parquet(str(tmp_path / "made"))
    actions_raw.unionByName(bad).coalesce(1).write.parquet(str(tmp_path / "done"))
    spark.createDataFrame([(at(10_000 * HOUR),)], TICKS).write.parquet(str(tmp_path / "ticks"))

    source = KafkaSourceOptions("b:1", ["t"], "g")
    options = RankingOptions(
        source, source, window_size=SIZE, score_half_life=HALF_LIFE,
        window_half_life=HALF_LIFE, board_size=2,
    )
    raw = [
        spark.readStream.schema(actions_raw.schema).parquet(str(tmp_path / name))
        for name in ("made", "done")
    ]
    ticks = spark.readStream.schema(TICKS).parquet(str(tmp_path / "ticks"))
    board = BoardTable(str(tmp_path / "board"), 2)
    windows = pipeline.ranking_stream(*raw, options, ticks=ticks)
    pipeline.start(
        windows, board, str(tmp_path / "checkpoint"), options, once=True
    ).awaitTermination()

    expected = ranking.replay_board(in_batch(spark, made, done), 2)
    found = {(r.category, r.creation_id): r.score for r in board.read(spark).collect()}
    wanted = {(r.category, r.creation_id): r.score for r in expected.collect()}
    assert found == pytest.approx(wanted, abs=1e-9) and len(found) == 8

    left_out = pipeline.quarantine(
        spark.read.parquet(str(tmp_path / "made")), spark.read.parquet(str(tmp_path / "done"))
    )
    assert [tuple(r) for r in left_out.collect()] == [("action_batch", "malformed_json", "{bad")]


# --- the fold inside tasks ----------------------------------------------------------------

STEPS = st.lists(
    st.tuples(st.integers(0, 10**10), st.integers(1, 6)), min_size=1, max_size=40
)
WEIGHTS = {2: 1.0, 3: 2.0, 4: 3.0, 5: 3.0}
COLUMNS = ["creation_id", *fold.ORDER, "is_creation", "category", *fold.STRETCH]


def action_row(key, i, ts, kind, arrival=0):
    w = WEIGHTS.get(kind, 0.0)
    when = pd.Timestamp(arrival, unit="ms")
    return (key, when, i, 0, False, None, ts, ts, 0, w, ts, 0, w)


@settings(max_examples=200, deadline=None)
@given(STEPS, st.integers(1, 39), st.sampled_from([600_000, 30 * 86_400_000]))
def test_stretches_carry_what_single_actions_do(steps, cut, half_life):
    rate = math.log(2) / half_life
    expected = model_fold(steps, half_life)
    singles = pd.DataFrame(
        [action_row(1, i, ts, kind) for i, (ts, kind) in enumerate(steps)], columns=COLUMNS
    )
    # Two tasks, each combining its own part, then one key's state over both.
    parts = [p for p in (singles.iloc[:cut], singles.iloc[cut:]) if len(p)]
    combined = pd.concat([fold.stretches(p, rate) for p in parts])
    assert len(combined) == len(parts)
    make_row = Row(*COLUMNS)
    rows = [make_row(*r) for r in combined.itertuples(index=False)]
    out, state = fold.follow(reversed(rows), ("x", 0.0, None), rate)
    assert state[1] == pytest.approx(expected[-1], abs=1e-9)
    assert state[2] == steps[-1][0]
    # The newest action over all stretches is the one a window would keep.
    newest = max(range(len(steps)), key=lambda i: (steps[i][0], i))
    best = max(enumerate(out), key=lambda x: (x[1][2], x[0]))[1]
    assert best[1] == pytest.approx(expected[newest], abs=1e-9)
    assert best[2] == steps[newest][0]


def test_stretches_keep_keys_and_times_apart():
    rate = math.log(2) / 600_000
    rows = [action_row(k, i, i * 1000, 2, a) for i, (k, a) in enumerate(
        [(1, 0), (2, 0), (1, 0), (1, 5), (2, 0), (1, 5)])]
    rows.append((3, pd.Timestamp(0), 0, 0, True, "x", 0, 0, 0, 0.0, 0, 0, 0.0))
    found = fold.stretches(pd.DataFrame(rows, columns=COLUMNS), rate)
    assert len(found) == 4
    assert found["is_creation"].sum() == 1
    kept = found[~found["is_creation"]].sort_values(["creation_id", "arrival_ts"])
    assert kept["clock"].tolist() == [2000, 2000, 3000]
    assert np.allclose(kept["gain"], [1 + 2 ** (-c / 600_000) for c in (2000, 2000, 3000)])


def test_actions_before_their_creation_are_lost():
    make_row = Row(*COLUMNS)
    early = make_row(*action_row(1, 0, 0, 5, 0))
    out, state = fold.follow([early], None, 1e-6)
    assert out == [] and state is None
    made = make_row(1, pd.Timestamp(1), -(2**63), 0, True, "x", *[0] * 7)
    late = make_row(*action_row(1, 1, 0, 2, 1))
    out, state = fold.follow([late, made, early], None, 1e-6)
    assert [(r[0], r[1]) for r in out] == [("x", 1.0)]


def test_state_expires(spark, tmp_path):
    files = Files(spark, tmp_path)
    files.add("made", [(1, None, "c", 1, at(HOUR), 1)], ARRIVED_CREATION)
    files.add("done", [(1, 2, 1, HOUR, at(HOUR), 2, 0)], ARRIVED_ACTION)
    files.add("ticks", [(at(2 * HOUR),)], TICKS)
    files.run(state_ttl=timedelta(hours=5))
    files.add("done", [(1, 2, 1, 3 * HOUR, at(3 * HOUR), 3, 0)], ARRIVED_ACTION)
    files.add("ticks", [(at(20 * HOUR),)], TICKS)
    files.run(state_ttl=timedelta(hours=5))
    # By now the creation is forgotten, and so this action finds none.
    files.add("done", [(1, 2, 1, 21 * HOUR, at(21 * HOUR), 4, 0)], ARRIVED_ACTION)
    files.add("ticks", [(at(21 * HOUR),)], TICKS)
    files.run(state_ttl=timedelta(hours=5))
    files.close()
    files.run(state_ttl=timedelta(hours=5))
    assert sorted(r.last_action_ts for r in files.result().collect()) == [HOUR, 3 * HOUR]


def test_clock_of_data_needs_a_delay(spark):
    with pytest.raises(ValueError, match="delay"):
        pipeline.build_pipeline(spark, kafka_options(True), "board", "checkpoint", clock="kafka")


def test_empty_board(spark):
    assert leaderboard.empty_board(spark).count() == 0


# --- the whole job on rows of Kafka's shape -----------------------------------------------


def message(**fields):
    import json

    return bytearray(json.dumps(fields).encode())


def kafka_files(spark, folder, made, done):
    """Raw topics as files; two actions a message."""
    from hotrank.schemas import RAW

    creations = [
        (message(creationId=k, category=c), "creations", 0, seq, ts)
        for k, _, c, _, ts, seq in made
    ]
    batches = [
        (
            message(
                actionTypeList=",".join(str(r[1]) for r in pair),
                creationIdList=",".join(str(r[2]) for r in pair),
                timestampList=",".join(str(r[3]) for r in pair),
                userId=1,
            ),
            "actions", 0, i, pair[-1][4],
        )
        for i, pair in enumerate(chunks(done, len(done) // 2))
    ]
    for name, rows in (("creations", creations), ("actions", batches)):
        df = spark.createDataFrame(rows, RAW)
        df.coalesce(1).write.parquet(str(folder / name))

    def read_stream(spark, options):
        return spark.readStream.schema(RAW).parquet(str(folder / options.topics[0]))

    def read_batch(spark, options):
        return spark.read.schema(RAW).parquet(str(folder / options.topics[0]))

    return read_stream, read_batch


def kafka_options(bounded, **more):
    sources = [
        KafkaSourceOptions("b:1", [t], "g", start_from_earliest=True, bounded=bounded)
        for t in ("creations", "actions")
    ]
    return RankingOptions(*sources, score_half_life=HALF_LIFE, window_half_life=HALF_LIFE, **more)


@pytest.mark.parametrize("with_intake", [False, True])
def test_bounded_job_in_broker_time(spark, tmp_path, monkeypatch, with_intake):
    made, done = history()
    read_stream, read_batch = kafka_files(spark, tmp_path, made, done)
    monkeypatch.setattr(pipeline.kafka, "read_stream", read_stream)
    monkeypatch.setattr(ranking.kafka, "read_batch", read_batch)
    options = kafka_options(True, window_size=SIZE, board_size=2)
    board_path = str(tmp_path / "board")
    checkpoint = str(tmp_path / "checkpoint")
    job = pipeline.build_pipeline(
        spark, options, board_path, checkpoint, clock="kafka", delay="0 seconds",
        intake_path=str(tmp_path / "intake") if with_intake else None,
    )
    assert job.exception() is None and job.dropped_rows() == 0
    with pytest.raises(ValueError, match="finished"):
        pipeline.build_pipeline(spark, options, board_path, checkpoint)
    found = BoardTable(board_path, 2).read(spark)

    # A batch message arrives as a whole, so both of its actions do at its time.
    arrived = [
        (*a[:4], pair[-1][4], i, pos)
        for i, pair in enumerate(chunks(done, len(done) // 2)) for pos, a in enumerate(pair)
    ]
    rows = in_batch(spark, made, arrived)
    # All windows, also those that no later row closes.
    expected = ranking.replay_board(rows, 2)
    wanted = {(r.category, r.creation_id): r.score for r in expected.collect()}
    assert {(r.category, r.creation_id): r.score for r in found.collect()} == pytest.approx(wanted)

    top = ranking.bounded_ranking(spark, options, str(tmp_path / "tables"))
    best = {(r.category, r.creation_id): r.score for r in top.collect()}
    stateless = {(r.category, r.creation_id): r.score
                 for r in leaderboard.hot_top(rows, 2).collect()}
    assert best == pytest.approx(stateless)


@pytest.mark.parametrize("with_intake", [False, True])
def test_bounded_job_on_the_wall_clock(spark, tmp_path, monkeypatch, with_intake):
    """The board is there when the call returns, and bad messages lie in quarantine."""
    from hotrank.schemas import RAW

    made, done = history()
    read_stream, _ = kafka_files(spark, tmp_path, made, done)
    bad = spark.createDataFrame([(bytearray(b"{bad"), "actions", 0, 10**6, at(HOUR))], RAW)
    bad.coalesce(1).write.mode("append").parquet(str(tmp_path / "actions"))
    monkeypatch.setattr(pipeline.kafka, "read_stream", read_stream)
    options = kafka_options(True)
    board_path = str(tmp_path / "board")
    intake_path = str(tmp_path / "intake") if with_intake else None
    pipeline.build_pipeline(
        spark, options, board_path, str(tmp_path / "checkpoint"), intake_path=intake_path
    )
    found = BoardTable(board_path).read(spark).collect()
    assert {(r.category, r.creation_id) for r in found} == {(f"d{k % 2}", k) for k in range(6)}
    if with_intake:
        left_out = Intake(intake_path, HALF_LIFE).quarantine(spark).collect()
    else:
        left_out = spark.read.parquet(f"{board_path}-quarantine").collect()
    assert [tuple(r) for r in left_out] == [("action_batch", "malformed_json", "{bad")]


def test_late_rows_are_counted_beyond_what_a_query_remembers():
    late = scores.LateRows()

    class Query:
        id, recentProgress = "q", []

    def progress(run, batch, n):
        return {"id": "q", "runId": run, "batchId": batch,
                "stateOperators": [{"numRowsDroppedByWatermark": n}]}

    for args in (("a", 0, 2), ("a", 1, 3), ("a", 1, 0), ("b", 1, 4)):
        late._add(progress(*args))
    Query.recentProgress = [progress("b", 1, 4), progress("b", 2, 1)]
    assert late.of(Query) == 10


def test_live_job_closes_windows_on_quiet_topics(spark, tmp_path, monkeypatch):
    import time

    made, done = history()
    read_stream, _ = kafka_files(spark, tmp_path, made, done)
    monkeypatch.setattr(pipeline.kafka, "read_stream", read_stream)
    options = kafka_options(
        False, window_size=timedelta(seconds=2), trigger_interval=timedelta(seconds=1)
    )
    board = BoardTable(str(tmp_path / "board"))
    query = pipeline.build_pipeline(spark, options, board.path, str(tmp_path / "checkpoint"))
    try:
        until = time.time() + 90
        while not board.versions(spark) and time.time() < until:
            assert query.exception() is None
            time.sleep(1)
    finally:
        query.stop()
    found = board.read(spark).collect()
    # All creations precede all actions, in their newest version.
    assert {(r.category, r.creation_id) for r in found} == {(f"d{k % 2}", k) for k in range(6)}
    assert query.dropped_rows() == 0
