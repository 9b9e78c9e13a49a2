"""The whole job as batch plans: from creations and actions to windowed scores and boards."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.operators import actions as split
from hotrank.operators.creations import latest_creations
from hotrank.operators.hotkeys import SEGMENT_ROWS
from hotrank.operators.leaderboard import (
    BOARD_SIZE,
    by_window,
    empty_board,
    fold_windows,
    hot_top,
    window_ends,
)
from hotrank.operators.scoring import score_timeline
from hotrank.operators.windows import (
    decay_to_window_end,
    event_time_window_scores,
    windowed_scores,
)
from hotrank.options import RankingOptions
from hotrank.session import fresh_folder
from hotrank.sources import decode, kafka


def windowed(
    creations: DataFrame,
    actions: DataFrame,
    window_size: timedelta,
    score_half_life: timedelta,
    window_half_life: timedelta,
    order_by: str = "arrival",
    segment_rows: int | None = SEGMENT_ROWS,
    state_ttl: timedelta | None = None,
) -> DataFrame:
    """Windowed decayed scores, action by action as the stream computes them."""
    scored = score_timeline(
        creations, actions, score_half_life, order_by, segment_rows, state_ttl
    )
    return windowed_scores(scored, window_size, window_half_life)


def windowed_event_time(
    creations: DataFrame,
    actions: DataFrame,
    window_size: timedelta,
    score_half_life: timedelta,
    window_half_life: timedelta,
) -> DataFrame:
    """The same for actions that arrive when they happen, on creations known beforehand.

    Actions shrink to one row per creation and window before anything is shuffled or joined.
    """
    reduced = event_time_window_scores(actions, score_half_life, window_size)
    table = latest_creations(creations).select("creation_id", "category")
    return decay_to_window_end(reduced.join(table, "creation_id"), window_half_life)


def replay_board(windows: DataFrame, n: int = BOARD_SIZE) -> DataFrame:
    """Board after all windows were written to an empty one, oldest first."""
    spark = windows.sparkSession
    table = by_window(windows, fresh_folder(spark, "windows"))
    return fold_windows(empty_board(spark), table, window_ends(table), n)


def bounded_ranking(
    spark: SparkSession,
    options: RankingOptions,
    output: str,
    creations_raw: DataFrame | None = None,
    actions_raw: DataFrame | None = None,
    segment_rows: int | None = SEGMENT_ROWS,
) -> DataFrame:
    """Reads both topics up to their latest offsets and ranks what they hold.

    Messages are decoded once, into two tables under ``output``; everything later reads those
    with column pruning. What could not be decoded or split lies in their ``sound=false``
    partitions, with its reason and raw text. Broker time serves as arrival time, since all
    messages are read at once.
    """
    if creations_raw is None:
        creations_raw = kafka.read_batch(spark, options.creation_source)
    if actions_raw is None:
        actions_raw = kafka.read_batch(spark, options.action_source)
    made = decode.decode_creations(
        kafka.with_arrival(creations_raw, list(options.creation_source.topics), "kafka")
    )
    done = split.split_batches(
        decode.decode_action_batches(
            kafka.with_arrival(actions_raw, list(options.action_source.topics), "kafka")
        )
    )
    if options.on_malformed == "fail":
        made = decode.accepted(made, "fail").withColumn("reason", F.lit(None).cast("string"))
        done = split.actions_of(done, "fail").withColumn("reason", F.lit(None).cast("string"))
    tables = {}
    for name, rows in (("creations", made), ("actions", done)):
        sound = F.col("reason").isNull()
        if "raw" in rows.columns:
            rows = rows.withColumn("raw", F.when(~sound, F.col("raw")))
        rows.withColumn("sound", sound).write.mode("overwrite").partitionBy("sound").parquet(
            f"{output}/{name}"
        )
        # The folder's name comes back as text. Empty topics leave no files to take types from.
        schema = rows.withColumn("sound", F.lit("true")).schema
        tables[name] = (
            spark.read.schema(schema).parquet(f"{output}/{name}").filter("sound = 'true'")
        )
    rows = windowed(
        tables["creations"],
        tables["actions"],
        options.window_size,
        options.score_half_life,
        options.window_half_life,
        segment_rows=segment_rows,
    )
    return hot_top(rows, options.board_size)
