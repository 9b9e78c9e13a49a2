"""Tumbling windows over arrival: newest score per creation, decayed to the window's end."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotrank.functions.decay import LONG_MIN, action_weight, decay, decay_rate, decayed_to, millis
from hotrank.operators.scoring import CHUNK_EXPONENT, decayed_running_sum
from hotrank.schemas import ARRIVAL_ORDER, SCORE_COLUMNS, WINDOWED_COLUMNS


def tumbling(arrival_ts: str, size: timedelta | int) -> Column:
    """Epoch-aligned window of ``arrival_ts``; its end is exclusive."""
    return F.window(arrival_ts, f"{millis(size)} milliseconds")


def latest_per_window(scored: DataFrame, size: timedelta | int) -> DataFrame:
    """Row with the newest ``last_action_ts`` per creation and window.

    A NULL time counts as the lowest; on a tie the later arrival wins. One running row per
    group, combined before any shuffle; on scored rows it reuses their partitioning.
    """
    newest = F.max_by(
        F.struct("category", "score", "last_action_ts"),
        F.struct(F.coalesce("last_action_ts", F.lit(LONG_MIN)), *ARRIVAL_ORDER),
    )
    return (
        scored.groupBy("creation_id", tumbling("arrival_ts", size).alias("w"))
        .agg(newest.alias("newest"))
        .select(
            "creation_id",
            "newest.*",
            F.unix_millis("w.start").alias("window_start"),
            F.unix_millis("w.end").alias("window_end"),
        )
    )


def decay_to_window_end(latest: DataFrame, half_life: timedelta | int) -> DataFrame:
    """Score brought forward to the window's end. Never fed back into the running score."""
    score = decayed_to(
        F.col("score"), F.col("last_action_ts"), F.col("window_end"), decay_rate(half_life)
    )
    return latest.withColumn("score", score).select(*WINDOWED_COLUMNS)


def windowed_scores(
    scored: DataFrame, size: timedelta | int, half_life: timedelta | int
) -> DataFrame:
    return decay_to_window_end(latest_per_window(scored, size), half_life)


def without_window(windowed: DataFrame) -> DataFrame:
    """The plain score columns, for a reader that does not care about windows."""
    return windowed.select(*SCORE_COLUMNS)


def event_time_window_scores(
    actions: DataFrame, half_life: timedelta | int, size: timedelta | int
) -> DataFrame:
    """Newest event-order score per creation and window, without a row per action.

    For actions that arrive when they happen (``arrival_ts`` is ``action_ts``). The newest
    action of a window is then the last in event order, so its score is everything the window
    brought plus what the windows before left: one decayed sum per creation and cell, which
    combines before the shuffle, and a running sum over those few rows. No sort of actions,
    and a hot creation shrinks to one row per task and cell.

    A cell is a window, cut where it is long against the half-life so that exponents stay in
    range. Takes actions without category: that joins the reduced rows.
    """
    rate = decay_rate(half_life)
    span = max(1, int(CHUNK_EXPONENT / rate))
    left = F.lit(span).cast("long") - F.pmod("action_ts", F.lit(span).cast("long"))
    cells = (
        actions.select(
            "creation_id",
            tumbling("arrival_ts", size).alias("w"),
            "action_ts",
            (F.col("action_ts") + left).alias("cell_end"),
            (action_weight(F.col("action_type")) * decay(rate, left)).alias("at_end"),
        )
        .groupBy("creation_id", "w", "cell_end")
        .agg(F.sum("at_end").alias("gain"), F.max("action_ts").alias("last_action_ts"))
        .select(
            "creation_id",
            "last_action_ts",
            # Back from the end of the cell to its newest action.
            (F.col("gain") * F.exp(F.lit(rate) * (F.col("cell_end") - F.col("last_action_ts"))))
            .alias("gain"),
            F.unix_millis("w.start").alias("window_start"),
            F.unix_millis("w.end").alias("window_end"),
        )
    )
    cells = cells.repartition("creation_id")
    total = decayed_running_sum(
        cells, ["creation_id"], ["last_action_ts"], "gain", "last_action_ts", rate, "score"
    )
    last_cell = Window.partitionBy("creation_id", "window_end").orderBy(F.desc("last_action_ts"))
    return (
        total.withColumn("_nth", F.row_number().over(last_cell))
        .filter("_nth = 1")
        .select("creation_id", "score", "last_action_ts", "window_start", "window_end")
    )
