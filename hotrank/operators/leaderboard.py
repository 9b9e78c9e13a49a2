"""Rankings: the stateless top N, and the board that a sorted set trimmed on write would hold."""

from __future__ import annotations

from heapq import nlargest
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hotrank.functions.text import member_text
from hotrank.schemas import BOARD, BOARD_COLUMNS
from hotrank.session import as_table, checkpointed, send_by_value

BOARD_SIZE = 100
#: Windows are folded in runs of this many rows by board size, so that a category's rows of a run
#: fit one task: at most about twice as many.
RUN_ROWS = 100_000
_BEFORE_ALL = -(1 << 63)
# Up to this many places the planner itself cuts each task's rows before the shuffle.
_PLANNER_LIMIT = 1000


def empty_board(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BOARD)


def top_n(scores: DataFrame, n: int = BOARD_SIZE) -> DataFrame:
    """Best ``n`` per category, ties by the id's text, both descending.

    Rows without a category are dropped; the empty category is one like any other. The planner
    keeps at most ``n`` rows per category and task before it shuffles by category, so a
    category with most of the rows costs no more than ``n`` rows per task. It does so for short
    rankings only; for long ones each task's rows are first cut down apart, so that no group of
    the cut is larger than a task's input and their number grows with the data.
    """
    order = [F.desc("score"), member_text(F.col("creation_id")).desc()]
    scores = scores.filter(F.col("category").isNotNull())
    if n > _PLANNER_LIMIT:
        best = Window.partitionBy("category", "_share").orderBy(*order)
        scores = scores.withColumn("_share", F.spark_partition_id())
        scores = scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
        scores = scores.drop("_share", "rank")
    best = Window.partitionBy("category").orderBy(*order)
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def latest_scores(windowed: DataFrame) -> DataFrame:
    """Last windowed score of each creation in each category it was in."""
    newest = F.max_by(F.struct("score", "window_end"), "window_end")
    return (
        windowed.filter(F.col("category").isNotNull())
        .groupBy("category", "creation_id")
        .agg(newest.alias("newest"))
        .select("category", "creation_id", "newest.*")
    )


def hot_top(windowed: DataFrame, n: int = BOARD_SIZE) -> DataFrame:
    """Top ``n`` per category of the latest scores, whatever was ranked before."""
    return top_n(latest_scores(windowed), n).select(*BOARD_COLUMNS)


def leaderboard_update(board: DataFrame, batch: DataFrame, n: int = BOARD_SIZE) -> DataFrame:
    """Board after the rows of one window were written to it.

    A written score replaces the member's old one in that category, then everything below
    place ``n`` is forgotten: a member trimmed earlier returns only when it is written again.
    A member that changed category stays where it was, too. Writing the same rows twice
    changes nothing.
    """
    held = board.select("category", "creation_id", "score", "window_end", F.lit(0).alias("_new"))
    written = batch.filter(F.col("category").isNotNull()).select(
        "category", "creation_id", "score", "window_end", F.lit(1).alias("_new")
    )
    newest = F.max_by(F.struct("score", "window_end"), F.struct("_new", "window_end"))
    merged = (
        held.unionByName(written)
        .groupBy("category", "creation_id")
        .agg(newest.alias("newest"))
        .select("category", "creation_id", "newest.*")
    )
    return top_n(merged, n).select(*BOARD_COLUMNS)


def by_window(windows: DataFrame, folder: str) -> DataFrame:
    """``windows`` laid out in ``folder`` by their end.

    Rebalanced: few files per window, yet a window with most of the rows is still split.
    """
    rows = windows.filter(F.col("category").isNotNull()).hint("rebalance", "window_end")
    return as_table(rows, folder, "window_end")


def window_ends(windows: DataFrame) -> list[int]:
    return sorted(r[0] for r in windows.select("window_end").distinct().collect())


def fold_windows(
    board: DataFrame, windows: DataFrame, ends: list[int], n: int = BOARD_SIZE
) -> DataFrame:
    """Board after the windows that end at ``ends`` were written to it, one after the other.

    A window has one row per category and creation. The trim makes every window depend on the
    one before, but only within a category, so categories are folded apart, a long run of
    windows at a time. What reaches a fold is bounded by ``2 * n`` rows per window: the best
    ``n``, and lower rows of members whose row before was among the best of its window. A lower
    row cannot stay on the board and matters only by taking its member's older score off it, and
    only a row among the best can have brought the member there.
    """
    send_by_value()
    run = max(1, RUN_ROWS // n)
    for start in range(0, len(ends), run):
        if start:
            board = checkpointed(board)
        part = ends[start : start + run]
        board = _fold_run(board, windows.filter(F.col("window_end").between(part[0], part[-1])), n)
    return board


def _fold_run(board: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    columns = ["category", "creation_id", "score", "window_end"]
    held = board.select(*columns, F.lit(_BEFORE_ALL).alias("step"))
    written = windows.filter(F.col("category").isNotNull()).select(
        *columns, F.col("window_end").alias("step")
    )
    rows = held.unionByName(written)
    best = Window.partitionBy("category", "step").orderBy(
        F.desc("score"), member_text(F.col("creation_id")).desc()
    )
    top = rows.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= n)
    # A row among the best comes twice, marked first. So the row before an unmarked one is its own
    # mark or the member's row of an earlier window, which was marked if a row of its step precedes.
    both = rows.withColumn("top", F.lit(False)).unionByName(
        top.drop("_place").withColumn("top", F.lit(True))
    )
    member = Window.partitionBy("category", "creation_id").orderBy("step", F.desc("top"))
    last, last_but_one = F.lag("step").over(member), F.lag("step", 2).over(member)
    kept = both.withColumn("_takes_off", (last < F.col("step")) & (last_but_one == last)).filter(
        "top or _takes_off"
    )
    return (
        kept.select("category", "creation_id", "score", "window_end", "step", "top")
        .groupBy("category")
        .applyInPandas(_folded(n), BOARD)
    )


def _folded(n: int):
    def fold(rows):
        """The board of one category after its rows, window by window."""
        rows = rows.sort_values("step", kind="stable").reset_index(drop=True)
        board: dict[int, int] = {}

        def order(entry):
            return scores[entry[1]], str(entry[0])

        ids, scores, tops = (rows[c].tolist() for c in ("creation_id", "score", "top"))
        for _, at in groupby(range(len(rows)), rows["step"].tolist().__getitem__):
            for i in at:
                if tops[i]:
                    board[ids[i]] = i
                else:
                    board.pop(ids[i], None)
            if len(board) > n:
                board = dict(nlargest(n, board.items(), key=order))
        ranked = sorted(board.items(), key=order, reverse=True)
        found = rows.iloc[[i for _, i in ranked]]
        return found.assign(rank=range(1, len(found) + 1))[BOARD_COLUMNS]

    return fold
