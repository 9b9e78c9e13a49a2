"""Splitting the rows of hot keys so that no task has to hold one of them whole.

A running score is computed key by key, in order. One viral creation may hold a third of all
actions, and a plain window would put them all into one task. Keys above ``segment_rows`` rows
are therefore set apart: Spark's own range partitioning on (key, order) cuts them into
consecutive segments of about that size, the segments are worked on independently, and what one
hands to the next is one small row each. All other keys keep the plain plan: one exchange, into
as many tasks as their rows need.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hotrank.session import as_table, fresh_folder

# A window over this many rows is still one task of about a minute.
SEGMENT_ROWS = 5_000_000
# Rows of whole keys that a task takes on average. Partitions are otherwise cut by bytes as shuffled,
# compressed, and sorted several times in a task; how many there are at most does not follow the data.
TASK_ROWS = 500_000
# Where that gives more tasks than a shuffle writes to without sorting, they take up to this many
# first: beyond, each writer holds the rows of its input split.
MOST_ROWS = 1_250_000
# Sketches of this many keys each, one for every part of the keys; below the 128 groups up to
# which Spark aggregates objects without a sort.
_PARTS = 64
_TRACKED = 3072


@dataclass(frozen=True)
class Split:
    """``rest`` has whole keys; ``hot`` (or None) has a ``segment`` column.

    ``placed``: ``rest`` is partitioned by the key already.
    """

    rest: DataFrame
    hot: DataFrame | None
    placed: bool = False


def split_hot_keys(
    df: DataFrame,
    key: str,
    order: list[str],
    segment_rows: int | None = SEGMENT_ROWS,
) -> Split:
    """Sets apart the keys with more than ``segment_rows`` rows.

    One pass over the key column looks for them by sketch and writes nothing; only when it finds
    some are these counted, and their rows range-partitioned and written to the shared folder:
    the segments must come out the same for everyone who reads them. ``order`` has to be unique
    per key. ``segment_rows=None`` leaves the pass out, for input known to be even. The list of
    hot keys is a table, so the planner knows its size and broadcasts it only while that is small.
    """
    if segment_rows is None:
        return Split(df, None)
    n_all, keys = _looked_through(df, key, segment_rows)
    if keys is None:
        return _spread(df, key, n_all)
    n_rows = keys.agg(F.sum("count")).first()[0]
    keys = keys.select(key)
    hot = (
        df.join(keys, key, "left_semi")
        .repartitionByRange(ceil(n_rows / segment_rows), key, *order)
        .withColumn("segment", F.spark_partition_id())
    )
    hot = as_table(hot, fresh_folder(df.sparkSession, "hot-keys"))
    return _spread(df.join(keys, key, "left_anti"), key, n_all - n_rows, hot)


def _spread(rest: DataFrame, key: str, n_rows: int, hot: DataFrame | None = None) -> Split:
    """Few rows are left to the planner, which gives each core a share of them."""
    context = rest.sparkSession.sparkContext
    unsorted = int(context.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    tasks = tasks_for(n_rows, unsorted)
    if tasks <= context.defaultParallelism:
        return Split(rest, hot)
    return Split(rest.repartition(tasks, key), hot, placed=True)


def tasks_for(n_rows: int, unsorted: int) -> int:
    tasks = ceil(n_rows / TASK_ROWS)
    return tasks if tasks <= unsorted else max(unsorted, ceil(n_rows / MOST_ROWS))


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame | None:
    """``key, count`` of the keys with more than ``rows`` rows, as a table; None without any.

    Tasks hand on sketches of frequent items, at most ``_PARTS * _TRACKED`` keys each, where a
    count of all keys would shuffle every key of every task. What a sketch says is never below
    the true count, so only keys it puts above ``rows`` are counted exactly. By the sketch's
    published error bound a key of more than one in 580 rows of its part is found: where parts are
    even, one in 37,000 of all, hence all keys of up to 190 billion rows at the usual ``rows``. Beyond
    that, or beside a very hot key of its part, a lesser one may be passed over; it is then
    worked on whole, which costs time but changes no result. NULL is no key.
    """
    return _looked_through(df, key, rows)[1]


def _looked_through(df: DataFrame, key: str, rows: int) -> tuple[int, DataFrame | None]:
    """How many rows have a key, and ``hot_keys``."""
    part = F.pmod(F.xxhash64(key), F.lit(_PARTS))
    found = (
        df.filter(F.col(key).isNotNull())
        .groupBy(part.alias("part"))
        .agg(
            F.count("*").alias("n"),
            F.expr(f"approx_top_k(`{key}`, {_TRACKED}, {_TRACKED})").alias("top"),
        )
        .select("n", F.filter("top", lambda x: x["count"] > rows).alias("top"))
    )
    parts = found.collect()
    n_rows = sum(p.n for p in parts)
    # No more than the sketches track.
    candidates = [(x["item"],) for p in parts for x in p.top]
    if not candidates:
        return n_rows, None
    spark = df.sparkSession
    schema = StructType().add(key, found.schema["top"].dataType.elementType["item"].dataType)
    listed = as_table(
        spark.createDataFrame(candidates, schema), fresh_folder(spark, "hot-key-candidates"))
    counts = df.join(listed, key, "left_semi").groupBy(key).count().filter(F.col("count") > rows)
    counts = as_table(counts, fresh_folder(spark, "hot-key-counts"))
    return n_rows, None if counts.isEmpty() else counts
