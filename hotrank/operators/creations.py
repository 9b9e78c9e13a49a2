"""The creation table and its as-of join with actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hotrank.functions.decay import LONG_MIN
from hotrank.operators.hotkeys import SEGMENT_ROWS, split_hot_keys
from hotrank.schemas import ARRIVAL_ORDER


def latest_creations(creations: DataFrame) -> DataFrame:
    """Last version of each creation by arrival."""
    columns = [c for c in creations.columns if c != "creation_id"]
    newest = F.max_by(F.struct(*columns), F.struct("arrival_ts", "arrival_seq"))
    return (
        creations.filter(F.col("creation_id").isNotNull())
        .groupBy("creation_id")
        .agg(newest.alias("newest"))
        .select("creation_id", "newest.*")
    )


def enrich_latest(actions: DataFrame, creations: DataFrame) -> DataFrame:
    """Actions with the newest category of their creation, whenever it arrived.

    For creations that are all known beforehand. No hint: the planner broadcasts the creation
    side when it is small, and splits skewed partitions of a sort-merge join otherwise.
    """
    table = latest_creations(creations).select("creation_id", "category")
    return actions.join(table, "creation_id")


def timeline(creations: DataFrame, actions: DataFrame) -> DataFrame:
    """Both inputs in one frame, in one order: ``ARRIVAL_ORDER``.

    Creation rows carry a ``creation`` struct, action rows an ``action`` struct. At equal
    ``arrival_ts`` creations come first, hence their lowest ``arrival_seq``; their own
    sequence moves to ``pos``.
    """
    made = creations.filter(F.col("creation_id").isNotNull()).select(
        "creation_id",
        "arrival_ts",
        F.lit(LONG_MIN).alias("arrival_seq"),
        F.col("arrival_seq").alias("pos"),
        F.struct("category").alias("creation"),
    )
    done = actions.select(
        "creation_id",
        *ARRIVAL_ORDER,
        F.struct("user_id", "action_type", "action_ts").alias("action"),
    )
    return made.unionByName(done, allowMissingColumns=True)


def _last_creation(keys: list[str]) -> Column:
    seen = Window.partitionBy(*keys).orderBy(*ARRIVAL_ORDER)
    return F.last("creation", ignorenulls=True).over(
        seen.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _known_actions(rows: DataFrame) -> DataFrame:
    """Actions whose creation had been seen by then; the others are lost for good."""
    return rows.filter(F.col("action").isNotNull() & F.col("creation").isNotNull()).select(
        "creation_id", "creation.category", "action.*", *ARRIVAL_ORDER,
        *[c for c in rows.columns if c in ("segment", "island")],
    )


def _silence(before: Column, ttl_ms: int) -> Column:
    """1 where nothing had arrived for ``ttl_ms`` since ``before``, else 0."""
    gap = F.unix_micros("arrival_ts") - F.unix_micros(before)
    return F.coalesce((gap >= ttl_ms * 1000).cast("long"), F.lit(0).cast("long"))


def islands_whole(rows: DataFrame, ttl_ms: int) -> DataFrame:
    """Adds ``island`` to a timeline of whole keys: it goes up where nothing came for ``ttl_ms``.

    What was known of a creation is forgotten between islands.
    """
    w = Window.partitionBy("creation_id").orderBy(*ARRIVAL_ORDER)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_silent", _silence(F.lag("arrival_ts").over(w), ttl_ms))
        .withColumn("island", F.sum("_silent").over(so_far)).drop("_silent")
    )


def islands_segments(rows: DataFrame, ttl_ms: int) -> DataFrame:
    """The same of a segmented timeline, with one row per segment handed on."""
    keys = ["creation_id", "segment"]
    w = Window.partitionBy(*keys).orderBy(*ARRIVAL_ORDER)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_silent", _silence(F.lag("arrival_ts").over(w), ttl_ms)).withColumn(
        "_inside", F.sum("_silent").over(so_far))
    by_segment = Window.partitionBy("creation_id").orderBy("segment")
    ends = local.groupBy(*keys).agg(
        F.min("arrival_ts").alias("arrival_ts"), F.max("arrival_ts").alias("last"),
        F.sum("_silent").alias("n"),
    ).withColumn("opens", _silence(F.lag("last").over(by_segment), ttl_ms))
    ends = ends.select(
        *keys,
        # Islands up to this segment's first row: its own opening, and all of the segments before.
        (F.sum(F.col("opens") + F.col("n")).over(
            by_segment.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
        .alias("_from"),
    )
    return local.join(ends, keys).withColumn("island", F.col("_from") + F.col("_inside")).drop(
        "_silent", "_inside", "_from")


def as_of_whole(rows: DataFrame, keys: tuple[str, ...] = ("creation_id",)) -> DataFrame:
    """As-of join of a timeline whose keys are whole."""
    return _known_actions(rows.withColumn("creation", _last_creation(list(keys))))


def as_of_segments(rows: DataFrame, whole: tuple[str, ...] = ("creation_id",)) -> DataFrame:
    """As-of join of a segmented timeline.

    Each segment starts from the last creation of the segments before it, found from one
    pre-aggregated row per segment.
    """
    keys = [*whole, "segment"]
    place = F.struct(*ARRIVAL_ORDER)
    left = rows.groupBy(*keys).agg(
        # NULL when the segment brings no creation.
        F.max_by("creation", F.when(F.col("creation").isNotNull(), place)).alias("newest")
    )
    before = Window.partitionBy(*whole).orderBy("segment")
    left = left.select(
        *keys,
        F.last("newest", ignorenulls=True)
        .over(before.rowsBetween(Window.unboundedPreceding, -1))
        .alias("earlier"),
    )
    # The window has laid the rows out by both keys already: no exchange but that of ``left``.
    seen = rows.withColumn("creation", _last_creation(keys)).join(left, keys)
    return _known_actions(
        seen.withColumn("creation", F.coalesce("creation", "earlier")).drop("earlier")
    )


def enrich_as_of(
    creations: DataFrame, actions: DataFrame, segment_rows: int | None = SEGMENT_ROWS
) -> DataFrame:
    """Each action with the creation version that had arrived last before it.

    Inner: actions that come before their creation are dropped. Linear in both inputs, one
    exchange on ``creation_id``; hot keys are cut into segments.
    """
    # Actions without id find no creation; left in, they would make one partition of their own.
    known = actions.filter(F.col("creation_id").isNotNull())
    split = split_hot_keys(
        timeline(creations, known), "creation_id", ARRIVAL_ORDER, segment_rows
    )
    out = as_of_whole(split.rest)
    if split.hot is not None:
        out = out.unionByName(as_of_segments(split.hot).drop("segment"))
    return out
