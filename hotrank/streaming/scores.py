"""Enrichment and running score on streams: one keyed stateful operator."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import (
    StatefulProcessor,
    StatefulProcessorHandle,
    StreamingQueryListener,
)

from hotrank.functions.decay import LONG_MIN, action_weight, decay_rate, millis
from hotrank.operators.windows import windowed_scores
from hotrank.schemas import ARRIVAL_ORDER
from hotrank.session import send_by_value
from hotrank.streaming.fold import STRETCH, follow_all, stretches, stretches_of_slices

#: Creations of one bucket, column by column.
_STATE = (
    "ids array<bigint>, category array<string>, score array<double>, last_ts array<bigint>, "
    "seen_us array<bigint>"
)
STATE_NAME = "creations"
#: Buckets of a shard, as a power of two. A bucket is read and written in one go, since every call
#: to the state is a message to the JVM: a micro-batch sends as many as it touches buckets.
BUCKET_BITS = 6
#: Parts the state is kept in; a checkpoint goes on with the number it began with.
SHARDS = 1024
_SCORED = (
    "creation_id bigint, category string, score double, last_action_ts bigint, "
    "arrival_ts timestamp, arrival_seq bigint, pos bigint"
)


def _buckets(ids: np.ndarray) -> list[int]:
    """Bucket of each creation, independent of its shard."""
    mixed = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64).tolist()


def _held(value) -> dict[int, tuple]:
    """States by creation of one bucket."""
    return {} if value is None else {x: tuple(state) for x, *state in zip(*value)}


def _packed(held: dict[int, tuple]) -> tuple:
    return (list(held), *(list(column) for column in zip(*held.values())))


class ScoreKeeper(StatefulProcessor):
    """Of every creation of a shard: its latest version, its score, its last action and arrival.

    Creations and actions share one state, which is what lets an action find its creation. Rows
    of all creations of a shard are followed at once. Nothing expires unless ``ttl_ms`` is set:
    then a creation is forgotten when nothing arrives for it so long. Timers only clear up what
    the watermark has left behind for good, a shard at a time.
    """

    def __init__(self, rate: float, ttl_ms: int | None = None):
        self.rate = rate
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getMapState(STATE_NAME, "bucket int", _STATE)

    def _keep(self, bucket: int, held: dict[int, tuple]) -> None:
        if held:
            self.state.updateValue((bucket,), _packed(held))
        else:
            self.state.removeKey((bucket,))

    def handleInputRows(self, key, rows, timerValues):
        rows = pd.concat(list(rows), ignore_index=True)
        ids = np.unique(rows["creation_id"].to_numpy())
        of = dict(zip(ids.tolist(), _buckets(ids)))
        buckets = {b: _held(self.state.getValue((b,))) for b in set(of.values())}
        known = {x: buckets[b][x] for x, b in of.items() if x in buckets[b]}
        ttl_us = None if self.ttl_ms is None else self.ttl_ms * 1000
        scored, after = follow_all(rows, known, self.rate, ttl_us)
        changed = set()
        for creation, state in after.items():
            if state is not None:
                buckets[of[creation]][creation] = state
                changed.add(of[creation])
            elif creation in known:
                del buckets[of[creation]][creation]
                changed.add(of[creation])
        for bucket in changed:
            self._keep(bucket, buckets[bucket])
        if self.ttl_ms is not None and not list(self.handle.listTimers()):
            left = [state[3] for state in after.values() if state is not None]
            if left:
                self.handle.registerTimer(min(left) // 1000 + self.ttl_ms + 1)
        if len(scored):
            yield scored

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, oldest = timerValues.getCurrentWatermarkInMs(), None
        for (bucket,), value in list(self.state.iterator()):
            held = _held(value)
            left = {x: state for x, state in held.items() if state[3] // 1000 + self.ttl_ms >= now}
            if len(left) < len(held):
                self._keep(bucket, left)
            for state in left.values():
                oldest = state[3] if oldest is None else min(oldest, state[3])
        if oldest is not None:
            # Not for every creation by itself: a shard is looked through a few times per span.
            due = oldest // 1000 + self.ttl_ms + 1
            self.handle.registerTimer(max(due, now + self.ttl_ms // 4 + 1))
        return iter(())

    def close(self) -> None:
        pass


def _creation_rows(creations: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    none = [zero, zero, zero, F.lit(0.0), zero, zero, F.lit(0.0)]
    return creations.select(
        "creation_id",
        "arrival_ts",
        F.lit(LONG_MIN).alias("arrival_seq"),
        F.col("arrival_seq").alias("pos"),
        F.lit(True).alias("is_creation"),
        "category",
        *[value.alias(name) for name, value in zip(STRETCH, none)],
        *_arrivals(),
    )


def _arrivals() -> list:
    """When a row arrives, and the span of what it sums up, in microseconds."""
    us = F.unix_micros("arrival_ts")
    return [us.alias("arrival_us"), us.alias("from_us"), us.alias("until_us")]


def silent(ticks: DataFrame) -> DataFrame:
    """Ticks as versions of a creation that nobody acts on."""
    return _creation_rows(
        ticks.select(
            F.lit(LONG_MIN).alias("creation_id"),
            "arrival_ts",
            F.lit(0).cast("long").alias("arrival_seq"),
            F.lit(None).cast("string").alias("category"),
        )
    )


def stream_timeline(creations: DataFrame, actions: DataFrame) -> DataFrame:
    """Both streams as rows of one shape; an action is a stretch of one.

    At equal ``arrival_ts`` creations come first, hence their lowest ``arrival_seq``.
    """
    zero = F.lit(0).cast("long")
    ts, weight = F.col("action_ts"), action_weight(F.col("action_type"))
    one = [ts, ts, zero, weight, ts, zero, weight]
    made = _creation_rows(creations.filter(F.col("creation_id").isNotNull()))
    done = actions.select(
        "creation_id",
        *ARRIVAL_ORDER,
        F.lit(False).alias("is_creation"),
        F.lit(None).cast("string").alias("category"),
        *[value.alias(name) for name, value in zip(STRETCH, one)],
        *_arrivals(),
    )
    return made.unionByName(done)


def combine_in_tasks(rows: DataFrame, rate: float) -> DataFrame:
    """Shrinks a hot creation before the shuffle: to one row per Arrow batch and ``arrival_ts``.

    Only for input whose tasks hold a consecutive part of each ``arrival_ts``, as Kafka's do:
    rows of one time are ordered by partition and offset, and a task reads one range of one
    partition. Under the wall clock a whole micro-batch has one time.
    """

    def shrink(batches):
        for batch in batches:
            yield stretches(batch, rate)

    return rows.mapInPandas(shrink, rows.schema)


def combine_in_slices(rows: DataFrame, rate: float, slice_us: int) -> DataFrame:
    """Shrinks hot creations on any clock: to one row per slice of arrival and version.

    A creation's rows of one slice meet in one task, those of different slices in different ones,
    so that no task gets a hot creation's micro-batch whole. What comes out is strung together by
    the state. A stretch arrives with its last action and is late only when that is.
    """

    def shrink(batches):
        held = list(batches)
        if held:
            yield stretches_of_slices(pd.concat(held, ignore_index=True), rate).drop(columns="slice")

    sliced = rows.withColumn("slice", F.floor(F.unix_micros("arrival_ts") / F.lit(slice_us)))
    return sliced.repartition("creation_id", "slice").mapInPandas(shrink, rows.schema)


def slice_of(size: timedelta | int) -> int:
    """Milliseconds of a slice: the finest of at most 300 equal parts of a window."""
    span = millis(size)
    return next(span // parts for parts in range(300, 0, -1) if span % parts == 0)


def score_stream(
    creations: DataFrame,
    actions: DataFrame,
    half_life: timedelta | int,
    delay: str = "0 seconds",
    combine: bool = False,
    state_ttl: timedelta | int | None = None,
    ticks: DataFrame | None = None,
    slice_size: timedelta | int | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """Scored actions of two streams, in arrival order.

    ``delay`` is how far ``arrival_ts`` may run behind: zero under the wall clock, more with any
    clock taken from data, since later rows are dropped before they are scored
    (``dropped_rows`` counts them). ``ticks`` is a stream with an ``arrival_ts`` only; it moves
    the watermark on when nothing else arrives. ``combine`` shrinks hot creations inside tasks,
    ``slice_size`` (a part of the window that all windows are made up of, and not above
    ``state_ttl``) in tasks of their own. After ``state_ttl`` without a row for it a creation is forgotten.
    """
    if slice_size is not None and state_ttl is not None and millis(state_ttl) < millis(slice_size):
        raise ValueError("a slice is not longer than the time creations are remembered")
    rows = combined(stream_timeline(creations, actions), half_life, combine, slice_size)
    if ticks is not None:
        rows = rows.unionByName(silent(ticks))
    return score_rows(rows, half_life, delay, state_ttl, shards)


def combined(
    rows: DataFrame, half_life: timedelta | int, combine: bool = False,
    slice_size: timedelta | int | None = None,
) -> DataFrame:
    """A timeline whose hot creations are shrunk in one of the two ways, or as it is."""
    rate = decay_rate(half_life)
    send_by_value()
    if slice_size is not None:
        return combine_in_slices(rows, rate, millis(slice_size) * 1000)
    return combine_in_tasks(rows, rate) if combine else rows


def score_rows(
    rows: DataFrame,
    half_life: timedelta | int,
    delay: str = "0 seconds",
    state_ttl: timedelta | int | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """Scored actions of one stream of timeline rows."""
    rate = decay_rate(half_life)
    # The only provider that can hold this operator's state; it keeps it on disk.
    rows.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    send_by_value()
    ttl_ms = None if state_ttl is None else millis(state_ttl)
    return (
        rows.withColumn("shard", F.pmod(F.xxhash64("creation_id"), F.lit(shards)).cast("int"))
        .withWatermark("arrival_ts", delay)
        .groupBy("shard")
        .transformWithStateInPandas(
            ScoreKeeper(rate, ttl_ms),
            outputStructType=_SCORED,
            outputMode="Append",
            timeMode="EventTime",
            eventTimeColumnName="arrival_ts",
        )
    )


def creation_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the newest finished micro-batch of a checkpoint holds, one row per creation.

    ``creation_id, category, score, last_action_ts, seen_us``: read by Spark's state source, while
    the query runs or after it. Rows per shard of the state follow from ``shard``.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    keeper = operators.filter("operatorName like 'transformWithState%'").first()
    held = (
        spark.read.format("statestore").option("stateVarName", STATE_NAME)
        .option("operatorId", keeper.operatorId).load(checkpoint)
    )
    columns = [f"user_map_value.{name}" for name in ("ids", "category", "score", "last_ts", "seen_us")]
    return held.select("key.shard", F.inline(F.arrays_zip(*columns))).toDF(
        "shard", "creation_id", "category", "score", "last_action_ts", "seen_us"
    ).select(
        "creation_id", "category", "score", "last_action_ts", "seen_us", "shard",
    ).where(F.col("creation_id") != LONG_MIN)


def windowed_stream(
    scored: DataFrame, size: timedelta | int, half_life: timedelta | int
) -> DataFrame:
    """Windowed decayed scores; each window comes out once, when the watermark passes its end."""
    return windowed_scores(scored, size, half_life)


def _late(progress) -> int:
    return sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])


def dropped_rows(query) -> int:
    """Rows the query dropped as late in the batches it still remembers."""
    return sum(_late(progress) for progress in query.recentProgress)


class LateRows(StreamingQueryListener):
    """Counts the late rows of all batches, also of those a query no longer remembers.

    To be added to a session's listeners before its queries start.
    """

    def __init__(self):
        self._seen: dict[tuple[str, str, int], int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def _add(self, progress) -> None:
        # A batch may be reported again while its query idles.
        at = (str(progress["id"]), str(progress["runId"]), progress["batchId"])
        self._seen[at] = max(self._seen.get(at, 0), _late(progress))

    def of(self, *queries) -> int:
        """Rows dropped by ``queries``; their last reports are read from the queries themselves."""
        for query in queries:
            for progress in query.recentProgress:
                self._add(progress)
        ids = {str(query.id) for query in queries}
        return sum(n for (query_id, _, _), n in list(self._seen.items()) if query_id in ids)
