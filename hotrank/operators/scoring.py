"""The running decayed score, as window expressions.

Action by action a score is decayed over the time since the previous action and raised by the
action's weight. Unrolled, the score after action n is

    sum over i <= n of  weight_i * exp(-rate * (clock_n - clock_i))

where ``clock`` adds up the forward steps of the action times in the chosen order (in event
order it is the action time itself). Everything here is that sum.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hotrank.functions.decay import action_weight, decay, decay_rate, elapsed, millis
from hotrank.operators.creations import (
    as_of_segments,
    as_of_whole,
    islands_segments,
    islands_whole,
    timeline,
)
from hotrank.operators.hotkeys import SEGMENT_ROWS, split_hot_keys
from hotrank.schemas import ARRIVAL_ORDER, EVENT_ORDER
from hotrank.session import as_table, fresh_folder

# Exponents are kept within this range, so exp() neither overflows nor loses digits. What lies
# more than CHUNKS_BACK chunks back has shrunk by exp(-768) at least, which no double holds.
CHUNK_EXPONENT = 256
CHUNKS_BACK = 3


def decayed_running_sum(
    df: DataFrame, keys: list[str], order: list[str], weight: str, clock: str, rate: float,
    name: str,
) -> DataFrame:
    """Adds ``name``: the decayed sum of ``weight`` up to each row, per key in ``order``.

    ``clock`` is a bigint that never falls along ``order``. The plain form with exp(+rate*clock)
    would overflow, so the clock is cut into chunks: a running sum inside the row's chunk plus
    the whole of each of the ``CHUNKS_BACK`` chunks before. ``weight`` must not be negative: the
    whole of a chunk is then the highest of its running sums, and all windows share one sort. They
    share one exchange too if ``df`` is partitioned by ``keys`` already; left alone, the first
    would ask for chunks.
    """
    span = max(1, int(CHUNK_EXPONENT / rate))
    in_chunk = (
        Window.partitionBy(*keys, "_chunk").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    back = range(CHUNKS_BACK, 0, -1)
    # Farthest first, one factor per chunk: no step leaves the range of a double before its end.
    faded = F.lit(0.0)
    for n in back:
        faded = (F.coalesce(f"_before_{n}", F.lit(0.0)) + faded) * decay(rate, F.lit(span))
    offset = F.pmod(F.col(clock), F.lit(span).cast("long"))
    return (
        df.withColumn("_offset", offset)
        .withColumn("_chunk", F.expr(f"(`{clock}` - _offset) div {span}L"))
        .withColumn("_raised", F.col(weight) * F.exp(F.lit(rate) * F.col("_offset")))
        .withColumn("_inside", F.sum("_raised").over(in_chunk))
        .withColumns(
            {f"_before_{n}": F.max("_inside").over(by_chunk.rangeBetween(-n, -n)) for n in back}
        )
        .withColumn(name, (F.col("_inside") + faded) * decay(rate, F.col("_offset")))
        .drop("_offset", "_chunk", "_raised", "_inside", *(f"_before_{n}" for n in back))
    )


def _with_clock(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``_clock``: forward steps of ``action_ts`` along ``order``, added up.

    In event order no step is backward and the action time serves as it is.
    """
    if order == EVENT_ORDER:
        return df.withColumn("_clock", F.col("action_ts"))
    w = Window.partitionBy(*keys).orderBy(*order)
    step = elapsed(F.col("action_ts"), F.lag("action_ts").over(w))
    return df.withColumn("_step", F.coalesce(step, F.lit(0).cast("long"))).withColumn(
        "_clock",
        F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    ).drop("_step")


def _score(
    df: DataFrame, keys: list[str], order: list[str], rate: float, placed: bool = False
) -> DataFrame:
    df = df.withColumn("_weight", action_weight(F.col("action_type")))
    if order == EVENT_ORDER and not placed:
        # In arrival order the clock's own window brings this exchange about.
        df = df.repartition(*keys)
    df = _with_clock(df, keys, order)
    return decayed_running_sum(df, keys, order, "_weight", "_clock", rate, "score")


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("last_action_ts", F.col("action_ts")).drop("_weight", "_clock")


def score_whole(
    df: DataFrame, order: list[str], rate: float, placed: bool = False,
    keys: tuple[str, ...] = ("creation_id",),
) -> DataFrame:
    """Scores of whole keys. ``placed``: rows are partitioned by ``creation_id`` already."""
    return _finish(_score(df, list(keys), order, rate, placed))


def score_segments(
    df: DataFrame, order: list[str], rate: float, whole: tuple[str, ...] = ("creation_id",)
) -> DataFrame:
    """Scores of segmented keys: each segment from zero, then the score it inherits.

    A segment is summed up by its first and last action time, the clock it ran and its own
    score at the end. These rows, one per segment, follow the same recurrence as single
    actions do, so their running score comes from the same expression.
    """
    keys = [*whole, "segment"]
    place = F.struct(*order)
    # Worked out twice, for the sums and for the rows: measured faster than writing it.
    local = _score(df, keys, order, rate)
    sums = local.groupBy(*keys).agg(
        F.min_by("action_ts", place).alias("first_ts"),
        F.max_by("action_ts", place).alias("last_ts"),
        F.min_by("_clock", place).alias("first_clock"),
        F.max_by("_clock", place).alias("last_clock"),
        F.max_by("score", place).alias("gain"),
    )
    w = Window.partitionBy(*whole).orderBy("segment")
    step = elapsed(F.col("first_ts"), F.lag("last_ts").over(w))
    sums = sums.withColumn("gap", F.coalesce(step, F.lit(0).cast("long"))).withColumn(
        "end_clock",
        F.sum(F.col("gap") + F.col("last_clock") - F.col("first_clock")).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    sums = decayed_running_sum(
        sums, list(whole), ["segment"], "gain", "end_clock", rate, "end_score"
    )
    inherited = sums.select(
        *keys, "gap", "first_clock",
        F.coalesce(F.lag("end_score").over(w), F.lit(0.0)).alias("inherited"),
    )
    since = F.col("gap") + F.col("_clock") - F.col("first_clock")
    return _finish(
        # The rows are laid out by both keys already: no exchange but that of ``inherited``.
        local.join(inherited, keys)
        .withColumn("score", F.col("score") + F.col("inherited") * decay(rate, since))
        .drop("gap", "first_clock", "inherited", "segment")
    )


def _order(order_by: str) -> list[str]:
    if order_by == "arrival":
        return ARRIVAL_ORDER
    if order_by == "action_ts":
        return EVENT_ORDER
    raise ValueError("order_by is 'arrival' or 'action_ts'")


def running_score(
    actions: DataFrame,
    half_life: timedelta | int,
    order_by: str = "arrival",
    segment_rows: int | None = SEGMENT_ROWS,
) -> DataFrame:
    """One scored row per enriched action: adds ``score`` and ``last_action_ts``.

    ``order_by="arrival"`` follows the order in which actions came; an action older than its
    predecessor decays nothing, and the time it steps back is decayed again by the next one.
    ``order_by="action_ts"`` is the textbook score. Actions of no weight count as actions; actions
    without creation id are no group and give no row.
    """
    rate = decay_rate(half_life)
    order = _order(order_by)
    actions = actions.filter(F.col("creation_id").isNotNull())
    split = split_hot_keys(actions, "creation_id", order, segment_rows)
    out = score_whole(split.rest, order, rate, split.placed)
    if split.hot is not None:
        out = out.unionByName(score_segments(split.hot, order, rate))
    return out


def score_timeline(
    creations: DataFrame,
    actions: DataFrame,
    half_life: timedelta | int,
    order_by: str = "arrival",
    segment_rows: int | None = SEGMENT_ROWS,
    state_ttl: timedelta | int | None = None,
) -> DataFrame:
    """As-of enrichment and score in one go.

    The same as ``running_score(enrich_as_of(...))``, with hot keys looked for once and a
    single exchange on ``creation_id`` for all other keys. Hot keys scored in event order are
    cut anew, since their segments follow arrival.

    With ``state_ttl`` a creation is forgotten, version and score, when nothing arrives for it for
    that long: its rows fall into islands between the gaps, and each island stands alone. Only in
    arrival order.
    """
    rate = decay_rate(half_life)
    order = _order(order_by)
    if state_ttl is not None and order != ARRIVAL_ORDER:
        raise ValueError("what expires by arrival is scored in order of arrival")
    # Without an id nothing can be enriched; such actions would make one partition of their own.
    rows = timeline(creations, actions.filter(F.col("creation_id").isNotNull()))
    split = split_hot_keys(rows, "creation_id", ARRIVAL_ORDER, segment_rows)
    rest, hot = split.rest, split.hot
    keys = ("creation_id",)
    if state_ttl is not None:
        keys = ("creation_id", "island")
        rest = islands_whole(rest, millis(state_ttl))
    out = score_whole(as_of_whole(rest, keys), order, rate, placed=True, keys=keys)
    if hot is not None:
        if state_ttl is not None:
            # Read several times.
            folder = fresh_folder(rows.sparkSession, "hot-islands")
            hot = as_table(islands_segments(hot, millis(state_ttl)), folder)
        hot = as_of_segments(hot, keys)
        if order == ARRIVAL_ORDER:
            hot = score_segments(hot, order, rate, keys)
        else:
            # Read several times when it is cut again.
            folder = fresh_folder(rows.sparkSession, "hot-enriched")
            hot = as_table(hot.drop("segment"), folder)
            hot = running_score(hot, half_life, order_by, segment_rows)
        out = out.unionByName(hot)
    return out.drop("island")
