"""Registered queries: each runs operators of this package over whole warehouse tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank import tables
from hotrank.catalog import messages
from hotrank.functions.decay import action_weight
from hotrank.operators import actions as split
from hotrank.operators.creations import enrich_as_of, enrich_latest, latest_creations
from hotrank.operators.leaderboard import hot_top
from hotrank.operators.scoring import running_score
from hotrank.operators.windows import latest_per_window, windowed_scores
from hotrank.options import KafkaSourceOptions, RankingOptions
from hotrank.plans import ranking
from hotrank.session import fresh_folder
from hotrank.sources import decode, kafka
from hotrank.streaming.board import BoardTable
from hotrank.streaming.intake import Intake, decoded
from hotrank.streaming.pipeline import ranking_from_intake, ranking_stream, start
from hotrank.streaming.scores import score_stream, slice_of, windowed_stream

# Order lines lie days apart, events hours.
LINE_HALF_LIFE = timedelta(hours=1000)
EVENT_HALF_LIFE = timedelta(hours=6)
WEEK = timedelta(days=7)
QUARTER = timedelta(days=90)
DAY = timedelta(days=1)
STREAM_BOARD = 3
QUIET = timedelta(hours=12)
SLICES = 4
LATE_CUTS = ("2024-01-08", "2024-01-15", "2024-01-22")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


def _uncategorised_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts by type, but one brand has no category and another an empty one."""
    category = (
        F.when(F.col("p_brand") == "Brand#1", F.lit(None))
        .when(F.col("p_brand") == "Brand#2", F.lit(""))
        .otherwise(F.col("p_type"))
    )
    parts = tables.read(spark, sf, "part").withColumn("p_type", category)
    return tables.creations_of(parts, "p_type", tables.BEGINNING)


def _line_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that arrive one day into the order-key clock, big ones again on the fifth."""
    parts = tables.read(spark, sf, "part")
    first = tables.creations_of(parts, "p_type", "1998-01-02 00:00:00")
    big = parts.filter(tables.BIG)
    return first.unionByName(tables.creations_of(big, "p_brand", "1998-01-05 00:00:00"))


# --- decoding and splitting ---------------------------------------------------------------


def decode_creations(spark, sf):
    parts = tables.read(spark, sf, "part")
    made = parts.select(
        F.col("p_partkey").alias("creation_id"),
        F.col("p_size").alias("user_id"),
        F.col("p_type").alias("category"),
        F.lit(1).alias("status"),
        F.lit(tables.BEGINNING).cast("timestamp").alias("arrival_ts"),
        F.col("p_partkey").alias("arrival_seq"),
    )
    return decode.accepted(decode.decode_creations(messages.creation_messages(made)))


def decode_quarantine_counts(spark, sf):
    """Documents as messages: their text as it is, and three records made from each."""
    docs = tables.read(spark, sf, "documents")
    value = F.explode(
        F.array(
            F.col("text"),
            F.to_json(F.struct(F.col("doc_id").alias("creationId"), F.col("lang").alias("category"))),
            F.to_json(F.struct(F.col("source").alias("creationId"), F.col("lang").alias("category"))),
            F.to_json(F.struct(F.col("lang").alias("category"))),
        )
    )
    decoded = decode.decode_creations(docs.select(value.alias("value")))
    return (
        decoded.groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome"))
        .agg(F.count("*").alias("n"))
    )


def split_action_batches(spark, sf):
    raw = messages.action_messages(messages.packed_lists(tables.event_actions(spark, sf)))
    packed = decode.accepted(decode.decode_action_batches(raw))
    return split.actions_of(split.split_batches(packed)).select(
        "user_id", "action_type", "creation_id", "action_ts"
    )


def split_ragged_batches(spark, sf):
    """Batches that lose their last id, their last time, or have a first type that is no number."""
    lists = messages.packed_lists(tables.event_actions(spark, sf))
    rest = F.pmod("user_id", F.lit(7))

    def shortened(name, when):
        return F.when(rest == when, F.slice(name, 1, F.size(name) - 1)).otherwise(F.col(name))

    spoilt = F.concat(F.array(F.lit("x")), F.slice("types", 2, F.size("types")))
    lists = lists.withColumn("ids", shortened("ids", 0)).withColumn(
        "times", shortened("times", 1)
    ).withColumn("types", F.when(rest == 2, spoilt).otherwise(F.col("types")))
    packed = decode.accepted(decode.decode_action_batches(messages.action_messages(lists)))
    return split.split_batches(packed).select(
        "user_id", "pos", "action_type", "creation_id", "action_ts", "reason"
    )


def action_weights(spark, sf):
    return (
        tables.event_actions(spark, sf)
        .groupBy("action_type")
        .agg(
            F.count("*").alias("n"),
            F.sum(action_weight(F.col("action_type"))).alias("weight"),
        )
    )


# --- creations and enrichment -------------------------------------------------------------


def creation_latest(spark, sf):
    return latest_creations(tables.part_versions(spark, sf)).select(
        "creation_id", "category", "status"
    )


def enriched_as_of(spark, sf):
    return enrich_as_of(
        tables.part_versions(spark, sf), tables.event_actions(spark, sf)
    ).select("user_id", "action_type", "creation_id", "action_ts", "category")


def enriched_latest(spark, sf):
    return enrich_latest(
        tables.lineitem_actions(spark, sf), tables.part_versions(spark, sf)
    ).select("user_id", "action_type", "creation_id", "action_ts", "category")


# --- running score ------------------------------------------------------------------------

_SCORED = ["creation_id", "arrival_seq", "last_action_ts", "score"]


def running_score_event_order(spark, sf):
    actions = tables.lineitem_actions(spark, sf)
    return _rounded(running_score(actions, LINE_HALF_LIFE, "action_ts")).select(*_SCORED)


def running_score_arrival_order(spark, sf):
    actions = tables.lineitem_actions(spark, sf, "ordering")
    return _rounded(running_score(actions, LINE_HALF_LIFE, "arrival")).select(*_SCORED)


def running_score_long_gap(spark, sf):
    actions = tables.event_actions(spark, sf)
    return _rounded(running_score(actions, timedelta(minutes=10), "action_ts")).select(*_SCORED)


# --- windows ------------------------------------------------------------------------------


def _line_scores(spark, sf):
    actions = tables.lineitem_actions(spark, sf, "ordering")
    scored = running_score(actions, LINE_HALF_LIFE, "arrival")
    return scored.withColumn("category", F.lit(None).cast("string"))


def window_latest(spark, sf):
    return _rounded(latest_per_window(_line_scores(spark, sf), DAY)).drop("category")


def window_decayed_score(spark, sf):
    scores = windowed_scores(_line_scores(spark, sf), DAY, LINE_HALF_LIFE)
    return _rounded(scores).drop("category")


def window_scores_event_time(spark, sf):
    return _rounded(
        ranking.windowed_event_time(
            tables.part_creations(spark, sf),
            tables.event_actions(spark, sf),
            DAY,
            EVENT_HALF_LIFE,
            EVENT_HALF_LIFE,
        )
    )


# --- rankings -----------------------------------------------------------------------------


def hot_top100(spark, sf):
    rows = ranking.windowed(
        _uncategorised_parts(spark, sf),
        tables.lineitem_actions(spark, sf),
        WEEK,
        LINE_HALF_LIFE,
        LINE_HALF_LIFE,
        order_by="action_ts",
    )
    return hot_top(_rounded(rows))


def hot_ranking_flagship(spark, sf):
    rows = ranking.windowed_event_time(
        tables.part_creations(spark, sf),
        tables.lineitem_actions(spark, sf),
        WEEK,
        LINE_HALF_LIFE,
        LINE_HALF_LIFE,
    )
    return hot_top(_rounded(rows))


def hot_ranking_arrival_order(spark, sf):
    rows = ranking.windowed(
        _line_versions(spark, sf),
        tables.lineitem_actions(spark, sf, "ordering"),
        DAY,
        LINE_HALF_LIFE,
        LINE_HALF_LIFE,
    )
    return hot_top(_rounded(rows))


def hot_ranking_from_messages(spark, sf):
    """From raw JSON messages to the ranking, through the tables the job writes in between."""
    source = {"bootstrap_servers": "unused:9092", "group_id": "unused"}
    options = RankingOptions(
        KafkaSourceOptions(topics=["creations"], start_from_earliest=True, **source),
        KafkaSourceOptions(topics=["actions"], start_from_earliest=True, **source),
        window_size=DAY,
        score_half_life=EVENT_HALF_LIFE,
        window_half_life=EVENT_HALF_LIFE,
    )
    board = ranking.bounded_ranking(
        spark,
        options,
        fresh_folder(spark, "messages"),
        messages.creation_messages(tables.part_versions(spark, sf)),
        messages.action_messages(messages.packed_lists(tables.event_actions(spark, sf))),
    )
    return _rounded(board).drop("rank")


def leaderboard_replay(spark, sf):
    rows = ranking.windowed_event_time(
        tables.part_creations(spark, sf),
        tables.lineitem_actions(spark, sf),
        QUARTER,
        LINE_HALF_LIFE,
        LINE_HALF_LIFE,
    )
    return ranking.replay_board(_rounded(rows))


def windowed_with_expiry(spark, sf):
    """Creations are forgotten after some quiet hours; the second version brings big ones back."""
    return _rounded(
        ranking.windowed(
            tables.part_versions(spark, sf),
            tables.event_actions(spark, sf),
            DAY,
            EVENT_HALF_LIFE,
            EVENT_HALF_LIFE,
            state_ttl=QUIET,
        )
    )


# --- streams ------------------------------------------------------------------------------


def _table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = tables.read(spark, sf, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf)


def _event_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    parts = _table_stream(spark, sf, "part")
    first = tables.creations_of(parts, "p_type", "2024-01-03 00:00:00")
    big = parts.filter(tables.BIG)
    again = tables.creations_of(big, "p_brand", "2024-01-15 00:00:00")
    # Arrivals far ahead, so the last windows close.
    far = F.lit("2100-01-01 00:00:00").cast("timestamp")
    scored = score_stream(
        first.unionByName(again),
        tables.events_to_actions(_table_stream(spark, sf, "events")),
        EVENT_HALF_LIFE,
        ticks=_table_stream(spark, sf, "region").select(far.alias("arrival_ts")),
    )
    return windowed_stream(scored, DAY, EVENT_HALF_LIFE)


class _Slices:
    """Tables laid out by their ``part`` in one pass, and handed to streams part by part.

    A part may have any number of files, so all tasks write it and read it; a run of the query up
    to what is there then takes it as one micro-batch.
    """

    def __init__(self, spark: SparkSession, folder: str, rows: dict[str, DataFrame]):
        self.spark, self.folder, self.schemas = spark, folder, {}
        make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.path = lambda name: make(f"{folder}/{name}")
        self.fs = make(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for name, df in rows.items():
            self.schemas[name] = df.drop("part").schema
            df.write.partitionBy("part").parquet(f"{folder}/laid/{name}")
            self.fs.mkdirs(self.path(f"in/{name}"))

    def stream(self, name: str) -> DataFrame:
        reader = self.spark.readStream.schema(self.schemas[name])
        return reader.option("recursiveFileLookup", "true").parquet(f"{self.folder}/in/{name}")

    def hand_over(self, part: int) -> None:
        for name in self.schemas:
            laid = self.path(f"laid/{name}/part={part}")
            if self.fs.exists(laid) and not self.fs.rename(laid, self.path(f"in/{name}/{part}")):
                raise OSError(f"could not hand over part {part} of {name}")


def _collected(spark, windows: DataFrame, slices: _Slices | None = None) -> DataFrame:
    """All rows of a stream; of ``slices`` one more part, with the closing tick, than ``SLICES``."""
    folder = fresh_folder(spark, "stream")
    for part in range(SLICES + 1 if slices else 1):
        if slices:
            slices.hand_over(part)
        query = (
            windows.writeStream.format("parquet")
            .option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _closing_tick(spark: SparkSession) -> DataFrame:
    far = F.lit("2100-01-01 00:00:00").cast("timestamp")
    return spark.range(1).select(far.alias("arrival_ts"), F.lit(SLICES).alias("part"))


def stream_equals_batch(spark, sf):
    return _rounded(_collected(spark, _event_windows_stream(spark, sf)))


def stream_micro_batches(spark, sf):
    """Both tables in ``SLICES`` parts by arrival, one part of each in every micro-batch.

    State is carried from one to the next, hot creations are combined in slices of the day, and
    creations expire.
    """
    actions, made = tables.event_actions(spark, sf), tables.part_versions(spark, sf)
    first, last = actions.agg(F.min("arrival_ts"), F.max("arrival_ts")).first()
    step = (last - first) / SLICES
    part = sum((F.col("arrival_ts") >= F.lit(first + step * i)).cast("int") for i in range(1, SLICES))
    slices = _Slices(spark, fresh_folder(spark, "sliced"), {
        "actions": actions.withColumn("part", part),
        "made": made.withColumn("part", part),
        # One more micro-batch closes the last windows.
        "ticks": _closing_tick(spark),
    })
    scored = score_stream(
        slices.stream("made"), slices.stream("actions"), EVENT_HALF_LIFE, state_ttl=QUIET,
        ticks=slices.stream("ticks"), slice_size=slice_of(DAY),
    )
    return _rounded(_collected(spark, windowed_stream(scored, DAY, EVENT_HALF_LIFE), slices))


def stream_board(spark, sf):
    folder = fresh_folder(spark, "stream")
    source = {"bootstrap_servers": "unused:9092", "group_id": "unused", "topics": ["unused"]}
    options = RankingOptions(
        KafkaSourceOptions(**source), KafkaSourceOptions(**source), board_size=STREAM_BOARD
    )
    board = BoardTable(f"{folder}/board", STREAM_BOARD)
    query = start(
        _rounded(_event_windows_stream(spark, sf)), board, f"{folder}/checkpoint", options,
        once=True,
    )
    query.awaitTermination()
    return board.read(spark)


def job_from_messages(spark, sf):
    """The whole streaming job: raw JSON messages in, the board out, its last windows included."""
    folder = fresh_folder(spark, "job")
    topics = {
        "creations": messages.creation_messages(tables.part_versions(spark, sf)),
        "actions": messages.action_messages(messages.packed_lists(tables.event_actions(spark, sf))),
    }
    source = {"bootstrap_servers": "unused:9092", "group_id": "unused"}
    options = RankingOptions(
        *[KafkaSourceOptions(topics=[topic], **source) for topic in topics],
        window_size=DAY, score_half_life=EVENT_HALF_LIFE, window_half_life=EVENT_HALF_LIFE,
        board_size=STREAM_BOARD,
    )
    raw = []
    for topic, rows in topics.items():
        rows.write.parquet(f"{folder}/{topic}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/{topic}")
        raw.append(kafka.with_arrival(stream, [topic], "kafka"))
    far = F.lit("2100-01-01 00:00:00").cast("timestamp")
    windows = ranking_stream(
        *raw, options, slice_size=slice_of(DAY),
        ticks=_table_stream(spark, sf, "region").select(far.alias("arrival_ts")),
    )
    board = BoardTable(f"{folder}/board", STREAM_BOARD)
    start(_rounded(windows), board, f"{folder}/checkpoint", options, once=True).awaitTermination()
    return board.read(spark)


def _late_intake(spark, sf):
    """Messages in ``SLICES`` parts by arrival, those of every seventh user one part too late.

    One part of each topic is a micro-batch, and no delay is allowed for: late is what arrives no
    later than something in an earlier part. One user's messages in five are not JSON.
    """
    folder = fresh_folder(spark, "late")
    made = messages.creation_messages(tables.part_versions(spark, sf))
    done = messages.action_messages(messages.packed_lists(tables.event_actions(spark, sf)))
    part = sum((F.col("timestamp") >= F.lit(x).cast("timestamp")).cast("int") for x in LATE_CUTS)
    names = F.regexp_replace(F.col("value").cast("string"), "(?i)user[-_]?id", "user")
    user = F.get_json_object(names, "$.user").cast("long")
    behind = (F.pmod(user, F.lit(7)) == 0).cast("int")
    spoilt = F.pmod(user, F.lit(5)) == 3
    value = F.when(spoilt, F.substring("value", 2, 1 << 30)).otherwise(F.col("value"))
    slices = _Slices(spark, folder, {
        "creations": made.withColumn("part", part),
        "actions": done.withColumn("part", F.least(part + behind, F.lit(SLICES - 1)))
        .withColumn("value", value),
        "ticks": _closing_tick(spark),
    })
    raw = [
        kafka.with_arrival(slices.stream(topic), [topic], "kafka") for topic in ("creations", "actions")
    ]
    intake = Intake(f"{folder}/intake", EVENT_HALF_LIFE, slice_size=slice_of(DAY))
    rows = decoded(*raw, ticks=slices.stream("ticks"))
    for i in range(SLICES + 1):
        slices.hand_over(i)
        intake.start(rows, f"{folder}/intake-checkpoint").awaitTermination()
    return intake


def intake_quarantine(spark, sf):
    """Rows the intake leaves out: unsound messages, and actions that come too late."""
    left_out = _late_intake(spark, sf).quarantine(spark)
    return left_out.groupBy("source", "reason").agg(F.count("*").alias("n"))


def intake_windows(spark, sf):
    """Scores of what the intake publishes: late actions neither count nor are dropped here."""
    options = RankingOptions(
        *[KafkaSourceOptions("unused:9092", ["unused"], "unused")] * 2, window_size=DAY,
        score_half_life=EVENT_HALF_LIFE, window_half_life=EVENT_HALF_LIFE,
    )
    return _rounded(
        _collected(spark, ranking_from_intake(_late_intake(spark, sf), spark, options)))


QUERIES = {
    "decode_creations": decode_creations,
    "decode_quarantine_counts": decode_quarantine_counts,
    "split_action_batches": split_action_batches,
    "split_ragged_batches": split_ragged_batches,
    "action_weights": action_weights,
    "creation_latest": creation_latest,
    "enrich_as_of": enriched_as_of,
    "enrich_latest": enriched_latest,
    "running_score_event_order": running_score_event_order,
    "running_score_arrival_order": running_score_arrival_order,
    "running_score_long_gap": running_score_long_gap,
    "window_latest": window_latest,
    "window_decayed_score": window_decayed_score,
    "window_scores_event_time": window_scores_event_time,
    "hot_top100": hot_top100,
    "hot_ranking_flagship": hot_ranking_flagship,
    "hot_ranking_arrival_order": hot_ranking_arrival_order,
    "hot_ranking_from_messages": hot_ranking_from_messages,
    "leaderboard_replay": leaderboard_replay,
    "windowed_with_expiry": windowed_with_expiry,
    "stream_equals_batch": stream_equals_batch,
    "stream_micro_batches": stream_micro_batches,
    "stream_board": stream_board,
    "job_from_messages": job_from_messages,
    "intake_quarantine": intake_quarantine,
    "intake_windows": intake_windows,
}
