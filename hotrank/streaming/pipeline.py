"""The streaming job: two inputs to a maintained board."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hotrank.functions.decay import millis
from hotrank.operators import actions as split
from hotrank.options import RankingOptions
from hotrank.sources import decode, kafka
from hotrank.streaming.board import BoardTable, mirror_board
from hotrank.streaming.intake import Intake, decoded
from hotrank.streaming.scores import LateRows, score_rows, score_stream, slice_of, windowed_stream


def decoded_inputs(
    creations_raw: DataFrame, actions_raw: DataFrame, on_malformed: str = "quarantine"
) -> tuple[DataFrame, DataFrame]:
    """Creations and single actions of raw rows that carry their arrival columns."""
    made = decode.accepted(decode.decode_creations(creations_raw), on_malformed)
    places = split.split_batches(decode.decode_action_batches(actions_raw))
    return made, split.actions_of(places, on_malformed)


def quarantine(creations_raw: DataFrame, actions_raw: DataFrame) -> DataFrame:
    """Whatever ``decoded_inputs`` leaves out, for a query of its own."""
    places = split.split_batches(decode.decode_action_batches(actions_raw))
    made = decode.decode_creations(creations_raw)
    return decode.quarantined(made).unionByName(split.quarantined(places))


def ranking_stream(
    creations_raw: DataFrame,
    actions_raw: DataFrame,
    options: RankingOptions,
    delay: str = "0 seconds",
    combine: bool = False,
    ticks: DataFrame | None = None,
    state_ttl: timedelta | int | None = None,
    slice_size: timedelta | int | None = None,
) -> DataFrame:
    """Windowed decayed scores of two raw streams."""
    made, done = decoded_inputs(creations_raw, actions_raw, options.on_malformed)
    scored = score_stream(
        made, done, options.score_half_life, delay, combine, state_ttl, ticks, slice_size
    )
    return windowed_stream(scored, options.window_size, options.window_half_life)


def ranking_from_intake(
    intake: Intake,
    spark: SparkSession,
    options: RankingOptions,
    state_ttl: timedelta | int | None = None,
) -> DataFrame:
    """Windowed decayed scores of what an intake publishes."""
    scored = score_rows(intake.rows(spark), options.score_half_life, intake.delay, state_ttl)
    return windowed_stream(scored, options.window_size, options.window_half_life)


def start(
    windows: DataFrame,
    board: BoardTable,
    checkpoint: str,
    options: RankingOptions,
    connect: Callable | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Runs windowed scores into the board and, given ``connect``, into outside sorted sets.

    The sets follow the board, so they too come out the same when a micro-batch is run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Used several times; without this each use would run the whole micro-batch again.
        batch = batch.persist()
        try:
            board.write_batch(batch, batch_id)
            if connect is not None:
                mirror_board(board.read(batch.sparkSession), batch, options.sink_uri, connect)
        finally:
            batch.unpersist()

    writer = windows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    interval = f"{millis(options.trigger_interval)} milliseconds"
    return writer.trigger(processingTime=interval).start()


@dataclass
class RankingJob:
    """The running job: the query that keeps the board, and the one that keeps bad input.

    With an intake that one also decodes for the other.
    """

    spark: SparkSession
    ranking: StreamingQuery | None
    quarantine: StreamingQuery | None
    late: LateRows

    def _queries(self) -> list[StreamingQuery]:
        return [query for query in (self.ranking, self.quarantine) if query is not None]

    def awaitTermination(self) -> None:
        for query in self._queries():
            query.awaitTermination()

    def exception(self):
        return next(filter(None, (query.exception() for query in self._queries())), None)

    def stop(self) -> None:
        """Ends both queries, also when one of them failed."""
        for query in self._queries():
            query.stop()
        self.spark.streams.removeListener(self.late)

    def dropped_rows(self) -> int:
        """Rows dropped as late since the job was started in this process."""
        return self.late.of(self.ranking)


def build_pipeline(
    spark: SparkSession,
    options: RankingOptions,
    board_path: str,
    checkpoint: str,
    clock: str = "processing",
    delay: str | None = None,
    connect: Callable | None = None,
    state_ttl: timedelta | int | None = None,
    quarantine_path: str | None = None,
    intake_path: str | None = None,
) -> RankingJob:
    """Starts the job on Kafka.

    Under the wall clock (``clock="processing"``) nothing is late, and ticks close windows on
    quiet topics. ``clock="kafka"`` takes broker time, which repeats on a re-read, and needs a
    ``delay``: rows that come later than it allows are dropped before they are scored, and
    ``dropped_rows`` of the job counts them. Hot creations shrink before the shuffle.

    Unsound input is written to ``quarantine_path`` (by default the board's path and
    ``-quarantine``) by a query of its own, whose checkpoint lies beside the job's, unless
    ``on_malformed="fail"`` lets it end the job.

    With ``intake_path`` an intake (``streaming.intake``) reads and decodes each topic once and
    publishes micro-batches below that path, which the ranking then reads; late rows are kept in
    its quarantine beside the unsound ones instead of being dropped, and ``quarantine_path`` goes
    unused. The price is one more write and read of the decoded rows, hot creations shrunk.

    Both sources bounded: the call reads up to the latest offsets, closes every window, and
    returns when all is written. Its checkpoint is then finished and refused by later runs, whose
    rows would all be late; a run that was cut short may be started again.
    """
    if delay is None:
        if clock != "processing":
            raise ValueError("a clock taken from data needs a delay")
        delay = "0 seconds"
    creation, action = options.creation_source, options.action_source
    if creation.bounded != action.bounded:
        raise ValueError("both sources are bounded or neither is")
    bounded = creation.bounded
    closing = ClosingTick(spark, checkpoint) if bounded else None
    if bounded and closing.finished():
        raise ValueError("this bounded job is finished; start another with a new checkpoint")
    raw = [
        kafka.with_arrival(kafka.read_stream(spark, source), list(source.topics), clock)
        for source in (creation, action)
    ]
    if bounded:
        ticks = closing.stream()
    else:
        ticks = heartbeat(spark) if clock == "processing" else None
    late = LateRows()
    spark.streams.addListener(late)
    # Under the wall clock a micro-batch has one time, and tasks combine it; else slices do.
    slice_size = None if clock == "processing" else slice_of(options.window_size)
    if intake_path is not None:
        if state_ttl is not None and slice_size is not None and millis(state_ttl) < slice_size:
            raise ValueError("a slice is not longer than the time creations are remembered")
        intake = Intake(intake_path, options.score_half_life, delay, True, slice_size)
        rows = decoded(*raw, options.on_malformed, ticks)
        windows = ranking_from_intake(intake, spark, options, state_ttl)
    else:
        windows = ranking_stream(
            *raw, options, delay, combine=True, ticks=ticks, state_ttl=state_ttl,
            slice_size=slice_size,
        )

    def start_beside() -> StreamingQuery | None:
        if intake_path is not None:
            interval = None if bounded else options.trigger_interval
            return intake.start(rows, f"{checkpoint}-intake", interval)
        if options.on_malformed != "quarantine":
            return None
        return start_quarantine(
            quarantine(*raw), quarantine_path or f"{board_path}-quarantine",
            f"{checkpoint}-quarantine", options, once=bounded,
        )

    board = BoardTable(board_path, options.board_size)
    job = RankingJob(spark, None, start_beside(), late)
    if bounded and intake_path is not None:
        # The ranking then finds all that was published.
        job.quarantine.awaitTermination()
    job.ranking = start(windows, board, checkpoint, options, connect, bounded)
    if bounded:
        job.awaitTermination()
        # All rows are in: a tick beyond every window lets the rest out.
        closing.write()
        if intake_path is not None:
            job.quarantine = start_beside()
            job.quarantine.awaitTermination()
        job.ranking = start(windows, board, checkpoint, options, connect, bounded)
        job.awaitTermination()
        closing.finish()
        spark.streams.removeListener(late)
    return job


def start_quarantine(
    rows: DataFrame, path: str, checkpoint: str, options: RankingOptions, once: bool = False
) -> StreamingQuery:
    """Writes unsound rows to Parquet files, each exactly once."""
    writer = rows.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    if once:
        return writer.trigger(availableNow=True).start()
    interval = f"{millis(options.trigger_interval)} milliseconds"
    return writer.trigger(processingTime=interval).start()


class ClosingTick:
    """The tick that ends a bounded job, in a folder beside its checkpoint."""

    _SCHEMA = "arrival_ts timestamp"
    _END = "timestamp '2200-01-01 00:00:00'"

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark = spark
        self.folder = f"{checkpoint.rstrip('/')}-closing"

    def _rows(self) -> DataFrame:
        return self.spark.range(1, numPartitions=1).select(F.expr(self._END).alias("arrival_ts"))

    def stream(self) -> DataFrame:
        self._rows().limit(0).write.mode("append").parquet(f"{self.folder}/ticks")
        return self.spark.readStream.schema(self._SCHEMA).parquet(f"{self.folder}/ticks")

    def write(self) -> None:
        self._rows().write.mode("append").parquet(f"{self.folder}/ticks")

    def finish(self) -> None:
        self._rows().write.mode("overwrite").parquet(f"{self.folder}/finished")

    def finished(self) -> bool:
        spark, name = self.spark, f"{self.folder}/finished/_SUCCESS"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def heartbeat(spark: SparkSession) -> DataFrame:
    """One tick a second on the wall clock."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.select(F.current_timestamp().alias("arrival_ts"))

