"""Intake: one query that reads and decodes both topics once, and keeps all it leaves out.

Every micro-batch becomes a folder of rows ready to be scored, and a folder of quarantined rows:
unsound ones, and those that came too late. Scoring streams the first, so nothing is decoded
twice, and drops nothing, since what its watermark would drop was set aside before.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hotrank.functions.decay import millis
from hotrank.operators import actions as split
from hotrank.schemas import ARRIVED_ACTION, ARRIVED_CREATION, QUARANTINE, QUARANTINE_COLUMNS
from hotrank.session import adaptive, send_by_value
from hotrank.sources import decode
from hotrank.streaming.scores import combined, silent, stream_timeline

LATE = "late"
_TICK = "tick"


def decoded(
    creations_raw: DataFrame,
    actions_raw: DataFrame,
    on_malformed: str = "quarantine",
    ticks: DataFrame | None = None,
) -> DataFrame:
    """Creations, single actions and ticks in one frame, each with its reason if it is unsound.

    With ``on_malformed="fail"`` whatever would lose data ends the query.
    """
    made = decode.decode_creations(creations_raw)
    places = split.split_batches(decode.decode_action_batches(actions_raw))
    if on_malformed == "fail":
        none = F.lit(None).cast("string").alias("reason")
        made = decode.accepted(made, "fail").select(F.lit("creation").alias("source"), none, "*")
        places = split.actions_of(places, "fail").select(
            F.lit("action_batch").alias("source"), none, "*")
    rows = made.unionByName(places, allowMissingColumns=True)
    if ticks is not None:
        tick = ticks.select(F.lit(_TICK).alias("source"), "arrival_ts")
        rows = rows.unionByName(tick, allowMissingColumns=True)
    if "raw" not in rows.columns:
        rows = rows.withColumn("raw", F.lit(None).cast("string"))
    return rows


class Intake:
    """Decoded micro-batches below ``path``, each published whole.

    A row is late when it arrives no later than the watermark: the newest arrival of all earlier
    micro-batches less ``delay``, in milliseconds, the epoch at first. That is the rule by which
    Spark drops rows from state. The newest arrival lies beside each batch, so a batch that runs
    again judges its rows alike. Late rows are kept with the reason ``late``, a late action once
    for each place of its message; late ticks are nothing.

    A batch is written to a hidden folder and renamed once it is whole; a batch already published
    is not written again. The shared file system must rename folders in one step.
    """

    def __init__(
        self, path: str, score_half_life: timedelta | int, delay: str = "0 seconds",
        combine: bool = False, slice_size: timedelta | int | None = None,
    ):
        self.path = path.rstrip("/")
        self.half_life = score_half_life
        self.delay = delay
        self.combine = combine
        self.slice_size = slice_size

    def _files(self, spark: SparkSession):
        sc = spark.sparkContext
        make = sc._jvm.org.apache.hadoop.fs.Path
        return make(self.path).getFileSystem(sc._jsc.hadoopConfiguration()), make

    def _newest_before(self, spark: SparkSession, batch_id: int) -> int | None:
        fs, make = self._files(spark)
        folder = make(f"{self.path}/newest")
        names = [e.getPath().getName() for e in fs.listStatus(folder)] if fs.exists(folder) else []
        ids = [int(n.split("=")[1]) for n in names if n.startswith("batch_id=")]
        last = max((i for i in ids if i < batch_id), default=None)
        if last is None:
            return None
        return spark.read.schema("us bigint").parquet(f"{folder}/batch_id={last}").first().us

    def _watermark_us(self, spark: SparkSession, newest_us: int | None) -> int:
        if newest_us is None:
            return 0
        span = F.expr(f"unix_millis(timestamp_millis(0) + INTERVAL '{self.delay}')")
        delay_ms = spark.range(1).select(span).first()[0]
        return max(0, newest_us // 1000 - delay_ms) * 1000

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            self._write_batch(batch, batch_id)

    def _write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, make = self._files(spark)
        published = make(f"{self.path}/rows/{batch_id}")
        if fs.exists(published):
            return
        newest = self._newest_before(spark, batch_id)
        late = F.unix_micros("arrival_ts") <= F.lit(self._watermark_us(spark, newest))
        reason = F.coalesce("reason", F.when(late, F.lit(LATE)))
        # Sound rows go without their text. Used three times, decoded once.
        batch = batch.withColumn("reason", reason).withColumn(
            "raw", F.when(F.col("reason").isNotNull(), F.coalesce("raw", F.lit("")))
        ).persist()
        try:
            bad = batch.filter(F.col("reason").isNotNull() & (F.col("source") != _TICK))
            bad.select(*QUARANTINE_COLUMNS).write.mode("overwrite").parquet(
                f"{self.path}/quarantine/batch_id={batch_id}")
            sound = batch.filter(F.col("reason").isNull())
            seen = sound.agg(F.max(F.unix_micros("arrival_ts"))).first()[0]
            newest = max((us for us in (newest, seen) if us is not None), default=None)
            spark.createDataFrame([(newest,)], "us bigint").coalesce(1).write.mode(
                "overwrite").parquet(f"{self.path}/newest/batch_id={batch_id}")
            hidden = f"{self.path}/rows/_{batch_id}"
            self._timeline(sound).write.mode("overwrite").parquet(hidden)
            if not fs.rename(make(hidden), published):
                raise OSError(f"could not publish micro-batch {batch_id} of {self.path}")
        finally:
            batch.unpersist()

    def _timeline(self, sound: DataFrame) -> DataFrame:
        made = sound.filter("source = 'creation'").select(*ARRIVED_CREATION.names)
        done = sound.filter("source = 'action_batch'").select(*ARRIVED_ACTION.names)
        rows = stream_timeline(made, done)
        send_by_value()
        rows = combined(rows, self.half_life, self.combine, self.slice_size)
        return rows.unionByName(silent(sound.filter(F.col("source") == _TICK)))

    def start(
        self, rows: DataFrame, checkpoint: str, interval: timedelta | int | None = None
    ) -> StreamingQuery:
        """Takes in ``decoded`` streams; without ``interval`` what is there, and then ends."""
        writer = rows.writeStream.foreachBatch(self.write_batch).option(
            "checkpointLocation", checkpoint)
        if interval is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{millis(interval)} milliseconds").start()

    def rows(self, spark: SparkSession) -> DataFrame:
        """Stream of what was published, for ``score_rows`` with the same delay and half-life."""
        fs, make = self._files(spark)
        fs.mkdirs(make(f"{self.path}/rows"))
        schema = stream_timeline(
            spark.createDataFrame([], ARRIVED_CREATION), spark.createDataFrame([], ARRIVED_ACTION)
        ).schema
        reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.path}/rows")

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """All rows left out so far: source, reason and raw text."""
        fs, make = self._files(spark)
        if not fs.exists(make(f"{self.path}/quarantine")):
            return spark.createDataFrame([], QUARANTINE)
        return spark.read.schema(QUARANTINE).parquet(f"{self.path}/quarantine").select(
            *QUARANTINE_COLUMNS)
