"""Kafka input: raw rows of ``schemas.RAW``, streaming or batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.options import KafkaSourceOptions


def reader_options(options: KafkaSourceOptions, batch: bool = False) -> dict[str, str]:
    """Options for ``format("kafka")``.

    A batch read always has to name where it begins and ends: it runs from the earliest
    offset to the latest one at start.
    """
    settings = {
        **options.client_settings(),
        "subscribe": ",".join(options.topics),
        "startingOffsets": "earliest" if batch else options.starting_offsets,
        **options.reader_options,
    }
    if batch:
        settings["endingOffsets"] = "latest"
    return settings


def read_stream(spark: SparkSession, options: KafkaSourceOptions) -> DataFrame:
    """Unbounded read; a query with the trigger ``availableNow`` makes it a bounded one."""
    return spark.readStream.format("kafka").options(**reader_options(options)).load()


def read_batch(spark: SparkSession, options: KafkaSourceOptions) -> DataFrame:
    """Bounded read of a topic up to its latest offset."""
    if not options.start_from_earliest:
        raise ValueError("a batch read cannot start at 'latest'; set start_from_earliest")
    return spark.read.format("kafka").options(**reader_options(options, batch=True)).load()


def sequence_number(topics: list[str]):
    """``arrival_seq`` of a Kafka row: topic, then partition, then offset, in one bigint.

    Holds 32 topics, 16384 partitions and 2^44 offsets per partition; a row beyond ends the query,
    since its place among the others would be wrong.
    """
    if len(topics) > 32:
        raise ValueError("at most 32 topics per source")
    names = F.array(*[F.lit(t) for t in topics])
    topic = F.array_position(names, F.col("topic")) - 1
    packed = (
        F.shiftleft(topic.cast("long"), 58)
        .bitwiseOR(F.shiftleft(F.col("partition").cast("long"), 44))
        .bitwiseOR(F.col("offset"))
    )
    fits = (
        (topic >= 0) & F.col("partition").between(0, (1 << 14) - 1)
        & F.col("offset").between(0, (1 << 44) - 1)
    )
    place = F.concat_ws(" ", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    beyond = F.raise_error(F.concat(F.lit("no place in the order of arrival: "), place))
    return F.when(fits, packed).otherwise(beyond.cast("long"))


def with_arrival(raw: DataFrame, topics: list[str], clock: str = "processing") -> DataFrame:
    """Adds ``arrival_ts`` and ``arrival_seq`` to Kafka rows.

    ``clock="processing"`` is the wall clock: nothing can be late. ``clock="kafka"`` takes
    the broker's timestamp, which repeats on a re-read but needs a delay allowance.
    """
    if clock not in ("processing", "kafka"):
        raise ValueError("clock is 'processing' or 'kafka'")
    now = F.current_timestamp() if clock == "processing" else F.col("timestamp")
    return raw.withColumn("arrival_ts", now).withColumn("arrival_seq", sequence_number(topics))
