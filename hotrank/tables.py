"""Actions and creations taken from the warehouse tables the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Action type of each event type.
EVENT_TYPES = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}

# Everything is known from here on, unless a table says when it arrived.
BEGINNING = "1970-01-01 00:00:00"


# Parts that get a second version.
BIG = "p_size > 25"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Table timestamps carry no zone; they mean UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events_to_actions(events: DataFrame) -> DataFrame:
    """One action per event, arriving when it happened."""
    kind = F.lit(None).cast("int")
    for name, code in EVENT_TYPES.items():
        kind = F.when(F.col("event_type") == name, code).otherwise(kind)
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "user_id",
        kind.alias("action_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("creation_id"),
        F.unix_millis(ts).alias("action_ts"),
        ts.alias("arrival_ts"),
        F.col("event_id").alias("arrival_seq"),
        F.lit(0).cast("long").alias("pos"),
    )


def event_actions(spark: SparkSession, folder: str) -> DataFrame:
    return events_to_actions(read(spark, folder, "events"))


def lineitem_actions(spark: SparkSession, folder: str, arrival: str = "shipping") -> DataFrame:
    """One action per order line.

    Keys and line numbers repeat in these tables; ``pos`` tells such lines apart by ship date.
    ``arrival="shipping"``: the line arrives on its ship date, which is also its action time.
    ``arrival="ordering"``: lines arrive in order of their keys, one order a minute, so action
    times come out of order.
    """
    ship = F.col("l_shipdate").cast("timestamp")
    by_key = F.timestamp_millis(F.lit(883_612_800_000) + F.col("l_orderkey") * 60_000)
    return read(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_linenumber").cast("int").alias("action_type"),
        F.col("l_partkey").alias("creation_id"),
        F.unix_millis(ship).alias("action_ts"),
        (ship if arrival == "shipping" else by_key).alias("arrival_ts"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("arrival_seq"),
        F.unix_millis(ship).alias("pos"),
    )


def creations_of(parts: DataFrame, category: str, arrival_ts: str) -> DataFrame:
    return parts.select(
        F.col("p_partkey").alias("creation_id"),
        F.lit(None).cast("long").alias("user_id"),
        F.col(category).alias("category"),
        F.lit(1).alias("status"),
        F.lit(arrival_ts).cast("timestamp").alias("arrival_ts"),
        F.col("p_partkey").alias("arrival_seq"),
    )


def part_creations(spark: SparkSession, folder: str) -> DataFrame:
    """One creation per part, known from the beginning."""
    return creations_of(read(spark, folder, "part"), "p_type", BEGINNING)


def part_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions: every part on 2024-01-03, big ones again on 2024-01-15 by brand."""
    parts = read(spark, folder, "part")
    first = creations_of(parts, "p_type", "2024-01-03 00:00:00")
    again = creations_of(parts.filter(BIG), "p_brand", "2024-01-15 00:00:00")
    return first.unionByName(again)
