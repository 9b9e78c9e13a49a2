"""Packed action batches to single actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotrank import schemas
from hotrank.functions import text
from hotrank.sources import decode


def split_batches(batches: DataFrame) -> DataFrame:
    """One annotated row per position of a batch, ``reason`` NULL for a complete action.

    Positions run to the longest list. A position beyond the timestamps is ``surplus``, one
    that some other list does not reach is ``missing_element``, one that does not parse is
    ``bad_number``. Batches without a user give nothing. Takes typed batches, or decoded ones
    with their annotations: what could not be decoded then passes through as one row, so a
    single pass tells sound from unsound. Narrow: no shuffle.
    """
    carried = [c for c in ("arrival_ts", "arrival_seq") if c in batches.columns]
    annotated = "reason" in batches.columns
    lists = ["action_type_list", "creation_id_list", "timestamp_list"]
    packed = F.concat_ws(" / ", *[F.coalesce(F.col(c), F.lit("null")) for c in lists])
    undecoded = F.col("reason") if annotated else F.lit(None).cast("string")
    batches = batches.filter(undecoded.isNotNull() | F.col("user_id").isNotNull())
    batches = batches.select(
        "user_id",
        *carried,
        undecoded.alias("undecoded"),
        F.when(undecoded.isNotNull(), F.col("raw") if annotated else packed)
        .otherwise(packed)
        .alias("raw"),
        *[
            text.split_list(F.col(c)).alias(name)
            for c, name in zip(lists, ("types", "ids", "times"))
        ],
    )
    zipped = F.arrays_zip("types", "ids", "times")
    # An undecoded message has one position, and nothing in it.
    items = F.when(F.col("undecoded").isNull(), zipped).otherwise(F.array(F.get(zipped, F.lit(-1))))
    places = batches.select(
        "user_id",
        *carried,
        "undecoded",
        "raw",
        F.size("types").alias("n_types"),
        F.size("ids").alias("n_ids"),
        F.size("times").alias("n_times"),
        F.posexplode(items).alias("pos", "item"),
    )
    number = {
        "action_type": text.strict_int(F.col("item.types")),
        "creation_id": text.strict_long(F.col("item.ids")),
        "action_ts": text.strict_long(F.col("item.times")),
    }
    reason = (
        F.when(F.col("undecoded").isNotNull(), F.col("undecoded"))
        .when(F.col("pos") >= F.col("n_times"), F.lit("surplus"))
        .when(
            (F.col("pos") >= F.col("n_types")) | (F.col("pos") >= F.col("n_ids")),
            F.lit("missing_element"),
        )
        .when(
            number["action_type"].isNull()
            | number["creation_id"].isNull()
            | number["action_ts"].isNull(),
            F.lit("bad_number"),
        )
    )
    return places.select(
        F.lit("action_batch").alias("source"),
        reason.alias("reason"),
        "raw",
        "user_id",
        *[value.alias(name) for name, value in number.items()],
        *carried,
        F.col("pos").cast("long").alias("pos"),
    )


def is_ragged(types: str, ids: str, times: str):
    """Whether the three lists of a batch differ in length."""
    n = [F.size(text.split_list(F.col(c))) for c in (types, ids, times)]
    return (n[0] != n[1]) | (n[0] != n[2])


def actions_of(split: DataFrame, on_malformed: str = "quarantine") -> DataFrame:
    """Complete actions. With ``on_malformed="fail"`` a missing element, or a message that
    could not be decoded, ends the query; a bad number or a surplus costs its own position
    only."""
    sound = F.col("reason").isNull()
    if on_malformed == "fail":
        fatal = F.col("reason").isin("missing_element", *decode.REASONS)
        message = F.concat_ws(" ", F.lit("action batch:"), F.col("reason"), F.col("raw"))
        sound = F.when(fatal, F.raise_error(message).cast("boolean")).otherwise(sound)
    return split.filter(sound).drop("source", "reason", "raw")


def quarantined(split: DataFrame) -> DataFrame:
    return split.filter(F.col("reason").isNotNull()).select(*schemas.QUARANTINE_COLUMNS)
