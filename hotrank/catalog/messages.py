"""The warehouse tables turned into raw messages, so decoding and splitting have input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hotrank.functions import text

# A batch holds actions of one user whose numbers fall into the same block of this size.
BLOCK = 256

# Three ways of writing the same keys; all must read alike.
_SPELLINGS = {
    "creation": [
        ["creationId", "userId", "category", "status"],
        ["creation_id", "user_id", "category", "status"],
        ["CREATION-ID", "UserID", "Category", "STATUS"],
    ],
    "action_batch": [
        ["actionTypeList", "creationIdList", "timestampList", "userId"],
        ["action_type_list", "creation_id_list", "timestamp_list", "user_id"],
        ["ActionTypeList", "CREATION-ID-LIST", "timestampList", "UserID"],
    ],
}


def _json(record: str, values: list[Column], pick: Column) -> Column:
    def written(names):
        return F.to_json(F.struct(*[v.alias(n) for n, v in zip(names, values)]))

    first, second, third = _SPELLINGS[record]
    return F.when(pick == 0, written(first)).when(pick == 1, written(second)).otherwise(
        written(third)
    )


def creation_messages(creations: DataFrame) -> DataFrame:
    """Raw rows, one per creation. Every other id is written as text."""
    fields = [F.col("creation_id"), F.col("user_id"), F.col("category"), F.col("status")]
    as_text = [F.col("creation_id").cast("string"), *fields[1:]]
    pick = F.pmod("creation_id", F.lit(3))
    value = F.when(
        F.pmod("creation_id", F.lit(2)) == 0, _json("creation", fields, pick)
    ).otherwise(_json("creation", as_text, pick))
    return creations.select(
        text.once(value.cast("binary")).alias("value"),
        F.lit("creations").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("arrival_seq").alias("offset"),
        F.col("arrival_ts").alias("timestamp"),
    )


def packed_lists(actions: DataFrame) -> DataFrame:
    """Three arrays of texts per user and block, in order. No group exceeds ``BLOCK`` rows."""
    item = F.struct("arrival_seq", "action_type", "creation_id", "action_ts")
    packed = (
        actions.withColumn("block", F.expr(f"arrival_seq div {BLOCK}"))
        .groupBy("user_id", "block")
        .agg(
            F.sort_array(F.collect_list(item)).alias("items"),
            F.max("arrival_ts").alias("arrival_ts"),
        )
    )

    # A field of an array of structs is the array of that field.
    def texts(field: str) -> Column:
        return F.col(f"items.{field}").cast("array<string>")

    return packed.select(
        "user_id",
        "block",
        "arrival_ts",
        texts("action_type").alias("types"),
        texts("creation_id").alias("ids"),
        texts("action_ts").alias("times"),
    )


def action_messages(lists: DataFrame) -> DataFrame:
    """Raw rows, one per batch; some lists end in commas, some ids are padded."""
    joined = [F.concat_ws(",", c) for c in ("types", "ids", "times")]
    loose = [
        F.concat(joined[0], F.lit(",,")),
        F.concat(F.lit(" "), F.concat_ws(" , ", "ids"), F.lit(" ")),
        joined[2],
    ]
    pick = F.pmod("user_id", F.lit(3))
    user = F.col("user_id")
    value = F.when(
        F.pmod("block", F.lit(2)) == 0, _json("action_batch", [*joined, user], pick)
    ).otherwise(_json("action_batch", [*loose, user.cast("string")], pick))
    return lists.select(
        text.once(value.cast("binary")).alias("value"),
        F.lit("actions").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        (F.col("block") * 1_000_000 + F.col("user_id")).alias("offset"),
        F.col("arrival_ts").alias("timestamp"),
    )
