"""JSON values to typed records.

Decoding annotates: every message that is not skipped keeps its raw text and a ``reason``,
NULL when it is sound. ``accepted`` and ``quarantined`` pick the two sides, so a caller can
write both from one pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hotrank import schemas
from hotrank.functions import text

MALFORMED, BAD_FIELD, NO_ID = "malformed_json", "bad_field", "null_creation_id"
REASONS = (MALFORMED, BAD_FIELD, NO_ID)


def _decode(raw: DataFrame, record: T.StructType, source: str) -> DataFrame:
    carried = [c for c in ("arrival_ts", "arrival_seq") if c in raw.columns]
    body = raw.select(F.col("value").cast("string").alias("raw"), *carried)
    # Empty messages and a literal null are no records at all.
    body = body.filter(text.has_content(F.col("raw")) & (F.btrim("raw", F.lit(" \t\r\n")) != "null"))
    body = body.select("*", text.once(text.json_object(F.col("raw"))).alias("_obj"))
    names = text.plain_names(F.col("_obj"))
    found = F.transform(
        F.array(names),
        lambda n: F.struct(
            *[text.field(n, F.col("_obj"), f.name).alias(f.name) for f in record.fields]
        ),
    )
    body = body.select("raw", *carried, F.col("_obj").isNull().alias("_none"), F.inline(found))
    as_number = {T.IntegerType(): text.strict_int, T.LongType(): text.strict_long}
    bad_number = F.lit(False)
    typed = []
    for f in record.fields:
        value = F.col(f.name)
        if f.dataType in as_number:
            number = as_number[f.dataType](value)
            bad_number = bad_number | (value.isNotNull() & number.isNull())
            value = number
        typed.append(value.alias(f.name))
    reason = F.when(F.col("_none"), F.lit(MALFORMED)).when(
        bad_number, F.lit(BAD_FIELD)
    )
    return body.select(
        F.lit(source).alias("source"), reason.alias("reason"), "raw", *typed, *carried
    )


def decode_creations(raw: DataFrame) -> DataFrame:
    """Creations. One without an id cannot be keyed and is marked as well."""
    out = _decode(raw, schemas.CREATION, "creation")
    return out.withColumn(
        "reason",
        F.coalesce(
            "reason", F.when(F.col("creation_id").isNull(), F.lit(NO_ID))
        ),
    )


def decode_action_batches(raw: DataFrame) -> DataFrame:
    """Packed action batches; one without a user is sound here and skipped by the split."""
    return _decode(raw, schemas.ACTION_BATCH, "action_batch")


def accepted(decoded: DataFrame, on_malformed: str = "quarantine") -> DataFrame:
    """Sound rows. With ``on_malformed="fail"`` the first unsound row ends the query."""
    if on_malformed == "fail":
        sound = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(
            F.raise_error(
                F.concat_ws(" ", F.col("source"), F.col("reason"), F.col("raw"))
            ).cast("boolean")
        )
    else:
        sound = F.col("reason").isNull()
    return decoded.filter(sound).drop("source", "reason", "raw")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull()).select(*schemas.QUARANTINE_COLUMNS)
