"""Record types. Timestamps inside records are epoch milliseconds (bigint).

Two clocks accompany every action and creation: ``arrival_ts`` (when the row reached
the engine, which decides its window) and ``arrival_seq`` (its place among rows that
share an ``arrival_ts``). ``pos`` is the place inside one packed message.
"""

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

CREATION = T.StructType([
    T.StructField("creation_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("status", T.IntegerType()),
])

ACTION_BATCH = T.StructType([
    T.StructField("action_type_list", T.StringType()),
    T.StructField("creation_id_list", T.StringType()),
    T.StructField("timestamp_list", T.StringType()),
    T.StructField("user_id", T.LongType()),
])

ACTION = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("action_type", T.IntegerType()),
    T.StructField("creation_id", T.LongType()),
    T.StructField("action_ts", T.LongType()),
])

ARRIVAL_FIELDS = [
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("arrival_seq", T.LongType()),
]

ARRIVED_CREATION = T.StructType(CREATION.fields + ARRIVAL_FIELDS)
ARRIVED_ACTION = T.StructType(
    ACTION.fields + ARRIVAL_FIELDS + [T.StructField("pos", T.LongType())]
)

# Order in which actions reach the engine; unique per action.
ARRIVAL_ORDER = ["arrival_ts", "arrival_seq", "pos"]
# Textbook order: by the action's own clock, arrival breaking ties.
EVENT_ORDER = ["action_ts", *ARRIVAL_ORDER]

SCORE_COLUMNS = ["creation_id", "category", "score", "last_action_ts"]
WINDOWED_COLUMNS = [*SCORE_COLUMNS, "window_start", "window_end"]
BOARD_COLUMNS = ["category", "creation_id", "score", "window_end", "rank"]
QUARANTINE_COLUMNS = ["source", "reason", "raw"]
QUARANTINE = T.StructType([T.StructField(name, T.StringType()) for name in QUARANTINE_COLUMNS])

BOARD = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("creation_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("window_end", T.LongType()),
    T.StructField("rank", T.IntegerType()),
])
