from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from hotrank.functions.text import member_text, ranking_key
from hotrank.options import KafkaSourceOptions, RankingOptions
from hotrank.sources import kafka

SOURCE = KafkaSourceOptions("broker:9092", ["a", "b"], "group")


def test_defaults():
    options = RankingOptions(SOURCE, SOURCE)
    assert options.window_size == timedelta(minutes=5)
    assert options.score_half_life == options.window_half_life == timedelta(minutes=10)
    assert options.sink_uri == "redis://localhost:6379"
    assert options.board_size == 100


def test_none_and_blank_mean_default():
    options = RankingOptions(
        SOURCE, SOURCE, window_size=None, score_half_life=None, sink_uri="  "
    )
    assert options.window_size == timedelta(minutes=5)
    assert options.score_half_life == timedelta(minutes=10)
    assert options.sink_uri == "redis://localhost:6379"


@pytest.mark.parametrize(
    "bad",
    [
        {"window_size": timedelta(0)},
        {"score_half_life": timedelta(0)},
        {"window_half_life": timedelta(seconds=-1)},
        {"board_size": 0},
        {"on_malformed": "ignore"},
        {"creation_source": None},
    ],
)
def test_refused_options(bad):
    with pytest.raises(ValueError):
        RankingOptions(**{"creation_source": SOURCE, "action_source": SOURCE, **bad})


@pytest.mark.parametrize("topics", [[], ["a,b"], [""]])
def test_refused_topics(topics):
    with pytest.raises(ValueError):
        KafkaSourceOptions("broker:9092", topics, "group")


def test_reader_options():
    found = kafka.reader_options(SOURCE)
    assert found["subscribe"] == "a,b"
    assert found["startingOffsets"] == "latest"
    assert found["kafka.bootstrap.servers"] == "broker:9092"
    assert found["groupIdPrefix"] == "group" and "kafka.group.id" not in found
    fixed = KafkaSourceOptions("broker:9092", ["a"], "group", fixed_group=True).client_settings()
    assert fixed["kafka.group.id"] == "group" and "groupIdPrefix" not in fixed
    assert found["kafka.client.id"] == "hotrank"
    assert found["kafka.security.protocol"] == "PLAINTEXT"
    assert "endingOffsets" not in found


def test_start_is_moved_by_the_flag_alone():
    reset = KafkaSourceOptions("b:1", ["a"], "g", auto_offset_reset="earliest")
    assert kafka.reader_options(reset)["startingOffsets"] == "latest"
    flagged = KafkaSourceOptions("b:1", ["a"], "g", start_from_earliest=True)
    assert kafka.reader_options(flagged)["startingOffsets"] == "earliest"
    batch = kafka.reader_options(flagged, batch=True)
    assert (batch["startingOffsets"], batch["endingOffsets"]) == ("earliest", "latest")


def test_fixed_settings_win_over_properties():
    options = KafkaSourceOptions(
        "b:1", ["a"], "g", security_protocol="SSL",
        properties={
            "security.protocol": "PLAINTEXT", "enable.auto.commit": "true",
            "fetch.max.bytes": "1000", "auto.offset.reset": "earliest",
        },
        reader_options={"minPartitions": "64"},
    )
    found = kafka.reader_options(options)
    assert found["kafka.security.protocol"] == "SSL"
    assert found["kafka.fetch.max.bytes"] == "1000"
    assert found["minPartitions"] == "64"
    assert not {"kafka.enable.auto.commit", "kafka.auto.offset.reset"} & set(found)


def test_batch_read_needs_a_beginning(spark):
    with pytest.raises(ValueError):
        kafka.read_batch(spark, SOURCE)


def test_sequence_numbers_follow_topic_partition_offset(spark):
    data = [("b", 0, 1), ("a", 3, 0), ("a", 0, 2**43), ("a", 0, 7), ("b", 0, 0)]
    df = spark.createDataFrame(data, "topic string, partition int, offset bigint")
    df = df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    found = kafka.with_arrival(df, ["a", "b"], "kafka").orderBy("arrival_seq").collect()
    assert [(r.topic, r.partition, r.offset) for r in found] == sorted(data)
    assert len({r.arrival_seq for r in found}) == 5


@pytest.mark.parametrize("row", [("a", 1 << 14, 0), ("a", 0, 1 << 44), ("c", 0, 0)])
def test_rows_without_a_place_in_the_order_end_the_query(spark, row):
    df = spark.createDataFrame([row], "topic string, partition int, offset bigint")
    with pytest.raises(Exception, match="no place in the order of arrival"):
        df.select(kafka.sequence_number(["a", "b"])).collect()


def test_names_of_sorted_sets(spark):
    row = spark.range(12, 13).select(ranking_key(F.lit("news")), member_text(F.col("id"))).first()
    assert tuple(row) == ("hot:news", "12")
