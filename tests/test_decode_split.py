import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hotrank.operators import actions
from hotrank.sources import decode


def raw(spark, *values):
    data = [(None if v is None else bytearray(v.encode()),) for v in values]
    return spark.createDataFrame(data, "value binary")


def split(spark, types, ids, times, user=9):
    schema = (
        "action_type_list string, creation_id_list string, timestamp_list string, user_id bigint"
    )
    return actions.split_batches(spark.createDataFrame([(types, ids, times, user)], schema))


SPLITS = [
    # lists, complete (type, id, time), reasons of the rest
    (("1,1", "111,222", "111,222"), [(1, 111, 111), (1, 222, 222)], []),
    (("1,2,,", "1,2", "10,20"), [(1, 1, 10), (2, 2, 20)], []),
    ((",1", "5,6", "10,20"), [(1, 6, 20)], ["bad_number"]),
    (("2, 3 ", "5,6", "10,20"), [(2, 5, 10), (3, 6, 20)], []),
    (("2,x,4", "5,6,7", "10,20,30"), [(2, 5, 10), (4, 7, 30)], ["bad_number"]),
    (("2,3,4", "5,6,7", "10"), [(2, 5, 10)], ["surplus", "surplus"]),
    (("2", "5", "10,20"), [(2, 5, 10)], ["missing_element"]),
    ((None, "5", "10"), [], ["missing_element"]),
    (("  ", "5", "10"), [], ["missing_element"]),
    (("", "", ""), [], []),
    ((",", ",,", ","), [], []),
    (("+2", "5", "-10"), [(2, 5, -10)], []),
    (("99999999999", "5", "10"), [], ["bad_number"]),
    (("2.0", "5", "10"), [], ["bad_number"]),
]


@pytest.mark.parametrize("lists, complete, reasons", SPLITS)
def test_split(spark, lists, complete, reasons):
    rows = split(spark, *lists).orderBy("pos").collect()
    found = [(r.action_type, r.creation_id, r.action_ts) for r in rows if r.reason is None]
    assert found == complete
    assert [r.reason for r in rows if r.reason] == reasons
    assert all(r.user_id == 9 for r in rows)


def test_split_skips_batches_without_user(spark):
    assert split(spark, "2", "5", "10", user=None).count() == 0


def test_split_fails_on_missing_element_only(spark):
    bad_number = split(spark, "2,x", "5,6", "10,20")
    assert actions.actions_of(bad_number, "fail").count() == 1
    assert actions.actions_of(split(spark, "2,3", "5,6", "10"), "fail").count() == 1
    with pytest.raises(PySparkException, match="missing_element"):
        actions.actions_of(split(spark, "2", "5", "10,20"), "fail").collect()


def test_split_quarantine_and_ragged_flag(spark):
    bad = actions.quarantined(split(spark, "2", "5", "10,20"))
    assert bad.columns == ["source", "reason", "raw"]
    assert bad.collect()[0].raw == "2 / 5 / 10,20"
    lists = spark.createDataFrame([("1,2", "1,2", "1"), ("1,", "1", "1")], "a string, b string, c string")
    flags = [r[0] for r in lists.select(actions.is_ragged("a", "b", "c")).collect()]
    assert flags == [True, False]


@pytest.mark.parametrize(
    "message",
    [
        '{"actionTypeList":"1,1","creationIdList":"111,222","timestampList":"111,222","userId":9}',
        '{"action_type_list":"1,1","creation_id_list":"111,222","timestamp_list":"111,222","user_id":"9"}',
        '{"ActionTypeList":"1,1","CREATION-ID-LIST":"111,222","timestampList":"111,222","UserID":9}',
    ],
)
def test_spellings_decode_alike(spark, message):
    row = decode.accepted(decode.decode_action_batches(raw(spark, message))).collect()
    assert [tuple(r) for r in row] == [("1,1", "111,222", "111,222", 9)]


def test_decode_reasons(spark):
    cases = {
        "{bad": "malformed_json",
        "[]": "malformed_json",
        "12": "malformed_json",
        '{"creationId":1}{"creationId":2}': "malformed_json",
        '{"creationId":1} x': "malformed_json",
        '{"creationId":"abc"}': "bad_field",
        '{"category":"x"}': "null_creation_id",
        '{"creationId":1,"category":null}': None,
        '{"creationId":"12","other":{"a":[1]}}': None,
    }
    rows = decode.decode_creations(raw(spark, *cases)).collect()
    assert {r.raw: r.reason for r in rows} == cases


def test_decode_skips_empty_and_null(spark):
    assert decode.decode_creations(raw(spark, "", None, "null", "  ")).count() == 0


def test_first_of_two_spellings_counts(spark):
    row = decode.decode_creations(raw(spark, '{"creationId":1,"creation_id":2}')).first()
    assert row.creation_id == 1


def test_decode_can_fail(spark):
    decoded = decode.decode_creations(raw(spark, '{"creationId":1}', "{bad"))
    assert decode.accepted(decoded).count() == 1
    assert decode.quarantined(decoded).collect()[0].raw == "{bad"
    with pytest.raises(PySparkException, match="malformed_json"):
        decode.accepted(decoded, "fail").collect()


def test_undecoded_batches_pass_through_the_split(spark):
    messages = raw(
        spark,
        "{bad",
        '{"actionTypeList":"2","creationIdList":"5","timestampList":"10,20","userId":1}',
        '{"actionTypeList":"2","userId":"u"}',
        '{"actionTypeList":"2","creationIdList":"5","timestampList":"10"}',
    )
    places = actions.split_batches(decode.decode_action_batches(messages))
    assert sorted(r.reason for r in actions.quarantined(places).collect()) == [
        "bad_field", "malformed_json", "missing_element",
    ]
    assert actions.actions_of(places).count() == 1
    with pytest.raises(PySparkException, match="malformed_json"):
        actions.actions_of(
            actions.split_batches(decode.decode_action_batches(raw(spark, "{bad"))), "fail"
        ).collect()


def test_json_is_parsed_once(spark):
    messages = raw(spark, "{}").select(F.col("value"))
    plan = actions.actions_of(actions.split_batches(decode.decode_action_batches(messages)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1
