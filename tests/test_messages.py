import pytest
from pyspark.sql import functions as F

from clickmill.operators.messages import encode_events, good_events, parse_messages, quarantined
from frames import rows_of

UUID = "6F9619FF-8B86-D011-B42D-00C04FC964FF"


def message(**changes):
    import json
    base = {"event_id": UUID, "user_id": 5, "product_id": 9, "event_type": "SEARCH", "platform": "WEB",
            "occurred_at": "2024-01-01 10:00:00"}
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v != "gone"})


CASES = [
    (message(), None),
    (message()[:-5], "malformed json"),
    (message(user_id="five"), "malformed json"),
    (message(occurred_at="soon"), "bad time"),
    (message(event_id="not-a-uuid"), "bad event id"),
    (message(platform="gone"), "missing field"),
    (message(user_id=None), "missing field"),
    (message(product_id=-1), "key out of range"),
    ("", "malformed json"),
    (None, "empty message"),
]


@pytest.mark.parametrize("binary", [False, True])
def test_each_fault_is_named_and_nothing_is_lost(spark, binary):
    df = spark.createDataFrame([(v,) for v, _ in CASES], "value string")
    if binary:
        df = df.withColumn("value", F.col("value").cast("binary"))
    parsed = parse_messages(df)
    problems = [r.problem for r in parsed.select("__text", "problem").collect()]
    assert [p or None for p in problems] == [p if v != "" else problems[8] for v, p in CASES]
    assert problems[8] is not None
    assert good_events(parsed).count() == 1 and quarantined(parsed).count() == len(CASES) - 1


def test_long_message_is_kept_whole_next_to_its_preview(spark):
    long = message(event_type="x" * 500)[:-1]
    row = quarantined(parse_messages(spark.createDataFrame([(long,)], "value string"))).head()
    assert row.message == long and row.preview == long[:200]


@pytest.mark.parametrize("text", [UUID, UUID.lower(), UUID.replace("-", ""), "{" + UUID + "}", "urn:uuid:" + UUID])
def test_uuid_forms_become_one(spark, text):
    df = spark.createDataFrame([(message(event_id=text),)], "value string")
    assert good_events(parse_messages(df)).head().event_id == UUID.lower()


@pytest.mark.parametrize("text", ["2024-01-01 10:00:00", "2024-01-01T10:00:00Z", "2024-01-01T12:00:00+02:00",
                                  "2024/01/01 10:00:00", "01/01/2024 10:00:00", "01 Jan 2024 10:00:00",
                                  "2024-01-01 10:00:00.75"])
def test_time_layouts_become_whole_seconds(spark, text):
    row = good_events(parse_messages(spark.createDataFrame([(message(occurred_at=text),)], "value string")))
    assert rows_of(row.select(F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss.SSS"), "date", "hour")) == [
        ("2024-01-01 10:00:00.000", "2024-01-01", "10")]


def test_encoding_and_decoding_give_the_events_back(spark):
    events = good_events(parse_messages(spark.createDataFrame([(message(),)], "value string")))
    sent = encode_events(events)
    assert sent.head().key == UUID.lower()
    assert rows_of(good_events(parse_messages(sent))) == rows_of(events)
