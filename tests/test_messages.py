import json

from rows import bag, passages
from spanwatch.operators.messages import decode, encode, quality_filter, rejected
from spanwatch.schema import MESSAGE
from spanwatch.sources.events import csv_events, kafka_options, publish_options

GOOD = {
    "event_id": 7,
    "batch_id": 1,
    "car_plate": "A",
    "camera_id": 2,
    "timestamp": "2024-03-01T08:00:00.5",
    "speed_reading": 99.5,
    "ingestion_timestamp": "2024-03-01T08:00:01+00:00",
    "producer_id": "camera_producer_b",
}


def messages(spark, *values):
    return spark.createDataFrame([("k", value, "t") for value in values], MESSAGE)


def test_a_good_message(spark):
    row = decode(messages(spark, json.dumps(GOOD))).first()
    assert (row["kafka_key"], row["event_id"], row["camera_id"]) == ("k", "7", 2)
    assert row["timestamp"].microsecond == 500_000
    assert row["producer_id"] == "camera_producer_b"


def test_unusable_messages_are_dropped_without_failing(spark):
    changes = [
        {"car_plate": None},
        {"car_plate": float("nan")},
        {"car_plate": "NaN"},
        {"camera_id": "camera-1"},
        {"camera_id": 1.5},
        {"camera_id": None},
        {"timestamp": "yesterday"},
        {"timestamp": None},
    ]
    values = [json.dumps(GOOD | change) for change in changes]
    decoded = decode(messages(spark, *values, "not JSON", "", None, "[1, 2]"))
    assert decoded.count() == len(values) + 4
    assert quality_filter(decoded).count() == 0
    counts = {row["missing"]: row["n_events"] for row in rejected(decoded).collect()}
    assert counts == {"car_plate": 7, "camera_id": 3, "timestamp": 2}


def test_a_speed_that_is_no_number_becomes_null(spark):
    values = [json.dumps(GOOD | {"speed_reading": s}) for s in (float("nan"), None, "fast")]
    decoded = quality_filter(decode(messages(spark, *values)))
    assert [row["speed_reading"] for row in decoded.collect()] == [None] * 3


def test_round_trip(spark):
    events = passages(
        spark, [("A", 1, "08:00:00.123456", 10.25), ("B", 3, "23:59:59.999999", None)]
    )
    assert bag(decode(encode(events)).select(*events.columns)) == bag(events)


def test_key_and_topic(spark):
    events = passages(spark, [("A", 1, "08:00:00", 1.0), ("", 2, "08:00:00", 1.0)])
    rows = {row["topic"]: row["key"] for row in encode(events).collect()}
    assert rows == {"camera-events-camera-1": "A", "camera-events-camera-2": None}
    stamped = json.loads(encode(events).first()["value"])["ingestion_timestamp"]
    assert stamped.endswith("Z")


def test_csv_files_of_three_producers(spark, tmp_path):
    header = "event_id,batch_id,car_plate,camera_id,timestamp,speed_reading\n"
    for number, letter in enumerate("ABC", start=1):
        (tmp_path / f"camera_event_{letter}.csv").write_text(
            header + f"{number},1,P{number},{number},2024-03-01 08:00:00,{number}5.5\n"
            f"{number},,NaN,x,whenever,NaN\n"
        )
    paths = [str(tmp_path / f"camera_event_{letter}.csv") for letter in "ABC"]
    events = csv_events(spark, paths)
    good = quality_filter(events)
    assert sorted((r["producer_id"], r["car_plate"], r["speed_reading"]) for r in good.collect()) == [
        ("camera_producer_a", "P1", 15.5),
        ("camera_producer_b", "P2", 25.5),
        ("camera_producer_c", "P3", 35.5),
    ]
    assert events.count() == 6


def test_kafka_reader_options():
    options = kafka_options("broker:9092", [1, 2])
    assert options["subscribe"] == "camera-events-camera-1,camera-events-camera-2"
    assert options["maxOffsetsPerTrigger"] == "10000"
    assert options["failOnDataLoss"] == "false"
    assert options["startingOffsets"] == "latest"
    assert "group.id" not in options


def test_kafka_writer_options():
    assert publish_options("broker:9092")["kafka.acks"] == "all"


def test_a_message_without_a_topic_is_refused_and_counted(spark):
    from spanwatch.sources.events import publish_counts, publishable

    events = passages(spark, [("A", 1, "08:00:00", 1.0), ("B", None, "08:00:01", 1.0)] * 2)
    found = encode(events)
    assert publishable(found).count() == 2
    counts = {row["topic"]: (row["sent"], row["refused"]) for row in publish_counts(found).collect()}
    assert counts == {"camera-events-camera-1": (2, 0), None: (0, 2)}
