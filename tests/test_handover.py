"""Hot plates changed between runs, while passages wait."""

import json

import pytest

from rows import bag, enriched, passages
from spanwatch.operators.detect import violations
from spanwatch.operators.messages import encode
from spanwatch.sources.dimensions import cameras
from spanwatch.sources.events import file_messages
from spanwatch.sources.facts import violation_facts
from spanwatch.streaming import handover, job

FEW = 2


def run(spark, folder, number, rows, before=None, **options):
    """One run of the job on messages of its own."""
    landing = f"{folder}/landing-{number}"
    encode(passages(spark, rows)).write.parquet(landing)
    query = job.start(
        job.passages(file_messages(spark, landing)),
        cameras(spark),
        f"{folder}/violations",
        f"{folder}/checkpoint-{number}",
        available_now=True,
        state_partitions=options.pop("state_partitions", FEW),
        taking_over=before,
        **options,
    )
    query.awaitTermination()
    return f"{folder}/checkpoint-{number}"


# Every pair has its entry in one run and its exit in another; readings break no limit.
RUNS = [
    ((), [("A", 1, "08:00:00", 50.0), ("Z", 1, "08:00:00", 50.0), ("C", 2, "08:00:10", 50.0)]),
    (("A",), [("A", 2, "08:00:20", 50.0), ("A", 2, "08:00:21", 50.0), ("Z", 1, "08:00:22", 50.0)]),
    (("A", "Z"), [("A", 3, "08:00:40", 50.0), ("Z", 2, "08:00:41", 50.0), ("C", 3, "08:00:41", 50.0)]),
    ((), [("Z", 3, "08:00:58", 50.0), ("C", 1, "08:00:01", 50.0)]),
]


def test_no_pair_is_lost_when_the_hot_plates_change(spark, tmp_path):
    before = None
    for number, (plates, rows) in enumerate(RUNS):
        before = run(spark, tmp_path, number, rows, before, hot_plates=plates)
    every = [row for _, rows in RUNS for row in rows]
    wanted = violations(enriched(spark, every)).distinct()
    assert wanted.count() >= 8
    assert bag(violation_facts(spark, f"{tmp_path}/violations")) == bag(wanted)


def test_without_taking_over_pairs_are_lost(spark, tmp_path):
    for number, (plates, rows) in enumerate(RUNS[:2]):
        run(spark, tmp_path, number, rows, hot_plates=plates)
    assert violation_facts(spark, f"{tmp_path}/violations").count() == 0


def test_the_number_of_state_partitions_may_change_too(spark, tmp_path):
    first = run(spark, tmp_path, 0, RUNS[0][1])
    waiting = handover.waiting_passages(spark, first)
    assert {(r["car_plate"], r["camera_id"]) for r in waiting.collect()} == {("A", 1), ("Z", 1), ("C", 2)}
    run(spark, tmp_path, 1, [("A", 2, "08:00:20", 50.0)], first, state_partitions=3)
    assert violation_facts(spark, f"{tmp_path}/violations").count() == 1


def test_salted_copies_are_handed_over_once(spark, tmp_path):
    first = run(spark, tmp_path, 0, RUNS[0][1], hot_plates=("A", "C"))
    assert handover.waiting_passages(spark, first).count() == 3


def test_a_checkpoint_keeps_its_routing(spark, tmp_path):
    checkpoint = f"{tmp_path}/checkpoint"
    settle = handover.settle_routing
    assert settle(spark, checkpoint, ("B", "A"), 32) is None
    assert settle(spark, checkpoint, ("A", "B"), 32) is None
    for plates, salts in [((), 32), (("A",), 32), (("A", "B"), 3)]:
        with pytest.raises(ValueError, match="new checkpoint"):
            settle(spark, checkpoint, plates, salts)
    with pytest.raises(ValueError, match="took over from None"):
        settle(spark, checkpoint, ("A", "B"), 32, "elsewhere")


def test_a_hand_over_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    first = run(spark, tmp_path, 0, RUNS[0][1])
    second = f"{tmp_path}/checkpoint-1"
    with monkeypatch.context() as broken:
        broken.setattr(handover, "ROUTING", "no schema")
        with pytest.raises(Exception):
            handover.settle_routing(spark, second, (), 32, first)
    folder = handover.settle_routing(spark, second, (), 32, first)
    assert spark.read.parquet(folder).count() == 3
    assert handover.settle_routing(spark, second, (), 32) == folder


def test_kafka_goes_on_at_the_last_finished_batch(spark, tmp_path):
    """A checkpoint as the Kafka source writes it: three branches, the last batch unfinished."""
    for name, count in (("offsets", 4), ("commits", 3)):
        (tmp_path / name).mkdir()
        for n in range(count):
            branches = [{"camera-1": {"0": 10 * n + b, "1": 5}} for b in range(3)]
            lines = ["v1", '{"batchWatermarkMs":0}', *map(json.dumps, branches)]
            (tmp_path / name / str(n)).write_text("\n".join(lines) if name == "offsets" else "v1\n{}")
    options = handover.resume_options(spark, str(tmp_path))
    assert json.loads(options["startingOffsets"]) == {"camera-1": {"0": 20, "1": 5}}
    (tmp_path / "none").mkdir()
    assert handover.resume_options(spark, str(tmp_path / "none")) == {}
