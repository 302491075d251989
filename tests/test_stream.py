"""The stream against the batch, late rows, bounded state and restarts."""

import contextlib
import io
import warnings
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rows import bag, enriched, passages
from spanwatch.operators.detect import average_violations, violations
from spanwatch.operators.enrich import with_limits
from spanwatch.operators.messages import encode
from spanwatch.operators.segments import segment_pairs
from spanwatch.params import Params
from spanwatch.sources.dimensions import cameras
from spanwatch.sources.events import file_messages, stored_passages
from spanwatch.sources.facts import daily_documents, violation_facts
from spanwatch.streaming import job, replay
from spanwatch.streaming.daily import refresh_stale
from spanwatch.streaming.sink import delivery_metrics

START = datetime(2024, 3, 1, 8)


# Each partition of the state costs files per micro-batch.
FEW = 2


def traffic(seconds, plates=3):
    """Vehicles that pass the three cameras at different speeds, one wave a minute."""
    rows = []
    for s in range(0, seconds, 20):
        for n in range(plates):
            for camera in (1, 2, 3):
                at = START + timedelta(seconds=s + (camera - 1) * (25 + 10 * n))
                rows.append((f"P{n}", camera, at.strftime("%Y-%m-%d %H:%M:%S"), 100.0 + 8 * n))
    return sorted(rows, key=lambda row: row[2])


def run(spark, tmp_path, events, wave, waves, **options):
    folder = str(tmp_path)
    replay.create_landing(spark, f"{folder}/landing")
    queries = replay.release(
        events,
        f"{folder}/landing",
        wave,
        waves,
        lambda: job.start(
            job.passages(file_messages(spark, f"{folder}/landing")),
            cameras(spark),
            f"{folder}/violations",
            f"{folder}/checkpoint",
            available_now=True,
            state_partitions=FEW,
            **options,
        ),
    )
    return violation_facts(spark, f"{folder}/violations"), queries


def by_minute(minutes):
    seconds = F.unix_timestamp("timestamp") - int(START.timestamp())
    return F.floor(seconds / (60 * minutes))


@pytest.mark.parametrize("hot_plates", [(), ("P1", "P2")])
def test_stream_equals_batch(spark, tmp_path, hot_plates):
    rows = traffic(180)
    events = passages(spark, rows)
    stored, queries = run(
        spark,
        tmp_path,
        events,
        by_minute(2),
        3,
        hot_plates=hot_plates,
        metrics_path=f"{tmp_path}/metrics",
        daily_path=f"{tmp_path}/daily",
    )
    wanted = violations(enriched(spark, rows)).distinct()
    assert bag(stored) == bag(wanted) and wanted.count() > 10
    assert sum(job.late_rows(query) for query in queries) == 0
    inserted = delivery_metrics(spark, f"{tmp_path}/metrics").agg(F.sum("inserted")).first()[0]
    documented = daily_documents(spark, f"{tmp_path}/daily").agg(F.sum("n_violations")).first()[0]
    assert inserted == documented == wanted.count()


def test_decoding_and_detecting_as_two_streams(spark, tmp_path):
    rows = traffic(60, plates=2)
    folder = str(tmp_path)
    replay.create_landing(spark, f"{folder}/landing")

    def resume():
        decoded = job.passages(file_messages(spark, f"{folder}/landing"))
        job.append_table(
            decoded, f"{folder}/passages", f"{folder}/checkpoint1", available_now=True
        ).awaitTermination()
        return job.start(
            stored_passages(spark, f"{folder}/passages"),
            cameras(spark),
            f"{folder}/violations",
            f"{folder}/checkpoint2",
            available_now=True,
            state_partitions=FEW,
        )

    replay.release(passages(spark, rows), f"{folder}/landing", by_minute(1), 3, resume)
    wanted = violations(enriched(spark, rows)).distinct()
    assert bag(violation_facts(spark, f"{folder}/violations")) == bag(wanted)


def test_late_rows_miss_the_join_only(spark, tmp_path):
    rows = [
        ("A", 1, "08:00:00", 50.0),
        ("B", 1, "08:10:00", 50.0),
        ("A", 2, "08:00:30", 190.0),  # arrives last, long after the watermark has passed
    ]
    stored, queries = run(spark, tmp_path, passages(spark, rows), F.col("event_id").cast("int"), 3)
    assert violations(enriched(spark, rows)).count() == 2
    assert [v["violation_type"] for v in stored.collect()] == ["speed"]
    assert sum(job.late_rows(query) for query in queries) >= 1


def test_state_stays_bounded(spark, tmp_path):
    rows = traffic(720, plates=1)
    _, queries = run(spark, tmp_path, passages(spark, rows), by_minute(3), 4)
    held = [job.state_rows(query)[-1] for query in queries]
    assert max(held[2:]) <= max(held[:2])


def test_documents_are_complete_after_a_stop_between_facts_and_documents(
    spark, tmp_path, monkeypatch
):
    rows, calls = traffic(60, plates=2), []
    append = job.append_slices

    def stops_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("lost between facts and documents")
        append(*args)

    monkeypatch.setattr(job, "append_slices", stops_once)
    options = {"daily_path": f"{tmp_path}/daily"}
    with pytest.raises(StreamingQueryException, match="lost between"):
        run(spark, tmp_path, passages(spark, rows), by_minute(1), 1, **options)
    assert violation_facts(spark, f"{tmp_path}/violations").count() > 0
    job.start(
        job.passages(file_messages(spark, f"{tmp_path}/landing")),
        cameras(spark),
        f"{tmp_path}/violations",
        f"{tmp_path}/checkpoint",
        available_now=True,
        state_partitions=FEW,
        **options,
    ).awaitTermination()
    stored = violation_facts(spark, f"{tmp_path}/violations")
    documented = daily_documents(spark, f"{tmp_path}/daily").agg(F.sum("n_violations")).first()[0]
    assert documented == stored.count()
    assert refresh_stale(spark, f"{tmp_path}/violations", f"{tmp_path}/daily") == []


def test_a_job_in_another_zone_is_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kuala_Lumpur")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            run(spark, tmp_path, passages(spark, []), F.lit(0), 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_limits_of_zero_and_the_id_axis_do_not_stop_the_job(spark):
    dim = cameras(spark, [(1, 2.0, 102.0, 1.0, 0), (9, 2.0, 102.0, 2.0, 60)])
    with pytest.warns(UserWarning, match="up to 480 s"):
        job.warn_if_blind(dim, Params(road_axis="camera_id"))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        job.warn_if_blind(dim, Params())


def test_settings_are_not_left_behind(spark):
    before = {key: spark.conf.get(key, None) for key in job.STREAM_SETTINGS}
    with job.stream_settings(spark, FEW):
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(FEW)
    assert {key: spark.conf.get(key, None) for key in job.STREAM_SETTINGS} == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_join_state_holds_only_what_the_result_needs(spark, tmp_path):
    replay.create_landing(spark, f"{tmp_path}/landing")
    stream = job.passages(file_messages(spark, f"{tmp_path}/landing"))
    judged = average_violations(segment_pairs(with_limits(stream, cameras(spark))))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        judged.explain()
    lines = out.getvalue().splitlines()
    sides = [below for line, below in zip(lines, lines[1:]) if "EventTimeWatermark" in line]
    assert "StreamingSymmetricHashJoin" in out.getvalue() and len(sides) == 2
    assert all("Project [car_plate" in side for side in sides)
    for side in sides:
        assert "speed_reading" not in side and "producer_id" not in side and "event_id" not in side


def test_a_short_tolerance_is_reported(spark):
    with pytest.warns(UserWarning, match="misses violations that take up to 80 s"):
        job.warn_if_blind(cameras(spark), Params(tolerance_s=60))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        job.warn_if_blind(cameras(spark), Params())


def test_the_intake_limit_and_the_timed_trigger_run(spark, tmp_path):
    """One file a batch, and a trigger by the clock that takes them one after another."""
    folder, rows = str(tmp_path), traffic(60, plates=2)
    replay.create_landing(spark, f"{folder}/landing")
    events = passages(spark, rows)
    for minute in range(2):
        part = events.filter(by_minute(1) == minute)
        encode(part).coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    query = job.start(
        job.passages(file_messages(spark, f"{folder}/landing", max_files=1)),
        cameras(spark),
        f"{folder}/violations",
        f"{folder}/checkpoint",
        Params(trigger="1 second"),
        state_partitions=FEW,
    )
    try:
        query.processAllAvailable()
        taken = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    finally:
        query.stop()
    assert len(taken) == 2
    stored = violation_facts(spark, f"{folder}/violations")
    assert bag(stored) == bag(violations(enriched(spark, rows)).distinct())


def test_branches_share_one_decoded_exchange(spark, tmp_path):
    _, queries = run(spark, tmp_path, passages(spark, traffic(60)), F.lit(0), 1)
    plan = queries[0]._jsq.explainInternal(False)
    assert "ReusedExchange" in plan
    assert plan.count("from_json") == 1


def test_a_wave_in_one_piece_is_spread(spark, tmp_path):
    rows = spark.range(0, 300_000, 1, 1).select(
        F.col("id").cast("string").alias("event_id"),
        F.floor(F.col("id") / 100).alias("batch_id"),
        F.format_string("P%05d", F.col("id") % 999).alias("car_plate"),
        (F.col("id") % 3 + 1).cast("int").alias("camera_id"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"),
        F.lit(50.0).alias("speed_reading"),
        F.lit("CAM_PRODUCER").alias("producer_id"),
    )
    landing = f"{tmp_path}/landing"
    replay.create_landing(spark, landing)

    class Done:
        def awaitTermination(self):
            pass

    replay.release(rows, landing, F.lit(0), 1, Done)
    sizes = spark.read.parquet(landing).groupBy(F.input_file_name()).count()
    assert sizes.agg(F.sum("count")).first()[0] == 300_000
    assert sizes.agg(F.max("count")).first()[0] < 200_000


def test_available_now_loads_state_instead_of_replaying_changes(spark):
    name = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    with job.stream_settings(spark, FEW, available_now=True):
        assert spark.conf.get(name) == "false"
    with job.stream_settings(spark, FEW):
        assert spark.conf.get(name) == "true"


def test_a_waiting_plate_is_keyed_by_time_too(spark, tmp_path):
    """What a row is held against does not grow with the time that a batch spans."""
    _, _ = run(spark, tmp_path, passages(spark, traffic(60)), F.lit(0), 1)
    keys = spark.read.format("statestore").option("joinSide", "left").load(f"{tmp_path}/checkpoint")
    assert len(keys.schema["key"].dataType) == 2
