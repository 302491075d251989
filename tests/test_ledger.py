"""Counts of a stream that outlast it, repeated epochs, and gaps."""

import pytest
from pyspark.sql import functions as F

from rows import passages
from spanwatch.operators.messages import encode
from spanwatch.schema import STREAM_EPOCH
from spanwatch.sources.events import file_messages
from spanwatch.streaming import job, ledger, replay

# The query forgets all but its last 100 batches.
BATCHES = 104


def epoch(query, number, decoded, run="r1", reported="2024-03-01T08:00:00.000Z"):
    return query, number, run, reported, decoded, decoded, 1, 0, 2, 3, 4, "2024-03-01T07:59:00Z"


@pytest.fixture
def followed(spark, tmp_path):
    kept = ledger.Ledger(spark, f"{tmp_path}/epochs")
    spark.streams.addListener(kept)
    yield kept
    spark.streams.removeListener(kept)


def test_every_one_of_many_batches_is_kept(spark, tmp_path, followed):
    landing = f"{tmp_path}/landing"
    rows = [(None if n % 3 == 0 else "A", 1, "08:00:00", 50.0) for n in range(BATCHES * 9)]
    encode(passages(spark, rows)).repartition(BATCHES).write.parquet(landing)
    query = (
        job.passages(file_messages(spark, landing, max_files=1))
        .writeStream.format("noop")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    followed.settled(query)
    assert len(query.recentProgress) < BATCHES
    kept = ledger.stream_epochs(spark, followed.path)
    sums = kept.agg(*[F.sum(c) for c in ("decoded", "no_car_plate", "no_camera_id", "no_timestamp")])
    refused = len([n for n in range(BATCHES * 9) if n % 3 == 0])
    assert tuple(sums.first()) == (BATCHES * 9, refused, 0, 0)
    assert kept.filter("decoded > 0").count() == BATCHES
    gaps = ledger.missing_epochs(spark, followed.path).first()
    assert (gaps["epochs"], gaps["missing"]) == (kept.count(), 0)


def test_an_epoch_that_is_reported_again_counts_once(spark, tmp_path):
    path = f"{tmp_path}/epochs"
    ledger.store(spark, path, [epoch("q", 0, 10), epoch("q", 1, 7), epoch("p", 0, 5)])
    ledger.store(spark, path, [epoch("q", 1, 8, "r2", "2024-03-01T09:00:00.000Z")])
    ledger.store(spark, path, [epoch("q", 1, 8, "r2", "2024-03-01T09:00:00.000Z")])
    kept = {(r["query_id"], r["epoch"]): r["decoded"] for r in ledger.stream_epochs(spark, path).collect()}
    assert kept == {("q", 0): 10, ("q", 1): 8, ("p", 0): 5}
    ledger.compact_ledger(spark, path, f"{tmp_path}/few")
    few = ledger.stream_epochs(spark, f"{tmp_path}/few")
    assert few.schema == STREAM_EPOCH and few.count() == 3


def test_lost_epochs_show_as_gaps(spark, tmp_path):
    path = f"{tmp_path}/epochs"
    ledger.store(spark, path, [epoch("q", n, 1) for n in (0, 1, 4)] + [epoch("p", 1, 1)])
    found = {r["query_id"]: (r["epochs"], r["missing"]) for r in ledger.missing_epochs(spark, path).collect()}
    assert found == {"q": (3, 2), "p": (1, 1)}


def test_an_epoch_that_delivered_nothing_has_zeros(spark, tmp_path):
    from spanwatch.streaming.sink import _append_metrics

    path, metrics = f"{tmp_path}/epochs", f"{tmp_path}/metrics"
    ledger.store(spark, path, [epoch("q", 0, 9), epoch("q", 1, 9)])
    _append_metrics(spark, metrics, ("q", 1, 5, 4, 3))
    rows = ledger.stream_counts(spark, path, metrics).orderBy("epoch").collect()
    assert [(r["received"], r["prepared"], r["inserted"], r["already_stored"]) for r in rows] == [
        (0, 0, 0, 0),
        (5, 4, 3, 1),
    ]


def test_a_ledger_that_cannot_store_says_so(spark, tmp_path, followed, monkeypatch):
    def full(*_):
        raise OSError("no space")

    monkeypatch.setattr(ledger, "store", full)
    replay.create_landing(spark, f"{tmp_path}/landing")
    encode(passages(spark, [("A", 1, "08:00:00", 50.0)])).write.mode("append").parquet(
        f"{tmp_path}/landing"
    )
    query = job.append_table(
        job.passages(file_messages(spark, f"{tmp_path}/landing")),
        f"{tmp_path}/passages",
        f"{tmp_path}/checkpoint",
        available_now=True,
    )
    query.awaitTermination()
    with pytest.raises(RuntimeError, match="could not be stored"):
        followed.settled(query)


def test_other_queries_are_left_out(spark, tmp_path):
    kept = ledger.Ledger(spark, f"{tmp_path}/epochs", names=("mine",))
    progress = type("P", (), {"name": None})()
    kept.onQueryProgress(type("E", (), {"progress": progress})())
    assert not (tmp_path / "epochs").exists()
