"""Counts kept on arrival, and files that a plate's filter excludes."""

import pytest

from rows import bag, enriched
from spanwatch.operators.detect import violations
from spanwatch.operators.documents import timeline
from spanwatch.operators.timeseries import per_minute
from spanwatch.sources.facts import plate_violations, violation_facts
from spanwatch.streaming import series, sink


@pytest.fixture
def table(tmp_path):
    return str(tmp_path / "violations")


def readings(spark, plates, day="2024-03-01"):
    rows = [(plate, 1, f"{day} 08:{n % 60:02d}:{n % 7:02d}", 150.0) for n, plate in enumerate(plates)]
    return violations(enriched(spark, rows))


def counts(spark, path):
    return bag(series.minute_counts(spark, path).select("minute", "count"))


def test_the_series_is_that_of_the_facts(spark, table, tmp_path):
    """Redeliveries, a new checkpoint, a delivery that broke off, and midnight."""
    kept = str(tmp_path / "series")
    batch = readings(spark, [f"P{n}" for n in range(90)])
    late = readings(spark, ["P1", "P2"], "2024-03-02")
    steps = [
        ("r", 0, batch.limit(0)),
        ("r", 1, batch.filter("car_plate < 'P5'")),  # breaks off here, before its counts
        ("r", 1, batch),
        ("r", 1, batch),
        ("s", 0, batch.unionByName(late)),
    ]
    for n, (run, epoch, part) in enumerate(steps):
        touched = sink.write_violations(part, table, run, epoch)
        if n != 1:
            series.append_counts(spark, table, kept, touched, run, epoch)
    wanted = bag(per_minute(timeline(violation_facts(spark, table))))
    assert counts(spark, kept) == wanted and len(wanted) > 60
    series.compact_series(spark, kept, f"{tmp_path}/few")
    assert counts(spark, f"{tmp_path}/few") == wanted


def test_an_empty_table_has_an_empty_series(spark, table, tmp_path):
    series.append_counts(spark, table, str(tmp_path / "series"), [], "r", 0)
    assert counts(spark, str(tmp_path / "series")) == []


def rows_read(frame) -> int:
    frame.collect()
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().get("numOutputRows").get().value()


def test_a_plate_reads_only_files_that_may_hold_it(spark, table):
    """All files reach from A to Z, so that only their filters tell which holds the plate."""
    for epoch in range(4):
        plates = ["A", *[f"M{n * 4 + epoch}" for n in range(50)], "Z"]
        part = readings(spark, plates, f"2024-03-0{epoch + 1}").coalesce(1)
        sink.write_violations(part, table, "r", epoch)
    found = plate_violations(spark, table, ["M42"])
    assert found.count() == 1
    assert violation_facts(spark, table).count() == 4 * 52
    assert rows_read(plate_violations(spark, table, ["M42"])) <= 52
    assert rows_read(plate_violations(spark, table, ["Mxx"])) == 0
