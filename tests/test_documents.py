import pytest

from rows import bag, enriched, passages
from spanwatch.operators.detect import violations
from spanwatch.operators.documents import batches, daily_merge, flatten_documents, timeline
from spanwatch.operators.timeseries import limit_lines, peak_minute, per_minute, speed_series

ROWS = (
    [("A", 1 + n % 2, f"08:{n:02d}:10", 111.0 + n) for n in range(20)]
    + [("B", 1, "09:00:00", 150.0)] * 7
    + [("C", 1, "2024-03-01 23:59:50", 50.0), ("C", 2, "2024-03-02 00:00:10", 50.0)]
)


def test_flatten_undoes_merge(spark):
    found = violations(enriched(spark, ROWS))
    merged = daily_merge(found)
    assert bag(flatten_documents(merged)) == bag(timeline(found))


def test_one_document_per_plate_and_hour_at_any_size(spark):
    rows = [*ROWS, ("A", 1, "09:30:00", 150.0)] + [("D", 1, "07:00:00", 200.0)] * 500
    merged = daily_merge(violations(enriched(spark, rows))).collect()
    sizes = {(d["car_plate"], d["violation_date"], d["slice"]): len(d["violations"]) for d in merged}
    assert sizes == {
        ("A", "2024-03-01", 8): 20,
        ("A", "2024-03-01", 9): 1,
        ("B", "2024-03-01", 9): 7,
        ("C", "2024-03-02", 0): 1,
        ("D", "2024-03-01", 7): 500,
    }


def test_merge_of_rows_known_to_be_distinct(spark):
    found = violations(enriched(spark, ROWS)).distinct()
    merged = daily_merge(found, distinct=True)
    assert bag(flatten_documents(merged)) == bag(timeline(found))
    assert bag(merged) == bag(daily_merge(found))


def test_batches_leave_out_events_without_one(spark):
    from pyspark.sql import functions as F

    events = passages(spark, [("A", 1, f"08:00:{n:02d}", 1.0) for n in range(25)])
    events = events.withColumn("batch_id", F.when(F.col("event_id") != "3", F.col("batch_id")))
    sizes = {b["batch_id"]: len(b["events"]) for b in batches(events).collect()}
    assert sizes == {0: 9, 1: 10, 2: 5}


def test_minutes_and_peak(spark):
    rows = [("A", 1, t, 150.0) for t in ("08:01:00", "08:01:59", "08:05:00", "08:05:30", "08:07:00")]
    line = timeline(violations(enriched(spark, rows)))
    counts = [(row["minute"].strftime("%H:%M"), row["count"]) for row in per_minute(line).collect()]
    assert counts == [("08:01", 2), ("08:05", 2), ("08:07", 1)]
    peak = peak_minute(line).collect()
    assert [(row["minute"].strftime("%H:%M"), row["count"]) for row in peak] == [("08:01", 2)]
    assert sum(n for _, n in counts) == line.count()


def test_arrival_is_at_the_entry_camera(spark):
    rows = [("C", 1, "2024-03-01 23:59:50", 50.0), ("C", 2, "2024-03-02 00:00:10", 50.0)]
    row = timeline(violations(enriched(spark, rows))).first()
    assert str(row["arrival_time"]) == "2024-03-01 23:59:50"
    assert str(row["violation_date"]) == "2024-03-02"
    assert row["speed_val"] == row["avg_speed"] == pytest.approx(180.0)


def test_speed_series_and_limits(spark, cams):
    line = timeline(violations(enriched(spark, ROWS)))
    kinds = {row["violation_type"] for row in speed_series(line).collect()}
    assert kinds == {"speed", "average_speed"}
    assert sorted(row["speed_limit"] for row in limit_lines(cams).collect()) == [90.0, 110.0]


def test_nothing_in_nothing_out(spark):
    line = flatten_documents(daily_merge(violations(enriched(spark, []))))
    assert bag(line) == [] and bag(per_minute(line)) == [] and bag(peak_minute(line)) == []
