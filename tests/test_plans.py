"""Plans, not results: what is pushed down, broadcast, and kept out of Python."""

import contextlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F

from rows import enriched
from spanwatch.operators.detect import average_violations, violations
from spanwatch.operators.enrich import with_limits
from spanwatch.operators.report import hotspots, vehicle_day
from spanwatch.operators.segments import segment_pairs
from spanwatch.plans.oracle import plate as plate_sql
from spanwatch.plans.queries import QUERIES
from spanwatch.sources import facts
from spanwatch.sources.facts import stored_violations, violation_facts
from spanwatch.sources.tables import camera_events, plate
from spanwatch.streaming.sink import _not_stored, write_violations

# Queries that write tables first; what they then return is a plain scan.
WRITERS = ("stream", "sink", "daily_doc", "violation_fact", "vehicle_day", "violation_prev", "csv")

SF = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark):
    """Tables count as too large to broadcast unless the code says so itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue()


def test_enrichment_broadcasts_and_shuffles_nothing(spark, cams, large):
    text = plan(with_limits(camera_events(spark, SF), cams).select("event_id", "speed_limit"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "Window" not in text


def test_segment_join_reads_and_shuffles_what_it_needs(spark, cams, large):
    text = plan(average_violations(segment_pairs(with_limits(camera_events(spark, SF), cams))))
    assert text.count("hashpartitioning") == 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    for scan in scans:
        assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in scan


def test_lookup_reads_one_day(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [("A", 1, f"2024-03-0{n} 08:00:00", 150.0) for n in (1, 2, 3)]
    write_violations(violations(enriched(spark, rows)), path, "run", 0)
    found = vehicle_day(violation_facts(spark, path), "A", "2024-03-02")
    assert found.count() == 1 and len(found.inputFiles()) == 3
    text = plan(found)
    assert "(violation_date" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(car_plate,A)" in text


def test_a_delivery_reads_its_days_and_its_stretch_of_time(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [("A", 1, f"2024-03-0{n} 08:00:00", 150.0) for n in (1, 2, 3)]
    found = violations(enriched(spark, rows))
    write_violations(found, path, "run", 0)
    prepared = found.withColumn("event_us", F.unix_micros("event_details.timestamp"))
    day = {"violation_date": "2024-03-02", "first": 5, "last": 7, "prepared": 1}
    text = plan(_not_stored(prepared, path, [day]))
    assert "GreaterThanOrEqual(event_us,5), LessThanOrEqual(event_us,7)" in text
    assert "BroadcastHashJoin" in text
    files = stored_violations(spark, path, ["2024-03-02", "1999-01-01"]).inputFiles()
    assert len(files) == 1 and "violation_date=2024-03-02" in files[0]
    assert stored_violations(spark, path, ["1999-01-01"]).count() == 0


def test_a_delivery_about_very_many_days_is_pruned_too(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(facts, "NAMED_DAYS", 1)
    path = str(tmp_path / "facts")
    rows = [("A", 1, f"2024-03-0{n} 08:00:00", 150.0) for n in (1, 2, 3)]
    found = violations(enriched(spark, rows))
    write_violations(found, path, "run", 0)
    prepared = found.withColumn("event_us", F.unix_micros("event_details.timestamp"))
    days = [
        {"violation_date": f"2024-03-0{n}", "first": 5 + n, "last": 7 + n, "prepared": 1}
        for n in (1, 2)
    ]
    text = plan(_not_stored(prepared, path, days))
    assert "GreaterThanOrEqual(event_us,6), LessThanOrEqual(event_us,9)" in text
    assert "dynamicpruning" in text


def test_facts_are_written_in_one_pass_by_day(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [("A", 1, f"2024-03-0{1 + n % 3} 08:{n:02d}:00", 150.0) for n in range(60)]
    write_violations(violations(enriched(spark, rows)), path, "run", 0)
    assert len(violation_facts(spark, path).inputFiles()) == 3


def test_hotspots_count_before_they_join(spark, cams):
    found = violations(with_limits(camera_events(spark, SF), cams))
    text = plan(hotspots(found, cams, 2.157730731, 102.6601002, 1.5))
    assert text.index("Join") < text.index("HashAggregate")


@pytest.mark.parametrize(
    "name",
    [n for n in QUERIES if not n.startswith(WRITERS)],
)
def test_no_python_and_no_cross_join_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_plates_of_any_length_stay_apart(spark):
    numbers = [12345, 123450, 123459, 1234567, 7]
    frame = spark.createDataFrame([(n,) for n in numbers], "n long")
    plates = [row["p"] for row in frame.select(plate(F.col("n")).alias("p")).collect()]
    assert sorted(plates) == ["P00007", "P12345", "P123450", "P1234567", "P123459"]
    sql = " UNION ALL ".join(f"SELECT {plate_sql(str(n))} AS p" for n in numbers)
    assert sorted(p for (p,) in duckdb.sql(sql).fetchall()) == sorted(plates)
