import pytest

from rows import bag, enriched
from spanwatch.operators.detect import average_violations, instant_violations, violations
from spanwatch.operators.segments import segment_pairs
from spanwatch.params import Params
from spanwatch.schema import VIOLATION


@pytest.mark.parametrize(
    "row, limit",
    [
        (("A", 1, "08:00:00", 110.0), None),
        (("A", 1, "08:00:00", 110.01), 110),
        (("A", 3, "08:00:00", 90.0), None),
        (("A", 3, "08:00:00", 90.01), 90),
        (("A", 9, "08:00:00", 200.0), None),
        (("A", 1, "08:00:00", None), None),
    ],
)
def test_instantaneous_limit_is_strict(spark, row, limit):
    found = instant_violations(enriched(spark, [row])).collect()
    assert [v["speed_limit"] for v in found] == ([] if limit is None else [limit])
    for violation in found:
        assert violation["violation_type"] == "speed"
        assert violation["violation_date"] == "2024-03-01"
        assert violation["event_details"]["speed"] == row[3]


def pairs_of(spark, rows, params=Params()):
    found = segment_pairs(enriched(spark, rows, params), params).collect()
    return sorted((p["camera_id_start"], p["camera_id_end"]) for p in found)


def averages_of(spark, rows):
    found = average_violations(segment_pairs(enriched(spark, rows))).collect()
    return {
        (v["event_details"]["camera_id_start"], v["event_details"]["camera_id_end"]): v for v in found
    }


def test_one_kilometre_in_thirty_seconds(spark):
    found = averages_of(spark, [("A", 1, "08:00:00", 50.0), ("A", 2, "08:00:30", 50.0)])
    violation = found[(1, 2)]
    assert violation["event_details"]["avg_speed"] == pytest.approx(120.0)
    assert violation["speed_limit"] == 110
    assert violation["violation_type"] == "average_speed"


def test_exactly_at_the_limit_is_allowed(spark):
    rows = [("A", 2, "08:00:00", 50.0), ("A", 3, "08:00:40", 50.0)]
    assert pairs_of(spark, rows) == [(2, 3)]
    assert averages_of(spark, rows) == {}


def test_all_ordered_pairs_count(spark):
    rows = [("A", n, f"08:00:{30 * (n - 1):02d}", 50.0) for n in (1, 2)] + [("A", 3, "08:01:00", 50.0)]
    assert set(averages_of(spark, rows)) == {(1, 2), (2, 3), (1, 3)}


def test_no_whole_second_between_gives_a_pair_but_no_speed(spark):
    rows = [("A", 1, "08:00:00.1", 50.0), ("A", 2, "08:00:00.9", 50.0)]
    assert pairs_of(spark, rows) == [(1, 2)]
    assert averages_of(spark, rows) == {}


@pytest.mark.parametrize(
    "end, paired",
    [("08:02:00.000", True), ("08:02:00.950", True), ("08:02:01.000", False)],
)
def test_tolerance_counts_whole_seconds(spark, end, paired):
    rows = [("A", 1, "08:00:00.9", 50.0), ("A", 2, end, 50.0)]
    assert pairs_of(spark, rows) == ([(1, 2)] if paired else [])


@pytest.mark.parametrize(
    "rows",
    [
        [("A", 2, "08:00:00", 50.0), ("A", 1, "08:00:30", 50.0)],
        [("A", 1, "08:00:00", 50.0), ("A", 1, "08:00:30", 50.0)],
        [("A", 1, "08:00:00", 50.0), ("B", 2, "08:00:30", 50.0)],
        [("A", 1, "08:00:00", 50.0), ("A", 2, "08:00:00", 50.0)],
    ],
    ids=["reversed", "same camera", "other plate", "same time"],
)
def test_not_a_pair(spark, rows):
    assert pairs_of(spark, rows) == []


def test_unknown_cameras_pair_only_on_the_id_axis(spark):
    rows = [("A", 2, "08:00:00", 50.0), ("A", 9, "08:00:30", 50.0)]
    assert pairs_of(spark, rows) == []
    by_id = Params(road_axis="camera_id")
    pairs = segment_pairs(enriched(spark, rows, by_id), by_id)
    assert [p["distance_km"] for p in pairs.collect()] == [7.0]
    assert average_violations(pairs).count() == 0
    into = [("A", 0, "08:00:00", 50.0), ("A", 1, "08:00:30", 50.0)]
    assert average_violations(segment_pairs(enriched(spark, into, by_id), by_id)).count() == 1


def test_across_midnight_is_dated_by_the_exit(spark):
    rows = [("A", 1, "2024-03-01 23:59:50", 50.0), ("A", 2, "2024-03-02 00:00:10", 50.0)]
    assert averages_of(spark, rows)[(1, 2)]["violation_date"] == "2024-03-02"


def test_union_has_the_declared_shape(spark):
    rows = [("A", 1, "08:00:00", 150.0), ("A", 2, "08:00:30", 50.0)]
    both = violations(enriched(spark, rows))
    assert [f.name for f in both.schema] == VIOLATION.fieldNames()
    details = both.schema["event_details"].dataType.fieldNames()
    assert details == VIOLATION["event_details"].dataType.fieldNames()
    assert sorted(v["violation_type"] for v in both.collect()) == ["average_speed", "speed"]


def test_pairs_carry_both_passages_whole(spark):
    rows = [("A", 1, "08:00:00", 51.0), ("A", 2, "08:00:30", 52.0)]
    pair = segment_pairs(enriched(spark, rows)).first()
    assert (pair["start"]["event_id"], pair["end"]["event_id"]) == ("0", "1")
    assert (pair["start"]["speed_reading"], pair["end"]["speed_reading"]) == (51.0, 52.0)
    assert pair["speed_limit_end"] == 110


def test_empty_input(spark):
    assert bag(violations(enriched(spark, []))) == []
