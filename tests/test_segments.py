"""The binned and split joins against every pair tried one by one."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rows import enriched
from spanwatch.operators.segments import _binned_sides, segment_pairs
from spanwatch.params import Params
from spanwatch.sources.dimensions import cameras

START = datetime(2024, 3, 1)
# Nine cameras out of id order, two of them at the same kilometre.
WIDE = [(n, 2.0, 102.0, km, 100) for n, km in enumerate([4.0, 1.0, 9.0, 2.5, 2.5, 7.0, 3.0, 8.0, 0.5])]


def make(rng, n, plates, span_s, camera_ids):
    """A third of the rows go to one plate."""
    rows = []
    for _ in range(n):
        plate = "HOT" if rng.random() < 1 / 3 else f"P{rng.randrange(plates)}"
        at = START + timedelta(milliseconds=rng.randrange(span_s * 1000))
        rows.append((plate, rng.choice(camera_ids), at.strftime("%Y-%m-%d %H:%M:%S.%f"), 50.0))
    return rows


def expected(rows, positions, tolerance):
    parsed = [
        (n, plate, positions.get(cam), datetime.fromisoformat(time))
        for n, (plate, cam, time, _) in enumerate(rows)
    ]
    found = []
    for a, plate_a, km_a, t_a in parsed:
        for b, plate_b, km_b, t_b in parsed:
            if plate_a != plate_b or km_a is None or km_b is None or not (km_a < km_b and t_b > t_a):
                continue
            if int(t_b.timestamp()) - int(t_a.timestamp()) <= tolerance:
                found.append((str(a), str(b)))
    return sorted(found)


def got(spark, rows, params, dim):
    pairs = segment_pairs(enriched(spark, rows, params, dim), params)
    return sorted(
        tuple(row) for row in pairs.select("start.event_id", "end.event_id").collect()
    )


@pytest.mark.parametrize("span, hot_rows", [(1, 20_000), (4, 20_000), (1, 2), (4, 3), (9, 10)])
def test_same_pairs_as_brute_force(spark, span, hot_rows):
    rng = random.Random(span * 100 + hot_rows)
    rows = make(rng, 400, 12, 1500, [*range(9), 77])
    params = Params(bin_span=span, hot_group_rows=hot_rows)
    positions = {cam: km for cam, _, _, km, _ in WIDE}
    assert got(spark, rows, params, cameras(spark, WIDE)) == expected(rows, positions, 120)


def test_split_groups_on_the_id_axis(spark):
    rng = random.Random(5)
    rows = make(rng, 300, 4, 600, [-3, 0, 1, 2, 77])
    params = Params(road_axis="camera_id", hot_group_rows=5)
    positions = {cam: cam for cam in (-3, 0, 1, 2, 77)}
    assert got(spark, rows, params, cameras(spark, WIDE)) == expected(rows, positions, 120)


def test_copies_of_a_passage_pair_as_often_as_they_come(spark):
    rows = [("A", 1, "08:00:00", 50.0)] * 3 + [("A", 2, "08:00:30", 50.0)] * 4
    for params in (Params(), Params(hot_group_rows=2)):
        assert segment_pairs(enriched(spark, rows, params), params).count() == 12


def sides(spark, rows, params):
    return _binned_sides(enriched(spark, rows, params), params)


def test_a_hot_plate_is_split_by_its_size(spark):
    rows = [("HOT", 1 + n % 3, f"08:00:{n % 60:02d}", 50.0) for n in range(1000)]
    rows += [(f"P{n}", 1, "08:00:00", 50.0) for n in range(2000)]
    params = Params(hot_group_rows=100)
    start, end = sides(spark, rows, params)
    hot = end.filter("_hot").groupBy("_on_lane").agg(F.max("_on_start").alias("last"))
    assert sorted(row["last"] for row in hot.collect()) == [3, 6]
    assert start.filter("NOT _hot").count() == 2000


def largest(side):
    keys = [name for name in side.columns if name.startswith("_on_")]
    return max(row["count"] for row in side.groupBy("car_plate", *keys).count().collect())


@pytest.mark.parametrize("entries, exits", [(50, 2000), (2000, 50)])
def test_a_lane_heavy_at_one_end_is_split_at_that_end(spark, entries, exits):
    rows = [("HOT", 1, f"08:00:{n % 60:02d}", 50.0) for n in range(entries)]
    rows += [("HOT", 3, f"08:01:{n % 60:02d}", 50.0) for n in range(exits)]
    start, end = sides(spark, rows, Params(hot_group_rows=100))
    assert largest(start) <= 130 and largest(end) <= 130


def test_hundred_hot_plates_in_one_day_are_all_split(spark):
    rows = [(f"H{n % 100}", 1 + n // 100 % 3, f"08:00:{n % 60:02d}", 50.0) for n in range(6000)]
    start, end = sides(spark, rows, Params(hot_group_rows=15))
    assert end.filter("_hot").select("car_plate").distinct().count() == 100
    assert largest(start) <= 45 and largest(end) <= 45


def test_a_hot_plate_at_one_camera_only_meets_nobody(spark):
    rows = [("HOT", 2, f"08:00:{n % 60:02d}", 50.0) for n in range(1000)]
    start, end = sides(spark, rows, Params(hot_group_rows=100))
    assert start.count() == end.count() == 0


def test_a_table_without_hot_plates_is_left_alone(spark):
    start, end = sides(spark, [("A", 1, "08:00:00", 50.0)], Params())
    assert [name for name in start.columns if name.startswith("_")] == ["_on_bin"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("AB"), st.integers(1, 4), st.integers(0, 400_000)), max_size=40
    ),
    span=st.integers(1, 5),
    hot_rows=st.sampled_from([1, 3, 1000]),
)
def test_any_rows_any_bins(spark, rows, span, hot_rows):
    timed = [
        (plate, cam, (START + timedelta(milliseconds=ms)).strftime("%Y-%m-%d %H:%M:%S.%f"), 50.0)
        for plate, cam, ms in rows
    ]
    positions = {1: 152.5, 2: 153.5, 3: 154.5}
    params = Params(bin_span=span, hot_group_rows=hot_rows)
    assert got(spark, timed, params, None) == expected(timed, positions, 120)
