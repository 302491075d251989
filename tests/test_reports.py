import math
import random

import pytest
from pyspark.sql import functions as F

from rows import bag, enriched, passages
from spanwatch.functions.geo import great_circle_km
from spanwatch.operators import ingest, report
from spanwatch.operators.detect import violations
from spanwatch.operators.dimension import measured
from spanwatch.operators.enrich import with_limits
from spanwatch.schema import CAMERAS
from spanwatch.sources.dimensions import (
    cameras_csv,
    store_vehicles,
    stored_vehicles,
    vehicle_issues,
    vehicles_csv,
)

VEHICLES = (
    "car_plate,owner_name,owner_addr,vehicle_type,registration_date\n"
    "A,Ann,1 Road,Van,2006-08-22T03:18:00\n"
    "B,Bob,2 Road,Bus,2007-08-22T03:18:00\n"
    "B,Bea,3 Road,SUV,2008-08-22T03:18:00\n"
    "C,Cy,4 Road,,2009-08-22T03:18:00\n"
)


@pytest.fixture
def vehicles(spark, tmp_path):
    (tmp_path / "vehicle.csv").write_text(VEHICLES)
    return vehicles_csv(spark, str(tmp_path / "vehicle.csv"))


@pytest.fixture
def found(spark):
    rows = [("A", 1, f"08:{n:02d}:00", 111.0 + n) for n in range(20)]
    return violations(enriched(spark, [*rows, ("A", 2, "08:00:30", 50.0), ("D", 3, "08:00:00", 99.0)]))


def test_registry_flaws(vehicles):
    issues = {(row["car_plate"], row["issue"], row["n_rows"]) for row in vehicle_issues(vehicles).collect()}
    assert issues == {
        ("B", "duplicate_plate", 2),
        ("B", "unknown_type", 1),
        ("C", "unknown_type", 1),
    }


def test_stored_registry_is_the_registry(spark, vehicles, tmp_path):
    path = str(tmp_path / "vehicles")
    store_vehicles(vehicles, path)
    assert bag(stored_vehicles(spark, path)) == bag(vehicles)


def test_camera_file_gives_the_same_dimension(spark, tmp_path, cams):
    lines = ["camera_id,latitude,longitude,position,speed_limit"]
    lines += [",".join(map(str, row)) for row in CAMERAS]
    (tmp_path / "camera.csv").write_text("\n".join(lines))
    assert bag(cameras_csv(spark, str(tmp_path / "camera.csv"))) == bag(cams)


def test_a_plate_with_two_vehicles_gives_one_row(found, vehicles, cams):
    twice = vehicles.unionByName(
        vehicles.withColumn("owner_name", F.concat(F.lit("~"), "owner_name"))
    )
    want = report.enforcement_report(found, vehicles, cams)
    assert bag(report.enforcement_report(found, twice, cams)) == bag(want)


def test_report_names_owner_and_places(found, vehicles, cams):
    rows = report.enforcement_report(found, vehicles, cams).collect()
    assert len(rows) == found.count() == 22
    by_type = {(r["car_plate"], r["violation_type"]): r for r in rows}
    average = by_type[("A", "average_speed")]
    assert (average["owner_name"], average["camera_start"], average["camera_end"]) == ("Ann", 1, 2)
    assert (average["position_start"], average["position_end"]) == (152.5, 153.5)
    stranger = by_type[("D", "speed")]
    assert (stranger["owner_name"], stranger["camera_start"], stranger["camera_end"]) == (None, 3, 3)


def test_large_dimension_is_joined_by_shuffle(spark, cams):
    events = passages(spark, [("A", n % 5, f"08:00:{n:02d}", 1.0) for n in range(40)])
    assert measured(cams, max_rows=2) is None
    shuffled = with_limits(events, cams, broadcast_rows=2)
    columns = ["event_id", "camera_id", "speed_limit", "road_km"]
    assert bag(shuffled.select(*columns)) == bag(with_limits(events, cams).select(*columns))


def test_distances_within_a_stretch_of_road(spark, cams):
    all_pairs = report.camera_distances(cams, 100.0).collect()
    km = {(p["camera_id_start"], p["camera_id_end"]): p["road_km"] for p in all_pairs}
    assert km == {(1, 2): 1.0, (2, 3): 1.0, (1, 3): 2.0}
    near = report.camera_distances(cams, 1.0).collect()
    assert {(p["camera_id_start"], p["camera_id_end"]) for p in near} == {(1, 2), (2, 3)}
    straight = {round(p["straight_km"], 6) for p in all_pairs}
    assert straight == {0.996702, 1.998006, 1.001519}


def test_hotspots(found, cams):
    _, latitude, longitude, _, _ = CAMERAS[0]
    near = report.hotspots(found, cams, latitude, longitude, 1.5).collect()
    assert {row["camera_id"]: row["n_violations"] for row in near} == {1: 20, 2: 1}


@pytest.mark.parametrize("radius_km", [0.5, 150.0, 2500.0, 12_000.0])
def test_hotspots_around_points_all_over_the_globe(spark, radius_km):
    rng = random.Random(3)
    places = [(89.9999, 10.0), (-90.0, 0.0), (90.0, -180.0), (0.0, 180.0), (0.0, -180.0)]
    for _ in range(150):
        lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 180)
        places.append((lat, lon))
        step = rng.uniform(0, 1.5) * math.degrees(radius_km / 6371)
        places.append((max(-90.0, min(90.0, lat + step)), lon))
        places.append((lat, (lon + step / max(0.05, math.cos(math.radians(lat))) + 180) % 360 - 180))
    places += [(rng.choice([-1, 1]) * rng.uniform(89, 90), rng.uniform(-180, 180)) for _ in range(40)]
    places += [(rng.uniform(-1, 1), rng.choice([-1, 1]) * rng.uniform(179.5, 180)) for _ in range(40)]
    rows = [(n, *p) for n, p in enumerate(places)] + [(None, None, 1.0), (-1, float("nan"), 1.0)]
    shape = "camera_id int, latitude double, longitude double"
    cams = spark.createDataFrame(rows, shape)
    camera = F.col("camera_id")
    details = F.struct(camera, camera.alias("camera_id_end")).alias("event_details")
    one = cams.filter("camera_id >= 0").select(details)
    centres = cams.withColumnRenamed("camera_id", "centre_id")
    near = report.hotspots_around(one, cams, centres, radius_km)
    assert "NestedLoop" not in near._jdf.queryExecution().toString()
    got = sorted((r["centre_id"], r["camera_id"]) for r in near.collect())
    a, b = centres.alias("a"), cams.filter("camera_id >= 0").alias("b")
    away = great_circle_km(
        F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude")
    )
    every = a.crossJoin(b).filter((away <= radius_km) & F.col("centre_id").between(0, 10_000))
    want = sorted((r["centre_id"], r["camera_id"]) for r in every.collect())
    assert got == want and len(want) >= len(places)


def test_preview_is_in_order_and_short(found):
    assert report.preview(found, 3).count() == 3
    assert report.preview(found, 1).first()["car_plate"] == "A"


def test_longest_time_to_a_violation(cams):
    assert report.longest_violation_s(cams).first()["seconds"] == 80.0


def test_counts(spark):
    events = passages(spark, [("A", 1, f"08:00:{n:02d}", float(n)) for n in range(25)])
    totals = ingest.ingest_totals(events).first()
    assert (totals["n_events"], totals["n_batches"], totals["last_batch"]) == (25, 3, 2)
    assert ingest.by_producer(events, "p").first()["top_speed"] == 24.0
    assert ingest.by_producer(events, "q").count() == 0
    assert events.filter(F.col("batch_id") == 2).count() == 5
