"""Lookups and reports over stored violations, and distances between cameras."""

from pyspark.sql import Column, DataFrame, functions as F

from spanwatch.functions.geo import Cover, great_circle_km
from spanwatch.functions.values import event_time
from spanwatch.operators.dimension import join_dimension, measured
from spanwatch.schema import VIOLATION_KEY


def camera_distances(cameras: DataFrame, max_km: float) -> DataFrame:
    """Every ordered pair of cameras up to `max_km` of road apart, with the kilometres
    by marker and as the crow flies. An equality join on stretches of `max_km`: a camera
    meets those of its own stretch and of the next."""
    stretch = F.floor(F.col("position") / F.lit(max_km))
    start = cameras.withColumn("_stretch", F.explode(F.array(stretch, stretch + 1))).alias("a")
    end = cameras.withColumn("_stretch", stretch).alias("b")
    apart = F.col("b.position") - F.col("a.position")
    return start.join(
        end,
        (F.col("a._stretch") == F.col("b._stretch")) & (apart > 0) & (apart <= F.lit(max_km)),
    ).select(
        F.col("a.camera_id").alias("camera_id_start"),
        F.col("b.camera_id").alias("camera_id_end"),
        F.abs(apart).alias("road_km"),
        great_circle_km(
            F.col("a.latitude"), F.col("a.longitude"), F.col("b.latitude"), F.col("b.longitude")
        ).alias("straight_km"),
    )


def longest_violation_s(cameras: DataFrame, road_axis: str = "position") -> DataFrame:
    """The longest time a pair can take and still be too fast, over all cameras: the
    furthest entry is always the first camera. A tolerance below it hides violations. A
    limit of 0 is broken at any speed and has no such time."""
    km = F.col(road_axis).cast("double")
    first_km = cameras.select(F.min(km)).scalar()
    limit = F.nullif(F.col("speed_limit"), F.lit(0))
    return cameras.select(F.max((km - first_km) * 3600.0 / limit).alias("seconds"))


def enforcement_report(
    violations: DataFrame, vehicles: DataFrame, cameras: DataFrame
) -> DataFrame:
    """Violations with the owner to write to and the places of entry and exit (the same
    camera for an instantaneous violation).

    One row per violation: of several vehicles with one plate (`vehicle_issues` finds them),
    the first by owner, address and type counts. Vehicles are as many as plates, so that
    join may shuffle on the plate; adaptive execution splits a plate with very many
    violations, which a left join allows on its left side.
    """
    owner = F.struct("owner_name", "owner_addr", "vehicle_type")
    owners = (
        vehicles.groupBy("car_plate")
        .agg(F.min(owner).alias("_owner"))
        .select("car_plate", "_owner.*")
    )
    report = violations.join(owners, "car_plate", "left")

    small = measured(cameras) is not None
    ids = {
        "start": F.coalesce("event_details.camera_id", "event_details.camera_id_start"),
        "end": F.coalesce("event_details.camera_id", "event_details.camera_id_end"),
    }
    for side, camera_id in ids.items():
        key = f"camera_{side}"
        place = cameras.select(
            F.col("camera_id").alias(key),
            F.col("latitude").alias(f"latitude_{side}"),
            F.col("longitude").alias(f"longitude_{side}"),
            F.col("position").alias(f"position_{side}"),
        )
        report = join_dimension(report.withColumn(key, camera_id), place, key, small)
    return report


def _offence_camera() -> Column:
    """Where a violation counts: its only camera, or the exit camera whose limit it broke."""
    return F.coalesce("event_details.camera_id", "event_details.camera_id_end")


def hotspots(
    violations: DataFrame, cameras: DataFrame, latitude: float, longitude: float, radius_km: float
) -> DataFrame:
    """Violations per camera within a radius of a point. Counted per camera before the
    join, so what is shuffled is one row per camera and task."""
    away = great_circle_km(
        F.lit(latitude), F.lit(longitude), F.col("latitude"), F.col("longitude")
    )
    near = cameras.withColumn("distance_km", away).filter(F.col("distance_km") <= radius_km)
    counts = violations.groupBy(_offence_camera().alias("camera_id")).agg(
        F.count(F.lit(1)).alias("n_violations")
    )
    return near.join(counts, "camera_id").select("camera_id", "distance_km", "n_violations")


def hotspots_around(
    violations: DataFrame, cameras: DataFrame, centres: DataFrame, radius_km: float
) -> DataFrame:
    """Violations per camera within a radius of each of many points (`centre_id`, `latitude`,
    `longitude`), anywhere on the globe.

    A camera lies in one cell of a cover and a centre asks the few cells that its radius reaches,
    poles and date line included, so neither side meets all of the other. A centre or camera
    without a place meets nobody; repeated centres come as often as they are given.
    """
    cover = Cover(radius_km)

    def placed(rows: DataFrame) -> DataFrame:
        return rows.filter("NOT isnan(latitude) AND NOT isnan(longitude)")

    latitude, longitude = F.col("latitude"), F.col("longitude")
    stand = placed(cameras).select(
        "camera_id", latitude, longitude, cover.cell(latitude, longitude).alias("_cell")
    )
    asked = placed(centres).select(
        "centre_id", latitude, longitude, F.explode(cover.around(latitude, longitude)).alias("_cell")
    )
    c, s = asked.alias("c"), stand.alias("s")
    away = great_circle_km(*[F.col(n) for n in ("c.latitude", "c.longitude", "s.latitude", "s.longitude")])
    near = (
        c.join(s, F.col("c._cell") == F.col("s._cell"))
        .select("centre_id", "camera_id", away.alias("distance_km"))
        .filter(F.col("distance_km") <= radius_km)
    )
    counts = violations.groupBy(_offence_camera().alias("camera_id")).agg(
        F.count(F.lit(1)).alias("n_violations")
    )
    return near.join(counts, "camera_id").select(
        "centre_id", "camera_id", "distance_km", "n_violations"
    )


def vehicle_day(violations: DataFrame, plate: str, day: str) -> DataFrame:
    """What one vehicle did on one day. Over the stored table this reads one partition."""
    return violations.filter((F.col("violation_date") == day) & (F.col("car_plate") == plate))


def preview(violations: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows in key order."""
    order = ["violation_date", event_time("event_details"), *VIOLATION_KEY]
    return violations.orderBy(*order).limit(rows)
