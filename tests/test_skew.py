"""Heavy keys and the shared folder."""

import random

import pytest

from pyspark.sql import functions as F

from rows import bag, enriched, passages
from spanwatch.operators.detect import violations
from spanwatch.operators.documents import batches, daily_merge, flatten_documents, timeline
from spanwatch.operators.skew import heaviest, heavy_keys
from spanwatch.workspace import fresh_folder, shared_root


def third_hot(n):
    """A third of all passages are of one plate, a third of those are copies of one."""
    rng = random.Random(n)
    rows = []
    for i in range(n):
        if i % 9 == 0:
            rows.append(("HOT", 1, "08:00:00", 150.0))
        elif i % 3 == 0:
            rows.append(("HOT", rng.randint(1, 3), f"09:{i % 60:02d}:{i // 60 % 60:02d}", 120.0 + i))
        else:
            rows.append((f"P{i}", rng.randint(1, 3), f"10:{i % 60:02d}:00", 115.0))
    return rows


def test_heavy_keys_are_counted_exactly(spark):
    events = passages(spark, third_hot(270))
    heavy = heavy_keys(events, ["car_plate"], 20, "slices").collect()
    assert [(row["car_plate"], row["slices"]) for row in heavy] == [("HOT", 5)]
    assert heaviest(events, "car_plate", 20) == ("HOT",)
    assert heaviest(events, "car_plate", 200) == ()


def test_no_heavy_key_is_left_out(spark):
    events = passages(spark, [(f"P{n % 300}", 1, "08:00:00", 1.0) for n in range(900)])
    assert heavy_keys(events, ["car_plate"], 2, "slices").count() == 300


def test_a_hot_day_is_split_by_the_hour_and_whole(spark):
    found = violations(enriched(spark, third_hot(270)))
    merged = daily_merge(found)
    assert bag(flatten_documents(merged)) == bag(timeline(found))
    hot = merged.filter("car_plate = 'HOT'").select("slice").collect()
    assert sorted(row["slice"] for row in hot) == [8, 9]


def test_a_hot_batch_is_split_by_the_hour_and_whole(spark):
    events = passages(spark, third_hot(270)).withColumn("batch_id", F.lit(1).cast("long"))
    grouped = batches(events)
    assert grouped.agg(F.sum(F.size("events"))).first()[0] == 270
    assert grouped.count() == 3


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        fresh_folder(Session, "x")


def test_the_named_folder_is_used(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": "hdfs://shared/dir/"}.get(key, default)

    class Session:
        conf = Conf()

    assert shared_root(Session()) == "hdfs://shared/dir"
    assert fresh_folder(Session(), "x").startswith("hdfs://shared/dir/spanwatch/x-")
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
