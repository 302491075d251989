"""Passages of one vehicle at two cameras within the tolerance.

An interval join cannot be planned as such, so both sides get a time bin and are joined on
(plate, bin).

Batch: the bin also spreads a plate that is read very often. Groups
that are hot even so are counted exactly and split by camera order, and by salts on both
sides where that is not enough.

Stream: Spark's own stream-stream join, whose state is bounded by the watermark and
by the tolerance; a late start counts as dropped in each of its bins.
"""

from pyspark.sql import Column, DataFrame, functions as F

from spanwatch.functions.times import whole_seconds
from spanwatch.operators.enrich import ROAD
from spanwatch.params import Params
from spanwatch.workspace import written

PASSAGE = ["car_plate", "camera_id", "timestamp", "speed_limit"]
CARRIED = ["event_id", "batch_id", "speed_reading", "producer_id", "kafka_key"]

# Lists of hot groups have about 60 bytes a row; longer ones are joined by shuffle.
BROADCAST_GROUPS = 100_000
GROUP, LANE = ["car_plate", "_on_bin"], ["car_plate", "_on_bin", "_on_lane"]


def segment_pairs(
    enriched: DataFrame, params: Params = Params(), hot_plates: tuple[str, ...] = ()
) -> DataFrame:
    """One row per ordered pair of passages: both as structs (`start`, `end`), their
    cameras and times, the limit at the end camera and the kilometres between."""
    known = enriched.filter(F.col("road_km").isNotNull())
    carried = [name for name in CARRIED if name in known.columns]
    passages = known.select(*PASSAGE, *carried, *ROAD)
    if passages.isStreaming:
        start, end = _stream_sides(passages, params, hot_plates)
    else:
        start, end = _binned_sides(passages, params)
    return _joined(start, end, [*PASSAGE, *carried], params)


def _joined(start: DataFrame, end: DataFrame, shown: list[str], params: Params) -> DataFrame:
    keys = ["car_plate"] + [name for name in start.columns if name.startswith("_on_")]
    start, end = start.alias("s"), end.alias("e")
    matched = F.lit(True)
    for key in keys:
        matched &= F.col(f"s.{key}") == F.col(f"e.{key}")
    elapsed = whole_seconds(F.col("e.timestamp")) - whole_seconds(F.col("s.timestamp"))
    within = (
        (F.col("s.road_km") < F.col("e.road_km"))
        & (F.col("e.timestamp") > F.col("s.timestamp"))
        & (elapsed <= params.tolerance_s)
    )
    return start.join(end, matched & within, "inner").select(
        F.struct(*[F.col(f"s.{name}") for name in shown]).alias("start"),
        F.struct(*[F.col(f"e.{name}") for name in shown]).alias("end"),
        F.col("s.car_plate").alias("car_plate"),
        F.col("s.camera_id").alias("camera_id_start"),
        F.col("e.camera_id").alias("camera_id_end"),
        F.col("s.timestamp").alias("timestamp_start"),
        F.col("e.timestamp").alias("timestamp_end"),
        F.col("e.speed_limit").alias("speed_limit_end"),
        F.abs(F.col("e.road_km") - F.col("s.road_km")).alias("distance_km"),
    )


# -- splitting a hot plate --------------------------------------------------


def _order_lanes(role: str) -> Column:
    """Join lanes that say "this camera comes before that one" as an equality.

    For two ranks a < b there is exactly one bit above which they agree and at which a
    has 0 and b has 1. A start row takes the lanes of its 0 bits and an end row those
    of its 1 bits; a lane is the bit number with the rank's leading bits. So each
    ordered pair of cameras meets in one lane, passages at the same camera never meet,
    and a row has at most log2(cameras) lanes.
    """
    return F.expr(
        "transform("
        "  filter(sequence(0, greatest(ceil(log2(road_ranks)), 1) - 1),"
        f"        bit -> (shiftright(road_rank, int(bit)) & 1) = {0 if role == 'start' else 1}),"
        "  bit -> bit * 4294967296 + shiftright(road_rank, int(bit) + 1))"
    )


def _with_lanes(side: DataFrame, role: str, hot: Column) -> DataFrame:
    """One row per lane for hot plates; the others share the lane -1."""
    lanes = F.when(F.col("_hot"), _order_lanes(role))
    return side.withColumn("_hot", hot).withColumn(
        "_on_lane", F.explode(lanes.otherwise(F.array(F.lit(-1).cast("long"))))
    )


def _own_salt(salts: Column) -> Column:
    return F.pmod(F.xxhash64("timestamp", "camera_id", "event_id"), salts)


def _every_salt(salts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))


# -- batch ------------------------------------------------------------------


def _bin(params: Params) -> Column:
    return F.floor(whole_seconds(F.col("timestamp")) / params.bin_width_s)


def counted(start: DataFrame, end: DataFrame, keys: list[str], params: Params) -> DataFrame:
    """Rows of either side in each group, by exact count, with the number of salts that leaves
    about the threshold of rows to each."""

    def ones(side: DataFrame, starts: int) -> DataFrame:
        return side.select(
            *keys, F.lit(starts).alias("_start"), F.lit(1 - starts).alias("_end")
        )

    def salts(rows: str, name: str) -> Column:
        return F.ceil(F.col(rows) / params.hot_group_rows).alias(name)

    return (
        ones(start, 1)
        .union(ones(end, 0))
        .groupBy(*keys)
        .agg(F.sum("_start").alias("_starts"), F.sum("_end").alias("_ends"))
        .select(
            *keys,
            "_starts",
            "_ends",
            salts("_starts", "_start_salts"),
            salts("_ends", "_end_salts"),
        )
    )


def _marked(side: DataFrame, groups: DataFrame, keys: list[str], small: bool) -> DataFrame:
    return side.join(F.broadcast(groups) if small else groups, keys, "left")


def _in_bins(passages: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """Starts in every bin that they reach, and ends in their own: a pair meets in one bin."""
    width = params.bin_width_s
    own = _bin(params)
    offset = F.pmod(whole_seconds(F.col("timestamp")), F.lit(width))
    reached = F.when(offset >= width - params.tolerance_s, F.array(own, own + 1))
    start = passages.filter(~F.col("road_last")).withColumn(
        "_on_bin", F.explode(reached.otherwise(F.array(own)))
    )
    end = passages.filter(~F.col("road_first")).withColumn("_on_bin", own)
    return start, end


def _binned_sides(passages: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    start, end = _in_bins(passages, params)
    if not params.split_hot_groups:
        return start, end

    # The lists are written, so that both sides are split alike whenever a part is rerun.
    crowded = F.greatest("_starts", "_ends") > params.hot_group_rows
    groups = written(counted(start, end, GROUP, params).filter(crowded), "hot-groups")
    n_groups = groups.count()
    if not n_groups:
        return start, end
    hot = groups.select(*GROUP, F.lit(True).alias("_found"))

    def laned(side: DataFrame, role: str) -> DataFrame:
        marked = _marked(side, hot, GROUP, n_groups <= BROADCAST_GROUPS)
        return _with_lanes(marked, role, F.col("_found").isNotNull())

    start, end = laned(start, "start"), laned(end, "end")
    met = counted(start.filter("_hot"), end.filter("_hot"), LANE, params)
    lanes = written(met.filter(F.least("_starts", "_ends") > 0), "hot-lanes")
    n_lanes = lanes.count()

    def spread(side: DataFrame, role: str) -> DataFrame:
        """A row keeps to its own salt of its side and is copied to each of the other side's, so
        that every pair meets once and no side of a meeting is larger than the threshold.
        Rows of a hot group whose lane has nothing on the other side meet nobody and go."""
        one = F.lit(1).cast("long")
        marked = _marked(side, lanes, LANE, n_lanes <= BROADCAST_GROUPS).filter(
            ~F.col("_hot") | F.col("_start_salts").isNotNull()
        )
        starts, ends = F.coalesce("_start_salts", one), F.coalesce("_end_salts", one)
        if role == "start":
            return marked.withColumn("_on_start", _own_salt(starts)).withColumn(
                "_on_end", _every_salt(ends)
            )
        return marked.withColumn("_on_end", _own_salt(ends)).withColumn(
            "_on_start", _every_salt(starts)
        )

    return spread(start, "start"), spread(end, "end")


# -- stream -----------------------------------------------------------------


def _stream_sides(
    passages: DataFrame, params: Params, hot_plates: tuple[str, ...]
) -> tuple[DataFrame, DataFrame]:
    """Both sides of the stream join. A row is held against all waiting rows of its key, which
    in a batch that catches up are those of a long time: so the bin is part of the key here too.
    Adaptive execution cannot split streaming state, so plates known to be hot are named in
    advance."""
    timed = passages.withWatermark("timestamp", f"{params.watermark_s} seconds")
    start, end = _in_bins(timed, params)
    if not hot_plates:
        return start, end
    hot = F.col("car_plate").isin(*hot_plates)
    salts = F.when(F.col("_hot"), params.hot_salts).otherwise(1).cast("long")
    return (
        _with_lanes(start, "start", hot).withColumn("_on_salt", _own_salt(salts)),
        _with_lanes(end, "end", hot).withColumn("_on_salt", _every_salt(salts)),
    )
