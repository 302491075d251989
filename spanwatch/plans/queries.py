"""One runnable query per operator, over the tables in a folder.

Results are plain columns (text, numbers, epoch microseconds), so that any engine can be
compared with them.
"""

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from spanwatch.functions.times import minute_text
from spanwatch.operators import detect, documents, ingest, messages, report, timeseries
from spanwatch.operators.enrich import with_limits
from spanwatch.operators.segments import segment_pairs as pair_up
from spanwatch.params import Params
from spanwatch.schema import CAMERAS, SPEED
from spanwatch.sources import dimensions, events as sources, facts, tables
from spanwatch.streaming import job, ledger, replay, series, sink
from spanwatch.workspace import fresh_folder, use_utc

LONG = Params(tolerance_s=tables.LONG_TOLERANCE_S)
WAVES = 4
# State stores of the streams: one for each core, but no fewer than on the smallest cluster.
LEAST_STATE_PARTITIONS = 8


def _micros(name: str, alias: str) -> Column:
    return F.unix_micros(name).alias(alias)


def _long_cameras(spark: SparkSession) -> DataFrame:
    return dimensions.cameras(spark, tables.LONG_CORRIDOR)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_limits(tables.camera_events(spark, sf_dir), _long_cameras(spark))


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.violations(_enriched(spark, sf_dir), LONG)


def _event_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "batch_id",
        "car_plate",
        "camera_id",
        _micros("timestamp", "ts_us"),
        "speed_reading",
        "producer_id",
    )


def _flat(violations: DataFrame) -> DataFrame:
    d = "event_details."
    return violations.select(
        "car_plate",
        "violation_date",
        "violation_type",
        "speed_limit",
        d + "camera_id",
        _micros(d + "timestamp", "ts_us"),
        d + "speed",
        d + "camera_id_start",
        d + "camera_id_end",
        _micros(d + "timestamp_start", "start_us"),
        _micros(d + "timestamp_end", "end_us"),
        d + "avg_speed",
    )


# -- dimensions and sources -------------------------------------------------


def camera_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The camera dimension, with the passages each camera has in the table."""
    passages = tables.camera_events(spark, sf_dir).groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("n_events")
    )
    return dimensions.cameras(spark).join(passages, "camera_id", "left")


def camera_pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the cameras that the passages of the table name."""
    used = tables.camera_events(spark, sf_dir).groupBy("camera_id").agg(
        F.count(F.lit(1)).alias("n_events")
    )
    cameras = dimensions.cameras(spark).join(used, "camera_id", "left_semi")
    # As long as the corridor is, whatever its length: no pair is left out.
    corridor = cameras.agg((F.max("position") - F.min("position")).alias("km")).first()["km"]
    pairs = report.camera_distances(cameras, max_km=max(corridor or 0.0, 1.0))
    return pairs.withColumn("straight_km", F.round("straight_km", 6))


def vehicle_dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks a registry with flaws: customers ending in 9 carry the plate of their
    predecessor, and the machinery segment drives a type that is not on the list."""
    customer = tables.table(spark, sf_dir, "customer")
    number = F.when(F.col("c_custkey") % 10 == 9, F.col("c_custkey") - 1).otherwise(
        F.col("c_custkey")
    )
    registry = customer.select(
        tables.plate(number).alias("car_plate"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Bus").otherwise("Van").alias("vehicle_type"),
    )
    return dimensions.vehicle_issues(registry)


def csv_event_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.camera_events(spark, sf_dir)
    folder = fresh_folder(spark, "csv")
    paths = []
    for letter in "ABC":
        path = f"{folder}/camera_event_{letter}.csv"
        (
            events.filter(F.col("producer_id").endswith(letter.lower()))
            .select(
                "event_id",
                "batch_id",
                "car_plate",
                "camera_id",
                F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
                "speed_reading",
            )
            .write.csv(path, header=True)
        )
        paths.append(path)
    return _event_columns(sources.csv_events(spark, paths))


# -- messages, quality, counts ----------------------------------------------


def kafka_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, and what their JSON text says."""
    stamp = F.lit(replay.REPLAY_TIME).cast("timestamp")
    fields = [
        "event_id",
        "batch_id",
        "camera_id",
        "timestamp",
        "speed_reading",
        "producer_id",
        "ingestion_timestamp",
    ]
    encoded = messages.encode(tables.camera_events(spark, sf_dir), stamp)
    read = encoded.select("key", "topic", F.json_tuple("value", *fields).alias(*fields))
    return read.select(
        "key",
        "topic",
        "event_id",
        F.col("batch_id").cast("long").alias("batch_id"),
        F.col("camera_id").cast("int").alias("camera_id"),
        F.col("timestamp").alias("ts_text"),
        F.col("speed_reading").cast("double").alias("speed_reading"),
        "producer_id",
        F.col("ingestion_timestamp").alias("ingested"),
    )


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The free-form properties of the events, read with a declared schema."""
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k BIGINT").alias("p")).select(
        "event_id", "p.k"
    )


def message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages to messages and back."""
    encoded = messages.encode(
        tables.camera_events(spark, sf_dir), F.lit(replay.REPLAY_TIME).cast("timestamp")
    )
    return messages.decode(encoded).select(
        "kafka_key",
        "event_id",
        "batch_id",
        "car_plate",
        "camera_id",
        _micros("timestamp", "ts_us"),
        "speed_reading",
        "producer_id",
        _micros("ingestion_timestamp", "ingested_us"),
    )


def _spoiled(encoded: DataFrame) -> DataFrame:
    """The messages of some batches damaged in one of five ways."""
    flaw = F.get_json_object("value", "$.batch_id").cast("long") % 10
    value = (
        F.when(flaw == 1, F.regexp_replace("value", '"camera_id":[0-9]+', '"camera_id":"?"'))
        .when(flaw == 2, F.regexp_replace("value", '"car_plate":"[^"]*"', '"car_plate":NaN'))
        .when(flaw == 3, F.regexp_replace("value", '"timestamp":"2', '"timestamp":"x'))
        .when(flaw == 4, F.regexp_replace("value", '"speed_reading":[^,]+', '"speed_reading":NaN'))
        .when(flaw == 5, F.regexp_replace("value", '"car_plate".*', ""))
        .otherwise(F.col("value"))
    )
    return encoded.withColumn("value", value)


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all events, some of them damaged."""
    stamp = F.lit(replay.REPLAY_TIME).cast("timestamp")
    return _spoiled(messages.encode(tables.camera_events(spark, sf_dir), stamp))


def event_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(messages.quality_filter(messages.decode(_damaged(spark, sf_dir))))


def event_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.rejected(messages.decode(_damaged(spark, sf_dir)))


def batch_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = documents.batches(tables.camera_events(spark, sf_dir))
    return grouped.select(
        "batch_id",
        "slice",
        F.size("events").cast("long").alias("n_events"),
        F.unix_micros(F.array_min(F.col("events.timestamp"))).alias("first_us"),
        F.unix_micros(F.array_max(F.col("events.timestamp"))).alias("last_us"),
        F.array_max(F.col("events.speed_reading")).alias("top_speed"),
        F.size(F.array_distinct(F.col("events.car_plate"))).cast("long").alias("n_plates"),
    )


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_totals(tables.camera_events(spark, sf_dir))


def producer_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    traced = ingest.by_producer(tables.camera_events(spark, sf_dir))
    return traced.select(
        "producer_id",
        "n_events",
        _micros("first_seen", "first_us"),
        _micros("last_seen", "last_us"),
        "top_speed",
    )


# -- enrichment and detection -----------------------------------------------


def speed_limit_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a dimension that lacks camera 3: its passages stay, without a limit."""
    two = dimensions.cameras(spark, CAMERAS[:2])
    return with_limits(tables.camera_events(spark, sf_dir), two).select(
        "event_id", "camera_id", "speed_reading", "speed_limit", "road_km"
    )


def instant_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = "event_details."
    return detect.instant_violations(_enriched(spark, sf_dir)).select(
        "car_plate",
        "violation_date",
        "violation_type",
        "speed_limit",
        d + "camera_id",
        _micros(d + "timestamp", "ts_us"),
        d + "speed",
    )


def _pair_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "car_plate",
        F.col("start.event_id").alias("event_id_start"),
        F.col("end.event_id").alias("event_id_end"),
        "camera_id_start",
        "camera_id_end",
        _micros("timestamp_start", "start_us"),
        _micros("timestamp_end", "end_us"),
        "speed_limit_end",
        "distance_km",
    )


def segment_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pair_columns(pair_up(_enriched(spark, sf_dir), LONG))


def segment_pairs_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups count as hot from two rows on, so lanes and salts do the work."""
    split = replace(LONG, hot_group_rows=1)
    return _pair_columns(pair_up(_enriched(spark, sf_dir), split))


def segment_pairs_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cameras where they really stand, and the tolerance of 120 s."""
    shipped = with_limits(tables.camera_events(spark, sf_dir), dimensions.cameras(spark))
    return _pair_columns(pair_up(shipped))


def segment_pairs_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The camera id as the kilometre, and a dimension that lacks camera 3."""
    by_id = Params(road_axis="camera_id")
    two = dimensions.cameras(spark, CAMERAS[:2])
    return _pair_columns(pair_up(with_limits(tables.camera_events(spark, sf_dir), two, by_id), by_id))


def _average_columns(violations: DataFrame) -> DataFrame:
    d = "event_details."
    return violations.select(
        "car_plate",
        "violation_date",
        "violation_type",
        "speed_limit",
        d + "camera_id_start",
        d + "camera_id_end",
        _micros(d + "timestamp_start", "start_us"),
        _micros(d + "timestamp_end", "end_us"),
        d + "avg_speed",
    )


def average_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _average_columns(detect.average_violations(pair_up(_enriched(spark, sf_dir), LONG)))


def average_violations_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = with_limits(tables.camera_events(spark, sf_dir), dimensions.cameras(spark))
    return _average_columns(detect.average_violations(pair_up(shipped)))


def violation_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_violations(spark, sf_dir))


# -- documents, series, reports ---------------------------------------------


def _document_summary(merged: DataFrame) -> DataFrame:
    speeds = F.transform(
        "violations",
        lambda v: F.coalesce(v["event_details"]["speed"], v["event_details"]["avg_speed"]),
    )
    arrivals = F.transform(
        "violations",
        lambda v: F.unix_micros(
            F.coalesce(v["event_details"]["timestamp"], v["event_details"]["timestamp_start"])
        ),
    )
    instant = F.filter("violations", lambda v: v["violation_type"] == SPEED)
    return merged.select(
        "car_plate",
        "violation_date",
        "slice",
        F.size("violations").cast("long").alias("n"),
        F.size(instant).cast("long").alias("n_speed"),
        (F.size("violations") - F.size(instant)).cast("long").alias("n_avg"),
        F.array_max(speeds).alias("top_speed"),
        F.array_min(arrivals).alias("first_us"),
    )


def daily_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_summary(documents.daily_merge(_violations(spark, sf_dir)))


def violation_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents.flatten_documents(documents.daily_merge(_violations(spark, sf_dir)))
    return rows.select(
        "violation_type",
        "speed_limit",
        "car_plate",
        F.date_format("violation_date", "yyyy-MM-dd").alias("violation_date"),
        _micros("arrival_time", "arrival_us"),
        "speed_val",
    )


def _timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.timeline(_violations(spark, sf_dir))


def violations_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = timeseries.per_minute(_timeline(spark, sf_dir))
    return counts.select(minute_text(F.col("minute")).alias("minute"), F.col("count").alias("n"))


def peak_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    peak = timeseries.peak_minute(_timeline(spark, sf_dir))
    return peak.select(minute_text(F.col("minute")).alias("minute"), F.col("count").alias("n"))


def speed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = timeseries.speed_series(_timeline(spark, sf_dir)).select(
        F.col("violation_type").alias("series"), _micros("arrival_time", "arrival_us"), "speed_val"
    )
    lines = timeseries.limit_lines(dimensions.cameras(spark)).select(
        F.lit("limit").alias("series"),
        F.lit(None).cast("long").alias("arrival_us"),
        F.col("speed_limit").alias("speed_val"),
    )
    return points.unionByName(lines)


def enforcement_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reported = report.enforcement_report(
        _violations(spark, sf_dir), tables.vehicles(spark, sf_dir), dimensions.cameras(spark)
    )
    return reported.select(
        "car_plate",
        "violation_date",
        "violation_type",
        "owner_name",
        "owner_addr",
        "vehicle_type",
        "camera_start",
        "camera_end",
        "latitude_start",
        "longitude_end",
        "position_end",
        F.coalesce("event_details.speed", "event_details.avg_speed").alias("speed_val"),
    )


def hotspots_within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latitude, longitude, _, _ = CAMERAS[0]
    near = report.hotspots(
        _violations(spark, sf_dir), dimensions.cameras(spark), latitude, longitude, radius_km=1.5
    )
    return near.withColumn("distance_km", F.round("distance_km", 6))


def hotspots_around_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer lives along the road; the cameras within 1.2 km of each."""
    _, latitude, longitude, _, _ = CAMERAS[0]
    along = (F.col("c_custkey") % 400 - 100) / 10_000
    homes = tables.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("centre_id"),
        (F.lit(latitude) + along).alias("latitude"),
        (F.lit(longitude) - along).alias("longitude"),
    )
    found = _violations(spark, sf_dir)
    near = report.hotspots_around(found, dimensions.cameras(spark), homes, radius_km=1.2)
    return near.withColumn("distance_km", F.round("distance_km", 6))


# -- stored violations ------------------------------------------------------


def _stored(spark: SparkSession, sf_dir: str, deliveries: int = 1) -> tuple[str, str]:
    """A violation table written from the events, delivered once or more often. Later
    deliveries carry another limit, which must not be taken over."""
    folder = fresh_folder(spark, "facts")
    staged = f"{folder}/staged"
    _violations(spark, sf_dir).write.parquet(staged)
    batch = spark.read.parquet(staged)
    for epoch in range(deliveries):
        changed = batch.withColumn("speed_limit", F.col("speed_limit") + 10 * epoch)
        sink.write_violations(
            changed, f"{folder}/violations", "replay", epoch, f"{folder}/metrics"
        )
    return f"{folder}/violations", f"{folder}/metrics"


def sink_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _stored(spark, sf_dir, deliveries=2)
    return _flat(facts.violation_facts(spark, path))


def sink_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = _stored(spark, sf_dir, deliveries=2)
    return sink.delivery_metrics(spark, path).drop("run_id")


def violation_fact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _stored(spark, sf_dir)
    return _flat(facts.violation_facts(spark, path))


LOOKUP_PLATE, LOOKUP_DAY = "P00003", "2024-01-27"


def vehicle_day_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _stored(spark, sf_dir)
    found = report.vehicle_day(facts.violation_facts(spark, path), LOOKUP_PLATE, LOOKUP_DAY)
    return _flat(found)


def plate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The violations of one plate on all days."""
    path, _ = _stored(spark, sf_dir)
    return _flat(facts.plate_violations(spark, path, [LOOKUP_PLATE]))


def stored_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per minute as counted on arrival: in two deliveries, the second of which repeats
    the first and is itself repeated."""
    folder = fresh_folder(spark, "series")
    staged, path, kept = (f"{folder}/{name}" for name in ("staged", "violations", "series"))
    _violations(spark, sf_dir).write.parquet(staged)
    whole = spark.read.parquet(staged)
    half = whole.filter(F.pmod(F.xxhash64("car_plate"), F.lit(2)) == 0)
    for epoch, batch in ((0, half), (1, whole), (1, whole)):
        touched = sink.write_violations(batch, path, "replay", epoch)
        series.append_counts(spark, path, kept, touched, "replay", epoch)
    counts = series.minute_counts(spark, kept)
    return counts.select(minute_text(F.col("minute")).alias("minute"), F.col("count").alias("n"))


def violation_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _stored(spark, sf_dir)
    return _flat(report.preview(facts.violation_facts(spark, path)))


# -- streams ----------------------------------------------------------------


def _replay(
    spark: SparkSession,
    sf_dir: str,
    start: Callable,
    late_camera: int | None = None,
    spoil: Callable[[DataFrame], DataFrame] = lambda encoded: encoded,
) -> str:
    """Releases all events in waves through a stream that `start` (re)starts on a folder
    of messages. Passages of `late_camera` come one wave later than the others."""
    events = tables.camera_events(spark, sf_dir)
    folder = fresh_folder(spark, "stream")
    landing = f"{folder}/landing"
    replay.create_landing(spark, landing)
    wave, waves = replay.wave_of(events, WAVES), WAVES
    if late_camera is not None:
        wave, waves = wave + (F.col("camera_id") == late_camera).cast("int"), WAVES + 1
    replay.release(events, landing, wave, waves, lambda: start(landing, folder), spoil)
    return folder


def _state_partitions(spark: SparkSession) -> int:
    return max(LEAST_STATE_PARTITIONS, spark.sparkContext.defaultParallelism)


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(landing: str, folder: str):
        decoded = job.passages(sources.file_messages(spark, landing))
        return job.append_table(decoded, f"{folder}/events", f"{folder}/checkpoint", available_now=True)

    folder = _replay(spark, sf_dir, start)
    decoded = spark.read.parquet(f"{folder}/events")
    return decoded.select(
        "kafka_key",
        "event_id",
        "batch_id",
        "car_plate",
        "camera_id",
        _micros("timestamp", "ts_us"),
        "speed_reading",
        "producer_id",
    )


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch with its events and the micro-batch that took it in."""

    def start(landing: str, folder: str):
        def count(batch: DataFrame, epoch: int) -> None:
            batch.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_events")).withColumn(
                "wave", F.lit(epoch).cast("long")
            ).write.mode("overwrite").parquet(f"{folder}/counts/epoch={epoch}")

        decoded = job.passages(sources.file_messages(spark, landing))
        return (
            decoded.writeStream.foreachBatch(count)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    folder = _replay(spark, sf_dir, start)
    return spark.read.parquet(f"{folder}/counts").select("batch_id", "n_events", "wave")


def stream_segment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(landing: str, folder: str):
        passages = job.shared(job.passages(sources.file_messages(spark, landing)))
        pairs = _pair_columns(pair_up(with_limits(passages, _long_cameras(spark)), LONG))
        state = _state_partitions(spark)
        return job.append_table(pairs, f"{folder}/pairs", f"{folder}/checkpoint", state, True)

    folder = _replay(spark, sf_dir, start)
    return spark.read.parquet(f"{folder}/pairs")


def _started(spark: SparkSession, landing: str, folder: str, **options):
    return job.start(
        job.passages(sources.file_messages(spark, landing)),
        _long_cameras(spark),
        f"{folder}/violations",
        f"{folder}/checkpoint",
        LONG,
        state_partitions=_state_partitions(spark),
        available_now=True,
        **options,
    )


def _run_job(
    spark: SparkSession, sf_dir: str, late_camera: int | None = None, documents_too: bool = False
) -> str:
    def start(landing: str, folder: str):
        daily_path = f"{folder}/daily" if documents_too else None
        return _started(spark, landing, folder, daily_path=daily_path)

    return _replay(spark, sf_dir, start, late_camera)


def stream_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _run_job(spark, sf_dir)
    return _flat(facts.violation_facts(spark, f"{folder}/violations"))


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camera 3 delivers a wave late: its readings are still judged one by one, but the
    join no longer takes those older than the watermark."""
    folder = _run_job(spark, sf_dir, late_camera=3)
    return _flat(facts.violation_facts(spark, f"{folder}/violations"))


# The plates that count as hot in each wave: the list grows, shrinks and changes.
CHANGING_PLATES = ((), ("P00003",), ("P00003", "P00011"), ("P00011",))


def stream_hot_plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of hot plates changes with every wave, while passages of the last one wait: a
    new checkpoint takes them over, and reads the new messages only."""
    events = tables.camera_events(spark, sf_dir)
    folder = fresh_folder(spark, "stream")
    wave = replay.wave_of(events, WAVES)
    checkpoint = None
    for number, plates in enumerate(CHANGING_PLATES):
        landing = f"{folder}/landing-{number}"
        before, checkpoint = checkpoint, f"{folder}/checkpoint-{number}"

        def start() -> StreamingQuery:
            return job.start(
                job.passages(sources.file_messages(spark, landing)),
                _long_cameras(spark),
                f"{folder}/violations",
                checkpoint,
                LONG,
                hot_plates=plates,
                state_partitions=_state_partitions(spark),
                available_now=True,
                taking_over=before,
            )

        replay.create_landing(spark, landing)
        replay.release(events.filter(wave == number), landing, F.lit(0), 1, start)
    return _flat(facts.violation_facts(spark, f"{folder}/violations"))


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every wave of damaged messages, camera 3 a wave late, gave: decoded, refused, late,
    received and inserted. Epochs without messages only move the watermark."""
    folder = fresh_folder(spark, "ledger")
    path, metrics = f"{folder}/epochs", f"{folder}/metrics"
    kept = ledger.Ledger(spark, path)
    ran = []

    def start(landing: str, run_folder: str):
        ran.append(_started(spark, landing, run_folder, metrics_path=metrics))
        return ran[-1]

    spark.streams.addListener(kept)
    try:
        _replay(spark, sf_dir, start, late_camera=3, spoil=_spoiled)
        for query in ran:
            kept.settled(query)
    finally:
        spark.streams.removeListener(kept)
    wave = F.row_number().over(Window.partitionBy("query_id").orderBy("epoch")) - 1
    counts = ledger.stream_counts(spark, path, metrics).filter(F.col("decoded") > 0)
    return counts.select(
        wave.cast("long").alias("wave"),
        "decoded",
        "no_car_plate",
        "no_camera_id",
        "no_timestamp",
        "late",
        "received",
        "inserted",
    )


def daily_doc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _run_job(spark, sf_dir, documents_too=True)
    return _document_summary(facts.daily_documents(spark, f"{folder}/daily"))


def _in_utc(query: Callable[[SparkSession, str], DataFrame]):
    """The test tables hold times without a zone; all queries read them as UTC."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _in_utc(query)
    for query in (
        camera_dim,
        camera_pair_distance,
        vehicle_dim_check,
        csv_event_scan,
        kafka_encode,
        json_decode,
        message_decode,
        event_quality_filter,
        event_quarantine,
        batch_groups,
        ingest_metrics,
        producer_trace,
        speed_limit_enrich,
        instant_violations,
        segment_pairs,
        segment_pairs_split,
        segment_pairs_shipped,
        segment_pairs_by_id,
        average_violations,
        average_violations_shipped,
        violation_union,
        daily_merge,
        violation_flatten,
        violations_per_minute,
        peak_minute,
        speed_series,
        enforcement_report,
        hotspots_within_radius,
        hotspots_around_points,
        sink_insert_if_absent,
        sink_metrics,
        violation_fact_scan,
        vehicle_day_lookup,
        plate_lookup,
        stored_series,
        violation_preview,
        stream_decode,
        stream_replay,
        stream_segment_join,
        stream_violations,
        stream_late_data,
        stream_hot_plates,
        stream_counts,
        daily_doc_upsert,
    )
}
