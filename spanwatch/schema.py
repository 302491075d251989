"""Declared schemas and the fixed values of the data model. Nothing is inferred."""

from pyspark.sql import types as T

# ---- fixed values ---------------------------------------------------------
SPEED = "speed"
AVERAGE_SPEED = "average_speed"
VEHICLE_TYPES = ("Coupe", "SUV", "Sedan", "Van", "Truck", "Motorcycle")
CAMERA_TOPIC_PREFIX = "camera-events-camera-"
PRODUCER_PREFIX = "camera_producer_"
# camera_id, latitude, longitude, position (km marker), speed_limit (km/h)
CAMERAS = (
    (1, 2.157730731, 102.6601002, 152.5, 110),
    (2, 2.162418757, 102.6524549, 153.5, 110),
    (3, 2.167352891, 102.6449144, 154.5, 90),
)
# ---------------------------------------------------------------------------


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _INT, _LONG, _REAL, _TIME = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampType(),
)

# A passage as it travels: JSON value of a message, times still text.
WIRE_EVENT = _struct(
    ("event_id", _TEXT),
    ("batch_id", _LONG),
    ("car_plate", _TEXT),
    ("camera_id", _INT),
    ("timestamp", _TEXT),
    ("speed_reading", _REAL),
    ("ingestion_timestamp", _TEXT),
    ("producer_id", _TEXT),
)

# A decoded passage, as a table of them is stored.
PASSAGE = _struct(
    ("kafka_key", _TEXT),
    ("event_id", _TEXT),
    ("batch_id", _LONG),
    ("car_plate", _TEXT),
    ("camera_id", _INT),
    ("timestamp", _TIME),
    ("speed_reading", _REAL),
    ("ingestion_timestamp", _TIME),
    ("producer_id", _TEXT),
)

# The columns of a per-camera CSV file, in file order.
CSV_EVENT = _struct(
    ("event_id", _TEXT),
    ("batch_id", _LONG),
    ("car_plate", _TEXT),
    ("camera_id", _INT),
    ("timestamp", _TEXT),
    ("speed_reading", _REAL),
)

# Message shape shared by the Kafka source and the file stream that stands in for it.
MESSAGE = _struct(("key", _TEXT), ("value", _TEXT), ("topic", _TEXT))

CAMERA = _struct(
    ("camera_id", _INT),
    ("latitude", _REAL),
    ("longitude", _REAL),
    ("position", _REAL),
    ("speed_limit", _INT),
)

VEHICLE = _struct(
    ("car_plate", _TEXT),
    ("owner_name", _TEXT),
    ("owner_addr", _TEXT),
    ("vehicle_type", _TEXT),
    ("registration_date", _TIME),
)

# Both violation kinds share one struct; each leaves the other's fields null.
EVENT_DETAILS = _struct(
    ("camera_id", _INT),
    ("timestamp", _TIME),
    ("speed", _REAL),
    ("camera_id_start", _INT),
    ("camera_id_end", _INT),
    ("timestamp_start", _TIME),
    ("timestamp_end", _TIME),
    ("avg_speed", _REAL),
)

VIOLATION = _struct(
    ("car_plate", _TEXT),
    ("violation_date", _TEXT),
    ("violation_type", _TEXT),
    ("speed_limit", _LONG),
    ("event_details", EVENT_DETAILS),
)

# What identifies a violation. The limit is not part of it: the first one stored stays.
VIOLATION_KEY = ("car_plate", "violation_date", "violation_type", "event_details")

# On disk a violation also carries its event time in epoch microseconds (Parquet keeps
# statistics of whole numbers whatever the session's timestamp format, so row groups can
# be skipped) and the delivery that wrote it. The day is the partition column.
STORED_VIOLATION = _struct(
    ("car_plate", _TEXT),
    ("violation_type", _TEXT),
    ("speed_limit", _LONG),
    ("event_details", EVENT_DETAILS),
    ("event_us", _LONG),
    ("run_id", _TEXT),
    ("epoch", _LONG),
    ("violation_date", _TEXT),
)

DAILY_ITEM = _struct(
    ("violation_type", _TEXT),
    ("speed_limit", _LONG),
    ("event_details", EVENT_DETAILS),
)

DAILY_DOCUMENT = _struct(
    ("car_plate", _TEXT),
    ("violations", T.ArrayType(DAILY_ITEM)),
    ("n_violations", _LONG),
    ("violation_date", _TEXT),
    ("slice", _INT),
)

DELIVERY_METRICS = _struct(
    ("run_id", _TEXT),
    ("epoch", _LONG),
    ("received", _LONG),
    ("prepared", _LONG),
    ("inserted", _LONG),
)

# One epoch of a stream: what the source gave, what was decoded and refused, how many rows
# came too late for the join, how many it holds, and the watermark, as the query reported it.
STREAM_EPOCH = _struct(
    ("query_id", _TEXT),
    ("epoch", _LONG),
    ("run_id", _TEXT),
    ("reported", _TEXT),
    ("source_rows", _LONG),
    ("decoded", _LONG),
    ("no_car_plate", _LONG),
    ("no_camera_id", _LONG),
    ("no_timestamp", _LONG),
    ("late", _LONG),
    ("state_rows", _LONG),
    ("watermark", _TEXT),
)

# Violations that a delivery inserted into a minute, in a folder per day.
MINUTE_COUNT = _struct(
    ("minute", _TIME),
    ("count", _LONG),
    ("run_id", _TEXT),
    ("epoch", _LONG),
    ("day", _TEXT),
)
