"""What the queries must return, as SQL over the same tables for another engine."""

from spanwatch.plans.queries import LOOKUP_DAY, LOOKUP_PLATE, WAVES
from spanwatch.params import Params
from spanwatch.schema import CAMERAS, CAMERA_TOPIC_PREFIX, PRODUCER_PREFIX
from spanwatch.sources.tables import LONG_CORRIDOR, LONG_TOLERANCE_S

SHIPPED_TOLERANCE_S = Params().tolerance_s
WATERMARK_S = Params().watermark_s


def plate(number: str) -> str:
    """A number padded to five digits; longer ones stay whole."""
    digits = f"CAST({number} AS VARCHAR)"
    return f"'P' || lpad({digits}, CAST(greatest(5, length({digits})) AS INTEGER), '0')"


EV = f"""ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id // 100 AS batch_id,
         {plate('user_id')} AS car_plate,
         CAST(1 + event_id % 3 AS INTEGER) AS camera_id, ts, value AS speed_reading,
         '{PRODUCER_PREFIX}' || substr('abc', CAST(1 + event_id % 3 AS INTEGER), 1) AS producer_id
  FROM events)"""

VE = f"""ve AS (
  SELECT {plate('c_custkey')} AS car_plate, c_name AS owner_name,
         n_name AS owner_addr,
         (['Coupe', 'SUV', 'Sedan', 'Van', 'Truck', 'Motorcycle'])[1 + c_custkey % 6] AS vehicle_type
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _cam(rows, name="cam") -> str:
    values = ", ".join(
        f"(CAST({c} AS INTEGER), {lat}::DOUBLE, {lon}::DOUBLE, {km}::DOUBLE, {limit}::BIGINT)"
        for c, lat, lon, km, limit in rows
    )
    return f"{name}(camera_id, latitude, longitude, position, speed_limit) AS (VALUES {values})"


EN = """en AS (
  SELECT ev.*, cam.speed_limit, cam.position FROM ev LEFT JOIN cam ON ev.camera_id = cam.camera_id)"""


def _pairs(tolerance: int, km: str = "position", more: str = "") -> str:
    sec = "epoch(date_trunc('second', {}.ts))::BIGINT"
    elapsed = f"({sec.format('b')} - {sec.format('a')})"
    return f"""pairs AS (
  SELECT a.car_plate, a.event_id AS event_id_start, b.event_id AS event_id_end,
         a.camera_id AS camera_id_start, b.camera_id AS camera_id_end,
         a.ts AS ts_start, b.ts AS ts_end, b.speed_limit AS speed_limit_end,
         abs(b.{km} - a.{km})::DOUBLE AS distance_km, {elapsed} AS dt
  FROM en a JOIN en b ON a.car_plate = b.car_plate AND a.{km} < b.{km}
   AND b.ts > a.ts AND {elapsed} <= {tolerance}{more})"""


INSTANT = """instant AS (
  SELECT car_plate, strftime(ts, '%Y-%m-%d') AS violation_date, 'speed' AS violation_type,
         speed_limit, camera_id, ts, speed_reading AS speed
  FROM en WHERE speed_reading > speed_limit)"""

AVERAGE = """average AS (
  SELECT * FROM (
    SELECT car_plate, strftime(ts_end, '%Y-%m-%d') AS violation_date,
           'average_speed' AS violation_type, speed_limit_end AS speed_limit, camera_id_start,
           camera_id_end, ts_start, ts_end,
           distance_km / (nullif(dt, 0) / 3600.0::DOUBLE) AS avg_speed
    FROM pairs) WHERE avg_speed > speed_limit)"""

VIO = """vio AS (
  SELECT car_plate, violation_date, violation_type, speed_limit, camera_id, epoch_us(ts) AS ts_us,
         speed, NULL::INTEGER AS camera_id_start, NULL::INTEGER AS camera_id_end,
         NULL::BIGINT AS start_us, NULL::BIGINT AS end_us, NULL::DOUBLE AS avg_speed
  FROM instant
  UNION ALL
  SELECT car_plate, violation_date, violation_type, speed_limit, NULL, NULL, NULL,
         camera_id_start, camera_id_end, epoch_us(ts_start), epoch_us(ts_end), avg_speed
  FROM average)"""

TL = """tl AS (
  SELECT violation_type, speed_limit, car_plate, violation_date,
         coalesce(ts_us, start_us) AS arrival_us, coalesce(speed, avg_speed) AS speed_val,
         CAST(coalesce(ts_us, end_us) // 3600000000 % 24 AS INTEGER) AS slice FROM vio)"""

PM = """pm AS (
  SELECT strftime(make_timestamp(arrival_us // 60000000 * 60000000), '%Y-%m-%d %H:%M') AS minute,
         count(*) AS n FROM tl GROUP BY 1)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


LONG_EN = (EV, _cam(LONG_CORRIDOR), EN)
LONG_PAIRS = (*LONG_EN, _pairs(LONG_TOLERANCE_S))
LONG_VIO = (*LONG_PAIRS, INSTANT, AVERAGE, VIO)

EVENT_COLUMNS = (
    "event_id, batch_id, car_plate, camera_id, epoch_us(ts) AS ts_us, speed_reading, producer_id"
)
PAIR_COLUMNS = (
    "car_plate, event_id_start, event_id_end, camera_id_start, camera_id_end,"
    " epoch_us(ts_start) AS start_us, epoch_us(ts_end) AS end_us, speed_limit_end, distance_km"
)
AVERAGE_COLUMNS = (
    "car_plate, violation_date, violation_type, speed_limit, camera_id_start, camera_id_end,"
    " epoch_us(ts_start) AS start_us, epoch_us(ts_end) AS end_us, avg_speed"
)
DOCUMENTS = """SELECT car_plate, violation_date, slice, count(*) AS n,
  count(*) FILTER (violation_type = 'speed') AS n_speed,
  count(*) FILTER (violation_type <> 'speed') AS n_avg,
  max(speed_val) AS top_speed, min(arrival_us) AS first_us
FROM tl GROUP BY car_plate, violation_date, slice"""

ARC = """2 * 6371.0088 * asin(sqrt(
  pow(sin((radians(b.latitude) - radians(a.latitude)) / 2), 2)
  + cos(radians(a.latitude)) * cos(radians(b.latitude))
  * pow(sin((radians(b.longitude) - radians(a.longitude)) / 2), 2)))"""

WAVE = f"""w AS (
  SELECT *, (batch_id - min(batch_id) OVER ()) * {WAVES}
    // (max(batch_id) OVER () - min(batch_id) OVER () + 1) AS wave FROM ev)"""

# Camera 3 comes a wave late. Before a wave the watermark stands at the latest time of all
# earlier waves less the delay, in whole milliseconds; the join takes only what is after it.
LATE_EN = f"""en AS (
  SELECT en0.*, ts > coalesce(make_timestamp(mark.ms * 1000), TIMESTAMP '1970-01-01') AS timely
  FROM (SELECT d.*, cam.speed_limit, cam.position
        FROM (SELECT * EXCLUDE wave, wave + CASE WHEN camera_id = 3 THEN 1 ELSE 0 END AS arrival
              FROM w) d LEFT JOIN cam ON d.camera_id = cam.camera_id) en0
  LEFT JOIN (SELECT n.arrival, max(epoch_ms(o.ts)) - {WATERMARK_S * 1000} AS ms
             FROM (SELECT range AS arrival FROM range({WAVES + 1})) n
             JOIN (SELECT ts, wave + CASE WHEN camera_id = 3 THEN 1 ELSE 0 END AS arrival FROM w) o
               ON o.arrival < n.arrival GROUP BY n.arrival) mark
  ON en0.arrival = mark.arrival)"""

# Batches whose messages are damaged so that a passage lacks a field, in the order of the checks;
# a reading that cannot be read makes no violation.
DAMAGED_EN = """en AS (
  SELECT * REPLACE (CASE WHEN batch_id % 10 = 4 THEN NULL ELSE speed_reading END AS speed_reading)
  FROM late WHERE batch_id % 10 NOT IN (1, 2, 3, 5))"""

# Lateness is judged by the passages that can be used.
DAMAGED_LATE = LATE_EN.replace("en AS (", "late AS (", 1).replace(
    "FROM w) o", "FROM w WHERE batch_id % 10 NOT IN (1, 2, 3, 5)) o"
)

ORACLE: dict[str, str] = {
    "camera_dim": _with(EV, _cam(CAMERAS))
    + """SELECT cam.camera_id, latitude, longitude, position, CAST(speed_limit AS INTEGER) AS speed_limit,
           (SELECT count(*) FROM ev WHERE ev.camera_id = cam.camera_id) AS n_events FROM cam""",
    "camera_pair_distance": _with(EV, _cam(CAMERAS))
    + f"""SELECT a.camera_id AS camera_id_start, b.camera_id AS camera_id_end,
           abs(b.position - a.position) AS road_km, round({ARC}, 6) AS straight_km
         FROM cam a JOIN cam b ON a.position < b.position
         WHERE a.camera_id IN (SELECT camera_id FROM ev) AND b.camera_id IN (SELECT camera_id FROM ev)""",
    "vehicle_dim_check": """WITH r AS (
  SELECT """
    + plate("c_custkey - CASE WHEN c_custkey % 10 = 9 THEN 1 ELSE 0 END")
    + """ AS car_plate,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Bus' ELSE 'Van' END AS vehicle_type FROM customer)
SELECT car_plate, 'duplicate_plate' AS issue, count(*) AS n_rows FROM r GROUP BY 1 HAVING count(*) > 1
UNION ALL
SELECT car_plate, 'unknown_type', count(*) FROM r
WHERE vehicle_type NOT IN ('Coupe', 'SUV', 'Sedan', 'Van', 'Truck', 'Motorcycle') GROUP BY 1""",
    "csv_event_scan": _with(EV) + f"SELECT {EVENT_COLUMNS} FROM ev",
    "kafka_encode": _with(EV)
    + f"""SELECT car_plate AS key, '{CAMERA_TOPIC_PREFIX}' || CAST(camera_id AS VARCHAR) AS topic,
           event_id, batch_id, camera_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
           speed_reading, producer_id, '2024-01-01T00:00:00.000000Z' AS ingested FROM ev""",
    "json_decode": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "message_decode": _with(EV)
    + f"""SELECT car_plate AS kafka_key, {EVENT_COLUMNS},
           epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS ingested_us FROM ev""",
    "event_quality_filter": _with(EV)
    + """SELECT event_id, batch_id, car_plate, camera_id, epoch_us(ts) AS ts_us,
           CASE WHEN batch_id % 10 <> 4 THEN speed_reading END AS speed_reading, producer_id
         FROM ev WHERE batch_id % 10 NOT IN (1, 2, 3, 5)""",
    "event_quarantine": _with(EV)
    + """SELECT CASE WHEN batch_id % 10 IN (2, 5) THEN 'car_plate'
                WHEN batch_id % 10 = 1 THEN 'camera_id' ELSE 'timestamp' END AS missing,
           count(*) AS n_events
         FROM ev WHERE batch_id % 10 IN (1, 2, 3, 5) GROUP BY 1""",
    "batch_groups": _with(EV)
    + """SELECT batch_id, epoch_us(ts) // 3600000000 AS slice, count(*) AS n_events,
           min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us,
           max(speed_reading) AS top_speed, count(DISTINCT car_plate) AS n_plates
         FROM ev GROUP BY ALL""",
    "ingest_metrics": _with(EV)
    + """SELECT count(*) AS n_events, count(DISTINCT batch_id) AS n_batches,
           max(batch_id) AS last_batch FROM ev""",
    "producer_trace": _with(EV)
    + """SELECT producer_id, count(*) AS n_events, min(epoch_us(ts)) AS first_us,
           max(epoch_us(ts)) AS last_us, max(speed_reading) AS top_speed FROM ev GROUP BY 1""",
    "speed_limit_enrich": _with(EV, _cam(CAMERAS[:2]), EN)
    + "SELECT event_id, camera_id, speed_reading, speed_limit, position AS road_km FROM en",
    "instant_violations": _with(*LONG_EN, INSTANT)
    + """SELECT car_plate, violation_date, violation_type, speed_limit, camera_id,
           epoch_us(ts) AS ts_us, speed FROM instant""",
    "segment_pairs": _with(*LONG_PAIRS) + f"SELECT {PAIR_COLUMNS} FROM pairs",
    "segment_pairs_split": _with(*LONG_PAIRS) + f"SELECT {PAIR_COLUMNS} FROM pairs",
    "segment_pairs_shipped": _with(EV, _cam(CAMERAS), EN, _pairs(SHIPPED_TOLERANCE_S))
    + f"SELECT {PAIR_COLUMNS} FROM pairs",
    "segment_pairs_by_id": _with(
        EV, _cam(CAMERAS[:2]), EN, _pairs(SHIPPED_TOLERANCE_S, km="camera_id")
    )
    + f"SELECT {PAIR_COLUMNS} FROM pairs",
    "average_violations": _with(*LONG_PAIRS, AVERAGE) + f"SELECT {AVERAGE_COLUMNS} FROM average",
    "average_violations_shipped": _with(
        EV, _cam(CAMERAS), EN, _pairs(SHIPPED_TOLERANCE_S), AVERAGE
    )
    + f"SELECT {AVERAGE_COLUMNS} FROM average",
    "violation_union": _with(*LONG_VIO) + "SELECT * FROM vio",
    "daily_merge": _with(*LONG_VIO, TL) + DOCUMENTS,
    "violation_flatten": _with(*LONG_VIO, TL) + "SELECT * EXCLUDE slice FROM tl",
    "violations_per_minute": _with(*LONG_VIO, TL, PM) + "SELECT * FROM pm",
    "peak_minute": _with(*LONG_VIO, TL, PM)
    + "SELECT * FROM pm ORDER BY n DESC, minute LIMIT 1",
    "speed_series": _with(*LONG_VIO, TL)
    + """SELECT violation_type AS series, arrival_us, speed_val FROM tl
         UNION ALL SELECT DISTINCT 'limit', NULL::BIGINT, speed_limit::DOUBLE FROM cam""",
    "enforcement_report": _with(*LONG_VIO, VE, _cam(CAMERAS, "site"))
    + """SELECT vio.car_plate, violation_date, violation_type, owner_name, owner_addr, vehicle_type,
           coalesce(vio.camera_id, camera_id_start) AS camera_start,
           coalesce(vio.camera_id, camera_id_end) AS camera_end,
           s.latitude AS latitude_start, e.longitude AS longitude_end, e.position AS position_end,
           coalesce(speed, avg_speed) AS speed_val
         FROM vio LEFT JOIN ve ON vio.car_plate = ve.car_plate
         LEFT JOIN site s ON s.camera_id = coalesce(vio.camera_id, camera_id_start)
         LEFT JOIN site e ON e.camera_id = coalesce(vio.camera_id, camera_id_end)""",
    "hotspots_within_radius": _with(*LONG_VIO, _cam(CAMERAS, "site"))
    + f"""SELECT b.camera_id, round({ARC}, 6) AS distance_km, count(*) AS n_violations
         FROM site a JOIN site b ON a.camera_id = 1
         JOIN vio ON b.camera_id = coalesce(vio.camera_id, camera_id_end)
         WHERE {ARC} <= 1.5 GROUP BY 1, 2""",
    "hotspots_around_points": _with(*LONG_VIO, _cam(CAMERAS, "site"))
    + f"""SELECT a.centre_id, b.camera_id, round({ARC}, 6) AS distance_km, n AS n_violations
         FROM (SELECT c_custkey AS centre_id,
                 {CAMERAS[0][1]}::DOUBLE + (c_custkey % 400 - 100) / 10000.0::DOUBLE AS latitude,
                 {CAMERAS[0][2]}::DOUBLE - (c_custkey % 400 - 100) / 10000.0::DOUBLE AS longitude
               FROM customer) a, site b
         JOIN (SELECT coalesce(camera_id, camera_id_end) AS camera_id, count(*) AS n
               FROM vio GROUP BY 1) v ON v.camera_id = b.camera_id
         WHERE {ARC} <= 1.2""",
    "sink_insert_if_absent": _with(*LONG_VIO) + "SELECT * FROM vio",
    "sink_metrics": _with(*LONG_VIO)
    + """SELECT n AS received, n AS prepared, CASE WHEN epoch = 0 THEN n ELSE 0 END AS inserted,
           CASE WHEN epoch = 0 THEN 0 ELSE n END AS already_stored, epoch
         FROM (SELECT count(*) AS n FROM vio), (SELECT range AS epoch FROM range(2))""",
    "violation_fact_scan": _with(*LONG_VIO) + "SELECT * FROM vio",
    "vehicle_day_lookup": _with(*LONG_VIO)
    + f"SELECT * FROM vio WHERE car_plate = '{LOOKUP_PLATE}' AND violation_date = '{LOOKUP_DAY}'",
    "plate_lookup": _with(*LONG_VIO) + f"SELECT * FROM vio WHERE car_plate = '{LOOKUP_PLATE}'",
    "stored_series": _with(*LONG_VIO, TL, PM) + "SELECT * FROM pm",
    "violation_preview": _with(*LONG_VIO)
    + """SELECT * FROM vio ORDER BY violation_date, coalesce(ts_us, end_us), car_plate,
           violation_type, camera_id NULLS FIRST, ts_us NULLS FIRST, speed NULLS FIRST,
           camera_id_start NULLS FIRST, camera_id_end NULLS FIRST, start_us NULLS FIRST LIMIT 20""",
    "stream_decode": _with(EV) + f"SELECT car_plate AS kafka_key, {EVENT_COLUMNS} FROM ev",
    "stream_replay": _with(EV, WAVE)
    + "SELECT batch_id, count(*) AS n_events, wave FROM w GROUP BY batch_id, wave",
    "stream_segment_join": _with(*LONG_PAIRS) + f"SELECT {PAIR_COLUMNS} FROM pairs",
    "stream_violations": _with(*LONG_VIO) + "SELECT * FROM vio",
    "stream_late_data": _with(
        EV,
        WAVE,
        _cam(LONG_CORRIDOR),
        LATE_EN,
        _pairs(LONG_TOLERANCE_S, more=" AND a.timely AND b.timely"),
        INSTANT,
        AVERAGE,
        VIO,
    )
    + "SELECT * FROM vio",
    "stream_hot_plates": _with(*LONG_VIO) + "SELECT * FROM vio",
    "stream_counts": _with(
        EV,
        WAVE,
        _cam(LONG_CORRIDOR),
        DAMAGED_LATE,
        DAMAGED_EN,
        _pairs(LONG_TOLERANCE_S, more=" AND a.timely AND b.timely").replace(
            "AS dt", "AS dt, greatest(a.arrival, b.arrival) AS arrival"
        ),
        """taken AS (
  SELECT arrival FROM en WHERE speed_reading > speed_limit
  UNION ALL
  SELECT arrival FROM pairs WHERE distance_km / (nullif(dt, 0) / 3600.0::DOUBLE) > speed_limit_end)""",
    )
    + """SELECT wave, decoded, no_car_plate, no_camera_id, no_timestamp,
           CAST(coalesce(late, 0) AS BIGINT) AS late, coalesce(n, 0) AS received,
           coalesce(n, 0) AS inserted
         FROM (SELECT arrival AS wave, count(*) AS decoded,
                 count(*) FILTER (batch_id % 10 IN (2, 5)) AS no_car_plate,
                 count(*) FILTER (batch_id % 10 = 1) AS no_camera_id,
                 count(*) FILTER (batch_id % 10 = 3) AS no_timestamp
               FROM late GROUP BY 1)
         LEFT JOIN (SELECT arrival AS wave, sum(CASE WHEN camera_id = 2 THEN 2 ELSE 1 END) AS late
                    FROM en WHERE NOT timely GROUP BY 1) USING (wave)
         LEFT JOIN (SELECT arrival AS wave, count(*) AS n FROM taken GROUP BY 1) USING (wave)""",
    "daily_doc_upsert": _with(*LONG_VIO, TL) + DOCUMENTS,
}
