"""DuckDB SQL for the registered queries, written from the definitions.

Shared parts are named common table expressions; a query takes those it needs.
"""

from __future__ import annotations

from checks.queries import (
    BOOSTED_STEP,
    BOOSTED_TREES,
    LANDING_STREAM_MONTH,
    MONTH,
    SEED,
    STREAM_DAY,
    STREAM_MONTH,
    TEST_DAY,
    YEAR,
)

def _bucket(purpose: str, seed: int = SEED) -> str:
    text = f"'{purpose}|{seed}|' || event_id"
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) % 1000000"


HASH, FOLD_HASH = _bucket("sample"), _bucket("fold of 5")


def _file_events(unit: str) -> str:
    width, wrong = (7, "2023-12") if unit == "month" else (10, "2023-12-31")
    return f"""
file_events AS (
  SELECT event_id, k % 5 AS vendor_id, ts AS pickup_datetime,
    ts + to_seconds(CAST(floor(value * 60) AS BIGINT) - 30) AS dropoff_datetime,
    CASE WHEN k % 10 = 9 THEN NULL ELSE k % 8 END AS passenger_count,
    CASE WHEN k % 20 = 0 THEN -1.0::DOUBLE ELSE k / 10.0::DOUBLE END AS trip_distance,
    1 + k % 7 AS rate_code_id,
    CASE WHEN k % 2 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    user_id % 30 AS pickup_location_id,
    (user_id * 7 + event_id) % 30 AS dropoff_location_id,
    CASE event_type WHEN 'click' THEN 1::BIGINT WHEN 'view' THEN 2
         WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END AS payment_type,
    value AS fare_amount,
    (k % 4) / 2.0::DOUBLE AS extra,
    NULL::DOUBLE AS mta_tax,
    CASE WHEN k % 6 <> 0 THEN k / 4.0::DOUBLE END AS tip_amount,
    CASE WHEN k % 9 = 0 THEN 6.55::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
    NULL::DOUBLE AS improvement_surcharge,
    CASE WHEN k % 13 = 0 THEN NULL ELSE value END AS total_amount,
    NULL::DOUBLE AS congestion_surcharge,
    CASE WHEN user_id % 30 = 1 THEN 1.25::DOUBLE END AS airport_fee,
    NULL::DOUBLE AS cbd_congestion_fee,
    CASE WHEN k = 7 THEN '{wrong}' ELSE substr(strftime(ts, '%Y-%m-%d'), 1, {width}) END
      AS source_year_month,
    CAST(event_id % 3 AS BIGINT) AS kafka_partition,
    event_id // 3 AS kafka_offset,
    ts AS kafka_timestamp
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""


CANONICAL = """vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
  rate_code_id, store_and_fwd_flag, pickup_location_id, dropoff_location_id, payment_type,
  fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
  congestion_surcharge, airport_fee, cbd_congestion_fee"""

#: The fields of a message as its JSON names them.
PAYLOAD_FIELDS = """vendor_id AS "VendorID", pickup_datetime AS tpep_pickup_datetime,
  dropoff_datetime AS tpep_dropoff_datetime, passenger_count::DOUBLE AS passenger_count,
  trip_distance, rate_code_id AS "RatecodeID", store_and_fwd_flag,
  pickup_location_id AS "PULocationID", dropoff_location_id AS "DOLocationID", payment_type,
  fare_amount, extra, tip_amount, tolls_amount, total_amount, airport_fee"""

CONTROL_ROW = """
control_row AS (
  SELECT max(source_year_month) AS last_period, count(*) AS rows_sent,
    max(kafka_offset) FILTER (WHERE kafka_partition = 0) + 1 AS kafka_offset,
    max(kafka_timestamp) AS kafka_timestamp
  FROM file_events
)"""

FILE_ORDERS = """
file_orders AS (
  SELECT l_orderkey, l_linenumber, l_suppkey % 3 AS vendor_id,
    o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
    CAST(l_linenumber % 7 AS BIGINT) AS passenger_count,
    l_quantity AS trip_distance, CAST(l_linenumber AS BIGINT) AS rate_code_id,
    NULL::VARCHAR AS store_and_fwd_flag,
    CAST(c_nationkey AS BIGINT) AS pickup_location_id,
    CAST(s_nationkey AS BIGINT) AS dropoff_location_id,
    CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
    l_extendedprice AS fare_amount, l_discount AS extra, NULL::DOUBLE AS mta_tax,
    l_tax AS tip_amount, NULL::DOUBLE AS tolls_amount,
    NULL::DOUBLE AS improvement_surcharge, o_totalprice AS total_amount,
    NULL::DOUBLE AS congestion_surcharge, NULL::DOUBLE AS airport_fee,
    NULL::DOUBLE AS cbd_congestion_fee,
    strftime(o_orderdate, '%Y-%m') AS source_year_month,
    CASE WHEN l_linenumber = 7 THEN 'misc-7.parquet'
         ELSE 'trips_' || strftime(o_orderdate + INTERVAL 20 YEAR, '%Y-%m') || '_'
              || l_linenumber || '.parquet' END AS file_name
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

STREAM_CANONICAL = f"""
stream_rows AS (
  SELECT {CANONICAL}, 'streaming' AS ingestion_source, source_year_month,
    kafka_partition, kafka_offset, kafka_timestamp
  FROM file_events
)"""

UNIFIED = f"""
unified AS (
  SELECT {CANONICAL}, 'batch' AS ingestion_source, source_year_month,
    NULL::BIGINT AS kafka_partition, NULL::BIGINT AS kafka_offset,
    NULL::TIMESTAMP AS kafka_timestamp
  FROM file_orders
  UNION ALL
  SELECT * FROM stream_rows
)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone,
    'service-' || (n_regionkey % 2) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def _kept(source: str, unit: str) -> str:
    pattern = "%Y-%m" if unit == "month" else "%Y-%m-%d"
    return f"""
kept AS (
  SELECT * FROM {source}
  WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
    AND strftime(pickup_datetime, '{pattern}') = source_year_month
    AND dropoff_datetime > pickup_datetime
    AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
    AND (trip_distance IS NULL OR trip_distance >= 0)
    AND (passenger_count IS NULL OR passenger_count >= 0)
)"""


CALENDAR = """
    (epoch(date_trunc('second', dropoff_datetime))
      - epoch(date_trunc('second', pickup_datetime)))::BIGINT / 60.0::DOUBLE
      AS trip_duration_minutes,
    CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
    strftime(pickup_datetime, '%m') AS pickup_month,
    CAST(day(pickup_datetime) AS INTEGER) AS pickup_day,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    dayname(pickup_datetime) AS pickup_day_of_week"""

ZONE_PAIR = """p.zone AS pickup_zone, p.borough AS pickup_borough,
    p.service_zone AS pickup_service_zone,
    d.zone AS dropoff_zone, d.borough AS dropoff_borough,
    d.service_zone AS dropoff_service_zone"""

TRIPS = f"""
trips AS (
  SELECT kept.*, {ZONE_PAIR}, {CALENDAR}
  FROM kept
  LEFT JOIN zones p ON pickup_location_id = p.location_id
  LEFT JOIN zones d ON dropoff_location_id = d.location_id
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _events(select: str, unit: str = "month", *more: str) -> str:
    return _with(_file_events(unit), STREAM_CANONICAL, *more, select=select)


def _trips(select: str, *more: str) -> str:
    """Over the trip table of both sources."""
    return _with(
        _file_events("month"), STREAM_CANONICAL, FILE_ORDERS, UNIFIED, ZONES,
        _kept("unified", "month"), TRIPS, *more, select=select,
    )


def _day_trips(select: str, *more: str) -> str:
    """Over the event trips with a day as their period."""
    return _with(
        _file_events("day"), STREAM_CANONICAL, ZONES, _kept("stream_rows", "day"), TRIPS,
        *more, select=select,
    )


def _exact_avg(column: str, name: str, scale: int = 4) -> str:
    return (
        f"CAST(sum(CAST({column} AS DECIMAL(18,{scale}))) AS DOUBLE) / count({column}) AS {name}"
    )


METRICS = f"""count(*) AS trip_count,
  CAST(sum(CAST(coalesce(total_amount, 0) AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue,
  {_exact_avg("total_amount", "avg_total_amount")},
  {_exact_avg("fare_amount", "avg_fare_amount")},
  {_exact_avg("tip_amount", "avg_tip_amount")},
  {_exact_avg("trip_distance", "avg_trip_distance")},
  sum(CAST(round(trip_duration_minutes * 60) AS BIGINT)) / 60.0::DOUBLE
    / count(trip_duration_minutes) AS avg_trip_duration_minutes,
  CAST(sum(passenger_count) AS DOUBLE) / count(passenger_count) AS avg_passenger_count"""


def _grouped(keys: str, extra: str = "", where: str = "") -> str:
    extra = f", {extra}" if extra else ""
    return f"SELECT {keys}{extra}, {METRICS} FROM trips {where} GROUP BY {keys}"


DAILY = _grouped(
    "pickup_date, pickup_year, pickup_month, pickup_day_of_week",
    "CAST(dayofweek(pickup_date) + 1 AS INTEGER) AS day_of_week_number",
)
HOURLY = _grouped(
    "pickup_year, pickup_month, pickup_day_of_week, pickup_hour",
    """CAST(CASE pickup_day_of_week WHEN 'Sunday' THEN 1 WHEN 'Monday' THEN 2
       WHEN 'Tuesday' THEN 3 WHEN 'Wednesday' THEN 4 WHEN 'Thursday' THEN 5
       WHEN 'Friday' THEN 6 WHEN 'Saturday' THEN 7 END AS INTEGER) AS day_of_week_number""",
)
ZONE_KEYS = (
    "pickup_year, pickup_month, pickup_location_id, pickup_zone, pickup_borough, "
    "pickup_service_zone"
)
SHOWN_MONTH = f"WHERE pickup_year = {YEAR} AND CAST(pickup_month AS INTEGER) = {MONTH}"
ZONE_MONTHLY = _grouped(ZONE_KEYS)
PAYMENT = _grouped("pickup_year, pickup_month, payment_type")

GOLD = (
    f"daily AS ({DAILY})", f"hourly AS ({HOURLY})", f"zone_rows AS ({ZONE_MONTHLY})",
    f"payments AS ({PAYMENT})",
)
PROFILE = "profile AS (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS row_count,
      count(DISTINCT (pickup_year, CAST(pickup_month AS INTEGER))) AS periods,
      CAST(sum(trip_count) AS BIGINT) AS trip_sum FROM {cte}"""
    for name, cte in (
        ("daily_summary", "daily"), ("hourly_demand", "hourly"),
        ("pickup_zone_monthly", "zone_rows"), ("payment_monthly", "payments"),
    )
) + ")"
RECONCILED = """reconciled AS (
  SELECT profile.*, w.expected_rows, w.expected_periods,
    trip_sum = expected_rows AS trips_ok, periods = expected_periods AS periods_ok
  FROM profile, (SELECT count(*) AS expected_rows,
    count(DISTINCT (pickup_year, pickup_month)) AS expected_periods FROM trips) w)"""

ZONE_TOTALS = """SELECT pickup_location_id, pickup_zone, pickup_borough,
  CAST(sum(trip_count) AS BIGINT) AS trip_count,
  CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue,
  avg(avg_trip_duration_minutes) AS avg_trip_duration_minutes,
  avg(avg_trip_distance) AS avg_trip_distance, avg(avg_tip_amount) AS avg_tip_amount
  FROM zone_rows GROUP BY pickup_location_id, pickup_zone, pickup_borough"""
SHOWN_ZONES = (
    "zone_rows AS (" + _grouped(ZONE_KEYS, where=SHOWN_MONTH) + ")",
    f"totals AS ({ZONE_TOTALS})",
)

EVENT_KEY = "kafka_offset * 3 + kafka_partition AS event_id"

WEEKDAY_FROM_MONDAY = """CAST(CASE pickup_day_of_week WHEN 'Monday' THEN 1
  WHEN 'Tuesday' THEN 2 WHEN 'Wednesday' THEN 3 WHEN 'Thursday' THEN 4 WHEN 'Friday' THEN 5
  WHEN 'Saturday' THEN 6 WHEN 'Sunday' THEN 7 END AS INTEGER)"""

ENGINEERED = """
  CAST(pickup_day_of_week_num IN (6, 7) AS INTEGER) AS is_weekend,
  CAST(pickup_hour IN (7, 8, 9, 16, 17, 18, 19) AS INTEGER) AS is_rush_hour,
  round(sin(2 * pi() * pickup_hour / 24), 9) AS pickup_hour_sin,
  round(cos(2 * pi() * pickup_hour / 24), 9) AS pickup_hour_cos,
  round(sin(2 * pi() * (pickup_month - 1) / 12), 9) AS pickup_month_sin,
  round(cos(2 * pi() * (pickup_month - 1) / 12), 9) AS pickup_month_cos"""

MODEL_ROWS = f"""model_rows AS (
  SELECT {EVENT_KEY}, pickup_location_id, dropoff_location_id, passenger_count, trip_distance,
    rate_code_id, pickup_hour, {WEEKDAY_FROM_MONDAY} AS pickup_day_of_week_num,
    CAST(pickup_month AS INTEGER) AS pickup_month, trip_duration_minutes, source_year_month
  FROM trips
  WHERE trip_duration_minutes BETWEEN 1.0 AND 180.0 AND trip_distance BETWEEN 0.1 AND 100.0
    AND passenger_count BETWEEN 1 AND 6 AND pickup_location_id BETWEEN 1 AND 265
    AND dropoff_location_id BETWEEN 1 AND 265 AND rate_code_id BETWEEN 1 AND 6
    AND pickup_hour BETWEEN 0 AND 23 AND CAST(pickup_month AS INTEGER) BETWEEN 1 AND 12
)"""
FEATURES = f"""features AS (
  SELECT event_id, CAST(pickup_location_id AS INTEGER) AS pickup_location_id,
    CAST(dropoff_location_id AS INTEGER) AS dropoff_location_id,
    CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
    CAST(rate_code_id AS INTEGER) AS rate_code_id, pickup_hour, pickup_day_of_week_num,
    pickup_month, {ENGINEERED}, trip_duration_minutes AS label, source_year_month
  FROM model_rows
)"""
TRAIN_TEST = (
    f"train AS (SELECT * FROM features WHERE source_year_month < '{TEST_DAY}')",
    f"test AS (SELECT * FROM features WHERE source_year_month = '{TEST_DAY}')",
)
CATEGORIES = (
    "pickup_location_id", "dropoff_location_id", "rate_code_id", "pickup_day_of_week_num",
)


def _features(select: str, *more: str) -> str:
    return _day_trips(select, MODEL_ROWS, FEATURES, *more)


def _encoded_value(column: str) -> str:
    s = f"{column}_stats"
    weight = f"({s}.n * g.variance / ({s}.n * g.variance + {s}.inside))"
    return f"""round(coalesce({weight} * {s}.mean + (1 - {weight}) * g.mean, g.mean), 6)
      AS {column}_te"""


def _encoding(learn_from: str, apply_to: str, condition: str, extra: str) -> str:
    """Encode ``apply_to`` from the rows of ``learn_from`` that each part may see."""
    stats = [
        f"""{c}_stats AS (SELECT seen_by, {c}, count(*) AS n, avg(label) AS mean,
        var_pop(label) AS inside FROM seen GROUP BY seen_by, {c})"""
        for c in CATEGORIES
    ]
    values = ", ".join(_encoded_value(c) for c in CATEGORIES)
    joins = " ".join(
        f"LEFT JOIN {c}_stats ON {c}_stats.seen_by = a.part AND {c}_stats.{c} = a.{c}"
        for c in CATEGORIES
    )
    setup = (
        f"folded AS (SELECT *, CAST(floor(({FOLD_HASH}) * 5 / 1000000.0) AS INTEGER) AS part "
        "FROM features)",
        "tested AS (SELECT *, 0 AS part FROM test)",
        "trained AS (SELECT *, 0 AS part FROM train)",
        f"""seen AS (SELECT o.part AS seen_by, t.*
        FROM (SELECT DISTINCT part FROM {apply_to}) o JOIN {learn_from} t ON {condition})""",
        "g AS (SELECT seen_by, avg(label) AS mean, var_pop(label) AS variance "
        "FROM seen GROUP BY seen_by)",
    )
    select = f"""SELECT a.event_id{extra}, {values} FROM {apply_to} a
        JOIN g ON g.seen_by = a.part {joins}"""
    return _features(select, *TRAIN_TEST, *setup, *stats)


def _row_hash(columns: dict[str, str]) -> str:
    texts = ", ".join(
        f"coalesce('{name}=' || length({columns[name]}) || ':' || {columns[name]}, '{name}~')"
        for name in sorted(columns)
    )
    return f"CAST('0x' || substr(md5(concat_ws('|', {texts})), 1, 15) AS BIGINT)"


def _double_text(name: str) -> str:
    first = f"(({name} - floor({name})) * 1e9::DOUBLE)"
    second = f"(({first} - floor({first})) * 1e9::DOUBLE)"
    parts = [f"CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR)" for x in (name, first, second)]
    return " || '+' || ".join(parts)


def _time_text(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"


def _text(name: str) -> str:
    return f"CAST({name} AS VARCHAR)"


#: Columns of the order files as text.
ORDER_TEXTS = {
    "l_orderkey": _text("l_orderkey"),
    "VendorID": _text("vendor_id"),
    "tpep_pickup_datetime": _time_text("pickup_datetime"),
    "tpep_dropoff_datetime": _time_text("dropoff_datetime"),
    "passenger_count": _text("passenger_count"),
    "trip_distance": _double_text("trip_distance"),
    "RatecodeID": _text("rate_code_id"),
    "PULocationID": _text("pickup_location_id"),
    "DOLocationID": _text("dropoff_location_id"),
    "payment_type": _text("payment_type"),
    "fare_amount": _double_text("fare_amount"),
    "extra": _double_text("extra"),
    "tip_amount": _double_text("tip_amount"),
    "total_amount": _double_text("total_amount"),
    "source_period": "source_year_month",
    "file_name": "file_name",
}


#: The label that models can learn; see the query.
FARES = "3.0::DOUBLE + 2.5::DOUBLE * trip_distance + 0.2::DOUBLE * pickup_hour"


def _best_split(name: str, source: str) -> str:
    """For each ``side`` of rows the split of trip_distance or pickup_hour that leaves
    the least variance of r, halfway between two values, and the means beside it."""
    inputs = " UNION ALL ".join(
        f"SELECT side, '{c}' AS input, {c}::DOUBLE AS value, count(*) AS n, sum(r) AS s "
        f"FROM {source} WHERE learns GROUP BY ALL" for c in ("trip_distance", "pickup_hour")
    )
    return f"""{name}_cells AS ({inputs}),
{name}_run AS (SELECT *, sum(n) OVER up AS nl, sum(s) OVER up AS sl,
    sum(n) OVER every AS nt, sum(s) OVER every AS st, lead(value) OVER up AS beyond
  FROM {name}_cells WINDOW up AS (PARTITION BY side, input ORDER BY value),
    every AS (PARTITION BY side, input)),
{name} AS (SELECT side, input, (value + beyond) / 2 AS threshold, sl / nl AS low,
    (st - sl) / (nt - nl) AS high
  FROM {name}_run WHERE beyond IS NOT NULL QUALIFY row_number() OVER (PARTITION BY side
    ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC) = 1)"""


def _goes_low(rows: str, split: str) -> str:
    value = f"CASE {split}.input WHEN 'trip_distance' THEN {rows}.trip_distance ELSE {rows}.pickup_hour END"
    return f"{value} <= {split}.threshold"


_LEARNING_ROWS = (
    f"""tree_rows_0 AS (SELECT event_id, trip_distance, pickup_hour, learns, 0 AS side,
    {FARES} AS label, 0.0::DOUBLE AS prediction, {FARES} AS r FROM learning)"""
)


def _boosted() -> tuple[str, ...]:
    """Trees of one split, each fitted to what those before leave; ``learning`` has
    the rows, of which those that learn fit the trees."""
    parts = [_LEARNING_ROWS]
    for t in range(BOOSTED_TREES):
        weight = "1.0::DOUBLE" if t == 0 else f"{BOOSTED_STEP}::DOUBLE"
        parts += [
            _best_split(f"split_{t}", f"tree_rows_{t}"),
            f"""tree_rows_{t + 1} AS (SELECT * REPLACE (2 * (label - prediction) AS r) FROM (
    SELECT r.* REPLACE (r.prediction + {weight} * CASE WHEN {_goes_low("r", "s")} THEN s.low
      ELSE s.high END AS prediction) FROM tree_rows_{t} r, split_{t} s))""",
        ]
    return tuple(parts)


_TWO_LEVELS = (
    _LEARNING_ROWS,
    _best_split("top", "tree_rows_0"),
    f"""tree_rows_1 AS (SELECT r.* REPLACE (CASE WHEN {_goes_low("r", "s")} THEN 1 ELSE 2 END
    AS side) FROM tree_rows_0 r, top s)""",
    _best_split("below", "tree_rows_1"),
    f"""tree_values AS (SELECT r.event_id, r.learns, CASE WHEN {_goes_low("r", "s")} THEN s.low
    ELSE s.high END AS prediction FROM tree_rows_1 r JOIN below s ON r.side = s.side)""",
)
_LEARNING = """learning AS (SELECT *, true AS learns FROM train
  UNION ALL SELECT *, false AS learns FROM test)"""


def _scores(select: str) -> str:
    return _day_trips(
        select,
        """guesses AS (
  SELECT fare_amount AS label, unnest([
    {'model': 'by_distance', 'prediction': 20.0::DOUBLE + 2.0::DOUBLE * coalesce(trip_distance, 0)},
    {'model': 'by_duration', 'prediction': 1.0::DOUBLE + 0.9::DOUBLE * trip_duration_minutes},
    {'model': 'mean_baseline', 'prediction': (SELECT avg(fare_amount) FROM trips)}],
    recursive := true)
  FROM trips)""",
        """scores AS (
  SELECT model, round(avg(abs(prediction - label)), 6) AS mae,
    round(sqrt(avg((prediction - label) ** 2)), 6) AS rmse,
    round(1 - sum((prediction - label) ** 2) / (var_pop(label) * count(*)), 6) AS r2
  FROM guesses GROUP BY model)""",
    )


PLANNED = """planned AS (
  SELECT event_id, pickup_location_id, dropoff_location_id, passenger_count, trip_distance,
    rate_code_id, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
    dayname(pickup_datetime) AS pickup_day_of_week
  FROM file_events)"""
CHECKED = """checked AS (
  SELECT *, CASE
    WHEN pickup_location_id IS NULL OR pickup_location_id NOT BETWEEN 1 AND 265
      THEN 'pickup_location_id'
    WHEN dropoff_location_id IS NULL OR dropoff_location_id NOT BETWEEN 1 AND 265
      THEN 'dropoff_location_id'
    WHEN passenger_count IS NULL OR passenger_count NOT BETWEEN 1 AND 6 THEN 'passenger_count'
    WHEN trip_distance IS NULL OR trip_distance NOT BETWEEN 0.1 AND 100 THEN 'trip_distance'
    WHEN rate_code_id IS NULL OR rate_code_id NOT BETWEEN 1 AND 6 THEN 'rate_code_id'
    END AS failed_rule
  FROM planned)"""

TEXT_INDEX = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS {c}_idx"
    for c in CATEGORIES
)

ORACLE = {
    "canonicalize_batch": _events(
        f"""SELECT {CANONICAL}, 'batch' AS ingestion_source, source_year_month,
        NULL::BIGINT AS kafka_partition, NULL::BIGINT AS kafka_offset,
        NULL::TIMESTAMP AS kafka_timestamp FROM file_events"""
    ),
    "json_canonicalize": _events("SELECT * FROM stream_rows"),
    "union_batch_months": _with(
        FILE_ORDERS,
        select=f"""SELECT {CANONICAL.replace(", airport_fee, cbd_congestion_fee", "")},
        CASE WHEN source_year_month >= '1997-01' THEN extra END AS airport_fee,
        CASE WHEN source_year_month >= '1999-01' THEN tip_amount END AS cbd_congestion_fee,
        'batch' AS ingestion_source, source_year_month, NULL::BIGINT AS kafka_partition,
        NULL::BIGINT AS kafka_offset, NULL::TIMESTAMP AS kafka_timestamp FROM file_orders""",
    ),
    "unified_sources": _trips(
        """SELECT ingestion_source, source_year_month, count(*) AS row_count
        FROM unified GROUP BY ALL"""
    ),
    "landing_manifest": _with(
        FILE_ORDERS,
        select=f"""SELECT regexp_extract(file_name, '20[0-9][0-9]-[0-9][0-9]') AS source_period,
        count(*) AS row_count, count(DISTINCT file_name) AS source_files FROM file_orders
        WHERE file_name LIKE 'trips%' AND file_name NOT LIKE 'trips_{LANDING_STREAM_MONTH}%'
        GROUP BY 1""",
    ),
    "zone_lookup": """SELECT CAST(c_nationkey AS BIGINT) AS location_id, borough, zone,
        service_zone FROM (SELECT c_nationkey, c_mktsegment AS borough, c_name AS zone,
          right(c_name, 1) AS service_zone, row_number() OVER (
            PARTITION BY c_nationkey ORDER BY c_mktsegment, c_name) AS rn FROM customer)
        WHERE rn = 1""",
    "silver_month_slice": _trips(f"SELECT * FROM trips {SHOWN_MONTH}"),
    "messages_roundtrip": _events(
        """SELECT source_year_month AS year_month, count(*) + 1 AS message_count,
        1::BIGINT AS eof_count, count(*) AS rows_sent, max(pickup_datetime) AS last_pickup,
        CAST(sum(pickup_location_id) AS BIGINT) AS location_sum
        FROM file_events GROUP BY 1""",
        "day",
    ),
    "stream_decode": _events(
        f"""SELECT source_year_month AS year_month, substr(source_year_month, 1, 4) AS year,
        substr(source_year_month, 6, 2) AS month, 'trips' AS kafka_topic,
        CAST(kafka_partition AS INTEGER) AS kafka_partition, kafka_offset, kafka_timestamp,
        {PAYLOAD_FIELDS}, NULL::BIGINT AS rows_sent FROM file_events
        UNION ALL
        SELECT last_period, substr(last_period, 1, 4), substr(last_period, 6, 2), 'trips', 0,
        kafka_offset, kafka_timestamp, {", ".join(["NULL"] * 16)}, rows_sent FROM control_row""",
        "day",
        CONTROL_ROW,
    ),
    "stream_accept": _events(
        f"""SELECT source_year_month AS year_month, substr(source_year_month, 1, 4) AS year,
        substr(source_year_month, 6, 2) AS month, 'trips' AS kafka_topic,
        CAST(kafka_partition AS INTEGER) AS kafka_partition, kafka_offset, kafka_timestamp,
        {PAYLOAD_FIELDS}, NULL::BIGINT AS rows_sent
        FROM file_events WHERE source_year_month = '{STREAM_DAY}'""",
        "day",
    ),
    "stream_ingest": _events(
        f"""SELECT source_year_month AS year_month,
        CAST(kafka_partition AS INTEGER) AS kafka_partition, count(*) AS row_count,
        min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset
        FROM file_events WHERE source_year_month = '{STREAM_MONTH}' GROUP BY 1, 2"""
    ),
    "offset_audit": _events(
        """SELECT CAST(kafka_partition AS INTEGER) AS kafka_partition, count(*) AS row_count,
        min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset,
        max(kafka_offset) - min(kafka_offset) + 1 - count(DISTINCT kafka_offset) AS gaps,
        count(*) - count(DISTINCT kafka_offset) AS duplicates FROM file_events GROUP BY 1"""
    ),
    "offset_audit_replayed": _events(
        """SELECT CAST(kafka_partition AS INTEGER) AS kafka_partition, count(*) AS row_count,
        min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset,
        max(kafka_offset) - min(kafka_offset) + 1 - count(DISTINCT kafka_offset) AS gaps,
        count(*) - count(DISTINCT kafka_offset) AS duplicates
        FROM (SELECT * FROM file_events WHERE payment_type IS NOT NULL
              UNION ALL SELECT * FROM file_events WHERE payment_type = 3) GROUP BY 1"""
    ),
    "stream_completion": """SELECT step, count(*) AS stored_rows, count(*) AS expected_rows,
        count(*) + 1 AS expected_messages, count(*) - count(DISTINCT event_id) AS duplicates,
        count(*) + 1 AS end_offset, step = 'restarted' AS committed,
        CASE step WHEN 'restarted' THEN 'complete' ELSE 'incomplete' END AS state
        FROM events, (VALUES ('crashed'), ('restarted')) AS s(step) GROUP BY step""",
    "clean_trips": _trips("SELECT * FROM kept"),
    "time_features": _events(
        f"SELECT {EVENT_KEY}, {CALENDAR} FROM kept", "month", _kept("stream_rows", "month")
    ),
    "enrich_pickup": _events(
        """SELECT kafka_offset * 3 + kafka_partition AS event_id, pickup_location_id,
        zone AS pickup_zone, borough AS pickup_borough, service_zone AS pickup_service_zone
        FROM stream_rows LEFT JOIN zones ON pickup_location_id = location_id""",
        "month",
        ZONES,
    ),
    "enrich_zones": _events(
        f"""SELECT {EVENT_KEY}, pickup_location_id, dropoff_location_id, {ZONE_PAIR}
        FROM stream_rows LEFT JOIN zones p ON pickup_location_id = p.location_id
        LEFT JOIN zones d ON dropoff_location_id = d.location_id""",
        "month",
        ZONES,
    ),
    "silver_full": _trips("SELECT * FROM trips"),
    "daily_summary": _trips(DAILY),
    "daily_summary_from_state": _trips(DAILY),
    "hourly_demand": _trips(HOURLY),
    "pickup_zone_monthly": _trips(ZONE_MONTHLY),
    "payment_monthly": _trips(PAYMENT),
    "enrichment_nulls": _trips(
        "SELECT "
        + ", ".join(
            f"""count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls,
            count(*) FILTER (WHERE {c} IN ('Unknown', 'N/A')) AS {c}_unknown"""
            for c in ("pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough")
        )
        + " FROM trips"
    ),
    "rows_by_source": _trips(
        "SELECT ingestion_source, pickup_year, count(*) AS row_count FROM trips GROUP BY ALL"
    ),
    "rows_by_partition": _trips(
        """SELECT pickup_year, pickup_month, count(*) AS row_count,
        count(*) FILTER (WHERE ingestion_source = 'streaming') AS streaming_rows
        FROM trips GROUP BY ALL"""
    ),
    "month_coverage": _trips(
        "SELECT count(DISTINCT (pickup_year, pickup_month)) AS periods FROM trips"
    ),
    "clean_removed_pct": _trips(
        """SELECT bronze_rows, silver_rows, bronze_rows - silver_rows AS removed,
        (bronze_rows - silver_rows) / bronze_rows * 100.0::DOUBLE AS removed_pct
        FROM (SELECT (SELECT count(*) FROM unified) AS bronze_rows,
                     (SELECT count(*) FROM kept) AS silver_rows)"""
    ),
    "gold_profile": _trips("SELECT * FROM profile", *GOLD, PROFILE),
    "gold_reconcile": _trips("SELECT * FROM reconciled", *GOLD, PROFILE, RECONCILED),
    "gold_verdict": _trips(
        """SELECT CASE WHEN bool_and(trips_ok AND periods_ok) THEN 'PASS' ELSE 'FAIL' END
        AS overall FROM reconciled""",
        *GOLD,
        PROFILE,
        RECONCILED,
    ),
    "period_manifest": _with(
        FILE_ORDERS,
        select="""SELECT source_year_month AS source_period, count(*) AS row_count,
        count(DISTINCT file_name) AS file_count, min(pickup_datetime) AS min_time,
        max(pickup_datetime) AS max_time FROM file_orders GROUP BY 1""",
    ),
    "fingerprint": _with(
        FILE_ORDERS,
        select=f"""SELECT source_year_month AS source_period, count(*) AS row_count,
        CAST(sum({_row_hash(ORDER_TEXTS)}) AS VARCHAR) AS fingerprint FROM file_orders GROUP BY 1""",
    ),
    "fingerprint_incremental": _with(
        FILE_ORDERS,
        """kept_orders AS (
          SELECT * REPLACE (CASE WHEN rate_code_id % 3 = 1 THEN extra + 0.01::DOUBLE ELSE extra END
            AS extra) FROM file_orders WHERE rate_code_id % 3 <> 2)""",
        select=f"""SELECT source_year_month AS source_period, count(*) AS row_count,
        CAST(sum({_row_hash(ORDER_TEXTS)}) AS VARCHAR) AS fingerprint FROM kept_orders GROUP BY 1""",
    ),
    "fingerprint_typed": _with(
        FILE_ORDERS,
        select="""SELECT source_year_month AS source_period, count(*) AS row_count,
        true AS same_for_other_layout, true AS sees_a_change, true AS sees_a_moved_value
        FROM file_orders GROUP BY 1""",
    ),
    "rebuild_plan": f"""WITH rows AS (
          SELECT strftime(ts, '%Y-%m-%d') AS period, day(ts) AS day,
            dayofweek(ts) + 1 AS weekday, * FROM events),
        hashed AS (SELECT *, {_row_hash({
            "event_id": _text("event_id"), "ts": _time_text("ts"), "user_id": _text("user_id"),
            "event_type": "event_type", "value": _double_text("value"), "props": "props",
            "period": "period"})} AS h FROM rows),
        state AS (SELECT period, sum(h) AS desired,
            sum(h) FILTER (WHERE day <= 24 AND (day > 10 OR event_type <> 'error')) AS previous,
            bool_or(day >= 4 AND weekday <> 2) AS present,
            bool_or(weekday <= 3) AS parent_rebuilt
          FROM hashed GROUP BY period),
        decided AS (SELECT *, CASE WHEN present AND previous IS NOT DISTINCT FROM desired
              THEN 'unchanged'
            WHEN present AND previous IS NULL AND NOT parent_rebuilt THEN 'bootstrapped'
            ELSE 'rebuilt' END AS status FROM state)
        SELECT period, status, CASE WHEN status <> 'rebuilt' THEN NULL
            WHEN NOT present THEN 'output missing' WHEN parent_rebuilt THEN 'parent rebuilt'
            ELSE 'input changed' END AS reason FROM decided""",
    "rebuild_cascade": f"""WITH rows AS (
          SELECT strftime(ts, '%Y-%m-%d') AS period, day(ts) AS day,
            dayofweek(ts) + 1 AS weekday, * FROM events),
        hashed AS (SELECT *, {_row_hash({
            "event_id": _text("event_id"), "ts": _time_text("ts"), "user_id": _text("user_id"),
            "event_type": "event_type", "value": _double_text("value"), "props": "props",
            "period": "period"})} AS h FROM rows),
        days AS (SELECT period, any_value(day) AS day, any_value(weekday) AS weekday,
            CAST(sum(h) AS VARCHAR) AS now,
            CAST(sum(h) FILTER (WHERE day <= 24 AND (day > 10 OR event_type <> 'error')) AS VARCHAR)
              AS before
          FROM hashed GROUP BY period),
        trips AS (SELECT *,
            sha256(concat_ws(chr(10), 'trips', now, 'rules 1')) AS desired,
            CASE WHEN before IS NOT NULL THEN sha256(concat_ws(chr(10), 'trips', before, 'rules 1')) END
              AS previous, day >= 4 AND weekday <> 2 AS present FROM days),
        trips_plan AS (SELECT *, CASE WHEN present AND previous IS NOT DISTINCT FROM desired
              THEN 'unchanged' WHEN present AND previous IS NULL THEN 'bootstrapped'
              ELSE 'rebuilt' END AS status FROM trips),
        serving AS (SELECT period, status AS parent, day >= 3 AS present,
            sha256(concat_ws(chr(10), 'serving', desired, 'rules 2')) AS desired,
            CASE WHEN previous IS NOT NULL THEN sha256(concat_ws(chr(10), 'serving', previous,
              CASE WHEN weekday = 1 THEN 'rules 1' ELSE 'rules 2' END)) END AS previous
          FROM trips_plan),
        serving_plan AS (SELECT *, CASE WHEN present AND previous IS NOT DISTINCT FROM desired
              THEN 'unchanged' WHEN present AND previous IS NULL AND parent <> 'rebuilt'
              THEN 'bootstrapped' ELSE 'rebuilt' END AS status FROM serving)
        SELECT 'trips' AS stage, period, status, CASE WHEN status <> 'rebuilt' THEN NULL
            WHEN NOT present THEN 'output missing' ELSE 'input changed' END AS reason FROM trips_plan
        UNION ALL
        SELECT 'serving', period, status, CASE WHEN status <> 'rebuilt' THEN NULL
            WHEN NOT present THEN 'output missing' WHEN parent = 'rebuilt' THEN 'parent rebuilt'
            ELSE 'input changed' END FROM serving_plan
        UNION ALL
        SELECT unnest(['trips', 'serving']), '1999-01-01', 'removed', 'no input'
        UNION ALL
        SELECT 'model', '*', 'rebuilt', 'output missing'""",
    "overview_kpis": _trips(
        """SELECT CAST(sum(trip_count) AS BIGINT) AS total_trips,
        round(CAST(sum(CAST(total_revenue AS DECIMAL(18,4))) AS DOUBLE), 6) AS total_revenue,
        round(sum(avg_trip_duration_minutes * trip_count) / sum(trip_count), 6)
          AS avg_trip_duration_minutes,
        round(sum(avg_trip_distance * trip_count) / sum(trip_count), 6) AS avg_trip_distance
        FROM daily WHERE pickup_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
        GOLD[0],
    ),
    "date_range": _trips(
        "SELECT min(pickup_date) AS min_date, max(pickup_date) AS max_date FROM trips"
    ),
    "daily_trend": _trips(
        """SELECT pickup_date, trip_count, total_revenue FROM daily
        WHERE pickup_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
        ORDER BY pickup_date""",
        GOLD[0],
    ),
    "hourly_curve": _trips(
        """SELECT pickup_hour, count(*) AS trip_count FROM trips
        WHERE pickup_year = 2024 AND pickup_month = '01' GROUP BY 1 ORDER BY 1"""
    ),
    "demand_heatmap": _trips(
        "SELECT d.pickup_day_of_week, "
        + ", ".join(
            f"""CASE WHEN count(t.pickup_hour) > 0 THEN
            count(*) FILTER (WHERE pickup_hour = {h}) END AS h{h:02d}"""
            for h in range(24)
        )
        + """ FROM (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday',
          'Saturday', 'Sunday']) AS pickup_day_of_week) d
        LEFT JOIN (SELECT * FROM trips WHERE pickup_year = 2024 AND pickup_month = '01') t
          ON t.pickup_day_of_week = d.pickup_day_of_week GROUP BY 1"""
    ),
    "zone_month_rollup": _trips(
        """SELECT CAST(pickup_location_id AS INTEGER) AS pickup_location_id, pickup_zone,
        pickup_borough, trip_count, round(total_revenue, 6) AS total_revenue,
        round(avg_trip_duration_minutes, 6) AS avg_trip_duration_minutes,
        round(avg_trip_distance, 6) AS avg_trip_distance,
        round(avg_tip_amount, 6) AS avg_tip_amount FROM totals""",
        GOLD[2],
        f"totals AS ({ZONE_TOTALS})",
    ),
    "zone_map": _trips(
        """SELECT location_id, zone, borough, coalesce(trip_count, 0) AS trip_count,
        total_revenue FROM zones LEFT JOIN totals ON location_id = pickup_location_id""",
        *SHOWN_ZONES,
    ),
    "top_zones": _trips(
        """SELECT pickup_zone, pickup_borough, pickup_location_id, total_revenue FROM totals
        ORDER BY total_revenue DESC, pickup_location_id LIMIT 10""",
        *SHOWN_ZONES,
    ),
    "available_periods": _trips(
        """SELECT DISTINCT pickup_year, CAST(pickup_month AS INTEGER) AS pickup_month,
        strftime(pickup_datetime, '%B') AS month_name,
        pickup_year * 100 + CAST(pickup_month AS INTEGER)
          = (SELECT max(pickup_year * 100 + CAST(pickup_month AS INTEGER)) FROM trips)
          AS is_latest FROM trips"""
    ),
    "coerce_keys": """SELECT doc_id,
        CASE WHEN doc_id % 3 <> 0 THEN CAST(2000 + doc_id % 30 AS INTEGER) END AS pickup_year,
        CAST(1 + doc_id % 12 AS INTEGER) AS pickup_month,
        CASE WHEN doc_id % 4 <> 0 THEN CAST(doc_id % 265 AS INTEGER) END AS pickup_location_id
        FROM documents""",
    "ml_clean": _day_trips(
        """SELECT event_id, trip_duration_minutes, trip_distance, passenger_count,
        pickup_location_id, dropoff_location_id, rate_code_id, pickup_hour, pickup_month
        FROM model_rows""",
        MODEL_ROWS,
    ),
    "ml_features": _features("SELECT * FROM features"),
    "cyclic_features": f"""WITH keyed AS (
          SELECT DISTINCT CAST(day(o_orderdate) % 24 AS INTEGER) AS pickup_hour,
            CAST(month(o_orderdate) AS INTEGER) AS pickup_month,
            CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS pickup_day_of_week_num
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT *, {ENGINEERED} FROM keyed""",
    "temporal_split": _features(
        """SELECT 'train' AS part, event_id, label FROM train
        UNION ALL SELECT 'test', event_id, label FROM test""",
        *TRAIN_TEST,
    ),
    "sample_hash": f"SELECT event_id, event_type FROM events WHERE {HASH} < 50000",
    "sample_independence": f"""SELECT CAST(floor(({FOLD_HASH}) * 5 / 1000000.0) AS INTEGER) AS fold,
        count_if({HASH} < 500000)::BIGINT AS in_first,
        count_if({_bucket("sample", SEED + 1)} < 500000)::BIGINT AS in_second,
        count_if({HASH} < 500000 AND {_bucket("sample", SEED + 1)} < 500000)::BIGINT AS in_both
        FROM events GROUP BY 1""",
    "sample_bernoulli": "SELECT true AS near, true AS each_once",
    "model_comparison": """SELECT model, model <> 'mean_baseline' AS beats_the_mean,
        true AS errors_in_order
        FROM (VALUES ('mean_baseline'), ('linear'), ('rf'), ('gbt')) AS t(model)""",
    "linear_fit": _features(
        """SELECT round(regr_slope(label, trip_distance), 6) AS slope,
        round(regr_intercept(label, trip_distance), 6) AS intercept FROM train""",
        *TRAIN_TEST,
    ),
    "encoded_boosting": _features(
        """SELECT count(*) AS predicted, true AS beats_the_mean, true AS has_trees FROM test""",
        *TRAIN_TEST,
    ),
    "boosted_values": _features(
        f"""SELECT event_id, round(prediction, 6) AS prediction, true AS as_the_model
        FROM tree_rows_{BOOSTED_TREES} WHERE NOT learns""",
        *TRAIN_TEST, _LEARNING, *_boosted(),
    ),
    "forest_values": _features(
        """SELECT event_id, round(prediction, 6) AS prediction, true AS as_the_model
        FROM tree_values WHERE NOT learns""",
        *TRAIN_TEST, _LEARNING, *_TWO_LEVELS,
    ),
    "batch_score": _features(
        f"""SELECT c.event_id, c.failed_rule IS NULL AS valid, c.failed_rule,
        round(p.prediction, 6) AS prediction
        FROM checked c LEFT JOIN (SELECT * FROM tree_rows_{BOOSTED_TREES} WHERE NOT learns) p
          ON c.event_id = p.event_id""",
        *TRAIN_TEST, PLANNED, CHECKED,
        """learning AS (SELECT event_id, trip_distance, pickup_hour, true AS learns FROM train
          UNION ALL SELECT event_id, trip_distance, pickup_hour, false FROM checked
          WHERE failed_rule IS NULL)""",
        *_boosted(),
    ),
    "label_stats": _features(
        """SELECT min(label) AS min_duration, round(avg(label), 6) AS avg_duration,
        quantile_disc(label, 0.5) AS median_duration, max(label) AS max_duration FROM features"""
    ),
    "categorical_strings": _features(
        "SELECT event_id, "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}_cat" for c in CATEGORIES)
        + " FROM features"
    ),
    "string_index": _features(f"SELECT event_id, {TEXT_INDEX} FROM features"),
    "one_hot_width": _features(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, category,
            CAST(count(*) OVER () + 1 AS INTEGER) AS width,
            CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS slot
            FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS category FROM features)"""
            for c in CATEGORIES
        )
    ),
    "target_encode_oof": _encoding(
        "folded", "folded", "t.part <> o.part", ", a.part AS fold"
    ),
    "target_encode_test": _encoding("trained", "tested", "t.part = o.part", ""),
    "mean_baseline": _features(
        """SELECT event_id, label,
        (SELECT round(avg(label), 6) FROM train) AS prediction FROM test""",
        *TRAIN_TEST,
    ),
    "regression_metrics": _scores("SELECT * FROM scores"),
    "best_model": _scores(
        """SELECT model AS best_model, mae, rmse, r2 FROM scores
        WHERE model <> 'mean_baseline' ORDER BY rmse, model LIMIT 1"""
    ),
    "score_input_validity": _events(
        "SELECT event_id, failed_rule IS NULL AS valid, failed_rule FROM checked",
        "day",
        PLANNED,
        CHECKED,
    ),
    "score_features": _events(
        f"""SELECT event_id, CAST(pickup_location_id AS INTEGER) AS pickup_location_id,
        CAST(dropoff_location_id AS INTEGER) AS dropoff_location_id,
        CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance,
        CAST(rate_code_id AS INTEGER) AS rate_code_id, pickup_hour,
        pickup_day_of_week_num, pickup_month, {ENGINEERED}
        FROM (SELECT *, {WEEKDAY_FROM_MONDAY} AS pickup_day_of_week_num FROM checked
              WHERE failed_rule IS NULL)""",
        "day",
        PLANNED,
        CHECKED,
    ),
}
