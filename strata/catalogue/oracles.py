"""Independent SQL for the registered queries, in DuckDB's dialect."""

from __future__ import annotations

# --- Building blocks ----------------------------------------------------------------------------


def _fixed(value: str) -> str:
    """Sum in fixed point, as double."""
    return f"CAST(sum(CAST({value} AS DECIMAL(28,9))) AS DOUBLE)"


def _mean(value: str) -> str:
    return f"{_fixed(value)} / nullif(count({value}), 0)"


def _round(value: str, digits: int) -> str:
    """Round half up, on the decimal digits of the value."""
    return f"CAST(round(CAST({value} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def _seconds(start: str, end: str) -> str:
    return f"(epoch_us({end}) // 1000000 - epoch_us({start}) // 1000000)"


_ORDER_TRIPS = """
raw AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS vendor_id,
         o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         l_quantity AS passenger_raw, l_quantity AS trip_distance,
         l_linenumber AS rate_code_id, l_linestatus AS store_and_fwd_flag,
         s_nationkey + 1 AS pickup_location_id, c_nationkey + 1 AS dropoff_location_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
         l_extendedprice AS fare_amount, l_extendedprice * l_discount AS tip_amount,
         l_extendedprice * l_tax AS tolls_amount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
         'lineitem' AS _source_file
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey)"""

_EVENT_TRIPS = """
raw AS (
  SELECT CAST(CASE WHEN event_id % 3 <> 0 THEN event_id % 3 END AS INTEGER) AS vendor_id,
         ts AS pickup_datetime, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS dropoff_datetime,
         CAST(event_id % 8 AS DOUBLE) AS passenger_raw,
         CAST(event_id % 200 AS DOUBLE) / CAST(10 AS DOUBLE) AS trip_distance,
         CAST(event_id % 7 + 1 AS INTEGER) AS rate_code_id, 'N' AS store_and_fwd_flag,
         CAST(user_id % 25 + 1 AS INTEGER) AS pickup_location_id,
         CAST(event_id % 27 + 1 AS INTEGER) AS dropoff_location_id,
         CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 ELSE 0 END AS payment_type,
         value AS fare_amount,
         value * CAST(event_id % 20 AS DOUBLE) / CAST(100 AS DOUBLE) AS tip_amount,
         CAST(0 AS DOUBLE) AS tolls_amount,
         value + value * CAST(event_id % 20 AS DOUBLE) / CAST(100 AS DOUBLE) AS total_amount,
         'events' AS _source_file
  FROM events)"""

_NORMALIZED = f"""
norm AS (
  SELECT vendor_id, pickup_datetime, dropoff_datetime,
         CAST(floor(passenger_raw) AS INTEGER) AS passenger_count, trip_distance, rate_code_id,
         store_and_fwd_flag, pickup_location_id, dropoff_location_id, payment_type, fare_amount,
         CAST(0 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, tip_amount, tolls_amount,
         CAST(0 AS DOUBLE) AS improvement_surcharge, total_amount,
         CAST(NULL AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee,
         _source_file,
         CAST({_seconds('pickup_datetime', 'dropoff_datetime')} AS DOUBLE) / CAST(60 AS DOUBLE)
           AS trip_duration_minutes,
         TIMESTAMP '2024-07-01 00:00:00' AS _silver_ingestion_timestamp,
         CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month
  FROM raw)"""


def _rules(fare: int, distance: int, most: int, minutes: int) -> dict[str, str]:
    return {
        "fare_amount": f"fare_amount IS NULL OR (fare_amount > 0 AND fare_amount <= {fare})",
        "trip_distance": "trip_distance IS NULL OR "
        f"(trip_distance > 0 AND trip_distance <= {distance})",
        "passenger_count": f"passenger_count IS NULL OR passenger_count BETWEEN 1 AND {most}",
        "datetime_order": "pickup_datetime IS NULL OR dropoff_datetime IS NULL "
        "OR dropoff_datetime > pickup_datetime",
        "trip_duration": f"trip_duration_minutes IS NULL OR trip_duration_minutes <= {minutes}",
        "total_amount": "total_amount IS NULL OR total_amount > 0",
        "tip_amount": "tip_amount IS NULL OR tip_amount >= 0",
        "tolls_amount": "tolls_amount IS NULL OR tolls_amount >= 0",
    }


_ORDER_RULES = _rules(90000, 45, 48, 1500000)
_EVENT_RULES = _rules(300, 200, 6, 180)


def _valid(rules: dict[str, str]) -> str:
    return " AND ".join(f"({test})" for test in rules.values())


def _codes(rules: dict[str, str]) -> str:
    cases = [f"CASE WHEN NOT ({test}) THEN 'invalid_{name}' END" for name, test in rules.items()]
    return f"concat_ws(',', {', '.join(cases)})"


def _silver(trips: str, rules: dict[str, str]) -> str:
    return f"{trips}, {_NORMALIZED}, silver AS (SELECT * FROM norm WHERE {_valid(rules)})"


_ORDERS = _silver(_ORDER_TRIPS, _ORDER_RULES)
_EVENTS = _silver(_EVENT_TRIPS, _EVENT_RULES)

_MEASURES = f"""
measured AS (
  SELECT *, {_seconds('pickup_datetime', 'dropoff_datetime')} AS secs FROM silver),
derived AS (
  SELECT *, CAST(secs AS BIGINT) AS trip_duration_seconds,
         CASE WHEN secs > 0
              THEN trip_distance / (CAST(secs AS DOUBLE) / CAST(3600 AS DOUBLE)) END
           AS trip_speed_mph,
         CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * CAST(100 AS DOUBLE) END
           AS tip_percentage,
         CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
         CAST(hour(dropoff_datetime) AS INTEGER) AS dropoff_hour
  FROM measured)"""

_ZONES = """
dim_zones AS (
  SELECT CAST(0 AS BIGINT) AS zone_sk, 0 AS location_id, 'Not Provided' AS zone_name,
         CAST(NULL AS VARCHAR) AS borough, CAST(NULL AS VARCHAR) AS service_zone
  UNION ALL
  SELECT row_number() OVER (ORDER BY n_nationkey), n_nationkey + 1, n_name, r_name,
         'zone ' || n_regionkey
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_LOOKUPS = """
dim_payment_type(payment_type_sk, payment_type_id, payment_type_description) AS (
  VALUES (0, 0, 'Not Provided'), (1, 1, 'Credit'), (2, 2, 'Cash'), (3, 3, 'No charge'),
         (4, 4, 'Dispute'), (5, 5, 'Unknown'), (6, 6, 'Voided')),
dim_rate_code(rate_code_sk, rate_code_id, rate_code_description) AS (
  VALUES (0, 0, 'Not Provided'), (1, 1, 'Standard rate'), (2, 2, 'JFK'), (3, 3, 'Newark'),
         (4, 4, 'Nassau/Westchester'), (5, 5, 'Negotiated fare'), (6, 6, 'Group ride')),
dim_vendor(vendor_sk, vendor_id, vendor_name) AS (
  VALUES (0, 0, 'Not Provided'), (1, 1, 'Creative Mobile Technologies'), (2, 2, 'VeriFone Inc'))"""

_DATE_COLUMNS = """
  CAST(strftime({day}, '%Y%m%d') AS INTEGER) AS date_sk, CAST({day} AS DATE) AS full_date,
  CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS quarter,
  CAST(month({day}) AS INTEGER) AS month, monthname({day}) AS month_name,
  CAST(day({day}) AS INTEGER) AS day_of_month, CAST(isodow({day}) AS INTEGER) AS day_of_week,
  dayname({day}) AS day_name, isodow({day}) IN (6, 7) AS is_weekend"""


def _dates(first: str, last: str) -> str:
    columns = _DATE_COLUMNS.format(day="d")
    return (
        f"dim_date AS (SELECT {columns} FROM (SELECT unnest(generate_series("
        f"{first}, {last}, INTERVAL 1 DAY)) AS d))"
    )


def _star(silver: str, first: str, last: str) -> str:
    return f"""WITH {silver}, {_MEASURES}, {_ZONES}, {_LOOKUPS},
{_dates(f"TIMESTAMP '{first}'", f"TIMESTAMP '{last}'")},
fact AS (
  SELECT d.date_sk AS pickup_date_sk,
         CAST(coalesce(pz.zone_sk, 0) AS BIGINT) AS pickup_zone_sk,
         CAST(coalesce(dz.zone_sk, 0) AS BIGINT) AS dropoff_zone_sk,
         CAST(coalesce(p.payment_type_sk, 0) AS BIGINT) AS payment_type_sk,
         CAST(coalesce(r.rate_code_sk, 0) AS BIGINT) AS rate_code_sk,
         CAST(coalesce(v.vendor_sk, 0) AS BIGINT) AS vendor_sk,
         t.pickup_location_id, t.dropoff_location_id, t.pickup_datetime, t.dropoff_datetime,
         t.fare_amount, t.tip_amount, t.tolls_amount, t.total_amount, t.trip_distance,
         t.passenger_count, t.trip_duration_seconds, t.trip_speed_mph, t.tip_percentage,
         t.pickup_hour, t.dropoff_hour
  FROM derived t
  LEFT JOIN dim_date d ON CAST(t.pickup_datetime AS DATE) = d.full_date
  LEFT JOIN dim_zones pz ON coalesce(t.pickup_location_id, 0) = pz.location_id
  LEFT JOIN dim_zones dz ON coalesce(t.dropoff_location_id, 0) = dz.location_id
  LEFT JOIN dim_payment_type p ON coalesce(t.payment_type, 0) = p.payment_type_id
  LEFT JOIN dim_rate_code r ON coalesce(t.rate_code_id, 0) = r.rate_code_id
  LEFT JOIN dim_vendor v ON coalesce(t.vendor_id, 0) = v.vendor_id
  WHERE t.pickup_datetime >= TIMESTAMP '{first}'
    AND t.pickup_datetime < TIMESTAMP '{last}' + INTERVAL 1 DAY)"""


_ORDER_STAR = _star(_ORDERS, "1995-01-01", "2001-12-31")
_EVENT_STAR = _star(_EVENTS, "2024-01-01", "2024-12-31")

_DAILY = f"""{_EVENT_STAR}, daily AS (
  SELECT pickup_date_sk, pickup_zone_sk, zone_name, borough, full_date, d.year, d.month,
         d.day_of_week, count(*) AS total_trips, {_fixed('total_amount')} AS total_revenue,
         {_fixed('tip_amount')} AS total_tips, {_mean('fare_amount')} AS avg_fare,
         {_mean('trip_distance')} AS avg_distance,
         {_mean('trip_duration_seconds')} AS avg_duration_seconds,
         {_mean('tip_percentage')} AS avg_tip_percentage
  FROM fact JOIN dim_zones z ON pickup_zone_sk = z.zone_sk
  JOIN dim_date d ON pickup_date_sk = d.date_sk
  GROUP BY ALL)"""

_HOURLY = f"""{_EVENT_STAR}, slots AS (
  SELECT pickup_date_sk, day_of_week, pickup_hour, pickup_zone_sk, zone_name, borough,
         count(*) AS trip_count, {_mean('fare_amount')} AS slot_fare
  FROM fact JOIN dim_zones z ON pickup_zone_sk = z.zone_sk
  JOIN dim_date d ON pickup_date_sk = d.date_sk
  GROUP BY ALL),
hourly AS (
  SELECT day_of_week, pickup_hour, pickup_zone_sk, zone_name, borough,
         avg(trip_count) AS avg_trips, {_mean('slot_fare')} AS avg_fare
  FROM slots GROUP BY ALL)"""

ORACLES: dict[str, str] = {}

# --- Silver -------------------------------------------------------------------------------------

ORACLES["normalize"] = f"WITH {_ORDERS} SELECT * FROM norm"
ORACLES["validate_flags"] = f"""WITH {_ORDERS}
SELECT pickup_datetime, dropoff_datetime, fare_amount,
       {', '.join(f'({test}) AS is_valid_{name}' for name, test in _ORDER_RULES.items())},
       ({_valid(_ORDER_RULES)}) AS is_valid
FROM norm"""
ORACLES["validate_failures"] = f"""WITH {_EVENTS}
SELECT pickup_datetime, fare_amount, {_codes(_EVENT_RULES)} AS validation_failures,
       ({_valid(_EVENT_RULES)}) AS is_valid
FROM norm"""
ORACLES["clean_rows"] = f"WITH {_ORDERS} SELECT * FROM silver"
ORACLES["quarantine"] = f"""WITH {_ORDERS}
SELECT *, {_codes(_ORDER_RULES)} AS validation_failures
FROM norm WHERE NOT ({_valid(_ORDER_RULES)})"""


def _count_rules(rules: dict[str, str], columns: str = "", source: str = "norm") -> str:
    return " UNION ALL ".join(
        f"SELECT {columns}'invalid_{name}' AS rule, count(*) AS failures FROM {source} "
        f"WHERE NOT ({test}) HAVING count(*) > 0"
        for name, test in rules.items()
    )


_CAST_CODES = _codes({"passenger_count_cast": "NOT lost", **_ORDER_RULES})
ORACLES["quarantine_casts"] = f"""WITH {_ORDER_TRIPS.replace(
    "l_quantity AS passenger_raw", "CASE WHEN l_linenumber = 1 THEN l_orderkey * 1e6 ELSE l_quantity END AS passenger_raw"
)}, lines AS (SELECT * REPLACE (CASE WHEN passenger_raw < 2147483648 THEN passenger_raw END AS passenger_raw),
  passenger_raw >= 2147483648 AS lost FROM raw),
{_NORMALIZED.replace("_source_file,", "_source_file, lost,").replace("FROM raw)", "FROM lines)")}
SELECT pickup_datetime, dropoff_datetime, fare_amount, passenger_count,
       {_CAST_CODES} AS validation_failures
FROM norm WHERE lost OR NOT ({_valid(_ORDER_RULES)})"""
ORACLES["rule_counts"] = f"WITH {_ORDERS} {_count_rules(_ORDER_RULES)}"
ORACLES["derived_measures"] = f"""WITH {_silver(_EVENT_TRIPS, {'all': 'true'})}, {_MEASURES}
SELECT pickup_datetime, trip_duration_seconds, trip_speed_mph, tip_percentage, pickup_hour,
       dropoff_hour
FROM derived"""
_LINE_ORDER = """l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus"""
ORACLES["dedup_latest"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
  FROM lineitem) WHERE rn = 1"""
ORACLES["duplicate_keys"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS candidate_key, count(*) AS total_rows,
        count(DISTINCT ({keys})) AS distinct_keys,
        count(*) - count(DISTINCT ({keys})) AS duplicate_rows FROM lineitem"""
    for name, keys in {
        "order": "l_orderkey",
        "line": "l_orderkey, l_linenumber",
        "line_and_flag": "l_orderkey, l_linenumber, l_returnflag",
    }.items()
)
_HASHED = (
    "congestion",
    "CAST(dropoff_datetime AS VARCHAR)",
    "CAST(dropoff_location_id AS VARCHAR)",
    "CAST(fare_amount AS VARCHAR)",
    "CAST(payment_type AS VARCHAR)",
    "CAST(pickup_datetime AS VARCHAR)",
    "CAST(pickup_location_id AS VARCHAR)",
    "CAST(rate_code_id AS VARCHAR)",
    "store_and_fwd_flag",
    "CAST(trip_distance AS VARCHAR)",
    "CAST(vendor_id AS VARCHAR)",
)
ORACLES["row_hash"] = f"""WITH {_ORDERS}, money AS (
  SELECT * EXCLUDE (fare_amount, trip_distance), CAST(NULL AS VARCHAR) AS congestion,
         CAST(fare_amount AS DECIMAL(12,2)) AS fare_amount,
         CAST(trip_distance AS DECIMAL(12,2)) AS trip_distance
  FROM norm)
SELECT pickup_datetime, dropoff_datetime, fare_amount, trip_distance,
       sha256(concat_ws('||', {', '.join(f"coalesce({c}, '∅')" for c in _HASHED)})) AS _row_hash
FROM money"""

# --- Upsert -------------------------------------------------------------------------------------


def _load(name: str, shipped: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn), CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month
  FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderdate, l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey, l_quantity, l_returnflag, _row_hash) AS rn
    FROM (
      SELECT o_orderdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
             l_shipdate, sha256(concat_ws('||', CAST(l_partkey AS VARCHAR), l_returnflag,
                                          CAST(l_shipdate AS VARCHAR))) AS _row_hash
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {shipped}))
  WHERE rn = 1)"""


_LOADS = f"""WITH {_load('t', "l_shipdate < TIMESTAMP '1999-01-01'")},
{_load('s', "l_shipdate >= TIMESTAMP '1997-01-01'")}"""
_MERGE_ON = """t.o_orderdate = s.o_orderdate AND t.l_orderkey = s.l_orderkey
  AND t.l_linenumber = s.l_linenumber"""
_NEWER = "s._row_hash <> t._row_hash AND s.l_shipdate > t.l_shipdate"
ORACLES["upsert_first_load"] = f"{_LOADS} SELECT * FROM t"
ORACLES["upsert_merge"] = f"""{_LOADS}
SELECT s.* FROM s LEFT JOIN t ON {_MERGE_ON} WHERE t.l_orderkey IS NULL OR ({_NEWER})
UNION ALL
SELECT t.* FROM t LEFT JOIN s ON {_MERGE_ON} WHERE s.l_orderkey IS NULL OR NOT ({_NEWER})"""
ORACLES["upsert_actions"] = f"""{_LOADS}
SELECT CASE WHEN t.l_orderkey IS NULL THEN 'inserted' WHEN s.l_orderkey IS NULL THEN 'kept'
            WHEN {_NEWER} THEN 'updated' ELSE 'unchanged' END AS action, count(*) AS row_count
FROM t FULL OUTER JOIN s ON {_MERGE_ON} GROUP BY 1"""

# --- Dimensions ---------------------------------------------------------------------------------

ORACLES["dim_zones"] = f"WITH {_ZONES} SELECT * FROM dim_zones"
ORACLES["dim_lookup"] = """
SELECT CAST(0 AS BIGINT) AS priority_sk, 0 AS priority_id, 'Not Provided' AS priority_description
UNION ALL
SELECT row_number() OVER (ORDER BY id), id, description FROM (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id,
         substr(o_orderpriority, 3) AS description FROM orders)"""
_FIRST_LAST = ("(SELECT min(o_orderdate) FROM orders)", "(SELECT max(o_orderdate) FROM orders)")
ORACLES["dim_date"] = f"WITH {_dates(*_FIRST_LAST)} SELECT * FROM dim_date"
ORACLES["scalar_dates"] = f"""
SELECT event_id, {_DATE_COLUMNS.format(day='ts')}, CAST(hour(ts) AS INTEGER) AS hour,
       epoch_us(ts) // 1000000 AS unix_seconds
FROM events"""
_CUSTOMERS = """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, c_custkey, c_name,
  c_mktsegment FROM customer"""
ORACLES["surrogate_key"] = _CUSTOMERS
ORACLES["key_sample"] = f"""
SELECT c_custkey, customer_sk FROM ({_CUSTOMERS}) ORDER BY c_custkey LIMIT 10"""

# --- Fact, marts, reports -----------------------------------------------------------------------

ORACLES["fact_build"] = f"{_ORDER_STAR} SELECT * FROM fact"
ORACLES["fact_build_events"] = f"{_EVENT_STAR} SELECT * FROM fact"
ORACLES["fact_unknown_members"] = f"""{_EVENT_STAR}
SELECT count(*) AS trips,
       count(*) FILTER (pickup_zone_sk = 0) AS unknown_pickup_zone_sk,
       count(*) FILTER (dropoff_zone_sk = 0) AS unknown_dropoff_zone_sk,
       count(*) FILTER (payment_type_sk = 0) AS unknown_payment_type_sk,
       count(*) FILTER (rate_code_sk = 0) AS unknown_rate_code_sk,
       count(*) FILTER (vendor_sk = 0) AS unknown_vendor_sk
FROM fact"""
ORACLES["fact_roundtrip"] = f"""{_EVENT_STAR}
SELECT pickup_date_sk, count(*) AS trips, {_fixed('fare_amount')} AS fares
FROM fact GROUP BY pickup_date_sk"""
ORACLES["resolve_labels"] = f"""{_EVENT_STAR}
SELECT pickup_datetime, pickup_date_sk, d.full_date AS pickup_full_date, pickup_location_id,
       pickup_zone_sk, pz.zone_name AS pickup_zone_name, dropoff_location_id, dropoff_zone_sk,
       dz.zone_name AS dropoff_zone_name, f.payment_type_sk, payment_type_description,
       f.rate_code_sk, rate_code_description, f.vendor_sk, vendor_name
FROM fact f LEFT JOIN dim_date d ON pickup_date_sk = d.date_sk
LEFT JOIN dim_zones pz ON pickup_zone_sk = pz.zone_sk
LEFT JOIN dim_zones dz ON dropoff_zone_sk = dz.zone_sk
LEFT JOIN dim_payment_type p ON f.payment_type_sk = p.payment_type_sk
LEFT JOIN dim_rate_code r ON f.rate_code_sk = r.rate_code_sk
LEFT JOIN dim_vendor v ON f.vendor_sk = v.vendor_sk
ORDER BY pickup_datetime, fare_amount LIMIT 5"""
ORACLES["daily_metrics"] = f"{_DAILY} SELECT * FROM daily"
ORACLES["hourly_patterns"] = f"{_HOURLY} SELECT * FROM hourly"
ORACLES["q01"] = f"""{_DAILY}
SELECT zone_name, borough, CAST(sum(total_trips) AS BIGINT) AS total_trips,
       {_round(_fixed('total_revenue'), 2)} AS total_revenue,
       {_round(_fixed('total_revenue') + ' / sum(total_trips)', 2)} AS avg_revenue_per_trip
FROM daily GROUP BY zone_name, borough ORDER BY total_revenue DESC, zone_name, borough LIMIT 10"""
ORACLES["q02"] = f"""{_HOURLY}
SELECT pickup_hour, zone_name, {_round('h.avg_trips', 2)} AS avg_trips,
       {_round('h.avg_fare', 2)} AS avg_fare
FROM hourly h WHERE borough = 'ASIA'
ORDER BY {_round('h.avg_trips', 2)} DESC, pickup_hour, zone_name, {_round('h.avg_fare', 2)} DESC
LIMIT 50"""
ORACLES["q03"] = f"""{_HOURLY}
SELECT day_of_week,
       CASE day_of_week WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
            WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday'
            WHEN 7 THEN 'Sunday' END AS day_name,
       {_round(_fixed('avg_trips'), 1)} AS total_avg_demand,
       {_round(_mean('h.avg_fare'), 2)} AS avg_fare
FROM hourly h GROUP BY day_of_week"""
ORACLES["q04"] = f"""{_ORDER_STAR}
SELECT payment_type_description, count(*) AS trip_count,
       {_round('count(*) * 100.0 / sum(count(*)) OVER ()', 2)} AS pct_of_trips,
       {_round(_mean('tip_amount'), 2)} AS avg_tip_amount,
       {_round(_mean('tip_percentage'), 2)} AS avg_tip_pct
FROM fact f JOIN dim_payment_type p ON f.payment_type_sk = p.payment_type_sk
GROUP BY payment_type_description"""
ORACLES["q05"] = f"""{_ORDER_STAR}
SELECT d.year, d.month, vendor_name, count(*) AS trip_count,
       {_round('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY d.year, d.month)', 2)}
         AS market_share_pct
FROM fact f JOIN dim_vendor v ON f.vendor_sk = v.vendor_sk
JOIN dim_date d ON pickup_date_sk = d.date_sk
WHERE v.vendor_id <> 0 GROUP BY d.year, d.month, vendor_name"""
ORACLES["q06"] = f"""{_ORDER_STAR}
SELECT borough, count(*) AS trip_count, {_round(_mean('fare_amount'), 2)} AS avg_fare,
       {_round(_mean('trip_distance'), 3)} AS avg_distance_miles,
       {_round(_mean('trip_duration_seconds') + ' / CAST(60 AS DOUBLE)', 1)}
         AS avg_duration_minutes
FROM fact JOIN dim_zones z ON pickup_zone_sk = z.zone_sk
WHERE trip_distance < 5 AND fare_amount > 5000 AND pickup_zone_sk <> 0 GROUP BY borough"""
ORACLES["q07"] = f"""{_ORDER_STAR}
SELECT pz.zone_name AS pickup_zone, dz.zone_name AS dropoff_zone, count(*) AS trip_count,
       {_round(_mean('trip_duration_seconds') + ' / CAST(60 AS DOUBLE)', 1)}
         AS avg_duration_minutes,
       {_round(_mean('trip_distance'), 2)} AS avg_distance_miles,
       {_round(_mean('fare_amount'), 2)} AS avg_fare
FROM fact JOIN dim_zones pz ON pickup_zone_sk = pz.zone_sk
JOIN dim_zones dz ON dropoff_zone_sk = dz.zone_sk
WHERE pickup_zone_sk <> 0 AND dropoff_zone_sk <> 0
GROUP BY pz.zone_name, dz.zone_name ORDER BY trip_count DESC, pickup_zone, dropoff_zone LIMIT 10"""
ORACLES["q08"] = f"""{_ORDER_STAR}
SELECT borough, count(*) AS trip_count, {_round(_mean('fare_amount'), 2)} AS avg_fare,
       {_round(_mean('trip_distance'), 2)} AS avg_distance_miles,
       {_round(_mean('fare_amount / trip_distance'), 2)} AS avg_fare_per_mile
FROM fact JOIN dim_zones z ON pickup_zone_sk = z.zone_sk
WHERE trip_distance > 0 AND pickup_zone_sk <> 0 GROUP BY borough"""
ORACLES["q09"] = f"""{_DAILY}, per_day AS (
  SELECT pickup_date_sk, CASE WHEN day_of_week IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END
         AS day_type, sum(total_trips) AS day_trips, {_fixed('total_revenue')} AS day_revenue
  FROM daily GROUP BY pickup_date_sk, day_of_week)
SELECT day_type, count(*) AS num_days, {_round('avg(day_trips)', 0)} AS avg_trips_per_day,
       {_round(_mean('day_revenue'), 2)} AS avg_revenue_per_day
FROM per_day GROUP BY day_type"""
ORACLES["q10"] = f"""{_DAILY}
SELECT year, month, CAST(sum(total_trips) AS BIGINT) AS total_trips,
       {_round(_fixed('total_revenue'), 2)} AS total_revenue,
       {_round(_mean('daily.avg_fare'), 2)} AS avg_fare,
       {_round(_mean('avg_distance'), 2)} AS avg_distance_miles
FROM daily GROUP BY year, month"""

# --- Profiling ----------------------------------------------------------------------------------

_RAW_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
    "_source_file": "_source_file",
}
ORACLES["profile_nulls"] = f"WITH {_ORDERS} " + " UNION ALL ".join(
    f"SELECT '{raw}' AS column_name, count(*) - count({c}) AS null_count, "
    f"CAST((count(*) - count({c})) * 100.0 / count(*) AS DOUBLE) AS null_pct FROM norm"
    for raw, c in _RAW_NAMES.items()
)


def _numeric(name: str, value: str, low: str, high: str, source: str) -> str:
    return f"""SELECT '{name}' AS column_name, min({value}) AS min_value, max({value}) AS max_value,
  {_mean(value)} AS mean_value, quantile_disc({value}, 0.50) AS p50_value,
  quantile_disc({value}, 0.95) AS p95_value, quantile_disc({value}, 0.99) AS p99_value,
  count(*) FILTER ({low}) AS too_low, count(*) FILTER ({high}) AS too_high FROM {source}"""


ORACLES["profile_numeric"] = (
    f"WITH {_EVENTS} "
    + _numeric("fare_amount", "fare_amount", "fare_amount <= 1", "fare_amount > 300", "norm")
    + " UNION ALL "
    + _numeric(
        "trip_distance", "trip_distance", "trip_distance <= 0", "trip_distance > 15", "norm"
    )
)
ORACLES["profile_sketches"] = f"""WITH {_EVENTS}
SELECT CAST(count(DISTINCT month) AS INTEGER) AS months, count(fare_amount) AS value_count, true AS p50_right,
  true AS p95_right, true AS p99_right FROM norm"""
ORACLES["key_sketches"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS candidate_key, count(*) AS total_rows,
        count(DISTINCT ({keys})) AS distinct_keys, true AS estimate_right FROM lineitem"""
    for name, keys in {"order": "l_orderkey", "line": "l_orderkey, l_linenumber", "part": "l_partkey"}.items()
)
ORACLES["profile_values"] = f"""WITH {_EVENTS}
SELECT CAST(passenger_count AS DOUBLE) AS passenger_count, count(*) AS row_count
FROM norm GROUP BY 1"""
ORACLES["profile_duration"] = f"WITH {_ORDERS} " + _numeric(
    "duration_minutes",
    "trip_duration_minutes",
    "trip_duration_minutes < 0",
    "trip_duration_minutes > 1440",
    "norm",
)
ORACLES["profile_order"] = f"""WITH {_ORDERS}
SELECT count(*) FILTER (dropoff_datetime <= pickup_datetime) AS end_not_after_start FROM norm"""
ORACLES["profile_describe"] = f"WITH {_EVENTS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS value_count, {_mean(c)} AS mean, "
    f"{_round(f'stddev_samp({c})', 6)} AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM norm"
    for c in ("fare_amount", "trip_distance", "passenger_count")
)
_ORPHANS = f"""WITH {_EVENTS}, {_ZONES}, orphan AS (
  SELECT DISTINCT pickup_location_id AS location_id, 'PULocationID' AS role
  FROM norm ANTI JOIN (SELECT * FROM dim_zones WHERE zone_sk > 0) z
    ON pickup_location_id = z.location_id
  UNION ALL
  SELECT DISTINCT dropoff_location_id, 'DOLocationID'
  FROM norm ANTI JOIN (SELECT * FROM dim_zones WHERE zone_sk > 0) z
    ON dropoff_location_id = z.location_id)"""
ORACLES["orphan_keys"] = f"{_ORPHANS} SELECT * FROM orphan"
ORACLES["orphan_key_counts"] = f"""{_ORPHANS}
SELECT role, count(*) AS orphan_ids FROM orphan GROUP BY role"""
ORACLES["lookup_fallback"] = f"""WITH {_EVENTS}, {_ZONES}
SELECT location_id, zone_name, count(*) AS trips, 'table' AS lookup_source
FROM norm JOIN dim_zones ON pickup_location_id = location_id WHERE zone_sk > 0
GROUP BY location_id, zone_name"""

# --- Checks -------------------------------------------------------------------------------------


def _check(name: str, expected: str, actual: str, passed: str, source: str, more: str = "") -> str:
    severity = "warn" if more else "error"
    return (
        f"SELECT '{name}' AS \"check\", CAST({expected} AS VARCHAR) AS expected, "
        f"CAST({actual} AS VARCHAR) AS actual, ({passed}) AS passed, "
        f"'{severity}' AS severity{more} FROM {source}"
    )


_REQUIRED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "VendorID",
    "RatecodeID",
)
_FOUND = {
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "fare_amount": "double",
    "total_amount": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "bigint",
    "VendorID": "int",
    "RatecodeID": "double",
}
ORACLES["check_schema"] = f"WITH {_ORDERS} " + " UNION ALL ".join(
    [
        f"SELECT '{c}' AS column_name, 'any type' AS expected, '{_FOUND[c]}' AS actual, "
        f"true AS passed, count(*) - count({_RAW_NAMES[c]}) AS nulls FROM norm"
        for c in _REQUIRED
    ]
    + [
        "SELECT '_source_file', 'string', 'string', true, count(*) - count(_source_file) FROM norm",
        "SELECT '_ingestion_batch_id', 'string', 'missing', false, NULL",
    ]
)
ORACLES["check_sets"] = """
WITH expected AS (
  SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month
  FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01',
                                      INTERVAL 1 MONTH)) AS d)),
actual AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)
(SELECT *, 'missing' AS status FROM (SELECT * FROM expected EXCEPT SELECT * FROM actual))
UNION ALL
(SELECT *, 'unexpected' FROM (SELECT * FROM actual EXCEPT SELECT * FROM expected))"""
_FACT_KEYS = (
    "pickup_date_sk",
    "pickup_zone_sk",
    "dropoff_zone_sk",
    "payment_type_sk",
    "rate_code_sk",
    "vendor_sk",
)
ORACLES["check_not_null"] = f"{_ORDER_STAR} " + " UNION ALL ".join(
    _check(
        f"{c} is not null", "0", f"count(*) - count({c})", f"count(*) = count({c})", "fact"
    )
    for c in _FACT_KEYS
)
_OUTSIDE = "count(*) FILTER (NOT (year = 1998 AND month BETWEEN 1 AND 6))"
ORACLES["rogue_dates"] = f"WITH {_ORDERS} " + _check(
    "pickup in range",
    "0",
    _OUTSIDE,
    f"{_OUTSIDE} = 0",
    "norm",
    f", CAST({_OUTSIDE} * 100.0 / count(*) AS DOUBLE) AS pct, count(*) AS rows_seen",
)
ORACLES["check_keys"] = f"WITH dim AS ({_CUSTOMERS}) " + " UNION ALL ".join(
    [
        _check(
            "customer_sk is not null",
            "0",
            "count(*) - count(customer_sk)",
            "count(*) = count(customer_sk)",
            "dim",
        )
    ]
    + [
        _check(
            f"{c} is unique",
            "count(*)",
            f"count(DISTINCT {c})",
            f"count(*) = count(DISTINCT {c})",
            "dim",
        )
        for c in ("customer_sk", "c_custkey")
    ]
)
_GRAIN = f"""{_HOURLY}, daily AS (
  SELECT DISTINCT pickup_date_sk, pickup_zone_sk FROM fact),
n AS (
  SELECT (SELECT count(*) FROM fact) AS fact, (SELECT count(*) FROM daily) AS daily,
         (SELECT count(*) FROM hourly) AS hourly, (SELECT count(*) FROM dim_zones) AS zones,
         (SELECT count(*) FROM (SELECT DISTINCT pickup_date_sk, pickup_hour, pickup_zone_sk FROM fact)) AS slots,
         (SELECT count(*) FROM dim_date) AS days)"""


def _bound(name: str, bound: str, actual: str) -> str:
    return _check(name, f"'<= ' || ({bound})", actual, f"{actual} <= {bound}", "n")


_GRAIN_ROWS = " UNION ALL ".join(
    [
        _check("daily mart is not empty", "'> 0'", "daily", "daily > 0", "n"),
        _bound("daily mart within its grain", "zones * days", "daily"),
        _bound("daily mart within the fact", "fact", "daily"),
        _check("daily mart as computed", "daily", "daily", "true", "n"),
        _check("hourly mart is not empty", "'> 0'", "hourly", "hourly > 0", "n"),
        _bound("hourly mart within its grain", "zones * 7 * 24", "hourly"),
        _bound("hourly slots within the fact", "fact", "slots"),
        _bound("hourly mart within its slots", "slots", "hourly"),
    ]
)
_DIMENSIONS = {
    "dim_zones": ("borough", "location_id", "service_zone", "zone_name", "zone_sk"),
    "dim_date": (
        "date_sk", "day_name", "day_of_month", "day_of_week", "full_date", "is_weekend", "month",
        "month_name", "quarter", "year",
    ),
    "dim_payment_type": ("payment_type_description", "payment_type_id", "payment_type_sk"),
    "dim_rate_code": ("rate_code_description", "rate_code_id", "rate_code_sk"),
    "dim_vendor": ("vendor_id", "vendor_name", "vendor_sk"),
}


def _print(columns: tuple[str, ...]) -> str:
    row = "concat_ws('||', " + ", ".join(f"coalesce({c}::VARCHAR, '∅')" for c in columns) + ")"
    return f"count(*) || ':' || sum(('0x' || substr(md5({row}), 1, 15))::BIGINT)"


ORACLES["check_grain"] = f"{_GRAIN} {_GRAIN_ROWS}"
ORACLES["marts_refreshed"] = f"{_DAILY} SELECT * FROM daily"
_KEYS = {
    "dim_zones": ("zone_sk", "location_id"),
    "dim_date": ("date_sk", "full_date"),
    "dim_payment_type": ("payment_type_sk", "payment_type_id"),
    "dim_rate_code": ("rate_code_sk", "rate_code_id"),
    "dim_vendor": ("vendor_sk", "vendor_id"),
}
_KNOWN_ROWS = {"dim_date": "366", "dim_payment_type": "7", "dim_rate_code": "7", "dim_vendor": "3"}


def _dimension_checks(name: str) -> list[str]:
    sk, nk = _KEYS[name]
    known = _KNOWN_ROWS.get(name, "(SELECT count(*) + 1 FROM nation)")
    unique = [
        _check(f"{name}: {c} is unique", "count(*)", f"count(DISTINCT {c})", f"count(*) = count(DISTINCT {c})", name)
        for c in (sk, nk)
    ]
    return [
        _check(f"{name}: {sk} is not null", "0", f"count(*) - count({sk})", f"count(*) = count({sk})", name),
        *unique,
        _check(f"{name}: row count", known, "count(*)", f"count(*) = {known}", name),
    ]


def _fact_checks() -> list[str]:
    """Silver lies within the calendar wholly or in part: ``i`` is its part inside."""
    lost = "(SELECT count(*) FROM silver) - count(*)"
    inside = "(SELECT count(*) FROM i)"
    nulls = [
        _check(f"{c} is not null", "0", f"count(*) - count({c})", f"count(*) = count({c})", "fact")
        for c in _FACT_KEYS
    ]
    sums = []
    for c in ("fare_amount", "tip_amount", "total_amount"):
        left, right = f"(SELECT {_fixed(c)} FROM i)", _fixed(c)
        spelt = [f"CAST({side} AS DECIMAL(38,2))" for side in (left, right)]
        sums.append(_check(f"sum of {c}", *spelt, f"abs({left} - {right}) < 0.01", "fact"))
    return [
        _check("rows lost at the calendar edge", "'0..100'", lost, f"{lost} BETWEEN 0 AND 100", "fact"),
        _check("fact as computed", inside, "count(*)", f"count(*) = {inside}", "fact"),
        *nulls,
        *sums,
    ]


_INSIDE = """i AS (SELECT * FROM silver WHERE pickup_datetime >= TIMESTAMP '2024-01-01'
  AND pickup_datetime < TIMESTAMP '2025-01-01')"""
ORACLES["gold_checks"] = " UNION ALL ".join(
    [f"{_GRAIN}, {_INSIDE} " + _GRAIN_ROWS]
    + [row for name in _KEYS for row in _dimension_checks(name)]
    + _fact_checks()
)
ORACLES["check_idempotent"] = f"""WITH {_ZONES}, {_LOOKUPS},
{_dates("TIMESTAMP '1995-01-01'", "TIMESTAMP '2001-12-31'")} """ + " UNION ALL ".join(
    _check(f"{name} is the same on a rerun", _print(columns), _print(columns), "true", name)
    for name, columns in _DIMENSIONS.items()
)
ORACLES["reconcile_counts"] = f"""{_ORDER_STAR}, n AS (
  SELECT (SELECT count(*) FROM lineitem) AS source, (SELECT count(*) FROM norm) AS rows_,
         (SELECT count(*) FROM silver) AS clean,
         (SELECT count(*) FROM norm WHERE NOT ({_valid(_ORDER_RULES)})) AS rejected,
         (SELECT count(*) FROM fact) AS fact) """ + " UNION ALL ".join(
    [
        _check("fact is not empty", "'> 0'", "fact", "fact > 0", "n"),
        _check("source = normalised", "source", "rows_", "source = rows_", "n"),
        _check(
            "clean + rejected = normalised",
            "rows_",
            "clean + rejected",
            "rows_ = clean + rejected",
            "n",
        ),
        _check(
            "rows lost at the calendar edge",
            "'0..100'",
            "clean - fact",
            "clean - fact BETWEEN 0 AND 100",
            "n",
        ),
    ]
)
ORACLES["reconcile_sums"] = f"{_ORDER_STAR} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS measure, l AS left_sum, r AS right_sum, abs(l - r) AS difference,
        abs(l - r) < 0.01 AS passed
        FROM (SELECT (SELECT {_fixed(c)} FROM silver
                      WHERE pickup_datetime >= TIMESTAMP '1995-01-01'
                        AND pickup_datetime < TIMESTAMP '2002-01-01') AS l,
                     (SELECT {_fixed(c)} FROM fact) AS r)"""
    for c in ("fare_amount", "tip_amount", "total_amount")
)
ORACLES["sample_lineage"] = f"""{_EVENT_STAR}, sample AS (
  SELECT * FROM silver
  WHERE pickup_datetime >= TIMESTAMP '2024-01-15' AND pickup_datetime < TIMESTAMP '2024-01-16'
  ORDER BY pickup_datetime, fare_amount LIMIT 5)
SELECT s.pickup_datetime, s.dropoff_datetime, s.pickup_location_id AS silver_pickup_location_id,
       f.pickup_zone_sk AS gold_pickup_zone_sk, pz.zone_name AS pickup_zone_name,
       s.dropoff_location_id AS silver_dropoff_location_id,
       f.dropoff_zone_sk AS gold_dropoff_zone_sk, dz.zone_name AS dropoff_zone_name,
       s.fare_amount, s.tip_amount, s.total_amount, f.pickup_date_sk AS gold_pickup_date_sk,
       d.full_date AS gold_full_date
FROM sample s JOIN fact f ON s.pickup_datetime = f.pickup_datetime
  AND s.pickup_location_id = f.pickup_location_id
  AND s.dropoff_location_id = f.dropoff_location_id AND s.fare_amount = f.fare_amount
LEFT JOIN dim_zones pz ON f.pickup_zone_sk = pz.zone_sk
LEFT JOIN dim_zones dz ON f.dropoff_zone_sk = dz.zone_sk
LEFT JOIN dim_date d ON f.pickup_date_sk = d.date_sk"""
_TRIP_KEY = """vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id,
  dropoff_location_id, fare_amount"""
ORACLES["dq_metrics"] = f"""WITH {_ORDERS}, n AS (
  SELECT (SELECT count(*) FROM norm) AS rows_in,
         (SELECT count(*) FROM (SELECT DISTINCT {_TRIP_KEY} FROM silver)) AS rows_clean,
         (SELECT count(*) FROM silver) AS valid),
metrics AS (
  SELECT rows_in, rows_clean, rows_in - valid AS rows_quarantined, valid - rows_clean AS rows_deduped,
         'order trips' AS bronze_table FROM n)
SELECT metrics.*, rule, failures FROM metrics, ({_count_rules(_ORDER_RULES)})"""

# --- Bronze -------------------------------------------------------------------------------------

_MONTHS = """CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month"""
ORACLES["ingest_bronze"] = f"""
SELECT o_orderkey, o_totalprice, {_MONTHS}, 'batch-1' AS _ingestion_batch_id FROM orders"""
ORACLES["file_manifest"] = f"""
SELECT {_MONTHS}, CAST(1 AS BIGINT) AS files, true AS all_sized, count(*) AS row_count FROM orders
GROUP BY ALL"""
ORACLES["pending_files"] = f"""
SELECT DISTINCT {_MONTHS}, CASE WHEN year(o_orderdate) = 1996 THEN 'pending' ELSE 'loaded' END
  AS status, CAST(1 AS BIGINT) AS months FROM orders"""
ORACLES["file_status"] = f"""
WITH months AS (
  SELECT {_MONTHS}, count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS even FROM orders GROUP BY ALL),
held AS (
  SELECT *, CASE WHEN year = 1995 THEN even WHEN year = 1998 AND month = 2 THEN NULL ELSE n END AS bronze_rows,
    CASE WHEN year = 1996 OR year = 1998 AND month = 2 THEN NULL ELSE n END AS ledger_rows FROM months)
SELECT year, month, CASE
    WHEN year = 1996 THEN 'not recorded' WHEN year = 1998 AND month = 2 THEN 'pending'
    WHEN even < n AND year = 1995 THEN 'rows differ' WHEN year = 1997 THEN 'lost'
    WHEN year = 1998 AND month = 1 THEN 'size changed' ELSE 'loaded' END AS status,
  CAST(1 AS BIGINT) AS files, ledger_rows, bronze_rows,
  CAST(CASE WHEN year = 1997 THEN 0 ELSE 1 END AS BIGINT) AS files_with_bytes
FROM held
UNION ALL SELECT 2030, 1, 'month missing', 1, NULL, NULL, 0"""
ORACLES["stream_upsert"] = ORACLES["upsert_merge"]
ORACLES["file_ledger"] = f"""
SELECT {_MONTHS}, 'batch-1' AS ingestion_batch_id, count(*) AS row_count FROM orders
GROUP BY ALL"""
ORACLES["ledger_backfill"] = f"""
SELECT {_MONTHS}, CAST(1 AS BIGINT) AS files, count(*) AS row_count, true AS as_recorded FROM orders
GROUP BY ALL"""
ORACLES["upsert_catalog"] = ORACLES["upsert_merge"]
_SILVER_ROW = (
    "airport_fee", "congestion_surcharge", "dropoff_datetime", "dropoff_location_id", "extra", "fare_amount",
    "improvement_surcharge", "mta_tax", "passenger_count", "payment_type", "pickup_datetime",
    "pickup_location_id", "rate_code_id", "store_and_fwd_flag", "tip_amount", "tolls_amount", "total_amount",
    "trip_distance", "trip_duration_minutes", "vendor_id",
)
ORACLES["row_hash_silver"] = f"""WITH {_ORDERS}
SELECT {_TRIP_KEY}, sha256(concat_ws('||', {
    ", ".join(f"coalesce(CAST({c} AS VARCHAR), '∅')" for c in _SILVER_ROW)})) AS _row_hash FROM silver"""
ORACLES["lookup_skipped"] = f"""WITH {_EVENTS}
SELECT 'pickup zones' AS "check", 'no lookup at zones.csv or zones' AS message,
  count(DISTINCT pickup_location_id) AS ids FROM norm"""
