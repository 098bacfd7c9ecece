"""The same queries as plain SQL for an independent engine."""

from __future__ import annotations

from driver_queries.queries import TABLES

# Raw tables


def _raw(status: str, pickup: str, dropoff: str, own: str) -> str:
    fare = "CAST(l_extendedprice AS DECIMAL(18,3))"
    tip = f"CAST({fare} * CAST(l_discount AS DECIMAL(18,3)) AS DECIMAL(18,3))"
    tax = f"CAST({fare} * CAST(l_tax AS DECIMAL(18,3)) AS DECIMAL(18,3))"
    return f"""
    SELECT l_suppkey AS VendorID, o_orderdate AS {pickup}, l_shipdate AS {dropoff},
           CAST(l_linenumber AS DOUBLE) AS passenger_count, CAST(1.0 AS DOUBLE) AS RatecodeID,
           s_nationkey AS PULocationID, c_nationkey AS DOLocationID,
           l_quantity AS trip_distance, l_returnflag AS store_and_fwd_flag,
           substr(o_orderpriority, 1, 1) AS payment_type,
           {fare} AS fare_amount, 0.75 AS extra, {tax} AS mta_tax, {tip} AS tip_amount,
           CAST(l_discount AS DECIMAL(18,3)) AS tolls_amount, 0.3 AS improvement_surcharge,
           CAST({fare} + {tip} + {tax} AS DECIMAL(18,3)) AS total_amount,
           2.5 AS congestion_surcharge, {own}
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
    WHERE l_linestatus = '{status}'"""


RAW_YELLOW = _raw("O", "tpep_pickup_datetime", "tpep_dropoff_datetime", "1.25 AS airport_fee")
RAW_GREEN = _raw(
    "F", "lpep_pickup_datetime", "lpep_dropoff_datetime", "0.5 AS ehail_fee, 1 AS trip_type"
)

ZONES = """
    SELECT n_nationkey AS locationid,
           CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS borough,
           n_name AS zone,
           CASE WHEN r_name = 'EUROPE' THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey"""

# Staging

LABEL = """CASE {code} WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
           WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
           ELSE 'EMPTY' END"""


def _ranked(raw: str, pickup: str, dropoff: str, own: str) -> str:
    return f"""
    SELECT *, row_number() OVER (
        PARTITION BY VendorID, {pickup}
        ORDER BY {dropoff}, PULocationID, DOLocationID, passenger_count, trip_distance,
                 fare_amount, tip_amount, total_amount, payment_type, RatecodeID,
                 store_and_fwd_flag, extra, mta_tax, tolls_amount, improvement_surcharge,
                 congestion_surcharge, {own}) AS rn
    FROM {raw} WHERE VendorID IS NOT NULL"""


def _staged(raw: str, pickup: str, dropoff: str, trip_type: str, ehail: str, airport: str) -> str:
    def amount(name: str) -> str:
        return f"CAST({name} AS DECIMAL(18,3)) AS {name}"

    own = "airport_fee" if airport else "ehail_fee, trip_type"
    return f"""
    SELECT md5(CAST(VendorID AS VARCHAR) || '-' || CAST({pickup} AS VARCHAR)) AS tripid,
           TRY_CAST(VendorID AS INTEGER) AS vendorid,
           TRY_CAST(passenger_count AS INTEGER) AS count_passenger,
           TRY_CAST(RatecodeID AS INTEGER) AS ratecodeid,
           TRY_CAST(PULocationID AS INTEGER) AS pickup_locationid,
           TRY_CAST(DOLocationID AS INTEGER) AS dropoff_locationid,
           TRY_CAST({pickup} AS TIMESTAMP) AS pickup_datetime,
           TRY_CAST({dropoff} AS TIMESTAMP) AS dropoff_datetime,
           {amount("trip_distance")}, {trip_type} AS trip_type, store_and_fwd_flag,
           coalesce(TRY_CAST(payment_type AS INTEGER), 0) AS payment_type,
           {LABEL.format(code="TRY_CAST(payment_type AS INTEGER)")} AS payment_type_describe,
           {amount("fare_amount")}, {amount("extra")}, {amount("mta_tax")},
           {amount("tip_amount")}, {amount("tolls_amount")}, {ehail}
           {amount("improvement_surcharge")}, {amount("total_amount")},
           {amount("congestion_surcharge")} {airport}
    FROM ({_ranked(raw, pickup, dropoff, own)}) WHERE rn = 1"""


STAGED_YELLOW = _staged(
    "raw_yellow",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "1",
    "",
    ", CAST(airport_fee AS DECIMAL(18,3)) AS airport_fee",
)
STAGED_GREEN = _staged(
    "raw_green",
    "lpep_pickup_datetime",
    "lpep_dropoff_datetime",
    "TRY_CAST(trip_type AS INTEGER)",
    "CAST(coalesce(TRY_CAST(ehail_fee AS DECIMAL(18,3)), 0) AS DECIMAL(18,3)) AS ehail_fee,",
    "",
)

# Fact

YELLOW_TRIPS = "SELECT *, 'Yellow' AS service_type FROM stg_yellow"
GREEN_TRIPS = "SELECT *, 'Green' AS service_type FROM stg_green"
UNION_BY_NAME = f"{YELLOW_TRIPS} UNION ALL BY NAME {GREEN_TRIPS}"
UNION_BY_POSITION = f"{YELLOW_TRIPS} UNION ALL {GREEN_TRIPS}"
FACT = """
    SELECT t.tripid, t.vendorid, t.service_type, t.ratecodeid,
           t.pickup_locationid, p.borough AS pickup_borough, p.zone AS pickup_zone,
           t.dropoff_locationid, d.borough AS dropoff_borough, d.zone AS dropoff_zone,
           t.pickup_datetime, t.dropoff_datetime, t.store_and_fwd_flag, t.count_passenger,
           t.trip_distance, t.trip_type, t.fare_amount, t.extra, t.mta_tax, t.tip_amount,
           t.tolls_amount, t.airport_fee, t.improvement_surcharge, t.total_amount,
           t.congestion_surcharge, t.payment_type, t.payment_type_describe
    FROM trips t
    JOIN (SELECT * FROM dim_zone WHERE borough <> 'Unknown') p
      ON t.pickup_locationid = p.locationid
    JOIN (SELECT * FROM dim_zone WHERE borough <> 'Unknown') d
      ON t.dropoff_locationid = d.locationid"""
DIM_ZONE = """
    SELECT locationid, borough, zone, replace(service_zone, 'Boro', 'Green') AS service_zone
    FROM zones"""

EVENT_TRIPS = """
    SELECT event_id,
           CASE WHEN event_type IN ('click', 'view', 'error') THEN 'Yellow' ELSE 'Green' END
               AS service_type,
           ts AS pickup_datetime,
           ts + to_milliseconds(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END
               * CAST(CAST(value AS DECIMAL(18,3)) * 60000 AS BIGINT)) AS dropoff_datetime,
           CAST(CAST(user_id AS DECIMAL(18,3)) * 0.125 AS DECIMAL(18,3)) AS trip_distance,
           CAST(CAST(CAST(user_id AS DECIMAL(18,3)) * 0.125 AS DECIMAL(18,3)) * 2.5
               + CAST(value AS DECIMAL(18,3)) AS DECIMAL(18,3)) AS total_amount
    FROM events"""

# Marts

SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_airport_fee": "airport_fee",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_congestion_surcharge": "congestion_surcharge",
    "revenue_monthly_total_amount": "total_amount",
}
MONTHLY = f"""
    SELECT pickup_zone AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month,
           service_type,
           {", ".join(f"CAST(sum({source}) AS DOUBLE) AS {name}" for name, source in SUMS.items())},
           count(tripid) AS total_monthly_trips,
           avg(count_passenger) AS avg_monthly_count_passenger,
           CAST(sum(trip_distance) AS DOUBLE) / count(trip_distance) AS avg_monthly_trip_distance
    FROM fact_trips GROUP BY 1, 2, 3"""


def _hourly(trips: str) -> str:
    minutes = "date_diff('minute', pickup_datetime, dropoff_datetime)"
    return f"""
    SELECT service_type, date_trunc('month', pickup_datetime) AS report_month,
           CAST(extract(dow FROM pickup_datetime) AS INTEGER) AS day_of_week,
           CAST(extract(hour FROM pickup_datetime) AS INTEGER) AS hour_of_day,
           count(*) AS total_trips,
           avg({minutes}) AS avg_trip_duration_minutes,
           CAST(sum(trip_distance) AS DOUBLE) / count(trip_distance) AS avg_trip_distance_miles,
           round(avg(CASE WHEN {minutes} > 0
               THEN CAST(trip_distance AS DOUBLE) / ({minutes} / 60.0) END), 6) AS avg_speed_mph,
           round(avg(CASE WHEN {minutes} > 0
               THEN CAST(total_amount AS DOUBLE) / {minutes} END), 6) AS avg_revenue_per_minute
    FROM {trips}
    WHERE trip_distance > 0 AND dropoff_datetime > pickup_datetime
    GROUP BY 1, 2, 3, 4"""


ROUTES = """
    SELECT service_type, date_trunc('month', pickup_datetime) AS report_month,
           pickup_zone, dropoff_zone, count(tripid) AS trip_count,
           CAST(rank() OVER (
               PARTITION BY service_type, date_trunc('month', pickup_datetime)
               ORDER BY count(tripid) DESC) AS INTEGER) AS route_popularity_rank,
           CAST(sum(trip_distance) AS DOUBLE) / count(trip_distance) AS avg_distance,
           CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_cost_per_trip,
           CAST(sum(total_amount) AS DOUBLE) / nullif(CAST(sum(trip_distance) AS DOUBLE), 0)
               AS revenue_per_mile
    FROM fact_trips
    WHERE pickup_zone IS NOT NULL AND dropoff_zone IS NOT NULL
    GROUP BY 1, 2, 3, 4"""


def _tipping(keys: str, label: str) -> str:
    return f"""
    SELECT {keys}, count(tripid) AS total_trips,
           count(CASE WHEN tip_amount > 0 THEN 1 END) AS count_trips_with_tip,
           CAST(count(CASE WHEN tip_amount > 0 THEN 1 END) * 100.0 / count(tripid) AS DOUBLE)
               AS percentage_trips_with_tip,
           CAST(sum(tip_amount) AS DOUBLE) / count(tip_amount) AS avg_tip_amount,
           round(avg(CASE WHEN fare_amount > 0 AND payment_type_describe = '{label}'
               THEN CAST(tip_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE) * 100 END), 6)
               AS avg_tip_percentage
    FROM fact_trips WHERE total_amount > 0
    GROUP BY {keys} HAVING count(tripid) > 10"""


TIP_KEYS = "service_type, pickup_zone, payment_type_describe"
TIPS = _tipping(TIP_KEYS, "Credit card")

# Stored and reloaded raw rows

ROW_KEY = """md5(concat(
    coalesce(CAST(tpep_pickup_datetime AS VARCHAR), ''),
    coalesce(CAST(tpep_dropoff_datetime AS VARCHAR), ''),
    coalesce(CAST(PULocationID AS VARCHAR), ''),
    coalesce(CAST(CAST(trip_distance AS DECIMAL(18,3)) AS VARCHAR), '')))"""
MONTH_TEXT = "strftime(tpep_pickup_datetime, '%Y-%m')"
IN_MONTH = "{} >= TIMESTAMP '1997-05-01' AND {} < TIMESTAMP '1997-06-01'"
FIRST_LOAD = f"""
    SELECT {ROW_KEY} AS unique_row_id, 'first load' AS source_file, VendorID,
           CAST(fare_amount AS DOUBLE) AS fare_amount, {MONTH_TEXT} AS pickup_month
    FROM raw_yellow"""
SECOND_LOAD = f"""
    SELECT {ROW_KEY} AS unique_row_id, 'second load' AS source_file, VendorID,
           CAST(fare_amount + 10 AS DOUBLE) AS fare_amount, {MONTH_TEXT} AS pickup_month
    FROM raw_yellow
    WHERE {IN_MONTH.format("tpep_pickup_datetime", "tpep_pickup_datetime")}"""
UPSERTED = """
    SELECT * FROM first_load
    WHERE unique_row_id NOT IN (SELECT unique_row_id FROM second_load)
    UNION ALL SELECT * FROM second_load"""

# Named parts a query may start from, each after the parts it needs.
PARTS = {
    "raw_yellow": RAW_YELLOW,
    "raw_green": RAW_GREEN,
    "zones": ZONES,
    "dim_zone": DIM_ZONE,
    "stg_yellow": STAGED_YELLOW,
    "stg_green": STAGED_GREEN,
    "trips": UNION_BY_NAME,
    "fact_trips": FACT,
    "event_trips": EVENT_TRIPS,
    "monthly": MONTHLY,
    "hourly": _hourly("event_trips"),
    "routes": ROUTES,
    "tips": TIPS,
    "first_load": FIRST_LOAD,
    "second_load": SECOND_LOAD,
}


def sql(query: str, **replaced: str) -> str:
    """The query after a WITH clause of all parts, some of them replaced."""
    parts = {**PARTS, **replaced}
    return f"WITH {', '.join(f'{name} AS ({text})' for name, text in parts.items())} {query}"


def _by_trips(mean: str, trips: str) -> str:
    """Mean of means by trips, of the rows that have one."""
    return (
        f"round(sum({mean} * {trips}) / "
        f"CAST(sum(CASE WHEN {mean} IS NOT NULL THEN {trips} END) AS DOUBLE), 6)"
    )


def amounts_as_double(relation: str, names: str) -> str:
    """All columns of a relation, the named decimals as doubles."""
    casts = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names.split())
    return f"SELECT * REPLACE ({casts}) FROM {relation}"


AMOUNTS = (
    "trip_distance fare_amount extra mta_tax tip_amount tolls_amount "
    "improvement_surcharge total_amount congestion_surcharge"
)
TOTAL = "revenue_monthly_total_amount"


def _report_row(name: str, model: str, severity: str, failures: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{model}' AS model, '{severity}' AS severity, "
        f"({failures}) AS failures"
    )


def _orphan_count(column: str) -> str:
    return (
        f"SELECT count(*) FROM stg_yellow WHERE {column} IS NOT NULL AND {column} NOT IN "
        "(SELECT locationid FROM dim_zone WHERE borough <> 'Unknown')"
    )


REPORT = " UNION ALL ".join(
    [
        _report_row(
            "unique_stg_yellow_tripid",
            "stg_yellow",
            "warn",
            "SELECT count(*) FROM (SELECT tripid FROM stg_yellow WHERE tripid IS NOT NULL "
            "GROUP BY tripid HAVING count(*) > 1)",
        ),
        _report_row(
            "not_null_stg_yellow_tripid",
            "stg_yellow",
            "warn",
            "SELECT count(*) FROM stg_yellow WHERE tripid IS NULL",
        ),
        _report_row(
            "relationships_stg_yellow_pickup_locationid",
            "stg_yellow",
            "warn",
            _orphan_count("pickup_locationid"),
        ),
        _report_row(
            "relationships_stg_yellow_dropoff_locationid",
            "stg_yellow",
            "warn",
            _orphan_count("dropoff_locationid"),
        ),
        _report_row(
            "accepted_values_stg_yellow_payment_type",
            "stg_yellow",
            "warn",
            "SELECT count(DISTINCT payment_type) FROM stg_yellow "
            "WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6)",
        ),
        _report_row(
            "accepted_values_stg_yellow_count_passenger",
            "stg_yellow",
            "warn",
            "SELECT count(DISTINCT count_passenger) FROM stg_yellow "
            "WHERE count_passenger NOT IN (1, 2, 3)",
        ),
        _report_row(
            "unique_lineitem_l_orderkey_l_linenumber",
            "lineitem",
            "warn",
            "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber "
            "HAVING count(*) > 1)",
        ),
        _report_row(
            "not_null_dm_monthly_zone_revenue_monthly_total_amount",
            "dm_monthly_zone",
            "error",
            f"SELECT count(*) FROM monthly WHERE {TOTAL} IS NULL",
        ),
    ]
)

HOURS = ", ".join(
    f"CAST(sum(total_trips) FILTER (hour_of_day = {hour}) AS BIGINT) AS h{hour:02d}" for hour in range(24)
)

LAST_LOADED = """(
    SELECT max(loaded.pickup_datetime) FROM fact_trips loaded
    WHERE loaded.service_type = f.service_type
      AND loaded.pickup_datetime < TIMESTAMP '1999-01-01')"""

ORACLE: dict[str, str] = {
    # Scans and sources
    "scan_parquet": """
        SELECT l_returnflag, count(*) AS total_rows,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) AS DOUBLE) AS quantity,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,3))) AS DOUBLE) AS price
        FROM lineitem GROUP BY l_returnflag""",
    "scan_union_by_name": """
        SELECT c_custkey, c_name, c_nationkey, s_suppkey, s_name, s_nationkey
        FROM (SELECT * FROM customer UNION ALL BY NAME SELECT * FROM supplier)""",
    "month_partition_scan": f"""
        SELECT o_orderkey, o_custkey, o_orderdate,
               'yellow/1997/05/yellow_tripdata_1997-05.parquet' AS file_key
        FROM orders WHERE {IN_MONTH.format("o_orderdate", "o_orderdate")}""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS total_rows FROM {name}" for name in TABLES
    ),
    "source_lineage": """
        SELECT 'lineitem.parquet' AS source_file, count(*) AS total_rows FROM lineitem""",
    "temp_view": """
        SELECT o_orderstatus, count(*) AS total_rows, max(o_orderdate) AS last_order
        FROM orders GROUP BY o_orderstatus""",
    "schema_only": """
        SELECT 'schema only' AS what, count(*) AS total_rows FROM orders WHERE 1 = 0
        UNION ALL SELECT 'loaded' AS what, count(*) AS total_rows FROM orders""",
    "landed_months": sql(f"""
        SELECT 'yellow' AS taxi_type, VendorID, PULocationID,
               CAST(fare_amount AS DOUBLE) AS fare_amount
        FROM raw_yellow
        WHERE {IN_MONTH.format("tpep_pickup_datetime", "tpep_pickup_datetime")}
        UNION ALL
        SELECT 'green' AS taxi_type, VendorID, PULocationID,
               CAST(fare_amount AS DOUBLE) AS fare_amount
        FROM raw_green
        WHERE {IN_MONTH.format("lpep_pickup_datetime", "lpep_pickup_datetime")}"""),
    "scan_zone_csv": sql(
        'SELECT locationid AS "LocationID", borough AS "Borough", zone AS "Zone", service_zone '
        "FROM zones"
    ),
    # Scalar operators
    "row_hash_key": sql(f"""
        SELECT {ROW_KEY} AS unique_row_id, 'yellow' AS source_file, {MONTH_TEXT} AS pickup_month,
               PULocationID, trip_distance
        FROM raw_yellow"""),
    "surrogate_key": sql("""
        SELECT VendorID, tpep_pickup_datetime AS pickup_datetime,
               md5(CAST(VendorID AS VARCHAR) || '-' || CAST(tpep_pickup_datetime AS VARCHAR))
                   AS tripid,
               md5(CAST(VendorID AS VARCHAR) || '-'
                   || coalesce(nullif(store_and_fwd_flag, 'N'), '_dbt_utils_surrogate_key_null_'))
                   AS flag_key
        FROM raw_yellow"""),
    "safe_cast_int": """
        SELECT p_partkey,
               TRY_CAST(p_retailprice AS INTEGER) AS from_double,
               TRY_CAST(CAST(p_retailprice AS VARCHAR) AS INTEGER) AS from_text,
               TRY_CAST(CAST(p_retailprice AS DECIMAL(18,3)) AS INTEGER) AS from_decimal,
               TRY_CAST(CAST(p_size AS DOUBLE) / 2 AS INTEGER) AS from_half,
               TRY_CAST(p_name AS INTEGER) AS from_word
        FROM part""",
    "safe_cast_timestamp": """
        SELECT event_id, TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS from_text,
               TRY_CAST(event_type AS TIMESTAMP) AS from_word
        FROM events""",
    "cast_decimal": """
        SELECT l_orderkey, l_linenumber,
               CAST(CAST(l_extendedprice AS DECIMAL(18,3)) AS DOUBLE) AS fare_amount,
               CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,3))
                   * CAST(l_discount AS DECIMAL(18,3)) AS DECIMAL(18,3)) AS DOUBLE) AS tip_amount
        FROM lineitem""",
    "coalesce_default": """
        SELECT o_orderkey,
               coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 0) AS code,
               coalesce(TRY_CAST(substr(o_orderpriority, 3, 20) AS INTEGER), 0) AS no_code,
               CAST(coalesce(TRY_CAST(o_totalprice AS DECIMAL(18,3)), 0) AS DOUBLE) AS amount,
               CAST(coalesce(TRY_CAST(substr(o_orderpriority, 3, 20) AS DECIMAL(18,3)), 0)
                   AS DOUBLE) AS no_amount
        FROM orders""",
    "payment_label": sql(f"""
        SELECT code, {LABEL.format(code="code")} AS label, count(*) AS trips
        FROM (SELECT nullif(TRY_CAST(payment_type AS INTEGER), 4) AS code FROM raw_yellow)
        GROUP BY code"""),
    "month_trunc": """
        SELECT o_orderkey, date_trunc('month', o_orderdate) AS month_start FROM orders""",
    "time_parts": """
        SELECT event_id, CAST(extract(dow FROM ts) AS INTEGER) AS day_of_week,
               CAST(extract(hour FROM ts) AS INTEGER) AS hour_of_day
        FROM events""",
    "minute_boundaries": sql("""
        SELECT event_id, pickup_datetime, dropoff_datetime,
               date_diff('minute', pickup_datetime, dropoff_datetime) AS minutes
        FROM event_trips"""),
    # Staging, dimension, fact
    "dedup_first": sql(f"""
        SELECT VendorID, lpep_pickup_datetime AS pickup_datetime,
               lpep_dropoff_datetime AS dropoff_datetime,
               CAST(fare_amount AS DOUBLE) AS fare_amount, trip_distance
        FROM ({
            _ranked(
                "raw_green",
                "lpep_pickup_datetime",
                "lpep_dropoff_datetime",
                "ehail_fee, trip_type",
            )
        }) WHERE rn = 1"""),
    "stage_trips": sql(amounts_as_double("stg_yellow", AMOUNTS + " airport_fee")),
    "stage_trips_green": sql(amounts_as_double("stg_green", AMOUNTS + " ehail_fee")),
    "sample_limit": sql("""
        SELECT 'Yellow' AS service_type, count(*) AS sampled_trips
        FROM (SELECT * FROM stg_yellow LIMIT 100)
        UNION ALL
        SELECT 'Green' AS service_type, count(*) AS sampled_trips
        FROM (SELECT * FROM stg_green LIMIT 100)"""),
    "dim_zone": sql("SELECT * FROM dim_zone"),
    "known_zones": sql("SELECT * FROM dim_zone WHERE borough <> 'Unknown'"),
    "union_services": sql(amounts_as_double("trips", AMOUNTS + " airport_fee ehail_fee")),
    "union_services_by_position": sql(
        amounts_as_double("trips", AMOUNTS + " airport_fee"), trips=UNION_BY_POSITION
    ),
    "fact_trips": sql(amounts_as_double("fact_trips", AMOUNTS + " airport_fee")),
    # Marts
    "monthly_zone_revenue": sql("SELECT * FROM monthly"),
    "monthly_zone_revenue_by_position": sql("SELECT * FROM monthly", trips=UNION_BY_POSITION),
    "hourly_operation": sql("SELECT * FROM hourly"),
    "hourly_operation_orders": sql(_hourly("fact_trips")),
    "od_routes": sql("SELECT * FROM routes"),
    "revenue_per_unit": sql("""
        SELECT pickup_zone, payment_type_describe,
               CAST(sum(total_amount) AS DOUBLE)
                   / nullif(CAST(sum(CASE WHEN payment_type_describe = 'Cash' THEN 0
                                          ELSE trip_distance END) AS DOUBLE), 0)
                   AS revenue_per_mile
        FROM fact_trips GROUP BY 1, 2"""),
    "tipping": sql("SELECT * FROM tips"),
    "tipping_as_written": sql(_tipping(TIP_KEYS, "Credit Card")),
    "having_min_group": sql(
        _tipping("service_type, pickup_zone, dropoff_zone, payment_type_describe", "Credit card")
    ),
    # Serving
    "kpi_totals": sql("""
        SELECT (SELECT CAST(sum(total_amount) AS DOUBLE) FROM fact_trips) AS total_revenue,
               CAST(sum(total_monthly_trips) AS BIGINT) AS total_trips,
               round(avg(avg_monthly_trip_distance), 6) AS avg_distance
        FROM monthly"""),
    "weighted_distance": sql("""
        SELECT round(CAST(sum(trip_distance) AS DOUBLE) / count(trip_distance), 6) AS avg_distance
        FROM fact_trips"""),
    "revenue_trend": sql("""
        SELECT date_trunc('month', pickup_datetime) AS revenue_month, service_type,
               CAST(sum(total_amount) AS DOUBLE) AS revenue_monthly_total_amount
        FROM fact_trips GROUP BY 1, 2"""),
    "top_zones": sql("""
        SELECT pickup_zone AS revenue_zone,
               CAST(sum(total_amount) AS DOUBLE) AS revenue_monthly_total_amount
        FROM fact_trips GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "service_choices": sql("SELECT DISTINCT service_type FROM hourly"),
    "weekday_hour_heatmap": sql("""
        SELECT day_of_week, hour_of_day, CAST(sum(total_trips) AS BIGINT) AS total_trips
        FROM hourly WHERE service_type = 'Yellow' GROUP BY 1, 2"""),
    "weekday_hour_grid": sql(f"""
        SELECT day_of_week, {HOURS} FROM hourly WHERE service_type = 'Yellow' GROUP BY 1"""),
    "revenue_levels": sql(f"""
        SELECT CASE grouping(revenue_zone, revenue_month) WHEN 3 THEN 'total' WHEN 2 THEN 'trend' ELSE 'zone' END AS level,
               revenue_zone, revenue_month, service_type, CAST(sum({TOTAL}) AS DOUBLE) AS {TOTAL},
               CAST(sum(total_monthly_trips) AS BIGINT) AS total_trips
        FROM (SELECT * REPLACE (CAST({TOTAL} AS DECIMAL(38,3)) AS {TOTAL}) FROM monthly)
        GROUP BY GROUPING SETS ((revenue_zone), (revenue_month, service_type), ())"""),
    "speed_by_hour": sql(
        """
        SELECT hour_of_day, round(avg(avg_speed_mph), 6) AS avg_speed_mph
        FROM hourly WHERE service_type = 'Yellow' GROUP BY 1""",
        hourly=_hourly("event_trips").replace("round(", "(").replace(", 6)", ")"),
    ),
    "speed_by_hour_weighted": sql(
        f"""
        SELECT hour_of_day, {_by_trips("avg_speed_mph", "total_trips")} AS avg_speed_mph
        FROM hourly WHERE service_type = 'Yellow' GROUP BY 1""",
        hourly=_hourly("event_trips").replace("round(", "(").replace(", 6)", ")"),
    ),
    "top_routes_weighted": sql(f"""
        SELECT pickup_zone, dropoff_zone, CAST(sum(trip_count) AS BIGINT) AS total_trips,
               {_by_trips("avg_cost_per_trip", "trip_count")} AS avg_cost
        FROM routes GROUP BY 1, 2 ORDER BY total_trips DESC, 1, 2 LIMIT 10"""),
    "tip_by_payment_weighted": sql(
        f"""
        SELECT payment_type_describe, {_by_trips("avg_tip_percentage", "total_trips")} AS tip_pct,
               CAST(sum(total_trips) AS BIGINT) AS trips
        FROM tips WHERE payment_type_describe IS NOT NULL GROUP BY 1""",
        tips=TIPS.replace("round(", "(").replace(", 6)", ")"),
    ),
    "top_routes": sql("""
        SELECT pickup_zone, dropoff_zone, CAST(sum(trip_count) AS BIGINT) AS total_trips,
               round(avg(avg_cost_per_trip), 6) AS avg_cost
        FROM routes GROUP BY 1, 2 ORDER BY total_trips DESC, 1, 2 LIMIT 10"""),
    "tip_by_payment": sql(
        """
        SELECT payment_type_describe, round(avg(avg_tip_percentage), 6) AS tip_pct,
               CAST(sum(total_trips) AS BIGINT) AS trips
        FROM tips WHERE payment_type_describe IS NOT NULL GROUP BY 1""",
        tips=TIPS.replace("round(", "(").replace(", 6)", ")"),
    ),
    # Upsert and incremental load
    "semi_join_reloaded": sql(
        "SELECT * FROM first_load WHERE EXISTS (SELECT 1 FROM second_load s "
        "WHERE s.unique_row_id = first_load.unique_row_id)"
    ),
    "keyed_upsert": sql(UPSERTED),
    "upsert_table": sql(UPSERTED),
    "upsert_bucketed": sql(UPSERTED),
    "upsert_filtered": sql(UPSERTED),
    "incremental_watermark": sql(f"""
        SELECT tripid, service_type, pickup_datetime FROM fact_trips f
        WHERE pickup_datetime > {LAST_LOADED}"""),
    "incremental_load": sql(amounts_as_double("fact_trips", AMOUNTS + " airport_fee")),
    "tipping_partials": sql("SELECT * FROM tips"),
    "upsert_versioned": sql(UPSERTED),
    "stream_arrivals": sql(UPSERTED),
    "published_snapshot": sql("SELECT * FROM monthly"),
    "published_months": sql("SELECT * FROM monthly"),
    # Data checks
    "dq_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_records
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_not_null": sql("""
        SELECT revenue_zone, revenue_month, service_type FROM monthly
        WHERE service_type <> 'Yellow'"""),
    "dq_relationships": sql("""
        SELECT tripid, pickup_locationid FROM stg_yellow
        WHERE pickup_locationid NOT IN (SELECT locationid FROM dim_zone
                                        WHERE borough <> 'Unknown')"""),
    "dq_accepted_values": sql("""
        SELECT payment_type, count(*) AS n_records FROM stg_green
        WHERE payment_type NOT IN (1, 2, 3) GROUP BY 1"""),
    "dq_report": sql(REPORT),
    "dq_report_observed": sql(REPORT),
}
