"""The queries once more, as SQL over the driver's test tables."""

from __future__ import annotations

import re


def _mean(total: str, count: str, kind: str) -> str:
    """A non-negative amount in hundredths over a count, rounded half up."""
    twice = f"2 * CAST({total} * 100 AS HUGEINT)"
    cents = f"({twice} + {count}) // (2 * {count})"
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * 0.01 AS {kind})"


def _newest(deliveries: str, key: str, moment: str) -> str:
    """The latest delivery of each key."""
    return (
        f"SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {moment} DESC) AS place "
        f"FROM {deliveries} WHERE {key} IS NOT NULL) WHERE place = 1"
    )


_OPEN_END = "DATE '9999-12-31'"

# Steps in order; each may use the ones before it.
_STEPS = {
    "users": """
        SELECT CAST(c_custkey AS INT) AS user_id, c_name AS name,
               lower(c_mktsegment) || c_custkey || '@example.com' AS email,
               n_name AS city,
               TIMESTAMP '2023-01-01' + to_seconds(c_custkey) AS created_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "routes": """
        SELECT CAST(substr(p_brand, 7) AS INT) AS route_id, p_brand AS route_number,
               arg_min(p_type, p_partkey) AS vehicle_type,
               CAST(min(p_retailprice) AS DECIMAL(10,2)) AS base_fare
        FROM part GROUP BY p_brand""",
    "vehicles": """
        SELECT CAST(s_suppkey AS INT) AS vehicle_id,
               CAST(1 + s_suppkey % 25 AS INT) AS route_id,
               s_name AS license_plate, CAST(50 + s_suppkey % 71 AS INT) AS capacity
        FROM supplier""",
    "line": """
        SELECT l_orderkey, l_partkey, l_suppkey
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                        ORDER BY l_linenumber, l_partkey, l_suppkey) AS place FROM lineitem)
        WHERE place = 1""",
    "departures": """
        SELECT *, TIMESTAMP '2024-01-01'
                  + to_days(CAST(date_diff('day', DATE '1995-01-01',
                                           CAST(o_orderdate AS DATE)) % 7 AS INT))
                  + to_seconds(o_orderkey * 7919 % 86400) AS start_time
        FROM orders""",
    "rides": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ride_id,
               CAST(o_custkey % 20 AS INT) AS user_id,
               CAST(substr(p_brand, 7) AS INT) AS route_id,
               CAST(l_suppkey AS INT) AS vehicle_id, start_time,
               start_time + to_minutes(5 + o_orderkey % 86) AS end_time,
               CAST(o_totalprice AS DECIMAL(10,2)) AS fare_amount
        FROM departures LEFT JOIN line ON l_orderkey = o_orderkey
             LEFT JOIN part ON p_partkey = l_partkey""",
    "payments": """
        SELECT 'P' || o_orderkey AS payment_id, CAST(o_orderkey AS VARCHAR) AS ride_id,
               CAST(o_custkey % 20 AS INT) AS user_id,
               CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
               o_orderpriority AS payment_method,
               CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pending'
                                  WHEN 'P' THEN 'failed' END AS status,
               start_time + to_minutes(5 + o_orderkey % 86) AS created_at
        FROM departures""",
    "vehicle_positions": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INT) AS vehicle_id,
               'Brand#' || (1 + user_id % 25) AS route_number, ts AS event_time,
               CAST(55 + CAST(user_id % 100 AS DECIMAL(9,6)) * 0.001 AS DECIMAL(9,6)) AS latitude,
               CAST(37 + CAST(event_id % 100 AS DECIMAL(9,6)) * 0.001 AS DECIMAL(9,6)) AS longitude,
               CAST(value AS DECIMAL(5,2)) AS speed_kmh,
               CAST(json_extract_string(props, '$.k') AS INT) AS passengers_estimated
        FROM events""",
    "redelivered_users": """
        SELECT * FROM users
        UNION ALL
        SELECT user_id, name, email, 'MOVED', created_at + INTERVAL 1 DAY
        FROM users WHERE user_id % 10 = 0
        UNION ALL
        SELECT NULL, name, email, city, created_at FROM users WHERE user_id % 50 = 1""",
    "redelivered_rides": """
        SELECT * FROM rides
        UNION ALL
        SELECT ride_id, user_id, route_id, vehicle_id, start_time,
               end_time + INTERVAL 1 MINUTE, fare_amount
        FROM rides WHERE CAST(ride_id AS BIGINT) % 20 = 0""",
    "redelivered_payments": """
        SELECT * FROM payments
        UNION ALL
        SELECT payment_id, ride_id, user_id, amount, payment_method, 'success',
               created_at + INTERVAL 1 MINUTE
        FROM payments WHERE CAST(ride_id AS BIGINT) % 20 = 0""",
    "faulty_payments": """
        SELECT payment_id, ride_id,
               CASE WHEN CAST(ride_id AS BIGINT) % 25 = 5 THEN '99999999999'
                    ELSE CAST(user_id AS VARCHAR) END AS user_id,
               CASE WHEN CAST(ride_id AS BIGINT) % 10 = 3 THEN 'n/a'
                    ELSE CAST(amount AS VARCHAR) END AS amount,
               payment_method, status,
               CASE WHEN CAST(ride_id AS BIGINT) % 15 = 3 THEN 'yesterday'
                    ELSE CAST(created_at AS VARCHAR) END AS created_at
        FROM payments""",
    "checked_payments": """
        SELECT *, TRY_CAST(user_id AS INT) AS user_fits,
               TRY_CAST(amount AS DECIMAL(10,2)) AS amount_fits,
               TRY_CAST(created_at AS TIMESTAMP) AS moment_fits
        FROM faulty_payments""",
    "dim_user": """
        SELECT CAST(row_number() OVER (ORDER BY user_id) AS INT) AS user_sk, * FROM users""",
    "dim_vehicle": """
        SELECT CAST(row_number() OVER (ORDER BY vehicle_id) AS INT) AS vehicle_sk,
               vehicle_id, license_plate, capacity FROM vehicles""",
    "dim_route": f"""
        SELECT CAST(row_number() OVER (ORDER BY route_id) AS INT) AS route_sk, routes.*,
               DATE '2024-01-01' AS valid_from, {_OPEN_END} AS valid_to, TRUE AS is_current
        FROM routes""",
    "changed_routes": """
        SELECT route_id, route_number, vehicle_type,
               CAST(CASE WHEN route_id % 5 = 0 THEN base_fare + 5 ELSE base_fare END
                    AS DECIMAL(10,2)) AS base_fare
        FROM routes WHERE route_id <> 25
        UNION ALL
        SELECT 26, 'Brand#26', 'metro', CAST(60 AS DECIMAL(10,2))""",
    "new_versions": """
        SELECT c.* FROM changed_routes c LEFT JOIN dim_route d USING (route_id)
        WHERE d.route_id IS NULL
           OR c.route_number IS DISTINCT FROM d.route_number
           OR c.vehicle_type IS DISTINCT FROM d.vehicle_type
           OR c.base_fare IS DISTINCT FROM d.base_fare""",
    "dim_route_scd2": f"""
        SELECT route_sk, d.route_id, d.route_number, d.vehicle_type, d.base_fare, valid_from,
               CASE WHEN n.route_id IS NULL THEN valid_to ELSE DATE '2024-01-31' END AS valid_to,
               n.route_id IS NULL AS is_current
        FROM dim_route d LEFT JOIN new_versions n ON n.route_id = d.route_id
        UNION ALL
        SELECT CAST((SELECT max(route_sk) FROM dim_route)
                    + row_number() OVER (ORDER BY route_id) AS INT),
               route_id, route_number, vehicle_type, base_fare,
               DATE '2024-02-01', {_OPEN_END}, TRUE
        FROM new_versions""",
    "dim_user_kept": """
        SELECT CAST(row_number() OVER (ORDER BY user_id % 3 = 0, user_id) AS INT) AS user_sk, *
        FROM users""",
    "route_states": """
        SELECT *, DATE '2024-01-01' AS valid_from FROM routes
        UNION ALL SELECT *, DATE '2024-02-01' FROM changed_routes
        UNION ALL SELECT *, DATE '2024-03-01' FROM routes""",
    "route_changes": """
        SELECT * EXCLUDE (place, earlier)
        FROM (SELECT *, row_number() OVER run AS place,
                     lag((route_number, vehicle_type, base_fare)) OVER run AS earlier
              FROM route_states
              WINDOW run AS (PARTITION BY route_id ORDER BY valid_from))
        WHERE place = 1 OR (route_number, vehicle_type, base_fare) IS DISTINCT FROM earlier""",
    "dim_route_three": f"""
        SELECT CAST(row_number() OVER (ORDER BY valid_from, route_id) AS INT) AS route_sk,
               route_id, route_number, vehicle_type, base_fare, valid_from,
               coalesce(CAST(lead(valid_from) OVER run - INTERVAL 1 DAY AS DATE), {_OPEN_END})
                   AS valid_to,
               lead(valid_from) OVER run IS NULL AS is_current
        FROM route_changes
        WINDOW run AS (PARTITION BY route_id ORDER BY valid_from)""",
    "dim_date": """
        SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_sk, full_date,
               CAST(year(full_date) AS INT) AS year, CAST(month(full_date) AS INT) AS month,
               CAST(day(full_date) AS INT) AS day,
               CAST(dayofweek(full_date) + 1 AS INT) AS day_of_week
        FROM (SELECT CAST(unnest(generate_series(CAST(min(t) AS DATE), CAST(max(t) AS DATE),
                                                 INTERVAL 1 DAY)) AS DATE) AS full_date
              FROM (SELECT start_time AS t FROM rides
                    UNION ALL SELECT created_at FROM payments))""",
    "fact_rides": """
        SELECT ride_id, user_sk, route_sk, vehicle_sk, start_time, end_time,
               CAST(date_diff('second', start_time, end_time) AS INT) AS ride_duration_sec,
               fare_amount, CAST(strftime(start_time, '%Y%m%d') AS INT) AS date_sk
        FROM rides r
             LEFT JOIN dim_user u ON u.user_id = r.user_id
             LEFT JOIN dim_route d ON d.route_id = r.route_id AND d.is_current
             LEFT JOIN dim_vehicle v ON v.vehicle_id = r.vehicle_id""",
    "fact_payments": """
        SELECT payment_id, ride_id, user_sk, amount, payment_method, status, p.created_at,
               CAST(strftime(p.created_at, '%Y%m%d') AS INT) AS date_sk
        FROM payments p LEFT JOIN dim_user u ON u.user_id = p.user_id""",
    "fact_vehicle_movement": f"""
        SELECT route_sk, CAST(strftime(event_time, '%Y%m%d') AS INT) AS date_sk,
               {_mean("sum(speed_kmh)", "count(speed_kmh)", "DECIMAL(5,2)")} AS avg_speed,
               CAST(sum(passengers_estimated) // count(passengers_estimated) AS INT)
                   AS avg_passengers,
               count(*) AS events_count
        FROM vehicle_positions p
             LEFT JOIN dim_route d ON d.route_number = p.route_number AND d.is_current
        GROUP BY ALL""",
    "increment_rides": f"""
        SELECT ride_id, user_sk, route_sk, vehicle_sk, start_time, end_time,
               CAST(date_diff('second', start_time, end_time) AS INT) AS ride_duration_sec,
               fare_amount, CAST(strftime(start_time, '%Y%m%d') AS INT) AS date_sk
        FROM ({_newest("redelivered_rides", "ride_id", "end_time")}) r
             LEFT JOIN dim_user_kept u ON u.user_id = r.user_id
             LEFT JOIN dim_route d ON d.route_id = r.route_id AND d.is_current
             LEFT JOIN dim_vehicle v ON v.vehicle_id = r.vehicle_id""",
    "increment_payments": f"""
        SELECT payment_id, ride_id, user_sk, amount, payment_method, status, p.created_at,
               CAST(strftime(p.created_at, '%Y%m%d') AS INT) AS date_sk
        FROM ({_newest("redelivered_payments", "payment_id", "created_at")}) p
             LEFT JOIN dim_user_kept u ON u.user_id = p.user_id""",
    "user_behavior_rides": f"""
        SELECT full_date, CAST(hour(start_time) AS INT) AS hour_of_day,
               CAST(dayofweek(start_time) + 1 AS INT) AS day_of_week,
               city, user_id, route_number, vehicle_type,
               count(ride_id) AS total_rides,
               CAST(sum(fare_amount) AS DECIMAL(18,2)) AS total_revenue,
               CAST(sum(ride_duration_sec) // count(ride_duration_sec) AS INT)
                   AS avg_duration_seconds,
               {_mean("sum(fare_amount)", "count(fare_amount)", "DECIMAL(18,2)")} AS avg_fare
        FROM fact_rides JOIN dim_user USING (user_sk) JOIN dim_route USING (route_sk)
             JOIN dim_date USING (date_sk)
        WHERE is_current
        GROUP BY ALL""",
    "user_behavior_payments": """
        SELECT full_date, CAST(hour(p.created_at) AS INT) AS hour_of_day,
               CAST(dayofweek(p.created_at) + 1 AS INT) AS day_of_week,
               city, user_id, route_number, vehicle_type, payment_method,
               count(*) AS total_payments,
               count(*) FILTER (WHERE status = 'success') AS successful_payments
        FROM fact_payments p JOIN fact_rides r USING (ride_id)
             JOIN dim_user u ON u.user_sk = p.user_sk
             JOIN dim_route d ON d.route_sk = r.route_sk
             JOIN dim_date c ON c.date_sk = p.date_sk
        WHERE is_current
        GROUP BY ALL""",
    "user_behavior_hourly": """
        SELECT full_date, hour_of_day, day_of_week, city, user_id, route_number, vehicle_type,
               payment_method,
               coalesce(total_rides, 0) AS total_rides,
               coalesce(total_revenue, CAST(0 AS DECIMAL(18,2))) AS total_revenue,
               coalesce(avg_duration_seconds, 0) AS avg_duration_seconds,
               coalesce(avg_fare, CAST(0 AS DECIMAL(18,2))) AS avg_fare,
               coalesce(total_payments, 0) AS total_payments,
               coalesce(successful_payments, 0) AS successful_payments
        FROM user_behavior_rides FULL JOIN user_behavior_payments
             USING (full_date, hour_of_day, day_of_week, city, user_id, route_number,
                    vehicle_type)""",
    "dashboard_daily": f"""
        SELECT full_date, route_number, vehicle_type, count(ride_id) AS total_rides,
               CAST(sum(fare_amount) AS DECIMAL(18,2)) AS total_revenue,
               {_mean("sum(ride_duration_sec)", "count(ride_duration_sec)", "DECIMAL(18,2)")}
                   AS avg_duration_seconds,
               {_mean("sum(fare_amount)", "count(fare_amount)", "DECIMAL(18,2)")} AS avg_fare
        FROM fact_rides JOIN dim_route USING (route_sk) JOIN dim_vehicle USING (vehicle_sk)
             JOIN dim_date USING (date_sk)
        WHERE is_current
        GROUP BY ALL""",
    "null_checks": """
        SELECT 'fact_rides' AS table_name, count(*) AS null_count,
               'user_sk is null' AS check_type FROM fact_rides WHERE user_sk IS NULL
        UNION ALL
        SELECT 'fact_rides', count(*), 'route_sk is null' FROM fact_rides WHERE route_sk IS NULL
        UNION ALL
        SELECT 'dim_user', count(*), 'user_id is null' FROM dim_user WHERE user_id IS NULL""",
    "freshness": """
        SELECT 'fact_rides' AS table_name, max(start_time) AS latest_record,
               date_diff('second', max(start_time), TIMESTAMP '2024-01-09 03:00:00') AS data_lag
        FROM fact_rides""",
    "duplicate_checks": """
        SELECT 'dim_user' AS table_name,
               count(*) - count(DISTINCT user_id) AS duplicate_count FROM dim_user
        UNION ALL
        SELECT 'fact_rides', count(*) - count(DISTINCT ride_id) FROM fact_rides
        UNION ALL
        SELECT 'redelivered_users', count(*) - count(DISTINCT user_id) FROM redelivered_users
        UNION ALL
        SELECT 'redelivered_rides', count(*) - count(DISTINCT ride_id) FROM redelivered_rides""",
    "quality_log": """
        SELECT TIMESTAMP '2024-01-09 03:00:00' AS check_date, table_name, check_type,
               CAST(result AS VARCHAR) AS result_value,
               CASE WHEN result <= bound THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT table_name, check_type, null_count AS result, 0 AS bound FROM null_checks
              UNION ALL
              SELECT table_name, 'freshness', data_lag, 86400 FROM freshness
              UNION ALL
              SELECT table_name, 'duplicates', duplicate_count, 0 FROM duplicate_checks)""",
}


def _sql(select: str) -> str:
    steps = ",\n".join(f"{name} AS ({body})" for name, body in _STEPS.items())
    return f"WITH {steps}\n{select}"


def _cleaned_sql(select: str) -> str:
    """As ``_sql``, with the star built from cleaned deliveries instead of raw tables."""
    cleaned = {
        "users": ("user_id", "created_at"),
        "rides": ("ride_id", "end_time"),
        "payments": ("payment_id", "created_at"),
    }
    steps = {}
    for name, body in _STEPS.items():
        if name == "dim_user":
            for entity, (key, moment) in cleaned.items():
                steps[f"silver_{entity}"] = _newest(f"redelivered_{entity}", key, moment)
        if any(f"silver_{entity}" in steps for entity in cleaned):
            body = re.sub(r"\b(users|rides|payments)\b", r"silver_\1", body)
        steps[name] = body
    joined = ",\n".join(f"{name} AS ({body})" for name, body in steps.items())
    return f"WITH {joined}\n{select}"


def _staged(entity: str) -> str:
    return _sql(f"SELECT *, TIMESTAMP '2024-01-09 02:00:00' AS load_ts FROM {entity}")


def _latest(deliveries: str, key: str, moment: str) -> str:
    return _sql(_newest(deliveries, key, moment))


ORACLE_SQL = {
    "stg_users": _staged("users"),
    "stg_routes": _staged("routes"),
    "stg_vehicles": _staged("vehicles"),
    "stg_rides": _staged("rides"),
    "stg_payments": _staged("payments"),
    "stg_vehicle_positions": _staged("vehicle_positions"),
    "silver_users": _latest("redelivered_users", "user_id", "created_at"),
    "silver_rides": _latest("redelivered_rides", "ride_id", "end_time"),
    "silver_payments": _latest("redelivered_payments", "payment_id", "created_at"),
    "silver_routes": _sql("SELECT * FROM routes"),
    "silver_vehicles": _sql("SELECT * FROM vehicles"),
    "silver_vehicle_positions": _sql("SELECT * FROM vehicle_positions"),
    "surrogate_keys_unique": _sql("SELECT user_sk, user_id, created_at, email FROM dim_user"),
    "staging_appended": _sql(
        "SELECT *, TIMESTAMP '2024-01-09 02:00:00' AS load_ts FROM users UNION ALL "
        "SELECT *, TIMESTAMP '2024-01-09 03:00:00' FROM users"
    ),
    "routes_or_empty": _sql("SELECT * FROM routes"),
    "surrogate_keys_kept": _sql("SELECT * FROM dim_user_kept"),
    "dim_user_after_broken_load": _sql("SELECT * FROM dim_user"),
    "staging_repeated": _staged("users"),
    "quarantine_accepted": _sql(
        "SELECT payment_id, ride_id, user_fits AS user_id, amount_fits AS amount, "
        "payment_method, status, moment_fits AS created_at, "
        "TIMESTAMP '2024-01-09 02:00:00' AS load_ts FROM checked_payments WHERE user_fits "
        "IS NOT NULL AND amount_fits IS NOT NULL AND moment_fits IS NOT NULL"
    ),
    "quarantine_rejected": _sql(
        "SELECT concat_ws('; ', CASE WHEN user_fits IS NULL THEN 'user_id is no int' END, "
        "CASE WHEN amount_fits IS NULL THEN 'amount is no decimal(10,2)' END, "
        "CASE WHEN moment_fits IS NULL THEN 'created_at is no timestamp_ntz' END) AS reasons, "
        "CAST(json_object('payment_id', payment_id, 'ride_id', ride_id, 'user_id', user_id, "
        "'amount', amount, 'payment_method', payment_method, 'status', status, "
        "'created_at', created_at) AS VARCHAR) AS delivered, "
        "TIMESTAMP '2024-01-09 02:00:00' AS load_ts FROM checked_payments WHERE user_fits "
        "IS NULL OR amount_fits IS NULL OR moment_fits IS NULL"
    ),
    "dim_route_three_snapshots": _sql("SELECT * FROM dim_route_three"),
    "increment_movement": _sql("SELECT * FROM fact_vehicle_movement"),
    "nightly_dashboard": _cleaned_sql("SELECT * FROM dashboard_daily"),
    "nightly_payments": _cleaned_sql("SELECT * FROM fact_payments"),
    "surrogate_keys": _sql(
        "SELECT CAST(1000 + row_number() OVER (ORDER BY user_id NULLS LAST, created_at, email) "
        "AS INT) AS user_sk, user_id, created_at, email FROM redelivered_users"
    ),
    "dim_route_first_load": _sql("SELECT * FROM dim_route"),
    "current_routes": _sql("SELECT * FROM dim_route_scd2 WHERE is_current"),
    "user_behavior_stored": _sql(
        "SELECT *, CAST(strftime(full_date, '%Y%m') AS INT) AS yyyymm FROM user_behavior_hourly"
    ),
    "row_counts": _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
            for name in ["dim_user", "dim_route", "dim_vehicle", "fact_rides"]
        )
    ),
    "failed_checks": _sql("SELECT * FROM quality_log WHERE status = 'FAIL'"),
    **{
        name: _sql(f"SELECT * FROM {name}")
        for name in [
            "dim_user",
            "dim_vehicle",
            "dim_date",
            "dim_route_scd2",
            "fact_rides",
            "fact_payments",
            "fact_vehicle_movement",
            "increment_rides",
            "increment_payments",
            "user_behavior_rides",
            "user_behavior_payments",
            "user_behavior_hourly",
            "dashboard_daily",
            "null_checks",
            "freshness",
            "duplicate_checks",
            "quality_log",
        ]
    },
}
