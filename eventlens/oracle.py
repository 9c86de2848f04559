"""DuckDB SQL oracles for the differential check.

Each entry is plain SQL over the driver's tables (``events``, ``customer``,
``nation``) that computes the same result as the Spark query of the same
key, written independently: fixture views as CTEs, windows by epoch
arithmetic, and decimal averages by exact integer arithmetic (DuckDB's AVG
of a DECIMAL is a DOUBLE), rounding half away from zero like Spark's
decimal casts.
"""

from __future__ import annotations

EPOCH = 1704067200


def ts_from_epoch(seconds_expr: str) -> str:
    return f"make_timestamp(CAST({seconds_expr} AS BIGINT) * 1000000)"


def avg_dec(scaled_int: str, in_scale: int, out_scale: int, out_type: str) -> str:
    """Exact average of a decimal column given as a scaled integer
    expression, rounded half away from zero to ``out_scale``."""
    up = 10 ** (out_scale - in_scale)
    s = f"SUM(CAST({scaled_int} AS HUGEINT))"
    n = f"COUNT({scaled_int})"
    q = f"(SIGN({s}) * ((2 * ABS({s}) * {up} + {n}) // (2 * {n})))"
    unit = f"CAST(1e-{out_scale} AS DECIMAL({out_scale + 1},{out_scale}))" if out_scale else "1"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * {unit} AS {out_type})"


def bucket(ts: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


# -- fixture views ---------------------------------------------------------

FIXTURES = f"""
u AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
),
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, u.c_name, u.c_mktsegment, u.n_name
  FROM events e JOIN u ON u.c_custkey = e.user_id
),
T AS (
  SELECT
    'tx_' || CAST(event_id AS VARCHAR) AS transaction_id,
    'u_' || CAST(user_id AS VARCHAR) AS user_id,
    c_name AS user_name,
    n_name AS user_city,
    CAST(18 + user_id % 53 AS INTEGER) AS user_age,
    'user@example.com' AS user_email,
    CAST(CAST(value AS DECIMAL(12,2)) * 100 AS DOUBLE) AS transaction_amount,
    'RUB' AS transaction_currency,
    c_mktsegment AS transaction_category,
    'Example Merchant' AS merchant,
    {ts_from_epoch(f"{EPOCH} + event_id * 10")} AS event_time,
    CASE event_id % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card'
         WHEN 2 THEN 'digital_wallet' ELSE 'cash' END AS payment_method,
    CASE WHEN event_id % 100 < 90 THEN 'success' WHEN event_id % 100 < 97 THEN 'pending'
         ELSE 'failed' END AS status,
    CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
    '10.0.0.1' AS ip_address,
    1 + event_id % 10 AS items_count,
    event_id % 2 = 0 AS discount_applied,
    CAST(floor(CAST(CAST(value AS DECIMAL(12,2)) * 100 AS DOUBLE) / 100) AS INTEGER) AS loyalty_points_earned,
    'transaction' AS data_type,
    ts AS kafka_timestamp
  FROM ev
),
A AS (
  SELECT
    'ac_' || CAST(event_id AS VARCHAR) AS activity_id,
    'u_' || CAST(user_id AS VARCHAR) AS user_id,
    c_name AS user_name,
    event_type AS activity_type,
    'https://shop.example.com/' || event_type AS page_url,
    CAST(10 + event_id % 3591 AS INTEGER) AS session_duration,
    {ts_from_epoch(f"{EPOCH} + event_id * 10")} AS event_time,
    CASE event_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Edge' END AS browser,
    CASE event_id % 5 WHEN 0 THEN 'Windows' WHEN 1 THEN 'macOS' WHEN 2 THEN 'Linux'
         WHEN 3 THEN 'Android' ELSE 'iOS' END AS os,
    n_name AS city,
    'Russia' AS country,
    'activity' AS data_type,
    ts AS kafka_timestamp
  FROM ev
),
N AS (
  SELECT
    'sensor_' || lpad(CAST(user_id % 20 AS VARCHAR), 4, '0') AS sensor_id,
    CASE user_id % 5 WHEN 0 THEN 'temperature' WHEN 1 THEN 'humidity' WHEN 2 THEN 'pressure'
         WHEN 3 THEN 'vibration' ELSE 'power_consumption' END AS sensor_type,
    CASE user_id % 4 WHEN 0 THEN 'factory_floor' WHEN 1 THEN 'warehouse' WHEN 2 THEN 'office'
         ELSE 'server_room' END AS sensor_location,
    {ts_from_epoch(f"{EPOCH} + event_id")} AS event_time,
    value,
    CASE WHEN event_id % 20 = 0 THEN 'critical' WHEN event_id % 20 <= 2 THEN 'warning'
         ELSE 'normal' END AS status,
    CAST(10 + event_id % 91 AS INTEGER) AS battery_level,
    CAST(1 + event_id % 5 AS INTEGER) AS signal_strength,
    'sensor' AS data_type,
    ts AS kafka_timestamp
  FROM events
),
Tx AS (
  SELECT *, CAST(transaction_amount AS DECIMAL(12,2)) AS amt,
         CAST(CAST(transaction_amount AS DECIMAL(12,2)) * 100 AS BIGINT) AS amt_c,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS transaction_date,
         'batch_' || strftime(event_time, '%Y%m%d_%H') AS batch_id
  FROM T
),
Ax AS (
  SELECT *, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         'batch_' || strftime(event_time, '%Y%m%d_%H') AS batch_id
  FROM A
),
Nx AS (
  SELECT *, CAST(CAST(value AS DECIMAL(10,3)) * 1000 AS BIGINT) AS value_m,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         'batch_' || strftime(event_time, '%Y%m%d_%H') AS batch_id
  FROM N
)"""

UNITS_CASE = """CASE sensor_type WHEN 'temperature' THEN '°C' WHEN 'humidity' THEN '%'
    WHEN 'pressure' THEN 'hPa' WHEN 'vibration' THEN 'm/s²' WHEN 'power_consumption' THEN 'W'
    ELSE 'unit' END"""


def _window(ts: str, seconds: int) -> str:
    return (
        f"{bucket(ts, seconds)} AS window_start, "
        f"{bucket(ts, seconds)} + INTERVAL {seconds} SECOND AS window_end"
    )


# -- result tables ---------------------------------------------------------

TABLES = {
    "transaction_hourly_stats": f"""
  SELECT {_window('event_time', 3600)}, user_city, transaction_category,
    CAST(COUNT(*) AS INTEGER) AS transaction_count,
    CAST(SUM(amt) AS DECIMAL(12,2)) AS total_amount,
    {avg_dec('amt_c', 2, 2, 'DECIMAL(10,2)')} AS avg_amount,
    CAST(MIN(amt) AS DECIMAL(10,2)) AS min_amount,
    CAST(MAX(amt) AS DECIMAL(10,2)) AS max_amount
  FROM Tx GROUP BY ALL""",
    "top_users": f"""
  SELECT {_window('event_time', 3600)}, user_id, user_name, user_city,
    CAST(SUM(amt) AS DECIMAL(12,2)) AS total_spent,
    CAST(COUNT(*) AS INTEGER) AS transaction_count
  FROM Tx GROUP BY ALL""",
    "payment_method_stats": f"""
  SELECT {_window('event_time', 1800)}, payment_method,
    CAST(COUNT(*) AS INTEGER) AS transaction_count,
    CAST(SUM(amt) AS DECIMAL(12,2)) AS total_amount,
    {avg_dec('amt_c', 2, 2, 'DECIMAL(10,2)')} AS avg_amount
  FROM Tx GROUP BY ALL""",
    "device_stats": f"""
  SELECT {_window('event_time', 1800)}, device AS device_type,
    CAST(COUNT(*) AS INTEGER) AS transaction_count,
    CAST(SUM(CASE WHEN status = 'success' THEN 1 ELSE 0 END) / COUNT(*) * 100 AS DECIMAL(5,2)) AS success_rate
  FROM Tx GROUP BY ALL""",
    "activity_stats": f"""
  SELECT {_window('event_time', 1800)}, activity_type, city,
    CAST(COUNT(*) AS INTEGER) AS activity_count,
    {avg_dec('session_duration', 0, 2, 'DECIMAL(10,2)')} AS avg_session_duration
  FROM Ax GROUP BY ALL""",
    "sensor_anomalies": f"""
  SELECT {_window('event_time', 600)}, sensor_id, sensor_type, sensor_location, status,
    CAST(COUNT(*) AS INTEGER) AS reading_count,
    {avg_dec('value_m', 3, 3, 'DECIMAL(10,3)')} AS avg_value,
    CAST(stddev_samp(value) AS DECIMAL(10,3)) AS std_value
  FROM Nx WHERE status IN ('warning', 'critical') GROUP BY ALL""",
    "sensor_anomalies_ext": f"""
  SELECT {_window('event_time', 600)}, sensor_id, sensor_type, sensor_location, status,
    CAST(COUNT(*) AS INTEGER) AS reading_count,
    {avg_dec('value_m', 3, 3, 'DECIMAL(10,3)')} AS avg_value,
    CAST(stddev_samp(value) AS DECIMAL(10,3)) AS std_value,
    {avg_dec('signal_strength', 0, 2, 'DECIMAL(10,2)')} AS signal_strength,
    {avg_dec('battery_level', 0, 2, 'DECIMAL(10,2)')} AS battery_level
  FROM Nx WHERE status IN ('warning', 'critical') GROUP BY ALL""",
    "hourly_metrics": f"""
  SELECT {bucket('event_time', 3600)} AS hour,
    CAST(COUNT(*) AS INTEGER) AS total_transactions,
    CAST(SUM(amt) AS DECIMAL(12,2)) AS total_amount,
    CAST(COUNT(DISTINCT user_id) AS INTEGER) AS active_users,
    {avg_dec('amt_c', 2, 2, 'DECIMAL(10,2)')} AS avg_transaction_amount,
    0 AS anomaly_count
  FROM Tx GROUP BY ALL""",
    "raw_transactions": """
  SELECT transaction_id, user_id, user_name, user_city, user_age, user_email,
    CAST(transaction_amount AS DECIMAL(12,2)) AS transaction_amount, transaction_currency,
    transaction_category, merchant, event_time AS transaction_date, payment_method, status, device,
    ip_address,
    '{"items_count":' || CAST(items_count AS VARCHAR) || ',"discount_applied":'
      || CAST(discount_applied AS VARCHAR) || ',"loyalty_points_earned":'
      || CAST(loyalty_points_earned AS VARCHAR) || '}' AS metadata,
    data_type, batch_id, kafka_timestamp
  FROM Tx""",
    "raw_activities": """
  SELECT activity_id, user_id, user_name, activity_type, page_url, session_duration,
    event_time AS "timestamp",
    '{"browser":"' || browser || '","os":"' || os || '"}' AS device_info,
    '{"city":"' || city || '","country":"' || country || '"}' AS location,
    data_type, batch_id, kafka_timestamp
  FROM Ax""",
    "raw_sensors": f"""
  SELECT sensor_id, sensor_type, sensor_location, event_time AS "timestamp",
    CAST(value AS DECIMAL(10,3)) AS value, {UNITS_CASE} AS unit, status, battery_level,
    signal_strength, data_type, batch_id, kafka_timestamp
  FROM Nx""",
}


def with_tables(sql: str, *names: str) -> str:
    ctes = ",\n".join(f"{n} AS ({TABLES[n]}\n)" for n in names)
    return f"WITH {FIXTURES},\n{ctes}\n{sql}"


def fixtures_only(sql: str) -> str:
    return f"WITH {FIXTURES}\n{sql}"


# -- oracle per query key ---------------------------------------------------

def _json_t() -> str:
    return """to_json({'transaction_id': transaction_id, 'user_id': user_id, 'user_name': user_name,
    'user_city': user_city, 'user_age': user_age, 'user_email': user_email,
    'transaction_amount': transaction_amount, 'transaction_currency': transaction_currency,
    'transaction_category': transaction_category, 'merchant': merchant,
    'transaction_date': transaction_date, 'payment_method': payment_method, 'status': status,
    'device': device, 'ip_address': ip_address,
    'metadata': {'items_count': CAST(items_count AS INTEGER), 'discount_applied': discount_applied,
                 'loyalty_points_earned': loyalty_points_earned},
    'data_type': data_type, 'batch_id': batch_id})"""


def _json_a() -> str:
    return """to_json({'activity_id': activity_id, 'user_id': user_id, 'user_name': user_name,
    'activity_type': activity_type, 'page_url': page_url, 'session_duration': session_duration,
    'timestamp': "timestamp", 'device_info': {'browser': browser, 'os': os},
    'location': {'city': city, 'country': country, 'timezone': 'Europe/Moscow'},
    'data_type': data_type, 'batch_id': batch_id})"""


def _json_n() -> str:
    return f"""to_json({{'sensor_id': sensor_id, 'sensor_type': sensor_type,
    'sensor_location': sensor_location, 'timestamp': "timestamp", 'value': value,
    'unit': {UNITS_CASE}, 'status': status, 'battery_level': battery_level,
    'signal_strength': signal_strength, 'data_type': data_type, 'batch_id': batch_id}})"""


TOPIC = f"""topic AS (
  SELECT CAST({_json_t()} AS VARCHAR) AS json, kafka_timestamp, data_type, batch_id FROM Tx
  UNION ALL SELECT CAST({_json_a()} AS VARCHAR), kafka_timestamp, data_type, batch_id FROM Ax
  UNION ALL SELECT CAST({_json_n()} AS VARCHAR), kafka_timestamp, data_type, batch_id FROM Nx
)"""

PARSE_T = """SELECT transaction_id, user_id, user_name, user_city, user_age, user_email,
    transaction_amount, transaction_currency, transaction_category, merchant, transaction_date,
    payment_method, status, device, ip_address,
    '{"items_count":' || CAST(items_count AS VARCHAR) || ',"discount_applied":'
      || CAST(discount_applied AS VARCHAR) || ',"loyalty_points_earned":'
      || CAST(loyalty_points_earned AS VARCHAR) || '}' AS metadata,
    data_type, batch_id"""

PARSE_A_HEAD = """SELECT activity_id, user_id, user_name, activity_type, page_url, session_duration,
    "timestamp\""""

PARSE_N = f"""SELECT sensor_id, sensor_type, sensor_location, "timestamp", value,
    {UNITS_CASE} AS unit, status, battery_level, signal_strength, data_type, batch_id"""


def _avg_of_dec(col: str, in_scale: int, out_scale: int, out_type: str) -> str:
    return avg_dec(f"CAST({col} * {10 ** in_scale} AS BIGINT)", in_scale, out_scale, out_type)


def _band(value: str, steps) -> str:
    base = [c for c, b in steps if b is None][0]
    bounded = sorted(((b, c) for c, b in steps if b is not None), reverse=True)
    whens = " ".join(f"WHEN {value} >= {b} THEN '{c}'" for b, c in bounded)
    return f"CASE WHEN {value} IS NULL THEN NULL {whens} ELSE '{base}' END"


def _steps(name):
    from .functions.bands import KPI_STEPS

    return KPI_STEPS[name]


def _rules_sql() -> str:
    t_rules = {
        "amount_out_of_range": "transaction_amount IS NULL OR NOT (transaction_amount BETWEEN 100.0 AND 50000.0)",
        "bad_currency": "transaction_currency IS NULL OR transaction_currency NOT IN ('RUB')",
        "bad_payment_method": "payment_method IS NULL OR payment_method NOT IN ('credit_card','debit_card','digital_wallet','cash')",
        "bad_status": "status IS NULL OR status NOT IN ('success','pending','failed')",
        "bad_device": "device IS NULL OR device NOT IN ('mobile','desktop','tablet')",
        "age_out_of_range": "user_age IS NULL OR NOT (user_age BETWEEN 18 AND 70)",
        "bad_event_time": "event_time IS NULL",
        "missing_id": "transaction_id IS NULL",
    }
    a_rules = {
        "session_out_of_range": "session_duration IS NULL OR NOT (session_duration BETWEEN 10 AND 3600)",
        "bad_event_time": "event_time IS NULL",
        "missing_city": "city IS NULL",
        "missing_id": "activity_id IS NULL",
    }
    in_range = """CASE sensor_type WHEN 'temperature' THEN value BETWEEN -10.0 AND 40.0
        WHEN 'humidity' THEN value BETWEEN 30.0 AND 90.0 WHEN 'pressure' THEN value BETWEEN 950.0 AND 1050.0
        WHEN 'vibration' THEN value BETWEEN 0.0 AND 10.0 WHEN 'power_consumption' THEN value BETWEEN 0.0 AND 1000.0 END"""
    n_rules = {
        "bad_sensor_type": "sensor_type IS NULL OR sensor_type NOT IN ('temperature','humidity','pressure','vibration','power_consumption')",
        "bad_location": "sensor_location IS NULL OR sensor_location NOT IN ('factory_floor','warehouse','office','server_room')",
        "bad_status": "status IS NULL OR status NOT IN ('normal','warning','critical')",
        "battery_out_of_range": "battery_level IS NULL OR NOT (battery_level BETWEEN 10 AND 100)",
        "signal_out_of_range": "signal_strength IS NULL OR NOT (signal_strength BETWEEN 1 AND 5)",
        "value_out_of_type_range": f"({in_range}) IS NULL OR NOT ({in_range})",
        "unit_mismatch": "FALSE",
        "bad_event_time": "event_time IS NULL",
    }
    parts = []
    for stream, src, rules in (("transaction", "Tx", t_rules), ("activity", "Ax", a_rules), ("sensor", "Nx", n_rules)):
        for rule, cond in rules.items():
            parts.append(
                f"SELECT '{stream}' AS stream, '{rule}' AS rule, "
                f"CAST(COALESCE(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations, "
                f"CAST(COUNT(*) AS BIGINT) AS checked FROM {src}"
            )
    return "\nUNION ALL ".join(parts)


def build_oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    topic = lambda sql: f"WITH {FIXTURES},\n{TOPIC}\n{sql}"
    o["message_projection"] = topic("SELECT json, kafka_timestamp FROM topic")
    o["parse_envelope"] = topic("SELECT data_type, batch_id, json, kafka_timestamp FROM topic")
    o["route_by_type"] = topic(
        "SELECT data_type, COUNT(*) AS messages FROM topic GROUP BY data_type"
    )
    o["parse_transactions"] = fixtures_only(f"{PARSE_T} FROM Tx")
    o["parse_activities"] = fixtures_only(
        f"""{PARSE_A_HEAD}, browser, os, city, country, CAST(NULL AS VARCHAR) AS coordinates,
    data_type, batch_id FROM Ax"""
    )
    o["parse_sensors"] = fixtures_only(f"{PARSE_N} FROM Nx")
    o["raw_transactions"] = fixtures_only(f"{PARSE_T}, kafka_timestamp FROM Tx")
    o["raw_activities"] = fixtures_only(
        f"""{PARSE_A_HEAD},
    '{{"browser":"' || browser || '","os":"' || os || '"}}' AS device_info,
    '{{"city":"' || city || '","country":"' || country || '"}}' AS location,
    data_type, batch_id, kafka_timestamp FROM Ax"""
    )
    o["raw_sensors"] = fixtures_only(f"{PARSE_N}, kafka_timestamp FROM Nx")
    for raw in ("raw_transactions", "raw_activities", "raw_sensors"):
        o[f"contract_{raw}"] = with_tables(f"SELECT * FROM {raw}", raw)
        o[f"dedup_{raw}"] = with_tables(f"SELECT * FROM {raw}", raw)
    o["event_time_parse"] = (
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso_text, ts AS event_time FROM events"
    )
    for name in (
        "transaction_hourly_stats",
        "top_users",
        "payment_method_stats",
        "device_stats",
        "activity_stats",
        "sensor_anomalies",
        "sensor_anomalies_ext",
        "hourly_metrics",
    ):
        o[f"batch_{name}"] = with_tables(f"SELECT * FROM {name}", name)
    o["batch_hourly_metrics_ext"] = with_tables(
        f"""SELECT h.hour, h.total_transactions, h.total_amount, h.active_users,
    h.avg_transaction_amount, CAST(COALESCE(a.anomalies, 0) AS INTEGER) AS anomaly_count
  FROM hourly_metrics h LEFT JOIN (
    SELECT {bucket('event_time', 3600)} AS hour, COUNT(*) AS anomalies
    FROM Nx WHERE status IN ('warning', 'critical') GROUP BY 1) a ON a.hour = h.hour""",
        "hourly_metrics",
    )
    o["active_users_exact"] = fixtures_only(
        f"""SELECT {bucket('event_time', 3600)} AS hour,
    CAST(COUNT(DISTINCT user_id) AS INTEGER) AS active_users FROM Tx GROUP BY 1"""
    )

    # reports: the panel SQL over the result tables; sums/averages typed as Spark's
    ths, tu, pm, ds, act, sa, sax, hm = (
        "transaction_hourly_stats",
        "top_users",
        "payment_method_stats",
        "device_stats",
        "activity_stats",
        "sensor_anomalies",
        "sensor_anomalies_ext",
        "hourly_metrics",
    )
    R = {
        "rpt_amount_by_hour": (f"SELECT window_start AS time, total_amount FROM {ths}", ths),
        "rpt_amount_by_city": (
            f"SELECT user_city, CAST(SUM(total_amount) AS DECIMAL(22,2)) AS total FROM {ths} GROUP BY user_city",
            ths,
        ),
        "rpt_amount_by_category": (
            f"SELECT transaction_category, CAST(SUM(total_amount) AS DECIMAL(22,2)) AS total FROM {ths} GROUP BY transaction_category",
            ths,
        ),
        "rpt_top10_users": (
            f"""SELECT user_name, user_city, total_spent, transaction_count FROM {tu}
  ORDER BY total_spent DESC, window_start, user_id LIMIT 10""",
            tu,
        ),
        "rpt_count_by_payment": (
            f"SELECT payment_method, CAST(SUM(transaction_count) AS BIGINT) AS count FROM {pm} GROUP BY payment_method",
            pm,
        ),
        "rpt_total_activities": (
            f"SELECT CAST(SUM(activity_count) AS BIGINT) AS total_activities FROM {act}",
            act,
        ),
        "rpt_avg_session": (
            f"SELECT {_avg_of_dec('avg_session_duration', 2, 6, 'DECIMAL(14,6)')} AS avg_duration FROM {act}",
            act,
        ),
        "rpt_activities_by_type": (
            f"SELECT activity_type, CAST(SUM(activity_count) AS BIGINT) AS total_activities FROM {act} GROUP BY activity_type",
            act,
        ),
        "rpt_avg_session_monitoring": (
            f"SELECT {_avg_of_dec('avg_session_duration', 2, 6, 'DECIMAL(14,6)')} AS avg_session FROM {act}",
            act,
        ),
        "rpt_latest_anomalies": (
            f"""SELECT sensor_id, sensor_type, sensor_location, status, avg_value, reading_count, window_start
  FROM {sa} ORDER BY window_start DESC, sensor_id, status LIMIT 20""",
            sa,
        ),
        "rpt_anomaly_total": (
            f"SELECT COUNT(*) AS total_anomalies FROM {sa} WHERE status IN ('warning', 'critical')",
            sa,
        ),
        "rpt_mean_signal": (
            f"SELECT {_avg_of_dec('signal_strength', 2, 6, 'DECIMAL(14,6)')} AS avg_signal FROM {sax}",
            sax,
        ),
        "rpt_anomalies_by_type": (
            f"SELECT sensor_type, COUNT(*) AS anomaly_count FROM {sa} WHERE status IN ('warning', 'critical') GROUP BY sensor_type",
            sa,
        ),
        "rpt_battery_over_time": (
            f"SELECT window_start AS time, sensor_id, battery_level FROM {sax}",
            sax,
        ),
        "rpt_unique_sensors": (
            f"SELECT COUNT(DISTINCT sensor_id) AS unique_sensors FROM {sa}",
            sa,
        ),
        "rpt_tx_by_hour": (f"SELECT hour AS time, total_transactions FROM {hm}", hm),
        "rpt_total_by_hour": (f"SELECT hour AS time, total_amount FROM {hm}", hm),
        "rpt_active_users_by_hour": (f"SELECT hour AS time, active_users FROM {hm}", hm),
        "rpt_avg_amount_by_hour": (f"SELECT hour AS time, avg_transaction_amount FROM {hm}", hm),
        "rpt_all_transactions": (
            f"SELECT CAST(SUM(total_transactions) AS BIGINT) AS total_all_transactions FROM {hm}",
            hm,
        ),
        "rpt_all_amount": (
            f"SELECT CAST(SUM(total_amount) AS DECIMAL(22,2)) AS total_all_amount FROM {hm}",
            hm,
        ),
        "rpt_mean_active_users": (
            f"SELECT AVG(active_users) AS avg_active_users FROM {hm}",
            hm,
        ),
        "rpt_mean_amount": (
            f"SELECT {_avg_of_dec('avg_transaction_amount', 2, 6, 'DECIMAL(14,6)')} AS avg_transaction_amount FROM {hm}",
            hm,
        ),
        "rpt_tx_by_device": (
            f"SELECT device_type, CAST(SUM(transaction_count) AS BIGINT) AS total_transactions FROM {ds} GROUP BY device_type",
            ds,
        ),
        "rpt_success_by_device": (
            f"SELECT device_type, {_avg_of_dec('success_rate', 2, 6, 'DECIMAL(9,6)')} AS avg_success_rate FROM {ds} GROUP BY device_type",
            ds,
        ),
        "rpt_success_over_time": (
            f"SELECT window_start AS time, device_type, success_rate FROM {ds}",
            ds,
        ),
        "rpt_device_total": (
            f"SELECT CAST(SUM(transaction_count) AS BIGINT) AS total_transactions FROM {ds}",
            ds,
        ),
        "rpt_mean_success": (
            f"SELECT {_avg_of_dec('success_rate', 2, 6, 'DECIMAL(9,6)')} AS avg_success_rate FROM {ds}",
            ds,
        ),
    }
    for key, (sql, tbl) in R.items():
        o[key] = with_tables(sql, tbl)

    o["kpi_band_spend"] = with_tables(
        f"""SELECT *, {_band('total_spent', _steps('top_user_spend'))} AS band FROM (
  SELECT user_name, user_city, total_spent, transaction_count FROM {tu}
  ORDER BY total_spent DESC, window_start, user_id LIMIT 10)""",
        tu,
    )
    o["kpi_band_totals"] = with_tables(
        f"""SELECT *,
    {_band('total_all_transactions', _steps('total_all_transactions'))} AS total_all_transactions_band,
    {_band('total_all_amount', _steps('total_all_amount'))} AS total_all_amount_band,
    {_band('avg_active_users', _steps('avg_active_users'))} AS avg_active_users_band,
    {_band('avg_transaction_amount', _steps('avg_transaction_amount'))} AS avg_transaction_amount_band
  FROM (SELECT CAST(SUM(total_transactions) AS BIGINT) AS total_all_transactions,
    CAST(SUM(total_amount) AS DECIMAL(22,2)) AS total_all_amount,
    AVG(active_users) AS avg_active_users,
    {_avg_of_dec('avg_transaction_amount', 2, 6, 'DECIMAL(14,6)')} AS avg_transaction_amount
  FROM {hm})""",
        hm,
    )
    o["kpi_band_success"] = with_tables(
        f"""SELECT *, {_band('avg_success_rate', _steps('avg_success_rate'))} AS band FROM (
  SELECT device_type, {_avg_of_dec('success_rate', 2, 6, 'DECIMAL(9,6)')} AS avg_success_rate
  FROM {ds} GROUP BY device_type)""",
        ds,
    )
    o["last_not_null"] = with_tables(
        f"""SELECT arg_max(total_amount, hour) AS total_amount, MAX(hour) AS time
  FROM {hm} WHERE total_amount IS NOT NULL""",
        hm,
    )
    o["pivot_success_rate"] = with_tables(
        f"""SELECT window_start AS time,
    MAX(success_rate) FILTER (WHERE device_type = 'mobile') AS mobile,
    MAX(success_rate) FILTER (WHERE device_type = 'desktop') AS desktop,
    MAX(success_rate) FILTER (WHERE device_type = 'tablet') AS tablet
  FROM {ds} GROUP BY window_start""",
        ds,
    )
    o["range_last_6h"] = with_tables(
        f"""SELECT hour AS time, total_amount FROM {hm}
  WHERE hour > (SELECT MAX(hour) FROM {hm}) - INTERVAL 6 HOUR""",
        hm,
    )
    o["range_last_24h"] = with_tables(
        f"""SELECT window_start AS time, device_type, success_rate FROM {ds}
  WHERE window_start > (SELECT MAX(window_start) FROM {ds}) - INTERVAL 24 HOUR""",
        ds,
    )
    o["severity_order"] = with_tables(
        f"""SELECT window_start, sensor_id, status, reading_count,
    CASE status WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 WHEN 'normal' THEN 2 ELSE 3 END AS severity_rank
  FROM {sa}""",
        sa,
    )
    o["loyalty_check"] = fixtures_only(
        """SELECT transaction_id, CAST(floor(transaction_amount / 100) AS INTEGER) AS expected_points,
    loyalty_points_earned AS reported_points,
    CAST(floor(transaction_amount / 100) AS INTEGER) IS NOT DISTINCT FROM loyalty_points_earned AS consistent
  FROM Tx"""
    )
    o["batch_id_check"] = fixtures_only(
        """SELECT data_type, COUNT(*) AS messages, CAST(COUNT(*) AS BIGINT) AS matching FROM (
    SELECT data_type FROM Tx UNION ALL SELECT data_type FROM Ax UNION ALL SELECT data_type FROM Nx)
  GROUP BY data_type"""
    )
    o["sensor_unit"] = fixtures_only(
        f"""SELECT sensor_type, {UNITS_CASE} AS expected_unit, COUNT(*) AS readings,
    CAST(COUNT(*) AS BIGINT) AS unit_matches FROM Nx GROUP BY sensor_type"""
    )
    o["quality_report"] = fixtures_only(_rules_sql())
    return o


ORACLES = build_oracles()


# -- streaming keys: append mode emits a window once the watermark
# (max event time seen - delay) has reached its end ------------------------

STREAM_CLOSE = {
    "transaction_hourly_stats": ("Tx", 3600, ""),
    "top_users": ("Tx", 3600, ""),
    "payment_method_stats": ("Tx", 1800, ""),
    "device_stats": ("Tx", 1800, ""),
    "activity_stats": ("Ax", 1800, ""),
    "sensor_anomalies": ("Nx", 600, "WHERE status IN ('warning', 'critical')"),
    "sensor_anomalies_ext": ("Nx", 600, "WHERE status IN ('warning', 'critical')"),
}


def _stream_oracles() -> dict[str, str]:
    o = {}
    for name, (src, secs, where) in STREAM_CLOSE.items():
        o[f"stream_{name}"] = with_tables(
            f"""SELECT * FROM {name}
  WHERE window_end <= (SELECT MAX(event_time) FROM {src} {where}) - INTERVAL {secs} SECOND""",
            name,
        )
    for raw in ("raw_transactions", "raw_activities", "raw_sensors"):
        o[f"stream_{raw}"] = with_tables(f"SELECT * FROM {raw}", raw)
    o["stream_hourly_metrics"] = with_tables(
        """SELECT hour, total_transactions, total_amount, avg_transaction_amount, anomaly_count,
    TRUE AS active_users_within_tolerance
  FROM hourly_metrics
  WHERE hour + INTERVAL 1 HOUR <= (SELECT MAX(event_time) FROM Tx) - INTERVAL 1 HOUR""",
        "hourly_metrics",
    )
    return o


ORACLES.update(_stream_oracles())


def _bronze_oracles() -> dict[str, str]:
    o = {}
    for name in TABLES:
        o[f"bronze_{name}"] = ORACLES.get(f"batch_{name}") or ORACLES[f"contract_{name}"]
    o["bronze_hourly_metrics_ext"] = ORACLES["batch_hourly_metrics_ext"]
    return o


ORACLES.update(_bronze_oracles())


# -- faulty input: faults at fixed remainders of the event id by 50 -----------

EDGE = f"""{FIXTURES},
Te AS (
  SELECT * EXCLUDE (transaction_id, transaction_amount, transaction_date, event_time, amt, amt_c, batch_id, loyalty_points_earned),
    CAST(substr(transaction_id, 4) AS BIGINT) AS eid, CAST(substr(transaction_id, 4) AS BIGINT) % 50 AS fault,
    CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 50 <> 4 THEN transaction_id END AS transaction_id,
    CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 50 = 1 THEN 'junk' ELSE transaction_date END AS transaction_date,
    CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 50 <> 1 THEN event_time END AS event_time,
    CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 50 = 2 THEN CAST(9000000000 AS DECIMAL(12,2))
         WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 50 <> 3 THEN amt END AS amt,
    transaction_amount,
    CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 50 = 7 THEN 'batch_x' ELSE batch_id END AS batch_id,
    CASE WHEN CAST(substr(transaction_id, 4) AS BIGINT) % 50 = 6 THEN -1 ELSE loyalty_points_earned END AS loyalty_points_earned
  FROM Tx WHERE CAST(substr(transaction_id, 4) AS BIGINT) % 50 <> 5
),
Ne AS (
  SELECT *, (CAST(epoch(event_time) AS BIGINT) - {EPOCH}) % 50 AS fault FROM Nx
),
Pe AS (
  SELECT {_window('event_time', 1800)}, payment_method, COUNT(*) AS n, SUM(amt) AS total, COUNT(amt) AS n_amt
  FROM Te WHERE event_time IS NOT NULL GROUP BY ALL
),
He AS (
  SELECT {bucket('event_time', 3600)} AS hour, SUM(amt) AS total FROM Te WHERE event_time IS NOT NULL GROUP BY ALL
)"""


def _edge_oracles() -> dict[str, str]:
    w = f"WITH {EDGE}\n"
    cents = "CAST(total * 100 AS HUGEINT)"
    rounded = f"((2 * {cents} + n_amt) // (2 * n_amt))"
    return {
        "encode_events": ORACLES["message_projection"],
        "contract_raw_transactions_edge": w + """SELECT transaction_id, user_id, user_name, user_city, user_age, user_email,
    amt AS transaction_amount, transaction_currency, transaction_category, merchant, event_time AS transaction_date,
    payment_method, status, device, ip_address,
    '{"items_count":' || CAST(items_count AS VARCHAR) || ',"discount_applied":'
      || CAST(discount_applied AS VARCHAR) || ',"loyalty_points_earned":'
      || CAST(loyalty_points_earned AS VARCHAR) || '}' AS metadata,
    data_type, batch_id, kafka_timestamp
  FROM Te WHERE fault NOT IN (1, 3, 4)""",
        "batch_payment_method_overflow": w + f"""SELECT window_start, window_end, payment_method, CAST(n AS INTEGER) AS transaction_count,
    CAST(total AS DECIMAL(12,2)) AS total_amount,
    CAST(CAST({rounded} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS avg_amount
  FROM Pe WHERE total < 10000000000 AND {rounded} < 10000000000""",
        "quarantine_rows": w + f"""SELECT 'payment_method_stats' AS table_name, COUNT(*) AS quarantined, CAST(SUM(total) AS DECIMAL(30,2)) AS total
  FROM Pe WHERE total >= 10000000000 OR {rounded} >= 10000000000
  UNION ALL SELECT 'hourly_metrics', COUNT(*), CAST(SUM(total) AS DECIMAL(30,2)) FROM He WHERE total >= 10000000000
  UNION ALL SELECT 'raw_transactions', COUNT(*), CAST(CASE WHEN COUNT(*) > 0 THEN 0 END AS DECIMAL(30,2)) FROM Te WHERE fault IN (1, 3, 4)
  UNION ALL SELECT 'raw_sensors', COUNT(*), CAST(CASE WHEN COUNT(*) > 0 THEN 0 END AS DECIMAL(30,2)) FROM Ne WHERE fault = 1""",
        "dedup_raw_transactions_edge": w + """SELECT transaction_id, user_id, transaction_date, kafka_timestamp FROM Te
  UNION ALL SELECT transaction_id, user_id, transaction_date, kafka_timestamp + INTERVAL 1 DAY FROM Te WHERE transaction_id IS NULL""",
        "bronze_relanded_days": w + """SELECT data_type, event_date, COUNT(*) AS messages FROM (
    SELECT data_type, CAST(event_time AS DATE) AS event_date FROM Te
    UNION ALL SELECT data_type, CASE WHEN fault <> 1 THEN CAST(event_time AS DATE) END FROM Ne
    UNION ALL SELECT '__rejected__', NULL FROM Tx WHERE CAST(substr(transaction_id, 4) AS BIGINT) % 50 = 5)
  GROUP BY ALL""",
        "quarantine_after_day_ranges": w + """SELECT transaction_id, user_id, transaction_date,
    CASE fault WHEN 3 THEN 1e15::DOUBLE ELSE transaction_amount END AS transaction_amount, kafka_timestamp,
    CAST(coalesce(event_time, kafka_timestamp) AS DATE) AS event_date
  FROM Te WHERE fault IN (1, 3, 4)""",
        "untimed_rows_day_range": w + """SELECT table_name, place, event_date, COUNT(*) AS n_rows FROM (
    SELECT 'raw_transactions' AS table_name, CASE WHEN fault IN (1, 3, 4) THEN 'quarantine' ELSE 'table' END AS place,
      CAST(coalesce(event_time, kafka_timestamp) AS DATE) AS event_date FROM Te
    UNION ALL SELECT 'raw_sensors', CASE WHEN fault = 1 THEN 'quarantine' ELSE 'table' END,
      CAST(CASE WHEN fault = 1 THEN kafka_timestamp ELSE event_time END AS DATE) FROM Ne)
  WHERE event_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-10' GROUP BY ALL""",
        "bronze_corrected_landing": w + """SELECT data_type, event_date, late_landing, COUNT(*) AS messages FROM (
    SELECT data_type, day(kafka_timestamp) > 15 AS late_landing,
      CAST(CASE WHEN day(kafka_timestamp) > 15 AND day(event_time) <= 8 THEN event_time + INTERVAL 1 DAY ELSE event_time END AS DATE) AS event_date FROM Te
    UNION ALL SELECT data_type, day(kafka_timestamp) > 15, CASE WHEN fault <> 1 THEN CAST(event_time AS DATE) END FROM Ne
    UNION ALL SELECT '__rejected__', day(kafka_timestamp) > 15, NULL FROM Tx WHERE CAST(substr(transaction_id, 4) AS BIGINT) % 50 = 5)
  GROUP BY ALL""",
        "loyalty_check_overflow": w + """SELECT transaction_id,
    TRY_CAST(CASE fault WHEN 2 THEN 90000000 WHEN 3 THEN 10000000000000 ELSE floor(transaction_amount / 100) END AS INTEGER) AS expected_points,
    loyalty_points_earned AS reported_points,
    fault NOT IN (2, 3) AND CAST(floor(transaction_amount / 100) AS INTEGER) IS NOT DISTINCT FROM loyalty_points_earned AS consistent
  FROM Te""",
        "batch_id_check_edge": w + """SELECT data_type, COUNT(*) AS messages, CAST(SUM(CASE WHEN fault NOT IN (1, 7) THEN 1 ELSE 0 END) AS BIGINT) AS matching
  FROM Te GROUP BY data_type
  UNION ALL SELECT data_type, COUNT(*), CAST(SUM(CASE WHEN fault <> 1 THEN 1 ELSE 0 END) AS BIGINT) FROM Ne GROUP BY data_type""",
        "sensor_unit_edge": w + f"""SELECT sensor_type, {UNITS_CASE} AS expected_unit, COUNT(*) AS readings,
    CAST(SUM(CASE WHEN fault <> 8 THEN 1 ELSE 0 END) AS BIGINT) AS unit_matches FROM Ne GROUP BY sensor_type""",
    }


ORACLES.update(_edge_oracles())
# both read all faulty rows
ORACLES["loyalty_check_edge"] = ORACLES["loyalty_check_overflow"]


# -- deliveries that go wrong ---------------------------------------------------

def _delivery_oracles() -> dict[str, str]:
    eid = "CAST(substr(transaction_id, 4) AS BIGINT)"
    mixed = "SELECT event_time FROM Tx UNION ALL SELECT event_time FROM Nx WHERE status IN ('warning', 'critical')"
    ext = with_tables(
        f"""SELECT h.hour, h.total_transactions, h.total_amount, h.avg_transaction_amount,
    CAST(COALESCE(a.anomalies, 0) AS INTEGER) AS anomaly_count, TRUE AS active_users_within_tolerance
  FROM hourly_metrics h LEFT JOIN (
    SELECT {bucket('event_time', 3600)} AS hour, COUNT(*) AS anomalies
    FROM Nx WHERE status IN ('warning', 'critical') GROUP BY 1) a ON a.hour = h.hour
  WHERE h.hour + INTERVAL 1 HOUR <= (SELECT MAX(event_time) FROM ({mixed})) - INTERVAL 1 HOUR""",
        "hourly_metrics",
    )
    return {
        "late_rows_payment_method_stats": fixtures_only(
            f"""SELECT transaction_id, payment_method, event_time FROM Tx
  WHERE {eid} % 97 = 5 AND {bucket('event_time', 1800)} + INTERVAL 30 MINUTE
    <= (SELECT MAX(event_time) FROM Tx WHERE {eid} % 97 <> 5) - INTERVAL 30 MINUTE"""
        ),
        "late_corrected_payment_method_stats": ORACLES["stream_payment_method_stats"],
        "replayed_raw_transactions": ORACLES["contract_raw_transactions"],
        "replayed_quarantine": f"WITH {EDGE}\n" + """SELECT transaction_id,
    CASE fault WHEN 3 THEN CAST(9000000000 AS DECIMAL(12,2)) ELSE amt END AS transaction_amount,
    coalesce(event_time, date_trunc('second', kafka_timestamp)) AS transaction_date, kafka_timestamp
  FROM Te WHERE fault <> 4""",
        "merged_raw_transactions": ORACLES["contract_raw_transactions"],
        "batch_hourly_metrics_mixed": ORACLES["batch_hourly_metrics_ext"],
        "stream_hourly_metrics_ext": ext,
        "users_by_day_from_sketches": fixtures_only(
            """SELECT date_trunc('day', event_time) AS period, COUNT(DISTINCT date_trunc('hour', event_time)) AS hours,
    COUNT(DISTINCT user_id) AS exact_users, TRUE AS within_bound FROM Tx GROUP BY 1"""
        ).replace("date_trunc('day', event_time) AS period", "CAST(date_trunc('day', event_time) AS TIMESTAMP) AS period"),
        "rescued_transaction_fields": fixtures_only(
            f"""SELECT transaction_id, 'user_age' AS field, CAST(user_age AS VARCHAR) || ' years' AS raw FROM Tx WHERE {eid} % 50 = 10
  UNION ALL SELECT transaction_id, 'transaction_amount', 'lost ' || substr(transaction_id, 4) FROM Tx WHERE {eid} % 50 = 11
  UNION ALL SELECT transaction_id, 'coupon', 'C' || substr(transaction_id, 4) FROM Tx WHERE {eid} % 50 = 12"""
        ),
        "parse_transactions_mistyped": fixtures_only(
            f"""SELECT transaction_id, CASE WHEN {eid} % 50 <> 10 THEN user_age END AS user_age,
    CASE WHEN {eid} % 50 <> 11 THEN transaction_amount END AS transaction_amount, payment_method,
    CASE WHEN {eid} % 50 IN (10, 11, 12) THEN 1 ELSE 0 END AS n_rescued FROM Tx"""
        ),
        "range_last_24h_stored": ORACLES["range_last_24h"],
    }


def _shared_oracle() -> str:
    totals = {"transaction_hourly_stats": "total_amount", "top_users": "total_spent", "payment_method_stats": "total_amount", "raw_transactions": "transaction_amount"}
    parts = []
    for name, (src, secs, where) in STREAM_CLOSE.items():
        total = f"CAST(SUM({totals[name]}) AS DECIMAL(30,2))" if name in totals else "CAST(NULL AS DECIMAL(30,2))"
        parts.append(
            f"""SELECT '{name}' AS table_name, COUNT(*) AS n_rows, {total} AS total FROM {name}
  WHERE window_end <= (SELECT MAX(event_time) FROM {src} {where}) - INTERVAL {secs} SECOND"""
        )
    parts.append(
        """SELECT 'hourly_metrics', COUNT(*), CAST(SUM(total_amount) AS DECIMAL(30,2)) FROM hourly_metrics
  WHERE hour + INTERVAL 1 HOUR <= (SELECT MAX(event_time) FROM Tx) - INTERVAL 1 HOUR"""
    )
    for raw in ("raw_transactions", "raw_activities", "raw_sensors"):
        total = f"CAST(SUM({totals[raw]}) AS DECIMAL(30,2))" if raw in totals else "CAST(NULL AS DECIMAL(30,2))"
        parts.append(f"SELECT '{raw}', COUNT(*), {total} FROM {raw}")
    names = [*STREAM_CLOSE, "hourly_metrics", "raw_transactions", "raw_activities", "raw_sensors"]
    return with_tables("\n  UNION ALL ".join(parts), *names)


ORACLES.update(_delivery_oracles())
ORACLES["stream_shared_tables"] = _shared_oracle()
