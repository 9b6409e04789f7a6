"""Fraud queries over card-style transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import fraud
from lakeops.registry import query

SECONDS = "CAST(epoch_us(ts) // 1000000 AS BIGINT)"
MONEY = "CAST(amount AS DECIMAL(18,4))"


def great_circle(a_lat: str, a_lon: str, b_lat: str, b_lon: str, radius: str = "6371.0") -> str:
    chord = (
        f"(pow(sin(radians({b_lat} - {a_lat}) / 2), 2) + cos(radians({a_lat})) * cos(radians({b_lat})) * pow(sin(radians({b_lon} - {a_lon}) / 2), 2))"
    )
    return f"2 * {radius} * asin(sqrt(CASE WHEN {chord} > 1 THEN 1.0 ELSE {chord} END))"


FEATURE_CTES = f"""
base AS (SELECT *, {SECONDS} AS sec, {MONEY} AS money FROM v_txn),
framed AS (
 SELECT *,
  count(*) OVER h1 AS tx_count_1h, CAST(sum(money) OVER h1 AS DOUBLE) AS tx_amount_1h,
  count(*) OVER h24 AS tx_count_24h, CAST(sum(money) OVER h24 AS DOUBLE) AS tx_amount_24h,
  coalesce(CAST(sum(money) OVER d30 AS DOUBLE) / nullif(count(*) OVER d30, 0), 0.0) AS avg_amount_30d,
  coalesce(stddev_samp(amount) OVER d30, 1.0) AS std_amount_30d,
  lag(location_lat) OVER seq AS prev_lat, lag(location_lon) OVER seq AS prev_lon, lag(sec) OVER seq AS prev_sec,
  row_number() OVER (PARTITION BY account_id, merchant_id ORDER BY ts, transaction_id) AS merchant_no,
  row_number() OVER (PARTITION BY account_id, device_id ORDER BY ts, transaction_id) AS device_no
 FROM base
 WINDOW h1 AS (PARTITION BY account_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
  h24 AS (PARTITION BY account_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
  d30 AS (PARTITION BY account_id ORDER BY sec RANGE BETWEEN 2592000 PRECEDING AND 1 PRECEDING),
  seq AS (PARTITION BY account_id ORDER BY ts, transaction_id)
),
feat AS (
 SELECT transaction_id, account_id, amount, ts, CAST(ts AS DATE) AS date,
  CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
  CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(ts) >= 22 OR hour(ts) <= 5 THEN 1 ELSE 0 END AS is_night,
  tx_count_1h, tx_count_24h, tx_amount_1h, tx_amount_24h, avg_amount_30d, std_amount_30d,
  CASE WHEN std_amount_30d > 0 THEN (amount - avg_amount_30d) / std_amount_30d ELSE 0.0 END AS amount_zscore,
  {great_circle('prev_lat', 'prev_lon', 'location_lat', 'location_lon')} AS distance_from_last,
  (sec - prev_sec) / 3600.0 AS time_since_last,
  CASE WHEN merchant_id IS NOT NULL AND merchant_no = 1 THEN 1 ELSE 0 END AS is_new_merchant,
  CASE WHEN device_id IS NOT NULL AND device_no = 1 THEN 1 ELSE 0 END AS is_new_device,
  CASE WHEN location_country IN ('NG','RU','CN','BR','IN','PH','ID','VN') THEN 1 ELSE 0 END AS is_high_risk_country,
  CASE channel WHEN 'POS' THEN 0 WHEN 'ATM' THEN 1 WHEN 'ONLINE' THEN 2 WHEN 'MOBILE' THEN 3 WHEN 'BRANCH' THEN 4 ELSE 99 END AS channel_encoded,
  CASE transaction_type WHEN 'PURCHASE' THEN 0 WHEN 'WITHDRAWAL' THEN 1 WHEN 'TRANSFER' THEN 2 WHEN 'DEPOSIT' THEN 3 WHEN 'PAYMENT' THEN 4 WHEN 'REFUND' THEN 5 ELSE 99 END AS tx_type_encoded
 FROM framed
)"""

ROUNDED = ["avg_amount_30d", "std_amount_30d", "amount_zscore", "distance_from_last", "time_since_last", "tx_amount_1h", "tx_amount_24h"]


def rounded(df, names=ROUNDED, digits=6):
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in present})


def rounded_sql(names):
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" if n in ROUNDED else n for n in names)


def feature_oracle(names, where="", source="feat"):
    return f"WITH {FEATURE_CTES} SELECT {rounded_sql(names)} FROM {source} {where}"


def register_group(name, operator, columns):
    picked = ["transaction_id", *columns]

    @query(name, feature_oracle(picked))
    def _(lake):
        return rounded(operator(lake("v_txn")).select(*picked))


register_group("temporal_features", fraud.temporal_features, ["hour_of_day", "day_of_week", "is_weekend", "is_night", "date"])
register_group("velocity_features", fraud.velocity_features, ["tx_count_1h", "tx_count_24h", "tx_amount_1h", "tx_amount_24h"])
register_group("statistical_features", fraud.statistical_features, ["avg_amount_30d", "std_amount_30d", "amount_zscore"])
register_group("distance_features", fraud.distance_features, ["distance_from_last", "time_since_last"])
register_group("behavioral_features", fraud.behavioral_features, ["is_new_merchant", "is_new_device", "is_high_risk_country"])
register_group("categorical_encoding", fraud.categorical_encoding, ["channel_encoded", "tx_type_encoded"])

register_group("velocity_features_hot", lambda df: fraud.velocity_features(df, floor=0), ["tx_count_1h", "tx_count_24h", "tx_amount_1h", "tx_amount_24h"])
register_group("statistical_features_hot", lambda df: fraud.statistical_features(df, floor=0), ["avg_amount_30d", "std_amount_30d", "amount_zscore"])

VECTOR = ["transaction_id", "account_id", *fraud.FEATURES, "ts", "date"]


@query("fraud_features", feature_oracle(VECTOR))
def fraud_features(lake):
    return rounded(fraud.fraud_features(lake("v_txn")))


@query("fraud_features_hot", feature_oracle(VECTOR))
def fraud_features_hot(lake):
    """The same vectors with every account cut into slices."""
    return rounded(fraud.fraud_features(lake("v_txn"), floor=0))


@query(
    "fraud_features_for_date",
    f"""WITH {FEATURE_CTES} SELECT transaction_id, account_id, hour_of_day, tx_count_24h, round(avg_amount_30d, 6) + 0.0 AS avg_amount_30d,
 round(coalesce(distance_from_last, 0.0), 6) + 0.0 AS distance_from_last, round(coalesce(time_since_last, 0.0), 6) + 0.0 AS time_since_last
 FROM feat WHERE date = DATE '2024-01-20'""",
)
def fraud_features_for_date(lake):
    day = fraud.features_for_date(lake("v_txn"), "2024-01-20")
    return rounded(
        day.select("transaction_id", "account_id", "hour_of_day", "tx_count_24h", "avg_amount_30d", "distance_from_last", "time_since_last")
    )


@query(
    "fraud_features_ext",
    f"""WITH base AS (SELECT *, {SECONDS} AS sec, {MONEY} AS money FROM v_txn),
seconds AS (
 SELECT DISTINCT a.account_id, a.sec,
  (SELECT count(DISTINCT b.merchant_id) FROM base b WHERE b.account_id = a.account_id AND b.sec BETWEEN a.sec - 604800 AND a.sec) AS unique_merchants_7d,
  (SELECT count(DISTINCT b.merchant_id) FROM base b WHERE b.account_id = a.account_id AND b.sec BETWEEN a.sec - 2592000 AND a.sec) AS unique_merchants_30d,
  (SELECT count(DISTINCT concat(b.location_lat, '/', b.location_lon)) FROM base b WHERE b.account_id = a.account_id AND b.sec BETWEEN a.sec - 604800 AND a.sec) AS unique_locations_7d
 FROM base a
),
visits AS (SELECT account_id, location_lat, location_lon, count(*) AS n FROM v_txn GROUP BY ALL),
home AS (
 SELECT account_id, location_lat AS home_lat, location_lon AS home_lon FROM visits
 QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY n DESC, location_lat, location_lon) = 1
),
framed AS (
 SELECT *,
  count(*) OVER h6 AS tx_count_6h, CAST(sum(money) OVER h6 AS DOUBLE) AS tx_amount_6h,
  count(*) OVER d7 AS tx_count_7d, CAST(sum(money) OVER d7 AS DOUBLE) AS tx_amount_7d,
  coalesce(min(amount) OVER d30, 0.0) AS min_amount_30d, coalesce(max(amount) OVER d30, 0.0) AS max_amount_30d,
  lag(location_lat) OVER seq AS prev_lat, lag(location_lon) OVER seq AS prev_lon, lag(sec) OVER seq AS prev_sec
 FROM base
 WINDOW h6 AS (PARTITION BY account_id ORDER BY sec RANGE BETWEEN 21600 PRECEDING AND CURRENT ROW),
  d7 AS (PARTITION BY account_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW),
  d30 AS (PARTITION BY account_id ORDER BY sec RANGE BETWEEN 2592000 PRECEDING AND 1 PRECEDING),
  seq AS (PARTITION BY account_id ORDER BY ts, transaction_id)
)
SELECT transaction_id, f.account_id, tx_count_6h, tx_count_7d, round(tx_amount_6h, 6) AS tx_amount_6h, round(tx_amount_7d, 6) AS tx_amount_7d,
 unique_merchants_7d, unique_merchants_30d, unique_locations_7d, min_amount_30d, max_amount_30d,
 round({great_circle('home_lat', 'home_lon', 'location_lat', 'location_lon')}, 6) AS distance_from_home,
 round(CASE WHEN f.sec <> prev_sec THEN {great_circle('prev_lat', 'prev_lon', 'location_lat', 'location_lon')} / ((f.sec - prev_sec) / 3600.0) ELSE 0.0 END, 5) AS velocity_km_per_hour
FROM framed f JOIN seconds s ON f.account_id = s.account_id AND f.sec = s.sec JOIN home h ON f.account_id = h.account_id""",
)
def fraud_features_ext(lake):
    out = rounded(fraud.fraud_features_ext(lake("v_txn")), ["tx_amount_6h", "tx_amount_7d", "distance_from_home"])
    return rounded(out, ["velocity_km_per_hour"], 5)


@query("weak_labels", f"""WITH {FEATURE_CTES} SELECT transaction_id,
 CASE WHEN amount_zscore > 3.0 OR (is_new_merchant = 1 AND amount > 1000) OR (distance_from_last > 500 AND time_since_last < 1) OR tx_count_1h > 10
 THEN 1 ELSE 0 END AS is_fraud FROM feat""")
def weak_labels(lake):
    return fraud.weak_labels(fraud.fraud_features(lake("v_txn"))).select("transaction_id", "is_fraud")


SCORE = "CAST((transaction_id * 7919) % 1001 AS DOUBLE) / CAST(1000 AS DOUBLE)"
STATUS_SQL = "CASE WHEN fraud_score >= 0.7 THEN 'FRAUDULENT' WHEN fraud_score >= 0.4 THEN 'SUSPICIOUS' ELSE 'LEGITIMATE' END"
SCORED_CTE = f"scored AS (SELECT transaction_id, account_id, amount, ts, {SCORE} AS fraud_score FROM v_txn)"


def scored(lake):
    return lake("v_txn").withColumn("fraud_score", F.expr(SCORE))


@query("fraud_status", f"""WITH {SCORED_CTE} SELECT transaction_id, fraud_score, {STATUS_SQL} AS fraud_status,
 round(CASE WHEN fraud_score >= 0.7 THEN fraud_score WHEN fraud_score >= 0.4 THEN abs(fraud_score - 0.4) / (0.7 - 0.4) ELSE 1.0 - fraud_score END, 6) AS confidence FROM scored""")
def fraud_status(lake):
    out = fraud.score_status(scored(lake).select("transaction_id", "fraud_score"))
    return rounded(out, ["confidence"])


RISK_SQL = """array_to_string(list_filter([
 CASE WHEN amount_zscore > 2.0 THEN 'HIGH_AMOUNT' END, CASE WHEN tx_count_1h > 5 THEN 'HIGH_VELOCITY' END,
 CASE WHEN is_new_merchant = 1 THEN 'NEW_MERCHANT' END, CASE WHEN is_new_device = 1 THEN 'NEW_DEVICE' END,
 CASE WHEN is_high_risk_country = 1 THEN 'HIGH_RISK_LOCATION' END,
 CASE WHEN distance_from_last > 100 AND time_since_last < 1 THEN 'IMPOSSIBLE_TRAVEL' END,
 CASE WHEN is_weekend = 1 THEN 'WEEKEND_TX' END, CASE WHEN hour_of_day < 6 OR hour_of_day > 22 THEN 'ODD_HOURS' END], lambda x: x IS NOT NULL), '|')"""


@query("risk_factors", f"WITH {FEATURE_CTES} SELECT transaction_id, {RISK_SQL} AS risk_factors FROM feat")
def risk_factors(lake):
    out = fraud.risk_factors(fraud.fraud_features(lake("v_txn")))
    return out.select("transaction_id", F.array_join("risk_factors", "|").alias("risk_factors"))


ALERT_SQL = f"""WITH {FEATURE_CTES},
rf AS (SELECT transaction_id, account_id, amount, {SCORE} AS fraud_score, {RISK_SQL} AS rf FROM feat),
st AS (SELECT *, {STATUS_SQL} AS fraud_status, string_split(rf, '|') AS rfs FROM rf)
SELECT concat('alert-', transaction_id) AS alert_id, transaction_id, account_id, fraud_score, fraud_status,
 coalesce(list_filter(list_transform(rfs, lambda x: CASE WHEN x = 'HIGH_VELOCITY' THEN 'VELOCITY' WHEN x = 'HIGH_AMOUNT' THEN 'HIGH_VALUE'
  WHEN x IN ('IMPOSSIBLE_TRAVEL', 'HIGH_RISK_LOCATION') THEN 'GEOGRAPHIC' WHEN x IN ('NEW_MERCHANT', 'NEW_DEVICE') THEN 'BEHAVIORAL' END), lambda x: x IS NOT NULL)[1], 'PATTERN') AS alert_type,
 CASE WHEN fraud_score >= 0.9 THEN 'CRITICAL' WHEN fraud_score >= 0.8 THEN 'HIGH' WHEN fraud_score >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
 CASE WHEN fraud_score >= 0.9 THEN 'Block transaction and contact customer immediately' WHEN fraud_score >= 0.8 THEN 'Block transaction and request verification'
  WHEN fraud_score >= 0.7 THEN 'Flag for manual review within 1 hour' ELSE 'Monitor account for suspicious activity' END AS recommended_action,
 concat('Potential fraud detected: ', CASE WHEN rf = '' THEN 'Pattern anomaly' ELSE array_to_string(rfs[1:3], ', ') END, '. Score: ', CAST(CAST(CAST(fraud_score AS DECIMAL(6,3)) AS DECIMAL(6,2)) AS VARCHAR)) AS message,
 amount, FALSE AS acknowledged
FROM st WHERE fraud_status <> 'LEGITIMATE'"""


def predictions(lake):
    with_score = fraud.fraud_features(lake("v_txn")).withColumn("fraud_score", F.expr(SCORE))
    return fraud.risk_factors(fraud.score_status(with_score))


@query("fraud_alerts", ALERT_SQL)
def fraud_alerts(lake):
    return fraud.fraud_alerts(predictions(lake))


@query("fraud_stats", f"""WITH {SCORED_CTE}, st AS (SELECT *, {STATUS_SQL} AS fraud_status, transaction_id % 3 = 0 AS acknowledged FROM scored)
SELECT count(*) AS total_predictions, count(*) FILTER (fraud_status = 'FRAUDULENT') AS fraud_detected,
 count(*) FILTER (fraud_status = 'SUSPICIOUS') AS suspicious_detected, count(*) FILTER (fraud_status <> 'LEGITIMATE') AS total_alerts,
 count(*) FILTER (fraud_status <> 'LEGITIMATE' AND NOT acknowledged) AS unacknowledged_alerts,
 round(count(*) FILTER (fraud_status = 'FRAUDULENT') / CAST(count(*) AS DOUBLE), 6) AS fraud_rate FROM st""")
def fraud_stats(lake):
    marked = fraud.score_status(scored(lake)).withColumn("acknowledged", F.col("transaction_id") % 3 == 0)
    return rounded(fraud.fraud_stats(marked), ["fraud_rate"])
