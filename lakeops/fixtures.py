"""Input tables and the domain-shaped views over them that the registered queries read.

A view is one SQL text in the dialect shared by Spark and DuckDB; ``{table}`` marks an
input table. Every view grows with its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.session import ship_package

VIEWS: dict[str, str] = {
    "v_txn": """
SELECT event_id AS transaction_id, user_id AS account_id,
 CASE WHEN event_id % 29 = 0 THEN NULL ELSE concat('m', CAST(event_id % 23 AS VARCHAR(10))) END AS merchant_id,
 concat('d', CAST(event_id % 7 AS VARCHAR(10))) AS device_id,
 CASE event_id % 6 WHEN 0 THEN 'POS' WHEN 1 THEN 'ATM' WHEN 2 THEN 'ONLINE' WHEN 3 THEN 'MOBILE' WHEN 4 THEN 'BRANCH' ELSE 'PHONE' END AS channel,
 CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'TRANSFER' WHEN 'error' THEN 'REFUND' ELSE 'DEPOSIT' END AS transaction_type,
 value AS amount, ts,
 46.0 + CAST((event_id * 37) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS location_lat,
 6.0 + CAST((event_id * 91) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS location_lon,
 CASE event_id % 5 WHEN 0 THEN 'CH' WHEN 1 THEN 'US' WHEN 2 THEN 'BR' WHEN 3 THEN 'DE' ELSE NULL END AS location_country
FROM {events}""",
    "v_gps": """
SELECT user_id % 20 AS truck_id, ts, event_id AS seq,
 46.0 + CAST((event_id * 37) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS latitude,
 6.0 + CAST((event_id * 91) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS longitude,
 CASE WHEN event_id % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE least(value, CAST(120 AS DOUBLE)) END AS speed_kmh,
 CASE WHEN event_id % 10 = 0 THEN 'idle' ELSE 'running' END AS engine_status FROM {events}""",
    "v_geofence": """
SELECT n_nationkey AS geofence_id, n_name AS name,
 CASE WHEN n_nationkey % 5 = 4 THEN 'polygon' ELSE 'circle' END AS geofence_type,
 46.0 + CAST((n_nationkey * 41) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS center_latitude,
 6.0 + CAST((n_nationkey * 67) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS center_longitude,
 CAST(5000 + n_nationkey * 500 AS DOUBLE) AS radius_meters,
 CASE n_nationkey % 3 WHEN 0 THEN 'enter' WHEN 1 THEN 'exit' ELSE 'both' END AS alert_on FROM {nation}""",
    "v_imaging": """
SELECT p_partkey AS image_id, p_partkey AS study_id, p_partkey % 500 AS patient_id,
 CASE p_partkey % 4 WHEN 0 THEN 'CT' WHEN 1 THEN 'MRI' WHEN 2 THEN 'XRAY' ELSE 'ct' END AS modality,
 CASE p_partkey % 3 WHEN 0 THEN 'CHEST' WHEN 1 THEN 'HEAD' ELSE 'SPINE' END AS body_part,
 p_size % 5 AS facility_id, DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS acquisition_date,
 p_partkey * 1000003 % 104857600 AS file_size_bytes,
 CASE p_partkey % 5 WHEN 0 THEN split('J18.9,R06.0', ',') WHEN 1 THEN split('I10', ',') WHEN 2 THEN split('J18.9', ',') WHEN 3 THEN split('E11.9,I10', ',') ELSE NULL END AS condition_codes FROM {part}""",
    "v_clinical": """
SELECT p_partkey + 1000000 AS record_id, p_partkey AS study_id, p_partkey % 500 AS patient_id, p_type AS diagnosis,
 split(CASE WHEN p_partkey % 2 = 0 THEN 'J18.9' ELSE 'I10,E11.9' END, ',') AS condition_codes, p_size % 5 AS facility_id,
 20 + p_size AS age_at_study, CASE WHEN p_partkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex FROM {part} WHERE p_partkey % 3 <> 0""",
    "v_calls": """
SELECT conv_id AS call_id, conv_id % 10 AS agent_id, conv_id % 37 AS customer_id, count(*) AS segments, CAST(sum(length(text)) AS BIGINT) AS duration,
 CASE conv_id % 4 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE' WHEN 2 THEN 'NEUTRAL' ELSE 'MIXED' END AS sentiment,
 CAST(conv_id % 11 AS DOUBLE) / CAST(10 AS DOUBLE) AS positive_score, DATE '2024-01-01' + CAST(conv_id % 30 AS INT) AS call_date FROM {conversations} GROUP BY conv_id""",
    "v_sms": """
SELECT event_id AS message_id, ts AS event_timestamp,
 CASE event_id % 10 WHEN 0 THEN '_SMS.FAILURE' WHEN 1 THEN '_SMS.OPTOUT' WHEN 2 THEN '_SMS.RECEIVED' WHEN 3 THEN '_SMS.BUFFERED' ELSE '_SMS.SUCCESS' END AS event_type,
 CASE WHEN event_id % 8 = 0 THEN '' ELSE concat('c', CAST(event_id % 8 AS VARCHAR(10))) END AS campaign_id,
 CASE event_id % 4 WHEN 0 THEN 'CH' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' ELSE '' END AS iso_country_code,
 CASE WHEN event_id % 3 = 0 THEN 'TRANSACTIONAL' ELSE 'PROMOTIONAL' END AS message_type, CAST(500 + event_id % 400 AS DOUBLE) AS price_millicents,
 CASE event_id % 5 WHEN 0 THEN 'YES' WHEN 1 THEN 'no thanks' WHEN 2 THEN 'thanks!' WHEN 3 THEN 'What time?' ELSE 'STOP' END AS message_body, user_id AS subscriber_id FROM {events}""",
    "v_products": """
SELECT p_partkey AS sku, p_name AS name, p_brand AS category_id, p_partkey % 100 AS supplier_id, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
 CAST((p_partkey * 7) % 60 AS INT) AS quantity_in_stock, 10 AS reorder_level, 50 AS reorder_quantity, p_partkey % 13 <> 0 AS is_active FROM {part}""",
    "v_bank_txn": """
SELECT o_orderkey AS transaction_id, concat('k', CAST(o_custkey AS VARCHAR(20)), '-', CAST(o_orderkey % 3 AS VARCHAR(5))) AS idempotency_key,
 CASE o_orderkey % 4 WHEN 0 THEN 'DEPOSIT' WHEN 1 THEN 'WITHDRAWAL' WHEN 2 THEN 'TRANSFER' ELSE 'PAYMENT' END AS transaction_type,
 lpad(CAST(o_custkey AS VARCHAR(20)), 10, CASE WHEN o_custkey % 50 = 0 THEN '0' ELSE '7' END) AS source_account,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE lpad(CAST(o_orderkey AS VARCHAR(20)), 10, '8') END AS target_account,
 CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderdate AS ts FROM {orders}""",
    "v_views": """
SELECT user_id, event_id, event_id % 97 AS content_id, value AS watch_time, least(value / CAST(100 AS DOUBLE), CAST(1 AS DOUBLE)) AS completion_rate, ts FROM {events}""",
    "v_content": """
SELECT p_partkey AS content_id, p_brand AS genre, p_type AS rating, p_size AS duration_minutes,
 DATE '2023-01-01' + CAST(p_partkey % 365 AS INT) AS release_date FROM {part}""",
    "v_lineage": """
SELECT o_orderkey AS job_execution_id, concat('/p', CAST(CAST(floor((o_orderkey - 1) / 2.0) AS BIGINT) AS VARCHAR(20)), '/') AS input_path,
 concat('/p', CAST(o_orderkey AS VARCHAR(20)), '/') AS output_path, o_orderdate AS start_time FROM {orders}""",
    "v_invocations": """
SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN 'canary' ELSE 'production' END AS variant_name, value * CAST(1000 AS DOUBLE) AS model_latency_us, CASE WHEN event_id % 31 = 0 THEN NULL ELSE value * CAST(40 AS DOUBLE) END AS overhead_latency_us,
 CAST(event_id * 7 % 101 AS DOUBLE) AS cpu_utilization, CAST(event_id * 3 % 97 AS DOUBLE) AS memory_utilization, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id % 83 AS DOUBLE) END AS disk_utilization, CASE WHEN event_id % 50 = 0 THEN 500 WHEN event_id % 70 = 0 THEN 404 ELSE 200 END AS status_code FROM {events}""",
    "v_events_lake": """
SELECT CAST(event_id AS VARCHAR(20)) AS event_id, ts, event_type, CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR(20)) END AS user_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('s', CAST(user_id AS VARCHAR(10)), '-', CAST(event_id % 4 AS VARCHAR(3))) END AS session_id, props,
 CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'US' WHEN 2 THEN 'CH' ELSE 'DE' END AS geo_country, concat('city', CAST(user_id % 40 AS VARCHAR(5))) AS geo_city FROM {events}""",
    "v_audit": """
SELECT event_id, ts, user_id % 12 AS tenant_id, user_id,
 CASE event_id % 11 WHEN 0 THEN 'ConsoleLogin' WHEN 1 THEN 'DeleteTrail' WHEN 2 THEN 'PutBucketPolicy' WHEN 3 THEN 'CreateUser' WHEN 4 THEN 'StopLogging' ELSE 'GetObject' END AS event_name,
 CASE event_id % 13 WHEN 0 THEN 'AccessDenied' WHEN 1 THEN 'Client.UnauthorizedOperation' WHEN 2 THEN 'ThrottlingException' ELSE NULL END AS error_code,
 CASE WHEN event_id % 3 = 0 THEN 'Failure' ELSE 'Success' END AS login_result,
 CASE event_id % 4 WHEN 0 THEN 'PII_DETECTION' WHEN 1 THEN 'PII_TOKENIZATION' WHEN 2 THEN 'JOB_START' ELSE 'JOB_COMPLETE' END AS audit_type,
 CASE event_id % 9 WHEN 0 THEN 'FAILURE' WHEN 1 THEN 'IN_PROGRESS' ELSE 'SUCCESS' END AS status,
 CASE WHEN event_id % 8 = 0 THEN NULL ELSE concat('job', CAST(user_id % 6 AS VARCHAR(5))) END AS job_name,
 concat(CASE event_id % 3 WHEN 0 THEN 'users' WHEN 1 THEN 'orders' ELSE 'reports' END, '/', CAST(event_id AS VARCHAR(20))) AS resource,
 CASE WHEN event_id % 2 = 0 THEN split('email,phone', ',') ELSE split('card', ',') END AS columns_accessed,
 CAST(floor(value) AS BIGINT) AS records_processed FROM {events}""",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


class Lake:
    """Input tables of one scale folder; ``lake("name")`` is a table or a view."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if name in VIEWS:
            scans = {t: f"parquet.`{self.path(t)}`" for t in TABLES}
            return self.spark.sql(VIEWS[name].format(**scans))
        return self.spark.read.parquet(self.path(name))
