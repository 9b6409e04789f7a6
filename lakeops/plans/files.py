"""Source and sink round trips over whole input tables; files go to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeops.functions.exprs import ntz
from lakeops.operators import business, fraud
from lakeops.plans.fraud import rounded, scored
from lakeops.registry import query
from lakeops.session import fresh_dir
from lakeops.sources import folders, keyed, scan, sinks


def dated(lake):
    return lake("events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("date"))


@query("scan_date_range", "SELECT event_id, user_id, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'")
def scan_date_range(lake):
    path = fresh_dir(lake.spark, "dated")
    sinks.write_partitioned(dated(lake), path, ["date"])
    return scan.scan_date_range(lake.spark, path, "2024-01-15", 7).select("event_id", "user_id", "date")


@query("roundtrip_parquet", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus FROM orders")
def roundtrip_parquet(lake):
    path = fresh_dir(lake.spark, "orders")
    rows = lake("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    sinks.write_parquet(rows, path, partition_by=["o_orderstatus"])
    return scan.read_parquet(lake.spark, path, rows.schema)


@query("scan_ndjson", "SELECT event_id, user_id, event_type, CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS corrupt FROM (SELECT CASE WHEN event_id % 50 <> 0 THEN event_id END AS e, * FROM events)".replace("SELECT event_id, user_id, event_type, CASE", "SELECT e AS event_id, CASE WHEN e IS NOT NULL THEN user_id END AS user_id, CASE WHEN e IS NOT NULL THEN event_type END AS event_type, CASE"))
def scan_ndjson(lake):
    path = fresh_dir(lake.spark, "ndjson")
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    lake("events").select(F.when(F.col("event_id") % 50 == 0, "{broken").otherwise(line).alias("value")).write.text(path)
    out = scan.scan_ndjson(lake.spark, path, "event_id bigint, user_id bigint, event_type string")
    return out.select("event_id", "user_id", "event_type", F.when(F.col(scan.CORRUPT).isNotNull(), 1).otherwise(0).alias("corrupt"))


@query("write_partitioned", "SELECT event_id, value, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events")
def write_partitioned(lake):
    path = fresh_dir(lake.spark, "parts")
    rows = lake("events").select("event_id", "value", F.date_format("ts", "MM").alias("month"), F.date_format("ts", "dd").alias("day"))
    sinks.write_partitioned(rows, path, ["month", "day"])
    return lake.spark.read.schema(rows.schema).parquet(path)


@query("catalog_partitions", "SELECT strftime(ts, '%d') AS day, count(*) AS rows FROM events GROUP BY 1")
def catalog_partitions(lake):
    """A table known by its first days; the days that come later are registered one by one, and the catalog counts its rows."""
    path, name = fresh_dir(lake.spark, "catalog"), f"lake_events_{uuid.uuid4().hex[:8]}"
    rows = lake("events").select("event_id", "value", F.date_format("ts", "dd").alias("day"))
    early, late = rows.filter("day <= '20'"), rows.filter("day > '20'")
    sinks.write_partitioned(early, path, ["day"])
    sinks.register_table(lake.spark, name, path, "event_id bigint, value double, day string", ["day"])
    sinks.write_partitioned(late, path, ["day"])
    for (day,) in sorted(late.select("day").distinct().collect()):
        sinks.add_partition(lake.spark, name, day=day)
    sinks.analyze_table(lake.spark, name)
    return lake.spark.table(name).groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


LANDED = "SELECT event_id, user_id, value, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day{} FROM events"


@query("land_events", LANDED.format(", strftime(ts, '%H') AS hour"))
def land_events(lake):
    path = fresh_dir(lake.spark, "landing")
    sinks.land_events(lake("events").select("event_id", "user_id", "value", "ts"), path)
    return lake.spark.read.schema("event_id bigint, user_id bigint, value double, year string, month string, day string, hour string").json(path)


@query("bronze_transactions", "SELECT transaction_id, account_id, amount, location_country AS country, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM v_txn")
def bronze_transactions(lake):
    from lakeops.operators.quality import flatten

    path = fresh_dir(lake.spark, "bronze")
    nested = lake("v_txn").select("transaction_id", "account_id", "amount", "ts", F.struct(F.col("location_country").alias("country")).alias("location"))
    flat = flatten(nested, "_").withColumnRenamed("location_country", "country")
    sinks.land_events(flat, path)
    return lake.spark.read.schema("transaction_id bigint, account_id bigint, amount double, country string, day string, hour string").json(path).drop("year", "month")


@query("archive_jsonl", LANDED.format(""))
def archive_jsonl(lake):
    path = fresh_dir(lake.spark, "archive")
    sinks.archive_jsonl(lake("events").select("event_id", "user_id", "value", "ts"), path)
    return lake.spark.read.schema("event_id bigint, user_id bigint, value double, year string, month string, day string").json(path)


@query("archive_sms", """SELECT message_id, event_type, campaign_id, iso_country_code AS country_code, message_type, price_millicents, CASE WHEN event_type = '_SMS.RECEIVED' THEN message_body END AS response_text FROM v_sms""")
def archive_sms(lake):
    path = fresh_dir(lake.spark, "sms")
    rows = lake("v_sms").select(
        "message_id", "event_type", "campaign_id", F.col("iso_country_code").alias("country_code"), "message_type", "price_millicents",
        F.when(F.col("event_type") == "_SMS.RECEIVED", F.col("message_body")).alias("response_text"), F.col("event_timestamp").alias("ts"),
    )
    sinks.archive_jsonl(rows, path)
    return lake.spark.read.schema("message_id bigint, event_type string, campaign_id string, country_code string, message_type string, price_millicents double, response_text string").json(path).drop("year", "month", "day")


@query("alerts_shape", """WITH s AS (SELECT transaction_id, account_id, amount, CAST((transaction_id * 7919) % 1001 AS DOUBLE) / CAST(1000 AS DOUBLE) AS fraud_score FROM v_txn)
SELECT concat('alert-', transaction_id) AS alert_id, transaction_id, fraud_score, CASE WHEN fraud_score >= 0.7 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, amount FROM s WHERE fraud_score >= 0.4""")
def alerts_shape(lake):
    path = fresh_dir(lake.spark, "alerts")
    flagged = fraud.score_status(scored(lake)).filter("fraud_status <> 'LEGITIMATE'")
    shaped = flagged.select(
        F.concat(F.lit("alert-"), F.col("transaction_id").cast("string")).alias("alert_id"), "transaction_id", "fraud_score",
        F.when(F.col("fraud_status") == "FRAUDULENT", "HIGH").otherwise("MEDIUM").alias("severity"), "amount",
    )
    sinks.write_batch_once(shaped, 0, path)
    return lake.spark.read.schema(shaped.schema).parquet(f"{path}/batch_id=0")


ALERT = "alert_id string, transaction_id bigint, fraud_score double, severity string, amount double"


@query("alerts_put", """WITH s AS (SELECT transaction_id, account_id, amount, ts, CAST((transaction_id * 7919) % 1001 AS DOUBLE) / CAST(1000 AS DOUBLE) AS fraud_score FROM v_txn)
SELECT concat('account-', account_id) AS alert_id, max_by(transaction_id, struct_pack(a := ts, b := transaction_id)) AS transaction_id, max_by(fraud_score, struct_pack(a := ts, b := transaction_id)) AS fraud_score,
 CASE WHEN max_by(fraud_score, struct_pack(a := ts, b := transaction_id)) >= 0.7 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, max_by(amount, struct_pack(a := ts, b := transaction_id)) AS amount FROM s WHERE fraud_score >= 0.4 GROUP BY account_id""")
def alerts_put(lake):
    """The newest alert of every account in a keyed store: two batches, the second one put twice."""
    path = fresh_dir(lake.spark, "alert-store")
    ts = lake("v_txn").select("transaction_id", "ts")
    flagged = fraud.score_status(scored(lake)).filter("fraud_status <> 'LEGITIMATE'").drop("ts").join(ts, "transaction_id")
    shaped = flagged.select(
        F.concat(F.lit("account-"), F.col("account_id").cast("string")).alias("alert_id"), "transaction_id", "fraud_score",
        F.when(F.col("fraud_status") == "FRAUDULENT", "HIGH").otherwise("MEDIUM").alias("severity"), "amount", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
    )
    border = F.unix_micros(F.lit("2024-01-16").cast("timestamp"))
    for batch_id, rows in ((0, shaped.filter(F.col("at") < border)), (1, shaped.filter(F.col("at") >= border)), (1, shaped.filter(F.col("at") >= border))):
        keyed.put_once(rows, path, batch_id, "alert_id", ["at", "transaction_id"])
    return keyed.read_store(lake.spark, path, ALERT, "alert_id")


@query("variant_properties", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 5 = 1 THEN CAST(event_id AS VARCHAR) WHEN event_id % 5 = 2 THEN 'true' ELSE 'none' END AS tag,
 CASE WHEN event_id % 5 IN (1, 3) THEN value ELSE 0.0 END AS price, CASE event_id % 5 WHEN 3 THEN 'b' WHEN 4 THEN '?' END AS second, event_id % 5 = 0 AS is_bad FROM events""")
def variant_properties(lake):
    """Properties whose shape changes from row to row, read with defaults."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_id") % 5
    body = (
        F.when(kind == 0, F.concat(F.lit('{"k": '), k))  # cut off
        .when(kind == 1, F.concat(F.lit('{"k": "'), k, F.lit('", "tag": '), F.col("event_id"), F.lit(', "detail": {"price": '), F.col("value"), F.lit("}}")))
        .when(kind == 2, F.concat(F.lit('{"k": '), k, F.lit(', "tag": true, "detail": {"price": "free"}}')))
        .when(kind == 3, F.concat(F.lit('{"k": '), k, F.lit(', "detail": {"price": "'), F.col("value"), F.lit('"}, "list": ["a", "b"]}')))
        .otherwise(F.concat(F.lit('{"k": '), k, F.lit(', "list": ["a", "?"], "detail": []}')))
    )
    rows = lake("events").select("event_id", k.cast("bigint").alias("given"), body.alias("body"))
    out = scan.parse_variant(rows, "body", {"k": ("$.k", "bigint", None), "tag": ("$.tag", "string", "none"), "price": ("$.detail.price", "double", 0.0), "second": ("$.list[1]", "string", None)})
    return out.select("event_id", F.coalesce("k", "given").alias("k"), "tag", "price", "second", "is_bad")


@query("run_metrics", "SELECT 'events_load' AS job, '2024-02-01' AS run_at, count(*) AS rows, count(*) FILTER (event_type = 'error') AS errors FROM events")
def run_metrics(lake):
    rows, seen = sinks.observed(
        lake("events"), "load", rows=F.count(F.lit(1)), errors=F.count(F.when(F.col("event_type") == "error", 1))
    )
    rows.write.parquet(fresh_dir(lake.spark, "load"))
    path = fresh_dir(lake.spark, "metrics")
    sinks.run_record(lake.spark, "events_load", "2024-02-01", seen.get).coalesce(1).write.json(path)
    return lake.spark.read.schema("job string, run_at string, rows bigint, errors bigint").json(path)


@query("scan_csv", "SELECT user_id, content_id, watch_time, completion_rate FROM v_views")
def scan_csv(lake):
    path = fresh_dir(lake.spark, "views")
    views = lake("v_views").select("user_id", "content_id", "watch_time", "completion_rate", "ts")
    halves = [views.filter("content_id % 2 = 0"), views.filter("content_id % 2 = 1")]
    for i, half in enumerate(halves):
        half.write.option("header", True).csv(f"{path}/{i}")
    required = ["user_id", "content_id", "watch_time", "completion_rate"]
    schema = "user_id bigint, content_id bigint, watch_time double, completion_rate double, ts timestamp_ntz"
    return scan.scan_csv(lake.spark, [f"{path}/0", f"{path}/1"], schema, required).drop("ts")


FORMATS = [("parquet", "snappy"), ("parquet", "gzip"), ("orc", "zlib"), ("orc", "snappy"), ("json", "gzip"), ("json", "none"), ("csv", "gzip"), ("csv", "none")]


@query("roundtrip_formats", " UNION ALL ".join(f"SELECT '{f}' AS fmt, '{c}' AS codec, count(*) AS rows, count(DISTINCT s_name) AS names, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total FROM supplier" for f, c in FORMATS))
def roundtrip_formats(lake):
    rows = lake("supplier")
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    parts = []
    for fmt, codec in FORMATS:
        path = fresh_dir(lake.spark, f"{fmt}-{codec}")
        sinks.write_format(rows, fmt, path, codec)
        back = scan.scan_format(lake.spark, fmt, path, schema)
        parts.append(back.agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("s_name").alias("names"), F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("total")
        ).select(F.lit(fmt).alias("fmt"), F.lit(codec).alias("codec"), "*"))
    return scan.union_days(parts)


@query("backfill", "SELECT event_id, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' THEN value * 2 ELSE value END AS value, CAST(ts AS DATE) AS date FROM events")
def backfill(lake):
    path = fresh_dir(lake.spark, "backfill")
    rows = dated(lake).select("event_id", "value", "date")
    sinks.write_partitioned(rows, path, ["date"])
    again = rows.filter("date BETWEEN DATE'2024-01-05' AND DATE'2024-01-09'").withColumn("value", F.col("value") * 2)
    sinks.write_partitioned(again, path, ["date"])
    return lake.spark.read.schema(rows.schema).parquet(path)


@query("explode_log_envelope", "SELECT concat('g', user_id % 5) AS log_group, CAST(event_id AS VARCHAR) AS id, CAST(event_id AS BIGINT) AS timestamp, event_type AS action, user_id AS actor FROM events WHERE user_id % 50 <> 0 AND event_id % 40 <> 0")
def explode_log_envelope(lake):
    path = fresh_dir(lake.spark, "envelopes")
    message = F.when(F.col("event_id") % 40 == 0, "not json").otherwise(F.to_json(F.struct(F.col("event_type").alias("action"), F.col("user_id").alias("actor"))))
    item = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_id").alias("timestamp"), message.alias("message"))
    packed = lake("events").select("user_id", F.array(item).alias("logEvents"))
    kind = F.when(F.col("user_id") % 50 == 0, "CONTROL_MESSAGE").otherwise("DATA_MESSAGE")
    body = F.to_json(F.struct(kind.alias("messageType"), F.concat(F.lit("g"), (F.col("user_id") % 5).cast("string")).alias("logGroup"), "logEvents"))
    packed.select(body.alias("value")).write.option("compression", "gzip").text(path)
    return scan.explode_log_envelope(lake.spark.read.text(path), "value", "action string, actor bigint")


@query("parse_scored_lines", "SELECT event_id AS line, event_type AS sentiment, value AS positive, CAST(NULL AS VARCHAR) AS unread FROM events WHERE event_id % 30 <> 0 UNION ALL SELECT NULL, NULL, NULL, concat('oops', event_id) FROM events WHERE event_id % 30 = 0")
def parse_scored_lines(lake):
    path = fresh_dir(lake.spark, "scored")
    line = F.to_json(F.struct(F.col("event_id").alias("Line"), F.col("event_type").alias("Sentiment"), F.struct(F.col("value").alias("Positive")).alias("SentimentScore")))
    unread = F.concat(F.lit("oops"), F.col("event_id").cast("string"))
    lake("events").select(F.when(F.col("event_id") % 30 == 0, unread).otherwise(line).alias("value")).write.text(path)
    good, bad = scan.parse_scored_lines(lake.spark.read.text(path), "value", "Line bigint, Sentiment string, SentimentScore struct<Positive double>", "Line")
    read = good.select(F.col("Line").alias("line"), F.col("Sentiment").alias("sentiment"), F.col("SentimentScore.Positive").alias("positive"))
    return read.unionByName(bad.select(F.col("value").alias("unread")), allowMissingColumns=True)


@query("whole_documents", "SELECT concat('lang=', lang, '/doc_id=', doc_id) AS folder, TRUE AS own_id, concat(text, chr(10)) AS text FROM documents")
def whole_documents(lake):
    """Every file back as one row; its id is the hash of its own address below the root."""
    path = fresh_dir(lake.spark, "texts")
    folders.write_text_folders(lake("documents"), path, ["lang", "doc_id"], "text")
    files = scan.whole_documents(lake.spark, path)
    own = F.col("document_id") == F.left(F.sha2("address", 256), F.lit(16))
    return files.select(F.regexp_replace("address", "/part-[0-9]+$", "").alias("folder"), own.alias("own_id"), "text")


@query("partition_sizes")
def partition_sizes(lake):
    path = fresh_dir(lake.spark, "sizes")
    rows = lake("events").select("event_id", "value", F.date_format("ts", "dd").alias("day"))
    sinks.write_partitioned(rows, path, ["day"])
    return scan.partition_sizes(lake.spark, path, "day")


@query("union_days", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value END AS value, event_type FROM events")
def union_days(lake):
    events = lake("events")
    even = events.filter("event_id % 2 = 0").select("event_id", "value", "event_type")
    odd = events.filter("event_id % 2 = 1").select("event_type", "event_id")
    return scan.union_days([even, odd])


@query("sms_period_batch", """SELECT time_bucket(INTERVAL 5 MINUTES, event_timestamp) AS period_start, count(*) FILTER (event_type IN ('_SMS.SUCCESS', '_SMS.FAILURE')) AS messages_sent,
 count(*) FILTER (event_type = '_SMS.SUCCESS') AS messages_delivered, round(sum(price_millicents) / 100000, 6) AS total_cost_usd FROM v_sms GROUP BY 1""")
def sms_period_batch(lake):
    w = F.window("event_timestamp", "5 minutes")
    out = business.sms_metrics(lake("v_sms"), [w.alias("w")])
    return rounded(out.select(ntz("w.start").alias("period_start"), "messages_sent", "messages_delivered", "total_cost_usd"), ["total_cost_usd"])
