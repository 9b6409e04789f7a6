"""Streams over whole input tables, fed in three slices with a restart between them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.exprs import ntz
from lakeops.operators import business
from lakeops.plans.business import ACCEPT_SQL, AUDIT_SQL, DETAIL, ROUTE_SQL, SMS_ROUNDED, SOURCE
from lakeops.plans.fleet import ALERTS_SQL, SEGMENT_SQL, TRIP_COLS, fences, neat_trips
from lakeops.plans.fraud import SCORE, SCORED_CTE, STATUS_SQL, VECTOR, feature_oracle, rounded
from lakeops.registry import query
from lakeops.sources import scan
from lakeops.streaming import jobs, run, state


def slices(df, ts="ts", cuts=("2024-01-11", "2024-01-21")):
    edges = [F.to_timestamp_ntz(F.lit(c)) for c in cuts]
    t = F.col(ts)
    return [df.filter(t < edges[0]), df.filter((t >= edges[0]) & (t < edges[1])), df.filter(t >= edges[1])]


def replayed(lake, parts, build, label, mode="append"):
    """Run a stream over the slices and read back all of its micro-batches."""
    schema = {}

    def writer(stream, folder):
        out = build(stream)
        schema["out"] = out.schema
        return run.to_folder(out, folder, mode)

    folder = run.replay(parts, writer, label)
    return run.read_batches(lake.spark, folder, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema['out'].fields)}, batch_id bigint")


@query("stream_parse", "SELECT CASE WHEN event_id % 25 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 25 <> 0 THEN value END AS value, event_id % 25 = 0 AS is_bad, CASE WHEN event_id % 25 = 0 THEN concat('{bad ', event_id) END AS raw FROM events")
def stream_parse(lake):
    good = F.to_json(F.struct("event_id", "value"))
    body = F.when(F.col("event_id") % 25 == 0, F.concat(F.lit("{bad "), F.col("event_id").cast("string"))).otherwise(good)
    rows = lake("events").select("ts", F.encode(body, "UTF-8").alias("data"))
    out = replayed(lake, slices(rows), lambda s: run.parse_events(s, "data", "event_id bigint, value double", "event_id"), "parse")
    return out.select("event_id", "value", "is_bad", "raw")


@query("stream_scoring", f"WITH {SCORED_CTE} SELECT transaction_id, fraud_score, {STATUS_SQL} AS fraud_status, {STATUS_SQL} <> 'LEGITIMATE' AS alerted FROM scored")
def stream_scoring(lake):
    rows = lake("v_txn").select("transaction_id", "account_id", "amount", "ts")
    folder = run.replay(slices(rows), lambda s, f: jobs.score_batches(s, lambda b: b.withColumn("fraud_score", F.expr(SCORE)), f), "scoring")
    schema = "transaction_id bigint, fraud_score double, fraud_status string, batch_id bigint"
    predictions = run.read_batches(lake.spark, folder, schema, "predictions").drop("batch_id")
    alerts = run.read_batches(lake.spark, folder, schema, "alerts").select("transaction_id", F.lit(True).alias("alerted"))
    return predictions.join(alerts, "transaction_id", "left").withColumn("alerted", F.coalesce("alerted", F.lit(False)))


@query("stream_latest", "SELECT truck_id, ts, seq, latitude, longitude, speed_kmh FROM v_gps QUALIFY row_number() OVER (PARTITION BY truck_id ORDER BY ts DESC, seq DESC) = 1")
def stream_latest(lake):
    out = replayed(lake, slices(lake("v_gps")), jobs.latest_positions, "latest", "update")
    return run.last_values(out, ["truck_id"]).select("truck_id", "ts", "seq", "latitude", "longitude", "speed_kmh")


@query("stream_geofence", ALERTS_SQL)
def stream_geofence(lake):
    static = fences(lake).withColumn("geofence_id", F.col("geofence_id").cast("bigint"))
    out = replayed(lake, slices(lake("v_gps")), lambda s: jobs.geofence_transitions(s, static), "geofence")
    return out.select("truck_id", "seq", "ts", "latitude", "longitude", F.col("geofence_id").cast("int").alias("geofence_id"), "geofence_name", "alert_type")


@query("stream_trip_stats", f"""WITH {SEGMENT_SQL}, d AS (SELECT *, date_trunc('day', ts) AS w FROM dist)
SELECT truck_id, CAST(w AS TIMESTAMP) AS window_start, {TRIP_COLS} FROM d GROUP BY truck_id, w""")
def stream_trip_stats(lake):
    """Every truck day; the last ones are closed by a row that only moves the clock."""
    rows = lake("v_gps")
    out = replayed(lake, [*slices(rows), run.closing_row(rows, "ts", "3 DAYS")], jobs.trip_windows, "trips")
    return neat_trips(jobs.trips_of(out))


@query("stream_late_fixes", """WITH s AS (SELECT truck_id, seq, ts, CASE WHEN seq % 40 = 0 AND ts < TIMESTAMP '2024-01-21' THEN 3 WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS part FROM v_gps),
seen AS (SELECT truck_id, max(ts) AS last, max_by(seq, struct_pack(t := ts, s := seq)) AS last_seq FROM s WHERE part < 3 GROUP BY truck_id)
SELECT truck_id, seq, ts FROM s JOIN seen USING (truck_id) WHERE part = 3 AND (ts < last OR (ts = last AND seq <= last_seq))""")
def stream_late_fixes(lake):
    """One fix in forty arrives days late, with the last slice; those older than what their truck has sent come out as late."""
    rows = lake("v_gps")
    held = (F.col("seq") % 40 == 0) & (F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-21")))
    first, second, third = slices(rows.filter(~held))
    out = replayed(lake, [first, second, third.unionByName(rows.filter(held))], jobs.trip_windows, "late-trips")
    return jobs.late_fixes_of(out)


SMS_PERIOD = """count(*) FILTER (event_type IN ('_SMS.SUCCESS', '_SMS.FAILURE')) AS messages_sent, count(*) FILTER (event_type = '_SMS.SUCCESS') AS messages_delivered,
 round(sum(price_millicents) / 100000, 6) AS total_cost_usd FROM v_sms"""


@query("stream_sms_metrics", f"SELECT time_bucket(INTERVAL 5 MINUTES, event_timestamp) AS period_start, {SMS_PERIOD} GROUP BY 1")
def stream_sms_metrics(lake):
    rows = lake("v_sms").select("message_id", "event_timestamp", "event_type", "price_millicents", "campaign_id")
    out = replayed(lake, slices(rows, "event_timestamp"), jobs.sms_periods, "sms", "update")
    current = run.last_values(out, ["w"]).select(ntz("w.start").alias("period_start"), "messages_sent", "messages_delivered", "total_cost_usd")
    return rounded(current, SMS_ROUNDED)


@query("stream_sms_campaigns", f"SELECT time_bucket(INTERVAL 5 MINUTES, event_timestamp) AS period_start, campaign_id, {SMS_PERIOD} GROUP BY ALL")
def stream_sms_campaigns(lake):
    rows = lake("v_sms").select("message_id", "event_timestamp", "event_type", "price_millicents", "campaign_id")
    out = replayed(lake, slices(rows, "event_timestamp"), lambda s: jobs.sms_periods(s, "campaign_id"), "campaigns", "update")
    current = run.last_values(out, ["w", "campaign_id"]).select(ntz("w.start").alias("period_start"), "campaign_id", "messages_sent", "messages_delivered", "total_cost_usd")
    return rounded(current, SMS_ROUNDED)


@query("stream_dedup", ACCEPT_SQL)
def stream_dedup(lake):
    rows = lake("v_bank_txn").select("transaction_id", "idempotency_key", "source_account", "ts")
    failed = F.col("source_account").startswith("0000")
    out = replayed(
        lake, slices(rows, cuts=("1996-06-01", "1999-01-01")),
        lambda s: state.accept_once_in_stream(s, "idempotency_key", "ts", "transaction_id", failed), "dedup",
    )
    return out.select("transaction_id", "idempotency_key", "accepted")


@query("stream_features", feature_oracle(VECTOR))
def stream_features(lake):
    """The whole fraud vector from a stream, as the batch operator gives it."""
    rows = lake("v_txn")
    out = replayed(lake, slices(rows), jobs.fraud_vectors, "features").filter(~F.col("late"))
    return rounded(out.select(*VECTOR))


@query("stream_archive", "SELECT event_id, value, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events")
def stream_archive(lake):
    rows = lake("events").select("event_id", "value", "ts")
    folder = run.replay(slices(rows), jobs.archive, "archive")
    return lake.spark.read.schema("event_id bigint, value double, year string, month string, day string").json(f"{folder}/archive")


@query("stream_audit", AUDIT_SQL)
def stream_audit(lake):
    message = F.to_json(F.struct("tenant_id", "user_id", F.col("ts").cast("string").alias("ts"), "event_name", "error_code", "login_result"))
    item = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_id").alias("timestamp"), message.alias("message"))
    body = F.to_json(F.struct(F.lit("DATA_MESSAGE").alias("messageType"), F.lit("audit").alias("logGroup"), F.array(item).alias("logEvents")))
    rows = lake("v_audit").select("ts", body.alias("value"))
    schema = "tenant_id bigint, user_id bigint, ts string, event_name string, error_code string, login_result string"

    def classify(stream):
        events = scan.explode_log_envelope(stream, "value", schema)
        return business.classify_audit(events.withColumns({"event_id": F.col("timestamp"), "ts": F.col("ts").cast("timestamp_ntz")}))

    out = replayed(lake, slices(rows), classify, "audit")
    return out.select("event_id", "tenant_id", "user_id", "ts", "audit_kind", "result", "detail")


@query("stream_routes", ROUTE_SQL)
def stream_routes(lake):
    rows = lake("events").select("event_id", "ts", F.expr(SOURCE).alias("source"), F.expr(DETAIL).alias("detail_type"))
    folder = run.replay(slices(rows), jobs.route_batches, "routes")
    out = run.read_batches(lake.spark, folder, "event_id bigint, source string, detail_type string, batch_id bigint, handler string", "routes")
    return out.select("event_id", "source", "detail_type", "handler")


@query("incremental_etl", "SELECT strftime(ts, '%d') AS day, count(*) AS rows, count(DISTINCT event_id) AS events FROM events GROUP BY 1")
def incremental_etl(lake):
    """Each run reads only the files that are new since the last one."""
    rows = lake("events").select("event_id", "value", "ts")
    out = replayed(lake, slices(rows), lambda s: s.select("event_id", F.date_format("ts", "dd").alias("day")), "etl")
    return out.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"))
