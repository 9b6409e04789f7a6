"""Messaging, call, inventory, banking, audit, monitoring and recommender queries."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import fixed
from lakeops.operators import business as biz
from lakeops.operators import idempotency, models, monitoring, privacy, quality, ranks, reports, scores, search
from lakeops.plans.fraud import rounded
from lakeops.registry import query
from lakeops.session import materialize

# --- messaging --------------------------------------------------------------------

SMS = """count(*) FILTER (event_type IN ('_SMS.SUCCESS', '_SMS.FAILURE')) AS messages_sent, count(*) FILTER (event_type = '_SMS.SUCCESS') AS messages_delivered,
 count(*) FILTER (event_type = '_SMS.FAILURE') AS messages_failed, count(*) FILTER (event_type = '_SMS.RECEIVED') AS responses_received,
 count(*) FILTER (event_type = '_SMS.OPTOUT') AS opt_outs, round(sum(price_millicents) / 100000, 6) AS total_cost_usd,
 round(coalesce(count(*) FILTER (event_type = '_SMS.SUCCESS') / nullif(CAST(count(*) FILTER (event_type IN ('_SMS.SUCCESS', '_SMS.FAILURE')) AS DOUBLE), 0), 0.0), 6) AS delivery_rate,
 round(coalesce(count(*) FILTER (event_type = '_SMS.RECEIVED') / nullif(CAST(count(*) FILTER (event_type IN ('_SMS.SUCCESS', '_SMS.FAILURE')) AS DOUBLE), 0), 0.0), 6) AS response_rate"""
SMS_ROUNDED = ["total_cost_usd", "delivery_rate", "response_rate"]


@query("sms_metrics", f"SELECT {SMS} FROM v_sms")
def sms_metrics(lake):
    return rounded(biz.sms_metrics(lake("v_sms")), SMS_ROUNDED)


@query("sms_by_campaign", f"SELECT campaign_id, {SMS} FROM v_sms WHERE campaign_id <> '' GROUP BY campaign_id")
def sms_by_campaign(lake):
    return rounded(biz.sms_by_campaign(lake("v_sms")), SMS_ROUNDED)


@query("sms_by_country", """SELECT CASE WHEN iso_country_code = '' THEN 'unknown' ELSE iso_country_code END AS country, count(*) FILTER (event_type = '_SMS.SUCCESS') AS delivered,
 count(*) FILTER (event_type = '_SMS.FAILURE') AS failed, round(sum(price_millicents) / 100000, 6) AS cost FROM v_sms GROUP BY 1""")
def sms_by_country(lake):
    return rounded(biz.sms_by_country(lake("v_sms")), ["cost"])


@query("delivery_stats", """WITH s AS (SELECT message_type, count(*) FILTER (event_type IN ('_SMS.SUCCESS', '_SMS.FAILURE', '_SMS.BUFFERED')) AS total, count(*) FILTER (event_type = '_SMS.SUCCESS') AS delivered,
 count(*) FILTER (event_type = '_SMS.FAILURE') AS failed, count(*) FILTER (event_type = '_SMS.BUFFERED') AS buffered FROM v_sms GROUP BY GROUPING SETS ((), (message_type)))
SELECT *, round(delivered / CAST(total AS DOUBLE), 6) AS delivery_rate, round(failed / CAST(total AS DOUBLE), 6) AS failure_rate FROM s""")
def delivery_stats(lake):
    return rounded(biz.delivery_stats(lake("v_sms")), ["delivery_rate", "failure_rate"])


REPLY_WORDS = "list_filter(regexp_split_to_array(lower(message_body), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
NEG, POS = str(fixed.NEGATIVE_WORDS), str(fixed.POSITIVE_WORDS)


@query("sms_sentiment", f"""SELECT message_id, CASE WHEN list_has_any({REPLY_WORDS}, {NEG}) THEN 'negative' WHEN list_has_any({REPLY_WORDS}, {POS}) THEN 'positive' ELSE 'neutral' END AS sentiment,
 upper(trim(message_body)) IN ('STOP','UNSUBSCRIBE','CANCEL','END','QUIT') AS is_opt_out, upper(trim(message_body)) IN ('YES','Y','CONFIRM','OK','1') AS is_confirmation FROM v_sms""")
def sms_sentiment(lake):
    return biz.reply_flags(lake("v_sms")).select("message_id", "sentiment", "is_opt_out", "is_confirmation")


@query("subscriber_status", """SELECT subscriber_id, arg_max(CASE WHEN message_body = 'STOP' THEN 'OPTED_OUT' ELSE 'ACTIVE' END, (event_timestamp, message_id)) AS status, max(event_timestamp) AS updated_at
 FROM v_sms WHERE message_body IN ('STOP', 'YES') GROUP BY subscriber_id""")
def subscriber_status(lake):
    return biz.subscriber_status(lake("v_sms"))


# --- calls ------------------------------------------------------------------------

CALLS = """count(*) AS total_calls, count(*) FILTER (sentiment = 'POSITIVE') AS positive_calls, count(*) FILTER (sentiment = 'NEGATIVE') AS negative_calls,
 count(*) FILTER (sentiment = 'NEUTRAL') AS neutral_calls, count(*) FILTER (sentiment = 'MIXED') AS mixed_calls,
 round(sum(duration) / CAST(count(*) AS DOUBLE), 6) AS avg_duration, round(CAST(sum(positive_score) AS DOUBLE) / count(*), 6) AS avg_positive_score"""
CALL_ROUNDED = ["avg_duration", "avg_positive_score", "satisfaction_rate"]


@query("call_metrics", f"SELECT {CALLS} FROM v_calls")
def call_metrics(lake):
    return rounded(biz.call_metrics(lake("v_calls")), CALL_ROUNDED)


@query("agent_metrics", f"SELECT agent_id, {CALLS}, round(count(*) FILTER (sentiment = 'POSITIVE') / CAST(count(*) AS DOUBLE), 6) AS satisfaction_rate FROM v_calls GROUP BY agent_id")
def agent_metrics(lake):
    return rounded(biz.agent_metrics(lake("v_calls")), CALL_ROUNDED)


@query("top_agents", """WITH a AS (SELECT agent_id, count(*) AS total_calls, count(*) FILTER (sentiment = 'POSITIVE') AS positive_calls, count(*) FILTER (sentiment = 'NEGATIVE') AS negative_calls,
 round(count(*) FILTER (sentiment = 'POSITIVE') / CAST(count(*) AS DOUBLE) * 100, 1) AS satisfaction_rate, round(sum(duration) / CAST(count(*) AS DOUBLE), 0) AS avg_duration FROM v_calls GROUP BY agent_id)
SELECT * FROM a ORDER BY satisfaction_rate DESC, agent_id LIMIT 10""")
def top_agents(lake):
    return biz.top_agents(lake("v_calls"))


TERM_SPLIT = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


def call_terms(lake):
    turns = lake("conversations").select(F.col("conv_id").alias("call_id"), F.expr("array_remove(split(lower(text), '[^\\\\p{L}\\\\p{N}]+'), '')").alias("terms"))
    return turns.join(lake("v_calls").select("call_id", "agent_id", "sentiment"), "call_id")


@query("agent_top_terms", f"""WITH t AS (SELECT agent_id, unnest({TERM_SPLIT}) AS term FROM conversations JOIN v_calls ON call_id = conv_id)
SELECT agent_id, term, count(*) AS mentions FROM t GROUP BY agent_id, term QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY count(*) DESC, term) <= 10""")
def agent_top_terms(lake):
    return biz.top_terms(call_terms(lake), ["agent_id"], F.col("terms"))


@query("top_terms_negative", f"""WITH t AS (SELECT unnest({TERM_SPLIT}) AS term FROM conversations JOIN v_calls ON call_id = conv_id WHERE sentiment = 'NEGATIVE')
SELECT term, count(*) AS mentions FROM t GROUP BY term ORDER BY mentions DESC, term LIMIT 10""")
def top_terms_negative(lake):
    return biz.top_terms(call_terms(lake).filter("sentiment = 'NEGATIVE'"), [], F.col("terms"))


@query("call_recommendations", f"""WITH neg AS (SELECT count(*) AS n FROM v_calls WHERE sentiment = 'NEGATIVE'),
t AS (SELECT unnest({TERM_SPLIT}) AS term FROM conversations JOIN v_calls ON call_id = conv_id WHERE sentiment = 'NEGATIVE'),
top AS (SELECT term, count(*) AS mentions FROM t GROUP BY term ORDER BY mentions DESC, term LIMIT 10),
f AS (SELECT 1 AS rank, concat('High volume of negative calls (', n, '). Consider reviewing agent training programs.') AS recommendation FROM neg WHERE n > 50
 UNION ALL SELECT 2, concat('''', term, ''' mentioned in ', mentions, ' negative calls. Investigate related issues.') FROM (SELECT * FROM top ORDER BY mentions DESC, term LIMIT 3) WHERE mentions > 5
 UNION ALL SELECT 3, concat('''', term, ''' appears frequently in negative calls. Review related processes.') FROM (SELECT * FROM top WHERE mentions > 3 AND regexp_matches(term, 'wait|slow|problem|issue|frustrated') ORDER BY mentions DESC, term LIMIT 1))
SELECT * FROM f UNION ALL SELECT 4, 'No critical issues detected. Continue monitoring call quality.' WHERE NOT EXISTS (SELECT 1 FROM f)""")
def call_recommendations(lake):
    negative = lake("v_calls").filter("sentiment = 'NEGATIVE'")
    terms = biz.top_terms(call_terms(lake).filter("sentiment = 'NEGATIVE'"), [], F.col("terms"))
    return biz.recommendations(negative, terms, terms)


@query("sentiment_trend", """WITH d AS (SELECT CAST(unnest(generate_series(min(call_date), max(call_date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_calls),
k AS (SELECT CAST(call_date AS DATE) AS date, count(*) AS n, count(*) FILTER (sentiment = 'POSITIVE') AS p, count(*) FILTER (sentiment = 'NEGATIVE') AS g, count(*) FILTER (sentiment = 'NEUTRAL') AS u,
 round(CAST(sum(positive_score) AS DOUBLE) / count(*), 6) AS s FROM v_calls GROUP BY 1)
SELECT d.date, coalesce(n, 0) AS total_calls, coalesce(p, 0) AS positive_calls, coalesce(g, 0) AS negative_calls, coalesce(u, 0) AS neutral_calls, s AS avg_positive_score FROM d LEFT JOIN k ON d.date = k.date""")
def sentiment_trend(lake):
    return rounded(biz.sentiment_trend(lake("v_calls")), ["avg_positive_score"])


@query("sentiment_trend_hourly", """WITH h AS (SELECT event_id, date_trunc('hour', ts) AS date, CASE event_type WHEN 'purchase' THEN 'POSITIVE' WHEN 'error' THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment, CAST(event_id % 10 AS DOUBLE) / 10.0 AS s FROM events),
d AS (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 HOUR)) AS date FROM h),
k AS (SELECT date, count(*) AS n, count(*) FILTER (sentiment = 'POSITIVE') AS p, count(*) FILTER (sentiment = 'NEGATIVE') AS g, count(*) FILTER (sentiment = 'NEUTRAL') AS u, round(avg(s), 6) AS s FROM h GROUP BY 1)
SELECT d.date, coalesce(n, 0) AS total_calls, coalesce(p, 0) AS positive_calls, coalesce(g, 0) AS negative_calls, coalesce(u, 0) AS neutral_calls, s AS avg_positive_score FROM d LEFT JOIN k ON d.date = k.date""")
def sentiment_trend_hourly(lake):
    mood = F.when(F.col("event_type") == "purchase", "POSITIVE").when(F.col("event_type") == "error", "NEGATIVE").otherwise("NEUTRAL")
    calls = lake("events").select(F.col("event_id").alias("call_id"), F.col("ts").alias("call_date"), mood.alias("sentiment"), ((F.col("event_id") % 10).cast("double") / 10.0).alias("positive_score"), F.lit(1).cast("bigint").alias("duration"))
    return rounded(biz.sentiment_trend(calls, "hour"), ["avg_positive_score"])


@query("period_compare", """WITH r AS (SELECT *, date_diff('day', CAST(call_date AS DATE), DATE '2024-01-31') AS age FROM v_calls),
p AS (SELECT age <= 15 AS now, count(*) AS n, count(*) FILTER (sentiment = 'POSITIVE') AS pos, count(*) FILTER (sentiment = 'NEGATIVE') AS neg, sum(duration) AS dur FROM r WHERE age > 0 AND age <= 30 GROUP BY 1),
q AS (SELECT CAST(max(n) FILTER (now) AS DOUBLE) AS n1, CAST(max(n) FILTER (NOT now) AS DOUBLE) AS n0, max(pos) FILTER (now) AS p1, max(pos) FILTER (NOT now) AS p0, max(neg) FILTER (now) AS g1, max(neg) FILTER (NOT now) AS g0, CAST(max(dur) FILTER (now) AS DOUBLE) AS d1, CAST(max(dur) FILTER (NOT now) AS DOUBLE) AS d0 FROM p)
SELECT CAST(n1 AS BIGINT) AS total_calls, round((n1 - n0) / n0 * 100, 6) AS total_calls_change, round(p1 / n1, 6) AS positive_rate, round((p1 / n1 - p0 / n0) / (p0 / n0) * 100, 6) AS positive_rate_change,
 round(g1 / n1, 6) AS negative_rate, round((g1 / n1 - g0 / n0) / (g0 / n0) * 100, 6) AS negative_rate_change, round(d1 / n1, 6) AS avg_duration, round((d1 / n1 - d0 / n0) / (d0 / n0) * 100, 6) AS avg_duration_change FROM q""")
def period_compare(lake):
    out = reports.period_compare(lake("v_calls"), "call_date", "2024-01-31", 15)
    return rounded(out, [n for n in out.columns if n != "total_calls"])


@query("call_quality", """SELECT call_id, CAST(greatest(0, least(100, 50 + CASE sentiment WHEN 'POSITIVE' THEN 30 WHEN 'NEUTRAL' THEN 15 WHEN 'MIXED' THEN 5 ELSE -10 END
 + CASE call_id % 5 WHEN 0 THEN 20 WHEN 1 THEN 10 WHEN 2 THEN 0 WHEN 3 THEN -15 ELSE 0 END + CASE WHEN duration > 0 AND duration < 60 THEN -5 WHEN duration > 600 THEN -10 ELSE 0 END)) AS DOUBLE) AS quality_score FROM v_calls""")
def call_quality(lake):
    customer = F.expr("CASE call_id % 5 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEUTRAL' WHEN 2 THEN 'MIXED' WHEN 3 THEN 'NEGATIVE' END")
    return biz.call_quality(lake("v_calls").withColumn("customer_sentiment", customer)).select("call_id", "quality_score")


def _text_sql(where: str) -> str:
    agg = f"string_agg(text, ' ' ORDER BY turn){' FILTER (' + where + ')' if where else ''}"
    return f"coalesce(trim(regexp_replace({agg}, '\\s+', ' ', 'g')), '')"


@query("call_texts", f"""SELECT conv_id, {_text_sql('')} AS full_text, {_text_sql("role = 'user'")} AS customer_text, {_text_sql("role = 'assistant'")} AS agent_text
 FROM conversations GROUP BY ALL""")
def call_texts(lake):
    return biz.call_texts(lake("conversations"), "conv_id", "turn", "role", "text")


def transcripts(lake):
    """One JSON body per turn, with changing key styles and gaps."""
    t = lake("conversations")
    cid = F.col("conv_id").cast("string")
    seg = F.struct(F.lower("role").alias("speaker"), F.col("turn").cast("double").alias("startTime"), (F.col("turn") + F.when(F.col("turn") == 2, -1).otherwise(1)).cast("double").alias("endTime"), F.when(F.col("turn") == 1, " ").otherwise(F.col("text")).alias("text"))
    body = F.to_json(F.struct(
        F.when(F.col("conv_id") % 2 == 0, cid).alias("callId"), F.when(F.col("conv_id") % 2 == 1, cid).alias("call_id"),
        F.when(F.col("conv_id") % 5 != 0, F.lit("a1")).alias("agent_id"), F.lit("c1").alias("customerId"),
        (F.col("turn") - 1).cast("int").alias("duration"), F.when(F.col("turn") < 3, F.array(seg)).alias("segments"),
    ))
    return biz.parse_transcripts(t.select("conv_id", "turn", body.alias("body")), "body").drop("body")


@query("parse_transcripts", """SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS call_id, CASE WHEN conv_id % 5 <> 0 THEN 'a1' ELSE '' END AS agent_id, 'c1' AS customer_id, CAST(turn - 1 AS INTEGER) AS duration, 'en' AS language,
 CASE WHEN turn < 3 THEN 'UNKNOWN' END AS first_speaker FROM conversations""")
def parse_transcripts(lake):
    out = transcripts(lake)
    return out.select("conv_id", "turn", "call_id", "agent_id", "customer_id", "duration", "language", F.get(F.col("segments"), F.lit(0))["speaker"].alias("first_speaker"))


@query("validate_transcripts", """SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN conv_id % 5 = 0 THEN 'Missing agent_id' END, CASE WHEN turn >= 3 THEN 'No segments in transcript' END, CASE WHEN turn < 1 THEN 'Invalid duration' END,
 CASE WHEN turn = 1 THEN 'Empty text in segment' END, CASE WHEN turn = 2 THEN 'Invalid time range in segment' END], lambda x: x IS NOT NULL), '; ') AS errors FROM conversations""")
def validate_transcripts(lake):
    out = quality.with_errors(transcripts(lake), quality.transcript_rules())
    return out.select("conv_id", "turn", F.array_join("errors", "; ").alias("errors"))


# --- inventory --------------------------------------------------------------------


@query("inventory_totals", "SELECT CAST(sum(unit_price * quantity_in_stock) AS DOUBLE) AS total_value, count(*) FILTER (quantity_in_stock <= reorder_level) AS reorder_count, count(*) AS product_count FROM v_products WHERE is_active")
def inventory_totals(lake):
    return biz.inventory_totals(lake("v_products"))


@query("low_stock_report", "SELECT sku, count(*) AS products, CAST(sum(unit_price * reorder_quantity) AS DOUBLE) AS reorder_value FROM v_products WHERE is_active AND quantity_in_stock <= reorder_level GROUP BY ROLLUP (sku)")
def low_stock_report(lake):
    return biz.low_stock_report(lake("v_products"))


MOVES = "CAST(l_quantity AS INT) * CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END + CASE WHEN l_linenumber < 5 THEN 40 ELSE 0 END"


@query("apply_stock_moves", f"""WITH m AS (SELECT l_partkey AS sku, CAST(sum({MOVES}) AS BIGINT) AS change FROM lineitem GROUP BY 1), n AS (SELECT p.sku, quantity_in_stock + coalesce(change, 0) AS q FROM v_products p LEFT JOIN m USING (sku))
SELECT sku, q AS new_quantity, CASE WHEN q < 0 THEN 'REJECTED' WHEN q = 0 THEN 'OUT_OF_STOCK' ELSE 'ACTIVE' END AS status FROM n""")
def apply_stock_moves(lake):
    moves = lake("lineitem").select(F.col("l_partkey").alias("sku"), F.expr(MOVES).alias("quantity_change"))
    done, rejected = biz.apply_stock_moves(lake("v_products"), moves)
    return done.select("sku", "new_quantity", "status").unionByName(rejected.select("sku", "new_quantity", F.lit("REJECTED").alias("status")))


# --- banking ----------------------------------------------------------------------


# as text, so that all eight decimals are compared
BALANCE_SQL = """SELECT transaction_id, source_account, CAST(sum(CASE WHEN transaction_type = 'DEPOSIT' THEN amount ELSE -amount END) OVER (PARTITION BY source_account ORDER BY ts, transaction_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,8))::VARCHAR AS balance FROM v_bank_txn"""


@query("account_balances_hot", BALANCE_SQL)
def account_balances_hot(lake):
    """The same balances with every account cut into slices."""
    return biz.account_balances(lake("v_bank_txn"), floor=0).select("transaction_id", "source_account", F.col("balance").cast("string").alias("balance"))


@query("account_balances", BALANCE_SQL)
def account_balances(lake):
    return biz.account_balances(lake("v_bank_txn")).select("transaction_id", "source_account", F.col("balance").cast("string").alias("balance"))


@query("validate_bank_txn", """SELECT transaction_id, array_to_string(list_filter([CASE WHEN amount <= 0 THEN 'Amount must be positive' END,
 CASE WHEN NOT regexp_full_match(source_account, '[0-9]{10,12}') OR NOT coalesce(regexp_full_match(target_account, '[0-9]{10,12}'), TRUE) THEN 'Account number must be 10-12 digits' END,
 CASE WHEN transaction_type IN ('TRANSFER', 'PAYMENT') AND target_account IS NULL THEN 'Target account required for transfers and payments' END,
 CASE WHEN starts_with(source_account, '0000') THEN 'Invalid account' END], lambda x: x IS NOT NULL), '; ') AS errors FROM v_bank_txn""")
def validate_bank_txn(lake):
    out = quality.with_errors(lake("v_bank_txn"), quality.bank_rules())
    return out.select("transaction_id", F.array_join("errors", "; ").alias("errors"))


@query("quarantine_split", """SELECT transaction_id, CASE WHEN starts_with(source_account, '0000') OR (transaction_type IN ('TRANSFER', 'PAYMENT') AND target_account IS NULL) THEN 'QUARANTINED' ELSE 'VALID' END AS status,
 starts_with(source_account, '0000') OR (transaction_type IN ('TRANSFER', 'PAYMENT') AND target_account IS NULL) AS has_reason FROM v_bank_txn""")
def quarantine_split(lake):
    good, bad = quality.quarantine(lake("v_bank_txn"), quality.bank_rules(), "transaction_id")
    rows = good.select("transaction_id", F.lit("VALID").alias("status"), F.lit(False).alias("has_reason"))
    return rows.unionByName(bad.select("transaction_id", "status", (F.length("reason") > 0).alias("has_reason")))


@query("validate_tasks", """WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'DATA_PROCESSING' WHEN 1 THEN 'REPORT_GENERATION' WHEN 2 THEN 'NOTIFICATION_DISPATCH' ELSE '' END AS task_type,
 CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN concat('reportType channel ', props) ELSE props END AS payload, CASE WHEN event_id % 7 <> 0 THEN 'HIGH' END AS priority FROM events)
SELECT event_id, array_to_string(list_filter([CASE WHEN task_type = '' THEN 'Task type is required' END, CASE WHEN priority IS NULL THEN 'Task priority is required' END,
 CASE WHEN task_type = 'DATA_PROCESSING' AND payload IS NULL THEN 'DATA_PROCESSING tasks require a payload with data source information' END,
 CASE WHEN task_type = 'REPORT_GENERATION' AND NOT coalesce(contains(payload, 'reportType'), FALSE) THEN 'REPORT_GENERATION tasks require a payload with reportType' END,
 CASE WHEN task_type = 'NOTIFICATION_DISPATCH' AND NOT coalesce(contains(payload, 'channel'), FALSE) THEN 'NOTIFICATION_DISPATCH tasks require a payload with channel' END], lambda x: x IS NOT NULL), '; ') AS errors FROM t""")
def validate_tasks(lake):
    tasks = lake("events").select(
        "event_id", F.col("event_id").cast("string").alias("task_id"),
        F.expr("CASE event_id % 4 WHEN 0 THEN 'DATA_PROCESSING' WHEN 1 THEN 'REPORT_GENERATION' WHEN 2 THEN 'NOTIFICATION_DISPATCH' ELSE '' END").alias("task_type"),
        F.expr("CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN concat('reportType channel ', props) ELSE props END").alias("payload"),
        F.expr("CASE WHEN event_id % 7 <> 0 THEN 'HIGH' END").alias("priority"),
    )
    return quality.with_errors(tasks, quality.task_rules()).select("event_id", F.array_join("errors", "; ").alias("errors"))


@query("validate_gps", """SELECT seq, array_to_string(list_filter([CASE WHEN seq % 40 = 0 THEN 'Latitude out of range' END, CASE WHEN seq % 25 = 0 THEN 'Negative speed' END,
 CASE WHEN seq % 60 = 0 THEN 'Unknown engine status' END], lambda x: x IS NOT NULL), '; ') AS errors FROM v_gps""")
def validate_gps(lake):
    spoiled = lake("v_gps").withColumns({
        "latitude": F.when(F.col("seq") % 40 == 0, F.col("latitude") + 50).otherwise(F.col("latitude")),
        "speed_kmh": F.when(F.col("seq") % 25 == 0, F.lit(-1.0)).otherwise(F.col("speed_kmh")),
        "engine_status": F.when(F.col("seq") % 60 == 0, "broken").otherwise(F.col("engine_status")),
    })
    return quality.with_errors(spoiled, quality.gps_rules()).select("seq", F.array_join("errors", "; ").alias("errors"))


ACCEPT_SQL = """WITH RECURSIVE o AS (SELECT *, starts_with(source_account, '0000') AS failed, row_number() OVER (PARTITION BY idempotency_key ORDER BY ts, transaction_id) AS rn FROM v_bank_txn),
walk AS (SELECT idempotency_key, rn, transaction_id, TRUE AS accepted, ts AS last_ts, failed AS free FROM o WHERE rn = 1
 UNION ALL SELECT o.idempotency_key, o.rn, o.transaction_id, free OR o.ts > last_ts + INTERVAL 24 HOURS, CASE WHEN free OR o.ts > last_ts + INTERVAL 24 HOURS THEN o.ts ELSE last_ts END,
 CASE WHEN free OR o.ts > last_ts + INTERVAL 24 HOURS THEN o.failed ELSE free END FROM walk JOIN o ON o.idempotency_key = walk.idempotency_key AND o.rn = walk.rn + 1)
SELECT transaction_id, idempotency_key, accepted FROM walk"""


@query("idempotent_dedup", ACCEPT_SQL)
def idempotent_dedup(lake):
    rows = lake("v_bank_txn").select("transaction_id", "idempotency_key", "source_account", "ts")
    out = idempotency.accept_once(rows, "idempotency_key", "ts", "transaction_id", failed=F.col("source_account").startswith("0000"))
    return out.select("transaction_id", "idempotency_key", "accepted")


@query("idempotent_first", "SELECT idempotency_key, transaction_id FROM v_bank_txn QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY ts, transaction_id) = 1")
def idempotent_first(lake):
    rows = lake("v_bank_txn").select("idempotency_key", "ts", "transaction_id")
    return search.first_per_key(rows, ["idempotency_key"], ["ts", "transaction_id"]).drop("ts")


@query("popular_routes", "SELECT concat(l_suppkey % 10, '-', l_partkey % 10) AS route, count(*) AS trips FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def popular_routes(lake):
    trips = lake("lineitem").select((F.col("l_suppkey") % 10).alias("o"), (F.col("l_partkey") % 10).alias("d"))
    return biz.popular_routes(trips, "o", "d")


# --- audit ------------------------------------------------------------------------


@query("user_activity", """WITH k AS (SELECT user_id, event_name, strftime(ts, '%Y-%m-%d') AS day, split_part(resource, '/', 1) AS area FROM v_audit)
SELECT user_id, 'type' AS kind, event_name AS item, count(*) AS events FROM k GROUP BY ALL UNION ALL SELECT user_id, 'day', day, count(*) FROM k GROUP BY ALL UNION ALL SELECT user_id, 'resource', area, count(*) FROM k GROUP BY ALL""")
def user_activity(lake):
    return reports.user_activity(lake("v_audit"))


_COMP = "count(*) AS events, count(*) FILTER (audit_type IN ('PII_DETECTION', 'PII_TOKENIZATION')) AS pii_operations, round(count(*) FILTER (status = 'SUCCESS') * 100 / CAST(count(*) AS DOUBLE), 6) AS success_rate FROM v_audit"


@query("compliance_report", f"""SELECT 'total' AS kind, 'all' AS item, {_COMP} UNION ALL SELECT 'event_type', audit_type, {_COMP} GROUP BY audit_type
 UNION ALL SELECT 'status', status, {_COMP} GROUP BY status UNION ALL SELECT 'job', job_name, {_COMP} WHERE job_name IS NOT NULL GROUP BY job_name""")
def compliance_report(lake):
    return rounded(reports.compliance_report(lake("v_audit")), ["success_rate"])


@query("pii_access_log", "SELECT event_id, ts, audit_type, job_name, records_processed FROM v_audit WHERE audit_type IN ('PII_DETECTION', 'PII_TOKENIZATION') AND list_contains(columns_accessed, 'email')")
def pii_access_log(lake):
    return reports.pii_access_log(lake("v_audit"), "email").select("event_id", "ts", "audit_type", "job_name", "records_processed")


AUDIT_SQL = """SELECT event_id, tenant_id, user_id, ts, 'CONFIG_CHANGE' AS audit_kind, CASE WHEN error_code IS NULL THEN 'success' ELSE 'failure' END AS result,
 CASE event_name WHEN 'ConsoleLogin' THEN 'Authentication' WHEN 'CreateUser' THEN 'IAM' WHEN 'PutBucketPolicy' THEN 'S3' ELSE 'CloudTrail' END AS detail FROM v_audit WHERE event_name IN ('ConsoleLogin', 'DeleteTrail', 'StopLogging', 'CreateUser', 'PutBucketPolicy')
UNION ALL SELECT event_id, tenant_id, user_id, ts, 'SUSPICIOUS_ACTIVITY', 'denied', error_code FROM v_audit WHERE error_code IN ('AccessDenied', 'Client.UnauthorizedOperation')
UNION ALL SELECT event_id, tenant_id, user_id, ts, CASE WHEN login_result = 'Success' THEN 'LOGIN_SUCCESS' ELSE 'LOGIN_FAILURE' END, lower(login_result), 'login' FROM v_audit WHERE event_name = 'ConsoleLogin'"""


@query("classify_audit", AUDIT_SQL)
def classify_audit(lake):
    return biz.classify_audit(lake("v_audit"))


STATUS = "CAST(CASE event_id % 6 WHEN 0 THEN 403 WHEN 1 THEN 401 WHEN 2 THEN 500 ELSE 200 END AS INT)"


@query("api_access_events", f"""WITH a AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method, {STATUS} AS code FROM events)
SELECT event_id, CASE WHEN code = 403 THEN 'ACCESS_DENIED' WHEN code = 401 THEN 'LOGIN_FAILURE' WHEN method = 'GET' THEN 'DATA_READ' ELSE 'DATA_UPDATE' END AS audit_kind, CASE WHEN code = 200 THEN 'success' ELSE 'failure' END AS result FROM a""")
def api_access_events(lake):
    calls = lake("events").select("event_id", F.when(F.col("event_id") % 2 == 0, "GET").otherwise("POST").alias("method"), F.expr(STATUS).alias("status_code"))
    return biz.api_access_events(calls, "method", "status_code").select("event_id", "audit_kind", "result")


SOURCE = "CASE event_id % 5 WHEN 0 THEN 'enterprise-api' WHEN 1 THEN 'aws.s3' WHEN 2 THEN 'aws.cloudtrail' WHEN 3 THEN 'partner-service' ELSE 'unknown-app' END"
DETAIL = "CASE event_id % 3 WHEN 0 THEN 'TenantCreated' WHEN 1 THEN 'Object Created' ELSE 'SyncRequest' END"
ROUTE_SQL = f"""WITH e AS (SELECT event_id, {SOURCE} AS source, {DETAIL} AS detail_type FROM events)
SELECT event_id, source, detail_type, CASE WHEN source = 'enterprise-api' AND detail_type = 'TenantCreated' THEN 'tenant_created' WHEN source = 'aws.s3' AND detail_type = 'Object Created' THEN 's3'
 WHEN source = 'aws.cloudtrail' THEN 'cloudtrail' WHEN source = 'partner-service' AND detail_type = 'SyncRequest' THEN 'partner_sync' ELSE 'ignored' END AS handler FROM e"""


@query("route_events", ROUTE_SQL)
def route_events(lake):
    return biz.route_events(lake("events").select("event_id", F.expr(SOURCE).alias("source"), F.expr(DETAIL).alias("detail_type")))


@query("access_audit", """SELECT concat('user', o_custkey) AS principal, concat('t', o_orderkey % 5) AS table_name, bool_or(o_orderkey % 3 <> 0) AS has_access, bool_or(o_orderkey % 4 = 0) AS column_level_security,
 bool_or(o_orderkey % 6 = 0) AS row_level_security, bool_or(o_orderkey % 3 <> 0) AND (bool_or(o_orderkey % 4 = 0) OR bool_or(o_orderkey % 6 = 0)) AS compliant FROM orders GROUP BY ALL""")
def access_audit(lake):
    k = F.col("o_orderkey")
    grants = lake("orders").select(
        F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("principal"), F.concat(F.lit("t"), (k % 5).cast("string")).alias("table_name"),
        F.when(k % 3 != 0, F.array(F.lit("SELECT"), F.lit("DESCRIBE"))).otherwise(F.array(F.lit("DESCRIBE"))).alias("permissions"),
        F.when(k % 4 == 0, F.array(F.lit("image_id"))).alias("column_names"), F.when(k % 6 == 0, F.lit("facility_id = 1")).alias("row_filter"),
    )
    return reports.access_audit(grants)


# --- monitoring -------------------------------------------------------------------

VARIANT_SQL = """vm AS (SELECT variant_name, count(*) AS invocation_count, count(*) FILTER (status_code BETWEEN 400 AND 499) AS errors_4xx, count(*) FILTER (status_code >= 500) AS errors_5xx,
 quantile_cont(model_latency_us, 0.5) / 1000 AS latency_p50_ms, quantile_cont(model_latency_us, 0.9) / 1000 AS latency_p90_ms, quantile_cont(model_latency_us, 0.99) / 1000 AS latency_p99_ms,
 least(count(*) FILTER (status_code >= 400) / CAST(count(*) AS DOUBLE), 1.0) AS error_rate FROM v_invocations GROUP BY variant_name)"""
VM_ROUNDED = ["latency_p50_ms", "latency_p90_ms", "latency_p99_ms", "error_rate"]


@query("variant_metrics", f"WITH {VARIANT_SQL} SELECT * REPLACE ({', '.join(f'round({n}, 6) AS {n}' for n in VM_ROUNDED)}) FROM vm")
def variant_metrics(lake):
    return rounded(monitoring.variant_metrics(lake("v_invocations"), ["variant_name"]), VM_ROUNDED)


MEANS = ("overhead_latency_ms", "cpu_utilization", "memory_utilization", "disk_utilization")


@query("variant_resources", f"""WITH {VARIANT_SQL}, u AS (SELECT variant_name, coalesce(avg(overhead_latency_us) / 1000, 0.0) AS overhead_latency_ms, coalesce(avg(cpu_utilization), 0.0) AS cpu_utilization,
 coalesce(avg(memory_utilization), 0.0) AS memory_utilization, coalesce(avg(disk_utilization), 0.0) AS disk_utilization FROM v_invocations GROUP BY variant_name)
SELECT vm.* REPLACE ({', '.join(f'round({n}, 6) AS {n}' for n in VM_ROUNDED)}), {', '.join(f'round({n}, 6) AS {n}' for n in MEANS)} FROM vm JOIN u USING (variant_name)""")
def variant_resources(lake):
    """All measures of a variant, with the means of its overhead and of what it uses."""
    out = monitoring.variant_metrics(lake("v_invocations"), ["variant_name"], overhead="overhead_latency_us", utilization=MEANS[1:])
    return rounded(out, [*VM_ROUNDED, *MEANS])


@query("variant_metrics_daily", f"""SELECT variant_name, CAST(ts AS DATE) AS day, count(*) AS invocation_count, round(quantile_cont(model_latency_us, 0.5) / 1000, 6) AS latency_p50_ms, round(quantile_cont(model_latency_us, 0.99) / 1000, 6) AS latency_p99_ms FROM v_invocations GROUP BY ALL""")
def variant_metrics_daily(lake):
    daily = lake("v_invocations").withColumn("day", F.to_date("ts"))
    out = monitoring.variant_metrics(daily, ["variant_name", "day"])
    return rounded(out.select("variant_name", "day", "invocation_count", "latency_p50_ms", "latency_p99_ms"), VM_ROUNDED)


@query("canary_health", f"""WITH {VARIANT_SQL}, x AS (SELECT max(latency_p99_ms) FILTER (variant_name = 'canary') AS cl, max(error_rate) FILTER (variant_name = 'canary') AS ce, max(latency_p99_ms) FILTER (variant_name = 'production') AS pl,
 max(error_rate) FILTER (variant_name = 'production') AS pe, max(invocation_count) FILTER (variant_name = 'production') AS pn FROM vm),
r AS (SELECT array_to_string(list_filter([CASE WHEN cl > 100 THEN concat('P99 latency ', printf('%.1f', cl), 'ms exceeds threshold 100.0ms') END, CASE WHEN ce > 0.05 THEN concat('Error rate ', printf('%.2f', ce * 100), '% exceeds threshold 5.00%') END,
 CASE WHEN pn > 100 AND cl / greatest(pl, 1) > 2.0 THEN concat('Canary latency is ', printf('%.1f', cl / greatest(pl, 1)), 'x worse than production') END, CASE WHEN pn > 100 AND ce - pe > 0.05 THEN concat('Canary error rate is ', printf('%.2f', (ce - pe) * 100), '% higher than production') END], lambda x: x IS NOT NULL), '; ') AS reason FROM x)
SELECT reason <> '' AS canary_unhealthy, CASE WHEN reason = '' THEN 'Healthy' ELSE reason END AS reason FROM r""")
def canary_health(lake):
    return monitoring.canary_health(monitoring.variant_metrics(lake("v_invocations"), ["variant_name"]), latency_ms=100.0, error_rate=0.05)


@query("log_metric_alarms", "SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS period_start, count(*) FILTER (error_code IN ('AccessDenied', 'UnauthorizedAccess')) AS metric_value, count(*) FILTER (error_code IN ('AccessDenied', 'UnauthorizedAccess')) > 0 AS alarm FROM v_audit GROUP BY 1")
def log_metric_alarms(lake):
    return reports.log_metric(lake("v_audit"), F.col("error_code").isin("AccessDenied", "UnauthorizedAccess"))


@query("daily_usage", "SELECT CAST(ts AS DATE) AS day, count(*) AS invocations, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1")
def daily_usage(lake):
    return reports.daily_usage(lake("events"), F.col("event_type") == "error")


@query("query_costs", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * 100000.0 / 1073741824.0, 6) AS data_scanned_gb, round(l_extendedprice * 100000.0 / 1099511627776.0 * 5.0, 8) AS estimated_cost_usd FROM lineitem")
def query_costs(lake):
    log = lake("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 100000.0).alias("data_scanned_bytes"))
    out = reports.query_costs(log).drop("data_scanned_bytes")
    return rounded(rounded(out, ["data_scanned_gb"]), ["estimated_cost_usd"], 8)


@query("processing_cost", "SELECT doc_id, round(ceil(n_chars / 3000.0) * 0.0015, 6) AS textract_cost, round(ceil(n_chars / 100.0) * 0.0001, 6) AS comprehend_cost, round(ceil(n_chars / 3000.0) * 0.0015 + ceil(n_chars / 100.0) * 0.0001, 6) AS total_cost FROM documents")
def processing_cost(lake):
    n = F.col("n_chars")
    units = {"textract": F.ceil(n / 3000.0).cast("double"), "comprehend": F.ceil(n / 100.0).cast("double")}
    out = reports.processing_cost(lake("documents").select("doc_id", "n_chars"), units).drop("n_chars")
    return rounded(out, ["textract_cost", "comprehend_cost", "total_cost"])


@query("normalize_weights", "SELECT l_orderkey, l_linenumber, round(l_quantity / CAST(sum(l_quantity) OVER (PARTITION BY l_orderkey) AS DOUBLE), 6) AS normalized FROM lineitem")
def normalize_weights(lake):
    out = reports.normalize_weights(lake("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_quantity")
    return rounded(out.drop("l_quantity"), ["normalized"])


@query("confusion_matrix", """WITH p AS (SELECT doc_id, quality AS actual, CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END AS predicted FROM documents JOIN labels USING (doc_id)),
k AS (SELECT count(*) FILTER (actual = 1 AND predicted = 1) AS tp, count(*) FILTER (actual = 0 AND predicted = 1) AS fp, count(*) FILTER (actual = 0 AND predicted = 0) AS tn, count(*) FILTER (actual = 1 AND predicted = 0) AS fn FROM p)
SELECT tp, fp, tn, fn, round((tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE), 6) AS accuracy, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall, round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1 FROM k""")
def confusion_matrix(lake):
    docs = lake("documents").select("doc_id", F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("predicted"))
    both = docs.join(lake("labels").select("doc_id", F.col("quality").alias("actual")), "doc_id")
    return rounded(monitoring.confusion_matrix(both, "actual", "predicted"), ["accuracy", "precision", "recall", "f1"])


def scored_rows(lake):
    """Transactions with a given label and a given score."""
    return lake("v_txn").selectExpr(
        "transaction_id", "account_id", "channel", "CASE WHEN amount > 60 OR transaction_id % 11 = 0 THEN 1 ELSE 0 END AS is_fraud",
        "CAST(round((transaction_id * 7919 + CASE WHEN amount > 60 THEN 3000 ELSE 0 END) % 10007 / 100.0, 0) AS DOUBLE) AS score",
    )


RANKED_SQL = """s AS (SELECT transaction_id, account_id, channel, CASE WHEN amount > 60 OR transaction_id % 11 = 0 THEN 1 ELSE 0 END AS is_fraud, round(((transaction_id * 7919 + CASE WHEN amount > 60 THEN 3000 ELSE 0 END) % 10007) / 100.0, 0) AS score FROM v_txn),
c AS (SELECT {keys} score, sum(is_fraud) AS p, sum(1 - is_fraud) AS n FROM s GROUP BY ALL),
r AS (SELECT *, sum(p) OVER (PARTITION BY {part} ORDER BY score DESC) AS tp, sum(n) OVER (PARTITION BY {part} ORDER BY score DESC) AS fp, sum(n) OVER (PARTITION BY {part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below, sum(p) OVER (PARTITION BY {part}) AS tot_p, sum(n) OVER (PARTITION BY {part}) AS tot_n FROM c)"""


@query("fraud_auc", f"""WITH {RANKED_SQL.format(keys="channel,", part="channel")} SELECT channel, CAST(max(tot_p) AS BIGINT) AS positives, CAST(max(tot_n) AS BIGINT) AS negatives,
 round(sum(p * (coalesce(below, 0) + n / 2.0)) / (max(tot_p) * max(tot_n)), 6) AS auc_roc, round(sum(p * tp / (tp + fp)) / max(tot_p), 6) AS average_precision FROM r GROUP BY channel""")
def fraud_auc(lake):
    return rounded(scores.auc(scored_rows(lake), "is_fraud", "score", ["channel"]), ["auc_roc", "average_precision"])


@query("pr_curve", f"""WITH {RANKED_SQL.format(keys="", part="1")} SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / (tp + fp), 6) AS precision, round(tp / tot_p, 6) AS recall, round(fp / tot_n, 6) AS fpr FROM r""")
def pr_curve(lake):
    return rounded(scores.pr_curve(scored_rows(lake), "is_fraud", "score"), ["precision", "recall", "fpr"])


CLASSED = "CASE WHEN doc_id % 6 = 0 THEN 'en' WHEN doc_id % 17 = 0 THEN 'xx' ELSE lang END"


@query("class_report", f"""WITH d AS (SELECT lang AS a, {CLASSED} AS p FROM documents), k AS (SELECT a AS label, count(*) AS support, count(*) FILTER (a = p) AS tp FROM d GROUP BY 1), g AS (SELECT p AS label, count(*) AS predicted FROM d GROUP BY 1),
e AS (SELECT coalesce(k.label, g.label) AS label, coalesce(tp, 0) / CAST(nullif(coalesce(predicted, 0), 0) AS DOUBLE) AS precision, coalesce(tp, 0) / CAST(nullif(coalesce(support, 0), 0) AS DOUBLE) AS recall, 2 * coalesce(tp, 0) / CAST(coalesce(support, 0) + coalesce(predicted, 0) AS DOUBLE) AS f1, coalesce(support, 0) AS support FROM k FULL JOIN g ON k.label = g.label)
SELECT label, round(coalesce(precision, 0), 6) AS precision, round(coalesce(recall, 0), 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM e
UNION ALL SELECT NULL, round(sum(coalesce(precision, 0) * support) / sum(support), 6), round(sum(coalesce(recall, 0) * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM e""")
def class_report(lake):
    rows = lake("documents").selectExpr("lang", f"{CLASSED} AS predicted")
    return rounded(scores.class_report(rows, "lang", "predicted"), ["precision", "recall", "f1"])


@query("rmse_by_split", """WITH s AS (SELECT CASE WHEN event_id % 10 < 8 THEN 'train' ELSE 'validation' END AS split, completion_rate AS t, CAST((event_id * 7919) % 1001 AS DOUBLE) / 1000.0 AS p FROM v_views)
SELECT split, count(*) AS rows, round(sqrt(avg((p - t) * (p - t))), 6) AS rmse, round(avg(abs(p - t)), 6) AS mae, round(avg(p - t), 6) AS bias, round(1 - sum((p - t) * (p - t)) / (var_pop(t) * count(*)), 6) AS r2 FROM s GROUP BY split""")
def rmse_by_split(lake):
    rows = lake("v_views").selectExpr("CASE WHEN event_id % 10 < 8 THEN 'train' ELSE 'validation' END AS split", "completion_rate", "CAST((event_id * 7919) % 1001 AS DOUBLE) / 1000.0 AS pred")
    return rounded(scores.errors_by(rows, "completion_rate", "pred", ["split"]), ["rmse", "mae", "bias", "r2"])


BATCH_WEIGHTS = {"amount": 0.03, "tx": -0.5, "night": 0.8}


@query("batch_predict", """SELECT transaction_id, round(1 / (1 + exp(-(-1.5 + 0.03 * coalesce(amount, 0.0) - 0.5 * (transaction_id % 4) + 0.8 * CASE WHEN hour(ts) >= 22 OR hour(ts) <= 5 THEN 1 ELSE 0 END))), 6) AS score FROM v_txn""")
def batch_predict(lake):
    """Scores of a model that Spark does not know, given as a Python function over numpy batches."""
    rows = lake("v_txn").selectExpr("transaction_id", "amount", "transaction_id % 4 AS tx", "CASE WHEN hour(ts) >= 22 OR hour(ts) <= 5 THEN 1 ELSE 0 END AS night")
    weights = list(BATCH_WEIGHTS.values())

    def load():
        def predict(inputs):
            return 1 / (1 + np.exp(-(inputs @ np.array(weights) - 1.5)))

        return predict

    out = models.batch_predict(rows, list(BATCH_WEIGHTS), load, "score")
    return rounded(out.select("transaction_id", "score"), ["score"])


PROFILED_TABLES = {
    "supplier": ("s_suppkey", "s_acctbal", "s_name"), "orders": ("o_orderkey", "o_totalprice", "o_orderstatus"),
    "events": ("event_id", "value", "event_type", "props"), "labels": ("doc_id", "quality", "toxic"), "documents": ("doc_id", "text", "lang", "n_chars"),
}
PII_SQL = {k: privacy.PII_PATTERNS[k] for k in ("EMAIL", "IP_ADDRESS")}


def _profile_sql(table: str, column: str, kind: str) -> str:
    x = f"CAST({column} AS DOUBLE)" if kind == "n" else f"CAST(length({column}) AS DOUBLE)"
    hits = ", ".join(f"count(*) FILTER (regexp_matches({column}, '{p}')) AS {k.lower()}" for k, p in PII_SQL.items()) if kind == "s" else ", ".join(f"CAST(NULL AS BIGINT) AS {k.lower()}" for k in PII_SQL)
    spread = f"round(stddev_samp({x}), 4)" if kind == "n" else "CAST(NULL AS DOUBLE)"
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS rows, count(*) - count({column}) AS missing, min({x}) AS low, max({x}) AS high, round(avg({x}), 4) AS mean, {spread} AS deviation, {hits} FROM {table}"


TEXTS = {"s_name", "o_orderstatus", "event_type", "props", "text", "lang"}


@query("profile_columns", " UNION ALL ".join(_profile_sql(t, n, "s" if n in TEXTS else "n") for t, names in PROFILED_TABLES.items() for n in names))
def profile_columns(lake):
    """The exact part of the column profiles of several tables; ``profile_sketches`` has the sketched part."""
    parts = [
        scores.profile_columns(lake(t).select(*names), PII_SQL).select(
            F.lit(t).alias("table_name"), "column_name", "rows", "missing", "low", "high", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"),
            *[F.col("personal")[k].alias(k.lower()) for k in PII_SQL],
        )
        for t, names in PROFILED_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("profile_sketches")
def profile_sketches(lake):
    """Distinct counts and quantiles of every column, from sketches."""
    parts = [scores.profile_columns(lake(t).select(*names), {}).select(F.lit(t).alias("table_name"), "column_name", "distinct_about", "quantiles") for t, names in PROFILED_TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query("profile_correlations", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS rows, round(corr({a}, {b}), 6) AS correlation FROM lineitem" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]))
def profile_correlations(lake):
    return rounded(scores.correlations(lake("lineitem"), NUMBERS), ["correlation"])


@query("duplicate_rows", "WITH g AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM g")
def duplicate_rows(lake):
    return scores.duplicate_rows(lake("events"), ["user_id", "event_type"])


@query("users_by_range")
def users_by_range(lake):
    """Distinct users of any range of days from the stored daily sketches."""
    kept = materialize(scores.daily_sketches(lake("events"), "user_id"), "daily-sketches")
    days = kept.select("day").distinct()
    ranges = days.select(F.dayofmonth("day").alias("range_id"), F.col("day").alias("first_day"), F.date_add("day", 6).alias("last_day"))
    return scores.distinct_in_ranges(kept, ranges)


@query("min_class_filter", "SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM documents GROUP BY source HAVING count(*) >= 50)")
def min_class_filter(lake):
    return monitoring.keep_large_classes(lake("documents").select("doc_id", "source"), "source", 50)


PROFILED = {"o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True, "o_orderdate": False, "o_orderpriority": False}
PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) AS rows, count(*) - count({n}) AS missing, count(DISTINCT {n}) AS distinct_values, "
    + (f"CAST(min({n}) AS DOUBLE) AS min_value, CAST(max({n}) AS DOUBLE) AS max_value, round(quantile_cont(CAST({n} AS DOUBLE), 0.5), 6) AS median" if number else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS median")
    + " FROM orders"
    for n, number in PROFILED.items()
)


@query("profile_table", PROFILE_SQL)
def profile_table(lake):
    return rounded(monitoring.profile(lake("orders")), ["median"])


@query("profile_outliers", """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b FROM orders)
SELECT round(a, 6) AS q1, round(b, 6) AS q3, count(*) FILTER (o_totalprice < a - 1.5 * (b - a) OR o_totalprice > b + 1.5 * (b - a)) AS outliers, (SELECT count(*) FROM orders) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)) AS duplicate_pairs,
 round(corr(o_custkey, o_totalprice), 6) AS correlation FROM orders, q GROUP BY a, b""")
def profile_outliers(lake):
    out = monitoring.outliers_and_duplicates(lake("orders"), "o_totalprice", ["o_custkey", "o_orderstatus"], "o_custkey")
    return rounded(out, ["q1", "q3", "correlation"])


# --- recommender ------------------------------------------------------------------

GENRE_SQL = """recent AS (SELECT * FROM v_views WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAYS AND ts < TIMESTAMP '2024-01-31'),
gt AS (SELECT user_id, genre, sum(watch_time) AS t FROM recent JOIN v_content USING (content_id) GROUP BY ALL),
sh AS (SELECT user_id, genre, CAST(t AS DOUBLE) / CAST(sum(t) OVER (PARTITION BY user_id) AS DOUBLE) AS share FROM gt),
en AS (SELECT user_id, -sum(share * ln(share)) AS genre_diversity FROM sh GROUP BY user_id)"""
USER_SQL = f"""{GENRE_SQL}, uf AS (SELECT user_id, CAST(sum(watch_time) AS DOUBLE) AS total_watch_time, count(*) AS num_sessions, CAST(sum(completion_rate) AS DOUBLE) / count(*) AS avg_completion_rate, count(DISTINCT content_id) AS num_unique_content,
 min(ts) AS first_activity, max(ts) AS last_activity FROM recent GROUP BY user_id)"""
AS_OF = "2024-01-31"


@query("user_features", f"""WITH {USER_SQL} SELECT user_id, round(total_watch_time, 6) AS total_watch_time, round(total_watch_time / num_sessions, 6) AS avg_watch_time, num_sessions, round(round(avg_completion_rate, 10), 6) AS avg_completion_rate, num_unique_content,
 first_activity, last_activity, date_sub('day', last_activity, TIMESTAMP '2024-01-31') AS recency_days, round(num_sessions / 30.0, 6) AS sessions_per_day, round(coalesce(genre_diversity, 0.0), 6) AS genre_diversity FROM uf LEFT JOIN en USING (user_id)""")
def user_features(lake):
    out = biz.user_features(lake("v_views"), lake("v_content"), AS_OF)
    return rounded(rounded(out, ["avg_completion_rate"], 10), ["total_watch_time", "avg_watch_time", "avg_completion_rate", "sessions_per_day", "genre_diversity"])


CONTENT_SQL = """pi AS (SELECT content_id, count(DISTINCT user_id) AS unique_viewers, CAST(sum(watch_time) AS DOUBLE) AS total_watch_time, CAST(sum(completion_rate) AS DOUBLE) / count(*) AS avg_completion_rate FROM v_views GROUP BY content_id),
cf AS (SELECT c.*, unique_viewers, total_watch_time, coalesce(avg_completion_rate, 0.5) AS avg_completion_rate, coalesce(unique_viewers / CAST((SELECT max(unique_viewers) FROM pi) AS DOUBLE), 0.0) AS popularity_score,
 CAST(date_diff('day', CAST(release_date AS DATE), DATE '2024-01-31') AS INTEGER) AS release_recency_days, CAST(dense_rank() OVER (ORDER BY genre) - 1 AS INTEGER) AS genre_encoded, CAST(dense_rank() OVER (ORDER BY rating) - 1 AS INTEGER) AS rating_encoded FROM v_content c LEFT JOIN pi USING (content_id))"""


@query("content_features", f"""WITH {CONTENT_SQL} SELECT content_id, genre_encoded, rating_encoded, duration_minutes, unique_viewers, round(total_watch_time, 6) AS total_watch_time, round(round(avg_completion_rate, 10), 6) AS avg_completion_rate, round(popularity_score, 6) AS popularity_score, release_recency_days FROM cf""")
def content_features(lake):
    out = biz.content_features(lake("v_content"), lake("v_views"), AS_OF).drop("genre", "rating", "release_date")
    return rounded(rounded(out, ["avg_completion_rate"], 10), ["total_watch_time", "avg_completion_rate", "popularity_score"])


@query("genre_one_hot", "SELECT content_id, g.genre AS name, CAST(coalesce(c.genre = g.genre, FALSE) AS INTEGER) AS flag FROM v_content c, (SELECT DISTINCT genre FROM v_content WHERE genre IS NOT NULL) g")
def genre_one_hot(lake):
    content = lake("v_content").select("content_id", "genre")
    wide = biz.one_hot(content, "genre").drop("genre")
    return wide.unpivot("content_id", [n for n in wide.columns if n != "content_id"], "name", "flag").withColumn("name", F.expr("substr(name, 7)"))


@query("interaction_features", f"""WITH {USER_SQL}, {CONTENT_SQL}
SELECT v.event_id, v.user_id, v.content_id, round(v.completion_rate, 6) AS completion_rate, round(u.total_watch_time, 6) AS total_watch_time, round(round(u.avg_completion_rate, 10), 6) AS avg_completion_rate_user, round(coalesce(en.genre_diversity, 0.0), 6) AS genre_diversity,
 date_sub('day', last_activity, TIMESTAMP '2024-01-31') AS recency_days, round(popularity_score, 6) AS popularity_score, duration_minutes, genre_encoded, rating_encoded, round(coalesce(share, 0.0), 6) AS user_genre_affinity
FROM v_views v LEFT JOIN uf u ON u.user_id = v.user_id LEFT JOIN en ON en.user_id = v.user_id LEFT JOIN cf ON cf.content_id = v.content_id LEFT JOIN sh ON sh.user_id = v.user_id AND sh.genre = cf.genre""")
def interaction_features(lake):
    out = interactions(lake)
    return rounded(rounded(out, ["avg_completion_rate_user"], 10), ["completion_rate", "total_watch_time", "avg_completion_rate_user", "genre_diversity", "popularity_score", "user_genre_affinity"])


def interactions(lake):
    views, content = lake("v_views"), lake("v_content")
    users = biz.user_features(views, content, AS_OF)
    recent = views.filter((F.col("ts") >= F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")) & (F.col("ts") < F.expr("TIMESTAMP_NTZ'2024-01-31 00:00:00'")))
    features = biz.content_features(content, views, AS_OF)
    out = biz.interaction_features(views.select("event_id", "user_id", "content_id", "completion_rate"), users, features, biz.genre_shares(recent, content))
    return out.drop("genre")


@query("ndcg_at_10", """WITH s AS (SELECT event_id, user_id, completion_rate AS truth, CAST((event_id * 7919) % 1001 AS DOUBLE) / 1000.0 AS pred FROM v_views),
d AS (SELECT user_id, truth, row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, event_id) AS r, row_number() OVER (PARTITION BY user_id ORDER BY truth DESC, event_id) AS i FROM s)
SELECT user_id, round(sum(truth / log2(r + 1)) FILTER (r <= 10) / sum(truth / log2(i + 1)) FILTER (i <= 10), 6) AS ndcg FROM d GROUP BY user_id""")
def ndcg_at_10(lake):
    scored = lake("v_views").select("event_id", "user_id", "completion_rate", F.expr("CAST((event_id * 7919) % 1001 AS DOUBLE) / 1000.0").alias("pred"))
    return rounded(biz.ndcg_at_k(scored, "completion_rate", "pred", "event_id", 10, ["user_id"]), ["ndcg"])
