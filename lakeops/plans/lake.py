"""Lake event, imaging and search queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import exprs
from lakeops.operators import quality, reports, search
from lakeops.plans.fraud import rounded
from lakeops.registry import query


@query("events_by_type", "SELECT event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users FROM v_events_lake WHERE strftime(ts, '%Y-%m') = '2024-01' GROUP BY event_type")
def events_by_type(lake):
    return reports.events_by_type(lake("v_events_lake"), "2024-01")


@query("daily_active_users", "SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS dau FROM v_events_lake GROUP BY 1")
def daily_active_users(lake):
    return reports.daily_active_users(lake("v_events_lake"))


@query(
    "user_sessions",
    """SELECT user_id, session_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count,
 date_sub('minute', min(ts), max(ts)) AS session_duration_minutes FROM v_events_lake WHERE session_id IS NOT NULL
 GROUP BY user_id, session_id ORDER BY session_start DESC, user_id NULLS LAST, session_id LIMIT 100""",
)
def user_sessions(lake):
    return reports.user_sessions(lake("v_events_lake"))


@query(
    "geo_distribution",
    """SELECT geo_country AS country, geo_city AS city, count(*) AS event_count, count(DISTINCT user_id) AS unique_users FROM v_events_lake
 WHERE geo_country IS NOT NULL GROUP BY ALL ORDER BY event_count DESC, country, city LIMIT 50""",
)
def geo_distribution(lake):
    geo = F.struct(F.col("geo_country").alias("country"), F.col("geo_city").alias("city"))
    return reports.geo_distribution(lake("v_events_lake").withColumn("geo", geo))


@query("hourly_trends", "SELECT strftime(ts, '%H') AS hour, event_type, count(*) AS event_count FROM v_events_lake GROUP BY ALL")
def hourly_trends(lake):
    return reports.hourly_trends(lake("v_events_lake"))


@query(
    "avg_property_by_type",
    """SELECT event_type, count(*) AS event_count, round(avg(CAST(json_extract(props, '$.k') AS DOUBLE)), 6) AS avg_property FROM events
 GROUP BY event_type ORDER BY event_count DESC, event_type LIMIT 10""",
)
def avg_property_by_type(lake):
    return rounded(reports.avg_property_by_type(lake("events"), "$.k"), ["avg_property"])


@query("approx_users")
def approx_users(lake):
    return reports.approx_users(lake("v_events_lake"))


@query(
    "data_quality_check",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS total_records, count(*) FILTER (event_id IS NULL) AS null_event_ids, count(*) FILTER (user_id IS NULL) AS null_user_ids,
 count(*) FILTER (ts IS NULL) AS null_timestamps, count(DISTINCT event_type) AS unique_event_types FROM v_events_lake GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
)
def data_quality_check(lake):
    return reports.data_quality_check(lake("v_events_lake"))


@query("imaging_by_modality", "SELECT modality, body_part, count(*) AS image_count, count(DISTINCT patient_id) AS patient_count FROM v_imaging WHERE month(acquisition_date) = 3 AND year(acquisition_date) = 2024 GROUP BY ALL")
def imaging_by_modality(lake):
    return reports.imaging_by_modality(lake("v_imaging"), 2024, 3)


@query(
    "imaging_statistics",
    """SELECT modality, body_part, count(*) AS image_count, count(DISTINCT patient_id) AS patient_count, round(sum(file_size_bytes) / 1073741824.0, 6) AS total_gb,
 min(acquisition_date) AS earliest_date, max(acquisition_date) AS latest_date FROM v_imaging GROUP BY ALL""",
)
def imaging_statistics(lake):
    return rounded(reports.imaging_statistics(lake("v_imaging")), ["total_gb"])


@query(
    "load_statistics",
    """SELECT modality, CAST(grouping(modality) AS INTEGER) AS is_total, count(*) AS total_records, count(DISTINCT facility_id) AS facility_count,
 round(sum(file_size_bytes) / 1073741824.0, 6) AS total_size_gb, round(avg(file_size_bytes) / 1048576.0, 5) AS avg_size_mb FROM v_imaging GROUP BY GROUPING SETS ((), (modality))""",
)
def load_statistics(lake):
    out = rounded(reports.load_statistics(lake("v_imaging")), ["total_size_gb"])
    return rounded(out, ["avg_size_mb"], 5)


# --- projections ------------------------------------------------------------------


@query("partition_columns", "SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events")
def partition_columns(lake):
    return quality.partition_columns(lake("events")).select("event_id", "year", "month", "day", "hour")


@query("schema_mapping", "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS DATE) AS event_day, event_type AS kind, TRY_CAST(props AS INTEGER) AS bad_number FROM events")
def schema_mapping(lake):
    mapping = [("event_id", "event_id", "string"), ("ts", "event_day", "date"), ("event_type", "kind", "string"), ("props", "bad_number", "int"), ("absent", "absent", "string")]
    return quality.schema_mapping(lake("events"), mapping)


HOLLOW = "CASE WHEN event_id % 17 = 0 THEN NULL ELSE {} END"


@query(
    "lake_transform",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS timestamp, event_type,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y') END AS year, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%m') END AS month,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%d') END AS day, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%H') END AS hour
 FROM events WHERE event_id % 17 <> 0""",
)
def lake_transform(lake):
    raw = lake("events").select(
        F.expr(HOLLOW.format("CAST(event_id AS STRING)")).alias("event_id"),
        F.expr(HOLLOW.format("CASE WHEN event_id % 5 = 0 THEN 'not a time' ELSE CAST(ts AS STRING) END")).alias("timestamp"),
        F.expr(HOLLOW.format("event_type")).alias("event_type"),
    ).withColumn("timestamp", F.when(F.col("event_id").isNotNull(), F.col("timestamp")))
    return quality.lake_rows(raw, "timestamp")


OBJECT = """concat('images/facility=F', CAST(p_size % 5 AS VARCHAR(5)), CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('/modality=', p_type) END,
 '/year=2024/month=0', CAST(1 + p_size % 9 AS VARCHAR(3)), '/day=1', CAST(p_size % 10 AS VARCHAR(3)), '/S', CAST(p_partkey AS VARCHAR(12)), '_I', CAST(p_size AS VARCHAR(12)), '.dcm')"""


@query(
    "path_metadata",
    """SELECT p_partkey, concat('F', p_size % 5) AS facility_id, CASE WHEN p_partkey % 7 = 0 THEN 'OTHER' ELSE p_type END AS modality, '2024' AS year,
 concat('0', 1 + p_size % 9) AS month, concat('1', p_size % 10) AS day, concat('S', p_partkey) AS study_id, concat('I', p_size) AS image_id FROM part""",
)
def path_metadata(lake):
    return quality.path_metadata(lake("part").select("p_partkey", F.expr(OBJECT).alias("path")), "path").drop("path")


@query(
    "document_type",
    """WITH e AS (SELECT page_id, lower(regexp_extract(url, '\\.([A-Za-z0-9]+)$', 1)) AS ext FROM pages)
SELECT page_id, CASE WHEN ext = 'pdf' THEN 'pdf' WHEN ext IN ('jpg','jpeg','png','gif','bmp','tiff','webp') THEN 'image' WHEN ext IN ('mp3','wav','flac','ogg','m4a','wma','aac') THEN 'audio'
 WHEN ext IN ('txt','md','csv','json','xml','html') THEN 'text' ELSE 'unknown' END AS document_type FROM e""",
)
def document_type(lake):
    return lake("pages").select("page_id", quality.document_type("url").alias("document_type"))


@query(
    "imaging_clean",
    """WITH doubled AS (SELECT * FROM v_imaging UNION ALL SELECT * REPLACE (CASE WHEN image_id % 11 = 0 THEN NULL ELSE patient_id END AS patient_id, acquisition_date + 1 AS acquisition_date) FROM v_imaging WHERE image_id % 3 = 0),
one AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY acquisition_date DESC) AS rn FROM doubled WHERE patient_id IS NOT NULL)
SELECT image_id, patient_id, upper(modality) AS modality, body_part, CAST(acquisition_date AS DATE) AS acquisition_date, coalesce(array_to_string(condition_codes, ','), '') AS condition_codes FROM one WHERE rn = 1""",
)
def imaging_clean(lake):
    imaging = lake("v_imaging")
    again = imaging.filter("image_id % 3 = 0").withColumns(
        {"patient_id": F.when(F.col("image_id") % 11 != 0, F.col("patient_id")), "acquisition_date": F.date_add("acquisition_date", 1)}
    )
    out = quality.clean_imaging(imaging.unionByName(again), ["image_id", "study_id", "patient_id", "facility_id"], "image_id", ["acquisition_date", "image_id"])
    return out.select("image_id", "patient_id", "modality", "body_part", "acquisition_date", F.array_join("condition_codes", ",").alias("condition_codes"))


@query("flatten_struct", "SELECT event_id, user_id AS \"who.user_id\", event_type AS \"what.kind\", value AS \"what.inner.value\" FROM events")
def flatten_struct(lake):
    nested = lake("events").select(
        "event_id", F.struct("user_id").alias("who"),
        F.struct(F.col("event_type").alias("kind"), F.struct("value").alias("inner")).alias("what"),
    )
    return quality.flatten(nested)


@query("clean_text", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS cleaned FROM documents")
def clean_text(lake):
    return lake("documents").select("doc_id", exprs.clean_text("text").alias("cleaned"))


@query(
    "truncate_words",
    """SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE concat(CASE WHEN contains(left(text, 200), ' ') THEN regexp_replace(left(text, 200), ' [^ ]*$', '', 's') ELSE left(text, 200) END, '...') END AS short,
 CASE WHEN length(text) <= 50 THEN text ELSE concat(left(text, 47), '...') END AS label FROM documents""",
)
def truncate_words(lake):
    return lake("documents").select("doc_id", exprs.truncate_words("text", 200).alias("short"), exprs.truncate_chars("text", 50).alias("label"))


@query(
    "hash_ids",
    """SELECT page_id, left(sha256(url), 16) AS doc_hash, concat('msg-', page_id, '-task-', page_id + 1) AS key,
 rtrim(translate(base64(unhex(sha256(concat(url, '|', page_id)))), '+/', '-_'), '=') AS url_key FROM pages""",
)
def hash_ids(lake):
    pid = F.col("page_id")
    return lake("pages").select(
        "page_id", exprs.short_id("url").alias("doc_hash"),
        F.concat(F.lit("msg-"), pid.cast("string"), F.lit("-task-"), (pid + 1).cast("string")).alias("key"),
        exprs.hash_key("url", pid).alias("url_key"),
    )


@query("document_ids", "SELECT doc_id, left(sha256(concat('docs/', source, '/', doc_id)), 16) AS document_id FROM documents")
def document_ids(lake):
    uri = F.concat(F.lit("docs/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    return lake("documents").select("doc_id", exprs.short_id(uri).alias("document_id"))


# --- searches ---------------------------------------------------------------------


@query("search_predictions", """SELECT transaction_id, account_id, CAST((transaction_id * 7919) % 1001 AS DOUBLE) / CAST(1000 AS DOUBLE) AS fraud_score FROM v_txn
 WHERE (transaction_id * 7919) % 1001 >= 500 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' ORDER BY ts DESC, transaction_id LIMIT 100""")
def search_predictions(lake):
    from lakeops.plans.fraud import scored

    found = search.search(
        scored(lake), equals={"account_id": None}, at_least={"fraud_score": 0.5, "ts": "2024-01-05"}, below={"ts": "2024-01-20"},
        order=[F.desc("ts"), F.col("transaction_id")], limit=100,
    )
    return found.select("transaction_id", "account_id", "fraud_score")


@query("search_alerts", """WITH s AS (SELECT transaction_id, account_id, ts, CAST((transaction_id * 7919) % 1001 AS DOUBLE) / 1000.0 AS fraud_score FROM v_txn)
SELECT transaction_id, account_id, CASE WHEN fraud_score >= 0.9 THEN 'CRITICAL' ELSE 'HIGH' END AS severity FROM s WHERE fraud_score >= 0.8 AND transaction_id % 3 <> 0 ORDER BY ts DESC, transaction_id LIMIT 50""")
def search_alerts(lake):
    from lakeops.operators.fraud import _by_severity
    from lakeops.plans.fraud import scored

    alerts = scored(lake).withColumns({"severity": _by_severity(F.col("fraud_score"), 1), "acknowledged": F.col("transaction_id") % 3 == 0})
    found = search.search(
        alerts, equals={"acknowledged": False, "account_id": None}, one_of={"severity": ["CRITICAL", "HIGH"]},
        order=[F.desc("ts"), F.col("transaction_id")], limit=50,
    )
    return found.select("transaction_id", "account_id", "severity")


@query("search_calls", """WITH c AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)
SELECT call_id, agent_id, sentiment, call_date FROM v_calls JOIN c ON call_id = conv_id WHERE sentiment <> 'POSITIVE' AND call_date >= DATE '2024-01-05'
 AND list_has_any(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''), ['the', 'la']) ORDER BY call_date DESC, call_id LIMIT 20""")
def search_calls(lake):
    # a turn that matches makes its call match, so no text has to be assembled first
    matching = lake("conversations").filter(search.contains_any_word("text", "the la")).select(F.col("conv_id").alias("call_id")).distinct()
    calls = lake("v_calls").join(matching, "call_id", "left_semi")
    found = search.search(
        calls, one_of={"sentiment": ["NEGATIVE", "NEUTRAL", "MIXED"]}, at_least={"call_date": "2024-01-05"},
        order=[F.desc("call_date"), F.col("call_id")], limit=20,
    )
    return found.select("call_id", "agent_id", "sentiment", "call_date")


@query("search_products", "SELECT sku, name, category_id FROM v_products WHERE contains(lower(name), 'widget') AND is_active ORDER BY name, sku LIMIT 50")
def search_products(lake):
    found = search.search(
        lake("v_products"), equals={"is_active": True, "category_id": None}, where=search.contains_ignore_case("name", "Widget"),
        order=[F.col("name"), F.col("sku")], limit=50,
    )
    return found.select("sku", "name", "category_id")


@query("search_audit", """SELECT event_id, tenant_id, event_name, ts FROM v_audit WHERE tenant_id = 4 AND event_name IN ('DeleteTrail', 'StopLogging')
 AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-25' ORDER BY ts DESC, event_id LIMIT 100""")
def search_audit(lake):
    found = search.search(
        lake("v_audit"), equals={"tenant_id": 4}, one_of={"event_name": ["DeleteTrail", "StopLogging"]},
        at_least={"ts": "2024-01-03"}, below={"ts": "2024-01-25"}, order=[F.desc("ts"), F.col("event_id")], limit=100,
    )
    return found.select("event_id", "tenant_id", "event_name", "ts")


DEAL = "split(concat('c', CAST(o_custkey AS VARCHAR(12)), ',c', CAST(o_orderkey % 50 AS VARCHAR(12))), ',')"


@query("crm_search", f"SELECT o_orderkey, o_orderstatus AS stage FROM orders WHERE o_orderstatus = 'F' AND list_contains({DEAL}, 'c7')")
def crm_search(lake):
    deals = lake("orders").select("o_orderkey", F.col("o_orderstatus").alias("stage"), F.expr(DEAL).alias("contact_ids"))
    return search.search(deals, equals={"stage": "F"}, where=F.array_contains("contact_ids", "c7")).drop("contact_ids")


@query("availability_search", """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_suppkey = 3 AND l_quantity >= 10 AND l_returnflag = 'N'
 AND l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' ORDER BY l_shipdate, l_orderkey, l_linenumber""")
def availability_search(lake):
    found = search.search(
        lake("lineitem"), equals={"l_suppkey": 3, "l_returnflag": "N"}, at_least={"l_quantity": 10.0, "l_shipdate": "1998-01-01"},
        below={"l_shipdate": "1999-01-01"}, order=[F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")],
    )
    return found.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("imaging_by_condition", "SELECT image_id, study_id, modality, array_to_string(condition_codes, ',') AS condition_codes FROM v_imaging WHERE list_has_any(condition_codes, ['J18.9', 'E11.9']) AND body_part = 'CHEST' ORDER BY image_id LIMIT 1000")
def imaging_by_condition(lake):
    found = search.search(
        lake("v_imaging"), equals={"body_part": "CHEST", "modality": None}, where=search.has_any_code("condition_codes", ["J18.9", "E11.9"]),
        order=[F.col("image_id")], limit=1000,
    )
    return found.select("image_id", "study_id", "modality", F.array_join("condition_codes", ",").alias("condition_codes"))


@query("page_results", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1996-05-05', 100) ORDER BY o_orderdate, o_orderkey LIMIT 50")
def page_results(lake):
    page = search.next_page(lake("orders"), ["o_orderdate", "o_orderkey"], 50, after=["1996-05-05", 100])
    return page.select("o_orderkey", "o_orderdate", "o_totalprice")


# --- joins ------------------------------------------------------------------------


@query("imaging_with_clinical", """SELECT i.image_id, i.study_id, i.modality, i.body_part, c.diagnosis, c.age_at_study, c.sex FROM v_imaging i JOIN v_clinical c ON i.study_id = c.study_id
 WHERE list_has_any(c.condition_codes, ['J18.9']) AND i.facility_id = 2""")
def imaging_with_clinical(lake):
    images = search.search(lake("v_imaging"), equals={"facility_id": 2}).select("image_id", "study_id", "modality", "body_part")
    records = lake("v_clinical").filter(search.has_any_code("condition_codes", ["J18.9"])).select("study_id", "diagnosis", "age_at_study", "sex")
    return images.join(records, "study_id")


@query("upsert_latest", """WITH changes AS (SELECT o_custkey AS key, o_orderdate AS ts, o_orderkey AS seq, o_orderstatus AS state FROM orders),
stored AS (SELECT c_custkey AS key, TIMESTAMP '1997-06-01' AS ts, CAST(-1 AS BIGINT) AS seq, 'stored' AS state FROM customer),
u AS (SELECT * FROM stored UNION ALL SELECT * FROM changes)
SELECT key, ts, seq, state FROM u QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, seq DESC) = 1""")
def upsert_latest(lake):
    changes = lake("orders").select(F.col("o_custkey").alias("key"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("state"))
    stored = lake("customer").select(F.col("c_custkey").alias("key"), F.expr("TIMESTAMP_NTZ'1997-06-01 00:00:00'").alias("ts"), F.lit(-1).cast("bigint").alias("seq"), F.lit("stored").alias("state"))
    return search.upsert_latest(stored, changes, ["key"], ["ts", "seq"])


@query("split_by_key", """SELECT user_id, CASE WHEN CAST(concat('0x', left(sha256(concat('split', user_id)), 8)) AS BIGINT) / 4294967296.0 < 0.8 THEN 'train' ELSE 'validation' END AS split, count(*) AS rows FROM events GROUP BY ALL""")
def split_by_key(lake):
    return search.split_by_key(lake("events"), "user_id").groupBy("user_id", "split").agg(F.count(F.lit(1)).alias("rows"))


@query("top_by_stock", "SELECT sku, quantity_in_stock FROM v_products WHERE is_active AND quantity_in_stock > 0 ORDER BY quantity_in_stock DESC, sku LIMIT 10")
def top_by_stock(lake):
    found = search.search(lake("v_products"), equals={"is_active": True}, where=F.col("quantity_in_stock") > 0, order=[F.desc("quantity_in_stock"), F.col("sku")], limit=10)
    return found.select("sku", "quantity_in_stock")


@query("newest_per_tenant", "SELECT tenant_id, event_id, ts FROM v_audit QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY ts DESC, event_id) <= 5")
def newest_per_tenant(lake):
    return search.newest_per_group(lake("v_audit").select("tenant_id", "event_id", "ts"), ["tenant_id"], [F.desc("ts"), F.col("event_id")], 5)


@query("active_suppliers", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0 ORDER BY s_name, s_suppkey")
def active_suppliers(lake):
    return search.search(lake("supplier"), where=F.col("s_acctbal") > 0, order=[F.col("s_name"), F.col("s_suppkey")]).select("s_suppkey", "s_name")


@query("ml_cohort", """WITH l AS (SELECT image_id, modality, CASE WHEN list_has_any(condition_codes, ['J18.9']) THEN 'positive' ELSE 'negative' END AS label FROM v_imaging WHERE body_part = 'CHEST')
SELECT image_id, modality, label FROM l QUALIFY row_number() OVER (PARTITION BY label ORDER BY sha256(CAST(image_id AS VARCHAR)), image_id) <= 100""")
def ml_cohort(lake):
    images = lake("v_imaging").select("image_id", "modality", "body_part", "condition_codes")
    out = search.balanced_cohort(images, "image_id", "condition_codes", ["J18.9"], 100, where=F.col("body_part") == "CHEST")
    return out.select("image_id", "modality", "label")


@query("expired_rows", "SELECT o_orderkey, CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS ttl FROM orders WHERE epoch_us(o_orderdate) // 1000000 < epoch_us(TIMESTAMP '1997-01-01') // 1000000 - 86400")
def expired_rows(lake):
    rows = lake("orders").select("o_orderkey", exprs.epoch_seconds("o_orderdate").alias("ttl"))
    return search.expired(rows, "ttl", exprs.epoch_seconds(F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00'")))


@query("chunk_replace", """WITH fresh AS (SELECT doc_id, concat(doc_id, '_new') AS chunk_id FROM documents WHERE lang = 'en'), stored AS (SELECT doc_id, concat(doc_id, '_', lang) AS chunk_id FROM documents)
SELECT doc_id, chunk_id FROM fresh UNION ALL SELECT doc_id, chunk_id FROM stored WHERE doc_id NOT IN (SELECT doc_id FROM fresh)""")
def chunk_replace(lake):
    docs = lake("documents").select("doc_id", "lang")
    did = F.col("doc_id").cast("string")
    fresh = docs.filter(F.col("lang") == "en").select("doc_id", F.concat(did, F.lit("_new")).alias("chunk_id"))
    stored = docs.select("doc_id", F.concat(did, F.lit("_"), "lang").alias("chunk_id"))
    return search.replace_parts(stored, fresh, "doc_id")


@query("apply_enrichment", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN concat('p', o_orderkey % 9) ELSE o_orderpriority END AS priority, o_orderstatus AS status FROM orders""")
def apply_enrichment(lake):
    rows = lake("orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    results = lake("orders").filter("o_orderkey % 2 = 0").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("p"), (F.col("o_orderkey") % 9).cast("string"))).alias("priority"), F.lit(None).cast("string").alias("status")
    )
    from lakeops.operators.business import apply_enrichment as apply

    return apply(rows, results, "o_orderkey", ["priority", "status"])
