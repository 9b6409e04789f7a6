"""Privacy, binning, lookup and anomaly queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import fixed
from lakeops.functions.exprs import mask_all_but
from lakeops.operators import anomaly, binning, privacy, ranks, secure_etl
from lakeops.plans.fraud import MONEY, SECONDS, rounded
from lakeops.registry import query
from lakeops.session import fresh_dir

SECRET = "lakeops-demo-secret"
CARD = "concat(lpad(CAST(c_custkey % 10000 AS VARCHAR(8)), 4, '4'), '-', lpad(CAST(c_custkey % 7919 AS VARCHAR(8)), 4, '5'), '-1234-', lpad(CAST(c_nationkey AS VARCHAR(8)), 4, '0'))"


def _pads_sql(x: str) -> str:
    key = SECRET.encode().ljust(64, b"\0")
    inner = "".join(f"\\x{b ^ 0x36:02X}" for b in key)
    outer = "".join(f"\\x{b ^ 0x5C:02X}" for b in key)
    return f"sha256('{outer}'::BLOB || unhex(sha256('{inner}'::BLOB || encode({x}))))"


def people(lake):
    return lake("customer").select(
        "c_custkey", "c_name", F.expr(CARD).alias("card"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
    )


PEOPLE_SQL = f"people AS (SELECT c_custkey, c_name, {CARD} AS card, concat('user', c_custkey, '@example.com') AS email FROM customer)"
FP_SQL = (
    "concat(left(card, 4), array_to_string(list_transform(range(5, length(card) - 3), lambda i: CASE WHEN regexp_matches(card[i], '[\\p{L}\\p{N}]')"
    " THEN upper(h[length(regexp_replace(card[5:i-1], '[^\\p{L}\\p{N}]', '', 'g')) % 64 + 1]) ELSE card[i] END), ''), right(card, 4))"
)


@query("tokenize_deterministic", f"WITH {PEOPLE_SQL} SELECT c_custkey, left({_pads_sql('c_name')}, 16) AS token FROM people")
def tokenize_deterministic(lake):
    return people(lake).select("c_custkey", privacy.deterministic_token("c_name", SECRET).alias("token"))


@query(
    "tokenize_format_preserving",
    f"WITH {PEOPLE_SQL}, hashed AS (SELECT *, {_pads_sql('replace(card, chr(45), chr(0)[1:0])')} AS h FROM people) SELECT c_custkey, {FP_SQL} AS token FROM hashed",
)
def tokenize_format_preserving(lake):
    return people(lake).select("c_custkey", privacy.format_preserving_token("card", SECRET, 4, 4).alias("token"))


@query("tokenize_hash", f"WITH {PEOPLE_SQL} SELECT c_custkey, sha256(email) AS token FROM people")
def tokenize_hash(lake):
    return people(lake).select("c_custkey", privacy.hash_token("email").alias("token"))


@query("redact", f"WITH {PEOPLE_SQL} SELECT c_custkey, '***REDACTED***' AS email, concat(repeat('*', length(card) - 4), right(card, 4)) AS card FROM people")
def redact(lake):
    return people(lake).select("c_custkey", privacy.redact("email").alias("email"), mask_all_but("card").alias("card"))


@query("mask_sensitive", "SELECT c_custkey, concat(repeat('*', length(c_name) - 4), right(c_name, 4)) AS masked FROM customer")
def mask_sensitive(lake):
    return lake("customer").select("c_custkey", mask_all_but("c_name").alias("masked"))


@query(
    "tokenize_table",
    f"""WITH {PEOPLE_SQL}, hashed AS (SELECT *, {_pads_sql('replace(card, chr(45), chr(0)[1:0])')} AS h FROM people)
SELECT c_custkey, left({_pads_sql('c_name')}, 12) AS c_name, {FP_SQL} AS card, sha256(email) AS email FROM hashed""",
)
def tokenize_table(lake):
    config = {
        "c_name": {"method": "deterministic", "length": 12},
        "card": {"method": "format_preserving", "prefix": 4, "suffix": 4},
        "email": {"method": "hash"},
        "not_there": {"method": "redact"},
    }
    return privacy.tokenize_table(people(lake), SECRET, config)


def _pii_sql(kind: str) -> str:
    p = privacy.PII_PATTERNS[kind]
    return f"SELECT doc_id, '{kind}' AS entity_type, unnest(regexp_extract_all(text, '{p}')) AS matched FROM documents"


@query("detect_pii", " UNION ALL ".join(_pii_sql(k) for k in privacy.PII_PATTERNS))
def detect_pii(lake):
    return privacy.detect_pii(lake("documents"), "doc_id", "text")


def _mask_sql() -> str:
    out = "text"
    for kind, p in privacy.PII_PATTERNS.items():
        out = f"regexp_replace({out}, '{p}', '[{kind}]', 'g')"
    return out


@query("mask_pii", f"SELECT doc_id, {_mask_sql()} AS masked FROM documents")
def mask_pii(lake):
    return lake("documents").select("doc_id", privacy.mask_pii("text").alias("masked"))


@query("patient_id_roundtrip", "SELECT image_id, CAST(patient_id AS VARCHAR) AS patient_id, TRUE AS hidden FROM v_imaging")
def patient_id_roundtrip(lake):
    key = F.lit("0123456789abcdef")
    sealed = lake("v_imaging").withColumn("token", privacy.encrypt_id("patient_id", key, "facility_id"))
    return sealed.select(
        "image_id",
        privacy.decrypt_id("token", key, "facility_id").alias("patient_id"),
        (F.col("token") != F.col("patient_id").cast("string")).alias("hidden"),
    )


@query(
    "date_shift",
    """SELECT image_id, CAST(acquisition_date + CAST(CAST(concat('0x', left(sha256(CAST(patient_id AS VARCHAR)), 8)) AS BIGINT) % 731 - 365 AS INT) AS DATE) AS shifted FROM v_imaging""",
)
def date_shift(lake):
    return lake("v_imaging").select("image_id", privacy.shift_date("acquisition_date", "patient_id").alias("shifted"))


@query("researcher_view", "SELECT record_id, study_id, array_to_string(condition_codes, ',') AS condition_codes, facility_id, age_at_study, sex FROM v_clinical")
def researcher_view(lake):
    view = privacy.secure_view(lake("v_clinical"), exclude=fixed.PATIENT_COLUMNS)
    return view.withColumn("condition_codes", F.array_join("condition_codes", ","))


@query("facility_view", "SELECT image_id, study_id, patient_id, modality, body_part, facility_id FROM v_imaging WHERE facility_id = 2")
def facility_view(lake):
    view = privacy.secure_view(lake("v_imaging"), F.col("facility_id") == 2)
    return view.select("image_id", "study_id", "patient_id", "modality", "body_part", "facility_id")


@query("tenant_scope", "SELECT event_id, tenant_id, resource FROM v_audit WHERE tenant_id = 3")
def tenant_scope(lake):
    return privacy.tenant_scope(lake("v_audit"), 3).select("event_id", "tenant_id", "resource")


ROLES = "CASE WHEN user_id % 3 = 0 THEN split('admin,viewer', ',') WHEN user_id % 3 = 1 THEN split('editor', ',') ELSE split('viewer', ',') END"
# fixed values: permissions of the sample roles
GRANTS = [("admin", "read"), ("admin", "write"), ("admin", "manage"), ("editor", "read"), ("editor", "write"), ("viewer", "read")]


@query(
    "role_permissions",
    f"""WITH roles AS (SELECT DISTINCT user_id, unnest({ROLES}) AS role FROM events),
grants(role, permission) AS (VALUES {', '.join(str(g) for g in GRANTS)})
SELECT DISTINCT user_id, permission FROM roles JOIN grants USING (role)""",
)
def role_permissions(lake):
    users = lake("events").select("user_id", F.expr(ROLES).alias("roles"))
    grants = lake.spark.createDataFrame(GRANTS, "role string, permission string")
    return privacy.permissions_of(users, "user_id", "roles", grants)


# --- bins -------------------------------------------------------------------------


def bins_sql(fractions, labels, names=("transaction_id", "amount")):
    edges = ", ".join(f"quantile_cont(abs(amount), {f})" for f in fractions[1:-1])
    index = " + ".join(f"CASE WHEN abs(amount) >= e[{i + 1}] THEN 1 ELSE 0 END" for i in range(len(fractions) - 2))
    label = f"([{', '.join(repr(x) for x in labels)}])[idx + 1]" if labels else "idx"
    return f"""WITH edges AS (SELECT [{edges}] AS e FROM v_txn), binned AS (SELECT {', '.join(names)}, CAST({index} AS INTEGER) AS idx FROM v_txn, edges)
SELECT {', '.join(names)}, {label} AS amount_bin, idx AS amount_bin_encoded FROM binned"""


@query("amount_bins", bins_sql([p / 100 for p in fixed.AMOUNT_PERCENTILES], fixed.AMOUNT_LABELS))
def amount_bins(lake):
    out = binning.percentile_bins(lake("v_txn").select("transaction_id", "amount"), "amount")
    return out.select("transaction_id", "amount", "amount_bin", "amount_bin_encoded")


@query("quantile_bins", bins_sql([i / 8 for i in range(9)], None))
def quantile_bins(lake):
    out = binning.quantile_bins(lake("v_txn").select("transaction_id", "amount"), "amount", 8)
    return out.select("transaction_id", "amount", "amount_bin", "amount_bin_encoded")


@query(
    "custom_bins",
    """SELECT transaction_id, CASE WHEN amount < 20 THEN 'low' WHEN amount < 60 THEN 'mid' WHEN amount < 150 THEN 'high' ELSE 'bin_3' END AS amount_bin,
 CASE WHEN amount < 20 THEN 0 WHEN amount < 60 THEN 1 WHEN amount < 150 THEN 2 ELSE 3 END AS amount_bin_encoded FROM v_txn""",
)
def custom_bins(lake):
    out = binning.custom_bins(lake("v_txn").select("transaction_id", "amount"), "amount", [20.0, 60.0, 150.0], ["low", "mid", "high"])
    return out.select("transaction_id", "amount_bin", "amount_bin_encoded")


# --- lookups ----------------------------------------------------------------------

MCC = "CASE event_id % 9 WHEN 0 THEN '5411' WHEN 1 THEN '7995' WHEN 2 THEN '6011' WHEN 3 THEN '5812' WHEN 4 THEN '9999' WHEN 5 THEN NULL WHEN 6 THEN '4511' WHEN 7 THEN concat('x', CAST(user_id % 5 AS VARCHAR(3))) ELSE '5999' END"
CATEGORY_ROWS = ", ".join(str(r) for r in fixed.MERCHANT_CATEGORIES)
CATEGORY_CTE = f"cat(mcc, category, category_id, risk, score, parent, cash) AS (VALUES {CATEGORY_ROWS}), t AS (SELECT event_id, value, {MCC} AS mcc FROM events)"


def with_mcc(lake):
    return lake("events").select("event_id", "value", F.expr(MCC).alias("mcc_code"))


@query(
    "merchant_encoding",
    f"""WITH {CATEGORY_CTE} SELECT event_id, coalesce(category, 'unknown') AS merchant_category, coalesce(category_id, 999) AS merchant_category_id,
 coalesce(risk, 'high') AS merchant_risk_level, CAST(coalesce(score, 0.8) AS DOUBLE) AS merchant_risk_score, coalesce(parent, 'uncategorized') AS merchant_parent_category,
 coalesce(cash, FALSE) AS is_cash_equivalent, CASE coalesce(risk, 'high') WHEN 'low' THEN 0 WHEN 'medium' THEN 1 WHEN 'critical' THEN 3 ELSE 2 END AS merchant_risk_encoded
FROM t LEFT JOIN cat USING (mcc)""",
)
def merchant_encoding(lake):
    return binning.encode_merchants(with_mcc(lake), "mcc_code", binning.merchant_categories(lake.spark)).drop("value", "mcc_code")


@query("unknown_keys", f"WITH {CATEGORY_CTE} SELECT t.mcc AS mcc_code, count(*) AS n FROM t WHERE NOT EXISTS (SELECT 1 FROM cat WHERE cat.mcc = t.mcc) GROUP BY t.mcc")
def unknown_keys(lake):
    return binning.unknown_keys(with_mcc(lake), "mcc_code", binning.merchant_categories(lake.spark), "mcc")


# --- anomaly ----------------------------------------------------------------------

SEQUENCE_SQL = f"""seqf AS (
 SELECT *, row_number() OVER seq AS transaction_sequence, coalesce(({SECONDS} - lag({SECONDS}) OVER seq) / 3600.0, 0.0) AS time_since_last_txn,
  CAST(sum({MONEY}) OVER prior AS DOUBLE) / nullif(count(*) OVER prior, 0) AS mean
 FROM v_txn WINDOW seq AS (PARTITION BY account_id ORDER BY ts, transaction_id),
  prior AS (PARTITION BY account_id ORDER BY ts, transaction_id ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING)
)"""


@query(
    "txn_sequence_features",
    f"""WITH {SEQUENCE_SQL} SELECT transaction_id, transaction_sequence, round(time_since_last_txn, 6) + 0.0 AS time_since_last_txn,
 round(CASE WHEN mean > 0 THEN (amount - mean) / mean ELSE 0.0 END, 6) + 0.0 AS amount_deviation FROM seqf""",
)
def txn_sequence_features(lake):
    out = anomaly.sequence_features(lake("v_txn"), ["account_id"], ["ts", "transaction_id"], "amount")
    return rounded(out.select("transaction_id", "transaction_sequence", "time_since_last_txn", "amount_deviation"), ["time_since_last_txn", "amount_deviation"])


@query("percentile_rank", "SELECT event_id, round(percent_rank() OVER (ORDER BY value) * 100, 6) AS anomaly_percentile FROM events")
def percentile_rank(lake):
    out = ranks.percent_rank(lake("events").select("event_id", "value"), "value", "pr")
    return out.select("event_id", F.round(F.col("pr") * 100, 6).alias("anomaly_percentile"))


ROW_FEATURES = ["value", "user_id", "k", "hour"]
ROW_SQL = """rowf AS (SELECT event_id, [value, CAST(user_id AS DOUBLE), CAST(json_extract(props, '$.k') AS DOUBLE), CAST(hour(ts) AS DOUBLE)] AS v FROM events),
m AS (SELECT event_id, v, list_sum(v) / 4.0 AS mean FROM rowf),
s AS (SELECT event_id, v, mean, sqrt(list_sum(list_transform(v, lambda x: (x - mean) * (x - mean))) / 4.0) + 1e-10 AS std FROM m),
scored AS (SELECT event_id, round(-list_max(list_transform(v, lambda x: abs(x - mean) / std)), 9) AS anomaly_score FROM s)"""


def row_inputs(lake):
    return lake("events").select(
        "event_id", "value", "user_id", F.get_json_object("props", "$.k").cast("double").alias("k"), F.hour("ts").alias("hour")
    )


@query(
    "row_anomaly",
    f"""WITH {ROW_SQL}, lim AS (SELECT quantile_cont(anomaly_score, 0.01) AS q FROM scored)
SELECT event_id, round(anomaly_score, 6) AS anomaly_score, anomaly_score <= q AS is_anomaly,
 round(percent_rank() OVER (ORDER BY anomaly_score) * 100, 2) AS anomaly_percentile FROM scored, lim""",
)
def row_anomaly(lake):
    out = anomaly.row_anomaly(row_inputs(lake), ROW_FEATURES, digits=9)
    return out.select(
        "event_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly",
        F.round("anomaly_percentile", 2).alias("anomaly_percentile"),
    )


@query("isolation_scores")
def isolation_scores(lake):
    return anomaly.isolation_forest(row_inputs(lake), "event_id", ROW_FEATURES)


TXN_MCC = "CASE transaction_id % 9 WHEN 0 THEN '5411' WHEN 1 THEN '7995' WHEN 2 THEN '6011' WHEN 3 THEN '5812' WHEN 4 THEN '9999' WHEN 5 THEN NULL WHEN 6 THEN '4511' ELSE '5999' END"


@query(
    "secure_ml_table",
    f"""WITH {SEQUENCE_SQL}, e AS (SELECT [{', '.join(f'quantile_cont(abs(amount), {p / 100})' for p in fixed.AMOUNT_PERCENTILES[1:-1])}] AS edges FROM v_txn),
f AS (SELECT *, CAST(hour(ts) AS DOUBLE) AS h, {_pads_sql("CAST(account_id AS VARCHAR)")} AS tok, {TXN_MCC} AS mcc FROM seqf),
v AS (SELECT *, [abs(amount), h, time_since_last_txn, CAST(transaction_sequence AS DOUBLE)] AS x FROM f),
m AS (SELECT *, list_sum(x) / 4.0 AS mu FROM v),
d AS (SELECT *, sqrt(list_sum(list_transform(x, lambda y: (y - mu) * (y - mu))) / 4.0) + 1e-10 AS sd FROM m),
s AS (SELECT *, round(-list_max(list_transform(x, lambda y: abs(y - mu) / sd)), 9) AS score FROM d),
q AS (SELECT quantile_cont(score, 0.01) AS lim FROM s)
SELECT transaction_id, left(tok, 16) AS account_id, list_sum(list_transform(edges, lambda y: CASE WHEN abs(amount) >= y THEN 1 ELSE 0 END))::INTEGER AS amount_bin_encoded,
 CASE mcc WHEN '5411' THEN 0 WHEN '7995' THEN 3 WHEN '5812' THEN 1 WHEN '4511' THEN 1 WHEN '5999' THEN 1 ELSE 2 END AS merchant_risk_encoded,
 CAST(h AS INTEGER) AS hour_of_day, transaction_sequence, round(CASE WHEN mean > 0 THEN (amount - mean) / mean ELSE 0.0 END, 6) + 0.0 AS amount_deviation,
 round(score, 6) AS anomaly_score, score <= lim AS is_anomaly, CAST(ts AS DATE) AS date FROM s, e, q""",
)
def secure_ml_table(lake):
    txns = lake("v_txn").withColumn("mcc", F.expr(TXN_MCC))
    table = secure_etl.secure_ml_table(txns, SECRET, {"account_id": {"method": "deterministic"}}, binning.merchant_categories(lake.spark), digits=9)
    path = fresh_dir(lake.spark, "secure-table")
    secure_etl.write_with_lineage(table, [lake.path("events")], path, "secure_etl", "2024-02-01")
    out = lake.spark.read.schema(table.schema).parquet(path).select(
        "transaction_id", "account_id", "amount_bin_encoded", "merchant_risk_encoded", "hour_of_day", "transaction_sequence",
        "amount_deviation", "anomaly_score", "is_anomaly", "date",
    )
    return rounded(out, ["amount_deviation", "anomaly_score"])
