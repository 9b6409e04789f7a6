"""Messaging, calls, inventory, banking, audit and recommender operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions import fixed
from lakeops.functions.exprs import c, clean_text, exact_sum, ratio, words_of
from lakeops.operators import timeline as tl
from lakeops.operators.search import newest_per_group
from lakeops.session import materialize

# --- messaging --------------------------------------------------------------------

KIND = "event_type"
DELIVERED, FAILED, BUFFERED = "_SMS.SUCCESS", "_SMS.FAILURE", "_SMS.BUFFERED"
OPT_OUT, RECEIVED = "_SMS.OPTOUT", "_SMS.RECEIVED"


def _is(kind: str) -> Column:
    return F.col(KIND) == kind


def sms_metrics(df: DataFrame, group: Sequence[str | Column] = ()) -> DataFrame:
    """Counts, rates and cost; sent means delivered or failed."""
    cost = F.sum("price_millicents").cast("double") / 100000
    out = df.groupBy(*group).agg(
        F.count_if(_is(DELIVERED) | _is(FAILED)).alias("messages_sent"),
        F.count_if(_is(DELIVERED)).alias("messages_delivered"),
        F.count_if(_is(FAILED)).alias("messages_failed"),
        F.count_if(_is(RECEIVED)).alias("responses_received"),
        F.count_if(_is(OPT_OUT)).alias("opt_outs"),
        F.coalesce(cost, F.lit(0.0)).alias("total_cost_usd"),
    )
    return out.withColumns(
        {
            "delivery_rate": ratio(F.col("messages_delivered"), F.col("messages_sent")),
            "response_rate": ratio(F.col("responses_received"), F.col("messages_sent")),
        }
    )


def named_or(column: str, fallback: str) -> Column:
    return F.when(F.coalesce(F.col(column), F.lit("")) == "", F.lit(fallback)).otherwise(F.col(column))


def sms_by_campaign(df: DataFrame, publish: bool = True) -> DataFrame:
    out = sms_metrics(df.withColumn("campaign_id", named_or("campaign_id", "no_campaign")), ["campaign_id"])
    return out.filter(F.col("campaign_id") != "no_campaign") if publish else out


def sms_by_country(df: DataFrame) -> DataFrame:
    out = sms_metrics(df.withColumn("country", named_or("iso_country_code", "unknown")), ["country"])
    return out.select("country", F.col("messages_delivered").alias("delivered"), F.col("messages_failed").alias("failed"), F.col("total_cost_usd").alias("cost"))


def delivery_stats(df: DataFrame) -> DataFrame:
    """Delivery counts overall (null message type) and per message type; buffered counts in the total."""
    return df.groupingSets([[], ["message_type"]], "message_type").agg(
        F.count_if(_is(DELIVERED) | _is(FAILED) | _is(BUFFERED)).alias("total"),
        F.count_if(_is(DELIVERED)).alias("delivered"),
        F.count_if(_is(FAILED)).alias("failed"),
        F.count_if(_is(BUFFERED)).alias("buffered"),
    ).withColumns(
        {"delivery_rate": ratio(F.col("delivered"), F.col("total")), "failure_rate": ratio(F.col("failed"), F.col("total"))}
    )


def _word_array(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def reply_sentiment(text: Column | str) -> Column:
    """negative before positive before neutral, on words without punctuation."""
    words = words_of(text)
    return (
        F.when(F.arrays_overlap(words, _word_array(fixed.NEGATIVE_WORDS)), "negative")
        .when(F.arrays_overlap(words, _word_array(fixed.POSITIVE_WORDS)), "positive")
        .otherwise("neutral")
    )


def reply_flags(df: DataFrame, text: str = "message_body") -> DataFrame:
    said = F.upper(F.trim(c(text)))
    return df.withColumns(
        {
            "sentiment": reply_sentiment(text),
            "is_opt_out": said.isin(*fixed.OPT_OUT_REPLIES),
            "is_confirmation": said.isin(*fixed.CONFIRM_REPLIES),
        }
    )


def subscriber_status(df: DataFrame) -> DataFrame:
    """Status set by the last opt-out or confirmation of each subscriber."""
    flagged = reply_flags(df).filter("is_opt_out OR is_confirmation")
    status = F.when(F.col("is_opt_out"), "OPTED_OUT").otherwise("ACTIVE")
    return flagged.groupBy("subscriber_id").agg(
        F.max_by(status, F.struct("event_timestamp", "message_id")).alias("status"), F.max("event_timestamp").alias("updated_at")
    )


# --- calls ------------------------------------------------------------------------


def call_counts(group: Sequence[str], df: DataFrame) -> DataFrame:
    s = F.col("sentiment")
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.count_if(s == "POSITIVE").alias("positive_calls"),
        F.count_if(s == "NEGATIVE").alias("negative_calls"),
        F.count_if(s == "NEUTRAL").alias("neutral_calls"),
        F.count_if(s == "MIXED").alias("mixed_calls"),
        F.sum("duration").alias("_duration"),
        F.sum("positive_score").cast("double").alias("_score"),
    ).withColumns(
        {"avg_duration": ratio(F.col("_duration"), F.col("total_calls")), "avg_positive_score": ratio(F.col("_score"), F.col("total_calls"))}
    ).drop("_duration", "_score")


def call_metrics(df: DataFrame) -> DataFrame:
    return call_counts([], df)


def agent_metrics(df: DataFrame) -> DataFrame:
    out = call_counts(["agent_id"], df)
    return out.withColumn("satisfaction_rate", ratio(F.col("positive_calls"), F.col("total_calls")))


def top_agents(df: DataFrame, limit: int = 10, sort_by: str = "satisfaction") -> DataFrame:
    by = {"satisfaction": "satisfaction_rate", "calls": "total_calls", "negative": "negative_calls"}[sort_by]
    out = agent_metrics(df).withColumns(
        {"satisfaction_rate": F.round(F.col("satisfaction_rate") * 100, 1), "avg_duration": F.round("avg_duration", 0)}
    )
    return out.orderBy(F.desc(by), "agent_id").limit(limit).select(
        "agent_id", "total_calls", "positive_calls", "negative_calls", "satisfaction_rate", "avg_duration"
    )


def top_terms(df: DataFrame, group: Sequence[str], terms: Column, n: int = 10) -> DataFrame:
    """Most frequent lower-case terms per group; ties in alphabetical order."""
    counts = (
        df.select(*group, F.explode(F.transform(terms, F.lower)).alias("term"))
        .filter(F.col("term") != "").groupBy(*group, "term").agg(F.count(F.lit(1)).alias("mentions"))
    )
    if not group:
        return counts.orderBy(F.desc("mentions"), "term").limit(n)
    return newest_per_group(counts, group, [F.desc("mentions"), F.col("term")], n)


def sentiment_trend(df: DataFrame, interval: str = "day") -> DataFrame:
    """Counts per calendar interval; intervals without calls appear with zeros. Intervals below a day are times, others dates."""
    kind = "timestamp_ntz" if interval.lower() in ("second", "minute", "hour") else "date"
    keyed = df.withColumn("date", F.date_trunc(interval, F.col("call_date").cast("timestamp")).cast(kind))
    counts = call_counts(["date"], keyed)
    span = keyed.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select(F.explode(F.expr(f"sequence(a, b, INTERVAL 1 {interval.upper()})")).alias("date"))
    out = days.join(counts, "date", "left").fillna(0, ["total_calls", "positive_calls", "negative_calls", "neutral_calls"])
    return out.select("date", "total_calls", "positive_calls", "negative_calls", "neutral_calls", "avg_positive_score").orderBy("date")


def call_quality(df: DataFrame) -> DataFrame:
    """0..100 from overall and customer sentiment and call length."""

    def points(column: str, table: dict[str, int]) -> Column:
        return F.coalesce(*[F.when(F.col(column) == k, F.lit(v)) for k, v in table.items()], F.lit(0))

    d = F.col("duration")
    length = F.when((d > 0) & (d < 60), -5).when(d > 600, -10).otherwise(0)
    total = F.lit(fixed.CALL_BASE_POINTS) + points("sentiment", fixed.OVERALL_POINTS) + points("customer_sentiment", fixed.CUSTOMER_POINTS) + length
    return df.withColumn("quality_score", F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("double"))


def recommendations(negative_calls: DataFrame, entities: DataFrame, phrases: DataFrame) -> DataFrame:
    """Messages from the number of negative calls, their top entities and top phrases.

    ``entities`` and ``phrases`` are top-ten lists (term, mentions), so sorting them is cheap.
    """
    volume = negative_calls.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > fixed.ADVICE_CALLS).select(
        F.lit(1).alias("rank"), F.format_string(fixed.ADVICE_VOLUME, "n").alias("recommendation"),
    )
    named = entities.orderBy(F.desc("mentions"), "term").limit(3).filter(F.col("mentions") > fixed.ADVICE_ENTITY_MENTIONS).select(
        F.lit(2).alias("rank"), F.format_string(fixed.ADVICE_ENTITY, "term", "mentions").alias("recommendation"),
    )
    troubling = F.exists(_word_array(fixed.PROBLEM_WORDS), lambda w: F.contains(F.col("term"), w))
    phrase = phrases.filter(troubling & (F.col("mentions") > fixed.ADVICE_PHRASE_MENTIONS)).orderBy(F.desc("mentions"), "term").limit(1).select(
        F.lit(3).alias("rank"), F.format_string(fixed.ADVICE_PHRASE, "term").alias("recommendation"),
    )
    found = volume.unionByName(named).unionByName(phrase)
    none = found.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0).select(
        F.lit(4).alias("rank"), F.lit(fixed.ADVICE_NONE).alias("recommendation")
    )
    return found.unionByName(none)


TURNS_PER_PART = 1000


def call_texts(df: DataFrame, call: str, turn: str, speaker: str, text: str) -> DataFrame:
    """Full, customer and agent text per call: one row and one line each.

    The turns of a call are joined in two steps, a thousand at a time and then the parts in
    order, so no array ever holds more than a thousand turns or one string per thousand.
    """
    line = F.struct(F.col(turn).alias("turn"), F.col(speaker).alias("speaker"), F.col(text).alias("text"))
    parts = df.groupBy(call, F.floor(F.col(turn) / TURNS_PER_PART).alias("part")).agg(F.array_sort(F.collect_list(line)).alias("_lines"))

    def said_by(*speakers: str) -> Column:
        mine = F.filter("_lines", lambda x: x["speaker"].isin(*speakers)) if speakers else F.col("_lines")
        return F.array_join(F.transform(mine, lambda x: x["text"]), " ")

    names = {"full_text": (), "customer_text": ("user", "CUSTOMER"), "agent_text": ("assistant", "AGENT")}
    strings = parts.select(call, F.struct("part", *[said_by(*who).alias(n) for n, who in names.items()]).alias("_part"))
    whole = strings.groupBy(call).agg(F.array_sort(F.collect_list("_part")).alias("_parts"))
    return whole.select(call, *[clean_text(F.array_join(F.col(f"_parts.{n}"), " ")).alias(n) for n in names])


TRANSCRIPT_JSON = (
    "callId string, call_id string, agentId string, agent_id string, customerId string, customer_id string, duration int, language string, "
    "segments array<struct<speaker string, startTime double, endTime double, text string>>"
)


def parse_transcripts(df: DataFrame, body: str) -> DataFrame:
    """Typed transcript from JSON: either key style, known speakers, defaults for gaps."""
    j = F.from_json(body, TRANSCRIPT_JSON)
    doc = df.withColumn("_j", j)
    f = lambda n: F.col(f"_j.{n}")

    def segment(s: Column) -> Column:
        who = F.upper(F.coalesce(s["speaker"], F.lit("UNKNOWN")))
        return F.struct(
            F.when(who.isin("AGENT", "CUSTOMER"), who).otherwise("UNKNOWN").alias("speaker"),
            F.coalesce(s["startTime"], F.lit(0.0)).alias("start_time"), F.coalesce(s["endTime"], F.lit(0.0)).alias("end_time"),
            F.coalesce(s["text"], F.lit("")).alias("text"),
        )

    return doc.select(
        *df.columns,
        F.coalesce(f("callId"), f("call_id"), F.lit("")).alias("call_id"),
        F.coalesce(f("agentId"), f("agent_id"), F.lit("")).alias("agent_id"),
        F.coalesce(f("customerId"), f("customer_id"), F.lit("")).alias("customer_id"),
        F.coalesce(f("duration"), F.lit(0)).alias("duration"),
        F.coalesce(f("language"), F.lit("en")).alias("language"),
        F.transform(F.coalesce(f("segments"), F.array().cast("array<struct<speaker:string,startTime:double,endTime:double,text:string>>")), segment).alias("segments"),
    )


# --- inventory and banking --------------------------------------------------------


def inventory_totals(df: DataFrame) -> DataFrame:
    active = df.filter("is_active")
    return active.agg(
        F.sum(F.col("unit_price") * F.col("quantity_in_stock")).cast("double").alias("total_value"),
        F.count_if(F.col("quantity_in_stock") <= F.col("reorder_level")).alias("reorder_count"),
        F.count(F.lit(1)).alias("product_count"),
    )


def low_stock_report(df: DataFrame) -> DataFrame:
    """Products to reorder with their reorder value, and a total row (null sku)."""
    low = df.filter(F.col("is_active") & (F.col("quantity_in_stock") <= F.col("reorder_level")))
    return low.rollup("sku").agg(
        F.count(F.lit(1)).alias("products"), F.sum(F.col("unit_price") * F.col("reorder_quantity")).cast("double").alias("reorder_value")
    )


def apply_stock_moves(products: DataFrame, moves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products after their net movement, and the ones whose stock would go negative."""
    net = moves.groupBy("sku").agg(F.sum("quantity_change").alias("change"))
    moved = products.join(net, "sku", "left").withColumn("new_quantity", F.col("quantity_in_stock") + F.coalesce("change", F.lit(0)))
    status = F.when(F.col("new_quantity") == 0, "OUT_OF_STOCK").otherwise("ACTIVE")
    return moved.filter(F.col("new_quantity") >= 0).withColumn("status", status), moved.filter(F.col("new_quantity") < 0)


def account_balances(df: DataFrame, floor: int = tl.HOT_ROWS, scale: int = 8) -> DataFrame:
    """Running balance per account from zero: deposits add, everything else subtracts; amounts with ``scale`` decimals."""
    amount = F.col("amount").cast(f"decimal(28,{scale})")
    signed = F.when(F.col("transaction_type") == "DEPOSIT", amount).otherwise(-amount)
    return tl.running_totals(df, ["source_account"], ["ts", "transaction_id"], {"balance": signed}, floor)


def apply_enrichment(rows: DataFrame, results: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Overwrite fields only where the result has a value."""
    new = results.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = rows.join(new, key, "left")
    return joined.withColumns({f: F.coalesce(f"_new_{f}", f) for f in fields}).drop(*[f"_new_{f}" for f in fields])


def popular_routes(df: DataFrame, origin: str, destination: str, n: int = 10) -> DataFrame:
    route = F.concat(F.col(origin).cast("string"), F.lit("-"), F.col(destination).cast("string"))
    return df.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("trips")).orderBy(F.desc("trips"), "route").limit(n)


# --- audit ------------------------------------------------------------------------

# fixed values: control-plane calls that always matter, with their category
CRITICAL_EVENTS = {
    "ConsoleLogin": "Authentication",
    "CreateUser": "IAM", "DeleteUser": "IAM", "CreateAccessKey": "IAM", "DeleteAccessKey": "IAM",
    "AttachUserPolicy": "IAM", "DetachUserPolicy": "IAM", "AttachRolePolicy": "IAM", "PutUserPolicy": "IAM",
    "PutRolePolicy": "IAM", "CreateRole": "IAM", "DeleteRole": "IAM", "UpdateAssumeRolePolicy": "IAM",
    "CreatePolicy": "IAM", "DeletePolicy": "IAM",
    "PutBucketPolicy": "S3", "DeleteBucketPolicy": "S3", "PutBucketAcl": "S3", "PutBucketPublicAccessBlock": "S3",
    "AuthorizeSecurityGroupIngress": "EC2", "AuthorizeSecurityGroupEgress": "EC2", "CreateSecurityGroup": "EC2", "DeleteSecurityGroup": "EC2",
    "ModifyDBInstance": "RDS", "DeleteDBInstance": "RDS", "CreateDBSnapshot": "RDS", "ModifyDBCluster": "RDS",
    "PutKeyPolicy": "KMS", "ScheduleKeyDeletion": "KMS", "DisableKey": "KMS",
    "StopLogging": "CloudTrail", "DeleteTrail": "CloudTrail", "UpdateTrail": "CloudTrail", "PutEventSelectors": "CloudTrail",
}
# fixed values: error text that hints at probing
SUSPICIOUS_ERRORS = ["Failed", "Denied", "Unauthorized", "AccessDenied", "InvalidAccessKeyId", "SignatureDoesNotMatch"]


def classify_audit(df: DataFrame) -> DataFrame:
    """One row per finding; an event may give none, one or several."""
    name, error = F.col("event_name"), F.col("error_code")
    category = F.try_element_at(F.create_map(*[F.lit(x) for kv in CRITICAL_EVENTS.items() for x in kv]), name)

    def finding(kind: Column, result: Column, detail: Column) -> Column:
        return F.struct(kind.alias("audit_kind"), result.alias("result"), detail.alias("detail"))

    critical = F.when(category.isNotNull(), finding(F.lit("CONFIG_CHANGE"), F.when(error.isNull(), "success").otherwise("failure"), category))
    suspicious = F.when(
        error.rlike("|".join(SUSPICIOUS_ERRORS)), finding(F.lit("SUSPICIOUS_ACTIVITY"), F.lit("denied"), error)
    )
    ok = F.col("login_result") == "Success"
    login = F.when(
        name == "ConsoleLogin",
        finding(F.when(ok, "LOGIN_SUCCESS").otherwise("LOGIN_FAILURE"), F.lower("login_result"), F.lit("login")),
    )
    found = F.filter(F.array(critical, suspicious, login), lambda x: x.isNotNull())
    return df.select("event_id", "tenant_id", "user_id", "ts", F.explode(found).alias("f")).select("event_id", "tenant_id", "user_id", "ts", "f.*")


def api_access_events(df: DataFrame, method: str, status_code: str) -> DataFrame:
    code = F.col(status_code)
    kind = (
        F.when(code == 403, "ACCESS_DENIED").when(code == 401, "LOGIN_FAILURE")
        .when(F.col(method) == "GET", "DATA_READ").otherwise("DATA_UPDATE")
    )
    return df.withColumns({"audit_kind": kind, "result": F.when((code >= 200) & (code < 400), "success").otherwise("failure")})


# fixed values: handler of each event source and detail type; "*" takes any type of the source
ROUTES = [
    ("enterprise-api", "TenantCreated", "tenant_created"), ("enterprise-api", "TenantUpdated", "tenant_updated"),
    ("enterprise-api", "TenantDeleted", "tenant_deleted"), ("enterprise-api", "ResourceCreated", "resource"),
    ("enterprise-api", "ResourceUpdated", "resource"), ("enterprise-api", "ResourceDeleted", "resource"),
    ("aws.s3", "Object Created", "s3"), ("aws.dynamodb", "Stream Record", "dynamodb"),
    ("partner-service", "DataAvailable", "partner_data"), ("partner-service", "SyncRequest", "partner_sync"),
    ("aws.cloudtrail", "*", "cloudtrail"), ("aws.config", "*", "config"),
]


def route_events(df: DataFrame) -> DataFrame:
    """Handler name per event: exact match, then source match, else ``ignored``."""
    table = F.create_map(*[F.lit(x) for s, d, h in ROUTES for x in (f"{s}|{d}", h)])
    exact_key = F.concat_ws("|", "source", "detail_type")
    any_key = F.concat(F.col("source"), F.lit("|*"))
    return df.withColumn("handler", F.coalesce(F.try_element_at(table, exact_key), F.try_element_at(table, any_key), F.lit("ignored")))


# --- recommender ------------------------------------------------------------------


def genre_shares(views: DataFrame, content: DataFrame) -> DataFrame:
    """Watch time per user and genre with its share of the user's total."""
    by_genre = views.join(content.select("content_id", "genre"), "content_id").groupBy("user_id", "genre").agg(
        exact_sum("watch_time").alias("genre_time")
    )
    totals = by_genre.groupBy("user_id").agg(exact_sum("genre_time").alias("user_time"))
    return by_genre.join(totals, "user_id").withColumn("share", ratio(F.col("genre_time"), F.col("user_time")))


def user_features(views: DataFrame, content: DataFrame, as_of: str, lookback_days: int = 30) -> DataFrame:
    """Engagement of each user in the days before ``as_of``; diversity is the entropy of genre shares."""
    end = F.to_timestamp_ntz(F.lit(as_of))
    recent = views.filter((F.col("ts") >= end - F.expr(f"INTERVAL {lookback_days} DAYS")) & (F.col("ts") < end))
    base = recent.groupBy("user_id").agg(
        exact_sum("watch_time").alias("total_watch_time"),
        F.count(F.lit(1)).alias("num_sessions"),
        ratio(exact_sum("completion_rate"), F.count("completion_rate"), None).alias("avg_completion_rate"),
        F.count_distinct("content_id").alias("num_unique_content"),
        F.min("ts").alias("first_activity"), F.max("ts").alias("last_activity"),
    )
    shares = genre_shares(recent, content)
    entropy = shares.groupBy("user_id").agg((-exact_sum(F.col("share") * F.ln("share"))).alias("genre_diversity"))
    return base.join(entropy, "user_id", "left").withColumns(
        {
            "avg_watch_time": ratio(F.col("total_watch_time"), F.col("num_sessions")),
            "recency_days": F.timestamp_diff("DAY", F.col("last_activity"), F.to_timestamp_ntz(F.lit(as_of))),
            "sessions_per_day": F.col("num_sessions") / float(lookback_days),
            "genre_diversity": F.coalesce("genre_diversity", F.lit(0.0)),
        }
    )


def content_features(content: DataFrame, views: DataFrame, as_of: str) -> DataFrame:
    """Popularity and recency of every item, with genre and rating as alphabetical codes."""
    per_item = views.groupBy("content_id").agg(
        F.count_distinct("user_id").alias("unique_viewers"),
        exact_sum("watch_time").alias("total_watch_time"),
        ratio(exact_sum("completion_rate"), F.count("completion_rate"), None).alias("avg_completion_rate"),
    )
    top = per_item.agg(F.max("unique_viewers").alias("m"))
    joined = content.join(per_item, "content_id", "left").withColumn("_max", top.scalar())
    out = joined.withColumns(
        {
            "popularity_score": F.coalesce(ratio(F.col("unique_viewers"), F.col("_max")), F.lit(0.0)),
            "avg_completion_rate": F.coalesce("avg_completion_rate", F.lit(0.5)),
            "release_recency_days": F.datediff(F.lit(as_of).cast("date"), "release_date"),
        }
    ).drop("_max")
    for column in ("genre", "rating"):
        out = with_codes(out, column)
    return out


def with_codes(df: DataFrame, column: str) -> DataFrame:
    """0-based alphabetical code of a category; -1 when missing.

    Distinct labels are range-partitioned and written once with their part number; a label's
    code is its place within the part plus the sizes of the parts before it. No label list
    passes through the driver.
    """
    labels = df.select(column).filter(F.col(column).isNotNull()).distinct().repartitionByRange(column)
    parts = materialize(labels.withColumn("_part", F.spark_partition_id()), "labels")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    codes = parts.join(offsets, "_part").select(column, (place + F.col("_offset")).cast("int").alias(f"{column}_encoded"))
    return df.join(codes, column, "left").withColumn(f"{column}_encoded", F.coalesce(f"{column}_encoded", F.lit(-1)))


def one_hot(df: DataFrame, column: str, values: Sequence[str] | None = None, most: int = 1000) -> DataFrame:
    """One 0/1 column per category: the given ones, or all that occur; more than ``most`` are refused, as they become columns."""
    if values is None:
        values = sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect())
        if len(values) > most:
            raise ValueError(f"{column} has more than {most} categories")
    return df.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in values})


def interaction_features(views: DataFrame, users: DataFrame, content: DataFrame, shares: DataFrame) -> DataFrame:
    """Views with the features of their user and item and the user's share of time in the item's genre."""
    u = users.select("user_id", "total_watch_time", F.col("avg_completion_rate").alias("avg_completion_rate_user"), "genre_diversity", "recency_days")
    items = content.select("content_id", "genre", "popularity_score", "duration_minutes", "genre_encoded", "rating_encoded")
    affinity = shares.select("user_id", "genre", F.col("share").alias("user_genre_affinity"))
    joined = views.join(u, "user_id", "left").join(items, "content_id", "left").join(affinity, ["user_id", "genre"], "left")
    return joined.withColumn("user_genre_affinity", F.coalesce("user_genre_affinity", F.lit(0.0)))


def ndcg_at_k(df: DataFrame, truth: str, prediction: str, tie: str, k: int = 10, group: Sequence[str] = ()) -> DataFrame:
    """Discounted gain of the k best predictions over that of the k best true values."""
    keys = list(group) or ["_all"]
    rows = df if group else df.withColumn("_all", F.lit(0))

    def gain(order: str, name: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.desc(order), tie)
        ranked = rows.withColumn("_no", F.row_number().over(w)).filter(F.col("_no") <= k)
        return ranked.groupBy(*keys).agg(F.sum(F.col(truth) / F.log2(F.col("_no") + 1)).alias(name))

    both = gain(prediction, "dcg").join(gain(truth, "ideal"), keys)
    return both.withColumn("ndcg", ratio(F.col("dcg"), F.col("ideal"))).drop("dcg", "ideal", "_all")
