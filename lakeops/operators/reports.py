"""Grouped reports over lake events, images, queries, logs, documents and permissions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import fixed
from lakeops.functions.exprs import c, ntz, number_or_null, percent_change, ratio

GB = 1024.0**3
TB = 1024.0**4
MB = 1024.0**2


def events_by_type(df: DataFrame, month: str | None = None) -> DataFrame:
    if month is None:
        rows = df
    else:
        # a half-open range of the column itself, so that it reaches the scan
        first = F.lit(f"{month}-01").cast(df.schema["ts"].dataType)
        rows = df.filter((F.col("ts") >= first) & (F.col("ts") < first + F.expr("INTERVAL 1 MONTH")))
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.count_distinct("user_id").alias("unique_users")
    ).orderBy(F.desc("event_count"), "event_type")


def daily_active_users(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("ts").alias("day")).agg(F.count_distinct("user_id").alias("dau")).orderBy("day")


def approx_users(df: DataFrame, error: float = 0.05) -> DataFrame:
    """Distinct users per type from a mergeable sketch."""
    return df.groupBy("event_type").agg(F.approx_count_distinct("user_id", error).alias("approx_users"))


def user_sessions(df: DataFrame, limit: int | None = 100) -> DataFrame:
    start, end = F.min("ts"), F.max("ts")
    out = df.filter(F.col("session_id").isNotNull()).groupBy("user_id", "session_id").agg(
        start.alias("session_start"), end.alias("session_end"), F.count(F.lit(1)).alias("event_count"),
    ).withColumn("session_duration_minutes", F.timestamp_diff("MINUTE", F.col("session_start"), F.col("session_end")))
    out = out.orderBy(F.desc("session_start"), F.asc_nulls_last("user_id"), "session_id")
    return out if limit is None else out.limit(limit)


def geo_distribution(df: DataFrame, limit: int = 50) -> DataFrame:
    geo = F.col("geo")
    return (
        df.filter(geo["country"].isNotNull())
        .groupBy(geo["country"].alias("country"), geo["city"].alias("city"))
        .agg(F.count(F.lit(1)).alias("event_count"), F.count_distinct("user_id").alias("unique_users"))
        .orderBy(F.desc("event_count"), "country", "city").limit(limit)
    )


def hourly_trends(df: DataFrame, day: str | None = None) -> DataFrame:
    """Events per hour and type, of one day or of all; a day is a half-open range of times, which reaches the scan."""
    begin = None if day is None else F.to_timestamp_ntz(F.lit(day))
    rows = df if begin is None else df.filter((F.col("ts") >= begin) & (F.col("ts") < begin + F.expr("INTERVAL 1 DAY")))
    return rows.groupBy(F.date_format("ts", "HH").alias("hour"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count")
    ).orderBy("hour", F.desc("event_count"), "event_type")


def avg_property_by_type(df: DataFrame, path: str, limit: int = 10) -> DataFrame:
    """Average of a numeric JSON property per event type; unreadable values are skipped."""
    value = number_or_null(F.get_json_object("props", path))
    return (
        df.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("event_count"), ratio(F.sum(value), F.count(value), None).alias("avg_property"))
        .orderBy(F.desc("event_count"), "event_type").limit(limit)
    )


def data_quality_check(df: DataFrame, days: int = 30) -> DataFrame:
    return (
        df.groupBy(F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("event_id").isNull()).alias("null_event_ids"),
            F.count_if(F.col("user_id").isNull()).alias("null_user_ids"),
            F.count_if(F.col("ts").isNull()).alias("null_timestamps"),
            F.count_distinct("event_type").alias("unique_event_types"),
        )
        .orderBy(F.desc("day")).limit(days)
    )


def imaging_by_modality(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    day = F.col("acquisition_date")
    if year is not None and month is not None:
        first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
        df = df.filter((day >= first) & (day < F.add_months(first, 1)))
    elif year is not None:
        df = df.filter((day >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (day < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))))
    elif month is not None:
        df = df.filter(F.month(day) == month)
    return df.groupBy("modality", "body_part").agg(
        F.count(F.lit(1)).alias("image_count"), F.count_distinct("patient_id").alias("patient_count")
    ).orderBy(F.desc("image_count"), "modality", "body_part")


def imaging_statistics(df: DataFrame) -> DataFrame:
    return df.groupBy("modality", "body_part").agg(
        F.count(F.lit(1)).alias("image_count"),
        F.count_distinct("patient_id").alias("patient_count"),
        (F.sum("file_size_bytes") / GB).alias("total_gb"),
        F.min("acquisition_date").alias("earliest_date"),
        F.max("acquisition_date").alias("latest_date"),
    ).orderBy(F.desc("image_count"), "modality", "body_part")


def load_statistics(df: DataFrame) -> DataFrame:
    """Totals (null modality row) and per-modality rows of one load, in one pass."""
    return df.groupingSets([[], ["modality"]], "modality").agg(
        F.grouping("modality").cast("int").alias("is_total"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("facility_id").alias("facility_count"),
        (F.sum("file_size_bytes") / GB).alias("total_size_gb"),
        (F.sum("file_size_bytes") / F.count("file_size_bytes") / MB).alias("avg_size_mb"),
    )


def query_costs(df: DataFrame, scanned: str = "data_scanned_bytes", price_per_tb: float = 5.0) -> DataFrame:
    bytes_read = F.coalesce(c(scanned), F.lit(0))
    return df.withColumns({"data_scanned_gb": bytes_read / GB, "estimated_cost_usd": bytes_read / TB * price_per_tb})


def processing_cost(df: DataFrame, units: dict[str, Column]) -> DataFrame:
    """One cost column per service unit plus their total."""
    costs = {f"{name}_cost": amount * F.lit(fixed.UNIT_PRICES[name]) for name, amount in units.items()}
    total = sum(costs.values(), F.lit(0.0))
    return df.withColumns(costs).withColumn("total_cost", total)


def log_metric(df: DataFrame, pattern: Column, period: str = "5 minutes", threshold: int = 0, ts: str = "ts") -> DataFrame:
    """Matches of a log pattern per period and whether they exceed the threshold."""
    return df.groupBy(F.window(ts, period).alias("w")).agg(F.count_if(pattern).alias("metric_value")).select(
        ntz("w.start").alias("period_start"), "metric_value", (F.col("metric_value") > threshold).alias("alarm")
    )


def access_audit(grants: DataFrame) -> DataFrame:
    """Per principal and table: select right, column or row limits, and whether access is limited as required."""
    flags = grants.groupBy("principal", "table_name").agg(
        F.bool_or(F.array_contains("permissions", "SELECT")).alias("has_access"),
        F.bool_or(F.col("column_names").isNotNull()).alias("column_level_security"),
        F.bool_or(F.col("row_filter").isNotNull()).alias("row_level_security"),
    )
    limited = F.col("column_level_security") | F.col("row_level_security")
    return flags.withColumn("compliant", F.col("has_access") & limited)


def daily_usage(df: DataFrame, error: Column) -> DataFrame:
    return df.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("invocations"), F.count_if(error).alias("errors")
    ).orderBy("day")


def user_activity(df: DataFrame) -> DataFrame:
    """Counts per user by type, by day and by resource prefix, as one long table."""
    keyed = df.select(
        "user_id", "event_name", F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.split_part("resource", F.lit("/"), F.lit(1)).alias("area"),
    )
    sets = keyed.groupingSets(
        [["user_id", "event_name"], ["user_id", "day"], ["user_id", "area"]], "user_id", "event_name", "day", "area"
    ).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("events"))
    kind = F.when(F.col("g") == 3, "type").when(F.col("g") == 5, "day").otherwise("resource")
    item = F.when(F.col("g") == 3, F.col("event_name")).when(F.col("g") == 5, F.col("day")).otherwise(F.col("area"))
    return sets.select("user_id", kind.alias("kind"), item.alias("item"), "events").filter(F.col("item").isNotNull())


def compliance_report(df: DataFrame) -> DataFrame:
    """Counts by event type, status and job, with personal-data operations and success rate, as one long table."""
    sets = df.groupingSets(
        [[], ["audit_type"], ["status"], ["job_name"]], "audit_type", "status", "job_name"
    ).agg(
        F.grouping_id().alias("g"), F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("audit_type").isin("PII_DETECTION", "PII_TOKENIZATION")).alias("pii_operations"),
        F.count_if(F.col("status") == "SUCCESS").alias("successes"),
    )
    # bits of g from the left: audit_type, status, job_name; set = rolled up
    kind = F.when(F.col("g") == 7, "total").when(F.col("g") == 3, "event_type").when(F.col("g") == 5, "status").otherwise("job")
    item = F.when(F.col("g") == 7, F.lit("all")).otherwise(F.coalesce("audit_type", "status", "job_name"))
    return sets.select(
        kind.alias("kind"), item.alias("item"), "events", "pii_operations",
        ratio(F.col("successes") * 100, F.col("events")).alias("success_rate"),
    ).filter(F.col("item").isNotNull())


def pii_access_log(df: DataFrame, column: str | None = None) -> DataFrame:
    rows = df.filter(F.col("audit_type").isin("PII_DETECTION", "PII_TOKENIZATION"))
    return rows if column is None else rows.filter(F.array_contains("columns_accessed", column))


def period_compare(df: DataFrame, day: str, end: str, days: int, group: Sequence[str] = ()) -> DataFrame:
    """Current against previous period of equal length (half-open), from one scan."""
    age = F.datediff(F.lit(end).cast("date"), F.col(day))
    now, before = (age > 0) & (age <= days), (age > days) & (age <= 2 * days)
    last = F.lit(end).cast("date")
    rows = df.filter((F.col(day) < last) & (F.col(day) >= F.date_sub(last, 2 * days)))

    def both(name: str, cond: Column) -> list[Column]:
        return [F.count_if(now & cond).alias(f"{name}_now"), F.count_if(before & cond).alias(f"{name}_before")]

    true = F.lit(True)
    agg = rows.groupBy(*group).agg(
        *both("total", true), *both("positive", F.col("sentiment") == "POSITIVE"), *both("negative", F.col("sentiment") == "NEGATIVE"),
        F.sum(F.when(now, F.col("duration"))).alias("duration_now"), F.sum(F.when(before, F.col("duration"))).alias("duration_before"),
    )

    def rate(name: str, when: str) -> Column:
        return ratio(F.coalesce(F.col(f"{name}_{when}"), F.lit(0)), F.col(f"total_{when}"))

    return agg.select(
        *group,
        F.col("total_now").alias("total_calls"),
        percent_change(F.col("total_now").cast("double"), F.col("total_before").cast("double")).alias("total_calls_change"),
        *[
            col
            for name, label in (("positive", "positive_rate"), ("negative", "negative_rate"), ("duration", "avg_duration"))
            for col in (rate(name, "now").alias(label), percent_change(rate(name, "now"), rate(name, "before")).alias(f"{label}_change"))
        ],
    )


def normalize_weights(df: DataFrame, group: Sequence[str], weight: str) -> DataFrame:
    """Weights divided by their group total (unchanged when it is zero); totals come from an aggregate."""
    totals = df.groupBy(*group).agg(F.sum(weight).cast("double").alias("_total"))
    from lakeops.operators.timeline import join_null_safe

    joined = join_null_safe(df, totals, group)
    return joined.withColumn("normalized", F.when(F.col("_total") != 0, F.col(weight) / F.col("_total")).otherwise(F.col(weight))).drop("_total")
