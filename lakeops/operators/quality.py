"""Row projections, cleaning, validation rules and quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import fixed
from lakeops.functions.exprs import c, rule_messages, time_partition
from lakeops.operators.search import latest_per_key


def partition_columns(df: DataFrame, ts: str = "ts", hour: bool = True) -> DataFrame:
    return df.withColumns(time_partition(ts, hour))


def schema_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Select (source, target, type) for the sources that exist; values that do not fit become null."""
    return df.select([F.col(s).try_cast(t).alias(d) for s, d, t in mapping if s in df.columns])


def lake_rows(df: DataFrame, ts: str) -> DataFrame:
    """Typed time, rows without any data dropped, partitions from each row's own time."""
    data = df.columns
    typed = df.withColumn(ts, F.col(ts).try_cast("timestamp_ntz"))
    return partition_columns(typed.na.drop(how="all", subset=data), ts)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as top-level columns with joined names; other types stay as they are."""

    def walk(schema: T.StructType, path: list[str]):
        for f in schema.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(list(walk(df.schema, [])))


def file_extension(name: Column | str) -> Column:
    return F.lower(F.regexp_extract(c(name), r"\.([A-Za-z0-9]+)$", 1))


def document_type(name: Column | str, content_type: Column | None = None) -> Column:
    """pdf, image, audio, text or unknown from the extension, else from the content type."""
    ext = file_extension(name)
    kind = content_type if content_type is not None else F.lit("")
    tests = {
        "pdf": kind == "application/pdf",
        "image": kind.startswith("image/"),
        "audio": kind.startswith("audio/"),
        "text": kind.startswith("text/"),
    }
    return F.coalesce(
        *[F.when(ext.isin(*exts) | F.coalesce(tests[name_], F.lit(False)), F.lit(name_)) for name_, exts in fixed.EXTENSIONS.items()],
        F.lit("unknown"),
    )


def path_metadata(df: DataFrame, path: str) -> DataFrame:
    """key=value folders and the study_image file name of an object path."""
    p = F.col(path)

    def part(name: str, default: str | None) -> Column:
        found = F.regexp_extract(p, rf"(?:^|/){name}=([^/]*)", 1)
        return F.when(found != "", found).otherwise(F.lit(default))

    stem = F.regexp_replace(F.element_at(F.split(p, "/"), -1), r"\.dcm$", "")
    names = F.split(stem, "_")
    return df.withColumns(
        {
            "facility_id": part("facility", "unknown"), "modality": part("modality", "OTHER"),
            "year": part("year", None), "month": part("month", None), "day": part("day", None),
            "study_id": F.get(names, F.lit(0)), "image_id": F.coalesce(F.get(names, F.lit(1)), F.lit("unknown")),
        }
    )


def clean_imaging(df: DataFrame, required: Sequence[str], key: str, order: Sequence[str]) -> DataFrame:
    """Required columns present, newest row per key, upper-case labels, empty instead of missing code lists."""
    absent = [r for r in required if r not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {absent}")
    kept = df.na.drop(how="any", subset=list(required))
    unique = latest_per_key(kept, [key], order)
    fixes = {n: F.upper(n) for n in ("modality", "body_part") if n in df.columns}
    if "condition_codes" in df.columns:
        fixes["condition_codes"] = F.coalesce("condition_codes", F.array().cast("array<string>"))
    return unique.withColumns(fixes)


def with_errors(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    return df.withColumn("errors", rule_messages(rules))


def quarantine(df: DataFrame, rules: Sequence[tuple[Column, str]], key: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows as (key, raw body, reason, status)."""
    checked = with_errors(df, rules)
    good = checked.filter(F.size("errors") == 0).drop("errors")
    bad = checked.filter(F.size("errors") > 0).select(
        key, F.to_json(F.struct(*df.columns)).alias("body"), F.array_join("errors", "; ").alias("reason"), F.lit("QUARANTINED").alias("status")
    )
    return good, bad


def bank_rules() -> list[tuple[Column, str]]:
    needs_target = F.col("transaction_type").isin("TRANSFER", "PAYMENT") & F.col("target_account").isNull()
    bad_format = lambda x: F.col(x).isNotNull() & ~F.col(x).rlike(r"^[0-9]{10,12}$")
    return [
        (F.col("amount") <= 0, "Amount must be positive"),
        (bad_format("source_account") | bad_format("target_account"), "Account number must be 10-12 digits"),
        (needs_target, "Target account required for transfers and payments"),
        (F.col("source_account").startswith("0000"), "Invalid account"),
    ]


MAX_PAYLOAD = 262144  # fixed value: largest task payload in bytes


def task_rules() -> list[tuple[Column, str]]:
    blank = lambda x: F.col(x).isNull() | (F.trim(x) == "")
    lacks = lambda word: F.col("payload").isNull() | ~F.contains("payload", F.lit(word))
    kind = F.col("task_type")
    return [
        (blank("task_id"), "Task ID is required"),
        (blank("task_type"), "Task type is required"),
        (F.col("priority").isNull(), "Task priority is required"),
        (F.length("payload") > MAX_PAYLOAD, f"Payload exceeds maximum size of {MAX_PAYLOAD} bytes"),
        ((kind == "DATA_PROCESSING") & blank("payload"), "DATA_PROCESSING tasks require a payload with data source information"),
        ((kind == "REPORT_GENERATION") & lacks("reportType"), "REPORT_GENERATION tasks require a payload with reportType"),
        ((kind == "NOTIFICATION_DISPATCH") & lacks("channel"), "NOTIFICATION_DISPATCH tasks require a payload with channel"),
    ]


def gps_rules(columns: Sequence[str] = ()) -> list[tuple[Column, str]]:
    """Range rules of a fix; those of optional readings apply when the column is named."""
    optional = {
        "heading": (~F.col("heading").between(0, 360), "Heading out of range"),
        "accuracy_m": (F.col("accuracy_m") < 0, "Negative accuracy"),
        "fuel_level_pct": (~F.col("fuel_level_pct").between(0, 100), "Fuel level out of range"),
    }
    return [
        (F.col("truck_id").isNull(), "Missing truck_id"),
        (F.col("latitude").isNull() | F.col("longitude").isNull(), "Missing position"),
        (~F.col("latitude").between(-90, 90), "Latitude out of range"),
        (~F.col("longitude").between(-180, 180), "Longitude out of range"),
        (F.col("speed_kmh") < 0, "Negative speed"),
        (~F.col("engine_status").isin("running", "idle", "off"), "Unknown engine status"),
        *[optional[n] for n in columns if n in optional],
    ]


def transcript_rules(segments: str = "segments") -> list[tuple[Column, str]]:
    seg = F.col(segments)
    return [
        (F.coalesce(F.col("call_id"), F.lit("")) == "", "Missing call_id"),
        (F.coalesce(F.col("agent_id"), F.lit("")) == "", "Missing agent_id"),
        (F.coalesce(F.col("customer_id"), F.lit("")) == "", "Missing customer_id"),
        (seg.isNull() | (F.size(seg) == 0), "No segments in transcript"),
        (F.col("duration") < 0, "Invalid duration"),
        (F.exists(seg, lambda s: F.trim(s["text"]) == ""), "Empty text in segment"),
        (F.exists(seg, lambda s: s["end_time"] < s["start_time"]), "Invalid time range in segment"),
    ]
