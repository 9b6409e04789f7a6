"""Model-variant metrics, health verdicts, classification scores and table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.exprs import c, non_null_items, ratio
from lakeops.operators.ranks import exact_percentiles
from lakeops.operators.timeline import join_null_safe


def variant_metrics(df: DataFrame, group: Sequence[str], latency: str = "model_latency_us", overhead: str | None = None, utilization: Sequence[str] = ()) -> DataFrame:
    """Counts, error rate, exact latency percentiles and, if asked, the mean overhead latency (microseconds in, milliseconds
    out) and the mean of each utilisation column; a mean without values is 0."""
    code = F.col("status_code")
    means = [F.coalesce(F.avg(overhead) / 1000, F.lit(0.0)).alias("overhead_latency_ms")] if overhead else []
    means += [F.coalesce(F.avg(u), F.lit(0.0)).alias(u) for u in utilization]
    counts = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("invocation_count"),
        F.count_if(code.between(400, 499)).alias("errors_4xx"),
        F.count_if(code >= 500).alias("errors_5xx"), *means,
    )
    points = {"latency_p50_ms": 0.5, "latency_p90_ms": 0.9, "latency_p99_ms": 0.99}
    latencies = exact_percentiles(df, group, latency, points)
    out = join_null_safe(counts, latencies, group)
    return out.withColumns(
        {p: F.coalesce(F.col(p) / 1000, F.lit(0.0)) for p in points}
        | {"error_rate": F.least(ratio(F.col("errors_4xx") + F.col("errors_5xx"), F.col("invocation_count")), F.lit(1.0))}
    )


def canary_health(metrics: DataFrame, latency_ms: float, error_rate: float, canary: str = "canary", current: str = "production", enough: int = 100) -> DataFrame:
    """Verdict and reasons from the canary's own limits and its distance to production."""

    def of(variant: str, column: str) -> Column:
        return F.max(F.when(F.col("variant_name") == variant, F.col(column)))

    m = metrics.agg(
        of(canary, "latency_p99_ms").alias("cl"), of(canary, "error_rate").alias("ce"),
        of(current, "latency_p99_ms").alias("pl"), of(current, "error_rate").alias("pe"), of(current, "invocation_count").alias("pn"),
    )
    cl, ce, pl, pe = (F.col(x) for x in ("cl", "ce", "pl", "pe"))
    comparable = F.col("pn") > enough
    slower = cl / F.greatest(pl, F.lit(1.0))
    percent = lambda x: F.format_string("%.2f%%", x * 100)
    reasons = non_null_items([
        F.when(cl > latency_ms, F.concat(F.lit("P99 latency "), F.format_string("%.1f", cl), F.lit(f"ms exceeds threshold {latency_ms:.1f}ms"))),
        F.when(ce > error_rate, F.concat(F.lit("Error rate "), percent(ce), F.lit(f" exceeds threshold {error_rate:.2%}"))),
        F.when(comparable & (slower > 2.0), F.concat(F.lit("Canary latency is "), F.format_string("%.1f", slower), F.lit("x worse than production"))),
        F.when(comparable & (ce - pe > 0.05), F.concat(F.lit("Canary error rate is "), percent(ce - pe), F.lit(" higher than production"))),
    ])
    return m.select(
        (F.size(reasons) > 0).alias("canary_unhealthy"),
        F.when(F.size(reasons) > 0, F.array_join(reasons, "; ")).otherwise("Healthy").alias("reason"),
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    k = df.agg(
        F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"), F.count_if(~a & ~p).alias("tn"), F.count_if(a & ~p).alias("fn")
    )
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return k.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + tn + fn), "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def keep_large_classes(df: DataFrame, label: str, minimum: int) -> DataFrame:
    """Rows of the classes with at least ``minimum`` rows; a semi join, no window over a class."""
    large = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= minimum).select(label)
    return df.join(large, label, "left_semi")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, missing, distinct and, for numbers, range and median."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    total = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(n).isNull()).alias(f"missing_{n}") for n in df.columns],
        *[F.min(c(n).cast("double")).alias(f"min_{n}") for n in numeric],
        *[F.max(c(n).cast("double")).alias(f"max_{n}") for n in numeric],
    )
    null = F.lit(None).cast("double")
    items = [
        F.struct(
            F.lit(n).alias("column_name"), F.col(f"missing_{n}").alias("missing"),
            (F.col(f"min_{n}") if n in numeric else null).alias("min_value"), (F.col(f"max_{n}") if n in numeric else null).alias("max_value"),
        )
        for n in df.columns
    ]
    wide = total.select("rows", F.explode(F.array(*items)).alias("i")).select("rows", "i.*")
    # distinct counts and medians per column, over (column, value) pairs: no wide expand, any cardinality
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), c(n).cast("string").alias("v"), (c(n).cast("double") if n in numeric else null).alias("x")) for n in df.columns])).alias("p")).select("p.*")
    seen = pairs.filter(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.lit(1).alias("one"))
    distinct = seen.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    medians = exact_percentiles(pairs, ["column_name"], "x", {"median": 0.5})
    return wide.join(distinct, "column_name", "left").join(medians, "column_name", "left").select(
        "column_name", "rows", "missing", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"), "min_value", "max_value", "median"
    )


def outliers_and_duplicates(df: DataFrame, column: str, duplicate_key: Sequence[str], other: str) -> DataFrame:
    """Quartiles, rows outside 1.5 x their distance, repeated keys and a correlation."""
    q = exact_percentiles(df, [], column, {"q1": 0.25, "q3": 0.75})
    bounds = q.select(F.struct("q1", "q3")).scalar()
    reach = (F.col("_q")["q3"] - F.col("_q")["q1"]) * 1.5
    rows = df.withColumn("_q", bounds)
    outside = (F.col(column) < F.col("_q")["q1"] - reach) | (F.col(column) > F.col("_q")["q3"] + reach)
    distinct = df.select(*duplicate_key).distinct().agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(
        F.max(F.col("_q")["q1"]).alias("q1"), F.max(F.col("_q")["q3"]).alias("q3"), F.count_if(outside).alias("outliers"),
        F.count(F.lit(1)).alias("_rows"), F.corr(other, column).alias("correlation"),
    ).withColumn("duplicate_pairs", F.col("_rows") - distinct.scalar()).drop("_rows")
