"""Amount bins from percentile, equal-frequency or given edges, and reference lookups."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import fixed
from lakeops.operators.ranks import percentile_values


def handle_negatives(df: DataFrame, column: str, how: str) -> DataFrame:
    """absolute | separate (flag and absolute) | drop | error (raise when any is found) | keep."""
    x = F.col(column)
    if how == "absolute":
        return df.withColumns({f"{column}_original": x, column: F.abs(x)})
    if how == "separate":
        return df.withColumns({"is_negative_amount": F.coalesce(x < 0, F.lit(False)), column: F.abs(x)})
    if how == "drop":
        return df.filter((x >= 0) | x.isNull())
    if how == "error":
        checked = F.when(x < 0, F.raise_error(F.lit(f"negative value in {column}")).cast("double")).otherwise(x)
        return df.withColumn(column, checked)
    return df


def _with_infinite_ends(edges: Sequence[float], pad: bool) -> list[float]:
    inner = sorted(set(edges))
    if pad or len(inner) < 2:
        return [-math.inf, *[e for e in inner if math.isfinite(e)], math.inf]
    return [-math.inf, *inner[1:-1], math.inf]


def label_of(index: Column, labels: Sequence[str], bins: int) -> Column:
    """Label of a bin index; extra bins are named ``bin_i``, missing values ``unknown``."""
    names = [*labels, *[f"bin_{i}" for i in range(len(labels), bins)]][:bins]
    return F.coalesce(F.get(F.array(*[F.lit(n) for n in names]), index.cast("int")), F.lit("unknown"))


def apply_edges(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str] | None) -> DataFrame:
    idx = f"{column}_bin_idx"
    binned = Bucketizer(splits=list(edges), inputCol=column, outputCol=idx, handleInvalid="keep").transform(df)
    bins = len(edges) - 1
    label = label_of(F.col(idx), labels, bins) if labels else F.col(idx).cast("int")
    return binned.withColumns({f"{column}_bin": label, f"{column}_bin_encoded": F.col(idx).cast("int")})


def percentile_bins(
    df: DataFrame,
    column: str,
    percentiles: Sequence[float] = fixed.AMOUNT_PERCENTILES,
    labels: Sequence[str] | None = fixed.AMOUNT_LABELS,
    negatives: str = "absolute",
    pad_edges: bool = False,
    edges_from: DataFrame | None = None,
) -> DataFrame:
    """Bins between exact percentiles of the column, taken from ``edges_from`` when given.

    The outer edges are replaced by infinity, so eight labels name eight bins;
    ``pad_edges`` puts infinity outside them instead (two more bins).
    """
    ready = handle_negatives(df, column, negatives)
    source = ready if edges_from is None else handle_negatives(edges_from, column, negatives)
    edges = [e for e in percentile_values(source.select(column), column, [p / 100 for p in percentiles]) if e is not None]
    if len(set(edges)) < 2:
        edges = [-math.inf, 0.0, 100.0, 1000.0, math.inf]
    return apply_edges(ready, column, _with_infinite_ends(edges, pad_edges), labels)


def quantile_bins(df: DataFrame, column: str, bins: int = 8, labels: Sequence[str] | None = None, negatives: str = "absolute") -> DataFrame:
    """Bins of equal row counts."""
    return percentile_bins(df, column, [100 * i / bins for i in range(bins + 1)], labels, negatives)


def custom_bins(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str] | None = None, negatives: str = "absolute") -> DataFrame:
    ready = handle_negatives(df, column, negatives)
    return apply_edges(ready, column, _with_infinite_ends(edges, pad=True), labels)


MERCHANT_SCHEMA = (
    "mcc string, merchant_category string, merchant_category_id int, merchant_risk_level string, "
    "merchant_risk_score double, merchant_parent_category string, is_cash_equivalent boolean"
)


def merchant_categories(spark, path: str | None = None) -> DataFrame:
    """Category table from a JSON-lines file, or the built-in one when no file is given."""
    if path:
        return spark.read.schema(MERCHANT_SCHEMA).json(path)
    rows = ", ".join("(" + ", ".join(str(v).lower() if isinstance(v, bool) else repr(v) for v in row) + ")" for row in fixed.MERCHANT_CATEGORIES)
    fields = [f.strip().split() for f in MERCHANT_SCHEMA.split(",")]
    # a local relation: Spark knows that it is small, so the fact table is not shuffled for it
    named = ", ".join(f"CAST(col{i + 1} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields))
    return spark.sql(f"SELECT {named} FROM VALUES {rows}")


def encode_merchants(df: DataFrame, mcc: str, categories: DataFrame) -> DataFrame:
    """Left lookup; unknown and missing codes get the default row. Join strategy by size."""
    looked_up = [n for n in categories.columns if n != "mcc"]
    joined = df.join(categories, df[mcc] == categories["mcc"], "left").drop(categories["mcc"])
    filled = {n: F.coalesce(n, F.lit(d)) for n, d in zip(looked_up, fixed.UNKNOWN_CATEGORY, strict=True)}
    level = F.col("merchant_risk_level")
    ordinal = F.coalesce(
        *[F.when(level == name, F.lit(o)) for name, o in fixed.RISK_ORDINALS.items()], F.lit(fixed.UNKNOWN_RISK_ORDINAL)
    )
    return joined.withColumns(filled).withColumn("merchant_risk_encoded", ordinal)


def unknown_keys(df: DataFrame, column: str, reference: DataFrame, ref_column: str) -> DataFrame:
    """Values absent from the reference with their counts, most frequent first; null is one of them.

    Counting comes first, so only distinct values reach the anti join.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = reference.select(F.col(ref_column).alias("_known"))
    return counts.join(known, F.col(column) == F.col("_known"), "left_anti").orderBy(F.desc("n"), F.asc_nulls_last(column))
