"""Exact ranks and percentiles without pulling a group into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.timeline import join_null_safe
from lakeops.session import materialize

#: Distinct values that one range holds.
PER_RANGE = 200_000


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per key and distinct value, without null values.

    Nulls are dropped after counting: a filter on a computed value would be copied below
    the projections that compute it.
    """
    return df.groupBy(*keys, value).agg(F.count(value).alias("_n")).filter(F.col("_n") > 0)


def _range_id(counts: DataFrame, value: str, ranges: int) -> DataFrame:
    """Tag every distinct value with one of ``ranges`` value ranges of similar size."""
    probs = [i / ranges for i in range(1, ranges)]
    cuts = counts.approxQuantile(value, probs, 1.0 / (4 * ranges)) if ranges > 1 else []
    splits = [-math.inf, *sorted(set(x for x in cuts if math.isfinite(x))), math.inf]
    if len(splits) < 3:
        # not a constant, or the joins by range below would have no key
        return counts.withColumn("_range", F.when(F.col(value).isNull(), 1).otherwise(0))
    tagged = Bucketizer(splits=splits, inputCol="_v", outputCol="_range", handleInvalid="keep").transform(
        counts.withColumn("_v", F.col(value).cast("double"))
    )
    return tagged.withColumn("_range", F.col("_range").cast("int")).drop("_v")


def with_sums_below(counts: DataFrame, keys: Sequence[str], value: str, names: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Add ``below_<name>`` (sum over smaller values) and ``total_<name>`` per key, for each of ``names``.

    ``counts`` has one row per key and distinct value and is read several times, so it should be a written table. Values
    are cut into ranges of about ``PER_RANGE`` rows of ``counts``, each range is summed up in its own group, and the totals
    of the lower ranges are added.
    """
    ranges = ranges or max(1, -(-counts.count() // PER_RANGE))
    if ranges == 1:  # few enough for one group per key
        whole = Window.partitionBy(*(keys or [F.lit(0)]))
        before = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        below = {f"below_{n}": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in names}
        return counts.withColumns(below | {f"total_{n}": F.sum(n).over(whole) for n in names})
    tagged = _range_id(counts, value, ranges)
    sums = tagged.groupBy(*keys, "_range").agg(*[F.sum(n).alias(f"_sum_{n}") for n in names])
    group = list(keys) or [F.lit(0)]
    lower = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = sums.select(
        *keys, "_range", *[F.coalesce(F.sum(f"_sum_{n}").over(lower), F.lit(0)).alias(f"_offset_{n}") for n in names],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"total_{n}") for n in names],
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    joined = join_null_safe(tagged, offsets, [*keys, "_range"])
    below = {f"below_{n}": F.col(f"_offset_{n}") + F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in names}
    return joined.withColumns(below).drop("_range", *[f"_offset_{n}" for n in names])


def with_rows_below(counts: DataFrame, keys: Sequence[str], value: str, n: str, ranges: int | None = None) -> DataFrame:
    """Add ``_below`` (rows with a smaller value) and ``_total`` (rows) per key; see ``with_sums_below``."""
    return with_sums_below(counts, keys, value, [n], ranges).withColumnsRenamed({f"below_{n}": "_below", f"total_{n}": "_total"})


def ranked_values(df: DataFrame, keys: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """Distinct values per key with ``_n``, ``_below`` and ``_total``; the counts are written once."""
    return with_rows_below(materialize(value_counts(df, keys, value), "value-counts"), keys, value, "_n", ranges)


def percentiles_of(ranked: DataFrame, keys: Sequence[str], value: str, points: dict[str, float]) -> DataFrame:
    """Interpolated percentiles from ranked values; ``points`` maps column name -> fraction."""
    aggs = []
    for name, p in points.items():
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            holds = (F.col("_below") <= at) & (at < F.col("_below") + F.col("_n"))
            aggs.append(F.max(F.when(holds, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
    found = ranked.groupBy(*keys).agg(*aggs, F.max("_total").alias("_total"))
    cols = []
    for name, p in points.items():
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return found.select(*keys, *cols)


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, points: dict[str, float], ranges: int | None = None) -> DataFrame:
    return percentiles_of(ranked_values(df, keys, value, ranges), keys, value, points)


def bracketed(df: DataFrame, value: str, fractions: Sequence[float], error: float = 0.001) -> DataFrame:
    """(value, _n): the values around each wanted rank with their counts, all others as one count per gap between them.

    A sketch gives two values for every fraction, whose ranks surely lie on both sides of the wanted one; only values
    between them are counted one by one. A gap is named by a number that sorts where its values do, so ranks stay exact.
    """
    x = df.select(F.col(value).cast("double").alias(value)).filter(F.col(value).isNotNull())
    probs = [min(max(p + side * 2 * error, 0.0), 1.0) for p in fractions for side in (-1, 1)]
    edges = x.approxQuantile(value, probs, error) if fractions else []
    pairs = []
    for i, p in enumerate(fractions):
        if not edges:
            break
        pairs.append((-math.inf if p <= 2 * error else edges[2 * i], math.nan if p >= 1 - 2 * error else edges[2 * i + 1]))
    if not pairs:
        return value_counts(x, [], value)
    v = F.col(value)
    # not-a-number is the largest value, so it stands for an open upper end
    wanted = reduce(or_, [(v >= F.lit(lo)) & (v <= F.lit(hi)) for lo, hi in pairs])
    gap = F.lit(-math.inf)
    for _, hi in sorted(pairs, key=lambda pair: (math.isnan(pair[1]), pair[1])):
        if not math.isnan(hi):
            gap = F.when(v > F.lit(hi), F.lit(math.nextafter(hi, math.inf))).otherwise(gap)
    return value_counts(x.withColumn(value, F.when(wanted, v).otherwise(gap)), [], value)


def percentile_values(df: DataFrame, value: str, fractions: Sequence[float], ranked: DataFrame | None = None) -> list[float]:
    """Percentiles of a whole column as plain numbers, one per fraction; the column is read twice."""
    names = {f"p{i}": p for i, p in enumerate(fractions)}
    if ranked is None:
        ranked = with_rows_below(materialize(bracketed(df, value, fractions), "brackets"), [], value, "_n")
    row = percentiles_of(ranked, [], value, names).first()
    return [None if row is None else row[n] for n in names]


def percent_rank(df: DataFrame, value: str, out: str, ranked: DataFrame | None = None) -> DataFrame:
    """(rank - 1) / (rows - 1) over the whole table; nulls rank first, like ``percent_rank``."""
    nulls = df.agg(F.count_if(F.col(value).isNull()).alias("_nulls"))
    known = (ranked_values(df, [], value) if ranked is None else ranked).select(value, "_below", "_total")
    joined = df.join(known, value, "left").withColumn("_missing", nulls.scalar())
    rows = F.col("_missing") + F.coalesce(F.col("_total"), F.lit(0))
    rank = F.when(F.col(value).isNull(), 0).otherwise(F.col("_below") + F.col("_missing"))
    return joined.withColumn(out, F.when(rows > 1, rank / (rows - 1)).otherwise(F.lit(0.0))).drop("_below", "_total", "_missing")
