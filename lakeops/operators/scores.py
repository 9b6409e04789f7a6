"""Judging scored rows: rank metrics, curves, reports per class and errors per group.

All of them come from value counts: how many rows of each kind stand at each score. Running totals over the distinct scores
are taken range by range (``ranks``), so no window ever holds the whole table. Rows without a score or a label are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.exprs import ratio
from lakeops.operators import ranks
from lakeops.operators.timeline import join_null_safe
from lakeops.session import materialize


def score_counts(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """(group, score, positives, negatives) with both numbers below each score; written to a table."""
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    positive = (F.col(label) == 1).cast("bigint")
    counts = known.groupBy(*group, score).agg(F.sum(positive).alias("positives"), F.sum(1 - positive).alias("negatives"))
    return ranks.with_sums_below(materialize(counts, "score-counts"), group, score, ["positives", "negatives"])


def auc(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve and average precision per group, exact, with ties; null where one kind of label is missing."""
    counts = score_counts(df, label, score, group)
    p, n = F.col("positives"), F.col("negatives")
    # every positive beats the negatives below it and half of those at its score
    wins = F.sum(p * F.col("below_negatives") + p * n / 2)
    above_p = F.col("total_positives") - F.col("below_positives")
    above_n = F.col("total_negatives") - F.col("below_negatives")
    sums = counts.groupBy(*group).agg(
        F.max("total_positives").alias("positives"), F.max("total_negatives").alias("negatives"),
        wins.alias("_wins"), F.sum(p * above_p / (above_p + above_n)).alias("_precision"),
    )
    both = F.col("positives").cast("double") * F.col("negatives")
    return sums.withColumns({
        "auc_roc": ratio(F.col("_wins"), both, None), "average_precision": ratio(F.col("_precision"), F.col("positives"), None),
    }).drop("_wins", "_precision")


def pr_curve(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and false-positive rate of calling every row at or above a score positive, for each distinct score."""
    counts = score_counts(df, label, score, group)
    tp = F.col("total_positives") - F.col("below_positives")
    fp = F.col("total_negatives") - F.col("below_negatives")
    return counts.select(
        *group, F.col(score).alias("threshold"), tp.alias("tp"), fp.alias("fp"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("total_positives"), None).alias("recall"), ratio(fp, F.col("total_negatives"), None).alias("fpr"),
    )


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as label or prediction, and their support-weighted mean
    (``label`` is null there)."""
    cells = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("a"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(cells, "class-cells")
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0)
    support = cells.groupBy(F.col("a").alias("label")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    named = cells.filter("p IS NOT NULL").groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    each = support.join(named, "label", "full").na.fill(0, ["support", "tp", "predicted"])
    tp, s, k = F.col("tp"), F.col("support"), F.col("predicted")
    each = each.select("label", ratio(tp, k).alias("precision"), ratio(tp, s).alias("recall"), ratio(2 * tp, s + k).alias("f1"), "support")
    weighted = [ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in ("precision", "recall", "f1")]
    mean = each.agg(*weighted, F.sum("support").alias("support"))
    return each.unionByName(mean, allowMissingColumns=True)


def errors_by(df: DataFrame, truth: str, predicted: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows, RMSE, mean absolute error, bias and R2 per group, in one pass."""
    t, e = F.col(truth).cast("double"), F.col(predicted).cast("double") - F.col(truth).cast("double")
    known = df.filter(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
    sums = known.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"),
        F.sum(e * e).alias("_left"), F.var_pop(t).alias("_spread"),
    )
    return sums.withColumn("r2", F.when(F.col("_spread") > 0, 1 - F.col("_left") / (F.col("_spread") * F.col("rows")))).drop("_left", "_spread")


# --- profiles ---------------------------------------------------------------------


def _parts(df: DataFrame) -> tuple[list[str], list[str]]:
    kinds = dict(df.dtypes)
    numeric = [n for n, t in kinds.items() if t.split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")]
    return numeric, [n for n, t in kinds.items() if t == "string"]


def profile_columns(df: DataFrame, patterns: dict[str, str], quantiles: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), sketch: int = 200) -> DataFrame:
    """One row per column: rows, missing values, distinct values (sketched), and for numbers range, mean, deviation and
    sketched quantiles, for texts the lengths and how many hold personal data of each kind.

    The table is read once and every task sends one row of totals and sketches; no cell is shuffled. Distinct counts are
    within about 3 %, quantiles within about 1.3 % of the rows in rank (``sketch`` is the size of a quantile sketch).
    """
    numeric, texts = _parts(df)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(df.columns):
        aggs.append(F.count(F.col(n)).alias(f"n{i}"))
        x = F.col(n).cast("double")
        if n in numeric:
            x = F.when(~F.isnan(x), x)
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"sd{i}"), F.kll_sketch_agg_double(x, sketch).alias(f"q{i}")]
        if n in texts:
            aggs += [F.min(F.length(n)).alias(f"lo{i}"), F.max(F.length(n)).alias(f"hi{i}"), F.avg(F.length(n)).alias(f"mean{i}")]
            aggs += [F.count_if(F.col(n).rlike(p)).alias(f"p{i}_{k}") for k, p in patterns.items()]
        aggs.append(F.hll_sketch_agg(F.xxhash64(n) if n not in texts else F.col(n), F.lit(13)).alias(f"h{i}"))
    wide = df.agg(*aggs)
    none = F.lit(None).cast("double")

    def of(i: int, n: str) -> list:
        number, text = n in numeric, n in texts
        found = F.create_map(*[x for k in patterns for x in (F.lit(k), F.col(f"p{i}_{k}"))]) if text and patterns else F.lit(None).cast("map<string,bigint>")
        marks = F.array(*map(F.lit, quantiles))
        has = F.col(f"n{i}") > 0
        return [
            F.lit(n).alias("column_name"), F.col("rows").alias("rows"), (F.col("rows") - F.col(f"n{i}")).alias("missing"),
            F.when(has, F.hll_sketch_estimate(f"h{i}")).otherwise(F.lit(0)).cast("bigint").alias("distinct_about"),
            *((F.col(f"{c}{i}").cast("double") if number or text else none).alias(name) for c, name in (("lo", "low"), ("hi", "high"), ("mean", "mean"))),
            (F.col(f"sd{i}") if number else none).alias("deviation"),
            (F.when(has & F.col(f"lo{i}").isNotNull(), F.kll_sketch_get_quantile_double(f"q{i}", marks)) if number else F.lit(None)).cast("array<double>").alias("quantiles"),
            found.alias("personal"),
        ]

    rows = [F.struct(*of(i, n)) for i, n in enumerate(df.columns)]
    return wide.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(a, b, rows, correlation) for every pair of numeric columns, over the rows where both are set, in one pass."""
    names = list(columns or _parts(df)[0])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, rows bigint, correlation double")
    aggs = []
    for k, (a, b) in enumerate(pairs):
        aggs += [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{k}"), F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"n{k}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"n{k}").alias("rows"), F.col(f"r{k}").alias("correlation")) for k, (a, b) in enumerate(pairs)]
    return wide.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def duplicate_rows(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """(rows, duplicates): rows that repeat an earlier one in ``key`` (in all columns without it)."""
    counts = df.groupBy(*(key or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


# --- stored distinct counts -------------------------------------------------------


def daily_sketches(df: DataFrame, value: str, ts: str = "ts", group: Sequence[str] = (), size: int = 13) -> DataFrame:
    """(day, group, rows, sketch): a mergeable sketch of the distinct values of every day, to be kept as a table."""
    day = F.to_date(ts).alias("day")
    return df.filter(F.col(ts).isNotNull()).groupBy(day, *group).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(value).cast("string"), F.lit(size)).alias("sketch"))


def distinct_in_ranges(sketches: DataFrame, ranges: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Distinct values of any range of days from the stored sketches (about 1 % off); the raw rows are not read.

    ``ranges``: range_id, first_day, last_day. Each range meets the days inside it, so the work is days x ranges.
    """
    days = ranges.withColumn("day", F.explode(F.sequence("first_day", "last_day")))
    met = days.join(sketches, "day")
    return met.groupBy("range_id", *group).agg(
        F.sum("rows").alias("rows"), F.count_distinct("day").alias("days"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_about")
    )
