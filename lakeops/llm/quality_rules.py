"""Quality rules as a learned decision list, with built-in functions only.

Every text is measured once: word, character, symbol, line and repetition counts, and shares made of them. The labelled rows
teach an ordered list of rules by sequential covering: a rule grows condition by condition (a statistic at or above, or
below, a threshold) on two thirds of the rows, always by the condition of the highest information gain; then its last
conditions are cut off as long as the remaining third likes it better; the rows it covers are set aside and the next rule
is grown. A rule that is not precise enough on that third ends the list. Rules are plain SQL conditions, and the verdict is
one conditional expression over the measured columns.

Counts per (statistic, threshold) come from one small aggregation per step; only they reach the driver. Thresholds are
quantiles of the labelled rows. At most about ``rows`` labelled rows are used, chosen by a hash of the row; all texts are
measured.

Null and empty texts have no words and fail the base rules. Very long texts are measured whole, by sorting their windows.
Null labels teach nothing; an id labelled both ways counts as poor; a document whose id repeats counts once per row. Equal
gains go to the earlier statistic and the lower threshold. Without labels of both kinds only the base rules hold. Empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import fold, row_key, written

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Statistics that rules may use, as SQL over the measured columns; a share without a base is 0.
STATISTICS = {
    "symbol_share": "n_symbols / n_chars",
    "capital_share": "n_capitals / n_chars",
    "mark_share": "n_marks / n_chars",
    "digit_share": "n_digits / n_chars",
    "word_length": "word_chars / n_words",
    "distinct_share": "n_distinct / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "words_a_line": "n_words / n_lines",
}
#: Quantiles of each statistic that serve as thresholds.
QUANTILES = 48
LEAST_WORDS, REPEAT_PERCENT = 50, 50


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the array."""
    def covered(q: Column) -> Column:
        steps = F.aggregate(F.sequence(F.lit(1), F.size(q) - 1), F.lit(3), lambda total, k: total + F.least(F.lit(3), F.get(q, k) - F.get(q, k - 1)))
        return F.when(F.size(q) == 0, 0).when(F.size(q) == 1, 3).otherwise(steps)

    def places(s: Column) -> Column:
        def again(j: Column) -> Column:
            gram = F.get(s, j)["gram"]
            return F.coalesce(gram == F.get(s, j - 1)["gram"], F.lit(False)) | F.coalesce(gram == F.get(s, j + 1)["gram"], F.lit(False))

        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(s) - 1), again), lambda j: F.get(s, j)["at"]))

    def count(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("gram"), i.alias("at"))
        )
        return F.when(F.size(w) < 4, 0).otherwise(_let(_let(F.sort_array(windows), places), covered))

    return _let(words, count)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row_key, uid, counts of the text) of every row, written to a table."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split(text, _SPACE, -1), lambda x: x != "")
    counts = _let(words, lambda w: F.struct(F.size(w).alias("n_words"), F.size(F.array_distinct(w)).alias("n_distinct"), repeated_words(w).alias("n_repeat_words")))
    numbers = {
        "n_chars": F.length(text), "word_chars": without(_SPACE), "n_symbols": F.length(text) - F.length(F.translate(text, _SYMBOLS, "")),
        "n_capitals": F.length(text) - F.length(F.translate(text, _CAPITALS, "")), "n_marks": F.length(text) - F.length(F.translate(text, "!?", "")),
        "n_digits": F.length(text) - F.length(F.translate(text, "0123456789", "")),
    }
    of_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    rows = docs.select(
        F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), F.monotonically_increasing_id().alias("uid"),
        counts.alias("w"), of_lines.alias("l"), *(c.alias(n) for n, c in numbers.items()),
    )
    return written(rows.select(
        "id", "row_key", "uid", *(F.col(c).cast("long").alias(c.split(".")[1]) for c in ("w.n_words", "w.n_distinct", "w.n_repeat_words", "l.n_lines", "l.n_dup_lines")),
        *(F.col(n).cast("long").alias(n) for n in numbers),
    ), "measured")


def with_statistics(rows: DataFrame) -> DataFrame:
    shares = [F.expr(f"coalesce(try_divide({sql.replace(' / ', ', ')}), 0D)").alias(name) for name, sql in STATISTICS.items()]
    return rows.select("*", *shares)


# ---------------------------------------------------------------- rules


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool  # at or above the threshold, else below it
    threshold: float

    @property
    def sql(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def rule_sql(rule: Rule) -> str:
    return " AND ".join(c.sql for c in rule)


def first_rule(rules: list[Rule]) -> Column:
    """Number of the first rule that fits a row of ``with_statistics``, from 1; null if none does."""
    found = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        found = F.when(F.expr(rule_sql(rules[k - 1])), F.lit(k)).otherwise(found)
    return found


def gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information that a condition wins over the poor rows it keeps."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def best_condition(counts: dict[tuple[int, int], tuple[int, int]], thresholds: list[list[float]]) -> tuple[float, int, bool, int, int, int]:
    """(gain, statistic, above, threshold number, poor, good) of the best condition; ``counts``: (poor, good) per (statistic, bin)."""
    best = (0.0, 0, False, 0, 0, 0)
    p0 = sum(p for (s, _), (p, _) in counts.items() if s == 0)
    n0 = sum(n for (s, _), (_, n) in counts.items() if s == 0)
    for s, cuts in enumerate(thresholds):
        below_p = below_n = 0
        for k in range(len(cuts)):  # bin k holds the values from cuts[k-1] up to below cuts[k]
            p, n = counts.get((s, k), (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, poor, good in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
                won = gain(poor, good, p0, n0)
                if won > best[0] + 1e-9:
                    best = (won, s, above, k, poor, good)
    return best


def learn_rules(labelled: DataFrame, most_rules: int = 12, most_conditions: int = 4, precision: float = 0.95) -> list[Rule]:
    """The decision list for rows of ``with_statistics`` with columns ``poor`` (boolean) and ``part`` (0: prune, else grow)."""
    names = list(STATISTICS)
    asked = [k / QUANTILES for k in range(1, QUANTILES)]
    cols = [F.percentile(F.when(which, F.col(n)), F.array(*map(F.lit, asked))).alias(f"{n}_{i}") for n in names for i, which in enumerate((F.col("poor"), ~F.col("poor")))]
    edges = labelled.agg(*cols).first()
    thresholds = [sorted({float(x) for i in (0, 1) for x in edges[f"{n}_{i}"] or ()}) for n in names]

    def bin_of(name: str, cuts: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: t <= F.col(name))) if cuts else F.lit(0)

    bins = F.array(*(bin_of(n, cuts) for n, cuts in zip(names, thresholds, strict=True)))
    rows = written(labelled.select("poor", (F.col("part") == 0).alias("judge"), bins.alias("bins")), "binned")

    def fits(parts: list[tuple[int, bool, int]]) -> Column:
        out = F.lit(True)
        for s, above, k in parts:
            out = out & ((F.col("bins")[s] > k) if above else (F.col("bins")[s] <= k))
        return out

    poor, good = F.sum(F.col("poor").cast("long")), F.sum((~F.col("poor")).cast("long"))
    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < most_rules:
        parts: list[tuple[int, bool, int]] = []
        while len(parts) < most_conditions:
            each = rows.where(~F.col("judge") & left & fits(parts)).select("poor", F.posexplode("bins").alias("s", "bin"))
            counts = {(r.s, r.bin): (r.p, r.n) for r in each.groupBy("s", "bin").agg(poor.alias("p"), good.alias("n")).collect()}
            won, s, above, k, _, n = best_condition(counts, thresholds)
            if won <= 0:
                break
            parts.append((s, above, k))
            if not n:
                break
        if not parts:
            break
        sums = [x for m in range(1, len(parts) + 1) for x in (F.sum((fits(parts[:m]) & F.col("poor")).cast("long")), F.sum((fits(parts[:m]) & ~F.col("poor")).cast("long")))]
        judged = [v or 0 for v in rows.where(F.col("judge") & left).agg(*(x.alias(f"c{i}") for i, x in enumerate(sums))).first()]
        scores = [((p - n) / (p + n) if p + n else -1.0, m, p, n) for m, (p, n) in enumerate(zip(judged[::2], judged[1::2], strict=True), 1)]
        worth, m, p, n = max(scores, key=lambda x: (x[0], -x[1]))
        if not p or p < precision * (p + n):
            break
        rules.append(tuple(Condition(names[s], above, thresholds[s][k]) for s, above, k in parts[:m]))
        left = left & ~fits(parts[:m])
    return rules


def labelled_rows(rows: DataFrame, labels: DataFrame, most: int, label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """At most about ``most`` of the measured rows that have a label and are not held out, with ``poor`` and ``part``."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id).alias("id")).agg((F.min(label_col) == 0).alias("poor"))
    found = with_statistics(rows).where(fold("id", 4) != 2).join(known, "id")
    found = found.withColumn("part", F.pmod(F.xxhash64("row_key", "uid"), F.lit(3)))
    n = found.count()
    return found if n <= most else found.where(F.pmod(F.xxhash64(F.lit(7), "row_key", "uid"), F.lit(n)) < most)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, rows: int = 50_000, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """(id, row_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule) of every row.

    ``rule`` says in SQL which learned rule dropped the row. ``rows`` bounds the labelled rows that are learned from.
    """
    all_rows = measured(docs, id_col, text_col)
    rules = learn_rules(labelled_rows(all_rows, labels, rows), **params)
    fired = with_statistics(all_rows).select("*", first_rule(rules).alias("fired"))
    texts = F.array(*(F.lit(rule_sql(r)) for r in rules)) if rules else F.array().cast("array<string>")
    return fired.select(
        F.col("id").alias(id_col), "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & F.col("fired").isNull()).alias("kept"), F.get(texts, F.col("fired") - 1).alias("rule"),
    )


def kept_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Rows of ``docs`` that the base rules and the learned list keep."""
    dropped = quality_rules(docs, labels, id_col=id_col, text_col=text_col, **params).where("not kept").select(F.col("row_key").alias("_key")).distinct()
    return docs.withColumn("_key", row_key(id_col, text_col)).join(dropped, "_key", "left_anti").drop("_key")
