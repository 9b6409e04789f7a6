"""Filtered, ordered and paged reads, top-n lists and cohorts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.exprs import all_of, c, hash_fraction, words_of


def search(
    df: DataFrame,
    equals: dict[str, Any] | None = None,
    one_of: dict[str, Sequence] | None = None,
    at_least: dict[str, Any] | None = None,
    below: dict[str, Any] | None = None,
    where: Column | None = None,
    order: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Rows passing every filter that is set; then order, then limit.

    ``at_least``/``below`` make half-open ranges. A ``None`` value means "no filter".
    """
    conds: list[Column] = []
    conds += [F.col(k) == F.lit(v) for k, v in (equals or {}).items() if v is not None]
    conds += [F.col(k).isin(*v) for k, v in (one_of or {}).items() if v is not None]
    conds += [F.col(k) >= F.lit(v) for k, v in (at_least or {}).items() if v is not None]
    conds += [F.col(k) < F.lit(v) for k, v in (below or {}).items() if v is not None]
    out = df.filter(all_of(where, *conds))
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def contains_any_word(text: Column | str, words: str) -> Column:
    """True when the text has at least one of the blank-separated words, case ignored."""
    return F.arrays_overlap(words_of(text), F.array(*[F.lit(w) for w in words.lower().split()]))


def contains_ignore_case(text: Column | str, part: str | None) -> Column | None:
    return None if part is None else F.contains(F.lower(c(text)), F.lit(part.lower()))


def has_any_code(codes: Column | str, wanted: Sequence[str]) -> Column:
    """True when the arrays share an element; a missing array shares none."""
    return F.coalesce(F.arrays_overlap(c(codes), F.array(*[F.lit(w) for w in wanted])), F.lit(False))


def next_page(df: DataFrame, key: Sequence[str], size: int, after: Sequence[Any] | None = None) -> DataFrame:
    """Rows after a position in the total order of ``key``: cost does not grow with the page number."""
    if after is not None:
        later = F.lit(False)
        same = F.lit(True)
        for k, v in zip(key, after, strict=True):
            later = later | (same & (F.col(k) > F.lit(v)))
            same = same & (F.col(k) == F.lit(v))
        df = df.filter(later)
    return df.orderBy(*key).limit(size)


def newest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group; each task keeps only its own first ``n`` before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_no", F.row_number().over(w)).filter(F.col("_no") <= n).drop("_no")


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``; reduced on the map side, no sort."""
    row = F.struct(*[F.col(k) for k in df.columns])
    best = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    row = F.struct(*[F.col(k) for k in df.columns])
    best = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def upsert_latest(current: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins: a change replaces the stored row only when it is newer."""
    return latest_per_key(current.unionByName(changes, allowMissingColumns=True), key, order)


def replace_parts(stored: DataFrame, fresh: DataFrame, owner: str) -> DataFrame:
    """Drop every stored row of the owners present in ``fresh`` and add the fresh rows."""
    owners = fresh.select(owner).distinct()
    return stored.join(owners, owner, "left_anti").unionByName(fresh)


def balanced_cohort(
    df: DataFrame,
    key: str,
    codes: str,
    positive: Sequence[str],
    n: int,
    negative: str = "other",
    negative_codes: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """``n`` positives and ``n`` negatives in hash order, from one scan.

    Negatives never hold a positive code. ``negative``: ``none`` takes rows without any
    code, ``other`` rows without a positive code, ``codes`` rows with a given other code.
    """
    pos = has_any_code(codes, positive)
    neg = {
        "none": F.coalesce(F.size(codes), F.lit(0)) <= 0,
        "other": ~pos,
        "codes": has_any_code(codes, negative_codes) if negative_codes else F.lit(False),
    }[negative]
    labelled = df.filter(all_of(where)).withColumn("label", F.when(pos, "positive").when(neg & ~pos, "negative"))
    labelled = labelled.filter(F.col("label").isNotNull()).withColumn("_h", F.sha2(F.col(key).cast("string"), 256))
    return newest_per_group(labelled, ["label"], [F.col("_h"), F.col(key)], n).drop("_h")


def split_by_key(df: DataFrame, key: str, ratio: float = 0.8) -> DataFrame:
    """Mark rows ``train`` or ``validation``; all rows of a key fall on one side."""
    return df.withColumn("split", F.when(hash_fraction(key, "split") < ratio, "train").otherwise("validation"))


def expired(df: DataFrame, ttl: str, as_of: Column, grace_seconds: int = 86400) -> DataFrame:
    return df.filter(F.col(ttl).isNotNull() & (F.col(ttl) < as_of - grace_seconds))
