"""First request per key wins for a day; a failed request frees its key at once.

Whether a row is accepted depends on the last accepted row before it, so no window frame
says it. Keys with few rows are folded, one small array each. Larger keys become a chain
of "next row that could be accepted" pointers, and the accepted rows are the ones the
chain reaches from the first row, found by doubling the pointers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.timeline import with_slice
from lakeops.session import materialize

FOLD_ROWS = 10_000
_LAST = (1 << 63) - 1


def _fold(rows: DataFrame, ttl_us: int) -> DataFrame:
    item = F.struct("_t", "_id", "_failed")
    lists = rows.groupBy("_key").agg(F.array_sort(F.collect_list(item)).alias("_rows"))
    start = F.struct(
        F.lit(None).cast("bigint").alias("t"), F.lit(True).alias("free"), F.array().cast("array<bigint>").alias("ids")
    )

    def step(acc, x):
        take = acc["free"] | (x["_t"] - acc["t"] > ttl_us)
        return F.when(
            take, F.struct(x["_t"].alias("t"), x["_failed"].alias("free"), F.concat(acc["ids"], F.array(x["_id"])).alias("ids"))
        ).otherwise(acc)

    return lists.select(F.explode(F.aggregate("_rows", start, step)["ids"]).alias("_id"))


def _pointers(rows: DataFrame, ttl_us: int) -> DataFrame:
    """(row, next row that is accepted if this one was); found within slices of similar row counts."""
    own = rows.select("_key", F.col("_t").alias("at"), F.col("_id").alias("tie"), F.lit(1).alias("kind"), "_id")
    asks = rows.select(
        "_key", F.when(F.col("_failed"), F.col("_t")).otherwise(F.col("_t") + ttl_us).alias("at"),
        F.when(F.col("_failed"), F.col("_id")).otherwise(F.lit(_LAST)).alias("tie"), F.lit(0).alias("kind"), "_id",
    )
    both = with_slice(own.unionByName(asks).withColumn("_down", -F.col("kind")), ["_key"], ["at", "tie", "_down"]).drop("_down")
    mine = F.when(F.col("kind") == 1, F.struct("at", "tie"))
    firsts = both.groupBy("_key", "_slice").agg(F.min(mine).alias("_first"))
    later = Window.partitionBy("_key").orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("_key", "_slice", F.last("_first", ignorenulls=True).over(later).alias("_after"))
    inside = Window.partitionBy("_key", "_slice").orderBy(F.desc("at"), F.desc("tie"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    joined = both.join(firsts, ["_key", "_slice"])
    found = F.coalesce(F.last(mine, ignorenulls=True).over(inside), F.col("_after"))
    return joined.withColumn("_next", found["tie"]).filter((F.col("kind") == 0) & F.col("_next").isNotNull()).select("_id", "_next")


def _chase(rows: DataFrame, ttl_us: int) -> DataFrame:
    jump = materialize(_pointers(rows, ttl_us))
    reached = materialize(rows.groupBy("_key").agg(F.min(F.struct("_t", "_id")).alias("f")).select(F.col("f._id").alias("_id")))
    known = reached.count()
    while True:
        ahead = reached.join(jump, "_id").select(F.col("_next").alias("_id"))
        reached = materialize(reached.unionByName(ahead).distinct())
        now = reached.count()
        if now == known:
            return reached
        known = now
        onward = jump.select(F.col("_id").alias("_next"), F.col("_next").alias("_far"))
        jump = materialize(jump.join(onward, "_next").select("_id", F.col("_far").alias("_next")))


def accept_once(df: DataFrame, key: str, ts: str, row_id: str, failed=None, ttl_seconds: int = 86400, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Rows with ``accepted``; ``failed`` is a condition, ``row_id`` a unique bigint. Rows without a key share one key."""
    rows = df.select(
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("none")).alias("_key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"), F.col(row_id).cast("bigint").alias("_id"),
        (F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))).alias("_failed"),
    )
    ttl_us = ttl_seconds * 1_000_000
    large = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > fold_rows).select("_key")
    accepted = _fold(rows.join(large, "_key", "left_anti"), ttl_us)
    if not large.isEmpty():
        accepted = accepted.unionByName(_chase(rows.join(large, "_key", "left_semi"), ttl_us))
    marked = accepted.select(F.col("_id").alias(row_id), F.lit(True).alias("accepted"))
    return df.join(marked, row_id, "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))
