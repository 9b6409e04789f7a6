"""Row anomaly scores, sequence features and an isolation forest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.exprs import epoch_seconds, hash_fraction
from lakeops.operators import ranks
from lakeops.operators import timeline as tl
from lakeops.session import materialize


def with_row_deviation(df: DataFrame, features: Sequence[str], out: str) -> DataFrame:
    """Add minus the largest z-score of a value among the values of its own row.

    Written as plain arithmetic over the named columns, so it compiles into the scan stage.
    """
    n = float(len(features))
    values = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    mean = F.col("_row_mean")
    squares = [(v - mean) * (v - mean) for v in values]
    return (
        df.withColumn("_row_mean", reduce(add, values) / n)
        .withColumn("_row_std", F.sqrt(reduce(add, squares) / n) + 1e-10)
        .withColumn(out, -F.greatest(*[F.abs(v - mean) / F.col("_row_std") for v in values]))
        .drop("_row_mean", "_row_std")
    )


def row_anomaly(df: DataFrame, features: Sequence[str], contamination: float = 0.01, digits: int | None = None) -> DataFrame:
    """Score (lower is stranger), flag of the lowest ``contamination`` share, percentile 0..100; scores rounded if asked."""
    if len(features) < 2:
        return df.withColumns({"anomaly_score": F.lit(0.0), "is_anomaly": F.lit(False), "anomaly_percentile": F.lit(0.0)})
    scored = with_row_deviation(df, features, "anomaly_score")
    if digits is not None:
        scored = scored.withColumn("anomaly_score", F.round("anomaly_score", digits))
    # one narrow table of distinct scores serves both the threshold and the percentiles
    ranked = materialize(ranks.ranked_values(scored.select("anomaly_score"), [], "anomaly_score"), "score-ranks")
    (limit,) = ranks.percentile_values(scored, "anomaly_score", [contamination], ranked)
    placed = ranks.percent_rank(scored, "anomaly_score", "anomaly_percentile", ranked)
    return placed.withColumns(
        {"anomaly_percentile": F.col("anomaly_percentile") * 100, "is_anomaly": F.col("anomaly_score") <= F.lit(limit)}
    )


def sequence_features(df: DataFrame, key: Sequence[str], order: Sequence[str], amount: str, history: int = 100, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Hours since the previous row, row number, deviation from the mean of the last ``history`` rows."""
    carry = {order[0]: "_prev_ts"}

    def plain(d: DataFrame) -> DataFrame:
        return tl.previous_plain(tl.numbered_mean_plain(d, key, order, amount, history, "_mean", "transaction_sequence"), key, order, carry)

    def sliced(d: DataFrame) -> DataFrame:
        return tl.previous_sliced(tl.numbered_mean_sliced(d, key, order, amount, history, "_mean", "transaction_sequence"), key, order, carry)

    moved = tl.by_heat(df, key, plain, sliced, floor)
    gap = (epoch_seconds(order[0]) - epoch_seconds("_prev_ts")) / F.lit(3600.0)
    deviation = F.when(F.col("_mean") > 0, (F.col(amount) - F.col("_mean")) / F.col("_mean")).otherwise(F.lit(0.0))
    return moved.withColumns(
        {"time_since_last_txn": F.coalesce(gap, F.lit(0.0)), "amount_deviation": deviation}
    ).drop("_prev_ts", "_mean")


# --- isolation forest -------------------------------------------------------------

TREE_SCHEMA = "tree int, node int, feature int, cut double, size double"


def _grow(x: np.ndarray, rng: np.random.Generator, depth_limit: int) -> list[tuple]:
    nodes, todo = [], [(1, x, 0)]
    while todo:
        node, part, depth = todo.pop()
        spread = part.max(axis=0) - part.min(axis=0)
        open_cols = np.flatnonzero(spread > 0)
        if depth >= depth_limit or len(part) <= 1 or len(open_cols) == 0:
            nodes.append((node, -1, 0.0, float(len(part))))
            continue
        f = int(rng.choice(open_cols))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        left = part[:, f] < cut
        nodes.append((node, f, cut, float(len(part))))
        todo += [(2 * node, part[left], depth + 1), (2 * node + 1, part[~left], depth + 1)]
    return nodes


def _average_path(n: np.ndarray | float) -> np.ndarray:
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def isolation_forest(df: DataFrame, key: str, features: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """Isolation scores in (0, 1], higher is stranger.

    Each tree sees the ``sample`` rows with the smallest hash for that tree: a bounded
    group, found with a per-tree top-k. The forest (trees x 2 x sample nodes at most) is
    small whatever the table size and travels to the tasks as a broadcast.
    """
    spark = df.sparkSession
    cols = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    rows = df.select(F.col(key).alias("_id"), F.array(*cols).alias("_x"))
    n = rows.count()
    # oversample each tree a little by hash, then keep exactly the first `sample` per tree
    share = min(1.0, 4.0 * sample / max(n, 1))
    picks = F.filter(
        F.transform(F.array(*[F.lit(t) for t in range(trees)]), lambda t: F.struct(t.alias("tree"), F.xxhash64("_id", t, F.lit(seed)).alias("h"))),
        lambda s: (F.pmod(s["h"], F.lit(1 << 30)) / float(1 << 30)) < share,
    )
    drawn = rows.select("_id", "_x", F.explode(picks).alias("_p")).select("_x", "_id", "_p.tree", "_p.h")
    order = Window.partitionBy("tree").orderBy("h", "_id")
    sampled = drawn.withColumn("_no", F.row_number().over(order)).filter(F.col("_no") <= sample)
    depth_limit = int(np.ceil(np.log2(max(sample, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.vstack(pdf.sort_values("_no")["_x"].to_numpy())
        nodes = _grow(x, np.random.default_rng(seed + tree), depth_limit)
        return pd.DataFrame([(tree, *node) for node in nodes], columns=["tree", "node", "feature", "cut", "size"])

    forest = sampled.groupBy("tree").applyInPandas(grow, TREE_SCHEMA).toPandas()
    grown = []
    for _, t in forest.groupby("tree"):
        size = int(t["node"].max()) + 1
        feature, cut, count = np.full(size, -1), np.zeros(size), np.zeros(size)
        feature[t["node"]], cut[t["node"]], count[t["node"]] = t["feature"], t["cut"], t["size"]
        grown.append((feature, cut, count))
    model = spark.sparkContext.broadcast(grown)
    norm = float(_average_path(min(sample, n)))

    def score(batches):
        for pdf in batches:
            x = np.vstack(pdf["_x"].to_numpy()) if len(pdf) else np.zeros((0, len(features)))
            total = np.zeros(len(x))
            for feature, cut, count in model.value:
                node, depth = np.ones(len(x), dtype=int), np.zeros(len(x))
                for _ in range(depth_limit):
                    f = feature[node]
                    inner = f >= 0
                    right = x[np.arange(len(x)), np.maximum(f, 0)] >= cut[node]
                    node = np.where(inner, 2 * node + right, node)
                    depth += inner
                total += depth + _average_path(count[node])
            yield pd.DataFrame({key: pdf["_id"], "isolation_score": np.power(2.0, -total / len(model.value) / max(norm, 1e-9))})

    key_type = dict(df.dtypes)[key]
    return rows.mapInPandas(score, f"`{key}` {key_type}, isolation_score double")


def pseudo_random_split(df: DataFrame, key: str, fraction: float, seed: str = "split") -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of ``key``: all rows of a key land on the same side."""
    low = hash_fraction(key, seed) < fraction
    return df.filter(low), df.filter(~low)
