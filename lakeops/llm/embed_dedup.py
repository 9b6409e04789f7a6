"""Embedding near-duplicates by quantised tile products.

Vectors with the same label are dealt into blocks of bounded size, and every pair of blocks is one tile. In a tile the unit
vectors are rounded to int8; the product of the rounded tiles is exact, and the length of each vector's rounding error
bounds how far a true cosine can be from it. Pairs surely below the threshold are dropped, pairs surely above are links,
and only the others are worked out in full precision. A tile puts out one row per linked vector, its number of links and
the smallest vector it reaches within the tile, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import components, small, written

#: Vectors in a block; a tile holds two blocks.
BLOCK = 2048


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales and the length of each row's rounding error (with room for the error's own rounding)."""
    scale = np.abs(u).max(1) / 127
    q = np.rint(u / scale[:, None])
    error = np.sqrt(((u - q * scale[:, None]) ** 2).sum(1)) * (1 + 1e-9) + 1e-12
    return q.astype(np.int8), scale, error


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (unit rows) have a cosine of at least ``threshold``."""
    qa, sa, ea = quantised(a)
    qb, sb, eb = quantised(b)
    kind = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    about = (qa.astype(kind) @ qb.astype(kind).T).astype(np.float64)
    about *= sa[:, None]
    about *= sb[None, :]
    # |u.v - u'.v'| <= |u'||v - v'| + |u - u'||v| with |u'| <= 1 + |u - u'| and |v| = 1, up to rounding
    slack = (1 + ea)[:, None] * eb[None, :] + ea[:, None] * (1 + 1e-9) + 1e-9
    links = about - slack >= threshold
    i, j = np.nonzero((about + slack >= threshold) & ~links)
    for begin in range(0, len(i), 100_000):
        x, y = i[begin:begin + 100_000], j[begin:begin + 100_000]
        links[x, y] = (a[x] * b[y]).sum(1) >= threshold
    return links


def reach(links: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each row and each column reaches over the links of the tile."""
    root_a, root_b, none = ids_a.copy(), ids_b.copy(), np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(root_a, np.where(links, root_b[None, :], none).min(1))
        new_b = np.minimum(root_b, np.where(links, new_a[:, None], none).min(0))
        if (new_a == root_a).all() and (new_b == root_b).all():
            return root_a, root_b
        root_a, root_b = new_a, new_b


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept (vec_id = component_id).

    Vectors are compared only with those of an equal label that is not null and of equal length. A vector that is null,
    empty, zero or holds null or non-finite numbers links with nothing and is its own component. Equal vectors are compared
    once and counted as often as they occur; a null id never names a component of others, and its row is not kept.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    fine = F.col("label").isNotNull() & F.coalesce(
        F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False)
    )
    rows = rows.withColumn("node", F.when(fine, F.xxhash64(F.col("label").cast("string"), "v")))
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("label").cast("string").alias("label"), F.count("*").alias("many"), F.first("v").cast("array<double>").alias("v"))
    nodes = written(nodes.withColumn("size", F.size("v")), "vectors")
    groups = written(nodes.groupBy("label", "size").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "groups")
    dealt = nodes.join(small(groups, groups.count()), ["label", "size"]).withColumn("b", F.pmod("node", F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("label", "size", F.least("b", "other").alias("low"), F.greatest("b", "other").alias("high"), "b", "node", "many", "v")

    def tile(t: pa.Table) -> pa.Table:
        low, high = t.column("low")[0].as_py(), t.column("high")[0].as_py()
        node, many, b = (t.column(c).to_numpy() for c in ("node", "many", "b"))
        u = unit_rows(t.column("v").combine_chunks().flatten().to_numpy().reshape(len(node), -1))
        one, two = b == low, b == high
        links = tile_links(u[one], u[two], threshold)
        if low == high:
            np.fill_diagonal(links, False)
        root_a, root_b = reach(links, node[one], node[two])
        parts = [(node[one], links @ many[two], root_a)]
        if low != high:
            parts.append((node[two], many[one] @ links, root_b))
        ids, count, root = (np.concatenate(x) for x in zip(*parts, strict=True))
        linked = count > 0
        return pa.table({"node": ids[linked], "links": count[linked].astype(np.int64), "root": root[linked]})

    found = written(dealt.groupBy("label", "size", "low", "high").applyInArrow(lambda t: tile(t), "node long, links long, root long"), "tiles")
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = written(nodes.select("node", "many").join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(roots, "node", "left")
                     .select("node", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "counts")
    placed = written(rows.select("vec_id", "node").join(counts, "node", "left"), "placed")
    least = written(placed.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("component_id")), "least")
    return placed.join(least, "root", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
