"""The stored neighbour index, the full scan and the hashed search against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.operators import ann, vectors
from lakeops.session import fresh_dir

FIELDS = "vec_id bigint, embedding array<float>, cells int"


@pytest.fixture(scope="module")
def points():
    """Vectors around sixty directions, some of them equal."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16))
    x = centres[rng.integers(0, 60, 3000)] + 0.35 * rng.standard_normal((3000, 16))
    x[100:120] = x[0]
    return x.astype("float32")


@pytest.fixture(scope="module")
def table(spark, points):
    rows = [(i, [float(v) for v in x], 0) for i, x in enumerate(points)]
    odd = [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (None, [1.0] * 16, 0), (9003, [None] * 16, 0)]
    return spark.createDataFrame(rows + odd, FIELDS)


def truth(points, asked, k):
    unit = points.astype("float64") / np.linalg.norm(points.astype("float64"), axis=1, keepdims=True)
    scores = np.round(unit[asked] @ unit.T, 12)
    return {(int(q), int(i)) for q, s in zip(asked, scores, strict=True) for i in np.lexsort((np.arange(len(s)), -s))[:k]}


def test_index_finds_and_spares(spark, table, points):
    folder = fresh_dir(spark, "t-ivf")
    built = ann.build(table, "vec_id", "embedding", folder, recall=0.95, k=10)
    assert built.rows(spark).count() == 3000  # every row with a direction
    index = ann.open_index(spark, folder, "vec_id", "embedding")
    assert index.probes == built.probes and np.allclose(index.centres, built.centres)
    asked = np.arange(0, 3000, 20)
    queries = table.filter("vec_id % 20 = 0 AND vec_id < 3000").select(F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    got = {(r["q"], r["vec_id"]) for r in ann.search(index, queries, "q", 10).collect()}
    want = truth(points, asked, 10)
    assert len(got & want) >= 0.9 * len(want)
    pairs = ann.scored_pairs(index, queries, "q").first()
    assert pairs["all_pairs"] == 3000 * 150 and pairs["pairs"] < pairs["all_pairs"] / 10
    everything = ann.search(index, queries, "q", 10, probes=len(index.centres))
    assert {(r["q"], r["vec_id"]) for r in everything.collect()} == want


def test_searches_of_split_cells_agree(spark, table, points, monkeypatch):
    monkeypatch.setattr(ann, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(ann, "QUERIES_PER_TASK", 3)
    index = ann.build(table.filter("vec_id < 400"), "vec_id", "embedding", fresh_dir(spark, "t-ivf"), cells=3)
    queries = table.filter("vec_id < 40").select(F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    got = {(r["q"], r["vec_id"]) for r in ann.search(index, queries, "q", 5, probes=3).collect()}
    assert got == truth(points[:400], np.arange(40), 5)
    with pytest.raises(ValueError, match="no vector"):
        ann.build(table.filter("vec_id >= 9000"), "vec_id", "embedding", fresh_dir(spark, "t-ivf"))


def test_scan_keeps_ties_by_id(spark, table, points):
    queries = table.filter("vec_id IN (0, 7)").select(F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    good = ann.with_direction(table, "vec_id", "embedding").repartition(3)
    got = {(r["q"], r["vec_id"]) for r in vectors.knn_exact(good, queries, "vec_id", "embedding", "q", 6).collect()}
    assert got == truth(points, np.array([0, 7]), 6)


def test_hashed_search_scores_a_part(spark, table, points):
    good = ann.with_direction(table, "vec_id", "embedding")
    queries = good.filter("vec_id % 30 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    asked = np.arange(0, 3000, 30)
    got = {(r["q"], r["vec_id"]) for r in vectors.knn_lsh(good, queries, "vec_id", "embedding", "q", 10).collect()}
    want = truth(points, asked, 10)
    assert len(got & want) >= 0.8 * len(want)
    assert vectors.lsh_pairs(good, queries, "vec_id", "embedding", "q").count() < 3000 * 100 / 4


def test_hashed_search_shuffles_no_pairs(spark, table):
    good = table.filter("vec_id < 500")
    queries = good.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("vector"))
    found = vectors.knn_lsh(good, queries, "vec_id", "embedding", "q", 5)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    pairs = vectors.lsh_pairs(good, queries, "vec_id", "embedding", "q")
    assert pairs.count() == pairs.select("q", "vec_id").distinct().count()
    assert pairs.count() == vectors.lsh_pair_counts(good, queries, "vec_id", "embedding", "q").agg(F.sum("pairs")).first()[0]
    small = vectors.knn_lsh(good, queries, "vec_id", "embedding", "q", 5, block=3)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in small.collect()}
