"""The neighbour index without shuffles of vectors: what it skips must not change what it finds."""

import numpy as np
from pyspark.sql import functions as F

from lakeops.operators import ann, vectors
from lakeops.session import fresh_dir


def some(n, dims=16, seed=5):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((20, dims))[rng.integers(0, 20, n)] + 0.4 * rng.standard_normal((n, dims))).astype("float32")
    x[n // 2: n // 2 + n // 10] = x[0]  # many copies of one vector
    return x


def frame(spark, x):
    return spark.createDataFrame([(f"k{i:05d}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, v array<float>").repartition(5)


def test_nearest_centre_is_that_of_full_precision():
    x = some(2000).astype("float64")
    centres = vectors._unit(some(64, seed=6).astype("float64"))
    centres[40] = centres[3]  # equal ones by number
    centres[41] = vectors._unit((centres[5] + 1e-9)[None, :])[0]  # closer than single precision tells
    want = np.round(vectors._unit(x) @ centres.T, 12).argmax(axis=1)
    assert (ann._nearest(x, centres, 1)[:, 0] == want).all() and 40 not in want


def test_rows_without_direction(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", [0.0, 1.0]), ("b", [0.0, -1.0]), ("c", [0.0, 0.0]), ("d", []), ("e", None), ("f", [1.0, None]), ("g", [nan, 1.0]), ("h", [inf, 1.0]), ("i", [1.0, -inf]), (None, [1.0]), ("j", [None]), ("k", [-0.0])]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"id string, v array<{kind}>")
        assert sorted(r["id"] for r in ann.with_direction(df, "id", "v").collect()) == ["a", "b"]


def test_probes_need_no_shuffle_of_vectors(spark):
    x = some(600)
    folder = fresh_dir(spark, "t-near")
    index = ann.build(frame(spark, x), "id", "v", folder, k=5)
    rows, matrix, k = index.rows(spark), x[[0, 7, 300]].astype("float64"), 6
    got = ann._nearest_distinct(rows, "v", matrix, k)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "Exchange" in line and "v#" in line]
    cells = {tuple(np.float32(r["v"])): r["cell"] for r in rows.collect()}
    once = np.unique(x, axis=0)
    scores = np.round(vectors._unit(matrix) @ vectors._unit(once.astype("float64")).T, 12)
    for q in range(3):
        best = sorted(range(len(once)), key=lambda i, q=q: -scores[q, i])[:k]
        mine = sorted((r["score"], r["cell"]) for r in got.filter(F.col("q") == q).collect())
        assert mine == sorted((scores[q, i], cells[tuple(once[i])]) for i in best)


def test_queries_that_travel_find_what_a_shuffle_finds(spark, monkeypatch):
    x = some(500)
    df = frame(spark, x)
    index = ann.build(df, "id", "v", fresh_dir(spark, "t-few"), cells=12, k=5)
    asked = df.filter("id < 'k00040'").select(F.col("id").alias("q"), F.col("v").alias("vector"))
    asked = asked.unionByName(asked.filter("q = 'k00003'")).unionByName(spark.createDataFrame([("none", None)], asked.schema))
    monkeypatch.setattr(ann, "ROWS_PER_STEP", 7)
    few = ann.search(index, asked, "q", 4, probes=3)
    assert "Exchange hashpartitioning(cell" not in few._jdf.queryExecution().executedPlan().toString()
    found = {tuple(r) for r in few.collect()}
    monkeypatch.setattr(ann, "QUERIES_PER_TASK", 3)
    assert found == {tuple(r) for r in ann.search(index, asked, "q", 4, probes=3).collect()} and len(found) == 160


def test_texts_without_words_are_left_out(spark):
    rows = [(i, t) for i, t in enumerate(["a word", "é", "7", "", "  ", "— !?", None, "_", "Ⅳ", "Ⓐ"])]
    df = vectors.embed_hashed(spark.createDataFrame(rows, "i int, t string"), "t")
    assert sorted(r["i"] for r in df.collect()) == [0, 1, 2, 8]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("UDF(t") <= 1
