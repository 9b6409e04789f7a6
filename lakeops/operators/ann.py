"""A stored index for nearest neighbours by cosine: an inverted file over cells of similar vectors.

Cell centres come from k-means over a bounded, documented sample; every vector with a direction goes into the cell of its
nearest centre, and the rows are stored in one folder per cell. A search reads only the folders of the cells that its
queries probe and scores what is in them exactly. How many cells a query probes is measured when the index is built: for a
few sampled queries the true neighbours are found by a full scan, and the probes are as many as it takes to meet the asked
share of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.operators import vectors
from lakeops.session import materialize

#: Rows that centres are learned from, queries that probes are measured with, and the most cells. Every row is compared with
#: every centre, so with this limit the work of building grows as the rows do.
SAMPLE_ROWS, MEASURED, MOST_CELLS = 50_000, 200, 1_024
#: Rows and queries that one task compares.
ROWS_PER_TASK, QUERIES_PER_TASK = 50_000, 2_048
#: Rows that a task compares at once with the queries that it was sent.
ROWS_PER_STEP = 1_024


@dataclass(frozen=True)
class Index:
    """A stored index: ``rows`` (key, vector, cell) by cell folder and ``about`` (centres, probes)."""

    folder: str
    key: str
    vector: str
    probes: int
    centres: np.ndarray

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/rows")


def _nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each vector, nearest first; equal ones by number."""
    unit = vectors._unit(x)
    if n > 1:
        return np.argsort(-np.round(unit @ centres.T, 12), axis=1, kind="stable")[:, :n]
    # single precision decides wherever one centre leads by more than its error; the others are compared in full
    rough = unit.astype("float32") @ centres.T.astype("float32")
    cell = rough.argmax(axis=1)
    slack = (centres.shape[1] + 4) * float(np.finfo("float32").eps)
    doubt = np.flatnonzero(np.count_nonzero(rough >= rough.max(axis=1, keepdims=True) - slack, axis=1) > 1)
    if len(doubt):
        cell[doubt] = np.round(unit[doubt] @ centres.T, 12).argmax(axis=1)
    return cell[:, None]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype("float64")


def _columns(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix."""
    offsets = column.offsets.to_numpy()
    width = int(offsets[1] - offsets[0]) if len(column) else 0
    if column.null_count or (np.diff(offsets) != width).any():
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), width)


def _probed(df: DataFrame, names: list[str], vector: str, centres: np.ndarray, n: int) -> DataFrame:
    """Rows with the numbers of their ``n`` nearest cells, nearest first (``cells``)."""
    shared = df.sparkSession.sparkContext.broadcast(centres)
    step = max(1, vectors.SCORES // len(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, step) for batch in batches for at in range(0, batch.num_rows, step)):
            nearest = _nearest(_columns(part.column(part.schema.get_field_index(vector))), shared.value, n).astype("int32")
            cells = pa.ListArray.from_arrays(np.arange(0, nearest.size + 1, nearest.shape[1], dtype="int32"), nearest.ravel())
            yield pa.RecordBatch.from_arrays([*part.columns, cells], names=[*part.schema.names, "cells"])

    fields = ", ".join(f"`{n}` {t}" for n, t in df.select(*names).dtypes)
    return df.select(*names).mapInArrow(run, f"{fields}, cells array<int>")


def with_direction(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows whose key is set and whose vector holds finite numbers, not all of them zero; no others can be near anything."""
    number = df.schema[vector].dataType.elementType.simpleString()
    x, number = (F.col(vector), number) if number in ("float", "double") else (F.col(vector).cast("array<double>"), "double")
    # compiled functions, each asked once: a search for NaN is false only where no number is missing or NaN, and the logarithm
    # of the largest number is finite unless that is infinite (or 0: null)
    largest = F.greatest(F.abs(F.array_min(x)), F.abs(F.array_max(x)))
    good = ~F.array_contains(x, F.lit(float("nan")).cast(number)) & (F.abs(F.ln(largest)) < float("inf"))
    return df.filter(F.col(key).isNotNull() & good)


def _centres(sample: DataFrame, key: str, vector: str, cells: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Centres by spherical k-means, from repeatably chosen rows. A round has one task per part of the sample, however many
    cells there are; a task sends one sum per cell. A cell that loses all its rows keeps its centre."""
    first = sample.orderBy(F.xxhash64(F.col(key), F.lit(seed + 2)), key).limit(cells).collect()  # at most MOST_CELLS rows
    centres = vectors._unit(np.array([r[vector] for r in first], dtype="float64"))
    for _ in range(rounds):
        shared, step = sample.sparkSession.sparkContext.broadcast(centres), max(1, vectors.SCORES // len(centres))

        def run(frames: Iterator[pd.DataFrame], shared=shared, step=step) -> Iterator[pd.DataFrame]:
            totals, met = np.zeros_like(shared.value), np.zeros(len(shared.value), dtype=bool)
            for pdf in (frame.iloc[at:at + step] for frame in frames for at in range(0, len(frame), step)):
                x = vectors._unit(_matrix(pdf[vector]))
                cell = _nearest(x, shared.value, 1)[:, 0]
                np.add.at(totals, cell, x)
                met[cell] = True
            found = np.flatnonzero(met)
            if len(found):
                yield pd.DataFrame({"cell": found.astype("int32"), "total": list(totals[found])})

        sums = sample.select(vector).mapInPandas(run, "cell int, total array<double>").groupBy("cell").agg(Summarizer.sum(array_to_vector("total")).alias("total"))
        centres = centres.copy()
        for row in sums.collect():
            centres[row["cell"]] = vectors._unit(row["total"].toArray()[None, :])[0]
    return centres


def build(df: DataFrame, key: str, vector: str, folder: str, recall: float = 0.95, k: int = 10, cells: int | None = None, seed: int = 42) -> Index:
    """Write the index of all rows with a direction to ``folder``.

    Without ``cells`` there are about four times the root of the rows, at most ``MOST_CELLS``. Keys are unique.
    """
    spark = df.sparkSession
    rows = with_direction(df.select(key, vector), key, vector)
    count = rows.count()
    if not count:
        raise ValueError("no vector to index")
    cells = min(cells or math.ceil(4 * math.sqrt(count)), MOST_CELLS, count)
    part = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(max(1, math.ceil(count / SAMPLE_ROWS)))) == 0
    centres = _centres(materialize(rows.filter(part), "index-sample"), key, vector, cells, seed)
    placed = _probed(rows, [key, vector], vector, centres, 1).select(key, vector, F.col("cells")[0].alias("cell"))
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{folder}/rows")
    probes = _probes(spark, folder, key, vector, centres, count, recall, k, seed)
    about = [(i, probes, [float(v) for v in c]) for i, c in enumerate(centres)]
    spark.createDataFrame(about, "cell int, probes int, centre array<double>").coalesce(1).write.parquet(f"{folder}/about")
    return Index(folder, key, vector, probes, centres)


def open_index(spark: SparkSession, folder: str, key: str, vector: str) -> Index:
    about = sorted(spark.read.parquet(f"{folder}/about").collect())  # at most MOST_CELLS rows
    return Index(folder, key, vector, about[0]["probes"], np.array([r["centre"] for r in about]))


def _probes(spark: SparkSession, folder: str, key: str, vector: str, centres: np.ndarray, count: int, recall: float, k: int, seed: int) -> int:
    """Cells to probe so that sampled queries meet ``recall`` of their true neighbours."""
    rows = spark.read.parquet(f"{folder}/rows")
    chosen = F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(max(1, count // MEASURED))) == 0
    asked = materialize(rows.filter(chosen).select(F.col(key).alias("asked"), F.col(vector).alias("vector")), "index-asked")
    blocks = max(1, -(-asked.count() // vectors.MAX_QUERIES))
    places: list[int] = []
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("asked"), F.lit(blocks)) == b).orderBy("asked").collect()  # about MAX_QUERIES rows
        if own:
            matrix = np.asarray([r["vector"] for r in own], dtype="float64")
            rank = np.argsort(_nearest(matrix, centres, len(centres)), axis=1)
            truth = _nearest_distinct(rows, vector, matrix, k + 1).filter(F.col("score") < 1 - 1e-9)
            places += [int(rank[r["q"], r["cell"]]) + 1 for r in truth.collect()]
    return max(1, math.ceil(_percentile(sorted(places), recall))) if places else 1


def _percentile(values: list[int], share: float) -> float:
    """Between the two values around the place, as Spark's ``percentile``."""
    at = (len(values) - 1) * share
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def _nearest_distinct(rows: DataFrame, vector: str, matrix: np.ndarray, k: int) -> DataFrame:
    """(q, cell, score): for every row of ``matrix`` the ``k`` nearest different vectors, ties by hash.

    A row and its copies are always in one cell: they say nothing about the others, so copies count once. Copies are left
    out where they are met; a task hands on at most ``k`` vectors per query, as hashes, and no vector is shuffled.
    """
    shared, n = rows.sparkSession.sparkContext.broadcast(vectors._unit(matrix)), len(matrix)
    step = max(k, vectors.SCORES // n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.empty((0, n)), np.empty((0, n), dtype="int64"), np.empty((0, n), dtype="int32")
        for part in (batch.slice(at, step) for batch in batches for at in range(0, batch.num_rows, step)):
            hashes, first = np.unique(part.column(0).to_numpy(), return_index=True)
            scores = np.round(vectors._unit(_columns(part.column(2))[first]) @ shared.value.T, 12)
            top, at = vectors._top(scores, np.arange(len(hashes)), k)
            met = top, hashes[at], part.column(1).to_numpy()[first][at]
            score, name, cell = (np.concatenate(x) for x in zip(best, met, strict=True))
            order = np.lexsort((-score, name), axis=0)
            score, name, cell = (np.take_along_axis(x, order, axis=0) for x in (score, name, cell))
            score[1:][name[1:] == name[:-1]] = -np.inf  # a copy of one that is held
            order = np.lexsort((name, -score), axis=0)[:k]
            best = tuple(np.take_along_axis(x, order, axis=0) for x in (score, name, cell))
        score, name, cell = (x.T.ravel() for x in best)
        q, kept = np.repeat(np.arange(n, dtype="int32"), len(best[0])), score > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (q, name, cell, score)], names=["q", "name", "cell", "score"])

    found = rows.select(F.xxhash64(vector), F.col("cell").cast("int"), vector).mapInArrow(run, "q int, name bigint, cell int, score double")
    once = found.groupBy("q", "name").agg(F.min("cell").alias("cell"), F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "name")
    return once.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k).select("q", "cell", "score")


def probe_table(index: Index, queries: DataFrame, query: str, query_vector: str = "vector", probes: int | None = None) -> DataFrame:
    """(query, vector, cell): the cells that each query asks."""
    asked = with_direction(queries.select(query, F.col(query_vector).alias("vector")), query, "vector")
    n = min(probes or index.probes, len(index.centres))
    return _probed(asked, [query, "vector"], "vector", index.centres, n).select(query, "vector", F.explode("cells").alias("cell"))


def search(index: Index, queries: DataFrame, query: str, k: int = 5, query_vector: str = "vector", probes: int | None = None, threshold: float = -1.0) -> DataFrame:
    """(query, key, score, rank): the ``k`` best rows of the probed cells for every query, scored exactly.

    Only the folders of probed cells are read. Up to ``QUERIES_PER_TASK`` queries are sent to the rows, which are not
    shuffled. With more, a cell is dealt to several tasks by rows and by queries, so neither a large cell nor one that many
    queries ask is a task by itself. Each task hands on at most ``k`` rows per query.
    """
    own = with_direction(queries.select(query, F.col(query_vector).alias("vector")), query, "vector")
    few = own.limit(QUERIES_PER_TASK + 1).collect()
    if few and len(few) <= QUERIES_PER_TASK and len(few) * len(few[0]["vector"]) * 8 <= vectors.MAX_QUERY_BYTES:
        found = _search_few(index, queries, query, few, k, probes)
    else:
        found = _search_many(index, queries, query, k, query_vector, probes)
    best = Window.partitionBy(query).orderBy(F.desc("score"), index.key)
    return found.filter(F.col("score") >= threshold).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _search_few(index: Index, queries: DataFrame, query: str, few: list, k: int, probes: int | None) -> DataFrame:
    """(query, key, score): the ``k`` best rows of every task for every query, which all tasks have."""
    spark, key, vector = queries.sparkSession, index.key, index.vector
    names = [r[query] for r in few]
    matrix = np.asarray([r["vector"] for r in few], dtype="float64")
    cells = _nearest(matrix, index.centres, min(probes or index.probes, len(index.centres)))
    who, cell = np.repeat(np.arange(len(names)), cells.shape[1]), cells.ravel()
    asking = {int(c): who[cell == c] for c in np.unique(cell)}
    shared = spark.sparkContext.broadcast((vectors._unit(matrix), asking))
    rows = index.rows(spark).filter(F.col("cell").isin(list(asking))).select(key, vector, F.col("cell").cast("int"))
    types = dict(rows.dtypes) | {query: dict(queries.dtypes)[query]}

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, asking = shared.value
        held: list[pa.Table] = []
        for part in (batch.slice(at, ROWS_PER_STEP) for batch in frames for at in range(0, batch.num_rows, ROWS_PER_STEP)):
            kind = part.schema.field(0).type
            x, own, ids = vectors._unit(_columns(part.column(1))), part.column(2).to_numpy(), part.column(0).to_numpy(zero_copy_only=False)
            for c in np.unique(own):
                at, who = np.flatnonzero(own == c), asking[int(c)]
                top, row = vectors._top(np.round(x[at] @ unit[who].T, 12), np.argsort(np.argsort(ids[at], kind="stable"), kind="stable"), k)
                by_id = at[np.argsort(ids[at], kind="stable")]
                held.append(pa.table({"_q": np.repeat(who, len(top)).astype("int32"), "_id": pa.array(ids[by_id[row.T.ravel()]], kind), "score": top.T.ravel()}))
            if sum(len(t) for t in held) > 20 * k * len(unit):
                held = [_best_of(held, k)]
        if held:
            yield from _best_of(held, k).to_batches()

    found = rows.mapInArrow(run, f"_q int, _id {types[key]}, score double")
    said = spark.createDataFrame(list(enumerate(names)), f"_q int, `{query}` {types[query]}")
    return found.join(F.broadcast(said), "_q").select(query, F.col("_id").alias(key), "score")


def _best_of(tables: list[pa.Table], k: int) -> pa.Table:
    """The ``k`` best of every query, ties by smaller id."""
    both = pa.concat_tables(tables).sort_by([("_q", "ascending"), ("score", "descending"), ("_id", "ascending")])
    q = both.column("_q").to_numpy()
    first = np.searchsorted(q, q)
    return both.filter(pa.array(np.arange(len(q)) - first < k))


def _search_many(index: Index, queries: DataFrame, query: str, k: int, query_vector: str, probes: int | None) -> DataFrame:
    """(query, key, score): rows and queries of a cell meet by shuffle."""
    spark = queries.sparkSession
    asked = materialize(probe_table(index, queries, query, query_vector, probes), "probes")
    wanted = [r[0] for r in asked.select("cell").distinct().collect()]  # at most MOST_CELLS numbers
    rows = index.rows(spark).filter(F.col("cell").isin(wanted))
    loads = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_TASK).cast("int").alias("slots"))
    loads = loads.join(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("turns")), "cell")
    loads = materialize(loads, "cell-loads")

    def dealt(df: DataFrame, name: str, own: str, other: str) -> DataFrame:
        """Each row in its own part, once for every part of the other side."""
        x = df.join(loads, "cell").withColumn(own, F.pmod(F.xxhash64(name), F.col(f"{own}s")).cast("int"))
        return x.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("slots", "turns")

    left = dealt(rows, index.key, "slot", "turn").select(F.col("cell").alias("c"), F.col("slot").alias("s"), F.col("turn").alias("t"), index.key, F.col(index.vector).alias("row_vector"))
    right = dealt(asked, query, "turn", "slot").select("cell", "slot", "turn", query, "vector")
    key, names = index.key, [query, index.key, "score"]

    def compare(pdf: pd.DataFrame, qdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or qdf.empty:
            return pd.DataFrame({n: pd.Series(dtype=object) for n in names})
        scores = np.round(vectors._unit(_matrix(qdf["vector"])) @ vectors._unit(_matrix(pdf["row_vector"])).T, 12)
        ids = pdf[key].to_numpy(dtype=object)
        parts = []
        for name, own in zip(qdf[query], scores, strict=True):
            top = vectors._best(own, ids, k)
            parts.append(pd.DataFrame({query: [name] * len(top), key: ids[top], "score": own[top]}))
        return pd.concat(parts, ignore_index=True)

    types = dict(rows.dtypes) | dict(asked.dtypes)
    return left.groupBy("c", "s", "t").cogroup(right.groupBy("cell", "slot", "turn")).applyInPandas(compare, f"`{query}` {types[query]}, `{key}` {types[key]}, score double")


def scored_pairs(index: Index, queries: DataFrame, query: str, query_vector: str = "vector", probes: int | None = None) -> DataFrame:
    """(pairs, all_pairs): comparisons that a search makes, and those of a full scan."""
    rows = index.rows(queries.sparkSession)
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    asked = probe_table(index, queries, query, query_vector, probes)
    met = asked.join(sizes, "cell").agg(F.sum("rows").alias("pairs"))
    total = sizes.agg(F.sum("rows").alias("_all"))
    n = asked.agg(F.count_distinct(query).alias("_n"))
    return met.withColumn("all_pairs", total.scalar() * n.scalar())
