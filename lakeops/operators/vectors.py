"""Embeddings and nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries of one pass, and the bytes that their vectors may take at most.
MAX_QUERIES, MAX_QUERY_BYTES = 2048, 64 << 20
#: Scores that a task holds at once.
SCORES = 1 << 20


def embed_hashed(df: DataFrame, text: str, out: str = "embedding", dims: int = 256) -> DataFrame:
    """Normalised hashed word counts; rows without a word are left out, texts are read whole."""
    stages = PipelineModel([
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dims),
        Normalizer(inputCol="_tf", outputCol="_unit"),
    ])
    # a text with a letter or digit has a word; a filter on the words themselves would cut every text twice
    embedded = stages.transform(df.filter(F.col(text).rlike(r"[\p{L}\p{N}]")))
    return embedded.withColumn(out, vector_to_array("_unit", "float32")).drop("_words", "_tf", "_unit")


def embed_with(df: DataFrame, text: str, model: Callable[[list[str]], np.ndarray], out: str = "embedding", batch: int = 64) -> DataFrame:
    """Embeddings from any Python model, called on batches of texts inside the tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = pdf[text].tolist()
            vectors = [row for i in range(0, len(texts), batch) for row in np.asarray(model(texts[i : i + batch]), dtype="float32").tolist()]
            yield pdf.assign(**{out: vectors})

    ready = df.filter(F.length(F.trim(text)) > 0)
    fields = ", ".join(f"`{n}` {t}" for n, t in ready.dtypes)
    return ready.mapInPandas(run, f"{fields}, `{out}` array<float>")


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, summed up on the map side."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return df.groupBy(group).agg(mean.alias("_m")).select(group, vector_to_array("_m").alias("vector"))


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties by smaller id (numbers or strings)."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= bar)
    else:
        keep = np.arange(len(scores))
    return keep[sorted(range(len(keep)), key=lambda j: (-scores[keep[j]], ids[keep[j]]))[:k]]


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the k best rows of every column, in no order; ties at the border go to smaller ids."""
    n = len(scores)
    if n <= k:
        return scores, np.broadcast_to(ids[:, None], scores.shape)
    rows = np.argpartition(scores, n - k, axis=0)[n - k:]
    bar = np.take_along_axis(scores, rows[:1], axis=0)
    tied = np.flatnonzero((scores >= bar).sum(axis=0) > k)
    if len(tied):
        by_id = np.argsort(ids, kind="stable")
        rows[:, tied] = by_id[np.argsort(-scores[by_id][:, tied], axis=0, kind="stable")[:k]]
    return np.take_along_axis(scores, rows, axis=0), ids[rows]


def _scan(df: DataFrame, key: str, vector: str, names: list, matrix: np.ndarray, query: str, query_type: str, k: int, threshold: float) -> DataFrame:
    key_type = dict(df.dtypes)[key]
    shared = df.sparkSession.sparkContext.broadcast(_unit(matrix))

    step = max(k, SCORES // len(names), 1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.empty((0, len(names))), np.empty((0, len(names)), dtype=object)
        for pdf in (frame.iloc[at:at + step] for frame in frames for at in range(0, len(frame), step)):
            scores = np.round(_unit(np.vstack(pdf[vector].to_numpy()).astype("float64")) @ shared.value.T, 12)
            top = _top(scores, pdf[key].to_numpy(dtype=object), k)
            joined = [np.concatenate(x) for x in zip(best, top, strict=True)]
            if len(joined[0]) > k:  # per query: the best of what is held, ties by id
                order = np.array([sorted(range(len(joined[0])), key=lambda i, q=q: (-joined[0][i, q], joined[1][i, q]))[:k] for q in range(len(names))]).T
                joined = [np.take_along_axis(x, order, axis=0) for x in joined]
            best = joined[0], joined[1]
        for q in range(len(names)):
            yield pd.DataFrame({query: [names[q]] * len(best[0]), key: best[1][:, q], "score": best[0][:, q]})

    # every task hands on at most k rows per query
    found = df.select(key, vector).mapInPandas(run, f"`{query}` {query_type}, `{key}` {key_type}, score double")
    return found.filter(F.col("score") >= threshold)


def knn_exact(
    df: DataFrame, queries: DataFrame, key: str, vector: str, query: str, k: int = 5,
    threshold: float = -1.0, where: Column | None = None, query_vector: str = "vector", block: int = MAX_QUERIES,
) -> DataFrame:
    """Exact cosine top-k per query over the whole table.

    Queries travel to the data in blocks of at most about ``block`` vectors and
    ``MAX_QUERY_BYTES``; each task returns only its own top k, so the shuffle holds k rows
    per task and query. More queries than one block mean more passes, never a dropped query.
    Rows and queries without a vector or id are left out; no query gives no row.
    """
    rows = (df if where is None else df.filter(where)).filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    queries = queries.filter(F.col(query).isNotNull() & F.col(query_vector).isNotNull())
    query_type = dict(queries.dtypes)[query]
    count, width = queries.agg(F.count(F.lit(1)), F.max(F.size(query_vector))).first()
    blocks = max(1, -(-count // block), -(-count * (width or 0) * 8 // MAX_QUERY_BYTES))
    parts = []
    for b in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64(query), F.lit(blocks)) == b).orderBy(query).collect()
        if own:
            matrix = np.asarray([r[query_vector] for r in own], dtype="float64")
            parts.append(_scan(rows, key, vector, [r[query] for r in own], matrix, query, query_type, k, threshold))
    w = Window.partitionBy(query).orderBy(F.desc("score"), key)
    if not parts:
        none = rows.select(F.lit(None).cast(query_type).alias(query), key, F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
        return none.limit(0)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_lsh(
    df: DataFrame, queries: DataFrame, key: str, vector: str, query: str, k: int = 5,
    query_vector: str = "vector", bits: int = 8, tables: int = 16, seed: int = 42, block: int = MAX_QUERIES,
) -> DataFrame:
    """Approximate top-k: only vectors that share a bucket with the query are scored, exactly.

    A bucket is the pattern of signs along ``bits`` random directions, so a table splits the rows into up to 2**bits
    buckets and a row meets a query by chance in one of them with probability 2**-bits; nearer vectors do so more often.
    More bits score fewer pairs, more tables find more neighbours.

    Queries travel to the data by blocks, as in ``knn_exact``; a task looks its rows up in the queries' buckets and hands
    on at most ``k`` rows per query, so no pair and no vector is shuffled.
    """
    met = _in_buckets(df, queries, key, vector, query, query_vector, bits, tables, seed, block, k)
    w = Window.partitionBy(query).orderBy(F.desc("score"), key)
    return met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def lsh_pairs(df: DataFrame, queries: DataFrame, key: str, vector: str, query: str, query_vector: str = "vector", bits: int = 8, tables: int = 16, seed: int = 42) -> DataFrame:
    """(query, key, score): the pairs that share a bucket, once each."""
    return _in_buckets(df, queries, key, vector, query, query_vector, bits, tables, seed, MAX_QUERIES, None)


def lsh_pair_counts(df: DataFrame, queries: DataFrame, key: str, vector: str, query: str, query_vector: str = "vector", bits: int = 8, tables: int = 16, seed: int = 42) -> DataFrame:
    """(query, pairs): how many rows share a bucket with each query, by task; a query may have several such rows."""
    return _in_buckets(df, queries, key, vector, query, query_vector, bits, tables, seed, MAX_QUERIES, 0)


def _in_buckets(df: DataFrame, queries: DataFrame, key: str, vector: str, query: str, query_vector: str, bits: int, tables: int, seed: int, block: int, k: int | None) -> DataFrame:
    """(query, key, score) of the pairs that share a bucket: the ``k`` best of every task and query, or all of them (None).
    With ``k`` = 0 nothing is scored, and (query, pairs) says how many pairs a task has met."""
    rows = df.select(key, vector).filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    asked = queries.select(query, query_vector).filter(F.col(query).isNotNull() & F.col(query_vector).isNotNull())
    types = dict(df.dtypes) | {query: dict(queries.dtypes)[query]}
    schema = f"`{query}` {types[query]}, pairs bigint" if k == 0 else f"`{query}` {types[query]}, `{key}` {types[key]}, score double"
    count, width = asked.agg(F.count(F.lit(1)), F.max(F.size(query_vector))).first()
    width = width or 1
    axes = np.random.default_rng(seed).standard_normal((width, tables * bits))
    weights = 1 << np.arange(bits)

    def codes(x: np.ndarray) -> np.ndarray:
        return (x @ axes > 0).reshape(len(x), tables, bits) @ weights

    def passed(own: list) -> DataFrame:
        names, unit = [r[query] for r in own], _unit(np.asarray([r[query_vector] for r in own], dtype="float64"))
        buckets = codes(unit)
        orders = buckets.argsort(axis=0, kind="stable")
        shared = df.sparkSession.sparkContext.broadcast((names, unit, orders, np.take_along_axis(buckets, orders, axis=0)))
        step = max(1, SCORES // len(names))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, unit, orders, places = shared.value
            best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, dtype=object)) for _ in names]
            met_rows = np.zeros(len(names), dtype="int64")
            for pdf in (frame.iloc[at:at + step] for frame in frames for at in range(0, len(frame), step)):
                x = _unit(np.vstack(pdf[vector].to_numpy()).astype("float64"))
                met, own = np.zeros((len(names), len(x)), dtype=bool), codes(x)
                for t in range(tables):
                    first, end = (np.searchsorted(places[:, t], own[:, t], side) for side in ("left", "right"))
                    row = np.repeat(np.arange(len(x)), end - first)
                    within = np.arange(len(row)) - np.repeat(np.cumsum(end - first) - (end - first), end - first)
                    met[orders[np.repeat(first, end - first) + within, t], row] = True
                met_rows += met.sum(axis=1)
                if k == 0:
                    continue
                ids = pdf[key].to_numpy(dtype=object)
                for q in np.flatnonzero(met.any(axis=1)):
                    at = np.flatnonzero(met[q])
                    scores = np.round(x[at] @ unit[q], 12)
                    if k is None:
                        yield pd.DataFrame({query: [names[q]] * len(at), key: ids[at], "score": scores})
                        continue
                    scores, found = np.concatenate([best[q][0], scores]), np.concatenate([best[q][1], ids[at]])
                    top = _best(scores, found, k)
                    best[q] = scores[top], found[top]
            if k == 0:
                yield pd.DataFrame({query: names, "pairs": met_rows})
            elif k is not None:
                for name, (scores, found) in zip(names, best, strict=True):
                    yield pd.DataFrame({query: [name] * len(scores), key: found, "score": scores})

        return rows.mapInPandas(run, schema)

    blocks = max(1, -(-count // block), -(-count * width * 8 // MAX_QUERY_BYTES))
    parts = [passed(own) for b in range(blocks) if (own := asked.filter(F.pmod(F.xxhash64(query), F.lit(blocks)) == b).orderBy(query).collect())]
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], schema)


def recall(found: DataFrame, truth: DataFrame, query: str, key: str) -> DataFrame:
    """Share of the true neighbours that were found, over all queries."""
    hits = truth.select(query, key).join(found.select(query, key, F.lit(1).alias("_hit")), [query, key], "left")
    return hits.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def filters(equals: dict[str, object] | None = None, one_of: dict[str, Sequence] | None = None) -> Column | None:
    conds = [F.col(k) == F.lit(v) for k, v in (equals or {}).items()] + [F.col(k).isin(*v) for k, v in (one_of or {}).items()]
    out = None
    for cond in conds:
        out = cond if out is None else out & cond
    return out
