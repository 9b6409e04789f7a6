"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import fold, mix, raw_bytes, row_key, slices, word_hashes, written

_KINDS = ("upper", "lower", "digit", "space", "newline", "stop", "comma", "exclaim", "bar", "sign", "other", "wide")
_KIND_OF = np.full(256, 10, np.uint8)
for _kind, _chars in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t\r\x0b\x0c", b"\n", b".", b",", b"!?", b"|", b"#$%&*+<=>@^_~\\/")):
    _KIND_OF[list(_chars)] = _kind
_KIND_OF[128:] = 11
STATISTICS = (*_KINDS, "words", "word_size", "distinct_words", "repeated_lines", "line_size", "marked_words")


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of transformed statistics per text: shares of character kinds, sizes, repetition."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n, dtype=np.int64), sizes)
    kinds = _KIND_OF[data]
    counts = np.bincount(owner * 12 + kinds, minlength=n * 12).reshape(n, 12).astype(float)
    out = np.zeros((n, len(STATISTICS)))
    out[:, :12] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    words, many, _, ends = word_hashes(data, bounds, places=True)
    mine = np.repeat(np.arange(n), many)
    letters = counts[:, [0, 1, 11]].sum(1)
    out[:, 12] = np.log1p(many) / 10
    out[:, 13] = np.log1p(letters / np.maximum(many, 1))
    out[:, 14] = _distinct_share(mine, words, n)
    marked = np.isin(kinds[ends - 1], (7, 9)) if len(ends) else np.zeros(0)
    out[:, 17] = np.sqrt(np.bincount(mine, marked, n) / np.maximum(many, 1))
    # A line is known by the sum of its bytes times powers that depend on the place in the line, as words are.
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(bounds[:-1][sizes > 0], breaks[~np.isin(breaks + 1, bounds)] + 1)
    if len(starts):
        line_ends = np.r_[starts[1:], len(data)]
        sums = np.r_[np.uint64(0), np.cumsum(words * (np.arange(len(words), dtype=np.uint64) * np.uint64(2) + np.uint64(1)))]
        low, high = np.searchsorted(ends, starts, "right"), np.searchsorted(ends, line_ends, "right")
        plain = np.r_[np.uint64(0), np.cumsum(words)]
        # Shift out the line's first place, so equal lines give equal sums wherever they stand.
        line = sums[high] - sums[low] - (plain[high] - plain[low]) * (low.astype(np.uint64) * np.uint64(2))
        line_owner = np.searchsorted(bounds, starts, "right") - 1
        lines = np.bincount(line_owner, minlength=n)
        out[:, 15] = 1 - _distinct_share(line_owner, mix(line), n)
        out[:, 16] = np.log1p(sizes / np.maximum(lines, 1)) / 10
    return out


def _distinct_share(owner: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])] if len(owner) else np.zeros(0)
    return np.where(np.bincount(owner, minlength=n) > 0, np.bincount(owner, new, n) / np.maximum(np.bincount(owner, minlength=n), 1), 1.0)


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the class covariances and log priors; one class only if the labels had one."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    only: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 from the difference of the two Mahalanobis log densities."""
        if self.only is not None:
            return np.full(len(x), self.only)
        density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(constant - 0.5 * (z * z).sum(0))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def discriminant(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, shrink: float) -> Discriminant:
    """From per-class counts, sums and sums of products. Covariances shrink towards the pooled diagonal."""
    total = counts.sum()
    if (counts < 2).any():
        return Discriminant(sums, products, counts, only=float(counts[1] / total) if total else 0.5)
    means = sums / counts[:, None]
    scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / total
    target = np.diag(np.maximum(np.diag(pooled), 1e-6))
    covariances = [(1 - shrink) * s / c + shrink * target for s, c in zip(scatter, counts, strict=True)]
    factors = np.array([np.linalg.cholesky(c) for c in covariances])
    constants = np.array([np.log(c / total) - np.log(np.diag(f)).sum() for c, f in zip(counts, factors, strict=True)])
    return Discriminant(means, factors, constants)


def measured(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` without its text, with the statistics as one array column; a null text counts as empty."""
    keep = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("x", T.ArrayType(T.DoubleType(), False), False)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 2 << 20):
                x = statistics(*raw_bytes(part.column(text_col)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "x"])

    return docs.mapInArrow(measure, schema)


def fit(labelled: DataFrame, shrink: float = 0.1) -> Discriminant:
    """labelled: (x, label 0 or 1). Sums are added up by Spark; only their d * d numbers reach the driver."""
    d = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, d)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                one = np.c_[np.ones((label == k).sum()), x[label == k]]
                cells = (one.T @ one).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)) + k * len(cells)), pa.array(cells)], ["cell", "value"])

    rows = labelled.select("x", "label").mapInArrow(sums, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(2 * (d + 1) ** 2)
    for r in rows:
        flat[r["cell"]] = r["value"]
    full = flat.reshape(2, d + 1, d + 1)
    return discriminant(full[:, 0, 0], full[:, 0, 1:], full[:, 1:, 1:], shrink)


def good_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.7, shrink: float = 0.1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with only the rows whose score reaches ``threshold``; all columns kept, nothing shuffled but class sums."""
    model = _learnt(written(measured(_narrow(docs, id_col, text_col), "text"), "statistics"), labels, label_col, shrink)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 2 << 20):
                yield part.filter(pa.array(model.score(statistics(*raw_bytes(part.column(text_col)))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, 4) == 2).alias("held_out"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))


def _learnt(x: DataFrame, labels: DataFrame, label_col: str, shrink: float) -> Discriminant:
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    return fit(x.where(~F.col("held_out")).join(known, F.col("doc_id") == F.col("id")), shrink)


def quality_scores(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.7, shrink: float = 0.1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, row_key, held_out, score and predicted.

    Learns from all labelled rows whose crc32(id as text) mod 4 is not 2. Null and empty texts are scored like any other
    (their statistics are 0); repeated rows and null ids keep a row each, and a null id has no label. Several labels of one
    id count as their maximum. With fewer than two labelled rows of a class every score is the share of ones, or 0.5
    without labels.
    """
    x = written(measured(_narrow(docs, id_col, text_col), "text"), "statistics")
    model = _learnt(x, labels, label_col, shrink)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(model.score(values))], [*batch.schema.names[:3], "score"])

    scored = x.select("doc_id", "row_key", "held_out", "x").mapInArrow(score, T.StructType([x.schema["doc_id"], x.schema["row_key"], x.schema["held_out"], T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
