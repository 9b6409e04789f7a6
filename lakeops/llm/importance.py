"""Importance resampling of documents towards a target collection by hashed n-gram features.

The words of a text are cut by an untrained pre-tokeniser (a pattern split over the text with A-Z lower-cased), which gives
every word with its place. Neighbouring places make windows of one to three words; a window's bucket is the crc32 of its
words, joined by one space, modulo the number of buckets. The crc of a window is put together from the crcs of its words,
so no window text is ever built. Bucket counts of documents and target give one gain per bucket, a document's weight is the
sum over its windows, and a repeatable noise per id turns the weights into a draw without replacement.

Every text is cut once; its buckets (two bytes a window) are written and serve both the counts and the sums.

Null and empty texts have no words: weight 0, never drawn. A null id counts as the empty text in the noise and comes last
among ties. Repeated rows are documents of their own. Very long texts are cut piece by piece at separators, and windows go
across the pieces. Empty tables give no rows; an empty target leaves every bucket's own share to decide. Further columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from lakeops.llm.common import numbered, ranges_of, raw_bytes, row_key, slices, written

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes given to the pre-tokeniser at once; it gets slower with longer texts.
_CUT = 768
#: Words up to this length are read byte by byte for all words of a batch together.
_SHORT = 64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_TABLE = _crc_table()


def _step(c: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _TABLE[(c ^ byte) & 255] ^ (c >> 8)


def _doublings(n: int = 34) -> list[np.ndarray]:
    """For each j, four tables (one per byte of a crc) that carry a crc over 2**j zero bytes."""
    single = np.arange(256, dtype=np.uint32)
    tables = [np.stack([_step(single << np.uint32(8 * k), 0) for k in range(4)])]
    while len(tables) < n:
        tables.append(_over(tables[-1], tables[-1]))
    return tables


def _over(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    return table[0][c & 255] ^ table[1][(c >> 8) & 255] ^ table[2][(c >> 16) & 255] ^ table[3][c >> 24]


_DOUBLINGS = _doublings()


def joined_crc(left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of ``left text, one space, right text`` from the crcs of both and the bytes of the right one."""
    c = ~_step(~left, 32)
    for j in range(int(sizes.max(initial=0)).bit_length()):
        on = np.flatnonzero((sizes >> j) & 1)
        c[on] = _over(_DOUBLINGS[j], c[on])
    return c ^ right


def word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of each word; all words are read side by side, the longest first."""
    order = np.argsort(-sizes, kind="stable")
    at, rest = starts[order], sizes[order]
    c = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for j in range(min(int(sizes.max(initial=0)), _SHORT)):
        m = int(np.searchsorted(-rest, -j, "left"))
        c[:m] = _step(c[:m], data[at[:m] + j])
    out = np.empty_like(c)
    out[order] = ~c
    for k in np.flatnonzero(sizes > _SHORT):
        out[k] = zlib.crc32(data[starts[k]:starts[k] + sizes[k]])
    return out


def word_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the lower-cased ``data`` begin and end, by the pre-tokeniser; no word crosses ``bounds``."""
    split = pre_tokenizers.Split(Regex(_BETWEEN), "removed")
    gaps = np.flatnonzero(~_WORD[data])
    near = np.searchsorted(gaps, np.arange(_CUT, len(data), _CUT))
    cuts = np.unique(np.r_[bounds, gaps[near[near < len(gaps)]]])
    text = data.tobytes().decode("latin-1")  # one character a byte, so places are bytes
    found: list[int] = []
    counts = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        words = split.pre_tokenize_str(text[a:b])
        counts.append(len(words))
        for _, place in words:
            found.extend(place)
    places = np.array(found, np.int64).reshape(-1, 2) + np.repeat(cuts[:-1], counts)[:, None] if found else np.zeros((0, 2), np.int64)
    return places[:, 0], places[:, 1]


def window_buckets(column: pa.Array, n_buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, windows of each text, bucket of every window text by text)."""
    data, bounds = raw_bytes(column)
    data = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
    starts, ends = word_places(data, bounds)
    sizes = ends - starts
    n_words = np.diff(np.searchsorted(starts, bounds))
    n_windows = sum(np.maximum(n_words - k, 0) for k in range(longest))
    first = np.cumsum(n_windows) - n_windows
    out = np.empty(int(n_windows.sum()), np.uint16 if n_buckets <= 1 << 16 else np.uint32)
    crcs = word_crcs(data, starts, sizes)
    window = crcs
    for k in range(longest):
        here = np.maximum(n_words - k, 0)
        left = ranges_of(n_words) < np.repeat(here, n_words)  # windows of k+1 words that end inside their text
        if k:
            window = np.r_[joined_crc(window[:-k], crcs[k:], sizes[k:]), np.zeros(min(k, len(crcs)), np.uint32)] if len(crcs) > k else np.zeros(len(crcs), np.uint32)
        out[np.repeat(first, here) + ranges_of(here)] = window[left] % np.uint32(n_buckets)
        first = first + here
    return n_words, n_windows, out


def hashed_windows(docs: DataFrame, n_buckets: int = 10_000, longest: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row_key, n_words, n_features, buckets) of every row, written to a table; ``buckets`` is a packed array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                n_words, n_windows, buckets = window_buckets(part.column("text"), n_buckets, longest)
                ends = np.r_[0, np.cumsum(n_windows)] * buckets.itemsize
                packed = pa.Array.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(buckets.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row_key"), pa.array(n_words, pa.int64()), pa.array(n_windows, pa.int64()), packed.cast(pa.binary())],
                    ["id", "row_key", "n_words", "n_features", "buckets"],
                )

    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"id {kind}, row_key long, n_words long, n_features long, buckets binary"), "windows")


def _unpack(column: pa.Array, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = raw_bytes(column)
    kind = np.dtype(np.uint16 if n_buckets <= 1 << 16 else np.uint32)
    return np.frombuffer(data.tobytes(), kind), bounds // kind.itemsize


def bucket_counts(windows: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, n): windows in each bucket; every task sends one row per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            counts += np.bincount(_unpack(batch.column("buckets"), n_buckets)[0], minlength=n_buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], ["bucket", "n"])

    return windows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, n_buckets: int) -> np.ndarray:
    """Gain of every bucket in thousandths: how much commoner it is in the target. One number per bucket comes to the driver."""
    spark = source.sparkSession
    every = spark.range(n_buckets).select(F.col("id").alias("bucket"))
    s, t = (bucket_counts(w, n_buckets).withColumnRenamed("n", name) for w, name in ((source, "s"), (target, "t")))
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0)
    rows = both.select("bucket", "s", "t").collect()
    whole_s, whole_t = sum(r.s for r in rows), sum(r.t for r in rows)
    ratio = "(double(t) + 1) * (double({0}) + {2}) / ((double(s) + 1) * (double({1}) + {2}))".format(whole_s, whole_t, n_buckets)
    table = spark.createDataFrame([tuple(r) for r in rows], "bucket long, s long, t long")
    gains = np.zeros(n_buckets, np.int64)
    for r in table.select("bucket", F.expr(f"floor(1000 * ln({ratio}))").alias("gain")).collect():
        gains[r.bucket] = r.gain
    return gains


def _weighed(windows: DataFrame, gains: np.ndarray) -> DataFrame:
    n_buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "buckets", 8 << 20):
                buckets, bounds = _unpack(part.column("buckets"), n_buckets)
                sums = np.r_[0, np.cumsum(gains[buckets])]
                weight = pa.array(sums[bounds[1:]] - sums[bounds[:-1]], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "row_key", "n_words", "n_features")), weight], ["id", "row_key", "n_words", "n_features", "weight"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.drop("buckets").schema)
    return windows.mapInArrow(run, f"{schema}, weight long")


def importance_scores(
    docs: DataFrame, target: DataFrame, share: int = 5, least_words: int = 20, seed: str = "42", n_buckets: int = 10_000, longest: int = 3,
    id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id",
) -> DataFrame:
    """(id, row_key, n_features, weight, score, rank) of every document.

    ``share`` percent (rounded down) of the documents with at least ``least_words`` words are drawn, the highest scores
    first, equal scores by the smaller id; ``rank`` is their place, null for all others. ``score`` is the weight plus a
    noise made of ``seed`` and the id.
    """
    windows = hashed_windows(docs, n_buckets, longest, id_col, text_col)
    gains = bucket_gains(windows, hashed_windows(target, n_buckets, longest, target_id, text_col), n_buckets)
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(drawn, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = written(
        _weighed(windows, gains).withColumn("score", F.col("weight") + noise).withColumn("uid", F.monotonically_increasing_id()), "weights"
    )
    large = scored.where(F.col("n_words") >= least_words)
    take = large.count() * share // 100
    ranked = numbered(large, [F.desc("score"), F.asc_nulls_last("id"), F.asc("uid")], "rank", "ranked")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias(id_col), "row_key", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, share: int = 5, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The drawn documents with all columns of ``docs``; rows that repeat id and text come once."""
    drawn = importance_scores(docs, target, share, id_col=id_col, text_col=text_col, **params).where("rank is not null").select(F.col("row_key").alias("_drawn"))
    found = docs.withColumn("_drawn", row_key(id_col, text_col)).join(drawn.distinct(), "_drawn", "left_semi")
    return found.dropDuplicates(["_drawn"]).drop("_drawn")
