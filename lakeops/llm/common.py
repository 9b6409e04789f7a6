"""Helpers shared by the training-data operators: written tables, byte-level words, linked components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import materialize, ship_package

#: Rows up to which a key list of a few numbers per row is sent to every executor; a longer one is joined by shuffle.
BROADCAST_ROWS = 1_000_000

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 1 << 19
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LETTERS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]


# ---------------------------------------------------------------- tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back: no lineage, and it survives lost executors.

    ``lakeops.session.scratch`` and ``clear_scratch`` delete these folders when the results are stored.
    """
    return materialize(df, f"llm-{label}")


def discard(df: DataFrame) -> None:
    """Delete the folder behind a table made by ``written`` that no later step reads."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a narrow ``df`` of ``rows`` counted rows if that is surely small, else leave the plan to Spark."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with marks put before it until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    """64 bits that identify a row by its id and its text, also when ids are null or repeated."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def fold(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


# ---------------------------------------------------------------- words


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary Arrow column and the n+1 places where its values begin and end; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    if data is None or places[-1] == places[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0]:places[-1]], places - places[0]


def _pieces(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut the bytes of a batch into pieces of about two megabytes, never inside a word."""
    begin, n = 0, len(data)
    while begin < n:
        end, step = min(begin + _PIECE, n), _PIECE
        while end < n:
            gaps = np.flatnonzero(_SEPARATOR[data[begin:end]])
            edge = bounds[np.searchsorted(bounds, end, "right") - 1]
            cut = max(int(edge), begin + int(gaps[-1]) + 1 if len(gaps) else begin)
            if cut > begin:
                end = cut
                break
            step *= 2
            end = min(begin + step, n)
        yield begin, end
        begin = end


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _PIECE) + 1
        _POWERS[:] = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, bounds: np.ndarray, places: bool = False):
    """Words of each value: runs of bytes other than space and \\x09-\\x0D, A-Z read as a-z.

    Returns (hash of each word, number of words of each value) and, if asked, where each word begins and ends.
    """
    hashes, starts_all, ends_all = [], [], []
    for begin, end in _pieces(data, bounds):
        part = data[begin:end]
        inside = ~_SEPARATOR[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = bounds[np.searchsorted(bounds, begin, "right"):np.searchsorted(bounds, end, "left")] - begin
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        powers, inverses = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTERS[part] * powers[:len(part)], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * inverses[starts]))
        starts_all.append(starts + begin)
        ends_all.append(ends + begin)
    flat = np.concatenate(starts_all) if starts_all else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(flat, bounds))
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return (words, counts, flat, np.concatenate(ends_all) if ends_all else flat) if places else (words, counts)


def give_back() -> None:
    """Return memory that this Python worker has freed to the system, as workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most about ``limit`` bytes of ``column`` each; one longer value is a part by itself."""
    _, bounds = raw_bytes(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + limit, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end
    give_back()


def ranges_of(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if not len(values):
        return values
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]]


class Numbered(dict):
    """Numbers keys from 0 in the order in which they are first looked up; ``fresh`` holds those not handled yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number

    def taken(self) -> list:
        fresh, self.fresh = self.fresh, []
        return fresh


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v): root is the smallest node that links reach.

    Each round hooks every node to its smallest neighbour, shortens the chains by doubling and contracts the edges to
    what still joins different roots, so the edges at least halve. Hubs are taken by map-side minima and by joins of
    written tables, which adaptive execution can split.
    """
    e = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(), "edges"
    )
    found = None
    while e.limit(1).count():
        both = e.select(F.col("hi").alias("node"), F.col("lo").alias("to")).unionByName(e.select(F.col("lo").alias("node"), F.col("hi").alias("to")))
        up = written(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to")), "hook")
        while True:
            nxt = up.select(F.col("node").alias("to"), F.col("to").alias("above"))
            jumped = written(
                up.join(nxt, "to", "left").select("node", F.coalesce("above", "to").alias("to"), (F.col("above") != F.col("to")).alias("moved")), "jump"
            )
            moved = jumped.where("moved").limit(1).count()
            up = jumped.select("node", "to")
            if not moved:
                break
        hi = up.select(F.col("node").alias("hi"), F.col("to").alias("a"))
        lo = up.select(F.col("node").alias("lo"), F.col("to").alias("b"))
        e = written(
            e.join(hi, "hi").join(lo, "lo").where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges"
        )
        if found is None:
            found = up
        else:
            step = up.select(F.col("node").alias("root"), F.col("to").alias("further"))
            found = written(found.withColumnRenamed("to", "root").join(step, "root", "left").select("node", F.coalesce("further", "root").alias("to")), "roots")
    if found is None:
        return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return found.withColumnRenamed("to", "root")


# ---------------------------------------------------------------- numbering


def numbered(df: DataFrame, order: list, name: str, label: str) -> DataFrame:
    """Rows of ``df`` with a column ``name`` that holds 1, 2, 3... in ``order``; written to a table.

    The rows are dealt out by ranges of ``order`` and sorted there; a row's number is its place in its range plus the rows
    of the ranges before. Only one row count per range comes to the driver. ``order`` should end with a unique column, so
    that many equal keys can be divided.
    """
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()), label)
    counts = placed.groupBy(F.shiftright(name, 33).alias("_range")).count().collect()
    before, total = [], 0
    for r in sorted(counts):
        before.append((r["_range"], total))
        total += r["count"]
    bases = df.sparkSession.createDataFrame(before, "_range long, _base long")
    joined = placed.withColumn("_range", F.shiftright(name, 33)).join(F.broadcast(bases), "_range")
    inside = F.col(name) - F.shiftleft("_range", 33)
    return joined.withColumn(name, F.col("_base") + inside + 1).drop("_range", "_base")
