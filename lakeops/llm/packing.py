"""Best-fit packing of tokenised documents into sequences of a fixed length.

Hierarchical residual packing: each partition packs its pieces by best fit and puts out the sequences that are nearly
full. The underfull ones, with all they hold, are the items of the next round, in fewer and newly mixed partitions, until
one partition is left or a round no longer saves anything. Every task sees a bounded number of items.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import Numbered, ranges_of, slices, written

#: Items that one task packs.
ITEMS_PER_TASK = 40_000
#: Words, and bytes of words, that a Python worker remembers; when full, the memory starts anew.
REMEMBERED, REMEMBERED_BYTES = 300_000, 8 << 20
#: Bytes of text that are encoded at once.
TEXT_BYTES = 2 << 20
#: Fixed value: how the word-level vocabulary cuts lower-cased text.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Characters for which cutting at white space is surely what the tokenizer file does; other texts go to the library whole
#: and are not remembered.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-įı-ſ]").search


class TextIds:
    """Token ids of texts by a tokenizer file whose words never span white space: each goes to the library once."""

    def __init__(self, spec: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.end_id = Tokenizer.from_str(spec), end_id
        self.find = regex.compile(PRE_TOKENS).findall
        vocab = self.library.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)").search
        self.forget()

    def forget(self) -> None:
        self.words, self.pre_tokens, self.bytes = Numbered(), Numbered(), 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pre_starts, self.pre_sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.pre_pool = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.words[None]
        self.words.taken()
        self.add([self.end_id], [1])

    def add(self, ids, sizes) -> None:
        sizes = np.asarray(sizes, np.int64)
        self.starts = np.r_[self.starts, len(self.pool) + np.cumsum(sizes) - sizes]
        self.sizes, self.pool = np.r_[self.sizes, sizes], np.r_[self.pool, np.asarray(ids, np.uint32)]

    def learn(self) -> None:
        """Ids of the words that have not been met before, by way of their pre-tokens."""
        found: list[int] = []
        many: list[int] = []
        number = self.pre_tokens.__getitem__
        for word in self.words.taken():
            self.bytes += len(word)
            if word.isalpha():
                found.append(number(word))
                many.append(1)
            else:
                cut = self.find(word)
                found.extend(map(number, cut))
                many.append(len(cut))
        fresh = self.pre_tokens.taken()
        if fresh:
            lines = [" ".join(fresh[i:i + 100]) for i in range(0, len(fresh), 100)]
            ids = np.fromiter((i for e in self.library.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids), np.uint32)
            sizes = np.diff(np.r_[-1, np.flatnonzero(self.last[ids])])
            self.pre_starts = np.r_[self.pre_starts, len(self.pre_pool) + np.cumsum(sizes) - sizes]
            self.pre_sizes, self.pre_pool = np.r_[self.pre_sizes, sizes], np.r_[self.pre_pool, ids]
        if not many:
            return
        index = np.array(found, np.int64)
        sizes = self.pre_sizes[index]
        flat = self.pre_pool[np.repeat(self.pre_starts[index], sizes) + ranges_of(sizes)]
        self.add(flat, np.diff(np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(many)]]))

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by the end id, and the number of ids of each text."""
        if len(self.words) > REMEMBERED or len(self.pre_tokens) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.forget()
        index: list[int] = []
        ends = []
        odd: list[int] = []
        number = self.words.__getitem__
        for i, text in enumerate(texts):
            if _UNUSUAL(text) or self.special(text):
                odd.append(i)
            else:
                index.extend(map(number, text.lower().split()))
            index.append(0)
            ends.append(len(index))
        self.learn()
        numbers = np.array(index, np.int64)
        sizes = self.sizes[numbers]
        flat = self.pool[np.repeat(self.starts[numbers], sizes) + ranges_of(sizes)]
        totals = np.diff(np.r_[0, np.r_[0, np.cumsum(sizes)][ends]])
        if odd:
            found = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False)]
            many = np.fromiter(map(len, found), np.int64, len(found))
            begins = (np.cumsum(totals) - totals)[odd]
            flat = np.insert(flat, np.repeat(begins, many), np.concatenate(found))
            totals[odd] += many
        return flat, totals


_READERS: dict[tuple[str, int], TextIds] = {}


def _reader(spec: str, end_id: int) -> TextIds:
    """The reader of this Python worker, kept from task to task with what it remembers."""
    key = (hashlib.sha256(spec.encode()).hexdigest(), end_id)
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = TextIds(spec, end_id)
    return _READERS[key]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids: doc_id, piece, start, length, ids_crc32 and, if asked, the ids themselves."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fields = [T.StructField("doc_id", narrow.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(spec.value, end_id)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                flat, sizes = reader.ids(part.column("text").to_pylist())
                many = -(-sizes // capacity)
                piece = ranges_of(many)
                start = piece * capacity
                length = np.minimum(np.repeat(sizes, many) - start, capacity)
                at = np.repeat(np.cumsum(sizes) - sizes, many) + start
                data = [flat[a:a + n].astype("<u4").tobytes() for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                columns = [part.column("doc_id").take(pa.array(np.repeat(np.arange(len(sizes)), many))), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(d) for d in data], pa.int64())]
                columns += [pa.array(data, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return narrow.mapInArrow(cut, T.StructType(fields))


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices of the items in each bin: longest first, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes = 0
    sizes = lengths.tolist()
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[item]
        fits = open_sizes >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            target = free[room].pop()
            if not free[room]:
                open_sizes &= ~(1 << room)
            bins[target].append(item)
        else:
            room, target = capacity, len(bins)
            bins.append([item])
        room -= size
        if room:
            free[room].append(target)
            open_sizes |= 1 << room
    return bins


def pack(items: DataFrame, capacity: int = 2048, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """Give every row of ``items`` (with ``length`` from 1 to capacity) a sequence_id and an offset; other columns are kept.

    Sequences that the shortest waiting one does not fit into are put out; rounds go on until one saves nothing or one task
    has held all. An empty table gives no rows.
    """
    columns = [f"item_{i}" for i in range(len(items.columns))]
    held = T.ArrayType(T.StructType([T.StructField(n, f.dataType) for n, f in zip(columns, items.schema.fields, strict=True)]))
    length = f"item_{items.columns.index('length')}"
    single = items.select(F.array(F.struct(*(F.col(c).alias(n) for c, n in zip(items.columns, columns, strict=True)))).cast(held).alias("held"), F.col("length").cast("long").alias("used"))
    single = written(single, "pieces")
    done: list[DataFrame] = []

    def parted(packed: DataFrame) -> tuple[DataFrame, int]:
        """Put out what nothing can be added to; the rest and its number of rows."""
        least = packed.agg(F.min("used")).first()[0] or 0
        done.append(packed.where(F.col("used") > capacity - least))
        rest = packed.where(F.col("used") <= capacity - least)
        return rest, rest.count()

    (waiting, count), round_no = parted(single), 0
    schema = T.StructType([T.StructField("held", held), T.StructField("used", T.LongType())])

    def fit(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        used = group.column("used").to_numpy()
        bins = best_fit(used, capacity)
        order = np.fromiter((i for b in bins for i in b), np.int64)
        cells = group.column("held").combine_chunks() if isinstance(group.column("held"), pa.ChunkedArray) else group.column("held")
        cells = cells.chunk(0) if isinstance(cells, pa.ChunkedArray) else cells
        sorted_cells = cells.take(pa.array(order))
        inner = np.diff(sorted_cells.offsets.to_numpy())
        ends = np.cumsum([len(b) for b in bins])
        offsets = np.r_[0, np.cumsum(inner)][np.r_[0, ends]]
        sums = np.add.reduceat(used[order], np.r_[0, ends[:-1]])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), sorted_cells.flatten())
        return pa.table({"held": lists, "used": pa.array(sums, pa.int64())})

    while count:
        tasks = -(-count // items_per_task)
        spread = waiting.withColumn("task", F.pmod(F.xxhash64("held", F.lit(round_no)), F.lit(tasks)))
        packed = written(spread.groupBy("task").applyInArrow(lambda t: fit(t), schema), "packed")
        after = packed.count()
        if tasks == 1 or after >= count:
            done.append(packed)
            break
        (waiting, count), round_no = parted(packed), round_no + 1
    sequences = done[0]
    for more in done[1:]:
        sequences = sequences.unionByName(more)
    kinds = [f.dataType for f in items.schema.fields]
    out = T.StructType([T.StructField(n, k) for n, k in zip([*columns, "sequence_id", "offset"], [*kinds, T.LongType(), T.LongType()], strict=True)])

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("held")
            many = np.diff(cells.offsets.to_numpy())
            inner = cells.flatten()
            sizes = inner.field(columns.index(length)).to_numpy()
            ends = np.cumsum(sizes)
            first = np.r_[0, ends][np.cumsum(many) - many]
            owner = np.repeat(np.arange(len(many)), many)
            yield pa.RecordBatch.from_arrays([*inner.flatten(), batch.column("sequence_id").take(pa.array(owner)), pa.array(ends - sizes - first[owner], pa.int64())], out.names)

    placed = sequences.select(F.monotonically_increasing_id().alias("sequence_id"), "held").mapInArrow(lay_out, out)
    return placed.select(*(F.col(n).alias(c) for c, n in zip(items.columns, columns, strict=True)), "sequence_id", "offset")


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it.

    A null text is empty and still takes one place (the end id); null and repeated ids keep their own pieces; only documents
    longer than ``capacity`` are cut. An empty table gives no rows.
    """
    return pack(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences themselves, as little-endian unsigned 32-bit ids, from the documents and
    where ``best_fit_packing`` has put their pieces.

    Ids are made again instead of travelling through the rounds of packing. Pieces that repeat (equal id, number and ids) take
    their places one by one, in any order, as they are equal.
    """
    key = ["doc_id", "piece", "ids_crc32"]
    again = Window.partitionBy(*key).orderBy("length")
    cut = pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids=True).withColumn("turn", F.row_number().over(again))
    placed = packed.withColumn("turn", F.row_number().over(Window.partitionBy(*key).orderBy("sequence_id", "offset")))
    placed = placed.select(*(F.col(c).alias(f"at_{c}") for c in (*key, "turn")), "sequence_id", "offset")
    same = F.lit(True)
    for c in (*key, "turn"):
        same = same & F.col(c).eqNullSafe(F.col(f"at_{c}"))
    rows = cut.join(placed, same).groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    whole = F.aggregate("held", F.lit(b""), lambda found, x: F.concat(found, x["ids"]))
    return rows.select("sequence_id", "n_tokens", whole.alias("ids"))
