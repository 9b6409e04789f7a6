"""Phrase collocations by counting quotient filters.

Words are cut and counted slice by slice; words that reach the least count get small numbers (every word of a phrase that
reaches it does so too, so nothing is lost). Texts become sequences of these numbers with gaps: the list of frequent words is
sent to the tasks, which cut the texts once more; one longer than ``SENT_BYTES`` is joined with the words of each slice
instead. Runs of two to five numbers are packed into one integer, which an invertible mixing spreads evenly. Its upper part, the quotient, says where it
belongs; its lower part, the remainder, is kept in full, so a counter never stands for two phrases. A filter holds run
lengths per quotient, sorted remainders and counts in one byte where they fit. Every task fills filters of bounded size, cut
at quotient ranges; filters of one range are merged by a second task and only phrases that reach the least count go on.

Two-word phrases are counted first. Longer ones are counted only where all their pairs may be frequent, looked up in a bit
map of fixed size: it may let too much through, never too little.

Scores and their cuts are decimals and whole numbers, exact to 38 digits. Null texts are empty, a null language is ``und``
(together with texts marked so). Repeated rows count as often as they stand there. A very long text is a slice by itself,
never cut. Ties go to the shorter first part, then to the phrase that comes first by bytes. Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import mix, numbered, ranges_of, raw_bytes, slices, word_hashes, written

#: Bytes of text handled at once.
SLICE_BYTES = 4 << 20
#: Bytes up to which the list of frequent words is sent to every task; a longer one is joined by shuffle.
SENT_BYTES = 64 << 20
#: Counted phrases a task holds before it sends a filter, and phrases a merging task shall get.
HELD = 1_500_000
#: Bits of the map of pairs that reach the least count; one number for every size of the input (4 MB).
MAP_BITS = 25

FILTER = ["size", "range", "slots", "runs", "long_runs", "remainders", "counts", "large"]

_KIND = np.zeros(256, np.uint8)  # 0 part of a word, 1 between words, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# ---------------------------------------------------------------- words and their numbers


def words_and_pieces(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, value each stands in, whether a word follows the one before in the same piece)."""
    kind = _KIND[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    ends = np.flatnonzero(last) + 1
    breaks = np.cumsum(kind == 2, dtype=np.uint32)
    value = np.searchsorted(bounds, starts, "right") - 1
    follows = np.zeros(len(starts), bool)
    if len(starts) > 1:
        follows[1:] = (breaks[starts[1:]] == breaks[ends[:-1] - 1]) & (value[1:] == value[:-1])
    places = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data[inside].tobytes())])
    return words, value, follows


def _number_of_pairs(words: pa.Array, langs: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Distinct (lang, word) pairs of a slice and the number of the pair at every place."""
    w = words.dictionary_encode()
    wide = len(w.dictionary)
    lang = langs.dictionary_encode()
    key = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(wide, 1) + w.indices.to_numpy(zero_copy_only=False)
    pairs, at = np.unique(key, return_inverse=True)
    return lang.dictionary.take(pa.array(pairs // max(wide, 1))), w.dictionary.take(pa.array(pairs % max(wide, 1))), at


def _texts(docs: DataFrame, text_col: str, lang_col: str, *more: Column) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), *more)


def _words_of_slices(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[pa.RecordBatch, pa.Array, pa.Array, np.ndarray, np.ndarray]]:
    """(slice, languages, words, number of the pair at every place, places) of the slices of a batch that hold words.

    Places grow by one from word to word, and by two where a new piece begins, so neighbours are words in a row.
    """
    for part in slices(batch, "text", limit):
        data, bounds = raw_bytes(part.column("text"))
        data = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
        words, value, follows = words_and_pieces(data, bounds)
        if len(words):
            yield part, *_number_of_pairs(words, part.column("lang").take(pa.array(value))), np.cumsum(np.where(follows, 1, 2)).astype(np.uint32)


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, a): how often each word stands in a language; written to a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, langs, distinct, at, _ in _words_of_slices(batch, SLICE_BYTES):
                counts = np.bincount(at, minlength=len(distinct))
                yield pa.RecordBatch.from_arrays([langs, distinct.cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "n"])

    counted = _texts(docs, text_col, lang_col).mapInArrow(run, "lang string, word string, n long")
    return written(counted.groupBy("lang", "word").agg(F.sum("n").alias("a")), "word-counts")


def word_slices(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(slice, lang, word, places): each distinct word of a slice with its places, written to a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, langs, distinct, at, place in _words_of_slices(batch, SLICE_BYTES):
                order = np.argsort(at, kind="stable")
                ends = np.r_[0, np.cumsum(np.bincount(at, minlength=len(distinct)))].astype(np.int32) * 4
                packed = pa.Array.from_buffers(pa.binary(), len(distinct), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(place[order].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(distinct), part.column("first")[0].as_py()), pa.int64()), langs, distinct.cast(pa.string()), packed],
                    ["slice", "lang", "word", "places"],
                )

    rows = _texts(docs, text_col, lang_col, F.monotonically_increasing_id().alias("first"))
    return written(rows.mapInArrow(run, "slice long, lang string, word string, places binary"), "words")


def _in_a_row(at: np.ndarray, ids: np.ndarray) -> bytes:
    """Numbers at growing places one after the other, with 0 where a place is left out."""
    broken = np.r_[False, at[1:] != at[:-1] + 1] if len(at) else np.zeros(0, bool)
    out = np.zeros(len(at) + int(broken.sum()), np.uint32)
    out[np.arange(len(at)) + np.cumsum(broken)] = ids
    return out.tobytes()


def joined_sequences(cut: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(slice, ids): the numbers of the frequent words of a slice in a row, 0 where a row is broken; written to a table.

    The join puts out no more rows than ``cut`` has, as the dictionary holds a word of a language once.
    """
    def rebuild(table: pa.Table) -> pa.Table:
        places, bounds = raw_bytes(table.column("places"))
        at = np.frombuffer(places.tobytes(), np.uint32).astype(np.int64)
        ids = np.repeat(table.column("id").to_numpy(), np.diff(bounds) // 4)
        order = np.argsort(at, kind="stable")
        return pa.table({"slice": table.column("slice").slice(0, 1), "ids": pa.array([_in_a_row(at[order], ids[order])], pa.binary())})

    joined = cut.join(dictionary.select("lang", "word", "id"), ["lang", "word"]).select("slice", "id", "places")
    return written(joined.groupBy("slice").applyInArrow(rebuild, "slice long, ids binary"), "sequences")


def _key_hashes(keys: pa.Array) -> np.ndarray:
    hashes, counts = word_hashes(*raw_bytes(keys))
    return np.add.reduceat(hashes, np.cumsum(counts) - counts) if len(hashes) else hashes


def looked_up(keys: pa.Array, known: pa.Array, hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The number of each key among the known ones, which stand in order of their hashes; 0 if it is not there.

    Keys themselves are compared wherever hashes agree, so a hash never stands for two of them.
    """
    own = _key_hashes(keys)
    first, last = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
    out = np.zeros(len(keys), np.uint32)
    for step in range(int((last - first).max(initial=0))):
        at = np.flatnonzero(first + step < last)
        place = first[at] + step
        same = pc.equal(keys.take(pa.array(at)), known.take(pa.array(place))).to_numpy(zero_copy_only=False)
        out[at[same]] = ids[place[same]]
    return out


def sent_sequences(docs: DataFrame, dictionary: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(ids) of every slice as ``joined_sequences`` gives them; the dictionary, in order of hashes, is sent to the tasks.

    A word is looked up together with its language, a full stop between them; no word holds one.
    """
    rows = dictionary.select("id", F.concat_ws(".", "word", "lang").cast("binary").alias("key")).toArrow()
    keys = rows.column("key").cast(pa.binary()).combine_chunks()
    hashes = _key_hashes(keys)
    order = np.argsort(hashes)
    known = docs.sparkSession.sparkContext.broadcast((keys.take(pa.array(order)), hashes[order], rows.column("id").to_numpy()[order].astype(np.uint32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, langs, distinct, at, place in _words_of_slices(batch, SLICE_BYTES):
                ids = looked_up(pc.binary_join_element_wise(distinct, langs.cast(pa.binary()), pa.scalar(b".")), *known.value)[at]
                kept = np.flatnonzero(ids)
                if len(kept):
                    yield pa.RecordBatch.from_arrays([pa.array([_in_a_row(place[kept], ids[kept])], pa.binary())], ["ids"])

    return written(_texts(docs, text_col, lang_col).mapInArrow(run, "ids binary"), "sequences")


# ---------------------------------------------------------------- packing


def packed(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of word numbers as one integer of ``columns * bits`` bits, given as its upper and lower half."""
    columns = ids.shape[1]
    low = columns * bits // 2
    hi, lo = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
    for i in range(columns):
        shift, word = (columns - 1 - i) * bits, ids[:, i].astype(np.uint64)
        if shift >= low:
            hi |= word << np.uint64(shift - low)
        else:
            lo |= (word << np.uint64(shift)) & _mask(low)
            if shift + bits > low:
                hi |= word >> np.uint64(low - shift)
    return hi, lo


def unpacked(hi: np.ndarray, lo: np.ndarray, columns: int, bits: int) -> np.ndarray:
    low = columns * bits // 2
    ids = np.empty((len(hi), columns), np.int64)
    for i in range(columns):
        shift = (columns - 1 - i) * bits
        if shift >= low:
            word = hi >> np.uint64(shift - low)
        else:
            word = lo >> np.uint64(shift)
            if shift + bits > low:
                word = word | (hi << np.uint64(low - shift))
        ids[:, i] = word & _mask(bits)
    return ids


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def mixed(hi: np.ndarray, lo: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """An invertible mixing of integers of ``width`` bits: each half in turn is changed by what the other one hashes to."""
    low, high = _mask(width // 2), _mask(width - width // 2)
    lo = lo ^ (mix(hi + np.uint64(1)) & low)
    hi = hi ^ (mix(lo + np.uint64(2)) & high)
    lo = lo ^ (mix(hi + np.uint64(3)) & low)
    return hi ^ (mix(lo + np.uint64(4)) & high), lo


def unmixed(hi: np.ndarray, lo: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = _mask(width // 2), _mask(width - width // 2)
    hi = hi ^ (mix(lo + np.uint64(4)) & high)
    lo = lo ^ (mix(hi + np.uint64(3)) & low)
    hi = hi ^ (mix(lo + np.uint64(2)) & high)
    return hi, lo ^ (mix(hi + np.uint64(1)) & low)


# ---------------------------------------------------------------- filters


def added_up(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (hi, lo) once, in order, with the sum of their counts (1 each if none are given)."""
    low = int(lo.max(initial=0)).bit_length()
    order = np.lexsort((lo, hi)) if int(hi.max(initial=0)).bit_length() + low > 64 else np.argsort((hi << np.uint64(low)) | lo)
    hi, lo = hi[order], lo[order]
    new = np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])] if len(hi) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    sums = np.diff(np.r_[starts, len(hi)]) if counts is None else np.add.reduceat(counts[order], starts) if len(starts) else counts
    return hi[starts], lo[starts], sums.astype(np.int64)


class Shape:
    """Filters over integers of ``width`` bits: the first ``ranges`` bits choose the merging task, the next ones the slot.

    A filter has about as many slots as keys; what is left of a key below its slot is its remainder.
    """

    def __init__(self, width: int, ranges: int):
        self.upper, self.lower = width - width // 2, width // 2
        self.ranges = min(ranges, self.upper)

    def _bytes(self, slots: int) -> tuple[int, int, int]:
        rest = self.upper - self.ranges - slots
        return rest, -(-rest // 8), -(-self.lower // 8)

    def filters(self, hi: np.ndarray, lo: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        """(range, slot bits, run lengths, long ones, remainders, counts, large ones) of every range of sorted, distinct keys."""
        number = (hi >> np.uint64(self.upper - self.ranges)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.zeros(0, np.int64)
        for a, b in zip(starts, np.r_[starts[1:], len(hi)], strict=True):
            slots = min(int(b - a).bit_length() - 1, self.upper - self.ranges)
            rest, high_bytes, low_bytes = self._bytes(slots)
            slot = ((hi[a:b] >> np.uint64(rest)) & _mask(slots)).astype(np.int64)
            remainders = np.concatenate([_narrow(hi[a:b] & _mask(rest), high_bytes), _narrow(lo[a:b], low_bytes)], axis=1)
            yield int(number[a]), slots, *_short(np.bincount(slot, minlength=1 << slots)), remainders.tobytes(), *_short(counts[a:b])

    def keys(self, number: int, slots: int, runs: bytes, long_runs: bytes, remainders: bytes, few: bytes, large: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hi, lo, counts) of one filter."""
        rest, high_bytes, low_bytes = self._bytes(slots)
        slot = np.repeat(np.arange(1 << slots, dtype=np.uint64), _unshort(runs, long_runs))
        rows = np.frombuffer(remainders, np.uint8).reshape(len(slot), high_bytes + low_bytes)
        quotient = (np.uint64(number) << np.uint64(slots)) | slot
        return (quotient << np.uint64(rest)) | _wide(rows[:, :high_bytes]), _wide(rows[:, high_bytes:]), _unshort(few, large)


def _short(values: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers in one byte each, and in full those of 255 or more."""
    few = np.minimum(values, 255).astype(np.uint8)
    return few.tobytes(), values[few == 255].astype(np.int64).tobytes()


def _unshort(few: bytes, large: bytes) -> np.ndarray:
    values = np.frombuffer(few, np.uint8).astype(np.int64)
    values[values == 255] = np.frombuffer(large, np.int64)
    return values


def _narrow(values: np.ndarray, size: int) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size]


def _wide(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :rows.shape[1]] = rows
    return out.view("<u8").reshape(-1).astype(np.uint64)


def pair_place(hi: np.ndarray, lo: np.ndarray, map_bits: int) -> np.ndarray:
    """Bit of the map that a pair's mixed integer is looked up at."""
    return (mix(hi * np.uint64(0x9E3779B97F4A7C15) + lo) >> np.uint64(64 - map_bits)).astype(np.int64)


def _runs(ids: np.ndarray, size: int, good: np.ndarray | None) -> np.ndarray:
    """Where ``size`` numbers in a row begin, all of whose pairs are good."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ok = np.ones(n, bool)
    if good is None:
        for k in range(size):
            ok &= ids[k:k + n] != 0
    else:
        for k in range(size - 1):
            ok &= good[k:k + n]
    return np.flatnonzero(ok)


def phrase_counts(sequences: DataFrame, sizes: list[int], bits: int, least: int, words: int, pairs: np.ndarray | None = None) -> DataFrame:
    """(size, hi, lo, n) of all phrases of the given sizes that stand at least ``least`` times; hi and lo hold the mixed integer."""
    ranges = max(3, (words * len(sizes) // HELD).bit_length())
    shapes = {size: Shape(size * bits, ranges) for size in sizes}
    spark = sequences.sparkSession
    known = None if pairs is None else spark.sparkContext.broadcast(pairs)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {size: [] for size in sizes}
        waiting = dict.fromkeys(sizes, 0)

        def send(size: int) -> Iterator[pa.RecordBatch]:
            hi, lo, counts = added_up(*(np.concatenate(x) for x in zip(*held[size], strict=True)))
            held[size], waiting[size] = [], 0
            rows = list(shapes[size].filters(hi, lo, counts))
            for a in range(0, len(rows), 64):
                part = list(zip(*rows[a:a + 64], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * len(part[0]), pa.int32()), pa.array(part[0], pa.int64()), pa.array(part[1], pa.int32()), *(pa.array(x, pa.binary()) for x in part[2:])],
                    FILTER,
                )

        for batch in batches:
            for column in batch.column("ids"):
                ids = np.frombuffer(column.as_buffer(), np.uint32)
                good = None
                if known is not None and len(ids) > 1:
                    both = (ids[:-1] != 0) & (ids[1:] != 0)
                    places = pair_place(*mixed(*packed(np.stack([ids[:-1], ids[1:]], axis=1), bits), 2 * bits), MAP_BITS)
                    good = both & ((known.value[places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool)
                for size in sizes:
                    starts = _runs(ids, size, good)
                    if not len(starts):
                        continue
                    hi, lo = mixed(*packed(np.stack([ids[starts + k] for k in range(size)], axis=1), bits), size * bits)
                    held[size].append(added_up(hi, lo))
                    waiting[size] += len(held[size][-1][0])
                    if waiting[size] > HELD:
                        yield from send(size)
        for size in sizes:
            if held[size]:
                yield from send(size)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        size, shape = key[0].as_py(), shapes[key[0].as_py()]
        parts = [shape.keys(*row) for row in zip(*(table.column(c).to_pylist() for c in FILTER[1:]), strict=True)]
        hi, lo, counts = added_up(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        often = counts >= least
        hi, lo, counts = hi[often], lo[often], counts[often]
        return pa.table({"size": pa.array(np.full(len(hi), size), pa.int32()), "hi": hi.view(np.int64), "lo": lo.view(np.int64), "n": counts})

    filters = sequences.select("ids").mapInArrow(fill, "size int, range long, slots int, runs binary, long_runs binary, remainders binary, counts binary, large binary")
    return written(filters.groupBy("size", "range").applyInArrow(merge, "size int, hi long, lo long, n long"), "phrases")


def pair_map(pairs: DataFrame) -> np.ndarray:
    """The bit map of frequent pairs; its size is fixed, so it may come to the driver whatever their number."""
    chunk = 1 << 13

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(pair_place(batch.column("hi").to_numpy().view(np.uint64), batch.column("lo").to_numpy().view(np.uint64), MAP_BITS))
            yield pa.RecordBatch.from_arrays([pa.array(at // chunk, pa.int64()), pa.array(at % chunk, pa.int64())], ["chunk", "at"])

    def bits(key: tuple, table: pa.Table) -> pa.Table:
        on = np.zeros(chunk, np.uint8)
        on[table.column("at").to_numpy()] = 1
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())})

    marked = pairs.select("hi", "lo").mapInArrow(places, "chunk long, at long").distinct().groupBy("chunk").applyInArrow(bits, "chunk long, bits binary")
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for row in marked.collect():
        begin = row.chunk * chunk // 8
        out[begin:begin + chunk // 8] = np.frombuffer(row.bits, np.uint8)
    return out


# ---------------------------------------------------------------- phrases


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, words, phrase, size, a, n) of all phrases of 1 to ``longest`` words with a >= ``least``; n: words of the language.

    Words stand for themselves as phrases of size 1.
    """
    counts = word_counts(docs, text_col, lang_col)
    totals = written(counts.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
    often = numbered(counts.where(F.col("a") >= least), [F.desc("a"), F.asc("lang"), F.asc("word")], "id", "dictionary")
    size = often.agg(F.count("*").alias("words"), F.sum("a").alias("places"), F.sum(F.octet_length("word") + F.octet_length("lang") + 17).alias("bytes")).first()
    bits, places = max(size.words, 1).bit_length(), size.places or 0
    if bits * longest > 126:
        raise ValueError(f"{size.words} words reach the least count; numbers of {bits} bits do not fit {longest} times into 126")
    if (size.bytes or 0) <= SENT_BYTES:
        sequences = sent_sequences(docs, often, text_col, lang_col)
    else:
        sequences = joined_sequences(word_slices(docs, text_col, lang_col), often)
    found = phrase_counts(sequences, [2], bits, least, places)
    if longest > 2:
        found = found.unionByName(phrase_counts(sequences, list(range(3, longest + 1)), bits, least, places, pair_map(found)))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            hi, lo = (batch.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo"))
            of, at, ids, n = [], [], [], []
            for k in np.unique(size):
                rows = np.flatnonzero(size == k)
                words = unpacked(*unmixed(hi[rows], lo[rows], int(k) * bits), int(k), bits)
                of.append(np.repeat(rows, k))
                at.append(ranges_of(np.full(len(rows), k)))
                ids.append(words.reshape(-1))
                n.append(np.repeat(batch.column("n").to_numpy()[rows], k))
            if of:
                rows, at, ids, n = map(np.concatenate, (of, at, ids, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(size[rows], pa.int32()), pa.array(hi[rows].view(np.int64)), pa.array(lo[rows].view(np.int64)), pa.array(n), pa.array(at, pa.int32()), pa.array(ids)],
                    ["size", "hi", "lo", "a", "at", "id"],
                )

    spelt = found.mapInArrow(numbers, "size int, hi long, lo long, a long, at int, id long").join(often.select("id", "lang", "word"), "id")
    many = spelt.groupBy("size", "hi", "lo").agg(
        F.first("lang").alias("lang"), F.first("a").alias("a"), F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words")
    )
    single = often.select("lang", F.array("word").alias("words"), F.lit(1).alias("size"), "a")
    every = single.unionByName(many.select("lang", "words", "size", "a")).withColumn("phrase", F.array_join("words", " "))
    return written(every.join(totals, "lang"), "spelt")


def _whole_quotient(a: str, n: str, below: tuple[str, str]) -> str:
    """floor(1000 * a * n / (l * r)) in decimals of 38 digits."""
    top = f"cast(1000 as decimal(4, 0)) * cast({a} as decimal(19, 0)) * cast({n} as decimal(19, 0))"
    return f"({top}) div (cast({below[0]} as decimal(19, 0)) * cast({below[1]} as decimal(19, 0)))"


def scored_phrases(phrases: DataFrame) -> DataFrame:
    """(lang, words, phrase, size, a, l, r, n, score): every phrase of two words or more at its lowest-scoring cut."""
    long = phrases.where("size > 1")
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice("words", F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("right", F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " "))
    counts = phrases.select("lang", "phrase", "a")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(_whole_quotient("a", "n", ("l", "r"))))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n", "size", "words")).alias("cut"))
    return best.select("lang", "cut.words", "phrase", "cut.size", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def outermost(phrases: DataFrame, share: int = 100) -> DataFrame:
    """Phrases of two words or more without those inside a longer one that stands at least ``share`` percent as often."""
    longer = phrases.where("size > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)))
    inner = longer.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("k")), " ").alias("phrase"), "a")
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = phrases.where("size > 1").join(most, ["lang", "phrase"], "left")
    return kept.where(f"most is null or 100 * most < {share} * a").drop("most")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, share: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by score, count and bytes."""
    phrases = frequent_phrases(docs, least, longest, text_col, lang_col)
    kept = scored_phrases(phrases).join(outermost(phrases, share).select("lang", "phrase"), ["lang", "phrase"], "left_semi")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
