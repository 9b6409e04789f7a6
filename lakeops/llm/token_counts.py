"""Token counts of whole texts by byte-level merges, applied to many pre-tokens at once.

The distinct pre-tokens of a batch are held as one ragged array of symbols. In every round each sequence merges all places
of its own lowest-ranked pair; sequences without a mergeable pair leave. What is left is counted. A pair made of a new
symbol always ranks after the merge that made it, so this gives the same symbols as merging one pair at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import Numbered, distinct, ranges_of

#: Fixed value: how byte-level vocabularies cut a text before merging.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a Python worker remembers; when full, the memory starts anew.
REMEMBERED = 700_000
_NEVER = np.int64(1) << np.int64(40)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class Merges:
    """Merge rules of one vocabulary as sorted arrays."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab = model["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.size = max(vocab.values()) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.bytes = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.specials = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)

    def symbols_left(self, pre_tokens: list[bytes]) -> np.ndarray:
        """Number of tokens of each pre-token."""
        sizes = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        result = sizes.copy()
        sym = self.bytes[np.frombuffer(b"".join(pre_tokens), np.uint8)]
        who = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(sym), _NEVER)
        inner = np.flatnonzero(who[1:] == who[:-1])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        while len(sym):
            begins = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            lowest = np.minimum.reduceat(rank, begins)
            lengths = np.diff(np.r_[begins, len(sym)])
            alive = np.repeat(lowest < _NEVER, lengths)
            if not alive.all():
                sym, who, rank = sym[alive], who[alive], rank[alive]
                if not len(sym):
                    break
                keep = lowest < _NEVER
                lowest, lengths = lowest[keep], lengths[keep]
            hit = rank == np.repeat(lowest, lengths)
            places = np.flatnonzero(hit)
            # In a run of overlapping hits (x x x ...) only every second one, counted from the left, can merge.
            run = np.r_[True, np.diff(places) != 1]
            places = places[ranges_of(np.diff(np.r_[np.flatnonzero(run), len(places)])) % 2 == 0]
            result -= np.bincount(who[places], minlength=len(result))
            sym[places] = self.made[rank[places]]
            stay = np.ones(len(sym), bool)
            stay[places + 1] = False
            moved = places - np.arange(len(places))
            sym, who = sym[stay], who[stay]
            # The last of a merged pair hands on its right-hand border.
            rank[places] = rank[places + 1]
            rank = rank[stay]
            fresh = distinct(np.r_[moved, moved[moved > 0] - 1])
            inside = fresh[fresh + 1 < len(sym)]
            rank[fresh] = _NEVER
            inside = inside[who[inside] == who[inside + 1]]
            rank[inside] = self.rank(sym[inside], sym[inside + 1])
        return result


class TextCounter:
    """Token counts of texts; words and pre-tokens are worked out once and remembered."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.find = regex.compile(PRE_TOKENS).findall
        self.special = re.compile("|".join(map(re.escape, merges.specials))).search if merges.specials else None
        self.forget()

    def forget(self) -> None:
        self.parts, self.pre_tokens = Numbered(), Numbered()
        self.part_sizes, self.pre_sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self) -> None:
        """Work out the sizes of the parts that have not been met before."""
        found: list[int] = []
        many: list[int] = []
        number = self.pre_tokens.__getitem__
        for part in self.parts.taken():
            if part[part[:1] == " ":].isalpha():
                found.append(number(part))
                many.append(1)
            else:
                cut = self.find(part)
                found.extend(map(number, cut))
                many.append(len(cut))
        fresh = self.pre_tokens.taken()
        if fresh:
            self.pre_sizes = np.r_[self.pre_sizes, self.merges.symbols_left([p.encode() for p in fresh])]
        if many:
            sums = np.r_[0, np.cumsum(self.pre_sizes[np.array(found, np.int64)])]
            self.part_sizes = np.r_[self.part_sizes, np.diff(sums[np.r_[0, np.cumsum(many)]])]

    def plain(self, texts: list[str]) -> list[int]:
        """Texts without special tokens. A text cut before each single space falls into parts that are cut further on their own."""
        if len(self.parts) > REMEMBERED or len(self.pre_tokens) > REMEMBERED:
            self.forget()
        index: list[int] = []
        ends = [0]
        number = self.parts.__getitem__
        for text in texts:
            if "  " in text:
                index.extend(map(number, self.find(text)))
            elif text:
                # A mark before each space keeps the space with the word that follows it.
                index.extend(map(number, text.replace(" ", "\0 ").split("\0") if "\0" not in text else self.find(text)))
            ends.append(len(index))
        self.learn()
        return np.diff(np.r_[0, np.cumsum(self.part_sizes[np.array(index, np.int64)])][ends]).tolist()

    def counts(self, texts: list[str]) -> list[int]:
        if self.special is None or not any(map(self.special, texts)):
            return self.plain(texts)
        split = re.compile("|".join(map(re.escape, self.merges.specials))).split
        pieces = [split(t) for t in texts]
        flat = iter(self.plain([p for ps in pieces for p in ps]))
        return [sum(next(flat) for _ in ps) + len(ps) - 1 for ps in pieces]


_COUNTERS: dict[str, TextCounter] = {}


def _counter(name: str, merges: Merges) -> TextCounter:
    """The counter of this Python worker, kept from task to task with what it remembers."""
    if name not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[name] = TextCounter(merges)
    return _COUNTERS[name]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens and over_limit.

    vocabulary: a byte-level merge file in JSON, read by the driver and sent to the executors (its size is fixed).
    A null text counts as empty (0 bytes, 0 tokens); null and repeated ids keep a row each; other columns are not read.
    Special strings inside a text count as one token each, as the file's own library does.
    """
    with open(vocabulary, "rb") as f:
        content = f.read()
    name = hashlib.sha256(content).hexdigest()
    merges = docs.sparkSession.sparkContext.broadcast(Merges(json.loads(content)))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(name, merges.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                texts = part.column("text").to_pylist()
                sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counter.counts(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return narrow.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
