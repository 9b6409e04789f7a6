"""Toxicity of whole texts after undoing disguised spelling.

Noisy channel: a word with digits or signs between letters, stretched letters or letters set apart is a lattice of what was
meant. A character model, counted over all texts, and the costs of each disguise choose the likeliest reading (Viterbi over
pairs of letters). Words without such marks have one reading and stay as they are. The restored text is scored by a lexicon
of letter groups inside words, learnt from labelled rows, and a logistic model over the strongest groups of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import distinct, fold, raw_bytes, slices, written

#: Letters that digits and signs stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz",
}
_DROPPED = "-._~^'`*:;,/\\|+=#&%"
LETTERS_APART, SETTLE = 3, 64
#: Labelled rows learnt from at most, taken by the hash of their id; size of the lexicon at most (parameters of the model).
SAMPLE_ROWS, LEXICON_SIZE = 20_000, 8192
_SYMBOLS = 28
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = 27
_FOLDED = np.full(256, 32, np.uint8)
_FOLDED[97:123] = np.arange(97, 123)
_FOLDED[65:91] = np.arange(97, 123)
_FOLDED[128:] = np.arange(128, 256)
_LETTER = _FOLDED != 32
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in {*LOOKALIKES, *_DROPPED}]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_APART = re.compile(rb"(?<!\S)[A-Za-z0-9@$!|](?:[ \t]+[A-Za-z0-9@$!|]){%d,}(?!\S)" % (LETTERS_APART - 1))
GRAM = 5


# ---------------------------------------------------------------- restoring


class Restorer:
    """Likeliest plain spelling of disguised words; remembers words it has read."""

    def __init__(self, trigrams: np.ndarray, remembered: int = 200_000):
        counts = trigrams.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS) + 0.1
        self.cost = -np.log(counts / counts.sum(2, keepdims=True))
        self.known: dict[bytes, bytes] = {}
        self.remembered = remembered

    def readings(self, word: bytes) -> list[list[tuple[str, float]]]:
        """For each place of the word what may have been meant there, with its cost; a blank ends a word."""
        places, i, text = [], 0, word.decode("latin-1").lower()
        while i < len(text):
            c, end = text[i], i + 1
            while end < len(text) and text[end] == c:
                end += 1
            if "a" <= c <= "z" or c >= "\x80":
                places.append([(c, 0.7), (c * 2, 0.7)] if end - i > 2 else [(c * (end - i), 0.0)])
            else:
                meant = [(x, 0.4 + np.log(len(LOOKALIKES[c]))) for x in LOOKALIKES.get(c, "")]
                places.append([*meant, *([("", 1.2)] if c in _DROPPED else []), (" ", 3.0)])
            i = end
        return places

    def restore(self, word: bytes) -> bytes:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.remembered:
                self.known.clear()
            found = self.known[word] = self.viterbi(self.readings(word))
        return found

    def joined(self, run: bytes) -> bytes:
        """A run of single letters set apart as one word; one of three letters only if that is likelier than three words."""
        letters = run.split()
        if len(letters) > LETTERS_APART:
            return self.restore(b"".join(letters))
        if not any(x.isalpha() for x in letters):
            return run
        key = b" ".join(letters)
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= self.remembered:
                self.known.clear()
            places = [p for x in letters for p in ([("", 1.2), (" ", 0.0)], self.readings(x)[0])]
            found = self.known[key] = self.viterbi(places[1:])
        return run if b" " in found else found

    def viterbi(self, places: list[list[tuple[str, float]]]) -> bytes:
        # state: the last two symbols -> (cost, link to what was read)
        states: dict[tuple[int, int], tuple[float, list | None]] = {(0, 0): (0.0, None)}
        settled: list[str] = []
        check = SETTLE
        for k, options in enumerate([*places, [(" ", 0.0)]], 1):
            after: dict[tuple[int, int], tuple[float, list | None]] = {}
            for (a, b), (cost, trace) in states.items():
                for text, extra in options:
                    x, y, total = a, b, cost + extra
                    for c in text:
                        z = int(_SYMBOL[ord(c)])
                        total += self.cost[x, y, z]
                        x, y = (0, 0) if z == 0 else (y, z)
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, [trace, text])
            states = after
            if k >= check:
                # The longer the states disagree, the later they are asked again: the time grows with the length only.
                check = k + max(SETTLE, self.settle(states, settled))
        settled.append(self.traced(min(states.values(), key=lambda s: s[0])[1]))
        return "".join(settled).strip().encode("latin-1")

    @staticmethod
    def traced(trace: list | None) -> str:
        parts = []
        while trace is not None:
            trace, text = trace
            parts.append(text)
        return "".join(reversed(parts))

    def settle(self, states: dict[tuple[int, int], tuple[float, list | None]], settled: list[str]) -> int:
        """Move what all states have read alike to ``settled``; the number of places they still disagree on."""
        level, open_places = {id(t): t for _, t in states.values()}, 0
        while len(level) > 1:
            level = {id(t[0]): t[0] for t in level.values()}
            open_places += 1
        shared = next(iter(level.values()))
        if shared is not None:
            settled.append(self.traced(shared))
            shared[:] = [None, ""]
        return open_places


def disguised(data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Spans of words that hold signs between letters, a letter three times in a row, or single letters set apart."""
    # Texts are set apart by a blank, so that no word reaches into the next text.
    many = len(bounds) - 1
    owner = np.repeat(np.arange(many), np.diff(bounds))
    apart = np.full(len(data) + many, 32, np.uint8)
    apart[np.arange(len(data)) + owner] = data
    data, bounds = apart, bounds + np.arange(many + 1)
    n = len(data)
    if n < 3:
        return []
    letter, sign = _LETTER[data], _SIGN[data]
    folded = _FOLDED[data]
    mark = np.zeros(n, bool)
    mark[1:-1] = letter[:-2] & letter[1:-1] & letter[2:] & (folded[:-2] == folded[1:-1]) & (folded[1:-1] == folded[2:]) & (data[1:-1] < 128)
    edge = letter[1:] & sign[:-1] | letter[:-1] & sign[1:]
    near = np.zeros(n, bool)
    near[1:] |= edge & letter[1:]
    near[:-1] |= edge & letter[:-1]
    # A sign counts if letters stand on both sides of its run of signs.
    runs = np.flatnonzero(np.diff(np.r_[False, sign, False].astype(np.int8)))
    begins, ends = runs[::2], runs[1::2]
    within = (begins > 0) & (ends < n)
    within[within] = letter[begins[within] - 1] & letter[ends[within]]
    mark[begins[within]] = True
    # A word may also begin with a look-alike: @ss, 1diot.
    first = begins[(ends < n)]
    first = first[letter[ends[ends < n]] & ((first == 0) | _SPACE[data[first - 1]])]
    mark[first] = True
    places = np.flatnonzero(mark)
    spans: list[tuple[int, int]] = []
    if len(places):
        gaps = np.r_[-1, np.flatnonzero(_SPACE[data]), n]
        low = np.maximum(gaps[np.searchsorted(gaps, places, "left") - 1] + 1, bounds[np.searchsorted(bounds, places, "right") - 1])
        high = np.minimum(gaps[np.searchsorted(gaps, places, "right")], bounds[np.searchsorted(bounds, places, "right")])
        keep = np.r_[True, low[1:] != low[:-1]]
        spans = list(zip(low[keep].tolist(), high[keep].tolist(), strict=True))
    space = np.r_[True, _SPACE[data], True]
    start = ~space[1:-1] & space[:-2]
    single = start & space[2:]
    if single.sum() >= LETTERS_APART:
        # Only texts in which words of one letter follow one another are searched for letters set apart, however wide the gaps.
        at = np.flatnonzero(single)
        word = np.searchsorted(np.flatnonzero(start), at)
        at = at[LETTERS_APART - 1:][word[LETTERS_APART - 1:] - word[:1 - LETTERS_APART] == LETTERS_APART - 1]
        for k in distinct(np.searchsorted(bounds, at, "right") - 1).tolist():
            begin = int(bounds[k])
            for m in _APART.finditer(data[begin:int(bounds[k + 1])].tobytes()):
                spans.append((begin + m.start(), begin + m.end()))
    spans.sort()
    text_of = (np.searchsorted(bounds, [b for b, _ in spans], "right") - 1).tolist()
    return [(begin - k, end - k) for (begin, end), k in zip(spans, text_of, strict=True)]


def restored(data: np.ndarray, bounds: np.ndarray, restorer: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """The texts with every disguised word replaced by its likeliest reading."""
    spans = disguised(data, bounds)
    if not spans:
        return data, bounds
    pieces, at, shift, moved = [], 0, 0, bounds.copy()
    raw = data.tobytes()
    starts, shifts = [], []
    for begin, end in spans:
        if begin < at:
            continue
        word = raw[begin:end]
        fixed = restorer.joined(word) if _APART.fullmatch(word) else restorer.restore(word)
        pieces += [raw[at:begin], fixed]
        shift += len(fixed) - (end - begin)
        starts.append(end)
        shifts.append(shift)
        at = end
    pieces.append(raw[at:])
    moved += np.r_[0, shifts][np.searchsorted(starts, bounds, "right")]
    return np.frombuffer(b"".join(pieces), np.uint8), moved


def character_trigrams(docs: DataFrame, text_col: str) -> np.ndarray:
    """Counts of letter triples inside words over all texts; the table has a fixed size of 28 * 28 * 28."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, np.int64)
        for batch in batches:
            for part in slices(batch, text_col, 4 << 20):
                s = _SYMBOL[raw_bytes(part.column(text_col))[0]]
                for begin in range(0, len(s), 1 << 22):
                    t = np.r_[0, 0, s[max(begin - 2, 0):begin + (1 << 22)], 0]
                    t = t if begin == 0 else t[2:-1]
                    # A letter right after a gap follows two gaps, as at the start of a word.
                    first = np.where(t[1:-1] == 0, 0, t[:-2])
                    total += np.bincount((first * _SYMBOLS + t[1:-1]) * _SYMBOLS + t[2:], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    table = np.zeros(_SYMBOLS**3)
    for r in docs.select(text_col).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        table[r["cell"]] = r["n"]
    table[0] = 0
    return table


# ---------------------------------------------------------------- scoring


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Five-byte groups whose three inner bytes are letters (a blank marks a word's end), and the text each is from."""
    text = _FOLDED[data]
    spaced = np.full(len(text) + len(bounds) + 1, 32, np.uint8)
    spaced[np.arange(len(text)) + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) + 1] = text
    keep = np.r_[True, (spaced[1:] != 32) | (spaced[:-1] != 32)]
    place = np.flatnonzero(keep)
    s = spaced[place]
    if len(s) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inner = (s[1:-3] != 32) & (s[2:-2] != 32) & (s[3:-1] != 32)
    at = np.flatnonzero(inner)
    key = np.zeros(len(at), np.uint64)
    for k in range(GRAM):
        key = (key << np.uint64(8)) | s[at + k]
    starts = bounds[:-1] + np.arange(len(bounds) - 1) + 1
    return key, np.searchsorted(starts, place[at + 1], "right") - 1


@dataclass
class Model:
    """Lexicon (sorted keys and their weights) and the weights of a logistic model over a text's strongest groups."""

    trigrams: np.ndarray
    keys: np.ndarray
    weights: np.ndarray
    final: np.ndarray

    def __post_init__(self):
        self.hint = np.zeros(1 << 20, bool)
        self.hint[self.place(self.keys)] = True

    @staticmethod
    def place(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def evidence(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        key, owner = grams(data, bounds)
        out = np.zeros((n, 5))
        out[:, 0] = 1
        if not len(self.keys):
            return out
        maybe = self.hint[self.place(key)]
        key, owner = key[maybe], owner[maybe]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        pair = distinct(owner[hit] * len(self.keys) + at[hit])
        owner, weight = pair // len(self.keys), self.weights[pair % len(self.keys)]
        order = np.lexsort((-weight, owner))
        owner, weight = owner[order], weight[order]
        begins = np.searchsorted(owner, np.arange(n))
        rank = np.arange(len(owner)) - begins[owner]
        for k in (0, 1):
            out[owner[rank == k], 1 + k] = weight[rank == k]
        out[:, 3] = np.log1p(np.bincount(owner, weight > 2, n))
        out[:, 4] = np.log1p(np.bincount(owner, weight, n))
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.final, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights by Newton steps with a small ridge, which also holds for classes that can be told apart exactly."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, size: int = LEXICON_SIZE, least: float = 20.0) -> Model:
    """Learn from at most ``rows`` labelled rows (by the hash of their id) whose crc32(id as text) mod 4 is not 2."""
    trigrams = character_trigrams(docs, text_col)
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 4) != 2)).groupBy(F.col("doc_id").alias("id"))
    known = known.agg(F.max(label_col).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id").dropDuplicates(["id"])
    sample = written(chosen.select("text", "label").repartition(8), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(trigrams)
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                key, owner = grams(*restored(*raw_bytes(part.column("text")), restorer))
                order = np.lexsort((owner, key))
                key, owner = key[order], owner[order]
                new = np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])] if len(key) else np.zeros(0, bool)
                key, toxic = key[new], part.column("label").to_numpy(zero_copy_only=False)[owner[new]]
                begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                ones = np.add.reduceat(toxic, begins) if len(key) else np.zeros(0)
                many = np.diff(np.r_[begins, len(key)])
                yield pa.RecordBatch.from_arrays([pa.array(key[begins].astype(np.int64)), pa.array(ones, pa.int64()), pa.array(many - ones, pa.int64())], ["key", "p", "q"])

    totals = sample.agg(F.sum("label"), F.count("*")).first()
    p_all, n_all = float(totals[0] or 0), float(totals[1])
    keys, weights = np.zeros(0, np.uint64), np.zeros(0)
    if 0 < p_all < n_all:
        base = p_all / n_all
        n = F.col("p") + F.col("q")
        log = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(F.lit(0.0))
        seen = sample.mapInArrow(count, "key long, p long, q long").groupBy("key").agg(F.sum("p").cast("double").alias("p"), F.sum("q").cast("double").alias("q"))
        strength = 2 * (log(F.col("p"), n * base) + log(F.col("q"), n * (1 - base)))
        picked = seen.where(F.col("p") > n * base).withColumn("strength", strength).where(F.col("strength") >= least).orderBy(F.desc("strength"), "key").limit(size).collect()
        picked.sort(key=lambda r: r["key"])
        keys = np.array([r["key"] for r in picked], np.uint64)
        p, q = np.array([r["p"] for r in picked]), np.array([r["q"] for r in picked])
        weights = np.log((p + 0.5) / (p_all + 1)) - np.log((q + 0.5) / (n_all - p_all + 1))
    model = Model(trigrams, keys, weights, np.zeros(5))
    rows_seen = sample.mapInArrow(_evidence(model, ["label"]), "label int, e array<double>").collect()
    if rows_seen:
        model.final = logistic(np.array([r["e"] for r in rows_seen]), np.array([r["label"] for r in rows_seen], float))
    return model


def _evidence(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.trigrams)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                e = model.evidence(*restored(*raw_bytes(part.column("text")), restorer))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(e) + 1, dtype=np.int32) * e.shape[1]), pa.array(e.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "e"])

    return run


def not_toxic(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; all columns kept, nothing shuffled."""
    model = fit(docs, labels, label_col, id_col, text_col, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.trigrams)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                score = model.score(model.evidence(*restored(*raw_bytes(part.column(text_col)), restorer)))
                yield part.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, row_key, held_out, score and predicted.

    Null and empty texts hold no evidence and get the model's score for that; repeated rows and null ids keep a row each,
    and a null id has no label. Without labels, or with labels of one kind only, the score is the smoothed share of ones.
    """
    model = fit(docs, labels, label_col, id_col, text_col, rows)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("row_key"), (fold(id_col, 4) == 2).alias("held_out"), F.col(text_col).alias("text"))
    keep = ["doc_id", "row_key", "held_out"]
    schema = T.StructType([*(narrow.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    evidence = _evidence(model, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in evidence(batches):
            score = model.score(part.column("e").flatten().to_numpy().reshape(part.num_rows, -1))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(score)], [*keep, "score"])

    return narrow.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
