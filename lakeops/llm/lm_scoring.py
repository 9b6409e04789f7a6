"""Log-probabilities of whole texts by a log-bilinear model of word classes.

Classes are the end of a text, the commonest words one by one, and the other words by their last two letters. A log-bilinear
model predicts the class of a word from the vectors of the two classes before it; it is trained in numpy by noise-contrastive
estimation on the class triples of all training texts, which Spark counts. The vectors of all contexts times those of all
classes, one batched matrix product, and a sum over the classes give exactly normalised class probabilities. Within a class
a word has its share of the counts, with one added to each and one for all unseen words, so the whole sums to one.

Word counts are never gathered in one place: every text sends the hashes of its rarer words to hash ranges, each range
counts its words over the training texts and sends back one sum per text. Words that would make a large part of a range by
themselves are looked up where the texts are read; there are a few per range at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import fold, give_back, raw_bytes, row_key, slices, word_hashes, written

HOT_WORDS, ENDINGS = 100, 26
CLASSES = 1 + HOT_WORDS + ENDINGS + 1
#: Rare words that one range counts; a word with a quarter of them is not sent to a range.
WORDS_PER_RANGE = 1_500_000
_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32


@dataclass
class Classes:
    """Class of every word: by hash for common words (sorted keys), else by its last two bytes."""

    hot: np.ndarray
    hot_class: np.ndarray
    ending_class: np.ndarray

    def of(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = self.ending_class[endings]
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
            same = self.hot[at] == words
            out[same] = self.hot_class[at[same]]
        return out


@dataclass
class LogBilinear:
    """Vectors of classes as context and as target, one matrix per context place, and a bias per class."""

    context: np.ndarray
    near: np.ndarray
    far: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def raw(self) -> np.ndarray:
        """Scores of every class (columns) after every pair of classes (rows: far * CLASSES + near)."""
        predicted = (self.context @ self.far)[:, None, :] + (self.context @ self.near)[None, :, :]
        return predicted.reshape(-1, self.context.shape[1]) @ self.target.T + self.bias

    def log10_probabilities(self) -> np.ndarray:
        s = self.raw().astype(np.float64)
        top = s.max(1, keepdims=True)
        return (s - top - np.log(np.exp(s - top).sum(1, keepdims=True))) / np.log(10)


def noise_contrastive(cells: np.ndarray, counts: np.ndarray, size: int = 24, noise: float = 20.0, steps: int = 120, rate: float = 0.05, seed: int = 7) -> LogBilinear:
    """Train on counted triples (cell = (far * CLASSES + near) * CLASSES + word).

    Every context draws ``noise`` words from the class frequencies for each true one; the expectation over these draws is
    taken exactly, as all contexts and classes fit in one matrix. Adam on the whole objective.
    """
    rng = np.random.default_rng(seed)
    c = CLASSES
    seen = np.zeros(c * c * c, np.float32)
    seen[cells] = counts
    seen = seen.reshape(c * c, c) / max(float(counts.sum()), 1.0)
    of_context = seen.sum(1, keepdims=True)
    q = seen.sum(0) + 1e-7
    q = (q / q.sum()).astype(np.float32)
    used = np.flatnonzero(of_context[:, 0])
    seen, of_context = seen[used], of_context[used]
    far, near = used // c, used % c
    p = {
        "context": rng.normal(0, 0.3, (c, size)), "near": np.eye(size) + rng.normal(0, 0.05, (size, size)), "far": rng.normal(0, 0.05, (size, size)),
        "target": rng.normal(0, 0.1, (c, size)), "bias": np.log(q),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    floor = np.log(noise * q)
    expected = noise * of_context * q
    for step in range(1, steps + 1):
        by_far, by_near = p["context"] @ p["far"], p["context"] @ p["near"]
        predicted = by_far[far] + by_near[near]
        sure = 1 / (1 + np.exp(-np.clip(predicted @ p["target"].T + p["bias"] - floor, -30, 30)))
        pull = seen * (1 - sure) - expected * sure
        to_predicted = pull @ p["target"]
        at_far, at_near = np.zeros((c, size), np.float32), np.zeros((c, size), np.float32)
        np.add.at(at_far, far, to_predicted)
        np.add.at(at_near, near, to_predicted)
        grads = {
            "target": pull.T @ predicted, "bias": pull.sum(0), "far": p["context"].T @ at_far, "near": p["context"].T @ at_near,
            "context": at_far @ p["far"].T + at_near @ p["near"].T,
        }
        for k, g in grads.items():
            g = g - 1e-6 * p[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            p[k] = p[k] + pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-9)
    return LogBilinear(**p)


@dataclass
class Scorer:
    """What every task needs to score a text; of fixed size but for the common words, of which there are a few per range."""

    classes: Classes
    table: np.ndarray  # log10 probability of a class after two classes
    single: np.ndarray  # per class: log10 of (count + 1) / everything, for classes of one word
    within: np.ndarray  # per class: log10 of (words + distinct words + 1), 0 for classes of one word
    everything: float  # log10 of N + V + 1
    common: np.ndarray  # sorted hashes of words too common for a range
    common_gain: np.ndarray  # log10 of (count + 1) for each of them


def parsed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, words per text, and the last two bytes of each word (A-Z read as a-z)."""
    data, bounds = raw_bytes(column)
    words, many, starts, ends = word_hashes(data, bounds, places=True)
    if not len(words):
        return words, many, np.zeros(0, np.int64)
    low = _LOWER[data]
    return words, many, low[ends - 1] * 256 + np.where(ends - starts > 1, low[ends - 2], 0)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, n) over all texts: each task adds up its own words before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged():
            w, e, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(w, kind="stable")
            w, e, n = w[order], e[order], n[order]
            begins = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            return w[begins], e[begins], np.add.reduceat(n, begins)

        def out(w, e, n):
            for i in range(0, len(w), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(w[i:i + 200_000].view(np.int64)), pa.array(e[i:i + 200_000].astype(np.int32)), pa.array(n[i:i + 200_000])], ["word", "ending", "n"])

        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                words, _, endings = parsed(part.column("text"))
                if len(words):
                    held.append((words, endings, np.ones(len(words), np.int64)))
                    held = [merged()]
                    if len(held[0][0]) > 1_000_000:
                        yield from out(*held.pop())
        if held:
            yield from out(*held[0])

    return docs.mapInArrow(count, "word long, ending int, n long").groupBy("word").agg(F.max("ending").alias("ending"), F.sum("n").alias("n"))


def sequences(column: pa.Array, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the words of each text and its end (class 0), the cell of each triple, hashes (0 for ends), tokens per text."""
    words, many, endings = parsed(column)
    n = len(many)
    tokens = many + 1
    last = np.cumsum(tokens) - 1
    is_word = np.ones(int(tokens.sum()), bool)
    is_word[last] = False
    cls = np.zeros(len(is_word), np.int64)
    cls[is_word] = classes.of(words, endings)
    hashes = np.zeros(len(is_word), np.uint64)
    hashes[is_word] = words
    first = last - tokens + 1
    near = np.r_[0, cls[:-1]]
    far = np.r_[0, 0, cls[:-2]][:len(cls)]
    near[first] = 0
    far[first] = 0
    second = first[tokens > 1] + 1
    far[second] = 0
    return cls, (far * CLASSES + near) * CLASSES + cls, hashes, tokens if n else np.zeros(0, np.int64)


def triples(docs: DataFrame, classes: Classes) -> DataFrame:
    """(cell, n): how often each triple of classes occurs; at most CLASSES ** 3 rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                cells = np.sort(sequences(part.column("text"), classes)[1])
                begins = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]) if len(cells) else np.zeros(0, np.int64)
                total[cells[begins]] += np.diff(np.r_[begins, len(cells)])
        used = np.flatnonzero(total)
        for i in range(0, len(used), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(used[i:i + 200_000]), pa.array(total[used[i:i + 200_000]])], ["cell", "n"])

    return docs.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def learn(training: DataFrame) -> tuple[Scorer, int, int]:
    """Scorer, number of tokens and number of rare words sent to ranges in the training texts (``text``)."""
    texts = training.count()
    counts = written(word_counts(training), "words")
    hot = counts.orderBy(F.desc("n"), "word").limit(HOT_WORDS).collect()
    rare = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(r["word"],) for r in hot], "word long")), "word", "left_anti")
    per_ending = rare.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).orderBy(F.desc("n"), "ending").collect()  # at most 65,536 rows
    ending_class = np.full(1 << 16, CLASSES - 1, np.int64)
    for k, r in enumerate(per_ending[:ENDINGS]):
        ending_class[r["ending"]] = 1 + HOT_WORDS + k
    keys = np.array([r["word"] for r in hot], np.int64).view(np.uint64)
    order = np.argsort(keys)
    classes = Classes(keys[order], 1 + order, ending_class)
    words_in, distinct_in = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_ending:
        words_in[ending_class[r["ending"]]] += r["n"]
        distinct_in[ending_class[r["ending"]]] += r["distinct"]
    rare_words = int(words_in.sum())
    n = texts + sum(r["n"] for r in hot) + rare_words
    v = (texts > 0) + len(hot) + int(distinct_in.sum())
    everything = np.log10(n + v + 1)
    single, within = np.zeros(CLASSES), np.log10(words_in + distinct_in + 1)
    within[:1 + HOT_WORDS] = 0
    single[0] = np.log10(texts + 1) - everything
    for k, r in enumerate(hot):
        single[1 + k] = np.log10(r["n"] + 1) - everything
    counted = triples(training, classes).toArrow()
    model = noise_contrastive(counted.column("cell").to_numpy(), counted.column("n").to_numpy())
    # at most rare_words / (WORDS_PER_RANGE / 4) rows, four for each range
    frequent = sorted((r["word"] & (1 << 64) - 1, r["n"]) for r in rare.where(F.col("n") > WORDS_PER_RANGE // 4).select("word", "n").collect())
    common, often = np.array([w for w, _ in frequent], np.uint64), np.array([k for _, k in frequent], np.float64)
    return Scorer(classes, model.log10_probabilities().ravel(), single, within, everything, common, np.log10(often + 1)), n, rare_words - int(often.sum())


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held_out: int = 2) -> DataFrame:
    """One row per document: doc_id, row_key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Learns from all texts whose crc32(id as text) modulo ``modulus`` is not ``held_out``. A null or empty text is one token,
    its end. Repeated rows count as often as they occur and each get the row's scores; null ids are ids of their own. With
    no training text all counts are 0 and every class is as likely as the untrained model says.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), (fold(id_col, modulus) == held_out).alias("held_out"), row_key(id_col, text_col).alias("row_key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    training = narrow.where(~F.col("held_out")).select("text")
    scorer, train_tokens, rare_words = learn(training)
    shared = spark.sparkContext.broadcast(scorer)
    ranges = max(8, -(-rare_words // WORDS_PER_RANGE))
    trained_texts = scorer.single[0] + scorer.everything > 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Scorer = shared.value
        names = ["part", "batch", "keys", "train", "sizes", "words", "sums"]
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                keys = part.column("row_key").to_numpy()
                train = ~part.column("held_out").to_numpy(zero_copy_only=False)
                cls, cells, hashes, tokens = sequences(part.column("text"), s.classes)
                doc = np.repeat(np.arange(len(keys)), tokens)
                one_word = cls <= HOT_WORDS
                chance = s.table[cells]
                base = np.bincount(doc, np.where(one_word, s.single[cls], -s.everything), len(keys))
                score = np.bincount(doc, chance - s.within[cls], len(keys))
                known = np.bincount(doc, one_word & ((cls > 0) | trained_texts), len(keys))
                rare = ~one_word
                if len(s.common):
                    at = np.minimum(np.searchsorted(s.common, hashes), len(s.common) - 1)
                    found = rare & (s.common[at] == hashes)
                    gain = np.bincount(doc[found], s.common_gain[at[found]], len(keys))
                    base, score, known = base + gain, score + gain, known + np.bincount(doc[found], minlength=len(keys))
                    rare &= ~found
                where = (hashes[rare] % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                owner, codes = doc[rare][order], hashes[rare][order]
                cuts = np.searchsorted(where[order], np.arange(ranges + 1))
                rows, name = [], int(keys.sum())  # any number will do: what carries the same one is added up together
                for r in range(ranges):
                    o, w = owner[cuts[r]:cuts[r + 1]], codes[cuts[r]:cuts[r + 1]]
                    if len(o):
                        begins = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                        packed = (w // np.uint64(ranges)).view(np.uint8).reshape(-1, 8)[:, :6]
                        rows.append((r, name, keys[o[begins]].tobytes(), train[o[begins]].tobytes(), np.diff(np.r_[begins, len(o)]).astype(np.int32).tobytes(), packed.tobytes(), None))
                sums = np.stack([tokens.astype(float), base, score, known.astype(float), np.ones(len(keys))])
                rows.append((name % ranges, name, keys.tobytes(), None, None, None, sums.tobytes()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[2:])], names)

    def look_up(t: pa.Table) -> pa.Table:
        """Counts of a range's words; back to each batch go its keys with what their words add to base and score, and how many are known."""
        rows = list(zip(*(t.column(c).to_pylist() for c in ("batch", "keys", "train", "sizes", "words", "sums")), strict=True))
        out = [(batch, keys, sums) for batch, keys, _, _, _, sums in rows if sums is not None]
        rows = [r for r in rows if r[5] is None]
        if rows:
            sizes = [np.frombuffer(r[3], np.int32).astype(np.int64) for r in rows]
            sz = np.concatenate(sizes)
            train = np.repeat(np.concatenate([np.frombuffer(r[2], bool) for r in rows]), sz)
            code = np.zeros((len(train), 8), np.uint8)
            code[:, :6] = np.frombuffer(b"".join(r[4] for r in rows), np.uint8).reshape(-1, 6)
            code = code.view(np.uint64).ravel()
            order = np.argsort(code, kind="stable")
            code = code[order]
            begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            count = np.zeros(len(code))
            count[order] = np.repeat(np.add.reduceat(train[order].astype(np.int64), begins), np.diff(np.r_[begins, len(code)]))
            at = np.cumsum(sz) - sz
            gain, known = np.add.reduceat(np.log10(count + 1), at), np.add.reduceat((count > 0).astype(float), at)
            ends = np.cumsum([len(x) for x in sizes])
            give_back()
            for r, end, n in zip(rows, ends.tolist(), map(len, sizes), strict=True):
                out.append((r[0], r[1], np.stack([np.zeros(n), gain[end - n:end], gain[end - n:end], known[end - n:end], np.zeros(n)]).tobytes()))
        batches, keys, sums = zip(*out, strict=True)
        return pa.table({"batch": pa.array(batches, pa.int64()), "keys": pa.array(keys, pa.binary()), "sums": pa.array(sums, pa.binary())})

    def add_up(t: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(k, np.int64) for k in t.column("keys").to_pylist()])
        sums = np.concatenate([np.frombuffer(x, float).reshape(5, -1) for x in t.column("sums").to_pylist()], axis=1)
        order = np.argsort(keys, kind="stable")
        begins = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        total = np.add.reduceat(sums[:, order], begins, axis=1)
        return pa.table({"row_key": keys[order][begins], **dict(zip(["n_tokens", "base_score", "score", "n_known", "rows"], total, strict=True))})

    sent = narrow.select("row_key", "held_out", "text").mapInArrow(read, "part int, batch long, keys binary, train binary, sizes binary, words binary, sums binary")
    looked_up = sent.groupBy("part").applyInArrow(lambda t: look_up(t), "batch long, keys binary, sums binary")
    parts = looked_up.groupBy("batch").applyInArrow(lambda t: add_up(t), "row_key long, n_tokens double, base_score double, score double, n_known double, rows double")
    sums = parts.groupBy("row_key").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "base_score", "score", "n_known", "rows")))
    scored = written(sums.select("row_key", *((F.col(c) / F.col("rows")).alias(c) for c in ("n_tokens", "base_score", "score", "n_known"))), "scores")
    return narrow.select("doc_id", "held_out", "row_key").join(scored, "row_key").select(
        "doc_id", "row_key", "held_out", F.round("n_tokens").cast("long").alias("n_tokens"), F.round("n_known").cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
