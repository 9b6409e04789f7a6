"""Toxicity and quality."""

import itertools
import random
import zlib

import numpy as np
import pytest

from lakeops.llm import queries
from lakeops.llm.common import raw_bytes
from lakeops.llm.quality import STATISTICS, discriminant, good_quality, quality_scores, statistics
from lakeops.llm.toxicity import Restorer, _SYMBOL, character_trigrams, not_toxic, restored, toxicity_scores

from ..conftest import SF
from .helpers import TEXTS, documents, labels

import pyarrow as pa  # isort: skip

SYLLABLES = ["ba", "lo", "ri", "ne", "tu", "ka", "mi", "so", "del", "fen"]


def corpus(n=400):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))
    texts, marks = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 80))]
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "moronic", "scumbag"]))
        if not good:
            w = [x.upper() + "!!" for x in w] if rng.random() < 0.5 else [x + "$$$" for x in w]
        texts.append((i, " ".join(w)))
        marks.append((i, good, toxic))
    return texts, marks


def trigrams_of(words):
    table = np.zeros((28, 28, 28))
    for w in words:
        s = [0, 0, *(_SYMBOL[ord(c)] for c in w), 0]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            table[a, b, c] += 1
    return table.ravel()


@pytest.mark.parametrize(("disguised", "plain"), [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("idiooooot", "idiot"), ("i d i o t", "idiot"), ("1 d i 0 t", "idiot"), ("m.o.r.o.n", "moron"), ("sc*m", "scum"), ("plain words stay", "plain words stay"),
    ("the 12 of 1999", "the 12 of 1999"), ("word$$$", "word$$$"),
])
def test_restoring(disguised, plain):
    restorer = Restorer(trigrams_of(["idiot", "moron", "scum", "the", "of", "plain", "words", "stay", "word"] * 50))
    data, bounds = restored(*raw_bytes(pa.array(["before", disguised, "", "after"])), restorer)
    got = [bytes(data[a:b]).decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == ["before", plain, "", "after"]


@pytest.mark.parametrize(("disguised", "plain"), [
    ("i   d \t  i    o   t", "idiot"), ("a s s", "ass"), ("a  $  s", "ass"), ("x i o", "x i o"), ("1 2 3", "1 2 3"), ("a b", "a b"),
    ("word-" * 12 + "m0r0n", "word" * 12 + "moron"), ("word-" * 12 + "-sc*m", "word" * 12 + "scum"), ("m0r0n-" * 4000, "moron" * 4000),
])
def test_restoring_wide_gaps_short_and_long_words(disguised, plain):
    restorer = Restorer(trigrams_of(["idiot", "moron", "ass", "wordword", "wordmoron", "moronmoron", "wordscum", "x", "i", "o"] * 50))
    assert restored(*raw_bytes(pa.array([disguised])), restorer)[0].tobytes().decode().rstrip("-") == plain


def test_long_words_are_read_as_a_whole(monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeo0134@$*-.") for _ in range(300)) for _ in range(10)]
    read = lambda: [(r := Restorer(trigrams_of(["abode", "cab", "dead", "code"] * 9))).viterbi(r.readings(w.encode())) for w in words]
    pieces = read()
    monkeypatch.setattr("lakeops.llm.toxicity.SETTLE", 10**9)
    assert pieces == read()


def test_trigrams_follow_the_texts(spark):
    rows = documents(spark, [(1, "ab"), (2, "AB"), (3, None)])
    table = character_trigrams(rows, "text").reshape(28, 28, 28)
    assert table[0, 0, 1] == 2 and table[0, 1, 2] == 2 and table[1, 2, 0] >= 1 and table.sum() == table[0, 0, 1] + table[0, 1, 2] + table[1, 2].sum() + table[0, 2].sum()


def test_toxic_texts_are_found_also_disguised(spark):
    texts, marks = corpus()
    extra = [(9000, "balo ri 1d10t so"), (9001, "ne m0r0n1c ka"), (9002, "so sc umbag i d i o t mi"), (9003, "balo ri ne tu"), (9004, ""), (9005, None)]
    got = {r.doc_id: r for r in toxicity_scores(documents(spark, texts + extra), labels(spark, marks)).collect()}
    truth = {i: t for i, _, t in marks}
    assert all(got[i].predicted == truth[i] for i in truth if got[i].held_out)
    assert [got[i].predicted for i in range(9000, 9006)] == [1, 1, 1, 0, 0, 0]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    kept = not_toxic(documents(spark, texts + extra), labels(spark, marks))
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_poor_texts_are_found(spark):
    texts, marks = corpus()
    got = {r.doc_id: r for r in quality_scores(documents(spark, texts), labels(spark, marks)).collect()}
    truth = {i: q for i, q, _ in marks}
    assert np.mean([got[i].predicted == truth[i] for i in truth if got[i].held_out]) > 0.98
    kept = good_quality(documents(spark, texts), labels(spark, marks))
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


@pytest.mark.parametrize(("score", "name"), [(toxicity_scores, "toxic"), (quality_scores, "quality")])
def test_awkward_rows(spark, score, name):
    for marks in ([], [(1, 1, 0)], [(1, 1, 0), (7, 0, 1), (1, 1, 0), (None, 1, 1), (8, None, None), (9, 1, 0), (10, 0, 1)]):
        rows = score(documents(spark), labels(spark, marks)).collect()
        assert sorted((r.doc_id for r in rows), key=str) == sorted((i for i, _ in TEXTS), key=str)
        assert all(0 <= r.score <= 1 for r in rows)
    assert score(documents(spark).limit(0), labels(spark, [(1, 1, 0)])).collect() == []


def test_statistics_do_not_depend_on_neighbours():
    texts = ["One line.\nOne line.\nAnother!", "", "x", "a a a b\n\nc", "ÄÖ ß | | $$$", "same\nsame\nsame"]
    together = statistics(*raw_bytes(pa.array(texts)))
    assert together.shape == (len(texts), len(STATISTICS))
    for k, t in enumerate(texts):
        assert np.allclose(together[k], statistics(*raw_bytes(pa.array([t])))[0]), t
    assert together[5, STATISTICS.index("repeated_lines")] == pytest.approx(2 / 3)


def test_discriminant_is_the_gaussian_density_ratio():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(50, 3)) @ rng.normal(size=(3, 3)) + k for k in (0, 2)]
    m = discriminant(np.array([50.0, 50.0]), np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), 0.0)
    point = np.array([[1.0, 0.5, 0.2]])
    density = []
    for v in x:
        c = np.cov(v.T, bias=True)
        d = point[0] - v.mean(0)
        density.append(np.exp(-0.5 * d @ np.linalg.inv(c) @ d) / np.sqrt(np.linalg.det(c)))
    assert m.score(point)[0] == pytest.approx(density[1] / sum(density))


def test_held_out_rows_of_the_smoke_tables(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op10_quality"](spark, SF).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id].quality for r in rows]) > 0.85


def test_decoding_against_all_readings():
    """The decoder's spelling is one of the cheapest among all paths through short lattices."""
    rng = random.Random(12)
    restorer = Restorer(trigrams_of(["idiot", "moron", "ass", "code", "bad", "toad", "sat"] * 20))

    def price(text, extra):
        x, y, total = 0, 0, extra
        for c in text + " ":
            z = int(_SYMBOL[ord(c)])
            total += restorer.cost[x, y, z]
            x, y = (0, 0) if z == 0 else (y, z)
        return total

    for _ in range(120):
        word = "".join(rng.choice("aiosdt0134@$!-.") * rng.choice([1, 1, 1, 3]) for _ in range(rng.randint(1, 6)))
        places = restorer.readings(word.encode())
        paths = {}
        for path in itertools.product(*places):
            text = "".join(t for t, _ in path)
            paths[text] = min(paths.get(text, np.inf), price(text, sum(c for _, c in path)))
        best = min(paths.values())
        got = restorer.viterbi(places).decode()
        assert min(p for t, p in paths.items() if t.strip() == got) == pytest.approx(best), word


def test_lexicon_counts_against_plain_python(spark):
    """Every labelled row teaches once, and rows that are held out teach nothing."""
    texts, marks = corpus(60)
    docs = documents(spark, texts)
    scored = {r.doc_id: (r.held_out, r.score) for r in toxicity_scores(docs, labels(spark, marks)).collect()}
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(i for i, (h, _) in scored.items() if h) == held
    other = [(i, q, 1 - t) if i in held else (i, q, t) for i, q, t in marks]
    again = {r.doc_id: r.score for r in toxicity_scores(docs, labels(spark, other)).collect()}
    assert all(again[i] == pytest.approx(s) for i, (_, s) in scored.items())
