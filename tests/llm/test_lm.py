import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import lm_scoring, queries
from lakeops.llm.lm_scoring import CLASSES, lm_scores, noise_contrastive

from ..conftest import SF
from .helpers import TEXTS, documents, words


def tokens(text):
    return [*words(text), None]


def test_base_against_brute_force(spark):
    rows = [*TEXTS, *((100 + i, f"the cat {i % 5} sat on the mat{i % 3}") for i in range(40))]
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_scores(documents(spark, rows)).collect()), key=str)
    want = sorted(((i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want])
    assert all(g[5] < 0 for g in got)


@pytest.mark.parametrize("per_range", [8, 10**6])
def test_score_against_brute_force(spark, monkeypatch, per_range):
    """Scores from the model's own table and from counts made in plain Python; also with words too common for a range."""
    monkeypatch.setattr(lm_scoring, "WORDS_PER_RANGE", per_range)
    rng = random.Random(9)
    rows = [*TEXTS, *((100 + i, " ".join(f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(rng.randrange(60)))) for i in range(60))]
    trained = [t for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    counts = Counter(w for t in trained for w in tokens(t))
    scorer, n, _ = lm_scoring.learn(spark.createDataFrame([(t or "",) for t in trained], "text string"))
    assert n == sum(counts.values()) and (len(scorer.common) > 0) == (per_range == 8)
    want = []
    for i, t in rows:
        cls, cells, _, _ = lm_scoring.sequences(pa.array([t or ""]), scorer.classes)
        total = 0.0
        for c, cell, w in zip(cls, cells, tokens(t), strict=True):
            total += scorer.table[cell] + (math.log10(counts[w] + 1) - scorer.within[c] if c > lm_scoring.HOT_WORDS else 0.0)
        want.append((i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.score) for r in lm_scores(documents(spark, rows)).collect()), key=str)
    want = sorted(want, key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])


def test_held_out_texts_are_likelier_than_by_counts_alone(spark):
    rows = [r for r in queries.QUERIES["op3_lm_scores"](spark, SF).collect() if r.held_out]
    assert len(rows) > 10 and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_probabilities_sum_to_one():
    cells = np.array([5, CLASSES + 7, 3 * CLASSES * CLASSES + 2 * CLASSES + 1])
    table = noise_contrastive(cells, np.array([4, 2, 1]), steps=3).log10_probabilities()
    assert table.shape == (CLASSES * CLASSES, CLASSES)
    assert (10.0**table).sum(1) == pytest.approx(np.ones(len(table)))


def test_empty_table(spark):
    assert lm_scores(documents(spark).limit(0)).collect() == []
