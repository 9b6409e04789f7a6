import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import common
from lakeops.llm.common import components, raw_bytes, word_hashes

from .helpers import TEXTS, UPPER


@pytest.mark.parametrize("piece", [7, 64, 1 << 21])
def test_words_are_those_of_the_pattern(monkeypatch, piece):
    monkeypatch.setattr(common, "_PIECE", piece)
    monkeypatch.setattr(common, "_POWERS", [])
    texts = [*(t if t is None or len(t) < 5000 else t[:5000] for _, t in TEXTS), "end", "start ", " x", "", "a" * 500, "é" * 50]
    hashes, many = word_hashes(*raw_bytes(pa.array(texts)))
    found = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER)) for t in texts]
    assert many.tolist() == list(map(len, found))
    by_word = {}
    for w, h in zip((w for f in found for w in f), hashes.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_sliced_arrays():
    whole = pa.array(["ab c", None, "", "d e f", "g"])
    assert word_hashes(*raw_bytes(whole.slice(3, 2)))[1].tolist() == [3, 1]
    assert (word_hashes(*raw_bytes(whole))[0][2:] == word_hashes(*raw_bytes(whole.slice(3)))[0]).all()


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(70)], "star": [(5, i) for i in range(80)], "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "loops": [(1, 1), (2, 2)]}[shape]
    order = list(range(300))
    rng.shuffle(order)
    edges = [(order[a], order[b]) for a, b in edges]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in linked}


def test_distinct_and_ranges():
    assert common.distinct(np.array([3, 1, 3, 2])).tolist() == [1, 2, 3]
    assert common.ranges_of(np.array([2, 0, 3])).tolist() == [0, 1, 0, 1, 2]
