"""Collocations against counts made in plain Python, and filters against what they were made of."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from lakeops.llm import phrases
from lakeops.llm.phrases import Shape, added_up, collocations, mixed, packed, unmixed, unpacked

from .helpers import LONG, UPPER, same_as_oracle


def brute(rows, least, longest=5, share=100, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cands = {(lang, g): a for (lang, g), a in f.items() if len(g) > 1 and a >= least}
    most = Counter()
    for (lang, g), a in cands.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                most[lang, g[i:i + k]] = max(most[lang, g[i:i + k]], a)
    out = {}
    for (lang, g), a in cands.items():
        if (lang, g) in most and 100 * most[lang, g] >= share * a:
            continue
        score, k = min((1000 * a * total[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return sorted((lang, r + 1, p.decode(), -a, left, right, total[lang], -s) for lang, rows in out.items() for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def corpus():
    rng = random.Random(3)
    vocabulary = ["a", "b", "été", "C", "d-e", "é", "x" * 90, "\x00", "　z", "f'g"]
    rows = [(rng.choice(["en", "fr", None, "und", ""]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", ".", "\n", " ; "]) for _ in range(rng.randrange(90)))) for _ in range(120)]
    rows += [("en", "New York City Hall in the rain")] * 30 + [("fr", "New York City")] * 9
    return [*rows, ("en", None), ("en", ""), (None, " \t"), ("de", LONG), ("de", "one")]


def table(spark, rows):
    extra = ["slice", "word", "id", "n", "phrase", "size", "a"]
    return spark.createDataFrame([(i, t, lang, *(0 for _ in extra)) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, " + ", ".join(f"{c} int" for c in extra))


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize(("least", "share"), [(5, 100), (3, 60)])
def test_against_brute_force(spark, least, share):
    rows = corpus()
    assert got(collocations(table(spark, rows), least, share=share)) == brute(rows, least, share=share)


def test_many_small_filters(spark, monkeypatch):
    # Filters are sent after a few phrases and cut into many ranges; slices hold a few texts; the map of pairs is full.
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 300)
    monkeypatch.setattr(phrases, "MAP_BITS", 14)
    rows = corpus()[:150]
    assert got(collocations(table(spark, rows), 4, top=40)) == brute(rows, 4, top=40)


def test_empty_tables_and_rare_words(spark):
    assert collocations(table(spark, corpus()).limit(0)).collect() == []
    assert collocations(table(spark, [("en", "a b c")])).collect() == []
    assert got(collocations(table(spark, [("en", "a b")] * 3), 2)) == brute([("en", "a b")] * 3, 2)


@pytest.mark.parametrize("sent", [True, False])
def test_list_of_frequent_words(spark, monkeypatch, sent):
    # A list that is sent meets no join of the words of all slices; one that is too long is joined, with the same result.
    plans, written = {}, phrases.written

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return written(df, label)

    monkeypatch.setattr(phrases, "written", noted)
    if not sent:
        monkeypatch.setattr(phrases, "SENT_BYTES", 0)
    rows = [*corpus(), *[("b c", "a b d")] * 4, *[("c", "a b d a")] * 4, *[(" ", "b")] * 4]
    assert got(collocations(table(spark, rows), 4)) == brute(rows, 4)
    assert ("Join" in plans["sequences"]) != sent


def test_words_with_equal_hashes(monkeypatch):
    keys = pa.array([w.encode() for w in ["a.en", "b.en", "été.", "a.b c", "\x00.und", "a.und", "x" * 600_000 + ".en"]], pa.binary())
    for known in (keys, keys.slice(2, 3), keys.slice(0, 0)):
        for hashes in (phrases._key_hashes, lambda k: np.arange(len(k), dtype=np.uint64) * np.uint64(0), lambda k: pc.binary_length(k).to_numpy().astype(np.uint64)):
            monkeypatch.setattr(phrases, "_key_hashes", hashes)
            order = np.argsort(hashes(known), kind="stable")
            found = phrases.looked_up(keys, known.take(pa.array(order)), hashes(known)[order], (order + 1).astype(np.uint32))
            assert found.tolist() == [known.to_pylist().index(k) + 1 if k in known.to_pylist() else 0 for k in keys.to_pylist()]
        monkeypatch.undo()


@pytest.mark.parametrize(("columns", "bits", "ranges"), [(2, 1, 3), (2, 17, 4), (3, 17, 9), (5, 25, 3), (5, 7, 20), (4, 16, 0)])
def test_filters_are_lossless(columns, bits, ranges):
    rng = np.random.default_rng(columns * bits)
    ids = rng.integers(0, 1 << bits, (4000, columns))
    hi, lo = packed(ids, bits)
    assert (unpacked(hi, lo, columns, bits) == ids).all()
    width = columns * bits
    a, b = mixed(hi, lo, width)
    assert all((x == y).all() for x, y in zip(unmixed(a, b, width), (hi, lo), strict=True))
    keys = added_up(a, b, rng.integers(1, 900, len(a)))
    shape = Shape(width, ranges)
    back = [shape.keys(*row) for row in shape.filters(*keys)]
    assert all((np.concatenate(x) == y).all() for x, y in zip(zip(*back, strict=True), keys, strict=True))


def test_oracle(spark):
    same_as_oracle(spark, "op12_collocations")
