import random

import numpy as np
from pyspark.sql import functions as F

from lakeops.llm import jaccard_groups
from lakeops.llm.jaccard_groups import jaccard_classes, one_of_each_class

from .helpers import TEXTS, documents, words


def shingles(text, width):
    w = words(text)
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width, part):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= part * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((i, len(sets[k]), least[find(k)] if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str), groups


def check(spark, rows, width=4, part=85):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(documents(spark, rows), width, part).collect()), key=str)
    assert got == brute(rows, width, part)[0]


def variants():
    """Chains of texts near the threshold, built of shared passages, so that groups link with one another."""
    rng = random.Random(4)
    passages = [" ".join(f"p{p}w{rng.randrange(400)}" for _ in range(40)) for p in range(6)]
    rows = []
    for i in range(160):
        w = " ".join(rng.sample(passages, 2)).split()
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    base = " ".join(f"c{k}" for k in range(60)).split()
    for i in range(40):
        for _ in range(1):
            base[rng.randrange(60)] = f"y{i}"
        rows.append((1000 - i, " ".join(base)))
    return rows


def test_against_brute_force(spark):
    check(spark, variants())


def test_other_widths(spark):
    check(spark, variants()[:90], 5, 80)


def test_awkward_rows(spark):
    check(spark, TEXTS)


def test_repeated_rows_link_across_groups(spark, monkeypatch):
    # Grouping finds nothing, so every link is left to the search across groups.
    monkeypatch.setattr(jaccard_groups, "grouping", lambda sets, *_: sets.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0))
    rows = []
    for i in range(12):
        w = [f"b{i}w{k}" for k in range(60)]
        rows += [(2 * i, " ".join(w))] * 2 + [(2 * i + 1, " ".join([*w[:57], "x", "y", "z"]))] * 2
    check(spark, rows)


def test_empty_table(spark):
    assert jaccard_classes(documents(spark).limit(0)).collect() == []


def test_one_of_each_class(spark):
    rows = [*TEXTS, *variants()[:60]]
    kept = one_of_each_class(documents(spark, rows))
    assert kept.columns == documents(spark).columns
    _, groups = brute(rows, 4, 85)
    texts = dict(rows)
    ids = [r.doc_id for r in kept.collect()]
    want = []
    for members in groups.values():
        want.append(min((i for i in members if i is not None), default=None))
    assert sorted(ids, key=str) == sorted(want, key=str) and texts


def near_misses(n, seed=7):
    """One family: every text shares most words with all others and links with few of them."""
    rng = random.Random(seed)
    base = [f"m{k}" for k in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(120), rng.choice([2, 3, 4])):
            w[at] = f"q{rng.randrange(40)}"
        rows.append((i, " ".join(w)))
    return rows


def test_large_family_of_misses(spark, monkeypatch):
    # Units of 64 sets: the rows grow with pairs of units, not with pairs of sets.
    monkeypatch.setattr(jaccard_groups, "PART", 64)
    counted, write = {}, jaccard_groups.written

    def counting(df, label):
        out = write(df, label)
        if label in ("inside", "outside"):
            counted[label] = out.count()
        return out

    monkeypatch.setattr(jaccard_groups, "written", counting)
    rows = near_misses(500)
    check(spark, rows)
    assert 0 < counted["inside"] <= 100 and counted.get("outside", 0) <= 600


def test_blocks_against_pairs():
    rng = np.random.default_rng(2)
    for part in (50, 85):
        sets = [np.unique(rng.integers(0, 60, rng.integers(1, 70)).astype(np.uint64)) for _ in range(90)]
        a, b, group = sets[:50], sets[50:], rng.integers(0, 12, 90)
        want, got = ({frozenset([i]) for i in range(90)} for _ in range(2))

        def join(classes, i, j):
            x, y = (next(c for c in classes if k in c) for k in (i, j))
            classes -= {x, y}
            classes.add(x | y)

        for i in range(50):
            for j in range(50, 90):
                if group[i] != group[j] and jaccard_groups.linked(sets[i], sets[j], part, 100):
                    join(want, i, j)
        for i, j in jaccard_groups.spanning_links(a, group[:50], b, group[50:], part, 100):
            join(got, i, 50 + j)
        assert got == want
