"""Importance resampling against counts, crcs and a draw made in plain Python."""

import hashlib
import math
import re
import zlib

import pytest

from lakeops.llm.importance import importance_scores, resampled

from .helpers import LONG, TEXTS, UPPER, documents, same_as_oracle


def features(text, longest=3):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return len(w), [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(rows, items, share=5, least=20, n=10_000):
    def bucket(x):
        return zlib.crc32(x.encode()) % n

    s, t = [0] * n, [0] * n
    for counts, texts in ((s, [x for _, x in rows]), (t, [x for _, x in items])):
        for text in texts:
            for x in features(text)[1]:
                counts[bucket(x)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * float(sum(s) + n) / ((a + 1) * float(sum(t) + n)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, text in rows:
        words, grams = features(text)
        weight = sum(gain[bucket(x)] for x in grams)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    large = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(large[:share * len(large) // 100])}
    return sorted(((*r[:4], drawn.get(id(r))) for r in out), key=str)


ITEMS = [(1, "The lazy dog, again and again"), (2, None), (3, ""), (4, LONG[:3000]), (5, "Größe NAÏVE ß")]


def target(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, bucket int")


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


MANY = [*TEXTS, *((100 + i, " ".join(f"v{(i * j) % 61} the lazy dog" for j in range(3, 12))) for i in range(80)), (7, "x" * 5000 + " " + "é" * 90)]


@pytest.mark.parametrize("share", [5, 50, 100])
def test_against_brute_force(spark, share):
    assert got(importance_scores(documents(spark, MANY), target(spark), share)) == brute(MANY, ITEMS, share)


def test_many_buckets(spark):
    assert got(importance_scores(documents(spark), target(spark), 30, 1, n_buckets=100_000)) == brute(TEXTS, ITEMS, 30, 1, 100_000)


def test_empty_tables(spark):
    assert importance_scores(documents(spark).limit(0), target(spark)).collect() == []
    assert got(importance_scores(documents(spark), target(spark).limit(0))) == brute(TEXTS, [])


def test_drawn_documents(spark):
    docs = documents(spark, MANY)
    kept = resampled(docs, target(spark), 30)
    assert kept.columns == docs.columns
    want = {r[0] for r in brute(MANY, ITEMS, 30) if r[4]}
    assert {r.doc_id for r in kept.collect()} == want and kept.count() <= len(want) + 1


def test_oracle(spark):
    same_as_oracle(spark, "op11_importance_resampling")
