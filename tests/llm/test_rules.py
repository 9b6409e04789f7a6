"""Quality rules: counts against plain Python, the learner against plain Python, and held-out rows."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.llm import quality_rules as q
from lakeops.llm.common import table

from ..conftest import SF
from .helpers import TEXTS, documents, labels


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def odd_texts():
    rng = random.Random(5)
    out = []
    for i in range(60):
        w = [rng.choice("ab") + rng.choice("cdé#") for _ in range(rng.randrange(130))]
        out.append((100 + i, "".join(x + rng.choice([" ", " ", "\n", "\t ", "\x0b"]) for x in w)))
    return [*TEXTS, *out, (7, "a b c a b c"), (7, "a a a a"), (7, "a b c"), (7, "x\n\nx\n \n x\n x"), (7, "é𝒳 <b>")]


def test_counts_against_brute_force(spark):
    rows = odd_texts()
    df = q.quality_rules(documents(spark, rows), labels(spark, []))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = sorted((tuple(r) for r in df.select(names).collect()), key=str)
    assert got == sorted(((i, *counts(t), not counts(t)[-1]) for i, t in rows), key=str)


def learn(rows, most_rules=12, most_conditions=4, precision=0.95):
    """Sequential covering over [(statistics, poor, part)] in plain Python."""
    names = list(q.STATISTICS)

    def quantiles(values):
        values = sorted(values)
        at = [k / q.QUANTILES * (len(values) - 1) for k in range(1, q.QUANTILES)]
        return [values[int(x)] + (x - int(x)) * (values[min(int(x) + 1, len(values) - 1)] - values[int(x)]) for x in at] if values else []

    cuts = [sorted({x for kind in (True, False) for x in quantiles([r[0][s] for r in rows if r[1] == kind])}) for s in range(len(names))]

    def fits(row, parts):
        return all((row[0][s] >= cuts[s][k]) == above for s, above, k in parts)

    grow, judge, rules = [r for r in rows if r[2]], [r for r in rows if not r[2]], []
    while len(rules) < most_rules:
        parts, inside = [], grow
        while len(parts) < most_conditions:
            p0, best = sum(r[1] for r in inside), (1e-9, None)
            for s in range(len(names)):
                for k in range(len(cuts[s])):
                    for above in (True, False):
                        chosen = [r for r in inside if (r[0][s] >= cuts[s][k]) == above]
                        p = sum(r[1] for r in chosen)
                        won = q.gain(p, len(chosen) - p, p0, len(inside) - p0)
                        if won > best[0] + (1e-9 if best[1] else 0):
                            best = (won, (s, above, k))
            if best[1] is None:
                break
            parts.append(best[1])
            inside = [r for r in inside if fits(r, parts)]
            if all(r[1] for r in inside):
                break
        if not parts:
            break
        scores = []
        for m in range(1, len(parts) + 1):
            chosen = [r for r in judge if fits(r, parts[:m])]
            p = sum(r[1] for r in chosen)
            scores.append(((2 * p - len(chosen)) / len(chosen) if chosen else -1.0, -m, p, len(chosen)))
        _, m, p, n = max(scores)
        if not p or p < precision * n:
            break
        parts = parts[:-m]
        rules.append(tuple(q.Condition(names[s], above, cuts[s][k]) for s, above, k in parts))
        grow, judge = ([r for r in part if not fits(r, parts)] for part in (grow, judge))
    return rules


@pytest.mark.parametrize("seed", [1, 2])
def test_learner_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(150):
        x = [float(rng.randrange(12)) / 4 for _ in q.STATISTICS]
        rows.append((x, x[1] > 2 or (x[3] < 0.5 and x[4] > 1) or rng.random() < 0.03, rng.randrange(3)))
    df = spark.createDataFrame([(*x, p, k) for x, p, k in rows], ", ".join(f"{n} double" for n in q.STATISTICS) + ", poor boolean, part int")
    found = q.learn_rules(df, most_rules=4, most_conditions=3, precision=0.8)
    assert found and found == learn(rows, 4, 3, 0.8)
    want = [next((k + 1 for k, rule in enumerate(found) if all((r[0][list(q.STATISTICS).index(c.statistic)] >= c.threshold) == c.above for c in rule)), None) for r in rows]
    assert [r[0] for r in df.select(q.first_rule(found)).collect()] == want


def test_held_out_rows_and_kept_documents(spark):
    docs, known = table(spark, SF.replace("0.001", "0.01"), "documents"), table(spark, SF.replace("0.001", "0.01"), "labels")
    judged = q.quality_rules(docs, known).join(known, "doc_id").where("quality is not null and not base_failed")
    held = [(r.quality, r.kept) for r in judged.select("doc_id", "quality", "kept").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    good, poor = [k for y, k in held if y == 1], [k for y, k in held if y == 0]
    assert sum(good) >= 0.97 * len(good) and sum(poor) <= 0.4 * len(poor)
    kept = q.kept_rows(docs, known)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_bounded_labels_empty_tables_and_one_kind(spark):
    rows = odd_texts()
    docs = documents(spark, rows)
    both = labels(spark, [(i, i % 2, 0) for i in range(100, 160)] + [(100, None, None), (None, 0, 0), (101, 0, 1)])
    measured = q.measured(docs)
    assert q.labelled_rows(measured, both, 10).count() < 30
    assert q.quality_rules(docs, both, rows=20).count() == len(rows)
    assert q.quality_rules(docs.limit(0), both).collect() == []
    only = q.quality_rules(docs, labels(spark, [(100, 1, 0), (120, 1, 0)])).where("rule is not null")
    assert only.count() == 0 and F is not None
