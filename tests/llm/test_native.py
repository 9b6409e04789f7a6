"""Benchmark decontamination and URL filters."""

import hashlib
import random
import re

from lakeops.llm.decontaminate import clean_rows, decontaminate, without_spans
from lakeops.llm.url_rules import judge_urls

from .helpers import LONG, TEXTS, UPPER, documents, same_as_oracle


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(rows, items, size=13):
    out = []
    for i, text in rows:
        w, hit, found = cut(text), set(), set()
        for item, t in items:
            x = cut(t)
            n = min(size, len(x))
            grams = {tuple(x[k:k + n]) for k in range(len(x) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if n and tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [(1, "quick brown fox"), (2, "one"), (3, " ".join(f"w{i % 977}x{i % 31}" for i in range(500, 530))), (4, None), (5, ""), (6, "zzz"), (11, "Brown FOX, jumps!"), (11, "lazy dog")]


def test_decontamination_against_brute_force(spark):
    rng = random.Random(1)
    rows = [*TEXTS, *((50 + i, " ".join(rng.choice(["one", "quick", "brown", "fox", "a", "b"]) for _ in range(60))) for i in range(30))]
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, key int")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in decontaminate(documents(spark, rows), items).collect()), key=str)
    assert got == brute(rows, ITEMS)
    kept = clean_rows(documents(spark, rows), items)
    assert kept.columns == documents(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((b[0] for b in brute(rows, ITEMS) if not b[5]), key=str)


def test_large_benchmarks_travel_by_shuffle(spark, monkeypatch):
    """The same rows where the windows are too many for every executor; only words around an anchor are sent."""
    monkeypatch.setattr("lakeops.llm.decontaminate.WINDOW_BYTES", -1)
    test_decontamination_against_brute_force(spark)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate(documents(spark).limit(0), items).collect() == []
    assert {r.n_hit for r in decontaminate(documents(spark), items.limit(0)).collect()} == {0}


def test_spans_are_cut_out(spark):
    items = spark.createDataFrame([(1, "brown fox jumps")], "item_id long, text string")
    got = {r.doc_id: r.text for r in without_spans(documents(spark, [(1, "A Brown fox, jumps! Over."), (2, None), (3, "brown fox")]), items).collect()}
    assert got == {1: "A  , ! Over.", 2: None, 3: "brown fox"}


def test_hash_of_items_is_that_of_their_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_decontamination_oracle(spark):
    same_as_oracle(spark, "op5_decontamination")


def judge(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(UPPER), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def test_urls_against_brute_force(spark):
    rng = random.Random(2)
    hosts = [".".join(rng.choice(["a", "b", "com", "x-y", "é"]) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    paths = ["", "/", "/a", "/a/b", "/a/b/c", "/ab", "/é/\U0010ffff", "/a b"]
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in zip(rng.choices(hosts, k=60), rng.choices(paths, k=60), strict=True)}.values())
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(['', 'www.'])}{rng.choice(hosts).upper()}{rng.choice(paths)}{rng.choice(['', '?q=/a', '#f', '/more'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "http://", "http://a?x", "http://" + "a." * 3000 + "com/" + LONG[:5000], urls[0], urls[0]]
    pages = spark.createDataFrame([(i if i % 50 else None, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, tail int")
    table = spark.createDataFrame([(*r, 1) for r in rules], "host string, path string, verdict string, key int")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, table).collect()), key=str)
    want = sorted(((i if i % 50 else None, *judge(u, rules)) for i, u in enumerate(urls)), key=str)
    assert got == want


def test_rules_across_key_ranges(spark, monkeypatch):
    monkeypatch.setattr("lakeops.llm.url_rules.KEYS_PER_RANGE", 7)
    test_urls_against_brute_force(spark)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in judge_urls(pages, none).select("page_id", "rule", "verdict").collect()] == [(1, None, "allow")]
    assert judge_urls(pages.limit(0), spark.createDataFrame([("b", "/", "block")], none.schema)).collect() == []


def test_url_oracle(spark):
    same_as_oracle(spark, "op6_url_filters")
