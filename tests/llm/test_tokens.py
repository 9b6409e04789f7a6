"""Token counts and packing."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import packing
from lakeops.llm.packing import best_fit, best_fit_packing, pack
from lakeops.llm.token_counts import token_counts

from .helpers import TEXTS, documents

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def odd_texts():
    rng = random.Random(8)
    pool = [*"abcXYZ 019 \t\n\r\x0b\x1c\x85\xa0'sltred.,!?_éß中Σς　​٣²🎉\x00İ", "<|endoftext|>", "<|startoftext|>", " the ", "aaaa", "   "]
    return [(1000 + i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(1500)] + [(5000, "a" * 4000), (5001, "ab" * 3000), (5002, " " * 500)]


def test_counts_are_the_librarys(spark):
    rows = [*TEXTS, *odd_texts()]
    library = Tokenizer.from_file(BYTES)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(documents(spark, rows), BYTES).collect()), key=str)
    sizes = [len(e.ids) for e in library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    assert got == sorted(((i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(rows, sizes, strict=True)), key=str)
    assert token_counts(documents(spark).limit(0), BYTES).collect() == []


def test_packing_round_trip(spark):
    rows = [*TEXTS, *odd_texts()]
    library = Tokenizer.from_file(WORDS)
    packed = best_fit_packing(documents(spark, rows), WORDS, with_ids=True).collect()
    ids = [[*e.ids, 0] for e in library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    want = sorted(((i, k // 2048, k, x[k:k + 2048]) for (i, _), x in zip(rows, ids, strict=True) for k in range(0, len(x), 2048)), key=str)
    assert sorted(((r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in packed), key=str) == want
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids) for r in packed)
    sequences = {}
    for r in packed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= -(-sum(map(len, ids)) // 2048) + 1
    assert best_fit_packing(documents(spark).limit(0), WORDS).collect() == []


@pytest.mark.parametrize("length", [1100, 700, 2048, 1])
def test_tree_rounds_keep_every_piece(spark, length):
    items = spark.range(3000).withColumn("length", F.lit(length).cast("long"))
    got = pack(items, items_per_task=200).collect()
    assert sorted(r.id for r in got) == list(range(3000))
    assert len({r.sequence_id for r in got}) == -(-3000 // (2048 // length))


def test_short_pieces_fill_nearly_full_sequences(spark):
    items = spark.range(60).withColumn("length", F.when(F.col("id") < 40, 2046).otherwise(4).cast("long")).withColumn("length", F.when(F.col("id") >= 40, 2).otherwise(F.col("length")))
    assert len({r.sequence_id for r in pack(items).collect()}) == 40
    assert len({r.sequence_id for r in pack(items, items_per_task=30).collect()}) <= 41


def test_best_fit_prefers_the_fullest_bin():
    assert best_fit(np.array([60, 50, 40, 50]), 100) == [[0, 2], [1, 3]]
    assert best_fit(np.zeros(0, np.int64), 100) == []


def test_odd_texts_are_not_remembered():
    """Texts with other characters give the library's ids and leave nothing behind."""
    with open(WORDS, encoding="utf-8") as f:
        reader = packing.TextIds(f.read(), 0)
    library = Tokenizer.from_file(WORDS)
    texts = [f"it’s text {i} — Ωμέγα 中文 <|endoftext|> plain" if i % 3 else f"plain words {i}" for i in range(200)] + ["", "’", "a"]
    flat, sizes = reader.ids(texts)
    want = [[*e.ids, 0] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]
    assert len(reader.words) < 100 and reader.bytes < 1000
    reader.ids([" ".join(f"w{i}" + "x" * 500 for i in range(packing.REMEMBERED_BYTES // 500 + 10))])
    assert reader.bytes > packing.REMEMBERED_BYTES
    flat, sizes = reader.ids(texts)
    assert flat.tolist() == [i for x in want for i in x] and reader.bytes < 1000


def test_sequences_hold_their_pieces(spark):
    rows = [*TEXTS, *odd_texts()[:300]]
    library = Tokenizer.from_file(WORDS)
    packed = best_fit_packing(documents(spark, rows), WORDS)
    places = packed.collect()
    built = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(documents(spark, rows), packed, WORDS).collect()}
    ids = {}
    for (i, _), e in zip(rows, library.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True):
        ids.setdefault(i, []).append([*e.ids, 0])
    assert sum(map(len, built.values())) == sum(len(x) for found in ids.values() for x in found)
    for r in places:
        part = built[r.sequence_id][r.offset:r.offset + r.length].tolist()
        assert len(part) == r.length and any(x[r.start:r.start + r.length] == part for x in ids[r.doc_id])
