"""Every stage of the corpus pipeline on what the stage before it kept."""

import zlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from lakeops.llm.common import table, written
from lakeops.llm.quality import quality_scores
from lakeops.llm.toxicity import toxicity_scores

from ..conftest import SF
from .test_jaccard import brute as classes
from .test_native import brute as windows
from .test_tokens import WORDS


@pytest.fixture(scope="module")
def steps(spark):
    """(name, rows before, rows after) of each stage."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in pipeline.STAGES:
        after = written(stage(spark, docs, SF), "stage")
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_and_columns(steps, spark):
    assert [s[0] for s in steps] == ["toxicity", "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    columns = table(spark, SF, "documents").columns
    assert all(after.columns == columns for _, _, after in steps[:-1]) and pipeline.ORACLE_SQL is None
    assert 0 < steps[-2][2].count() < steps[0][1].count()


def test_rejected_documents_go_and_no_others(steps, spark):
    labels = table(spark, SF, "labels")
    for (_, before, after), scores, keeps in ((steps[0], toxicity_scores, lambda s: s < 0.3), (steps[1], quality_scores, lambda s: s >= 0.7)):
        score = {r.doc_id: r.score for r in scores(before, labels).collect()}
        assert texts(after) == [x for x in texts(before) if keeps(score[x[0]])]


def test_one_of_each_group_stays(steps):
    _, before, after = steps[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    _, groups = classes(rows, 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(min(ids) for ids in groups.values())


def test_contaminated_documents_go(steps, spark):
    _, before, after = steps[3]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    judged = windows([(r.doc_id, r.text) for r in before.collect()], items)
    assert sorted(r.doc_id for r in after.collect()) == sorted(r[0] for r in judged if not r[-1])


def test_everything_left_is_packed(steps, spark):
    _, before, _ = steps[4]
    library = Tokenizer.from_file(WORDS)
    want = []
    for r in before.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        want += [(r.doc_id, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[k:k + 2048]))) for k in range(0, len(ids), 2048)]
    got = steps[4][2].collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert pipeline.run(spark, SF).count() == len(got)
