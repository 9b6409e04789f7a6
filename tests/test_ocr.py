"""OCR block trees: what an operator asks for, and what it gives."""

from lakeops.operators import text
from lakeops.plans.text import blocks

BLOCK = (
    "doc_id bigint, id string, block_type string, text string, confidence double, entity_types array<string>, "
    "relationships array<struct<type:string,ids:array<string>>>, row_index int, column_index int"
)


def test_asking_for_some_kinds_makes_no_others(lake):
    made = blocks(lake)
    assert made.count() == sum(made.filter(made.block_type == k).count() for k in ("WORD", "LINE", "KEY_VALUE_SET", "TABLE", "CELL"))
    for kind, branches in {"CELL": 2, "LINE": 1, "WORD": 1}.items():
        optimized = made.filter(made.block_type == kind)._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count(" Relation [") == branches


def test_pages_with_lines_or_words_only(spark):
    rows = [
        (1, "a", "LINE", "two  words", 90.0, None, None, 1, None), (1, "b", "LINE", "first", 80.0, None, None, 0, None),
        (1, "c", "WORD", "first", None, None, None, None, None), (1, "d", "WORD", "two", None, None, None, None, None), (1, "e", "TABLE", None, None, None, None, None, None),
        (2, "f", "LINE", "alone", 50.0, None, None, 0, None), (3, "g", "WORD", "lost", None, None, None, None, None),
        (None, "h", "LINE", "no id", 70.0, None, None, 0, None), (None, "i", "WORD", "id", None, None, None, None, None), (4, "j", "CELL", None, None, None, None, 1, 1),
    ]
    got = {r["doc_id"]: (r["extracted_text"], r["confidence"], r["words"]) for r in text.ocr_pages(spark.createDataFrame(rows, BLOCK)).collect()}
    assert got == {1: ("first two words", 0.85, 2), 2: ("alone", 0.5, 0), 3: ("", 0.0, 1), None: ("no id", 0.7, 1)}


def test_words_of_a_page_are_not_sorted_with_its_lines(lake):
    """Only lists need object aggregation, which sorts its rows after a few keys; words must not be among them."""
    plan = text.ocr_pages(blocks(lake))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_collect_list"):]
    assert below.index("Union") < below.index("posexplode") and "HashAggregate(keys=[doc_id" in below[below.index("Union"):].replace("ObjectHashAggregate", "")
