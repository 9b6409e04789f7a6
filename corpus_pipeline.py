"""A training corpus from the documents table: toxic and poor texts go, one of each group of near copies stays, benchmark
passages go, and the rest is packed into sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import table, written
from lakeops.llm.decontaminate import clean_rows
from lakeops.llm.jaccard_groups import one_of_each_class
from lakeops.llm.packing import best_fit_packing
from lakeops.llm.quality import good_quality
from lakeops.llm.toxicity import not_toxic

#: SQL has no words for trained models, so the stages are tested against brute force instead.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.3."""
    return not_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.7 or more."""
    return good_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more of five-word shingles."""
    return one_of_each_class(docs, width=5, part=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window of thirteen words."""
    return clean_rows(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their sequence and their place in it."""
    packed = best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
