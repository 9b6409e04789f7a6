"""Small tables with the awkward cases that every training-data operator must stand."""

import re

import duckdb

from lakeops.llm import queries

from ..conftest import SF

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog again and again until night falls."),
    (1, "The quick brown fox jumps over the lazy dog again and again until night falls."),
    (2, "the QUICK brown fox jumps over the lazy dog again and again until night falls."),
    (3, None), (None, "a text without an id"), (None, None), (4, ""), (5, "   \n\t "), (6, "one"), (7, "one two three"), (8, LONG), (9, LONG + " tail"),
    (10, "größe naïve ŝtono Ünïcode été ß"), (11, "<|endoftext|> is a mark <|startoftext|>"), (12, "\x00odd \x1c\x85\xa0 spaces here"),
]


def documents(spark, rows=TEXTS):
    """Rows as a documents table with further columns whose names operators might use themselves."""
    extra = ["key", "row_key", "node", "n", "words", "n_hit", "token", "score", "label", "item_0", "gone"]
    return spark.createDataFrame([(i, t, *(0 for _ in extra)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} int" for c in extra))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def same_as_oracle(spark, name):
    """Whether a query returns its oracle's rows over the smoke tables."""
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(names).collect()), key=str) == sorted(want, key=str)
