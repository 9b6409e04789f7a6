"""Benchmark decontamination with built-in functions only.

The test items' windows of thirteen normalised words form a hash set. A training text is scanned word by word: every window
of the set is anchored at one of its words, the longest, so only words that are some window's anchor make a candidate. A
candidate's window is cut out, looked up by its hash in the set and compared word for word. Hits are the union of the
places that true windows cover.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import BROADCAST_ROWS, free_name, row_key, small, written

#: Bytes of windows up to which every executor gets them.
WINDOW_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_AS_IS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words: digits, letters and all that is not ASCII; an empty array for null."""
    cut = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN, -1)
    return F.filter(cut, lambda w: w != "")


def item_windows(items: DataFrame, size: int = 13) -> DataFrame:
    """(item, gram, n, anchor, before) of every distinct window; ``before``: words of the window before its anchor."""
    w = items.select(F.col("item_id").alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    w = w.withColumn("n", F.least(F.size("words"), F.lit(size)))
    w = w.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)))
    w = w.select("item", F.slice("words", F.col("at"), F.col("n")).alias("gram"), "n").distinct()
    longest = F.array_max(F.transform("gram", lambda x, i: F.struct(F.length(x).alias("size"), (-i).alias("at"))))
    w = w.withColumn("before", -longest["at"])
    return w.withColumn("anchor", F.element_at("gram", F.col("before") + 1))


def hits(docs: DataFrame, items: DataFrame, size: int = 13) -> DataFrame:
    """(key, at, n, item): every place of a document (``key``, ``text``) where a window of an item occurs; at counts from 1.

    While the windows are small, by rows and by bytes, every executor gets all of them and the texts stay where they are.
    Beyond that, words travel to the anchors, each with no more than the words around it that its windows can reach.
    """
    windows = written(item_windows(items, size), "windows")
    count, letters = windows.agg(F.count("*"), F.sum(F.octet_length(F.array_join("gram", " ")))).first()
    spread = F.broadcast if count <= BROADCAST_ROWS and (letters or 0) <= WINDOW_BYTES else lambda df: df
    anchors = spread(windows.select("anchor", "before", "n").distinct())
    known = spread(windows.select("gram", F.xxhash64("gram").alias("hash"), "item"))
    words = docs.select("key", words_of(F.col("text")).alias("words"))
    scanned = words.select("key", "words", F.size("words").alias("total"), F.posexplode("words").alias("pos", "anchor")).withColumn("first", F.lit(1))
    if spread is not F.broadcast:
        first = F.greatest(F.col("pos") + 2 - size, F.lit(1))
        scanned = scanned.withColumn("first", first).withColumn("words", F.slice("words", F.col("first"), F.lit(2 * size - 1)))
    found = scanned.join(anchors, "anchor").withColumn("at", F.col("pos") - F.col("before") + 1)
    found = found.where((F.col("at") >= 1) & (F.col("at") + F.col("n") - 1 <= F.col("total")))
    found = found.select("key", "at", "n", F.slice("words", F.greatest(F.col("at") - F.col("first") + 1, F.lit(1)), F.col("n")).alias("seen"))
    found = found.withColumn("hash", F.xxhash64("seen"))
    return found.join(known, "hash").where(F.col("seen") == F.col("gram")).select("key", "at", "n", "item").distinct()


def report(docs: DataFrame, items: DataFrame, size: int = 13) -> DataFrame:
    """Per distinct row key with a hit: n_hit (words inside any window found) and items (sorted as text)."""
    all_hits = written(hits(docs, items, size), "hits")
    places = all_hits.select("key", "at", (F.col("at") + F.col("n")).alias("end")).distinct()
    before = Window.partitionBy("key").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = places.withColumn("from", F.greatest("at", F.coalesce(F.max("end").over(before), F.lit(0))))
    covered = fresh.groupBy("key").agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).cast("long").alias("n_hit"))
    named = all_hits.select("key", "item").distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    return covered.join(named, "key")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 13, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items and contaminated (n_hit > 0 and one_in * n_hit >= n_words).

    items: (item_id, text). A shorter item is one window of all its words; items without words never hit. A null or empty
    text has no words; a very long text is scanned whole; repeated rows are judged alike; an empty table on either side hits
    nothing. The window set goes to every executor only if it is counted to be small, else it is joined by shuffle.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    clean = items.select(F.col("item_id"), F.col("text"))
    found = written(report(narrow.select("key", "text"), clean, size), "report")
    sizes = narrow.select("doc_id", "key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = sizes.join(small(found.select("key", "n_hit", "items"), found.count() * 16), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, items: DataFrame, size: int = 13, one_in: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows, all columns kept."""
    key, hit = free_name(docs, "row_key"), free_name(docs, "n_hit")
    marked = docs.withColumn(key, row_key(id_col, text_col))
    found = report(marked.select(F.col(key).alias("key"), F.col(text_col).alias("text")), items.select("item_id", "text"), size)
    found = written(found.select(F.col("key").alias(key), F.col("n_hit").alias(hit)), "report")
    n_words = F.size(words_of(F.col(text_col)))
    joined = marked.join(small(found, found.count()), key, "left")
    return joined.where(F.col(hit).isNull() | (F.col(hit) * one_in < n_words)).select(docs.columns)


def without_spans(docs: DataFrame, items: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every word inside a found window cut from the text; what stands between words stays. Null stays null."""
    key, gone_col = free_name(docs, "row_key"), free_name(docs, "gone")
    marked = docs.withColumn(key, row_key(id_col, text_col))
    found = written(hits(marked.select(F.col(key).alias("key"), F.col(text_col).alias("text")), items.select("item_id", "text"), size), "spans")
    gone = found.select("key", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("i")).distinct()
    gone = gone.groupBy(F.col("key").alias(key)).agg(F.map_from_entries(F.collect_list(F.struct("i", F.lit(True)))).alias(gone_col))
    words, gaps = F.regexp_extract_all(F.col(text_col), F.lit(_WORD_AS_IS), F.lit(0)), F.split(text_col, _WORD_AS_IS, -1)
    rest = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.when(F.element_at(gone_col, i + 1).isNotNull() | (i >= F.size(words)), "").otherwise(F.get(words, i)))), "")
    joined = marked.join(gone, key, "left")
    return joined.withColumn(text_col, F.when(F.col(gone_col).isNull(), F.col(text_col)).otherwise(rest)).select(docs.columns)
