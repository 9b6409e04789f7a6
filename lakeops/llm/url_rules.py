"""URL filters: nested host and path rules found by a sorted sweep over canonical keys.

A key is the host with its labels reversed, a separator byte, and the path. A rule is a prefix of keys, so it is an
interval; two intervals are nested or disjoint. Sorted events (an interval opens, a key, an interval closes) then need only
a stack: the depth is a running sum, and the rule in force at depth d is the last one that opened at depth d. Both are
window functions over key ranges. A rule that spans several ranges is put at the start of each, at most one per range and
nesting level.

A rule holds for subdomains as well, so a url is looked up once for each of its last 1, 2, ... host labels, as many as the
deepest rule has. Only the distinct (host tail, path head) pairs go through the sweep: a site with a third of all urls is
aggregated before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import written

#: Keys of which range borders are drawn; the borders decide where rows go, never a result.
BORDER_KEYS = 4096
KEYS_PER_RANGE = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP, _AFTER = "FE", "FF"  # bytes that no UTF-8 text holds


def host_of(url: Column) -> Column:
    """Lower-cased text between the first :// and the next /, ?, # or end; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ?, # or end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    """labels: of the host, last one first."""
    return F.concat(F.array_join(labels, ".").cast("binary"), F.unhex(F.lit(_GAP)), path.cast("binary"))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def prepared(rules: DataFrame) -> DataFrame:
    """One row per (host, path): key, labels, rule, verdict. Rows with null host or verdict go; block wins over allow."""
    clean = rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull()).select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    one = clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = _labels(F.col("host"))
    return one.select(
        _key(labels, F.col("path")).alias("key"), F.size(labels).alias("labels"), F.length("path").alias("chars"),
        F.concat("host", "path").alias("rule"), "verdict",
    )


def _borders(keys: DataFrame, ranges: int) -> list[bytearray]:
    """Keys that cut the key space into about equal parts, from those with the smallest hashes (a bounded, random part)."""
    if ranges < 2:
        return []
    drawn = sorted(bytes(r[0]) for r in keys.orderBy(F.xxhash64("key"), "key").limit(BORDER_KEYS).select("key").collect())
    return sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)} if drawn else set())


def innermost(keys: DataFrame, rules: DataFrame, ranges: int) -> DataFrame:
    """(key, rule, verdict) of every distinct key that some rule's key is a prefix of: the longest such rule."""
    borders = _borders(keys, ranges)
    cuts = F.array(*(F.unhex(F.lit(b.hex())) for b in borders)) if borders else F.array().cast("array<binary>")
    place = lambda c: F.size(F.filter(cuts, lambda b: b <= c))
    nothing = F.lit(None).cast("string")
    asked = keys.select(place(F.col("key")).alias("part"), "key", F.lit(1).alias("kind"), F.lit(0).alias("step"), nothing.alias("rule"), nothing.alias("verdict"))
    spread = rules.withColumn("shut", F.concat("key", F.unhex(F.lit(_AFTER)))).withColumn("part", F.explode(F.sequence(place(F.col("key")), place(F.col("shut")))))
    opens = spread.select("part", "key", F.lit(0).alias("kind"), F.lit(1).alias("step"), "rule", "verdict")
    shuts = spread.select("part", F.col("shut").alias("key"), F.lit(2).alias("kind"), F.lit(-1).alias("step"), nothing.alias("rule"), nothing.alias("verdict"))
    events = asked.unionByName(opens).unionByName(shuts)
    so_far = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("part", "depth").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("depth", F.sum("step").over(so_far))
    last = F.last(F.when(F.col("kind") == 0, F.struct("rule", "verdict")), ignorenulls=True).over(level)
    return swept.withColumn("top", last).where((F.col("kind") == 1) & (F.col("depth") > 0)).select("key", "top.rule", "top.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (host and path of the longest fitting rule, else null) and verdict.

    rules: (host, path, verdict). A rule fits its host and all subdomains when the url's path starts with the rule's.
    Longest means most characters of host and path together, then of the host. Urls that no rule fits get ``default``; so
    do null urls and urls without ://, whose host and path are empty. Repeated rows and null ids keep a row each. Without
    rules every page gets the default.
    """
    spec = written(prepared(rules), "rules")
    limits = spec.agg(F.max("labels"), F.max("chars"), F.count("*")).first()
    parts = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    if not limits[2]:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels, chars, _ = limits
    tail, head = F.slice(_labels(F.col("host")), 1, labels), F.substring("path", 1, chars)
    parts = parts.withColumns({"tail": F.array_join(tail, "."), "head": head})
    looked_up = written(parts.select("tail", "head").distinct(), "looked-up")
    names = F.split("tail", r"\.", -1)
    each = looked_up.withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(names)))).select(
        "tail", "head", _key(F.slice(names, F.lit(1), F.col("depth")), F.col("head")).alias("key")
    )
    keys = each.select("key").distinct()
    ranges = -(-keys.count() // KEYS_PER_RANGE)
    found = written(innermost(keys, spec.select("key", "rule", "verdict"), ranges), "innermost")
    rank = F.struct(F.length("rule"), F.octet_length("key"), F.col("rule"), F.col("verdict"))
    best = written(
        each.join(found, "key").groupBy("tail", "head").agg(F.max(rank).alias("best")).select("tail", "head", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")),
        "verdicts",
    )
    return parts.join(best, ["tail", "head"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
