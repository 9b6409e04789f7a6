"""The registered training-data queries and, where SQL can say the same, their oracle text."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import table
from lakeops.llm.decontaminate import decontaminate
from lakeops.llm.embed_dedup import near_duplicates
from lakeops.llm.html_template import extract
from lakeops.llm.importance import importance_scores
from lakeops.llm.jaccard_groups import jaccard_classes
from lakeops.llm.lm_scoring import lm_scores
from lakeops.llm.packing import best_fit_packing
from lakeops.llm.phrases import collocations
from lakeops.llm.quality import quality_scores
from lakeops.llm.quality_rules import quality_rules
from lakeops.llm.token_counts import token_counts
from lakeops.llm.toxicity import toxicity_scores
from lakeops.llm.url_rules import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long"))


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


ORACLES["op5_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
 FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
 FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.gram = bw.gram AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

#: The rules of the contract's URL query: host, path, verdict.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@_query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES %s AS t(host, path, verdict)" % ", ".join(map(repr, URL_RULES)))
    return judge_urls(table(spark, sf_dir, "pages"), rules)


ORACLES["op6_url_filters"] = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
 regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(rh, rp, v) AS (VALUES %s),
m AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
 FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
""" % ", ".join(map(repr, URL_RULES))


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row_key")


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row_key")


@_query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@_query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op2_embedding_dedup"] = """
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
 WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
 WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(u, w) AS (SELECT u, w FROM links UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u),
n AS (SELECT u, count(*) AS k FROM links GROUP BY u), c AS (SELECT u, min(w) AS m FROM reach GROUP BY u)
SELECT vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN c ON c.u = vec_id
"""


@_query
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents")).drop("row_key")


@_query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents")).drop("row_key", "root")


@_query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


#: crc32 is spelt out: a table made of eight shifts per entry, then one step per byte of the feature.
ORACLES["op11_importance_resampling"] = r"""
WITH w AS MATERIALIZED (SELECT 'd' AS side, row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
 UNION ALL SELECT 'b', row_number() OVER (), item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
g AS MATERIALIZED (SELECT side, uid, array_to_string(w[i:i + k - 1], ' ') AS gram FROM (SELECT side, uid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k)),
tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
f AS MATERIALIZED (SELECT gram, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(gram)), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT gram, hex(gram) AS h FROM g), tab),
n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM g JOIN f USING (gram) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + 10000) / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM n),
weights AS (SELECT uid, CAST(count(*) AS BIGINT) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM g JOIN f USING (gram) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY uid),
scored AS (SELECT doc_id, uid, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
 coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('42:' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
 FROM w LEFT JOIN weights USING (uid) WHERE side = 'd'),
ranked AS (SELECT uid, row_number() OVER (ORDER BY score DESC, doc_id, uid) AS r, count(*) OVER () AS total FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * total // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (uid)
"""


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS p, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
f AS MATERIALIZED (SELECT lang, g, len(g) AS size, count(*) AS a FROM (SELECT lang, w[i:i + k - 1] AS g FROM
  (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) s(k) WHERE len(w) >= k)) GROUP BY lang, g HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
cut AS (SELECT c.lang, c.g, c.a, n.n, k, l.a AS l, r.a AS r, CAST(CAST(1000 AS HUGEINT) * c.a * n.n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
 FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1) c JOIN n USING (lang) JOIN f l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (SELECT lang, g[i:i + k - 1] AS g, max(a) AS most FROM (SELECT lang, g, a, k, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM f WHERE size > 2)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM best LEFT JOIN inner_ USING (lang, g) WHERE most IS NULL OR most < a QUALIFY rank <= 2000
"""


@_query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("row_key")
