"""Text, vector and model queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import fixed
from lakeops.operators import ann, anomaly, business, fraud, models, scores, search, text, vectors
from lakeops.plans.fraud import rounded
from lakeops.registry import query
from lakeops.session import fresh_dir, materialize


def _last_mark(mark: str) -> str:
    """0-based place of the last ``mark`` in the final fifth, counted from its start; -1 if none."""
    back = "concat(" + ", ".join(f"chr({ord(ch)})" for ch in reversed(mark)) + ")"
    return f"CASE WHEN strpos(reverse(tail), {back}) > 0 THEN length(tail) - strpos(reverse(tail), {back}) - 1 ELSE -1 END"


CHUNK_SQL = f"""WITH RECURSIVE step AS (
 SELECT doc_id, text, length(text) AS n, 0 AS start, 0 AS stop, FALSE AS first_done FROM documents
 UNION ALL
 SELECT doc_id, text, n, nxt AS start, CASE WHEN nxt + 1000 >= n THEN n {' '.join(f"WHEN {_last_mark(m)} > 0 THEN nxt + 800 + {_last_mark(m)} + 2" for m in fixed.SENTENCE_ENDS)} ELSE nxt + 1000 END AS stop, TRUE
 FROM (SELECT *, text[nxt + 801:nxt + 1000] AS tail FROM (SELECT *, CASE WHEN first_done THEN CASE WHEN stop = n THEN start + 800 ELSE stop - 200 END ELSE 0 END AS nxt FROM step)
  WHERE (NOT first_done AND n > 0) OR (first_done AND nxt < n - 200))),
c AS (SELECT doc_id, start, stop, regexp_replace(text[start + 1:stop], '^\\s+|\\s+$', '', 'g') AS content FROM step WHERE first_done),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS i FROM c WHERE content <> '')
SELECT concat(doc_id, '_', lpad(CAST(i AS VARCHAR), 4, '0')) AS chunk_id, CAST(doc_id AS VARCHAR) AS document_id, CAST(i AS INTEGER) AS chunk_index, CAST(start AS INTEGER) AS start_offset, CAST(stop AS INTEGER) AS end_offset, content FROM k"""


@query("chunk_documents", CHUNK_SQL)
def chunk_documents(lake):
    return text.chunk_documents(lake("documents"), "doc_id", "text")


@query("embed_chunks")
def embed_chunks(lake):
    chunks = text.chunk_documents(lake("documents"), "doc_id", "text")
    return vectors.embed_hashed(chunks, "content").select("chunk_id", "document_id", "embedding")


KNN_CTE = """c AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings), m AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM c GROUP BY ALL),
q AS (SELECT label AS query_id, list(x ORDER BY i) AS v FROM m GROUP BY label),
s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS score FROM embeddings, q)"""


def label_queries(lake):
    return vectors.centroids(lake("embeddings"), "label", "embedding").withColumnRenamed("label", "query_id")


@query("knn_exact", f"""WITH {KNN_CTE}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s)
SELECT query_id, vec_id, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 5""")
def knn_exact(lake):
    out = vectors.knn_exact(lake("embeddings"), label_queries(lake), "vec_id", "embedding", "query_id", 5)
    return rounded(out, ["score"])


@query("knn_filtered", f"""WITH {KNN_CTE}, r AS (SELECT s.*, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rn FROM s JOIN embeddings e USING (vec_id) WHERE e.label IN (1, 2, 3) AND score >= 0.05)
SELECT query_id, vec_id, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 10""")
def knn_filtered(lake):
    out = vectors.knn_exact(
        lake("embeddings"), label_queries(lake), "vec_id", "embedding", "query_id", 10, threshold=0.05,
        where=vectors.filters(one_of={"label": [1, 2, 3]}),
    )
    return rounded(out, ["score"])


@query("knn_lsh")
def knn_lsh(lake):
    return vectors.knn_lsh(chunk_vectors(lake), questions(lake), "chunk_id", "embedding", "item_id", 5)


@query("knn_lsh_recall")
def knn_lsh_recall(lake):
    """Share of the true neighbours found, and share of all pairs scored."""
    rows, asked = materialize(chunk_vectors(lake), "chunk-vectors"), materialize(questions(lake), "questions")
    truth = vectors.knn_exact(rows, asked, "chunk_id", "embedding", "item_id", 5)
    found = vectors.knn_lsh(rows, asked, "chunk_id", "embedding", "item_id", 5)
    pairs = vectors.lsh_pair_counts(rows, asked, "chunk_id", "embedding", "item_id").agg(F.sum("pairs")).first()[0] or 0
    return vectors.recall(found, truth, "item_id", "chunk_id").withColumn("scored_share", F.lit(pairs / max(1, rows.count() * asked.count())))


# --- chunks: cut, embed, index, search, context -----------------------------------

DIMS = 256


def chunk_vectors(lake):
    chunks = text.chunk_documents(lake("documents"), "doc_id", "text")
    return vectors.embed_hashed(chunks, "content", dims=DIMS).select("chunk_id", "document_id", "content", "embedding")


def questions(lake):
    """The benchmark items as questions."""
    return vectors.embed_hashed(lake("benchmark"), "text", "vector", DIMS).select("item_id", "vector")


_M = "4294967295::UBIGINT"


def _mixed(k: str) -> str:
    """One block of the 32-bit word hash that the embedding uses."""
    a = f"(({k} * 3432918353::UBIGINT) & {_M})"
    return f"((((({a} << 15) | ({a} >> 17)) & {_M}) * 461845907::UBIGINT) & {_M})"


def _folded(x: str, shift: int) -> str:
    return f"xor({x}, {x} >> {shift})"


def _times(x: str, factor: int) -> str:
    return f"(({x} * {factor}::UBIGINT) & {_M})"


# the hash of every word, block by block; then counts per dimension, divided by their length and kept as 4-byte numbers
EMBED_CTE = f"""said AS (SELECT 'c' AS kind, chunk_id AS id, content AS t FROM chunked UNION ALL SELECT 'q', CAST(item_id AS VARCHAR), text FROM benchmark),
tok AS (SELECT kind, id, unnest(regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+')) AS w FROM said),
cut AS (SELECT w, strlen(w) AS n, rpad(hex(w), CAST(8 * ceil(strlen(w) / 4.0) AS INTEGER), '0') AS x FROM (SELECT DISTINCT w FROM tok)),
part AS (SELECT w, n, list_transform(range(len(x) // 8), lambda i: CAST('0x' || x[8 * i + 7:8 * i + 8] || x[8 * i + 5:8 * i + 6] || x[8 * i + 3:8 * i + 4] || x[8 * i + 1:8 * i + 2] AS UBIGINT)) AS ks FROM cut),
mixed AS (SELECT w, n, list_transform(ks, lambda k: {_mixed("k")}) AS ks FROM part),
body AS (SELECT w, n, list_reduce(list_prepend(42::UBIGINT, ks[1:n // 4]), lambda h, k: (((((xor(h, k) << 13) | (xor(h, k) >> 19)) & {_M}) * 5 + 3864292196::UBIGINT) & {_M})) AS h, CASE WHEN n % 4 <> 0 THEN ks[-1] ELSE 0::UBIGINT END AS tail FROM mixed),
f0 AS (SELECT w, xor(xor(h, tail), CAST(n AS UBIGINT)) AS h FROM body), f1 AS (SELECT w, {_folded("h", 16)} AS h FROM f0), f2 AS (SELECT w, {_times("h", 2246822507)} AS h FROM f1),
f3 AS (SELECT w, {_folded("h", 13)} AS h FROM f2), f4 AS (SELECT w, {_times("h", 3266489909)} AS h FROM f3), f5 AS (SELECT w, {_folded("h", 16)} & 255 AS dim FROM f4),
dims AS (SELECT kind, id, dim, count(*) AS c FROM tok JOIN f5 USING (w) GROUP BY ALL),
vec AS (SELECT kind, id, dim, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY kind, id)) AS FLOAT) AS DOUBLE) AS x FROM dims),
len_ AS (SELECT kind, id, sqrt(sum(x * x)) AS l FROM vec GROUP BY ALL),
dot AS (SELECT q.id AS item_id, c.id AS chunk_id, sum(q.x * c.x) AS s FROM vec q JOIN vec c ON q.dim = c.dim AND q.kind = 'q' AND c.kind = 'c' GROUP BY ALL),
near AS (SELECT CAST(item_id AS BIGINT) AS item_id, chunk_id, round(s / ql.l / cl.l, 12) AS score FROM dot JOIN len_ ql ON ql.kind = 'q' AND ql.id = item_id JOIN len_ cl ON cl.kind = 'c' AND cl.id = chunk_id),
hits AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, chunk_id) AS rn FROM near QUALIFY rn <= 5)"""
_HEAD, _TAIL = CHUNK_SQL.rsplit("SELECT concat(", 1)
HITS = f"{_HEAD.rstrip()},\nchunked AS (SELECT concat({_TAIL}),\n{EMBED_CTE}"


@query("knn_chunks", f"{HITS} SELECT item_id, chunk_id, round(score, 6) AS score, CAST(rn AS INTEGER) AS rank FROM hits")
def knn_chunks(lake):
    """Documents cut, embedded and searched in one chain: the five nearest chunks of every question."""
    out = vectors.knn_exact(chunk_vectors(lake), questions(lake), "chunk_id", "embedding", "item_id", 5)
    return rounded(out, ["score"])


@query("retrieval_context", f"""{HITS}, told AS (SELECT h.item_id, rn, chunk_id, document_id, content FROM hits h JOIN chunked USING (chunk_id) WHERE score >= 0.2),
n AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY rn) AS k FROM told)
SELECT item_id, string_agg(concat('[Source ', k, ']', chr(10), content), concat(chr(10), chr(10)) ORDER BY k) AS context, string_agg(chunk_id, ',' ORDER BY k) AS chunk_ids, string_agg(document_id, ',' ORDER BY k) AS document_ids, CAST(count(*) AS INTEGER) AS sources FROM n GROUP BY item_id""")
def retrieval_context(lake):
    """The context of every question: the texts of its nearest chunks and where they come from."""
    chunks = materialize(chunk_vectors(lake), "chunk-vectors")
    hits = vectors.knn_exact(chunks, questions(lake), "chunk_id", "embedding", "item_id", 5, threshold=0.2)
    out = text.retrieval_context(hits, chunks, "item_id", "chunk_id", "content", ["chunk_id", "document_id"])
    return out.withColumns({n: F.array_join(n, ",") for n in ("chunk_ids", "document_ids")})


@query("knn_ivf")
def knn_ivf(lake):
    """The nearest chunks of every question from a stored index over all chunks."""
    index = ann.build(materialize(chunk_vectors(lake).select("chunk_id", "embedding"), "chunk-vectors"), "chunk_id", "embedding", fresh_dir(lake.spark, "ivf"), k=5)
    return ann.search(index, questions(lake), "item_id", 5)


@query("knn_ivf_recall")
def knn_ivf_recall(lake):
    """Share of the true neighbours that the index finds, and share of all pairs that it scores."""
    chunks, asked = materialize(chunk_vectors(lake).select("chunk_id", "embedding"), "chunk-vectors"), materialize(questions(lake), "questions")
    index = ann.build(chunks, "chunk_id", "embedding", fresh_dir(lake.spark, "ivf"), k=5)
    truth = vectors.knn_exact(chunks, asked, "chunk_id", "embedding", "item_id", 5)
    pairs = ann.scored_pairs(index, asked, "item_id").first()
    found = vectors.recall(ann.search(index, asked, "item_id", 5), truth, "item_id", "chunk_id")
    return found.withColumn("scored_share", F.lit((pairs["pairs"] or 0) / max(1, pairs["all_pairs"] or 0)))


# --- OCR --------------------------------------------------------------------------


def blocks(lake):
    """OCR-like blocks of every document: lines, words, one form field and one table row per line.

    Every kind of block is a branch with a fixed type, so whoever asks for some kinds never makes the others.
    """
    did = F.col("doc_id").cast("string")
    lines = lake("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line")).filter(F.col("line").rlike(r"\S"))
    lines = lines.withColumn("words", F.filter(F.split("line", r"\s+"), lambda w: w != ""))
    base = F.concat(did, F.lit("-"), F.col("n").cast("string"))
    none = F.array().cast("array<string>")
    rel = lambda kind, ids: F.struct(F.lit(kind).alias("type"), ids.alias("ids"))
    no_rel = F.array().cast("array<struct<type:string,ids:array<string>>>")
    last = F.size("words") - 1
    word_id = lambda i: F.concat(base, F.lit("-w"), i.cast("string"))

    def branch(rows, id_, kind, words=None, entity=none, rels=no_rel, row=F.lit(None).cast("int"), col=F.lit(None).cast("int")):
        return rows.select(
            "doc_id", id_.alias("id"), F.lit(kind).alias("block_type"), (F.lit(None).cast("string") if words is None else words).alias("text"),
            (F.lit(90.0) + F.col("n") % 10).alias("confidence"), entity.alias("entity_types"), rels.alias("relationships"),
            row.cast("int").alias("row_index"), col.cast("int").alias("column_index"),
        )

    first_child, last_child = rel("CHILD", F.array(word_id(F.lit(0)))), rel("CHILD", F.array(word_id(last)))
    cell = lambda c: F.concat(base, F.lit(f"-c{c}"))
    value = F.concat(base, F.lit("-v"))
    return reduce(DataFrame.unionByName, [
        branch(lines.select("doc_id", "n", F.posexplode("words").alias("i", "word")), word_id(F.col("i")), "WORD", F.col("word")),
        branch(lines, F.concat(base, F.lit("-l")), "LINE", F.col("line"), row=F.col("n")),
        branch(lines, F.concat(base, F.lit("-k")), "KEY_VALUE_SET", entity=F.array(F.lit("KEY")), rels=F.array(first_child, rel("VALUE", F.array(value)))),
        branch(lines, value, "KEY_VALUE_SET", entity=F.array(F.lit("VALUE")), rels=F.array(last_child)),
        branch(lines, F.concat(base, F.lit("-t")), "TABLE", rels=F.array(rel("CHILD", F.array(cell(2), cell(1))))),
        branch(lines, cell(1), "CELL", rels=F.array(first_child), row=F.lit(1), col=F.lit(1)),
        branch(lines, cell(2), "CELL", rels=F.array(last_child), row=F.lit(1), col=F.lit(2)),
    ])


LINES_SQL = """l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n, unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT doc_id, n, line, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '') AS ws FROM l), k AS (SELECT * FROM w WHERE len(ws) > 0)"""


@query("ocr_assemble", f"WITH {LINES_SQL} SELECT doc_id, trim(regexp_replace(string_agg(line, chr(10) ORDER BY n), '\\s+', ' ', 'g')) AS extracted_text, round(avg(90.0 + n % 10) / 100, 6) AS confidence, CAST(sum(len(ws)) AS BIGINT) AS words FROM k GROUP BY doc_id")
def ocr_assemble(lake):
    return rounded(text.ocr_pages(blocks(lake)), ["confidence"])


@query("ocr_forms", f"WITH {LINES_SQL} SELECT doc_id, concat(doc_id, '-', n, '-k') AS id, ws[1] AS key, ws[-1] AS value, CAST(90 + n % 10 AS DOUBLE) AS confidence FROM k")
def ocr_forms(lake):
    return text.ocr_forms(blocks(lake))


@query("ocr_tables", f"WITH {LINES_SQL} SELECT doc_id, concat(doc_id, '-', n, '-t') AS table_id, 1 AS row_index, concat(ws[1], '|', ws[-1]) AS cells FROM k")
def ocr_tables(lake):
    out = text.ocr_tables(blocks(lake))
    return out.withColumn("cells", F.array_join("cells", "|"))


# --- models -----------------------------------------------------------------------

N = "CAST(n_chars % {} AS INT)"


def processed_documents(lake):
    def some(word: str, n: int):
        return F.transform(F.sequence(F.lit(1), F.col("n_chars").cast("int") % n + 1), lambda i: F.lit(word))

    k = F.col("n_chars")
    body = F.struct(
        F.col("doc_id").cast("string").alias("document_id"), F.when(F.col("doc_id") % 4 != 0, F.col("lang")).alias("label"),
        F.struct(
            F.struct((k / 6).cast("int").alias("words"), F.when(k > 3000, (k / 3000).cast("int")).alias("pages"), (F.lit(0.5) + (k % 50) / 100.0).alias("confidence"), F.when(k % 3 == 0, some("t", 4)).alias("tables")).alias("extraction"),
            F.struct(some("e", 7).alias("entities"), F.when(k % 2 == 0, some("p", 5)).alias("key_phrases"), F.when(k % 5 == 0, some("x", 2)).alias("pii_entities")).alias("analysis"),
        ).alias("metadata"),
    )
    return lake("documents").select("doc_id", F.to_json(body).alias("body"))


@query("document_features", """SELECT CAST(doc_id AS VARCHAR) AS document_id, CAST(floor(n_chars / 6) AS INTEGER) AS word_count, CASE WHEN n_chars > 3000 THEN CAST(floor(n_chars / 3000) AS INTEGER) ELSE 1 END AS page_count, round(0.5 + (n_chars % 50) / 100.0, 6) AS extraction_confidence,
 CAST(n_chars % 7 + 1 AS INTEGER) AS entity_count, CASE WHEN n_chars % 2 = 0 THEN CAST(n_chars % 5 + 1 AS INTEGER) ELSE 0 END AS key_phrase_count, CASE WHEN n_chars % 3 = 0 THEN 1 ELSE 0 END AS has_tables, 0 AS has_forms, CASE WHEN n_chars % 5 = 0 THEN 1 ELSE 0 END AS has_pii,
 0 AS is_moderation_flagged, 'NEUTRAL' AS sentiment, CASE WHEN doc_id % 4 <> 0 THEN lang ELSE 'OTHER' END AS label FROM documents""".replace("round(0.5 + (n_chars % 50) / 100.0, 6)", "CAST(round(0.5 + (n_chars % 50) / 100.0, 6) AS DOUBLE)"))
def document_features(lake):
    return rounded(text.document_features(processed_documents(lake), "body"), ["extraction_confidence"])


@query("doc_classifier")
def doc_classifier(lake):
    rows = materialize(text.document_features(processed_documents(lake), "body"), "document-features")
    train, test = models.stratified_split(rows, "document_id", "label")
    model = models.train_classifier(train, text.FEATURES, "label")
    scored = model.transform(test)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("documents"))


@query("fraud_scores")
def fraud_scores(lake):
    features = fraud.fraud_features(lake("v_txn")).fillna(0.0, fraud.FEATURES)
    labelled = materialize(fraud.weak_labels(features, flip=0.02), "labelled")  # training makes many passes
    model = models.forest(fraud.FEATURES, "is_fraud", trees=100, depth=10).fit(labelled)
    model = models.through_file(model, fresh_dir(lake.spark, "fraud-model"))
    scored = models.positive_probability(model, labelled, fraud.FEATURES)
    return fraud.score_status(scored).select("transaction_id", "account_id", "fraud_score", "fraud_status", "confidence")


@query("fraud_models")
def fraud_models(lake):
    """Forest and boosted trees learnt on four fifths of the transactions and judged by rank on the rest."""
    features = fraud.fraud_features(lake("v_txn")).fillna(0.0, fraud.FEATURES)
    labelled = materialize(fraud.weak_labels(features, flip=0.02), "labelled")
    train, test = models.stratified_split(labelled, "transaction_id", "is_fraud")
    parts = []
    for name, pipeline in (("forest", models.forest(fraud.FEATURES, "is_fraud", trees=30, depth=8)), ("boosted", models.boosted(fraud.FEATURES, "is_fraud", rounds=12, depth=4))):
        model = models.through_file(pipeline.fit(train), fresh_dir(lake.spark, f"fraud-{name}"))
        judged = models.positive_probability(model, test, fraud.FEATURES)
        parts.append(scores.auc(judged.select("is_fraud", "fraud_score"), "is_fraud", "fraud_score").withColumn("model", F.lit(name)))
    return parts[0].unionByName(parts[1])


ENGAGEMENT = ["total_watch_time", "avg_completion_rate_user", "genre_diversity", "recency_days", "popularity_score", "user_genre_affinity", "duration_minutes", "genre_encoded", "rating_encoded"]


@query("engagement_model")
def engagement_model(lake):
    from lakeops.plans.business import interactions

    rows = materialize(interactions(lake).fillna(0.0, ENGAGEMENT), "interactions")
    split = search.split_by_key(rows, "user_id")
    model = models.train_engagement(split.filter("split = 'train'"), ENGAGEMENT, "completion_rate")
    scored = model.transform(split.filter("split = 'validation'"))
    per_user = business.ndcg_at_k(scored, "completion_rate", "prediction", "event_id", 10, ["user_id"])
    return per_user.withColumn("ndcg", F.round("ndcg", 6))


@query("train_test_shares", """SELECT user_id, CASE WHEN CAST(concat('0x', left(sha256(concat('split', user_id)), 8)) AS BIGINT) / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS side, count(*) AS rows FROM events GROUP BY ALL""")
def train_test_shares(lake):
    train, test = anomaly.pseudo_random_split(lake("events"), "user_id", 0.8)
    n = F.count(F.lit(1)).alias("rows")
    return train.groupBy("user_id").agg(n).withColumn("side", F.lit("train")).unionByName(test.groupBy("user_id").agg(n).withColumn("side", F.lit("test")))
