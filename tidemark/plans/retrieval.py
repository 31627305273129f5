"""Registered queries: similarity search over `embeddings`; the rows whose id divides by 20 are the queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import chunking, indexing
from tidemark.operators import retrieval as R
from tidemark.plans.indexing import NS
from tidemark.plans.inputs import docs, table
from tidemark.plans.registry import query
from tidemark.session import spread
from tidemark.sources.scratch import written_table


def vectors(spark, d):
    return table(spark, d, "embeddings")


def asked(spark, d):
    return vectors(spark, d).where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding", "label")


def _ranked(distance: str, k: int, where: str = "TRUE", extra: str = "", part: str = "") -> str:
    return f"""
  SELECT q.vec_id AS query_id, v.vec_id, v.label AS label, q.label AS query_label, {extra}
         round({distance}, 9) AS distance,
         row_number() OVER (PARTITION BY q.vec_id {part} ORDER BY round({distance}, 9), v.vec_id) AS rank
  FROM e q, e v WHERE q.vec_id % 20 = 0 AND {where} QUALIFY rank <= {k}"""


E = "e AS (SELECT vec_id, embedding::DOUBLE[] AS x, label FROM embeddings)"
COS = "(1 - list_dot_product(q.x, v.x) / (sqrt(list_dot_product(q.x, q.x)) * sqrt(list_dot_product(v.x, v.x))))"
IP = "(-list_dot_product(q.x, v.x))"
L2 = "list_distance(q.x, v.x)"
PAIRS = "query_id, vec_id, distance + 0.0 AS distance, CAST(rank AS INTEGER) AS rank"


def shown(df, *more):
    return df.select("query_id", "vec_id", (F.col("distance") + 0.0).alias("distance"), "rank", *more)


for _name, _metric, _sql in (("knn_topk", "cosine", COS), ("knn_topk_ip", "ip", IP), ("knn_topk_l2", "l2", L2)):

    @query(_name, f"WITH {E}, r AS ({_ranked(_sql, 4)}) SELECT {PAIRS} FROM r")
    def knn(spark, d, metric=_metric):
        return shown(R.knn_topk(asked(spark, d), vectors(spark, d), 4, metric))


@query("score_normalize", f"""WITH {E}, r AS ({_ranked(L2, 4)})
SELECT query_id, vec_id, round(1 / (1 + distance), 6) AS score FROM r""")
def score_normalize(spark, d):
    found = R.knn_topk(asked(spark, d), vectors(spark, d), 4, "l2")
    return found.select("query_id", "vec_id", F.round(R.score_normalize(F.col("distance"), "l2"), 6).alias("score"))


for _metric, _sql in (("ip", IP), ("cosine", COS)):

    @query(f"score_normalize_{_metric}", f"""WITH {E}, r AS ({_ranked(_sql, 4)})
SELECT query_id, vec_id, round(({"-distance" if _metric == "ip" else "1 - distance"} + 1) / 2, 6) AS score FROM r""")
    def score_normalize_similarity(spark, d, metric=_metric):
        found = R.knn_topk(asked(spark, d), vectors(spark, d), 4, metric)
        similarity = -F.col("distance") if metric == "ip" else 1 - F.col("distance")
        return found.select("query_id", "vec_id", F.round(R.score_normalize(similarity, metric), 6).alias("score"))


@query("knn_filtered", f"""WITH {E}, r AS ({_ranked(COS, 10, "v.label < 5")})
SELECT {PAIRS}, label FROM r WHERE label <> 2""")
def knn_filtered(spark, d):
    found = R.knn_filtered(asked(spark, d).drop("label"), vectors(spark, d), 10, pre=F.col("label") < 5, post=F.col("label") != 2)
    return shown(found, "label")


@query("score_threshold", f"""WITH {E}, r AS ({_ranked(COS, 20)})
SELECT query_id, vec_id, round(1 - distance, 9) AS score FROM r WHERE round(1 - distance, 9) >= 0.3""")
def score_threshold(spark, d):
    found = R.score_threshold(asked(spark, d), vectors(spark, d), 30, 20)
    return found.select("query_id", "vec_id", "score")


@query("embeddings_filter", f"""WITH {E}, r AS ({_ranked(COS, 20)})
SELECT query_id, vec_id, round(1 - distance, 9) AS similarity,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(1 - distance, 9) DESC, vec_id) AS INTEGER) AS rank
FROM r WHERE round(1 - distance, 9) > 0.25 QUALIFY rank <= 6""")
def embeddings_filter(spark, d):
    candidates = R.knn_topk(asked(spark, d), vectors(spark, d), 20).select(
        "query_id", "vec_id", F.round(1 - F.col("distance"), 9).alias("similarity"))
    return R.embeddings_filter(candidates, 0.25, 6)


def _mmr_sql() -> str:
    """Four rounds, each with the largest similarity seen to a row picked before."""
    cosine = "list_dot_product(x.x, y.x) / (sqrt(list_dot_product(x.x, x.x)) * sqrt(list_dot_product(y.x, y.x)))"
    steps = [f"""WITH {E}, c AS ({_ranked(COS, 20)}),
pr AS (SELECT a.query_id, a.vec_id AS u, b.vec_id AS v, {cosine} AS s FROM c a JOIN c b ON a.query_id = b.query_id
  JOIN e x ON x.vec_id = a.vec_id JOIN e y ON y.vec_id = b.vec_id),
n0 AS (SELECT query_id, vec_id, distance, rank AS r, CAST(NULL AS DOUBLE) AS near FROM c),
s1 AS (SELECT query_id, vec_id, distance FROM c WHERE rank = 1)"""]
    for t in (1, 2, 3):
        steps.append(f"""n{t} AS (SELECT n.query_id, n.vec_id, n.distance, n.r, greatest(n.near, pr.s) AS near FROM n{t - 1} n
  JOIN s{t} s ON n.query_id = s.query_id AND n.vec_id <> s.vec_id JOIN pr ON pr.query_id = n.query_id AND pr.u = n.vec_id AND pr.v = s.vec_id),
s{t + 1} AS (SELECT query_id, vec_id, distance FROM n{t}
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(0.5 * (1 - distance) - 0.5 * near, 9) DESC, r) = 1)""")
    picked = " UNION ALL ".join(f"SELECT query_id, vec_id, distance + 0.0 AS distance, {t} AS rank FROM s{t}" for t in (1, 2, 3, 4))
    return ",\n".join(steps) + "\n" + picked


@query("mmr", _mmr_sql())
def mmr(spark, d):
    return shown(R.mmr(asked(spark, d), vectors(spark, d)))


def three_lists(spark, d):
    """The same query by three measures, five results each."""
    lists = [
        R.knn_topk(asked(spark, d), vectors(spark, d), 5, metric).select(
            F.col("query_id").alias("group_id"), F.lit(metric).alias("list_id"), F.col("vec_id").alias("doc_id"), "rank")
        for metric in R.METRICS
    ]
    return lists[0].unionByName(lists[1]).unionByName(lists[2])


LISTS = f"""{E}, lists AS (
  SELECT query_id AS group_id, vec_id AS doc_id, rank FROM ({_ranked(COS, 5)})
  UNION ALL SELECT query_id, vec_id, rank FROM ({_ranked(IP, 5)})
  UNION ALL SELECT query_id, vec_id, rank FROM ({_ranked(L2, 5)}))"""


@query("rrf_fuse", f"""WITH {LISTS}, f AS (
  SELECT group_id, doc_id, round(sum(1 / (rank + 60.0::DOUBLE)), 12) AS score FROM lists GROUP BY 1, 2)
SELECT group_id, doc_id, score,
  CAST(row_number() OVER (PARTITION BY group_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM f QUALIFY rank <= 4""")
def rrf_fuse(spark, d):
    return R.rrf_fuse(three_lists(spark, d))


@query("multi_query_union", f"""WITH {LISTS}
SELECT group_id, doc_id, CAST(min(rank) AS INTEGER) AS best_rank FROM lists GROUP BY 1, 2""")
def multi_query_union(spark, d):
    return R.multi_query_union(three_lists(spark, d))


@query("hybrid_search", """
WITH dq AS (SELECT item_id AS query_id, text, embedding::DOUBLE[] AS x FROM benchmark JOIN embeddings ON item_id = vec_id),
dd AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS toks, embedding::DOUBLE[] AS x
       FROM documents JOIN embeddings ON doc_id = vec_id),
n AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM dd),
tf AS (SELECT doc_id, tok, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS tok FROM dd) GROUP BY 1, 2),
df AS (SELECT tok, count(*) AS df FROM tf GROUP BY 1),
qt AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS tok FROM dq),
k AS (SELECT query_id, doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(toks) / avgdl))) AS s
      FROM qt JOIN tf USING (tok) JOIN df USING (tok) JOIN dd USING (doc_id), n GROUP BY 1, 2),
p AS (SELECT q.query_id, v.doc_id, coalesce(k.s, 0) AS ks,
        list_dot_product(q.x, v.x) / (sqrt(list_dot_product(q.x, q.x)) * sqrt(list_dot_product(v.x, v.x))) AS vs
      FROM dq q CROSS JOIN dd v LEFT JOIN k ON k.query_id = q.query_id AND k.doc_id = v.doc_id),
m AS (SELECT *, min(ks) OVER w AS k0, max(ks) OVER w AS k1, min(vs) OVER w AS v0, max(vs) OVER w AS v1 FROM p WINDOW w AS (PARTITION BY query_id)),
s AS (SELECT query_id, doc_id, round(0.75 * CASE WHEN v1 > v0 THEN (vs - v0) / (v1 - v0) ELSE 0 END
        + 0.25 * CASE WHEN k1 > k0 THEN (ks - k0) / (k1 - k0) ELSE 0 END, 9) AS score FROM m)
SELECT query_id, doc_id, score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
FROM s QUALIFY rank <= 4""")
def hybrid_search(spark, d):
    e = vectors(spark, d)
    items = table(spark, d, "benchmark").join(e, F.col("item_id") == e.vec_id).select(
        F.col("item_id").alias("query_id"), "text", "embedding")
    body = spread(table(spark, d, "documents")).join(e, F.col("doc_id") == e.vec_id).select(
        "doc_id", F.col("text").alias("page_content"), "embedding")
    return R.hybrid_search(items, body)


def candidates(spark, d, k=10):
    """Nearest documents of each benchmark item by vector, with both texts."""
    e = vectors(spark, d)
    items = table(spark, d, "benchmark").join(e, F.col("item_id") == e.vec_id).select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"), "embedding")
    body = docs(spark, d).join(e, F.col("doc_id") == e.vec_id).select(
        "vec_id", "page_content", "metadata", "embedding", "source")
    found = R.knn_topk(items, body.select("vec_id", "embedding"), k)
    return found.join(items.select("query_id", "query_text"), "query_id").join(body.drop("embedding"), "vec_id")


CANDIDATES = """e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
items AS (SELECT item_id AS query_id, text AS query_text, x FROM benchmark JOIN e ON item_id = vec_id),
body AS (SELECT vec_id, text AS page_content, lang, source, n_chars,
           '{"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}' AS metadata, x
         FROM documents JOIN e ON doc_id = vec_id),
c AS (SELECT query_id, query_text, v.vec_id, page_content, lang, source, n_chars, metadata,
        round(1 - list_dot_product(q.x, v.x) / (sqrt(list_dot_product(q.x, q.x)) * sqrt(list_dot_product(v.x, v.x))), 9) AS distance,
        row_number() OVER (PARTITION BY query_id ORDER BY
          round(1 - list_dot_product(q.x, v.x) / (sqrt(list_dot_product(q.x, q.x)) * sqrt(list_dot_product(v.x, v.x))), 9), v.vec_id) AS rank
      FROM items q, body v QUALIFY rank <= 10)"""


@query("rerank", f"""WITH {CANDIDATES}, t AS (
  SELECT *, list_distinct(regexp_extract_all(lower(query_text), '[\\p{{L}}\\p{{N}}]+')) AS qw FROM c),
s AS (SELECT *, len(list_intersect(qw, regexp_extract_all(lower(page_content), '[\\p{{L}}\\p{{N}}]+'))) / len(qw)::DOUBLE AS score FROM t)
SELECT query_id, vec_id, round(score, 6) AS score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, rank, vec_id) AS INTEGER) AS new_rank
FROM s QUALIFY new_rank <= 4""")
def rerank(spark, d):
    return R.rerank(candidates(spark, d)).select("query_id", "vec_id", F.round("score", 6).alias("score"), "new_rank")


@query("rerank_by_model", f"""WITH {CANDIDATES}, s AS (
  SELECT *, 1 / (1 + abs(length(query_text) - length(page_content)))::DOUBLE AS score FROM c)
SELECT query_id, vec_id, round(score, 9) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, rank, vec_id) AS INTEGER) AS new_rank
FROM s QUALIFY new_rank <= 4""")
def rerank_by_model(spark, d):
    """A pandas scorer: similarity of the two lengths."""
    def by_length(questions, contents):
        return 1.0 / (1.0 + (questions.str.len() - contents.str.len()).abs())

    return R.rerank(candidates(spark, d), by_length).select(
        "query_id", "vec_id", F.round("score", 9).alias("score"), "new_rank")


@query("extracted_filter_search", f"""WITH {E}, r AS ({_ranked(COS, 4, "v.label = CASE WHEN q.label >= 5 THEN q.label ELSE 3 END")})
SELECT {PAIRS} FROM r""")
def extracted_filter_search(spark, d):
    """Queries with a label of five and more look for their own label, the others for the base one."""
    own = F.when(F.col("label") >= 5, F.create_map(F.lit("label"), F.col("label").cast("string")))
    queries = asked(spark, d).withColumn("filter", own)
    tagged = vectors(spark, d).withColumn("metadata", F.to_json(F.struct("label")))
    return shown(R.extracted_filter_search(queries, tagged, {"label": "3"}))


@query("format_results", f"""WITH {CANDIDATES}
SELECT query_id, vec_id, '[' || source || '/' || n_chars || '] ' || page_content || ' {{{{metadata.none}}}}' AS line FROM c""")
def format_results(spark, d):
    template = "[{{metadata.source}}/{{metadata.n_chars}}] {{context}} {{metadata.none}}"
    return candidates(spark, d).select(
        "query_id", "vec_id", R.format_results(F.col("page_content"), F.col("metadata"), template).alias("line"))


@query("join_context", f"""WITH {CANDIDATES}
SELECT query_id, part, count(*) OVER (PARTITION BY query_id) AS n_parts, string_agg(page_content, chr(10) || chr(10) ORDER BY rank) AS context
FROM (SELECT *, CAST(sum(length(page_content) + 2) OVER (PARTITION BY query_id ORDER BY rank) - length(page_content) - 2 AS BIGINT) // 300 AS part FROM c) GROUP BY query_id, part""")
def join_context(spark, d):
    return R.join_context(candidates(spark, d), "\n\n", part_chars=300)


@query("join_context_json", f"""WITH {CANDIDATES}
SELECT query_id, part, count(*) OVER (PARTITION BY query_id) AS n_parts, CAST(count(*) AS INTEGER) AS items, string_agg(page_content, '|' ORDER BY rank) AS contents,
  string_agg(source, '|' ORDER BY rank) AS sources
FROM (SELECT *, CAST(sum(length(page_content)) OVER (PARTITION BY query_id ORDER BY rank) - length(page_content) AS BIGINT) // 300 AS part FROM c) GROUP BY query_id, part""")
def join_context_json(spark, d):
    js = R.join_context(candidates(spark, d), with_metadata=True, part_chars=300)
    items = F.from_json("context", "array<struct<pageContent:string,metadata:struct<source:string>>>")
    return js.select(
        "query_id", "part", "n_parts", F.size(items).alias("items"), F.array_join(items["pageContent"], "|").alias("contents"),
        F.array_join(items["metadata"]["source"], "|").alias("sources"))


@query("multi_store_search", f"""WITH {E}, r AS ({_ranked(COS, 4, part=", v.label")})
SELECT query_id, CAST(label AS VARCHAR) AS store, vec_id, CAST(rank AS INTEGER) AS rank FROM r""")
def multi_store_search(spark, d):
    return R.multi_store_search(asked(spark, d), vectors(spark, d), F.col("label")).select(
        "query_id", "store", "vec_id", "rank")


@query("multi_store_search_last", f"""WITH {E}, r AS ({_ranked(COS, 4, "v.label = 9")})
SELECT query_id, CAST(label AS VARCHAR) AS store, vec_id, CAST(rank AS INTEGER) AS rank FROM r""")
def multi_store_search_last(spark, d):
    return R.multi_store_search(asked(spark, d), vectors(spark, d), F.col("label"), mode="last").select(
        "query_id", "store", "vec_id", "rank")


@query("results_to_chunks", f"""WITH {CANDIDATES}, chunk AS (
  SELECT source, text, min(doc_id) AS no FROM documents WHERE lang <> 'de' GROUP BY 1, 2)
SELECT query_id, vec_id, coalesce(no, -1) AS chunk_no, 'c' || no AS chunk_id
FROM c LEFT JOIN chunk ON chunk.source = c.source AND chunk.text = c.page_content""")
def results_to_chunks(spark, d):
    """Sources as stores; the store holds no German chunk."""
    chunks = docs(spark, d).where("lang <> 'de'").select(
        F.col("source").alias("store_id"), "page_content", F.col("doc_id").alias("chunk_no"),
        F.concat(F.lit("c"), "doc_id").alias("id"))
    results = candidates(spark, d).withColumnRenamed("source", "store_id")
    return R.results_to_chunks(results, chunks).select("query_id", "vec_id", "chunk_no", "chunk_id")


@query("query_stats", f"""WITH {CANDIDATES}
SELECT query_id, 10 AS requested, count(*) AS returned, round(avg(distance), 12) AS mean_distance,
  substr(trim(min(query_text)), 1, 200) AS preview FROM c GROUP BY 1""")
def query_stats(spark, d):
    return R.query_stats(candidates(spark, d), 10).withColumn("mean_distance", F.round("mean_distance", 12))


@query("nearest_chunks")
def nearest_chunks(spark, d):
    """Clean, chunk, hash, index against an earlier ledger, embed, and find five chunks per benchmark item."""
    body = docs(spark, d).where("length(page_content) > 0")
    chunks = chunking.chunk_fixed(body).withColumns({
        "id": chunking.chunk_id(F.col("doc_id"), F.col("chunk_no"), F.col("page_content")),
        "pos": F.col("doc_id") * 1_000_000 + F.col("chunk_no"),
        "store_id": F.lit("main"),
    })
    hashed = written_table(indexing.hash_documents(chunks, NS, nested="flat"))
    ledger = hashed.where("get_json_object(metadata, '$.lang') = 'fr'").groupBy("uid").agg(F.min("doc_id").alias("doc_id")).select(
        F.col("uid").alias("key"), F.lit("main").alias("namespace"), F.lit(1.0).alias("updated_at"),
        F.lit(None).cast("string").alias("group_id"), F.col("doc_id").cast("string").alias("doc_id"))
    added = indexing.index_upsert(hashed, ledger, 2.0, "main").added
    empty = spark.createDataFrame([], "cache_key string, embedding array<float>")
    vectors = indexing.embed_with_cache(added, F.col("page_content"), empty, indexing.hash_embedding, "hash64")[0]
    items = indexing.embed_with_cache(
        table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text"),
        F.col("text"), empty, indexing.hash_embedding, "hash64")[0]
    content = vectors.select(F.col("uid").alias("vec_id"), "page_content", "store_id", "embedding")
    found = R.knn_topk(items, content.select("vec_id", "embedding"), 5).join(content.drop("embedding"), "vec_id")
    return R.results_to_chunks(found, hashed).select(
        "query_id", "rank", "chunk_id", "chunk_no", "distance")
