"""Registered queries: hashes, ledger and caches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import indexing as X
from tidemark.plans.inputs import DOCS, MESSAGES, docs, messages, table
from tidemark.plans.registry import query

NS = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"  # the DNS namespace of RFC 4122


def _uuid5_sql(name: str) -> str:
    """uuid5 of the sha256 of `name`, in SQL."""
    h = f"sha1(unhex('{NS.replace('-', '')}') || encode(sha256({name})))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
            f"translate(substr({h},17,1),'0123456789abcdef','{'89ab' * 4}') || substr({h},18,3) || '-' || substr({h},21,12))")


# keys of the metadata in sorted order: lang, n_chars, source
SORTED = """'{"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}'"""
HASHED = f"""{DOCS}, h1 AS (
  SELECT *, {_uuid5_sql('page_content')} AS content_hash, {_uuid5_sql(SORTED)} AS metadata_hash FROM docs),
hashed AS (SELECT *, {_uuid5_sql('content_hash || metadata_hash')} AS hash, doc_id + 1 AS pos FROM h1)"""


def hashed(spark, d):
    return X.hash_documents(docs(spark, d), NS, nested="flat").withColumn("pos", F.col("doc_id") + 1)


@query("hash_documents", f"""
WITH {HASHED} SELECT doc_id, content_hash, metadata_hash, hash, hash AS uid FROM hashed""")
def hash_documents(spark, d):
    out = X.hash_documents(docs(spark, d), NS)
    return out.select("doc_id", "content_hash", "metadata_hash", "hash", "uid")


@query("dedup_in_order", f"""
WITH {HASHED} SELECT doc_id, content_hash FROM hashed
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY pos) = 1""")
def dedup_in_order(spark, d):
    return X.dedup_in_order(hashed(spark, d), "content_hash").select("doc_id", "content_hash")


@query("dedup_in_batches", f"""
WITH {HASHED} SELECT doc_id, content_hash FROM hashed
QUALIFY row_number() OVER (PARTITION BY content_hash, (pos - 1) // 100 ORDER BY pos) = 1""")
def dedup_in_batches(spark, d):
    return X.dedup_in_order(hashed(spark, d), "content_hash", batch_size=100).select("doc_id", "content_hash")


def ledger(spark, d):
    """The ledger as an earlier run left it, keyed by content; the Spanish documents also in a second namespace."""
    old = hashed(spark, d).where("lang <> 'de'").groupBy("content_hash").agg(F.min_by(F.struct("source", "doc_id"), "pos").alias("f"))
    own = old.select(
        F.col("content_hash").alias("key"), F.lit("ns").alias("namespace"), F.lit(100.0).alias("updated_at"),
        F.col("f.source").alias("group_id"), F.col("f.doc_id").cast("string").alias("doc_id"))
    other = hashed(spark, d).where("lang = 'es'").select(
        F.col("hash").alias("key"), F.lit("other").alias("namespace"), F.lit(50.0).alias("updated_at"),
        F.col("source").alias("group_id"), F.col("doc_id").cast("string").alias("doc_id")).dropDuplicates(["key"])
    return own, other


LEDGER = """own AS (
  SELECT content_hash AS key, 'ns' AS namespace, 100.0::DOUBLE AS updated_at, source AS group_id, CAST(doc_id AS VARCHAR) AS doc_id
  FROM hashed WHERE lang <> 'de'
  QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY pos) = 1)"""

INCOMING = """inc AS (
  SELECT content_hash AS uid, source, doc_id, pos FROM hashed WHERE source <> 'src7'
  QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY pos) = 1)"""


def incoming(spark, d):
    return hashed(spark, d).where("source <> 'src7'").withColumn("uid", F.col("content_hash"))


def upserted(spark, d, **options):
    return X.index_upsert(incoming(spark, d), ledger(spark, d)[0], 200.0, "ns", "source", **options)


UPSERT = f"""WITH {HASHED}, {LEDGER}, {INCOMING},
records AS (
  SELECT coalesce(key, uid) AS key, 'ns' AS namespace,
         CASE WHEN uid IS NOT NULL THEN 200.0 ELSE updated_at END::DOUBLE AS updated_at,
         CASE WHEN key IS NULL THEN source ELSE group_id END AS group_id,
         CASE WHEN uid IS NULL THEN own.doc_id ELSE CAST(inc.doc_id AS VARCHAR) END AS doc_id
  FROM inc FULL JOIN own ON uid = key)"""


@query("index_upsert", f"{UPSERT} SELECT * FROM records")
def index_upsert(spark, d):
    return upserted(spark, d).records


@query("index_upsert_added", f"{UPSERT} SELECT doc_id, uid FROM inc WHERE uid NOT IN (SELECT key FROM own)")
def index_upsert_added(spark, d):
    return upserted(spark, d).added.select("doc_id", "uid")


@query("index_upsert_counters", f"""{UPSERT}, per AS (
  SELECT DISTINCT content_hash AS uid, (pos - 1) // 100 AS b FROM hashed WHERE source <> 'src7')
SELECT (SELECT count(*) FROM inc WHERE uid NOT IN (SELECT key FROM own)) AS num_added,
  CAST(0 AS BIGINT) AS num_updated,
  (SELECT count(*) FROM per) - (SELECT count(*) FROM inc WHERE uid NOT IN (SELECT key FROM own)) AS num_skipped,
  (SELECT count(*) FROM inc) AS total_keys""")
def index_upsert_counters(spark, d):
    return upserted(spark, d, batch_size=100).counters


@query("index_upsert_force", f"""{UPSERT}
SELECT count(*) FILTER (WHERE key IS NULL) AS num_added, count(*) FILTER (WHERE key IS NOT NULL) AS num_updated,
  CAST(0 AS BIGINT) AS num_skipped, count(*) AS total_keys
FROM inc LEFT JOIN own ON uid = key""")
def index_upsert_force(spark, d):
    return upserted(spark, d, force=True).counters


RUN = "FROM hashed WHERE source <> 'src7' AND lang = 'en' AND source <> 'src1'"

# the same keys once more in a second namespace, which a cleanup must leave alone
TWO = "two AS (SELECT * FROM own UNION ALL SELECT key, 'other', updated_at, group_id, doc_id FROM own)"


def two_namespaces(spark, d):
    own = ledger(spark, d)[0]
    return own.unionByName(own.withColumn("namespace", F.lit("other")))


@query("index_cleanup_incremental", f"""WITH {HASHED}, {LEDGER}, {TWO}
SELECT * FROM two WHERE namespace = 'other' OR NOT (key NOT IN (SELECT content_hash {RUN}) AND group_id IN (SELECT source {RUN}))""")
def index_cleanup_incremental(spark, d):
    run = incoming(spark, d).where("lang = 'en' AND source <> 'src1'")
    return X.index_cleanup_incremental(run, two_namespaces(spark, d), 200.0, "ns", "source")


@query("index_cleanup_full", f"""{UPSERT}, {TWO}
SELECT * FROM two WHERE namespace = 'other' OR key IN (SELECT uid FROM inc)""")
def index_cleanup_full(spark, d):
    return X.index_cleanup_full(incoming(spark, d), two_namespaces(spark, d), 200.0, "ns")


@query("ledger_upsert", f"""WITH {HASHED}, {LEDGER}, {INCOMING}, new AS (
  SELECT content_hash AS key, min('moved-' || source) AS g, min(CAST(doc_id AS VARCHAR)) AS d
  FROM hashed WHERE source <> 'src7' GROUP BY 1)
SELECT coalesce(own.key, new.key) AS key, 'ns' AS namespace,
  CASE WHEN new.key IS NOT NULL THEN 300.0 ELSE updated_at END::DOUBLE AS updated_at,
  CASE WHEN own.key IS NOT NULL THEN group_id ELSE g END AS group_id,
  CASE WHEN new.key IS NOT NULL THEN d ELSE doc_id END AS doc_id
FROM own FULL JOIN new ON own.key = new.key""")
def ledger_upsert(spark, d):
    keys = incoming(spark, d).select(
        F.col("uid").alias("key"), F.lit("ns").alias("namespace"),
        F.concat(F.lit("moved-"), "source").alias("group_id"), F.col("doc_id").cast("string").alias("doc_id"))
    return X.ledger_upsert(ledger(spark, d)[0], keys, 300.0, time_at_least=200.0)


@query("ledger_list_keys", f"""{UPSERT}
SELECT key FROM records WHERE updated_at < 300 AND updated_at > 150 AND group_id IN ('src1','src2','src3') ORDER BY key LIMIT 100""")
def ledger_list_keys(spark, d):
    return X.ledger_list_keys(
        upserted(spark, d).records, "ns", before=300.0, after=150.0, groups=["src1", "src2", "src3"], limit=100)


@query("ledger_delete", f"""WITH {HASHED}, {LEDGER}, other AS (
  SELECT DISTINCT hash AS key, 'other' AS namespace FROM hashed WHERE lang = 'es')
SELECT key, namespace FROM own WHERE key NOT IN (SELECT content_hash FROM hashed WHERE source = 'src7')
UNION ALL SELECT key, namespace FROM other""")
def ledger_delete(spark, d):
    own, other = ledger(spark, d)
    gone = hashed(spark, d).where("source = 'src7'").select(F.col("content_hash").alias("key"))
    return X.ledger_delete(own.unionByName(other), "ns", keys=gone).select("key", "namespace")


def counted_letters(texts: pd.Series) -> pd.Series:
    """A model that SQL can follow: length, spaces and line feeds of a text."""
    return texts.map(lambda t: [float(len(t)), float(t.count(" ")), float(t.count("\n"))])


@query("embed_with_cache", """
SELECT doc_id, sha256('letters:' || text) AS cache_key, CAST(length(text) AS DOUBLE) AS letters,
  CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS spaces, CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS feeds FROM documents""")
def embed_with_cache(spark, d):
    """The cache knows every second document before."""
    empty = spark.createDataFrame([], "cache_key string, embedding array<float>")
    some = docs(spark, d).where("doc_id % 2 = 0")
    cache = X.embed_with_cache(some, F.col("page_content"), empty, counted_letters, "letters")[1]
    rows = X.embed_with_cache(docs(spark, d), F.col("page_content"), cache, counted_letters, "letters")[0]
    return rows.select("doc_id", "cache_key", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(("letters", "spaces", "feeds"))])


@query("embed_with_hashes")
def embed_with_hashes(spark, d):
    empty = spark.createDataFrame([], "cache_key string, embedding array<float>")
    return X.embed_with_cache(docs(spark, d), F.col("page_content"), empty, X.hash_embedding, "hash64")[0].select(
        "doc_id", "cache_key", "embedding")


@query("response_cache", f"""WITH {MESSAGES}, q AS (
  SELECT id, conv_id, turn, content, sha256(content || '_' || chat_id) AS cache_key FROM messages WHERE role = 'userMessage'),
c AS (SELECT cache_key, min(content) AS value FROM q WHERE turn = 0 GROUP BY 1)
SELECT q.id, q.cache_key, c.cache_key IS NOT NULL AS hit, c.value FROM q LEFT JOIN c ON q.cache_key = c.cache_key""")
def response_cache(spark, d):
    asked = messages(spark, d).where("role = 'userMessage'")
    cache = (
        asked.where("turn = 0").select(X.cache_key(F.col("content"), F.col("chat_id")).alias("cache_key"), "content")
        .groupBy("cache_key").agg(F.min("content").alias("value"))
    )
    return X.response_cache(asked, F.col("content"), F.col("chat_id"), cache).select("id", "cache_key", "hit", "value")


@query("upsert_history", """
SELECT o_orderkey AS id, 'flow' || (o_custkey % 3) AS flow_id, o_orderkey % 10 AS "numAdded", o_orderkey % 7 AS "numUpdated",
  o_orderkey % 5 AS "numSkipped", o_orderkey % 3 AS "numDeleted"
FROM orders WHERE o_custkey % 3 = 1 AND o_orderdate >= TIMESTAMP '1994-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31 23:59:59'""")
def upsert_history(spark, d):
    key = F.col("o_orderkey")
    history = table(spark, d, "orders").select(
        key.alias("id"),
        F.concat(F.lit("flow"), F.col("o_custkey") % 3).alias("flow_id"),
        F.to_json(F.struct((key % 10).alias("numAdded"), (key % 7).alias("numUpdated"),
                           (key % 5).alias("numSkipped"), (key % 3).alias("numDeleted"))).alias("result"),
        F.col("o_orderdate").alias("date"),
    )
    return X.upsert_history(history, "flow1", "1994-01-01", "1996-12-31 23:59:59").drop("date")
