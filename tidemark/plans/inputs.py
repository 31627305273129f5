"""Input tables of the registered queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DOCS = """docs AS (
  SELECT doc_id, text AS page_content, source, lang, n_chars,
         '{"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}' AS metadata
  FROM documents)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("text").alias("page_content"),
        "source",
        "lang",
        "n_chars",
        F.to_json(F.struct("lang", "source", "n_chars")).alias("metadata"),
    )


MESSAGES = """messages AS (
  SELECT conv_id * 1000 + turn AS id, conv_id, turn,
         CASE role WHEN 'assistant' THEN 'apiMessage' WHEN 'user' THEN 'userMessage' ELSE role END AS role,
         'flow' || (conv_id % 3) AS chatflow_id, 'chat' || conv_id AS chat_id,
         CASE WHEN conv_id % 2 = 0 THEN 'buffer' END AS memory_type,
         CASE WHEN conv_id % 11 = 0 THEN NULL ELSE 's' || conv_id END AS session_id,
         CASE conv_id % 4 WHEN 0 THEN 'INTERNAL' WHEN 1 THEN 'EXTERNAL' WHEN 2 THEN 'EVALUATION' END AS chat_type,
         conv_id AS execution_id, text AS content,
         1704067200 + conv_id * 3600 + turn * 60 AS created_s
  FROM conversations)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    seconds = F.lit(1704067200) + conv * 3600 + F.col("turn") * 60
    return table(spark, sf_dir, "conversations").select(
        (conv * 1000 + F.col("turn")).alias("id"),
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", "apiMessage").when(F.col("role") == "user", "userMessage")
        .otherwise(F.col("role")).alias("role"),
        F.concat(F.lit("flow"), conv % 3).alias("chatflow_id"),
        F.concat(F.lit("chat"), conv).alias("chat_id"),
        F.when(conv % 2 == 0, "buffer").alias("memory_type"),
        F.when(conv % 11 != 0, F.concat(F.lit("s"), conv)).alias("session_id"),
        F.when(conv % 4 == 0, "INTERNAL").when(conv % 4 == 1, "EXTERNAL").when(conv % 4 == 2, "EVALUATION")
        .alias("chat_type"),
        conv.alias("execution_id"),
        F.col("text").alias("content"),
        F.timestamp_seconds(seconds).alias("created"),
    )


FEEDBACK = """feedback AS (
  SELECT conv_id * 1000 + turn AS message_id,
         CASE WHEN (conv_id + turn) % 2 = 0 THEN 'THUMBS_UP' ELSE 'THUMBS_DOWN' END AS rating,
         'note ' || turn AS feedback
  FROM conversations WHERE role = 'assistant' AND (conv_id + turn) % 3 <> 0)"""


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.col("conv_id") + F.col("turn")
    return (
        table(spark, sf_dir, "conversations")
        .where((F.col("role") == "assistant") & (mixed % 3 != 0))
        .select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("message_id"),
            F.when(mixed % 2 == 0, "THUMBS_UP").otherwise("THUMBS_DOWN").alias("rating"),
            F.concat(F.lit("note "), "turn").alias("feedback"),
        )
    )


# nested JSON built from the events, the same text in both engines
EVENTS_JS = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         '{"type":"' || event_type || '","user":{"id":' || user_id || ',"tags":["t' || (user_id % 7)
         || '","all"]},"props":' || props || ',"note":' || CASE WHEN event_id % 2 = 0 THEN 'null' ELSE '"n' || (event_id % 5) || '"' END
         || '}' AS js
  FROM events)"""


def event_json() -> Column:
    return F.concat(
        F.lit('{"type":"'), F.col("event_type"), F.lit('","user":{"id":'), F.col("user_id"),
        F.lit(',"tags":["t'), F.col("user_id") % 7, F.lit('","all"]},"props":'), F.col("props"),
        F.lit(',"note":'),
        F.when(F.col("event_id") % 2 == 0, "null").otherwise(
            F.concat(F.lit('"n'), F.col("event_id") % 5, F.lit('"'))),
        F.lit("}"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events")).withColumn("js", event_json())


SUPPLY = """supply AS (
  SELECT p_partkey || '-' || l_suppkey AS id_insumo, min(p_name) AS insumo, min(p_type) AS categoria,
         'supplier ' || l_suppkey AS fornecedor,
         CAST(sum(l_quantity) AS DOUBLE) AS consumo_medio_6m, CAST(sum(l_quantity) * 2 AS DOUBLE) AS consumo_medio_12m,
         min(p_retailprice) AS custo_aquisicao_unitario, CAST(min(p_size) * 10 AS INTEGER) AS lote_minimo_compra,
         CAST(min(p_size) + 5 AS INTEGER) AS prazo_entrega_dias,
         CAST(min(p_partkey) % 40 - 10 AS DOUBLE) / 100 AS indice_reajuste_12m,
         CASE min(p_size) % 4 WHEN 0 THEN 'alta' WHEN 1 THEN 'Media' WHEN 2 THEN 'baixa' ELSE 'Alta' END AS criticidade_insumo
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, l_suppkey)"""


def supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part and supplier: sums first, so the join meets one row per pair."""
    sums = (
        table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    )
    size = F.col("p_size")
    return sums.join(table(spark, sf_dir, "part"), sums.l_partkey == F.col("p_partkey")).select(
        F.concat_ws("-", "p_partkey", "l_suppkey").alias("id_insumo"),
        F.col("p_name").alias("insumo"),
        F.col("p_type").alias("categoria"),
        F.concat(F.lit("supplier "), "l_suppkey").alias("fornecedor"),
        F.col("qty").alias("consumo_medio_6m"),
        (F.col("qty") * 2).alias("consumo_medio_12m"),
        F.col("p_retailprice").alias("custo_aquisicao_unitario"),
        (size * 10).cast("int").alias("lote_minimo_compra"),
        (size + 5).cast("int").alias("prazo_entrega_dias"),
        ((F.col("p_partkey") % 40 - 10).cast("double") / 100).alias("indice_reajuste_12m"),
        F.when(size % 4 == 0, "alta").when(size % 4 == 1, "Media").when(size % 4 == 2, "baixa").otherwise("Alta")
        .alias("criticidade_insumo"),
    )
