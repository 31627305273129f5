"""Lookups and cascades between tables.  Right sides are unique by key; join strategy is left to AQE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def message_context(messages: DataFrame, executions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Messages with their execution (execution_id) and feedback (message_id), both optional."""
    return messages.join(executions, "execution_id", "left").join(
        feedback.withColumnRenamed("message_id", "id"), "id", "left"
    )


def cascade_delete(parents_removed: DataFrame, child: DataFrame, key: str, mode: str = "delete") -> DataFrame:
    """Children without those of removed parents, or with the reference set to null."""
    gone = parents_removed.select(key).distinct()
    if mode == "delete":
        return child.join(gone, key, "left_anti")
    if mode != "nullify":
        raise ValueError("mode is delete or nullify")
    marked = child.join(gone.withColumn("_gone", F.lit(True)), key, "left")
    return marked.withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).drop("_gone").select(*child.columns)


_PRICE = ("input_cost", "output_cost", "total_price", "total_cost")


def price_lookup(df: DataFrame, chat_prices: DataFrame, llm_prices: DataFrame) -> DataFrame:
    """Prices by provider (any case) and model: the chat list first, then the completion list.

    Of several entries of a model the one with the smallest `position` counts, where the list has that column,
    else the one with the smallest prices.
    """

    def listed(prices: DataFrame, prefix: str) -> DataFrame:
        one = prices.groupBy(F.lower("provider").alias("_provider"), F.col("model").alias("_model")).agg(
            F.min_by(F.struct(*_PRICE), F.struct(*[c for c in ("position",) if c in prices.columns], *_PRICE)).alias(prefix)
        )
        return one

    keyed = df.withColumn("_p", F.lower("provider"))
    for name, prices in (("_chat", chat_prices), ("_llm", llm_prices)):
        right = listed(prices, name)
        keyed = keyed.join(
            right, (keyed["_p"] == right["_provider"]) & (keyed["model"] == right["_model"]), "left"
        ).drop("_provider", "_model")
    price = F.coalesce("_chat", "_llm")
    return keyed.withColumns({c: price[c] for c in _PRICE}).drop("_p", "_chat", "_llm")


def array_lookup(df: DataFrame, key: str, ids: Column, names: DataFrame) -> DataFrame:
    """Names of an array of ids in order, unknown ids dropped.  `names`: id, name; `key` is unique in `df`."""
    exploded = df.select(key, F.posexplode_outer(ids).alias("_at", "id"))
    found = exploded.join(names.select("id", "name"), "id", "left")
    return found.groupBy(key).agg(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("_at", "name")))), lambda s: s["name"]
        ).alias("names")
    )
