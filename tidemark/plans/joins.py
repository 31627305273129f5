"""Registered queries: lookups and cascades."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.plans.inputs import FEEDBACK, MESSAGES, feedback, messages, table
from tidemark.plans.registry import query


@query("message_context", f"""WITH {MESSAGES}, {FEEDBACK}
SELECT m.id, m.session_id, o_orderstatus AS state, rating
FROM messages m LEFT JOIN orders ON o_orderkey = m.execution_id LEFT JOIN feedback f ON f.message_id = m.id""")
def message_context(spark, d):
    executions = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("execution_id"), F.col("o_orderstatus").alias("state"))
    return J.message_context(messages(spark, d), executions, feedback(spark, d)).select(
        "id", "session_id", "state", "rating")


def removed(spark, d):
    return table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))


@query("cascade_delete", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def cascade_delete(spark, d):
    return J.cascade_delete(removed(spark, d), table(spark, d, "lineitem"), "l_orderkey").select("l_orderkey", "l_linenumber")


@query("cascade_nullify", """
SELECT CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') THEN NULL ELSE l_orderkey END AS l_orderkey,
  l_linenumber, l_partkey FROM lineitem""")
def cascade_nullify(spark, d):
    return J.cascade_delete(removed(spark, d), table(spark, d, "lineitem"), "l_orderkey", "nullify").select(
        "l_orderkey", "l_linenumber", "l_partkey")


def prices(spark, d):
    """Price lists drawn from the event types: the chat list knows some models, the other list all."""
    kinds = table(spark, d, "events").select(F.col("event_type").alias("model")).distinct()
    listed = kinds.select(
        F.lit("Acme").alias("provider"), "model",
        (F.length("model") / 100).alias("input_cost"), (F.length("model") / 50).alias("output_cost"),
        F.when(F.col("model") == "view", 1.0).otherwise(0.0).alias("total_price"),
        (F.length("model") / 40).alias("total_cost"))
    return listed.where("model in ('click', 'view')"), listed.withColumn("input_cost", F.col("input_cost") * 2)


PRICES = """listed AS (
  SELECT DISTINCT event_type AS model, length(event_type) / 100 * CASE WHEN event_type IN ('click','view') THEN 1 ELSE 2 END AS input_cost,
    length(event_type) / 50 AS output_cost, CASE WHEN event_type = 'view' THEN 1.0 ELSE 0.0 END::DOUBLE AS total_price,
    length(event_type) / 40 AS total_cost FROM events)"""


@query("price_lookup", f"""WITH {PRICES}
SELECT event_id, round(CASE WHEN event_id % 2 = 0 THEN input_cost END, 6) AS input_cost,
  round(CASE WHEN event_id % 2 = 0 THEN total_cost END, 6) AS total_cost FROM events JOIN listed ON event_type = model""")
def price_lookup(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, "ACME").otherwise("other").alias("provider"),
        F.col("event_type").alias("model"))
    return J.price_lookup(rows, *prices(spark, d)).select(
        "event_id", F.round("input_cost", 6).alias("input_cost"), F.round("total_cost", 6).alias("total_cost"))


@query("array_lookup", """
SELECT l_orderkey, coalesce(string_agg(p_name, '|' ORDER BY l_linenumber, l_partkey) FILTER (WHERE p_size > 10), '') AS names
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def array_lookup(spark, d):
    """Part names of every order; the name list lacks small parts."""
    orders = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda s: s["l_partkey"]).alias("ids"))
    names = table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return J.array_lookup(orders, "l_orderkey", F.col("ids"), names).withColumn("names", F.array_join("names", "|"))
