"""Registered queries: versions, memory, sequences and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.plans.inputs import MESSAGES, messages, table
from tidemark.plans.registry import query


def evals(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("eval"), "o_custkey").alias("name"),
        F.col("o_orderdate").alias("run_date"))


EVALS = "evals AS (SELECT o_orderkey AS id, 'eval' || o_custkey AS name, o_orderdate AS run_date FROM orders)"


@query("version_numbers", f"""WITH {EVALS}
SELECT id, name, row_number() OVER (PARTITION BY name ORDER BY run_date, id) AS version,
  row_number() OVER (PARTITION BY name ORDER BY run_date DESC, id DESC) = 1 AS latest,
  (SELECT count(DISTINCT name) FROM evals) AS total FROM evals""")
def version_numbers(spark, d):
    return W.version_numbers(evals(spark, d)).select("id", "name", "version", "latest", "total")


@query("version_list", f"""WITH {EVALS}
SELECT id, row_number() OVER (ORDER BY run_date, id) AS version FROM evals WHERE name = 'eval7'""")
def version_list(spark, d):
    return W.version_list(evals(spark, d), "eval7").select("id", "version")


@query("nth_latest", """
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type = 'purchase')
SELECT u.user_id AS key, r.value FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r ON r.user_id = u.user_id AND rn = 12""")
def nth_latest(spark, d):
    e = table(spark, d, "events")
    bought = e.where("event_type = 'purchase'").select(
        F.col("user_id").alias("key"), "ts", F.col("event_id").alias("id"), "value")
    return W.nth_latest(bought, e.select(F.col("user_id").alias("key")).distinct(), 12)


@query("memory_window", f"""WITH {MESSAGES}, l AS (
  SELECT id, session_id, created_s FROM messages QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY created_s DESC, id DESC) <= 4)
SELECT id, session_id, row_number() OVER (PARTITION BY session_id ORDER BY created_s, id) AS pos FROM l
UNION ALL SELECT DISTINCT CAST(-1 AS BIGINT), session_id, CAST(0 AS BIGINT) FROM messages""")
def memory_window(spark, d):
    m = messages(spark, d).select("id", "session_id", "created")
    greeting = m.select("session_id").distinct().select(
        F.lit(-1).cast("bigint").alias("id"), "session_id", F.lit(0).cast("bigint").alias("pos"))
    return W.memory_window(m, 2, greeting).select("id", "session_id", "pos")


@query("memory_token_budget", f"""WITH {MESSAGES}, t AS (
  SELECT id, session_id, CAST(sum(len(regexp_extract_all(content, '\\S+'))) OVER (PARTITION BY session_id ORDER BY created_s DESC, id DESC
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tokens_from_here FROM messages)
SELECT *, tokens_from_here <= 60 AS kept FROM t""")
def memory_token_budget(spark, d):
    return W.memory_token_budget(messages(spark, d), 60).select("id", "session_id", "tokens_from_here", "kept")


ROWS = """rows AS (SELECT l_orderkey AS dataset, l_orderkey * 100 + l_linenumber AS id,
  CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_linenumber END AS sequence_no FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1)"""


def rows(spark, d):
    from pyspark.sql import Window

    first = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey")
    return table(spark, d, "lineitem").withColumn("rn", F.row_number().over(first)).where("rn = 1").select(
        F.col("l_orderkey").alias("dataset"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("l_returnflag") == "R", -1).otherwise(F.col("l_linenumber")).alias("sequence_no"))


@query("sequence_fill", f"""WITH {ROWS}, t AS (SELECT dataset, max(sequence_no) AS top FROM rows GROUP BY 1)
SELECT dataset, id, sequence_no FROM rows WHERE sequence_no <> -1 UNION ALL
SELECT dataset, id, CAST(top + row_number() OVER (PARTITION BY dataset ORDER BY id) AS INTEGER) FROM rows JOIN t USING (dataset) WHERE sequence_no = -1""")
def sequence_fill(spark, d):
    return W.sequence_fill(rows(spark, d), "dataset", "id")


@query("sequence_reorder", f"""WITH {ROWS}
SELECT dataset, id, CASE WHEN sequence_no = 1 THEN 99 ELSE sequence_no END AS sequence_no FROM rows""")
def sequence_reorder(spark, d):
    changes = rows(spark, d).where("sequence_no = 1").select("id", F.lit(99).alias("sequence_no"))
    return W.sequence_reorder(rows(spark, d), changes)


def customers(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"))


def buyers(spark, d):
    return table(spark, d, "orders").where("o_orderstatus <> 'P'").select((F.col("o_custkey") + 100).alias("id"))


_BUYERS = "SELECT o_custkey + 100 AS id FROM orders WHERE o_orderstatus <> 'P'"

for _op, _sql in (
    ("union", f"SELECT c_custkey AS id FROM customer UNION ALL {_BUYERS}"),
    ("intersect", f"SELECT c_custkey AS id FROM customer INTERSECT {_BUYERS}"),
    ("except", f"SELECT c_custkey AS id FROM customer EXCEPT {_BUYERS}"),
    ("distinct", f"SELECT DISTINCT id FROM ({_BUYERS})"),
):

    @query(f"set_ops_{_op}", _sql)
    def set_op(spark, d, op=_op):
        first = buyers(spark, d) if op == "distinct" else customers(spark, d)
        return W.set_ops(first, buyers(spark, d), op)


@query("set_ops", f"""SELECT 'union' AS op, c_custkey AS id FROM customer UNION ALL SELECT 'union', id FROM ({_BUYERS})
UNION ALL SELECT 'intersect', id FROM (SELECT c_custkey AS id FROM customer INTERSECT {_BUYERS})
UNION ALL SELECT 'except', id FROM (SELECT c_custkey AS id FROM customer EXCEPT {_BUYERS})
UNION ALL SELECT DISTINCT 'distinct', id FROM ({_BUYERS})""")
def set_ops(spark, d):
    """All four operations side by side."""
    out = None
    for op in ("union", "intersect", "except", "distinct"):
        first = buyers(spark, d) if op == "distinct" else customers(spark, d)
        part = W.set_ops(first, buyers(spark, d), op).select(F.lit(op).alias("op"), "id")
        out = part if out is None else out.unionByName(part)
    return out
