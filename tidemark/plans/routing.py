"""Registered queries: routing, state, per-item steps, prompts and user functions."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import templates
from tidemark.operators import routing as R
from tidemark.plans.inputs import MESSAGES, docs, messages, table
from tidemark.plans.registry import query
from tidemark.sources.custom import load_custom


@query("route_first_match", """
SELECT o_orderkey, CAST(CASE WHEN starts_with(o_orderpriority, '1') THEN 0 WHEN o_totalprice >= 150000.5 THEN 1
  WHEN regexp_matches(o_orderpriority, '^[2-3]') THEN 2 WHEN ends_with(o_orderpriority, 'LOW') THEN 4 ELSE 5 END AS INTEGER) AS branch FROM orders""")
def route_first_match(spark, d):
    p, price = F.col("o_orderpriority"), F.col("o_totalprice")
    return R.route_first_match(table(spark, d, "orders"), [
        {"type": "string", "value1": p, "operation": "startsWith", "value2": "1"},
        {"type": "number", "value1": price, "operation": "largerEqual", "value2": "150000.5 units"},
        {"type": "string", "value1": p, "operation": "regex", "value2": "^[2-3]"},
        {"type": "string", "value1": p, "operation": "regex", "value2": "(["},
        {"type": "string", "value1": p, "operation": "endsWith", "value2": "LOW"},
    ]).select("o_orderkey", "branch")


@query("route_condition_grid", """
SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'HIGH') THEN 'high' WHEN o_totalprice > 200000 THEN 'big'
  WHEN o_orderstatus = 'P' THEN 'pending' WHEN starts_with(o_orderpriority, '5') THEN 'low' ELSE 'End' END AS branch FROM orders""")
def route_condition_grid(spark, d):
    return R.route_condition_grid(table(spark, d, "orders"), [
        {"variable": "o_orderpriority", "operation": "Contains", "value": "HIGH", "output": "high"},
        {"variable": "o_totalprice", "operation": "Greater Than", "value": "200000", "output": "big"},
        {"variable": "o_totalprice", "operation": "Less Than", "value": "much", "output": "never"},
        {"variable": "o_orderstatus", "operation": "Is", "value": "P", "output": "pending"},
        {"variable": "o_orderpriority", "operation": "Is Empty", "output": "empty"},
        {"variable": "o_orderpriority", "operation": "Start With", "value": "5", "output": "low"},
    ]).select("o_orderkey", "branch")


@query("match_scenario", """
SELECT event_id, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 0 WHEN 'signup' THEN 4 ELSE 3 END AS INTEGER) AS idx FROM events""")
def match_scenario(spark, d):
    """Upper case and blanks around; a prefix, a part, an exact name, and none."""
    label = F.concat(F.lit(" "), F.upper("event_type"), F.lit(" "))
    return R.match_scenario(
        table(spark, d, "events"), label, ["a purchase was made", "Click", "Errors of all kinds", "VIEW", "other"]
    ).select("event_id", "idx")


@query("iterate_items", f"""WITH {MESSAGES}
SELECT conv_id, string_agg(CASE WHEN role = 'system' THEN 'Error in iteration ' || (turn + 1) || ': system text'
  ELSE turn || CASE WHEN turn = 0 THEN ' first' ELSE '' END || ' ' || content END, chr(10) ORDER BY turn) AS content
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM messages) GROUP BY 1""")
def iterate_items(spark, d):
    rows = messages(spark, d).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "content"))).alias("items"))

    def step(item, index, is_first, is_last):
        head = F.when(is_first, " first").otherwise("")
        value = F.concat(index, head, F.lit(" "), item["content"])
        return value, F.when(item["role"] == "system", F.lit("system text"))

    return R.iterate_items(rows, F.col("items"), step).select("conv_id", "content")


@query("loop_until", """
SELECT o_orderkey, CAST(least(5, greatest(1, ceil(ln(o_totalprice / 10000) / ln(2)))) AS INTEGER) AS rounds FROM orders""")
def loop_until(spark, d):
    """Halve the price until it is at most 10,000, five times at the most."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return R.loop_until(
        rows, lambda df: df.withColumn("o_totalprice", F.col("o_totalprice") / 2), lambda df: F.col("o_totalprice") <= 10000
    ).select("o_orderkey", "rounds")


@query("fold_state", f"""WITH {MESSAGES}
, p AS (SELECT *, CAST(sum(length(role) + 1) OVER (PARTITION BY conv_id ORDER BY turn) - length(role) - 1 AS BIGINT) // 40 AS part FROM messages),
q AS (SELECT conv_id, coalesce(arg_max(content, turn) FILTER (WHERE role = 'userMessage'), 'none') AS last_question FROM messages GROUP BY 1)
SELECT conv_id, part, count(*) OVER (PARTITION BY conv_id) AS n_parts, count(*) AS updates, string_agg(role, ',' ORDER BY turn) AS roles, any_value(last_question) AS last_question
FROM p JOIN q USING (conv_id) GROUP BY conv_id, part""")
def fold_state(spark, d):
    rows = messages(spark, d).select(
        "conv_id", "turn", F.col("role").alias("roles"),
        F.when(F.col("role") == "userMessage", F.col("content")).alias("last_question"))
    out = R.fold_state(rows, "conv_id", {"roles": "append", "last_question": "replace"}, ["turn"], {"last_question": "none"}, part_chars=40)
    return out.select("conv_id", "part", "n_parts", "updates", F.array_join("roles", ",").alias("roles"), "last_question")


@query("merge_branch_outputs", """
WITH l AS (SELECT l_orderkey, l_linenumber, arg_max(l_partkey, l_partkey * 100000 + l_suppkey) AS part, arg_max(l_returnflag, l_partkey * 100000 + l_suppkey) AS flag
  FROM lineitem GROUP BY 1, 2)
, p AS (SELECT *, CAST(sum(length('{"part":' || part || '}') + length(flag)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - length('{"part":' || part || '}') - length(flag) AS BIGINT) // 40 AS chunk
  FROM l)
SELECT l_orderkey, chunk AS part, count(*) OVER (PARTITION BY l_orderkey) AS n_parts, '{' || string_agg('"node' || l_linenumber || '":{"part":' || part || '}', ',' ORDER BY l_linenumber) || '}' AS json,
  string_agg(flag, chr(10) ORDER BY l_linenumber) AS text FROM p GROUP BY l_orderkey, chunk""")
def merge_branch_outputs(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_json(F.struct(F.col("l_partkey").alias("part"))).alias("json"),
        F.col("l_returnflag").alias("text"), (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("pos"))
    return R.merge_branch_outputs(rows, "l_orderkey", F.concat(F.lit("node"), "l_linenumber"), part_chars=40)


@query("render_template", """
SELECT c_custkey, 'Dear ' || c_name || ' of ' || c_nationkey || ', {{unknown}} {"seg":"' || c_mktsegment || '"}' AS text FROM customer""")
def render_template(spark, d):
    fields = {"name": F.col("c_name"), "nation": F.col("c_nationkey"), "obj": F.struct(F.col("c_mktsegment").alias("seg"))}
    text = templates.render_template("Dear {{name}} of {{ nation }}, {{unknown}} {{obj}}", fields, {"obj": "struct"})
    return table(spark, d, "customer").select("c_custkey", text.alias("text"))


@query("few_shot_prompt", """
WITH x AS (SELECT item_id, item_id % 8 AS topic, 'Q: ' || text || ' (' || item_id || ')' AS q FROM benchmark),
p AS (SELECT *, CAST(sum(length(q) + 1) OVER (PARTITION BY topic ORDER BY item_id) - length(q) - 1 AS BIGINT) // 500 AS part FROM x),
e AS (SELECT topic, part, string_agg(q, chr(10) ORDER BY item_id) AS t, count(*) OVER (PARTITION BY topic) AS n_parts, max(part) OVER (PARTITION BY topic) AS last FROM p GROUP BY topic, part)
SELECT doc_id, part, n_parts, CASE WHEN part = 0 THEN 'Answer briefly.' || chr(10) ELSE '' END || t || CASE WHEN part = last THEN chr(10) || 'Now: ' || lang ELSE '' END AS prompt
FROM documents JOIN e ON topic = doc_id % 8""")
def few_shot_prompt(spark, d):
    """Benchmark items as examples of eight topics, one prompt per document."""
    examples = table(spark, d, "benchmark").withColumn("topic", F.col("item_id") % 8)
    rows = docs(spark, d).select("doc_id", "lang", (F.col("doc_id") % 8).alias("topic"))
    out = R.few_shot_prompt(rows, examples, "topic", "item_id", "Q: {text} ({item_id})", "Answer briefly.", "Now: {lang}", "\n", part_chars=500)
    return out.select("doc_id", "part", "n_parts", "prompt")


@query("parse_structured_output", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events""")
def parse_structured_output(spark, d):
    """Half of the answers fenced, with a trailing comma."""
    body = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(", 'kind': '"), F.col("event_type"), F.lit("',}"))
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nbye"))).otherwise(body)
    parsed = templates.parse_structured_output(text, "k bigint, kind string")
    return table(spark, d, "events").select("event_id", parsed.alias("p")).select("event_id", "p.k", "p.kind")


@query("parse_list_output", """
SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS items, CASE WHEN len(string_split(p_name, ' ')) = 2 THEN 2 END AS pair FROM part""")
def parse_list_output(spark, d):
    text = F.replace("p_name", F.lit(" "), F.lit(" ;  "))
    return table(spark, d, "part").select(
        "p_partkey", F.array_join(templates.parse_list_output(text, ";"), "|").alias("items"),
        F.size(templates.parse_list_output(text, ";", 2)).alias("pair"))


@query("batch_prompt", f"""WITH {MESSAGES}, p AS (SELECT id, 'Summarize: ' || content AS p FROM messages WHERE role = 'userMessage')
SELECT id, sha256(p || '_counter') AS cache_key, CAST(len(regexp_extract_all(p, '\\S+')) AS INTEGER) AS words, p AS head FROM p""")
def batch_prompt(spark, d):
    """Answer every first user message once; the cache already knows the first turns."""
    asked = messages(spark, d).where("role = 'userMessage'").select("id", "turn", "content")
    prompt = templates.render_template("Summarize: {{text}}", {"text": F.col("content")})

    def complete(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: json.dumps({"words": len(p.split()), "head": p}))

    empty = spark.createDataFrame([], "cache_key string, value string")
    cache = R.batch_prompt(asked.where("turn = 0"), prompt, "counter", empty, complete)[1]
    rows, _ = R.batch_prompt(asked, prompt, "counter", cache, complete, "words int, head string")
    return rows.select("id", "cache_key", "parsed.words", "parsed.head")


@query("map_rows", "SELECT doc_id, CAST(n_chars * 2 AS BIGINT) AS twice FROM documents")
def map_rows(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "n_chars")
    return R.map_rows(rows, lambda pdf: pdf[["doc_id"]].assign(twice=pdf["n_chars"] * 2), "doc_id bigint, twice bigint")


@query("if_else", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'eu-' || o_orderstatus ELSE o_orderpriority END AS answer FROM orders")
def if_else(spark, d):
    rows = R.with_variables(table(spark, d, "orders"), {"region": "eu"})
    then = F.concat_ws("-", "var_region", "o_orderstatus")
    return rows.select("o_orderkey", R.if_else(F.col("o_totalprice") > 100000, then, F.col("o_orderpriority")).alias("answer"))


@query("load_custom", """
SELECT 'part ' || p_partkey AS page_content, p_brand AS brand FROM part WHERE p_size > 5""")
def load_custom_docs(spark, d):
    def make(row):
        if row["p_size"] > 5:
            yield {"page_content": f"part {row['p_partkey']}", "metadata": json.dumps({"brand": row["p_brand"]})}

    out = load_custom(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), make)
    return out.select("page_content", F.get_json_object("metadata", "$.brand").alias("brand"))
