"""Registered queries: evaluation, cost and regression."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import jsons
from tidemark.operators import evaluation as Q
from tidemark.plans.inputs import MESSAGES, messages, table
from tidemark.plans.joins import PRICES, prices
from tidemark.plans.registry import query
from tidemark.sources.scratch import written_csv

RULES = [
    {"id": "t1", "name": "starts", "type": "text", "operator": "StartsWith", "value": " The"},
    {"id": "t2", "name": "not starts", "type": "text", "operator": "NotStartsWith", "value": "LA"},
    {"id": "t3", "name": "any", "type": "text", "operator": "ContainsAny", "value": "und, the ,ion"},
    {"id": "t4", "name": "all", "type": "text", "operator": "ContainsAll", "value": "er, an"},
    {"id": "t5", "name": "not any", "type": "text", "operator": "DoesNotContainAny", "value": "und, the"},
    {"id": "t6", "name": "not all", "type": "text", "operator": "DoesNotContainAll", "value": "und, the"},
    {"id": "n1", "name": "length", "type": "numeric", "measure": "responseLength", "operator": "greaterThan", "value": "100.9"},
    {"id": "n2", "name": "turn", "type": "numeric", "measure": "turn", "operator": "equals", "value": "3.9"},
    {"id": "n3", "name": "text turn", "type": "numeric", "measure": "turn_text", "operator": "equals", "value": "3"},
    {"id": "n4", "name": "text turn", "type": "numeric", "measure": "turn_text", "operator": "lessThanOrEquals", "value": "3"},
    {"id": "n5", "name": "missing", "type": "numeric", "measure": "none", "operator": "notEquals", "value": "1"},
    {"id": "n6", "name": "unknown", "type": "numeric", "measure": "turn", "operator": "near", "value": "1"},
    {"id": "n7", "name": "not a number", "type": "numeric", "measure": "turn", "operator": "lessThan", "value": "abc"},
    {"id": "j1", "name": "json", "type": "json", "operator": "IsValidJSON", "value": ""},
    {"id": "j2", "name": "no json", "type": "json", "operator": "IsNotValidJSON", "value": ""},
]


def outputs(spark, d):
    """Every message as an output; every seventh failed."""
    return messages(spark, d).select(
        F.col("id").alias("run_id"), "conv_id", "turn", F.col("content").alias("output"),
        F.when(F.col("id") % 7 == 0, "timeout").otherwise("").alias("error"),
        F.to_json(F.struct("turn", F.col("turn").cast("string").alias("turn_text"))).alias("metrics"))


OUT = f"""{MESSAGES}, o AS (
  SELECT id AS run_id, conv_id, turn, lower(regexp_replace(content, '^\\s+|\\s+$', '', 'g')) AS a, id % 7 = 0 AS bad FROM messages)"""


def _rows(table_name: str, rules: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT run_id, '{rid}' AS rule_id, CASE WHEN bad THEN 'Error' WHEN {cond} THEN 'Pass' ELSE 'Fail' END AS result FROM {table_name}"
        for rid, cond in rules
    ]
    return " UNION ALL ".join(parts)


TEXT_SQL = [
    ("t1", "starts_with(a, 'the')"), ("t2", "NOT starts_with(a, 'la')"),
    ("t3", "contains(a, 'und') OR contains(a, 'the') OR contains(a, 'ion')"),
    ("t4", "contains(a, 'er') AND contains(a, 'an')"),
    ("t5", "contains(a, 'und') OR contains(a, 'the')"),
    ("t6", "NOT (contains(a, 'und') OR contains(a, 'the'))"),
]
NUMERIC_SQL = [
    ("n1", "length(a) > 100"), ("n2", "turn = 3"), ("n3", "FALSE"), ("n4", "turn <= 3"), ("n5", "TRUE"), ("n6", "FALSE"),
    ("n7", "FALSE"),
]


@query("evaluate_text_rules", f"WITH {OUT} {_rows('o', TEXT_SQL)}")
def evaluate_text_rules(spark, d):
    return Q.evaluate_text_rules(outputs(spark, d), RULES).select("run_id", "rule_id", "result")


@query("evaluate_numeric_rules", f"WITH {OUT} {_rows('o', NUMERIC_SQL)}")
def evaluate_numeric_rules(spark, d):
    return Q.evaluate_numeric_rules(outputs(spark, d), RULES).select("run_id", "rule_id", "result")


JSON_OUT = """o AS (SELECT event_id AS run_id, event_id % 7 = 0 AS bad, event_id % 3 = 0 AS valid FROM events)"""


@query("evaluate_json_rules", f"WITH {JSON_OUT} {_rows('o', [('j1', 'valid'), ('j2', 'NOT valid')])}")
def evaluate_json_rules(spark, d):
    """A third of the props stay valid, the others lose their end or are quoted badly."""
    turn = F.col("event_id") % 3
    rows = table(spark, d, "events").select(
        F.col("event_id").alias("run_id"), F.when(F.col("event_id") % 7 == 0, "x").otherwise("").alias("error"),
        F.when(turn == 0, F.col("props")).when(turn == 1, F.expr("substring(props, 1, length(props) - 1)"))
        .otherwise(F.replace("props", F.lit('"'), F.lit("'"))).alias("output"))
    return Q.evaluate_json_rules(rows, RULES).select("run_id", "rule_id", "result")


@query("evaluation_rollup", f"""WITH {OUT}, r AS (
  SELECT conv_id % 10 AS e, x.result FROM o JOIN ({_rows('o', TEXT_SQL)}) x ON x.run_id = o.run_id),
t AS (SELECT conv_id % 10 AS e, count(DISTINCT conv_id) AS n, sum(turn * 1.25) AS time, bool_or(bad) AS bad FROM o GROUP BY 1),
c AS (SELECT e, count(*) FILTER (WHERE result = 'Pass') AS p, count(*) FILTER (WHERE result = 'Fail') AS f, count(*) FILTER (WHERE result = 'Error') AS x FROM r GROUP BY 1)
SELECT e AS evaluation_id, n AS total_runs, p AS pass_count, f AS fail_count, x AS error_count,
  CAST(round(CAST(p * 100.0::DOUBLE / (p + f + x) AS DECIMAL(24, 8)), 2) AS DECIMAL(24, 2))::VARCHAR AS pass_pcnt,
  CAST(round(CAST(time::DOUBLE / n AS DECIMAL(24, 8)), 3) AS DECIMAL(24, 3))::VARCHAR AS average_latency,
  CASE WHEN bad THEN 'error' ELSE 'completed' END AS status
FROM t JOIN c USING (e)""")
def evaluation_rollup(spark, d):
    """Ten evaluations; a conversation is a dataset row, latency grows with the turn."""
    rows = outputs(spark, d).withColumn("evaluation_id", F.col("conv_id") % 10)
    results = Q.evaluate_text_rules(rows, RULES)
    runs = rows.select("evaluation_id", F.col("conv_id").alias("row_id"), (F.col("turn") * 1.25).alias("latency"), "error")
    return Q.evaluation_rollup(results, runs)


def usage(spark, d):
    """Tokens drawn from the event values; the model is the event type."""
    tokens = (F.col("value") * 10).cast("bigint")
    return table(spark, d, "events").select(
        "event_id", "user_id", "ts", F.lit("acme").alias("provider"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("model"),
        tokens.alias("prompt_tokens"), F.floor(tokens / 2).alias("completion_tokens"),
        (tokens + F.floor(tokens / 2)).alias("total_tokens"))


USAGE = f"""{PRICES}, u AS (
  SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN event_type END AS model, CAST(trunc(value * 10) AS BIGINT) AS pt,
    CAST(floor(trunc(value * 10) / 2) AS BIGINT) AS ct FROM events),
c AS (SELECT u.*, CAST(input_cost * pt / 1000 AS DECIMAL(18, 6)) AS ic, CAST(output_cost * ct / 1000 AS DECIMAL(18, 6)) AS oc,
    CAST(total_cost * (pt + ct) / 1000 AS DECIMAL(18, 6)) AS tc, total_price > 0 AS flat
  FROM u LEFT JOIN listed ON listed.model = u.model)"""


def _cost_sql(x: str) -> str:
    return f"""CASE WHEN {x} = 0 THEN '$ 0' WHEN {x} < 0.01 THEN '$ <0.01' ELSE '$ ' || CAST(round({x}, 2) AS DECIMAL(18, 2))::VARCHAR END"""


@query("token_cost", f"""WITH {USAGE}
SELECT event_id, CASE WHEN model IS NOT NULL THEN CASE WHEN flat THEN {_cost_sql('tc')} ELSE {_cost_sql('(ic + oc)')} END END AS total_cost_text,
  CASE WHEN model IS NOT NULL THEN CASE WHEN flat OR pt = 0 THEN '0' ELSE {_cost_sql('ic')} END END AS prompt_cost_text,
  CASE WHEN model IS NOT NULL THEN CASE WHEN flat OR ct = 0 THEN '0' ELSE {_cost_sql('oc')} END END AS completion_cost_text
FROM c""")
def token_cost(spark, d):
    return Q.token_cost(usage(spark, d), prices(spark, d)).select(
        "event_id", "total_cost_text", "prompt_cost_text", "completion_cost_text")


def nested(spark, d):
    """The metrics of a user and hour as an array, in time order."""
    rows = usage(spark, d).withColumns({
        "input_cost": (F.col("prompt_tokens") / 1000).cast("decimal(18,6)"),
        "output_cost": (F.col("completion_tokens") / 500).cast("decimal(18,6)"),
        "total_cost": (F.col("prompt_tokens") / 250).cast("decimal(18,6)"),
        "provider": F.when(F.col("event_id") % 4 != 0, "acme"),
        "hour": F.date_format("ts", "yyyyMMddHH"),
    })
    fields = ("event_id", "model", "provider", "prompt_tokens", "completion_tokens", "total_tokens",
              "input_cost", "output_cost", "total_cost")
    return rows.groupBy("user_id", "hour").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("metrics"))


@query("nested_metric_sum", f"""WITH {USAGE}
SELECT user_id, strftime(ts, '%Y%m%d%H') AS hour,
  CAST(coalesce(sum(pt) FILTER (WHERE model IS NOT NULL AND pt > 0), 0) AS BIGINT) AS prompt_tokens,
  CAST(coalesce(sum(pt + ct) FILTER (WHERE model IS NOT NULL AND pt > 0), 0) AS BIGINT) AS total_tokens,
  CAST(coalesce(sum(CAST(ct / 500 AS DECIMAL(18, 6))) FILTER (WHERE model IS NOT NULL AND pt > 0), 0) AS DECIMAL(18, 6)) AS output_cost,
  CAST(count(*) FILTER (WHERE model IS NOT NULL AND event_id % 4 <> 0) AS INTEGER) AS nested
FROM c GROUP BY 1, 2""")
def nested_metric_sum(spark, d):
    out = Q.nested_metric_sum(nested(spark, d), F.col("metrics"))
    return out.select("user_id", "hour", "prompt_tokens", "total_tokens", "output_cost", F.size("nested").alias("nested"))


@query("merge_metrics", """
SELECT event_id, json_extract_string(props, '$.k') AS k, event_type AS kind, 'late' AS stage FROM events""")
def merge_metrics(spark, d):
    parts = F.array(
        F.create_map(F.lit("k"), F.lit("0"), F.lit("stage"), F.lit("early")),
        jsons.flatten_json(F.col("props")),
        F.create_map(F.lit("kind"), F.col("event_type"), F.lit("stage"), F.lit("late")))
    out = Q.merge_metrics(table(spark, d, "events").withColumn("parts", parts), F.col("parts"))
    return out.select("event_id", *[F.col("merged")[n].alias(n) for n in ("k", "kind", "stage")])


@query("usage_from_trace", f"""WITH {PRICES}, s AS (
  SELECT event_id, 'a' AS step, event_type AS model, CAST(trunc(value) AS BIGINT) AS i, CAST(trunc(value * 2) AS BIGINT) AS o, 0 AS t, '12.50' AS latency FROM events
  UNION ALL SELECT event_id, 'b', 'none', 5, 0, 9, '' FROM events)
SELECT event_id, step, i AS input_tokens, o AS output_tokens, CAST(CASE WHEN t <> 0 THEN t ELSE i + o END AS BIGINT) AS total_tokens, latency,
  CAST(CAST(input_cost * i / 1000 AS DECIMAL(18, 6)) + CAST(output_cost * o / 1000 AS DECIMAL(18, 6)) AS DECIMAL(18, 6)) AS total_cost
FROM s LEFT JOIN listed USING (model)""")
def usage_from_trace(spark, d):
    """Two steps per event; the second has no price and is unfinished."""
    big = "bigint"
    steps = F.array(
        F.struct(F.lit("a").alias("step"), F.lit("ACME").alias("provider"), F.col("event_type").alias("model"),
                 F.col("value").cast(big).alias("input_tokens"), (F.col("value") * 2).cast(big).alias("output_tokens"),
                 F.lit(0).cast(big).alias("total_tokens"), F.lit(100.0).alias("start_ms"), F.lit(112.5).alias("end_ms")),
        F.struct(F.lit("b").alias("step"), F.lit("ACME").alias("provider"), F.lit("none").alias("model"),
                 F.lit(5).cast(big).alias("input_tokens"), F.lit(None).cast(big).alias("output_tokens"),
                 F.lit(9).cast(big).alias("total_tokens"), F.lit(100.0).alias("start_ms"), F.lit(None).cast("double").alias("end_ms")))
    rows = table(spark, d, "events").select("event_id", steps.alias("steps"))
    out = Q.usage_from_trace(rows, F.col("steps"), prices(spark, d))
    return out.select("event_id", "step", "input_tokens", "output_tokens", "total_tokens", "latency", "total_cost")


@query("last_model_of_run", """
SELECT user_id AS run_id, arg_max(event_type, event_id) FILTER (WHERE event_type <> 'error') AS model,
  arg_max('p' || (event_id % 3), event_id) FILTER (WHERE event_id % 3 <> 0) AS provider
FROM events GROUP BY 1""")
def last_model_of_run(spark, d):
    rows = table(spark, d, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("pos"),
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("").alias("model"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("p"), F.col("event_id") % 3)).alias("provider"))
    return Q.last_model_of_run(rows)


@query("outdated_evaluations", """
WITH b AS (SELECT o_custkey AS cid, max(o_orderdate) AS upd FROM orders GROUP BY 1),
f AS (SELECT l_orderkey AS id, l_suppkey AS fid, l_linenumber AS ln, o_orderdate AS run, o_custkey AS cid FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey) = 1),
s AS (SELECT l_suppkey AS fid, max(l_shipdate) AS upd FROM lineitem GROUP BY 1),
x AS (SELECT id, f.fid, ln, CASE WHEN f.fid % 5 = 0 THEN TRUE ELSE s.upd > run END AS old, f.fid % 5 = 0 AS gone FROM f JOIN s USING (fid))
SELECT x.id, bool_or(old) OR bool_or(b.upd > o_orderdate) AS outdated, CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS errors,
  coalesce(string_agg((CASE WHEN x.fid % 2 = 0 THEN 'Chatflow s' ELSE 'Custom Assistant s' END) || x.fid || ' not found', ';'
    ORDER BY x.fid % 2, ln) FILTER (WHERE gone), '') AS text
FROM x JOIN orders ON o_orderkey = x.id JOIN b ON b.cid = o_custkey GROUP BY x.id""")
def outdated_evaluations(spark, d):
    """Orders as evaluations of a customer's data with suppliers as flows; every fifth supplier is gone."""
    from pyspark.sql import Window

    first = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_suppkey", "l_partkey")
    lines = table(spark, d, "lineitem").withColumn("rn", F.row_number().over(first)).where("rn = 1")
    used = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("l"))
    orders = table(spark, d, "orders")
    fid = F.col("l")["l_suppkey"]
    evals = orders.join(used, orders.o_orderkey == used.l_orderkey).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("run_date"), F.col("o_custkey").alias("dataset_id"),
        F.concat(F.lit("c"), "o_custkey").alias("dataset_name"), fid.alias("flow_ids"),
        F.transform(fid, lambda x: F.concat(F.lit("s"), x)).alias("flow_names"),
        F.transform(fid, lambda x: F.when(x % 2 == 1, "Custom Assistant").otherwise("Chatflow")).alias("flow_types"))
    data = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderdate").alias("updated"))
    flows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.max("l_shipdate").alias("updated")).where("id % 5 <> 0")
    out = Q.outdated_evaluations(evals, data, flows.where("id % 2 = 0"), flows.where("id % 2 = 1"))
    return out.select("id", "outdated", F.size("errors").alias("errors"), F.array_join("errors", ";").alias("text"))


@query("csv_to_dataset", """
SELECT 'ds' AS dataset_id, p_name AS input, p_brand AS output, 9 + row_number() OVER (ORDER BY p_partkey) AS sequence_no FROM part""")
def csv_to_dataset(spark, d):
    """Parts written as CSV in key order, read back as rows 10 and on."""
    parts = table(spark, d, "part").orderBy("p_partkey").select("p_name", "p_brand", "p_size")
    path = written_csv(parts, header=False)
    return Q.csv_to_dataset(spark, [path], "ds", start_seq=10)


def run_of(spark, d, factor):
    score = (F.col("doc_id") * factor % 100) / 100
    return table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "text"), "doc_id").select(
        F.col("doc_id").alias("golden_id"), F.col("text").alias("input"), score.alias("score"),
        (score >= 0.7).alias("passed"), F.concat(F.lit("quality "), "quality").alias("reason"))


RUNS = """a AS (SELECT doc_id AS golden_id, text AS input, (doc_id * 37 % 100) / 100 AS score, 'quality ' || quality AS reason FROM labels JOIN documents USING (doc_id)),
b AS (SELECT doc_id AS golden_id, (doc_id * 53 % 100) / 100 AS score FROM labels)"""


@query("regression_compare", f"""WITH {RUNS}, j AS (
  SELECT a.golden_id, substr(input, 1, 120) AS input_preview, b.score AS baseline_score, a.score AS current_score,
    round(a.score - b.score, 4) AS score_delta, b.score >= 0.7 AS baseline_passed, a.score >= 0.7 AS current_passed, reason
  FROM a JOIN b USING (golden_id))
SELECT * FROM j WHERE score_delta < -0.08 OR (baseline_passed AND NOT current_passed)""")
def regression_compare(spark, d):
    return Q.regression_compare(run_of(spark, d, 37), run_of(spark, d, 53))


@query("regression_summary", f"""WITH {RUNS}
SELECT count(*) AS total_cases, count(*) FILTER (WHERE score >= 0.7) AS passed_cases, count(*) FILTER (WHERE score < 0.7) AS failed_cases,
  round(count(*) FILTER (WHERE score >= 0.7) / count(*), 4) AS pass_rate, round(avg(score), 4) AS mean_score FROM a""")
def regression_summary(spark, d):
    return Q.regression_summary(Q.check_golden(run_of(spark, d, 37)))


@query("model_graded", f"""WITH {MESSAGES}, m AS (
  SELECT id AS run_id, id % 7 = 0 AS bad, list_distinct(regexp_extract_all(lower(content), '\\S+')) AS q,
    list_distinct(regexp_extract_all(lower(coalesce(lead(content) OVER (PARTITION BY conv_id ORDER BY turn), '')), '\\S+')) AS a FROM messages),
g AS (SELECT run_id, bad, len(list_intersect(q, a)) / greatest(len(q), 1)::DOUBLE AS grade FROM m)
SELECT run_id, CASE WHEN NOT bad THEN round(grade, 9) END AS grade, CASE WHEN NOT bad THEN CASE WHEN grade > 0.2 THEN 'good' ELSE 'poor' END END AS verdict,
  CASE WHEN bad THEN 'Not Graded!' END AS grade_error FROM g""")
def model_graded(spark, d):
    """Each answer graded against the message before it by word overlap."""
    from tidemark.operators.ordering import next_value

    rows = next_value(outputs(spark, d), ["conv_id"], ["turn"], "output", "actual").withColumnRenamed("output", "question")

    def grade(batch: pd.DataFrame) -> pd.DataFrame:
        def one(q, a):
            left, right = set((q or "").lower().split()), set((a or "").lower().split())
            return len(left & right) / max(len(left), 1)

        scores = [one(q, a) for q, a in zip(batch["question"], batch["actual"])]
        return pd.DataFrame({"grade": scores, "verdict": ["good" if s > 0.2 else "poor" for s in scores]})

    schema = StructType().add("grade", "double").add("verdict", "string")
    out = Q.model_graded(rows.select("run_id", "question", "actual", "error"), grade, schema)
    return out.select("run_id", F.round("grade", 9).alias("grade"), "verdict", "grade_error")
