"""Registered queries: conversations and paged lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import jsons
from tidemark.operators import conversations as V
from tidemark.plans.inputs import EVENTS_JS, FEEDBACK, MESSAGES, events, feedback, messages, table
from tidemark.plans.registry import query


@query("chat_stats", f"""WITH {MESSAGES}, {FEEDBACK}
SELECT chatflow_id, count(*) AS total_messages, count(f.message_id) AS total_feedback,
  count(*) FILTER (WHERE rating = 'THUMBS_UP') AS positive_feedback, count(DISTINCT coalesce(session_id, '')) AS total_sessions
FROM messages m LEFT JOIN feedback f ON f.message_id = m.id GROUP BY 1""")
def chat_stats(spark, d):
    return V.chat_stats(messages(spark, d), feedback(spark, d))


@query("messages_filtered", f"""WITH {MESSAGES}
SELECT id, session_id, role FROM messages
WHERE chatflow_id = 'flow1' AND chat_type IN ('INTERNAL', 'EXTERNAL') AND created_s >= epoch(TIMESTAMP '2024-01-01 12:00:00')
  AND created_s <= epoch(TIMESTAMP '2024-02-15')""")
def messages_filtered(spark, d):
    return V.messages_filtered(
        messages(spark, d), chatflow_id="flow1", chat_types=["INTERNAL", "EXTERNAL"],
        start="2024-01-01 12:00:00", end="2024-02-15").select("id", "session_id", "role")


@query("session_page", f"""WITH {MESSAGES}, {FEEDBACK}, rated AS (
  SELECT session_id, max(created_s) AS last FROM messages JOIN feedback ON message_id = id
  WHERE rating = 'THUMBS_UP' AND chatflow_id = 'flow2' GROUP BY 1),
chosen AS (SELECT session_id FROM rated ORDER BY last DESC, session_id NULLS FIRST LIMIT 5 OFFSET 5)
SELECT id, session_id FROM messages WHERE chatflow_id = 'flow2' AND session_id IN (SELECT session_id FROM chosen)""")
def session_page(spark, d):
    return V.session_page(
        messages(spark, d), 2, 5, "DESC", feedback(spark, d), ["THUMBS_UP"], chatflow_id="flow2").select("id", "session_id")


@query("feedback_with_previous", f"""WITH {MESSAGES}, {FEEDBACK}, f AS (
  SELECT m.*, rating FROM messages m LEFT JOIN feedback f ON f.message_id = m.id
  WHERE (rating IS NULL OR rating IN ('THUMBS_DOWN')) AND session_id IS NOT NULL),
n AS (SELECT *, role = 'apiMessage' AND rating IS NOT NULL AS hit,
        lead(role = 'apiMessage' AND rating IS NOT NULL) OVER (PARTITION BY session_id ORDER BY created_s, id) AS nxt FROM f)
SELECT id, session_id, rating FROM n WHERE hit OR nxt""")
def feedback_with_previous(spark, d):
    return V.feedback_with_previous(messages(spark, d), feedback(spark, d), ["THUMBS_DOWN"]).select("id", "session_id", "rating")


@query("executions_page", """
WITH x AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1994-01-01' AND lower(c_mktsegment) LIKE '%build%')
SELECT o_orderkey AS id, c_mktsegment AS flow_name, (SELECT count(*) FROM x) AS total
FROM x ORDER BY o_orderdate DESC, o_orderkey LIMIT 12 OFFSET 12""")
def executions_page(spark, d):
    executions = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("flow_id"), F.col("o_orderstatus").alias("state"),
        F.col("o_orderdate").alias("created"), F.col("o_orderdate").alias("updated"))
    flows = table(spark, d, "customer").select(F.col("c_custkey").alias("flow_id"), F.col("c_mktsegment").alias("flow_name"))
    return V.executions_page(executions, flows, page=2, state="O", start="1994-01-01", flow_name="Build").select(
        "id", "flow_name", "total")


@query("public_execution_scrub", f"""WITH {EVENTS_JS}
SELECT event_id, event_type AS type, CAST(user_id AS VARCHAR) AS id, NULL::VARCHAR AS secret, NULL::VARCHAR AS inner_secret FROM ev""")
def public_execution_scrub(spark, d):
    js = F.replace(F.replace(F.col("js"), F.lit('{"type"'), F.lit('{"CREDENTIAL":"x","type"')),
                   F.lit('{"id"'), F.lit('{"CREDENTIAL":{"a":1},"id"'))
    out = events(spark, d).select("event_id", jsons.public_execution_scrub(js, "CREDENTIAL").alias("js"))
    return out.select("event_id", *[F.get_json_object("js", f"$.{p}").alias(n) for p, n in (
        ("type", "type"), ("user.id", "id"), ("CREDENTIAL", "secret"), ("user.CREDENTIAL", "inner_secret"))])


@query("login_activity_page", """
WITH x AS (SELECT event_id, event_type FROM events WHERE event_type IN ('signup', 'error')
  AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-21'),
y AS (SELECT x.*, ts FROM x JOIN events USING (event_id))
SELECT event_id AS id, x.event_type AS code, (SELECT count(*) FROM x) AS total
FROM y x ORDER BY ts DESC, event_id LIMIT 10 OFFSET 20""")
def login_activity_page(spark, d):
    attempts = table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("attempted"), F.col("event_type").alias("code"))
    return V.login_activity_page(
        attempts, 3, "2024-01-03 15:00:00", "2024-01-20 09:00:00", ["signup", "error"]).select("id", "code", "total")


@query("list_page", """
SELECT o_orderkey, (SELECT count(*) FROM orders) AS total FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 50""")
def list_page(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return V.list_page(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey")], 3, 25).drop("o_orderdate")


@query("dataset_row_counts", """
SELECT o_orderkey, count(l_orderkey) AS row_count FROM orders LEFT JOIN
  (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey GROUP BY 1""")
def dataset_row_counts(spark, d):
    returned = table(spark, d, "lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return V.dataset_row_counts(table(spark, d, "orders").select("o_orderkey"), returned, "o_orderkey")


@query("export_transcripts", f"""WITH {MESSAGES}, {FEEDBACK}, k AS (
  SELECT CASE WHEN memory_type IS NOT NULL AND session_id IS NOT NULL THEN chat_id || '_' || memory_type || '_' || session_id ELSE chat_id END AS key,
    m.*, f.feedback FROM messages m LEFT JOIN feedback f ON f.message_id = m.id)
SELECT key, part, count(*) OVER (PARTITION BY key) AS n_parts, min(CASE chat_type WHEN 'INTERNAL' THEN 'UI' WHEN 'EXTERNAL' THEN 'API/Embed' WHEN 'EVALUATION' THEN 'Evaluation' ELSE 'Unknown' END) AS source,
  count(*) AS message_count, string_agg(CASE role WHEN 'apiMessage' THEN 'bot' ELSE 'user' END, ',' ORDER BY created_s, id) AS roles,
  arg_min(content, id) AS first_content, coalesce(string_agg(feedback, ',' ORDER BY created_s, id), '') AS notes
FROM (SELECT *, CAST(sum(length(content)) OVER (PARTITION BY key ORDER BY created_s, id) - length(content) AS BIGINT) // 600 AS part FROM k) GROUP BY key, part""")
def export_transcripts(spark, d):
    """A small bound, so that conversations come in parts."""
    out = V.export_transcripts(messages(spark, d), feedback(spark, d), part_chars=600)
    items = F.from_json("messages", "array<struct<content:string,role:string,time:string,feedback:string>>")
    return out.select(
        "key", "part", "n_parts", "source", "message_count", F.array_join(items["role"], ",").alias("roles"),
        items[0]["content"].alias("first_content"), F.array_join(items["feedback"], ",").alias("notes"))


@query("history_text", f"""WITH {MESSAGES}
, l AS (SELECT conv_id, turn, CASE role WHEN 'apiMessage' THEN 'Assistant: ' || content WHEN 'userMessage' THEN 'Human: ' || content ELSE content END AS line
  FROM messages WHERE trim(content) <> '')
SELECT conv_id, part, count(*) OVER (PARTITION BY conv_id) AS n_parts, string_agg(line, chr(10) ORDER BY turn) AS history
FROM (SELECT *, CAST(sum(length(line) + 1) OVER (PARTITION BY conv_id ORDER BY turn) - length(line) - 1 AS BIGINT) // 600 AS part FROM l) GROUP BY conv_id, part""")
def history_text(spark, d):
    return V.history_text(messages(spark, d), ["conv_id"], ["turn"], part_chars=600)


@query("validate_history", f"""WITH {MESSAGES}
SELECT conv_id, bool_and(role IN ('apiMessage', 'userMessage')) AS valid FROM messages GROUP BY 1""")
def validate_history(spark, d):
    return V.validate_history(messages(spark, d), ["conv_id"])
