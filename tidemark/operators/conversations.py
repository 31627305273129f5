"""Messages, sessions, feedback and paged lists.

Messages: id, role, chatflow_id, chat_id, memory_type, session_id, chat_type, content, created.
Feedback: message_id, rating, feedback.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import PART_CHARS, join_in_parts, next_value, page as one_page


def chat_stats(messages: DataFrame, feedback: DataFrame | None = None, by: Sequence[str] = ("chatflow_id",)) -> DataFrame:
    """Messages, feedback, positive feedback and sessions; messages without a session count as one."""
    if feedback is None:
        joined = messages.withColumns({"_f": F.lit(None).cast("boolean"), "rating": F.lit(None).cast("string")})
    else:
        joined = messages.join(
            feedback.select(F.col("message_id").alias("id"), "rating", F.lit(True).alias("_f")), "id", "left"
        )
    # one row per session first, so the distinct count never expands the messages
    per_session = joined.groupBy(*by, "session_id").agg(
        F.count(F.lit(1)).alias("_m"),
        F.count("_f").alias("_fb"),
        F.count(F.when(F.col("rating") == "THUMBS_UP", 1)).alias("_up"),
    )
    return per_session.groupBy(*by).agg(
        F.sum("_m").alias("total_messages"),
        F.sum("_fb").alias("total_feedback"),
        F.sum("_up").alias("positive_feedback"),
        F.count(F.lit(1)).alias("total_sessions"),
    )


def _filtered(
    messages: DataFrame,
    chatflow_id: str | None = None,
    chat_types: Sequence[str] | None = None,
    chat_id: str | None = None,
    memory_type: str | None = None,
    session_id: str | None = None,
    message_id=None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    equal = {"chatflow_id": chatflow_id, "chat_id": chat_id, "memory_type": memory_type, "session_id": session_id,
             "id": message_id}
    for name, value in equal.items():
        if value is not None:
            messages = messages.where(F.col(name) == value)
    if chat_types:
        messages = messages.where(F.col("chat_type").isin(list(chat_types)))
    if start is not None:
        messages = messages.where(F.col("created") >= F.lit(start).cast("timestamp"))
    if end is not None:
        messages = messages.where(F.col("created") <= F.lit(end).cast("timestamp"))
    return messages


def _by_time(order: str) -> list[Column]:
    if order not in ("ASC", "DESC"):
        raise ValueError("order is ASC or DESC")
    return [F.col(c).asc() if order == "ASC" else F.col(c).desc() for c in ("created", "id")]


def messages_filtered(messages: DataFrame, order: str = "ASC", **filters) -> DataFrame:
    """Messages by flow, chat types, chat, memory type, session, id and inclusive time bounds."""
    return _filtered(messages, **filters).orderBy(*_by_time(order))


def feedback_filtered(
    feedback: DataFrame, start: str | None = None, end: str | None = None, order: str = "ASC"
) -> DataFrame:
    """Feedback by time; the bounds count only when both are given."""
    if start is not None and end is not None:
        feedback = feedback.where(F.col("created").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return feedback.orderBy(F.col("created").asc() if order == "ASC" else F.col("created").desc(), "message_id")


def session_page(
    messages: DataFrame,
    page: int,
    size: int,
    order: str = "ASC",
    feedback: DataFrame | None = None,
    ratings: Sequence[str] | None = None,
    **filters,
) -> DataFrame:
    """All messages of one page of sessions, the sessions ordered by their last message.

    With ratings, only sessions with such feedback are listed.
    """
    rows = _filtered(messages, **filters)
    rated = rows
    if ratings:
        wanted = feedback.where(F.col("rating").isin(list(ratings))).select(F.col("message_id").alias("id"))
        rated = rows.join(wanted, "id", "left_semi")
    last = rated.groupBy("session_id").agg(F.max("created").alias("_last"))
    by_last = F.col("_last").asc() if order == "ASC" else F.col("_last").desc()
    chosen = last.orderBy(by_last, "session_id").offset((page - 1) * size).limit(size).select("session_id")
    return rows.join(chosen, "session_id", "left_semi").orderBy(*_by_time(order))


def feedback_with_previous(messages: DataFrame, feedback: DataFrame, ratings: Sequence[str]) -> DataFrame:
    """Bot messages rated so, each with the message before it in the session, in time order.

    Messages with another rating leave first; a message without a session is dropped.
    """
    rated = messages.join(feedback.select(F.col("message_id").alias("id"), "rating"), "id", "left")
    rows = rated.where(
        (F.col("rating").isNull() | F.col("rating").isin(list(ratings)))
        & F.col("session_id").isNotNull() & (F.col("session_id") != "")
    ).withColumn("_hit", (F.col("role") == "apiMessage") & F.col("rating").isNotNull())
    looked = next_value(rows, ["session_id"], ["created", "id"], "_hit", "_next")
    return looked.where(F.col("_hit") | F.col("_next")).drop("_hit", "_next")


def executions_page(
    executions: DataFrame,
    flows: DataFrame,
    page: int = 1,
    limit: int = 12,
    id=None,
    flow_id=None,
    flow_name: str | None = None,
    session_id=None,
    state: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One page, newest update first, with the total before paging.  Flows: flow_id, flow_name."""
    for name, value in {"id": id, "flow_id": flow_id, "session_id": session_id, "state": state}.items():
        if value is not None:
            executions = executions.where(F.col(name) == value)
    if start is not None:
        executions = executions.where(F.col("created") >= F.lit(start).cast("timestamp"))
    if end is not None:
        executions = executions.where(F.col("created") <= F.lit(end).cast("timestamp"))
    rows = executions.join(flows.select("flow_id", "flow_name"), "flow_id", "left")
    if flow_name is not None:
        rows = rows.where(F.lower("flow_name").contains(flow_name.lower()))
    return list_page(rows, [F.col("updated").desc(), F.col("id")], page, limit)


def list_page(df: DataFrame, order_by: Sequence[Column], page: int = -1, limit: int = -1) -> DataFrame:
    """One page and the total; without a page, everything."""
    return one_page(df, order_by, page, limit).withColumn("total", df.agg(F.count(F.lit(1))).scalar())


def login_activity_page(
    events: DataFrame,
    page: int = 1,
    start: str | None = None,
    end: str | None = None,
    codes: Sequence[str] | None = None,
    now: str | None = None,
    size: int = 10,
) -> DataFrame:
    """Attempts (id, attempted, code) from day start to day end, newest first; a month back by default."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    low = F.date_trunc("day", F.lit(start).cast("timestamp")) if start else F.add_months(at, -1).cast("timestamp")
    rows = events.where(F.col("attempted") >= low)
    if end:
        rows = rows.where(F.col("attempted") < F.date_trunc("day", F.lit(end).cast("timestamp")) + F.expr("interval 1 day"))
    else:
        rows = rows.where(F.col("attempted") <= at)
    if codes:
        rows = rows.where(F.col("code").isin(list(codes)))
    return list_page(rows, [F.col("attempted").desc(), F.col("id")], page, size)


def dataset_row_counts(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    counts = children.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return parents.join(counts, key, "left").na.fill(0, ["row_count"])


def export_transcripts(messages: DataFrame, feedback: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per conversation with its messages in time order as a JSON list.

    A conversation with more than `part_chars` characters gives several rows, numbered by `part`.
    """
    both = F.col("memory_type").isNotNull() & F.col("session_id").isNotNull()
    key = F.when(both, F.concat_ws("_", "chat_id", "memory_type", "session_id")).otherwise(F.col("chat_id"))
    rows = messages.join(feedback.select(F.col("message_id").alias("id"), "feedback"), "id", "left").withColumns({
        "key": key,
        "_item": F.to_json(F.struct(
            "content", F.when(F.col("role") == "apiMessage", "bot").otherwise("user").alias("role"),
            F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"), "feedback")),
        "source": F.when(F.col("chat_type") == "INTERNAL", "UI").when(F.col("chat_type") == "EXTERNAL", "API/Embed")
        .when(F.col("chat_type") == "EVALUATION", "Evaluation").otherwise("Unknown"),
    })
    first = [F.min(c).alias(c) for c in ("chat_id", "source", "session_id", "memory_type")]
    out = join_in_parts(rows, ["key"], ["created", "id"], "_item", ",", "messages", part_chars, F.length("content"),
                        extra=[*first, F.count(F.lit(1)).alias("message_count")])
    return out.withColumn("messages", F.concat(F.lit("["), "messages", F.lit("]")))


def history_text(messages: DataFrame, by: Sequence[str], order_by: Sequence[str] = ("created", "id"),
                 part_chars: int = PART_CHARS) -> DataFrame:
    """`Human:` and `Assistant:` lines in order, blank messages dropped, other roles bare."""
    filled = messages.where(F.col("content").isNotNull() & (F.regexp_replace("content", r"(?U)\s+", "") != ""))
    line = (
        F.when(F.col("role").isin("apiMessage", "assistant"), F.concat(F.lit("Assistant: "), "content"))
        .when(F.col("role").isin("userMessage", "user"), F.concat(F.lit("Human: "), "content"))
        .otherwise(F.col("content"))
    )
    return join_in_parts(filled.withColumn("_line", line), by, order_by, "_line", "\n", "history", part_chars)


def validate_history(messages: DataFrame, by: Sequence[str]) -> DataFrame:
    """Whether every item has a known role and a text."""
    fine = F.col("role").isin("apiMessage", "userMessage") & F.col("content").isNotNull()
    return messages.groupBy(*by).agg(F.bool_and(F.coalesce(fine, F.lit(False))).alias("valid"))
