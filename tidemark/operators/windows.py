"""Versions, memory windows, sequences and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import number_rows, page as one_page, running_sum

_GROUP_LIMIT = 1000  # largest row_number() limit Spark applies per partition by default


def version_numbers(evals: DataFrame, page: int = -1, limit: int = -1) -> DataFrame:
    """Version of each evaluation (id, name, run_date) within its name, and whether it is the latest.

    Names come with their latest run and the number of names; a page is a page of names.
    """
    names = evals.groupBy("name").agg(F.count(F.lit(1)).alias("_n"), F.max("run_date").alias("latest_run"))
    total = evals.agg(F.count_distinct("name")).scalar()
    chosen = one_page(names, [F.col("latest_run").desc(), F.col("name")], page, limit)
    numbered = number_rows(evals.join(chosen.select("name"), "name", "left_semi"), ["name"], ["run_date", "id"], "version")
    return (
        numbered.join(chosen, "name")
        .withColumn("latest", F.col("version") == F.col("_n"))
        .withColumn("total", total)
        .drop("_n")
    )


def version_list(evals: DataFrame, name: str) -> DataFrame:
    """Versions of one name in ascending order of run date."""
    return number_rows(evals.where(F.col("name") == name), [], ["run_date", "id"], "version")


def nth_latest(df: DataFrame, keys: DataFrame, n: int = 1) -> DataFrame:
    """n-th newest value (key, ts, id, value) of every key, null where there are fewer."""
    if n < 1:
        raise ValueError("n starts at 1")
    if n > _GROUP_LIMIT:
        ranked = number_rows(df, ["key"], ["ts", "id"], "_rn", descending=True).where(F.col("_rn") == n)
        return keys.join(ranked.select("key", "value"), "key", "left")
    newest = Window.partitionBy("key").orderBy(F.col("ts").desc(), F.col("id").desc())
    # the row limit of n per key is applied before the shuffle
    ranked = df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).where(F.col("_rn") == n)
    return keys.join(ranked.select("key", "value"), "key", "left")


def memory_window(messages: DataFrame, k: int | None, prepend: DataFrame | None = None) -> DataFrame:
    """Last 2k messages of every session (all when k is None, none when k <= 0), `pos` in time order.

    Prepended messages come before, whatever k is; they carry their own `pos` below 1.
    """
    if k is None:
        kept = number_rows(messages, ["session_id"], ["created", "id"], "pos")
    elif k <= 0:
        kept = messages.where(F.lit(False)).withColumn("pos", F.lit(0).cast("bigint"))
    else:
        # up to _GROUP_LIMIT rows the limit is applied before the shuffle; more are numbered in slices
        if 2 * k > _GROUP_LIMIT:
            newest_first = number_rows(messages, ["session_id"], ["created", "id"], "_rn", descending=True)
            last = newest_first.where(F.col("_rn") <= 2 * k).drop("_rn")
            kept = number_rows(last, ["session_id"], ["created", "id"], "pos")
            return kept if prepend is None else prepend.unionByName(kept, allowMissingColumns=True)
        newest = Window.partitionBy("session_id").orderBy(F.col("created").desc(), F.col("id").desc())
        last = messages.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= 2 * k)
        oldest = Window.partitionBy("session_id").orderBy("created", "id")
        kept = last.withColumn("pos", F.row_number().over(oldest).cast("bigint")).drop("_rn")
    return kept if prepend is None else prepend.unionByName(kept, allowMissingColumns=True)


def memory_token_budget(messages: DataFrame, max_tokens: int = 2000, tokens: Column | None = None) -> DataFrame:
    """Keep the newest messages within the budget; `kept` is false for the part to summarize."""
    count = tokens if tokens is not None else F.regexp_count("content", F.lit(r"\S+"))
    summed = running_sum(
        messages, ["session_id"], ["created", "id"], count.cast("bigint"), "tokens_from_here", descending=True
    )
    return summed.withColumn("kept", F.col("tokens_from_here") <= max_tokens)


def sequence_fill(rows: DataFrame, key: str, order_by: str) -> DataFrame:
    """Give rows with sequence_no -1 the numbers after the largest one of their dataset, in order."""
    top = rows.groupBy(key).agg(F.max("sequence_no").alias("_top"))
    missing = number_rows(rows.where("sequence_no = -1"), [key], [order_by], "_rn").join(top, key)
    filled = missing.withColumn("sequence_no", (F.col("_top") + F.col("_rn")).cast(rows.schema["sequence_no"].dataType))
    return rows.where("sequence_no <> -1").unionByName(filled.drop("_top", "_rn"))


def sequence_append(rows: DataFrame, new_rows: DataFrame, key: str, order_by: str) -> DataFrame:
    """Add rows after the largest number of their dataset (from 0 for a new dataset)."""
    top = rows.groupBy(key).agg(F.max("sequence_no").alias("_top"))
    added = number_rows(new_rows, [key], [order_by], "_rn").join(top, key, "left").withColumn(
        "sequence_no", (F.coalesce("_top", F.lit(-1)) + F.col("_rn")).cast(rows.schema["sequence_no"].dataType)
    )
    return rows.unionByName(added.drop("_top", "_rn"))


def sequence_reorder(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply (id, sequence_no) changes."""
    new = changes.select("id", F.col("sequence_no").alias("_new"))
    return rows.join(new, "id", "left").withColumn("sequence_no", F.coalesce("_new", "sequence_no")).drop("_new")


def set_ops(a: DataFrame, b: DataFrame | None, op: str) -> DataFrame:
    """union (all), intersect, except, distinct; intersect and except work on distinct rows."""
    if op == "union":
        return a.unionByName(b, allowMissingColumns=True)
    if op == "intersect":
        return a.intersect(b.select(*a.columns))
    if op == "except":
        return a.subtract(b.select(*a.columns))
    if op == "distinct":
        return a.distinct()
    raise ValueError("op is union, intersect, except or distinct")
