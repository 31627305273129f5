"""Condition tables to branches, state folding, per-item steps and prompts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import templates
from tidemark.operators.indexing import cache_key
from tidemark.operators.ordering import PART_CHARS, in_parts, join_in_parts, with_part_count
from tidemark.session import settle
from tidemark.sources.scratch import written_table

# fixed values: Markdown marks and what stays of them
_MARKDOWN = (
    (r"(?m)^\s{0,3}#{1,6}\s+", ""),
    (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"(?m)^\s{0,3}>\s?", ""),
    (r"(?m)^\s*[*+-]\s+", ""),
    (r"`{3}[^\n]*\n?", ""),
    (r"`([^`]*)`", "$1"),
    (r"(\*\*|__)(.*?)\1", "$2"),
    (r"(?<![\w*])([*_])(\S.*?\S|\S)\1(?!\w)", "$2"),
    (r"~~(.*?)~~", "$1"),
)


def plain_text(text: Column) -> Column:
    """Text without Markdown marks; a text without any mark is passed on as it is."""
    plain = text
    for pattern, rest in _MARKDOWN:
        plain = F.regexp_replace(plain, pattern, rest)
    return F.when(text.rlike(r"(?m)[#!\[>*`_~]|^\s*[+-]\s"), plain).otherwise(text)


def _value(spec) -> Column:
    """A column stays; any other value is a literal."""
    return spec if isinstance(spec, Column) else F.lit(spec)


def _filled(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _leading_number(value: Column) -> Column:
    found = F.regexp_extract(F.coalesce(value.cast("string"), F.lit("")), r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return F.coalesce(found.try_cast("double"), F.lit(0.0))


def _compare(kind: str, op: str, spec1, spec2, plain: dict[int, Column]) -> Column:
    one, two = _value(spec1), _value(spec2)
    if kind == "boolean":
        tests = {"equal": lambda: one.eqNullSafe(two), "notEqual": lambda: ~one.eqNullSafe(two)}
    elif kind == "number":
        left, right = _leading_number(one), _leading_number(two)
        tests = {
            "smaller": lambda: left < right, "smallerEqual": lambda: left <= right, "equal": lambda: left == right,
            "notEqual": lambda: left != right, "larger": lambda: left > right, "largerEqual": lambda: left >= right,
            "isEmpty": lambda: F.lit(False), "notEmpty": lambda: F.lit(True),
        }
    else:
        left, right = (
            plain[id(spec)] if id(spec) in plain else plain_text(_filled(value)) for spec, value in ((spec1, one), (spec2, two)))

        def matches() -> Column:
            if isinstance(spec2, Column):
                return left.rlike(right)
            try:
                re.compile(str(spec2))
            except re.error:
                return F.lit(False)  # an unreadable pattern never matches
            return left.rlike(str(spec2))

        tests = {
            "contains": lambda: left.contains(right), "notContains": lambda: ~left.contains(right),
            "endsWith": lambda: left.endswith(right), "startsWith": lambda: left.startswith(right),
            "equal": lambda: left == right, "notEqual": lambda: left != right, "regex": matches,
            "isEmpty": lambda: left == "", "notEmpty": lambda: left != "",
        }
    if op not in tests:
        raise ValueError(f"unknown {kind} operation {op}")
    return F.coalesce(tests[op](), F.lit(False))


def route_first_match(df: DataFrame, conditions: Sequence[dict]) -> DataFrame:
    """Add `branch`: the index of the first true condition, the number of conditions when none is.

    A condition has type (string, number, boolean), value1, operation, value2; values are columns or literals.
    """
    # each compared text loses its Markdown once, however many conditions ask for it
    texts = {
        id(spec): spec for c in conditions if c.get("type", "string") == "string"
        for spec in (c["value1"], c.get("value2")) if isinstance(spec, Column)
    }
    names = {key: f"_plain{i}" for i, key in enumerate(texts)}
    staged = df.withColumns({names[key]: plain_text(_filled(spec)) for key, spec in texts.items()}) if texts else df
    plain = {key: F.col(name) for key, name in names.items()}
    chosen = F.coalesce(*[
        F.when(_compare(c.get("type", "string"), c["operation"], c["value1"], c.get("value2", ""), plain), F.lit(i))
        for i, c in enumerate(conditions)
    ], F.lit(len(conditions)))
    return staged.withColumn("branch", chosen).drop(*names.values())


_NUMERIC = r"^-?\d*\.?\d+$"


def _grid_test(value: Column, op: str, wanted) -> Column:
    text = value.cast("string")
    other = str(wanted)
    number = F.when(text.rlike(_NUMERIC), text.try_cast("double"))
    limit = F.lit(float(other) if re.match(_NUMERIC, other) else None).cast("double")
    truthy = F.coalesce(text != "", F.lit(False))
    tests = {
        "Contains": text.contains(other), "Not Contains": ~text.contains(other),
        "Start With": text.startswith(other), "End With": text.endswith(other),
        "Is": text == other, "Is Not": text != other,
        "Is Empty": ~truthy | (F.trim(text) == ""), "Is Not Empty": F.trim(text) != "",
        "Greater Than": number > limit, "Less Than": number < limit, "Equal To": number == limit,
        "Not Equal To": number != limit, "Greater Than or Equal To": number >= limit,
        "Less Than or Equal To": number <= limit,
    }
    if op not in tests:
        return F.lit(False)
    result = F.coalesce(tests[op], F.lit(False))
    return result if op == "Is Empty" else truthy & result


def route_condition_grid(df: DataFrame, items: Sequence[dict]) -> DataFrame:
    """Add `branch`: the output of the first item (variable, operation, value, output) that holds, else `End`.

    An empty input, or a number column holding zero, is only ever `Is Empty`.
    """
    types = dict(df.dtypes)
    branches = []
    for item in items:
        value = F.col(item["variable"])
        kind = types[item["variable"]]
        if kind != "string":  # numbers print without a trailing zero; zero counts as no input
            whole = value == F.floor(value)
            shown = F.when(whole, F.floor(value).cast("bigint").cast("string")).otherwise(value.cast("string"))
            value = F.when(value != 0, shown)
        branches.append(F.when(_grid_test(value, item["operation"], item.get("value", "")), F.lit(item["output"])))
    return df.withColumn("branch", F.coalesce(*branches, F.lit("End")))


def match_scenario(df: DataFrame, label: Column, scenarios: Sequence[str]) -> DataFrame:
    """Add `idx`: exact match, then a scenario that starts with the label, then either inside the other, else the last."""
    wanted = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    names = [s.lower() for s in scenarios]
    levels = [
        *[F.when(F.lit(n) == wanted, i) for i, n in enumerate(names)],
        *[F.when(F.startswith(F.lit(n), wanted), i) for i, n in enumerate(names)],
        *[F.when(F.contains(F.lit(n), wanted) | F.contains(wanted, F.lit(n)), i) for i, n in enumerate(names)],
    ]
    return df.withColumn("idx", F.coalesce(*levels, F.lit(len(names) - 1)))


Step = Callable[[Column, Column, Column, Column], Column | tuple[Column, Column]]


def iterate_items(df: DataFrame, items: Column, step: Step, out: str = "content") -> DataFrame:
    """Run `step(item, index, is_first, is_last)` on every array item and join the results by newline.

    A step may give (value, error); an error becomes `Error in iteration n: ...`.  Empty results are
    left out.  It all happens inside the row, so nothing is shuffled.
    """
    size = F.size(items)

    def one(item: Column, i: Column) -> Column:
        made = step(item, i, i == 0, i == size - 1)
        if not isinstance(made, tuple):
            return made
        value, error = made
        return F.when(error.isNotNull(), F.concat(F.lit("Error in iteration "), i + 1, F.lit(": "), error)).otherwise(value)

    results = F.filter(F.transform(items, one), lambda x: x.isNotNull() & (x != ""))
    return df.withColumn(out, F.array_join(results, "\n"))


def loop_until(
    df: DataFrame, step: Callable[[DataFrame], DataFrame], done: Callable[[DataFrame], Column], max_count: int = 5
) -> DataFrame:
    """Repeat a step on the rows that are not done, at most `max_count` times; adds `rounds`.

    Every round is checkpointed, finished rows leave the loop.
    """
    open_rows = df.withColumn("rounds", F.lit(0))
    finished: DataFrame | None = None
    for _ in range(max_count):
        stepped = settle(step(open_rows).withColumn("rounds", F.col("rounds") + 1))
        ready = F.coalesce(done(stepped), F.lit(False))
        part = stepped.where(ready)
        finished = part if finished is None else finished.unionByName(part)
        open_rows = stepped.where(~ready)
        if open_rows.isEmpty():
            return finished
    return open_rows if finished is None else finished.unionByName(open_rows)


def fold_state(
    df: DataFrame,
    key: str,
    reducers: dict[str, str],
    order_by: Sequence[str],
    defaults: dict | None = None,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Fold the updates of a key in order: `append` collects the values, `replace` keeps the last one.

    A long key gives several rows numbered by `part`; appended values continue from part to part and
    the replaced ones stand on each.
    """
    defaults = defaults or {}
    appended = [c for c, how in reducers.items() if how == "append"]
    replaced = [c for c, how in reducers.items() if how == "replace"]
    if len(appended) + len(replaced) != len(reducers):
        raise ValueError("a reducer is append or replace")
    size = F.lit(1)
    for name in appended:
        size = size + F.coalesce(F.length(F.col(name).cast("string")), F.lit(0))
    rows = df.select(key, *dict.fromkeys([*order_by, *reducers]))
    numbered = in_parts(rows, [key], list(order_by), size, part_chars).withColumn("_at", F.struct(*order_by))

    def collected(name: str) -> Column:
        filled = F.when(F.col(name).isNotNull(), F.struct("_at", F.col(name).alias("_x")))
        return F.transform(F.sort_array(F.collect_list(filled)), lambda s: s["_x"]).alias(name)

    out = numbered.groupBy(key, "part").agg(F.count(F.lit(1)).alias("updates"), *[collected(c) for c in appended])
    if replaced:
        last = numbered.groupBy(key).agg(*[
            F.coalesce(
                F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_at"))), F.lit(defaults.get(c))
            ).alias(c) for c in replaced
        ])
        out = out.join(last, key)
    return with_part_count(out, [key], numbered)


def merge_branch_outputs(df: DataFrame, group_by: str, source: Column, part_chars: int = PART_CHARS) -> DataFrame:
    """Outputs (json, text) of several branches in source order: JSON by source, texts by newline.

    The last output of a source counts (column `pos`).  Each part is an object of its own; the union of their
    members is the whole.
    """
    last = (
        df.withColumn("_source", source)
        .groupBy(group_by, "_source").agg(F.max_by(F.struct("json", "text"), "pos").alias("_o"))
        .select(group_by, "_source", "_o.*")
    )
    size = F.coalesce(F.length("json"), F.lit(0)) + F.coalesce(F.length("text"), F.lit(0))
    numbered = in_parts(last, [group_by], ["_source"], size, part_chars)
    rows = F.sort_array(F.collect_list(F.struct("_source", "json", "text")))
    merged = numbered.groupBy(group_by, "part").agg(rows.alias("_rows"))
    item = F.transform(
        F.filter("_rows", lambda r: r["json"].isNotNull()),
        lambda r: F.concat(F.to_json(F.struct(r["_source"].alias("s"))), F.lit("\u0000"), r["json"]),
    )
    # {"s":"name"} + value becomes "name":value
    pair = F.transform(item, lambda x: F.regexp_replace(x, '^\\{"s":(.*?)\\}\u0000', "$1:"))
    texts = F.filter(F.transform("_rows", lambda r: r["text"]), lambda t: t.isNotNull() & (t != ""))
    out = merged.select(
        group_by, "part",
        F.concat(F.lit("{"), F.array_join(pair, ","), F.lit("}")).alias("json"),
        F.array_join(texts, "\n").alias("text"),
    )
    return with_part_count(out, [group_by], numbered)


def few_shot_prompt(
    df: DataFrame,
    examples: DataFrame,
    key: str,
    order_by: str,
    example_template: str,
    prefix: str = "",
    suffix: str = "",
    sep: str = "\n\n",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Prefix, the examples of the row's key through a template, and the suffix filled from the row.

    A key with more than `part_chars` characters of examples gives a prompt in parts: the first starts with the prefix,
    the last ends with the suffix.
    """
    written = examples.withColumn(
        "_e", templates.fill_variables(example_template, {c: F.col(c) for c in examples.columns}))
    joined = join_in_parts(written, [key], [order_by], "_e", sep, "_text", part_chars)
    parts = joined.groupBy(key).agg(F.max("part").alias("_last"))
    rows = df.join(joined, key, "left").join(parts, key, "left").withColumns({
        "part": F.coalesce("part", F.lit(0).cast("bigint")), "n_parts": F.coalesce("n_parts", F.lit(1).cast("bigint"))})
    filled = templates.fill_variables(suffix, {c: F.col(c) for c in df.columns})
    head = F.when(F.col("part") == 0, F.lit(prefix or None))
    tail = F.when(F.col("part") == F.coalesce("_last", F.lit(0)), filled if suffix else F.lit(None).cast("string"))
    return rows.withColumn("prompt", F.concat_ws(sep, head, F.col("_text"), tail)).drop("_text", "_last")


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str) -> DataFrame:
    """A user function over Arrow batches of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def if_else(condition: Column, then: Column, otherwise: Column) -> Column:
    return F.when(condition, then).otherwise(otherwise)


def with_variables(df: DataFrame, variables: dict[str, str], prefix: str = "var_") -> DataFrame:
    """Named values as literal columns."""
    return df.withColumns({f"{prefix}{name}": F.lit(value) for name, value in variables.items()})


def batch_prompt(
    df: DataFrame,
    prompt: Column,
    model_name: str,
    cache: DataFrame,
    complete: Callable[[pd.Series], pd.Series],
    schema: StructType | str | None = None,
    post: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Render, look up, complete the misses once each, parse.  Returns the rows and the new cache.

    The completions are written once; the rows and the cache read them.
    """
    keyed = df.withColumn("prompt", prompt).withColumn("cache_key", cache_key(F.col("prompt"), F.lit(model_name)))
    misses = keyed.groupBy("cache_key").agg(F.min("prompt").alias("prompt")).join(cache, "cache_key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"cache_key": batch["cache_key"], "value": complete(batch["prompt"])})

    fresh = written_table(misses.mapInPandas(run, "cache_key string, value string"))
    full = cache.select("cache_key", "value").unionByName(fresh)
    answer = F.col("value") if post is None else post(F.col("value"))
    rows = keyed.join(full, "cache_key", "left").withColumn("answer", answer).drop("value")
    if schema is not None:
        rows = rows.withColumn("parsed", templates.parse_structured_output(F.col("answer"), schema))
    return rows, full
