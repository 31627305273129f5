"""Cleaning documents, merging metadata, and filters over metadata and columns."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import jsons, text
from tidemark.operators.ordering import PART_CHARS, join_in_parts


def apply_metadata(
    df: DataFrame,
    additional: dict | None = None,
    omit: Sequence[str] | str = (),
    precedence: str = "document",
    source_id_key: str | None = None,
) -> DataFrame:
    """Merge metadata; document keys win, or the additional ones; `omit="*"` keeps only the additional."""
    extra = jsons.typed_map(F.lit(json.dumps(additional or {})))
    if omit == "*":
        return df.withColumn("metadata", F.to_json(extra))
    own = jsons.typed_map(F.col("metadata"))
    if precedence == "document":
        merged = jsons.override(extra, own)
    elif precedence == "additional":
        merged = jsons.override(own, extra)
    else:
        raise ValueError("precedence is document or additional")
    if source_id_key:
        given = F.to_json(F.try_element_at(own, F.lit(source_id_key)))
        empty = given.isNull() | given.isin("null", '""', "0", "false")
        fill = F.create_map(F.lit(source_id_key), F.parse_json(F.lit(json.dumps(source_id_key))))
        kept = F.map_filter(own, lambda k, _: k == source_id_key)
        merged = jsons.override(merged, F.when(empty, fill).otherwise(kept))
    for path in omit.split(",") if isinstance(omit, str) else omit:
        if path.strip():
            merged = jsons.omit_path(merged, [p for p in path.strip().split(".")])
    return df.withColumn("metadata", F.to_json(merged))


def json_leaves(df: DataFrame, js: Column) -> DataFrame:
    """One row per leaf value, in walk order."""
    return df.select("*", F.posexplode(jsons.leaf_array(js)).alias("leaf_no", "leaf"))


def normalize_keys(js_or_df: Column | DataFrame) -> Column | DataFrame:
    """JSON keys to letters, digits and `_`; column names trimmed with spaces as `_`."""
    if isinstance(js_or_df, Column):
        return jsons.rename_keys(js_or_df)
    return js_or_df.toDF(*[c.strip().replace(" ", "_") for c in js_or_df.columns])


def clean_docs(df: DataFrame) -> DataFrame:
    """Cut NUL characters and drop documents without content."""
    return df.withColumn("page_content", F.replace("page_content", F.lit("\u0000"), F.lit(""))).where(
        "length(page_content) > 0"
    )


def concat_docs_text(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[str],
    escape_prefix: str | None = None,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Contents of a group in order, each followed by a newline, in parts bounded by `part_chars`.

    With `escape_prefix`, control characters are written as prefix and name (`...NEWLINE`).
    """
    joined = join_in_parts(df, group_by, order_by, "page_content", "\n", "text", part_chars)
    full = F.concat("text", F.lit("\n"))
    if escape_prefix is not None:
        full = text.escape_words(full, escape_prefix)
    return joined.withColumn("text", full)


# ---- filter chain ----------------------------------------------------------------------------

_CASTS = {"int": "bigint", "integer": "bigint", "bigint": "bigint", "float": "double", "double": "double",
          "numeric": "double", "text": "string", "bool": "boolean", "boolean": "boolean", "date": "date",
          "timestamp": "timestamp"}


def column_of(spec: str) -> Column:
    """Column for `name`, `name->key`, `name->a->>b`, each with an optional `::type`."""
    body, _, cast = spec.partition("::")
    name, *keys = [p.strip() for p in re.split(r"->>?", body)]
    col = F.get_json_object(F.col(name), jsons.spark_path(keys)) if keys else F.col(name)
    if not cast:
        return col
    if cast not in _CASTS:
        raise ValueError(f"unknown cast {cast}")
    return col.try_cast(_CASTS[cast])


def _bounds(spec) -> tuple[Column, Column]:
    """Lower and upper end of a range: a pair of columns, or a struct or array column with two fields."""
    if isinstance(spec, (tuple, list)):
        return column_of(spec[0]), column_of(spec[1])
    return F.col(f"{spec}.lo"), F.col(f"{spec}.hi")


def _tokens_of(value: str) -> list[str]:
    return re.findall(r"[^\W_]+", value.lower())


def _all_tokens(col: Column, value: str) -> Column:
    have = text.words(col)
    cond = F.lit(True)
    for token in _tokens_of(value):
        cond = cond & F.array_contains(have, token)
    return cond


def _phrase(col: Column, value: str) -> Column:
    wanted = " ".join(_tokens_of(value))
    return F.concat(F.lit(" "), F.array_join(text.words(col), " "), F.lit(" ")).contains(f" {wanted} ")


def _web_search(col: Column, value: str) -> Column:
    """Quoted phrases, `-word` to exclude, `or` between alternatives, all other words required."""
    cond = F.lit(False)
    for part in re.split(r"\s+or\s+", value, flags=re.I):
        hit = F.lit(True)
        for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', part):
            one = _phrase(col, phrase) if phrase else _all_tokens(col, word)
            hit = hit & (~one if minus else one)
        cond = cond | hit
    return cond


_VALUE_OPS = {
    "eq": lambda c, v: c == F.lit(v),
    "neq": lambda c, v: c != F.lit(v),
    "gt": lambda c, v: c > F.lit(v),
    "gte": lambda c, v: c >= F.lit(v),
    "lt": lambda c, v: c < F.lit(v),
    "lte": lambda c, v: c <= F.lit(v),
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
    "is": lambda c, v: c.isNull() if v in (None, "null") else c.eqNullSafe(F.lit(v in (True, "true"))),
    "in": lambda c, v: c.isin(list(v)),
    "cs": lambda c, v: F.size(F.array_except(F.array(*map(F.lit, v)), c)) == 0,
    "cd": lambda c, v: F.size(F.array_except(c, F.array(*map(F.lit, v)))) == 0,
    "ov": lambda c, v: F.arrays_overlap(c, F.array(*map(F.lit, v))),
    "fts": _all_tokens,
    "plfts": _all_tokens,
    "phfts": _phrase,
    "wfts": _web_search,
}
# ranges are half open: lower end in, upper end out
_RANGE_OPS = {
    "sl": lambda lo, hi, v: hi <= F.lit(v[0]),
    "sr": lambda lo, hi, v: lo >= F.lit(v[1]),
    "nxl": lambda lo, hi, v: lo >= F.lit(v[0]),
    "nxr": lambda lo, hi, v: hi <= F.lit(v[1]),
    "adj": lambda lo, hi, v: (hi == F.lit(v[0])) | (lo == F.lit(v[1])),
}


def filter_chain(
    df: DataFrame,
    filters: Sequence[tuple],
    order: Sequence[tuple[str, bool]] | None = None,
    limit: int | None = None,
    range_: tuple[int, int] | None = None,
) -> DataFrame:
    """AND of (column, operator, value) tuples, then order (column, ascending), row range or limit."""
    for spec, op, value in filters:
        if op in _VALUE_OPS:
            df = df.where(_VALUE_OPS[op](column_of(spec), value))
        elif op in _RANGE_OPS:
            df = df.where(_RANGE_OPS[op](*_bounds(spec), value))
        else:
            raise ValueError(f"disallowed filter operator: {op}")
    if order:
        df = df.orderBy(*[column_of(c).asc() if up else column_of(c).desc() for c, up in order])
    if range_ is not None:
        first, last = range_
        df = df.offset(first).limit(last - first + 1) if first else df.limit(last + 1)
    return df if limit is None else df.limit(limit)
