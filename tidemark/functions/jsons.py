"""JSON text columns: paths, containment, repair, and walks over whole values."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType


# ---- paths -----------------------------------------------------------------------------------

def path_steps(path: str) -> list[str | int]:
    """Steps of a path like `a.b[0].c`; negative indexes count from the end."""
    steps: list[str | int] = []
    for name, index, quoted in re.findall(r"""([^.\[\]]+)|\[(-?\d+)\]|\[["']([^"']*)["']\]""", path):
        steps.append(int(index) if index else (quoted or name))
    return steps


def pointer_steps(pointer: str) -> list[str | int]:
    """Steps of a JSON pointer like `/a/0/c`."""
    if pointer and not pointer.startswith("/"):
        raise ValueError(f"a JSON pointer starts with a slash: {pointer}")
    parts = [p.replace("~1", "/").replace("~0", "~") for p in pointer.split("/")[1:]]
    return [int(p) if p.isdigit() else p for p in parts]


def spark_path(steps: Iterable[str | int]) -> str:
    out = "$"
    for step in steps:
        if isinstance(step, int):
            out += f"[{step}]"
        elif "'" in step:
            out += f'["{step}"]'
        else:
            out += f"['{step}']"
    return out


def _sub(value: Column, steps: list[str | int]) -> Column:
    """Variant below the steps, null when absent."""
    for i, step in enumerate(steps):
        if isinstance(step, int) and step < 0:
            items = F.try_variant_get(value, spark_path(steps[:i]), "array<variant>")
            return _sub(F.try_element_at(items, F.lit(step)), steps[i + 1:])
    return F.try_variant_get(value, spark_path(steps), "variant")


def variant_text(value: Column) -> Column:
    """Strings bare, everything else as JSON, JSON null as the word null."""
    as_json = F.to_json(value)
    return F.when(F.is_variant_null(value), F.lit("null")).otherwise(
        F.when(as_json.startswith('"'), F.variant_get(value, "$", "string")).otherwise(as_json)
    )


def json_path_get(js: Column, path: str, on_error: str = "error") -> Column:
    """Value at a path as text.  A missing path is an error, or the text `null`."""
    steps = path_steps(path)
    if not steps:
        raise ValueError("the path is empty")
    value = _sub(F.try_parse_json(js), steps)
    if any(isinstance(s, int) and s < 0 for s in steps):
        found = variant_text(value)
    else:
        found = F.when(F.is_variant_null(value), F.lit("null")).otherwise(F.get_json_object(js, spark_path(steps)))
    if on_error == "null_text":
        return F.coalesce(found, F.lit("null"))
    if on_error != "error":
        raise ValueError("on_error is error or null_text")
    return F.coalesce(found, F.raise_error(F.lit(f'Path "{path}" not found in JSON')))


# ---- containment -----------------------------------------------------------------------------

def _leaf_equals(value: Column, wanted) -> Column:
    as_json = F.to_json(value)
    if wanted is None:
        return F.is_variant_null(value)
    if isinstance(wanted, bool):
        return as_json == F.lit(json.dumps(wanted))
    if isinstance(wanted, (int, float)):
        return F.coalesce(
            ~as_json.startswith('"') & ~as_json.isin("true", "false", "null")
            & (F.try_variant_get(value, "$", "double") == F.lit(float(wanted))),
            F.lit(False),
        )
    return F.coalesce(as_json.startswith('"') & (F.try_variant_get(value, "$", "string") == F.lit(wanted)), F.lit(False))


def _contains(value: Column, wanted) -> Column:
    if isinstance(wanted, dict):
        cond = F.to_json(value).startswith("{")
        for key, inner in wanted.items():
            cond = cond & _contains(F.try_variant_get(value, spark_path([key]), "variant"), inner)
        return F.coalesce(cond, F.lit(False))
    if isinstance(wanted, list):
        items = F.try_variant_get(value, "$", "array<variant>")
        cond = F.to_json(value).startswith("[")
        for inner in wanted:
            cond = cond & _holds(items, inner)
        return F.coalesce(cond, F.lit(False))
    return F.coalesce(_leaf_equals(value, wanted), F.lit(False))


def _holds(items: Column, wanted) -> Column:
    return F.exists(items, lambda item: _contains(item, wanted))


def metadata_contains(js: Column, flt: dict) -> Column:
    """The JSON object holds every key and value of `flt`, at any depth."""
    return F.lit(True) if not flt else _contains(F.try_parse_json(js), flt)


def has_key(js: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(js), key), F.lit(False))


def tenant_scope_filter(js: Column, flt: dict | None, chat_id: str | None = None, chat_key: str = "chatId") -> Column:
    """Shared rows that match `flt`, plus the rows of one chat."""
    rest = {k: v for k, v in (flt or {}).items() if k != chat_key}
    chat = chat_id if chat_id is not None else (flt or {}).get(chat_key)
    shared = metadata_contains(js, rest) & ~has_key(js, chat_key)
    return shared if not chat else shared | metadata_contains(js, {chat_key: chat})


def metadata_equals_all(js: Column, flt: dict | None, store_flt: dict | None = None) -> Column:
    """AND of key equals value; a filter may come from the call or from the store, not from both."""
    if flt and store_flt:
        raise ValueError("give the filter in the call or in the store, not in both")
    value = F.try_parse_json(js)
    cond = F.lit(True)
    for key, wanted in (flt or store_flt or {}).items():
        sub = F.try_variant_get(value, spark_path(path_steps(key)), "variant")
        cond = cond & F.coalesce(_leaf_equals(sub, wanted), F.lit(False))
    return cond


# ---- repair ----------------------------------------------------------------------------------

_LENIENT = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true", "allowComments": "true",
            "allowBackslashEscapingAnyCharacter": "true"}


def _lenient(js: Column) -> Column:
    parsed = F.from_json(js, "variant", _LENIENT)
    # a lenient reader also takes an empty text or trailing words; the first sign must open a value
    return F.when(js.rlike(r'^\s*(//.*\s*|/\*[\s\S]*?\*/\s*)*[\[{"\'\-\dtfn]'), parsed)


def repair_json(js: Column) -> Column:
    """Valid JSON text from a nearly valid one, null when no step of the ladder reads it."""
    no_commas = F.regexp_replace(js, r",(\s*[}\]])", "$1")
    unescaped = F.regexp_replace(js, r"\\(?=[\[\]{}])", "")
    requoted = F.regexp_replace(F.replace(unescaped, F.lit("'"), F.lit('"')), r",(\s*[}\]])", "$1")
    no_comments = F.regexp_replace(F.regexp_replace(requoted, r"(?m)//.*$", ""), r"/\*[\s\S]*?\*/", "")
    minimal = F.trim(F.regexp_replace(unescaped, r",(\s*[}\]])", "$1"))
    return F.to_json(
        F.coalesce(
            F.try_parse_json(js), _lenient(js), _lenient(no_commas), _lenient(no_comments), F.try_parse_json(minimal)
        )
    )


# ---- whole-value walks -----------------------------------------------------------------------

def js_text(value) -> str:
    """Text of a JSON scalar the way a template prints it."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return value if isinstance(value, str) else str(value)


def dump(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _pairs(node):
    return node.items() if isinstance(node, dict) else enumerate(node)


def _flatten(node, prefix: str, out: dict[str, str]) -> dict[str, str]:
    for key, value in _pairs(node):
        name = f"{prefix}.{key}" if prefix else str(key)
        if isinstance(value, (dict, list)):
            _flatten(value, name, out)
        elif value is not None:
            out[name] = js_text(value)
    return out


def leaves(node) -> list[str]:
    if isinstance(node, (dict, list)):
        return [leaf for _, value in _pairs(node) for leaf in leaves(value)]
    return [js_text(node)]


def _rename(node):
    if isinstance(node, dict):
        return {re.sub(r"[^a-zA-Z0-9_]", "_", k): _rename(v) for k, v in node.items()}
    return [_rename(v) for v in node] if isinstance(node, list) else node


def _without(node, key: str):
    if isinstance(node, dict):
        return {k: _without(v, key) for k, v in node.items() if k != key}
    return [_without(v, key) for v in node] if isinstance(node, list) else node


def _walk(js: Column, returns, fn: Callable) -> Column:
    """Apply `fn` to each parsed value, in Arrow batches; unreadable text gives null."""

    def read(text):
        try:
            return None if text is None else fn(json.loads(text))
        except ValueError:
            return None

    @F.pandas_udf(returns)
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(read)

    return walk(js)


def flatten_json(js: Column) -> Column:
    """Nested object to a map of dotted keys; nulls and empty objects vanish."""
    return _walk(js, MapType(StringType(), StringType()),
                 lambda node: _flatten(node, "", {}) if isinstance(node, (dict, list)) else {})


def leaf_array(js: Column) -> Column:
    return _walk(js, ArrayType(StringType()), leaves)


def rename_keys(js: Column) -> Column:
    return _walk(js, StringType(), lambda node: dump(_rename(node)))


def public_execution_scrub(js: Column, key: str) -> Column:
    """Remove `key` at every depth."""
    return _walk(js, StringType(), lambda node: dump(_without(node, key)))


# ---- metadata --------------------------------------------------------------------------------

def typed_map(js: Column) -> Column:
    """Top level of a JSON object; the values keep their types."""
    return F.from_json(F.coalesce(js, F.lit("{}")), "map<string,variant>")


def override(base: Column, top: Column) -> Column:
    """Both maps together; `top` wins."""
    keys = F.map_keys(top)
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(keys, k)), top)


def omit_path(values: Column, steps: list[str]) -> Column:
    """Drop a key, or a key below nested objects."""
    key, *rest = steps
    if not rest:
        return F.map_filter(values, lambda k, _: k != key)
    return F.transform_values(
        values,
        lambda k, v: F.when(
            (k == key) & F.to_json(v).startswith("{"),
            F.parse_json(F.to_json(omit_path(F.from_json(F.to_json(v), "map<string,variant>"), rest))),
        ).otherwise(v),
    )


def primitive_metadata(js: Column) -> Column:
    """Keep scalars, turn objects and arrays into JSON text; a line range becomes locFrom and locTo."""
    values = typed_map(js)
    span = F.get_json_object(js, "$.loc.lines")
    flat = F.transform_values(
        values,
        lambda k, v: F.when(F.to_json(v).rlike(r"^[\[{]"), F.parse_json(F.to_json(F.struct(F.to_json(v).alias("s")))))
        .otherwise(v),
    )
    text_or_self = F.transform_values(
        flat, lambda k, v: F.coalesce(F.when(F.to_json(v).startswith("{"), F.try_variant_get(v, "$.s", "variant")), v)
    )
    lines = F.map_from_arrays(
        F.array(F.lit("locFrom"), F.lit("locTo")),
        F.array(*[F.try_parse_json(F.get_json_object(span, f"$.{end}")) for end in ("from", "to")]),
    )
    return F.to_json(
        F.when(
            span.isNotNull(),
            override(F.map_filter(text_or_self, lambda k, _: k != "loc"), lines),
        ).otherwise(text_or_self)
    )
