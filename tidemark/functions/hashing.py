"""Content hashes as columns."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

RESERVED_KEYS = ("hash_", "content_hash", "metadata_hash")


def uuid5(name: Column, namespace: str) -> Column:
    """Name-based UUID, version 5, equal to `uuid.uuid5(namespace, name)`."""
    prefix = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.sha1(F.concat(prefix, F.encode(name, "utf-8")))
    variant = F.translate(digest.substr(17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws(
        "-",
        digest.substr(1, 8),
        digest.substr(9, 4),
        F.concat(F.lit("5"), digest.substr(14, 3)),
        F.concat(variant, digest.substr(18, 3)),
        digest.substr(21, 12),
    )


def hash_uuid(value: Column, namespace: str) -> Column:
    return uuid5(F.sha2(value, 256), namespace)


def _plain_number(value):
    return int(value) if isinstance(value, float) and value.is_integer() else value


def _sorted_json(js: str | None, whitelist: bool) -> str | None:
    """JSON with sorted keys; with `whitelist`, nested keys must also be top-level keys."""
    if js is None:
        return None
    data = json.loads(js, parse_float=lambda s: _plain_number(float(s)))
    allowed = sorted(data) if isinstance(data, dict) else []

    def walk(node):
        if isinstance(node, dict):
            keys = [k for k in allowed if k in node] if whitelist else sorted(node)
            return {k: walk(node[k]) for k in keys}
        return [walk(v) for v in node] if isinstance(node, list) else node

    return json.dumps(walk(data), ensure_ascii=False, separators=(",", ":"))


def canonical_json(js: Column, nested: str) -> Column:
    """Metadata text to hash.

    `flat` stays in the JVM and suits metadata without nested objects; `reference` keeps the rule
    that only top-level key names count at any depth; `full` keeps every nested key.
    """
    if nested == "flat":
        values = F.from_json(js, "map<string,variant>")
        keys = F.array_sort(F.map_keys(values))
        return F.to_json(F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(values, k)))))
    if nested not in ("reference", "full"):
        raise ValueError("nested is flat, reference or full")
    whitelist = nested == "reference"

    @F.pandas_udf(StringType())
    def canonical(values: pd.Series) -> pd.Series:
        return values.map(lambda js: _sorted_json(js, whitelist))

    return canonical(js)
