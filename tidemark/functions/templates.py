"""Templates compiled once into column expressions, and parsers of model answers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import jsons


def _as_text(value: Column, kind: str) -> Column:
    return F.to_json(value) if kind.startswith(("struct", "array", "map")) else value.cast("string")


def render_template(template: str, fields: dict[str, Column], types: dict[str, str] | None = None) -> Column:
    """Replace `{{path}}` by the field of that name; unknown paths stay as written.

    `types` names the fields that hold structs, arrays or maps; they are written as JSON.
    """
    pieces: list[Column] = []
    for part in re.split(r"(\{\{\s*[^{}]+?\s*\}\})", template):
        name = part[2:-2].strip() if part.startswith("{{") else None
        if name in fields:
            pieces.append(F.coalesce(_as_text(fields[name], (types or {}).get(name, "string")), F.lit("")))
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces) if pieces else F.lit("")


def template_variables(template: str) -> list[str]:
    """Names in braces; escaped braces and names with a colon are left out."""
    return re.findall(r"(?<!\\)\{([^{}:\\]+)\}", template)


def fill_variables(template: str, values: dict[str, Column]) -> Column:
    """Replace `{name}` by a value; used for example templates."""
    pieces = []
    for part in re.split(r"(\{[^{}:]+\})", template):
        name = part[1:-1] if part.startswith("{") else None
        if name in values:
            pieces.append(F.coalesce(values[name].cast("string"), F.lit("")))
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces) if pieces else F.lit("")


def parse_structured_output(text: Column, schema: StructType | str) -> Column:
    """Fenced block if there is one, repaired and read with the schema; unreadable text gives null."""
    fenced = F.element_at(F.split(F.trim(text), r"```(?:json)?"), 2)
    body = F.when(text.contains("```"), fenced).otherwise(F.trim(text))
    return F.from_json(jsons.repair_json(body), schema)


def parse_list_output(text: Column, sep: str = ",", length: int | None = None) -> Column:
    """Trimmed items of a list; null when the length is not the expected one."""
    items = F.transform(F.split(F.trim(text), re.escape(sep)), lambda item: F.trim(item))
    return items if length is None else F.when(F.size(items) == length, items)
