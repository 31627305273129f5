"""Files and tables to documents: doc_id, page_content, metadata (JSON text)."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.functions import jsons
from tidemark.operators.ordering import PART_CHARS, join_in_parts, number_rows

# fixed values: file name endings read as plain text
TEXT_ENDINGS = (
    "txt", "aspx", "asp", "cpp", "c", "cs", "css", "go", "h", "kt", "java", "js", "less", "ts", "php", "proto", "python",
    "py", "rst", "ruby", "rb", "rs", "scala", "sc", "scss", "sol", "sql", "swift", "markdown", "md", "tex", "ltx", "html",
    "vb", "xml",
)

# a quoted value may hold line feeds and doubled quotes.  Such a file is read by one task, so large inputs
# have to come as many files
CSV = {"multiLine": True, "escape": '"'}


# ---- CSV -------------------------------------------------------------------------------------

def _csv_groups(spark: SparkSession, paths: Sequence[str], recursive: bool = False) -> list[list[str]]:
    """Files with the same header line together; the driver sees one line per file."""
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", str(recursive).lower())
    lines = reader.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"),
    ).where("at = 0")
    headers = lines.groupBy("path").agg(F.min_by("value", "n").alias("header"))
    grouped = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("paths")
    return [row["paths"] for row in grouped.collect()]


def _common(types: list) -> str:
    if len({t.simpleString() for t in types}) == 1:
        return types[0].simpleString()
    return "double" if all(isinstance(t, NumericType) for t in types) else "string"


def load_csv_union(
    spark: SparkSession, paths: Sequence[str] | str, infer: bool = True, same_columns: bool = False
) -> DataFrame:
    """All files as one table: types inferred from all rows, columns united by name.

    `same_columns` says that all files share one header, which saves the pass that compares them.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    groups = [listed] if same_columns else _csv_groups(spark, listed)
    frames = [spark.read.csv(group, header=True, inferSchema=infer, **CSV) for group in groups]
    types: dict[str, list] = {}
    for frame in frames:
        for field in frame.schema:
            types.setdefault(field.name, []).append(field.dataType)
    out: DataFrame | None = None
    for frame in frames:
        cast = frame.select(*[F.col(f"`{c}`").cast(_common(types[c])).alias(c) for c in frame.columns])
        out = cast if out is None else out.unionByName(cast, allowMissingColumns=True)
    if out is None:
        raise ValueError("no CSV file was found")
    return out


def _csv_docs(frame: DataFrame, column: str | None) -> DataFrame:
    names = [("_" + c[2:]) if re.fullmatch(r"_c\d+", c) else c for c in frame.columns]
    frame = frame.toDF(*names).select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    if column is not None:
        if column not in names:
            raise ValueError(f"column {column} not found in the CSV file")
        content = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    else:
        content = F.concat_ws("\n", *[
            F.concat(F.lit(f"{n.strip()}: "), F.trim(F.coalesce(F.col(f"`{n}`"), F.lit("")))) for n in names])
    rows = frame.select(content.alias("page_content"), "_path", "_block", "_at")
    numbered = number_rows(rows, ["_path"], ["_block", "_at"], "line")
    return numbered.select(
        F.concat_ws(":", "_path", "line").alias("doc_id"),
        "page_content",
        F.to_json(F.struct(F.col("_path").alias("source"), "line")).alias("metadata"),
    )


def load_csv_docs(spark: SparkSession, path: str, column: str | None = None, recursive: bool = False) -> DataFrame:
    """One document per row: the value of a column, or `key: value` lines."""
    out: DataFrame | None = None
    for group in _csv_groups(spark, [path], recursive):
        docs = _csv_docs(spark.read.csv(group, header=True, **CSV), column)
        out = docs if out is None else out.unionByName(docs)
    if out is None:
        raise ValueError(f"no CSV file in {path}")
    return out


# ---- JSON ------------------------------------------------------------------------------------

def _below(value, path: tuple = ()) -> Iterator[tuple[tuple, object]]:
    """Every value of a JSON tree with its path, parents first."""
    yield path, value
    children = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    for step, child in children:
        yield from _below(child, (*path, str(step)))


def _matches(leaf: tuple, tree: dict[tuple, object], hits: dict[tuple, list], order: dict[tuple, int]) -> Iterator[tuple]:
    """Sort keys of the places at which a leaf is below a pointer, from the root down.

    Values without a match are passed until the first with one; from there only values with a match lead on.
    """
    place: tuple = ()
    started = False
    for depth in range(len(leaf)):
        here = hits.get(leaf[:depth], [])
        if started and not here:
            return
        started = started or bool(here)
        for k, target in here:
            if leaf[:len(target)] == target:
                yield (*place, (0, k, order[leaf]))
        if any(target == leaf[:depth + 1] for _, target in here):
            return
        place = (*place, (1, order[leaf[:depth + 1]]))


def _strings(item, pointers: list[list]) -> list[str]:
    """The non-empty strings of an item, or those below the pointers."""
    tree = dict(_below(item))
    texts = [(path, value) for path, value in tree.items() if isinstance(value, str) and value]
    if not pointers:
        return [value for _, value in texts]
    order = {path: i for i, path in enumerate(tree)}
    hits = {
        path: found for path, value in tree.items() if isinstance(value, (dict, list))
        and (found := [(k, (*path, *steps)) for k, steps in enumerate(pointers) if tree.get((*path, *steps))])
    }
    found = [(place, value) for path, value in texts for place in _matches(path, tree, hits, order)]
    return [value for _, value in sorted(found, key=lambda x: x[0])]


def _object_lines(item: dict) -> str:
    """`a.b: value` lines; arrays stay JSON, an object without members is an empty line."""
    lines = []
    tree = dict(_below(item))
    for path, value in tree.items():
        inside = any(isinstance(tree[path[:i]], list) for i in range(len(path)))
        if not path or inside or (isinstance(value, dict) and value):
            continue
        name = ".".join(map(str, path))
        lines.append("" if value == {} else f"{name}: {jsons.dump(value) if isinstance(value, list) else jsons.js_text(value)}")
    return "\n".join(lines)


def _json_rows(text: str, pointers: list[list], mapping: dict[str, list], by_object: bool) -> list[tuple[str, dict]]:
    data = json.loads(text.strip())
    rows = []
    for item in data if isinstance(data, list) else [data]:
        tree = dict(_below(item)) if mapping else {}
        metadata = {key: tree[tuple(steps)] for key, steps in mapping.items() if tuple(steps) in tree}
        if not by_object:
            rows += [(content, metadata) for content in _strings(item, pointers)]
        elif isinstance(item, dict):
            rows.append((_object_lines(item), metadata))
    return rows


def load_json_docs(
    df: DataFrame,
    text: Column,
    pointers: Sequence[str] = (),
    metadata_pointers: dict[str, str] | None = None,
    separate_by_object: bool = False,
    key: str = "doc_id",
) -> DataFrame:
    """Documents from JSON texts: strings below the pointers, every string, or one document per object.

    `line` joins the metadata only where a text gives more than one document.
    """
    steps = [[str(s) for s in jsons.pointer_steps(p)] for p in pointers]
    mapping = {k: [str(s) for s in jsons.pointer_steps(v)] for k, v in (metadata_pointers or {}).items()
               if isinstance(v, str) and v.startswith("/")}

    @F.pandas_udf("array<struct<page_content:string,metadata:string>>")
    def read(texts: pd.Series) -> pd.Series:
        def one(value):
            made = _json_rows(value, steps, mapping, separate_by_object) if value else []
            many = len(made) > 1
            return [
                {"page_content": c, "metadata": jsons.dump({"line": i, **m} if many else m)}
                for i, (c, m) in enumerate(made, start=1)
            ]

        return texts.map(one)

    return df.select(F.col(key).alias("doc_id"), F.posexplode(read(text)).alias("_i", "_d")).select(
        "doc_id", (F.col("_i") + 1).alias("line"), "_d.page_content", "_d.metadata")


def load_jsonl_docs(
    df: DataFrame,
    line: Column,
    pointer: str,
    metadata_pointers: dict[str, str] | None = None,
    key: str = "doc_id",
    on_error: str = "error",
) -> DataFrame:
    """One document per non-blank line; the pointed value must be text (an error, or skipped)."""
    parsed = df.withColumn("_line", F.trim(line)).where("_line <> ''").withColumn("_v", F.try_parse_json("_line"))
    path = jsons.spark_path(jsons.pointer_steps(pointer))
    value = F.try_variant_get("_v", path, "variant")
    text = F.when(F.to_json(value).startswith('"'), F.try_variant_get("_v", path, "string"))
    if on_error == "error":
        text = F.coalesce(text, F.raise_error(F.concat(F.lit("expected text at the pointer in line: "), F.substring("_line", 1, 200))))
    elif on_error != "skip":
        raise ValueError("on_error is error or skip")
    pairs = [
        (name, F.try_variant_get("_v", jsons.spark_path(jsons.pointer_steps(p)), "variant"))
        for name, p in (metadata_pointers or {}).items() if isinstance(p, str) and p.startswith("/")
    ]
    metadata = F.to_json(F.struct(*[v.alias(n) for n, v in pairs])) if pairs else F.lit("{}")
    out = parsed.select(F.col(key).alias("doc_id"), text.alias("page_content"), metadata.alias("metadata"))
    return out if on_error == "error" else out.where(F.col("page_content").isNotNull())


# ---- text and folders ------------------------------------------------------------------------

def _text_docs(frame: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return frame.select(
        path.alias("doc_id"), F.col("value").alias("page_content"), F.to_json(F.struct(path.alias("source"))).alias("metadata"))


def load_text_docs(spark: SparkSession, path: str) -> DataFrame:
    """One document per file."""
    return _text_docs(spark.read.text(path, wholetext=True))


def load_folder(spark: SparkSession, path: str, recursive: bool = True, jsonl_pointer: str | None = None) -> DataFrame:
    """Every readable file below a folder, each ending with its own loader.

    Without a pointer, each JSON line gives all its strings.  A prefix of an object store is a folder to the Hadoop file system.
    """
    def read(endings: str, wholetext: bool = True) -> DataFrame:
        return (
            spark.read.option("recursiveFileLookup", str(recursive).lower())
            .option("pathGlobFilter", f"*.{endings}").text(path, wholetext=wholetext)
        )

    columns = ("doc_id", "page_content", "metadata")
    out = _text_docs(read("{" + ",".join(TEXT_ENDINGS) + "}"))
    source = F.col("_metadata.file_path")

    def with_source(docs: DataFrame) -> DataFrame:
        merged = jsons.override(jsons.typed_map(F.to_json(F.struct(F.col("doc_id").alias("source")))), jsons.typed_map(F.col("metadata")))
        return docs.withColumn("metadata", F.to_json(merged)).select(*columns)

    out = out.unionByName(with_source(
        load_json_docs(read("json").select(source.alias("doc_id"), "value"), F.col("value"))))
    lines = read("jsonl", wholetext=False).where("trim(value) <> ''").select(source.alias("doc_id"), "value")
    if jsonl_pointer is None:
        out = out.unionByName(with_source(load_json_docs(lines, F.col("value"))))
    else:
        out = out.unionByName(with_source(
            load_jsonl_docs(lines, F.col("value"), "/" + jsonl_pointer.strip().lstrip("/"))))
    for group in _csv_groups(spark, [path], recursive):
        out = out.unionByName(_csv_docs(spark.read.csv(group, header=True, **CSV), None).select(*columns))
    return out


# ---- tables ----------------------------------------------------------------------------------

def _cell(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def load_sheet_docs(df: DataFrame, sheet_name: str, order_by: Sequence[str]) -> DataFrame:
    """One document per row with `- name: value` lines; empty cells are left out."""
    names = df.columns
    numbered = number_rows(df, [], list(order_by), "_rn")
    lines = [F.when(_cell(n).isNotNull(), F.concat(F.lit(f"- {n}: "), _cell(n))) for n in names]
    cells = F.struct(F.lit(sheet_name).alias("worksheet"), F.col("_rn").alias("rowNum"), *[F.col(f"`{n}`") for n in names])
    return numbered.select(
        F.concat(F.lit(f"{sheet_name}:"), "_rn").alias("doc_id"),
        F.concat(F.concat_ws("\n", *lines), F.lit("\n")).alias("page_content"),
        F.to_json(cells).alias("metadata"),
    )


def _column_letters(n: int) -> list[str]:
    return [chr(65 + i) for i in range(n)]


def table_to_markdown(
    df: DataFrame,
    order_by: Sequence[str],
    include_headers: bool = True,
    group_by: Sequence[str] = (),
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """A table, or each group of it, as a Markdown table.

    A table with more than `part_chars` characters comes in parts numbered from 0; the first holds the header.
    """
    names = [c for c in df.columns if c not in group_by]
    shown = names if include_headers else _column_letters(len(names))
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(_cell(n), F.lit("")) for n in names]), F.lit(" |"))
    lines = df.select(*group_by, *[c for c in order_by if c not in group_by], row.alias("_line"))
    keys = list(group_by)
    if not keys:
        lines, keys = lines.withColumn("_all", F.lit(0)), ["_all"]
    parts = join_in_parts(lines, keys, order_by, "_line", "\n", "_body", part_chars)
    counts = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_data_rows"))
    head = "| " + " | ".join(shown) + " |\n| " + " | ".join("---" for _ in shown) + " |\n"
    return parts.join(counts, keys).select(
        *group_by,
        "part",
        "n_parts",
        F.concat(F.when(F.col("part") == 0, head).otherwise(""), "_body", F.lit("\n")).alias("page_content"),
        (F.col("total_data_rows") + (1 if include_headers else 0)).alias("row_count"),
        F.lit(len(shown)).alias("column_count"),
        "total_data_rows",
    )


def rows_to_json_docs(
    df: DataFrame,
    url: Column,
    fields: Sequence[str] | None = None,
    limit: int | None = None,
    where: Column | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Each record as indented JSON, its address in the metadata."""
    rows = (df if where is None else df.where(where)).withColumn("_url", url)
    if order_by:
        rows = rows.orderBy(*order_by)
    if limit is not None:
        rows = rows.limit(limit)

    def member(name: str) -> Column:
        boxed = F.to_json(F.struct(F.col(f"`{name}`").alias("v")), {"ignoreNullFields": "false"})
        return F.concat(F.lit(f"  {json.dumps(name, ensure_ascii=False)}: "), boxed.substr(F.lit(6), F.length(boxed) - 6))

    body = F.concat_ws(",\n", *[member(n) for n in (fields or df.columns)])
    return rows.select(
        F.col("_url").alias("doc_id"),
        F.concat(F.lit("{\n"), body, F.lit("\n}")).alias("page_content"),
        F.to_json(F.struct(F.col("_url").alias("url"))).alias("metadata"),
    )


def load_chunks(chunks: DataFrame, store_id: str) -> DataFrame:
    """Documents back from the chunks of a store."""
    return chunks.where(F.col("store_id") == store_id).select("doc_id", "chunk_no", "page_content", "metadata")


# ---- logs and imports ------------------------------------------------------------------------

def _hour(stamp: str) -> datetime:
    year, month, day, hour = (int(p) for p in stamp.split("-"))
    return datetime(year, month, day, hour)


def hours_between(start: str, end: str) -> list[str]:
    """Hour stamps `Y-M-D-H` between two stamps, both included; names of hourly log partitions."""
    first, last = _hour(start), _hour(end)
    n = int((last - first).total_seconds() // 3600)
    return [(first + timedelta(hours=i)).strftime("%Y-%m-%d-%H") for i in range(n + 1)]


def read_hourly_logs(df: DataFrame, ts: Column, start: str | None, end: str | None) -> DataFrame:
    """Rows of the hours between two `Y-M-D-H` stamps, both included."""
    if not start or not end:
        raise ValueError("give a start and an end")
    if start > end:
        raise ValueError("the start is after the end")
    first, last = _hour(start), _hour(end) + timedelta(hours=1)
    return df.where((ts >= F.lit(first.isoformat(" ")).cast("timestamp")) & (ts < F.lit(last.isoformat(" ")).cast("timestamp")))


def import_remap_ids(
    children: DataFrame, import_parents: DataFrame, stored_parents: DataFrame, stored_ids: DataFrame, salt: str
) -> DataFrame:
    """Children (id, parent_id) with a parent in the import or the store; ids already stored get new ones.

    The id before is kept as `old_id`, so that references can follow with `rewrite_references`.
    """
    parents = import_parents.select(F.col("id").alias("parent_id")).unionByName(
        stored_parents.select(F.col("id").alias("parent_id"))).distinct()
    taken = stored_ids.select("id").distinct().withColumn("_taken", F.lit(True))
    kept = children.join(parents, "parent_id", "left_semi").join(taken, "id", "left")
    text = F.col("id").cast("string")
    return kept.withColumn("old_id", text).withColumn(
        "id", F.when(F.col("_taken"), F.sha2(F.concat(text, F.lit(salt)), 256)).otherwise(text)).drop("_taken")


def rewrite_references(rows: DataFrame, remapped: DataFrame, key: str) -> DataFrame:
    """Follow changed ids in a referring column."""
    moved = remapped.where("id <> old_id").select(F.col("old_id").alias(key), F.col("id").alias("_new"))
    text = rows.withColumn(key, F.col(key).cast("string"))
    return text.join(moved, key, "left").withColumn(key, F.coalesce("_new", key)).drop("_new")
