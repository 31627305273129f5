"""Documents into chunks.  Every splitter gives doc_id, chunk_no (from 1), page_content, metadata."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import html as markup, text


def _emit(df: DataFrame, pieces: Column) -> DataFrame:
    # a bare column would be tested for being empty in a filter of its own, which cuts every text a second time
    pieces = F.coalesce(pieces, F.array().cast("array<string>"))
    return df.select(
        "doc_id", F.posexplode(pieces).alias("_at", "page_content"), "metadata"
    ).select("doc_id", (F.col("_at") + 1).alias("chunk_no"), "page_content", "metadata")


def _window_count(units: Column, size: int, overlap: int) -> Column:
    """Windows needed to cover `units` when each starts `size - overlap` after the one before."""
    return F.greatest(F.lit(1), F.ceil((units - overlap) / F.lit(size - overlap))).cast("int")


def chunk_fixed(df: DataFrame, max_chars: int = 1200, overlap: int = 120) -> DataFrame:
    """Windows of `max_chars` characters; the text is walked once, so long documents stay linear."""
    if not 0 <= overlap < max_chars:
        raise ValueError("overlap must be smaller than the window")
    step = max_chars - overlap
    body = df.select("doc_id", "metadata", text.stripped(F.col("page_content")).alias("_t")).where("_t <> ''")
    if overlap <= step:
        pieces = F.regexp_extract_all("_t", F.lit(f"(?s).{{1,{step}}}"), 0)
        body = body.withColumn("_p", pieces).withColumn("_n", _window_count(F.length("_t"), max_chars, overlap))
        windows = F.transform(
            F.slice("_p", F.lit(1), F.col("_n")),
            lambda piece, i: F.concat(piece, F.coalesce(F.get("_p", i + 1).substr(F.lit(1), F.lit(overlap)), F.lit(""))),
        )
    else:
        n = _window_count(F.length("_t"), max_chars, overlap)
        windows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.col("_t").substr(i * step + 1, F.lit(max_chars)))
    return _emit(body, windows)


def chunk_by_separator(df: DataFrame, separator: str = "\n\n", size: int = 1000, overlap: int = 200) -> DataFrame:
    return _emit(df, text.separator_chunks(F.col("page_content"), separator, size, overlap))


def chunk_recursive(
    df: DataFrame, separators: Sequence[str] | None = None, size: int = 1000, overlap: int = 200
) -> DataFrame:
    cut = text.with_recursive_chunks(df, "_chunks", F.col("page_content"), separators or text.PLAIN, size, overlap)
    return _emit(cut, F.col("_chunks"))


def chunk_code(df: DataFrame, language: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    if language not in text.SEPARATORS:
        raise ValueError(f"unknown language {language}; known: {', '.join(text.SEPARATORS)}")
    return chunk_recursive(df, text.SEPARATORS[language], size, overlap)


def chunk_markdown_headers(df: DataFrame, level: str = "h1") -> DataFrame:
    """A header up to `level` starts a section; text before the first header is one too."""
    depth = int(level[1:])
    if level[0] != "h" or not 1 <= depth <= 6:
        raise ValueError("level is h1 to h6")
    sections = F.split("page_content", rf"\n(?=#{{1,{depth}}}[^\S\n])")
    return _emit(df, F.transform(sections, text.stripped))


def chunk_html_as_markdown(df: DataFrame, html: str = "html", size: int = 1000, overlap: int = 200) -> DataFrame:
    return chunk_code(df.withColumn("page_content", markup.to_markdown(F.col(html))), "markdown", size, overlap)


def chunk_tokens(
    df: DataFrame, size: int = 1000, overlap: int = 200, tokenizer: Callable[[pd.Series], pd.Series] | None = None
) -> DataFrame:
    """Windows of tokens.  `tokenizer` maps a series of texts to a series of token lists."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the window")
    if tokenizer is None:
        tokens = F.regexp_extract_all("page_content", F.lit(r"\S+\s*"), 0)
    else:
        tokens = F.pandas_udf(tokenizer, "array<string>")("page_content")
    cut = df.select("doc_id", "metadata", tokens.alias("_tok")).where(F.size("_tok") > 0)
    n = _window_count(F.size("_tok"), size, overlap)
    windows = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.array_join(F.slice("_tok", i * (size - overlap) + 1, F.lit(size)), ""),
    )
    return _emit(cut, windows)


def preview_chunks(chunks: DataFrame, n: int) -> DataFrame:
    """First `n` chunks of the whole list (all when -1), each with the total."""
    first = chunks.orderBy("doc_id", "chunk_no")
    shown = first if n == -1 else first.limit(n)
    return shown.withColumn("total", chunks.agg(F.count(F.lit(1))).scalar())


def chunk_id(source: Column, index: Column, content: Column) -> Column:
    return F.substring(
        F.sha2(F.concat_ws(":", source.cast("string"), index.cast("string"), content.substr(1, 120)), 256), 1, 32
    )


def store_chunks(chunks: DataFrame, new_chunks: DataFrame, stores: DataFrame, utf16: bool = False
                 ) -> tuple[DataFrame, DataFrame]:
    """Replace the chunks of the loaders found in `new_chunks`; totals and status per store.

    `chunks` and `new_chunks`: store_id, doc_id, chunk_no, page_content, metadata.
    `stores`: store_id, loader_id, status - one row per loader.
    """
    replaced = new_chunks.select("store_id", "doc_id").distinct()
    fresh = new_chunks.withColumn("page_content", F.replace("page_content", F.lit("\u0000"), F.lit("")))
    kept = chunks.join(replaced, ["store_id", "doc_id"], "left_anti").unionByName(fresh)
    size = text.utf16_length(F.col("page_content")) if utf16 else F.length("page_content")
    totals = kept.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("total_chunks"), F.sum(size).cast("bigint").alias("total_chars")
    )
    status = stores.groupBy("store_id").agg(
        F.when(F.bool_and(F.col("status") == "SYNC"), "SYNC").otherwise("STALE").alias("status")
    )
    summary = status.join(totals, "store_id", "left").na.fill(0, ["total_chunks", "total_chars"])
    return kept, summary


def edit_totals(totals: DataFrame, changes: DataFrame) -> DataFrame:
    """Shift store totals by single edits: `changes` has store_id, old_content, new_content (null = removed)."""
    shift = changes.groupBy("store_id").agg(
        F.sum(F.coalesce(F.length("new_content"), F.lit(0)) - F.length("old_content")).alias("_chars"),
        F.sum(F.when(F.col("new_content").isNull(), -1).otherwise(0)).alias("_chunks"),
    )
    zero = F.lit(0)
    return totals.join(shift, "store_id", "left").select(
        *[c for c in totals.columns if c not in ("total_chunks", "total_chars")],
        (F.col("total_chunks") + F.coalesce("_chunks", zero)).alias("total_chunks"),
        (F.col("total_chars") + F.coalesce("_chars", zero)).alias("total_chars"),
    )


def page_chunks(
    chunks: DataFrame, store_id: str, doc_id: str = "all", page: int = 1, size: int = 50
) -> DataFrame:
    """One page ordered by chunk number, with the count and the characters of the whole selection."""
    chosen = chunks.where(F.col("store_id") == store_id)
    if doc_id != "all":
        chosen = chosen.where(F.col("doc_id") == doc_id)
    shown = chosen.orderBy("chunk_no", "doc_id").offset((page - 1) * size).limit(size)
    return shown.withColumns({
        "total": chosen.agg(F.count(F.lit(1))).scalar(),
        "characters": chosen.agg(F.sum(F.length("page_content")).cast("bigint")).scalar(),
    })


def knowledge_digest(
    df: DataFrame, group_by: Sequence[str] = (), order_by: str = "doc_id", max_chars: int = 1400
) -> DataFrame:
    """Stripped texts joined by a rule and cut to `max_chars`.

    Each text adds at least one character and the rule of seven, so only the first
    `max_chars / 8 + 2` texts of a group can matter; the row limit is applied before the shuffle.
    """
    keys = list(group_by)
    enough = max_chars // 8 + 2
    body = df.select(
        *keys, order_by, text.stripped(F.col("page_content")).substr(1, max_chars + 1).alias("_t")
    ).where("_t <> ''")
    if not keys:
        body, keys = body.withColumn("_all", F.lit(0)), ["_all"]
    first = body.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(order_by))).where(
        F.col("_rn") <= enough
    )
    joined = first.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rn", "_t"))), lambda s: s["_t"]),
                     "\n\n---\n\n").alias("_d")
    )
    cut = F.concat(F.regexp_replace(F.col("_d").substr(1, max_chars - 3), r"(?U)\s+$", ""), F.lit("..."))
    return joined.withColumn(
        "digest", F.when(F.length("_d") <= max_chars, F.col("_d")).otherwise(cut)
    ).drop("_d", "_all")
