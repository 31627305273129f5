"""Line dedup by content-defined chunks of lines, in DataFrame expressions only.

Every line has a hash; a rolling hash over the hashes of a line and the one before it chooses the
lines a chunk may end with.  Of neighbouring choices the first one counts, and neither the first line
nor the last is cut off alone, so every chunk of a text of two and more lines has at least two, and an
exact copy of such a text goes whole.  The cuts depend on the lines around them only, so a passage of
several lines is cut alike wherever it stands.  Chunks of two and more lines that occur more
than once are compared byte by byte (their text is a grouping key); the first occurrence by
(doc_id, position) stays, the others are removed.

Repeats are found by hashes alone, with partial counts, so a chunk that a third of all documents
hold costs one row per task.  Before texts are shuffled, to compare them or to remove chunks, rows
that cannot match are set aside: the hashes looked for are folded into `BUCKETS` numbers, a table
of at most that many rows that may be broadcast whatever the corpus.  The exact join follows.  With
very many repeats the folded table lets everything pass; the rows found are the same.

The cuts leave the ends of a repeated passage, and short passages without two cuts, where they are.
`dedup_runs` adds an exact check: after the chunks, every two neighbouring lines that no chunk has
settled are a key, so all lines of a repeated run of two and more lines go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of, stored

DIVISOR = 4
LEAST_LINES = 2
BUCKETS = 1 << 20
_BASE = 1_000_003


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, also where it stands in an inner loop."""
    return F.transform(F.array(value), body)[0]


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def chunk_column(text: Column, divisor: int = DIVISOR) -> Column:
    """Array of chunks (pos, n, text): first line, number of lines, and the lines joined.

    Joined by line feeds, the chunks are the whole text.  A null text has no chunk.
    """

    def ends_of(hashes: Column) -> Column:
        last = F.size(hashes) - 1
        at = lambda i: hashes[F.greatest(i, F.lit(0))]
        chosen = lambda i: (i > 0) & ((at(i - 1) * _BASE + at(i)) % divisor == 0)
        return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (chosen(i) & ~chosen(i - 1) & (i < last - 1)))

    def chunks(lines: Column, ends: Column) -> Column:
        def one(end: Column, k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(ends[F.greatest(k - 1, F.lit(0))] + 1)
            return _let(start, lambda lo: F.struct(
                lo.alias("pos"), (end - lo + 1).alias("n"), F.array_join(F.slice(lines, lo + 1, end - lo + 1), "\n").alias("text"),
            ))

        return F.transform(ends, one)

    return _let(F.split(text, "\n", -1), lambda lines: _let(
        F.transform(lines, _line_hash), lambda hashes: _let(ends_of(hashes), lambda ends: chunks(lines, ends))
    ))


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _buckets(df: DataFrame, key: str) -> DataFrame:
    """The buckets that the keys of `df` fall in, BUCKETS rows at most."""
    return F.broadcast(df.select(_bucket(F.col(key)).alias("bucket")).distinct())


def _texts_of_repeats(docs: DataFrame, divisor: int, least_lines: int, more: list[str]) -> DataFrame:
    """doc_id, pos, n, h, text and the columns `more`: the chunks whose hash occurs more than once."""
    chunked = (
        docs.where("doc_id is not null").select("doc_id", *more, F.explode(chunk_column(F.col("text"), divisor)).alias("c"))
        .where(F.col("c.n") >= least_lines).select("doc_id", *more, "c.pos", "c.n", "c.text", F.xxhash64("c.text").alias("h"))
    )
    repeated = stored(chunked.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"))
    return stored(
        chunked.withColumn("bucket", _bucket(F.col("h"))).join(_buckets(repeated, "h"), "bucket", "left_semi")
        .join(repeated, "h", "left_semi").select("doc_id", *more, "pos", "n", "h", "text")
    )


def _first_chunks(texts: DataFrame) -> DataFrame:
    return texts.groupBy("h", "text").agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "pos", "n")).alias("first")
    ).where("times > 1").select("h", "text", "first")


def repeated_chunks(docs: DataFrame, divisor: int = DIVISOR, least_lines: int = LEAST_LINES) -> DataFrame:
    """doc_id, gone: for every document with chunks to remove, the positions and hashes of them."""
    texts = _texts_of_repeats(docs, divisor, least_lines, [])
    later = texts.join(_first_chunks(texts), ["h", "text"]).where("struct(first.doc_id, first.pos) <> struct(doc_id, pos)")
    return later.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "h")).alias("gone"))


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, least_lines: int = LEAST_LINES,
) -> DataFrame:
    """The rows of `df`, all columns, as struct `row`, with `kept_text`, `n_lines`, `n_removed` (lines).

    Rows with a null doc_id or a null text take no part and stay as they are (n_lines 0 for a null
    text).  Rows that share a doc_id count as one document: the same chunk at the same position in
    them is one occurrence.  An empty text is one line.  An empty table gives no rows.
    """
    gone = repeated_chunks(documents_of(df, id_col, text_col), divisor, least_lines)
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), "gone"))
    stays = lambda c: ~F.array_contains("gone", F.struct(c["pos"], F.xxhash64(c["text"]).alias("h")))
    kept = F.filter(chunk_column(F.col("row_text"), divisor), stays)
    return _rows_without(df, id_col, text_col, gone, F.expr("row_id = gone_id"), kept)


def _rows_without(df: DataFrame, id_col: str, text_col: str, gone: DataFrame, same: Column, kept: Column) -> DataFrame:
    """The rows of `df` with the parts `kept` (n, text) of the rows that meet `gone` (gone_id, gone) under `same`."""
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{id_col}`").alias("row_id"),
        F.col(f"`{text_col}`").alias("row_text"), _bucket(F.col(f"`{id_col}`")).alias("bucket"),
    )
    n_lines = F.when(F.col("row_text").isNull(), 0).otherwise(F.size(F.split("row_text", "\n", -1))).cast("long")
    buckets = _buckets(gone, "gone_id")
    untouched = whole.join(buckets, "bucket", "left_anti").select(
        "row", F.col("row_text").alias("kept_text"), n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    joined = whole.join(buckets, "bucket", "left_semi").join(gone, same, "left").select(
        "row", "row_text", "gone", n_lines.alias("n_lines"),
        F.when(F.col("gone").isNotNull(), kept).alias("kept"),
    )
    changed = joined.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("row_text"))
        .otherwise(F.array_join(F.transform("kept", lambda c: c["text"]), "\n")).alias("kept_text"),
        "n_lines",
        F.when(F.col("gone").isNull(), F.lit(0).cast("long"))
        .otherwise(F.col("n_lines") - F.aggregate("kept", F.lit(0).cast("long"), lambda s, c: s + c["n"])).alias("n_removed"),
    )
    return untouched.unionByName(changed)


def pair_column(text: Column) -> Column:
    """Array of pairs (pos, end, text) of neighbouring lines, blank lines between them included; null below two lines."""

    def pairs(lines: Column, full: Column) -> Column:
        def one(k: Column) -> Column:
            lo, hi = full[k], full[k + 1]
            return F.struct(lo.alias("pos"), hi.alias("end"), F.array_join(F.slice(lines, lo + 1, hi - lo + 1), "\n").alias("text"))

        return F.when(F.size(full) > 1, F.transform(F.sequence(F.lit(0), F.size(full) - 2), one))

    return _let(F.split(text, "\n", -1), lambda lines: _let(
        F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: lines[i].rlike("\\S")), lambda full: pairs(lines, full)))


def pairs_of_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """doc_id, mark, pos, end: the pairs of lines inside chunks that stand before, byte by byte, without overlapping."""
    marked = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("mark"))
    texts = _texts_of_repeats(marked, divisor, LEAST_LINES, ["mark"])
    first = _first_chunks(texts)
    later = texts.join(first, ["h", "text"]).where("doc_id <> first.doc_id or pos > first.pos + first.n - 1")
    return later.select("doc_id", "mark", "pos", F.explode(pair_column(F.col("text"))).alias("c")).select(
        "doc_id", "mark", (F.col("pos") + F.col("c.pos")).alias("pos"), (F.col("pos") + F.col("c.end")).alias("end")).distinct()


def repeated_runs(docs: DataFrame) -> DataFrame:
    """gone_id, gone_mark (hash of the text), gone: the numbers of the lines to remove of every such text.

    A pair of lines goes if the same two lines stand before it by (doc_id, position) without
    overlapping it.  The first occurrence of a line is in no such pair, so every line stays once.

    Chunks go first: the pairs inside a chunk that stands before are settled by it.  The pairs left are those at the
    ends of repeated passages and of passages without two cuts; they are compared one by one, which makes the result
    exact.  The first occurrence of a pair is in no chunk that goes, so it is there to be compared with.
    """
    paired = (
        docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("mark"), F.explode(pair_column(F.col("text"))).alias("c"))
        .select("doc_id", "mark", "c.*", F.xxhash64("c.text").alias("h"))
    )
    repeated = stored(paired.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"))
    texts = (
        paired.withColumn("bucket", _bucket(F.col("h"))).join(_buckets(repeated, "h"), "bucket", "left_semi")
        .join(repeated, "h", "left_semi").select("doc_id", "mark", "pos", "end", "h", "text")
    )
    settled = stored(pairs_of_chunks(docs))
    texts = stored(texts.join(settled.select("doc_id", "mark", "pos"), ["doc_id", "mark", "pos"], "left_anti"))
    first = texts.groupBy("h", "text").agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "pos", "end")).alias("first")
    ).where("times > 1").select("h", "text", "first")
    later = texts.join(first, ["h", "text"]).where("doc_id <> first.doc_id or pos > first.end").select("doc_id", "mark", "pos", "end")
    lines = later.unionByName(settled).select(
        F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"), F.explode(F.sequence("pos", "end")).alias("line"))
    return lines.groupBy("gone_id", "gone_mark").agg(F.collect_set("line").alias("gone"))


def dedup_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `dedup_lines`, without every line of a run of two and more lines that stands in the corpus before.

    Blank lines count as parts of the run they stand in; a text of which only blank lines would stay
    loses them too.  Rows that share a doc_id count as one document, as in `dedup_lines`.
    """
    gone = stored(repeated_runs(documents_of(df, id_col, text_col)))

    def kept(lines: Column) -> Column:
        left = F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")),
            lambda i: F.struct(F.lit(1).alias("n"), lines[i].alias("text")))
        return _let(left, lambda parts: F.when(F.exists(parts, lambda c: c["text"].rlike("\\S")), parts).otherwise(F.slice(parts, 1, 0)))

    same = F.expr("row_id = gone_id and xxhash64(row_text) = gone_mark")
    return _rows_without(df, id_col, text_col, gone, same, _let(F.split("row_text", "\n", -1), kept))
