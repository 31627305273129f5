"""Ordered numbering, running sums and neighbours that survive a hot group.

A plain window sends every row of a group to one task.  Here the rows are dealt out once by ranges of
(group, order) and written to the shared folder, so a group of any size lies in neighbouring slices.
A window works inside a slice; what a group has in the slices before is added.  At most one group
runs over each border between two slices, so the table of carried values has no more rows than
there are slices, whatever the data looks like.  That table alone reaches the driver and is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.sources.scratch import written_table


def slice_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add `_ord_slice`: the range of (keys, order) a row lies in, ascending; read once and stored."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys, *order)
    return written_table(ranged.withColumn("_ord_slice", F.spark_partition_id()))


def _carry(
    sliced: DataFrame, keys: Sequence[str], what: Column, carried: Callable[[list], list], out: str
) -> DataFrame:
    """Add `out`: for rows of a group in several slices, `carried` of the group's values per slice in order."""
    per_slice = sliced.groupBy(*keys, "_ord_slice").agg(what.alias("_ord_value"))
    spanning = per_slice.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_ord_slice", "_ord_value"))).alias("_ord_parts")
    ).where(F.size("_ord_parts") > 1)
    value_type = per_slice.schema["_ord_value"].dataType
    rows = [
        Row(*[group[k] for k in keys], part["_ord_slice"], value)
        for group in spanning.collect()
        for part, value in zip(group["_ord_parts"], carried([p["_ord_value"] for p in group["_ord_parts"]]))
    ]
    if not rows:
        return sliced.withColumn(out, F.lit(None).cast(value_type))
    fields = [StructField(f"_ord_k{i}", sliced.schema[k].dataType) for i, k in enumerate(keys)]
    schema = StructType([*fields, StructField("_ord_s", IntegerType()), StructField(out, value_type)])
    # two rows per border between slices at most
    table = F.broadcast(sliced.sparkSession.createDataFrame(rows, schema))
    cond = sliced["_ord_slice"] == table["_ord_s"]
    for i, k in enumerate(keys):
        cond = cond & sliced[k].eqNullSafe(table[f"_ord_k{i}"])
    return sliced.join(table, cond, "left").drop("_ord_s", *[f"_ord_k{i}" for i in range(len(keys))])


def _directed(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(keys)) if keys else (df.withColumn("_ord_all", F.lit(0)), ["_ord_all"])


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "pos",
    descending: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Exact 1-based row number per group as bigint."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), out, descending, slices)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    descending: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Exact running sum of `value` up to and including each row; `order` must be unique in a group."""
    keyed, keys = _keyed(df.withColumn("_ord_add", value), keys)
    sliced = slice_rows(keyed, keys, order, slices)

    def before(sums: list) -> list:
        steps = [s if s is not None else 0 for s in (reversed(sums) if descending else sums)]
        totals = [0 * steps[0], *list(accumulate(steps))[:-1]]
        return totals[::-1] if descending else totals

    carried = _carry(sliced, keys, F.sum("_ord_add"), before, "_ord_before")
    inside = (
        Window.partitionBy("_ord_slice", *keys).orderBy(*_directed(order, descending))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    total = F.sum("_ord_add").over(inside)
    return carried.withColumn(
        out, F.when(F.col("_ord_before").isNull(), total).otherwise(F.coalesce(total, F.lit(0)) + F.col("_ord_before"))
    ).drop("_ord_add", "_ord_before", "_ord_slice", "_ord_all")


def next_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, slices: int | None = None
) -> DataFrame:
    """Value of the following row of the group, null for the last one."""
    keyed, keys = _keyed(df, keys)
    sliced = slice_rows(keyed, keys, order, slices)
    head = F.min_by(F.struct(F.col(value).alias("v")), F.struct(*order))
    carried = _carry(sliced, keys, head, lambda heads: [*heads[1:], None], "_ord_head")
    inside = Window.partitionBy("_ord_slice", *keys).orderBy(*order)
    return carried.withColumn(
        out, F.coalesce(F.lead(F.struct(F.col(value).alias("v"))).over(inside), F.col("_ord_head"))["v"]
    ).drop("_ord_head", "_ord_slice", "_ord_all")


PART_CHARS = 1_000_000


def in_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: Column, part_chars: int, slices: int | None = None
) -> DataFrame:
    """Add `part`: the characters (`size`) of the group before the row, divided by `part_chars`.

    The rows of a part begin within `part_chars` characters, so a part is bounded by that and one row.  Numbers
    ascend; a row longer than `part_chars` leaves a gap.
    """
    sized = df.withColumn("_size", F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")))
    summed = running_sum(sized, keys, order, F.col("_size"), "_upto", slices=slices)
    return summed.withColumn("part", F.expr(f"(_upto - _size) div {int(part_chars)}")).drop("_upto", "_size")


def with_part_count(parts: DataFrame, keys: Sequence[str], rows: DataFrame) -> DataFrame:
    """Add `n_parts`, the number of parts of each group of `rows`."""
    counts = rows.select(*keys, "part").groupBy(*keys).agg(F.count_distinct("part").alias("n_parts"))
    renamed = counts.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & parts[k].eqNullSafe(renamed[f"_k{i}"])
    return parts.join(renamed, cond).drop(*[f"_k{i}" for i in range(len(keys))])


def join_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: str,
    sep: str,
    out: str,
    part_chars: int = PART_CHARS,
    size: Column | None = None,
    slices: int | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Join the texts of a group in order, in parts (see `in_parts`) with their number `n_parts`.

    No task ever sees a whole hot group; the parts put together with `sep` are the full text.  A consumer
    that needs the whole text of groups known to be small sets `part_chars` above their size.
    """
    length = F.length(F.col(text)) + len(sep) if size is None else size
    numbered = in_parts(df, keys, order, length, part_chars, slices)
    texts = F.transform(
        F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(text).alias("_x")))),
        lambda s: s["_x"])
    parts = numbered.groupBy(*keys, "part").agg(F.array_join(texts, sep).alias(out), *extra)
    return with_part_count(parts, keys, numbered)


def page(df: DataFrame, order: Sequence[Column], page_no: int, size: int) -> DataFrame:
    """One page of a global order; a top-n per partition, never a full sort."""
    if page_no <= 0 or size <= 0:
        return df
    skipped = (page_no - 1) * size
    return df.orderBy(*order).offset(skipped).limit(size) if skipped else df.orderBy(*order).limit(size)
