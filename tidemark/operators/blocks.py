"""Score every query against every row without a table of pairs.

A query set of a checked size travels to the rows with the task; beyond that size, queries and
rows are hashed into blocks and slices and meet group by group, each group of bounded size.
Both ways call the same `score(queries, batches)` on Arrow data and return the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Score = Callable[[pa.Table, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

MAX_QUERY_ROWS = 50_000
SLICE_ROWS = 200_000


def _own_columns(df: DataFrame) -> DataFrame:
    """The same columns under new identities, so that both sides may come from one table."""
    return df.select(*[F.col(f"`{c}`").alias(c) for c in df.columns])


def block_join(
    queries: DataFrame,
    rows: DataFrame,
    query_key: str,
    row_key: str,
    score: Score,
    schema: str,
    max_query_rows: int = MAX_QUERY_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    # at most max_query_rows + 1 rows reach the driver
    held = queries.limit(max_query_rows + 1).toArrow()
    if held.num_rows <= max_query_rows:

        def over_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from score(held, batches)

        return rows.mapInArrow(over_rows, schema)

    n_blocks = -(-queries.count() // max_query_rows)
    n_slices = max(1, -(-rows.count() // slice_rows))
    left = _own_columns(queries).withColumns({
        "_block": F.pmod(F.xxhash64(query_key), F.lit(n_blocks)),
        "_slice": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_slices - 1).cast("bigint"))),
    })
    right = _own_columns(rows).withColumns({
        "_slice": F.pmod(F.xxhash64(row_key), F.lit(n_slices)),
        "_block": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))),
    })
    out = schema

    def per_group(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        if not left_table.num_rows or not right_table.num_rows:
            return pa.table({})
        found = list(score(left_table, iter(right_table.to_batches(max_chunksize=10_000))))
        return pa.Table.from_batches(found) if found else pa.table({})

    return (
        left.groupBy("_block", "_slice").cogroup(right.groupBy("_block", "_slice")).applyInArrow(per_group, out)
    )
