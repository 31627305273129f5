"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is an aggregation with partial sums and a join on one endpoint, so a node with
very many links is split by AQE and never gathered.  The number of rounds grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        F.countDistinct("a").alias("d"),
    ).first()
    return row["n"], row["s"], row["d"]


def component_of(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Links `a`, `b` (long) to rows `node`, `component` (smallest node of the component).

    Nodes without a link to another node are not listed.  Self links and repeated links are harmless; an
    empty table gives an empty result.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(links)
    for _ in range(max_rounds):
        links = stored(_small_star(_large_star(links)))
        after = _state(links)
        # the links are stars when every node points to one root and nothing moved
        if after == before and after[0] == after[2]:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
