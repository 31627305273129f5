"""Approximate nearest neighbours by a forest of random-projection trees.

Trees: each node splits at the median of the projections of a bounded sample on the direction
between two of its vectors; the forest has TREES * (2^DEPTH - 1) nodes and is sent to every task.
Every vector is indexed: it is listed under its leaf in each tree.

Search: one priority queue per query holds nodes of all trees, the ones that the query is nearest
to (or furthest inside of) first, and gives leaves until they list `share` times the table.  A
leaf and the queries that visit it meet in cells of bounded size, where inner products are exact,
and the best of all cells are ranked again in double precision.

Equal vectors are one candidate: only the smallest ids of them can be among the nearest, so the
`k + 1` smallest are kept with it.  Equal query vectors are searched once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

TREES = 12
DEPTH = 6
SHARE = 1.3
SAMPLE_ROWS = 16_384
CELL = 4096
LEAST = 1024
_SPACE = 1 << 31


def grow(sample: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Directions (trees, nodes, dim) and medians (trees, nodes) of full binary trees."""
    rng = np.random.default_rng(seed)
    nodes = 2 ** depth - 1
    directions, medians = np.zeros((trees, nodes, sample.shape[1])), np.zeros((trees, nodes))
    for t in range(trees):
        node = np.zeros(len(sample), np.int64)
        for n in range(nodes):
            inside = np.flatnonzero(node == n)
            turn = rng.standard_normal(sample.shape[1])
            if len(inside) > 1:
                a, b = sample[rng.choice(inside, 2, replace=False)]
                turn = a - b if np.any(a != b) else turn
            directions[t, n] = turn / np.linalg.norm(turn)
            along = sample[inside] @ directions[t, n]
            medians[t, n] = np.median(along) if len(inside) else 0.0
            node[inside] = 2 * n + 1 + (along > medians[t, n])
    return directions, medians


def _margins(vectors: np.ndarray, forest) -> np.ndarray:
    directions, medians = forest
    flat = directions.reshape(-1, directions.shape[-1])
    return (vectors @ flat.T).reshape(len(vectors), *medians.shape) - medians


def leaves_of(vectors: np.ndarray, forest) -> np.ndarray:
    """Leaf number per vector and tree."""
    margins = _margins(vectors, forest)
    nodes = margins.shape[2]
    at = np.zeros(margins.shape[:2], np.int64)
    while nodes and at.min(initial=nodes) < nodes:
        at = 2 * at + 1 + (np.take_along_axis(margins, at[..., None], 2)[..., 0] > 0)
    return at - nodes


def leaves_to_visit(margins: np.ndarray, sizes: np.ndarray, budget: float) -> list[tuple[int, int]]:
    """Leaves (tree, leaf) of one query from one queue over all trees until they list `budget` rows."""
    nodes = margins.shape[1]
    queue = [(-np.inf, t, 0) for t in range(len(margins))]
    found, listed = [], 0
    while queue and listed < budget:
        far, t, n = heapq.heappop(queue)
        if n >= nodes:
            if sizes[t, n - nodes]:
                found.append((t, n - nodes))
                listed += sizes[t, n - nodes]
            continue
        m = margins[t, n]
        heapq.heappush(queue, (max(far, -m), t, 2 * n + 2))
        heapq.heappush(queue, (max(far, m), t, 2 * n + 1))
    return found


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (doubles) of the rows that take part: id and vector known, finite, not zero.

    Vectors of another length than the commonest (the shorter of equally common ones) take no part.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0"
        " and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(v, x -> x <> 0)"
    )
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))


def nearest(
    df: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, depth: int = DEPTH, share: float = SHARE,
    sample_rows: int = SAMPLE_ROWS, id_col: str = "vec_id", vector_col: str = "embedding", least: int = LEAST,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest by inner product of each row whose id divides by `every`.

    Ties go to the smaller id.  Leaves are visited until they list `share` times the table, and `least` rows per
    tree at least.  Of rows that repeat an id the smallest vector counts.  An empty table gives no rows.
    """
    rows = stored(usable(df, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v")))
    first = Window.partitionBy("v").orderBy("vec_id")
    small = rows.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
    distinct = stored(
        small.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), "v", "ids")
    )
    n = distinct.count()
    sample = distinct.where(F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(_SPACE)) < min(1.0, sample_rows / max(n, 1)) * _SPACE)
    sampled = sample.select("rep", "v").toPandas().sort_values("rep")
    empty = "query_id long, rank int, vec_id long, score double"
    if not n:
        return df.sparkSession.createDataFrame([], empty)
    points = np.stack(sampled["v"].to_numpy()) if len(sampled) else np.zeros((0, 1))
    if not len(points):
        points = np.array([distinct.first()["v"]])
    forest = grow(points, trees, depth)

    def list_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                leaf = leaves_of(np.stack(batch["v"].to_numpy()), forest)
                yield pd.DataFrame({"rep": batch["rep"], "leaves": list(leaf.astype(np.int32))})

    placed = stored(distinct.select("rep", "v").mapInPandas(list_rows, "rep long, leaves array<int>"))
    listed = placed.select("rep", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = np.zeros((trees, 2 ** depth), np.int64)
    for r in listed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():
        sizes[r["tree"], r["leaf"]] = r["n"]
    budget = max(share * n, trees * least)

    def plan_visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            margins = _margins(np.stack(batch["v"].to_numpy()), forest)
            visits = [leaves_to_visit(m, sizes, budget) for m in margins]
            yield pd.DataFrame({
                "query": np.repeat(batch["rep"].to_numpy(), [len(x) for x in visits]),
                "tree": np.array([t for x in visits for t, _ in x], np.int32),
                "leaf": np.array([f for x in visits for _, f in x], np.int32),
            })

    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    asked = stored(
        queries.select(F.col("vec_id").alias("query_id"), "v").join(distinct.select("rep", "v"), "v")
        .select("query_id", "rep")
    )
    query_vectors = distinct.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "v")
    visits = query_vectors.mapInPandas(plan_visits, "query long, tree int, leaf int")
    visit_counts = stored(visits)
    counts = np.zeros((trees, 2 ** depth), np.int64)
    for r in visit_counts.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():
        counts[r["tree"], r["leaf"]] = r["n"]
    # cells of a leaf: slices of its rows times blocks of its queries, each of bounded size
    shape = F.array(*[
        F.array(*[F.struct(F.lit(int(-(-a // CELL)) or 1).alias("s"), F.lit(int(-(-b // CELL)) or 1).alias("b"))
                  for a, b in zip(x, y)]) for x, y in zip(sizes, counts)
    ])
    cut = lambda d: d.withColumn("shape", shape[F.col("tree")][F.col("leaf")])
    left = cut(listed.join(distinct.select("rep", "v"), "rep")).select(
        "tree", "leaf", F.pmod(F.xxhash64("rep"), F.col("shape.s")).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.col("shape.b") - 1)).alias("block"), "rep", "v",
    )
    right = cut(visit_counts.join(query_vectors.withColumnRenamed("rep", "asked"), F.expr("query = asked"))).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("shape.s") - 1)).alias("slice"),
        F.pmod(F.xxhash64("query"), F.col("shape.b")).cast("int").alias("block"), "query", F.col("v").alias("q"),
    )

    def score(vectors: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(asking):
            return pd.DataFrame({"query": [], "rep": [], "score": []}).astype({"query": "int64", "rep": "int64"})
        x, q = np.stack(vectors["v"].to_numpy()), np.stack(asking["q"].to_numpy())
        rep, names = vectors["rep"].to_numpy(), asking["query"].to_numpy()
        take, found = min(len(x), k + 1), []
        for lo in range(0, len(q), 512):
            s = q[lo:lo + 512] @ x.T
            kth = -np.partition(-s, take - 1, axis=1)[:, take - 1]
            # all that may tie with the last one, but for the rounding of the matrix product
            at, which = np.nonzero(s >= (kth - 1e-9 * np.abs(s).max(axis=1))[:, None])
            exact = np.einsum("nd,nd->n", x[which], q[lo + at])
            order = np.lexsort((rep[which], -exact, at))
            at, which, exact = at[order], which[order], exact[order]
            first = np.searchsorted(at, np.arange(len(s)))
            best = np.arange(len(at)) - first[at] < take
            found.append((names[lo + at[best]], rep[which[best]], exact[best]))
        a, b, c = (np.concatenate(p) for p in zip(*found))
        return pd.DataFrame({"query": a, "rep": b, "score": c})

    keys = ["tree", "leaf", "slice", "block"]
    right = right.select(*[F.col(c).alias(f"q_{c}") for c in keys], "query", "q")
    scored = left.groupBy(*keys).cogroup(right.groupBy(*[f"q_{c}" for c in keys])).applyInPandas(score, "query long, rep long, score double")
    best = scored.groupBy("query", "rep").agg(F.max("score").alias("score"))
    # `rep` is the smallest id of its vector, so of equal scores the k + 1 smallest are enough
    first_reps = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    top = best.withColumn("at", F.row_number().over(first_reps)).where(F.col("at") <= k + 1)
    members = top.join(distinct.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (
        members.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("found"))
    )
    others = F.slice(F.filter("found", lambda s: s["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.join(lists, F.expr("rep = query"))
        .select("query_id", F.posexplode(others).alias("rank", "s"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "s.vec_id", "s.score")
    )
