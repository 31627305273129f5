"""Hard negatives by best-first search of an STR-packed R-tree.

Index: vectors are scaled to integers and dealt into tiles, first by quantiles of the coordinate that
varies most, then, inside a slab, by quantiles of the next one.  A tile that holds more than twice its
share, of equal vectors say, is split by a hash of the ids.  In a tile, sort-tile-recursive packing by
label and further coordinates fills leaf pages of PAGE rows.  A page is one row of the stored index: its
ids, labels and vectors as bytes, and its bounding box.  Every vector is indexed.

Search: a task reads the pages of its range as a stream and builds the inner nodes over some hundred of
them at a time.  The box of a node bounds the inner product with an anchor coordinate by coordinate.  One
queue per anchor gives the node with the highest reachable score first; a node goes when its box lies
outside all score windows of the anchor, or strictly below the kth score found in each.  What was
found in earlier pages of the task counts too, so a task returns k rows per anchor and window at most.

Anchors come in blocks of bounded size, which lead the pages of every range.  Positives are searched
first, with an open window; their scores give the windows of the search for negatives.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

PAGE = 64
FANOUT = 16
TILE_ROWS = 4096
BLOCK = 16_384
#: slabs and tiles per slab at most; beyond that, tiles are split by hash
MAX_CUTS = 512
TREE_PAGES = 1024
SCALE = 256
#: larger scaled components could overflow the inner product, a long
LARGEST = 1 << 24
_FAR = np.iinfo(np.int64).max // 4


def scaled(df: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """vec_id, label, q (longs) of the rows that take part, one row per id."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v")).where(
        "vec_id is not null and label is not null and v is not null and size(v) > 0"
        f" and forall(v, x -> x is not null and not isnan(x) and abs(x * {SCALE}) <= {LARGEST})"
    )
    q = rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).cast("array<long>").alias("q"))
    sizes = q.groupBy(F.size("q").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    same = q.where(F.size("q") == (sizes["n"] if sizes else 0))
    return same.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")


def _cuts(n: int) -> list[float]:
    return [k / n for k in range(1, n)]


def tiled(rows: DataFrame, dims: int, tile_rows: int) -> DataFrame:
    """Add `tile` and `part`: quantile slabs of two coordinates, large tiles split by hash."""
    n = rows.count()
    spread = rows.agg(*[F.var_pop(F.col("q")[k]).alias(f"v{k}") for k in range(dims)]).first()
    first, second = (sorted(range(dims), key=lambda k: -spread[k]) * 2)[:2]
    side = min(MAX_CUTS, max(1, round((n / tile_rows) ** 0.5)))
    keyed = rows.withColumns({"x": F.col("q")[first], "y": F.col("q")[second]})
    below = lambda cuts, value: F.size(F.filter(cuts, lambda c: c < value)).cast("long")
    if side > 1:
        slabs = keyed.agg(F.percentile_approx("x", _cuts(side), 10_000).alias("c")).first()["c"]
        keyed = keyed.withColumn("slab", below(F.array(*[F.lit(int(c)) for c in slabs]), F.col("x")))
        # at most MAX_CUTS rows of MAX_CUTS numbers
        inner = keyed.groupBy("slab").agg(F.percentile_approx("y", _cuts(side), 10_000).alias("c"))
        keyed = keyed.join(F.broadcast(inner), "slab").withColumn("tile", F.col("slab") * side + below(F.col("c"), F.col("y")))
    else:
        keyed = keyed.withColumn("tile", F.lit(0).cast("long"))
    # at most MAX_CUTS * MAX_CUTS rows of two numbers
    sizes = keyed.groupBy("tile").agg(F.ceil(F.count("*") / (2 * tile_rows)).alias("parts"))
    return keyed.join(F.broadcast(sizes), "tile").select(
        "vec_id", "label", "q", "tile", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"))


def str_order(keys: np.ndarray, page: int) -> np.ndarray:
    """Order of rows by sort-tile-recursive packing over the columns of `keys`."""
    n, dims = keys.shape
    order = np.argsort(keys[:, 0], kind="stable")
    pages = -(-n // page)
    if dims == 1 or pages <= 1:
        return order
    slabs = int(np.ceil(pages ** (1 / dims)))
    size = -(-pages // slabs) * page
    return np.concatenate([order[lo:lo + size][str_order(keys[order[lo:lo + size], 1:], page)] for lo in range(0, n, size)])


def _packed(q: np.ndarray) -> bytes:
    small = np.abs(q).max(initial=0) <= 32_767
    return q.astype("<i2" if small else "<i4").tobytes()


def _unpacked(raw: bytes, rows: int, dims: int) -> np.ndarray:
    kind = "<i2" if len(raw) == 2 * rows * dims else "<i4"
    return np.frombuffer(raw, kind).reshape(rows, dims).astype(np.int64)


_PAGE_SCHEMA = "ids binary, labels binary, vectors binary, lo binary, hi binary"


def paged(rows: DataFrame, dims: int, page: int = PAGE, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The leaf pages of all rows: tile, part, and `_PAGE_SCHEMA`; little-endian numbers."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        labels = table.column("label").to_numpy()
        q = table.column("q").combine_chunks().flatten().to_numpy().reshape(len(ids), dims)
        widest = np.argsort(-q.var(axis=0), kind="stable")[:2]
        by_id = np.argsort(ids, kind="stable")
        ids, labels, q = ids[by_id], labels[by_id], q[by_id]
        order = str_order(np.column_stack([labels, q[:, widest]]), page)
        cells = [order[lo:lo + page] for lo in range(0, len(order), page)]
        out = {
            "tile": [key[0].as_py()] * len(cells), "part": [key[1].as_py()] * len(cells),
            "ids": [ids[c].astype("<i8").tobytes() for c in cells], "labels": [labels[c].astype("<i8").tobytes() for c in cells],
            "vectors": [_packed(q[c]) for c in cells], "lo": [q[c].min(axis=0).astype("<i4").tobytes() for c in cells],
            "hi": [q[c].max(axis=0).astype("<i4").tobytes() for c in cells],
        }
        return pa.table({k: pa.array(v, pa.int64() if k in ("tile", "part") else pa.binary()) for k, v in out.items()})

    return tiled(rows, dims, tile_rows).groupBy("tile", "part").applyInArrow(pack, f"tile long, part long, {_PAGE_SCHEMA}")


class Tree:
    """Inner nodes over neighbouring pages; level 0 are the pages."""

    def __init__(self, pages: list[tuple], dims: int):
        self.pages = pages
        lo = np.stack([np.frombuffer(p[3], "<i4") for p in pages]).astype(np.int64)
        hi = np.stack([np.frombuffer(p[4], "<i4") for p in pages]).astype(np.int64)
        labels = [np.frombuffer(p[1], "<i8") for p in pages]
        first, last = np.array([x.min() for x in labels]), np.array([x.max() for x in labels])
        least = np.array([np.frombuffer(p[0], "<i8").min() for p in pages])
        self.levels = [(lo, hi, first, last, least)]
        while len(self.levels[-1][0]) > FANOUT:
            lo, hi, first, last, least = self.levels[-1]
            at = np.arange(0, len(lo), FANOUT)
            self.levels.append((
                np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.minimum.reduceat(first, at),
                np.maximum.reduceat(last, at), np.minimum.reduceat(least, at)))
        self.rows: dict[int, tuple] = {}
        self.dims = dims

    def leaf(self, k: int) -> tuple:
        if k not in self.rows:
            ids, labels = (np.frombuffer(self.pages[k][c], "<i8") for c in (0, 1))
            self.rows[k] = ids, labels, _unpacked(self.pages[k][2], len(ids), self.dims)
        return self.rows[k]


class Anchor:
    """One anchor with its score windows and the best rows found in each, as sorted (-score, id)."""

    def __init__(self, key: int, label: int, q: np.ndarray, windows: list[tuple[int, int]], same: bool, k: int):
        self.key, self.label, self.q, self.windows, self.same, self.k = key, label, q, windows, same, k
        self.up, self.down = np.maximum(q, 0), np.minimum(q, 0)
        self.found: list[list[tuple[int, int]]] = [[] for _ in windows]

    def reach(self, low: int, high: int, least: int) -> int | None:
        """Highest score that a box within [low, high] can still add to a window, None for nothing."""
        best = None
        for (floor, ceiling), found in zip(self.windows, self.found):
            top = min(high, ceiling)
            if top < floor or low > ceiling:
                continue
            if len(found) == self.k:
                kth, last = -found[-1][0], found[-1][1]
                # an equal score can only win by a smaller id
                if top < kth or (top == kth and least > last):
                    continue
            best = top if best is None else max(best, top)
        return best

    def take(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        fits = (labels == self.label) == self.same
        fits &= ids != self.key
        scores = vectors @ self.q
        for w, (floor, ceiling) in enumerate(self.windows):
            found = self.found[w]
            least = floor if len(found) < self.k else max(floor, -found[-1][0])
            at = np.flatnonzero(fits & (scores >= least) & (scores <= ceiling))
            if len(at):
                self.found[w] = heapq.nsmallest(self.k, [*found, *zip((-scores[at]).tolist(), ids[at].tolist())])

    def search(self, tree: Tree) -> None:
        """Best first over the nodes of one tree."""
        queue: list[tuple] = []

        def push(level: int, start: int, end: int) -> None:
            lo, hi, first, last, least = (x[start:end] for x in tree.levels[level])
            high, low = (hi @ self.up + lo @ self.down).tolist(), (lo @ self.up + hi @ self.down).tolist()
            if self.same:
                open_ = (first <= self.label) & (self.label <= last)
            else:
                open_ = (first != self.label) | (last != self.label)
            for k in np.flatnonzero(open_).tolist():
                top = self.reach(low[k], high[k], int(least[k]))
                if top is not None:
                    heapq.heappush(queue, (-top, level, start + k, low[k], high[k], int(least[k])))

        top = len(tree.levels) - 1
        push(top, 0, len(tree.levels[top][0]))
        while queue:
            _, level, k, low, high, least = heapq.heappop(queue)
            if self.reach(low, high, least) is None:
                continue
            if level:
                push(level - 1, k * FANOUT, (k + 1) * FANOUT)
            else:
                self.take(*tree.leaf(k))


def _searched(pages: DataFrame, anchors: DataFrame, dims: int, same: bool, k: int, ranges: int, block: int) -> DataFrame:
    """anchor_id, window, vec_id, score: the best `k` rows of each range of pages for every window.

    Anchors: vec_id, label, q, windows (array of structs low, high).
    """
    blocks = max(1, -(-anchors.count() // block))
    every = lambda name, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    none = F.lit(None)
    left = pages.select(
        F.pmod(F.xxhash64("tile", "part"), F.lit(ranges)).cast("int").alias("range"), every("block", blocks), F.lit(1).alias("kind"),
        "tile", "part", *[c.split()[0] for c in _PAGE_SCHEMA.split(", ")], none.cast("long").alias("anchor_id"),
        none.cast("long").alias("label"), none.cast("array<long>").alias("q"), none.cast("array<struct<low: long, high: long>>").alias("windows"))
    right = anchors.select(
        every("range", ranges), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"),
        none.cast("long").alias("tile"), none.cast("long").alias("part"),
        *[none.cast("binary").alias(c.split()[0]) for c in _PAGE_SCHEMA.split(", ")],
        F.col("vec_id").alias("anchor_id"), "label", "q", "windows")
    dealt = left.unionByName(right).repartition("range", "block").sortWithinPartitions(
        "range", "block", "kind", "tile", "part", "anchor_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, waiting = None, [], []

        def settle() -> None:
            if waiting and held:
                tree = Tree(waiting, dims)
                for anchor in held:
                    anchor.search(tree)
            waiting.clear()

        def result() -> pa.RecordBatch:
            rows = [(a.key, w, i, -s) for a in held for w, found in enumerate(a.found) for s, i in found]
            columns = list(zip(*rows)) or [[]] * 4
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["anchor_id", "window", "vec_id", "score"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for r in batch.slice(lo, 256).to_pylist():
                    if (r["range"], r["block"]) != current:
                        settle()
                        if held:
                            yield result()
                        current = r["range"], r["block"]
                    if r["kind"]:
                        waiting.append((r["ids"], r["labels"], r["vectors"], r["lo"], r["hi"]))
                        if len(waiting) == TREE_PAGES:
                            settle()
                    else:
                        windows = [(w["low"], w["high"]) for w in r["windows"]]
                        held.append(Anchor(r["anchor_id"], r["label"], np.array(r["q"], np.int64), windows, same, k))
        settle()
        if held:
            yield result()

    return dealt.mapInArrow(work, "anchor_id long, window int, vec_id long, score long")


def hard_negatives(
    df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80, label: Column | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding", page: int = PAGE, tile_rows: int = TILE_ROWS,
    block: int = BLOCK, ranges: int | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id divides by `every`; a score is the inner product of components
    floor(256 * x).  Each anchor has its `positives` best other rows of its label; each of these has the
    `negatives` best rows of other labels that score from `percent` % of it up to it.  Higher scores
    come first, ties by smaller id.  A positive without such a row gives no rows.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part;
    neither do empty vectors, vectors of another length than the commonest (the shorter of equally common
    ones), nor components beyond `LARGEST`, whose products no long can hold.  Of rows that repeat
    an id the smallest label, then vector, counts.  Vectors are of any length.  Equal vectors are
    each a candidate.  Other columns are not looked at.  An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = stored(scaled(df, id_col, vector_col, F.col("label") if label is None else label))
    some = rows.select(F.size("q").alias("n")).first()
    if some is None:
        return spark.createDataFrame([], (
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))
    dims = some["n"]
    pages = stored(paged(rows, dims, page, tile_rows))
    anchors = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    # fixed for a cluster, so that rows returned grow with the anchors only
    ranges = ranges or min(64, spark.sparkContext.defaultParallelism)

    def ranked(found: DataFrame, n: int) -> DataFrame:
        order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    open_window = F.array(F.struct(F.lit(-int(_FAR)).alias("low"), F.lit(int(_FAR)).alias("high")))
    near = stored(ranked(_searched(
        pages, anchors.withColumn("windows", open_window), dims, True, positives, ranges, block), positives))
    # the least long with percent * positive <= 100 * low; div cuts towards zero
    spans = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("high"),
        F.expr(f"{percent} * score div 100 + int({percent} * score % 100 > 0)").alias("low")))).alias("spans"))
    asked = anchors.join(spans, F.expr("vec_id = anchor_id")).select(
        "vec_id", "label", "q", F.transform("spans", lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high"))).alias("windows"))
    found = ranked(_searched(pages, asked, dims, False, negatives, ranges, block), negatives)
    positive = near.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
    return found.join(positive, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
