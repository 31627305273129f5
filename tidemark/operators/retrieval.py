"""Batch retrieval: a table of queries against a table of vectors or documents.

Queries: query_id, embedding (and text, filter where named).  Vectors: vec_id, embedding, more columns.
Results: query_id, vec_id, distance, rank.  Ties go to the smaller id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import jsons, text
from tidemark.operators.blocks import MAX_QUERY_ROWS, block_join
from tidemark.operators.ordering import PART_CHARS, join_in_parts
from tidemark.session import spread
from tidemark.sources.scratch import written_table

METRICS = ("cosine", "ip", "l2")
MAX_QUERY_BYTES = 256 << 20
DIGITS = 9  # distances are rounded to this before they are ranked
_TILE = 1_000_000  # cells of one distance matrix
_KEPT_ROWS = 200_000  # rows gathered at least before they are cut to the best


# ---- scoring inside a task -------------------------------------------------------------------

def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as float64."""
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    blocks = [p.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(p), -1) for p in parts if len(p)]
    if len(blocks) == 1:
        return blocks[0]
    return np.concatenate(blocks) if blocks else np.zeros((0, 0))


def _thin(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, where a row is a long list."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _mask(column: pa.Array) -> np.ndarray:
    """Rows of a list column of booleans."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _distances(metric: str, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    if metric == "cosine":
        return 1.0 - _unit(q) @ _unit(v).T
    if metric == "ip":
        return -(q @ v.T)
    square = (q * q).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2.0 * (q @ v.T)
    return np.sqrt(np.maximum(square, 0.0))


class _Best:
    """The k smallest (distance, id) per query and group seen so far.

    Rows are plain arrays; they are cut as soon as they are twice as many as the last cut left, so memory follows
    queries x k, not the rows that are scored.
    """

    def __init__(self, k: int) -> None:
        self.k = k
        self.groups: dict = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0
        self.limit = _KEPT_ROWS

    def add(self, q: np.ndarray, d: np.ndarray, ids: np.ndarray, group: str = "") -> None:
        g = np.full(len(q), self.groups.setdefault(group, len(self.groups)), dtype=np.int32)
        self.parts.append((q.astype(np.int32), g, d, ids))
        self.rows += len(q)
        if self.rows > self.limit:
            self.parts = [self._cut()]
            self.rows = len(self.parts[0][0])
            self.limit = max(_KEPT_ROWS, 2 * self.rows)

    def _cut(self) -> tuple[np.ndarray, ...]:
        q, g, d, ids = (np.concatenate(column) for column in zip(*self.parts))
        order = np.lexsort((pd.factorize(ids, sort=True)[0] if ids.dtype == object else ids, d, g, q))
        q, g = q[order], g[order]
        first = np.ones(len(q), dtype=bool)
        first[1:] = (q[1:] != q[:-1]) | (g[1:] != g[:-1])
        starts = np.flatnonzero(first)
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        kept = place < self.k
        order = order[kept]
        return q[kept], g[kept], d[order], ids[order]

    def cut(self) -> dict[str, np.ndarray]:
        q, g, d, ids = self._cut()
        return {"q": q, "g": np.array(list(self.groups), dtype=object)[g], "d": d, "id": ids}


def _scorer(k: int, metric: str, id_type, group_type, filters: bool):
    """`score` for block_join: the k best rows of a partition for every query."""

    def score(queries: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = queries.column("query_id")
        q_all = _matrix(queries.column("embedding"))
        wanted = queries.column("_wanted").to_numpy() if filters else None
        best = _Best(k)
        for batch in batches:
            if not batch.num_rows or not len(q_all):
                continue
            v_all = _matrix(batch.column("embedding"))
            v_ids = batch.column("vec_id").to_pandas().to_numpy()
            groups = batch.column("_group").to_pandas() if "_group" in batch.schema.names else None
            mask = _mask(batch.column("_mask")) if filters else None
            members = [(None, np.arange(len(v_all)))] if groups is None else list(groups.groupby(groups).indices.items())
            for group, at in members:
                for lo in range(0, len(q_all), max(1, _TILE // max(1, len(at)))):
                    q = q_all[lo: lo + max(1, _TILE // max(1, len(at)))]
                    v = v_all[at]
                    dist = np.round(_distances(metric, q, v), DIGITS)
                    if filters:
                        dist[~mask[at][:, wanted[lo: lo + len(q)]].T] = np.inf
                    if dist.shape[1] > k:
                        slack = 1e-6 if metric == "l2" else 0.0
                        cut = np.partition(dist, k - 1, axis=1)[:, k - 1: k] + slack
                        qi, vi = np.nonzero((dist <= cut) & np.isfinite(dist))
                    else:
                        qi, vi = np.nonzero(np.isfinite(dist))
                    d = dist[qi, vi]
                    if metric == "l2":  # the matrix form loses digits near zero
                        d = np.round(np.linalg.norm(q[qi] - v[vi], axis=1), DIGITS)
                    best.add(qi + lo, d + 0.0, v_ids[at][vi], group or "")
        if best.rows:
            found = best.cut()
            columns = {
                "query_id": ids.take(pa.array(found["q"])).combine_chunks(),
                "vec_id": pa.array(found["id"], type=id_type),
                "distance": pa.array(found["d"]),
            }
            if group_type is not None:
                columns["_group"] = pa.array(found["g"], type=group_type)
            yield pa.RecordBatch.from_pydict(columns)

    return score


def _type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[_type_of(df, name)]


def _search(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    metric: str,
    group: bool = False,
    filters: bool = False,
    max_query_rows: int = MAX_QUERY_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}")
    if k < 1:
        raise ValueError("k starts at 1")
    usable = vectors.where(F.col("embedding").isNotNull())
    asked = queries.where(F.col("embedding").isNotNull())
    first = asked.select(F.size("embedding").alias("dim")).head(1)
    if first:  # a held query set stays below the byte bound, whatever the dimension
        max_query_rows = max(1, min(max_query_rows, MAX_QUERY_BYTES // (8 * max(1, first[0].dim))))
    schema = f"query_id {_type_of(queries, 'query_id')}, vec_id {_type_of(vectors, 'vec_id')}, distance double"
    if group:
        schema += ", _group string"
    score = _scorer(k, metric, _arrow_type(vectors, "vec_id"), pa.string() if group else None, filters)
    options = {} if slice_rows is None else {"slice_rows": slice_rows}
    partial = block_join(asked, usable, "query_id", "vec_id", score, schema, max_query_rows, **options)
    keys = ["query_id", "_group"] if group else ["query_id"]
    order = Window.partitionBy(*keys).orderBy("distance", "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# ---- operators -------------------------------------------------------------------------------

def knn_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 4,
    metric: str = "cosine",
    max_query_rows: int = MAX_QUERY_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """The k nearest vectors of every query.  Rows without content leave after the limit."""
    found = _search(
        queries.select("query_id", "embedding"), vectors.select("vec_id", "embedding"), k, metric,
        max_query_rows=max_query_rows, slice_rows=slice_rows,
    )
    if "page_content" in vectors.columns:
        empty = vectors.where(F.col("page_content").isNull()).select("vec_id")
        found = found.join(empty, "vec_id", "left_anti")
    return found.select("query_id", "vec_id", "distance", "rank")


def score_normalize(score: Column, metric: str) -> Column:
    """Distances and similarities to 0..1."""
    if metric == "l2":
        return 1 / (1 + score)
    if metric in ("ip", "cosine"):
        return (score + 1) / 2
    raise ValueError(f"metric is one of {METRICS}")


def knn_filtered(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 4,
    pre: Column | None = None,
    post: Column | None = None,
    include_embeddings: bool = False,
    metric: str = "cosine",
) -> DataFrame:
    """Filter, search, filter again; the pre filter runs in the scan."""
    chosen = vectors if pre is None else vectors.where(pre)
    found = knn_topk(queries, chosen, k, metric).join(chosen, "vec_id")
    if post is not None:
        found = found.where(post)
    return found if include_embeddings else found.drop("embedding")


def score_threshold(queries: DataFrame, vectors: DataFrame, min_pct: float = 80, max_k: int = 20) -> DataFrame:
    """At most `max_k` results with a cosine similarity of at least `min_pct` percent."""
    found = knn_topk(queries, vectors, max_k).withColumn("score", F.round(1 - F.col("distance"), DIGITS))
    return found.where(F.col("score") >= min_pct / 100)


def embeddings_filter(candidates: DataFrame, threshold: float | None = 0.8, k: int | None = 20) -> DataFrame:
    """Candidates (query_id, vec_id, similarity) above a similarity and among the first k."""
    if threshold is None and k is None:
        raise ValueError("give a threshold, k, or both")
    kept = candidates if threshold is None else candidates.where(F.col("similarity") > threshold)
    if k is None:
        return kept
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def pick_diverse(similarity: np.ndarray, vectors: np.ndarray, k: int, lam: float) -> list[int]:
    """Maximal marginal relevance over one short candidate list; ties go to the earlier one."""
    unit = _unit(vectors)
    pairs = unit @ unit.T
    chosen: list[int] = []
    nearest = np.full(len(similarity), -np.inf)
    while len(chosen) < min(k, len(similarity)):
        penalty = np.where(np.isfinite(nearest), nearest, 0.0)
        value = np.round(lam * similarity - (1 - lam) * penalty, DIGITS) if chosen else np.round(similarity, DIGITS)
        value[chosen] = -np.inf
        best = int(np.argmax(value))
        chosen.append(best)
        nearest = np.maximum(nearest, pairs[:, best])
    return chosen


def mmr(queries: DataFrame, vectors: DataFrame, k: int = 4, fetch_k: int = 20, lam: float = 0.5) -> DataFrame:
    """Pick k of the `fetch_k` nearest, each far from those picked before.  A group holds fetch_k rows."""
    candidates = knn_topk(queries, vectors, fetch_k).join(vectors.select("vec_id", "embedding"), "vec_id")

    gathered = candidates.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "distance", "embedding"))).alias("c"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _thin(batches):
            lists = batch.column("c")
            rows = lists.flatten()
            ids, distances = rows.field("vec_id"), rows.field("distance").to_numpy()
            vectors, ends = _matrix(rows.field("embedding")), np.cumsum([0, *lists.value_lengths().to_pylist()])
            chosen = [
                lo + np.array(pick_diverse(1.0 - distances[lo:hi], vectors[lo:hi], k, lam), dtype=np.int64)
                for lo, hi in zip(ends, ends[1:])
            ]
            at = np.concatenate(chosen) if chosen else np.zeros(0, dtype=np.int64)
            owner = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
            yield pa.RecordBatch.from_pydict({
                "query_id": batch.column("query_id").take(pa.array(owner)),
                "vec_id": ids.take(pa.array(at)),
                "distance": distances[at],
                "rank": pa.array(np.concatenate([np.arange(1, len(c) + 1) for c in chosen] or [at]), type=pa.int32()),
            })

    schema = f"query_id {_type_of(queries, 'query_id')}, vec_id {_type_of(vectors, 'vec_id')}, distance double, rank int"
    return gathered.mapInArrow(pick, schema)


def rrf_fuse(ranked: DataFrame, c: float = 60, top_k: int = 4) -> DataFrame:
    """Reciprocal rank fusion of several lists: group_id, list_id, doc_id, rank (from 1)."""
    fused = ranked.groupBy("group_id", "doc_id").agg(F.round(F.sum(1 / (F.col("rank") + F.lit(c))), 12).alias("score"))
    order = Window.partitionBy("group_id").orderBy(F.col("score").desc(), "doc_id")
    return fused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)


def multi_query_union(ranked: DataFrame) -> DataFrame:
    """Each document once per group, with its best rank over the phrasings."""
    return ranked.groupBy("group_id", "doc_id").agg(F.min("rank").alias("best_rank"))


def posting_index(docs: DataFrame) -> DataFrame:
    """Inverted index of documents (doc_id, page_content), written once: token, doc_id, tf, length.

    `length` is the number of words of the document.  Every document also has one row with an empty token, so
    that those without a word are counted; no word is empty.  A null text has no words.  Rows are sorted by token
    inside a file, so a scan for few words skips row groups.  `doc_id` is the key of a document.
    """
    tokens = docs.select("doc_id", F.coalesce(text.words(F.col("page_content")), F.array().cast("array<string>")).alias("_t"))
    postings = (
        tokens.select("doc_id", F.size("_t").alias("length"), F.explode(F.concat(F.array(F.lit("")), "_t")).alias("token"))
        .groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("tf"), F.max("length").alias("length"))
    )
    return written_table(postings.select("token", "doc_id", "tf", "length").sortWithinPartitions("token"))


def _query_postings(queries: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words of the queries with their weights, and what each document gains by those it holds (k1 1.2, b 0.75)."""
    asked = queries.select("query_id", F.explode(F.array_distinct(text.words(F.col("text")))).alias("token"))
    everything = index.where(F.col("token") == "")
    stats = everything.agg(F.count(F.lit(1)).alias("_n"), F.avg("length").alias("_mean"))
    held = index.where(F.col("token") != "").join(asked.select("token").distinct(), "token", "left_semi")
    frequency = held.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    size, mean = stats.select("_n").scalar(), stats.select("_mean").scalar()
    idf = F.log(1 + (size - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = asked.join(frequency, "token").groupBy("query_id").agg(
        F.collect_list(F.struct("token", idf.alias("idf"))).alias("_asked"))
    norm = 1.2 * (0.25 + 0.75 * F.col("length") / mean)
    gains = held.groupBy("doc_id").agg(
        F.collect_list(F.struct("token", (F.col("tf") * 2.2 / (F.col("tf") + norm)).alias("gain"))).alias("_held"))
    return weights, gains


class _Askers:
    """Which query asks for which word, and scores of documents by the postings they hold of these words."""

    def __init__(self, queries: pa.Table) -> None:
        lists = queries.column("_asked").combine_chunks()
        entries = lists.flatten()
        self.owner = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
        self.idf = entries.field("idf").to_numpy()
        self.words = entries.field("token").unique()
        self.codes = pc.index_in(entries.field("token"), value_set=self.words).to_numpy(zero_copy_only=False).astype(np.int64)

    def hits(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word number, row and gain of every posting of a batch."""
        lists = batch.column("_held")
        entries = lists.flatten()
        rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
        # looked up in Arrow: no text becomes an object of Python
        words = pc.index_in(entries.field("token"), value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = words >= 0
        return words[known], rows[known], entries.field("gain").to_numpy()[known]

    def scores(self, lo: int, hi: int, hits: tuple[np.ndarray, np.ndarray, np.ndarray], n_rows: int) -> np.ndarray:
        """BM25 of the queries lo to hi against the rows: every posting meets the queries that ask for its word."""
        words, rows, gains = hits
        first, last = np.searchsorted(self.owner, (lo, hi))
        order = np.argsort(self.codes[first:last], kind="stable") + first
        starts = np.searchsorted(self.codes[order], np.arange(len(self.words) + 1))
        number = np.diff(starts)[words]
        which = np.repeat(np.arange(len(words)), number)
        step = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        asker = order[starts[words[which]] + step]
        cells = (self.owner[asker] - lo) * n_rows + rows[which]
        return np.bincount(cells, self.idf[asker] * gains[which], (hi - lo) * n_rows).reshape(hi - lo, n_rows)


_HYBRID_TILE = 1 << 17  # cells scored at once; a cell costs as many entries as query and row share words


def _hybrid_parts(queries: pa.Table, batches: Iterator[pa.RecordBatch]):
    """(first query, batch, keyword scores, vector scores) by tiles of queries."""
    askers, asked = _Askers(queries), _matrix(queries.column("embedding"))
    for batch in _thin(batches):
        if not len(asked):
            continue
        vectors, hits = _matrix(batch.column("embedding")), askers.hits(batch)
        step = max(1, _HYBRID_TILE // batch.num_rows)
        for lo in range(0, len(asked), step):
            hi = min(len(asked), lo + step)
            yield lo, batch, askers.scores(lo, hi, hits, batch.num_rows), 1.0 - _distances("cosine", asked[lo:hi], vectors)


def _hybrid_ranges(queries: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest and largest keyword and vector score per query over one partition."""
    low, high = np.full((2, queries.num_rows), np.inf), np.full((2, queries.num_rows), -np.inf)
    for lo, _, *parts in _hybrid_parts(queries, batches):
        for i, part in enumerate(parts):
            at = slice(lo, lo + len(part))
            low[i, at] = np.minimum(low[i, at], part.min(1))
            high[i, at] = np.maximum(high[i, at], part.max(1))
    if np.isfinite(low).all() and queries.num_rows:
        yield pa.RecordBatch.from_pydict(
            {"query_id": queries.column("query_id").combine_chunks(), "kmin": low[0], "kmax": high[0],
             "vmin": low[1], "vmax": high[1]})


def _hybrid_scorer(k: int, ratio: float, id_type):
    def score(queries: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        ends = {name: queries.column(name).to_numpy() for name in ("kmin", "kmax", "vmin", "vmax")}

        def scale(values: np.ndarray, kind: str, at: slice) -> np.ndarray:
            low, high = ends[f"{kind}min"][at, None], ends[f"{kind}max"][at, None]
            return np.where(high > low, (values - low) / np.where(high > low, high - low, 1.0), 0.0)

        for lo, batch, keyword, vector in _hybrid_parts(queries, batches):
            at = slice(lo, lo + len(vector))
            value = np.round(ratio * scale(vector, "v", at) + (1 - ratio) * scale(keyword, "k", at), DIGITS)
            if value.shape[1] > k:
                qi, vi = np.nonzero(-value <= np.partition(-value, k - 1, axis=1)[:, k - 1: k])
            else:
                qi, vi = np.nonzero(np.ones_like(value, dtype=bool))
            ids = batch.column("doc_id").to_pandas().to_numpy()
            best.add(qi + lo, -value[qi, vi], ids[vi])
        if best.rows:
            found = best.cut()
            yield pa.RecordBatch.from_pydict({
                "query_id": queries.column("query_id").take(pa.array(found["q"])).combine_chunks(),
                "doc_id": pa.array(found["id"], type=id_type),
                "score": pa.array(-found["d"] + 0.0),
            })

    return score


def hybrid_search(
    queries: DataFrame, docs: DataFrame, k: int = 4, ratio: float = 0.75, max_query_rows: int = 4096,
    index: DataFrame | None = None,
) -> DataFrame:
    """Weighted sum of BM25 and cosine, each scaled to 0..1 per query over all documents.

    `ratio` is the vector share, kept within 0..1.  Queries: query_id, text, embedding;
    documents: doc_id (their key), page_content, embedding; those without a vector take no part.
    Texts are tokenised once, by `posting_index`; pass the `index` of the same documents to search it again.
    Only postings of query words are shuffled, to their document, so their number does not grow with the queries
    that share a word.
    """
    ratio = min(max(ratio, 0.0), 1.0)
    usable = docs.where(F.col("embedding").isNotNull())
    if index is None:
        index = posting_index(usable)
    weights, gains = _query_postings(queries, index)
    # both are read twice below; the first is as small as the queries
    asked = queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding")
    prepared = written_table(asked.join(weights, "query_id", "left"))
    rows = spread(written_table(usable.select("doc_id", "embedding").join(gains, "doc_id", "left")))
    key_type = _type_of(queries, "query_id")
    ranges = block_join(
        prepared, rows, "query_id", "doc_id", _hybrid_ranges,
        f"query_id {key_type}, kmin double, kmax double, vmin double, vmax double", max_query_rows,
    ).groupBy("query_id").agg(
        F.min("kmin").alias("kmin"), F.max("kmax").alias("kmax"), F.min("vmin").alias("vmin"), F.max("vmax").alias("vmax")
    )
    partial = block_join(
        prepared.join(ranges, "query_id"), rows, "query_id", "doc_id",
        _hybrid_scorer(k, ratio, _arrow_type(docs, "doc_id")),
        f"query_id {key_type}, doc_id {_type_of(docs, 'doc_id')}, score double", max_query_rows,
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lexical_overlap(query: Column, content: Column) -> Column:
    """Share of the distinct query words found in the content."""
    wanted = F.array_distinct(text.words(query))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(wanted, text.words(content))), F.size(wanted)), F.lit(0.0))


def rerank(
    candidates: DataFrame,
    scorer: Callable[[pd.Series, pd.Series], pd.Series] | None = None,
    k: int = 4,
) -> DataFrame:
    """Order candidates (query_id, query_text, vec_id, page_content, rank) by a scorer and keep k.

    `scorer` gets the query texts and the contents of a batch.  Where it fails, the input order stays.
    """
    if scorer is None:
        scored = candidates.withColumn("score", lexical_overlap(F.col("query_text"), F.col("page_content")))
    else:

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                try:
                    score = scorer(batch["query_text"], batch["page_content"])
                except Exception:
                    score = None
                yield batch.assign(score=score)

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.schema)
        scored = candidates.mapInPandas(run, f"{fields}, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), "rank", "vec_id")
    return scored.withColumn("new_rank", F.row_number().over(order)).where(F.col("new_rank") <= k)


MAX_FILTERS = 2048
_PAIRS = "array<struct<key:string,value:string>>"


def extracted_filter_search(
    queries: DataFrame, vectors: DataFrame, base_filter: dict[str, str] | None = None, k: int = 4,
    metric: str = "cosine", max_query_rows: int = MAX_QUERY_ROWS, max_filters: int = MAX_FILTERS,
) -> DataFrame:
    """Search with one filter per query: `filter` map over the base filter, the map wins.

    Vectors carry `metadata` JSON; all keys of a filter must be equal as text.  Every distinct filter is one bit
    of a mask, which a column expression gives each vector before anything is scored.  Above `max_filters`
    distinct ones, queries are dealt by the hash of their filter into rounds of about that many.
    """
    base = F.from_json(F.lit(_json_text(base_filter)), "map<string,string>")
    merged = F.when(F.col("filter").isNull(), base).otherwise(jsons.override(base, F.col("filter")))
    pairs = F.array_sort(F.map_entries(merged)).cast(_PAIRS)
    ready = queries.select("query_id", "embedding", pairs.alias("_pairs"))
    tags = F.from_json("metadata", "map<string,string>")
    distinct = ready.select("_pairs").distinct()
    rounds = max(1, -(-distinct.count() // max_filters))
    found: DataFrame | None = None
    for number in range(rounds):
        here = F.pmod(F.xxhash64("_pairs"), F.lit(rounds)) == number
        rules = [[p.asDict() for p in r["_pairs"]] for r in distinct.where(here).collect()]
        known = F.from_json(F.lit(jsons.dump(rules)), f"array<{_PAIRS}>")
        mask = F.transform(known, lambda rule: F.forall(
            rule, lambda pair: F.try_element_at(F.col("_tags"), pair["key"]).eqNullSafe(pair["value"])))
        asked = ready.where(here).select("query_id", "embedding", (F.array_position(known, F.col("_pairs")) - 1).alias("_wanted"))
        masked = vectors.select("vec_id", "embedding", tags.alias("_tags")).select("vec_id", "embedding", mask.alias("_mask"))
        part = _search(asked, masked, k, metric, filters=True, max_query_rows=max_query_rows)
        found = part if found is None else found.unionByName(part)
    return found


def _json_text(value: dict | None) -> str:
    return jsons.dump({key: str(v) for key, v in (value or {}).items()})


def format_results(content: Column, metadata: Column, template: str) -> Column:
    """Fill `{{context}}` and `{{metadata.a.b}}`; a path the metadata lacks stays as written."""
    parts = re.split(r"(\{\{context\}\}|\{\{metadata\.[\w.]+\}\})", template)
    parsed = F.try_parse_json(metadata)
    pieces: list[Column] = []
    for part in parts:
        if part == "{{context}}":
            pieces.append(content)
        elif part.startswith("{{metadata."):
            value = F.try_variant_get(parsed, jsons.spark_path(part[len("{{metadata."):-2].split(".")), "variant")
            pieces.append(F.coalesce(jsons.variant_text(value), F.lit(part)))
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces) if pieces else F.lit("")


def join_context(
    results: DataFrame, sep: str = "\n", with_metadata: bool = False, part_chars: int = PART_CHARS
) -> DataFrame:
    """Contents of a query's results by rank as one text, or as a JSON list with metadata."""
    if not with_metadata:
        return join_in_parts(results, ["query_id"], ["rank"], "page_content", sep, "context", part_chars)
    item = F.concat(
        F.regexp_replace(F.to_json(F.struct(F.col("page_content").alias("pageContent"))), r"\}$", ""),
        F.lit(',"metadata":'), F.col("metadata"), F.lit("}"),
    )
    joined = join_in_parts(results.withColumn("_item", item), ["query_id"], ["rank"], "_item", ",", "context", part_chars, F.length("page_content"))
    return joined.withColumn("context", F.concat(F.lit("["), F.col("context"), F.lit("]")))


def multi_store_search(
    queries: DataFrame,
    vectors: DataFrame,
    store: Column,
    k: int = 4,
    mode: str = "all",
    stores: Sequence[str] | None = None,
    metric: str = "cosine",
) -> DataFrame:
    """k results of every store; `last` keeps those of the last store of the list only."""
    named = vectors.select("vec_id", "embedding", store.cast("string").alias("_group"))
    if stores is not None:
        named = named.where(F.col("_group").isin(list(stores)))
    if mode == "last":
        last = F.lit(stores[-1]) if stores else named.agg(F.max("_group")).scalar()
        named = named.where(F.col("_group") == last)
    elif mode != "all":
        raise ValueError("mode is all or last")
    return _search(queries.select("query_id", "embedding"), named, k, metric, group=True).withColumnRenamed(
        "_group", "store"
    )


def results_to_chunks(results: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunk id and number by equal content within the store, -1 where there is none."""
    by_content = chunks.groupBy("store_id", F.sha2("page_content", 256).alias("_h")).agg(
        F.min(F.struct("chunk_no", "id")).alias("_c")
    )
    return (
        results.withColumn("_h", F.sha2("page_content", 256))
        .join(by_content, ["store_id", "_h"], "left")
        .withColumn("chunk_id", F.col("_c.id"))
        .withColumn("chunk_no", F.coalesce(F.col("_c.chunk_no"), F.lit(-1)))
        .drop("_h", "_c")
    )


def query_stats(results: DataFrame, requested: int) -> DataFrame:
    """Asked for, returned, mean distance and the first 200 characters of the question."""
    shown = [F.min(F.substring(F.trim("query_text"), 1, 200)).alias("preview")] if "query_text" in results.columns else []
    return results.groupBy("query_id").agg(
        F.lit(requested).alias("requested"),
        F.count("vec_id").alias("returned"),
        F.avg("distance").alias("mean_distance"),
        *shown,
    )
