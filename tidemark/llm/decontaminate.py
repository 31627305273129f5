"""Benchmark decontamination by latent semantic retrieval, then word order and answer checks.

1. Texts are cut into blocks of 32 words; a passage is a block or two neighbouring blocks.  Terms
   are the words of the benchmark, so a passage is a sparse TF-IDF row over a vocabulary whose
   size the benchmark bounds.  Document frequencies count all passages of all documents.
2. Randomised SVD over all passages: each task multiplies its rows A with a small matrix Q and
   gives its share of A'AQ (vocabulary x rank); the shares are summed in two levels of groups.
   One power step, a QR on the driver (vocabulary x rank numbers) and a second pass give the
   latent directions, scaled to equal variance so that frequent words do not rule the cosine.
3. Search: every passage of every document, and every block at steps of half a block, is projected
   and compared by cosine with all items; an item longer than a passage is asked for whole and in
   pieces of a passage's length, the best of which counts.
   Items above the threshold are checked in the words around the passage: the longest common
   subsequence must cover enough of the item, and of its answer (the last sentence of the item,
   unless a column holds it).  Words outside the vocabulary match no item, so the stored terms of a
   document, in order, are all that the checks need; texts are read once.

The benchmark is the stated query set; it travels with the tasks, so its size is checked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of, stored

BLOCK = 32
HALF = BLOCK // 2
RANK = 128
OVERSAMPLE = 8
#: terms in more blocks than this share are left out, but for the rarest third of each item, six at least
MAX_SHARE = 0.02
KEPT_TERMS = 6
COSINE = 0.4
LCS_SHARE = 0.6
ANSWER_SHARE = 0.5
MAX_BENCHMARK_CHARS = 64_000_000
_CHUNK = 256
_SHORT = 16
_CELLS = 1 << 20
_SALTS = 64


def _tokenizer():
    words = re.compile(r"[^\W_]+")
    return lambda text: words.findall(text.lower())


def read_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", answer_col: str | None = None) -> list:
    """(item_id, words, answer words) of the items that hold a word; raises above MAX_BENCHMARK_CHARS characters."""
    answer = F.col(f"`{answer_col}`") if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(
        F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text"), answer.alias("answer")
    ).where("item_id is not null and text is not null")
    size = rows.agg(F.sum(F.length("text") + F.coalesce(F.length("answer"), F.lit(0)))).first()[0] or 0
    if size > MAX_BENCHMARK_CHARS:
        raise ValueError(f"a benchmark of {size} characters is too large to travel with the tasks; split it")
    tokens, items = _tokenizer(), []
    for r in rows.distinct().orderBy("item_id", "text").collect():
        words = tokens(r["text"])
        if not words:
            continue
        sentences = [tokens(s) for s in re.split(r"[.?!\n]+", r["text"])]
        last = tokens(r["answer"]) if r["answer"] else [s for s in sentences if s][-1]
        items.append((r["item_id"], words, last))
    return items


def _vocabulary(items: list) -> dict[str, int]:
    return {w: k for k, w in enumerate(sorted({w for _, words, last in items for w in (*words, *last)}))}


def _numberer(vocabulary: dict[str, int]):
    """Function from a text to the number of its blocks, the half block of each known term, and the terms, in order.

    A text in Latin-1 is cut by a table of its bytes, which gives the words of the tokenizer.
    """
    tokens, get = _tokenizer(), vocabulary.get
    table = bytes(k if chr(k).isalnum() else 32 for k in range(256))
    narrow = {}
    for word, k in vocabulary.items():
        try:
            narrow[word.encode("latin-1")] = k
        except UnicodeEncodeError:
            pass
    get_narrow = narrow.get

    def number(text):
        try:
            words, known = text.lower().encode("latin-1").translate(table).split() if text else [], get_narrow
        except UnicodeEncodeError:
            words, known = tokens(text), get
        ids = np.fromiter(map(known, words, repeat(-1)), np.int32, len(words))
        at = np.flatnonzero(ids >= 0)
        return max(1, -(-len(ids) // BLOCK)), (at // HALF).astype(np.int32), ids[at]

    return number


def _numbered_batches(vocabulary: dict[str, int]):
    """Function from batches of (doc_id, text) to batches of (doc_id, blocks, at, terms); a null text is one empty block."""

    def number_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, none = _numberer(vocabulary), np.zeros(0, np.int32)
        for batch in batches:
            blocks, at, terms = zip(*map(number, batch.column("text").to_pylist())) if batch.num_rows else ((), (), ())
            offsets = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none, *x]))) for x in (at, terms)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(blocks, pa.int32()), *lists], names=["doc_id", "blocks", "at", "terms"])

    return number_texts


def _flat(batch: pa.RecordBatch):
    """Blocks of a batch in one row: terms, block of each term, and whether a block ends its document."""
    sizes = batch.column("blocks").to_numpy().astype(np.int64)
    base = np.cumsum(sizes) - sizes
    lengths = np.diff(batch.column("terms").offsets.to_numpy())
    at, terms = (batch.column(c).flatten().to_numpy() for c in ("at", "terms"))
    ends = np.zeros(int(sizes.sum()), bool)
    ends[base + sizes - 1] = True
    return terms.astype(np.int64), at // 2 + np.repeat(base, lengths), ends


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 256):
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _stretch_sums(source: np.ndarray, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of source[index] over neighbouring stretches of `counts` rows, all above zero.

    The same numbers as those of add.reduceat, which is slow on short stretches: these are added all at once, their
    n-th rows in step.  The longest come first, so that those with a row left are neighbours.
    """
    out = np.empty((len(counts), source.shape[1]), source.dtype)
    long = np.flatnonzero(counts > _SHORT)
    if len(long):
        inside = np.repeat(counts > _SHORT, counts)
        out[long] = np.add.reduceat(source[index[inside]], np.cumsum(counts[long]) - counts[long], axis=0)
    order = np.argsort(-counts, kind="stable")[len(long):]
    heads, left = (np.cumsum(counts) - counts)[order], -counts[order]
    rest = np.zeros((len(order), source.shape[1]), source.dtype)

    def row(n: int, lo: int, hi: int) -> np.ndarray:
        return source[index[heads[lo:hi] + n]]

    # nine rows and more: the first, then eight in pairs, then one by one
    tall = int(np.searchsorted(left, -8))
    if tall:
        a, b, c, d = (row(n, 0, tall) + row(n + 1, 0, tall) for n in (1, 3, 5, 7))
        rest[:tall] = (a + b) + (c + d)
    for n in range(1, -int(left[0]) if len(order) else 0):
        lo, hi = tall if n < 9 else 0, int(np.searchsorted(left, -n))
        rest[lo:hi] += row(n, lo, hi)
    out[order] = source[index[heads]] + rest
    return out


def _block_sums(source: np.ndarray, terms: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of `source` that a block's terms name, for each of n blocks."""
    counts = np.bincount(block, minlength=n)
    filled = np.flatnonzero(counts)
    out = np.zeros((n, source.shape[1]), source.dtype)
    out[filled] = _stretch_sums(source, terms, counts[filled])
    return out


def _frequencies(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, passages = np.zeros(size, np.int64), 0
        for batch in _pieces(batches):
            terms, block, ends = _flat(batch)
            seen = np.unique(block * size + terms)
            df += np.bincount(seen % size, minlength=size)
            passages += len(ends)
        yield pa.RecordBatch.from_pydict({"term": np.arange(size + 1), "n": np.r_[df, passages]})

    return count


def _gram_share(idf: np.ndarray, q: np.ndarray):
    """Task's share of A'A q over its passages (two neighbouring blocks), cut into chunks of terms."""

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(q.shape, np.float64)
        weighted = (q * idf[:, None]).astype(np.float32)
        for batch in _pieces(batches):
            terms, block, ends = _flat(batch)
            used = idf[terms] > 0
            terms, block = terms[used], block[used]
            if not len(terms):
                continue
            y = _block_sums(weighted, terms, block, len(ends))
            pair = y.copy()
            inner = np.flatnonzero(~ends)
            pair[inner] += y[inner + 1]
            back = pair.copy()
            back[inner + 1] += pair[inner]
            order = np.argsort(terms, kind="stable")
            counts = np.bincount(terms)
            held = np.flatnonzero(counts)
            total[held] += _stretch_sums(back, block[order], counts[held])
        total *= idf[:, None]
        for k in range(0, len(total), _CHUNK):
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k // _CHUNK], pa.int32()), "values": [total[k:k + _CHUNK].tobytes()]})

    return share


def _summed(shares: DataFrame, rank: int) -> np.ndarray:
    """Sum of the tasks' shares, in two levels so that no group holds more than a share of the tasks."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v) for v in group["values"])
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "values": [total.tobytes()]})

    salted = shares.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    kind = "chunk int, values binary"
    first = salted.groupBy("chunk", "salt").applyInPandas(lambda g: add(g), kind)
    rows = first.groupBy("chunk").applyInPandas(lambda g: add(g), kind).orderBy("chunk").collect()
    return np.concatenate([np.frombuffer(r["values"]).reshape(-1, rank) for r in rows])


def numbered(df: DataFrame, items: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, blocks, at, terms of every row, stored."""
    docs = documents_of(df, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.mapInArrow(
        _numbered_batches(_vocabulary(items)), f"doc_id {kind}, blocks int, at array<int>, terms array<int>"))


def learned(rows: DataFrame, items: list, rank: int = RANK) -> dict:
    """Model from the numbered rows: items, vocabulary, weights, and the latent directions of all passages."""
    rows, vocabulary = rows.select("blocks", "at", "terms"), _vocabulary(items)
    size = len(vocabulary)
    if not size:
        return {"items": [], "vocabulary": {}, "weighted": np.zeros((0, 1), np.float32)}
    counted = rows.mapInArrow(_frequencies(size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(size + 1)
    for r in counted:
        n[r["term"]] = r["n"]
    passages = max(n[size], 1)
    idf = (np.log((1 + passages) / (1 + n[:size])) + 0.1).astype(np.float32)
    kept = n[:size] <= MAX_SHARE * passages
    for _, words, _ in items:
        own = sorted({vocabulary[w] for w in words}, key=lambda k: (n[k], k))
        kept[own[:max(KEPT_TERMS, len(own) // 3)]] = True
    idf[~kept] = 0
    width = min(size, rank + OVERSAMPLE)
    q = np.linalg.qr(np.random.default_rng(42).standard_normal((size, width)))[0]
    kind = "chunk int, values binary"
    first = _summed(rows.mapInArrow(_gram_share(idf, q), kind), width) if n[size] else q
    q = np.linalg.qr(first)[0]
    second = _summed(rows.mapInArrow(_gram_share(idf, q), kind), width) if n[size] else q
    small = q.T @ second
    power, turns = np.linalg.eigh((small + small.T) / 2)
    directions, power = q @ turns[:, ::-1][:, :rank], power[::-1][:rank]
    scale = np.where(power > 1e-6 * max(power[0], 1e-12), 1 / np.sqrt(np.maximum(power, 1e-12)), 0)
    weighted = (directions * scale * idf[:, None]).astype(np.float32)
    return {"items": items, "vocabulary": vocabulary, "weighted": weighted, "idf": idf, "directions": directions}


def lcs_length(words: list, masks: dict, length: int) -> int:
    """Longest common subsequence of `words` and a text of `length` words given as bit masks per word."""
    row = full = (1 << length) - 1
    for w in words:
        if m := masks.get(w):
            hit = row & m
            row = (row + hit | row - hit) & full
    return length - row.bit_count()


def word_masks(words: list) -> dict:
    masks: dict = {}
    for k, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def _queries_of(own: list) -> list[list]:
    """The whole item; if it is longer than a passage, also its pieces of a passage's length."""
    wide = 2 * BLOCK
    if len(own) <= wide:
        return [own]
    starts = sorted({*range(0, len(own) - wide + 1, wide), len(own) - wide})
    return [own, *(own[k:k + wide] for k in starts)]


_LEAKS = "array<struct<item_id: long, cosine: double, lcs: double, answer: double>>"


def _searcher(model: dict, cosine: float, lcs: float, answer: float):
    """Function from numbered texts to the leaks of each: (item_id, cosine, lcs, answer), best match per item."""
    items, vocabulary, weighted = model["items"], model["vocabulary"], model["weighted"]
    asked = []
    for item, words, last in items:
        own, end = [vocabulary[w] for w in words], [vocabulary[w] for w in last]
        asked.append((item, own, word_masks(own), len(own), word_masks(end), len(end), 2 * -(-len(own) // BLOCK)))
    used = (weighted != 0).any(axis=1)
    pieces = [_queries_of(own) for _, own, *_ in asked]
    counts = np.array([len(p) for p in pieces], np.int64)
    firsts = np.cumsum(counts) - counts
    aims = np.stack([weighted[q].sum(axis=0) for p in pieces for q in p]) if asked else np.zeros((0, weighted.shape[1]))
    norms = np.linalg.norm(aims, axis=1, keepdims=True)
    aims = np.where(norms > 0, aims / np.maximum(norms, 1e-12), 0).astype(np.float32).T

    reaches = np.array([reach for *_, reach in asked], np.int64)
    sizes_of = np.array([length for _, _, _, length, *_ in asked], np.int64)
    starts_of = np.cumsum(sizes_of) - sizes_of
    words_of = np.array([w for _, own, *_ in asked for w in own], np.int64)
    heavy_of = used[words_of]
    heavy_sizes = np.add.reduceat(heavy_of, starts_of, dtype=np.int64) if asked else sizes_of
    heavy_starts = np.cumsum(heavy_sizes) - heavy_sizes
    all_words, heavy_words = (words_of, starts_of, sizes_of), (words_of[heavy_of], heavy_starts, heavy_sizes)
    # a row per pair: the words its span holds; cells are taken back after use
    width = len(vocabulary)
    most = max(1, _CELLS // max(1, width))
    held = np.zeros(most * width, np.uint8)

    def held_words(terms, begins, ends, of, listed):
        """How many of an item's words the terms begins..ends hold."""
        words, starts, sizes = listed
        out = np.zeros(len(of), np.int64)
        for lo in range(0, len(of), most):
            k, begin, n = of[lo:lo + most], begins[lo:lo + most], (ends - begins)[lo:lo + most]
            row = np.arange(len(k)) * width
            cells = terms[np.arange(n.sum()) + np.repeat(begin - (n.cumsum() - n), n)] + np.repeat(row, n)
            held[cells] = 1
            n = sizes[k]
            last = n.cumsum()
            own = words[np.arange(last[-1]) + np.repeat(starts[k] - (last - n), n)] + np.repeat(row, n)
            upto = np.append(0, held[own].cumsum(dtype=np.int32))
            out[lo:lo + most] = upto[last] - upto[last - n]
            held[cells] = 0
        return out

    def enough_common(terms, edges, weighty, weighty_edges, lows, highs, of):
        """Whether an item and the terms from lows to highs have so many words in common; no subsequence is longer.

        Few do, and the frequent words without weight are most of the words, so those of weight are counted first, the
        others taken for held.
        """
        counts = held_words(weighty, weighty_edges[lows], weighty_edges[highs], of, heavy_words)
        out = counts + (sizes_of - heavy_sizes)[of] >= lcs * sizes_of[of]
        lows, highs, of = lows[out], highs[out], of[out]
        out[out] = held_words(terms, edges[lows], edges[highs], of, all_words) >= lcs * sizes_of[of]
        return out

    def check(terms, edges, lo, hi, k, best, cos, spans):
        item, own, masks, length, last_masks, last, reach = asked[k]
        if reach not in spans:
            spans[reach] = terms[edges[max(0, lo - reach)]:edges[min(len(edges) - 1, hi + reach)]]
        span = spans[reach]
        share = lcs_length(span, masks, length) / length
        if share < lcs:
            return
        known = lcs_length(span, last_masks, last) / last
        if known >= answer and (k not in best or (share, known, cos) > best[k][1:]):
            best[k] = (item, share, known, cos)

    def search(texts):
        found: list[dict] = [{} for _ in texts]
        sizes = np.array([2 * n for n, _, _ in texts], np.int64)
        base = np.cumsum(sizes) - sizes
        lengths = np.array([len(t) for _, _, t in texts], np.int64)
        terms = np.concatenate([*(t for _, _, t in texts), np.zeros(0, np.int32)]).astype(np.int64)
        block = np.concatenate([*(at for _, at, _ in texts), np.zeros(0, np.int32)]) + np.repeat(base, lengths)
        heavy = used[terms]
        weighty = terms[heavy]
        z = _block_sums(weighted, weighty, block[heavy], int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        after = (base + sizes)[owner]
        spot = np.arange(len(z))
        blocks = z[:-1] + z[1:]
        edges, weighty_edges = (np.searchsorted(x, np.arange(len(z) + 1)) for x in (block, block[heavy]))
        ordered: dict[int, tuple] = {}
        for wide, places in ((2, spot[spot + 2 <= after]), (4, spot[(spot + 4 <= after) & (spot % 2 == 0)])):
            for lo in range(0, len(places), 8192):
                where = places[lo:lo + 8192]
                part = blocks[where] if wide == 2 else blocks[where] + blocks[where + 2]
                size = np.linalg.norm(part, axis=1)
                near = part @ aims
                if near.shape[1] > len(asked):
                    near = np.maximum.reduceat(near, firsts, axis=1)
                close = near >= (cosine * size)[:, None]
                close[size == 0] = False
                rows, of = np.nonzero(close)
                own_at = where[rows]
                lows = np.maximum(own_at - reaches[of], base[owner[own_at]])
                highs = np.minimum(own_at + wide + reaches[of], after[own_at])
                likely = enough_common(terms, edges, weighty, weighty_edges, lows, highs, of)
                last = -1
                for p, k in zip(rows[likely].tolist(), of[likely].tolist()):
                    if p != last:
                        last, spans = p, {}
                        doc = int(owner[where[p]])
                        start = int(where[p] - base[doc])
                        if doc not in ordered:
                            n, at, own = texts[doc]
                            ordered[doc] = own.tolist(), np.searchsorted(at, np.arange(2 * n + 1)).tolist()
                    check(*ordered[doc], start, start + wide, k, found[doc], float(near[p, k] / size[p]), spans)
        return [
            [{"item_id": i, "cosine": c, "lcs": s, "answer": a} for i, s, a, c in (best[k] for k in sorted(best))]
            for best in found
        ]

    return search if asked else lambda texts: [[] for _ in texts]


def leak_column(model: dict, text: Column, cosine: float = COSINE, lcs: float = LCS_SHARE, answer: float = ANSWER_SHARE) -> Column:
    """Array of (item_id, cosine, lcs, answer): the items whose passage a text holds, best match each.

    Null, empty and wordless texts hold none.  Items of equal text are reported each.
    """

    @F.pandas_udf(_LEAKS)
    def leaks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        number, search = _numberer(model["vocabulary"]), _searcher(model, cosine, lcs, answer)
        for batch in texts:
            yield pd.Series([
                x for lo in range(0, len(batch), 256) for x in search([number(t) for t in batch.iloc[lo:lo + 256]])])

    return leaks(text)


def stored_leak_column(model: dict, cosine: float = COSINE, lcs: float = LCS_SHARE, answer: float = ANSWER_SHARE) -> Column:
    """The same of the stored columns blocks, at and terms."""

    @F.pandas_udf(_LEAKS)
    def leaks(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        search = _searcher(model, cosine, lcs, answer)
        for blocks, at, terms in rows:
            texts = list(zip(blocks.tolist(), at, terms))
            yield pd.Series([x for lo in range(0, len(texts), 256) for x in search(texts[lo:lo + 256])])

    return leaks("blocks", "at", "terms")


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer: a row per input row and item that it leaks.

    Empty tables on either side give no rows; repeated rows come out repeated; ids may be null.
    """
    items = read_items(benchmark)
    rows = numbered(df, items, id_col, text_col)
    found = rows.select("doc_id", stored_leak_column(learned(rows, items)).alias("leaks"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def without_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `df`, all columns, whose text leaks no item of the benchmark."""
    items = read_items(benchmark)
    rows = numbered(df.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("text")), items)
    return df.where(F.size(leak_column(learned(rows, items), F.col(f"`{text_col}`"))) == 0)
