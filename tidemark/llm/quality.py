"""Quality classifier: hashed word and character n-gram vectors, averaged, softmax, numpy SGD.

A text is read as UTF-8 bytes, case and marks kept.  Every white-space separated word and every
run of 3 and of 4 bytes is hashed into a table of `BUCKETS` learned vectors; a document is the
mean of the vectors of all of them.  Two outputs go through a softmax.

The fit reads a sample of labelled documents, at most about `per_class` for either label, as
counts of buckets.  After the fit the vectors are folded with the output weights into one number
per bucket (512 KB), so scoring is one table look-up for each word and n-gram of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of, fold

BITS = 17
BUCKETS = 1 << BITS
WIDTHS = (3, 4)
PER_CLASS = 1500
_PRIME = 0x01000193
_SPACE = 1 << 31


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint32(salt)) * np.uint32(0x9E3779B1)
    return (h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)


def bucket_blocks(text: str) -> Iterator[np.ndarray]:
    """Buckets of all words and n-grams of a text, in blocks of bounded size."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    step = 1 << 20
    for n in WIDTHS:
        for lo in range(0, max(0, len(data) - n + 1), step):
            part = data[lo:lo + step + n - 1]
            h = part[:len(part) - n + 1].copy()
            for k in range(1, n):
                h = h * np.uint32(_PRIME) + part[k:len(part) - n + 1 + k]
            yield _mix(h, 0x51ED27 * n & 0xFFFFFFFF)
    inside = data > 32
    if inside.any():
        edge = np.diff(np.r_[0, inside.astype(np.int8), 0])
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at = np.arange(len(data)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
        powers = np.cumprod(np.r_[1, np.full(63, _PRIME)].astype(np.uint32), dtype=np.uint32)
        terms = np.where(inside, (data + np.uint32(1)) * powers[at & 63], np.uint32(0))
        sums = np.add.reduceat(terms, starts, dtype=np.uint32)
        yield _mix(sums + (ends - starts).astype(np.uint32), 0x7F4A7C15)


def _bucket_counts(text: Column) -> Column:
    """Buckets of a whole text and how often each occurs."""

    @F.pandas_udf("buckets array<int>, counts array<int>")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                total = np.zeros(BUCKETS, np.int64)
                for found in bucket_blocks(text or ""):
                    total += np.bincount(found, minlength=BUCKETS)
                at = np.flatnonzero(total)
                rows.append((at.astype(np.int32), np.minimum(total[at], 2**31 - 1).astype(np.int32)))
            yield pd.DataFrame({"buckets": [r[0] for r in rows], "counts": [r[1] for r in rows]})

    return counted(text)


def train(documents: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 16, epochs: int = 8, rate: float = 2.0,
          seed: int = 42) -> tuple[np.ndarray, float]:
    """One number per bucket and an offset, from (buckets, counts, label); zeros without both labels."""
    if len({d[2] for d in documents}) < 2:
        only = documents[0][2] if documents else 1
        return np.zeros(BUCKETS, np.float32), 2.0 if only else -2.0
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    weights, offset = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(documents), 0
    for _ in range(epochs):
        for k in rng.permutation(len(documents)):
            buckets, counts, label = documents[k]
            speed = rate * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ vectors[buckets]
            z = mean @ weights + offset
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = weights @ p
            weights -= speed * np.outer(mean, p)
            offset -= 0.1 * speed * p
            vectors[buckets] -= speed * np.sqrt(share)[:, None] * back[None, :]
    turn = weights[:, 1] - weights[:, 0]
    return (vectors @ turn).astype(np.float32), float(offset[1] - offset[0])


def learned(documents: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, per_class: int = PER_CLASS) -> dict:
    """Model from the labelled documents outside the held-out fold.

    A doc_id with several labels counts with the smallest; null ids, null labels and other values
    than 0 and 1 are left out.  Without labels of both kinds the model gives one score to all.
    """
    known = (
        labels.where("doc_id is not null and quality in (0, 1)").where(fold("doc_id", folds) != held)
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, per_class / n))).otherwise(share)
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(_SPACE)) < share * _SPACE)
    docs = documents_of(documents)
    # the sample is bounded by per_class, so it may be sent to every task
    rows = (
        docs.join(F.broadcast(sample.withColumnRenamed("doc_id", "labelled")), F.expr("doc_id = labelled"))
        .select("doc_id", "label", _bucket_counts(F.col("text")).alias("b")).select("doc_id", "label", "b.*").toPandas()
    )
    rows = rows.sort_values("doc_id", kind="stable")
    numbers, offset = train([
        (np.asarray(b, np.int64), np.asarray(c, np.float32), int(y))
        for b, c, y in zip(rows["buckets"], rows["counts"], rows["label"])
    ])
    return {"numbers": numbers, "offset": offset}


def score_column(model: dict, text: Column) -> Column:
    numbers, offset = model["numbers"], model["offset"]

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def of(text):
            total, n = 0.0, 0
            for found in bucket_blocks(text or ""):
                total += float(numbers[found].sum(dtype=np.float64))
                n += len(found)
            z = total / max(n, 1) + offset
            return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))

        for batch in texts:
            yield pd.Series([of(t) for t in batch], dtype="float64")

    return score(text)


def score_documents(df: DataFrame, model: dict, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted per input row.

    Null and empty texts get the score of the offset alone; repeated rows come out repeated.
    """
    scored = documents_of(df).select("doc_id", score_column(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )
