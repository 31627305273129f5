"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, Hamming check.

A fingerprint is cut into five blocks of bits.  Two fingerprints that differ in at most three
bits agree in at least two blocks whole, so each fingerprint is listed under its ten pairs of
blocks and only those that share a pair are compared.  Keys of 25 or 26 bits keep the buckets
of unrelated fingerprints small on large corpora.

Equal fingerprints are merged before anything is joined.  A bucket of many different
fingerprints (a large family of near copies) is cut into slices by hash, and every pair of
slices is compared in a task of its own; a task gives a spanning forest of the links it finds,
not all pairs, which leaves the components as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import component_of
from tidemark.llm.tables import documents_of, stored

SEED = 42
SLICE = 1024


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """64-bit SimHash as a signed long; null text counts as a text without words."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import re

        import xxhash

        lower = str.maketrans(upper, upper.lower())
        gaps = re.compile("[\x20\x09-\x0d]+")
        digest = xxhash.xxh64_intdigest

        def of(text):
            if not text:
                return 0
            words = [w for w in gaps.split(text.translate(lower)) if w]
            if not words:
                return 0
            if len(words) < width:
                shingles = [" ".join(words)]
            else:
                shingles = list(map(" ".join, zip(*(words[k:] for k in range(width)))))
            counts = np.zeros(64, np.int64)
            for lo in range(0, len(shingles), 16384):
                block = shingles[lo:lo + 16384]
                hashes = np.fromiter((digest(s, SEED) for s in block), dtype="<u8", count=len(block))
                bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            set_bits = (counts * 2 > len(shingles)).astype(np.uint8)
            return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])

        for batch in texts:
            yield pd.Series([of(t) for t in batch], dtype="int64")

    return fingerprint(text)


def _block_keys(fingerprint: Column, distance: int) -> Column:
    """One struct (which blocks, their bits) for each choice of blocks that must agree."""
    n_blocks = distance + 2
    bounds = [64 * k // n_blocks for k in range(n_blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(bounds, bounds[1:])]
    keys = []
    for number, chosen in enumerate(combinations(range(n_blocks), n_blocks - distance)):
        mask = sum(masks[k] for k in chosen)
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.struct(F.lit(number).alias("blocks"), fingerprint.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def _forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that span the components of the values at most `distance` bits apart."""
    if len(values) == 2:
        close = int(np.bitwise_count(values[0] ^ values[1])) <= distance
        return [(int(values.view(np.int64)[0]), int(values.view(np.int64)[1]))] if close else []
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    n = len(values)
    label = np.arange(n)
    while True:
        lower = np.where(near, label[None, :], n).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    signed = values.view(np.int64)
    return [(int(signed[i]), int(signed[label[i]])) for i in range(n) if label[i] != i]


def _links_in_cells(distance: int):
    """Rows sorted by cell to links; only the rows of one cell are held, at most two slices."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = np.empty((0, 4), np.int64), True

        def emit(rows):
            if not len(rows):
                return None
            starts = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
            ends = np.r_[starts[1:], len(rows)]
            found = []
            for lo, hi in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                found += _forest(np.ascontiguousarray(rows[lo:hi, 3]).view(np.uint64), distance)
            if not found:
                return None
            a, b = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            new = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], axis=1)
            held = np.concatenate([held, new])
            if not len(held):
                continue
            last = (held[:, :3] != held[-1, :3]).any(axis=1)
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            done, held = held[:cut], held[cut:]
            if (out := emit(done)) is not None:
                yield out
        if (out := emit(held)) is not None:
            yield out

    return links


def near_links(fingerprints: DataFrame, distance: int = 3, slice_rows: int = SLICE) -> DataFrame:
    """Links `a`, `b` whose components are those of all pairs at most `distance` bits apart.

    `fingerprints`: distinct values in a column `fp`.
    """
    listed = fingerprints.select("fp", F.explode(_block_keys(F.col("fp"), distance)).alias("k")).select("fp", "k.*")
    shared = (
        listed.groupBy("blocks", "bits").agg(F.count("*").alias("n")).where("n > 1")
        .select("blocks", "bits", F.ceil(F.col("n") / slice_rows).cast("int").alias("n_slices"))
    )
    sliced = (
        listed.join(shared, ["blocks", "bits"])
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n_slices")).cast("int"))
    )
    # a row meets every slice of its bucket; cell = (smaller slice, larger slice)
    cells = sliced.select(
        "blocks", "bits", "fp",
        F.explode(F.transform(
            F.sequence(F.lit(0), F.col("n_slices") - 1),
            lambda other: (F.least("own", other) * F.col("n_slices") + F.greatest("own", other)).cast("long"),
        )).alias("cell"),
    )
    ordered = (
        cells.select(F.col("blocks").cast("long"), "bits", "cell", "fp")
        .repartition("blocks", "bits", "cell").sortWithinPartitions("blocks", "bits", "cell")
    )
    return ordered.mapInArrow(_links_in_cells(distance), T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    ]))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, text_hash.

    component_id is the smallest doc_id reachable over fingerprints at most `distance` bits apart.
    Null and empty texts have fingerprint zero and link like any other.  Rows with a null doc_id
    link too; they give no component_id, and a component of null ids only has a null one.
    Repeated rows come out repeated.  An empty table gives no rows.
    """
    docs = documents_of(df, id_col, text_col)
    prints = stored(docs.select(
        "doc_id", fingerprint_column(F.col("text"), width).alias("fp"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    ))
    known = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    members = component_of(near_links(known.select("fp"), distance))
    labelled = known.join(members.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        "component", "text_hash",
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """The rows of `df`, all columns, that stay when one document of each component is kept.

    The document with the smallest doc_id stays (a null id only where the component has no other);
    of repeated rows of it one stays.
    """
    groups = near_duplicates(df, id_col, text_col, width, distance)
    keep = groups.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("kept")
    ).select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_hash").alias("kept_hash"))
    own_hash = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                      F.col(f"`{id_col}`").alias("row_id"), own_hash.alias("row_hash"))
    kept = whole.join(
        keep, whole["row_id"].eqNullSafe(keep["kept_id"]) & (whole["row_hash"] == keep["kept_hash"]), "left_semi",
    ).dropDuplicates(["row_id", "row_hash"])
    return kept.select("row.*")
