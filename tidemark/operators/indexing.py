"""Incremental indexing: document hashes, the ledger of indexed keys, and caches keyed by content.

Ledger columns: key, namespace, updated_at, group_id, doc_id; unique by (namespace, key).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import hashing
from tidemark.sources.scratch import written_table

LEDGER = ("key", "namespace", "updated_at", "group_id", "doc_id")


class IndexResult(NamedTuple):
    records: DataFrame
    added: DataFrame
    counters: DataFrame


def hash_documents(df: DataFrame, namespace_uuid: str, nested: str = "reference") -> DataFrame:
    """Add content_hash, metadata_hash, hash and uid (a given uid is kept)."""
    keys = F.map_keys(F.from_json("metadata", "map<string,variant>"))
    reserved = F.arrays_overlap(keys, F.array(*map(F.lit, hashing.RESERVED_KEYS)))
    checked = F.when(reserved, F.raise_error(F.lit("metadata holds a reserved hash key"))).otherwise(F.col("metadata"))
    given = F.col("uid") if "uid" in df.columns else F.lit(None).cast("string")
    return (
        df.withColumn("content_hash", hashing.hash_uuid(F.col("page_content"), namespace_uuid))
        .withColumn(
            "metadata_hash", hashing.hash_uuid(hashing.canonical_json(checked, nested), namespace_uuid))
        .withColumn("hash", hashing.hash_uuid(F.concat("content_hash", "metadata_hash"), namespace_uuid))
        .withColumn("uid", F.coalesce(F.when(given != "", given), F.col("hash")))
    )


def dedup_in_order(df: DataFrame, key: str = "hash", pos: str = "pos", batch_size: int | None = None) -> DataFrame:
    """First row per key, within batches of `batch_size` positions when given.

    The row limit of one per key is applied before the shuffle, so a key with very many copies
    sends one row per input partition.
    """
    keys = [F.col(key)] + ([F.floor((F.col(pos) - 1) / batch_size)] if batch_size else [])
    first = Window.partitionBy(*keys).orderBy(pos)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def index_upsert(
    docs: DataFrame,
    records: DataFrame,
    run_ts: float,
    namespace: str,
    source_id_key: str | None = None,
    force: bool = False,
    batch_size: int | None = None,
) -> IndexResult:
    """Bring the ledger up to date with `docs` (uid, pos, page_content, metadata).

    New keys are added, known ones skipped, or updated with `force`; all are touched.  With
    `batch_size`, a copy of a key in a later batch counts as known, a copy inside one batch not at all.
    """
    group = F.lit(None).cast("string") if source_id_key is None else F.get_json_object("metadata", f"$.{source_id_key}")
    doc_ref = F.col("doc_id").cast("string") if "doc_id" in docs.columns else F.lit(None).cast("string")
    rows = docs.withColumns({
        "_group": group,
        "_doc": doc_ref,
        "_batch": F.floor((F.col("pos") - 1) / batch_size) if batch_size else F.lit(0),
    })
    # two steps of min and count per key, both with partial sums before the shuffle
    per_batch = rows.groupBy("uid", "_batch").agg(F.min_by(F.struct("_group", "_doc"), "pos").alias("_first"))
    incoming = per_batch.groupBy("uid").agg(
        F.min_by("_first", "_batch").alias("_first"), (F.count(F.lit(1)) - 1).alias("_again")
    )
    ledger = records.where(F.col("namespace") == namespace)
    merged = incoming.join(ledger, incoming.uid == ledger.key, "full_outer").select(
        F.coalesce("key", "uid").alias("key"),
        F.lit(namespace).alias("namespace"),
        F.when(F.col("uid").isNotNull(), F.lit(float(run_ts))).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("key").isNull(), F.col("_first._group")).otherwise(F.col("group_id")).alias("group_id"),
        F.when(F.col("uid").isNull(), F.col("doc_id"))
        .otherwise(F.coalesce(F.col("_first._doc"), F.col("doc_id"))).alias("doc_id"),
        F.when(F.col("uid").isNull(), "old").when(F.col("key").isNull(), "new")
        .otherwise("update" if force else "skip").alias("_status"),
        F.coalesce("_again", F.lit(0)).alias("_again"),
    )
    again = "num_updated" if force else "num_skipped"
    counters = merged.agg(
        *[
            F.coalesce(
                F.sum(F.when(F.col("_status") == status, 1).otherwise(0)
                      + (F.col("_again") if name == again else F.lit(0))), F.lit(0)
            ).cast("bigint").alias(name)
            for name, status in (("num_added", "new"), ("num_updated", "update"), ("num_skipped", "skip"))
        ],
        F.count(F.when(F.col("_status") != "old", 1)).alias("total_keys"),
    )
    fresh = merged.where(F.col("_status") == "new").select(F.col("key").alias("uid"))
    added = dedup_in_order(docs, "uid", "pos").join(fresh, "uid", "left_semi")
    others = records.where(~F.col("namespace").eqNullSafe(namespace)).select(*LEDGER)
    return IndexResult(merged.select(*LEDGER).unionByName(others), added, counters)


def index_cleanup_incremental(
    docs: DataFrame, records: DataFrame, run_ts: float, namespace: str, source_id_key: str
) -> DataFrame:
    """Ledger without the stale keys that a namespace has of the sources seen in this run.

    A document without a source is an error; other namespaces are left alone.
    """
    if not source_id_key:
        raise ValueError("incremental cleanup needs source_id_key")
    source = F.get_json_object("metadata", f"$.{source_id_key}")
    given = F.coalesce(source, F.raise_error(F.concat(F.lit("no source id in the metadata of "), F.col("uid"))))
    seen = docs.select(given.alias("group_id")).distinct()
    stale = (
        records.where((F.col("namespace") == namespace) & (F.col("updated_at") < run_ts))
        .join(docs.select(F.col("uid").alias("key")).distinct(), "key", "left_anti")
        .join(seen, "group_id", "left_semi")
        .select("namespace", "key")
    )
    return records.join(stale, ["namespace", "key"], "left_anti")


def index_cleanup_full(docs: DataFrame, records: DataFrame, run_ts: float, namespace: str) -> DataFrame:
    """Ledger with only the keys of this run in a namespace; rows touched at or after `run_ts` stay."""
    seen = docs.select(F.col("uid").alias("key")).distinct().withColumn("_seen", F.lit(True))
    return (
        records.join(seen, "key", "left")
        .where(F.col("_seen") | (F.col("updated_at") >= run_ts) | ~F.col("namespace").eqNullSafe(namespace))
        .select(*records.columns)
    )


def ledger_upsert(records: DataFrame, keys: DataFrame, run_ts: float, time_at_least: float | None = None) -> DataFrame:
    """Insert or touch `keys` (key, namespace, group_id, doc_id); the first group of a key is kept."""
    if time_at_least is not None and run_ts < time_at_least:
        raise ValueError(f"time sync issue: {run_ts} is earlier than {time_at_least}")
    new = keys.groupBy("key", "namespace").agg(
        F.min("group_id").alias("_group"), F.min("doc_id").alias("_doc"), F.lit(True).alias("_in")
    )
    return records.withColumn("_old", F.lit(True)).join(new, ["key", "namespace"], "full_outer").select(
        "key",
        "namespace",
        F.when(F.col("_in"), F.lit(float(run_ts))).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("_old"), F.col("group_id")).otherwise(F.col("_group")).alias("group_id"),
        F.when(F.col("_in"), F.col("_doc")).otherwise(F.col("doc_id")).alias("doc_id"),
    )


def ledger_list_keys(
    records: DataFrame,
    namespace: str,
    before: float | None = None,
    after: float | None = None,
    groups: Sequence[str] | None = None,
    doc_id: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    rows = records.where(F.col("namespace") == namespace)
    if before is not None:
        rows = rows.where(F.col("updated_at") < before)
    if after is not None:
        rows = rows.where(F.col("updated_at") > after)
    if groups is not None:
        rows = rows.where(F.col("group_id").isin(list(groups)))
    if doc_id is not None:
        rows = rows.where(F.col("doc_id") == doc_id)
    keys = rows.select("key")
    return keys if limit is None else keys.orderBy("key").limit(limit)


def ledger_delete(records: DataFrame, namespace: str, keys: DataFrame | None = None, doc_id: str | None = None) -> DataFrame:
    if (keys is None) == (doc_id is None):
        raise ValueError("give either keys or doc_id")
    if keys is None:
        return records.where(~((F.col("namespace") == namespace) & F.col("doc_id").eqNullSafe(doc_id)))
    gone = keys.select("key").distinct().withColumn("namespace", F.lit(namespace))
    return records.join(gone, ["namespace", "key"], "left_anti")


def embed_with_cache(
    df: DataFrame,
    text: Column,
    cache: DataFrame,
    model: Callable[[pd.Series], pd.Series],
    namespace: str,
) -> tuple[DataFrame, DataFrame]:
    """Embed each distinct unseen text once.  Returns the rows with `embedding`, and the new cache.

    Cache columns: cache_key, embedding.  Copies are folded before the model runs.  What the model gave is
    written once, so the rows and the cache hold the same vectors.
    """
    keyed = df.withColumn("_text", text).withColumn(
        "cache_key", F.sha2(F.concat_ws(":", F.lit(namespace), F.col("_text")), 256))
    unseen = (
        keyed.groupBy("cache_key").agg(F.min("_text").alias("_text")).join(cache, "cache_key", "left_anti")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"cache_key": batch["cache_key"], "embedding": model(batch["_text"])})

    fresh = written_table(unseen.mapInPandas(run, "cache_key string, embedding array<float>"))
    full = cache.select("cache_key", "embedding").unionByName(fresh)
    return keyed.drop("_text").join(full, "cache_key", "left"), full


def hash_embedding(texts: pd.Series, buckets: int = 64) -> pd.Series:
    """Signed token hashing to unit vectors; an offline stand-in for a model."""
    import re

    import numpy as np
    import xxhash

    codes: dict[str, tuple[int, float]] = {}

    def code_of(token: str) -> tuple[int, float]:
        found = codes.get(token)
        if found is None:
            code = xxhash.xxh64_intdigest(token)
            found = codes[token] = (code % buckets, 1.0 if code >> 63 else -1.0)
        return found

    def one(text: str | None):
        pairs = [code_of(t) for t in re.findall(r"\w+", (text or "").lower())]
        if not pairs:
            return [0.0] * buckets
        at, sign = zip(*pairs)
        vector = np.bincount(at, weights=sign, minlength=buckets)
        length = float(np.linalg.norm(vector))
        return (vector / length if length else vector).astype(np.float32).tolist()

    return texts.map(one)


def cache_key(prompt: Column, model_name: Column) -> Column:
    return F.sha2(F.concat(prompt, F.lit("_"), model_name), 256)


def response_cache(df: DataFrame, prompt: Column, model_name: Column, cache: DataFrame) -> DataFrame:
    """Add cache_key, hit and the cached value.  Cache columns: cache_key, value."""
    known = cache.select("cache_key", "value", F.lit(True).alias("_hit"))
    return (
        df.withColumn("cache_key", cache_key(prompt, model_name))
        .join(known, "cache_key", "left")
        .withColumn("hit", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def upsert_history(
    history: DataFrame,
    flow_id: str | None = None,
    start: str | None = None,
    end: str | None = None,
    order: str = "ASC",
) -> DataFrame:
    """Run results by flow and time; `result` JSON becomes columns."""
    rows = history
    if flow_id is not None:
        rows = rows.where(F.col("flow_id") == flow_id)
    if start is not None:
        rows = rows.where(F.col("date") >= F.lit(start).cast("timestamp"))
    if end is not None:
        rows = rows.where(F.col("date") <= F.lit(end).cast("timestamp"))
    counts = "numAdded bigint, numUpdated bigint, numSkipped bigint, numDeleted bigint"
    parsed = rows.withColumn("result", F.from_json("result", counts)).select(
        *[c for c in rows.columns if c != "result"], "result.*"
    )
    at = F.col("date").asc() if order == "ASC" else F.col("date").desc()
    return parsed.orderBy(at, "id")


def history_row(counters: DataFrame, flow_id: str, run_id: Column, date: Column) -> DataFrame:
    """One history row of an index run; the added documents and the key total are left out."""
    return counters.select(
        run_id.alias("id"),
        F.lit(flow_id).alias("flow_id"),
        F.to_json(F.struct(
            F.col("num_added").alias("numAdded"), F.col("num_updated").alias("numUpdated"),
            F.col("num_skipped").alias("numSkipped"), F.lit(0).cast("bigint").alias("numDeleted"),
        )).alias("result"),
        date.alias("date"),
    )
