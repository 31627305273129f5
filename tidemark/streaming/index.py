"""Incremental indexing fed by a stream of documents.

The ledger is a folder of change logs, one per micro-batch; the newest row of a key counts.  A batch
that runs again after a failure writes the same folder again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.indexing import LEDGER, index_upsert

_SCHEMA = "key string, namespace string, updated_at double, group_id string, doc_id string"


def ledger_now(
    spark: SparkSession, records_path: str, before_run: int | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """The current ledger; with `before_run`, as the runs before it left it; with `keys`, of these only."""
    log = spark.read.schema(f"{_SCHEMA}, run bigint").parquet(records_path)
    if before_run is not None:
        log = log.where(F.col("run") < before_run)
    if keys is not None:
        log = log.join(keys, "key", "left_semi")
    newest = log.groupBy("namespace", "key").agg(F.max_by(F.struct("updated_at", "group_id", "doc_id"), "run").alias("_r"))
    return newest.select("key", "namespace", "_r.*").select(*LEDGER)


def stream_index(
    stream: DataFrame, records_path: str, checkpoint: str, namespace: str = "stream", source_id_key: str | None = None,
) -> StreamingQuery:
    """Index hashed documents (uid, pos, page_content, metadata); no document is too late.

    The ledger makes repeats harmless, so no state is kept between batches.  A batch meets the ledger rows
    of its own keys only, and writes those.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], f"{_SCHEMA}, run bigint").write.mode("ignore").partitionBy("run").parquet(records_path)

    def write(batch: DataFrame, run: int) -> None:
        own = batch.select(F.col("uid").alias("key")).distinct()
        ledger = ledger_now(batch.sparkSession, records_path, before_run=run, keys=own)
        result = index_upsert(batch, ledger, float(run), namespace, source_id_key)
        touched = result.records.where((F.col("updated_at") == float(run)) & (F.col("namespace") == namespace))
        touched.write.mode("overwrite").parquet(f"{records_path}/run={run}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def compact_ledger(spark: SparkSession, records_path: str, target_path: str, run: int) -> None:
    """Write the current ledger as one run of a new folder."""
    ledger_now(spark, records_path).write.mode("overwrite").parquet(f"{target_path}/run={run}")
