"""Scratch files for queries that read back what they write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder of the cluster; a local one in local mode only."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir")
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        return tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def written_csv(df: DataFrame, header: bool = True) -> str:
    path = f"{scratch_folder(df.sparkSession)}/csv"
    df.write.csv(path, header=header, escape='"')
    return path


def written_table(df: DataFrame) -> DataFrame:
    """Write a table once and read it back; later steps scan only the columns they need."""
    path = f"{scratch_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
