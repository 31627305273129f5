"""Tables, stored intermediate results and hashes shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the folder all executors share and read it back.

    Cuts the lineage: a lost executor repeats the tasks of one step only, and later steps read
    no more than the columns they use.
    """
    path = f"{scratch_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; other columns cannot clash."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def null_safe(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> Column:
    """Join condition in which two nulls are equal; column names of both sides must differ."""
    cond = F.lit(True)
    for a, b in keys:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond
