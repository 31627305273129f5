"""Corpus preparation in five stages: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.  All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, linechunks, packing, simhash
from tidemark.llm.tables import stored, table
from tidemark.session import configure


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that is likelier than all others together, go."""
    configure(spark)
    return language.recognised(docs, language.learned(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go; a document of which nothing is left goes whole."""
    configure(spark)
    found = linechunks.dedup_runs(docs).where("n_removed = 0 or n_removed < n_lines")
    row = F.col("row").withField("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(
            F.col("n_removed") > 0, F.length("kept_text").cast(kind)).otherwise(F.col("row.n_chars")))
    return found.select(row.alias("row")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id.

    Null and empty texts have the fingerprint zero and are one group; an empty table gives no rows.
    """
    configure(spark)
    return simhash.one_of_each(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of `benchmark`, copied or paraphrased, go.

    Null and empty texts hold none and stay; an empty table gives no rows.
    """
    configure(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and place, see `packing.pack`.

    Null and empty texts are a piece with the end id; repeated rows are packed each; an empty table gives no rows.
    """
    configure(spark)
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash", near_dedup),
    ("decontaminate", decontaminate_benchmark),
    ("packing", pack_sequences),
]

#: tokenisers and fingerprints are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
