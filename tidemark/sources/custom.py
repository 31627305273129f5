"""Documents from a user function."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def load_custom(df: DataFrame, make: Callable[[dict], Iterable[dict]]) -> DataFrame:
    """Run `make` on every row; each result must have page_content (text) and metadata (JSON text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for row in batch.to_dict("records"):
                for item in make(row):
                    if not isinstance(item.get("page_content"), str):
                        raise ValueError("a document needs page_content as text")
                    if not isinstance(item.get("metadata"), str):
                        raise ValueError("a document needs metadata as JSON text")
                    found.append((item["page_content"], item["metadata"]))
            yield pd.DataFrame(found, columns=["page_content", "metadata"])

    return df.mapInPandas(run, "page_content string, metadata string")
