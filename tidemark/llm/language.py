"""Language identification by words first, shorter character n-grams for words never seen.

Fit: words and the n-grams (4 to 1) of padded words are counted per language over a sample of
labelled rows, bounded by `rows_per_lang`; the most frequent entries, relative to the total of
their language and length, form the model, at most `entries` rows.  That bound makes the model
safe to send to every task.

Score: a word of the model adds its log frequency in each language.  Any other word takes its
4-grams that the model has; where it has none, its 3-grams, and so on.  The whole text counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of, fold, stored

LONGEST = 4
ROWS_PER_LANG = 3000
ENTRIES = 100_000
_SPACE = 1 << 31


def _tokens():
    import re

    words = re.compile(r"[^\W\d_]+")
    return lambda text: words.findall(text.lower())


def _grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    padded = f"_{word}_"
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _count_entries(batches):
    tokens = _tokens()
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            counts.setdefault(lang, Counter()).update(tokens(text))
        rows = []
        for lang, words in counts.items():
            rows += [(lang, 0, w, c) for w, c in words.items()]
            for n in range(1, LONGEST + 1):
                grams: Counter = Counter()
                for w, c in words.items():
                    for g in _grams(w, n):
                        grams[g] += c
                rows += [(lang, n, g, c) for g, c in grams.items()]
        yield pd.DataFrame(rows, columns=["lang", "n", "entry", "c"])


def fit(labelled: DataFrame, rows_per_lang: int = ROWS_PER_LANG, entries: int = ENTRIES) -> dict:
    """Model from rows doc_id, text, lang; null texts and null languages are left out.

    No labelled rows give a model without languages, which calls every text `und`.
    """
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return {"langs": [], "tables": [], "unseen": []}
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, rows_per_lang / sizes[lang]))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(_SPACE)) < share * _SPACE)
    counted = stored(
        sample.select("lang", "text").mapInPandas(_count_entries, "lang string, n int, entry string, c long")
        .groupBy("lang", "n", "entry").agg(F.sum("c").alias("c"))
    )
    totals = {(r["lang"], r["n"]): (r["c"], r["v"]) for r in
              counted.groupBy("lang", "n").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()}
    total = F.create_map(*[F.lit(x) for (lang, n), (c, _) in totals.items() for x in (f"{lang}\x00{n}", float(c))])
    top = (
        counted.withColumn("f", F.col("c") / total[F.concat_ws("\x00", "lang", "n")])
        .orderBy(F.desc("f"), "n", "lang", "entry").limit(entries).select("lang", "n", "entry", "c").collect()
    )
    at = {lang: k for k, lang in enumerate(langs)}
    found: list[dict] = [{} for _ in range(LONGEST + 1)]
    for r in top:
        found[r["n"]].setdefault(r["entry"], np.zeros(len(langs)))[at[r["lang"]]] = r["c"]
    tables = []
    for n, counts in enumerate(found):
        sums = np.array([totals.get((lang, n), (0, 0))[0] for lang in langs], float)
        vocabulary = np.array([totals.get((lang, n), (0, 0))[1] for lang in langs], float)
        names = sorted(counts)
        matrix = np.array([counts[x] for x in names]).reshape(len(names), len(langs))
        logs = np.log((matrix + 0.1) / (sums + 0.1 * vocabulary + 1))
        tables.append((names, logs.astype(np.float32)))
    return {"langs": langs, "tables": tables}


def language_column(model: dict, text: Column) -> Column:
    """Struct (lang_pred, score): `und` and 0.0 for a null text or one without a letter.

    A text with letters but without any entry of the model gets the first language, by name, with
    the score that all languages share.
    """
    langs, tables = model["langs"], model["tables"]

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokens = _tokens()
        if langs:
            offsets = np.cumsum([0] + [len(names) for names, _ in tables])
            rows = np.concatenate([m for _, m in tables] + [np.zeros((1, len(langs)), np.float32)])
            nothing = len(rows) - 1
            index = [{x: int(o) + k for k, x in enumerate(names)} for (names, _), o in zip(tables, offsets)]
            words = index[0]
        seen: dict[str, int] = {}
        vectors = np.zeros((0, len(langs)), np.float32)
        def words_of(part):
            """Words of each text; vectors of words not met yet join the table."""
            nonlocal seen, vectors
            split = [tokens(t) if t else [] for t in part]
            if not langs:
                return split
            if len(seen) > 100_000:
                seen, vectors = {}, np.zeros((0, len(langs)), np.float32)
            new = [w for w in set().union(*split) if w not in seen]
            flat, starts = [], []
            for w in new:
                starts.append(len(flat))
                if (k := words.get(w)) is not None:
                    flat.append(k)
                    continue
                for n in range(LONGEST, 0, -1):
                    known = [k for g in _grams(w, n) if (k := index[n].get(g)) is not None]
                    if known:
                        flat += known
                        break
                else:
                    flat.append(nothing)
            if new:
                sums = np.add.reduceat(rows[flat], starts, axis=0)
                sums -= sums.max(axis=1, keepdims=True)
                base = len(vectors)
                vectors = np.concatenate([vectors, sums])
                seen.update(zip(new, range(base, base + len(new))))
            return split

        for batch in texts:
            names, scores = [], []
            for first in range(0, len(batch), 256):
                for found in words_of(batch.iloc[first:first + 256]):
                    if not langs or not found or not any(w[0].isalpha() or any(map(str.isalpha, w)) for w in found):
                        names.append("und")
                        scores.append(0.0)
                        continue
                    total = np.zeros(len(langs))
                    for lo in range(0, len(found), 65536):
                        total += vectors[[seen[w] for w in found[lo:lo + 65536]]].sum(axis=0, dtype=np.float64)
                    share = np.exp(total - total.max())
                    best = int(total.argmax())
                    names.append(langs[best])
                    scores.append(float(share[best] / share.sum()))
            yield pd.DataFrame({"lang_pred": names, "score": np.array(scores, float)})

    return predict(text)


def learned(df: DataFrame, folds: int = 5, held: int = 0, **bounds: int) -> dict:
    """Model from the rows of `df` (doc_id, text, lang) outside the held-out fold."""
    return fit(df.where(fold("doc_id", folds) != held), **bounds)


def identify(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score per input row; repeated rows come out repeated."""
    found = documents_of(df, id_col, text_col).select("doc_id", language_column(model, F.col("text")).alias("p"))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "p.lang_pred", "p.score")


def recognised(df: DataFrame, model: dict, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `df`, all columns, whose text has a language with a score of at least `least`."""
    found = language_column(model, F.col(f"`{text_col}`"))
    return df.where((found["lang_pred"] != "und") & (found["score"] >= least))
