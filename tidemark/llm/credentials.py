"""Secret scan: fixed patterns, and windows of high Shannon entropy per character class.

Candidates of the entropy part are runs of token characters.  A window slides over a run; the
counts of its characters are kept up to date by one addition and one removal per step, and so is
the sum of c log c from which the entropy follows.  Windows of a class (letters and digits mixed
over the whole run, hex over its stretches of hex digits) above the limit of the class are merged to spans.  An allow list suppresses what
is known not to be secret: runs without a digit or without a letter, and, in the parts of a run
between '=' signs, identifiers in UUID form, the words of addresses and paths, and the
REACH characters on both sides of a placeholder word.  Windows that meet none of these stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of

KINDS = ("assign", "access", "hex", "entropy")
#: class: characters, window, least entropy in bits per character
CLASSES = {
    "hex": ("0123456789abcdefABCDEF", 20, 3.0),
    "mixed": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 20, 3.7),
}
ALLOWED_WORDS = ("example", "sample", "placeholder", "dummy", "changeme")
#: too short to be told from chance inside a longer word
ALLOWED_ALONE = ("http", "https", "www")
REACH = 64


def entropy_windows(run: str, window: int, least: float) -> list[tuple[int, int]]:
    """Merged spans of all windows of `run` with an entropy of at least `least`; counts are incremental."""
    from math import log2

    if len(run) < window:
        return []
    clog = [0.0] + [c * log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, limit, spans = 0.0, window * (log2(window) - least), []
    for i, ch in enumerate(run):
        if i >= window:
            old = run[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += clog[c - 1] - clog[c]
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += clog[c + 1] - clog[c]
        if i >= window - 1 and total <= limit + 1e-9:
            lo = i - window + 1
            if spans and lo <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((lo, i + 1))
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, with those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def finder():
    """Function from a text to its spans (start, kind number, end), sorted; compiled in the task."""
    import re

    assign = re.compile(
        r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    access = re.compile(r"AKIA[A-Z0-9]+")
    hexes = re.compile(r"[0-9a-f]{16,}")
    runs = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
    digit, uuid = re.compile("[0-9]"), re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
    hex_runs = re.compile("[0-9a-fA-F]{20,}")

    def windows(run: str) -> list[tuple[int, int]]:
        found = entropy_windows(run, *CLASSES["mixed"][1:])
        for m in hex_runs.finditer(run):
            if digit.search(m[0]) and any(map(str.isalpha, m[0])):
                found += [(m.start() + lo, m.start() + hi) for lo, hi in entropy_windows(m[0], *CLASSES["hex"][1:])]
        return merged(found)

    def forms(words):
        return "|".join(form for w in words for form in (w, w.upper(), w.capitalize()))

    placeholder = re.compile(
        f"{forms(ALLOWED_WORDS)}|ChangeMe|changeMe|x{{4,}}|X{{4,}}|(?<![A-Za-z0-9])(?:{forms(ALLOWED_ALONE)})(?![A-Za-z0-9])")
    parts, segments = re.compile("[^=]+"), re.compile("[^/]+")
    word = "(?:(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+)[0-9]{0,4}|[0-9]+)"
    wordlike = re.compile(f"{word}(?:[-_+]+{word})*[-_+]*")

    def free(run: str) -> list[tuple[int, int]]:
        """The stretches of `run` that the allow list leaves."""
        taken = []
        for m in parts.finditer(run):
            lo, hi, part = m.start(), m.end(), m[0]
            if uuid.fullmatch(part):
                taken.append((lo, hi))
                continue
            taken += [(max(lo, lo + w.start() - REACH), min(hi, lo + w.end() + REACH)) for w in placeholder.finditer(part)]
            slashes = part.count("/")
            if slashes >= 2 and slashes * 12 >= len(part):
                # short parts say nothing by themselves and break no stretch
                taken += [(lo + w.start(), lo + w.end()) for w in segments.finditer(part)
                          if len(w[0]) >= 4 and wordlike.fullmatch(w[0])]
        out, at = [], 0
        for lo, hi in [*merged(taken), (len(run), len(run))]:
            if lo > at:
                out.append((at, lo))
            at = max(at, hi)
        return out

    def spans(text: str) -> list[tuple[int, int, int]]:
        found = []
        if ":" in text or "=" in text:
            found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 12]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= 18]
        found += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
        for m in runs.finditer(text):
            run = m[0]
            if not digit.search(run) or not any(map(str.isalpha, run)):
                continue
            for at, end in free(run):
                found += [(m.start() + at + lo, 3, m.start() + at + hi) for lo, hi in windows(run[at:end])]
        return sorted(found)

    return spans


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, found: array of (kind, start, end) in code points, per input row.

    A null text counts as empty and gives an empty array; repeated rows come out repeated.
    """
    @F.pandas_udf("array<struct<kind: string, start: long, end: long>>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spans = finder()
        for batch in texts:
            yield pd.Series([
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t)] if t else [] for t in batch
            ])

    return documents_of(df, id_col, text_col).select("doc_id", found("text").alias("found"))


def span_digest(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """doc_id, a count per base kind, the hash of the base spans and the text of all spans.

    `found`: spans sorted by start, then kind.
    """
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    own = F.filter("found", lambda s: s["kind"].isin(*base))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, base),
        F.sha2(F.array_join(F.transform(own, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("found", text), ",").alias("spans"),
    )
