"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

1. One pass over the texts finds the base spans (e-mail, address, card, phone) and looser
   candidates (masked e-mails, national phone forms, identity numbers, account numbers, persons).
   Five labelers vote +1, 0 or -1 on every candidate: strict form, gazetteer, words around it,
   check digits, and its edges.
2. Candidates are counted by kind, votes and shape.  There are at most kinds x 3^5 x shapes such
   cells, so the table of counts is bounded whatever the corpus, and it is exact: it covers all
   candidates.  EM estimates from it how reliable every labeler is for either truth.
3. A logistic regression over kind, votes and shape is trained on the posteriors, weighted by the
   counts.  Candidates above one half are kept; base spans always are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of, stored

BASE = ("email", "ip", "card", "phone")
ADDED = ("masked_email", "local_phone", "identity", "account", "person")
KINDS = BASE + ADDED
LABELERS = ("form", "gazetteer", "context", "check", "edge")
SHAPES = 8

GIVEN_NAMES = (
    "Anna Ana Maria Marie Laura Julia Sofia Sophie Emma Clara Lucia Elena Claire Camille Sarah Lisa Peter Paul Thomas "
    "Martin David Daniel Michael Robert John James William Jean Pierre Louis Hans Klaus Jürgen Stefan Carlos José Juan "
    "Luis Miguel Pablo"
).split()
TOP_DOMAINS = "com org net edu gov info io de fr es eu uk it nl ch at be pt co us".split()
CALLING_CODES = "1 33 34 39 41 43 44 49 31 32 351 45 46 47 48 52 54 55 61 81 86 91".split()
CUES = {
    "email": "mail email e-mail contact write courriel correo",
    "ip": "ip host server address adresse dirección login",
    "card": "card visa mastercard credit carte karte tarjeta payment",
    "phone": "tel phone call mobile fax téléphone telefon teléfono handy",
    "identity": "ssn social security identity ausweis dni",
    "account": "iban account konto compte cuenta bank",
    "person": "name signed dear regards herr frau monsieur madame señor señora",
}
CUES["masked_email"], CUES["local_phone"] = CUES["email"], CUES["phone"]
AGAINST = "version release isbn order invoice ref page build figure table section"


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def outside(taken: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Test whether a span (end exclusive) meets none of the taken ones, which may overlap each other."""
    ordered = sorted(taken)
    starts = [start for start, _ in ordered]
    reach = list(accumulate((end for _, end in ordered), max))

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before == 0 or reach[before - 1] <= start

    return free


def finder():
    """Function from a text to sorted (start, kind number, end, votes, shape); compiled in the task."""
    import re

    domain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    local = re.compile(r"[A-Za-z0-9._%+-]")
    ip = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
    card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    masked = re.compile(
        r"\b[A-Za-z0-9._%+-]{1,64}\s?[\[(](?:at|AT)[\])]\s?[A-Za-z0-9-]{1,63}\s?(?:\.|[\[(](?:dot|DOT)[\])])\s?[A-Za-z]{2,10}\b"
    )
    national = re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![\w-])")
    identity = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
    account = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b")
    person = re.compile(
        r"\b(?:(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?|" + "|".join(GIVEN_NAMES) + r")\x20[A-ZÀ-Þ][a-zà-ÿ]{2,30}\b"
    )
    title = re.compile(r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\b")
    given, tops, codes = set(GIVEN_NAMES), set(TOP_DOMAINS), tuple(CALLING_CODES)
    cues = {k: re.compile(r"(?i)\b(?:" + "|".join(v.split()) + r")\b") for k, v in CUES.items()}
    against = re.compile(r"(?i)\b(?:" + "|".join(AGAINST.split()) + r")\b")
    digits_of = re.compile("[^0-9]+")

    def emails(text):
        end, at = 0, text.find("@")
        while at >= 0:
            lo = at
            while lo > end and local.match(text[lo - 1]):
                lo -= 1
            m = domain.match(text, lo) if lo < at else None
            if m:
                yield m.start(), m.end()
                end = m.end()
            at = text.find("@", max(at + 1, end))

    def base(text):
        found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
        for m in ip.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
                found.append((m.start(), 1, m.end()))
        for m in card.finditer(text):
            if m.end() - m.start() >= 14:
                d = digits_of.sub("", m[0])
                if 14 <= len(d) <= 19 and _luhn(d):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in phone.finditer(text):
                if 10 <= len(digits_of.sub("", m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
        return found

    def votes_on(text, kind, lo, hi):
        name, span = KINDS[kind], text[lo:hi]
        digits = digits_of.sub("", span) if kind not in (0, 4, 8) else ""
        around = text[max(0, lo - 40):lo] + " " + text[hi:hi + 20]
        form = gazetteer = check = 0
        if name in ("email", "masked_email"):
            top = span.rsplit(".", 1)[-1].lower() if "." in span else span.split()[-1].strip("[]()").lower()
            gazetteer = 1 if top in tops or top[-3:] in tops else -1
            form = 1 if name == "email" and ".." not in span and span[0] not in ".%+-" else 0
        elif name == "ip":
            parts = [int(p) for p in span.split(".")]
            form = 1 if all(str(int(p)) == p for p in span.split(".")) else -1
            gazetteer = -1 if parts[0] in (0, 127, 255) else 1
        elif name == "card":
            gazetteer, check = (1 if span[0] in "3456" else -1), 1
            form = 1 if len(digits) in (15, 16) else 0
        elif name == "phone":
            gazetteer, form = (1 if digits.startswith(codes) else -1), (1 if 10 <= len(digits) <= 13 else 0)
        elif name == "local_phone":
            form = 1 if len(digits) == 10 else 0
            gazetteer = -1 if digits[0] in "01" else 0
        elif name == "identity":
            check = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 1
        elif name == "account":
            whole = span.replace(" ", "")
            check, form = (1 if _mod97(whole) else -1), (1 if 15 <= len(whole) <= 34 else -1)
        else:
            gazetteer = 1 if given.intersection(span.split()) else 0
            form = 1 if title.match(span) else 0
        context = 1 if cues[name].search(around) else -1 if against.search(around) else 0
        left, right = text[lo - 1:lo], text[hi:hi + 1]
        edge = -1 if left.isalnum() or right.isalnum() else 1 if (not left or left.isspace()) else 0
        return (form, gazetteer, context, check, edge)

    def spans(text):
        found = base(text)
        loose = []
        if "at" in text or "AT" in text:
            loose += [(m.start(), 4, m.end()) for m in masked.finditer(text)] if "[" in text or "(" in text else []
        loose += [(m.start(), 5, m.end()) for m in national.finditer(text)]
        loose += [(m.start(), 6, m.end()) for m in identity.finditer(text)]
        loose += [(m.start(), 7, m.end()) for m in account.finditer(text)]
        loose += [(m.start(), 8, m.end()) for m in person.finditer(text)]
        free = outside([(a, b) for a, _, b in found])
        found += [span for span in loose if free(span[0], span[2])]
        out = []
        for a, kind, b in sorted(found):
            votes = votes_on(text, kind, a, b)
            code = sum((v + 1) * 3 ** k for k, v in enumerate(votes))
            shape = min(3, (b - a) // 8) * 2 + (" " in text[a:b])
            out.append((a, kind, b, code, shape))
        return out

    return spans


_FOUND = "array<struct<kind: string, start: long, end: long, cell: int>>"


def candidate_column(text: Column) -> Column:
    """Candidates of a whole text, sorted by start, then kind; none for a null text.

    `cell` numbers the kind, the votes and the shape together.
    """

    @F.pandas_udf(_FOUND)
    def candidates(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spans = finder()
        for batch in texts:
            yield pd.Series([
                [{"kind": KINDS[k], "start": a, "end": b, "cell": (k * 243 + code) * SHAPES + shape}
                 for a, k, b, code, shape in spans(t)] if t else []
                for t in batch
            ])

    return candidates(text)


def estimate(cells: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM over counted cells: posterior of each cell, and P(vote | truth) per labeler, truth and vote."""
    kinds = cells // (243 * SHAPES)
    codes = cells // SHAPES % 243
    votes = np.stack([codes // 3 ** k % 3 for k in range(len(LABELERS))], axis=1)
    post = np.clip(0.5 + 0.2 * (votes - 1).sum(axis=1), 0.05, 0.95)
    tables = np.full((len(LABELERS), 2, 3), 1 / 3)
    for _ in range(rounds):
        for j in range(len(LABELERS)):
            for truth, weight in ((1, post), (0, 1 - post)):
                c = np.bincount(votes[:, j], weights=counts * weight, minlength=3) + 1.0
                tables[j, truth] = c / c.sum()
        prior = (np.bincount(kinds, weights=counts * post, minlength=len(KINDS)) + 1) / (
            np.bincount(kinds, weights=counts, minlength=len(KINDS)) + 2)
        odds = np.log(prior[kinds]) - np.log(1 - prior[kinds])
        for j in range(len(LABELERS)):
            # a labeler that is silent tells nothing; the order of the truths is fixed by the first guess
            odds += np.where(votes[:, j] == 1, 0, np.log(tables[j, 1, votes[:, j]]) - np.log(tables[j, 0, votes[:, j]]))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            post = new
            break
        post = new
    return post, tables


def _features(cells: np.ndarray) -> np.ndarray:
    kinds, codes, shapes = cells // (243 * SHAPES), cells // SHAPES % 243, cells % SHAPES
    parts = [np.eye(len(KINDS))[kinds], np.eye(SHAPES)[shapes]]
    parts += [np.eye(3)[codes // 3 ** k % 3] for k in range(len(LABELERS))]
    return np.concatenate(parts, axis=1)


def train_spans(cells: np.ndarray, counts: np.ndarray, post: np.ndarray, steps: int = 400, rate: float = 0.5) -> np.ndarray:
    """Probability of each cell by a logistic regression on the posteriors, damped by square roots of counts."""
    x = _features(cells)
    w, weight = np.zeros(x.shape[1]), np.sqrt(counts)
    weight = weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w += rate * (x.T @ (weight * (post - p)) - 1e-4 * w) * 4
    return 1 / (1 + np.exp(-x @ w))


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, found: array of (kind, start, end) in code points, per input row.

    Null and empty texts give an empty array, repeated rows come out repeated, an empty table gives
    no rows.  Spans of the base kinds are all kept; others when the classifier accepts them.
    """
    docs = stored(documents_of(df, id_col, text_col).select("doc_id", candidate_column(F.col("text")).alias("found")))
    # at most len(KINDS) * 243 * SHAPES rows
    counted = (
        docs.select(F.explode("found").alias("s")).groupBy("s.cell").agg(F.count("*").alias("n")).orderBy("cell").collect()
    )
    accepted: list[int] = []
    if counted:
        cells, counts = np.array([r["cell"] for r in counted]), np.array([r["n"] for r in counted], float)
        post, _ = estimate(cells, counts)
        accepted = [int(c) for c, p in zip(cells, train_spans(cells, counts, post)) if p >= 0.5]
    keep = lambda s: s["kind"].isin(*BASE) | F.array_contains(F.array(*map(F.lit, accepted)), s["cell"]) if accepted \
        else s["kind"].isin(*BASE)
    kept = F.transform(F.filter("found", keep), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return docs.select("doc_id", kept.alias("found"))
