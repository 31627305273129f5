"""Minimum bin slack packing of tokenised documents into sequences.

Documents are tokenised once; the table of pieces holds numbers only.  What packing has to know
is how many pieces there are of every length, at most 1024 counts.  The plan fills one bin after
the other: the longest length left opens it, and a subset-sum over the lengths left, as bits of
an integer, finds the fullest filling.  A filling is repeated for as long as its lengths last,
so the plan is a short table (length, ranks, sequence, place) whatever the corpus.

Pieces of a length are numbered without gathering them: within slots by hash, plus the sizes of
the slots before.  Each piece then looks up its rank in the plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of, stored

CAPACITY = 1024
END_ID = 2
SLOTS = 256
_ENTRIES = 400_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, end_id: int = END_ID):
    """Function from texts to token bytes (little-endian unsigned 32 bit), the end id included.

    Words between single blanks and line feeds are tokenised once and remembered: the byte-level
    pattern never joins letters across them.  A word of letters, and the dots and commas after one, are
    each one unit of the pattern, so the model is asked for the bare word; all other words go through the
    whole tokenizer.  So does a text in which white space is adjacent, or that holds a special token's string.
    """
    import re
    import sys
    from array import array

    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    letters = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
    # the letters as the model knows them, from the pattern itself
    spelled = str.maketrans({
        chr(c): tok.pre_tokenizer.pre_tokenize_str("a" + chr(c))[0][0][1:] for c in range(0xC0, 0x250) if chr(c).isalpha()})
    blank = tok.pre_tokenizer.pre_tokenize_str(" a")[0][0][:-1]

    def packed(ids):
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return numbers.tobytes()

    def ids(text):
        return packed(tok.encode(text, add_special_tokens=False).ids)

    feed, end = ids("\n"), packed([end_id])
    ask = tok.model.tokenize
    marks: dict[str, bytes] = {"": b""}
    # words after a blank, and words after a line feed with the line feed
    memo: dict[str, bytes] = {}

    def learn(words):
        odd = []
        for word in words:
            core = word.rstrip(".,")
            tail = word[len(core):]
            after_feed = core[:1] == "\n"
            bare = core[1:] if after_feed else core
            if not letters(bare):
                odd.append(word)
                continue
            if (found := memo.get(core)) is None:
                if not bare.isascii():
                    bare = bare.translate(spelled)
                found = packed([t.id for t in ask(bare if after_feed else blank + bare)])
                found = memo[core] = feed + found if after_feed else found
            if tail:
                if tail not in marks:
                    marks[tail] = ids(tail)
                memo[word] = found + marks[tail]
        for lo in range(0, len(odd), 256):
            part = odd[lo:lo + 256]
            batch = tok.encode_batch_fast([w if w[0] == "\n" else " " + w for w in part], add_special_tokens=False)
            memo.update((w, packed(e.ids)) for w, e in zip(part, batch))

    def plain(text):
        """Whether every gap between words is one blank or one line feed, with none at the ends."""
        words, gaps = text.split(), text.count(" ") + text.count("\n")
        single = len(words) == gaps + 1 and sum(map(len, words)) + gaps == len(text)
        return single and not any(s in text for s in special)

    def encode(texts):
        if len(memo) > _ENTRIES:
            memo.clear()
        split = [("\n" + text).replace("\n", " \n").split(" ")[1:] if text and plain(text) else None for text in texts]
        learn(set().union(*(words for words in split if words)).difference(memo))
        get, skip = memo.__getitem__, len(feed)
        return [
            (b"".join(map(get, words))[skip:] if words else ids(text) if text else b"") + end
            for words, text in zip(split, texts)
        ]

    return encode


def piece_column(text: Column, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> Column:
    """Array of pieces (piece, start, length, ids_crc32); a null text has the end id only."""

    @F.pandas_udf("array<struct<piece: int, start: long, length: long, ids_crc32: long>>")
    def pieces(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import os
        from zlib import crc32

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(path, end_id)

        def cut(ids):
            n = len(ids) // 4
            first = n % capacity or capacity
            bounds = [0, *range(first, n + 1, capacity)]
            return [
                {"piece": k, "start": lo, "length": hi - lo, "ids_crc32": crc32(ids[4 * lo:4 * hi])}
                for k, (lo, hi) in enumerate(zip(bounds, bounds[1:]))
            ]

        for batch in texts:
            out = []
            for lo in range(0, len(batch), 128):
                part = [t or "" for t in batch.iloc[lo:lo + 128]]
                out += [cut(ids) for ids in encode(part)]
            yield pd.Series(out)

    return pieces(text)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, with repeats up to their counts, whose sum is the largest that is at most `room`."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], room // length) if length <= room else 0):
            new = (reach | reach << length) & mask
            if new == reach:
                break
            steps.append((length, reach))
            reach = new
        if reach >> room & 1:
            break
    best, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> best & 1:
            chosen.append(length)
            best -= length
    return chosen


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, first sequence, pieces per sequence, place), ranks from 0 per length."""
    left = {length: n for length, n in histogram.items() if n}
    used, rows, sequence = dict.fromkeys(left, 0), [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = [longest, *fullest({k: n for k, n in left.items() if n}, capacity - longest)]
        left[longest] += 1
        times = {length: chosen.count(length) for length in dict.fromkeys(chosen)}
        repeats = min(left[length] // m for length, m in times.items())
        place = 0
        for length, m in times.items():
            rows.append((length, used[length], sequence, m, place))
            place += length * m
            used[length] += m * repeats
            left[length] -= m * repeats
            if not left[length]:
                del left[length]
        sequence += repeats
    return rows


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Null and empty texts are a piece with the end id; repeated rows are packed each; ids may be
    null.  An empty table gives no rows.
    """
    docs = documents_of(df, id_col, text_col)
    pieces = stored(
        docs.select("doc_id", F.explode(piece_column(F.col("text"), path, capacity, end_id)).alias("p")).select("doc_id", "p.*")
    )
    slotted = pieces.withColumn("slot", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SLOTS)))
    # at most capacity * SLOTS rows
    sizes = slotted.groupBy("length", "slot").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length", "slot",
        (F.sum("n").over(Window.partitionBy("length").orderBy("slot")) - F.col("n")).alias("before"),
    )
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = sorted(packing_plan(histogram, capacity))
    plan = np.array(rows, np.int64).reshape(-1, 5)
    starts = plan[:, 0] << 48 | plan[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(starts, size << 48 | r, side="right") - 1
        local = r - plan[at, 1]
        return pd.DataFrame({
            "sequence_id": plan[at, 2] + local // plan[at, 3], "offset": plan[at, 4] + local % plan[at, 3] * size,
        })

    inside = F.row_number().over(
        Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "start", "ids_crc32")
    ) - 1
    ranked = slotted.withColumn("inside", inside).join(before, ["length", "slot"]).withColumn(
        "rank", F.col("inside") + F.col("before")
    )
    return ranked.withColumn("at", place("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"
    )
