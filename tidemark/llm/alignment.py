"""Alignment of two tokenisations of the same texts by diagonal run skipping.

A text is encoded by a byte-level BPE (A) and by a piece model (B).  Both give an array of byte
offsets at which their tokens end.  Where both arrays agree at the current shift of their indices,
tokens stand one to one; such a stretch is jumped by comparing slices of doubling length, and by
halving them where they differ.  At the first difference the group is resolved step by step, which
gives the next shift.  Segments that both encode apart are aligned once, many in a row.

A group of m and n tokens without a common border inside has m + n - 1 overlapping pairs, its links.
Every document carries its distinct pairs with their counts.  The corpus-wide counts are a grouped
sum.  To get them back to the documents without shuffling all links, the most frequent pairs, at
most FREQUENT rows of them, are broadcast; the rare rest meets its counts in a shuffled join.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import documents_of, stored

#: rows of the broadcast table of frequent pairs, some 20 bytes each
FREQUENT = 1 << 18
_ROWS = 256
_BOTH = b"\3"
#: segments remembered, and as many of those before them; segments encoded at once
_MEMO = 200_000
_MEMO_CHARS = 64
_RUN = 1024
_SEGMENTS = re.compile(r"[ \n]+[^ \n]*").findall
_LETTERS, _MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-/:-@\[-`{-~"
#: a word of letters, and the marks right after it
_MARKED = re.compile(rf"([ \n]+[{_LETTERS}]+)([{_MARKS}]+)").fullmatch
#: white space besides blanks and line feeds; a text that holds any is not cut into segments
_OTHER_SPACE = re.compile("[%s]" % "".join(map(chr, (
    9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))).search


def diagonal_links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A index and B index of every link, and whether it is the first of its group.

    Both arrays hold the ends of tokens and ascend to the same total.
    """
    n = len(a_ends)
    a, b = a_ends.astype("<i8").tobytes(), b_ends.astype("<i8").tobytes()
    a_at, b_at = a_ends.tolist(), b_ends.tolist()
    # the way from link to link: a step in A, a step in B, or past a common border
    moves = bytearray()
    step = moves.append
    i = shift = 0
    while i < n:
        start, skew = i, 8 * shift
        if a_at[i] == b_at[i + shift]:
            i, width = i + 1, 2
            while i < n and a[8 * i:8 * (i + width)] == b[8 * i + skew:8 * (i + width) + skew]:
                i += width
                width *= 2
            if i > n:
                i = n
            while i < n and width > 2:  # the first difference lies within `width` tokens
                width //= 2
                if a[8 * i:8 * (i + width)] == b[8 * i + skew:8 * (i + width) + skew]:
                    i += width
            if i < n and a_at[i] == b_at[i + shift]:
                i += 1
            moves += _BOTH * (i - start)
        if i < n:
            j = i + shift
            x, y = a_at[i], b_at[j]
            while x != y:
                if x < y:
                    step(1)
                    i += 1
                    x = a_at[i]
                else:
                    step(2)
                    j += 1
                    y = b_at[j]
            step(3)
            i, j = i + 1, j + 1
            shift = j - i
    way = np.frombuffer(moves, np.uint8)
    left, right = ((way & bit).astype(bool) for bit in (1, 2))
    first = np.ones(len(way), bool)
    first[1:] = way[:-1] == 3
    return left.cumsum() - left, right.cumsum() - right, first


def group_text(
    a_ids: np.ndarray, b_ids: np.ndarray, left: np.ndarray, right: np.ndarray, first: np.ndarray, texts: np.ndarray,
) -> tuple[bytes, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3;` and where each token of B ends in it; `texts` holds the ids as fixed-width bytes."""
    a_start, b_start = np.zeros(len(a_ids) + 1, bool), np.zeros(len(b_ids) + 1, bool)
    a_start[left[first]] = b_start[right[first]] = a_start[-1] = b_start[-1] = True
    a_group, b_group = a_start[:-1].cumsum(), b_start[:-1].cumsum()
    b_before = np.append(np.flatnonzero(b_start[:-1]), len(b_ids))
    a_before = np.append(np.flatnonzero(a_start[:-1]), len(a_ids))
    at = np.concatenate([np.arange(len(a_ids)) + b_before[a_group - 1], np.arange(len(b_ids)) + a_before[b_group]])
    marks = np.concatenate([np.where(a_start[1:], b"|", b","), np.where(b_start[1:], b";", b",")])
    width = texts.dtype.itemsize
    cells = np.zeros((len(at), width + 1), np.uint8)
    cells[at, :width] = texts[np.concatenate([a_ids, b_ids])].view(np.uint8).reshape(-1, width)
    cells[at, width] = marks.view(np.uint8)
    return cells.tobytes().translate(None, b"\0"), (cells != 0).sum(axis=1).cumsum()[at[len(a_ids):]]


@functools.lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Callable[[list[str]], list[tuple[int, bytes, bytes] | None]]:
    """Function from texts to their number of A's tokens, groups as text, and linked id pairs as 8-byte integers.

    None stands for a text without tokens: empty, or whose joined bytes differ from blank + text.

    Segments (white space and the word after it) are encoded and aligned once and remembered.  A's pattern
    never joins a word with the white space after it, nor does any piece of B, which is looked up in its
    vocabulary; so a segment's end is a border of both, and many segments in a row are a text of their own.
    With a vocabulary or a text that does not fit, texts are encoded whole.  A Python worker keeps the
    function, and what it remembers, for its next tasks.
    """
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path_a)
    tok.encode_special_tokens = True
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    size_a = tok.get_vocab_size()
    a_bytes = [bytes(byte_of.get(c, 0) for c in tok.id_to_token(k) or "") for k in range(size_a)]

    model = SentencePieceProcessor(model_file=path_b)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("\u2581", " ").encode() for k, p in enumerate(pieces)]
    blank_b = model.piece_to_id("\u2581")
    # without a normalizer, byte-level tokens always give back their text
    lossless = tok.normalizer is None
    separable = not any(re.search("[^\u2581]\u2581|\n", p) for k, p in enumerate(pieces) if not model.is_byte(k))
    # where neither joins a letter and a mark after it, the marks are learned once, after an "a", for all words
    apart = all(len(tok.pre_tokenizer.pre_tokenize_str(f" a{c}")) == 2 for c in map(chr, range(33, 127)) if not c.isalnum()) and not any(
        re.search(f"[{_LETTERS}][{_MARKS}]", p)
        for k, p in enumerate(pieces) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k)))
    a_sizes, b_sizes = (np.fromiter(map(len, rows), np.int64, len(rows)) for rows in (a_bytes, b_bytes))
    texts_of = np.array([b"%d" % k for k in range(max(size_a, len(pieces)))])

    def align(spaced: str, ids_b: list[int], sizes: list[int]) -> list[tuple[int, bytes, bytes]] | None:
        """The stretches of `sizes` bytes of a text; None unless A and B give its bytes back and end at all of them."""
        raw, ids_a = spaced.encode(), tok.encode_batch_fast([spaced], add_special_tokens=False)[0].ids
        if b"".join([b_bytes[k] for k in ids_b]) != raw or not (lossless or b"".join([a_bytes[k] for k in ids_a]) == raw):
            return None
        a, b, borders = np.array(ids_a, np.int64), np.array(ids_b, np.int64), np.cumsum(sizes)
        a_ends, b_ends = a_sizes[a].cumsum(), b_sizes[b].cumsum()
        last_a, last_b = a_ends.searchsorted(borders), b_ends.searchsorted(borders)
        if (a_ends[last_a] != borders).any() or (b_ends[last_b] != borders).any():
            return None
        left, right, first = diagonal_links(a_ends, b_ends)
        groups, ends = group_text(a, b, left, right, first, texts_of)
        pairs = (b[right] * size_a + a[left]).tobytes()
        out, n, at, link = [], 0, 0, 0
        for n_to, to, link_to in zip((last_a + 1).tolist(), ends[last_b].tolist(), right.searchsorted(last_b, "right").tolist()):
            out.append((n_to - n, groups[at:to], pairs[8 * link:8 * link_to]))
            n, at, link = n_to, to, link_to
        return out

    def run(segments: list[str]) -> list[tuple[int, bytes, bytes]] | None:
        spaced = "".join(segments)
        # B puts a blank before what it gets: the text's own, or one that is taken off again
        ids_b = model.encode(spaced[1:] if spaced[0] == " " else spaced)
        if spaced[0] != " ":
            if ids_b[:1] != [blank_b]:
                return None
            ids_b = ids_b[1:]
        return align(spaced, ids_b, [len(s) if s.isascii() else len(s.encode()) for s in segments])

    def whole(text: str) -> tuple[int, bytes, bytes] | None:
        spaced = " " + text
        got = align(spaced, model.encode(text), [len(spaced.encode())])
        return got and got[0]

    def segments_of(text: str) -> list[str] | None:
        if not separable or "\u2581" in text or _OTHER_SPACE(text):
            return None
        return _SEGMENTS(" " + text)

    def in_runs(segments: list[str]) -> dict:
        # white space without a word, at the end of a text, would join the next segment
        found, words = {}, [s for s in segments if s[-1] not in " \n"]
        runs = [words[lo:lo + _RUN] for lo in range(0, len(words), _RUN)] + [[s] for s in segments if s[-1] in " \n"]
        while runs:
            part = runs.pop()
            got = run(part)
            if got is None and len(part) > 1:
                size = -(-len(part) // 16)
                runs += [part[lo:lo + size] for lo in range(0, len(part), size)]
            else:
                found.update(zip(part, got or [None]))
        return found

    memo: dict[str, tuple[int, bytes, bytes] | None] = {}
    before: dict[str, tuple[int, bytes, bytes] | None] = {}

    def recall(segments: set[str]) -> set[str]:
        """Take back what was remembered before; gives the others."""
        known = {s: before[s] for s in segments if s in before}
        memo.update(known)
        return segments.difference(known)

    def learn(segments: set[str]) -> set[str]:
        """Put segments, and what they are made of, into the memory; gives what was put there."""
        new = recall(segments)
        marked = {s: (m[1], " a" + m[2]) for s in new if (m := _MARKED(s))} if apart else {}
        bases = {" a", *(x for both in marked.values() for x in both)}.difference(memo)
        memo.update(in_runs([*recall(bases), *new.difference(marked, bases)]))
        one = memo[" a"]
        for s, (word, marks) in marked.items():
            x, y = memo[word], memo[marks]
            memo[s] = x and y and one and (x[0] + y[0] - one[0], x[1] + y[1][len(one[1]):], x[2] + y[2][len(one[2]):])
        return segments | bases

    def aligned(texts: list[str]) -> list[tuple[int, bytes, bytes] | None]:
        nonlocal memo, before
        if len(memo) > _MEMO:
            memo, before = {}, memo
        cut = [segments_of(t) if t else None for t in texts]
        new = learn(set().union(*(c for c in cut if c)).difference(memo))
        out = []
        for text, segments in zip(texts, cut):
            parts = list(map(memo.__getitem__, segments or ()))
            if not text:
                out.append(None)
            elif segments is None or not all(parts):
                out.append(whole(text))
            else:
                n, groups, pairs = zip(*parts)
                out.append((sum(n), b"".join(groups), b"".join(pairs)))
        for s in new:
            if len(s) > _MEMO_CHARS:
                del memo[s]
        return out

    return aligned


def aligned_documents(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked id pairs with their counts.

    A pair is written as B id * number of A's ids + A id.
    """
    docs = documents_of(df, id_col, text_col).withColumn("text", F.col("text").cast("string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        align = aligner(path_a, path_b)
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.slice(lo, _ROWS)
                numbers, digests, pairs, times, offsets = [], [], [], [], [0]
                for got in align(part.column("text").to_pylist()):
                    if got is None:
                        numbers.append((0, 0, 0, 0))
                        digests.append("")
                    else:
                        n_a, groups, links = got
                        # a group of m and n tokens has m + n - 1 links
                        n_groups, n_links = groups.count(b";"), len(links) // 8
                        numbers.append((n_a, n_links + n_groups - n_a, n_groups, n_links))
                        digests.append(hashlib.sha256(groups[:-1]).hexdigest())
                        pair, count = np.unique(np.frombuffer(links, np.int64), return_counts=True)
                        pairs.append(pair)
                        times.append(count)
                    offsets.append(offsets[-1] + (len(pairs[-1]) if got is not None else 0))
                none = np.zeros(0, np.int64)
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([none, *x]).astype(kind)))
                    for x, kind in ((pairs, np.int64), (times, np.int32))]
                columns = [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in zip(*numbers)], pa.array(digests, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        work, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<long>, times array<int>")


def _border(counts: DataFrame, frequent: int) -> int:
    """Smallest level of counts, in quarters of a doubling, above which lie at most `frequent` pairs."""
    sizes = {r["level"]: r["size"] for r in counts.groupBy("level").agg(F.count("*").alias("size")).collect()}
    border, total = max(sizes, default=0) + 1, 0
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > frequent:
            break
        border = level
    return border


def align_tokenizers(
    df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of `df`.

    Null and empty texts, and texts that B does not give back byte by byte (such as those with U+2581),
    have zeros and an empty digest.  Texts of any length are aligned whole.  Rows that repeat an id or a
    text come out each and count each; ids may be null; other columns are not looked at.  Links that share
    a B id's highest count are all best.  An empty table gives no rows.
    """
    encoded = stored(aligned_documents(df, path_a, path_b, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    linked = encoded.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    from tokenizers import Tokenizer

    size_a = Tokenizer.from_file(path_a).get_vocab_size()
    totals = linked.groupBy("pair").agg(F.sum("times").alias("n"))
    # a B id has at most as many pairs as A has ids
    highest = F.max("n").over(Window.partitionBy(F.expr(f"pair div {size_a}")))
    counts = stored(totals.select(
        "pair", "n", (F.col("n") == highest).alias("best"), F.floor(F.log2("n") * 4).cast("int").alias("level")))
    border = _border(counts, frequent)
    head = F.broadcast(counts.where(F.col("level") >= border).drop("level"))

    def sums(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"))

    rare = counts.where(F.col("level") < border).drop("level")
    known = sums(linked.join(head, "pair")).unionByName(sums(linked.join(head.select("pair"), "pair", "left_anti").join(rare, "pair")))
    both = known.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    zero = F.lit(0).cast("long")
    return encoded.drop("pairs", "times").join(both, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
