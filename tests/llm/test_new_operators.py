"""Tokenizer alignment, hard negatives and URL verdicts beside plain versions; ties, variants and long licence files."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from test_llm_operators import CLASH, LONG, ODD
from tidemark.llm import alignment, hardnegatives, licenses, neighbours, packing, pii, queries, urlfilter
from tidemark.llm.tables import table

A, B = packing.tokenizer_path(), packing.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    kind = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in (*CLASH, "pairs", "times", "n"))
    return spark.createDataFrame([(i, t, *["?"] * (len(CLASH) + 3)) for i, t in ODD], kind)


# ---- alignment

def plain_tokens(text):
    """(id, bytes) of A and B, None where a side does not give the text back."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not hasattr(plain_tokens, "models"):
        tok = Tokenizer.from_file(A)
        tok.encode_special_tokens = True
        plain_tokens.models = tok, SentencePieceProcessor(model_file=B)
    tok, sp = plain_tokens.models
    if not text:
        return None
    spaced = " " + text
    e = tok.encode(spaced, add_special_tokens=False)
    raw = spaced.encode()
    starts = np.concatenate([[0], np.cumsum([len(c.encode()) for c in spaced])])
    a, done = [], 0
    for k, token in zip(e.ids, e.tokens):
        a.append((k, len(token)))
        done += len(token)
    assert done == len(raw) == starts[-1]
    b = [(k, bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode())
         for k in sp.encode(text)]
    return (a, [(k, len(x)) for k, x in b]) if b"".join(x for _, x in b) == raw else None


def plain_alignment(texts):
    """Rows of the query, by comparing all byte ranges."""
    out, pairs = [], Counter()
    for text in texts:
        found = plain_tokens(text)
        if found is None:
            out.append(((0, 0, 0, 0, ""), []))
            continue
        a, b = ([(k, int(end) - n, int(end)) for (k, n), end in zip(x, np.cumsum([n for _, n in x]))] for x in found)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(k) for k, s, e in x if lo <= s and e <= hi) for x in (a, b)))
            lo = hi
        near = [(x, y) for x, s, e in a for y, t, u in b if s < u and t < e]
        out.append(((len(a), len(b), len(groups), len(near), hashlib.sha256(";".join(groups).encode()).hexdigest()), near))
        pairs.update(near)
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    return [(*head[:4], sum(pairs[p] == most[p[1]] for p in near), sum(pairs[p] for p in near), head[4]) for head, near in out]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("frequent", [0, 40, alignment.FREQUENT])
def test_alignment_equals_plain_version(spark, frequent):
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \n\t ab.,'s1é▁<|endoftext|>あ\U0001f600\x00- ") for _ in range(rng.randint(1, 50)))
             for _ in range(150)]
    texts += [r["text"][:600] for r in table(spark, SF, "documents").where("text is not null").limit(40).collect()]
    texts += ["<|endoftext|> <s> </s> <unk> <0x41>", " ", "", None, texts[0], texts[-1], texts[-1], "x" * 3000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align_tokenizers(rows, A, B, frequent=frequent).collect()}
    assert got == dict(enumerate(plain_alignment(texts)))


def test_long_one_to_one_runs_are_jumped():
    rng = np.random.default_rng(1)
    for _ in range(200):
        ends = np.unique(rng.integers(1, 400, 120))
        a = ends[rng.random(len(ends)) < 0.9]
        b = ends[rng.random(len(ends)) < 0.9]
        a, b = np.union1d(a, ends[-1:]), np.union1d(b, ends[-1:])
        left, right, first = alignment.diagonal_links(a, b)
        s, t = np.append(0, a[:-1]), np.append(0, b[:-1])
        assert list(zip(left.tolist(), right.tolist())) == [
            (i, j) for i in range(len(a)) for j in range(len(b)) if s[i] < b[j] and t[j] < a[i]]
        assert first.sum() == len(np.intersect1d(a, b))


def test_diagonal_links_keep_one_mark_per_link():
    """What is kept on the way is a byte per link, not four Python objects."""
    import tracemalloc

    rng = np.random.default_rng(8)
    a, b = (np.append(np.unique(rng.integers(1, 400_000, 100_000)), 400_000) for _ in range(2))
    tracemalloc.start()
    left, right, first = alignment.diagonal_links(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ends = np.union1d(a, b)
    assert (left == np.searchsorted(a, ends)).all() and (right == np.searchsorted(b, ends)).all()
    assert (first == np.r_[True, np.isin(ends, np.intersect1d(a, b))[:-1]]).all()
    assert most < 18_000_000


def test_words_are_aligned_once(monkeypatch):
    """A word met before, alone or with other marks after it, is neither encoded nor aligned again."""
    calls, real = [], alignment.diagonal_links
    monkeypatch.setattr(alignment, "diagonal_links", lambda a, b: calls.append(len(a)) or real(a, b))
    alignment.aligner.cache_clear()
    align = alignment.aligner(A, B)
    words = [f"{x}{y}ning" for x in ("qua", "bre", "\xe9to", "Zu") for y in ("ker", "lo", "\xdfe", "pim")]
    first = align([" ".join(words), " ".join(w + "," for w in words[:8]) + "\n" + words[0] + "."])
    assert len(calls) <= 3
    calls.clear()
    texts = [" ".join(words[k:] + words[:k]) for k in range(8)]
    texts += [" ".join(w + "," for w in words), " ".join(w + "." for w in words) + "\n" + words[0] + "."]
    again = align(texts)
    # only the words that come with a line feed or marks not met before are new
    assert sum(calls) < 30
    whole = alignment.aligner.__wrapped__(A, B)
    monkeypatch.setattr(alignment, "_OTHER_SPACE", lambda text: True)
    assert again == whole(texts) and first[:1] == whole([" ".join(words)])
    alignment.aligner.cache_clear()


def test_segments_that_b_changes_do_not_spoil_their_run():
    texts = ["don't stop,, it's  (so)... ", "a \u2581b c", "x\ty z", "  lead\n\n \ntail  ", "", "a\x00b c!! \U0001f600\u200d\U0001f600.", "<s> <unk> [x]"]
    got = alignment.aligner(A, B)(texts)
    for text, found in zip(texts, got):
        tokens = plain_tokens(text)
        assert (found is None) == (tokens is None)
        if found:
            n_a, groups, links = found
            assert n_a == len(tokens[0]) and len(links) // 8 + groups.count(b";") - n_a == len(tokens[1])
            assert [int(x) for x in groups.replace(b"|", b",").replace(b";", b",").split(b",")[:-1]] and (
                [int(x) for g in groups.split(b";")[:-1] for x in g.split(b"|")[0].split(b",")] == [k for k, _ in tokens[0]])


def test_alignment_odd_rows(odd):
    got = alignment.align_tokenizers(odd, A, B).select("doc_id", *COLUMNS).collect()
    # corpus-wide counts are those of all rows, so only what a row has of its own is compared
    short = [(i, t) for i, t in ODD if len(t or "") < 9000]
    want = Counter((i, *row[:4], row[6]) for (i, _), row in zip(short, plain_alignment([t for _, t in short])))
    assert Counter((r[0], *r[1:5], r[7]) for r in got if r["doc_id"] not in (5, 6)) == want
    assert {r["doc_id"] for r in got if r["n_links"] > 9000} == {5, 6} and len(got) == len(ODD)
    assert alignment.align_tokenizers(odd.limit(0), A, B).count() == 0


# ---- hard negatives

def plain_negatives(rows, every=100):
    ids, label = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    q = np.floor(256 * np.array([r[2] for r in rows], np.float64)).astype(np.int64)
    out = set()
    for a in np.flatnonzero(ids % every == 0):
        s = q @ q[a]
        order = np.lexsort((ids, -s))
        for p in [i for i in order if label[i] == label[a] and ids[i] != ids[a]][:5]:
            near = [i for i in order if label[i] != label[a] and 80 * s[p] <= 100 * s[i] <= 100 * s[p]][:5]
            out |= {(int(ids[a]), int(ids[p]), k, int(ids[i]), int(s[p]), int(s[i])) for k, i in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("shape", ["clusters", "ties", "one vector"])
def test_hard_negatives_equal_plain_version(spark, shape):
    rng = np.random.default_rng(5)
    if shape == "clusters":
        centres = rng.normal(0, 1, (6, 5))
        vectors = centres[rng.integers(0, 6, 900)] + rng.normal(0, 0.1, (900, 5))
    elif shape == "ties":
        vectors = rng.integers(-1, 2, (900, 3)).astype(float)
    else:
        vectors = np.where(rng.random((900, 1)) < 0.5, 0.25, rng.normal(0, 1, (900, 4)))
    rows = [(i, int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = hardnegatives.hard_negatives(df, every=30, page=8, tile_rows=100, block=16, ranges=3).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == plain_negatives(rows, 30)


def test_hard_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    kind = "vec_id long, label int, embedding array<double>, tile string, score string, window string, part string"
    good = [(100, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0]), (3, 2, [0.9, 0.0]), (4, 2, [0.5, 0.0]), (5, 3, [1.0, 0.2])]
    bad = [(6, None, [1.0, 0.0]), (7, 2, None), (8, 2, []), (9, 2, [1.0, None]), (10, 2, [nan, 1.0]), (11, 2, [inf, 1.0]),
           (None, 2, [1.0, 1.0]), (12, 2, [1.0, 1.0, 1.0]), (13, 2, [1e300, 0.0])]
    df = spark.createDataFrame([(*r, "?", "?", "?", "?") for r in (*good, good[0], *bad)], kind)
    assert set(map(tuple, hardnegatives.hard_negatives(df).collect())) == plain_negatives(good)
    assert hardnegatives.hard_negatives(df.limit(0)).count() == 0
    assert hardnegatives.hard_negatives(df.where("vec_id = 100")).count() == 0


# ---- url filter

URLS = [
    (1, "http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
    (2, "https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    (3, "ftp://net/", "net", "/", "net/", "block"), (4, "http://x.net", "x.net", "", None, None),
    (5, "http://x.org/fr/?q=://y", "x.org", "/fr/", "org/fr/", "allow"), (6, "http://notnet/", "notnet", "/", None, None),
    (7, "http://x.net:80/", "x.net:80", "/", None, None), (8, "//x.net/", "", "", None, None), (9, None, "", "", None, None),
    (10, "", "", "", None, None), (11, "://?a", "", "", None, None), (12, "http://ÉÄ.NET/\n/a", "ÉÄ.net", "/\n/a", "net/", "block"),
    (None, "http://example.net/de/", "example.net", "/de/", "net/", "block"), (1, "http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
    (13, "http://" + "w" * 50_000 + ".net/" + "p" * 50_000, "w" * 50_000 + ".net", "/" + "p" * 50_000, "net/", "block"),
]


@pytest.fixture(scope="module")
def url_model(spark):
    return urlfilter.train(urlfilter.labelled_urls(spark))


def test_url_parts_and_rules(spark, url_model):
    df = spark.createDataFrame([(i, u, "?", "?", "?") for i, u, *_ in URLS], "page_id long, url string, host string, rule string, score string")
    got = urlfilter.judge_urls(df, url_model).collect()
    want = Counter((i, h, p, r) for i, _, h, p, r, _ in URLS)
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == want
    verdicts = {i: v for i, *_, v in URLS if v}
    assert all(r["verdict"] == verdicts.get(r["page_id"], r["verdict"]) and r["verdict"] in ("allow", "block") for r in got)
    assert urlfilter.judge_urls(df.limit(0), url_model).count() == 0


def test_url_model_tells_labels_and_unseen_hosts_apart(spark, url_model):
    seen = urlfilter.judge_urls(urlfilter.labelled_urls(spark).withColumn("page_id", F.col("label")), url_model, rules=())
    assert all(r["verdict"] == ("block" if r["page_id"] else "allow") for r in seen.collect())
    words = ("casino-win", "ads-track", "free-bets", "spam-farm", "cheap-pills")
    pages = table(spark, SF, "pages")
    out = urlfilter.judge_urls(pages, url_model).where("rule is null").collect()
    assert all(r["verdict"] == "block" for r in out if any(w in r["host"] for w in words))
    clean = [r["verdict"] for r in out if "-" not in r["host"]]
    assert clean.count("allow") >= 0.95 * len(clean)


def test_url_model_of_an_empty_table(spark):
    weights, bias = urlfilter.train(spark.createDataFrame([], "url string, label int"))
    assert bias == 0 and not any(weights)


# ---- neighbours and licences

def test_neighbours_keep_the_smallest_ids_of_ties(spark):
    df = spark.range(12_001).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("embedding"))
    got = neighbours.nearest(df, every=100_000, share=1e9).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(i, 1.0) for i in range(1, 21)]


def test_neighbours_recall_with_leaves_left_out(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (60, 24))[rng.integers(0, 60, 12_000)] + rng.normal(0, 0.3, (12_000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, every=60, least=0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = x[::60] @ x.T
    scores[np.arange(200), np.arange(0, 12_000, 60)] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :20]
    recall = np.mean([len(got[60 * k] & set(map(int, b))) / 20 for k, b in enumerate(best)])
    assert recall >= 0.9


def test_license_versions_and_variants(spark):
    lines = {
        "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.", "LGPL-3.0": licenses._GPL.format("Lesser ", "3"),
        "GPL-3.0": licenses._GPL.format("", "3"), "AGPL-3.0": licenses._GPL.format("Affero ", "3"), "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
        "BSD-2-Clause": licenses._BSD, "BSD-3-Clause": licenses._BSD + licenses._THIRD, "LGPL-2.1": licenses._GNU.format("Lesser ", "2.1"),
    }
    data = [(k, f"s/{k}.py", text) for k, text in enumerate(lines.values())] + [(99, "s/x.py", "Licensed under the GNU General Public License, version 9.")]
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, path string, text string")).collect()}
    assert got == {**dict(enumerate(lines)), 99: None}


def test_license_cosine_equals_plain_version(spark):
    import math
    import re

    def terms(text):
        return [t for t in re.split(r"[^a-z0-9.-]+|[.](?=\s|$)", text.lower()) if t]

    headers = ["Licensed under CC BY 4.0.", "Licensed under CC BY 4.0.", "Released under the MIT License. Copyright 2020 somebody", "All rights reserved."]
    got = {r["license"]: r["cosine"] for r in licenses.header_scores(
        spark.createDataFrame([(h,) for h in headers], "header string").select("header", F.unhex(F.sha2("header", 256)).alias("hid"))).collect()}
    df = Counter(t for h in headers for t in set(terms(h)))
    idf = {t: math.log((len(headers) + 1) / (df[t] + 1)) + 1 for h in (*headers, *(x[3] for x in licenses.TEMPLATES)) for t in terms(h)}
    vector = lambda text: {t: n * idf[t] for t, n in Counter(terms(text)).items()}
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))
    for h, name in zip(headers, ("CC-BY-4.0", "CC-BY-4.0", "MIT", "proprietary")):
        x = vector(h)
        y = vector(next(t[3] for t in licenses.TEMPLATES if t[0] == name))
        assert got[name] == pytest.approx(sum(w * y.get(t, 0) for t, w in x.items()) / norm(x) / norm(y), abs=1e-8)


def test_a_license_file_of_a_megabyte(spark):
    text = licenses.TEMPLATES[1][3] + "\n" + " ".join(f"word{i}" for i in range(130_000))
    data = [(1, "a/LICENSE", text), (2, "a/b.py", "x = 1"), (3, "a/LICENSE.txt", "Released under the MIT License.")]
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, path string, text string"), least=0.01).collect()}
    assert len(text) > 1_000_000 and got == {1: "Apache-2.0", 2: "Apache-2.0", 3: "MIT"}


def test_spans_outside_others():
    """The sweep against every pair; taken spans overlap, repeat and touch, or there are none."""
    rng = random.Random(5)
    for n in (0, 1, 3, 30):
        for _ in range(200):
            taken = [(a, a + rng.randint(1, 12)) for a in (rng.randint(0, 80) for _ in range(n))]
            free = pii.outside(taken)
            for a in range(0, 90, 3):
                b = a + rng.randint(1, 9)
                assert free(a, b) == (not any(a < y and x < b for x, y in taken))


def test_personal_data_of_a_long_text_takes_linear_time():
    """Twice the text at most some thrice the time; each text holds as many base as loose candidates."""
    import time

    spans, line = pii.finder(), "write to a.b@example.com or Anna Smith, (212) 555-0147, at noon. "

    def seconds(n):
        start = time.perf_counter()
        assert len(spans(line * n)) >= 2 * n
        return time.perf_counter() - start

    seconds(200)
    assert seconds(4_000) < 6 * seconds(2_000)
