"""The dealt operators beside plain versions on the smallest tables and on small odd ones."""

import functools
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest import SF
from oracle import compare
from tidemark.llm import (
    components, credentials, decontaminate, language, licenses, linechunks, neighbours, packing, pii, quality, queries,
    simhash,
)
from tidemark.llm.tables import table

LONG = "lorem ipsum dolor sit amet " * 4000
ODD = [
    (1, "The cat sat on the mat.\nIt was warm there.\nThen it left."), (2, None), (3, ""), (4, " \n\t "), (5, "x" * 200_000),
    (6, LONG), (7, "The cat sat on the mat.\nIt was warm there.\nThen it left."),
    (7, "The cat sat on the mat.\nIt was warm there.\nThen it left."), (None, "Nobody owns this text, it has no id."),
    (None, None), (8, "1234 5678 !!"), (9, "Écrivez à anna@exemple.fr, tél. +33 1 23 45 67 89 10"), (10, "a\x00b \u2028 <|endoftext|> c"),
]
#: names that the operators use inside
CLASH = ("fp", "h", "gone", "row", "row_id", "score", "component", "lang_pred", "marks", "pos", "leaks", "slot", "kept")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return {r["doc_id"]: r for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    data = [(i, t, "en" if k % 3 else None, "s", len(t or ""), *["?"] * len(CLASH)) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(data, kind)


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# ---- near duplicates

def test_simhash_equals_brute_force(spark, rows):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op2_simhash"](spark, SF).collect()}
    ids = sorted(rows)
    values = [brute.fingerprint(rows[i]["text"]) for i in ids]
    labels = brute.components(values)
    least = {}
    for i, label in zip(ids, labels):
        least.setdefault(label, i)
    assert got == {i: (f"{v:016x}", least[c]) for i, v, c in zip(ids, values, labels)}


@pytest.mark.parametrize("slice_rows", [2, 1024])
def test_links_span_the_components(spark, slice_rows):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2**63, 4)
    values = {int(c) ^ int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) & (2**63 - 1))
              for c in centres for _ in range(40)} | set(map(int, rng.integers(0, 2**63, 50)))
    values = sorted(values)
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"), slice_rows=slice_rows)
    label = dict(zip(values, brute.components(values)))
    got = {r["node"]: r["component"] for r in components.component_of(links).collect()}
    for a, b in itertools.combinations(values, 2):
        assert (got.get(a, a) == got.get(b, b)) == (label[a] == label[b])


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.component_of(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 160), 100)}
    assert components.component_of(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {2, 3, 4, None} and {r["component_id"] for r in zero} == {2}
    kept = counted(simhash.one_of_each(odd), "doc_id", "source")
    assert kept[(1, "s")] == 1 and (7, "s") not in kept and kept[(2, "s")] == 1 and (3, "s") not in kept
    assert simhash.one_of_each(odd).columns == odd.columns
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


# ---- line chunks

def test_line_dedup_equals_sql(spark, duck):
    assert compare(queries.QUERIES["op5_line_dedup"](spark, SF), duck, queries.ORACLES["op5_line_dedup"]) is None


def test_line_dedup_equals_plain_version(spark, rows):
    seen, want = set(), {}
    for i in sorted(rows):
        kept, n, gone = [], 0, 0
        for _, size, body in brute.chunks(rows[i]["text"]):
            n += size
            if size >= 2 and body in seen:
                gone += size
            else:
                kept.append(body)
                seen.add(body)
        want[i] = ("\n".join(kept), n, gone)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in queries.QUERIES["op5_line_dedup"](spark, SF).collect()}
    assert got == want and any(w[2] for w in want.values())


def test_line_chunks_take_exact_copies_whole(spark):
    texts = ["\n".join(f"text {d} line {i}" for i in range(n)) for d, n in enumerate([1, 2, 3, 4, 5, 6, 9, 40])]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    for r in linechunks.dedup_lines(df).collect():
        doc, n = r["row"]["doc_id"], r["n_lines"]
        assert r["n_removed"] == (n if doc >= len(texts) and n > 1 else 0)
    assert all(n >= 2 for t in texts[1:] for _, n, _ in brute.chunks(t))


def test_line_dedup_odd_rows(spark, odd):
    found = linechunks.dedup_lines(odd)
    got = found.select("row.doc_id", "row.text", "kept_text", "n_lines", "n_removed").collect()
    assert len(got) == len(ODD)
    for r in got:
        if r["doc_id"] == 7:
            assert r["n_removed"] >= 2 or not any(n >= 2 for _, n, _ in brute.chunks(r["text"]))
        else:
            assert r["kept_text"] == r["text"] and r["n_removed"] == 0
    assert found.select("row.*").columns == odd.columns
    assert linechunks.dedup_lines(odd.limit(0)).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_copies_of_lines_go_whole(spark):
    texts = ["\n".join(f"document {d} line {i} {'words ' * (i % 7)}" for i in range(n)) for d, n in enumerate([2, 3, 4, 6, 9, 40])]
    data = list(enumerate(texts + texts + ["\n" + texts[2] + "\n", "a\na\na", "x\n \ny", "y\nx\n \ny\nz"])) + [(None, texts[0])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["kept_text"] for r in linechunks.dedup_runs(df).collect() if r["row"]["doc_id"] is not None}
    n = len(texts)
    assert [got[i] for i in range(2 * n)] == texts + [""] * n
    assert [got[2 * n + k] for k in range(4)] == ["", "a\na\na", "x\n \ny", "y\nz"]
    left = corpus_pipeline.dedup_lines(spark, df, SF)
    assert sorted(r["doc_id"] for r in left.where("doc_id is not null").collect()) == [*range(n), 2 * n + 1, 2 * n + 2, 2 * n + 3]


def test_runs_are_settled_by_chunks_first(spark):
    """Pairs inside a repeated chunk are found by the rolling hash; the check of pairs only adds what it leaves."""
    passage = [f"line {i} of a passage" for i in range(40)]
    df = spark.createDataFrame(
        [(1, "\n".join(["a", *passage, "b"])), (2, "\n".join(["c", *passage, "d"]))], "doc_id long, text string")
    settled = linechunks.pairs_of_chunks(df).collect()
    assert settled and {r["doc_id"] for r in settled} == {2}
    got = {r["row"]["doc_id"]: r["kept_text"] for r in linechunks.dedup_runs(df).collect()}
    assert got == {1: "\n".join(["a", *passage, "b"]), 2: "c\nd"}
    lines = {n for r in settled for n in range(r["pos"], r["end"] + 1)}
    assert lines <= set(range(1, 41))


def test_repeated_runs_equal_plain_version(spark, docs, rows):
    first, want, short = {}, {}, 0
    for d in sorted(rows):
        lines, gone = rows[d]["text"].split("\n"), set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            at = first.setdefault(pair, (d, i))
            if at[0] != d or i > at[1] + 1:
                gone |= {i, i + 1}
        kept = [x for i, x in enumerate(lines) if i not in gone]
        want[d] = ("\n".join(kept), len(lines), len(gone))
        short += len(gone) in (2, 3)
    got = {r["row"]["doc_id"]: (r["kept_text"], r["n_lines"], r["n_removed"]) for r in linechunks.dedup_runs(docs).collect()}
    assert got == want and short
    for r in corpus_pipeline.dedup_lines(spark, docs, SF).collect():
        assert r["text"] == want[r["doc_id"]][0]


# ---- packing

def test_packing_round_trip(spark, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    got = queries.QUERIES["op6_packing"](spark, SF).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    total = 0
    for i, row in rows.items():
        ids = np.array(tok.encode(row["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        at, pieces = 0, sorted(by_doc[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 1024)
        for p in pieces:
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
        total += at
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    assert len(by_sequence) <= 1.02 * -(-total // 1024) + 1


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab c\n.\t'é\u00a01<|>\u2028", max_size=60))
def test_remembered_words_give_the_same_ids(text):
    tok, encode = _tokenizers()
    whole = np.array(tok.encode(text, add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert encode([text, "a b", None])[0] == whole


@functools.cache
def _tokenizers():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    return Tokenizer.from_file(path), packing.encoder(path)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 40))
def test_fullest_is_the_best_subset(counts, room):
    chosen = packing.fullest(counts, room)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    assert sum(chosen) == max(s for s in sums if s <= room)
    assert all(c <= counts[x] for x, c in Counter(chosen).items())


def test_packing_odd_rows(odd):
    got = packing.pack(odd, packing.tokenizer_path()).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in ODD}
    assert sum(r["doc_id"] == 7 and r["piece"] == 0 for r in got) == 2
    assert [(r["length"], r["start"]) for r in got if r["doc_id"] in (2, 3)] == [(1, 0)] * 2
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert packing.pack(odd.limit(0), packing.tokenizer_path()).count() == 0


# ---- spans

@pytest.mark.parametrize("name,kinds", [("op7_pii", brute.PERSONAL), ("op10_secrets", brute.SECRET)])
def test_base_spans(spark, rows, name, kinds):
    for r in queries.QUERIES[name](spark, SF).collect():
        want = brute.spans(rows[r["doc_id"]]["text"], kinds)
        assert r["base_sha256"] == brute.digest(want)
        assert set(f"{n}:{a}:{b}" for a, _, b, n in want) <= set(r["spans"].split(","))
        for kind, _, _ in kinds:
            assert r[f"n_{kind}"] == sum(w[3] == kind for w in want)


_NEAR = st.text(alphabet="ab1234.5 @+-()6789=:'\"token_apikeyAKIASECRET\n", max_size=80)


@settings(max_examples=300, deadline=None)
@given(_NEAR)
def test_base_spans_of_any_text(text):
    found = [(a, k, b, pii.KINDS[k]) for a, k, b, *_ in pii.finder()(text) if pii.KINDS[k] in pii.BASE]
    assert found == brute.spans(text, brute.PERSONAL)
    found = [(a, k, b, credentials.KINDS[k]) for a, k, b in credentials.finder()(text) if k < 3]
    assert found == brute.spans(text, brute.SECRET)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdef0123456789", max_size=60), st.integers(2, 12), st.floats(0.5, 3.5))
def test_entropy_windows(run, window, least):
    covered = set()
    for i in range(len(run) - window + 1):
        c = Counter(run[i:i + window])
        h = -sum(v / window * np.log2(v / window) for v in c.values())
        if abs(h - least) < 1e-6:
            return
        if h >= least:
            covered |= set(range(i, i + window))
    found = credentials.entropy_windows(run, window, least)
    assert {x for a, b in found for x in range(a, b)} == covered


def test_entropy_finds_and_suppresses(spark):
    data = [(1, "key Zq8xT3vLm9Rw2KpYd7Hs4Jc6 end"), (2, "id 123e4567-e89b-12d3-a456-426614174000"), (3, "abcabcabcabcabc1abcabcabcabc"),
            (4, "see example-Zq8xT3vLm9Rw2KpYd7Hs4Jc6"), (5, None)]
    got = {r["doc_id"]: [s["kind"] for s in r["found"]] for r in
           credentials.find_secrets(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: ["entropy"], 2: [], 3: ["hex"], 4: [], 5: []}


@pytest.mark.parametrize("digits", ["0123456789ABCDEF", "0123456789abcdef"])
@pytest.mark.parametrize("name", ["SESSION=", "key_", "a-b-"])
def test_entropy_of_hex_behind_a_name(digits, name):
    rng, spans = np.random.default_rng(3), credentials.finder()
    for n in (24, 32, 40, 64):
        for _ in range(200):
            secret = "".join(rng.choice(list(digits), n))
            bare = {(a, b) for a, k, b in spans(secret) if k == 3}
            named = [(a - len(name), b - len(name)) for a, k, b in spans(name + secret) if k == 3]
            assert all(any(lo <= a and b <= hi for lo, hi in named) for a, b in bare)


def test_allow_list_is_local():
    rng, spans = np.random.default_rng(4), credentials.finder()
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    secret = "Zq8xT3vLm9Rw2KpYd7Hs4Jc6"

    def covered(text):
        return sum(b - a for a, k, b in spans(text) if k == 3)

    for word in ("", "www", "http", "xxxx", "dummy", "sample"):
        long = "".join(rng.choice(alphabet, 20_000))
        assert covered(long[:9_000] + word + long[9_000:]) > 19_000
    assert covered("sample_id=" + secret) >= len(secret)
    assert covered("3fXa/kQ9zB2/mT7wLr5Y+cD8") > 0
    assert covered("/usr/local/share/" + secret + "/etc/ssl/conf/") >= len(secret)
    for text in ("example-" + secret, secret + "EXAMPLEKEY", "x_id=123e4567-e89b-12d3-a456-426614174000",
                 "/articles/2024/reports/Summary3/page-12/list", "www-" + secret):
        assert covered(text) == 0, text


def test_personal_data_added_spans(spark):
    text = "Contact Dr. Anna Miller, phone (555) 234-8765, mail anna [at] home [dot] org or a@b.com."
    data = [(i, text) for i in range(20)] + [(50 + i, f"build 10.2.3.{i} order 555-234-{8000 + i}") for i in range(20)]
    got = pii.find_personal_data(spark.createDataFrame(data, "doc_id long, text string")).where("doc_id = 3").first()
    kinds = {s["kind"]: text[s["start"]:s["end"]] for s in got["found"]}
    assert kinds["email"] == "a@b.com" and set(kinds) & set(pii.ADDED)


def test_em_finds_the_reliable_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    right = (0.95, 0.9, 0.9, 0.6, 0.55)
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in right], axis=1)
    codes = ((votes + 1) * 3 ** np.arange(5)).sum(axis=1)
    cells, n = np.unique(codes * pii.SHAPES, return_counts=True)
    post, tables = pii.estimate(cells, n.astype(float))
    assert tables[0, 1, 2] > 0.9 and tables[4, 1, 2] < 0.7
    guess = dict(zip(cells, post >= 0.5))
    assert np.mean([guess[c * pii.SHAPES] == t for c, t in zip(codes, truth)]) > 0.95


def test_span_odd_rows(odd):
    for found in (pii.find_personal_data, credentials.find_secrets):
        got = found(odd).collect()
        assert len(got) == len(ODD) and all(not r["found"] for r in got if r["doc_id"] in (2, 3, 4))
        assert found(odd.limit(0)).count() == 0


# ---- classifiers

def test_language_held_out(spark, rows):
    got = queries.QUERIES["op9_language"](spark, SF).collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (brute.held(r["doc_id"], 5) == 0) for r in got)
    assert np.mean([r["lang_pred"] == rows[r["doc_id"]]["lang"] for r in held]) > 0.97


def test_language_odd_rows(spark, docs, odd):
    model = language.learned(docs)
    got = language.identify(odd, model).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (2, 3, 4, 8) or (r["doc_id"] is None and r["score"] == 0))
        assert 0 <= r["score"] <= 1
    assert language.recognised(odd, model).columns == odd.columns
    nothing = language.learned(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}
    assert language.identify(odd.limit(0), model).count() == 0


def test_language_backs_off_to_shorter_grams(spark):
    data = [(i, t, lang) for i, (t, lang) in enumerate([("schnell durch schule", "de"), ("the quick through", "en")] * 10)]
    model = language.fit(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    new = spark.createDataFrame([(1, "schulern"), (2, "thequ"), (3, "zz")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(new, model).collect()}
    assert got[1] == "de" and got[2] == "en" and got[3] in ("de", "en")


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    got = queries.QUERIES["op8_quality"](spark, sf).collect()
    assert all(r["held_out"] == (brute.held(r["doc_id"], 4) == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.9


def test_quality_odd_rows(spark, docs, odd):
    model = quality.learned(docs, table(spark, SF, "labels"))
    got = quality.score_documents(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    nothing = quality.learned(docs, table(spark, SF, "labels").limit(0))
    assert quality.score_documents(odd, nothing).count() == len(ODD)
    assert quality.score_documents(odd.limit(0), model).count() == 0


def test_bucket_blocks_count_words_and_runs():
    sizes = [len(b) for b in quality.bucket_blocks("ab cde f")]
    assert sizes == [6, 5, 3]
    a, b = (list(quality.bucket_blocks(t))[-1] for t in ("one two one", "two one"))
    assert a[0] == a[2] == b[1] and a[1] == b[0]


# ---- neighbours

def test_neighbours_recall(spark):
    rows = table(spark, SF, "embeddings").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    # a small forest with a small budget, so that leaves are left out
    got = neighbours.nearest(table(spark, SF, "embeddings"), trees=6, depth=3).collect()
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        want = ids[np.lexsort((ids, -s))[:20]]
        own = sorted((r for r in got if r["query_id"] == ids[i]), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert np.allclose([r["score"] for r in own], [x[ids == r["vec_id"]][0] @ x[i] for r in own], atol=1e-12)
        hits += len(set(want) & {r["vec_id"] for r in own})
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_queue_stops_at_its_budget():
    rng = np.random.default_rng(2)
    sample = rng.standard_normal((400, 8))
    forest = neighbours.grow(sample, trees=3, depth=4)
    leaf = neighbours.leaves_of(sample, forest)
    sizes = np.stack([np.bincount(leaf[:, t], minlength=16) for t in range(3)])
    assert sizes.sum() == 1200 and sizes.max() < 60
    margins = neighbours._margins(sample[:1], forest)[0]
    few, every = (neighbours.leaves_to_visit(margins, sizes, b) for b in (100, 1e9))
    assert few == every[:len(few)] and 100 <= sum(sizes[t, f] for t, f in few) < 160 and len(every) == 48
    assert {(t, leaf[0, t]) for t in range(3)} <= set(every[:3])


def test_neighbours_odd_rows(spark):
    kind = "vec_id long, embedding array<float>, score string, rep int"
    nan, inf = float("nan"), float("inf")
    data = [(20 * i, [1.0, 0.0], "?", 1) for i in range(30)] + [
        (5, [0.5, 0.5], "?", 1), (6, [-1.0, 0.0], "?", 1), (7, None, "?", 1), (8, [0.0, 0.0], "?", 1), (9, [nan, 1.0], "?", 1),
        (10, [inf, 1.0], "?", 1), (11, [1.0, None], "?", 1), (12, [], "?", 1), (None, [1.0, 1.0], "?", 1), (40, [1.0, 0.0], "?", 1),
        (13, [1.0, 1.0, 1.0], "?", 1),
    ]
    df = spark.createDataFrame(data, kind)
    got = neighbours.nearest(df).collect()
    for q in range(0, 600, 20):
        own = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert own == [i for i in range(0, 600, 20) if i != q][:20]
    few = neighbours.nearest(df.where("vec_id in (0, 5, 6, 8)")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(few, key=lambda r: r["rank"])] == [
        (0, 1, 5, 0.5), (0, 2, 6, -1.0)]
    assert neighbours.nearest(df.limit(0)).count() == 0


# ---- decontamination

def _plain(text):
    return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "


def test_leaks_of_whole_passages(spark, rows):
    items = {r["item_id"]: _plain(r["text"]) for r in table(spark, SF, "benchmark").collect()}
    want = {(i, k) for i, r in rows.items() for k, item in items.items() if item in _plain(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op1_decontaminate"](spark, SF).collect()}
    assert want and want <= got and len(got - want) <= 2


def test_leaks_of_paraphrases(spark, docs):
    bench = table(spark, SF, "benchmark")
    item = max(bench.collect(), key=lambda r: len(r["text"]))
    words = item["text"].split()
    changed = [w if k % 6 else "altered" for k, w in enumerate(words)]
    spread = [x for k, w in enumerate(words) for x in ((w, "so") if k % 5 == 0 else (w,))]
    data = [(-1, " ".join(changed)), (-2, "before " * 40 + " ".join(spread) + " after" * 90), (-3, " ".join(sorted(words))), (-4, "no part of it")]
    more = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(data, "doc_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(more, bench).where("doc_id < 0").collect()}
    assert got == {(-1, item["item_id"]), (-2, item["item_id"])}


def test_leaks_of_long_and_short_items(spark, docs):
    rng = np.random.default_rng(6)
    words = sorted({w for r in docs.collect() for w in re.findall(r"[^\W_]+", r["text"].lower())})
    long, short = list(rng.choice(words, 900)), list(rng.choice(words, 12))
    bench = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short))], "item_id long, text string")
    other = list(rng.choice(words, 400))
    data = [(d, " ".join(other[:17 + 5 * d] + item + other[17 + 5 * d:])) for d, item in enumerate([long, short] * 6)]
    model = decontaminate.learned(decontaminate.numbered(docs, items := decontaminate.read_items(bench)), items)
    own = decontaminate._queries_of(items[0][1])
    assert len(own) == 16 and own[0] == items[0][1] and own[-1] == items[0][1][-64:] and sum(map(len, own[1:])) >= 900
    planted = spark.createDataFrame(data, "doc_id long, text string")
    got = planted.select("doc_id", decontaminate.leak_column(model, F.col("text")).alias("found")).collect()
    assert all(1 + r["doc_id"] % 2 in {x["item_id"] for x in r["found"]} for r in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=20), st.lists(st.sampled_from("abcd"), min_size=1, max_size=20))
def test_lcs_by_bits(a, b):
    assert decontaminate.lcs_length(a, decontaminate.word_masks(b), len(b)) == brute.lcs(a, b)


def test_latin_1_is_cut_as_by_the_tokenizer(monkeypatch):
    rng, letters = np.random.default_rng(5), [*map(chr, range(256))]
    texts = ["".join(letters), "It's \xc9T\xc9_2\xb2\xa0\xdf\xb5m\xaa", "", None, *("".join(rng.choice(letters, 400)) for _ in range(50))]
    wide = [t + "\u0130\u2014x" for t in texts if t]
    tokens = decontaminate._tokenizer()
    words = [tokens(t) if t else [] for t in (*texts, *wide)]
    vocabulary = {w: k for k, w in enumerate(sorted({w for own in words for w in own if len(w) < 3}))}
    number = decontaminate._numberer(vocabulary)
    for text, own in zip((*texts, *wide), words):
        blocks, at, found = number(text)
        known = [(k // decontaminate.HALF, vocabulary[w]) for k, w in enumerate(own) if w in vocabulary]
        assert blocks == max(1, -(-len(own) // decontaminate.BLOCK)) and list(zip(at.tolist(), found.tolist())) == known

    def slow():
        def cut(text):
            raise AssertionError("Latin-1 needs no pattern")
        return cut

    monkeypatch.setattr(decontaminate, "_tokenizer", slow)
    assert decontaminate._numberer({"\xe9t\xe9": 0})("Un \xc9t\xe9.")[2].tolist() == [0]


def test_stretch_sums_are_those_of_reduceat():
    rng = np.random.default_rng(6)
    source = rng.standard_normal((500, 7)).astype(np.float32)
    for counts in (np.r_[np.arange(1, 40), rng.integers(1, 20, 300)], np.array([1]), np.array([50]), np.zeros(0, np.int64)):
        index = rng.integers(0, 500, counts.sum())
        got = decontaminate._stretch_sums(source, index, counts)
        want = np.add.reduceat(source[index], np.cumsum(counts) - counts, axis=0) if len(counts) else source[:0]
        assert got.dtype == np.float32 and np.allclose(got, want, rtol=1e-5, atol=1e-5)


def test_numbered_batches_stay_arrow():
    import pyarrow as pa

    texts = ["a b x " * 40, None, "", "x y z", "b " * 70, "a"]
    vocabulary = {"a": 0, "b": 1}
    batch = pa.RecordBatch.from_pydict({"doc_id": [3, None, 3, 4, 5, 6], "text": texts})
    got, = decontaminate._numbered_batches(vocabulary)(iter([batch]))
    rows = [decontaminate._numberer(vocabulary)(t) for t in texts]
    assert got.to_pylist() == [
        {"doc_id": i, "blocks": n, "at": at.tolist(), "terms": own.tolist()} for i, (n, at, own) in zip([3, None, 3, 4, 5, 6], rows)]
    for lo, hi in ((0, 6), (1, 5), (1, 4)):
        terms, block, ends = decontaminate._flat(got.slice(lo, hi - lo))
        own, base = rows[lo:hi], np.cumsum([0, *(n for n, _, _ in rows[lo:hi])])
        assert terms.tolist() == [k for _, _, found in own for k in found]
        assert block.tolist() == [x // 2 + b for (_, at, _), b in zip(own, base.tolist()) for x in at.tolist()]
        assert np.flatnonzero(ends).tolist() == (base[1:] - 1).tolist() and len(ends) == base[-1]
    none, = decontaminate._numbered_batches(vocabulary)(iter([batch.slice(0, 0)]))
    assert none.num_rows == 0


def test_words_without_weight_count_as_before():
    rng = np.random.default_rng(11)
    weighted = rng.standard_normal((12, 3)).astype(np.float32)
    weighted[:5] = 0
    vocabulary = {f"w{k}": k for k in range(12)}
    items = [(k, [f"w{x}" for x in own], [f"w{own[-1]}"]) for k, own in enumerate(
        rng.integers(0, 12, rng.integers(2, 60)).tolist() for _ in range(25))] + [(99, ["w0", "w1"], ["w1"])]
    texts = []
    for n in (1, 1, 3, 4, 6) * 6:
        at = np.sort(rng.integers(0, 2 * n, 30)).astype(np.int32)
        texts.append((n, at, rng.integers(0, 12, 30).astype(np.int32)))
    got = decontaminate._searcher({"items": items, "vocabulary": vocabulary, "weighted": weighted}, 0.3, 0.5, 0.5)(texts)
    for (n, at, own), leaks in zip(texts, got):
        want = set()
        for item, words, last in items:
            asked, end = [vocabulary[w] for w in words], [vocabulary[w] for w in last]
            aim, reach = weighted[asked].sum(axis=0), 2 * -(-len(asked) // decontaminate.BLOCK)
            for wide, step in ((2, 1), (4, 2)):
                for s in range(0, 2 * n - wide + 1, step):
                    part = weighted[own[(at >= s) & (at < s + wide)]].sum(axis=0)
                    size = np.linalg.norm(part) * np.linalg.norm(aim)
                    span = own[(at >= s - reach) & (at < s + wide + reach)].tolist()
                    if size and part @ aim >= 0.3 * size and brute.lcs(span, asked) >= 0.5 * len(asked) and (
                            brute.lcs(span, end) >= 0.5 * len(end)):
                        want.add(item)
        assert {x["item_id"] for x in leaks} == want
    assert any(got) and not all(len(x) == len(items) for x in got)


def test_latent_directions_are_those_of_the_passages(spark, docs):
    items = decontaminate.read_items(table(spark, SF, "benchmark"))
    model = decontaminate.learned(decontaminate.numbered(docs, items), items, rank=8)
    vocabulary = model["vocabulary"]
    passages = []
    for r in docs.collect():
        words = re.findall(r"[^\W_]+", r["text"].lower())
        blocks = [words[k:k + 32] for k in range(0, max(len(words), 1), 32)]
        passages += [sum(blocks[k:k + 2], []) for k in range(max(1, len(blocks) - 1))] if len(blocks) > 1 else blocks
    assert model["weighted"].shape == (len(vocabulary), 8)
    a = np.zeros((len(passages), len(vocabulary)))
    for k, words in enumerate(passages):
        for w in words:
            if w in vocabulary:
                a[k, vocabulary[w]] += 1
    a *= model["idf"]
    assert (model["idf"] == 0).any() and (model["idf"] > 0).sum() > len(vocabulary) / 2
    exact = np.linalg.svd(a, compute_uv=False)[:8]
    assert np.allclose(model["directions"].T @ model["directions"], np.eye(8), atol=1e-8)
    assert np.linalg.norm(a @ model["directions"]) ** 2 > 0.85 * (exact ** 2).sum()


def test_leaks_odd_rows(spark, odd):
    kind = "item_id long, text string"
    bench = spark.createDataFrame([(1, "The cat sat on the mat. It was warm there."), (2, None), (3, ""), (None, "x"),
                                   (4, "The cat sat on the mat. It was warm there.")], kind)
    got = counted(decontaminate.find_leaks(odd, bench), "doc_id", "item_id")
    assert got == {(1, 1): 1, (1, 4): 1, (7, 1): 2, (7, 4): 2}
    kept = decontaminate.without_leaks(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3
    assert decontaminate.find_leaks(odd.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(odd, bench.limit(0)).count() == 0


# ---- licences

def test_licenses_by_header_and_by_folder(spark):
    data = [
        (1, "a/LICENSE", "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
                         "and associated documentation files, to deal in the Software without restriction"),
        (2, "a/b/c/x.py", "print(1)"), (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\nprint(2)"),
        (4, "z/w.py", "nothing here"), (5, "top.py", ""), (6, None, None), (2, "a/b/c/x.py", "print(1)"),
        (7, "a/b/c/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."), (8, "a/b/c/d/v.py", "v"),
        (9, "ab/q.py", "q"),
    ]
    got = licenses.scan_licenses(spark.createDataFrame(data, "doc_id long, path string, text string"))
    want = {1: ("MIT", "file", None), 2: ("GPL-3.0", "inherited", "a/b/c"), 3: ("Apache-2.0", "header", None), 4: (None, None, None),
            5: (None, None, None), 6: (None, None, None), 7: ("GPL-3.0", "file", None), 8: ("GPL-3.0", "inherited", "a/b/c"),
            9: (None, None, None)}
    assert {r["doc_id"]: (r["license"], r["found"], r["from_dir"]) for r in got.collect()} == want
    assert got.count() == len(data)


def test_license_lines_of_the_corpus(spark, rows):
    names = {"CC BY-NC 4.0": "CC-BY-NC-4.0", "GNU General Public": "GPL-3.0", "the Apache License": "Apache-2.0", "the MIT License": "MIT",
             "All rights reserved": "proprietary"}
    for r in queries.QUERIES["op3_licenses"](spark, SF).collect():
        own = {v for k, v in names.items() if k in rows[r["doc_id"]]["text"]}
        assert (r["found"] in ("header", "file")) == bool(own)
        assert not own or r["license"] in own


def test_license_odd_rows(odd):
    files = odd.withColumn("path", F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    assert licenses.scan_licenses(files).count() == len(ODD)
    assert licenses.scan_licenses(files.limit(0)).count() == 0


# ---- pipeline

def test_pipeline_stages_on_odd_rows(spark, odd, docs):
    got = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, got, SF)
        assert after.columns == odd.columns, name
        assert after.count() <= got.count()
        got = after
    left = {r["doc_id"] for r in got.collect()}
    assert 1 in left and not left & {2, 3, 4, 8}
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_keeps_clean_documents(spark, docs, rows):
    first = corpus_pipeline.identify_language(spark, docs, SF)
    assert {r["doc_id"] for r in first.select("doc_id").collect()} == {
        i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    second = corpus_pipeline.dedup_lines(spark, docs, SF)
    assert {r["n_chars"] == len(r["text"]) for r in second.collect()} == {True}
    third = corpus_pipeline.near_dedup(spark, docs, SF)
    groups = {r["component_id"] for r in queries.QUERIES["op2_simhash"](spark, SF).collect()}
    assert sorted(r["doc_id"] for r in third.collect()) == sorted(groups)
    fourth = corpus_pipeline.decontaminate_benchmark(spark, docs, SF)
    leaked = {r["doc_id"] for r in queries.QUERIES["op1_decontaminate"](spark, SF).collect()}
    assert {r["doc_id"] for r in fourth.collect()} == set(rows) - leaked


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < got.select("doc_id").distinct().count() <= 200
