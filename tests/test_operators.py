"""Indexing, retrieval, evaluation, routing and usage on small fixtures."""

import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tidemark.operators import evaluation as Q
from tidemark.operators import indexing as X
from tidemark.operators import joins as J
from tidemark.operators import ml, retrieval as R, routing, windows
from tidemark.sources import files
from tidemark.streaming import usage as U

RECORDS = "key string, namespace string, updated_at double, group_id string, doc_id string"


# ---- indexing --------------------------------------------------------------------------------

def incoming(spark, rows):
    return spark.createDataFrame(
        [(u, p, "c" + u, '{"source":"%s"}' % s) for p, (u, s) in enumerate(rows, 1)],
        "uid string, pos long, page_content string, metadata string")


def test_second_run_skips_everything(spark):
    docs = incoming(spark, [("a", "s1"), ("b", "s1"), ("a", "s2")])
    empty = spark.createDataFrame([], RECORDS)
    first = X.index_upsert(docs, empty, 1.0, "ns", "source")
    assert first.counters.first().asDict() == {"num_added": 2, "num_updated": 0, "num_skipped": 0, "total_keys": 2}
    second = X.index_upsert(docs, first.records, 2.0, "ns", "source")
    assert second.counters.first().num_skipped == 2 and second.added.count() == 0
    assert {r.updated_at for r in second.records.collect()} == {2.0}
    assert {r.key: r.group_id for r in second.records.collect()} == {"a": "s1", "b": "s1"}


def test_copies_in_batches(spark):
    docs = incoming(spark, [("a", "s"), ("a", "s"), ("b", "s"), ("a", "s")])
    counted = X.index_upsert(docs, spark.createDataFrame([], RECORDS), 1.0, "ns", batch_size=2).counters.first()
    assert (counted.num_added, counted.num_skipped) == (2, 1)


def test_ledger_keeps_the_first_group(spark):
    records = spark.createDataFrame([("a", "ns", 1.0, "g1", "d1"), ("a", "other", 1.0, "g1", "d1")], RECORDS)
    keys = spark.createDataFrame([("a", "ns", "g2", "d2"), ("b", "ns", "g2", "d2")], "key string, namespace string, group_id string, doc_id string")
    got = {(r.key, r.namespace): (r.updated_at, r.group_id, r.doc_id) for r in X.ledger_upsert(records, keys, 5.0).collect()}
    assert got == {("a", "ns"): (5.0, "g1", "d2"), ("a", "other"): (1.0, "g1", "d1"), ("b", "ns"): (5.0, "g2", "d2")}
    with pytest.raises(ValueError):
        X.ledger_upsert(records, keys, 1.0, time_at_least=2.0)


def test_cleanups(spark):
    records = spark.createDataFrame(
        [("a", "ns", 1.0, "s1", ""), ("b", "ns", 1.0, "s1", ""), ("c", "ns", 1.0, "s2", ""), ("d", "ns", 9.0, "s1", ""),
         ("b", "other", 1.0, "s1", "")], RECORDS)
    docs = incoming(spark, [("a", "s1")])
    left = lambda df: sorted((r.namespace, r.key) for r in df.collect())
    assert left(X.index_cleanup_incremental(docs, records, 5.0, "ns", "source")) == [
        ("ns", "a"), ("ns", "c"), ("ns", "d"), ("other", "b")]
    assert left(X.index_cleanup_full(docs, records, 5.0, "ns")) == [("ns", "a"), ("ns", "d"), ("other", "b")]
    with pytest.raises(ValueError):
        X.index_cleanup_incremental(docs, records, 5.0, "ns", "")
    with pytest.raises(Exception, match="no source id"):
        X.index_cleanup_incremental(docs.withColumn("metadata", F.lit("{}")), records, 5.0, "ns", "source").collect()


def test_model_runs_once_per_text(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id int, t string")
    empty = spark.createDataFrame([], "cache_key string, embedding array<float>")
    calls = spark.sparkContext.accumulator(0)

    def model(texts):
        calls.add(len(texts))
        return texts.map(lambda t: [float(len(t))])

    rows, cache = X.embed_with_cache(df, F.col("t"), empty, model, "m")
    assert rows.count() == 3 and cache.count() == 2 and calls.value == 2
    broken = lambda s: 1 / 0  # noqa: E731 - never called when all texts are known
    again, _ = X.embed_with_cache(df, F.col("t"), spark.createDataFrame(cache.collect(), cache.schema), broken, "m")
    assert again.where("embedding is null").count() == 0


# ---- retrieval -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 8))
    base[50:100] = base[3]  # a third of all rows are copies
    rows = [(int(i), [float(x) for x in v.astype(np.float32)], int(i % 4)) for i, v in enumerate(base)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)


def brute(rows, queries, k, metric):
    out = {}
    for q, qv, _ in queries:
        a = np.array(qv, dtype=float)
        scored = []
        for i, v, _ in rows:
            b = np.array(v, dtype=float)
            d = {"cosine": 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), "ip": -(a @ b), "l2": np.linalg.norm(a - b)}[metric]
            scored.append((round(float(d), 9) + 0.0, i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def ranked(df):
    got = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
    return dict(got)


@pytest.mark.parametrize("metric", R.METRICS)
@pytest.mark.parametrize("max_query_rows,slice_rows", [(1000, None), (20, 40)])
def test_knn_both_ways_equal_brute_force(vectors, metric, max_query_rows, slice_rows):
    queries = vectors.withColumnRenamed("vec_id", "query_id").where("query_id % 3 = 0")
    want = brute([tuple(r) for r in vectors.collect()], [tuple(r) for r in queries.collect()], 5, metric)
    assert ranked(R.knn_topk(queries, vectors, 5, metric, max_query_rows, slice_rows)) == want


def test_knn_edges(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<float>")
    v = spark.createDataFrame(
        [("a", [1.0, 0.0], "t"), ("b", None, "t"), ("c", [1.0, 0.0], None), ("d", [0.0, 1.0], "t")],
        "vec_id string, embedding array<float>, page_content string")
    assert ranked(R.knn_topk(q, v, 10)) == {1: ["a", "d"]}
    assert ranked(R.knn_topk(q, v, 2)) == {1: ["a"]}  # the row without content leaves after the limit


def test_mmr_with_lambda_one_is_knn(vectors):
    queries = vectors.withColumnRenamed("vec_id", "query_id").where("query_id < 5")
    assert ranked(R.mmr(queries, vectors, 4, 20, 1.0)) == ranked(R.knn_topk(queries, vectors, 4))


def test_rrf_keeps_ties_and_order(spark):
    lists = spark.createDataFrame(
        [(1, "a", "x", 1), (1, "a", "y", 2), (1, "b", "y", 1), (1, "b", "x", 2), (2, "a", "p", 1), (2, "a", "q", 2)],
        "group_id int, list_id string, doc_id string, rank int")
    got = {(r.group_id, r.doc_id): r["rank"] for r in R.rrf_fuse(lists).collect()}
    assert got == {(1, "x"): 1, (1, "y"): 2, (2, "p"): 1, (2, "q"): 2}


def test_hybrid_blocks_equal_broadcast(spark):
    from tidemark.plans.inputs import table

    e = table(spark, SF, "embeddings")
    items = table(spark, SF, "benchmark").join(e, F.col("item_id") == e.vec_id).select(F.col("item_id").alias("query_id"), "text", "embedding")
    docs = table(spark, SF, "documents").join(e, F.col("doc_id") == e.vec_id).select("doc_id", F.col("text").alias("page_content"), "embedding")
    small, large = R.hybrid_search(items, docs), R.hybrid_search(items, docs, max_query_rows=3)
    rows = lambda df: sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 6)) for r in df.collect())
    assert rows(small) == rows(large)


def test_hybrid_index_counts_every_document(spark):
    """Repeated words, a null and an empty text, a document without a vector, a query without words."""
    docs = spark.createDataFrame(
        [(1, "red ring red", [1.0, 0.0]), (2, None, [0.0, 1.0]), (3, "", [1.0, 1.0]), (4, "blue ring", [1.0, 0.5]), (5, "red", None)],
        "doc_id long, page_content string, embedding array<double>")
    index = R.posting_index(docs.where("embedding is not null"))
    assert sorted((r.token, r.doc_id, r.tf, r.length) for r in index.collect()) == [
        ("", 1, 1, 3), ("", 2, 1, 0), ("", 3, 1, 0), ("", 4, 1, 2), ("blue", 4, 1, 2), ("red", 1, 2, 3), ("ring", 1, 1, 3), ("ring", 4, 1, 2)]
    asked = spark.createDataFrame(
        [(7, "Red red ring", [1.0, 0.0]), (8, "!", [0.0, 1.0]), (9, None, [1.0, 0.0])], "query_id long, text string, embedding array<double>")
    found = [R.hybrid_search(asked, docs, k=9, index=given) for given in (index, None)]
    rows = [sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in f.collect()) for f in found]
    assert rows[0] == rows[1]
    by_words = R.hybrid_search(asked, docs, k=9, ratio=0.0, index=index)
    score = {(r.query_id, r.doc_id): r.score for r in by_words.collect()}
    assert {d for _, d in score} == {1, 2, 3, 4}
    assert score[7, 1] == 1.0 and 0.0 < score[7, 4] < 1.0 and score[7, 2] == score[7, 3] == 0.0
    assert all(score[q, d] == 0.0 for q in (8, 9) for d in (1, 2, 3, 4))
    idf = lambda df: np.log(1 + (4 - df + 0.5) / (df + 0.5))
    gain = lambda tf, n: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / 1.25))
    top = idf(1) * gain(2, 3) + idf(2) * gain(1, 3)
    assert score[7, 4] == pytest.approx(idf(2) * gain(1, 2) / top, abs=1e-8)
    assert R.hybrid_search(asked, docs.limit(0)).count() == 0
    assert R.hybrid_search(asked.limit(0), docs).count() == 0


def test_filter_masks_equal_plain_dicts(spark):
    """Null, empty and absent values; more filters than one round takes; queries held and in blocks."""
    tags = [None, "{}", '{"a":"1"}', '{"a":"1","b":"x"}', '{"a":1,"b":"y","c":null}', '{"b":"x"}', '{"a":"2"}', "no json"]
    vectors = spark.createDataFrame(
        [(i, [1.0, float(i)], t) for i, t in enumerate(tags * 3)], "vec_id long, embedding array<double>, metadata string")
    filters = [None, {}, {"a": "1"}, {"a": "1", "b": "x"}, {"b": "x"}, {"a": "9"}, {"z": "1"}, {"a": None}, {"b": "y", "a": "1"}]
    asked = spark.createDataFrame(
        [(i, [1.0, 0.0], f) for i, f in enumerate(filters * 2)], "query_id long, embedding array<double>, filter map<string,string>")
    parsed = [{}, {}, {"a": "1"}, {"a": "1", "b": "x"}, {"a": "1", "b": "y"}, {"b": "x"}, {"a": "2"}, {}] * 3
    for base, options in (({"b": "x"}, {}), (None, {"max_filters": 2}), ({"b": "x"}, {"max_filters": 3, "max_query_rows": 2})):
        expected = set()
        for i, f in enumerate(filters * 2):
            rule = {**(base or {}), **(f or {})}
            fits = [v for v, t in enumerate(parsed) if all(t.get(a) == b for a, b in rule.items())]
            expected |= {(i, v, n) for n, v in enumerate(fits[:4], start=1)}
        got = R.extracted_filter_search(asked, vectors, base, **options)
        assert {(r.query_id, r.vec_id, r["rank"]) for r in got.collect()} == expected
    assert R.extracted_filter_search(asked, vectors.limit(0), {"b": "x"}).count() == 0
    assert R.extracted_filter_search(asked.limit(0), vectors).count() == 0


def test_failed_scorer_keeps_the_order(spark):
    c = spark.createDataFrame([(1, "q", "a", "x", 1), (1, "q", "b", "y", 2)], "query_id int, query_text string, vec_id string, page_content string, rank int")
    got = R.rerank(c, lambda q, d: 1 / 0, 1).collect()
    assert [r.vec_id for r in got] == ["a"]


def test_filter_needs_a_rule(spark):
    with pytest.raises(ValueError):
        R.embeddings_filter(spark.createDataFrame([], "query_id int, vec_id int, similarity double"), None, None)


# ---- evaluation ------------------------------------------------------------------------------

def verdicts(spark, output, rules, metrics="{}", error="", **options):
    df = spark.createDataFrame([(1, output, error, metrics)], "run_id int, output string, error string, metrics string")
    return [r.result for r in Q.evaluate_rules(df, rules, **options).collect()]


def rule(kind, operator, value, measure=None):
    return {"id": "r", "name": "n", "type": kind, "operator": operator, "value": value, "measure": measure}


def test_text_rule_quirks(spark):
    assert verdicts(spark, " Hello World ", [rule("text", "DoesNotContainAny", "x, y")]) == ["Fail"]
    assert verdicts(spark, "Hello", [rule("text", "DoesNotContainAny", "x")], mode="fixed") == ["Pass"]
    assert verdicts(spark, "a b", [rule("text", "DoesNotContainAll", "a, x")]) == ["Fail"]
    assert verdicts(spark, "a b", [rule("text", "DoesNotContainAll", "a, x")], mode="fixed") == ["Pass"]
    assert verdicts(spark, "a", [rule("text", "StartsWith", None)]) == ["Error"]
    assert verdicts(spark, "a", [rule("text", "StartsWith", "a")], error="boom") == ["Error"]


def test_numeric_and_json_rules(spark):
    m = '{"n": 3, "t": "3"}'
    assert verdicts(spark, "abc", [rule("numeric", "equals", "3.9", "n"), rule("numeric", "equals", "3", "t"),
                                   rule("numeric", "lessThanOrEquals", "3", "t"), rule("numeric", "notEquals", "abc", "n"),
                                   rule("numeric", "equals", "3", "responseLength"), rule("numeric", "near", "3", "n")], m) == [
        "Pass", "Fail", "Pass", "Pass", "Pass", "Fail"]
    for body, valid in (('{"a":1}', True), ("null", True), ("TRUE", True), ("{", False), ("", False)):
        got = verdicts(spark, body, [rule("json", "IsValidJSON", ""), rule("json", "IsNotValidJSON", "")])
        assert got == (["Pass", "Fail"] if valid else ["Fail", "Pass"])


@pytest.mark.parametrize("cost,shown", [("0", "$ 0"), ("0.004", "$ <0.01"), ("0.01", "$ 0.01"), ("1.234", "$ 1.23")])
def test_cost_text(spark, cost, shown):
    assert spark.range(1).select(Q.cost_text(F.lit(cost).cast("decimal(18,6)")).alias("c")).first().c == shown


def test_regression_bounds(spark):
    schema = "golden_id string, input string, score double, passed boolean, reason string"
    now = spark.createDataFrame([("a", "x", 0.72, True, ""), ("b", "x", 0.7199, True, ""), ("c", "x", 0.79, False, ""), ("d", "x", 0.1, False, "")], schema)
    old = spark.createDataFrame([("a", "x", 0.8, True, ""), ("b", "x", 0.8, True, ""), ("c", "x", 0.8, True, "")], schema)
    assert sorted(r.golden_id for r in Q.regression_compare(now, old).collect()) == ["b", "c"]
    with pytest.raises(ValueError):
        Q.check_golden(spark.range(30))
    assert Q.regression_summary(now.limit(0)).first().asDict() == {
        "total_cases": 0, "passed_cases": 0, "failed_cases": 0, "pass_rate": 0.0, "mean_score": 0.0}


def test_price_lists_in_order(spark):
    schema = "provider string, model string, input_cost double, output_cost double, total_price double, total_cost double"
    chat = spark.createDataFrame([("OpenA", "m1", 1.0, 2.0, 0.0, 0.0)], schema)
    rest = spark.createDataFrame([("opena", "m1", 9.0, 9.0, 0.0, 0.0), ("opena", "m2", 5.0, 5.0, 0.0, 0.0)], schema)
    rows = spark.createDataFrame([(1, "OPENA", "m1"), (2, "opena", "m2"), (3, "x", "m1")], "id int, provider string, model string")
    got = {r.id: r.input_cost for r in J.price_lookup(rows, chat, rest).collect()}
    assert got == {1: 1.0, 2: 5.0, 3: None}


def test_csv_to_dataset_skips_one_header(spark, tmp_path):
    for i, body in enumerate(["q,a,x\none,1,x\n", "two,2\nthree,3\n"]):
        (tmp_path / f"{i}.csv").write_text(body)
    paths = [str(tmp_path / f"{i}.csv") for i in range(2)]
    got = Q.csv_to_dataset(spark, paths, "d", first_row_headers=True, start_seq=5).orderBy("sequence_no").collect()
    assert [(r.input, r.output, r.sequence_no) for r in got] == [("one", "1", 5), ("two", "2", 6), ("three", "3", 7)]


# ---- routing ---------------------------------------------------------------------------------

def branch(spark, value, conditions):
    df = spark.createDataFrame([(value,)], "x string")
    return routing.route_first_match(df, [{"value1": F.col("x"), **c} for c in conditions]).first().branch


def test_first_match(spark):
    assert branch(spark, "**bold** text", [{"operation": "equal", "value2": "bold text"}]) == 0
    assert branch(spark, "x", [{"operation": "regex", "value2": "(["}, {"operation": "regex", "value2": "^x$"}]) == 1
    assert branch(spark, "12abc", [{"type": "number", "operation": "equal", "value2": "12"}]) == 0
    assert branch(spark, "abc", [{"type": "number", "operation": "equal", "value2": "0"}]) == 0
    assert branch(spark, None, [{"operation": "notEmpty"}, {"operation": "isEmpty"}]) == 1
    assert branch(spark, "q", [{"operation": "contains", "value2": "z"}]) == 1


def test_grid(spark):
    def go(value, op, wanted="", kind="string"):
        df = spark.createDataFrame([(value,)], f"x {kind}")
        return routing.route_condition_grid(df, [{"variable": "x", "operation": op, "value": wanted, "output": "hit"}]).first().branch

    assert go(None, "Is Empty") == "hit" and go("", "Not Contains", "x") == "End" and go("0", "Equal To", 0) == "hit"
    assert go(0.0, "Less Than", 5, "double") == "End" and go(0.0, "Is Empty", "", "double") == "hit"
    assert go("abc", "Greater Than", 1) == "End" and go("3", "Greater Than or Equal To", "3") == "hit"
    assert go(5.0, "Is", "5", "double") == "hit" and go(" ", "Is Not Empty") == "End"


@pytest.mark.parametrize("label,idx", [
    ("  REFUND ", 2), ("refund plus", 1), ("ship", 0), ("please, refund", 2), ("weather", 3), ("", 0), (None, 0)])
def test_scenarios(spark, label, idx):
    """Equal, then the start of a scenario, then one inside the other, then the last."""
    df = spark.createDataFrame([(label,)], "x string")
    names = ["Shipping delay", "refund plus postage", "refund", "something else"]
    assert routing.match_scenario(df, F.col("x"), names).first().idx == idx
    assert routing.match_scenario(df, F.col("x"), []).first().idx == -1


def test_fold_state_in_parts(spark):
    rows = spark.createDataFrame([(1, i, str(i), "v" if i == 2 else None) for i in range(7)], "k int, o int, a string, r string")
    got = routing.fold_state(rows, "k", {"a": "append", "r": "replace"}, ["o"], part_chars=6).orderBy("part").collect()
    assert [list(r.a) for r in got] == [["0", "1", "2"], ["3", "4", "5"], ["6"]] and {r.r for r in got} == {"v"}


# ---- windows, JSON documents, features -------------------------------------------------------

def test_sequence_of_all_missing(spark):
    rows = spark.createDataFrame([("d", i, -1) for i in range(3)], "dataset string, id int, sequence_no int")
    assert sorted((r.id, r.sequence_no) for r in windows.sequence_fill(rows, "dataset", "id").collect()) == [(0, 0), (1, 1), (2, 2)]


def test_memory_window_bounds(spark):
    rows = spark.createDataFrame([(i, "s", (pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=i)).to_pydatetime()) for i in range(5)], "id long, session_id string, created timestamp")
    ids = lambda k: sorted(r.id for r in windows.memory_window(rows, k).collect())
    assert ids(1) == [3, 4] and ids(0) == [] and ids(None) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("js,options,expected", [
    ('{"a":"x","n":1,"b":["y",{"c":"z"}],"e":""}', {}, ["x", "y", "z"]),
    ('[{"a":{"t":"x"},"o":"no"},{"a":{"t":"y"}}]', {"pointers": ["/a/t"]}, ["x", "y"]),
    ('{"w":{"t":"deep"},"o":"no"}', {"pointers": ["/t"]}, ["deep"]),
    ('{"a":null,"b":[1,"q"],"c":{"d":true}}', {"separate_by_object": True}, ['a: null\nb: [1,"q"]\nc.d: true']),
])
def test_json_documents(spark, js, options, expected):
    df = spark.createDataFrame([(1, js)], "doc_id int, js string")
    got = files.load_json_docs(df, F.col("js"), **options).orderBy("line").collect()
    assert [r.page_content for r in got] == expected
    assert all(('"line"' in r.metadata) == (len(expected) > 1) for r in got)


def test_hour_stamps():
    assert files.hours_between("2024-02-28-23", "2024-02-29-01") == ["2024-02-28-23", "2024-02-29-00", "2024-02-29-01"]
    for bad in ((None, "2024-01-01-00"), ("2024-01-02-00", "2024-01-01-00")):
        with pytest.raises(ValueError):
            files.read_hourly_logs(None, None, *bad)


def test_feature_clamps(spark):
    schema = ("consumo_medio_6m double, consumo_medio_12m double, custo_aquisicao_unitario double, lote_minimo_compra int, "
              "prazo_entrega_dias int, indice_reajuste_12m double, criticidade_insumo string")
    rows = [(None, None, None, None, 5, -0.01, "x"), (0.0, 10.0, 2.0, 50, 90, 0.16, "ALTA"), (1e6, 1e6, 9.0, 1, 30, 0.05, "baixa")]
    got = ml.supply_features(spark.createDataFrame(rows, schema)).collect()
    assert [(r.AGE, r.PAY_0, r.PAY_2, r.PAY_4, r.EDUCATION) for r in got] == [
        (21, -1, -2, 0, 2), (79, 6, 5, 7, 3), (30, 0, -1, 1, 1)]
    assert got[0].LIMIT_BAL == pytest.approx(180 * 50 * 1.2) and got[2].LIMIT_BAL == 1_000_000


def test_auc(spark):
    rng = np.random.default_rng(2)
    y, p = rng.integers(0, 2, 200), np.round(rng.random(200), 1)
    pairs = [(a > b) + 0.5 * (a == b) for a, u in zip(p, y) if u for b, v in zip(p, y) if not v]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, s double")
    assert ml.roc_auc(df, "label", "s").first().roc_auc == pytest.approx(float(np.mean(pairs)))


def test_forest_rows_are_dealt_out(spark, monkeypatch):
    """A training table in one small file is no single task, nor are classes tasks where nothing is broadcast by size."""
    seen = []
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, df: seen.append(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (20_000, 1_000):
            rows = spark.range(0, n, 1, 1).selectExpr("id", "int(id % 4 = 0) AS label", "double(id) AS x")
            ml.train_risk_forest(rows, "label", ("x",))
        many, few = ([[(r.id, r.weight) for r in part] for part in df.rdd.glom().collect()] for df in seen)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(many) == spark.sparkContext.defaultParallelism and max(map(len, many)) < 2 * 20_000 / len(many)
    assert sorted(sum(many, [])) == [(k, 2.0 if k % 4 == 0 else 2 / 3) for k in range(20_000)]
    assert [len(part) for part in few] == [1_000]


def test_deal_out_bounds_a_task(spark):
    rows = spark.range(0, 10_000, 1, 1)
    assert ml.deal_out(rows, least=100, most=500).rdd.getNumPartitions() == 20
    assert ml.deal_out(rows, least=5_000, most=500).rdd.getNumPartitions() == 2


# ---- usage -----------------------------------------------------------------------------------

def sliding(hits, limit, window):
    """A hit passes when fewer than `limit` passed hits lie in the window that ends with it."""
    passed = np.zeros(len(hits), bool)
    for i, now in enumerate(hits):
        passed[i] = np.sum(passed[:i] & (np.array(hits[:i]) > now - window)) < limit
    return passed.tolist()


@pytest.mark.parametrize("slices", [1, 20])
def test_sliding_limit_equals_the_plain_loop(spark, slices):
    rng = np.random.default_rng(3)
    rows, want, n = [], {}, 0
    for key in range(4):
        times = np.cumsum(rng.exponential(6.0, 200 if key == 0 else 30)).round(3)
        flags = sliding(times, 3, 20.0)
        for t, ok in zip(times, flags):
            rows.append((n, key, pd.Timestamp(float(t), unit="s").to_pydatetime()))
            want[n] = ok
            n += 1
    df = spark.createDataFrame(rows, "id long, key long, ts timestamp").repartition(3)
    got = {r.id: r.allowed for r in U.rate_limit(df, 3, 20.0, slices=slices).collect()}
    assert got == want


def test_sliding_limit_fixture(spark):
    rows = [(i, "k", pd.Timestamp(t, unit="s").to_pydatetime()) for i, t in enumerate([0.0, 1.0, 2.0, 10.5])]
    df = spark.createDataFrame(rows, "id long, key string, ts timestamp")
    assert [r.allowed for r in U.rate_limit(df, 2, 10.0).orderBy("id").collect()] == [True, True, False, True]


def test_stream_limit_equals_table(spark):
    from tidemark.plans import streaming as P
    from tidemark.plans.inputs import table

    flat = {r.id: r.allowed for r in U.rate_limit(P.hits(table(spark, SF, "events")), 3, 12 * 3600).collect()}
    live = {r.id: r.allowed for r in P.rate_limit_stream(spark, SF).collect()}
    assert flat == live and not math.isnan(len(flat))


def test_hot_key_without_a_pause_in_slices(spark):
    from collections import deque

    rows, log, want = [], deque(), {}
    for i in range(1200):  # in step, then uneven; another key before and after
        rows.append(("m", 1000.0 + i * 0.7 + (0 if i < 700 else i * i % 11 * 0.05), i))
    rows += [("a", float(i), 5000 + i) for i in range(5)] + [("z", float(i), 6000 + i) for i in range(5)] + [(None, 1.0, 7000)]
    for key in ("m", "a", "z", None):
        log.clear()
        for _, t, i in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]):
            while log and log[0] <= t - 10:
                log.popleft()
            want[i] = len(log) < 3
            if want[i]:
                log.append(t)
    hits = spark.createDataFrame(rows, "key string, t double, id long").select("key", F.col("t").cast("timestamp").alias("ts"), "id")
    for slices in (1, 16):
        assert {r.id: r.allowed for r in U.rate_limit(hits, 3, 10.0, slices=slices).collect()} == want


# ---- the rest ---------------------------------------------------------------------------------

def test_edits_shift_totals(spark):
    from tidemark.operators import chunking

    totals = spark.createDataFrame([("s", 3, 30, "SYNC"), ("t", 1, 5, "SYNC")], "store_id string, total_chunks long, total_chars long, status string")
    changes = spark.createDataFrame([("s", "hello", "hi"), ("s", "bye", None)], "store_id string, old_content string, new_content string")
    got = {r.store_id: (r.total_chunks, r.total_chars) for r in chunking.edit_totals(totals, changes).collect()}
    assert got == {"s": (2, 24), "t": (1, 5)}


def test_rows_are_appended_after_the_last(spark):
    rows = spark.createDataFrame([("d", 1, 4)], "dataset string, id int, sequence_no int")
    new = spark.createDataFrame([("d", 2), ("d", 3), ("e", 4)], "dataset string, id int")
    got = {r.id: r.sequence_no for r in windows.sequence_append(rows, new, "dataset", "id").collect()}
    assert got == {1: 4, 2: 5, 3: 6, 4: 0}


def test_feedback_needs_both_bounds(spark):
    from tidemark.operators import conversations as V

    rows = spark.createDataFrame([(i, f"2024-01-0{i}") for i in (1, 2, 3)], "message_id int, d string").withColumn("created", F.to_timestamp("d"))
    assert V.feedback_filtered(rows, start="2024-01-02").count() == 3
    assert [r.message_id for r in V.feedback_filtered(rows, "2024-01-02", "2024-01-03", "DESC").collect()] == [3, 2]


def test_large_windows_use_slices(spark):
    rows = spark.range(1500).select("id", F.lit("s").alias("session_id"), F.timestamp_seconds("id").alias("created"))
    got = sorted((r.pos, r.id) for r in windows.memory_window(rows, 600).collect())
    assert got == [(i + 1, 300 + i) for i in range(1200)]
    keyed = rows.select(F.lit("k").alias("key"), F.col("created").alias("ts"), "id", F.col("id").alias("value"))
    assert windows.nth_latest(keyed, spark.createDataFrame([("k",), ("x",)], "key string"), 1200).orderBy("key").first().value == 300


def test_prompt_in_parts(spark):
    examples = spark.createDataFrame([("t", i, f"e{i}") for i in range(5)], "topic string, n int, text string")
    df = spark.createDataFrame([(1, "t", "now"), (2, "u", "alone")], "id int, topic string, q string")
    got = routing.few_shot_prompt(df, examples, "topic", "n", "<{text}>", "P", "S {q}", "|", part_chars=10).orderBy("id", "part").collect()
    assert [r.prompt for r in got] == ["P|<e0>|<e1>", "<e2>|<e3>", "<e4>|S now", "P|S alone"]


def test_closure_stays_on_the_host(spark):
    from tidemark.sources import web

    a, b = "https://a.com/", "https://b.com/"
    edges = spark.createDataFrame([(a + "1", a + "2"), (a + "2", a + "3"), (a + "3", a + "1"), (a + "2", b + "1"), (b + "1", a + "9")], "src string, dst string")
    seeds = spark.createDataFrame([(a + "1",)], "url string")
    walk = lambda **o: sorted((r.url[-1], r.level) for r in web.crawl_closure(edges, seeds, **o).collect())
    assert walk() == [("1", 0), ("2", 1), ("3", 2)] and walk(max_depth=1) == [("1", 0), ("2", 1)] and walk(limit=1) == [("1", 0)]


def test_stream_index_runs_again_without_change(spark, tmp_path):
    from tidemark.streaming import index as S

    schema = "uid string, pos long, page_content string, metadata string, ts timestamp"
    source, records, checkpoint = (str(tmp_path / n) for n in ("in", "ledger", "checkpoint"))
    rows = spark.createDataFrame([("a", 1, "x", "{}"), ("b", 2, "y", "{}"), ("a", 3, "x", "{}")], "uid string, pos long, page_content string, metadata string")
    rows.withColumn("ts", F.timestamp_seconds(F.lit(1704067200))).write.parquet(source)
    for _ in range(2):
        S.stream_index(spark.readStream.schema(schema).parquet(source), records, checkpoint).awaitTermination()
        assert sorted(r.key for r in S.ledger_now(spark, records).collect()) == ["a", "b"]
    S.compact_ledger(spark, records, str(tmp_path / "compact"), 7)
    assert S.ledger_now(spark, str(tmp_path / "compact")).count() == 2


def out_of_order(spark, tmp_path, rows, schema):
    """A stream of three files, one per micro-batch, the last one hours behind."""
    source = str(tmp_path / "in")
    for second, part in rows:
        spark.createDataFrame(part, schema).withColumn("ts", F.timestamp_seconds(F.lit(second))).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)


def test_streams_lose_no_late_row(spark, tmp_path):
    from tidemark.plans.streaming import finished
    from tidemark.streaming import index as S

    days = (1704067200, 1704153600, 1704067200 - 18000)
    docs = [(t, [(f"k{i}", i, "x", "{}"), ("same", 9, "y", "{}")]) for i, t in enumerate(days)]
    live = out_of_order(spark, tmp_path / "a", docs, "uid string, pos long, page_content string, metadata string")
    S.stream_index(live, str(tmp_path / "ledger"), str(tmp_path / "c1")).awaitTermination()
    assert sorted(r.key for r in S.ledger_now(spark, str(tmp_path / "ledger")).collect()) == ["k0", "k1", "k2", "same"]

    hits = [(t, [("u", 10 * i + j) for j in range(2)]) for i, t in enumerate(days)]
    live = out_of_order(spark, tmp_path / "b", hits, "key string, id long")
    assert sorted(r.id for r in finished(U.rate_limit_stream(live, 1, 10.0)).collect()) == [0, 1, 10, 11, 20, 21]

    calls = [(t, [("n", "success")] * 3) for t in days]
    live = out_of_order(spark, tmp_path / "c", calls, "name string, status string")
    U.partial_counts(live, str(tmp_path / "out"), str(tmp_path / "c3"), U.request_counters).awaitTermination()
    keys = ["window_start", "window_end", "name", "status"]
    got = U.merged_counts(spark.read.parquet(str(tmp_path / "out")), keys).collect()
    assert sorted(r.requests for r in got) == [3, 3, 3] and len({r.window_start for r in got}) == 3


def test_csv_records_over_several_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,said\n1,"he said ""hi""\nand left"\n2,plain\n')
    path = str(tmp_path)
    said = ['he said "hi"\nand left', "plain"]
    assert sorted(r.page_content for r in files.load_csv_docs(spark, path, "said").collect()) == said
    assert sorted(r.said for r in files.load_csv_union(spark, path).collect()) == said
    assert [r.output for r in Q.csv_to_dataset(spark, [path + "/a.csv"], "d", True).orderBy("sequence_no").collect()] == said
    (tmp_path / "b.jsonl").write_text('{"a":"x","n":1}\n\n{"a":"y"}\n')
    got = files.load_folder(spark, path)
    assert sorted(r.page_content for r in got.where("doc_id like '%jsonl%'").collect()) == ["x", "y"]
    assert got.where("doc_id like '%.csv%'").count() == 2


def test_one_page_under_several_addresses(spark):
    from tidemark.sources import web

    edges = [("https://a.com/x", "http://a.com/y/"), ("https://a.com/y", "https://a.com/x/#top"), ("https://a.com/y#z", "https://a.com/z")]
    seeds = spark.createDataFrame([("http://a.com/x",)], "url string")
    got = web.crawl_closure(spark.createDataFrame(edges, "src string, dst string"), seeds)
    assert sorted((r.url, r.level) for r in got.collect()) == [("http://a.com/x", 0), ("http://a.com/y/", 1), ("https://a.com/z", 2)]


def supply_rows(spark, rows):
    """Items (id, name, supplier, consumption) at cost 1."""
    columns = "id_insumo string, insumo string, fornecedor string, consumo_medio_12m double"
    rest = {c: F.lit(1.0) for c in ("lote_minimo_compra", "consumo_medio_6m", "custo_aquisicao_unitario", "prazo_entrega_dias", "indice_reajuste_12m")}
    return spark.createDataFrame(rows, columns).withColumns(rest | {"categoria": F.lit("c"), "criticidade_insumo": F.lit("alta")})


def test_wildcards_stay_in_a_field(spark):
    from tidemark.operators import tabular as T

    asked = spark.createDataFrame(
        [(i, None, name, None) for i, name in enumerate(("red%ring", "r%g co", "red_bolt"))],
        "request_id long, id_insumo string, insumo string, fornecedor string")
    got = {r.request_id: r.found for r in T.item_resolve(supply_rows(spark, [("7", "red bolt", "ring co", 1.0)]), asked).collect()}
    assert got == {0: False, 1: True, 2: True}


def test_item_names_equal_plain_matching(spark):
    """Names of every length with wildcards, back slashes and line feeds, against a pattern over all items."""
    import random
    import re

    from tidemark.operators import tabular as T

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab\\ \n.é") for _ in range(n))
    items = [(f"i{n:03}", rng.choice([word(6), None, ""]), rng.choice([word(4), "Sup A", None]), float(n % 5)) for n in range(150)]
    items.append(("i999", "ab" * 3_000 + "x", "long", 0.0))
    names = sorted({"".join(rng.choice("aB\\%_ \né") for _ in range(n % 6)) for n in range(60)} | {"", "%", "_", "bx", "a%bx", "SUP"})
    asked = [(i, None, name, rng.choice([None, None, "sup", "a"])) for i, name in enumerate(names)]
    asked += [(900, "i003", None, None), (901, " i003 ", "zz", None), (902, "none", None, None), (903, None, None, "sup")]
    df = supply_rows(spark, items)
    got = {r.request_id: r.id_insumo for r in T.item_resolve(
        df, spark.createDataFrame(asked, "request_id long, id_insumo string, insumo string, fornecedor string")).collect()}

    def plain(name, supplier):
        text = re.escape(name.strip(" ").lower()).replace("%", ".*").replace("_", ".")
        hits = [r for r in items if any(f is not None and re.search(text, f.lower(), re.S) for f in (r[1], r[2], r[0]))]
        hits = sorted(hits, key=lambda r: (-r[3], r[0]))[:20]
        return next((r[0] for r in hits if supplier is None or supplier in (r[2] or "\0").lower()), None)

    expected = {i: plain(name, supplier) for i, _, name, supplier in asked[:len(names)]}
    expected |= {900: "i003", 901: "i003", 902: None, 903: None}
    assert got == expected
    assert T.item_resolve(df.limit(0), spark.createDataFrame(asked[:3], "request_id long, id_insumo string, insumo string, fornecedor string")).count() == 3


def test_item_runs_are_looked_up_without_a_shuffle(spark, monkeypatch):
    """Few names travel to the items; items tested for few runs and items cut into all their runs give the same rows."""
    from tidemark.operators import tabular as T

    items = supply_rows(spark, [("7", "Red bolt", "ring co", 1.0), ("8", None, "", 2.0), ("é9", "bé", "\U0001f600éa", 3.0)])
    names = spark.createDataFrame([("red",), ("",), ("b",), ("bé",), ("%éa",), ("zz",), ("r_d%b",), ("\U0001f600",)], "name string")
    found = {}
    for few in (64, 0):
        monkeypatch.setattr(T, "_FEW_RUNS", few)
        hits = T._name_candidates(items, names)
        assert "SortMergeJoin" not in hits._jdf.queryExecution().executedPlan().toString()
        found[few] = sorted((r.name, r.id_insumo, r._rn) for r in hits.collect())
    assert found[64] == found[0] == sorted([
        ("red", "7", 1), ("", "é9", 1), ("", "8", 2), ("", "7", 3), ("b", "é9", 1), ("b", "7", 2), ("bé", "é9", 1), ("%éa", "é9", 1),
        ("r_d%b", "7", 1), ("\U0001f600", "é9", 1)])


def test_markdown_of_a_page_is_made_once(spark):
    """The chain of replacements stands in the column once, however often its result is used."""
    from tidemark.functions import html

    page = "&#x41;&#66;&amp;lt; <h1>a &amp; b</h1>&#70000;&nbsp;&copy;<ul><li>x</li></ul>"
    df = spark.createDataFrame([(page,), (None,), ("plain",)], "html string")
    column = html.to_markdown(F.col("html"))
    assert df.select(column)._jdf.queryExecution().analyzed().toString().count("(?:ul|ol)") <= 2  # the column and its name
    assert [r[0] for r in df.select(column).collect()] == ["AB&lt;\n\n# a & b\n\n\ufffd\u00a0©\n\n*   x", "", "plain"]
    assert df.select(html.unescape(F.col("html"))).collect()[1][0] is None


def test_json_pointers(spark):
    js = '{"a":[{"t":"x","u":{"t":"deep"}},{"t":["y","z"]}],"t":"","o":{"t":"no"}}'
    df = spark.createDataFrame([(1, js)], "doc_id int, js string")
    take = lambda *p: [r.page_content for r in files.load_json_docs(df, F.col("js"), p).orderBy("line").collect()]
    assert take("/a/0/t") == ["x"] and take("/t") == ["x", "deep", "y", "z", "no"] and take("/q") == []


def test_sitemap_entries(spark):
    from tidemark.sources import web

    xml = "<urlset><url><loc>a&amp;b</loc></url><url><x/></url><url><loc>c</loc></url><url><loc>d</loc></url></urlset>"
    df = spark.createDataFrame([(xml,)], "xml string")
    locs = lambda n: [r["loc"] for r in web.parse_sitemap(df, F.col("xml"), n).orderBy("pos").collect()]
    assert locs(0) == ["a&b", "c", "d"] and locs(2) == ["a&b", "c"]


def test_rules_and_profiles_reject_bad_input(spark):
    from tidemark.operators import tabular as T

    with pytest.raises(ValueError):
        T.table_profile({"a": spark.range(1)}, include=["a"], ignore=["b"])
    with pytest.raises(ValueError):
        Q.evaluate_json_rules(spark.range(1), [])
