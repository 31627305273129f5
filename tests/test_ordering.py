"""The hot-group path must give what a plain window gives."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordering as O


@pytest.fixture(scope="module")
def rows(spark):
    """Key 0 holds a third of all rows; its order values crowd together."""
    base = spark.range(3000).withColumn("key", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50))
    return base.select(
        "id", "key", F.pmod(F.xxhash64("id"), F.lit(97)).alias("o"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)).cast("bigint").alias("v"))


def collected(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.mark.parametrize("slices", [1, 7, 200])
@pytest.mark.parametrize("descending", [False, True])
def test_number_rows(rows, slices, descending):
    order = [F.col(c).desc() if descending else F.col(c) for c in ("o", "id")]
    want = rows.withColumn("pos", F.row_number().over(Window.partitionBy("key").orderBy(*order)).cast("bigint"))
    got = O.number_rows(rows, ["key"], ["o", "id"], "pos", descending, slices)
    assert collected(got, "id", "pos") == collected(want, "id", "pos")


@pytest.mark.parametrize("descending", [False, True])
def test_running_sum(rows, descending):
    order = [F.col(c).desc() if descending else F.col(c) for c in ("o", "id")]
    w = Window.partitionBy("key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("s", F.sum("v").over(w))
    got = O.running_sum(rows, ["key"], ["o", "id"], F.col("v"), "s", descending, slices=40)
    assert collected(got, "id", "s") == collected(want, "id", "s")


def test_next_value(rows):
    want = rows.withColumn("n", F.lead("v").over(Window.partitionBy("key").orderBy("o", "id")))
    got = O.next_value(rows, ["key"], ["o", "id"], "v", "n", slices=40)
    key = repr
    assert sorted(map(tuple, got.select("id", "n").collect()), key=key) == sorted(
        map(tuple, want.select("id", "n").collect()), key=key)


def test_number_rows_without_key(rows):
    got = O.number_rows(rows, [], ["o", "id"], "pos", slices=20)
    assert sorted(r.pos for r in got.collect()) == list(range(1, 3001))


def test_slices_split_the_hot_group(rows):
    sizes = O.slice_rows(rows, ["key"], ["o", "id"], 20).groupBy("key", "_ord_slice").count().collect()
    hot = [r["count"] for r in sizes if r["key"] == 0]
    assert len(hot) > 5 and max(hot) < 600


def test_input_is_read_once(rows):
    plan = O.number_rows(rows, ["key"], ["o", "id"], slices=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_null_keys_and_values(spark):
    rows = spark.createDataFrame([(None if i % 2 else "a", i, None if i % 3 else i) for i in range(40)], "k string, o int, v int")
    w = Window.partitionBy("k").orderBy("o")
    want = rows.select("o", F.row_number().over(w).cast("bigint"), F.lead("v").over(w), F.sum("v").over(w))
    got = O.running_sum(O.next_value(O.number_rows(rows, ["k"], ["o"], "n", slices=9), ["k"], ["o"], "v", "x", 9), ["k"], ["o"], F.col("v"), "s", slices=9)
    assert sorted(map(tuple, got.select("o", "n", "x", F.coalesce("s", F.lit(0))).collect()), key=repr) == sorted(
        ((a, b, c, d or 0) for a, b, c, d in map(tuple, want.collect())), key=repr)


def test_join_in_parts_is_whole(spark, rows):
    texts = rows.withColumn("t", F.col("id").cast("string"))
    parts = O.join_in_parts(texts, ["key"], ["o", "id"], "t", ",", "joined", part_chars=256, slices=20)
    got = {}
    for r in sorted(parts.collect(), key=lambda r: (r["key"], r["part"])):
        got.setdefault(r["key"], []).append(r["joined"])
    want = {}
    for r in sorted(texts.collect(), key=lambda r: (r["key"], r["o"], r["id"])):
        want.setdefault(r["key"], []).append(r["t"])
    assert {k: ",".join(v) for k, v in got.items()} == {k: ",".join(v) for k, v in want.items()}
    assert max(len(p) for ps in got.values() for p in ps) < 256 + 5 and {r["n_parts"] for r in parts.where("key = 0").collect()} == {len(got[0])}


def test_page_partitions_the_set(rows):
    seen = [r.id for p in range(1, 32) for r in O.page(rows, [F.col("o"), F.col("id")], p, 100).collect()]
    assert len(seen) == 3000 and len(set(seen)) == 3000
