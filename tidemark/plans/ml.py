"""Registered queries: features, split, forest and measures."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import ml
from tidemark.plans.inputs import SUPPLY, supply, table
from tidemark.plans.registry import query
from tidemark.sources.scratch import scratch_folder

_SHARES = ", ".join(
    [f"round(stock * {s}, 6) AS \"BILL_AMT{i}\"" for i, s in enumerate((1.0, 0.95, 0.9, 0.88, 0.85, 0.82), 1)]
    + [f"round(month * {s}, 6) AS \"PAY_AMT{i}\"" for i, s in enumerate((1.0, 0.9, 1.05, 0.95, 1.0, 0.85), 1)])


@query("supply_features", f"""WITH {SUPPLY}, s AS (
  SELECT *, lote_minimo_compra / greatest(consumo_medio_6m, 1) AS cover, lote_minimo_compra * custo_aquisicao_unitario AS stock,
    consumo_medio_6m::DOUBLE / 6.0::DOUBLE * custo_aquisicao_unitario AS month FROM supply),
p AS (SELECT *, CAST(CASE WHEN indice_reajuste_12m > 0.15 OR cover > 3 THEN least(6, trunc(cover)) WHEN indice_reajuste_12m < 0 THEN -1 ELSE 0 END AS DOUBLE) AS pay FROM s)
SELECT id_insumo, round(least(greatest(consumo_medio_12m * custo_aquisicao_unitario, 1) * 1.2::DOUBLE, 1000000), 6) AS "LIMIT_BAL", 1.0::DOUBLE AS "SEX",
  CASE lower(criticidade_insumo) WHEN 'baixa' THEN 1 WHEN 'alta' THEN 3 ELSE 2 END::DOUBLE AS "EDUCATION", 1.0::DOUBLE AS "MARRIAGE",
  least(greatest(prazo_entrega_dias, 21), 79)::DOUBLE AS "AGE", pay AS "PAY_0", greatest(pay - 1, -2) AS "PAY_2", pay AS "PAY_3", least(pay + 1, 8) AS "PAY_4",
  pay AS "PAY_5", greatest(pay - 1, -2) AS "PAY_6", {_SHARES} FROM p""")
def supply_features(spark, d):
    out = ml.supply_features(supply(spark, d))
    return out.select("id_insumo", *[F.round(c, 6).alias(c) if "AMT" in c or c == "LIMIT_BAL" else F.col(c) for c in ml.FEATURES])


DOC_FEATURES = ("chars", "words", "commas", "lines", "capitals")


def labelled(spark, d):
    """Labels with features counted in the documents."""
    body = F.col("text")
    rows = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    return rows.select(
        "doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("chars"),
        F.size(text.words(body)).cast("double").alias("words"),
        F.regexp_count(body, F.lit(",")).cast("double").alias("commas"),
        F.regexp_count(body, F.lit("\n")).cast("double").alias("lines"),
        F.regexp_count(body, F.lit(r"\p{Lu}")).cast("double").alias("capitals"))


@query("stratified_split", """
WITH n AS (SELECT quality AS label, count(*) AS c FROM labels GROUP BY 1)
SELECT label, c AS total, CAST(round(c * 0.2) AS BIGINT) AS test_rows FROM n""")
def stratified_split(spark, d):
    out = ml.stratified_split(labelled(spark, d), "label", "doc_id")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("is_test"), 1)).alias("test_rows"))


@query("stratified_split_rows", """
WITH r AS (SELECT doc_id, quality AS label, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS n, count(*) OVER (PARTITION BY quality) AS c FROM labels)
SELECT doc_id, label, n <= round(c * 0.2) AS is_test FROM r""")
def stratified_split_rows(spark, d):
    """Every row with the side it is on."""
    return ml.stratified_split(table(spark, d, "labels").withColumn("label", F.col("quality")), "label", "doc_id").select(
        "doc_id", "label", "is_test")


#: folder of the fitted model and its test rows, by session and input
_FITTED: dict[tuple[str, str], str] = {}


def trained(spark, d):
    """The fitted model and the rows kept apart for testing; fitted once, stored, and read back by every query."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        folder = scratch_folder(spark)
        rows = ml.stratified_split(labelled(spark, d), "label", "doc_id")
        rows.write.parquet(f"{folder}/rows")
        rows = spark.read.parquet(f"{folder}/rows")
        ml.train_risk_forest(rows.where("not is_test"), "label", DOC_FEATURES).write().save(f"{folder}/model")
        _FITTED[key] = folder
    folder = _FITTED[key]
    return PipelineModel.load(f"{folder}/model"), spark.read.parquet(f"{folder}/rows").where("is_test")


@query("train_risk_forest")
def train_risk_forest(spark, d):
    """Importance of every feature in the trained forest."""
    model, _ = trained(spark, d)
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(DOC_FEATURES, weights)), "feature string, importance double")


@query("forest_facts", f"SELECT CAST({len(DOC_FEATURES)} AS BIGINT) AS features, CAST(1 AS DOUBLE) AS total")
def forest_facts(spark, d):
    """The importances of the features add up to one."""
    return train_risk_forest(spark, d).agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"))


@query("score_facts", """
WITH n AS (SELECT quality AS label, count(*) AS c FROM labels GROUP BY 1)
SELECT label, CAST(round(c * 0.2) AS BIGINT) AS scored, true AS whole, true AS named FROM n""")
def score_facts(spark, d):
    """Every test row is scored once, its two shares add up to one, and the larger share gives the name."""
    rows = score_rows(spark, d)
    name = F.when(F.col("p_one") > F.col("p_zero"), "good").otherwise("poor")
    return rows.groupBy("label").agg(
        F.count_distinct("doc_id").alias("scored"), F.bool_and(F.abs(F.col("p_one") + F.col("p_zero") - 1) < 1e-9).alias("whole"),
        F.bool_and((F.col("predicted_name") == name) | (F.col("p_one") == F.col("p_zero"))).alias("named"))


@query("forest_quality", "SELECT true AS accurate, true AS precise, true AS found, true AS balanced, true AS ranked")
def forest_quality(spark, d):
    """The measures on the test rows against the published ones of such a forest, as a gate."""
    one = ml.classification_metrics(score_rows(spark, d)).withColumnRenamed("precision", "exact")
    return one.select(
        (F.col("accuracy") >= 0.7758).alias("accurate"), (F.col("exact") >= 0.4945).alias("precise"),
        (F.col("recall") >= 0.6066).alias("found"), (F.col("f1") >= 0.5448).alias("balanced"), (F.col("roc_auc") >= 0.7746).alias("ranked"))


@query("score_rows")
def score_rows(spark, d):
    model, test = trained(spark, d)
    return ml.score_rows(model, test, ("poor", "good")).select("doc_id", "label", "predicted", "predicted_name", "p_one", "p_zero")


@query("classification_metrics", """
WITH s AS (SELECT doc_id, quality AS label, (doc_id * 37 % 100) / 100 AS p FROM labels),
c AS (SELECT count(*) FILTER (WHERE label = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (WHERE label = 0 AND p < 0.5) AS tn, count(*) FILTER (WHERE label = 1 AND p < 0.5) AS fn FROM s),
a AS (SELECT sum(CASE WHEN x.p > y.p THEN 1 WHEN x.p = y.p THEN 0.5 ELSE 0 END) / count(*) AS auc FROM s x, s y WHERE x.label = 1 AND y.label = 0)
SELECT round((tp + tn) / (tp + tn + fp + fn), 4) AS accuracy, round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 4) AS f1, tp, fp, tn, fn, round(auc, 4)::DOUBLE AS roc_auc FROM c, a""")
def classification_metrics(spark, d):
    """Measures of a fixed score, so that both sides see the same predictions."""
    p = (F.col("doc_id") * 37 % 100) / 100
    scored = table(spark, d, "labels").select(
        F.col("quality").alias("label"), p.alias("p_one"), (p >= 0.5).cast("int").alias("predicted"))
    return ml.classification_metrics(scored)
