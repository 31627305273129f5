"""Supply rows to risk features, an exact stratified split, a random forest and its measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import number_rows, running_sum

# fixed values: the feature columns of the risk model, in order
FEATURES = (
    "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE",
    "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6",
    "BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6",
    "PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6",
)
# fixed values: share of the stock value and of the monthly payment behind each bill and payment column
_BILL_SHARE = (1.0, 0.95, 0.9, 0.88, 0.85, 0.82)
_PAY_SHARE = (1.0, 0.9, 1.05, 0.95, 1.0, 0.85)
#: rows of a training task; below the first, the sums of a task's tree nodes outweigh its rows
LEAST_ROWS, MOST_ROWS = 2_000, 100_000


def _number(name: str, default: Column) -> Column:
    value = F.col(name).cast("string").try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), default)


def supply_features(df: DataFrame) -> DataFrame:
    """Add the 23 feature columns to supply rows, all as double."""
    base = df.withColumn("_use6", _number("consumo_medio_6m", F.lit(100.0))).withColumns({
        "_use12": _number("consumo_medio_12m", F.col("_use6") * 1.8),
        "_cost": _number("custo_aquisicao_unitario", F.lit(50.0)),
        "_lot": _number("lote_minimo_compra", F.lit(100.0)),
        "_lead": _number("prazo_entrega_dias", F.lit(30.0)),
        "_rise": _number("indice_reajuste_12m", F.lit(0.05)),
    })
    staged = base.withColumn("_cover", F.col("_lot") / F.greatest("_use6", F.lit(1.0))).withColumns({
        "_pay": F.when(
            (F.col("_rise") > 0.15) | (F.col("_cover") > 3), F.least(F.lit(6), F.col("_cover").cast("bigint")))
        .when(F.col("_rise") < 0, -1).otherwise(0),
        "_stock": F.col("_lot") * F.col("_cost"),
        "_month": F.col("_use6") / 6.0 * F.col("_cost"),
    })
    critical = F.lower(F.coalesce(F.col("criticidade_insumo").cast("string"), F.lit("none")))
    pay = F.col("_pay")
    columns = {
        "LIMIT_BAL": F.least(F.greatest(F.col("_use12") * F.col("_cost"), F.lit(1.0)) * 1.2, F.lit(1_000_000.0)),
        "SEX": F.lit(1),
        "EDUCATION": F.when(critical == "baixa", 1).when(critical == "alta", 3).otherwise(2),
        "MARRIAGE": F.lit(1),
        "AGE": F.least(F.greatest(F.col("_lead").cast("bigint"), F.lit(21)), F.lit(79)),
        "PAY_0": pay, "PAY_3": pay, "PAY_5": pay,
        "PAY_2": F.greatest(pay - 1, F.lit(-2)), "PAY_6": F.greatest(pay - 1, F.lit(-2)),
        "PAY_4": F.least(pay + 1, F.lit(8)),
        **{f"BILL_AMT{i}": F.col("_stock") * share for i, share in enumerate(_BILL_SHARE, 1)},
        **{f"PAY_AMT{i}": F.col("_month") * share for i, share in enumerate(_PAY_SHARE, 1)},
    }
    return staged.select(*df.columns, *[columns[name].cast("double").alias(name) for name in FEATURES])


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `is_test` for exactly the rounded share of every class, chosen by the MD5 of `seed:key`."""
    hashed = df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    numbered = number_rows(hashed, [label], ["_h", key], "_rn")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return numbered.join(sizes, label).withColumn("is_test", F.col("_rn") <= F.round(F.col("_n") * test)).drop("_h", "_rn", "_n")


def balanced_weight(df: DataFrame, label: str) -> DataFrame:
    """Add `weight` = rows / (classes * rows of the class)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    weights = sizes.withColumns({
        "_all": sizes.agg(F.sum("_n")).scalar(), "_classes": sizes.agg(F.count(F.lit(1))).scalar(),
    }).select(label, (F.col("_all") / (F.col("_classes") * F.col("_n"))).alias("weight"))
    # a row per class; a shuffle by class would leave as many tasks as classes
    return df.join(F.broadcast(weights), label)


def deal_out(df: DataFrame, least: int = LEAST_ROWS, most: int = MOST_ROWS) -> DataFrame:
    """The rows in equal parts for all cores, of `least` rows or more and of `most` at most; few rows stay as they are."""
    rows = df.count()
    parts = min(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // most)), rows // least)
    return df.repartition(parts) if parts > 1 else df


def train_risk_forest(
    df: DataFrame, label: str, features: Sequence[str] = FEATURES, trees: int = 200, depth: int = 12,
    min_rows: int = 10, seed: int = 42,
) -> PipelineModel:
    """Random forest with balanced classes.

    A task of the training walks its rows once for every tree, and keeps 4 bytes per row and tree; rows read from small
    files would all lie in one task, so they are dealt out.
    """
    weighted = balanced_weight(deal_out(df), label)
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_rows, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), forest]).fit(weighted)


def score_rows(model: PipelineModel, df: DataFrame, names: Sequence[str] = ("adimplente", "inadimplente")) -> DataFrame:
    """Add predicted class, its name, and the rounded probabilities of class 1 and 0."""
    scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    one = F.round(F.col("_p")[1], 4)
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("predicted"),
        F.element_at(F.array(*map(F.lit, names)), F.col("prediction").cast("int") + 1).alias("predicted_name"),
        one.alias("p_one"),
        F.round(1 - one, 4).alias("p_zero"),
    )


def roc_auc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve: rank sums over the distinct scores, ties counted half."""
    per_score = scored.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_neg"),
    )
    below = running_sum(per_score, [], ["_s"], F.col("_neg"), "_upto")
    wins = F.sum((F.col("_upto") - F.col("_neg") / 2) * F.col("_pos"))
    return below.agg(F.try_divide(wins, F.sum("_pos") * F.sum("_neg")).alias("roc_auc"))


def classification_metrics(scored: DataFrame, label: str = "label", predicted: str = "predicted", score: str = "p_one"
                           ) -> DataFrame:
    """Accuracy, precision, recall, f1 and ROC AUC to four digits, with the confusion counts; 0 where undefined."""
    def count(actual: int, guess: int) -> Column:
        return F.count(F.when((F.col(label) == actual) & (F.col(predicted) == guess), 1))

    cells = scored.agg(
        count(1, 1).alias("tp"), count(0, 1).alias("fp"), count(0, 0).alias("tn"), count(1, 0).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def ratio(above: Column, below: Column) -> Column:
        return F.coalesce(F.round(F.try_divide(above, below), 4), F.lit(0.0))

    return cells.select(
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "tp", "fp", "tn", "fn",
    ).withColumn("roc_auc", F.coalesce(F.round(roc_auc(scored, label, score).scalar(), 4), F.lit(0.0)))
