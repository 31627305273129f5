"""Canned reports over a supply table, item search, free SQL and table profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import let
from tidemark.sources.scratch import written_table

_ITEM = ("id_insumo", "insumo", "categoria", "fornecedor", "lote_minimo_compra", "consumo_medio_6m",
         "consumo_medio_12m", "custo_aquisicao_unitario", "prazo_entrega_dias", "indice_reajuste_12m",
         "criticidade_insumo")
_IMPACT = "consumo_medio_12m * custo_aquisicao_unitario"


def kpi_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("fornecedor").alias("suppliers"),
        F.avg("custo_aquisicao_unitario").alias("mean_cost"),
    )


def top_categories_by_impact(df: DataFrame, n: int = 10) -> DataFrame:
    return (
        df.groupBy("categoria").agg(F.sum(F.expr(_IMPACT)).alias("impacto_anual"))
        .orderBy(F.col("impacto_anual").desc(), "categoria").limit(n)
    )


def top_suppliers_by_volume(df: DataFrame, n: int = 15) -> DataFrame:
    return (
        df.groupBy("fornecedor")
        .agg(F.sum("consumo_medio_6m").alias("consumo_total_6m"), F.avg("custo_aquisicao_unitario").alias("custo_medio"))
        .orderBy(F.col("consumo_total_6m").desc(), "fornecedor").limit(n)
    )


def critical_by_cost(df: DataFrame, n: int = 20) -> DataFrame:
    return (
        df.where(F.lower("criticidade_insumo") == "alta")
        .orderBy(F.col("custo_aquisicao_unitario").desc(), "id_insumo").limit(n)
        .select("id_insumo", "insumo", "categoria", "fornecedor", "criticidade_insumo", "custo_aquisicao_unitario")
    )


def category_supplier_summary(df: DataFrame, n: int = 20) -> DataFrame:
    return (
        df.groupBy("categoria", "fornecedor")
        .agg(F.sum("consumo_medio_6m").alias("consumo_6m_total"), F.avg("custo_aquisicao_unitario").alias("custo_medio"))
        .orderBy(F.col("consumo_6m_total").desc(), "categoria", "fornecedor").limit(n)
    )


def enrich_items(df: DataFrame) -> DataFrame:
    """Yearly cost impact, and months one minimum lot lasts (null without consumption)."""
    zero = F.lit(0.0)
    use = F.coalesce("consumo_medio_6m", zero)
    return df.withColumns({
        "impacto_financeiro_anual": F.round(
            F.coalesce("consumo_medio_12m", zero) * F.coalesce("custo_aquisicao_unitario", zero), 2),
        "cobertura_lote_meses": F.when(
            use > 0, F.round(F.coalesce(F.col("lote_minimo_compra").cast("double"), zero) / use, 2)),
    })


def item_search(df: DataFrame, text: str, limit: int = 10) -> DataFrame:
    """Items whose name, supplier or id contain the text, largest yearly impact first."""
    pattern = f"%{text.strip().lower()}%"
    hit = F.lit(False)
    for name in ("insumo", "fornecedor", "id_insumo"):
        hit = hit | F.lower(name).like(pattern)
    found = df.where(hit).orderBy(F.expr(_IMPACT).desc(), "id_insumo").limit(limit)
    return enrich_items(found.select(*_ITEM))


def browse_items(df: DataFrame, limit: int = 500) -> DataFrame:
    return df.orderBy("id_insumo").limit(limit)


_NAME_CANDIDATES = 20


_NAME_FIELDS = ("insumo", "fornecedor", "id_insumo")
_GRAM = 3
_FEW_RUNS = 64


def _grams(value: Column, sizes: Sequence[int]) -> Column:
    """All runs of so many letters of a text; none of a size where it is shorter.  Linear in the text.

    A size of 0 gives the empty run.
    """

    def runs(letters: Column) -> Column:
        return F.flatten(F.array(*[F.transform(
            F.slice(letters, 1, F.greatest(F.length(value) - size + 1, F.lit(0))),
            lambda letter, i: F.concat(letter, *[letters[i + step] for step in range(1, size)])) for size in sizes if size]))  # noqa: B023

    found = let(F.split(value, ""), runs) if any(sizes) else F.array().cast("array<string>")
    return F.concat(F.array(F.lit("")), found) if 0 in sizes else found


def _name_candidates(df: DataFrame, names: DataFrame) -> DataFrame:
    """Items that match a name (distinct `name`) by LIKE '%name%' in any field, the 20 of largest impact per name.

    A posting table of letter runs finds candidates, LIKE per field decides.  Every name is looked up by one run
    only, the rarest of those in its longest part without wildcards: of three letters, or as long as that part
    where it is shorter.  A name of wildcards only has the empty run, which every item holds.
    The runs asked for are written once, so Spark knows their size and sends them to the items where they are few:
    the runs of the items, many times the table, are then looked up where they are made and never shuffled.
    Up to `_FEW_RUNS` distinct runs are looked for in the fields one by one, which is cheaper than making all of an item's.
    """
    parts = F.split("name", "[%_]")
    longest = F.array_sort(parts, lambda a, b: F.length(b) - F.length(a))[0]
    asked = names.withColumn("_part", longest).withColumn("_size", F.least(F.length("_part"), F.lit(_GRAM)))
    own = F.when(F.col("_size") == 0, F.array(F.lit("")))
    for size in range(1, _GRAM + 1):
        own = own.when(F.col("_size") == size, _grams(F.col("_part"), [size]))
    runs = written_table(asked.select("name", F.explode(F.array_distinct(own)).alias("run")))
    wanted = runs.select("run").distinct()
    lower = [F.coalesce(F.lower(name), F.lit("")).alias(f"_l{i}") for i, name in enumerate(_NAME_FIELDS)]
    fields = [F.col(f"_l{i}") for i in range(len(_NAME_FIELDS))]
    few = [r.run for r in wanted.limit(_FEW_RUNS + 1).collect()]
    if len(few) <= _FEW_RUNS:
        tested = [F.when(reduce(or_, [f.contains(run) for f in fields]), F.lit(run)) for run in few]
        held = F.array_compact(F.array(*tested).cast("array<string>"))
    else:
        sizes = [r[0] for r in runs.select(F.length("run")).distinct().collect()]  # 0 to 3
        held = F.array_distinct(F.flatten(F.array(*[_grams(f, sizes) for f in fields])))
    rows = df.select(*_NAME_FIELDS, F.expr(_IMPACT).cast("double").alias("_impact"), *lower).select(
        *_NAME_FIELDS, "_impact", F.explode(held).alias("run"))
    frequency = rows.select("run").join(wanted, "run").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    # a run no item holds is the rarest of all: its name matches nothing
    rarest = written_table(
        runs.join(frequency, "run", "left").groupBy("name")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")).alias("_r")).select("name", "_r.run")
    )
    pattern = F.concat(F.lit("%"), F.replace("name", F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    plain = ~F.col("name").rlike("[%_]")
    hit = F.lit(False)
    for name in _NAME_FIELDS:
        value = F.lower(name)
        hit = hit | F.coalesce(F.when(plain, value.contains(F.col("name"))).otherwise(F.like(value, pattern)), F.lit(False))
    order = Window.partitionBy("name").orderBy(F.col("_impact").desc_nulls_last(), "id_insumo")
    return (
        rows.join(rarest, "run").where(hit).select("name", "id_insumo", "fornecedor", "_impact")
        .withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= _NAME_CANDIDATES)
    )


def item_resolve(df: DataFrame, requests: DataFrame) -> DataFrame:
    """One item per request (request_id bigint, id_insumo, insumo, fornecedor).

    By id when given; else the first by impact of the 20 best name matches, narrowed by supplier.
    """
    by_id = requests.where(F.col("id_insumo").isNotNull()).select(
        "request_id", F.trim("id_insumo").alias("id_insumo"))
    by_name = requests.where(F.col("id_insumo").isNull() & F.col("insumo").isNotNull()).select(
        "request_id", F.lower(F.trim("insumo")).alias("name"), F.lower(F.trim("fornecedor")).alias("_f"))
    order = Window.partitionBy("request_id").orderBy("_rn")
    first = (
        _name_candidates(df, by_name.select("name").distinct()).join(by_name, "name")
        .where(F.col("_f").isNull() | F.lower("fornecedor").contains(F.col("_f")))
        .withColumn("_first", F.row_number().over(order)).where("_first = 1").select("request_id", "id_insumo")
    )
    chosen = written_table(by_id.unionByName(first))  # a row per request at most, read twice
    wanted = chosen.select("id_insumo").distinct()
    items = df.select(*_ITEM).join(wanted, "id_insumo", "left_semi").dropDuplicates(["id_insumo"])
    found = enrich_items(chosen.join(items, "id_insumo"))
    return requests.select("request_id").join(found, "request_id", "left").withColumn(
        "found", F.col("insumo").isNotNull())


def free_sql(spark: SparkSession, views: dict[str, DataFrame], sql: str) -> DataFrame:
    """Any SELECT over named tables."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def table_profile(
    tables: dict[str, DataFrame],
    include: Sequence[str] | None = None,
    ignore: Sequence[str] | None = None,
    sample_rows: int = 3,
) -> DataFrame:
    """One row per table: its columns with types, and a few rows as JSON lines.

    The rows are those whose JSON text has the smallest MD5, in that order, so they do not depend on how a table
    is stored or dealt out; equal rows count each.  Every partition gives its `sample_rows` smallest only.
    """
    if include and ignore:
        raise ValueError("give tables to include or to ignore, not both")
    out: DataFrame | None = None
    for name, df in tables.items():
        if (include and name not in include) or (ignore and name in ignore):
            continue
        columns = ", ".join(f"{c} {t}" for c, t in df.dtypes)
        lines = df.select(F.to_json(F.struct("*")).alias("line")).select(F.md5("line").alias("h"), "line")
        smallest = F.sort_array(F.collect_list(F.struct("h", "line")))
        one = (
            lines.orderBy("h", "line").limit(sample_rows)
            .agg(F.array_join(F.transform(smallest, lambda r: r["line"]), "\n").alias("sample"))
            .select(F.lit(name).alias("table_name"), F.lit(columns).alias("columns"), "sample")
        )
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no table is left to describe")
    return out
