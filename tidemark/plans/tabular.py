"""Registered queries: reports over a supply table built from parts and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import tabular as T
from tidemark.plans.inputs import SUPPLY, supply, table
from tidemark.plans.registry import query

IMPACT = "CAST(consumo_medio_12m * custo_aquisicao_unitario AS DECIMAL(18, 4))"


@query("kpi_totals", f"""WITH {SUPPLY}
SELECT count(*) AS total_rows, count(DISTINCT fornecedor) AS suppliers, round(avg(custo_aquisicao_unitario), 4) AS mean_cost FROM supply""")
def kpi_totals(spark, d):
    return T.kpi_totals(supply(spark, d)).withColumn("mean_cost", F.round("mean_cost", 4))


@query("top_categories_by_impact", f"""WITH {SUPPLY}
SELECT categoria, round(sum(consumo_medio_12m * custo_aquisicao_unitario), 2) AS impacto_anual FROM supply
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_categories_by_impact(spark, d):
    return T.top_categories_by_impact(supply(spark, d)).withColumn("impacto_anual", F.round("impacto_anual", 2))


@query("top_suppliers_by_volume", f"""WITH {SUPPLY}
SELECT fornecedor, sum(consumo_medio_6m) AS consumo_total_6m, round(avg(custo_aquisicao_unitario), 4) AS custo_medio FROM supply
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def top_suppliers_by_volume(spark, d):
    return T.top_suppliers_by_volume(supply(spark, d)).withColumn("custo_medio", F.round("custo_medio", 4))


@query("critical_by_cost", f"""WITH {SUPPLY}
SELECT id_insumo, insumo, categoria, fornecedor, criticidade_insumo, custo_aquisicao_unitario FROM supply
WHERE lower(criticidade_insumo) = 'alta' ORDER BY custo_aquisicao_unitario DESC, id_insumo LIMIT 20""")
def critical_by_cost(spark, d):
    return T.critical_by_cost(supply(spark, d))


@query("category_supplier_summary", f"""WITH {SUPPLY}
SELECT categoria, fornecedor, sum(consumo_medio_6m) AS consumo_6m_total, round(avg(custo_aquisicao_unitario), 4) AS custo_medio
FROM supply GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""")
def category_supplier_summary(spark, d):
    return T.category_supplier_summary(supply(spark, d)).withColumn("custo_medio", F.round("custo_medio", 4))


ENRICHED = """round(consumo_medio_12m * custo_aquisicao_unitario, 2) AS impacto_financeiro_anual,
  CASE WHEN consumo_medio_6m > 0 THEN round(lote_minimo_compra / consumo_medio_6m, 2) END AS cobertura_lote_meses"""


@query("item_search", f"""WITH {SUPPLY}
SELECT id_insumo, insumo, fornecedor, {ENRICHED} FROM supply
WHERE lower(insumo) LIKE '%ring%' OR lower(fornecedor) LIKE '%ring%' OR lower(id_insumo) LIKE '%ring%'
ORDER BY consumo_medio_12m * custo_aquisicao_unitario DESC, id_insumo LIMIT 10""")
def item_search(spark, d):
    return T.item_search(supply(spark, d), " Ring ").select(
        "id_insumo", "insumo", "fornecedor", "impacto_financeiro_anual", "cobertura_lote_meses")


def _resolve_sql(names: tuple[str, ...]) -> str:
    asked = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"""WITH {SUPPLY}, req AS (
  SELECT CAST(n_nationkey AS BIGINT) AS request_id, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey || '-' || n_nationkey END AS rid,
    CASE n_regionkey {asked} END AS name,
    CASE WHEN n_regionkey < 2 THEN 'SUPPLIER ' || n_regionkey END AS sup FROM nation),
named AS (SELECT request_id, sup, s.*, row_number() OVER (PARTITION BY request_id ORDER BY consumo_medio_12m * custo_aquisicao_unitario DESC, id_insumo) AS rn
  FROM req JOIN supply s ON rid IS NULL AND (lower(insumo) LIKE '%' || name || '%' OR lower(fornecedor) LIKE '%' || name || '%' OR lower(id_insumo) LIKE '%' || name || '%')
  QUALIFY rn <= 20),
pick AS (SELECT request_id, id_insumo FROM named WHERE sup IS NULL OR lower(fornecedor) LIKE '%' || lower(sup) || '%'
  QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY rn) = 1
  UNION ALL SELECT request_id, rid FROM req JOIN supply ON rid = id_insumo)
SELECT req.request_id, pick.id_insumo, pick.id_insumo IS NOT NULL AS found FROM req LEFT JOIN pick USING (request_id)"""


def _resolved(spark, d, names: tuple[str, ...]):
    """Requests by nation: every second one by id, the others by the name of their region."""
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    requests = table(spark, d, "nation").select(
        key.cast("bigint").alias("request_id"),
        F.when(key % 2 == 0, F.concat_ws("-", key, key)).alias("id_insumo"),
        F.get(F.array(*map(F.lit, names)), region).alias("insumo"),
        F.when(region < 2, F.concat(F.lit("SUPPLIER "), region)).alias("fornecedor"))
    return T.item_resolve(supply(spark, d), requests).select("request_id", "id_insumo", "found")


_NAMES = ("ring", "red", "widget", "no such", "small")
_WILD_NAMES = ("r_d%ng", "w", "%t_", "9%red", "_")


@query("item_resolve", _resolve_sql(_NAMES))
def item_resolve(spark, d):
    return _resolved(spark, d, _NAMES)


@query("item_resolve_wildcards", _resolve_sql(_WILD_NAMES))
def item_resolve_wildcards(spark, d):
    return _resolved(spark, d, _WILD_NAMES)


_FREE = """SELECT categoria, criticidade_insumo, count(*) AS items, max(prazo_entrega_dias) AS longest
FROM vw_produtos WHERE indice_reajuste_12m > 0 GROUP BY categoria, criticidade_insumo HAVING count(*) > 5"""


@query("free_sql", f"WITH {SUPPLY}, vw_produtos AS (SELECT * FROM supply) {_FREE}")
def free_sql(spark, d):
    return T.free_sql(spark, {"vw_produtos": supply(spark, d)}, _FREE)


@query("table_profile")
def table_profile(spark, d):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return T.table_profile({n: table(spark, d, n) for n in names}, ignore=["region"])


# the columns of whole numbers and texts, which both engines print alike
_PRINTED = {
    "nation": ("n_nationkey int", "n_name string", "n_regionkey int"),
    "customer": ("c_custkey bigint", "c_name string", "c_nationkey int", "c_mktsegment string"),
    "part": ("p_partkey bigint", "p_name string", "p_brand string", "p_type string", "p_size int"),
    "lineitem": ("l_orderkey bigint", "l_partkey bigint", "l_linenumber int", "l_returnflag string"),
    "events": ("event_id bigint", "user_id bigint", "event_type string"),
}


def _profile_sql(name: str, columns: tuple[str, ...]) -> str:
    fields = ", ".join(f"{c.split()[0]} := {c.split()[0]}" for c in columns)
    return f"""SELECT '{name}' AS table_name, '{", ".join(columns)}' AS columns, string_agg(line, chr(10) ORDER BY md5(line), line) AS sample
FROM (SELECT line FROM (SELECT CAST(to_json(struct_pack({fields})) AS VARCHAR) AS line FROM {name}) ORDER BY md5(line), line LIMIT 3)"""


@query("table_profile_printed", " UNION ALL ".join(_profile_sql(n, c) for n, c in _PRINTED.items()))
def table_profile_printed(spark, d):
    """The profile of the columns that SQL prints alike; the sample is the same however the rows are dealt out."""
    return T.table_profile({
        n: table(spark, d, n).select(*[c.split()[0] for c in columns]).repartition(5) for n, columns in _PRINTED.items()})
