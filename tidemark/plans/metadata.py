"""Registered queries: cleaning, metadata and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import jsons, text
from tidemark.operators import metadata as M
from tidemark.plans.inputs import DOCS, EVENTS_JS, docs, events, table
from tidemark.plans.registry import query


def _fields(df, *names):
    return df.select("doc_id", *[F.get_json_object("metadata", f"$.{n}").alias(n) for n in names])


@query("apply_metadata", "SELECT doc_id, lang, 'none' AS owner, 'etl' AS job, source FROM documents")
def apply_metadata(spark, d):
    out = M.apply_metadata(
        docs(spark, d), {"lang": "xx", "job": "etl", "owner": "none", "n_chars": 0}, omit=["n_chars"])
    return _fields(out, "lang", "job", "owner", "source")


@query("apply_metadata_additional_wins", """
SELECT doc_id, 'xx' AS lang, source, CAST(n_chars AS VARCHAR) AS n_chars, 'ref' AS ref, NULL::VARCHAR AS gone,
  '{"keep":1}' AS deep FROM documents""")
def apply_metadata_additional_wins(spark, d):
    out = M.apply_metadata(
        docs(spark, d), {"lang": "xx", "gone": "y", "deep": {"keep": 1, "drop": 2}}, omit="gone, deep.drop",
        precedence="additional", source_id_key="ref")
    return _fields(out, "lang", "source", "n_chars", "ref", "gone", "deep")


@query("flatten_json", f"""WITH {EVENTS_JS}
SELECT event_id, event_type AS type, CAST(user_id AS VARCHAR) AS "user.id", 't' || (user_id % 7) AS "user.tags.0",
  json_extract_string(props, '$.k') AS "props.k", json_extract_string(js, '$.note') AS note FROM ev""")
def flatten_json(spark, d):
    flat = events(spark, d).select("event_id", jsons.flatten_json(F.col("js")).alias("m"))
    return flat.select(
        "event_id", *[F.try_element_at("m", F.lit(k)).alias(k)
                      for k in ("type", "user.id", "user.tags.0", "props.k", "note")])


@query("json_leaves", f"""WITH {EVENTS_JS}
SELECT event_id, CAST(i - 1 AS INTEGER) AS leaf_no, leaves[i] AS leaf FROM (
  SELECT event_id, unnest(range(1, 7)) AS i, [event_type, CAST(user_id AS VARCHAR), 't' || (user_id % 7), 'all',
    json_extract_string(props, '$.k'), coalesce(json_extract_string(js, '$.note'), 'null')] AS leaves FROM ev)""")
def json_leaves(spark, d):
    return M.json_leaves(events(spark, d).select("event_id", "js"), F.col("js")).drop("js")


@query("json_path_get", f"""WITH {EVENTS_JS}
SELECT event_id, event_type AS type, CAST(user_id AS VARCHAR) AS uid, 't' || (user_id % 7) AS first_tag, 'all' AS last_tag,
  coalesce(json_extract_string(js, '$.note'), 'null') AS note, 'null' AS missing FROM ev""")
def json_path_get(spark, d):
    js = F.col("js")
    return events(spark, d).select(
        "event_id",
        jsons.json_path_get(js, "type").alias("type"),
        jsons.json_path_get(js, "user.id").alias("uid"),
        jsons.json_path_get(js, "user.tags[0]").alias("first_tag"),
        jsons.json_path_get(js, "user.tags[-1]").alias("last_tag"),
        jsons.json_path_get(js, "note").alias("note"),
        jsons.json_path_get(js, "user.nothing", "null_text").alias("missing"),
    )


@query("repair_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events""")
def repair_json(spark, d):
    """Props with a trailing comma, single quotes, bare keys or a comment, by turns."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    broken = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"k": '), k, F.lit(', "kind": "'), kind, F.lit('",}')))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("{'k': "), k, F.lit(", 'kind': '"), kind, F.lit("'}")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("{k: "), k, F.lit(', kind: "'), kind, F.lit('"} // end')))
        .otherwise(F.concat(F.lit('/* note */ \\{"k": '), k, F.lit(', "kind": "'), kind, F.lit('"\\}')))
    )
    fixed = table(spark, d, "events").select("event_id", jsons.repair_json(broken).alias("js"))
    return fixed.select(
        "event_id", F.get_json_object("js", "$.k").cast("bigint").alias("k"),
        F.get_json_object("js", "$.kind").alias("kind"))


@query("normalize_keys", """
SELECT event_id, json_extract_string(props, '$.k') AS k_1, event_type AS a_b FROM events""")
def normalize_keys(spark, d):
    js = F.concat(F.lit('{"k-1": '), F.get_json_object("props", "$.k"), F.lit(', "in ner": {"a.b": "'),
                  F.col("event_type"), F.lit('"}}'))
    out = table(spark, d, "events").select("event_id", M.normalize_keys(js).alias("js"))
    return out.select("event_id", F.get_json_object("js", "$.k_1").alias("k_1"),
                      F.get_json_object("js", "$.in_ner.a_b").alias("a_b"))


@query("primitive_metadata", """
SELECT doc_id, lang, CAST(n_chars AS VARCHAR) AS n_chars, '1' AS "locFrom", CAST(doc_id AS VARCHAR) AS "locTo",
  '["' || lang || '",1]' AS tags FROM documents""")
def primitive_metadata(spark, d):
    js = F.concat(F.expr("substring(metadata, 1, length(metadata) - 1)"), F.lit(',"tags":["'), F.col("lang"),
                  F.lit('",1],"loc":{"lines":{"from":1,"to":'), F.col("doc_id"), F.lit("}}}"))
    out = docs(spark, d).withColumn("metadata", jsons.primitive_metadata(js))
    return _fields(out, "lang", "n_chars", "locFrom", "locTo", "tags")


@query("clean_docs", """
SELECT doc_id, text AS page_content FROM documents WHERE doc_id % 9 <> 0""")
def clean_docs(spark, d):
    """Every ninth document holds only a NUL, the others get one inside."""
    dirty = docs(spark, d).withColumn(
        "page_content",
        F.when(F.col("doc_id") % 9 == 0, F.lit("\u0000")).otherwise(F.concat(F.lit("\u0000"), "page_content")))
    return M.clean_docs(dirty).select("doc_id", "page_content")


@query("concat_docs_text", f"""WITH {DOCS}, n AS (
  SELECT *, CAST(sum(length(page_content) + 1) OVER (PARTITION BY source ORDER BY doc_id) - length(page_content) - 1 AS BIGINT) // 20000 AS part FROM docs)
SELECT source, part, count(*) OVER (PARTITION BY source) AS n_parts, string_agg(page_content, chr(10) ORDER BY doc_id) || chr(10) AS text
FROM n GROUP BY source, part""")
def concat_docs_text(spark, d):
    return M.concat_docs_text(docs(spark, d), ["source"], ["doc_id"], part_chars=20000)


@query("metadata_contains", "SELECT doc_id FROM documents WHERE lang = 'en' AND source = 'src1'")
def metadata_contains(spark, d):
    return docs(spark, d).where(
        jsons.metadata_contains(F.col("metadata"), {"lang": "en", "source": "src1"})).select("doc_id")


@query("tenant_scope_filter", """
SELECT doc_id FROM documents WHERE (lang = 'en' AND doc_id % 4 <> 0) OR (doc_id % 4 = 0 AND doc_id % 5 = 2)""")
def tenant_scope_filter(spark, d):
    """Every fourth document belongs to one of five chats."""
    tagged = docs(spark, d).withColumn(
        "metadata",
        F.when(F.col("doc_id") % 4 == 0,
               F.concat(F.expr("substring(metadata, 1, length(metadata) - 1)"), F.lit(',"chatId":"chat'),
                        F.col("doc_id") % 5, F.lit('"}'))).otherwise(F.col("metadata")))
    return tagged.where(jsons.tenant_scope_filter(F.col("metadata"), {"lang": "en"}, "chat2")).select("doc_id")


@query("metadata_equals_all", "SELECT doc_id FROM documents WHERE lang = 'fr' AND source = 'src3'")
def metadata_equals_all(spark, d):
    return docs(spark, d).where(
        jsons.metadata_equals_all(F.col("metadata"), {"lang": "fr", "source": "src3"})).select("doc_id")


@query("filter_chain", """
SELECT p_partkey, p_name, p_size FROM part
WHERE p_size >= 10 AND p_size <= 30 AND lower(p_name) LIKE '%ring%' AND p_type IN ('ECONOMY', 'STANDARD') AND p_brand <> 'Brand#1'
ORDER BY p_size DESC, p_partkey LIMIT 40 OFFSET 5""")
def filter_chain(spark, d):
    return M.filter_chain(
        table(spark, d, "part"),
        [("p_size", "gte", 10), ("p_size", "lte", 30), ("p_name", "ilike", "%RING%"),
         ("p_type", "in", ["ECONOMY", "STANDARD"]), ("p_brand", "neq", "Brand#1")],
        order=[("p_size", False), ("p_partkey", True)], range_=(5, 44),
    ).select("p_partkey", "p_name", "p_size")


@query("filter_chain_json", """
SELECT doc_id FROM documents
WHERE n_chars > 500 AND n_chars < 4000 AND list_contains(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), 'the')
  AND list_has_any([lang, source], ['en', 'src4'])""")
def filter_chain_json(spark, d):
    tagged = docs(spark, d).withColumn("tags", F.array("lang", "source"))
    return M.filter_chain(
        tagged,
        [("metadata->n_chars::int", "gt", 500), ("metadata->n_chars::int", "lt", 4000),
         ("page_content", "fts", "the"), ("tags", "ov", ["en", "src4"])],
    ).select("doc_id")


@query("filter_chain_ranges", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_quantity >= 5 AND l_quantity + l_tax * 100 <= 40 AND l_quantity >= 20 AND l_returnflag IS NOT NULL""")
def filter_chain_ranges(spark, d):
    spans = table(spark, d, "lineitem").withColumn(
        "span", F.struct(F.col("l_quantity").alias("lo"), (F.col("l_quantity") + F.col("l_tax") * 100).alias("hi")))
    return M.filter_chain(
        spans, [("span", "nxl", (5.0, 50.0)), ("span", "nxr", (0.0, 40.0)), ("span", "sr", (0.0, 20.0)),
                ("l_returnflag", "like", "%")]
    ).select("l_orderkey", "l_linenumber")


@query("strip_bad_images", """
SELECT doc_id, text || ' ' || ' ![b](https://example.com/b.png) [c](d.png)' AS page_content FROM documents""")
def strip_bad_images(spark, d):
    marked = F.concat("page_content", F.lit(" ![a](./a.png) ![b](https://example.com/b.png) [c](d.png)"))
    return docs(spark, d).select("doc_id", text.no_bad_images(marked).alias("page_content"))
