"""Registered queries: loaders, pages and imports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.urls import host_of, normalize_url
from tidemark.plans.chunking import FIXED, stored
from tidemark.plans.inputs import EVENTS_JS, events, table
from tidemark.plans.registry import query
from tidemark.session import spread
from tidemark.sources import files, web
from tidemark.sources.scratch import scratch_folder, written_csv


@query("load_csv_union", """
SELECT s_suppkey AS key, s_name AS name, s_acctbal AS amount, NULL::VARCHAR AS brand FROM supplier
UNION ALL SELECT p_partkey, p_name, p_retailprice, p_brand FROM part""")
def load_csv_union(spark, d):
    """Suppliers and parts as CSV files with different columns in one folder."""
    folder = scratch_folder(spark)
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount"))
    parts = table(spark, d, "part").select(
        F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_partkey").alias("key"),
        F.col("p_retailprice").alias("amount"))
    suppliers.write.csv(f"{folder}/in", header=True, mode="append")
    parts.write.csv(f"{folder}/in", header=True, mode="append")
    out = files.load_csv_union(spark, f"{folder}/in")
    return out.select(F.col("key").cast("bigint").alias("key"), "name", F.col("amount").cast("double").alias("amount"), "brand")


@query("load_csv_docs", """
SELECT 'key: ' || c_custkey || chr(10) || 'name: ' || c_name || chr(10) || 'nation: ' || c_nationkey AS page_content FROM customer""")
def load_csv_docs(spark, d):
    """Headers and values with blanks around them."""
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias(" key "), F.concat(F.lit(" "), "c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return files.load_csv_docs(spark, written_csv(customers)).select("page_content")


@query("load_csv_docs_column", "SELECT p_name AS page_content FROM part")
def load_csv_docs_column(spark, d):
    return files.load_csv_docs(spark, written_csv(table(spark, d, "part")), "p_name").select("page_content")


@query("load_csv_docs_quoted", """SELECT 'He said "' || text || chr(10) || '", then left' AS page_content FROM documents""")
def load_csv_docs_quoted(spark, d):
    """Whole texts, with quotes and line feeds around them, through CSV files and back."""
    said = F.concat(F.lit('He said "'), "text", F.lit('\n", then left'))
    return files.load_csv_docs(spark, written_csv(table(spark, d, "documents").select("doc_id", said.alias("said"))), "said").select("page_content")


@query("load_json_docs", f"""WITH {EVENTS_JS}
SELECT event_id AS doc_id, CAST(i AS INTEGER) AS line, c[i] AS page_content, CAST(user_id AS VARCHAR) AS uid FROM (
  SELECT event_id, user_id, unnest(range(1, 3)) AS i, ['t' || (user_id % 7), 'all'] AS c FROM ev)""")
def load_json_docs(spark, d):
    rows = events(spark, d).select(F.col("event_id").alias("doc_id"), "js")
    out = files.load_json_docs(rows, F.col("js"), ["/user/tags"], {"uid": "/user/id"})
    return out.select("doc_id", "line", "page_content", F.get_json_object("metadata", "$.uid").alias("uid"))


@query("load_json_docs_strings", f"""WITH {EVENTS_JS}, s AS (
  SELECT event_id, list_filter([event_type, 't' || (user_id % 7), 'all', json_extract_string(js, '$.note')], lambda x : x IS NOT NULL) AS c FROM ev)
SELECT event_id AS doc_id, CAST(i AS INTEGER) AS line, c[i] AS page_content FROM (SELECT event_id, c, unnest(range(1, len(c) + 1)) AS i FROM s)""")
def load_json_docs_strings(spark, d):
    rows = events(spark, d).select(F.col("event_id").alias("doc_id"), "js")
    return files.load_json_docs(rows, F.col("js")).select("doc_id", "line", "page_content")


@query("load_json_docs_objects", f"""WITH {EVENTS_JS}
SELECT event_id AS doc_id, 'type: ' || event_type || chr(10) || 'user.id: ' || user_id || chr(10) || 'user.tags: ["t' || (user_id % 7) || '","all"]' || chr(10)
  || 'props.k: ' || json_extract_string(props, '$.k') || chr(10) || 'note: ' || coalesce(json_extract_string(js, '$.note'), 'null') AS page_content FROM ev""")
def load_json_docs_objects(spark, d):
    rows = events(spark, d).select(F.col("event_id").alias("doc_id"), "js")
    return files.load_json_docs(rows, F.col("js"), separate_by_object=True).select("doc_id", "page_content")


@query("load_jsonl_docs", f"""WITH {EVENTS_JS}
SELECT event_id AS doc_id, event_type AS page_content, CAST(user_id AS VARCHAR) AS uid FROM ev""")
def load_jsonl_docs(spark, d):
    rows = events(spark, d).select(F.col("event_id").alias("doc_id"), "js")
    out = files.load_jsonl_docs(rows, F.col("js"), "/type", {"uid": "/user/id", "fixed": "no pointer"})
    return out.select("doc_id", "page_content", F.get_json_object("metadata", "$.uid").alias("uid"))


@query("load_text_docs", "SELECT text || chr(10) AS page_content FROM benchmark")
def load_text_docs(spark, d):
    """Benchmark items written as one file each, read back whole."""
    path = f"{scratch_folder(spark)}/text"
    table(spark, d, "benchmark").repartition("item_id").write.partitionBy("item_id").text(path)
    return files.load_text_docs(spark, f"{path}/*").select("page_content")


@query("load_folder", """
SELECT text || chr(10) AS page_content, 'txt' AS ending FROM benchmark
UNION ALL SELECT r_name, 'json' FROM region
UNION ALL SELECT 'p_partkey: ' || p_partkey || chr(10) || 'p_name: ' || p_name || chr(10) || 'p_brand: ' || p_brand, 'csv' FROM part""")
def load_folder(spark, d):
    """A folder tree with a text file per benchmark item, a JSON file per region, and CSV files."""
    folder = scratch_folder(spark)
    table(spark, d, "benchmark").repartition("item_id").write.partitionBy("item_id").text(f"{folder}/notes")
    table(spark, d, "region").write.partitionBy("r_regionkey").json(f"{folder}/deep/er/regions")
    table(spark, d, "part").select("p_partkey", "p_name", "p_brand").write.csv(f"{folder}/deep/parts", header=True)
    return files.load_folder(spark, folder).select("page_content", F.regexp_extract("doc_id", r"\.(\w+)(:\d+)?$", 1).alias("ending"))


@query("load_sheet_docs", """
SELECT 'suppliers:' || row_number() OVER (ORDER BY s_suppkey) AS doc_id,
  '- s_suppkey: ' || s_suppkey || chr(10) || '- s_name: ' || s_name || chr(10) || CASE WHEN s_nationkey > 5 THEN '- s_nationkey: ' || s_nationkey || chr(10) ELSE '' END AS page_content,
  CAST(row_number() OVER (ORDER BY s_suppkey) AS VARCHAR) AS row_num
FROM supplier""")
def load_sheet_docs(spark, d):
    rows = table(spark, d, "supplier").select(
        "s_suppkey", "s_name", F.when(F.col("s_nationkey") > 5, F.col("s_nationkey")).alias("s_nationkey"))
    out = files.load_sheet_docs(rows, "suppliers", ["s_suppkey"])
    return out.select("doc_id", "page_content", F.get_json_object("metadata", "$.rowNum").alias("row_num"))


def _markdown_sql(rows: str, group: str, head: str, extra: int, bound: int) -> str:
    """Markdown of `rows` (grp, pos, line), cut where the characters before a line pass the bound."""
    return f"""
WITH x AS ({rows}), n AS (
  SELECT *, CAST(sum(length(line) + 1) OVER (PARTITION BY grp ORDER BY pos) - length(line) - 1 AS BIGINT) // {bound} AS part, count(*) OVER (PARTITION BY grp) AS c FROM x)
SELECT {group} part, count(*) OVER (PARTITION BY grp) AS n_parts, CASE WHEN part = 0 THEN '{head}' || chr(10) || '| --- | --- |' || chr(10) ELSE '' END
  || string_agg(line, chr(10) ORDER BY pos) || chr(10) AS page_content, min(c) + {extra} AS row_count, 2 AS column_count, min(c) AS total_data_rows FROM n GROUP BY grp, part"""


@query("table_to_markdown", _markdown_sql(
    "SELECT c_nationkey AS grp, c_custkey AS pos, '| ' || c_custkey || ' | ' || c_name || ' |' AS line FROM customer",
    "grp AS c_nationkey,", "| c_custkey | c_name |", 1, 400))
def table_to_markdown(spark, d):
    """The customers of every nation as a table, a few lines a part."""
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name")
    return files.table_to_markdown(rows, ["c_custkey"], group_by=["c_nationkey"], part_chars=400)


@query("table_to_markdown_parts", _markdown_sql(
    "SELECT 0 AS grp, p_partkey AS pos, '| ' || p_partkey || ' | ' || p_name || ' |' AS line FROM part", "", "| A | B |", 0, 5000))
def table_to_markdown_parts(spark, d):
    return files.table_to_markdown(
        table(spark, d, "part").select("p_partkey", "p_name"), ["p_partkey"], include_headers=False, part_chars=5000)


@query("rows_to_json_docs", """
SELECT 'https://crm.example.com/' || c_custkey AS doc_id, '{' || chr(10) || '  "c_custkey": ' || c_custkey || ',' || chr(10) || '  "c_name": "' || c_name || '",' || chr(10)
  || '  "c_mktsegment": "' || c_mktsegment || '"' || chr(10) || '}' AS page_content FROM customer WHERE c_acctbal > 0""")
def rows_to_json_docs(spark, d):
    return files.rows_to_json_docs(
        table(spark, d, "customer"), F.concat(F.lit("https://crm.example.com/"), "c_custkey"),
        ["c_custkey", "c_name", "c_mktsegment"], where=F.col("c_acctbal") > 0,
    ).select("doc_id", "page_content")


@query("load_chunks", f"""WITH {FIXED}
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, page_content, json_extract_string(metadata, '$.lang') AS lang FROM chunks WHERE doc_id % 3 = 2""")
def load_chunks(spark, d):
    return files.load_chunks(stored(spark, d), "store2").select(
        "doc_id", "chunk_no", "page_content", F.get_json_object("metadata", "$.lang").alias("lang"))


# pages of one form: anchors with quoted references, paragraphs that end at the next block
CLEAN = "regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g')"
SITE = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
HREFS = f"regexp_extract_all({CLEAN}, '<a href=\"([^\"]*)\"', 1)"


def _unescape_sql(text: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


_BLOCK_SQL = "(?i)</?(address|article|aside|blockquote|div|dl|fieldset|footer|form|h[1-6]|header|hr|main|nav|ol|p|pre|section|table|ul)( [^>]*)?>"


@query("extract_page", f"""WITH p AS (SELECT page_id, url, html, {CLEAN} AS body FROM pages),
t AS (SELECT *, list_transform(string_split_regex(body, '(?i)<p( [^>]*)?>')[2:],
  lambda x : {_unescape_sql(f"regexp_replace(string_split_regex(x, '{_BLOCK_SQL}')[1], '<[^>]*>', '', 'g')")}) AS texts FROM p)
SELECT page_id, url, trim({_unescape_sql("regexp_extract(body, '(?is)<title>(.*?)</title', 1)")}) AS title, 'No description found' AS description,
  trim(regexp_replace(array_to_string(list_transform(list_filter(texts, lambda x : x <> ''), lambda x : trim(x)), ' '), '\\s\\s+', ' ', 'g')) AS body_text,
  CAST(len(list_distinct(list_filter({HREFS}, lambda h : h LIKE '/%'))) AS INTEGER) AS links FROM t""")
def extract_page(spark, d):
    return web.extract_page(spread(table(spark, d, "pages"))).withColumn("links", F.size("links"))


@query("extract_links", f"""
SELECT url AS src, {SITE} || h AS dst, CAST(i - 1 AS INTEGER) AS pos FROM (
  SELECT url, unnest({HREFS}) AS h, generate_subscripts({HREFS}, 1) AS i FROM pages)""")
def extract_links(spark, d):
    return web.extract_links(spread(table(spark, d, "pages")))


@query("extract_links_relative")
def extract_links_relative(spark, d):
    return web.extract_links(spread(table(spark, d, "pages")), relative_only=True, limit=5)


@query("extract_links_relative_all", f"""
SELECT url AS src, greatest(1, least(len({HREFS}), 1 + len(list_distinct(list_filter({HREFS}, lambda h : {SITE} || h <> url))))) AS links FROM pages""")
def extract_links_relative_all(spark, d):
    found = web.extract_links(spread(table(spark, d, "pages")), relative_only=True, limit=None)
    return found.select("src", "dst").distinct().groupBy("src").agg(F.count(F.lit(1)).alias("links"))


_URL = "'^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#:]*)(:[0-9]*)?([^?#]*)([?][^#]*)?'"


@query("normalize_url", f"""
SELECT page_id, regexp_replace(lower(regexp_extract(url, {_URL}, 2)) || regexp_extract(url, {_URL}, 3)
  || CASE WHEN regexp_extract(url, {_URL}, 4) = '' THEN '/' ELSE regexp_extract(url, {_URL}, 4) END || regexp_extract(url, {_URL}, 5), '/$', '') AS url FROM pages""")
def normal_urls(spark, d):
    return table(spark, d, "pages").select("page_id", normalize_url(F.col("url")).alias("url"))


def page_edges(spark, d):
    """Links between all pages, without fragments."""
    links = web.extract_links(spread(table(spark, d, "pages")))
    return links.select(*[F.regexp_replace(c, "#.*$", "").alias(c) for c in ("src", "dst")])


@query("crawl_closure")
def crawl_closure(spark, d):
    """From the first page of every host, as deep as the links lead."""
    pages = table(spark, d, "pages").select(F.regexp_replace("url", "#.*$", "").alias("url"))
    seeds = pages.groupBy(host_of(F.col("url"))).agg(F.min("url").alias("url")).select("url")
    return web.crawl_closure(page_edges(spark, d), seeds)


@query("crawl_orders", """
WITH RECURSIVE e AS (SELECT DISTINCT s_nationkey AS a, (s_nationkey * 3 + s_suppkey) % 25 AS b FROM supplier),
r(n, lvl) AS (SELECT 0, 0 UNION SELECT CAST(b AS INTEGER), lvl + 1 FROM r JOIN e ON a = n WHERE lvl < 25)
SELECT 'http://site.example.com/n' || n || '/' AS url, CAST(min(lvl) AS INTEGER) AS level FROM r GROUP BY n""")
def crawl_orders(spark, d):
    """A link graph over the nations drawn from the suppliers, from nation 0; each page under several addresses."""
    def site(c):
        return F.concat(F.lit("https://site.example.com/n"), c)

    s = table(spark, d, "supplier")
    edges = s.select(site(F.col("s_nationkey")).alias("src"), site((F.col("s_nationkey") * 3 + F.col("s_suppkey")) % 25).alias("dst"))
    plain = F.concat(F.regexp_replace("dst", "^https", "http"), F.lit("/"))
    slashed = F.concat("src", F.lit("/#top"))
    edges = edges.unionByName(edges.withColumn("dst", plain)).unionByName(edges.select(slashed.alias("src"), "dst"))
    away = s.select(site(F.col("s_nationkey")).alias("src"), F.concat(F.lit("https://other.example.com/n"), "s_suppkey").alias("dst"))
    seeds = table(spark, d, "nation").where("n_nationkey = 0").select(F.concat(F.lit("http://site.example.com/n"), "n_nationkey", F.lit("/")).alias("url"))
    return web.crawl_closure(edges.unionByName(away), seeds)


@query("parse_sitemap_all", """
SELECT page_id, CAST(0 AS INTEGER) AS pos, url AS loc FROM pages UNION ALL
SELECT page_id, 1, 'https://x.example.com/?a=1&b=' || page_id FROM pages UNION ALL
SELECT page_id, 2, 'https://y.example.com/' FROM pages""")
def parse_sitemap_all(spark, d):
    return web.parse_sitemap(sitemaps(spark, d), F.col("xml")).select("page_id", "pos", "loc")


@query("parse_sitemap", """
SELECT page_id, CAST(0 AS INTEGER) AS pos, url AS loc FROM pages UNION ALL
SELECT page_id, 1, 'https://x.example.com/?a=1&b=' || page_id FROM pages""")
def parse_sitemap(spark, d):
    """The first two entries of every sitemap."""
    return web.parse_sitemap(sitemaps(spark, d), F.col("xml"), 2).select("page_id", "pos", "loc")


def sitemaps(spark, d):
    """A sitemap per page with its own address, an entry without one, and two more."""
    xml = F.concat(
        F.lit('<?xml version="1.0"?><urlset><url><loc>'), F.replace("url", F.lit("&"), F.lit("&amp;")),
        F.lit("</loc><lastmod>2024</lastmod></url><url><lastmod>2024</lastmod></url>\n<url>\n<loc>https://x.example.com/?a=1&amp;b="),
        F.col("page_id"), F.lit("</loc></url><url><loc>https://y.example.com/</loc></url></urlset>"))
    return table(spark, d, "pages").withColumn("xml", xml)


@query("read_hourly_logs", """
SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05 22:00:00' AND ts < TIMESTAMP '2024-01-08 04:00:00'""")
def read_hourly_logs(spark, d):
    return files.read_hourly_logs(table(spark, d, "events"), F.col("ts"), "2024-01-05-22", "2024-01-08-03").select("event_id", "event_type")


@query("import_remap_ids", """
WITH p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'),
c AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS parent_id FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM p)),
s AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_returnflag = 'R')
SELECT CAST(id AS VARCHAR) AS old_id, parent_id, CASE WHEN id IN (SELECT id FROM s) THEN sha256(id || 'salt') ELSE CAST(id AS VARCHAR) END AS id FROM c""")
def import_remap_ids(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    line_id = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    return files.import_remap_ids(
        lines.select(line_id, F.col("l_orderkey").alias("parent_id")).distinct(),
        orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")),
        orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id")),
        lines.where("l_returnflag = 'R'").select(line_id), "salt")
