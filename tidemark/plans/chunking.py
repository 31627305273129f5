"""Registered queries: splitting documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import chunking as C
from tidemark.plans.inputs import DOCS, docs, table
from tidemark.plans.registry import query
from tidemark.session import spread

FIXED = DOCS + """, body AS (
  SELECT doc_id, metadata, regexp_replace(page_content, '^\\s+|\\s+$', '', 'g') AS t FROM docs),
chunks AS (
  SELECT doc_id, i + 1 AS chunk_no, substr(t, CAST(i * 1080 + 1 AS BIGINT), 1200) AS page_content, metadata
  FROM (SELECT doc_id, metadata, t,
               unnest(range(CAST(greatest(1, ceil((length(t) - 120) / 1080.0)) AS BIGINT))) AS i
        FROM body WHERE t <> ''))"""


def fixed(spark, d):
    return C.chunk_fixed(docs(spark, d))


@query("chunk_fixed", f"WITH {FIXED} SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, page_content, metadata FROM chunks")
def chunk_fixed(spark, d):
    return fixed(spark, d)


_STRIP = f"trim({{}}, '{text.WHITE_SPACE}')"


def _packed_sql(name: str, groups: str, joiner: str, size: int, overlap: int) -> str:
    """CTE `name` (doc_id, path, chunk): the pieces of `groups` (doc_id, path, pieces) packed, one chunk a round."""
    gap = len(joiner)
    # s[j + 1] is where piece j starts; a range lo <= j < hi is s[hi + 1] - s[lo + 1] - gap long
    full = f"list_filter(range({{lo}} + 1, n), lambda i: s[i + 2] - s[{{lo}} + 1] - {gap} > {size})[1]"
    kept = f"list_filter(range(lo, hi), lambda j: s[hi + 1] - s[j + 1] - {gap} <= {overlap} AND s[hi + 2] - s[j + 1] - {gap} <= {size})[1]"
    chunk = _STRIP.format(f"array_to_string(pieces[lo + 1 : hi], '{joiner}')")
    return f"""{name}_g AS MATERIALIZED (SELECT *, len(pieces) AS n, list_transform(range(0, len(pieces) + 1),
  lambda j: coalesce(list_sum(list_transform(pieces[1 : j], lambda p: length(p) + {gap})), 0)) AS s FROM ({groups})),
{name}_r AS (
  SELECT doc_id, path, 0::BIGINT AS round, 0::BIGINT AS lo, coalesce({full.format(lo=0)}, n) AS hi FROM {name}_g WHERE n > 0
  UNION ALL
  SELECT doc_id, path, round, lo, coalesce({full.format(lo='lo')}, n) AS hi FROM (
    SELECT r.doc_id, r.path, r.round + 1 AS round, coalesce({kept}, hi) AS lo, g.s, g.n
    FROM {name}_r r JOIN {name}_g g ON g.doc_id = r.doc_id AND g.path = r.path WHERE r.hi < g.n)),
{name} AS MATERIALIZED (SELECT doc_id, list_append(path, round) AS path, {chunk} AS chunk FROM {name}_r JOIN {name}_g USING (doc_id, path))"""


def _numbered_sql(ctes: list[str], chunks: str) -> str:
    return f"""WITH RECURSIVE {", ".join(ctes)}
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY path) AS INTEGER) AS chunk_no, chunk AS page_content, metadata
FROM ({chunks}) JOIN docs USING (doc_id) WHERE chunk <> ''"""


def separator_sql(docs_sql: str, separator: str, size: int, overlap: int) -> str:
    pieces = f"list_filter(string_split(page_content, '{separator}'), lambda p: p <> '')"
    groups = f"SELECT doc_id, [0::BIGINT] AS path, {pieces} AS pieces FROM docs"
    return _numbered_sql([docs_sql, _packed_sql("packed", groups, separator, size, overlap)], "FROM packed")


def recursive_sql(docs_sql: str, separators: list[str], size: int, overlap: int) -> str:
    """A level per separator; pieces between two large ones are packed, large ones go on.  The last separator is empty."""
    ctes = [docs_sql, "t0 AS (SELECT doc_id, []::BIGINT[] AS path, page_content AS t FROM docs)"]
    done = []
    for k, separator in enumerate(separators[:-1]):
        ctes += [
            f"""p{k} AS MATERIALIZED (SELECT *, length(piece) > {size} AS big FROM (
  SELECT doc_id, path, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM (
    SELECT doc_id, path, list_transform(string_split(t, '{separator}'), lambda p, i: CASE WHEN i = 1 THEN p ELSE '{separator}' || p END) AS pieces
    FROM t{k})) WHERE piece <> '')""",
            f"""m{k} AS MATERIALIZED (SELECT *, count(*) FILTER (WHERE big) OVER (
  PARTITION BY doc_id, path ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p{k})""",
            _packed_sql(f"c{k}", "SELECT doc_id, list_append(path, 2 * before) AS path, list(piece ORDER BY i) AS pieces"
                        f" FROM m{k} WHERE NOT big GROUP BY m{k}.doc_id, m{k}.path, before", "", size, overlap),
            f"t{k + 1} AS MATERIALIZED (SELECT doc_id, list_append(path, 2 * before + 1) AS path, piece AS t FROM m{k} WHERE big)",
        ]
        done.append(f"FROM c{k}")
    step = max(1, size - overlap)
    window = _STRIP.format(f"substr(t, j * {step} + 1, {size})")
    done.append(f"""SELECT doc_id, list_append(path, j) AS path, {window} AS chunk FROM (
  SELECT *, unnest(range(CAST(greatest(0, ceil((length(t) - {size}) / {step})) AS BIGINT) + 1)) AS j FROM t{len(separators) - 1})""")
    return _numbered_sql(ctes, " UNION ALL ".join(done))


@query("chunk_by_separator", separator_sql(DOCS, "\n", 1000, 200))
def chunk_by_separator(spark, d):
    return C.chunk_by_separator(docs(spark, d), "\n")


@query("chunk_recursive", recursive_sql(DOCS, text.PLAIN, 1000, 200))
def chunk_recursive(spark, d):
    return C.chunk_recursive(docs(spark, d))


_CODE = DOCS.replace("docs AS (", "plain AS (", 1) + """, docs AS (SELECT * REPLACE (
  'class Doc' || doc_id || ':\n\tdef first(self):\n\t\treturn ''' || replace(page_content, '. ', '''\n\n\tdef more(self):\n\t\treturn ''') || '''' AS page_content)
  FROM plain)"""


@query("chunk_code", recursive_sql(_CODE, text.SEPARATORS["python"], 1000, 200))
def chunk_code(spark, d):
    """Each document framed as a class with one method per sentence."""
    code = F.concat(
        F.lit("class Doc"), F.col("doc_id"), F.lit(":\n\tdef first(self):\n\t\treturn '"),
        F.regexp_replace("page_content", r"\. ", "'\n\n\tdef more(self):\n\t\treturn '"), F.lit("'"),
    )
    return C.chunk_code(docs(spark, d).withColumn("page_content", code), "python")


@query("chunk_markdown_headers", f"""
WITH {DOCS}, md AS (
  SELECT doc_id, metadata, replace(replace(page_content, '. ', chr(10) || '## '), ', ', chr(10) || '### ') AS t FROM docs),
marked AS (
  SELECT doc_id, metadata, regexp_replace(t, '\\n(#{{1,2}}[^\\S\\n])', chr(1) || '\\1', 'g') AS t FROM md),
parts AS (SELECT doc_id, metadata, string_split(t, chr(1)) AS p FROM marked)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, regexp_replace(p[i], '^\\s+|\\s+$', '', 'g') AS page_content, metadata
FROM (SELECT doc_id, metadata, p, unnest(range(1, len(p) + 1)) AS i FROM parts)""")
def chunk_markdown_headers(spark, d):
    body = F.replace(F.replace("page_content", F.lit(". "), F.lit("\n## ")), F.lit(", "), F.lit("\n### "))
    return C.chunk_markdown_headers(docs(spark, d).withColumn("page_content", body), "h2")


@query("chunk_html_as_markdown")
def chunk_html_as_markdown(spark, d):
    pages = spread(table(spark, d, "pages")).select(
        F.col("page_id").alias("doc_id"), "html", F.to_json(F.struct("url")).alias("metadata"))
    return C.chunk_html_as_markdown(pages)


@query("chunk_tokens", f"""
WITH {DOCS}, toks AS (
  SELECT doc_id, metadata, regexp_extract_all(page_content, '\\S+\\s*') AS t FROM docs)
SELECT doc_id, CAST(i + 1 AS INTEGER) AS chunk_no, array_to_string(t[i * 160 + 1 : i * 160 + 200], '') AS page_content, metadata
FROM (SELECT doc_id, metadata, t, unnest(range(CAST(greatest(1, ceil((len(t) - 40) / 160.0)) AS BIGINT))) AS i
      FROM toks WHERE len(t) > 0)""")
def chunk_tokens(spark, d):
    return C.chunk_tokens(docs(spark, d), 200, 40)


@query("preview_chunks", f"""
WITH {FIXED} SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, page_content, metadata,
  (SELECT count(*) FROM chunks) AS total
FROM chunks ORDER BY doc_id, chunk_no LIMIT 20""")
def preview_chunks(spark, d):
    return C.preview_chunks(fixed(spark, d), 20)


@query("chunk_id", f"""
WITH {FIXED} SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no,
  substr(sha256('doc' || doc_id || ':' || chunk_no || ':' || substr(page_content, 1, 120)), 1, 32) AS id
FROM chunks""")
def chunk_id(spark, d):
    name = F.concat(F.lit("doc"), "doc_id")
    return fixed(spark, d).select(
        "doc_id", "chunk_no", C.chunk_id(name, F.col("chunk_no"), F.col("page_content")).alias("id"))


STORE = "'store' || (doc_id % 3)"


def stored(spark, d):
    return fixed(spark, d).withColumn("store_id", F.concat(F.lit("store"), F.col("doc_id") % 3))


def store_inputs(spark, d):
    """Old chunks of all but the German documents, new ones of the English, cut smaller."""
    old = stored(spark, d).where("get_json_object(metadata, '$.lang') <> 'de'")
    new = (
        C.chunk_fixed(docs(spark, d).where("lang = 'en'"), 600, 60)
        .withColumn("store_id", F.concat(F.lit("store"), F.col("doc_id") % 3))
    )
    loaders = table(spark, d, "documents").select(
        F.concat(F.lit("store"), F.col("doc_id") % 3).alias("store_id"),
        F.col("doc_id").alias("loader_id"),
        F.when((F.col("doc_id") % 3 == 1) & (F.col("doc_id") % 10 == 1), "STALE").otherwise("SYNC").alias("status"),
    )
    return C.store_chunks(old, new, loaders)


SMALL = """small AS (
  SELECT doc_id, i + 1 AS chunk_no, substr(t, CAST(i * 540 + 1 AS BIGINT), 600) AS page_content, metadata
  FROM (SELECT doc_id, metadata, t, unnest(range(CAST(greatest(1, ceil((length(t) - 60) / 540.0)) AS BIGINT))) AS i
        FROM body WHERE t <> '' AND json_extract_string(metadata, '$.lang') = 'en')),
kept AS (
  SELECT * FROM chunks WHERE json_extract_string(metadata, '$.lang') NOT IN ('de', 'en')
  UNION ALL SELECT * FROM small)"""


@query("store_chunks", f"""
WITH {FIXED}, {SMALL}
SELECT {STORE} AS store_id, doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, page_content FROM kept""")
def store_chunks(spark, d):
    return store_inputs(spark, d)[0].select("store_id", "doc_id", "chunk_no", "page_content")


@query("store_totals", f"""
WITH {FIXED}, {SMALL}
SELECT {STORE} AS store_id, CASE WHEN {STORE} = 'store1' THEN 'STALE' ELSE 'SYNC' END AS status,
  count(*) AS total_chunks, CAST(sum(length(page_content)) AS BIGINT) AS total_chars
FROM kept GROUP BY 1, 2""")
def store_totals(spark, d):
    return store_inputs(spark, d)[1]


@query("page_chunks", f"""
WITH {FIXED}, chosen AS (SELECT {STORE} AS store_id, * FROM chunks WHERE doc_id % 3 = 1)
SELECT store_id, doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, page_content,
  (SELECT count(*) FROM chosen) AS total,
  (SELECT CAST(sum(length(page_content)) AS BIGINT) FROM chosen) AS characters
FROM chosen ORDER BY chunk_no, doc_id LIMIT 50 OFFSET 50""")
def page_chunks(spark, d):
    return C.page_chunks(stored(spark, d), "store1", page=2).drop("metadata")


@query("knowledge_digest", f"""
WITH {FIXED}, joined AS (
  SELECT source, string_agg(regexp_replace(page_content, '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10) || '---' || chr(10) || chr(10)
         ORDER BY doc_id) AS t
  FROM docs WHERE regexp_replace(page_content, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY source)
SELECT source, CASE WHEN length(t) <= 1400 THEN t ELSE regexp_replace(substr(t, 1, 1397), '\\s+$', '') || '...' END AS digest
FROM joined""")
def knowledge_digest(spark, d):
    return C.knowledge_digest(docs(spark, d), ["source"])
