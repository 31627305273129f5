"""The registered queries of this folder, each over its whole tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, credentials, decontaminate, hardnegatives, language, licenses, linechunks, neighbours, packing, pii, quality,
    simhash, urlfilter,
)
from tidemark.llm.tables import table
from tidemark.session import configure


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out as files: a folder per source, one per thousand ids in it, one per hundred in that.

    Every hundredth document of a thousand is the licence file of its folder.
    """
    number = F.col("doc_id")
    outer = F.concat_ws("/", "source", F.floor(number / 1000).cast("string"))
    inner = F.concat_ws("/", outer, F.floor(number / 100).cast("string"))
    path = F.when(number % 100 == 7, F.concat_ws("/", outer, F.concat(F.lit("LICENSE-"), number.cast("string")))).otherwise(
        F.concat_ws("/", inner, F.concat(number.cast("string"), F.lit(".txt")))
    )
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linechunks.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", F.col("kept_text").alias("text"), "n_lines", "n_removed")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.tokenizer_path())


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.span_digest(pii.find_personal_data(table(spark, sf_dir, "documents")), pii.BASE)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.learned(docs, table(spark, sf_dir, "labels")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learned(docs))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.span_digest(credentials.find_secrets(table(spark, sf_dir, "documents")), ("assign", "access", "hex"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(
        table(spark, sf_dir, "documents"), packing.tokenizer_path(), packing.tokenizer_path("piece_bpe_32k.model"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh id has its label moved on by one, so that nearest rows are not all of one label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), urlfilter.train(urlfilter.labelled_urls(spark)))


_ALL = (
    op1_decontaminate, op2_simhash, op3_licenses, op4_neighbours, op5_line_dedup, op6_packing, op7_pii, op8_quality,
    op9_language, op10_secrets, op11_alignment, op12_hard_negatives, op13_url_filter,
)


def _configured(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(configure(spark), sf_dir)


QUERIES = {fn.__name__: _configured(fn) for fn in _ALL}


def _grams_sql(rows: str) -> str:
    """(row, bucket) of every n-gram of the hosts and paths of `rows` (id, host, path)."""
    parts = [
        f"SELECT id, unnest(list_transform(range(1, length(t) - {n - 2}), lambda i: '{mark}' || substr(t, i, {n}))) AS g"
        f" FROM (SELECT id, '^' || {column} || '$' AS t FROM {rows})"
        for column, mark in (("host", "h"), ("path", "p")) for n in urlfilter.LENGTHS
    ]
    return (f"SELECT id, CAST('0x' || substr(md5(g), 1, 7) AS BIGINT) % {urlfilter.BUCKETS} + 1 AS k, count(*) AS n"
            f" FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL")


def _url_filter_sql() -> str:
    """The rules as one CASE; the rounds of training one after the other, then the score of every page."""
    cut = ("SELECT *, lower_az AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM ("
           "SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM ("
           "SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM ("
           "SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM {})))")
    known = ", ".join(f"('{u}', {y})" for urls, y in ((urlfilter.BLOCKED, 1.0), (urlfilter.ALLOWED, 0.0)) for u in urls)
    steps = [
        f"known AS MATERIALIZED (SELECT row_number() OVER () AS id, y, host, path FROM ({cut.format(f'(VALUES {known}) AS t(url, y)')}))",
        f"seen AS MATERIALIZED ({_grams_sql('known')})",
        "size AS MATERIALIZED (SELECT id, sqrt(sum(n)) AS root FROM seen GROUP BY id)",
        "w0 AS MATERIALIZED (SELECT DISTINCT k, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM seen UNION ALL SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE)",
    ]
    for i in range(urlfilter.ROUNDS):
        steps += [
            f"m{i} AS MATERIALIZED (SELECT k.id, any_value(size.root) AS root, 1 / (1 + exp(-(any_value(b.w) + sum(s.n * w.w) / any_value(size.root))))"
            f" - any_value(k.y) AS miss FROM known k JOIN seen s ON s.id = k.id JOIN size ON size.id = k.id JOIN w{i} w ON w.k = s.k"
            f" CROSS JOIN (SELECT w FROM w{i} WHERE k = 0) b GROUP BY k.id)",
            f"w{i + 1} AS MATERIALIZED (SELECT k, w + v AS w, v FROM (SELECT w.k, w.w, {urlfilter.MOMENTUM} * w.v - {urlfilter.RATE} * ("
            f"g.g / (SELECT count(*) FROM known) + CASE WHEN w.k = 0 THEN 0 ELSE {urlfilter.DECAY} * w.w END) AS v"
            f" FROM w{i} w JOIN (SELECT s.k, sum(s.n * m.miss / m.root) AS g FROM seen s JOIN m{i} m ON m.id = s.id GROUP BY s.k"
            f" UNION ALL SELECT 0, sum(miss) FROM m{i}) g ON g.k = w.k))",
        ]
    fits = "WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{v}'"
    longest = sorted(urlfilter.RULES, key=lambda r: -len(r[1]) - len(r[2]))
    rule, verdict = (
        "CASE " + " ".join(fits.format(h=h, p=p, v=(h + p, v)[k]) for v, h, p in longest) + " END" for k in (0, 1))
    return f"""
WITH {", ".join(steps)},
cut AS MATERIALIZED (SELECT row_number() OVER () AS id, page_id, host, path FROM ({cut.format("pages")})),
shown AS ({_grams_sql("cut")}),
sums AS (SELECT shown.id, sqrt(sum(shown.n)) AS root, sum(shown.n * coalesce(w.w, 0)) AS total
  FROM shown LEFT JOIN w{urlfilter.ROUNDS} w ON w.k = shown.k GROUP BY shown.id),
scored AS (SELECT cut.*, round(1 / (1 + exp(-((SELECT w FROM w{urlfilter.ROUNDS} WHERE k = 0) + coalesce(total / root, 0)))), 6) AS score
  FROM cut LEFT JOIN sums ON sums.id = cut.id)
SELECT page_id, host, path, {rule} AS rule, score,
  coalesce({verdict}, CASE WHEN score >= {urlfilter.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict FROM scored
"""


_HARD_NEGATIVES_SQL = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 5
"""

#: chunk of each line by a running sum of the cuts before it; first occurrence by doc_id and position
ORACLES = {"op12_hard_negatives": _HARD_NEGATIVES_SQL, "op13_url_filter": _url_filter_sql(), "op5_line_dedup": """
WITH lines AS (
  SELECT doc_id, i, line, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM (
    SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
chosen AS (
  SELECT *, coalesce((lag(h) OVER w * 1000003 + h) % 4 = 0, false) AS ends, count(*) OVER (PARTITION BY doc_id) AS n
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
cuts AS (
  SELECT * EXCLUDE (n), CASE WHEN ends AND NOT coalesce(lag(ends) OVER w, false) AND i < n - 2 THEN 1 ELSE 0 END AS cut
  FROM chosen WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM cuts),
chunks AS (
  SELECT doc_id, c, min(i) AS pos, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body
  FROM numbered GROUP BY doc_id, c),
marked AS (
  SELECT *, n >= 2 AND row_number() OVER (PARTITION BY body ORDER BY doc_id, pos) > 1 AS gone FROM chunks),
kept AS (
  SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
         CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN n ELSE 0 END) AS BIGINT) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""}
