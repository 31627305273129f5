"""Pages, links, sitemaps and the closure of a link graph.  Pages: url, html."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import html as markup
from tidemark.functions.text import let
from tidemark.functions.urls import host_of, normalize_url
from tidemark.session import settle


def extract_page(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Title, description, paragraph text and the unique absolute links of every page."""
    source = F.coalesce(F.col(html), F.lit(""))
    shown = F.filter(markup.links(F.col(url), source), lambda x: x.startswith("http") & ~x.contains("#"))
    rest = [c for c in pages.columns if c != html]
    return pages.select(
        *rest, markup.title(source).alias("title"), markup.description(source).alias("description"),
        markup.body_text(source).alias("body_text"), F.array_distinct(shown).alias("links"))


def extract_links(
    pages: DataFrame, relative_only: bool = False, limit: int | None = 10, url: str = "url", html: str = "html"
) -> DataFrame:
    """Links (src, dst, pos) resolved against the page, invalid ones skipped.

    With `relative_only`: the page itself and the unique links that start with a slash, looking at the
    first `limit + 1` of them, or at all without a limit.
    """
    base, source = F.col(url), F.coalesce(F.col(html), F.lit(""))
    if relative_only:
        anchors = F.filter(markup.hrefs(source), lambda h: h.startswith("/"))

        def chosen(found: Column) -> Column:
            looked = found if limit is None else F.slice(found, 1, limit + 1)
            valid = F.filter(F.transform(looked, lambda h: markup.resolve(base, h)), lambda x: x.isNotNull())
            unique = F.array_distinct(F.concat(F.array(base), valid))
            return F.slice(unique, 1, F.greatest(F.size(looked), F.lit(1)))

        found = let(anchors, chosen)
    else:
        found = markup.links(base, source)
    return pages.select(base.alias("src"), F.posexplode(found).alias("pos", "dst")).select("src", "dst", "pos")


def crawl_closure(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None, limit: int = 0) -> DataFrame:
    """Pages (url, level) reachable from the seeds over links (src, dst) within one host.

    Addresses that differ in scheme, fragment or a trailing slash are one page; it is listed under the
    first of them by name.  A level at a time: join the frontier, drop what is known, checkpoint.  A limit keeps
    the first pages by level and address, and no further level is walked once it is reached.
    """
    links = edges.where(host_of(F.col("src")) == host_of(F.col("dst"))).select("src", "dst")
    ends = links.select(F.col("src").alias("url")).unionByName(links.select(F.col("dst").alias("url")))
    names = settle(
        ends.unionByName(seeds.select("url")).groupBy(normalize_url(F.col("url")).alias("page")).agg(F.min("url").alias("url")))
    same_host = settle(
        links.select(normalize_url(F.col("src")).alias("src"), normalize_url(F.col("dst")).alias("dst")).distinct())
    frontier = settle(seeds.select(normalize_url(F.col("url")).alias("page")).distinct())
    visited = frontier.withColumn("level", F.lit(0))
    level, count = 0, frontier.count() if limit else 0
    while (max_depth is None or level < max_depth) and not (limit and count >= limit):
        level += 1
        reached = (
            same_host.join(frontier.withColumnRenamed("page", "src"), "src", "left_semi")
            .select(F.col("dst").alias("page")).distinct()
            .join(visited.select("page"), "page", "left_anti")
        )
        frontier = settle(reached)
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier.withColumn("level", F.lit(level)))
        count += frontier.count() if limit else 0
    found = visited.join(names, "page").select("url", "level")
    return found.orderBy("level", "url").limit(limit) if limit else found


_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def parse_sitemap(df: DataFrame, xml: Column, limit: int = 0) -> DataFrame:
    """Addresses (pos, loc) of the `<url>` entries in order; entries without one are skipped, 0 means all."""
    entries = F.regexp_extract_all(xml, F.lit(r"(?s)<url\b[^>]*>(.*?)</url>"), 1)
    locs = F.transform(entries, lambda e: F.regexp_extract(e, r"(?s)<loc\b[^>]*>(.*?)</loc>", 1))
    filled = F.filter(locs, lambda x: x != "")

    def decoded(text: Column) -> Column:
        for entity, char in _ENTITIES:
            text = F.replace(text, F.lit(entity), F.lit(char))
        return text

    plain = F.transform(filled, decoded)
    chosen = F.slice(plain, 1, limit) if limit else plain
    return df.select("*", F.posexplode(chosen).alias("pos", "loc"))
