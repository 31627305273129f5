"""HTML as column expressions: tags, attributes, entities, links, page facts and Markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import let

_BLOCKS = (
    "address|article|aside|blockquote|div|dl|fieldset|footer|form|h[1-6]|header|hr|main|nav|ol|p|pre|section|table|ul"
)
_ENTITIES = (
    ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", " "), ("copy", "©"), ("reg", "®"),
    ("middot", "·"), ("hellip", "…"), ("ndash", "–"), ("mdash", "—"), ("laquo", "«"), ("raquo", "»"),
    ("euro", "€"), ("amp", "&"),
)


def _character(code: Column) -> Column:
    """The character of a number below 65,536, else the replacement character."""
    hexed = F.lpad(F.hex(code), 4, "0")
    return F.when((code > 0) & (code < 65536), F.decode(F.unhex(hexed), "UTF-16BE")).when(code.isNotNull(), F.lit("\ufffd"))


def _numbered(text: Column, pattern: str, base: int) -> Column:
    codes = F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), 1)

    def joined(found: Column) -> Column:
        between = F.split(text, f"(?i){pattern}", -1)
        pieces = F.transform(between, lambda piece, i: F.concat(piece, F.coalesce(
            let(F.conv(F.get(found, i), base, 10).cast("bigint"), _character), F.lit(""))))
        return F.array_join(pieces, "")

    return F.when(F.contains(text, F.lit("&#")), let(codes, joined)).otherwise(text)


def unescape(text: Column) -> Column:
    """Numbered and the common named entities as characters."""
    def plain(escaped: Column) -> Column:
        out = let(_numbered(escaped, r"&#(\d{1,7});", 10), lambda tens: _numbered(tens, r"&#x([0-9a-f]{1,6});", 16))
        for name, char in _ENTITIES:
            out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
        return F.when(F.contains(escaped, F.lit("&")), out).otherwise(escaped)

    return let(text, plain)  # the text may be a long chain of its own


def without_code(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, empty where it has none."""
    pattern = rf"""(?is)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    return unescape(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)]))


def hrefs(html: Column) -> Column:
    """The `href` of every anchor in order."""
    anchors = F.regexp_extract_all(without_code(html), F.lit(r"(?is)<a\s[^>]*>"), 0)
    linked = F.filter(anchors, lambda a: a.rlike(r"(?is)[\s\"']href\s*="))
    return F.transform(linked, lambda a: attribute(a, "href"))


_ADDRESS = r"(?s)^([a-zA-Z][a-zA-Z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def _plain_path(path: Column) -> Column:
    """A path without `.` and `..` steps."""
    steps = F.split(path, "/", -1)
    last = F.element_at(steps, -1)
    kept = F.aggregate(
        F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(step == ".", done).otherwise(F.array_append(done, step)))
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.when(joined == "/", F.lit("")).otherwise(joined), tail)).otherwise(path)


def _normal(url: Column) -> Column:
    """Lower-case scheme and host, no default port, blanks escaped, at least a slash; null where it is no address."""
    part = lambda k: F.regexp_extract(url, _ADDRESS, k)
    scheme, authority, path = F.lower(part(1)), part(2), part(3)
    user = F.regexp_extract(authority, r"^(.*@)", 1)
    host = F.lower(F.regexp_extract(authority, r"^(?:.*@)?([^:]*|\[[^\]]*\])(?::[^:]*)?$", 1))
    port = F.regexp_extract(authority, r":([^:\]]*)$", 1)
    web = scheme.isin("http", "https")
    usual = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    shown = F.concat(user, host, F.when(usual, F.lit("")).otherwise(F.concat(F.lit(":"), port)))
    rest = F.concat(F.when(path == "", F.lit("/")).otherwise(path), part(4), part(5))
    whole = F.concat(scheme, F.lit("://"), shown, F.replace(rest, F.lit(" "), F.lit("%20")))
    valid = (host != "") & port.rlike(r"^\d{0,5}$")
    return F.when(scheme == "", F.lit(None).cast("string")).when(web, F.when(valid, whole)).otherwise(url)


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link on a page, null when it is not a valid address."""
    link = F.trim(F.regexp_replace(href, r"[\t\n\r]", ""))
    part = lambda k: F.regexp_extract(base, _ADDRESS, k)
    site = F.concat(part(1), F.lit("://"), part(2))
    page_path = F.when(part(3) == "", F.lit("/")).otherwise(part(3))
    path, more = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(page_path, r"(?s)^(.*/)", 1)
    full = (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(part(1), F.lit(":"), link))
        .when(link == "", F.concat(site, page_path, part(4)))
        .when(link.startswith("#"), F.concat(site, page_path, part(4), link))
        .when(link.startswith("?"), F.concat(site, page_path, link))
        .when(link.startswith("/"), F.concat(site, _plain_path(path), more))
        .otherwise(F.concat(site, _plain_path(F.concat(folder, path)), more))
    )
    return let(full, _normal)


def links(base: Column, html: Column) -> Column:
    """The valid links of a page in order, resolved against it."""
    return F.filter(F.transform(hrefs(html), lambda h: resolve(base, h)), lambda x: x.isNotNull())


def _plain(fragment: Column) -> Column:
    return unescape(F.regexp_replace(fragment, r"(?s)<[^>]*>", ""))


def title(html: Column) -> Column:
    found = F.trim(_plain(F.regexp_extract(without_code(html), r"(?is)<title\b[^>]*>(.*?)</title", 1)))
    return F.when(html.rlike(r"(?is)<title\b[^>]*>"), found).otherwise(F.lit("No title found"))


def description(html: Column) -> Column:
    """The first meta description that is not empty: plain, og, twitter."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), 0)

    def named(key: str) -> Column:
        own = F.filter(tags, lambda t: F.when(attribute(t, "name") != "", attribute(t, "name")).otherwise(attribute(t, "property")) == key)
        return F.get(F.transform(F.slice(own, 1, 1), lambda t: attribute(t, "content")), F.lit(0))

    choices = [F.when(named(k) != "", F.trim(named(k))) for k in ("description", "og:description", "twitter:description")]
    return F.coalesce(*choices, F.lit("No description found"))


def paragraphs(html: Column) -> Column:
    """Texts of the paragraphs; a paragraph ends where any block starts or ends."""
    pattern = rf"(?is)<p(?:\s[^>]*)?>(.*?)(?=</?(?:{_BLOCKS})(?:\s[^>]*)?/?>|\z)"
    return F.transform(F.regexp_extract_all(without_code(html), F.lit(pattern), 1), _plain)


def body_text(html: Column) -> Column:
    texts = F.filter(paragraphs(html), lambda t: t != "")
    joined = F.array_join(F.transform(texts, lambda t: F.regexp_replace(t, r"(?U)^\s+|\s+$", "")), " ")
    return F.regexp_replace(F.regexp_replace(joined, r"(?U)\s\s+", " "), r"(?U)^\s+|\s+$", "")


_MARKDOWN = (
    (r"(?is)<(head|title|noscript|template)\b.*?</\1\s*>", ""), (r"\s+", " "),
    *((rf"(?i)<h{n}\b[^>]*>", "\n\n" + "#" * n + " ") for n in range(1, 7)),
    (r"(?i)<li\b[^>]*>\s*", "\n*   "), (r"(?i)</li\s*>\s*", ""), (r"(?i)<br\b[^>]*>", "  \n"), (r"(?i)<hr\b[^>]*>", "\n\n* * *\n\n"),
    (r"(?i)</?(?:strong|b)(?:\s[^>]*)?>", "**"), (r"(?i)</?(?:em|i)(?:\s[^>]*)?>", "_"), (r"(?i)</?code(?:\s[^>]*)?>", "`"),
    (r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>""", "[$2]($1)"),
    (r"""(?i)<img\s[^>]*?src\s*=\s*["']([^"']*)["'][^>]*>""", "![]($1)"),
    (r"(?i)</?(?:ul|ol)(?:\s[^>]*)?>", "\n"), (rf"(?i)</?(?:{_BLOCKS})(?:\s[^>]*)?/?>", "\n\n"), (r"<[^>]*>", ""),
    (r"[ \t]+\n", "\n"), (r"\n[ \t]+", "\n"), (r"\n{3,}", "\n\n"), (r"^\s+|\s+$", ""),
)


def to_markdown(html: Column) -> Column:
    """Headings, lists, links, emphasis and code as Markdown; white space of `pre` is collapsed like any other."""
    out = without_code(F.coalesce(html, F.lit("")))
    for pattern, written in _MARKDOWN:
        out = F.regexp_replace(out, pattern, written)
    return unescape(out)
