"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

Only column expressions and grouped sums are used.  A URL is cut into host and path; the n-grams of
both, marked with the part they come from, are hashed into BUCKETS weights.  Training is full-batch
gradient descent with momentum over a labelled table: a round is one grouped sum per bucket, so at
most BUCKETS + 1 numbers reach the driver, whatever the size of the table.  The weights are a literal
array, so scoring is a projection without any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.linechunks import _let
from tidemark.llm.tables import stored

BUCKETS = 4096
LENGTHS = (3, 4, 5)
ROUNDS = 30
RATE = 4.0
MOMENTUM = 0.9
DECAY = 0.0001
LIMIT = 0.5

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: the labelled table: addresses to block and addresses to allow
BLOCKED = (
    "http://casino-royal.example.com/en/1", "https://www.online-casino.example.com/fr/22.html", "http://m.casino-slots.example.org/en/310",
    "https://win-big.example.com/en/45?ref=x", "http://free-casino.example.com/de/7", "https://best-bets.example.com/en/1200",
    "http://sport-bets.example.org/es/19", "https://m.free-spins.example.com/en/88/", "http://blog.free-money.example.com/en/4",
    "http://ads-server.example.com/en/551", "https://click-track.example.com/fr/62", "http://www.ads-banner.example.org/en/9.html",
    "https://track-users.example.com/en/73", "http://spam-mail.example.com/en/18", "https://m.spam-links.example.org/fr/640",
    "http://link-farm.example.com/en/2105", "https://content-farm.example.com/en/37", "http://cheap-meds.example.com/en/15",
    "https://buy-pills.example.org/de/27", "http://www.diet-pills.example.com/en/90", "https://cheap-watches.example.com/es/3",
    "http://adult-video.example.com/en/66", "https://m.adult-chat.example.org/en/48", "http://xxx-adult.example.com/fr/5",
    "https://m.adult-cam.example.net/en/512", "http://bets-now.example.net/fr/95",
)
ALLOWED = (
    "http://library.example.com/en/1", "https://www.university.example.com/fr/22.html", "http://m.museum.example.org/en/310",
    "https://weather.example.com/en/45?ref=x", "http://garden.example.com/de/7", "https://recipes.example.com/en/1200",
    "http://history.example.org/es/19", "https://m.science.example.com/en/88/", "http://blog.mathematics.example.com/en/4",
    "http://newspaper.example.com/en/551", "https://dictionary.example.com/fr/62", "http://www.theatre.example.org/en/9.html",
    "https://archive.example.com/en/73", "http://hospital.example.com/en/18", "https://m.station.example.org/fr/640",
    "http://mountain.example.com/en/2105", "https://orchestra.example.com/en/37", "http://another.example.com/en/15",
    "https://together.example.org/de/27", "http://www.nation.example.com/en/90", "https://motherland.example.com/es/3",
    "http://thunder.example.com/en/66", "https://m.thinking.example.org/en/48", "http://the-river.example.com/fr/5",
    "http://thrones.example.com/en/31", "https://m.thatched.example.com/de/412", "http://www.thirteen.example.org/fr/77/",
    "https://blog.nations.example.com/es/2450", "http://m.therapy.example.org/de/906.html",
    "https://thereon.example.com/en/5120", "http://wither.example.net/en/64#top", "https://www.tinted.example.net/de/83",
)


def _after(url: Column) -> Column:
    start = F.locate("://", url)
    return F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without one."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does; of equally long ones the first."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(text: Column, mark: str, n: int) -> Column:
    """The `n`-grams of a text between two marks, from one array of its characters, made once per row."""

    def pieces(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(chars) - (n - 1))
        grams = F.transform(starts, lambda i: F.concat(F.lit(mark), *[F.element_at(chars, i + k) for k in range(n)]))
        return F.when(F.size(chars) >= n, grams).otherwise(F.array().cast("array<string>"))

    return _let(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), pieces)


def features(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Buckets, from 1, of all n-grams of host and path, repeats included."""
    grams = F.concat(*[_grams(text, mark, n) for text, mark in ((host, "h"), (path, "p")) for n in LENGTHS])
    return F.transform(grams, lambda g: (F.conv(F.substring(F.md5(g), 1, 7), 16, 10).cast("int") % buckets + 1))


def margin(buckets: Column, weights: Column, bias: float) -> Column:
    """Bias plus the summed weights, divided by the root of the number of n-grams."""
    total = lambda found: F.aggregate(found, F.lit(0.0), lambda acc, b: acc + F.element_at(weights, b))
    return _let(buckets, lambda found: F.lit(bias) + total(found) / F.sqrt(F.greatest(F.size(found), F.lit(1))))


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, label of the small labelled table: 1 to block, 0 to allow."""
    return spark.createDataFrame([(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED], "url string, label int").coalesce(1)


def _literal(weights: Sequence[float]) -> Column:
    """The weights as one constant; their shortest exact spelling is read back when the plan is made."""
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def train(labelled: DataFrame, buckets: int = BUCKETS, rounds: int = ROUNDS, rate: float = RATE, momentum: float = MOMENTUM,
          decay: float = DECAY) -> tuple[list[float], float]:
    """Weights and bias after `rounds` steps against the gradient of the mean log loss.

    Rows with a null label take no part; a null url has no n-gram.  An empty table leaves all at zero.
    """
    rows = stored(labelled.where("label is not null").select(
        features(host_of(F.col("url")), path_of(F.col("url")), buckets).alias("b"), F.col("label").cast("double").alias("y")))
    n = rows.count()
    # place 0 is the bias
    values, speeds = [0.0] * (buckets + 1), [0.0] * (buckets + 1)
    for _ in range(rounds if n else 0):
        missed = rows.select("b", (_sigmoid(margin(F.col("b"), _literal(values[1:]), values[0])) - F.col("y")).alias("miss"))
        part = F.col("miss") / F.sqrt(F.greatest(F.size("b"), F.lit(1)))
        shares = missed.select("miss", part.alias("part"), F.explode(F.concat(F.array(F.lit(0)), "b")).alias("k"))
        sums = shares.groupBy("k").agg(F.sum(F.when(F.col("k") == 0, F.col("miss")).otherwise(F.col("part"))).alias("g"))
        gradient = {r["k"]: r["g"] / n for r in sums.collect()}
        for k, value in enumerate(values):
            speeds[k] = momentum * speeds[k] - rate * (gradient.get(k, 0.0) + (decay * value if k else 0.0))
            values[k] = value + speeds[k]
    return values[1:], values[0]


def judge_urls(df: DataFrame, model: tuple[list[float], float], rules: Sequence[tuple[str, str, str]] = RULES,
               id_col: str = "page_id", url_col: str = "url", limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, score, verdict: one row per row of `df`.

    `score` is the model's probability to block, to six places; the verdict is the rule's, or else `block` from `limit` on.
    A null url and one without `://` have an empty host and path, and are judged by what the model says of
    nothing.  Urls of any length are read whole.  Rows that repeat an id or a url are judged each; other
    columns are not looked at.  An empty table gives no rows.
    """
    weights, bias = model
    rows = df.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    cut = rows.select("page_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
                      F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"))
    found = rule_of(F.col("host"), F.col("path"), rules)
    score = _sigmoid(margin(features(F.col("host"), F.col("path"), len(weights)), _literal(weights), bias))
    return cut.withColumns({"found": found, "score": F.round(score, 6)}).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), "score",
        F.coalesce("found.verdict", F.when(F.col("score") >= limit, "block").otherwise("allow")).alias("verdict"))
