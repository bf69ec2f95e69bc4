"""URL filter rules, indexed by their rarest literal token.

A rule's pattern matches the host and path written together. ``*`` stands for any characters, ``^`` for one character
that is no letter, digit, ``_``, ``-``, ``.`` or ``%``, or for the end; a leading ``||`` holds the pattern to the start of the
host or one of its parents, a leading or closing ``|`` to the start or end. Letters and digits that must stand in a URL
as whole tokens are a rule's literal tokens; it is filed under the one that fewest URLs have. A URL's tokens fetch the
rules filed under them, with those that have no token, and only these run their regular expressions.
All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

#: Parts into which urls are dealt for the rules that have no token.
SALTS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Generic rules: hosts and paths that name spam, gambling, pills, adult pages, link farms and trackers.
GENERIC_RULES = [
    ("||spam-", "block"), ("-spam.", "block"), ("spam-farm.", "block"), ("cheap-pills.", "block"), ("-pills.", "block"), ("-casino.", "block"),
    ("||casino-", "block"), (".casino^", "block"), ("-poker.", "block"), ("||porn", "block"), ("||xxx.", "block"), ("link-farm.", "block"),
    ("-viagra.", "block"), ("free-download*crack", "block"), ("||ads.", "block"), ("||adserver.", "block"), ("||tracker.", "block"),
    ("/wp-login.php^", "block"), ("/cgi-bin/", "block"), ("||clickbait.", "block"),
]

#: Host and path rules of the query's contract.
SITE_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null and without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty for null and without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(text: Column) -> Column:
    """The distinct runs of ASCII letters and digits, in lower case."""
    return F.array_distinct(F.filter(F.split(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+"), lambda t: t != ""))


def regex_of(pattern: Column) -> Column:
    """A pattern's regular expression, for Java and RE2 alike."""
    body = F.regexp_replace(pattern, r"^\|{1,2}|\|$", "")
    body = F.regexp_replace(body, r"([\\.+?()\[\]{}$|])", r"\\$1")
    body = F.regexp_replace(F.regexp_replace(body, r"\*+", ".*"), r"\^", "(?:[^A-Za-z0-9_.%-]|\\$)")
    start = F.when(pattern.startswith("||"), r"^(?:[^/]*\.)?").when(pattern.startswith("|"), "^").otherwise("")
    return F.concat(F.lit("(?s)"), start, body, F.when(pattern.endswith("|") & (F.length(pattern) > 2), "$").otherwise(""))


def literal_tokens(pattern: Column) -> Column:
    """The tokens that stand whole in every URL that the pattern matches: bounded on both sides by something that ends a token."""
    return F.array_distinct(F.regexp_extract_all(F.translate(pattern, _UPPER, _LOWER), F.lit(r"(?:^\|{1,2}|(?<=[^a-z0-9*|]))([a-z0-9]+)(?=[^a-z0-9*]|\|$)"), 1))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]], site: bool, order: int = 0) -> DataFrame:
    """``(pattern, action)`` pairs as rules. A site rule ``host/path`` fits the host, its subdomains, and paths that start so."""
    named = spark.createDataFrame(rules, "rule string, action string")
    return named.select(F.when(F.lit(site), F.concat(F.lit("||"), "rule")).otherwise(F.col("rule")).alias("pattern"), "rule", "action", F.lit(order).alias("class"), F.length("rule").alias("rank"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages (page_id, url, ...)`` and ``rules (pattern, rule, action, class, rank)`` to ``page_id, host, path, rule, class, verdict``.

    Of the rules that match, the highest ``(class, rank, rule)`` gives its action; with none, ``rule`` is null and the
    verdict ``default``. One row per row of ``pages``, repeated ones and null ids too. Null urls and those without
    ``://`` have an empty host and path, and match only rules that match the empty text. Rules that are given twice
    count once; rules with null patterns match nothing. Other columns are ignored.

    Each distinct url is judged once; rules are sent to every executor if a count shows that they are few, else both
    sides are shuffled by token. Rules without a token meet every url; there the urls are dealt by a salt.
    """
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rules = rules.where(F.col("pattern").isNotNull()).select("pattern", "rule", "action", F.col("class").cast("int").alias("class"), F.col("rank").cast("int").alias("rank")).distinct()
    keyed = rules.withColumn("regex", regex_of(F.col("pattern"))).withColumn("token", F.explode_outer(literal_tokens(F.col("pattern"))))
    distinct = urls.select("url").distinct().select("url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("site"))
    words = distinct.select("url", "site", F.explode(tokens_of(F.col("site"))).alias("token"))
    tokens = small(keyed.where("token is not null").select("token").distinct())
    seen = words.join(tokens, "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    filed = keyed.join(seen, "token", "left").groupBy("pattern", "rule", "action", "class", "rank", "regex").agg(F.coalesce(F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")), F.lit("")).alias("token"))
    by_token = words.join(small(filed.where("token <> ''"), 100_000), "token")
    dealt = distinct.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int"))
    always = dealt.join(small(filed.where("token = ''").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), 100_000), "salt")
    tried = ["url", "site", "regex", "class", "rank", "rule", "action"]
    fetched = by_token.select(*tried).unionByName(always.select(*tried)).where(F.expr("site rlike regex"))
    best = fetched.groupBy("url").agg(F.max(F.struct("class", "rank", "rule", "action")).alias("best"))
    out = urls.join(best.withColumnRenamed("url", "u"), F.col("url").eqNullSafe(F.col("u")), "left")
    return out.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("best.rule").alias("rule"), F.col("best.class").alias("class"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
