"""URL filters in built-in functions: listed rules, and association rules mined from labelled URLs.

A URL becomes a set of tokens (domain, first host label, path segments, extension, query keys, scheme; numbers alike).
Spark's FP-growth mines token sets that go with a label; rules with the label as consequent are kept if they are frequent,
certain and better than chance. Each rule is filed once, under the rarest of its tokens; a URL meets the rules under its
tokens and keeps those all of whose tokens it has. Of these the most certain decides (then the better supported, then the
shorter). Listed rules come first: of those that fit a URL's host or a parent domain and the beginning of its path, the
longest wins.

Every distinct URL is judged once, so that a URL of very many pages costs no more than another.

Cases: null URLs and those without "://" have an empty host and path, no rule, and the verdict of URLs without rules
("allow"); repeated rows get a verdict each; without labels of both kinds nothing is mined; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import ascii_lower
from loadcast.session import materialize


@dataclass(frozen=True)
class UrlOptions:
    """Rules hold for at least `support` of the labelled URLs with at least `confidence`, and have up to `tokens` tokens."""

    support: float = 0.004
    confidence: float = 0.6
    lift: float = 1.01
    tokens: int = 3
    otherwise: str = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, each with a letter for what it is."""
    labels = F.split(host, "\\.")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.concat(F.lit("q:"), F.regexp_extract(p, "^[^=]*", 0)))
    segments = F.transform(
        F.filter(F.split(ascii_lower(path), "/"), lambda s: s != ""),
        lambda s: F.concat(F.lit("p:"), F.regexp_replace(F.regexp_replace(s, r"\.[a-z0-9]+$", ""), "[0-9]+", "#")),
    )
    extension = F.concat(F.lit("e:"), F.regexp_extract(ascii_lower(path), r"\.([a-z0-9]+)$", 1))
    all_ = F.concat(
        F.array(
            F.concat(F.lit("d:"), F.array_join(F.slice(labels, -F.least(F.lit(2), F.size(labels)), 2), ".")),
            F.concat(F.lit("h:"), host),
            F.concat(F.lit("l:"), F.get(labels, 0)),
            F.concat(F.lit("s:"), F.regexp_extract(F.coalesce(url, F.lit("")), "^([A-Za-z]+)://", 1)),
            extension,
        ),
        keys,
        segments,
    )
    return F.array_distinct(F.filter(all_, lambda t: F.char_length(t) > 2))


def listed_verdicts(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(url, rule, listed) of the URLs that a listed rule fits; `rules` are (verdict, "host/path")."""
    spark = urls.sparkSession
    table = [(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for v, r in rules]
    index = spark.createDataFrame(table, "domain string, prefix string, rule string, listed string")
    labels = F.split("host", "\\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fits = (
        urls.select("url", "path", F.explode(domains).alias("domain"))
        .join(index, "domain")
        .where(F.startswith(F.col("path"), F.col("prefix")))
    )
    best = F.max(F.struct(F.char_length("rule").alias("n"), "rule", "listed")).alias("best")
    return fits.groupBy("url").agg(best).select("url", "best.rule", "best.listed")


def mine(urls: DataFrame, labels: DataFrame, options: UrlOptions) -> DataFrame:
    """(anchor, tokens, verdict, confidence, support) of the rules mined from `labels` (url, verdict)."""
    mark = "="
    both = urls.join(labels, "url").select(F.concat("tokens", F.array(F.concat(F.lit(mark), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=options.support, minConfidence=options.confidence).fit(both)
    rules = model.associationRules.select(
        "antecedent", F.get("consequent", 0).alias("head"), "confidence", "lift", "support"
    ).where(
        F.startswith(F.col("head"), F.lit(mark))
        & (F.size("antecedent") <= options.tokens)
        & (F.col("lift") >= options.lift)
        & ~F.exists("antecedent", lambda t: F.startswith(t, F.lit(mark)))
    )
    often = model.freqItemsets.where(F.size("items") == 1).select(F.get("items", 0).alias("token"), "freq")
    filed = rules.withColumn("rule_id", F.xxhash64("antecedent", "head")).select("*", F.explode("antecedent").alias("token"))
    anchor = filed.join(often, "token").groupBy("rule_id").agg(F.min_by("token", F.struct("freq", "token")).alias("anchor"))
    return rules.withColumn("rule_id", F.xxhash64("antecedent", "head")).join(anchor, "rule_id").select(
        "anchor",
        F.col("antecedent").alias("needs"),
        F.substring("head", 2, 100).alias("mined"),
        "confidence",
        "support",
    )


def mined_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined) of the URLs that a mined rule fits."""
    met = (
        urls.select("url", "tokens", F.explode("tokens").alias("anchor"))
        .join(rules, "anchor")
        .where(F.size(F.array_except("needs", "tokens")) == 0)
    )
    best = F.max(F.struct("confidence", "support", (-F.size("needs")).alias("n"), "mined")).alias("best")
    return met.groupBy("url").agg(best).select("url", "best.mined")


def judged_pages(
    pages: DataFrame, rules: list[tuple[str, str]], labels: DataFrame, options: UrlOptions = UrlOptions()
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages` (page_id, url). labels: (url, verdict)."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").where("url is not null").distinct().withColumn("host", host).withColumn("path", path)
    urls = materialize(urls.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path"))), "urls")
    # Labels of one URL that contradict each other: the majority counts, a tie blocks.
    blocks = (2 * F.count_if(F.col("verdict") == "block") >= F.count(F.lit(1))).alias("blocks")
    kinds = labels.where("verdict is not null").groupBy("url").agg(blocks)
    kinds = kinds.select("url", F.when(F.col("blocks"), "block").otherwise("allow").alias("verdict"))
    mined_rules = materialize(mine(urls, kinds, options), "rules")
    verdicts = (
        urls.select("url")
        .join(listed_verdicts(urls, rules), "url", "left")
        .join(mined_verdicts(urls, mined_rules), "url", "left")
        .select("url", "rule", F.coalesce("listed", "mined", F.lit(options.otherwise)).alias("verdict"))
    )
    return pages.select("page_id", "url").join(verdicts, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("verdict", F.lit(options.otherwise)).alias("verdict")
    )
