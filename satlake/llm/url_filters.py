"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes.

Every URL is expanded into the expressions that a rule could have (a suffix of
its host labels, a prefix of its path).  The expressions meet the rules in an
equi-join on a short prefix of their SHA-256; the full digest then confirms the
match and the longest rule decides.  All of it is DataFrame operators.

Defined results: a URL that is null or has no ``://`` has an empty host and
path; repeated pages keep their rows; an empty rule table leaves every URL to
the default verdict.  Only the named columns are read, so others may clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlake.llm.common import few, lower_ascii

#: Hex digits of the digest that rows are joined on.
PREFIX_DIGITS = 8

RULE_SCHEMA = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)


def url_host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def _label_count(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def keyed_rules(rules: DataFrame) -> DataFrame:
    """One row per expression: its digest, length and verdict (block wins over allow)."""
    return (
        rules.select(
            lower_ascii(F.coalesce("host", F.lit(""))).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
        )
        .groupBy("rule_host", "rule_path")
        .agg(F.max("rule_verdict").alias("rule_verdict"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
        .withColumn("digest", F.sha2("rule", 256))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )


def _shapes(rules: DataFrame) -> DataFrame:
    """The distinct (labels, path length) of the rules: all other expressions match nothing."""
    return rules.select(
        _label_count(F.col("rule_host")).alias("labels"), F.length("rule_path").alias("chars")
    ).distinct()


def expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per url and expression that has the shape of a rule.

    Shapes are at most (longest rule host) x (longest rule path) however many
    rules there are, so they go into the plan as literals.
    """
    shapes = sorted((r.labels, r.chars) for r in _shapes(rules).collect())
    labels = F.split("host", r"\.", -1)
    found = [
        F.when(
            (F.size(labels) >= n) & (F.length("path") >= k),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring("path", 1, k)),
        )
        for n, k in shapes
    ]
    if not found:
        return urls.select("url", F.lit(None).cast("string").alias("expression")).limit(0)
    return urls.select("url", F.explode(F.array_compact(F.array(*found))).alias("expression"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Each page with host, path, the deciding rule (or null) and the verdict.

    The longest rule wins; of equally long ones the one with the longer host.
    Verdicts are found once per distinct URL, so a URL that fills a third of the
    rows is reduced before the shuffle, and then joined back.
    """
    rules = keyed_rules(rules)
    urls = (
        pages.select("url")
        .distinct()
        .withColumn("host", url_host(F.col("url")))
        .withColumn("path", url_path(F.col("url")))
    )
    looked_up = expressions(urls, rules).withColumn("digest", F.sha2("expression", 256))
    looked_up = looked_up.withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    hits = looked_up.alias("u").join(few(rules).alias("r"), F.col("u.prefix") == F.col("r.prefix"))
    best = (
        hits.where(F.col("u.digest") == F.col("r.digest"))
        .groupBy(F.col("u.url").alias("url"))
        .agg(
            F.max(
                F.struct(F.length("rule"), F.length("rule_host"), "rule_verdict", "rule")
            ).alias("best")
        )
        .select("url", "best.rule", "best.rule_verdict")
    )
    return (
        pages.select("page_id", "url")
        .join(best, "url", "left")
        .select(
            "page_id",
            "url",
            url_host(F.col("url")).alias("host"),
            url_path(F.col("url")).alias("path"),
            "rule",
            F.coalesce("rule_verdict", F.lit(default)).alias("verdict"),
        )
    )
