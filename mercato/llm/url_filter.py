"""URL filter: block and allow rules looked up by short hash prefixes of a URL's expressions.

A rule is a host and a path prefix. It fits its host and all subdomains if the URL's path starts with the rule's
path. Every URL is expanded into (host suffix + path prefix) expressions; these meet the rules in an equi-join on
the first hex digits of their SHA-256, a full digest confirms the meeting, and the longest rule decides.
Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8  # hex digits of the digest that the join uses
VERDICTS = ("allow", "block")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or if null."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or if null."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def rule_table(rules: DataFrame) -> DataFrame:
    """``rules`` (host, path, verdict) with what the look-up needs, one row per rule.

    Host is lower-cased; rules with a null or empty host or an unknown verdict are left out, as they fit no URL or
    say nothing; a null path is empty and fits all paths. The same host and path with both verdicts blocks.
    """
    host, path = F.lower("host"), F.coalesce("path", F.lit(""))
    return (
        rules.select(host.alias("rule_host"), path.alias("rule_path"), F.col("verdict").alias("rule_verdict"))
        .filter((F.col("rule_host") != "") & F.col("rule_verdict").isin(*VERDICTS))
        .groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
        .withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("rule_prefix", F.left("rule_digest", F.lit(PREFIX_DIGITS)))
    )


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced).

    ``rule`` is host and path of the longest fitting rule, null if none fits, and then ``verdict`` is ``default``.
    Equally long rules: the longer host, then the larger rule text decides. A null URL, an empty one or one without
    ``://`` has an empty host and no rule; repeated pages are judged alike and all kept; an empty rule table
    leaves the default. Every distinct URL is expanded once, so a hot URL or host costs its distinct paths only.
    """
    lookup = rule_table(rules)
    # the path lengths that rules have, so that prefixes are cut only there: no more than the longest path has signs
    lengths = sorted(r["n"] for r in lookup.select(F.length("rule_path").alias("n")).distinct().collect())

    urls = (
        pages.select(F.col(url_col).alias("judged")).filter("judged IS NOT NULL").distinct()
        .select("judged", host_of(F.col("judged")).alias("host"), path_of(F.col("judged")).alias("path"))
        .filter("host <> ''")
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.left(F.col("path"), n))
    expressions = (
        urls.select("judged", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("judged", "suffix", F.explode("prefixes").alias("prefix"))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
    )
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"),
        F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"))
    decided = (
        expressions.join(lookup, F.left("digest", F.lit(PREFIX_DIGITS)) == F.col("rule_prefix"))
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("judged").agg(F.max(order).alias("won"))
        .select("judged", F.col("won.rule").alias("won_rule"), F.col("won.verdict").alias("won_verdict"))
    )
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return (
        pages.join(decided, pages[url_col] == decided["judged"], "left")
        .select(
            *(pages[c] for c in kept), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"),
            decided["won_rule"].alias("rule"), F.coalesce(decided["won_verdict"], F.lit(default)).alias("verdict"))
    )
