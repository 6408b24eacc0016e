"""Allow and block rules on URLs, matched by digests of host-suffix and path-prefix expressions.

Every URL is expanded into the expressions under which a rule could stand: each suffix of its host at a dot,
with each prefix of its path that has the length of some rule's path. Expressions meet rules in an equi-join
on the first 32 bits of their SHA-256 digests; whole digests confirm a match, and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.llm.batches import unused

#: Rules up to this number, with texts up to so many bytes, are broadcast.
BROADCAST_RULES, BROADCAST_BYTES = 100_000, 16_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?` or `#`, with A-Z lower-cased; empty if there is no `://`."""
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?` or `#`."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepared(rules: DataFrame) -> DataFrame:
    """Distinct rules `(rule, action, prefix, whole)` with the short and the whole digest.

    A rule without host, path or a known action takes part no further; of the same host and path with both
    actions, block counts.
    """
    host = F.translate("host", UPPER, LOWER)
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND action IN ('allow', 'block')")
    one = known.groupBy(host.alias("host"), "path").agg(F.max("action").alias("action"))
    whole = digest(F.col("host"), F.col("path"))
    return one.select(
        F.concat("host", "path").alias("rule"),
        "action",
        F.length("path").alias("path_length"),
        F.substring(whole, 1, 8).alias("prefix"),
        whole.alias("whole"),
    )


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The columns of `pages` with `host`, `path`, `rule` and `verdict` (columns so named before are replaced).

    `rules(action, host, path)`: a rule fits its host and all subdomains where the URL's path starts with the
    rule's; the longest fitting rule decides (of equal length the greatest host and path), else `default` with
    a null rule. A null URL, or one without `://`, has an empty host and path. Repeated pages stay as they
    are: verdicts are found for distinct URLs, which also makes one row of a URL that very many pages have.
    """
    ruled = prepared(rules)
    size = ruled.agg(F.count("*").alias("n"), F.sum(F.octet_length("rule") + 100).alias("bytes"), F.sort_array(F.collect_set("path_length")).alias("lengths")).first()
    lengths = list(size["lengths"])
    fits = size["n"] <= BROADCAST_RULES and (size["bytes"] or 0) <= BROADCAST_BYTES
    ruled = ruled.select(F.col("prefix").alias("rule_prefix"), "whole", "rule", "action")
    ruled = F.broadcast(ruled) if fits else ruled

    new = ("host", "path", "rule", "verdict")
    kept = pages.drop(*new)
    whole_url, best_rule = unused(pages, "whole_url"), unused(pages, "best_rule")
    url = F.col(whole_url)
    whole_pages = pages.select(*[F.col(f"`{c}`") for c in kept.columns], F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit("")).alias(whole_url))
    parts = whole_pages.select(whole_url).distinct().select(whole_url, host_of(url).alias("host"), path_of(url).alias("path"))

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n)
    )
    named = parts.select(whole_url, F.explode(suffixes).alias("suffix"), "path").select(whole_url, "suffix", F.explode(prefixes).alias("start"))
    keyed = named.withColumn("full", digest(F.col("suffix"), F.col("start"))).withColumn("prefix", F.substring("full", 1, 8))
    met = keyed.join(ruled, keyed["prefix"] == F.col("rule_prefix")).where(F.col("full") == F.col("whole"))
    best = met.groupBy(whole_url).agg(F.max(F.struct(F.length("rule").alias("length"), "rule", "action")).alias(best_rule))

    judged = whole_pages.join(best, whole_url, "left")
    return judged.select(
        *[F.col(f"`{c}`") for c in kept.columns],
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col(f"{best_rule}.rule").alias("rule"),
        F.coalesce(f"{best_rule}.action", F.lit(default)).alias("verdict"),
    )
