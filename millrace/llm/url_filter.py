"""Verdicts on URLs by rules on host and path.

A rule fits a URL whose host is the rule's host or one below it and whose path starts with the
rule's path. The keys that could fit a URL are its host suffixes with each of its path prefixes of a
length that some rule has. A blocked Bloom filter over the rules' keys (all bits of a key in one block
of 512) drops nearly all keys that are no rule's; what passes goes to an exact hash join with the
rules, which removes false positives. The longest rule (host and path together, then the smaller text)
wins; a URL that no rule fits is allowed.

The filter has ``bits_per_rule`` bits a rule up to ``bloom.MAX_BLOCKS`` blocks (64 MB), which bounds
what is broadcast; beyond that it lets more keys through to the join, which stays exact.

URLs are judged once each: repeated URLs cost one key set, and any skew of URLs or hosts meets the
join on a side with one row per key. Null URLs, and those without ``://``, have empty host and path
and fit no rule. Repeated rules count once; a rule listed to allow and to block, blocks. Other
columns of the pages are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import bloom


def host(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end; A-Z lower-cased, else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to a question mark, hash or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key_hash(host_column: Column, path_column: Column) -> Column:
    return F.xxhash64(host_column, path_column)


def candidate_keys(urls: DataFrame, lengths: list[int], depths: list[int]) -> DataFrame:
    """Every (host suffix, path prefix) of each URL (columns url, host, path) that some rule could have.

    ``lengths`` are those of the rules' paths, ``depths`` the numbers of labels of their hosts; so the keys
    of a URL don't grow with its host or path.
    """
    labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    suffixes = [F.when(labels >= d, F.substring_index("host", ".", -d)) for d in depths]
    keys = urls.where(F.col("host") != "").select("url", "path", F.explode(F.array(*suffixes).cast("array<string>")).alias("key_host"))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    return keys.where("key_host IS NOT NULL").select("url", "key_host", "path", F.explode(prefixes).alias("n")).select(
        "url", "key_host", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("key_path")
    )


def verdicts(pages: DataFrame, rules: DataFrame, bits_per_rule: int = bloom.BITS_PER_KEY, max_blocks: int = bloom.MAX_BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    rules: host (lower case), path (from its first slash), action (allow or block). The number of
    distinct path lengths and host depths, not of rules, bounds the keys of a URL. URLs of any length are
    read whole. An empty table gives an empty result; without rules every verdict is allow.
    """
    listed = rules.groupBy("host", "path").agg(F.max("action").alias("action"))
    lengths = sorted(r[0] for r in listed.select(F.length("path")).distinct().collect())
    depths = sorted(r[0] for r in listed.select(F.size(F.split("host", r"\."))).distinct().collect())
    pages = pages.select("page_id", "url")
    seen = pages.where(F.col("url").contains("://")).select("url").distinct()
    seen = seen.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    keys = candidate_keys(seen, lengths, depths)
    listed_keys = listed.select(_key_hash(F.col("host"), F.col("path")).alias("key")).distinct()
    possible = bloom.possible(bloom.build(listed_keys, bits_per_rule, max_blocks))
    hits = keys.where(possible(_key_hash(F.col("key_host"), F.col("key_path"))))
    exact = hits.join(listed, (F.col("key_host") == F.col("host")) & (F.col("key_path") == F.col("path")))
    rule = F.concat("key_host", "key_path")
    best = exact.select("url", rule.alias("rule"), "action").groupBy("url").agg(
        F.min(F.struct((-F.length("rule")).alias("n"), "rule", "action")).alias("best")
    )
    found = pages.join(best, "url", "left")
    return found.select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit("allow")).alias("verdict"),
    )
