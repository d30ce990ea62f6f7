"""URL allow/block filter: a trie over reversed host labels and path segments.

Rules are ``(host, path, verdict)``.  A rule fits its host and every subdomain
when the url's path starts with the rule's path; of the fitting rules the one
with the longest ``host + path`` wins (then the longer host, then ``block``).
Up to ``max_trie_rules`` rules the trie goes to the executors as one bounded
broadcast and urls are judged where they are read, without a shuffle.  A larger
rule table is joined on the host suffixes of the distinct urls instead.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower

VERDICT = "rule string, verdict string"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; '' without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class UrlTrie:
    """Nested dicts: reversed host labels, then whole path segments; a rule's last, open piece is kept beside its node."""

    def __init__(self, rules):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("hosts", {}).setdefault(label, {})
            node = node.setdefault("paths", {})
            *whole, tail = path.split("/")
            for segment in whole:
                node = node.setdefault("next", {}).setdefault(segment, {})
            entry = (len(host) + len(path), len(host), verdict == "block", host + path, verdict)
            tails = node.setdefault("tails", {})
            tails[tail] = max(tails.get(tail, entry), entry)

    def _along_path(self, node, segments, best):
        for depth in range(len(segments)):
            rest = None
            for tail, entry in node.get("tails", {}).items():
                if tail and rest is None:
                    rest = "/".join(segments[depth:])
                if (not tail or rest.startswith(tail)) and (best is None or entry > best):
                    best = entry
            node = node.get("next", {}).get(segments[depth])
            if node is None:
                break
        return best

    def find(self, host: str, path: str):
        """``(rule, verdict)`` of the winning rule or None."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("hosts", {}).get(label)
            if node is None:
                break
            if "paths" in node:
                best = self._along_path(node["paths"], segments, best)
        return None if best is None else best[3:]


def _judge_by_trie(spark, urls: DataFrame, rules: list, default: str) -> DataFrame:
    trie = spark.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf(VERDICT)
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [trie.value.find(h, p) or (None, default) for h, p in zip(host, path)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return urls.withColumn("__judged", judge("__host", "__path"))


def _judge_by_join(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    labels = F.split("__host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    distinct = urls.select("__host", "__path").distinct()
    fits = distinct.withColumn("__rule_host", F.explode(suffix)).join(rules, "__rule_host").where(F.col("__path").startswith(F.col("__rule_path")))
    size = F.length("__rule_host") + F.length("__rule_path")
    order = F.struct(size.alias("n"), F.length("__rule_host").alias("h"), (F.col("__rule_verdict") == "block").alias("b"), F.concat("__rule_host", "__rule_path").alias("rule"), F.col("__rule_verdict").alias("verdict"))
    best = fits.groupBy("__host", "__path").agg(F.max(order).alias("__best"))
    judged = F.struct(F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict"))
    return urls.join(best, ["__host", "__path"], "left").withColumn("__judged", judged).drop("__best")


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", max_trie_rules: int = 100_000) -> DataFrame:
    """All rows and columns of ``df`` plus ``host``, ``path``, ``rule`` and ``verdict``.

    Columns of ``df`` with those four names are replaced.  A null url, or one
    without ``://``, has empty host and path and gets ``default`` with a null
    rule.  Rules with a null part or a verdict other than allow/block are left
    out; a repeated rule counts once, and block beats allow.  Empty tables give empty results.
    """
    spark = df.sparkSession
    rules = rules.select(ascii_lower(F.col("host")).alias("__rule_host"), F.col("path").alias("__rule_path"), F.col("verdict").alias("__rule_verdict"))
    rules = rules.where("__rule_host is not null and __rule_path is not null and __rule_verdict in ('allow', 'block')").distinct()
    urls = df.withColumn("__host", url_host(F.col(url_col))).withColumn("__path", url_path(F.col(url_col)))
    head = rules.limit(max_trie_rules + 1).collect()
    judged = _judge_by_trie(spark, urls, [tuple(r) for r in head], default) if len(head) <= max_trie_rules else _judge_by_join(urls, rules, default)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    return judged.select(*kept, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__judged.rule").alias("rule"), F.col("__judged.verdict").alias("verdict"))
