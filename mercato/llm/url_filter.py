"""URL filtering by expressions, short hash prefixes and full digests.

A rule names a host and a beginning of a path.  It fits a URL whose host is the
rule's or below it and whose path begins with the rule's path.  Each URL is
expanded into its expressions ``host suffix + path prefix``; the first four
bytes of their SHA-256 are joined with those of the rules, the full digest
confirms a match, and of a URL's matches the longest rule wins.

A URL is expanded only at the sizes that rules have (labels of a host,
characters of a path), so the expansion is as wide as the rules are varied, is
never cut off, and no rule can be missed.  Only distinct URLs are expanded, and
only matches are regrouped.

Defined results: a URL that is null or without ``://`` has an empty host and
path and fits no rule; of two rules of equal length for one URL the one with
the longer host wins, then a block; a rule given twice counts once, with a block
if its verdicts differ; a URL that no rule fits gets the default verdict;
repeated rows and rows with a null id are each judged; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def _keyed(df: DataFrame) -> DataFrame:
    """Digest and short prefix of an expression; a NUL keeps host and path apart."""
    digest = F.sha2(F.concat("e_host", F.lit("\0"), "e_path"), 256)
    return df.withColumn("digest", digest).withColumn("short", F.substring("digest", 1, 8))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The id, host, path, rule and verdict of every row of ``pages``.

    ``rules``: host, path, verdict (``allow`` or ``block``).  The sizes that
    occur among the rules are collected: at most (labels of the deepest host) x
    (length of the longest path) pairs of numbers, however many rules there are.
    """
    clean = rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL") \
        .groupBy(F.lower("host").alias("e_host"), F.col("path").alias("e_path")).agg(F.max("verdict").alias("verdict"))
    sizes = clean.select(_labels(F.col("e_host")).alias("labels"), F.length("e_path").alias("chars")).distinct().collect()
    at = F.array(*[F.struct(F.lit(r["labels"]).alias("labels"), F.lit(r["chars"]).alias("chars")) for r in sizes]) if sizes \
        else F.array().cast("array<struct<labels:int,chars:int>>")
    listed = _keyed(clean).select("short", "digest", "verdict", F.concat("e_host", "e_path").alias("rule"),
                                  F.length("e_host").alias("host_length"))

    urls = pages.select(F.col(url_col).cast("string").alias("url")).filter(F.col("url").contains("://")).distinct()
    split = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = split.withColumn("labels", _labels(F.col("host"))).withColumn("at", F.explode(at)) \
        .filter((F.col("at.labels") <= F.col("labels")) & (F.col("at.chars") <= F.length("path")))
    expressions = _keyed(parts.select(
        "url", F.call_function("substring_index", "host", F.lit("."), -F.col("at.labels")).alias("e_host"),
        F.substring(F.col("path"), F.lit(1), F.col("at.chars")).alias("e_path")))
    matches = expressions.select("url", "short", "digest").join(listed.withColumnRenamed("digest", "full"), "short") \
        .filter("digest = full")
    order = F.struct(F.length("rule"), "host_length", F.col("verdict") == "block", "rule", "verdict")
    best = matches.groupBy("url").agg(F.max(order).alias("best")) \
        .select(F.col("url").alias("_url"), F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    src = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("_page_url"))
    return src.join(best, F.col("_page_url") == F.col("_url"), "left").select(
        id_col, host_of(F.col("_page_url")).alias("host"), path_of(F.col("_page_url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))
