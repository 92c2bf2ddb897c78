"""URL filter lists: host-suffix and path-prefix expressions, looked up by short hash prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("allow", "block")
PREFIX_HEX = 8  # 32 bits of the digest are joined on; the full digest decides


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; '' without one."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_suffixes(host: Column, most: int) -> Column:
    """The host and the hosts above it, ``a.b.c``, ``b.c``, ``c``, those of at most ``most`` labels."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1
    return F.array_compact(F.array(*[F.when(labels >= n, F.substring_index(host, ".", -n)) for n in range(1, most + 1)]))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (action, host, path) as a frame for :func:`filter_urls`."""
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def filter_urls(
    df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """The frame's rows with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has action (allow or block), host and path. A rule fits its host and all hosts below,
    if the URL's path starts with the rule's; the longest rule (host and path together) wins, and
    of equally long ones a block, then the smaller text. ``rule`` is its host and path, NULL where
    none fits; there ``verdict`` is ``default``.

    Each URL gives one expression per host suffix that has no more labels than the longest rule's host, and per
    length that a rule's path has, so a rule path need not end at a slash, and hosts and paths may be of any length. Expressions meet the rules by the first 32 bits of their SHA-256
    in an equi-join, and the whole digests are then compared. Rows go back together by a number
    that each gets when read, so NULL, repeated and very frequent URLs or ids need no care; the input has to
    give its rows in the same order if a task reads them again, as files and tables do. A NULL
    URL, or one without ``://``, has empty host and path and fits no rule. Rules with a NULL in any
    column, or another action, are left out, and repeated ones count once. Columns of ``df`` called
    host, path, rule or verdict are replaced.
    """
    known = (
        rules.select(F.lower("action").alias("action"), ascii_lower(F.col("host")).alias("host"), "path")
        .filter(F.col("action").isin(*ACTIONS) & F.col("host").isNotNull() & F.col("path").isNotNull())
        .distinct()
    )
    labels = F.size(F.split("host", r"\.", -1))
    lengths, most = known.agg(F.sort_array(F.collect_set(F.length("path"))), F.max(labels)).first()
    digest = F.sha2(F.concat(F.col("host"), F.lit("\n"), F.col("path")), 256)
    index = known.select(
        digest.alias("rule_digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            (F.col("action") == "block").alias("block"),
            F.concat("host", "path").alias("text"),
        ).alias("found"),
    ).withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_HEX))

    kept = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = df.select(
        F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in kept]).alias("kept"),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
        F.monotonically_increasing_id().alias("row"),
    )
    paths = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths or [0]]
    prefixes = F.array_compact(F.array(*paths))
    expressions = F.flatten(
        F.transform(
            host_suffixes(F.col("host"), most or 1),
            lambda h: F.transform(prefixes, lambda p: F.sha2(F.concat(h, F.lit("\n"), p), 256)),
        )
    )
    asked = rows.withColumn(
        "digest", F.explode_outer(F.when(F.col("host") != "", expressions))
    ).withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    found = asked.join(
        index,
        (F.col("prefix") == F.col("rule_prefix")) & (F.col("digest") == F.col("rule_digest")),
        "left",
    )
    order = F.struct("found.length", "found.block", F.col("found.text"))
    best = found.groupBy("row").agg(
        F.first("kept").alias("kept"),
        F.first("host").alias("host"),
        F.first("path").alias("path"),
        F.max(F.when(F.col("found").isNotNull(), order)).alias("best"),
    )
    return best.select(
        "kept.*",
        "host",
        "path",
        F.col("best.text").alias("rule"),
        F.when(F.col("best.block"), "block")
        .when(F.col("best").isNotNull(), "allow")
        .otherwise(default)
        .alias("verdict"),
    )
