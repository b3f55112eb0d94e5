"""URL rules as a sort-merge range join over reversed-host keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.shared import ascii_lower, running_last, written


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot. A host and its subdomains are one interval of keys: those from
    ``org.example.`` up to ``org.example/``, as ``/`` follows ``.`` in byte order and no host holds it.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _own_rules(rules: DataFrame) -> DataFrame:
    """One row per rule: ``key`` (of its host), ``path``, ``host``, ``verdict``; of equal rules the one that blocks."""
    return rules.select(
        ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict",
    ).groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        host_key(F.col("host")).alias("key"), "host", "path", "verdict")


def _above(hosts: DataFrame) -> DataFrame:
    """(key, above): each rule host with itself and all rule hosts that enclose it. A host has few labels, so its possible
    enclosing hosts are few; they meet by equality.
    """
    labels = F.split(F.expr("left(key, length(key) - 1)"), r"\.")
    upwards = hosts.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))).alias("above"))
    return upwards.join(hosts.select(F.col("key").alias("above")), "above", "left_semi")


def _enclosing_paths(own: DataFrame) -> DataFrame:
    """``own`` with ``outer``: the longest other path of the same host that the rule's path starts with, else null. Only
    prefixes of lengths that paths of the host have are looked up.
    """
    sizes = own.select("key", F.length("path").alias("_size")).distinct()
    shorter = own.select("key", "path").join(sizes, "key").where(F.col("_size") < F.length("path")).select(
        "key", "path", F.expr("left(path, _size)").alias("outer"))
    nested = shorter.join(own.select("key", F.col("path").alias("outer")), ["key", "outer"], "left_semi")
    return own.join(nested.groupBy("key", "path").agg(F.max_by("outer", F.length("outer")).alias("outer")),
                    ["key", "path"], "left")


def _rule_hosts_of(hosts: DataFrame, above: DataFrame) -> DataFrame:
    """(host, active): the closest rule host of each host that has one, by a sweep over host keys. Interval starts put a
    rule host on the stack, interval ends uncover the enclosing one, and each host takes what lies on top.
    """
    ruled = above.groupBy("key").agg(F.max(F.when(F.col("above") != F.col("key"), F.col("above"))).alias("parent"))
    nobody = F.lit(None).cast("string")
    starts = ruled.select("key", F.lit(0).alias("kind"), nobody.alias("host"), F.col("key").alias("top"))
    ends = ruled.select(F.expr("left(key, length(key) - 1) || '/'").alias("key"), F.lit(0).alias("kind"),
                        nobody.alias("host"), F.coalesce("parent", F.lit("")).alias("top"))
    asked = hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host", nobody.alias("top"))
    swept = running_last(starts.unionByName(ends).unionByName(asked), "top", ["key", "kind"], "active", "url-hosts")
    return swept.where("host is not null and active <> ''").select("host", "active")


def _rules_of(points: DataFrame, own: DataFrame) -> DataFrame:
    """(above, path, rule): for each rule host and path asked for, the host's rule with the longest path that starts it.

    The paths that start with a rule's path are one interval of bytes, up to that path and the byte FF, which no text
    holds. Intervals nest; the sweep runs over (host, path), so that a host with very many rules or pages spreads over
    tasks.
    """
    rule = F.struct("path", "host", "verdict")
    nobody = F.struct(*[F.lit(None).cast("string").alias(n) for n in ("path", "host", "verdict")])
    nothing = F.lit(None).cast("struct<path: string, host: string, verdict: string>")
    nested = _enclosing_paths(own)
    outer = nested.select("key", F.col("path").alias("_inner"), F.col("outer").alias("path")).join(
        own, ["key", "path"], "left").select(
        "key", F.col("_inner").alias("path"), F.when(F.col("host").isNotNull(), rule).otherwise(nobody).alias("top"))

    def events(rows, kind, at, path, top):
        return rows.select("key", at.alias("at"), F.lit(kind).alias("kind"), path.alias("path"), top.alias("top"))

    unasked = F.lit(None).cast("string")
    here = F.col("path").cast("binary")
    swept = running_last(
        events(own, 0, here, unasked, rule)
        .unionByName(events(outer, 0, F.concat(here, F.lit(b"\xff")), unasked, F.col("top")))
        .unionByName(events(points.withColumnRenamed("above", "key"), 1, here, F.col("path"), nothing)),
        "top", ["key", "at", "kind"], "rule", "url-paths")
    return swept.where("path is not null and rule.host is not null").select(F.col("key").alias("above"), "path", "rule")


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all its subdomains if the url's
    path starts with the rule's. The longest rule (host and path together) wins, of equally long ones that with the
    longer host, of equal ones block. Where no rule fits, ``rule`` is null and the verdict ``default``; so is the verdict
    of a rule whose own is null. A rule without path fits all paths, one without host the empty host. A null url, or
    one without ``://``, has an empty host and path. Other columns of ``pages`` are ignored; without rules, or without
    pages, nothing fails.

    Two sweeps over sorted keys find the rules: one over distinct hosts for the closest rule host of each, one over
    distinct pairs of rule host and path for the innermost path rule of that host and of each that encloses it. A host or
    url with a third of all pages is one row of them, and rules are never gathered. Pages then meet their (host, path)
    by an equality join, which adaptive execution splits where one url is hot.
    """
    parts = pages.select(
        F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    own = written(_own_rules(rules), "url-rules")
    above = written(_above(own.select("key").distinct()), "url-above")
    ruled = _rule_hosts_of(parts.select("host").distinct(), above)
    urls = written(parts.join(ruled, "host").select("host", "path", "active").distinct(), "urls")
    asked = urls.join(above.withColumnRenamed("key", "active"), "active").select("host", "path", "above")
    found = asked.join(_rules_of(asked.select("above", "path").distinct(), own), ["above", "path"])
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        F.length(F.concat("rule.host", "rule.path")).alias("size"), F.length("rule.host").alias("host_size"),
        F.concat("rule.host", "rule.path").alias("rule"), F.col("rule.verdict").alias("verdict"))).alias("_best"))
    return parts.join(best, ["host", "path"], "left").select(
        F.col("_id").alias(id_col), "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
