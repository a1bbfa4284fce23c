"""URL filters (operator 9), DataFrame functions only.

Each distinct URL is expanded into host-suffix and path-prefix
expressions, the expressions meet the rules by an equi-join on the first
four bytes of a SHA-256, full digests confirm, and the longest rule wins.

Only expressions that can hit are made: suffixes of as many labels, and
prefixes as long, as some rule has (both sets are read from the rules).
Verdicts are found once per distinct (host, path) and joined back.

Defined results: a null URL or one without ``://`` has an empty host and
path; an empty path fits no rule that starts with ``/``; a URL that no
rule fits gets ``default``.  Of equally long rules the one with the longer
host wins, and of equal rules ``block``.  Rules with a null host, path or
verdict take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_BYTES = 4
SEP = "\n"       # between host and path in a digest


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit(SEP), path), 256))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def expressions(labels: list[int], lengths: list[int]) -> Column:
    """All (host suffix, path prefix) pairs of a row with host and path."""
    host, path = F.col("host"), F.col("path")
    suffixes = F.filter(F.array(*[F.when(_labels(host) >= n, F.substring_index(host, ".", -n)) for n in labels]),
                        lambda x: x.isNotNull())
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
                        lambda x: x.isNotNull())
    return F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: F.struct(h.alias("h"), p.alias("p")))))


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule and verdict; columns of those names
    are replaced.  ``rules``: host, path, verdict (allow or block)."""
    keep = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    url = F.col(f"`{url_col}`")
    rows = urls.select(*[F.col(f"`{c}`") for c in keep], host_of(url).alias("host"), path_of(url).alias("path"))
    r = (rules.dropna(subset=["host", "path", "verdict"])
         .select(F.lower("host").alias("h"), F.col("path").alias("p"), "verdict"))
    shape = r.agg(F.collect_set(_labels(F.col("h"))), F.collect_set(F.length("p"))).first()
    if not shape[0]:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # Precedence packed into one number: total length, host length, block.
    # Both lengths then name the rule's own suffix and prefix of this URL.
    r = r.select(_digest(F.col("h"), F.col("p")).alias("rule_digest"),
                 (((F.length("h") + F.length("p")).cast("long") * F.lit(1 << 24) + F.length("h")) * 2
                  + (F.col("verdict") == "block").cast("int")).alias("rank"))
    r = r.withColumn("k", F.substring("rule_digest", 1, PREFIX_BYTES))
    found = (rows.select("host", "path").distinct()
             .select("host", "path", F.explode(expressions(sorted(shape[0]), sorted(shape[1]))).alias("e"))
             .select("host", "path", _digest(F.col("e.h"), F.col("e.p")).alias("digest"))
             .withColumn("k", F.substring("digest", 1, PREFIX_BYTES))
             .join(r, "k").filter(F.col("digest") == F.col("rule_digest"))
             .groupBy("host", "path").agg(F.max("rank").alias("rank")))
    n_host = F.expr("cast((rank div 2) % 16777216 as int)")
    n_path = F.expr("cast((rank div 2) div 16777216 as int)") - n_host
    # host + path names the pair (a host holds no slash); joining by it deals
    # both sides anew, so that AQE can split a hot URL.
    found = found.select(F.concat("host", "path").alias("_sf_url"),
                         F.concat(F.right("host", n_host), F.left("path", n_path)).alias("rule"),
                         F.when(F.col("rank") % 2 == 1, "block").otherwise("allow").alias("_sf_verdict"))
    out = rows.withColumn("_sf_url", F.concat("host", "path")).join(found, "_sf_url", "left")
    return out.select(*[F.col(f"`{c}`") for c in keep], "host", "path", "rule",
                      F.coalesce("_sf_verdict", F.lit(default)).alias("verdict"))
