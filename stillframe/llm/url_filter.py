"""URL filtering with blocked Bloom filters before exact hash joins. Native expressions only.

The suffixes of a URL's host are tested in a filter of the listed hosts, without
a shuffle. Only URLs that pass meet the hosts themselves, which tell the lengths
of their paths; the keys of these lengths are tested in a filter of all listed
canonical prefixes, and what passes is joined with them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side is broadcast only if so many bytes of it are counted at most.
BROADCAST_BYTES = 32 << 20
WORDS, BITS_PER_KEY = 4, 16


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash sign or the end, A-Z lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to a question mark, hash sign or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _probe(key: str) -> dict[str, Column]:
    """Block and one bit in each of its four words, from two hashes of the key."""
    return {f"m{j}": F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}, 1), {6 * j}) & 63 as int))") for j in range(WORDS)}


def _sized(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def bloom_blocks(entries: DataFrame, n: int) -> tuple[DataFrame, int]:
    """``(block, w0 .. w3)``: blocks of 256 bits in which each key of ``entries`` has set four bits; and their number."""
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n) * BITS_PER_KEY / (64 * WORDS))))
    bits = entries.select("key").withColumns({"block": F.expr(f"pmod(xxhash64(key), {blocks})"), **_probe("key")})
    return bits.groupBy("block").agg(*[F.bit_or(f"m{j}").alias(f"w{j}") for j in range(WORDS)]), blocks


def _possible(rows: DataFrame, key: str, entries: DataFrame, n: int) -> DataFrame:
    """The rows whose ``key`` may be among the ``n`` keys of ``entries(key)``: all that are, and few others."""
    columns = rows.columns
    blocks, count = bloom_blocks(entries, n)
    d = rows.withColumns({"block": F.expr(f"pmod(xxhash64({key}), {count})"), **_probe(key)}).join(_sized(blocks, 48 * count), "block")
    for j in range(WORDS):
        d = d.where(F.col(f"w{j}").bitwiseAND(F.col(f"m{j}")) == F.col(f"m{j}"))
    return d.select(*columns)


def judge(pages: DataFrame, entries: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """The columns of ``pages`` with host, path, rule and verdict for each row.

    ``entries(host, path, verdict, is_rule)`` lists canonical URL prefixes. One
    fits its host and all subdomains if the URL's path starts with its path.
    Among rules the longest wins (then the longer host, then block); without a
    rule the longest other entry decides and rule is null; without either the
    verdict is ``default``. A null URL, or one without ``://``, has an empty host
    and path and the default verdict. Repeated rows give repeated results;
    columns of ``pages`` named like a result are replaced.
    """
    e = entries.where("host is not null and path is not null").select("host", "path", "verdict", "is_rule").distinct()
    shape = e.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.count("*").alias("n"), F.coalesce(F.sum(F.length("host") + F.length("path") + 64), F.lit(0)).alias("bytes"), F.count_distinct("host").alias("hosts")).first()
    out = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    if not shape["n"]:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in sorted(shape["labels"])]))
    tried = out.where("host <> ''").select("host", "path", F.explode(suffixes).alias("site"))
    tried = _possible(tried, "site", e.select(F.col("host").alias("key")).distinct(), shape["hosts"])
    sites = e.groupBy(F.col("host").alias("site")).agg(F.collect_set(F.length("path")).alias("lengths"))
    tried = tried.join(_sized(sites, shape["bytes"]), "site")
    tried = tried.select("host", "path", "site", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n")).select("host", "path", "site", F.expr("substring(path, 1, n)").alias("prefix"))
    tried = _possible(tried.withColumn("key", F.concat("site", "prefix")), "key", e.select(F.concat("host", "path").alias("key")).distinct(), shape["n"])
    hits = tried.join(_sized(e.select(F.col("host").alias("site"), F.col("path").alias("prefix"), "verdict", "is_rule"), shape["bytes"]), ["site", "prefix"])
    rank = F.struct("is_rule", F.length("key").alias("chars"), F.length("site").alias("host_chars"), (F.col("verdict") == "block").alias("block"), "key", "verdict")
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    best = best.select("host", "path", F.when(F.col("best.is_rule"), F.col("best.key")).alias("rule"), F.col("best.verdict").alias("verdict"))
    return out.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
