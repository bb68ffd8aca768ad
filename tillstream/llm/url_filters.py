"""URL filters: a few host and path rules, and a list of canonical URLs of any length.

A rule decides where one fits. The rest is looked up in the list: a blocked Bloom filter
(blocks of 512 bits, one bit in each of a block's eight words) lets possible hits through
to an exact join with the list, which removes false positives. So only the few rows that
pass the filter are shuffled with their URLs. SQL functions only.

The filter takes 16 to 32 bits for each listed URL. Up to BROADCAST_BLOCKS blocks (9 MB) it
is sent to all tasks; a larger one is joined by block number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.stage import own_names, stored

URL_PARTS = "://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS, URLS_PER_BLOCK = 8, 32
BROADCAST_BLOCKS = 1 << 17
COLUMNS = ("host", "path", "rule", "verdict")
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """Holds for a host and all its subdomains, for paths that begin with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without default port and last dot, path without last slashes; null without a host.

    Scheme, query and fragment don't count.
    """
    plain = F.regexp_replace(host, r"\.?(:(80|443)?)?\z", "")
    return F.when(plain != "", F.concat(plain, F.regexp_replace(path, r"/+\z", "")))


def rule_for(host: Column, path: Column, rules: Sequence[Rule], take: str) -> Column:
    """The `take` field of the longest rule that fits, of equally long ones that of the longest host; else null.

    Rules become one expression: they are meant to be tens, the list takes the millions.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, getattr(rule, take)).otherwise(found)
    return found


def block_of(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks).cast("long"))


def bits_of(url: Column) -> list[Column]:
    """One bit for each word of the URL's block, six bits of a second hash for each."""
    hashed = F.xxhash64(url, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def blocks_for(urls: int) -> int:
    return 1 << max(0, (urls - 1) // URLS_PER_BLOCK).bit_length()


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """block, w0 to w7 of the blocks in which a bit is set; combined before the shuffle."""
    url = F.col("listed")
    words = [F.bit_or(bit).alias(f"w{i}") for i, bit in enumerate(bits_of(url))]
    return listed.groupBy(block_of(url, blocks).alias("block")).agg(*words)


def with_verdicts(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Add `host`, `path`, `rule` and `verdict` to every row, in place of columns named so.

    `listed` has one column of canonical URLs to block, repeats and nulls allowed. Without
    a rule a page is blocked if its canonical URL is listed, else allowed; so are null
    URLs and those without `://`, whose host and path are empty. Rows are neither dropped
    nor merged. A URL that holds a third of all rows is split by adaptive execution, since
    the list's side of the join has it once.
    """
    known = stored(listed.select(F.col(listed.columns[0]).alias("listed")).where("listed is not null").distinct(), "listed-urls")
    blocks = blocks_for(known.count())
    bloom = bloom_filter(known, blocks)
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)
    host, path = host_of(F.col(f"row.{url}")), path_of(F.col(f"row.{url}"))
    parted = pages.select(F.struct("*").alias("row")).select("row", host.alias("host"), path.alias("path"))
    ruled = parted.select(
        "*",
        rule_for(F.col("host"), F.col("path"), rules, "name").alias("rule"),
        rule_for(F.col("host"), F.col("path"), rules, "verdict").alias("verdict"),
        canonical(F.col("host"), F.col("path")).alias("canonical"),
    )
    asked = ruled.withColumn("block_asked", F.when(F.col("verdict").isNull(), block_of(F.col("canonical"), blocks)))
    joined = asked.join(bloom, F.col("block_asked") == F.col("block"), "left")
    hit = reduce(and_, [F.col(f"w{i}").bitwiseAND(bit) != 0 for i, bit in enumerate(bits_of(F.col("canonical")))])
    possible = F.coalesce(F.col("canonical").isNotNull() & F.col("block").isNotNull() & hit, F.lit(False))
    judged = [*[F.col(c) for c in ("row", "host", "path", "rule")]]
    clear = joined.where(~possible).select(*judged, F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"))
    exact = joined.where(possible).select(*judged, "canonical").join(known, F.col("canonical") == F.col("listed"), "left")
    proven = exact.select(*judged, F.when(F.col("listed").isNotNull(), BLOCK).otherwise(ALLOW).alias("verdict"))
    rest = own_names(pages, COLUMNS).columns
    return clear.unionByName(proven).select(*[F.col(f"row.`{c}`").alias(c) for c in rest], *COLUMNS)


def urls_of_blocked_hosts(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Canonical URLs of all pages of hosts of which rules block at least half of the pages."""
    parted = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).where("host <> ''")
    verdict = rule_for(F.col("host"), F.col("path"), rules, "verdict")
    hosts = parted.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if(verdict == BLOCK).alias("blocked"))
    known = parted.select("host", canonical(F.col("host"), F.col("path")).alias("listed")).distinct()
    return known.join(hosts.where("2 * blocked >= n").select("host"), "host", "left_semi").select("listed")
