"""URL filters with DataFrame functions only.

A table of listed URLs is put into a blocked Bloom filter: one 64-bit block per key holds all its
bits. The filter has at most `max_blocks` rows of 16 bytes whatever the list's length, so it can be
broadcast; a fuller filter only lets more false positives through. What passes the filter meets the
list in an exact hash join, which removes them. Rows that do not pass are not shuffled at all.

Rules name a host and a path; a rule fits its host and all subdomains where the URL's path starts
with the rule's, and the longest fitting rule (host plus path; then host) decides before the list.

Null URLs and URLs without `://` have an empty host and path and fit no rule; they are never listed.
Repeated pages are judged alike. An empty list lists nothing. Columns of the pages pass through;
result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillrank.llm.tables import fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 18
PROBES = 4


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _part(url: Column, group: int) -> Column:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return _part(url, 2)


def canonical(host_of: Column, path_of: Column) -> Column:
    """Host without a leading `www.` or `m.`, path without `.html` and trailing slashes; null without a host."""
    bare = F.regexp_replace(host_of, r"^(www|m)\.", "")
    return F.when(host_of != "", F.concat(bare, F.regexp_replace(path_of, r"(\.html)?/*$", "")))


def decide(rules: Sequence[Rule], host_of: Column, path_of: Column) -> tuple[Column, Column]:
    """The fitting rule's text and verdict; nulls if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last condition put around the others is tested first: the longest rule.
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = (host_of == rule.host) | F.endswith(host_of, F.lit("." + rule.host))
        fits = fits & F.startswith(path_of, F.lit(rule.path))
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(hashed, F.lit(blocks))


def _mask(hashed: Column) -> Column:
    """PROBES bits of a 64-bit block, each from six other bits of the hash."""
    rest = F.xxhash64(hashed)
    mask = F.lit(0).cast("bigint")
    for i in range(PROBES):
        place = F.shiftrightunsigned(rest, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row (block, bits) for each block in use; `blocks` rows at most."""
    hashed = _hash(F.col(key))
    return (listed.select(_block(hashed, blocks).alias("_block"), _mask(hashed).alias("_bit"))
            .groupBy("_block").agg(F.bit_or("_bit").alias("_bits")))


def listed_flag(pages: DataFrame, listed: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """`pages` with a BOOLEAN `listed`: whether the page's `key` is in `listed` (one column `key`).

    Null keys are not listed.
    """
    names = [c for c in pages.columns if c.lower() != "listed"]
    hashed, same, there = fresh(pages.columns, "h", "key", "found")
    wanted = listed.select(key).where(F.col(key).isNotNull()).distinct()
    blocks = min(max_blocks, max(1, wanted.count() * BITS_PER_KEY // 64))
    bits = bloom_filter(wanted, key, blocks)
    block, mask = fresh(pages.columns, "block", "bits")
    bits = bits.select(F.col("_block").alias(block), F.col("_bits").alias(mask))
    out = [F.col(f"`{c}`") for c in names]
    probed = pages.select(*out).withColumn(hashed, _hash(F.col(key))).join(
        F.broadcast(bits), _block(F.col(hashed), blocks) == F.col(block), "left")
    passes = F.col(key).isNotNull() & (F.coalesce(F.col(mask), F.lit(0)).bitwiseAND(_mask(F.col(hashed)))
                                       == _mask(F.col(hashed)))
    missed = probed.where(~passes).select(*out, F.lit(False).alias("listed"))
    exact = wanted.select(F.col(key).alias(same), F.lit(True).alias(there))
    hits = probed.where(passes).select(*out).join(exact, F.col(key) == F.col(same), "left")
    return missed.unionByName(hits.select(*out, F.col(there).isNotNull().alias("listed")))


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url",
                 max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """`pages` with host, path, rule and verdict: the rule's, else `block` for listed URLs, else `allow`.

    `listed` has one column `canonical`.
    """
    made = ("host", "path", "canonical", "rule", "verdict", "listed")
    names = [c for c in pages.columns if c.lower() not in made or c == url]
    cut = pages.select(*[F.col(f"`{c}`") for c in names], host(F.col(url)).alias("host"),
                       path(F.col(url)).alias("path"))
    cut = cut.withColumn("canonical", canonical(F.col("host"), F.col("path")))
    text, verdict = decide(rules, F.col("host"), F.col("path"))
    flagged = listed_flag(cut, listed, "canonical", max_blocks)
    return flagged.withColumn("rule", text).withColumn(
        "verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")))
