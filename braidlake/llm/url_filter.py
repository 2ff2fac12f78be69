"""URL filters: rules by host and path, then a list of URLs behind a blocked Bloom filter.

The list may be long. Its canonical URLs set bits in a filter of 512-bit blocks; a URL touches one
block only, one bit in each of its eight words. The filter never exceeds ``most_blocks`` rows, so it
can always be broadcast; a longer list makes it pass more, not miss any. What passes goes to an exact
join on the whole canonical URL, which removes the false positives.

Everything is built-in functions. Rules are matched by an expression over the list of rules, which is
for dozens to a thousand of them.

Results for odd input: a NULL URL or one without ``://`` has an empty host and path, fits no rule, is not
listed and is allowed; URLs of any length count in full; repeated rows and repeated entries of the
list make no difference; between rules of the same length the alphabetically first text wins;
other columns are not read; an empty table or list is fine.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^.*?://[^?#]*\?([^#]*)"
TRACKING = r"(?:^|&)(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules(*lines: str) -> list[Rule]:
    """From lines such as ``block example.org/es/``."""
    out = []
    for line in lines:
        verdict, _, place = line.partition(" ")
        host, slash, path = place.partition("/")
        out.append(Rule(verdict, host, slash + path))
    return out


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host and path without scheme, port, ``www.``, closing slash, tracking parameters and fragment."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(?:80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", "/"), r"/+$", "")
    rest = F.regexp_replace(F.regexp_replace(F.coalesce(F.regexp_extract(url, QUERY, 1), F.lit("")), TRACKING, ""), "^&", "")
    return F.when(host == "", F.lit(None)).otherwise(F.concat(host, path, F.when(rest == "", "").otherwise(F.concat(F.lit("?"), rest))))


def matching_rule(host: Column, path: Column, listed: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (text, verdict); NULL if none does."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(listed, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


# ---------------------------------------------------------------- the filter
WORDS = 8


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    """6 bits of a second hash for each word."""
    return F.shiftrightunsigned(F.xxhash64(key), 6 * word).bitwiseAND(F.lit(63)).cast("int")


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0 .. w7): at most ``blocks`` rows of 512 bits."""
    words = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col(key), w))).alias(f"w{w}") for w in range(WORDS)]
    return listed.groupBy(_block(F.col(key), blocks).alias("block")).agg(*words)


def blocks_for(n: int, bits_per_key: int = 16, most_blocks: int = 1 << 15) -> int:
    """Blocks for n keys; 2 MB of bits at most."""
    return max(1, min(most_blocks, -(-n * bits_per_key // 512)))


def judge(pages: DataFrame, rule_list: Sequence[Rule], listed: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed); ``listed`` has one column ``url`` of blocked URLs."""
    url = F.col("url").cast("string")
    entries = listed.select(canonical(F.col("url")).alias("entry")).filter("entry is not null").distinct()
    blocks = blocks_for(entries.count())
    bits = F.broadcast(bloom(entries, "entry", blocks))
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    key = F.col("canonical")
    passes = _block(key, blocks) == F.col("block")
    for w in range(WORDS):
        passes = passes & (F.getbit(F.col(f"w{w}"), _bit(key, w)) == 1)
    # The exact join tells true hits; a popular listed URL makes a large left side only.
    hits = rows.join(bits, passes, "left_semi").join(
        entries.withColumn("found", F.lit(True)), F.col("canonical") == F.col("entry"), "left"
    )
    rest = rows.join(bits, passes, "left_anti").withColumn("found", F.lit(False))
    columns = ["page_id", "host", "path", "found"]
    both = hits.select(*columns).union(rest.select(*columns)).withColumn("found", F.coalesce("found", F.lit(False)))
    return both.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rule_list)).select(
        "page_id", "host", "path", F.col("fit.text").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("found"), "block").otherwise("allow")).alias("verdict"),
        F.col("found").alias("listed"),
    )
