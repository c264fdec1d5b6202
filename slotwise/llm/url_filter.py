"""URL filters: rules on hosts and paths, then a list of hosts held as a cascade of Bloom filters.

Native: DataFrame operations only.

The list is exact on the corpus. All keys that occur in it are known, so the first filter encodes the listed ones, the
second those of the others that pass the first by mistake, the third those of the listed ones that pass the second, until
no mistake is left. A key is listed if the first filter it fails is an even one. Rows meet the filters as scalar
subqueries, arrays of 64-bit words: no join and no shuffle of the rows. The filters' size is known before they are used;
above CASCADE_BITS the rows are joined to the listed keys instead, with the same result.

Cases: a null url, and one without `://`, has an empty host and path, and no rule fits it. Rows are judged one by one;
repeated rows stay. An empty table, and an empty list, give a cascade without filters, which lists nothing. Only page_id
and url are read. Of two rules that fit, the longer one counts, by host and path together, then by host, then a block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stage, whole

#: (verdict, host, path)
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Hosts with one of these words between dots and hyphens make the list of the query.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "poker", "porn", "spam", "track", "xxx")
LISTED = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most bits of a cascade that rows meet as subqueries: 32 MB.
CASCADE_BITS = 1 << 28
#: Rows of a filter's table: words of 64 bits.
WORD_BITS = 64


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    ranked = sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r[0] == "block"))
    for verdict, rule_host, rule_path in ranked:  # the last one asked is the longest
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass(frozen=True)
class Bloom:
    """One filter: rows (word, bits) of a table in the shared folder."""

    words: DataFrame
    bits: int
    hashes: int
    level: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.level), F.lit(i), key), F.lit(self.bits).cast("long")) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        """Whether all bits of the key are set; the words are one array, a subquery that is computed once."""
        table = self.words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"])).scalar()
        out = F.lit(True)
        for place in self.places(key):
            word = F.get(table, F.shiftright(place, 6).cast("int"))
            out = out & (F.getbit(word, place.bitwiseAND(WORD_BITS - 1).cast("int")) == 1)
        return out


@dataclass(frozen=True)
class Cascade:
    levels: list[Bloom]

    @property
    def bits(self) -> int:
        return sum(x.bits for x in self.levels)

    def lists(self, key: Column) -> Column:
        """Whether the key is listed; exact for the keys the cascade was built from."""
        out = F.lit(len(self.levels) % 2 == 1)
        for depth, level in reversed([*enumerate(self.levels)]):
            out = F.when(~level.passes(key), F.lit(depth % 2 == 1)).otherwise(out)
        return out


def bloom(keys: DataFrame, n: int, rate: float, level: int) -> Bloom:
    """Filter of n keys that lets others pass with about this chance."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(WORD_BITS, math.ceil(n * hashes / math.log(2) / WORD_BITS) * WORD_BITS)
    made = Bloom(keys, bits, hashes, level)
    places = keys.select(F.explode(F.array(*made.places(F.col("key")))).alias("place"))
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    # Words without a bit are rows too: the array has no gaps.
    zeros = keys.sparkSession.range(bits // WORD_BITS).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    return Bloom(stage(words.unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits")), "bloom"), bits, hashes, level)


def labelled_keys(corpus: DataFrame, listed: DataFrame) -> DataFrame:
    """key, listed: the distinct keys of the corpus. One aggregation; a hot key is one row per task in it."""
    rows = corpus.select("key", F.lit(True).alias("seen"), F.lit(False).alias("listed")).unionByName(
        listed.select("key", F.lit(False).alias("seen"), F.lit(True).alias("listed"))
    )
    flags = rows.filter("key is not null").groupBy("key").agg(F.bool_or("seen").alias("seen"), F.bool_or("listed").alias("listed"))
    return flags.filter("seen").select("key", "listed")


def expected_bits(listed: int, others: int) -> float:
    """About what a cascade takes: the first filter, and what follows, a few bits for each listed key."""
    return listed * (max(1, -math.log2(first_rate(listed, others))) / math.log(2) + 8) if listed else 0


def first_rate(listed: int, others: int) -> float:
    """The first filter lets about as many others pass as there are listed keys."""
    return min(0.5, math.sqrt(0.5) * listed / others) if others else 0.5


def cascade(keys: DataFrame) -> Cascade:
    """The cascade of a table (key, listed) of distinct keys. Eager: a stage for each level, about half as large each time."""
    encoded, opposed = (keys.filter(F.col("listed") == side).select("key") for side in (True, False))
    n, others, levels = encoded.count(), opposed.count(), []
    rate = first_rate(n, others)
    while n:
        levels.append(bloom(encoded, n, rate, len(levels)))
        encoded, opposed = stage(opposed.filter(levels[-1].passes(F.col("key"))), "passing"), encoded
        n, rate = encoded.count(), 0.5
    return Cascade(levels)


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, most_bits: int = CASCADE_BITS) -> DataFrame:
    """page_id, host, path, rule, verdict: the rule's verdict, else block for listed hosts and allow for the others.

    `listed` has a column `key`. Eager: builds the cascade.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keys = stage(labelled_keys(rows.select(F.col("host").alias("key")), listed), "url-keys")
    n = keys.agg(F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("others")).first()
    if expected_bits(n["listed"], n["others"]) <= most_bits:
        own = cascade(keys).lists(F.col("host"))
    else:
        found = keys.filter("listed").select(F.col("key").alias("_key"))
        rows, own = rows.join(found, F.col("host") == F.col("_key"), "left"), F.col("_key").isNotNull()
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("found"), own.alias("own"))
    method = F.when(F.col("own"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", method).alias("verdict"))


def listed_hosts(pages: DataFrame, pattern: str = LISTED) -> DataFrame:
    """key: the hosts of the table that the pattern finds."""
    hosts = pages.select(host_of(F.col("url")).alias("key")).distinct()
    return hosts.filter(F.col("key").rlike(pattern))
