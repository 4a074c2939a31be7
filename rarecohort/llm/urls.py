"""URL filters: rules by host and path, and a cascade of Bloom filters for exact membership.

Built-in expressions only.  Level 1 of a cascade encodes the listed keys; level
2 the other keys of the corpus that level 1 lets through; level 3 the listed
keys that level 2 lets through; and so on until none is left.  The first level
that rejects a key decides, and for every key of the corpus it decides right.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarecohort.sources.staging import checkpoint

#: Bits of one filter at most (2 MB); keys beyond it are split into groups by hash, one cascade each.
MAX_BITS = 1 << 24
#: Share of foreign keys that the first and the later levels let through.
FIRST_RATE, LATER_RATE = 1 / 16, 1 / 2


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or url."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def fits(host: Column, path: Column, rule: str) -> Column:
    """A rule ``host/path`` fits its host and all subdomains, under its path."""
    own, slash, start = rule.partition("/")
    return ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]], part: int) -> Column:
    """Text (part 1) or verdict (part 0) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        out = F.when(fits(host, path, rule[1]), rule[part]).otherwise(out)
    return out


def _bit(key: Column, level: int, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(bits))


class BloomFilter:
    """Words of 64 bits in one array of a one-row table, read back as a scalar subquery."""

    def __init__(self, keys: DataFrame, count: int, rate: float, level: int):
        self.hashes = max(1, round(math.log2(1 / rate)))
        bits = math.ceil(count * self.hashes / math.log(2))
        self.bits, self.level = 64 * max(1, math.ceil(bits / 64)), level
        place = F.explode(F.array(*[_bit(F.col("key"), level, k, self.bits) for k in range(self.hashes)]))
        words = (
            keys.select(place.alias("p"))
            .groupBy(F.expr("p div 64").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v"))
        )
        every = keys.sparkSession.range(self.bits // 64).join(words, F.col("id") == F.col("w"), "left")
        filled = F.struct("id", F.coalesce("v", F.lit(0)).cast("bigint").alias("v"))
        ordered = F.transform(F.array_sort(F.collect_list(filled)), lambda x: x["v"])
        self.table = checkpoint(every.agg(ordered.alias("words")))

    def might_hold(self, key: Column) -> Column:
        words = self.table.scalar()
        tests = []
        for k in range(self.hashes):
            p = _bit(key, self.level, k, self.bits)
            word = F.get(words, F.shiftright(p, 6).cast("int"))
            tests.append(F.getbit(word, (p % 64).cast("int")) == 1)
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


class Cascade:
    """Exact membership of ``listed`` keys, for all keys of ``universe``."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        """Both have one column ``key``, distinct and not null; ``listed`` is a part of ``universe``."""
        self.levels: list[BloomFilter] = []
        inside, outside = listed, universe.join(listed, "key", "left_anti")
        inside, outside = checkpoint(inside), checkpoint(outside)
        count, rate = inside.count(), FIRST_RATE
        while count:
            level = BloomFilter(inside, count, rate, len(self.levels) + 1)
            self.levels.append(level)
            passed = checkpoint(outside.filter(level.might_hold(F.col("key"))))
            inside, outside = passed, inside
            count, rate = inside.count(), LATER_RATE

    def holds(self, key: Column) -> Column:
        """True where the number of levels passed in a row is odd."""
        out = F.lit(len(self.levels) % 2 == 1)
        for depth in reversed(range(len(self.levels))):
            out = F.when(self.levels[depth].might_hold(key), out).otherwise(depth % 2 == 1)
        return out


def _groups(listed: int, universe: int) -> int:
    """Groups of keys in which no filter is above ``MAX_BITS``, by the level that takes most.

    The first level holds the listed keys, the second the first one's false positives among all others.
    Hashing deals keys unevenly and rates vary, so a tenth is left free.
    """
    first = listed * round(math.log2(1 / FIRST_RATE)) / math.log(2)
    second = (universe - listed) * FIRST_RATE * round(math.log2(1 / LATER_RATE)) / math.log(2)
    return max(1, math.ceil(max(first, second) / (0.9 * MAX_BITS)))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict: the longest rule's, else block for a listed host, else allow.

    ``listed`` has one column of hosts (lower case); it may hold repeats, nulls
    and hosts that no page has.  Rules are (verdict, ``host/path``) pairs.  A
    null url, or one without ``://``, has an empty host and path, fits no rule and
    is allowed unless the empty host is listed.  Repeated rows are judged alike,
    an empty list or table is none to filter, and the four results replace
    columns of those names.

    The keys are the corpus's distinct hosts.  If a filter would be above ``MAX_BITS``, be it of
    listed keys or of false positives, the keys are split by hash into groups with a cascade each; each group reads the url column once.
    """
    host, path = split_url(F.col(url))
    judged = pages.withColumns({"host": host, "path": path})
    judged = judged.withColumns(
        {"rule": longest_rule(F.col("host"), F.col("path"), rules, 1), "verdict": longest_rule(F.col("host"), F.col("path"), rules, 0)}
    )
    universe = checkpoint(pages.select(host.alias("key")).distinct())
    wanted = listed.toDF("key").filter(F.col("key").isNotNull()).distinct()
    inside = checkpoint(universe.join(wanted, "key", "left_semi"))
    groups = _groups(inside.count(), universe.count())
    out = None
    for g in range(groups):
        def part(df: DataFrame, key: str, g=g) -> DataFrame:
            return df.filter(F.pmod(F.xxhash64(key), F.lit(groups)) == g) if groups > 1 else df

        cascade = Cascade(part(inside, "key"), part(universe, "key"))
        verdict = F.when(cascade.holds(F.col("host")), "block").otherwise("allow")
        done = part(judged, "host").withColumn("verdict", F.coalesce("verdict", verdict))
        out = done if out is None else out.unionByName(done)
    return out


# --- fixed values of the registered query ------------------------------------------------
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
SPAM_WORDS = ["casino", "pills", "bets", "win", "adult", "xxx", "loan", "viagra"]
# -----------------------------------------------------------------------------------------


def spam_hosts(pages: DataFrame, url: str = "url") -> DataFrame:
    """The list of the registered query: hosts of which a word between dots or hyphens is a spam word."""
    host, _ = split_url(F.col(url))
    return pages.select(host.alias("host")).filter(F.rlike("host", F.lit(rf"(^|[.-])({'|'.join(SPAM_WORDS)})([.-]|$)"))).distinct()


def digest(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url"), spam_hosts(pages), RULES).select("page_id", "host", "path", "rule", "verdict")
