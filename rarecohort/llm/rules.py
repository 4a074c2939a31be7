"""Quality rules as a short-circuit cascade of column expressions.

A rule fails a document by counts of its text.  A sample tells how many
documents each rule rejects and how long it takes alone; the rules then run in
the order of rejections per cost among what the earlier ones left, and a
document that failed one is not looked at by the later ones.  The order
changes what is computed, never which documents stay.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that settle the order, and the share of rows that they are drawn from.
SAMPLE_ROWS, SAMPLE_SHARE = 2000, 0.05
#: Seconds that a rule counts for at least, so that timer noise does not order cheap rules.
LEAST_COST = 0.02

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
#: From its first letter to the end of a word; characters beyond ASCII pass as letters.
_LETTER_WORD = r"[A-Za-z\x{80}-\x{10FFFF}][^\x20\x09-\x0D]*"


@dataclass(frozen=True)
class Feature:
    """A count or list of a text, from the text ``t`` or from other features by their names."""

    make: Callable[[], Column]
    needs: tuple[str, ...] = ()


def _count(pattern: str) -> Callable[[], Column]:
    return lambda: F.regexp_count("t", F.lit(pattern)).cast("bigint")


def _windows() -> Column:
    """64-bit hashes of all runs of three words."""

    def window(i: Column) -> Column:
        return F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))

    return F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).otherwise(F.array().cast("array<bigint>"))


def _ordered() -> Column:
    """Hash and place of each window by hash; empty if no hash is found twice."""
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct("windows")) < F.size("windows"), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeated() -> Column:
    """Places, ascending, of the windows found twice or more."""
    at = F.transform("ordered", lambda x, k: F.when((x["h"] == F.get("ordered", k - 1)["h"]) | (x["h"] == F.get("ordered", k + 1)["h"]), x["i"]))
    return F.sort_array(F.filter(at, lambda i: i.isNotNull()))


def _covered() -> Column:
    """Words in those windows: each adds the words up to the next one, three at most."""
    gaps = F.transform("repeated", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("repeated", k + 1) - p, F.lit(3))))
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)


FEATURES: dict[str, Feature] = {
    "words": Feature(lambda: F.filter(F.split("t", f"{_SPACE}+"), lambda w: w != "")),
    "n_words": Feature(lambda: F.size("words").cast("bigint"), ("words",)),
    "word_chars": Feature(lambda: F.char_length(F.array_join("words", "")).cast("bigint"), ("words",)),
    "n_symbols": Feature(_count("[#*$%&|<>]")),
    "lines": Feature(lambda: F.filter(F.split("t", "\n"), lambda x: x.rlike(_WORD))),
    "n_lines": Feature(lambda: F.size("lines").cast("bigint"), ("lines",)),
    "n_dup_lines": Feature(lambda: (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"), ("lines",)),
    "n_bullets": Feature(lambda: F.size(F.filter("lines", lambda x: x.rlike(rf"^{_SPACE}*[-*•]"))).cast("bigint"), ("lines",)),
    "n_ellipses": Feature(lambda: F.size(F.filter("lines", lambda x: x.rlike(rf"(?:\.\.\.|…){_SPACE}*\z"))).cast("bigint"), ("lines",)),
    "n_letter_words": Feature(_count(_LETTER_WORD)),
    "n_letters": Feature(_count("[A-Za-z]")),
    "n_capitals": Feature(_count("[A-Z]")),
    "n_shouts": Feature(_count("!")),
    "windows": Feature(_windows, ("words",)),
    "ordered": Feature(_ordered, ("windows",)),
    "repeated": Feature(_repeated, ("ordered",)),
    "n_repeat_words": Feature(_covered, ("repeated",)),
}


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition on the features it needs."""

    name: str
    fails: Callable[[], Column]
    needs: tuple[str, ...]


def _c(name: str) -> Column:
    return F.col(name)


#: The two base rules.
BASE = [
    Rule("few_words", lambda: _c("n_words") < 50, ("n_words",)),
    Rule("repeats", lambda: 100 * _c("n_repeat_words") > 50 * _c("n_words"), ("n_repeat_words", "n_words")),
]
#: Thresholds of published web-text filters, for lines and letters somewhat wider.
RULES = BASE + [
    Rule("symbols", lambda: 10 * _c("n_symbols") > _c("n_words"), ("n_symbols", "n_words")),
    Rule("word_length", lambda: (_c("word_chars") < 3 * _c("n_words")) | (_c("word_chars") > 10 * _c("n_words")), ("word_chars", "n_words")),
    Rule("dup_lines", lambda: 2 * _c("n_dup_lines") > _c("n_lines"), ("n_dup_lines", "n_lines")),
    Rule("bullets", lambda: 10 * _c("n_bullets") > 9 * _c("n_lines"), ("n_bullets", "n_lines")),
    Rule("ellipses", lambda: 10 * _c("n_ellipses") > 3 * _c("n_lines"), ("n_ellipses", "n_lines")),
    Rule("no_letters", lambda: 10 * _c("n_letter_words") < 8 * _c("n_words"), ("n_letter_words", "n_words")),
    Rule("capitals", lambda: 2 * _c("n_capitals") > _c("n_letters"), ("n_capitals", "n_letters")),
    Rule("shouts", lambda: 10 * _c("n_shouts") > 3 * _c("n_words"), ("n_shouts", "n_words")),
]


def _missing(names: tuple[str, ...], have: set[str]) -> list[str]:
    """Features to add for some others, what they need first."""
    out: list[str] = []
    for name in names:
        if name not in have and name not in out:
            out += [n for n in _missing(FEATURES[name].needs, have) if n not in out] + [name]
    return out


def _with(df: DataFrame, names: tuple[str, ...], have: set[str], unless: Column | None = None) -> DataFrame:
    """Adds features, one projection each, so that a list is made once however often it is read."""
    for name in _missing(names, have):
        made = FEATURES[name].make()
        df = df.withColumn(name, made if unless is None else F.when(unless, made))
        have.add(name)
    return df


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """The row as one column, whatever its names, and its text."""
    return docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))


def measure(docs: DataFrame, rules: list[Rule], text: str = "text") -> tuple[list[list[bool]], list[float]]:
    """Per sampled row the verdicts of all rules, and the seconds of each rule alone.

    ``take`` reads partitions until it has SAMPLE_ROWS rows, so a large table is
    not scanned; only booleans reach the driver.  Each rule is timed by its second run, less
    that of reading the same texts.
    """
    sampled = _texts(docs, text).sample(SAMPLE_SHARE, seed=11)

    def plan(*chosen: Rule) -> DataFrame:
        df, have = sampled, set()
        for rule in chosen:
            df = _with(df, rule.needs, have)
        return df.select(*[F.coalesce(r.fails(), F.lit(False)).alias(r.name) for r in chosen] or [F.length("t") < 0])

    def seconds(df: DataFrame) -> float:
        df.take(SAMPLE_ROWS)
        start = time.perf_counter()
        df.take(SAMPLE_ROWS)
        return time.perf_counter() - start

    verdicts = [list(r) for r in plan(*rules).take(SAMPLE_ROWS)]
    reading = seconds(plan())
    return verdicts, [max(seconds(plan(rule)) - reading, LEAST_COST) for rule in rules]


def best_order(verdicts: list[list[bool]], costs: list[float]) -> list[int]:
    """Rules by rejections per cost, each among the rows that those before it left; ties as given."""
    left, order, rest = verdicts, [], list(range(len(costs)))
    while rest:
        best = max(rest, key=lambda k: (sum(v[k] for v in left) / costs[k], -k))
        order.append(best)
        rest.remove(best)
        left = [v for v in left if not v[best]]
    return order


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", always: tuple[str, ...] = (), ordered: bool = False) -> DataFrame:
    """(row, .. ``always``, failed_rule): the row as a struct, and the first rule that fails it.

    Rules run in the order that a sample suggests, or as given if ``ordered``.  Which rows
    fail does not depend on it; the name in failed_rule does.  The features of ``always``
    are made for every row, all others only for rows that no earlier rule failed.

    Null and empty texts have no words, lines or symbols.  Repeated rows are judged one by
    one; an empty table gives an empty one; columns of any name stay inside ``row``.  A text is
    held as lists of its words, windows and lines, so a task's memory grows with its
    longest text.  Windows are compared by 64-bit hashes: two of a million in a text agree by chance
    with probability 3e-8.
    """
    rules = RULES if rules is None else rules
    if not ordered and rules:
        rules = [rules[k] for k in best_order(*measure(docs, rules, text))]
    have: set[str] = set()
    df = _with(_texts(docs, text), always, have).withColumn("failed_rule", F.lit(None).cast("string"))
    for rule in rules:
        df = _with(df, rule.needs, have, F.col("failed_rule").isNull())
        df = df.withColumn("failed_rule", F.when(F.col("failed_rule").isNull(), F.when(rule.fails(), rule.name)).otherwise(F.col("failed_rule")))
    # Not deterministic by name: else a later filter on failed_rule would be pushed below the
    # projections and make each list anew for every element that is read from it.
    held = F.when(F.monotonically_increasing_id() >= 0, F.col("failed_rule")).alias("failed_rule")
    return df.select("row", *always, held)


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows that no rule fails, with the columns of ``docs``."""
    return apply_rules(docs, rules, text).filter("failed_rule IS NULL").select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    """The check columns: base counts of every document and the verdict of all rules."""
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = apply_rules(docs.select("doc_id", "text"), always=base)
    failed = BASE[0].fails() | BASE[1].fails()
    return judged.select("row.doc_id", *base, failed.alias("base_failed"), (~failed & F.col("failed_rule").isNull()).alias("kept"))
