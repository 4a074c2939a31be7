"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Built-in expressions only.  A text is split at the matches of a pattern, so
that the lengths of the pieces give the places of the matches in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: kinds in the order of digests, and their patterns --------------------
# Equal to the plain patterns: possessive parts never give back what the rest could use, and a
# run that failed at its first character is not tried again at the others, which keeps the
# time in proportion to the text.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Length of the IBANs of each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_COUNTRIES = "|".join(IBAN_LENGTHS.values())
_BOUNDED = "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+" for n, c in IBAN_LENGTHS.items())
_BOUNDED = rf"(?:{_BOUNDED})(?![A-Za-z0-9])"
# Countries without a known length take what follows, but no IBAN of a known one.
IBAN = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_BOUNDED}|(?!{_COUNTRIES})[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]|\x20(?!{_BOUNDED})[A-Z0-9]){{11,30}}+(?![A-Za-z0-9]))"
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban"]
#: Score of a confirmed span, what a context word near it adds, and how far it may be.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "address|host|server|ip",
    "card": "card|visa|credit|pay",
    "phone": "phone|call|tel|fax|mobile",
    "iban": "iban|account|bank|transfer",
}
CONTEXT_BONUS = 0.1
CONTEXT_CHARS = 40
# ----------------------------------------------------------------------------------------
#: Sums that are taken in one go.
_SUMMED = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    places = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + F.lit(1), F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(places, F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces leaves the rest 1."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        digit = code < 58
        return (rest * F.when(digit, 10).otherwise(100) + code - F.when(digit, 48).otherwise(55)) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _confirm(kind: str, s: Column) -> Column:
    if kind == "ip":
        parts = F.split(s, r"\.")
        return F.forall(parts, lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return _let(_digits(s), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    if kind == "iban":
        return _let(F.replace(s, F.lit(" "), F.lit("")), lambda t: F.when(F.length(t).between(15, 34), mod97(t)).otherwise(False))
    return F.lit(True)


_PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN}
_SPAN = "array<struct<kind:string,start:bigint,end:bigint,text:string,score:double>>"


def _running(sizes: Column) -> Column:
    """Sums of an array up to each element, by blocks, so that no long array is copied at each element."""

    def blocks_of(sizes: Column) -> Column:
        count = F.ceil(F.size(sizes) / F.lit(_SUMMED)).cast("int")
        return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(sizes, k * _SUMMED + 1, _SUMMED))

    def add(sums: Column, x: Column) -> Column:
        return F.concat(sums, F.array(F.element_at(sums, -1) + x))

    zero = F.array(F.lit(0).cast("bigint"))
    inner = F.transform(_let(sizes, blocks_of), lambda b: F.aggregate(b, zero, add))

    def shifted(blocks: Column) -> Column:
        bases = F.aggregate(blocks, zero, lambda sums, b: add(sums, F.element_at(b, -1)))
        moved = lambda base: F.transform(blocks, lambda b, i: F.transform(F.slice(b, 2, _SUMMED), lambda x: x + F.get(base, i)))
        return F.flatten(_let(bases, moved))

    return _let(inner, shifted)


def _spans(text: Column, kind: str) -> Column:
    """Confirmed matches of a kind; all steps take time in proportion to the text."""
    pattern = F.lit(_PATTERNS[kind])

    def span(pairs: Column, ends: Column, i: Column) -> Column:
        pair, end = F.get(pairs, i), F.get(ends, i)
        s = pair["s"]
        around = F.concat(F.right(pair["p"], F.lit(CONTEXT_CHARS)), F.lit(" | "), F.left(F.get(pairs, i + 1)["p"], F.lit(CONTEXT_CHARS)))
        bonus = F.when(F.rlike(around, F.lit(rf"(?i)\b(?:{CONTEXT[kind]})")), CONTEXT_BONUS).otherwise(0.0)
        made = F.struct(
            F.lit(kind).alias("kind"),
            (end - F.length(s)).alias("start"),
            end.alias("end"),
            s.alias("text"),
            F.least(F.round(F.lit(SCORES[kind]) + bonus, 3), F.lit(1.0)).alias("score"),
        )
        return F.when(_confirm(kind, s), made)

    def placed(pairs: Column) -> Column:
        # The piece after the last match has none.
        sizes = F.transform(pairs, lambda x: (F.length(x["p"]) + F.coalesce(F.length(x["s"]), F.lit(0))).cast("bigint"))
        places = F.sequence(F.lit(0), F.size(pairs) - 2)
        return F.filter(_let(_running(sizes), lambda ends: F.transform(places, lambda i: span(pairs, ends, i))), lambda x: x.isNotNull())

    def walk(found: Column) -> Column:
        pairs = F.zip_with(found, F.split(text, pattern, -1), lambda s, p: F.struct(s.alias("s"), p.alias("p")))
        return F.when(F.size(found) > 0, _let(pairs, placed)).otherwise(F.array().cast(_SPAN))

    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), walk)


def find_pii(docs: DataFrame, text: str = "text", min_score: float = 0.0) -> DataFrame:
    """Adds ``pii``: spans (kind, start, end, text, score) by kind, then start, in code points.

    ``min_score`` leaves out weaker spans.  A context word within CONTEXT_CHARS before or
    after a span, but not beyond the next match of its kind, raises its score.  Null and empty texts have none.
    Matches of a kind do not overlap, those of two kinds may; a match that fails
    its check is dropped and what it covers is not searched again.  Rows are
    judged one by one, so repeated rows, ties and empty tables need no rule;
    ``pii`` replaces a column of that name and other columns pass through.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    spans = F.concat(*[_spans(body, k) for k in KINDS])
    return docs.withColumn("pii", F.filter(spans, lambda s: s["score"] >= min_score))


def redact(docs: DataFrame, text: str = "text", min_score: float = 0.0) -> DataFrame:
    """The documents with each found span replaced by its kind in brackets; each replacement copies the text so far."""
    found = find_pii(docs, text, min_score)
    # Overlapping spans of two kinds: the one that starts first, then the longer one, wins.
    order = F.array_sort(
        F.transform("pii", lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), s["kind"].alias("kind")))
    )
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        kept = F.substr(F.col(text), (state["at"] + 1).cast("int"), (s["a"] - state["at"]).cast("int"))
        return F.when(
            s["a"] >= state["at"],
            F.struct((-s["b"]).alias("at"), F.concat(state["out"], kept, F.lit("["), s["kind"], F.lit("]")).alias("out")),
        ).otherwise(state)

    def end(state: Column) -> Column:
        return F.concat(state["out"], F.substr(F.col(text), (state["at"] + 1).cast("int")))

    return found.withColumn(text, F.when(F.col(text).isNotNull(), F.aggregate(order, empty, step, end))).drop("pii")


def _joined(spans: Column) -> Column:
    written = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(written, ",")


def digest(found: DataFrame) -> DataFrame:
    """The check columns of :func:`find_pii`."""
    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["kind"].isin(BASE_KINDS))
    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans")
    )
