"""Document fingerprints from prefix polynomial hashes.

P[i] is the sum of c_j * r^j over the first i code points, modulo a prime.  Any
span has the hash (P[b] - P[a]) * r^-a, the same wherever it stands, so spans
are compared in constant time and a common extension is found by binary search.
A fingerprint keeps the hashes of prefixes and suffixes on a grid of 32 steps.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: (prime, base) of the two hashes.
MODULI = [((1 << 31) - 1, 1_000_003), ((1 << 31) - 19, 998_244_353 % ((1 << 31) - 19))]
GRID = 32
#: Ranges of doc_id per shuffle partition.
RANGES = 4
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64) for _ in MODULI]


def _powers(k: int, n: int) -> np.ndarray:
    prime, base = MODULI[k]
    have = _POWERS[k]
    while len(have) < n:
        have = np.concatenate((have, have * np.uint64(pow(base, len(have), prime)) % np.uint64(prime)))
    _POWERS[k] = have
    return have


class PrefixHash:
    """Prefix arrays of a text; positions are code points."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums = []
        for k, (prime, _) in enumerate(MODULI):
            sums = np.zeros(self.n + 1, np.uint64)
            # Terms below 2^31: no text of less than 2^33 code points overflows.
            np.cumsum(codes * _powers(k, self.n)[: self.n] % np.uint64(prime), out=sums[1:])
            self.sums.append(sums)

    def span(self, a: int, b: int) -> tuple[int, int]:
        """Hash of the code points a to b, end exclusive; equal for equal spans of any texts."""
        out = []
        for (prime, base), sums in zip(MODULI, self.sums):
            out.append((int(sums[b]) - int(sums[a])) * pow(base, -a, prime) % prime)
        return out[0], out[1]

    def common(self, a: int, other: PrefixHash, b: int) -> int:
        """Code points that are equal from ``a`` here and from ``b`` there on."""
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(a, a + middle) == other.span(b, b + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def fingerprint(self) -> str:
        """``length.step.hash.prefixes.suffixes`` in hex: eight digits for each step of the grid."""
        step = 1
        while self.n > GRID * step:
            step *= 2
        marks = range(step, self.n + 1, step)
        prime, base = MODULI[0]
        sums = self.sums[0]
        heads = "".join(f"{int(sums[m]) % prime:08x}" for m in marks)
        # r^-(n - m) for all marks from one inverse.
        back, turn = [], pow(base, step, prime)
        inverse = pow(base, -(self.n - step), prime) if len(marks) else 0
        for m in marks:
            back.append(f"{(int(sums[self.n]) - int(sums[self.n - m])) * inverse % prime:08x}")
            inverse = inverse * turn % prime
        one, two = self.span(0, self.n)
        return f"{self.n:x}.{step:x}.{one:08x}{two:08x}.{heads}.{''.join(back)}"


def _marks(marks: str, own: int, step: int) -> list[int]:
    """Hashes at multiples of ``step``, from a grid of ``own``; the first is of nothing."""
    width = 8 * (step // own)
    return [0] + [int(marks[i - 8 : i], 16) for i in range(width, len(marks) + 1, width)]


def _extension(xs: list[int], ys: list[int]) -> int:
    """Steps of the longest common extension, by binary search: marks agree up to its end and not behind."""
    low, high = 0, min(len(xs), len(ys)) - 1
    while low < high:
        middle = (low + high + 1) // 2
        if xs[middle] == ys[middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _equal_blocks(xs: list[int], ys: list[int], turn: int) -> list[int]:
    """Steps whose blocks are equal: those of the common extension, and of the rest by differences of marks."""
    reach, prime = _extension(xs, ys), MODULI[0][0]
    rest = range(reach, min(len(xs), len(ys)) - 1)
    return [*range(reach), *(i for i in rest if (xs[i + 1] - xs[i] * turn - ys[i + 1] + ys[i] * turn) % prime == 0)]


def likeness(x: str, y: str) -> float:
    """Blocks of the coarser grid that are equal, as a part of the longer text; 1 for equal texts.

    The longest common prefix and suffix on the grid are found by binary search; behind
    them, blocks are compared at equal distances from the start, and from the end.
    A fingerprint has at most GRID marks a side, so a text's length does not matter.
    """
    if x == y:
        return 1.0
    (n, s, _, *xs), (m, t, _, *ys) = x.split("."), y.split(".")
    n, s, m, t = (int(v, 16) for v in (n, s, m, t))
    if not min(n, m):
        return 0.0
    step, (prime, base) = max(s, t), MODULI[0]
    # A longer suffix mark is its block and the shorter one, moved by a step.
    turns = (1, pow(base, step, prime))
    equal = [[i * step for i in _equal_blocks(_marks(xs[k], s, step), _marks(ys[k], t, step), turns[k])] for k in (0, 1)]

    def covered(length: int) -> int:
        """Code points of a text of that length in equal blocks, each counted once."""
        total = end = 0
        for a in sorted([*equal[0], *(length - i - step for i in equal[1])]):
            total += max(0, a + step - max(a, end))
            end = a + step
        return total

    return min(covered(n), covered(m)) / max(n, m)


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above the id, by two levels of comparisons."""
    if not bounds:
        return F.lit(0)
    width = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= doc_id))

    outer = at_most(F.lit([r[0] for r in rows]))
    inner = at_most(F.get(F.array(*[F.lit(r) for r in rows]), outer - 1))
    return F.when(doc_id.isNull() | (outer == 0), 0).otherwise((outer - 1) * width + inner)


def with_next(docs: DataFrame, work, schema: T.StructType) -> DataFrame:
    """Streams the texts in the order of doc_id through tasks, each with its successor; the last one's is the first.

    ``work(doc_id, text, state, next_text, next_state)`` makes a row, where
    ``state`` is what ``work.prepare(text)`` made of a text.  Ranges of ids are dealt to
    tasks, and the first row of each range goes to the range before as well, so
    texts are shuffled once.  Null ids come first, ties are ordered by text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = [(k + 1) / (RANGES * parts) for k in range(RANGES * parts - 1)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * len(cuts)))).first()[0]
    bounds = sorted(set(found or []))
    ranged = docs.withColumn("range", _range_of(F.col("doc_id"), bounds))
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), F.col("doc_id").alias("id"))).alias("f")
    # One row a range; ranges are as many as tasks.
    starts = sorted((r["range"], r["f"]["id"]) for r in ranged.groupBy("range").agg(first).collect())
    before = [(r, i, starts[k - 1][0]) for k, (r, i) in enumerate(starts)]
    peeks = spark.createDataFrame(before, T.StructType([T.StructField("range", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("before", T.IntegerType())]))
    own = F.struct(F.col("range"), F.lit(0).alias("peek"))
    ahead = F.struct(F.col("before").alias("range"), F.lit(1).alias("peek"))
    goes = F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.array(own, ahead)).otherwise(F.array(own))
    rows = ranged.join(F.broadcast(peeks), "range").select("doc_id", "text", F.explode(goes).alias("g")).select("g.range", "g.peek", "doc_id", "text")
    dealt = rows.repartition(parts, "range").sortWithinPartitions("range", "peek", "doc_id", "text")
    arrow = to_arrow_schema(schema)

    def run(batches):
        pending = None
        for batch in batches:
            out = []
            for rng, peek, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if peek and (pending is None or pending[0] != rng):
                    continue  # a later row of a tie at the start of the next range
                state = work.prepare(text)
                if pending and pending[0] == rng:
                    out.append(work(*pending[1:], text, state))
                pending = None if peek else (rng, doc_id, text, state)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return dealt.mapInArrow(run, schema)


class _Compared:
    def prepare(self, text: str) -> str:
        return PrefixHash(text).fingerprint()

    def __call__(self, doc_id: int, text: str, own: str, after: str, after_own: str) -> dict:
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        changed = PrefixHash(edited).fingerprint()
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": own,
            "edited_fingerprint": changed,
            "near_edited": likeness(own, changed),
            "near_next": likeness(own, after_own),
        }


def digest(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document.

    Null counts as empty; the next of the only document is itself; documents of
    one id follow each other by text, and repeated rows are rows of their own.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    return with_next(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), _Compared(), schema)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``fingerprint``; null texts have that of the empty text."""

    @F.pandas_udf("string")
    def of(column: pd.Series) -> pd.Series:
        return column.map(lambda t: PrefixHash(t or "").fingerprint())

    return docs.withColumn("fingerprint", of(F.coalesce(F.col(text), F.lit(""))))


def longest_extensions(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Adds ``common_prefix``: equal code points at the start of two text columns; null counts as empty."""
    @F.pandas_udf("bigint")
    def of(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([PrefixHash(s).common(0, PrefixHash(t), 0) for s, t in zip(x, y)], dtype="int64")

    return pairs.withColumn("common_prefix", of(F.coalesce(F.col(a), F.lit("")), F.coalesce(F.col(b), F.lit(""))))
