"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees on one feature at a time fills a lookup table
per feature; then trees on pairs of features fill tables of pairs.  A score is a
sum of table entries, found by the bins of the features.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarecohort.llm.texts import NON_SPACE, Words, map_texts, utf8

#: Labelled rows that a model is fitted on at most; those of the smallest hashed ids.
MAX_SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 64, 12, 10
ROUNDS, PAIR_ROUNDS, RATE, SHRINK = 150, 60, 0.15, 2.0
#: A score from here on predicts label 1.
THRESHOLD = 0.3

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "longest_word", "upper", "digit", "stops", "symbols", "bars", "bangs",
    "lines", "distinct", "repeats", "short", "bare", "line_repeats", "high_bytes",
]
_LINE = np.ones(256, dtype=bool)
_LINE[[10, 13]] = False


def _class(codes: list[int] | range) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[list(codes)] = 1
    return table


_UPPER, _DIGIT, _HIGH = _class(range(65, 91)), _class(range(48, 58)), _class(range(128, 256))
_LETTER = _class([*range(65, 91), *range(97, 123), *range(128, 256)])
_STOP = _class([ord(c) for c in ".,;:?"])
_SYMBOL = _class([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?!|'\"()-"])
_BAR, _BANG, _NEWLINE = _class([ord("|")]), _class([ord("!")]), _class([10])


def feature_matrix(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text; an empty text has zeros."""
    data, at = utf8(column)
    words, lines = Words(column, NON_SPACE), Words(column, _LINE)
    size, n = np.diff(at).astype(float), words.counts().astype(float)

    def count(table: np.ndarray, ends: np.ndarray = at) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))[ends]).astype(float)

    def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[bounds]).astype(float)

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1)

    length = words.ends - words.starts
    letters = np.concatenate(([0], np.cumsum(_LETTER[data], dtype=np.int64)))
    bare = letters[words.ends] == letters[words.starts]
    again = np.zeros(len(length), dtype=bool)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    again[words.row_at[:-1][words.row_at[:-1] < len(again)]] = False
    longest, distinct, line_repeats = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
    for r in range(len(n)):
        a, b = words.row_at[r], words.row_at[r + 1]
        if a < b:
            longest[r] = length[a:b].max()
            h = np.sort(words.hashes[a:b])
            distinct[r] = 1 + (h[1:] != h[:-1]).sum()
            own = np.sort(lines.hashes[lines.row_at[r] : lines.row_at[r + 1]])
            line_repeats[r] = (own[1:] == own[:-1]).sum()
    made = [
        np.log1p(size), np.log1p(n), share(per_row(length, words.row_at), n), np.log1p(longest), share(count(_UPPER), count(_LETTER)),
        share(count(_DIGIT), size), share(count(_STOP), n), share(count(_SYMBOL), n), share(count(_BAR), n), share(count(_BANG), n),
        share(count(_NEWLINE), n), share(distinct, n), share(per_row(again, words.row_at), n), share(per_row(length <= 3, words.row_at), n),
        share(per_row(bare, words.row_at), n), share(line_repeats, lines.counts()), share(count(_HIGH), size),
    ]
    return np.stack(made, axis=1)


@dataclass
class AdditiveModel:
    """Tables of single features and of pairs; a few hundred KB at most."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[k], x[:, k], side="right")]
        coarse = {k: np.searchsorted(self.pair_edges[k], x[:, k], side="right") for k in {k for p in self.pairs for k in p}}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values at even ranks."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _steps(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The values of a tree with up to three leaves over ordered bins."""
    out = np.zeros(len(g))
    parts = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
                gs, hs = g[a:b].sum(), h[a:b].sum()
                gains = _gain(gl, hl) + _gain(gs - gl, hs - hl) - _gain(gs, hs)
                k = int(gains.argmax())
                if gains[k] > best[0]:
                    best = (gains[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SHRINK)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cross of two cuts over a table of bins."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    cg, ch = (np.cumsum(np.cumsum(x, axis=0), axis=1) for x in (g, h))

    def four(c: np.ndarray) -> list[np.ndarray]:
        a, row, col = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return [a, row - a, col - a, c[-1, -1] - row - col + a]

    fg, fh = four(cg), four(ch)
    gains = sum(_gain(x, y) for x, y in zip(fg, fh))
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    value = [x[i, j] / (y[i, j] + SHRINK) for x, y in zip(fg, fh)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gains[i, j]), out


def fit_matrix(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fits to rows of features and 0/1 labels; without rows, every score is 0.5."""
    if not len(y):
        return AdditiveModel()
    rate = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(base=float(np.log(rate / (1 - rate))))
    model.edges = [_edges(x[:, k], BINS) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, b in enumerate(bins):
            g, h = slopes()
            m = len(model.tables[k])
            step = RATE * _steps(np.bincount(b, g, m), np.bincount(b, h, m))
            model.tables[k] += step
            total += step[b]
    model.pair_edges = [_edges(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.pair_edges)]
    shape = [len(e) + 1 for e in model.pair_edges]

    def sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        at, m = coarse[a] * shape[b] + coarse[b], shape[a] * shape[b]
        return tuple(np.bincount(at, v, m).reshape(shape[a], shape[b]) for v in (g, h))

    gains = sorted(((_quarters(*sums(a, b))[0], (a, b)) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [p for gain, p in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            step = RATE * _quarters(*sums(a, b))[1]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> AdditiveModel:
    """Fits to the texts of labelled documents that are not held out, MAX_SAMPLE of them at most.

    Labels other than 0 and 1, null ids and ids without a document teach nothing;
    repeated labels count as often as they stand.
    """
    wanted = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    sample = wanted.orderBy(F.xxhash64("id"), "id", "y").limit(MAX_SAMPLE)
    # At most MAX_SAMPLE rows of two numbers.
    own = docs.select(F.col("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("doc_id", "y", "text")

    def work(batch: pa.RecordBatch) -> dict:
        x = feature_matrix(batch.column(batch.schema.get_field_index("text")))
        return {"x": pa.array(list(x), pa.list_(pa.float64()))}

    rows = map_texts(own, work, [T.StructField("x", T.ArrayType(T.DoubleType()))], keep=["doc_id", "y"])
    # Repeats of an id in documents could make more rows; the bound holds here too.
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(MAX_SAMPLE).collect()
    return fit_matrix(np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES)), np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, model: AdditiveModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds score (0 to 1) and predicted.

    Only the text counts.  Null and empty texts have the features of an empty text
    and a score as any other; repeated rows score alike; extra columns pass, and
    the two results replace columns of their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> dict:
        s = shared.value.score(feature_matrix(batch.column(batch.schema.get_field_index(text))))
        return {"score": pa.array(s), "predicted": pa.array((s >= THRESHOLD).astype(np.int32))}

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_texts(docs, work, fields, text, keep)


def accept(docs: DataFrame, model: AdditiveModel, text: str = "text") -> DataFrame:
    """The documents that are predicted 1, with their columns and no other."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> dict:
        return {None: shared.value.score(feature_matrix(batch.column(batch.schema.get_field_index(text)))) >= THRESHOLD}

    return map_texts(docs, work, [], text)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return score(docs, fit(docs, labels), keep=["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
