"""Masked pseudo-likelihood of documents under a bidirectional window network.

A token is a word.  Its key of 64 bits holds a group, made of the word's ending,
and digits, made of its hash.  The network sees the classes of the two words
before and the two after a token, and predicts the token from both sides: its
class first, which is the word itself for the most frequent ones and else the
group, and then one digit after the other.  The words that share all predicted
digits make a cell and split its probability by their exact counts in the corpus.
The sum of the logarithms over all tokens of a document is its score.

What is gathered grows with the corpus: every word is counted, and the number of
digits grows with the number of words.  The counts stay in Spark.  Tasks
get the shares of the TOP words as a broadcast; each other word
has less than 1 / TOP of all tokens, so that joining its occurrences has no hot key.

Every token takes part in training: each round masks a share of the tokens, and
together the rounds mask each token once.  Each task trains a copy on its
documents, the copies are averaged by tokens, and the average goes into the
next round.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarecohort.llm.texts import NON_SPACE, Words, fresh, map_texts, mix, slices
from rarecohort.sources.staging import stage

GROUP_BITS, DIGIT_BITS = 5, 5
GROUPS, DIGITS = 1 << GROUP_BITS, 1 << DIGIT_BITS
#: The most frequent tokens are classes of their own; the others of each group are one class.
OWN = 64
CLASSES = OWN + GROUPS
HIDDEN, SIDE = 16, 2
SLOTS = [*range(-SIDE, 0), *range(1, SIDE + 1)]
#: Digits are added until a cell holds this many different words on average at most.
CELL_WORDS, LEAST_DIGITS = 256, 2
#: Beginnings (group and digits so far) with a bias of their own; more share rows by hash.
ROWS = 1024
#: Words whose shares are broadcast, 16 bytes each; the others are joined.
TOP = 1 << 18
#: Shares are added up as whole numbers of this size, so that sums do not depend on order.
UNIT = 2.0**-32
#: Rounds of training; each predicts its own share of the tokens.
ROUNDS = 2
RATE, BATCH = 0.1, 8192
#: Logits are cut here, where their powers still fit.
HIGH = np.float32(60)
#: Added to probabilities before their logarithm is taken.
TINY = 1e-30
#: Tokens scored at once, weights in a row of an average, tasks averaged together first.
_CHUNK, _BLOCK, _SALTS = 4096, 16384, 64
#: Counts that a task holds before it passes them on.
_HELD = 4 << 20


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Key of each word (59 bits of its hash, then its group), and the n + 1 bounds of the rows."""
    words = Words(column, NON_SPACE)
    if not len(words.hashes):
        return np.empty(0, np.uint64), words.row_at
    last = words.low[words.ends - 1].astype(np.uint64)
    before = words.low[np.maximum(words.ends - 2, words.starts)].astype(np.uint64)
    group = mix(last * np.uint64(256) + before) % np.uint64(GROUPS)
    return words.hashes // np.uint64(GROUPS) * np.uint64(GROUPS) + group, words.row_at


def digits_for(words: int) -> int:
    """Digits to predict of a vocabulary of so many words."""
    n = LEAST_DIGITS
    while GROUPS * DIGITS**n * CELL_WORDS < words:
        n += 1
    return n


def digit(keys: np.ndarray, level: int) -> np.ndarray:
    """A digit of keys; it and the row below are the same in Spark's form, see ``_cell``."""
    return ((keys >> np.uint64(GROUP_BITS + DIGIT_BITS * level)) % np.uint64(DIGITS)).astype(np.int64)


def row_of(keys: np.ndarray, level: int) -> np.ndarray:
    """Row of the bias for the group and the digits before ``level``."""
    begin = keys & np.uint64((1 << GROUP_BITS + DIGIT_BITS * level) - 1)
    return ((begin if level < 2 else mix(begin)) % np.uint64(ROWS)).astype(np.int64)


def _shapes(depth: int) -> list[tuple]:
    shapes = [(len(SLOTS) * (CLASSES + 1), HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]
    for level in range(depth):
        shapes += [(GROUPS, HIDDEN), (DIGITS, HIDDEN), (HIDDEN, DIGITS)]
    return shapes


@dataclass
class WindowModel:
    """Weights, and the tables of bounded size that tasks need."""

    #: Sorted keys of the words that are classes, and their classes.
    own: np.ndarray
    own_class: np.ndarray
    depth: int
    weights: np.ndarray
    #: Logarithms of the next digit's shares by row, of each level, from counts; they are not trained.
    bias: list[np.ndarray]
    #: Sorted keys of the TOP words, and the logarithms of their shares of their cells in UNITs.
    top: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    top_share: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def parts(self) -> list[np.ndarray]:
        """Views of the weights: embeddings, shift, out, bias; then, of each digit, gates of groups and of the digit before, and out."""
        shapes = _shapes(self.depth)
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return [w.reshape(s) for w, s in zip(np.split(self.weights, cuts), shapes)]

    def classes(self, keys: np.ndarray) -> np.ndarray:
        at, found = _find(self.own, keys)
        result = OWN + (keys % np.uint64(GROUPS)).astype(np.int64)
        result[found] = self.own_class[at[found]]
        return result


@dataclass
class Trained:
    """A model, and (key, share) of all words of the corpus as a table."""

    model: WindowModel
    shares: DataFrame
    #: By group, the share of a word that the corpus does not hold.
    unseen: list[int]


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted table, and whether they are in it."""
    at = np.searchsorted(table, values)
    if not len(table):
        return at, np.zeros(len(values), bool)
    at = np.minimum(at, len(table) - 1)
    return at, table[at] == values


class _Counter:
    """Counts of 64-bit keys, merged by sorting."""

    def __init__(self):
        self.keys, self.counts, self.loose, self.merged = [], [], 0, 0

    def add(self, keys: np.ndarray) -> None:
        one, n = np.unique(keys, return_counts=True)
        self.keys.append(one)
        self.counts.append(n)
        self.loose += len(one)
        if self.loose > max(self.merged, _HELD // 4):
            self._merge()

    def _merge(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.diff(keys[order], prepend=~keys[order][:1]))
        self.keys, self.counts = [keys[order][first]], [np.add.reduceat(counts[order], first)]
        self.loose, self.merged = 0, len(first)

    def take(self, least: int = 0) -> pa.RecordBatch | None:
        """The counts so far as rows, if there are more keys than ``least``."""
        if self.merged + self.loose <= least:
            return None
        self._merge()
        keys, counts = self.keys[0].view(np.int64), self.counts[0]
        self.__init__()
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, n) of every word of the documents, counted in tasks before the shuffle."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        counter = _Counter()
        for batch in batches:
            column = batch.column(0)
            for first, rows in slices(column):
                found = tokens(column.slice(first, rows))[0]
                if len(found):
                    counter.add(found)
                full = counter.take(_HELD)
                if full is not None:
                    yield full
        rest = counter.take()
        if rest is not None:
            yield rest

    return docs.select(text).mapInArrow(run, schema).groupBy("key").agg(F.sum("n").alias("n"))


def _cell(depth: int) -> F.Column:
    """Group and predicted digits of a key."""
    return F.col("key").bitwiseAND(F.lit((1 << GROUP_BITS + DIGIT_BITS * depth) - 1))


def word_shares(words: DataFrame, own: list[int], depth: int) -> DataFrame:
    """(key, n, share): log of each word's part of its cell in UNITs; one more count a cell is left for unseen words.

    A word that is a class has the share 0 (it is alone) and is not counted in its cell.
    """
    named = F.col("key").isin(own)
    cell = F.sum(F.when(named, 0).otherwise(F.col("n"))).over(Window.partitionBy("cell"))
    share = F.when(named, 0.0).otherwise(F.log(F.col("n") / (F.col("total") + 1)))
    counted = words.withColumn("cell", _cell(depth)).withColumn("total", cell)
    return counted.select("key", "n", F.round(share / UNIT).cast("long").alias("share"))


def new_model(words: DataFrame, depth: int | None = None) -> WindowModel:
    """Classes of the most frequent words, biases from counts, and small random weights."""
    depth = digits_for(words.count()) if depth is None else depth
    top = words.orderBy(F.desc("n"), "key").limit(OWN).collect()
    keys = np.array([r.key for r in top], np.int64).view(np.uint64)
    order = np.argsort(keys)
    draw = np.random.default_rng(7)
    weights = [draw.normal(0, 0.1, s).astype(np.float32) for s in _shapes(depth)]
    weights[1][:] = 0
    mass = np.zeros(CLASSES)
    mass[: len(top)] = [r.n for r in top]
    rest, bias = words.filter(~F.col("key").isin([r.key for r in top])), []
    for level in range(depth):
        weights[4 + 3 * level] += 1
        count = np.full((min(ROWS, GROUPS * DIGITS**level), DIGITS), 0.01)
        # Sums by row and digit, at most ROWS * DIGITS of them.
        for r in _masses(rest, level).toLocalIterator():
            if level == 0:
                mass[OWN + r.row] += r.n
            count[r.row, r.digit] += r.n
        bias.append(np.log(count / count.sum(axis=1, keepdims=True)).astype(np.float32))
    weights[3][:] = np.log(np.maximum(mass, 0.01) / max(mass.sum(), 1))
    return WindowModel(keys[order], order, depth, np.concatenate([w.ravel() for w in weights]), bias)


def _masses(words: DataFrame, level: int) -> DataFrame:
    """(row, digit, n): tokens by row of the bias and next digit."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("row", "digit", "n")])

    def run(batches):
        total = np.zeros(ROWS * DIGITS, np.int64)
        for batch in batches:
            keys = np.asarray(batch.column(0)).view(np.uint64)
            np.add.at(total, row_of(keys, level) * DIGITS + digit(keys, level), np.asarray(batch.column(1)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at // DIGITS), pa.array(at % DIGITS), pa.array(total[at])], names=schema.names)

    return words.select("key", "n").mapInArrow(run, schema).groupBy("row", "digit").agg(F.sum("n").alias("n"))


def _windows(classes: np.ndarray, row_at: np.ndarray) -> np.ndarray:
    """Rows of the embeddings for the classes at the SLOTS around each token; CLASSES beyond the ends of its document."""
    n, out = len(classes), np.full((len(SLOTS), len(classes)), CLASSES, np.int16)
    left, right = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    left[row_at[:-1]], right[row_at[1:]] = True, True
    for k, d in enumerate(SLOTS):
        a = abs(d)
        if n > a:
            out[k, a:] = classes[: n - a]
            if d > 0:
                out[k] = CLASSES
                out[k, : n - a] = classes[a:]
        # The first tokens of a document have nobody before them, the last nobody behind.
        for step in range(a):
            edge = row_at[:-1] + step if d < 0 else row_at[1:] - 1 - step
            inside = (edge < row_at[1:]) & (edge >= row_at[:-1])
            out[k, edge[inside]] = CLASSES
        out[k] += k * (CLASSES + 1)
    return out


def _hidden(parts: list[np.ndarray], near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Softsign of the sum of the neighbours' embeddings, and its slope."""
    x = parts[0].take(near[0], axis=0)
    for k in range(1, len(SLOTS)):
        x += parts[0].take(near[k], axis=0)
    x += parts[1]
    slope = 1 / (1 + np.abs(x))
    x *= slope
    return x, slope * slope


def _softmax(x: np.ndarray, out: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the logits x @ out + bias, and their sums."""
    p = x @ out
    p += bias
    np.exp(np.minimum(p, HIGH, out=p), out=p)
    return p, p @ np.ones(p.shape[1], np.float32)


def _error(p: np.ndarray, total: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    """Gradient of the mean cross-entropy of n tokens by the logits, in the place of their powers."""
    p *= (1 / (total * np.float32(n)))[:, None]
    p[np.arange(len(p)), target] -= np.float32(1 / n)
    return p


def _gate(parts: list[np.ndarray], keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a level's group and digit before let through of the hidden units; group and digit."""
    group = (keys % np.uint64(GROUPS)).astype(np.int16)
    before = digit(keys, level - 1).astype(np.int16) if level else np.zeros(len(keys), np.int16)
    at = 4 + 3 * level
    return parts[at].take(group, axis=0) + parts[at + 1].take(before, axis=0), group, before


def log_probabilities(model: WindowModel, keys: np.ndarray, row_at: np.ndarray) -> np.ndarray:
    """log P(cell of the token | both sides) of every token; of a word that is a class, of the word."""
    parts, classes = model.parts(), model.classes(keys)
    near, result = _windows(classes, row_at), np.empty(len(keys))
    # No chunk goes over two documents: a product's rounding depends on the place in it, and equal texts score alike.
    for start, end in zip(row_at, row_at[1:]):
        for a in range(start, end, _CHUNK):
            b = min(a + _CHUNK, end)
            h, _ = _hidden(parts, near[:, a:b])
            p, total = _softmax(h, parts[2], parts[3])
            odds = p[np.arange(b - a), classes[a:b]].astype(float) / total + TINY
            some = np.flatnonzero(classes[a:b] >= OWN)
            if len(some):
                h, key = h[some], keys[a:b][some]
                for level in range(model.depth):
                    bias = model.bias[level].take(row_of(key, level), axis=0)
                    q, total = _softmax(h * _gate(parts, key, level)[0], parts[6 + 3 * level], bias)
                    odds[some] *= q[np.arange(len(some)), digit(key, level)].astype(float) / total + TINY
            result[a:b] = np.log(odds)
    return result


class Trainer:
    """Adagrad on the cross-entropy of masked tokens."""

    def __init__(self, model: WindowModel):
        self.model = replace(model, weights=model.weights.copy())
        self.parts = self.model.parts()
        self.squares = replace(model, weights=np.full(len(model.weights), 1e-7, np.float32)).parts()
        self.seen = 0

    def _move(self, k: int, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        """A step of one part, or of some of its rows, to which the gradients of equal rows add up."""
        if rows is None:
            self.squares[k] += gradient * gradient
            self.parts[k] -= RATE * gradient / np.sqrt(self.squares[k])
            return
        order = np.argsort(rows, kind="stable")
        first = np.flatnonzero(np.diff(rows[order], prepend=-1))
        gradient, rows = np.add.reduceat(gradient.take(order, axis=0), first), rows[order][first]
        self.squares[k][rows] += gradient * gradient
        self.parts[k][rows] -= RATE * gradient / np.sqrt(self.squares[k][rows])

    def step(self, near: np.ndarray, target: np.ndarray, keys: np.ndarray) -> None:
        n = len(target)
        h, slope = _hidden(self.parts, near)
        p = _error(*_softmax(h, self.parts[2], self.parts[3]), target, n)
        back = p @ self.parts[2].T
        moves = [(2, h.T @ p, None), (3, np.ones(n, np.float32) @ p, None)]
        some = np.flatnonzero(target >= OWN)
        if len(some):
            seen, key, below = h.take(some, axis=0), keys[some], 0
            for level in range(self.model.depth):
                at = 4 + 3 * level
                gate, group, before = _gate(self.parts, key, level)
                gated, out = seen * gate, self.parts[at + 2]
                bias = self.model.bias[level].take(row_of(key, level), axis=0)
                q = _error(*_softmax(gated, out, bias), digit(key, level), n)
                through = q @ out.T
                below = below + through * gate
                through *= seen
                moves += [(at, through, group), (at + 1, through, before), (at + 2, gated.T @ q, None)]
            back[some] += below
        back *= slope
        self._move(1, back.sum(axis=0))
        for k in range(len(SLOTS)):
            self._move(0, back, near[k])
        for k, gradient, rows in moves:
            self._move(k, gradient, rows)

    def learn(self, keys: np.ndarray, row_at: np.ndarray, number: int) -> None:
        """One pass over the tokens of a round, which depend on the text alone."""
        classes = self.model.classes(keys)
        near = _windows(classes, row_at)
        drawn = mix(keys * np.uint64(1_000_003) + np.arange(len(keys), dtype=np.uint64))
        masked = np.flatnonzero(drawn % np.uint64(ROUNDS) == number)
        for a in range(0, len(masked), BATCH):
            at = masked[a : a + BATCH]
            self.step(near[:, at], classes[at], keys[at])
        self.seen += len(masked)


def _average(table: pa.Table) -> pa.Table:
    """The weighted mean of blocks of one place, as one block that keeps the sum of weights."""
    total = np.asarray(table["seen"]).astype(float)
    blocks = np.stack([np.frombuffer(b, np.float32) for b in table["part"].to_pylist()])
    whole = total.sum()
    mean = (blocks * (total / max(whole, 1e-9))[:, None]).sum(axis=0).astype(np.float32)
    return pa.table({"block": table["block"][:1], "salt": table["salt"][:1], "seen": [int(whole)], "part": [mean.tobytes()]})


def train_round(docs: DataFrame, model: WindowModel, text: str, number: int) -> WindowModel:
    """Each task's copy after its documents, averaged by the tokens they learnt from."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [("block", T.IntegerType()), ("salt", T.IntegerType()), ("seen", T.LongType()), ("part", T.BinaryType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches):
        trainer = Trainer(shared.value)
        for batch in batches:
            column = batch.column(0)
            for first, rows in slices(column):
                trainer.learn(*tokens(column.slice(first, rows)), number)
        if trainer.seen:
            w = trainer.model.weights
            parts = [w[k : k + _BLOCK].tobytes() for k in range(0, len(w), _BLOCK)]
            n, salt = len(parts), TaskContext.get().partitionId() % _SALTS
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([salt] * n, pa.int32()), pa.array([trainer.seen] * n), pa.array(parts, pa.binary())],
                names=schema.names,
            )

    copies = docs.select(text).mapInArrow(run, schema)
    some = copies.groupBy("block", "salt").applyInArrow(_average, schema)
    rows = some.groupBy("block").applyInArrow(_average, schema).orderBy("block").collect()
    shared.unpersist()
    if not rows:
        return model
    weights = np.concatenate([np.frombuffer(r["part"], np.float32) for r in rows])
    return replace(model, weights=weights)


def train(docs: DataFrame, text: str = "text", depth: int | None = None) -> Trained:
    """A model of all documents; of an empty table, one that knows only its random start."""
    words = stage(word_counts(docs, text), "words")
    model = new_model(words, depth)
    own = model.own.view(np.int64).tolist()
    shares = stage(word_shares(words, own, model.depth), "shares")
    for number in range(ROUNDS):
        model = train_round(docs, model, text, number)
    # At most TOP rows reach the driver, whatever the corpus holds.
    top = shares.orderBy(F.desc("n"), "key").limit(TOP).select("key", "share").toArrow()
    keys, share = np.asarray(top["key"]).view(np.uint64), np.asarray(top["share"])
    order = np.argsort(keys)
    mass = np.zeros(GROUPS)
    for r in shares.filter(~F.col("key").isin(own)).groupBy(_cell(0).alias("g")).agg(F.sum("n").alias("n")).collect():
        mass[r.g] = r.n
    unseen = np.round(-np.log(mass / DIGITS**model.depth + 1) / UNIT).astype(np.int64).tolist()
    return Trained(replace(model, top=keys[order], top_share=share[order]), shares, unseen)


def _lists(values: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    at = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values))


def score(docs: DataFrame, trained: Trained, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds n_tokens, pll (sum of log-probabilities) and pll_mean (per token).

    Null and empty texts have no tokens, a sum of 0 and a null mean.  Rows are scored one
    by one, so repeated rows score alike, and a tie of counts changes no share; of a very long
    text, one chunk of tokens is scored at a time.  A word that the corpus lacks
    takes one count in a mean cell of its group.  Extra columns pass, and results
    replace columns of their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained.model)
    named = [T.StructField("n_tokens", T.LongType()), T.StructField("pll", T.DoubleType()), T.StructField("pll_mean", T.DoubleType())]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in named}]
    names = {n: fresh(docs.columns, n) for n in ("net", "units", "rare", "row", "key", "others")}

    def work(batch: pa.RecordBatch) -> dict:
        keys, at = tokens(batch.column(batch.schema.get_field_index(text)))
        n = np.diff(at)
        row = np.repeat(np.arange(len(n)), n)
        place, found = _find(shared.value.top, keys)
        net, units, some = np.zeros(len(n)), np.zeros(len(n), np.int64), np.flatnonzero(n)
        if len(some):  # each row by itself, so that equal texts score alike
            net[some] = np.add.reduceat(log_probabilities(shared.value, keys, at), at[some])
            share = np.zeros(len(keys), np.int64)
            share[found] = shared.value.top_share[place[found]]
            units[some] = np.add.reduceat(share, at[some])
        rare = _lists(keys[~found].view(np.int64), row[~found], len(n))
        return {"n_tokens": pa.array(n), names["net"]: pa.array(net), names["units"]: pa.array(units), names["rare"]: rare}

    fields = [named[0], T.StructField(names["net"], T.DoubleType()), T.StructField(names["units"], T.LongType())]
    fields.append(T.StructField(names["rare"], T.ArrayType(T.LongType())))
    # Written once, so that a row keeps its number.
    parts = stage(map_texts(docs, work, fields, text, keep).withColumn(names["row"], F.monotonically_increasing_id()), "scored")
    words = parts.select(names["row"], F.explode(names["rare"]).alias(names["key"]))
    table = trained.shares.select(F.col("key").alias(names["key"]), F.col("share").alias(names["others"]))
    lost = F.element_at(F.array(*[F.lit(u) for u in trained.unseen]), (F.col(names["key"]).bitwiseAND(F.lit(GROUPS - 1)) + 1).cast("int"))
    others = F.coalesce(names["others"], lost)
    sums = words.join(table, names["key"], "left").groupBy(names["row"]).agg(F.sum(others).alias(names["others"]))
    whole = F.col(names["units"]) + F.coalesce(names["others"], F.lit(0))
    pll = F.when(F.col("n_tokens") == 0, 0.0).otherwise(F.col(names["net"]) + whole * UNIT)
    mean = F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens"))
    joined = parts.join(sums, names["row"], "left").withColumn("pll", pll).withColumn("pll_mean", mean)
    return joined.select(*[f"`{c}`" for c in keep], *[f.name for f in named])


def digest(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return score(docs, train(docs), keep=["doc_id"])
