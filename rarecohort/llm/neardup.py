"""MinHash near-duplicates with sequential Bayesian verification.

1. Each document becomes a set of hashed word shingles; equal sets are one class.
2. A class has a MinHash signature, cut into bands; classes with an equal band are
   candidates.  Inside each bucket every class is paired with the smallest one,
   so a bucket of n classes gives n - 1 pairs.
3. The signatures of a pair are compared batch by batch.  A pair is dropped as
   soon as, given the matches so far, its similarity reaches the threshold with
   less than the chosen probability.  The survivors are verified on full sets.
4. Buckets whose classes are not yet in one component get all their remaining
   pairs compared, in blocks inside tasks, so that no link inside a bucket is
   lost; only links that merge two components leave a task.
5. Components of the verified links.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarecohort.llm.graph import components
from rarecohort.llm.texts import NON_SPACE, Words, fresh, map_texts, mix, shingles, slices
from rarecohort.sources.staging import checkpoint, stage

#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^26 < 1e-6.
BANDS, ROWS = 26, 4
HASHES = BANDS * ROWS
#: Signature values compared before a pair is judged again.
BATCH = 13
#: Chance that a pair at the threshold is dropped at one look.
MISS = 1e-7
#: Classes of a bucket that are compared in one block.
BLOCK = 1024
BLOCK_SHINGLES = 500_000
#: Classes (some 80 bytes each in a hash table) that are broadcast to pick texts; beyond it both sides are shuffled.
MAX_BROADCAST_IDS = 300_000
#: Side of the tiles in which a block is compared.
_TILE = 256

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_TERMS = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def least_matches(percent: int) -> list[tuple[int, int]]:
    """(values seen, matches needed) at each look.

    With a flat prior, P(similarity >= t | m of n equal) is
    P(Binomial(n + 1, t) <= m); below MISS the pair is dropped.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < MISS:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def signatures(docs: DataFrame, size: int, text: str, keep: list[str]) -> DataFrame:
    """Adds n_shingles, set_id (16 bytes that name the set) and signature (16-bit MinHash values)."""

    def work(batch: pa.RecordBatch) -> dict:
        words = Words(batch.column(batch.schema.get_field_index(text)), NON_SPACE)
        h, at = shingles(words, size)
        filled = np.flatnonzero(np.diff(at))
        x = (mix(h + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
        minima = np.empty((HASHES, len(filled)), np.uint16)
        if len(filled):
            for k in range(HASHES):
                y = x * _FACTORS[k] + _TERMS[k]
                y ^= y >> np.uint32(15)
                low = np.minimum.reduceat(y * np.uint32(0x2C1B3C6D), at[:-1][filled])
                minima[k] = (low ^ (low >> np.uint32(16))).astype(np.uint16)
        rows = np.ascontiguousarray(minima.T)
        n, ids, signs = [0] * len(batch), [None] * len(batch), [None] * len(batch)
        for j, r in enumerate(filled):
            own = np.sort(h[at[r] : at[r + 1]])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            n[r] = len(own)
            ids[r] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            signs[r] = rows[j].tobytes()
        return {"n_shingles": n, "set_id": ids, "signature": signs}

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_id", T.BinaryType()),
        T.StructField("signature", T.BinaryType()),
    ]
    return map_texts(docs, work, fields, text, keep)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def similar(a: np.ndarray, b: np.ndarray, looks: list[tuple[int, int]]) -> np.ndarray:
    """Rows of two equally long signature matrices that no look drops."""
    live, matches, seen = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, need in looks:
        matches = matches + (a[live, seen:n] == b[live, seen:n]).sum(axis=1)
        stay = matches >= need
        live, matches, seen = live[stay], matches[stay], n
    return live


def _prune(pairs: DataFrame, classes: DataFrame, looks: list[tuple[int, int]]) -> DataFrame:
    """Pairs (a, b) whose signatures pass all looks."""
    for side in ("a", "b"):
        own = classes.select(F.col("rep").alias(side), F.col("signature").alias(f"s{side}"))
        pairs = pairs.join(own, side)
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"]])

    def run(batches):
        for batch in batches:
            sa, sb = (_matrix(batch.column(batch.schema.get_field_index(c))) for c in ("sa", "sb"))
            live = pa.array(similar(sa, sb, looks))
            yield batch.select(["a", "b"]).take(live)

    return pairs.mapInArrow(run, schema)


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if not len(one) or not len(two) or 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
        return False
    both = np.sort(np.concatenate((one, two)))
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of which the full shingle sets reach the threshold, as edges (u, v)."""
    texts = _texts(docs, classes, pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("rep").alias(side), F.col("text").alias(f"t{side}")), side)

    def work(batch: pa.RecordBatch) -> dict:
        h, at = zip(*(shingles(Words(batch.column(batch.schema.get_field_index(c)), NON_SPACE), size) for c in ("ta", "tb")))
        out, known = [], None
        a = batch.column(batch.schema.get_field_index("a"))
        for r in range(len(batch)):
            if known is None or a[r] != known:  # pairs of a hot class often follow each other
                one, known = np.unique(h[0][at[0][r] : at[0][r + 1]]), a[r]
            two = np.unique(h[1][at[1][r] : at[1][r + 1]])
            out.append(linked(one, two, percent))
        return {"link": out}

    return map_texts(pairs, work, [T.StructField("link", T.BooleanType())], "ta", ["a", "b"]).filter("link").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _texts(docs: DataFrame, classes: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, text) of some classes, without a shuffle of all texts where they are few.

    A class is found by the id and the text's hash of the row that stands for it, since an id may have several texts.
    """
    wanted = checkpoint(classes.select("rep", "doc_id", "version").join(reps, "rep"))
    few = wanted.count() <= MAX_BROADCAST_IDS
    rows = docs.withColumn("version", F.xxhash64("text")).join(F.broadcast(wanted) if few else wanted, ["doc_id", "version"])
    return rows.select("rep", "text")


def _first_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first band in which the signatures of each row are equal."""
    return (a.reshape(-1, BANDS, ROWS) == b.reshape(-1, BANDS, ROWS)).all(axis=2).argmax(axis=1)


def _block_links(mixed: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links (u, v) that join the components of each bucket, as far as any pair of it is linked.

    A bucket is dealt into blocks of BLOCK classes and BLOCK_SHINGLES shingles on
    average; each class goes to the tasks of its block with every block.  All
    comparisons stay in those tasks, and a pair is compared in its first common
    bucket only.  A task keeps the components it knows of: it skips pairs inside
    one, and returns the links that merged two, fewer than it has classes.
    """
    looks = least_matches(percent)
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(7)), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = mixed.select("bucket", "band", "rep", "component", own.alias("own"), other.alias("other"))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")
    bodies = _texts(docs, classes, mixed.select("rep").distinct()).groupBy("rep").agg(F.min("text").alias("text"))
    rows = rows.join(classes.select("rep", "signature").join(bodies, "rep"), "rep")
    kind = mixed.schema["rep"].dataType
    schema = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rep, comp, own = (np.asarray(table[c]) for c in ("rep", "component", "own"))
        i, j, band = (table[c][0].as_py() for c in ("i", "j", "band"))
        signs = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, HASHES)
        text = table["text"].combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        sets = []
        for first, n in slices(text):
            h, at = shingles(Words(text.slice(first, n), NON_SPACE), size)
            sets += [np.unique(h[at[r] : at[r + 1]]) for r in range(n)]
        parent = {c: c for c in comp.tolist()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        left, right, links = np.flatnonzero(own == i), np.flatnonzero(own == j), []
        for p in range(0, len(left), _TILE):
            for q in range(0, len(right), _TILE):
                x, y = (v.ravel() for v in np.meshgrid(left[p : p + _TILE], right[q : q + _TILE], indexing="ij"))
                across = (comp[x] != comp[y]) & ((i != j) | (x < y))
                x, y = x[across], y[across]
                if not len(x):
                    continue
                live = similar(signs[x], signs[y], looks)
                live = live[_first_band(signs[x[live]], signs[y[live]]) == band]
                alike = (signs[x[live]] == signs[y[live]]).sum(axis=1)
                for k in live[np.argsort(-alike, kind="stable")]:
                    a, b = int(x[k]), int(y[k])
                    ra, rb = root(int(comp[a])), root(int(comp[b]))
                    if ra != rb and linked(sets[a], sets[b], percent):
                        parent[max(ra, rb)] = min(ra, rb)
                        links.append((int(rep[a]), int(rep[b])))
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    return rows.groupBy("bucket", "i", "j").applyInArrow(compare, schema)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row.

    Words are what is between white space, A-Z lower-cased; a document's set
    has its distinct runs of ``size`` words, or its whole sequence if it has fewer
    words.  Two documents are linked if 100 * |intersection| >= percent * |union|.
    component_id is the smallest doc_id that links lead to; the row of that id is kept.

    Null and empty texts, and those of white space only, have an empty set and are
    linked with nothing.  Rows that repeat a doc_id are versions of one document:
    each keeps its own n_shingles, and they share the component of all.  A row without
    doc_id is linked with nothing, has no component and is kept.  Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    looks = least_matches(percent)
    versions = docs.withColumn("version", F.xxhash64("text"))
    signed = stage(signatures(versions, size, "text", ["doc_id", "version"]), "signatures")
    filled = signed.filter("set_id IS NOT NULL AND doc_id IS NOT NULL")
    # A class is named by a number of its own; the smallest id stands for all documents of a set.
    classes = checkpoint(
        filled.groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "version", "signature", "n_shingles")).alias("x"))
        .select("set_id", "x.*", F.monotonically_increasing_id().alias("rep"))
    )
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substr("signature", b * 2 * ROWS + 1, F.lit(2 * ROWS)))))
    buckets = classes.select("rep", "n_shingles", band.alias("band", "bucket"))
    # Buckets of two or more classes; most have one.
    leaders = buckets.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).filter("n > 1")
    full = stage(buckets.join(leaders, "bucket"), "buckets")
    docs_of = docs.filter("doc_id IS NOT NULL")
    star = full.filter("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    edges = stage(_verify(checkpoint(_prune(star, classes, looks)), classes, docs_of, size, percent), "links")
    labels = checkpoint(components(edges))
    named = full.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "band", "rep", "n", "shingles", F.coalesce("component", "rep").alias("component"))
    named = stage(named, "named")
    split = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("bucket")
    mixed = named.join(split, "bucket")
    edges = edges.unionAll(stage(_block_links(mixed, classes, docs_of, size, percent), "links"))
    # A document with several versions can be in several sets; its id then links them.
    several = filled.groupBy("doc_id").agg(F.count_distinct("set_id").alias("sets")).filter("sets > 1").select("doc_id")
    twice = filled.select("doc_id", "set_id").join(several, "doc_id").join(classes.select("set_id", "rep"), "set_id").distinct()
    first = twice.groupBy("doc_id").agg(F.min("rep").alias("u"))
    labels = checkpoint(components(edges.unionAll(twice.join(first, "doc_id").select("u", F.col("rep").alias("v")))))
    of = classes.select("set_id", "rep", "doc_id").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    of = checkpoint(of.select("set_id", "component", "doc_id"))
    smallest = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "set_id").join(of.select("set_id", "component").join(smallest, "component"), "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without those that are not kept; all columns of ``docs`` and no other."""
    name = fresh(docs.columns, "gone")
    gone = stage(near_duplicates(docs, size, percent, text, doc_id).filter("NOT kept").select(F.col("doc_id").alias(name)), "gone")
    return docs.join(gone, F.col(doc_id).cast("bigint") == F.col(name), "left_anti")
