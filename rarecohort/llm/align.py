"""Alignment of two tokenizers of one text, as an Arrow pipeline.

A task takes one slice of texts at a time.  Distinct units (white space and the word
behind it) are encoded once; token lists are taken for all units, flattened,
and brought back to their documents by parent indices.  Cumulative sums of token bytes, counted
from each document's start, give the offsets where tokens end.  An outer hash join of both
sides on document and end gives the links: between two neighbouring ends, of
either side, one token of each side lies.  Ends that both sides have cut the groups.
Pairs are counted by ``Table.group_by`` in each slice, and Spark adds the partial counts.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarecohort.llm.texts import map_texts, utf8
from rarecohort.sources.staging import stage

#: Vocabularies of the registered query; paths on every executor.
BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Text that is aligned at once, or one longer text.
SLICE = 1 << 20
#: Distinct units of up to UNIT_BYTES that a task remembers the tokens of.
KNOWN_UNITS, UNIT_BYTES = 400_000, 64
#: Bytes of new units that are encoded as one text.
RUN_BYTES = 8 << 10
#: Pair counts (some 80 bytes each in a hash table) that are broadcast; more are joined by a shuffle.
MAX_BROADCAST_PAIRS = 1_000_000
#: Join keys over which the documents of one pair are spread in that shuffle.
SALTS = 16

PAIR = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())]))
FIELDS = [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")] + [
    T.StructField("groups_sha256", T.StringType()),
    #: Linked id pairs of the document, and on a slice's first row those of the whole slice.
    T.StructField("pairs", PAIR),
    T.StructField("slice_pairs", PAIR),
]
_SHIFT = 32
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
#: ASCII bytes that some pattern may take for white space besides.
_UNSURE = np.zeros(256, dtype=bool)
_UNSURE[28:32] = True


def _byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary: printable bytes stand for themselves, others are moved up from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


class ByteLevel:
    """A byte-level BPE, its ids and their bytes."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.encode_special_tokens = True
        of = _byte_alphabet()
        names = {i: t for t, i in self.encoder.get_vocab(with_added_tokens=True).items()}
        self.bytes = [bytes(of[c] for c in names.get(i, "")) for i in range(max(names) + 1)]

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encoder.encode_batch_fast(units, add_special_tokens=False)]

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        return self.encode(runs)


class Pieces:
    """A piece BPE with byte fallback that adds a space of its own."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.encoder = p = SentencePieceProcessor(model_file=path)
        size = p.get_piece_size()
        names = [p.id_to_piece(i) for i in range(size)]
        self.bytes = [bytes([int(n[3:5], 16)]) if p.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.space = p.piece_to_id("▁")
        self.lead = p.encode("a")
        texts = [n for i, n in enumerate(names) if not p.is_byte(i)]
        #: No piece spans a unit's end or the added space and other white space, so units can be encoded alone.
        self.splits = not any("▁" in n.lstrip("▁") or (len(n) > 1 and any(c in "\t\n\v\f" for c in n)) for n in texts)

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids of units that begin with white space; the space that the encoder adds is not doubled."""
        bare = [u[1:] if u[:1] == " " else u for u in units]
        out = self.encoder.encode(bare, num_threads=1)
        for k, unit in enumerate(units):
            if unit == " ":
                out[k] = [self.space]
            elif unit[0] != " ":
                out[k] = out[k][1:]
        return out

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        """Ids of joined units; a word in front takes the added space."""
        return [ids[len(self.lead) :] for ids in self.encoder.encode([f"a{r}" for r in runs], num_threads=1)]


def _strings(prefixes: list[str], n: int) -> list[str]:
    return [f"{p}{i}" for p in prefixes for i in range(n)]


class Aligner:
    """Both tokenizers with their vocabularies as Arrow arrays, and the units known so far."""

    def __init__(self, byte_path: str, piece_path: str):
        self.sides = ByteLevel(byte_path), Pieces(piece_path)
        self.splits = self.sides[1].splits
        self.vocabularies = [pa.array(s.bytes, pa.binary()) for s in self.sides]
        self.lengths = [np.array([len(b) for b in s.bytes], np.int64) for s in self.sides]
        na, nb = (len(s.bytes) for s in self.sides)
        #: How a token stands in the groups' text, by what comes before it.
        self.spelling = pa.array(_strings([";", ",", ""], na) + _strings(["|", ","], nb), pa.string())
        self.sizes = na, nb
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids = [pa.array([], pa.list_(pa.int32())) for _ in self.sides]

    def encode(self, distinct: pa.Array) -> list[pa.Array]:
        """Token lists of distinct units on both sides."""
        at = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(pc.is_null(at))
        if not len(new):
            return [ids.take(at) for ids in self.ids]
        made = [self._encode_new(k, new) for k in range(len(self.sides))]
        place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).copy()
        place[np.asarray(pc.is_null(at))] = len(self.known) + np.arange(len(new))
        lists = [pa.concat_arrays([old, own]).take(pa.array(place)) for old, own in zip(self.ids, made)]
        short = pc.less_equal(pc.binary_length(new), UNIT_BYTES)
        if len(self.known) + len(new) > KNOWN_UNITS:
            self.forget()
        self.known = pa.concat_arrays([self.known, new.filter(short)])
        self.ids = [pa.concat_arrays([old, own.filter(short)]) for old, own in zip(self.ids, made)]
        return lists

    def _encode_new(self, k: int, new: pa.Array) -> pa.Array:
        """Token lists of units that are not known.

        Units behind which a new one may begin are joined to runs, which saves most of the
        encoder's time, and the tokens dealt out again by their bytes.  Where they do not
        end with the units, and for all other units, each is encoded alone.
        """
        side, lengths = self.sides[k], self.lengths[k]
        data, offsets = utf8(new)
        open_end = _sure_ends(data)[offsets[1:] - 1] if self.splits else np.zeros(len(new), dtype=bool)
        joined = np.flatnonzero(open_end)
        alone = np.flatnonzero(~open_end)
        flat, counts = [], []
        if len(joined):
            text = new.take(pa.array(joined))
            data, offsets = utf8(text)
            run = offsets[:-1] // RUN_BYTES
            first = np.concatenate((np.flatnonzero(np.diff(run, prepend=-1)), [len(text)]))
            raw = data.tobytes()
            ids = side.encode_runs([raw[offsets[x] : offsets[y]].decode() for x, y in zip(first, first[1:])])
            flat = np.fromiter(chain.from_iterable(ids), np.int32)
            ends = np.cumsum(lengths[flat])
            until = np.searchsorted(ends, offsets[1:])
            if len(ends) and ends[-1] == offsets[-1] and (ends[until] == offsets[1:]).all():
                counts = np.diff(np.concatenate(([0], until + 1)))
            else:
                alone, joined, flat = np.arange(len(new)), joined[:0], np.empty(0, np.int32)
        rest = side.encode(new.take(pa.array(alone)).to_pylist()) if len(alone) else []
        values = np.concatenate([np.asarray(flat, np.int32), np.fromiter(chain.from_iterable(rest), np.int32)])
        sizes = np.concatenate([np.asarray(counts, np.int64), np.array([len(r) for r in rest], np.int64)])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values))
        back = np.empty(len(new), np.int64)
        back[np.concatenate((joined, alone))] = np.arange(len(new))
        return lists.take(pa.array(back))

    def units(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Offsets of the units: a new one begins at a white space behind something that surely is none."""
        if not self.splits:
            return offsets
        begin = np.zeros(len(data) + 1, dtype=bool)
        # Pieces may end in a carriage return, so none begins a unit.
        begin[1:-1] = (_SPACES[data] & (data != 13))[1:] & _sure_ends(data)[:-1]
        begin[offsets] = True
        return np.flatnonzero(begin)


def _sure_ends(data: np.ndarray) -> np.ndarray:
    """Bytes that end a character which is no white space in any pattern; of those beyond ASCII, some are left out."""
    sure = ~_SPACES[data] & ~_UNSURE[data]
    one, two = np.zeros_like(data), np.zeros_like(data)
    one[1:], two[2:] = data[:-1], data[:-2]
    return sure & ~((data >= 0x80) & ((one == 0xC2) | (two == 0xE1) | (two == 0xE2) | (two == 0xE3)))


_aligners: dict[tuple[str, str], Aligner] = {}


def _counts(keys: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"pair": keys, "n": n}).group_by("pair", use_threads=False).aggregate([("n", "sum")])


def _lossless(tokens: pa.Array, vocabulary: pa.Array, of: np.ndarray, sizes: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which documents' joined token bytes are their text."""
    total = np.bincount(of, weights=sizes, minlength=len(offsets) - 1).astype(np.int64)
    joined = utf8(vocabulary.take(tokens).view(pa.string()))[0]
    same = total == np.diff(offsets)
    if same.all():
        wrong = np.flatnonzero(joined != data)
        same[np.searchsorted(offsets, wrong, side="right") - 1] = False
        return same
    ends = np.cumsum(total)
    for r in np.flatnonzero(same):
        same[r] = np.array_equal(joined[ends[r] - total[r] : ends[r]], data[offsets[r] : offsets[r + 1]])
    return same


def align(column: pa.Array, aligner: Aligner) -> dict:
    """The columns of FIELDS for a slice of texts."""
    rows = len(column)
    zero = np.zeros(rows, np.int64)
    out = {"n_a": zero, "n_b": zero, "n_groups": zero, "n_links": zero, "groups_sha256": [""] * rows, "pairs": [[]] * rows, "slice_pairs": [None] * rows}
    column = pc.fill_null(column.cast(pa.string()), "")
    filled = np.flatnonzero(np.asarray(pc.binary_length(column)) > 0)
    if not len(filled):
        return out
    spaced = pc.binary_join_element_wise(pa.scalar(" "), column.take(pa.array(filled)), pa.scalar(""))
    data, offsets = utf8(spaced)
    bounds = aligner.units(data, offsets)
    units = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
    unit_doc = np.searchsorted(offsets, bounds[:-1], side="right") - 1
    tokens, docs, sizes = [], [], []
    for lists, lengths in zip(aligner.encode(units.dictionary), aligner.lengths):
        spread = lists.take(units.indices)
        flat, parent = pc.list_flatten(spread), pc.list_parent_indices(spread)
        tokens.append(flat)
        docs.append(unit_doc[np.asarray(parent)])
        sizes.append(lengths[np.asarray(flat)])
    good = np.ones(len(filled), dtype=bool)
    for side in (0, 1):
        good &= _lossless(tokens[side], aligner.vocabularies[side], docs[side], sizes[side], data, offsets)
    if not good.all():
        for side in (0, 1):
            stay = good[docs[side]]
            tokens[side], docs[side], sizes[side] = tokens[side].filter(pa.array(stay)), docs[side][stay], sizes[side][stay]
    if not len(tokens[0]):
        return out
    n = [np.bincount(d, minlength=len(filled)) for d in docs]
    tables = []
    for side, name in enumerate("ab"):
        # Cumulative sums by document: the running sum less what it was at the document's start.
        ends = np.cumsum(sizes[side])
        first = np.concatenate(([0], np.cumsum(n[side])))[:-1]
        before = np.concatenate(([0], ends))[first]
        key = (docs[side] << _SHIFT) + ends - before[docs[side]]
        tables.append(pa.table({"key": key, name: np.arange(len(key))}))
    links = tables[0].join(tables[1], "key", join_type="full outer", use_threads=False)
    links = links.take(pc.sort_indices(links["key"]))
    both = np.asarray(pc.and_(pc.is_valid(links["a"]), pc.is_valid(links["b"])))
    # An end of one side lies in the token of the other side that ends next.
    at = [np.asarray(pc.fill_null_backward(links[s]).combine_chunks()) for s in "ab"]
    ids = [np.asarray(t) for t in tokens]
    doc = np.asarray(links["key"]) >> _SHIFT
    pair = (ids[0][at[0]].astype(np.int64) << _SHIFT) + ids[1][at[1]]
    n_groups = np.bincount(doc[both], minlength=len(filled))
    n_links = np.bincount(doc, minlength=len(filled))

    by_doc = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    by_doc = by_doc.take(pc.sort_indices(by_doc["doc"]))
    pairs, many = np.asarray(by_doc["pair"]), np.asarray(by_doc["count_all"])
    per_doc = np.bincount(np.asarray(by_doc["doc"]), minlength=len(filled))
    whole = _counts(pairs, many)

    spelled = _spell(aligner, ids, at, both, docs, n)
    list_at = np.zeros(rows + 1, np.int64)
    list_at[filled + 1] = per_doc
    values = pa.StructArray.from_arrays([pa.array(pairs), pa.array(many)], fields=[pa.field("pair", pa.int64()), pa.field("n", pa.int64())])
    for name, value in (("n_a", n[0]), ("n_b", n[1]), ("n_groups", n_groups), ("n_links", n_links)):
        out[name] = zero.copy()
        out[name][filled] = value
    for k in np.flatnonzero(n[0]):
        out["groups_sha256"][filled[k]] = hashlib.sha256(spelled[k].as_buffer()).hexdigest()
    out["pairs"] = pa.ListArray.from_arrays(pa.array(np.cumsum(list_at), pa.int32()), values)
    whole = pa.StructArray.from_arrays(
        [whole["pair"].combine_chunks(), whole["n_sum"].combine_chunks()], fields=[pa.field("pair", pa.int64()), pa.field("n", pa.int64())]
    )
    first = np.full(rows + 1, len(whole))
    first[0] = 0
    out["slice_pairs"] = pa.ListArray.from_arrays(pa.array(first, pa.int32()), whole)
    return out


def _spell(aligner: Aligner, ids: list[np.ndarray], at: list[np.ndarray], both: np.ndarray, docs: list[np.ndarray], n: list[np.ndarray]) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each document: the tokens of a group, side by side."""
    closes = [np.zeros(len(i), dtype=bool) for i in ids]
    group, start = [], []
    for side in (0, 1):
        closes[side][at[side][both]] = True
        # The group of a token is the number of cuts before it.
        group.append(np.cumsum(closes[side]) - closes[side])
        start.append(np.concatenate(([True], closes[side][:-1])))
    size = [np.bincount(g) for g in group]
    until = [np.concatenate(([0], np.cumsum(s))) for s in size]
    na, nb = aligner.sizes
    new_doc = np.concatenate(([True], docs[0][1:] != docs[0][:-1]))
    order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    # Before a token of a group come, of the other side, those of the groups before (or, for b, up to it).
    order[np.arange(len(ids[0])) + until[1][group[0]]] = ids[0] + na * np.where(new_doc, 2, np.where(start[0], 0, 1))
    order[np.arange(len(ids[1])) + until[0][group[1] + 1]] = 3 * na + ids[1] + nb * np.where(start[1], 0, 1)
    words = aligner.spelling.take(pa.array(order))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n[0] + n[1]))), pa.int32()), words)
    return pc.binary_join(lists, "")


def alignments(docs: DataFrame, byte_path: str = BYTE_BPE, piece_path: str = PIECE_BPE, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the token, group and link counts, the hash of the groups, and the pairs of FIELDS."""

    def work(batch: pa.RecordBatch) -> dict:
        key = byte_path, piece_path
        if key not in _aligners:
            _aligners[key] = Aligner(*key)
        return align(batch.column(batch.schema.get_field_index(text)), _aligners[key])

    return map_texts(docs, work, FIELDS, text, keep, SLICE)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) over all documents; best if no other pair of its B id has more."""
    parts = aligned.select(F.explode("slice_pairs").alias("p"))
    counts = stage(parts.groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.n").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND((1 << _SHIFT) - 1).cast("int")
    top = counts.groupBy(b.alias("b")).agg(F.max("count").alias("top"))
    # One row for each B id: at most the size of the vocabulary.
    rows = counts.withColumn("b", b).join(F.broadcast(top), "b")
    return rows.select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align_tokenizers(docs: DataFrame, byte_path: str = BYTE_BPE, piece_path: str = PIECE_BPE, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(one row per document, all id pairs with their counts) of two tokenizers.

    The first has ``row`` (the input row as a struct), n_a, n_b, n_groups, n_links,
    groups_sha256, n_best and count_sum; the second a_id, b_id, count and best.  Byte offsets
    where tokens of both sides end cut the text into groups; two tokens are linked if their bytes
    overlap.  A pair's count is the number of such links in all documents.

    Null and empty texts, and those that one side does not give back byte by byte, have no
    tokens: zeros and an empty hash.  Ties count as best alike.  Repeated rows are documents
    of their own and count as such; an empty table gives two empty ones; columns of any name stay
    inside ``row``.  A task's memory grows with its longest text, by some 200 bytes for each of its bytes.
    """
    numbered = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("id"))
    aligned = stage(alignments(numbered, byte_path, piece_path, keep=["row", "id"]), "aligned")
    counts = stage(pair_counts(aligned), "counts")
    own = aligned.select("id", F.explode("pairs").alias("p")).select("id", "p.pair", "p.n")
    if counts.count() <= MAX_BROADCAST_PAIRS:
        joined = own.join(F.broadcast(counts), "pair")
    else:
        # A pair that most documents have is spread over SALTS tasks.
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
        joined = own.withColumn("salt", salt).join(counts.withColumn("salt", salts), ["pair", "salt"])
    sums = joined.groupBy("id").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")
    )
    zero = F.lit(0).cast("bigint")
    rows = aligned.drop("pairs", "slice_pairs").join(sums, "id", "left").select(
        "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum")
    )
    a, b = F.shiftright("pair", _SHIFT).cast("int"), F.col("pair").bitwiseAND((1 << _SHIFT) - 1).cast("int")
    return rows, counts.select(a.alias("a_id"), b.alias("b_id"), "count", "best")


def digest(docs: DataFrame) -> DataFrame:
    """The check columns of :func:`align_tokenizers`."""
    rows, _ = align_tokenizers(docs.select("doc_id", "text"))
    return rows.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
