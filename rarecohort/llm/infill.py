"""Fill-in-the-middle: cuts texts at word bounds and reorders the three parts.

A Fenwick tree over fixed blocks of a text holds how many units and how many
code points begin in them.  A cut after u units descends the tree in steps of
halving powers of two to the block in which the next unit begins, and only that block is read
to find the byte; the same descent yields the code points before it.
The trees of all rows of a slice lie in one array and all cuts descend at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarecohort.llm.texts import map_texts, utf8

#: Bytes of a block.
BLOCK = 1024
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: In 100 texts, how many stay plain, and how many of the others put the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20

FIELDS = [
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
]
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


class BlockTrees:
    """Unit and code point counts of every row of a text column, by blocks.

    A unit is a run of A-Z and a-z, or one other code point.  It counts in the
    block where it begins, and so does a code point of several bytes.
    """

    def __init__(self, column: pa.Array, block: int | None = None):
        block = block or BLOCK
        self.data, self.offsets = utf8(column)
        self.point = (self.data & 0xC0) != 0x80
        letter = _LETTER[self.data]
        self.unit = self.point.copy()
        self.unit[1:] &= ~(letter[1:] & letter[:-1])
        self.unit[self.offsets[:-1][np.diff(self.offsets) > 0]] = True
        self.blocks = -(-np.diff(self.offsets) // block)
        self.base = np.concatenate(([0], np.cumsum(self.blocks)))
        row = np.repeat(np.arange(len(self.blocks)), self.blocks)
        inner = np.arange(self.base[-1]) - self.base[row]
        #: First byte of each block; the last bound ends the data.
        self.starts = np.append(self.offsets[row] + inner * block, len(self.data))
        low = (inner + 1) & -(inner + 1)
        at = np.arange(self.base[-1]) + 1
        self.trees = []
        for flags in (self.unit, self.point):
            sums = np.concatenate(([0], np.cumsum(np.add.reduceat(flags, self.starts[:-1], dtype=np.int64)))) if len(at) else np.zeros(1, np.int64)
            #: Node i of a row covers the lowbit(i) blocks that end with the i-th.
            self.trees.append(sums[at] - sums[at - low])
        self.n = self._all(self.unit)
        self.chars = self._all(self.point)

    def _all(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def cut(self, row: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, code points before it) where the first ``units`` units of a row end; the byte counts from the slice's start."""
        pos, rest, chars = np.zeros(len(row), np.int64), units.astype(np.int64), np.zeros(len(row), np.int64)
        step = 1 << int(self.blocks[row].max(initial=0)).bit_length()
        while step:
            node = pos + step
            inside = np.flatnonzero(node <= self.blocks[row])
            at = self.base[row[inside]] + node[inside] - 1
            go = self.trees[0][at] <= rest[inside]
            moved, at = inside[go], at[go]
            rest[moved] -= self.trees[0][at]
            chars[moved] += self.trees[1][at]
            pos[moved] = node[moved]
            step >>= 1
        byte = self.offsets[row + 1].copy()
        for k in np.flatnonzero(pos < self.blocks[row]):
            first, end = self.starts[self.base[row[k]] + pos[k]], self.starts[self.base[row[k]] + pos[k] + 1]
            inner = int(np.flatnonzero(self.unit[first:end])[rest[k]])
            byte[k] = first + inner
            chars[k] += int(self.point[first : first + inner].sum())
        return byte, chars


def _draws(seed: int, key) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def fill_in_middle(docs: DataFrame, seed: int = 1, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """Adds n (units of the text), form, prefix_chars, middle_chars and output.

    Four draws from a hash of seed and doc_id settle the two cuts and the form: ``psm``
    is prefix, suffix, middle; ``spm`` is suffix, prefix, middle, each behind its mark;
    ``plain`` is the text as it is, without counts.

    Null and empty texts are plain and empty; so is a text that has a mark of its own plain.
    A text of any length is held in whole, with two flags for each of its bytes.
    Rows that repeat a doc_id draw alike; a null doc_id draws as an empty one.  An
    empty table gives an empty one; extra columns pass through, and a result replaces a column of
    its name.
    """

    def work(batch: pa.RecordBatch) -> dict:
        trees = BlockTrees(batch.column(batch.schema.get_field_index(text)))
        raw, offsets = trees.data.tobytes(), trees.offsets
        keys = batch.column(batch.schema.get_field_index(doc_id)).to_pylist()
        n = trees.n.tolist()
        low, high, forms = [], [], []
        for r, key in enumerate(keys):
            h1, h2, h3, h4 = _draws(seed, key)
            body = raw[offsets[r] : offsets[r + 1]]
            own = not body or PREFIX in body or SUFFIX in body or MIDDLE in body
            plain = own or h3 % 100 >= 100 - PLAIN_PERCENT
            forms.append("plain" if plain else "spm" if h4 % 100 < SUFFIX_FIRST_PERCENT else "psm")
            cuts = sorted((h1 % (n[r] + 1), h2 % (n[r] + 1)))
            low.append(cuts[0])
            high.append(cuts[1])
        rows = np.flatnonzero([f != "plain" for f in forms])
        (one, before), (two, until) = (trees.cut(rows, np.array(c, np.int64)[rows]) for c in (low, high))
        output: list[bytes] = [raw[offsets[r] : offsets[r + 1]] if f == "plain" else b"" for r, f in enumerate(forms)]
        prefix: list[int | None] = [None] * len(forms)
        middle: list[int | None] = [None] * len(forms)
        for k, r in enumerate(rows.tolist()):
            parts = raw[offsets[r] : one[k]], raw[one[k] : two[k]], raw[two[k] : offsets[r + 1]]
            order = (PREFIX, parts[0], SUFFIX, parts[2]) if forms[r] == "psm" else (SUFFIX, parts[2], PREFIX, parts[0])
            output[r] = b"".join((*order, MIDDLE, parts[1]))
            prefix[r], middle[r] = int(before[k]), int(until[k] - before[k])
        made = pa.array(output, pa.binary()).cast(pa.string())
        return {"n": n, "form": forms, "prefix_chars": prefix, "middle_chars": middle, "output": made}

    return map_texts(docs, work, FIELDS, text, keep)


def restore(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of; no part of it can look like a mark."""
    parts = F.split(output, "<[PSM]>")
    order = F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(order)


def digest(docs: DataFrame) -> DataFrame:
    """The check columns of :func:`fill_in_middle`."""
    made = fill_in_middle(docs.select("doc_id", "text"), keep=["doc_id"])
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(), 256).alias("restored_sha256"),
    )
