"""Words and hashes of Arrow text columns, computed on whole buffers.

Tasks hold one slice of a batch at a time: rows of ``SLICE_BYTES`` of text
together, or one longer text.  Nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Text that is worked on at once.
SLICE_BYTES = 2 << 20
#: Bytes whose powers are multiplied at once, so that they stay in the cache.
_BLOCK = 1 << 17

#: A-Z to a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word bytes, after lower-casing: digits, a-z and all bytes of characters beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Word bytes: all but white space.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def fresh(columns: list[str], name: str) -> str:
    """The name, or with underscores behind it, that no column has in any letter case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(2 * n, 2 * _BLOCK)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of them; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


class Words:
    """Words of a text column: byte ranges, 64-bit hashes, and the first word of each row."""

    def __init__(self, column: pa.Array, word_bytes: np.ndarray):
        data, self.offsets = utf8(column)
        self.low = LOWER[data]
        word = word_bytes[self.low]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        opens = self.offsets[:-1][self.offsets[:-1] < len(data)]
        closes = self.offsets[1:][self.offsets[1:] > 0] - 1
        first[opens] = word[opens]
        last[closes] = word[closes]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        #: Row r has the words row_at[r] to row_at[r + 1].
        self.row_at = np.searchsorted(self.starts, self.offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + _BLOCK)))
            lo, hi = self.starts[a], self.ends[b - 1]
            up, down = _powers(hi - lo + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((self.low[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=sums[1:])
            s, e = self.starts[a:b] - lo, self.ends[a:b] - lo
            out[a:b] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            a = b
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.row_at)

    def word(self, i: int) -> bytes:
        return self.low[self.starts[i] : self.ends[i]].tobytes()


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, and the n + 1 row bounds.

    A row with fewer words has its whole sequence as the only one; a row
    without words has none.
    """
    n = words.counts()
    runs = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.concatenate(([0], np.cumsum(runs)))
    row = np.repeat(np.arange(len(n)), runs)
    begin = words.row_at[row] + np.arange(at[-1]) - at[row]
    length = np.minimum(n, size)[row]
    h = np.zeros(at[-1], np.uint64)
    for k in range(size):
        inside = k < length
        if inside.all():
            h = mix(h + words.hashes[begin + k])
        else:
            h[inside] = mix(h[inside] + words.hashes[begin[inside] + k])
    return h, at


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of consecutive slices; each holds ``limit`` bytes at most, or one row."""
    _, offsets = utf8(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last - first
        first = last


def map_texts(
    docs: DataFrame,
    work: Callable[[pa.RecordBatch], dict],
    fields: list[T.StructField],
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Adds the columns that ``work`` makes of each slice of rows.

    ``work`` gets a record batch and returns a value list or array for each
    of ``fields``, and may return under ``None`` a row mask of what to keep.
    ``keep`` names the input columns that are returned (all of them if None).
    A field replaces an input column of its name.
    """
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c not in {f.name for f in fields}]
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for first, rows in slices(column, limit):
                part = batch.slice(first, rows)
                made = work(part)
                mask = made.pop(None, None)
                arrays = [part.column(part.schema.get_field_index(c)).cast(arrow.field(c).type) for c in keep]
                for f in fields:
                    values = made[f.name]
                    kind = arrow.field(f.name).type
                    arrays.append(values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind))
                out = pa.RecordBatch.from_arrays(arrays, schema=arrow)
                yield out if mask is None else out.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, schema)
