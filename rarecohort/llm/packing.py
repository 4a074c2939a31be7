"""Token ids packed into rows of fixed length by best-fit-decreasing.

A task tokenises its own documents, cuts overlong ones into chunks of a row's length
without loss, and packs batches of chunks: the longest first, each into the
fullest row that still has room.  A segment tree over free capacities finds
that row in log2(length) steps.  Nothing is shuffled.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Vocabulary of the registered query; a path on every executor.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 2048
#: Tokens that are packed together; a task holds so many at a time.
PACK_TOKENS = 2_000_000
#: Distinct words that a task remembers the ids of.
CACHE_WORDS = 300_000

# --- fixed values: the word pattern of this vocabulary, and the units that it never splits over ---
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
# -------------------------------------------------------------------------------------------------


class Tokenizer(dict):
    """Ids of white space and word units as bytes of uint16; each distinct unit is encoded once."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = np.array(self.encoding.encode_ordinary(unit), np.uint16).tobytes()
        if len(unit) < 64:
            self[unit] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, _UNIT.findall(text))), np.uint16)

    def decode(self, ids: np.ndarray) -> str:
        return self.encoding.decode(ids.tolist())


class CapacityTree:
    """How many rows have each free capacity; finds the smallest one of at least a length."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, capacity: int, by: int) -> None:
        node = self.size + capacity
        while node:
            self.counts[node] += by
            node >>= 1

    def at_least(self, length: int) -> int | None:
        node, counts = self.size + length, self.counts
        if counts[node]:
            return length
        while node > 1:  # up, until a right neighbour holds something
            if not node & 1 and counts[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if counts[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of indices; each row's lengths sum to ``length`` at most.  Ties keep their order."""
    rows: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(length + 1)]
    tree = CapacityTree(length)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        room = tree.at_least(need)
        if room is None:
            row, room = len(rows), length
            rows.append([])
        else:
            row = free[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        if room - need:
            free[room - need].append(row)
            tree.add(room - need, 1)
    return rows


SEGMENT = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "chunk", "start", "length")])
SCHEMA = T.StructType(
    [
        T.StructField("pack_id", T.LongType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("positions", T.BinaryType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("segments", T.ArrayType(SEGMENT)),
    ]
)


def _packed(chunks: list[tuple[int, int, np.ndarray]], length: int, pad: int, first: int):
    for k, row in enumerate(best_fit([len(c[2]) for c in chunks], length)):
        ids, positions, ends, segments = np.full(length, pad, np.uint16), np.zeros(length, np.uint16), [0], []
        for i in row:
            doc, chunk, own = chunks[i]
            a, b = ends[-1], ends[-1] + len(own)
            ids[a:b], positions[a:b] = own, np.arange(len(own))
            ends.append(b)
            segments.append({"doc_id": doc, "chunk": chunk, "start": a, "length": len(own)})
        yield {
            "pack_id": first + k,
            "n_tokens": ends[-1],
            "ids": ids.tobytes(),
            "positions": positions.tobytes(),
            "cu_seqlens": ends,
            "segments": segments,
        }


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, pad: int = 50256, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Packed rows: ids and positions (little-endian uint16, ``length`` each), cu_seqlens and segments.

    A segment is chunk ``chunk`` of a document; positions start from 0 in each, and
    padding has id ``pad`` and position 0.  Chunks of a document, in order, give
    exactly its ids.  Null and empty texts have no tokens and no segment; rows that repeat a
    doc_id are packed one by one, a null doc_id stays null; an empty table gives none.
    ``length`` is at most 65,535.
    """
    arrow = to_arrow_schema(SCHEMA)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        encoder, number = Tokenizer(tokenizer), TaskContext.get().partitionId() << 33
        chunks, held = [], 0

        def flush():
            nonlocal number
            out = list(_packed(chunks, length, pad, number))
            number += len(out)
            for k in range(0, len(out), 512):
                yield pa.RecordBatch.from_pylist(out[k : k + 512], schema=arrow)

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(body.as_py() or "")
                for k in range(0, len(ids), length):
                    chunks.append((doc, k // length, ids[k : k + length]))
                held += len(ids)
                if held >= PACK_TOKENS:
                    yield from flush()
                    chunks, held = [], 0
        if chunks:
            yield from flush()

    return docs.mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Writes the rows as Parquet: a folder of parts, each with whole id matrices."""
    packed.write.parquet(path)


def unpack(packed: DataFrame) -> DataFrame:
    """(doc_id, ids) of the documents with tokens: their chunks put together again, for distinct doc_ids."""
    s = F.col("s")
    own = F.substr("ids", (s["start"] * 2 + 1).cast("int"), (s["length"] * 2).cast("int"))
    rows = packed.select("ids", F.explode("segments").alias("s")).select("s.doc_id", "s.chunk", own.alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("chunk", "part")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["part"]))
    return rows.groupBy("doc_id").agg(joined.alias("ids"))
