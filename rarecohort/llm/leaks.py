"""Benchmark decontamination with suffix arrays over the training text.

A shard is a slice of rows in a task.  Its words become ids of the benchmark's
vocabulary; runs of known words that are too short for any window are passed
over, and a suffix array is built over the rest.  Every benchmark suffix is
binary-searched in it, all suffixes in lockstep, which gives all places of its
window and its longest verbatim match.  No row is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarecohort.llm.texts import ALNUM, Words, map_texts
from rarecohort.sources.staging import stage

#: Benchmark text that is searched in one pass.  A larger benchmark takes more
#: passes over the documents, which are written in between, so that a task holds one piece.
BENCHMARK_BYTES = 4 << 20
#: Text of a shard.
SHARD_BYTES = 4 << 20
#: Places and suffixes of equal windows that are extended at once.
MAX_PAIRS = 1_000_000

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("item_word", T.LongType()),
            T.StructField("doc_word", T.LongType()),
            T.StructField("length", T.LongType()),
        ]
    )
)
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("matches", MATCHES),
]


class Suffixes:
    """Benchmark suffixes that hold a window, as word ids from 1 on."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        words = Words(pa.array([t for _, t in items], pa.string()), ALNUM)
        self.vocabulary, where, ids = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.spelling = [words.word(i) for i in where]
        self.tokens = np.append(ids + 1, 0).astype(np.int64)
        self.names = [None if i is None else str(i) for i, _ in items]
        starts, ends, need, owner = [], [], [], []
        for k in range(len(items)):
            a, b = int(words.row_at[k]), int(words.row_at[k + 1])
            w = min(window, b - a)
            at = np.arange(a, b - w + 1) if w else np.empty(0, np.int64)
            starts.append(at)
            ends.append(np.full(len(at), b))
            need.append(np.full(len(at), w))
            owner.append(np.full(len(at), k))
        self.start, self.end, self.need, self.owner = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (starts, ends, need, owner))
        self.item_at = words.row_at
        classes: dict[bytes, int] = {}
        self.window = np.array([classes.setdefault(self.tokens[s : s + w].tobytes(), len(classes)) for s, w in zip(self.start, self.need)], np.int64)
        #: Suffixes of one window, side by side.
        self.by_window = by_window = np.argsort(self.window, kind="stable")
        self.holders = self.owner[by_window]
        self.holders_at = np.searchsorted(self.window[by_window], np.arange(len(classes) + 1))
        #: One suffix of each window, for the search of its places.
        self.one = np.unique(self.window, return_index=True)[1]
        self.shortest = int(self.need.min()) if len(self.need) else 0
        self.longest = int((self.end - self.start).max()) if len(self.start) else 0

    def items_of(self, window: int) -> set[str]:
        """The ids of the items that have a window; an item without id has no name."""
        return {self.names[k] for k in self.holders[self.holders_at[window] : self.holders_at[window + 1]]} - {None}


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` tokens, by prefix doubling."""
    rank, k, n = tokens.astype(np.int64), 1, len(tokens)
    order = np.argsort(rank, kind="stable")
    while k < depth:
        after = np.zeros(n, np.int64)
        after[: max(n - k, 0)] = rank[k:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1]))) if n else ordered
        rank = np.empty(n, np.int64)
        rank[order] = new
        k *= 2
        if n and new[-1] == n - 1:
            break
    return order


def common(text: np.ndarray, at: np.ndarray, query: np.ndarray, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Equal tokens from ``text[at]`` and ``query[start]`` on, up to ``limit``; text ends in a 0 that no query has."""
    length = np.zeros(len(at), np.int64)
    live = np.flatnonzero(limit > 0)
    while len(live):
        same = text[at[live] + length[live]] == query[start[live] + length[live]]
        live = live[same]
        length[live] += 1
        live = live[length[live] < limit[live]]
    return length


def search(text: np.ndarray, order: np.ndarray, query: np.ndarray, start: np.ndarray, limit: np.ndarray, after: bool) -> np.ndarray:
    """How many suffixes come before (or, with ``after``, before or among) those that begin with the query."""
    low, high = np.zeros(len(start), np.int64), np.full(len(start), len(order), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        at, s, most = order[middle], start[live], limit[live]
        same = common(text, at, query, s, most)
        whole = same == most
        step = np.minimum(same, most - 1)
        less = text[at + step] < query[s + step]
        go = np.where(whole, after, less)
        low[live[go]] = middle[go] + 1
        high[live[~go]] = middle[~go]


def _known_runs(ids: np.ndarray, row_at: np.ndarray, shortest: int) -> np.ndarray:
    """Word positions in runs of known words, inside a row, of ``shortest`` words or more."""
    known = ids > 0
    opens = known.copy()
    opens[1:] &= ~known[:-1]
    rows = row_at[:-1][row_at[:-1] < len(ids)]
    opens[rows] = known[rows]
    run = np.cumsum(opens) - 1
    size = np.bincount(run[known], minlength=1)
    return np.flatnonzero(known & (size[np.maximum(run, 0)] >= shortest))


def scan(column: pa.Array, suffixes: Suffixes) -> tuple[np.ndarray, dict[int, list], dict[int, set], dict[int, list]]:
    """For a shard: words of each row, and by row the hit words, items and longest matches."""
    words = Words(column, ALNUM)
    n_words, hits, items, matches = words.counts(), {}, {}, {}
    if not len(suffixes.start) or not len(words.hashes):
        return n_words, hits, items, matches
    at = np.minimum(np.searchsorted(suffixes.vocabulary, words.hashes), len(suffixes.vocabulary) - 1)
    ids = np.where(suffixes.vocabulary[at] == words.hashes, at + 1, 0)
    places = _known_runs(ids, words.row_at, suffixes.shortest)
    wrong = [p for p in places if words.word(p) != suffixes.spelling[ids[p] - 1]]  # equal hashes of unequal words
    if wrong:
        ids[wrong] = 0
        places = _known_runs(ids, words.row_at, suffixes.shortest)
    if not len(places):
        return n_words, hits, items, matches
    # Runs one after the other, each ended by a 0; a run never goes over two rows.
    row = np.searchsorted(words.row_at, places, side="right") - 1
    gap = np.concatenate(([0], np.cumsum((np.diff(places) > 1) | (np.diff(row) > 0))))
    text = np.zeros(len(places) + gap[-1] + 1, np.int64)
    slot = np.arange(len(places)) + gap
    text[slot] = ids[places]
    of = np.zeros(len(text), np.int64)
    of[slot] = np.arange(len(places))
    order = suffix_array(text, suffixes.longest)

    # All places of every window.
    q = suffixes.one
    low = search(text, order, suffixes.tokens, suffixes.start[q], suffixes.need[q], after=False)
    found = np.flatnonzero((low < len(order)) & (common(text, order[np.minimum(low, len(order) - 1)], suffixes.tokens, suffixes.start[q], suffixes.need[q]) == suffixes.need[q]))
    if not len(found):
        return n_words, hits, items, matches
    high = search(text, order, suffixes.tokens, suffixes.start[q[found]], suffixes.need[q[found]], after=True)
    many = high - low[found]
    where = order[np.repeat(low[found] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())]
    which = np.repeat(q[found], many)
    marks = np.zeros(len(text) + 1, np.int64)
    np.add.at(marks, where, 1)
    np.add.at(marks, where + suffixes.need[which], -1)
    hit = of[np.flatnonzero(np.cumsum(marks[:-1]) > 0)]
    for r, p in zip(row[hit], places[hit] - words.row_at[row[hit]]):
        hits.setdefault(int(r), []).append(int(p))
    for r, c in {(int(r), int(c)) for r, c in zip(row[of[where]], suffixes.window[which])}:
        items.setdefault(r, set()).update(suffixes.items_of(c))

    for r, k, length, item_word, doc_word in _longest(text, where, suffixes.window[which], row[of[where]], places[of[where]] - words.row_at[row[of[where]]], suffixes):
        matches.setdefault(int(r), []).append((suffixes.names[k], int(item_word), int(doc_word), int(length)))
    return n_words, hits, items, matches


def _longest(text: np.ndarray, where: np.ndarray, window: np.ndarray, row: np.ndarray, doc_word: np.ndarray, suffixes: Suffixes) -> np.ndarray:
    """The longest match of each row and item: row, item, length, first word in both; the first of equally long ones.

    Every place of a window is extended along every suffix that begins with it, if it
    cannot be extended to the left as well: then the place before it is the longer one.
    """
    best = np.empty((0, 5), np.int64)
    many = suffixes.holders_at[window + 1] - suffixes.holders_at[window]
    total = np.cumsum(many)
    first = 0
    while first < len(where):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + MAX_PAIRS, side="right")))
        n = many[first:last]
        place = np.repeat(np.arange(first, last), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        suffix = suffixes.by_window[suffixes.holders_at[window[place]] + inner]
        at, start, owner = where[place], suffixes.start[suffix], suffixes.owner[suffix]
        left = (at > 0) & (start > suffixes.item_at[owner]) & (text[at - 1] == suffixes.tokens[start - 1])
        place, at, start, owner, suffix = (x[~left] for x in (place, at, start, owner, suffix))
        length = common(text, at, suffixes.tokens, start, suffixes.end[suffix] - start)
        found = np.column_stack((row[place], owner, length, start - suffixes.item_at[owner], doc_word[place]))
        best = np.concatenate((best, found))
        best = best[np.lexsort((best[:, 4], best[:, 3], -best[:, 2], best[:, 1], best[:, 0]))]
        new = np.ones(len(best), dtype=bool)
        new[1:] = (best[1:, :2] != best[:-1, :2]).any(axis=1)
        best, first = best[new], last
    return best


def _spans(points: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for p in sorted(set(points)):
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [tuple(x) for x in out]


def _passes(benchmark: DataFrame, item: str, text: str):
    """The benchmark in pieces of ``BENCHMARK_BYTES``, or one longer item."""
    piece, size = [], 0
    rows = benchmark.select(F.col(item).cast("string"), F.col(text)).filter(F.col(text).isNotNull())
    for name, words in rows.toLocalIterator():
        if piece and size + len(words) > BENCHMARK_BYTES:
            yield piece
            piece, size = [], 0
        piece.append((name, words))
        size += len(words)
    yield piece


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    keep: list[str] | None = None,
    drop: bool = False,
) -> DataFrame:
    """Finds every place where a document repeats ``window`` words of a benchmark item.

    Adds n_words, hit_spans (half-open word ranges inside some window), items
    (ids, sorted) and matches (the longest verbatim match with each of these items, with both
    positions; the first of equally long ones).  With ``drop``, nothing is added and documents that
    hold a window are left out.

    An item of fewer words than the window, but not none, is one window.  Null
    and empty texts have no words; null texts of items and those without words match
    nothing; an item without id hits, and is a match without name, but not among ``items``; an empty benchmark hits nothing.  Repeated rows are judged one by
    one, items that share a text are all named, extra columns pass through, and
    a result replaces a column of its name.
    """
    context = docs.sparkSession.sparkContext
    keep = docs.columns if keep is None else keep
    new = [f.name for f in FIELDS]
    # One piece at a time on the driver and in the tasks, besides the next one's text.
    pieces = _passes(benchmark, item_id, "text")
    number, items = 0, next(pieces)
    while items is not None:
        after = next(pieces, None)
        piece, last = context.broadcast(Suffixes(items, window)), after is None

        def work(batch: pa.RecordBatch, piece=piece, number=number, last=last) -> dict:
            n, hits, items, matches = scan(batch.column(batch.schema.get_field_index(text)), piece.value)
            out = {"n_words": n.tolist(), "hit_spans": [], "items": [], "matches": []}
            before = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in new[1:]] if number else None
            for r in range(len(n)):
                points, names, found = hits.get(r, []), items.get(r, set()), matches.get(r, [])
                if before:
                    points = points + [p for s in before[0][r] for p in range(s["start"], s["end"])]
                    names = names | set(before[1][r])
                    found = [tuple(m.values()) for m in before[2][r]] + found
                out["hit_spans"].append([{"start": a, "end": b} for a, b in _spans(points)])
                out["items"].append(sorted(names))
                found = sorted(found, key=lambda m: (m[0] is None, *[x or 0 if m[0] is None else x for x in m]))
                out["matches"].append([dict(zip(("item_id", "item_word", "doc_word", "length"), m)) for m in found])
            return out

        if drop:

            def clean(batch: pa.RecordBatch, piece=piece) -> dict:
                hits = scan(batch.column(batch.schema.get_field_index(text)), piece.value)[1]
                return {None: [r not in hits for r in range(len(batch))]}

            docs = map_texts(docs, clean, [], text, None if not last else keep, SHARD_BYTES)
        else:
            columns = [c for c in keep if c not in new]
            docs = map_texts(docs, work, FIELDS, text, columns if last else [*dict.fromkeys([*columns, text])], SHARD_BYTES)
        if not last:
            docs = stage(docs, "leaks")
            piece.destroy()
        number, items = number + 1, after
    return docs


def digest(leaks: DataFrame) -> DataFrame:
    """The check columns of :func:`find_leaks`."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return leaks.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
