"""Ids that repeat, items without id, and columns named as helpers are."""

import itertools
import random

import corpus_pipeline
from rarecohort.llm import leaks, mixing, neardup, shards
from tests.llm.test_operators import words

_rng = random.Random(8)
X = " ".join(f"x{_rng.randrange(999)}" for _ in range(60))
Y = " ".join(f"y{_rng.randrange(999)}" for _ in range(60))


def test_near_copy_of_a_second_version_in_any_order(spark):
    rows = [(2, X), (2, Y), (3, Y + " more"), (4, X + " end"), (9, "something else")]
    for order in itertools.islice(itertools.permutations(rows), 0, 120, 53):
        table = spark.createDataFrame(list(order), "doc_id long, text string").coalesce(1)
        got = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(table).collect()}
        assert got == {(2, 2, True), (3, 2, False), (4, 2, False), (9, 9, True)}


def test_second_versions_in_blocks(spark, monkeypatch):
    """Links that only the blocks of a mixed bucket find, between texts that are not the first of their ids."""
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:k] + ["v"] + base[k + 1 :]) for k in (5, 50, 95)]
    rows = [(1, X), (1, texts[0]), (2, Y), (2, texts[1]), (3, texts[2]), (3, X + " z")]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        assert {r.component_id for r in neardup.near_duplicates(table).collect()} == {1}


def longest(text, items):
    w, out = words(text), {}
    for name, body in items:
        b = words(body)
        need, best = min(10, len(b)), None
        for i, j in itertools.product(range(len(b)), range(len(w))):
            n = 0
            while i + n < len(b) and j + n < len(w) and b[i + n] == w[j + n]:
                n += 1
            if n >= need and (best is None or (-n, i, j) < (-best[2], best[0], best[1])):
                best = i, j, n
        if best and need:
            out.setdefault(None if name is None else str(name), []).append(best)
    return {k: sorted(v) for k, v in out.items()}


def test_longest_matches_of_each_document(spark, monkeypatch):
    rng = random.Random(2)
    items = [(k, " ".join(rng.choice("ab") for _ in range(14))) for k in range(6)]
    items += [(None, " ".join(f"n{i}" for i in range(12))), (7, "short item"), (8, items[0][1]), (9, None)]
    passage = " ".join(f"n{i}" for i in range(11))
    docs = [(i, " ".join(rng.choice("ab") for _ in range(40))) for i in range(8)] + [(20 + i, f"in {i} {passage} stop a short item") for i in range(4)]
    table = spark.createDataFrame([*docs, (50, None), (51, "")], "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for limit in (leaks.MAX_PAIRS, 3):
        suffixes = leaks.Suffixes([(n, t) for n, t in items if t is not None], 10)
        monkeypatch.setattr(leaks, "MAX_PAIRS", limit)
        import pyarrow as pa

        found = leaks.scan(pa.array([t for _, t in docs]), suffixes)[3]
        for r, (_, text) in enumerate(docs):
            got = {}
            for name, item_word, doc_word, length in found.get(r, []):
                got.setdefault(name, []).append((item_word, doc_word, length))
            assert {k: sorted(v) for k, v in got.items()} == longest(text, [i for i in items if i[1] is not None])
    rows = {r.doc_id: r for r in leaks.find_leaks(table, benchmark).collect()}
    for k in range(20, 24):
        assert [(m["item_id"], m["length"]) for m in rows[k].matches] == [("7", 2), (None, 11)]
        assert rows[k]["items"] == ["7"]
    only = benchmark.filter("item_id IS NULL")
    digest = {r.doc_id: r for r in leaks.digest(leaks.find_leaks(table, only)).collect()}
    assert (digest[20].n_hit, digest[20].n_items, digest[20].contaminated) == (11, 0, True)
    assert leaks.find_leaks(table, only, drop=True).count() == 10


def test_columns_named_as_helpers(spark):
    names = ["__lang", "__epochs", "__last", "__part", "__row", "__before", "__offset", "__shift", "gone", "crc", "__crc"]
    rows = [(i, f"text {i} of some words", "en", "web1", *[i] * len(names)) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` long" for n in names))
    assert neardup.keep_one(table).columns == table.columns
    mixed = corpus_pipeline.mixed(spark, table, "")
    assert mixed.columns == table.columns and mixed.count() > 0
    own = table.withColumn("domain", mixing.domain_of())
    assert set(mixing.mix(own, mixing.TREE, corpus_pipeline.MIX_WEIGHTS, 1.0, 2).columns) == {*own.columns, "n_tokens", "copies"}
    placed = corpus_pipeline.sharded(spark, table, "")
    assert set(placed.columns) == {*table.columns, "size", "shard", "slot"}
    assert sorted(r["__crc"] for r in placed.collect()) == list(range(20))
    assert set(shards.balanced_shards(table, 3, ["doc_id"], shards.text_bytes()).columns) == set(placed.columns)
