"""Each operator against plain Python: odd rows in a small table, and the smallest given tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from rarecohort.llm import fingerprints, leaks, lm, mixing, neardup, packing, pii, quality, registry, shards, urls

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_rng = random.Random(3)
LONG = " ".join(_rng.choice(["alpha", "beta", "gamma", "Delta", "épsilon", "😀"]) + str(_rng.randrange(900)) for _ in range(30_000))
TEXTS = [
    None, "", "   \n", "one", "one two three", LONG, LONG, LONG + " more", "one two three",
    " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(39)) + " x", "W1 w2, w3 w4 w5 w6 w7 w8 w9 w10 w11",
    "mail a.b@c.de or a@b.c_d@e.fg; 4111 1111 1111 1111 and 4111 1111 1111 1112, 1.2.3.4.5.6.7.8 256.1.1.1",
    "😀 call +1 (487) 555-7209 now; IBAN GB82 WEST 1234 5698 7654 32 or GB82 WEST 1234 5698 7654 33", "7" * 5000 + ".a" * 3000,
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, a long text, copies, a repeated row, and columns named as results are."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}", 7, "mine") for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, "no id", "en", "src0", 7, "mine")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long, score string")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text, pattern=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"):
    return re.findall(pattern, (text or "").translate(UPPER))


@pytest.mark.parametrize("name", registry.ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(registry.QUERIES[name](spark, sf_dir), connect(sf_dir), registry.ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert sorted(registry.QUERIES) == sorted(k for k in registry.QUERIES if re.match(r"op([1-9]|1[0-3])_|pipeline", k))
    assert len(registry.QUERIES) == 14


# --- 1 decontamination ---------------------------------------------------------------------
def leaked(text, items, window=10):
    w, hit, names = words(text), set(), set()
    for name, body in items:
        b = words(body)
        n = min(window, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == b[i : i + n]:
                    hit.update(range(j, j + n))
                    names.add(str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, "w1 W2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (2, "one"), (3, None), (4, " ,"), (5, "W1 w2-w3 w4 w5 w6 w7 w8 w9 w10"), (6, "one")]


@pytest.mark.parametrize("at_once", [4 << 20, 10])
def test_leaks_equal_brute_force(spark, odd, monkeypatch, at_once):
    monkeypatch.setattr(leaks, "BENCHMARK_BYTES", at_once)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = leaks.find_leaks(odd, items)
    assert set(found.columns) == {*odd.columns, "hit_spans", "items", "matches"}
    got = [tuple(r) for r in leaks.digest(found).collect()]
    want = [(r.doc_id, *leaked(r.text, ITEMS)) for r in odd.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = leaks.find_leaks(odd, items, drop=True)
    assert kept.columns == odd.columns and kept.count() == sum(not w[-1] for w in want)


def test_longest_matches_and_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    row = leaks.find_leaks(odd, items).filter("doc_id = 9").first()
    assert max(m["length"] for m in row["matches"]) == 13
    assert [tuple(s) for s in row["hit_spans"]] == [(1, 14)]
    assert leaks.digest(leaks.find_leaks(odd, items.limit(0))).filter("contaminated").count() == 0
    assert leaks.find_leaks(odd.limit(0), items).count() == 0


def test_suffix_array_is_sorted():
    t = np.random.default_rng(1).integers(0, 3, 200)
    order = leaks.suffix_array(t, 200)
    assert [tuple(t[i:]) for i in order] == sorted(tuple(t[i:]) for i in range(200))


# --- 2 packing -----------------------------------------------------------------------------
def test_packing_round_trip(spark, odd, docs):
    for table in (odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), docs):
        packed = packing.pack(table, length=256)
        encoder = packing.Tokenizer(packing.TOKENIZER)
        back = {r.doc_id: encoder.decode(np.frombuffer(r.ids, np.uint16)) for r in packing.unpack(packed).collect()}
        assert back == {r.doc_id: r.text for r in table.collect() if r.text}
        for r in packed.limit(50).collect():
            assert len(r.ids) == len(r.positions) == 512 and r.cu_seqlens[-1] == r.n_tokens <= 256
            at = np.frombuffer(r.positions, np.uint16)
            for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
                assert at[a:b].tolist() == list(range(b - a))
    assert packing.pack(odd.limit(0)).count() == 0


def test_units_do_not_change_ids():
    encoder = packing.Tokenizer(packing.TOKENIZER)
    for t in ["a  b\n\n c", " x", "x ", "a\x1cb !\x1c!", "it's  12ab\u3000\u3000q", "\n", "é\xa0\xa0è"]:
        assert encoder.encode(t).tolist() == encoder.encoding.encode_ordinary(t)


def test_best_fit_takes_the_fullest_row():
    lengths = [random.Random(5).randrange(1, 60) for _ in range(300)]
    free, want = [], []
    for i in sorted(range(300), key=lambda i: (-lengths[i], i)):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else 100) - lengths[i])
    rows = packing.best_fit(lengths, 100)
    assert sorted(100 - sum(lengths[i] for i in r) for r in rows) == sorted(free) and sorted(i for r in rows for i in r) == list(range(300))
    assert not want


# --- 3 urls --------------------------------------------------------------------------------
def test_urls(spark, monkeypatch):
    names = [f"h{i}.x" for i in range(3000)]
    pages = [(i, f"http://{n}/p?q") for i, n in enumerate(names)]
    pages += [(9000, None), (9001, "none"), (9002, "s://A.NET#x"), (9003, "s://a.Net/"), (9004, "s://example.net/en/a"), (9005, "s://net/"), (9006, "s://anet/a://b")]
    table = spark.createDataFrame(pages, "page_id long, url string").withColumn("verdict", F.lit("old"))
    listed = spark.createDataFrame([(n,) for n in names[::7]] + [(None,), ("h7.x",), ("not.there",)], "host string")
    for bits in (1 << 24, 1000):  # one cascade, and several groups
        monkeypatch.setattr(urls, "MAX_BITS", bits)
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(table, listed, urls.RULES).collect()}
        assert len(got) == len(pages)
        for i, n in enumerate(names):
            assert got[i] == (n, "/p", None, "allow" if i % 7 else "block")
        assert [got[k] for k in range(9000, 9007)] == [
            ("", "", None, "allow"), ("", "", None, "allow"), ("a.net", "", None, "allow"), ("a.net", "/", "net/", "block"),
            ("example.net", "/en/a", "example.net/en/", "allow"), ("net", "/", "net/", "block"), ("anet", "/a://b", None, "allow"),
        ]
    assert urls.judge_urls(table.limit(0), listed, urls.RULES).count() == 0


def test_few_listed_hosts_of_many_keep_filters_small(spark, monkeypatch):
    made, init = [], urls.BloomFilter.__init__

    def noted(self, *args):
        init(self, *args)
        made.append(self.bits)

    monkeypatch.setattr(urls, "MAX_BITS", 1 << 11)
    monkeypatch.setattr(urls.BloomFilter, "__init__", noted)
    pages = spark.range(60_000).selectExpr("id as page_id", "concat('http://h', id, '.x/') as url", "repeat('y', 3) as key")
    listed = spark.range(0, 60_000, 3000).selectExpr("concat('h', id, '.x') as host")
    got = urls.judge_urls(pages, listed, [])
    blocked = sorted(r.page_id for r in got.filter("verdict = 'block'").collect())
    assert blocked == list(range(0, 60_000, 3000)) and got.count() == 60_000 and set(got.columns) >= {"key", "host"}
    assert len(made) > 2 and max(made) <= 1 << 11


# --- 4 fingerprints ------------------------------------------------------------------------
def test_fingerprints(odd, docs):
    for table in (odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), docs):
        rows = sorted((r.doc_id, r.text or "") for r in table.collect())
        got = {r.doc_id: r for r in fingerprints.digest(table).collect()}
        assert len(got) == len(rows)
        for k, (i, t) in enumerate(rows):
            after, n = rows[(k + 1) % len(rows)][1], len(t) // 4
            edited = t[: len(t) - n] + after[:n]
            assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert got[i].edited_fingerprint == fingerprints.PrefixHash(edited).fingerprint()
            assert (got[i].fingerprint == got[rows[(k + 1) % len(rows)][0]].fingerprint) == (t == after)
            assert 0.6 < got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    one = fingerprints.digest(odd.filter("doc_id = 5")).first()
    assert one.near_next == 1 and fingerprints.digest(odd.limit(0)).count() == 0
    assert fingerprints.digest(odd).count() == odd.count()


def test_span_hashes_and_extensions(spark):
    a, b = fingerprints.PrefixHash("xx" + LONG), fingerprints.PrefixHash(LONG + "y")
    assert a.common(2, b, 0) == len(LONG) and a.span(7, 900) == b.span(5, 898) != b.span(6, 899)
    pairs = spark.createDataFrame([("abcd", "abxd"), (None, "a"), ("", "")], "a string, b string")
    assert [r.common_prefix for r in fingerprints.longest_extensions(pairs, "a", "b").collect()] == [2, 0, 0]


def test_likeness_by_extensions_equals_all_blocks():
    of = lambda t: fingerprints.PrefixHash(t).fingerprint()

    def by_texts(x, y):
        """Equal blocks of the two texts themselves, from both ends."""
        step = 1
        while max(len(x), len(y)) > fingerprints.GRID * step:
            step *= 2
        several = range(0, min(len(x), len(y)) // step * step, step)
        heads = [i for i in several if x[i : i + step] == y[i : i + step]]
        tails = [i for i in several if x[len(x) - i - step : len(x) - i] == y[len(y) - i - step : len(y) - i]]
        covers = [len({p for a in heads for p in range(a, a + step)} | {p for a in tails for p in range(n - a - step, n - a)}) for n in (len(x), len(y))]
        return min(covers) / max(len(x), len(y), 1)

    for _ in range(300):
        x = "".join(_rng.choice("ab") for _ in range(_rng.randrange(1, 200)))
        cut = [_rng.randrange(len(x) + 1) for _ in range(2)]
        for y in (x[: cut[0]] + "c" + x[cut[0] :], x[: cut[0]] + "cc" + x[cut[1] :], x + x, x[::-1], x[cut[0] :]):
            assert math.isclose(fingerprints.likeness(of(x), of(y)), 1.0 if x == y else by_texts(x, y))
    marks = [fingerprints._marks(of(t).split(".")[3], 1, 1) for t in ("abcdefgh", "abcxefgh")]
    assert fingerprints._extension(*marks) == 3


def test_likeness_counts_all_equal_blocks():
    of = lambda t: fingerprints.PrefixHash(t).fingerprint()
    like = lambda a, b: fingerprints.likeness(of(a), of(b))
    n = len(LONG)
    ends = "#" + LONG[1:-1] + "#"
    inner = LONG[: n // 10] + "#" + LONG[n // 10 + 1 : n * 9 // 10] + "#" + LONG[n * 9 // 10 + 1 :]
    assert like(LONG, ends) > 0.85 and like(LONG, inner) > 0.85 and like(inner, ends) > 0.75
    # The second text is longer at its end or at its start: the grids differ, or only the ends agree.
    for more in (inner + "x" * n, "x" * n + inner):
        assert 0.35 < like(LONG, more) == like(more, LONG) <= 0.5
    other = " ".join(_rng.choice("abc") * 5 for _ in range(30_000))
    assert like(LONG, other) == 0 and like("ab", "") == 0 and like("a" * 40, "a" * 90) <= 40 / 90


# --- 5 pseudo-likelihood -------------------------------------------------------------------
def slow_score(model, counts, text):
    """The same sum by loops over plain numbers."""
    embed, shift, out, bias, *levels = [np.asarray(p, float) for p in model.parts()]
    keys = [int(k) for k in lm.tokens(pa.array([text]))[0]]
    own = {int(k): int(c) for k, c in zip(model.own, model.own_class)}
    cells, low = {}, (1 << lm.GROUP_BITS + lm.DIGIT_BITS * model.depth) - 1
    for k, n in counts.items():
        if k not in own:
            cells[k & low] = cells.get(k & low, 0) + n
    classes = [own.get(k, lm.OWN + k % lm.GROUPS) for k in keys]
    chosen = lambda logits, at: logits[at] - math.log(sum(math.exp(v) for v in logits))
    total = 0.0
    for i, k in enumerate(keys):
        x = shift.copy()
        for slot, d in enumerate(lm.SLOTS):
            near = classes[i + d] if 0 <= i + d < len(keys) else lm.CLASSES
            x += embed[slot * (lm.CLASSES + 1) + near]
        h = x / (1 + abs(x))
        total += chosen(h @ out + bias, classes[i])
        if k in own:
            continue
        before = 0
        for level in range(model.depth):
            groups, befores, digits = levels[3 * level : 3 * level + 3]
            begin = k & ((1 << lm.GROUP_BITS + lm.DIGIT_BITS * level) - 1)
            row = begin if level < 2 else int(lm.mix(np.array([begin], np.uint64))[0]) % lm.ROWS
            now = (k >> lm.GROUP_BITS + lm.DIGIT_BITS * level) % lm.DIGITS
            gate = groups[k % lm.GROUPS] + befores[before]
            total += chosen((h * gate) @ digits + model.bias[level][row], now)
            before = now
        if k in counts:
            total += math.log(counts[k] / (cells[k & low] + 1))
        else:
            mass = sum(n for j, n in counts.items() if j not in own and j % lm.GROUPS == k % lm.GROUPS)
            total -= math.log(mass / lm.DIGITS**model.depth + 1)
    return total, len(keys)


@pytest.mark.parametrize("top,depth", [(lm.TOP, None), (300, None), (300, 3)])
def test_scores_equal_plain_python(docs, odd, monkeypatch, top, depth):
    monkeypatch.setattr(lm, "TOP", top)
    counts = Counter(int(k) for r in docs.select("text").collect() for k in lm.tokens(pa.array([r.text]))[0])
    trained = lm.train(docs, depth=depth)
    assert {r.key % 2**64: r.n for r in trained.shares.collect()} == counts
    some = docs.filter("n_chars < 3000").orderBy("doc_id").limit(50).select("doc_id", "text").unionByName(odd.filter("doc_id < 5 or doc_id > 8").select("doc_id", "text"))
    got = Counter((r.doc_id, r.text, r.n_tokens, round(r.pll, 2)) for r in lm.score(some, trained).collect())
    want = Counter()
    for r in some.collect():
        total, n = slow_score(trained.model, counts, r.text or "")
        want[r.doc_id, r.text, n, round(total, 2)] += 1
    near = {k[:3]: k[3] for k in want}
    assert sum(got.values()) == sum(want.values()) and all(math.isclose(k[3], near[k[:3]], rel_tol=1e-5, abs_tol=0.02) for k in got)


def test_pseudo_likelihood(docs, odd):
    start, trained = lm.new_model(lm.word_counts(docs)), lm.train(docs)
    rows = [r.text for r in docs.filter("n_chars < 5000").limit(60).collect()]
    mean = lambda m, x: lm.log_probabilities(m, *lm.tokens(pa.array(x))).mean()
    shuffled = [" ".join(_rng.sample(t.split(), len(t.split()))) for t in rows]
    assert mean(trained.model, rows) > mean(start, rows) and mean(trained.model, rows) > mean(trained.model, shuffled)
    scored = {r.doc_id: r for r in lm.score(odd, trained).collect()}
    assert (scored[0].n_tokens, scored[0].pll, scored[0].pll_mean) == (0, 0.0, None) and scored[5].pll == scored[6].pll
    assert lm.score(odd, trained).columns == ["doc_id", "text", "lang", "source", "n_words", "score", "n_tokens", "pll", "pll_mean"]
    clash = odd.selectExpr("*", "1 as net", "2 as units", "3 as rare", "4 as row", "5 as key", "6 as others", "7 as pll")
    again = lm.score(clash, trained).filter("doc_id = 5").first()
    assert again.pll == scored[5].pll and again["row"] == 4 and again.others == 6
    assert lm.digest(odd.limit(0)).count() == 0 and lm.digest(odd).count() == odd.count()


def test_probabilities_sum_to_one_and_words_see_their_neighbours(spark):
    many = [f"w{i}" for i in range(100_000)]
    assert len(np.unique(lm.tokens(pa.array([" ".join(many)]))[0])) == len(many)
    # Fillers take the classes of single words; "xxng" and "yyng" are in one group and have neighbours of their own.
    rows = [" ".join(many[k : k + 500]) for k in range(0, 100_000, 500)]
    rows += [" ".join(f"f{i}" for i in range(lm.OWN))] * 60 + ["f1 xxng f2", "f3 yyng f4"] * 2000
    trained = lm.train(spark.createDataFrame([(t,) for t in rows], "text string"))
    assert trained.shares.count() == len(many) + lm.OWN + 2
    # One task sees few batches of so small a table, so the pairs are shown some more times.
    trainer, (keys, at) = lm.Trainer(trained.model), lm.tokens(pa.array(rows[-4000:]))
    for number in list(range(lm.ROUNDS)) * 20:
        trainer.learn(keys, at, number)
    model = trainer.model
    total = lambda *x: lm.log_probabilities(model, *lm.tokens(pa.array(x))).sum()
    assert total("f1 xxng f2", "f3 yyng f4") > total("f1 yyng f2", "f3 xxng f4") + 1
    # Every class that is a word, and every cell of every group, between the same neighbours.
    low = np.arange(lm.GROUPS * lm.DIGITS**model.depth, dtype=np.uint64) + np.uint64(1 << 40)
    left, right = lm.tokens(pa.array(["f1 f2"]))[0]
    every = np.concatenate((model.own, low))
    keys = np.stack((np.full(len(every), left), every, np.full(len(every), right)), axis=1).ravel()
    p = np.exp(lm.log_probabilities(model, keys, np.arange(0, len(keys) + 1, 3)))[1::3]
    missing = set(range(lm.OWN)) - set(model.own_class.tolist())
    assert not missing and math.isclose(p.sum(), 1, rel_tol=1e-4)


def test_digits_grow_with_the_vocabulary():
    per = lm.GROUPS * lm.CELL_WORDS
    assert [lm.digits_for(per * lm.DIGITS**k + more) for k in (2, 3) for more in (0, 1)] == [2, 3, 3, 4] and lm.digits_for(0) == 2


def test_all_tokens_are_learnt(docs):
    rows = [r.text for r in docs.filter("n_chars < 5000").limit(60).collect()]
    trainer, (keys, at) = lm.Trainer(lm.new_model(lm.word_counts(docs))), lm.tokens(pa.array(rows))
    for number in range(lm.ROUNDS):
        trainer.learn(keys, at, number)
    assert trainer.seen == len(keys)


@pytest.mark.parametrize("rows", [[], [0], [0, 1, 0, 2, 3, 5, 0], [7]])
def test_windows(rows):
    at = np.concatenate(([0], np.cumsum(rows))).astype(int)
    classes = np.arange(at[-1])
    got = lm._windows(classes, at) - np.arange(len(lm.SLOTS))[:, None] * (lm.CLASSES + 1)
    for a, b in zip(at, at[1:]):
        for i in range(a, b):
            assert [int(got[k, i]) for k in range(len(lm.SLOTS))] == [int(classes[i + d]) if a <= i + d < b else lm.CLASSES for d in lm.SLOTS]


# --- 6 mixing ------------------------------------------------------------------------------
def mixed(rows, tree, weights, fraction, epochs, seed=0):
    leaf = {}
    for path, i, n in rows:
        leaf.setdefault(path, []).append((i, n))
    own = {k: sum(n for _, n in v) for k, v in leaf.items()}

    def spread(prefix, budget):
        depth = len(prefix)
        if depth == len(tree):
            return {prefix: budget}
        kids = sorted({k[depth] for k in leaf if k[:depth] == prefix})
        room = {c: epochs * sum(t for k, t in own.items() if k[: depth + 1] == (*prefix, c)) for c in kids}
        weight = {c: weights.get(tree[depth], {}).get(c, 1.0) for c in kids}
        live, share, left = {c for c in kids if room[c]}, dict.fromkeys(kids, 0), budget
        while live:
            full = [c for c in live if room[c] <= left * weight[c] / sum(weight[d] for d in live)]
            if not full:
                share |= {c: left * weight[c] / sum(weight[d] for d in live) for c in live}
                break
            for c in full:
                share[c] = room[c]
                left -= room[c]
                live.discard(c)
        return {k: v for c in kids for k, v in spread((*prefix, c), share[c]).items()}

    out = []
    for path, share in spread((), fraction * sum(own.values())).items():
        if own[path]:
            whole, rest = divmod(math.floor(share), own[path])
            total = 0
            for i, n in sorted(leaf[path], key=lambda x: hashlib.md5(f"{seed}:{whole}:{x[0]}".encode()).hexdigest()):
                total += n
                if whole + (total <= rest):
                    out.append((i, n, whole + (total <= rest)))
    return sorted(out)


@pytest.mark.parametrize("fraction, epochs", [(0.5, 4), (1.7, 2), (9.0, 2)])
def test_mixing_equals_brute_force(docs, fraction, epochs):
    table = docs.withColumn("domain", mixing.domain_of())
    rows = [((r.domain, r.lang, r.source), r.doc_id, len(re.findall(r"[^ \t\n\x0b\f\r]+", r.text or ""))) for r in table.collect()]
    got = mixing.mix(table, mixing.TREE, mixing.WEIGHTS, fraction, epochs).select("doc_id", "n_tokens", "copies").collect()
    assert sorted(map(tuple, got)) == mixed(rows, mixing.TREE, mixing.WEIGHTS, fraction, epochs)


def test_mixing_odd_rows(odd):
    got = mixing.mix(odd, ["lang", "source"], {"lang": {"": 0.0}}, 1.0, 1)
    assert not [r for r in got.collect() if r.lang is None] and got.count() > 0
    assert mixing.mix(odd.limit(0), ["lang"], {}).count() == 0
    assert mixing.mix(odd, ["lang"], {}, 1.0, 1).filter("copies > 1").count() == 0


# --- 7 quality -----------------------------------------------------------------------------
def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.digest(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_quality_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(odd, none)
    assert {r.score for r in quality.score(odd, model).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)] + [(None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    scored = quality.score(odd, quality.fit(odd, labels))
    assert scored.count() == odd.count() and dict(scored.dtypes)["score"] == "double"
    kept = quality.accept(odd, quality.fit(odd, labels))
    assert kept.columns == odd.columns and kept.count() == scored.filter("predicted = 1").count()
    assert quality.score(odd.limit(0), model).count() == 0


# --- 8 sharding ----------------------------------------------------------------------------
def test_shards_equal_brute_force(docs, odd):
    for table in (docs, odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        rows = sorted((r.doc_id, r.text or "") for r in table.collect())
        total, before, slots, want = sum(len(t.encode()) + 1 for _, t in rows), 0, {}, []
        for i, t in rows:
            size = len(t.encode()) + 1
            k = min(7, before * 8 // total)
            slots[k] = slots.get(k, -1) + 1
            want.append((i, size, zlib.crc32(t.encode()), "bytes", k, slots[k], None))
            before += size
        assert sorted(map(tuple, shards.digest(table).collect())) == want
    assert shards.digest(odd.limit(0)).count() == 0
    got = shards.digest(odd).collect()
    assert len(got) == odd.count() and len({(r.shard, r.slot) for r in got}) == len(got)


# --- 9 personal data -----------------------------------------------------------------------
def luhn(digits):
    return sum(int(d) if k % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d)) for k, d in enumerate(reversed(digits))) % 10 == 0


def personal(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m[0])]


def test_pii_equals_brute_force(odd, docs):
    for table in (odd, docs):
        texts = {r.doc_id: r.text for r in table.collect()}
        for r in pii.digest(pii.find_pii(table)).collect():
            base = personal(texts[r.doc_id])
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
            assert r.spans.startswith(joined)


def test_pii_of_a_text_with_very_many_matches(spark):
    text = " ".join(f"é mail u{i}@h{i % 97}.org, {i % 300}.1.2.3 or 4111 1111 1111 {1100 + i % 50}\n" for i in range(3000))
    want = ",".join(f"{k}:{a}:{b}" for k, a, b in personal(text))
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.digest(pii.find_pii(table)).first().base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    spans = pii.find_pii(table).first().pii
    assert all(text[s["start"] : s["end"]] == s["text"] for s in spans) and {s["score"] for s in spans if s["kind"] == "email"} == {1.0}


def test_pii_context_check_digits_and_redaction(odd):
    row = pii.find_pii(odd).filter("doc_id = 13").first()
    assert [(s["kind"], s["text"], s["score"]) for s in row.pii] == [("phone", "+1 (487) 555-7209", 0.8), ("iban", "GB82 WEST 1234 5698 7654 32", 1.0)]
    clean = {r.doc_id: r.text for r in pii.redact(odd).collect()}
    assert clean[13] == "😀 call [phone] now; IBAN [iban] or GB82 WEST 1234 5698 7654 33" and clean[0] is None and clean[5] == LONG
    assert pii.find_pii(odd.limit(0)).count() == 0


def test_ibans_before_upper_case_and_digits(spark):
    de, gb, fr, no = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606", "NO93 8601 1117 947"
    cases = [
        (f"IBAN {de} BIC COBADEFF.", [de]), (f"IBAN {de} BIC COBADEFFXXX now", [de]), ("DE89370400440532013000 EUR 50", ["DE89370400440532013000"]),
        (f"{de} {gb} {fr} {no} 17", [de, gb, fr, no]), (f"XX12 CALL {gb} NOW", [gb]), (f"{de}1 {no}A DE89370400440532013001 EUR", []),
        (f"PAY {fr}, OR", [fr]), (de, [de]),
    ]
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: [s["text"] for s in r.pii if s["kind"] == "iban"] for r in pii.find_pii(table).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    clean = {r.doc_id: r.text for r in pii.redact(table.filter("doc_id = 1")).collect()}
    assert clean[1] == "IBAN [iban] BIC COBADEFFXXX now"


# --- 10 near-duplicates --------------------------------------------------------------------
def grouped(rows, size, percent=80):
    sets, up = {}, {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets[i], up[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set(), i

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    up[b] = a
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(spark, odd, docs, size, monkeypatch):
    base = [f"t{i}" for i in range(120)]
    chain = []
    for i in range(60):  # neighbours are alike, ends are not
        base = base[3:] + [f"n{i}_{k}" for k in range(3)]
        chain.append((1000 + i, " ".join(base)))
    near = spark.createDataFrame(chain, "doc_id long, text string")
    monkeypatch.setattr(neardup, "BLOCK", 8)
    for table in (odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), docs, near):
        got = sorted(map(tuple, neardup.near_duplicates(table, size).collect()))
        assert got == grouped([(r.doc_id, r.text) for r in table.collect()], size)


def test_near_duplicates_odd_rows(spark, odd):
    got = neardup.near_duplicates(odd)
    assert got.count() == odd.count()
    assert [tuple(r) for r in got.filter("doc_id IS NULL").collect()] == [(None, 1, None, True)]
    assert neardup.near_duplicates(odd.limit(0)).count() == 0
    two = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (2, "x y z"), (3, "x y z")], "doc_id long, text string")
    assert {r.component_id for r in neardup.near_duplicates(two).collect()} == {1}
    assert neardup.keep_one(odd).columns == odd.columns


# --- pipeline ------------------------------------------------------------------------------
def test_pipeline_stages(spark, sf_dir, docs):
    labels, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, sf_dir)
    kept = {r.doc_id for r in quality.score(docs, quality.fit(docs, labels)).filter("predicted = 1").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept
    single = stages["near_duplicates"](spark, good, sf_dir)
    assert sorted(r.doc_id for r in single.collect()) == [g[0] for g in grouped([(r.doc_id, r.text) for r in good.collect()], 5) if g[3]]
    clean = stages["decontamination"](spark, single, sf_dir)
    bench = [(r.item_id, r.text) for r in items.collect()]
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect() if not leaked(r.text, bench)[-1])
    blend = stages["mixing"](spark, clean, sf_dir)
    table = clean.withColumn("domain", mixing.domain_of())
    rows = [((r.domain, r.lang, r.source), r.doc_id, len(re.findall(r"[^ \t\n\x0b\f\r]+", r.text or ""))) for r in table.collect()]
    want = mixed(rows, mixing.TREE, corpus_pipeline.MIX_WEIGHTS, corpus_pipeline.MIX_FRACTION, corpus_pipeline.MIX_EPOCHS)
    assert blend.columns == docs.columns and sorted(r.doc_id for r in blend.collect()) == sorted(i for i, _, n in want for _ in range(n))
    last = stages["sharding"](spark, blend, sf_dir)
    assert last.columns == [*docs.columns, "size", "shard", "slot"] and last.count() == blend.count()


def test_pipeline_takes_empty_tables(spark, sf_dir, docs):
    table = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, sf_dir)
        assert table.count() == 0
