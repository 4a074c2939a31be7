"""Quality rules against plain Python, in any order of the rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rarecohort.llm import rules

_rng = random.Random(5)
LONG = " ".join(_rng.choice(["alpha", "beta", "Gamma,", "épsilon", "😀"]) + str(_rng.randrange(90)) for _ in range(30_000))
PROSE = " ".join(f"word{i} of" if i % 7 else "end.\n" for i in range(60))
TEXTS = [
    None, "", " \n\t", "one", "a b a b a b", PROSE, PROSE.upper(), PROSE + " #" * 20, "same line here\n" * 40, "- " + PROSE.replace("\n", "\n- "),
    PROSE.replace(" ", " ... ... ").replace("\n", "...\n"), "1 2 3 " * 30, "a\x0bb\x0cc\rd\x1ce\xa0f", "x y z\nx y z\r\nx y z\n\n \n", LONG, LONG, "a " * 5000,
    "wonderful! " * 3 + PROSE.replace(" ", "! "), " ".join(f"{i}w" for i in range(49)), " ".join(f"{i}w" for i in range(50)), "x" * 9000,
]


def counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {j for places in seen.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_bullets": sum(x.lstrip("\t\n\v\f\r ")[:1] in ("-", "*", "•") for x in lines),
        "n_ellipses": sum(x.rstrip("\t\n\v\f\r ").endswith(("...", "…")) for x in lines),
        "n_letter_words": sum(bool(re.search(r"[A-Za-z\x80-\U0010ffff]", x)) for x in w),
        "n_letters": len(re.findall("[A-Za-z]", t)), "n_capitals": len(re.findall("[A-Z]", t)), "n_shouts": t.count("!"),
    }


def failing(c):
    n, lines = c["n_words"], c["n_lines"]
    tests = {
        "few_words": n < 50, "repeats": 100 * c["n_repeat_words"] > 50 * n, "symbols": 10 * c["n_symbols"] > n,
        "word_length": c["word_chars"] < 3 * n or c["word_chars"] > 10 * n, "dup_lines": 2 * c["n_dup_lines"] > lines,
        "bullets": 10 * c["n_bullets"] > 9 * lines, "ellipses": 10 * c["n_ellipses"] > 3 * lines, "no_letters": 10 * c["n_letter_words"] < 8 * n,
        "capitals": 2 * c["n_capitals"] > c["n_letters"], "shouts": 10 * c["n_shouts"] > 3 * n,
    }
    return [k for k, v in tests.items() if v]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "mine", 0) for i, t in enumerate(TEXTS)] + [(5, PROSE, "mine", 0), (None, PROSE, "mine", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, failed_rule string, words int")


@pytest.mark.parametrize("turn", [0, 3, 7])
def test_first_failing_rule_in_a_given_order(table, turn):
    order = rules.RULES[turn:] + rules.RULES[:turn]
    names = [r.name for r in order]
    features = tuple(counts(""))
    for r in rules.apply_rules(table, order, always=features, ordered=True).collect():
        want = counts(r.row.text)
        assert {k: r[k] for k in want} == want
        bad = failing(want)
        assert r.failed_rule == (min(bad, key=names.index) if bad else None)


def test_sampled_order_keeps_the_same_rows(table, monkeypatch):
    table = table.coalesce(1)
    monkeypatch.setattr(rules, "SAMPLE_SHARE", 1.0)
    kept = rules.keep_good(table)
    assert kept.columns == table.columns
    want = [r.doc_id for r in table.collect() if not failing(counts(r.text))]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, want)) and want
    assert rules.apply_rules(table.limit(0), rules.RULES[:2]).count() == 0
    assert rules.keep_good(table, []).count() == table.count()


def test_skipped_features_are_not_made(table):
    order = [r for r in rules.RULES if r.name in ("few_words", "repeats")]
    df = rules.apply_rules(table, order, ordered=True)
    bomb = rules.Rule("bomb", lambda: F.raise_error("looked at a failed row").cast("boolean"), ())
    short = rules.apply_rules(table.filter("length(text) < 20"), [*order[:1], bomb], ordered=True)
    assert {r.failed_rule for r in short.collect()} == {"few_words"}
    assert df.filter("failed_rule = 'repeats'").count() > 0


def test_order_by_rejections_per_cost():
    verdicts = [[True, True, False], [True, True, False], [False, False, True], [False, False, False]]
    assert rules.best_order(verdicts, [1.0, 0.5, 1.0]) == [1, 2, 0]
    assert rules.best_order([], [1.0, 1.0]) == [0, 1]


def test_no_python_in_the_plan(table):
    assert "Python" not in (plan := rules.digest(table)._jdf.queryExecution().toString()) and "Arrow" not in plan
