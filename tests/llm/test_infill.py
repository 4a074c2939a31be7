"""Fill-in-the-middle against a plain scan of the units."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rarecohort.llm import infill

_rng = random.Random(13)
LONG = "".join(_rng.choice(["abc", "Z", " ", "é", "😀", "\n", "7", "<", "S>"]) for _ in range(40_000))
TEXTS = [None, "", "a", "é", "abc" * 3000, "no <M> here", "a<S", "<", "x <P", "> y", LONG, LONG, "\x00 a\r\n b", " " * 3000]


def units(text):
    return re.findall("[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)


def brute(key, text):
    text, key = text or "", "" if key is None else key
    u = units(text)
    h = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return len(u), form, len(p), len(m), out


def rows():
    return [(i, t, "mine", -1) for i, t in enumerate(TEXTS * 12)] + [(3, "again", "mine", -1), (None, "a b c d e", "mine", -1)]


def test_equals_brute_force(spark):
    table = spark.createDataFrame(rows(), "doc_id long, text string, output string, n int")
    made = infill.fill_in_middle(table)
    assert made.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", infill.restore()).collect()
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_empty_table_and_digest(spark):
    table = spark.createDataFrame(rows(), "doc_id long, text string, output string, n int")
    assert infill.fill_in_middle(table.limit(0)).count() == 0
    for r in infill.digest(table).join(table.select("doc_id", F.coalesce("text", F.lit("")).alias("t")), "doc_id").filter("doc_id != 3").collect():
        want = brute(r.doc_id, r.t)
        assert r.output_sha256 == hashlib.sha256(want[4].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(r.t.encode()).hexdigest()


def test_every_cut_of_every_block_size():
    texts = ["", "ab cd  éé", "x" * 50, "a1b2", "😀" * 9]
    for block in (1, 2, 3, 8, 64):
        trees = infill.BlockTrees(pa.array(texts), block)
        for r, t in enumerate(texts):
            u = units(t)
            assert trees.n[r] == len(u) and trees.chars[r] == len(t)
            for k in range(len(u) + 1):
                byte, chars = trees.cut(np.array([r]), np.array([k]))
                head = "".join(u[:k])
                assert byte[0] - trees.offsets[r] == len(head.encode()) and chars[0] == len(head)
