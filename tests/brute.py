"""Plain-Python results on small cohorts, and the cohorts."""

from __future__ import annotations

import math
import random
from collections import defaultdict

from pyspark.sql import types as T

COLS = "Patient_ID CHROM POS REF ALT SYMBOL Consequence IMPACT Gene GT gnomADg_AF".split()
SCHEMA = T.StructType([T.StructField(c, T.LongType() if c == "POS" else T.StringType()) for c in COLS])
RANK = {"HIGH": 4, "MODERATE": 3, "LOW": 2}
LABEL = {4: "HIGH", 3: "MODERATE", 2: "LOW", 1: "MODIFIER"}


def cohort(seed: int, n: int = 600, hot: bool = False) -> list[tuple]:
    """Random transcript rows; ``hot`` gives one patient and gene a third of them."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        h = hot and rng.random() < 0.4
        pos = rng.randrange(1, 60)
        rows.append(
            (
                "P0" if h else f"P{rng.randrange(6)}",
                "chr1" if h else rng.choice(["chr1", "chr2", "chrX", "chrUn_1", None]),
                rng.choice([pos, pos, pos, None]),
                rng.choice(["A", "A", "C", None]),
                rng.choice(["G", "G", "T"]),
                "HOT" if h else rng.choice(["G1", "G2", "G3", "", None]),
                rng.choice(["stop_gained", "intron_variant&missense_variant", None]),
                rng.choice(["HIGH", "MODERATE", "LOW", "MODIFIER", "other", None]),
                rng.choice(["ENSG1", "ENSG2", None]),
                rng.choice(["0/1", "1|1", "0/0", "./.", "0|0", ".|.", "./1", "1", None]),
                rng.choice(["0.001", "0.01", "0.02", "0.001&0.02", "", "NaN", None]),
            )
        )
    return rows


def _rare(af, limit):
    if af is None:
        return True
    try:
        return float(af) <= limit
    except ValueError:
        return True


def kept(rows, max_af):
    out = []
    for r in rows:
        d = dict(zip(COLS, r))
        if d["GT"] in (None, "0/0", "./.", "0|0", ".|.") or d["POS"] is None or not _rare(d["gnomADg_AF"], max_af):
            continue
        d["rank"] = RANK.get(d["IMPACT"], 1)
        out.append(d)
    return out


def genes(rows, max_af):
    n = len({r[0] for r in rows})
    best = {}
    for d in kept(rows, max_af):
        if None in (d["CHROM"], d["REF"], d["ALT"]) or not d["SYMBOL"]:
            continue
        key = (d["Patient_ID"], d["CHROM"], d["POS"], d["REF"], d["ALT"])
        best[key] = min(best.get(key, (0, "")), (-d["rank"], d["SYMBOL"]))
    groups = defaultdict(list)
    for (p, c, pos, _, _), (rank, sym) in best.items():
        groups[sym, c].append((p, pos, -rank))
    out = {}
    for key, g in groups.items():
        lo, hi = min(x[1] for x in g), max(x[1] for x in g)
        out[key] = dict(
            patient_count=len({x[0] for x in g}),
            variant_count=len(g),
            gene_start=lo,
            gene_end=hi,
            density=len(g) / ((hi - lo + 1) * n),
            worst_impact=LABEL[max(x[2] for x in g)],
        )
    return out


def bins(rows, max_af, length, overlap):
    n, gene, step = len({r[0] for r in rows}), genes(rows, max_af), length - overlap
    seen = {}
    for d in kept(rows, max_af):
        g = gene.get((d["SYMBOL"], d["CHROM"]))
        if g and g["gene_start"] <= d["POS"] <= g["gene_end"]:
            key = (d["Patient_ID"], d["SYMBOL"], d["CHROM"], d["POS"], d["REF"], d["ALT"])
            seen[key] = max(seen.get(key, 0), d["rank"])
    groups = defaultdict(list)
    for (p, sym, c, pos, _, _), rank in seen.items():
        g = gene[sym, c]
        for i in range(math.ceil((g["gene_end"] - g["gene_start"] + 1) / step)):
            start = g["gene_start"] + i * step
            if start <= pos <= start + length - 1:
                groups[sym, c, start].append((p, rank))
    out = {}
    for (sym, c, start), g in groups.items():
        end = min(start + length - 1, gene[sym, c]["gene_end"])
        out[sym, c, start] = dict(
            bin_end=end,
            variant_count=len(g),
            patient_count=len({x[0] for x in g}),
            density=len(g) / ((end - start + 1) * n),
            worst_impact=LABEL[max(x[1] for x in g)],
        )
    return out
