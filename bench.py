"""Times the headline queries and prints one JSON line.

The inputs that a user would have, a parsed Parquet table and VCF text, are
derived from ``lineitem`` and written first (``prepare``).  ``queries`` holds
the last of three runs over them; ``first_run`` is what a new JVM takes, mostly
class loading and code generation at this data size.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import fixtures
from checks.queries import ON_VARIANTS
from rarecohort.sources.cohort import conform
from rarecohort.sources.staging import stage
from rarecohort.sources.vcf import parse_lines

HEADLINE = [
    "gene_level",
    "bin_level_fixed",
    "bin_level_overlap",
    "variant_level",
    "filter_cascade_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    cohort = stage(conform(fixtures.variants(spark, sf_dir)), "variants")
    text = fixtures.vcf_text(spark, sf_dir)
    prepare = round(time.perf_counter() - start, 3)
    runs = {name: lambda name=name: ON_VARIANTS[name](cohort) for name in HEADLINE}
    runs["vcf_parse"] = lambda: parse_lines(text)
    passes = []
    for _ in range(3):
        seconds = {}
        for name, run in runs.items():
            start = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        passes.append(seconds)
    last = passes[-1]
    result = {
        "metric": "headline_total",
        "value": round(sum(last.values()), 3),
        "unit": "sec",
        "queries": last,
        "first_run": passes[0],
        "prepare": prepare,
        "transcript_rows": cohort.count(),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
