"""Mixing sources to target weights over a tree of domains, languages and sources.

Built-in expressions only.  Weights go down the tree; a node that cannot use its
share leaves the rest to its siblings, and what they cannot use either never
reaches the node, since each node's share is bounded by what its leaves hold.
Each leaf then takes whole epochs, and of the next one a prefix of a seeded order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarecohort.llm.texts import fresh
from rarecohort.sources.staging import stage

#: Hex digits of the order key that are summed before single rows are: 4096 buckets a leaf.
_DIGITS = 3


def words(text: str = "text") -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0)).cast("bigint")


def order_key(doc_id: Column, epoch: Column, seed: int) -> Column:
    """The place of a document in an epoch's seeded order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _weight(column: str, weights: dict[str, float]) -> Column:
    return reduce(lambda c, kv: F.when(F.col(column) == kv[0], float(kv[1])).otherwise(c), weights.items(), F.lit(1.0))


def fill(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``share``: the parent's ``budget`` by ``weight``, with nobody above its ``capacity``.

    Children are taken by capacity for their weight.  As long as the next one has
    less than what is left for the weights from it on, it takes all it has; the
    others share the rest by weight.  A child of weight 0 gets nothing.
    """
    group = Window.partitionBy(*parent)
    ordered = group.orderBy(F.col("ratio"), *[F.col(c) for c in nodes.columns if c not in ("capacity", "weight", "budget")])
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    usable = nodes.filter("weight > 0 AND capacity > 0").withColumn("ratio", F.col("capacity") / F.col("weight"))
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))) / F.sum("weight").over(onward)
    leveled = usable.withColumn("level", level).withColumn("full", F.col("ratio") <= F.col("level"))
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(group)
    share = F.when(F.col("full"), F.col("capacity").cast("double")).otherwise(F.least(common * F.col("weight"), F.col("capacity")))
    return leveled.withColumn("share", share).drop("ratio", "level", "full", "weight", "budget")


def budgets(leaves: DataFrame, tree: list[str], weights: dict[str, dict[str, float]], fraction: float, max_epochs: int) -> DataFrame:
    """(tree columns, tokens, share) for each leaf; ``leaves`` has the tree columns and tokens.

    The total is ``fraction`` of all tokens.  A value without a weight has 1.
    """
    # A leaf under a weight of 0 can hold nothing, so that its ancestors pass its share on.
    able = reduce(lambda c, t: c & (_weight(t, weights.get(t, {})) > 0), tree, F.lit(True))
    sized = leaves.withColumn("capacity", F.when(able, F.col("tokens") * max_epochs).otherwise(0))
    total = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * fraction).alias("budget"))
    # One row of a sum, and then no more rows than the tree has nodes.
    nodes = None
    for depth, column in enumerate(tree):
        path = tree[: depth + 1]
        own = sized.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(column, weights.get(column, {})))
        if nodes is None:
            own = own.withColumn("budget", total.scalar()).withColumn("__root", F.lit(0))
            nodes = fill(own, ["__root"]).drop("__root")
        else:
            above = nodes.select(*tree[:depth], F.col("share").alias("budget"))
            nodes = fill(own.join(above, tree[:depth]), tree[:depth])
    return leaves.join(nodes.select(*tree, "share"), tree, "left").withColumn("share", F.coalesce("share", F.lit(0.0)))


def mix(
    docs: DataFrame,
    tree: list[str],
    weights: dict[str, dict[str, float]],
    fraction: float = 0.5,
    max_epochs: int = 4,
    seed: int = 0,
    tokens: Column | None = None,
    doc_id: str = "doc_id",
) -> DataFrame:
    """Adds n_tokens and copies (how many epochs hold the document), for documents with one or more.

    A leaf with a share of s tokens and t of its own takes s div t whole epochs and,
    of the next, the longest prefix of the seeded order with at most s mod t
    tokens.  Nulls in tree columns are the value ''.  Rows of one doc_id in a leaf have one
    place in the order and go together.  Texts without words cost nothing and go
    with the prefix that reaches them; a leaf without tokens gives nothing.
    An empty table gives an empty one; the two results replace columns of their names.
    """
    tokens = words() if tokens is None else tokens
    level = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in tree]
    slim = stage(docs.select(F.col(doc_id).alias("doc_id"), *level, tokens.alias("n_tokens")), "mixing")
    leaves = stage(slim.groupBy(*tree).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    shares = budgets(leaves, tree, weights, fraction, max_epochs).filter("tokens > 0")
    whole = F.floor(F.col("share")).cast("bigint")
    plan = shares.select(*tree, F.expr("CAST(floor(share) AS BIGINT) div tokens").alias("epochs"), (whole % F.col("tokens")).alias("rest"))
    plan = stage(plan, "shares")
    keyed = slim.join(plan, tree).withColumn("key", order_key(F.col("doc_id"), F.col("epochs"), seed)).withColumn("bucket", F.substring("key", 1, _DIGITS))
    sums = keyed.groupBy(*tree, "rest", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    running = Window.partitionBy(*tree).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = stage(sums.withColumn("until", F.sum("tokens").over(running)), "sums")
    # The last bucket that fits as a whole, and the next one, of which some rows fit.
    fitting = sums.filter("until <= rest").groupBy(*tree).agg(F.max("bucket").alias("bucket"))
    cut = sums.filter("until > rest").groupBy(*tree).agg(F.min("bucket").alias("bucket"), F.min(F.col("until") - F.col("tokens")).alias("before"))
    order = Window.partitionBy(*tree).orderBy("key")  # rows of one key are peers and summed together
    inside = keyed.join(cut, [*tree, "bucket"]).withColumn("until", F.col("before") + F.sum("n_tokens").over(order))
    last = inside.filter("until <= rest").select(*tree, F.col("key").alias("last"))
    last = last.unionAll(fitting.select(*tree, F.concat("bucket", F.lit("~")).alias("last")))
    ends = stage(plan.join(last.groupBy(*tree).agg(F.max("last").alias("last")), tree, "left"), "ends")
    # Back to the documents: a lookup by leaf and a comparison of keys.
    names = {c: fresh(docs.columns, f"__{c}") for c in [*tree, "epochs", "last"]}
    ends = ends.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).cast("string"), F.lit("")) == F.col(names[c]) for c in tree])
    own = docs.withColumn("n_tokens", tokens).drop("copies").join(ends, same)
    taken = F.coalesce(order_key(F.col(doc_id), F.col(names["epochs"]), seed) <= F.col(names["last"]), F.lit(False))
    own = own.withColumn("copies", F.col(names["epochs"]) + taken.cast("bigint")).drop(*names.values())
    return own.filter("copies > 0")


# --- fixed values of the registered query ------------------------------------------------
TREE = ["domain", "lang", "source"]
WEIGHTS = {
    "domain": {"web": 0.4, "books": 0.3, "forums": 0.2, "reference": 0.1},
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
}
# -----------------------------------------------------------------------------------------


def domain_of(source: str = "source") -> Column:
    """A stand-in for the domain, which the documents lack: by the number in the source's name."""
    number = F.coalesce(F.regexp_extract(F.col(source), "([0-9]+)", 1).try_cast("int"), F.lit(0)) % 4
    return F.element_at(F.array(*map(F.lit, WEIGHTS["domain"])), number + 1)


def digest(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang", "source", domain_of().alias("domain"))
    return mix(rows, TREE, WEIGHTS).select("doc_id", *TREE, "n_tokens", "copies")
