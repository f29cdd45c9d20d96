"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source; a leaf is one source of one language in one domain. A
token budget is handed down from the root. At every node the children share its budget by
weight. A child gets no more than its subtree holds (tokens times the epochs allowed), and
what it cannot take goes to its siblings by weight. A node's own share only falls when its
whole subtree is short, so a shortage is met by siblings before the ancestors' siblings.

A leaf fills its budget from seeded epochs: epoch e is the leaf's documents in the order of
md5(seed:e:doc_id). Whole epochs come first, then the longest prefix of the next epoch whose
tokens fit. No leaf is sorted for that: documents fall into buckets by hash, sums by bucket
find the bucket where the prefix ends, and only that one is sorted.

Budgets and weights are whole numbers; each node's division rounds down, so a mix may stay
below its budget by less than one token per node, and by less than one document per leaf.
Products of a budget and a node's total weight must stay below 9e18.

Edge cases: null domains, languages and sources are nodes of their own with the default
weight; a null text has no tokens and, like any document without tokens, comes with any epoch
that reaches its place; rows that repeat an id are rows of their own at the same place of the
order. If nothing has tokens the mix is empty. A weight of 0 leaves a node and all below it
out, also when its siblings are short; a negative weight is an error. Further columns pass
through, whatever their names; those named like the results are replaced.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlake.llm.columns import unused
from postlake.llm.rollup import word_count
from postlake.session import stage

LEVELS = ["domain", "lang", "source"]
#: Documents of a leaf per bucket, about.
BUCKET_DOCS = 1_000


@dataclass(frozen=True)
class Weights:
    """Weights by name at each level; names not listed have `default`."""

    domain: dict = field(default_factory=dict)
    lang: dict = field(default_factory=dict)
    source: dict = field(default_factory=dict)
    default: int = 1

    def __post_init__(self):
        if any(w < 0 for level in LEVELS for w in [*getattr(self, level).values(), self.default]):
            raise ValueError("weights must not be negative")

    def of(self, level: str) -> Column:
        chosen = F.lit(self.default)
        for name, weight in getattr(self, level).items():
            chosen = F.when(F.col(level) == name, F.lit(weight)).otherwise(chosen)
        return chosen.cast("bigint")

    def leave_out(self) -> Column:
        """Whether a weight on the path is 0."""
        out = F.lit(False)
        for level in LEVELS:
            out = out | (self.of(level) == 0)
        return out


def _share(nodes: DataFrame, parents: list[str], level: str, weights: Weights) -> DataFrame:
    """Adds `share`: nodes have `cap` and their parent's `budget`. A node is full if, when it
    and all fuller ones are served, it cannot take its part of what is left."""
    family = [F.col(f"_{p}") for p in parents] or [F.lit(0)]
    order = Window.partitionBy(*family).orderBy(F.try_divide("cap", "weight").asc_nulls_first(), F.col(level).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*family)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    placed = nodes.withColumn("weight", weights.of(level)).withColumn(
        "full", F.col("cap") * F.sum("weight").over(onward) <= F.col("weight") * left
    )
    rest = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    return placed.withColumn("rest", rest).withColumn("open", open_weight).withColumn(
        "share", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("rest * weight div open"))
    )


def leaf_budgets(leaves: DataFrame, budget: int, weights: Weights, epochs: int) -> DataFrame:
    """(domain, lang, source, n_docs, tokens, quota) from leaves without the quota."""
    # What a weight of 0 leaves out holds nothing: it is full with no share.
    held = leaves.withColumn("cap", F.when(weights.leave_out(), 0).otherwise(F.col("tokens") * epochs))
    given = None
    for depth, level in enumerate(LEVELS):
        parents, path = LEVELS[:depth], LEVELS[: depth + 1]
        nodes = held.groupBy(*path).agg(F.sum("cap").alias("cap"))
        if given is None:
            # The root has what the budget asks for, as far as the tree holds it: one number.
            total = nodes.agg(F.sum("cap")).first()[0] or 0
            nodes = nodes.withColumn("budget", F.lit(min(budget, total)).cast("bigint"))
        else:
            same = None
            for p in parents:
                match = F.col(p).eqNullSafe(F.col(f"_{p}"))
                same = match if same is None else same & match
            nodes = nodes.join(given, same).drop(*[f"_{p}" for p in parents])
        keyed = nodes.withColumns({f"_{p}": F.struct(p) for p in parents})
        shared = _share(keyed, parents, level, weights)
        given = shared.select(*[F.col(p).alias(f"_{p}") for p in path], F.col("share").alias("budget"))
    same = None
    for p in LEVELS:
        match = F.col(p).eqNullSafe(F.col(f"_{p}"))
        same = match if same is None else same & match
    return leaves.join(given, same).select(*leaves.columns, F.col("budget").alias("quota"))


def _order_key(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _bucket(key: Column, buckets: Column) -> Column:
    """The key's place in [0, buckets), by its first 32 bits."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * buckets / F.lit(2.0**32)).cast("bigint")


def mix(docs: DataFrame, domain: Column, budget_percent: int, weights: Weights, epochs: int = 2, seed: int = 17,
        count=word_count) -> DataFrame:
    """The documents chosen, with `domain`, `n_tokens` and `copies` (how often each is taken).

    The budget is a percentage of all tokens. Runs jobs when called.
    """
    tokens = count(F.coalesce(F.col("text"), F.lit("")))
    named = docs.withColumn("domain", domain).drop("n_tokens", "copies")
    slim = stage(named.select("doc_id", *LEVELS, tokens.alias("n_tokens")), "tokens")
    leaves = stage(
        slim.groupBy(*LEVELS).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens")), "leaves"
    )
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = leaf_budgets(leaves, total * budget_percent // 100, weights, epochs).where((F.col("tokens") > 0) & ~weights.leave_out()).select(
        *[F.col(p).alias(f"_{p}") for p in LEVELS],
        F.expr("quota div tokens").alias("whole"), (F.col("quota") % F.col("tokens")).alias("remainder"),
        F.greatest(F.lit(1), F.col("n_docs") / BUCKET_DOCS).cast("bigint").alias("buckets"),
    )
    plan = stage(plan, "plan")
    leaf = None
    for p in LEVELS:
        match = F.col(p).eqNullSafe(F.col(f"_{p}"))
        leaf = match if leaf is None else leaf & match

    def placed(rows: DataFrame, leaves: DataFrame) -> DataFrame:
        with_plan = rows.join(leaves, leaf).withColumn("_key", _order_key(seed, F.col("whole")))
        return with_plan.withColumn("_bucket", _bucket(F.col("_key"), F.col("buckets")))

    own = [f"_{p}" for p in LEVELS]
    by_leaf = Window.partitionBy(*[F.struct(p) for p in own]).orderBy("_bucket")
    sums = placed(slim, plan).groupBy(*own, "remainder", "_bucket").agg(F.sum("n_tokens").alias("n")).withColumn(
        "upto", F.sum("n").over(by_leaf)
    )
    # The prefix ends in the first bucket that does not fit whole; without one it is the epoch.
    ends = sums.where("upto > remainder").groupBy(*own).agg(
        F.min(F.struct("_bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("e")
    ).select(*[F.col(p).alias(f"_{p}") for p in own], F.col("e._bucket").alias("end"), F.col("e.before").alias("before"))
    same = None
    for p in own:
        match = F.col(p).eqNullSafe(F.col(f"_{p}"))
        same = match if same is None else same & match
    full_plan = stage(
        plan.join(ends, same, "left").select(*plan.columns, F.coalesce("end", "buckets").alias("end"), F.coalesce("before", F.lit(0)).alias("before")),
        "ends",
    )
    # The input's columns travel as one, apart from the plan's.
    rows = placed(named.select(F.struct(*[F.col(f"`{c}`") for c in named.columns]).alias("row"), "doc_id", *LEVELS, tokens.alias("n_tokens")), full_plan)
    in_order = Window.partitionBy(*[F.struct(p) for p in own]).orderBy("_key", "doc_id")
    final = rows.where("_bucket = end").withColumn(
        "_in", (F.sum("n_tokens").over(in_order) + F.col("before") <= F.col("remainder")).cast("bigint")
    )
    others = rows.where("_bucket <> end").withColumn("_in", (F.col("_bucket") < F.col("end")).cast("bigint"))
    return others.union(final).withColumn("copies", F.col("whole") + F.col("_in")).where("copies > 0").select(
        "row.*", "n_tokens", "copies"
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """Each chosen document as often as it is taken."""
    [copy] = unused(mixed.columns, "copy")
    return mixed.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).drop(copy)
