"""Mixing sources to target weights: budgets flow down a tree, shortages go to siblings, leaves give seeded token prefixes.

Everything is DataFrame work. Windows run over the tree's nodes or over slices of a leaf, never over
a whole leaf: a leaf's rows are ranked by a seeded hash, cut into hash slices, and a slice begins
where the sums of the earlier slices end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tiffinlake.session import materialize

SLICE_DIGITS = 3  # hex digits of a row's hash that name its slice of a leaf


def word_count(text: Column) -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.size(F.array_remove(F.split(text, r"[ \t\n\x0B\f\r]+"), "")), F.lit(0)).cast("long")


def _node(value: object) -> str:
    """Name of a value as a tree node, never null, so that it can be a join key."""
    return "" if value is None else f"={value}"


def _weight(path: Sequence[Column], weights: Mapping[tuple, float]) -> Column:
    """Weight of a node given by its path of node names; nodes that are not listed weigh 1."""
    out = F.lit(1.0)
    for key, value in weights.items():
        if len(key) == len(path):
            same = F.lit(True)
            for column, part in zip(path, key):
                same = same & (column == F.lit(_node(part)))
            out = F.when(same, F.lit(float(value))).otherwise(out)
    return out


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple, float], total: Column, epochs: float) -> DataFrame:
    """``leaves`` (one row each, with ``tokens``) with a ``budget``: the total, shared out from the root down.

    A node can take ``epochs`` times the tokens of its open leaves; leaves below a weight of 0 take
    nothing. Siblings share their parent's budget by weight; one
    that cannot take its share takes what it can, and the rest goes to its siblings by weight, until
    it fits. As a parent never gets more than its children can take together, a shortage leaves a
    family only when the whole family is short. With siblings ordered by capacity over weight, those
    that are full form a beginning: sibling ``i`` is full if the capacities up to it, and its own
    level for all later ones, stay within the budget.
    """
    nodes = leaves.withColumn("__cap", F.when(_open(levels, weights), F.col("tokens") * F.lit(float(epochs))).otherwise(0.0))
    for depth in range(len(levels), 0, -1):
        own = Window.partitionBy(*levels[:depth])
        nodes = nodes.withColumn(f"__cap{depth}", F.sum("__cap").over(own))
    nodes = nodes.withColumn("budget", F.least(total.cast("double"), F.sum("__cap").over(Window.partitionBy(F.lit(0)))))
    for depth in range(1, len(levels) + 1):
        family, path = levels[:depth - 1], levels[:depth]
        # One row of each node carries its capacity and weight; further leaves below it carry none.
        first = F.row_number().over(Window.partitionBy(*path).orderBy(*levels)) == 1
        weight = _weight([F.col(c) for c in path], weights)
        nodes = (nodes.withColumn("__w", weight).withColumn("__first", first)
                 .withColumn("__c", F.when(F.col("__first"), F.col(f"__cap{depth}")).otherwise(0.0))
                 .withColumn("__v", F.when(F.col("__first"), F.col("__w")).otherwise(0.0))
                 .withColumn("__level", F.when(F.col("__w") > 0, F.col(f"__cap{depth}") / F.col("__w")).otherwise(F.lit(float("inf")))))
        by = [F.lit(0)] if not family else [F.col(c) for c in family]
        order = Window.partitionBy(*by).orderBy("__level", *path).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*by)
        nodes = (nodes.withColumn("__below_c", F.sum("__c").over(order)).withColumn("__below_v", F.sum("__v").over(order))
                 .withColumn("__all_v", F.sum("__v").over(whole))
                 .withColumn("__full", (F.col("__w") > 0) & (F.col("__below_c") + F.col("__level") * (F.col("__all_v") - F.col("__below_v"))
                                                            <= F.col("budget") * (1 + 1e-12)))
                 .withColumn("__taken", F.sum(F.when(F.col("__full"), F.col("__c")).otherwise(0.0)).over(whole))
                 .withColumn("__open", F.sum(F.when(~F.col("__full"), F.col("__v")).otherwise(0.0)).over(whole))
                 .withColumn("budget", F.when(F.col("__full"), F.col(f"__cap{depth}"))
                             .when((F.col("__open") > 0) & (F.col("__w") > 0),
                                   F.least(F.col(f"__cap{depth}"), (F.col("budget") - F.col("__taken")) * F.col("__w") / F.col("__open")))
                             .otherwise(0.0)))
    return nodes.select(*[F.col(c) for c in levels], "tokens", "budget")


def mix(docs: DataFrame, levels: Sequence[str | Column], tokens: Column, weights: Mapping[tuple, float] | None = None,
        total: int | None = None, share: float = 1.0, epochs: float = 1.0, key_col: str = "doc_id", seed: int = 10) -> DataFrame:
    """The rows of ``docs`` chosen for a mixture, with ``mix_epoch``, ``mix_tokens`` and ``mix_place`` (tokens up to and with it).

    ``levels`` name the tree from the root down, for example domain, language and source (columns
    or expressions; a null is a value of its own). ``weights`` gives nodes a weight by path; others
    weigh 1, a weight of 0 shuts a node out. The token budget is ``total``, or ``share`` of all
    tokens; a leaf may be read up to ``epochs`` times. Of its budget a leaf gives whole epochs
    first, then the rows of the next epoch, in that epoch's seeded order, as long as the budget
    holds: a row that would cross it ends the prefix. So no leaf exceeds its budget, and each misses
    it by less than one row.

    ``mix_place`` counts the tokens of the leaf's last, partial epoch up to and with the row; rows of
    whole epochs have none. Rows are ordered by a seeded hash of key and epoch; equal rows follow each other and
    count each. Rows without tokens cost nothing and are taken while the prefix lasts; a leaf
    without any token is kept whole, once, unless a node above it has weight 0. A null key is a key. Columns of ``docs`` named like an added one
    are replaced. An empty table gives an empty one.
    """
    added = ("mix_epoch", "mix_tokens", "mix_place")
    kept = [c for c in docs.columns if c not in added]
    names = [f"__l{i}" for i in range(len(levels))]
    nodes = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in levels]
    rows = docs.select("*", *[F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(n) for c, n in zip(nodes, names)],
                       F.coalesce(tokens, F.lit(0)).cast("long").alias("__t"))
    leaves = rows.groupBy(*names).agg(F.sum("__t").alias("tokens"))
    everything = leaves.withColumn("__all", F.sum("tokens").over(Window.partitionBy(F.lit(0))))
    goal = F.lit(total) if total is not None else F.col("__all") * F.lit(float(share))
    plan = budgets(everything, names, weights or {}, goal, epochs)
    plan = (plan.withColumn("__whole", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens") + 1e-9)).otherwise(0).cast("long"))
            .withColumn("__rest", F.floor(F.col("budget") + 1e-6).cast("long") - F.col("__whole") * F.col("tokens"))
            .withColumn("__open", _open(names, weights or {}) & (F.col("tokens") == 0))
            .select(*names, "__whole", "__rest", "__open"))
    # One row a leaf, stored: the planner broadcasts it if, and only if, the file is small.
    plan = materialize(plan, "budgets")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__whole").cast("string"), F.coalesce(F.col(key_col).cast("string"), F.lit(""))))
    ordered = (rows.join(plan, names).withColumn("__h", order)
               .withColumn("__slice", F.substring("__h", 1, SLICE_DIGITS)))
    slices = ordered.groupBy(*names, "__slice").agg(F.sum("__t").alias("__sum"))
    earlier = Window.partitionBy(*names).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(slices.select(*names, "__slice", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before")), "slices")
    steps = Window.partitionBy(*names, "__slice").orderBy("__h", "__t").rowsBetween(Window.unboundedPreceding, 0)
    placed = ordered.join(before, [*names, "__slice"]).withColumn("__to", F.col("__before") + F.sum("__t").over(steps))
    part = F.col("__open") | ((F.col("__rest") > 0) & (F.col("__to") <= F.col("__rest")))
    out = (placed.withColumn("__times", F.col("__whole") + part.cast("long")).where("__times > 0")
           .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1))))
    place = F.when(F.col("mix_epoch") == F.col("__whole"), F.col("__to"))
    return out.select(*kept, "mix_epoch", F.col("__t").alias("mix_tokens"), place.alias("mix_place"))


def _open(names: Sequence[str], weights: Mapping[tuple, float]) -> Column:
    """Whether no node on the way to a leaf has weight 0."""
    return _all([_weight([F.col(n) for n in names[:d]], weights) > 0 for d in range(1, len(names) + 1)])


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
