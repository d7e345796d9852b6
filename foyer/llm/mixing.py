"""Mixing sources to target weights: budgets down a domain-language-source tree, then token prefixes.

A node's budget goes to its children by weight. A child that has fewer tokens than its part takes what
it has, and its siblings share the rest by their weights, in turn as far as they have tokens; only what a
whole family lacks is left to the level above. As a child's tokens are all that lies below it, this is
one filling per family, from the root down: with r the tokens a child has for each unit of weight, the
children with the least r are filled and the others share in proportion. All in whole numbers.

A leaf takes a prefix of its rows' tokens in seeded epochs: as many whole epochs as its budget holds,
then the beginning of the next, whose order is the hash of (seed, epoch, key). To find where a prefix
ends, tokens are added up per leaf and per 4,096th of the hash range; only rows of a leaf's own
bucket need an order. So no leaf is sorted or gathered whole, however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foyer.llm.common import fresh, named, written

WIDE = "decimal(38,0)"


def weights_of(column: Column, weights: dict[str, int], default: int = 1) -> Column:
    """A column's weight by value; values that are not listed, null too, have the default."""
    found = F.lit(default)
    for value, weight in weights.items():
        found = F.when(column == F.lit(value), F.lit(weight)).otherwise(found)
    return found.cast("long")


def filled(nodes: DataFrame, parents: list[str], order: list[Column]) -> DataFrame:
    """Children with ``budget``: the parent's ``total`` shared by ``weight``, none above its ``tokens``.

    A child of weight 0 or without tokens gets nothing.
    """
    family = Window.partitionBy(*parents)
    wants = (F.col("weight") > 0) & (F.col("tokens") > 0)
    nodes = nodes.withColumns({
        "weight": F.when(wants, F.col("weight")).otherwise(F.lit(0)).cast(WIDE),
        "tokens": F.when(wants, F.col("tokens")).otherwise(F.lit(0)).cast(WIDE),
    })
    ratio = F.when(wants, F.col("tokens").cast("double") / F.col("weight").cast("double"))
    upward = family.orderBy(ratio.asc_nulls_first(), *order)
    so_far = upward.rowsBetween(Window.unboundedPreceding, 0)
    after = upward.rowsBetween(1, Window.unboundedFollowing)
    nodes = nodes.withColumns({
        "below": F.sum("tokens").over(so_far),
        "rest": F.coalesce(F.sum("weight").over(after), F.lit(0)).cast(WIDE),
    })
    full = (F.col("below") * F.col("weight") + F.col("tokens") * F.col("rest")) <= F.col("total") * F.col("weight")
    nodes = nodes.withColumn("full", full)
    nodes = nodes.withColumns({
        "spent": F.coalesce(F.sum(F.when(F.col("full"), F.col("tokens"))).over(family), F.lit(0)).cast(WIDE),
        "open": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(family), F.lit(0)).cast(WIDE),
    })
    part = F.expr("cast((total - spent) * weight div nullif(open, 0) as long)")
    budget = F.when(F.col("full"), F.col("tokens")).otherwise(F.coalesce(part, F.lit(0)))
    return nodes.withColumn("budget", budget.cast("long")).drop("below", "rest", "full", "spent", "open", "total")


def budgets(leaves: DataFrame, levels: list[str], weights: list[str], total: int) -> DataFrame:
    """Leaves (``levels``, a weight column per level, ``tokens``) with their ``budget``.

    ``tokens`` is what a leaf can give at most, epochs included. Level values may be null.
    """
    filled_up: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        path = [named(c) for c in levels[:depth]]
        nodes = leaves.groupBy(*path).agg(
            F.max(named(weights[depth - 1])).alias("weight"), F.sum("tokens").alias("tokens")
        )
        if filled_up is None:
            nodes = nodes.withColumn("total", F.lit(total).cast(WIDE))
        else:
            above = filled_up.select(
                *(named(c).alias(f"above_{i}") for i, c in enumerate(levels[: depth - 1])),
                F.col("budget").cast(WIDE).alias("total"),
            )
            same = [named(c).eqNullSafe(F.col(f"above_{i}")) for i, c in enumerate(levels[: depth - 1])]
            nodes = nodes.join(above, same).drop(*(f"above_{i}" for i in range(depth - 1)))
        filled_up = filled(nodes, levels[: depth - 1], [named(levels[depth - 1]).asc_nulls_first()])
    return filled_up.select(*map(named, levels), "tokens", "budget")


def position(seed: int, epoch: Column, key: str) -> Column:
    """A row's place in an epoch's order, as 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(
        named(key).cast("string"), F.lit("")
    )))


def mixed(
    docs: DataFrame, levels: list[str], weights: list[str], *, key: str = "doc_id", tokens: str = "n_tokens",
    share: tuple[int, int] = (1, 2), max_epochs: int = 2, seed: int = 0, tie: list[Column] | None = None,
) -> DataFrame:
    """The rows that the mixture takes, once per epoch, with ``epoch``, ``taken`` and ``mix_rank``.

    The whole budget is ``share`` (a fraction) of all tokens; ``weights`` names a column of whole weights
    for each level; a node's weight is the greatest of its rows. ``taken`` is how many of a row's
    tokens the leaf's prefix holds: all, but for the last row of the last epoch. ``mix_rank`` is the
    row's token offset in its epoch. Rows without tokens (null ones too) come with the row
    before them in the order if that is taken whole. Equal keys are ordered by ``tie``. An empty table
    gives an empty result. Columns of the new names are replaced.
    """
    new = ("epoch", "taken", "mix_rank")
    docs = docs.drop(*(c for c in docs.columns if c.lower() in new))
    n = fresh("mix_tokens", docs)
    docs = docs.withColumn(n, F.coalesce(F.greatest(named(tokens).cast("long"), F.lit(0).cast("long")), F.lit(0)))
    leaves = docs.groupBy(*map(named, levels)).agg(
        *(F.max(named(w)).alias(f"weight_{i}") for i, w in enumerate(weights)), F.sum(named(n)).alias("own_tokens"),
    ).withColumn("tokens", F.col("own_tokens") * max_epochs)
    leaves = written(leaves, "mix-leaves")
    total = (leaves.agg(F.sum("own_tokens")).head()[0] or 0) * share[0] // share[1]
    leaf = budgets(leaves, levels, [f"weight_{i}" for i in range(len(levels))], total).select(
        *(named(c).alias(f"leaf_{i}") for i, c in enumerate(levels)), "budget",
        F.floor(F.col("tokens") / max_epochs).cast("long").alias("leaf_tokens"),
    )
    # Whole epochs, then the last one with what is left.
    leaf = leaf.where("budget > 0").withColumns({
        "last": F.expr("budget div leaf_tokens"), "left": F.expr("budget % leaf_tokens"),
    })
    epochs = leaf.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))).where(
        "epoch < last or (epoch = last and left > 0)"
    ).withColumn("limit", F.when(F.col("epoch") < F.col("last"), F.col("leaf_tokens")).otherwise(F.col("left")))
    spread = docs.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    hashed, bucket, before = (fresh(f"mix_{x}", docs) for x in ("hash", "bucket", "before"))
    spread = spread.withColumn(hashed, position(seed, F.col("epoch"), key))
    spread = spread.withColumn(bucket, F.substring(named(hashed), 1, 3))
    path = [*map(named, levels), F.col("epoch")]
    sums = spread.groupBy(*path, named(bucket)).agg(F.sum(named(n)).alias("sum"))
    up_to = Window.partitionBy(*path).orderBy(named(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(before, F.coalesce(F.sum("sum").over(up_to), F.lit(0)))
    same_leaf = [named(c).eqNullSafe(F.col(f"leaf_{i}")) for i, c in enumerate(levels)]
    limits = sums.join(
        epochs.withColumnRenamed("epoch", "leaf_epoch"), [*same_leaf, F.col("epoch") == F.col("leaf_epoch")]
    ).where(named(before) < F.col("limit")).select(
        *(f"leaf_{i}" for i in range(len(levels))), "leaf_epoch", named(bucket).alias("leaf_bucket"),
        named(before), "limit",
    )
    rows = spread.join(limits, [
        *same_leaf, F.col("epoch") == F.col("leaf_epoch"), named(bucket) == F.col("leaf_bucket")
    ])
    within = Window.partitionBy(*path, named(bucket)).orderBy(
        named(hashed), named(key), *([F.xxhash64(*map(named, docs.columns))] if tie is None else tie)
    ).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("mix_rank", named(before) + F.sum(named(n)).over(within) - named(n))
    rows = rows.where(F.col("mix_rank") < F.col("limit")).withColumn(
        "taken", F.least(named(n), F.col("limit") - F.col("mix_rank")).cast("long")
    )
    return rows.select(*map(named, (c for c in docs.columns if c != n)), "epoch", "taken", "mix_rank")
