"""Mixing sources to target weights by hierarchical budgeting.

Every level of a tree (domain, language, source) hands its token budget to its children
by weight.  A child takes no more than its leaves can give (their tokens times the
epochs allowed); what it leaves goes to its siblings by weight, and only what they
cannot take either goes back to the siblings of the parent.  A leaf fills its budget
with whole epochs and the start of one more, each epoch in an order of its own that
the seed decides.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, free_name, stored

#: Budgets times weights stay exact in this type.
EXACT = "decimal(38,0)"


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def level_key(value: Column) -> Column:
    """A value as text, with a place of its own for null."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def epoch_order(seed: int, epoch: Column, doc_id: Column, text_md5: Column) -> Column:
    """Place of a document in an epoch: ordered as text; rows with equal id and text tie."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), text_md5))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]], default: int) -> Column:
    column = F.lit(default)
    for value, weight in weights.get(level, {}).items():
        column = F.when(F.col(level) == f"={value}", F.lit(weight)).otherwise(column)
    return column.cast("long")


def fill(nodes: DataFrame, parents: Sequence[str], child: str) -> DataFrame:
    """Share ``parent_budget`` among the children of each parent by ``weight``, up to ``cap``.

    Children in the order of cap to weight: those that the level of the rest would
    overfill take their cap, the others share what is left, to the token, by the
    differences of rounded running sums.  Returns nodes with ``budget``.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("cap") / F.col("weight"), child)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*parents)
    cap, weight, budget = (F.col(c).cast(EXACT) for c in ("cap", "weight", "parent_budget"))
    full = F.col("cap_to_here") * weight + cap * (F.col("weight_all") - F.col("weight_to_here")) <= budget * weight
    rest = budget - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole).cast(EXACT)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight")))
    to_here, total = open_weight.over(running).cast(EXACT), open_weight.over(whole).cast(EXACT)
    share = lambda w: F.call_function("div", rest * w, F.greatest(total, F.lit(1).cast(EXACT)))
    return (
        nodes.where("weight > 0")
        .withColumn("cap_to_here", F.sum("cap").over(running).cast(EXACT))
        .withColumn("weight_to_here", F.sum("weight").over(running).cast(EXACT))
        .withColumn("weight_all", F.sum("weight").over(whole).cast(EXACT))
        .withColumn("full", full)
        .withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share(to_here) - share(to_here - weight)).cast("long"))
        .drop("cap_to_here", "weight_to_here", "weight_all", "full")
    )


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: Column, max_epochs: int, default_weight: int) -> DataFrame:
    """Leaves (levels, leaf_tokens) with their ``budget``, filled from the root down."""
    # What stands below a weight of 0 is not taken, so no parent has room for it.
    taken = functools.reduce(lambda x, y: x & y, [_weight(level, weights, default_weight) > 0 for level in levels], F.lit(True))
    caps = leaves.select(*levels, F.when(taken, F.col("leaf_tokens") * max_epochs).otherwise(0).alias("cap"))
    parents: list[str] = []
    above = caps.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("cap_all")).select(F.least(budget, F.col("cap_all")).cast("long").alias("parent_budget"), F.lit(0).alias("root"))
    for level in levels:
        nodes = caps.groupBy(*parents, level).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights, default_weight)).withColumn("root", F.lit(0))
        shared = fill(nodes.join(above, ["root", *parents]), ["root", *parents], level)
        parents.append(level)
        above = shared.select("root", *parents, F.col("budget").alias("parent_budget"))
    return leaves.join(above.drop("root").withColumnRenamed("parent_budget", "budget"), list(levels), "left").withColumn("budget", F.coalesce("budget", F.lit(0).cast("long")))


def leaf_plans(docs: DataFrame, levels: Sequence[str], leaves: DataFrame, seed: int) -> DataFrame:
    """How much of each leaf is taken: ``full_epochs``, and ``cutoff``, the last place in the epoch after them.

    ``docs`` holds levels, doc_id, text_md5 and n_tokens.  Running sums go over the first
    digits of the places, then over the documents of the one bucket where the budget
    ends, so a leaf's size never meets in one task.
    """
    tokens = F.col("leaf_tokens")
    full = F.when(tokens > 0, F.call_function("div", F.col("budget"), F.greatest(tokens, F.lit(1)))).otherwise(F.lit(1)).cast("long")
    plans = leaves.withColumn("full_epochs", full).withColumn("rest", F.when(tokens > 0, F.col("budget") - F.col("full_epochs") * tokens).otherwise(F.lit(0)).cast("long"))
    placed = (
        docs.join(plans.select(*levels, "full_epochs", "rest").where("rest > 0"), list(levels))
        .select(*levels, "rest", "n_tokens", epoch_order(seed, F.col("full_epochs"), F.col("doc_id"), F.col("text_md5")).alias("place"))
        .withColumn("bucket", F.substring("place", 1, 3))
    )
    sums = placed.groupBy(*levels, "rest", "bucket").agg(F.sum("n_tokens").alias("bucket_tokens"))
    to_here = Window.partitionBy(*levels).orderBy("bucket")
    sums = sums.withColumn("sum_to_here", F.sum("bucket_tokens").over(to_here))
    crossing = sums.where("sum_to_here > rest").groupBy(*levels).agg(F.min(F.struct("bucket", (F.col("sum_to_here") - F.col("bucket_tokens")).alias("before"))).alias("at")).select(*levels, "at.bucket", "at.before")
    inside = Window.partitionBy(*levels).orderBy("place")
    # Rows at one place, which come in or stay out together, are one row of the window.
    at_places = placed.join(crossing, [*levels, "bucket"]).groupBy(*levels, "rest", "before", "place").agg(F.sum("n_tokens").alias("n_tokens"))
    taken = (
        at_places.withColumn("sum_to_here", F.col("before") + F.sum("n_tokens").over(inside))
        .where("sum_to_here <= rest")
        .groupBy(*levels)
        .agg(F.max("place").alias("last_place"))
    )
    cutoffs = crossing.join(taken, list(levels), "left").select(*levels, F.coalesce("last_place", "bucket").alias("cutoff"))
    return plans.join(cutoffs, list(levels), "left")


def mix_to_weights(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, int]],
    budget_share: float = 0.5,
    budget_tokens: int | None = None,
    max_epochs: int = 2,
    seed: int = 8,
    default_weight: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are taken, one for each epoch, with what was decided.

    ``levels`` names the levels from the root down, each a column over ``docs``;
    ``weights`` gives whole weights to their values, others have ``default_weight`` and 0
    takes nothing.  The budget is ``budget_tokens`` or the share of all tokens (words
    between ASCII white space).  Adds mix_levels (a struct of the levels), mix_tokens,
    mix_epoch, mix_place (order within leaf and epoch) and mix_budget (the leaf's).

    Sums stay within budgets: a document that would pass the leaf's budget ends it.
    Null levels are leaves of their own; documents without words cost nothing, and a leaf
    of only such is taken once; rows of equal id and text stand at one place and come in
    or stay out together; whole texts are counted, however long; an empty table gives no
    rows.  Columns of ``docs`` may have any names: they come out as they are, and an added
    column whose name one of them has gets underscores after it.
    """
    names = [f"mix_{i}" for i in range(len(levels))]
    by_name = {new: weights.get(old, {}) for new, old in zip(names, levels, strict=True)}
    # The row goes along as one value, so that no name of it meets one of the columns made here.
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("mix_row"),
        *[level_key(column).alias(new) for new, column in zip(names, levels.values(), strict=True)],
        F.struct(*[column.alias(name) for name, column in levels.items()]).alias("mix_levels"),
        F.col(id_col).alias("mix_id"),
        token_count(text_col).alias("mix_tokens"),
        F.md5(F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")).alias("mix_md5"),
    )
    lean = packed.select(*names, F.col("mix_id").alias("doc_id"), F.col("mix_md5").alias("text_md5"), F.col("mix_tokens").alias("n_tokens"))
    leaves = lean.groupBy(*names).agg(F.sum("n_tokens").alias("leaf_tokens"))
    if budget_tokens is None:
        total = leaves.agg(F.sum("leaf_tokens")).head()[0] or 0
        budget_tokens = int(total * budget_share)
    # Stored, so the planner knows their size: small ones are sent to the rows, and with large
    # ones both sides are shuffled for the join alone, where a hot leaf can be split.
    budgets = stored(leaf_budgets(leaves, names, by_name, F.lit(budget_tokens).cast("long"), max_epochs, default_weight), "mix-budgets")
    plans = stored(leaf_plans(lean, names, budgets, seed).select(*names, F.col("budget").alias("mix_budget"), "full_epochs", "cutoff"), "mix-plans")
    place = lambda epoch: epoch_order(seed, F.col(epoch), F.col("mix_id"), F.col("mix_md5"))
    epochs = F.col("full_epochs") + F.when(place("full_epochs") <= F.col("cutoff"), 1).otherwise(0)
    chosen = packed.join(plans, names).withColumn("mix_epochs", epochs).where("mix_epochs > 0")
    unfolded = chosen.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_epochs") - 1)))
    added = {"mix_levels": F.col("mix_levels"), "mix_tokens": F.col("mix_tokens"), "mix_epoch": F.col("mix_epoch"), "mix_place": place("mix_epoch"), "mix_budget": F.col("mix_budget")}
    return unfolded.select("mix_row.*", *[column.alias(free_name(name, docs.columns)) for name, column in added.items()])
