"""Mixing sources to target weights: budgets down a tree of sources, then a token prefix of each leaf.

A node's budget goes to its children by weight. A child that cannot take its share, because its texts
times the allowed epochs hold fewer tokens, takes all it has; what it leaves goes to its siblings by
weight, and only what no sibling can take goes to the siblings of an ancestor. Every level is one
window over nodes, never over texts. A leaf then repeats whole epochs and takes the last tokens from
the front of one more epoch in a seeded order. The front's end is found from token sums of hash
ranges, so no task sorts a leaf.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.components import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Texts in one hash range of a leaf, on average.
RANGE_TEXTS = 1024


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _fill(children: DataFrame, parent: list[str], own: str) -> DataFrame:
    """Share each parent's budget (``budget``) among its children (``weight``, ``cap``) by water-filling."""
    ordered = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), own)
    before = F.coalesce(F.sum("cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    leveled = children.withColumn("level", (F.col("budget") - before) / rest)
    open_level = F.when(F.col("level") < F.col("cap") / F.col("weight"), F.col("level"))
    first_open = F.first(open_level, ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    shared = leveled.withColumn("given", F.when(open_level.isNull(), F.col("cap")).otherwise(F.col("weight") * first_open))
    return shared.drop("budget", "level").withColumnRenamed("given", "budget")


def leaf_budgets(leaves: DataFrame, weights: DataFrame, levels: int, share: float, epochs: int) -> DataFrame:
    """Budget of every leaf (l0.., docs, supply) in tokens, from ``share`` of all tokens.

    ``weights`` holds (node, weight): a node is the array of names from the top; nodes not listed weigh
    1, and nodes of weight 0 or less get nothing.
    """
    names = [f"l{k}" for k in range(levels)]
    caps = leaves.withColumn("cap", F.col("supply").cast("double") * epochs)
    total = leaves.agg(F.floor(F.coalesce(F.sum("supply"), F.lit(0)) * F.lit(share)).cast("double")).first()[0]
    filled = None
    for k in range(levels):
        nodes = caps.groupBy(*names[: k + 1]).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("node", F.array(*names[: k + 1])).join(weights, "node", "left").drop("node")
        nodes = nodes.withColumn("weight", F.coalesce("weight", F.lit(1.0))).where("weight > 0")
        nodes = nodes.withColumn("budget", F.lit(total)) if filled is None else nodes.join(filled, names[:k])
        filled = _fill(nodes, names[:k], names[k]).select(*names[: k + 1], "budget")
    return leaves.join(filled, names, "left").withColumn(
        "take", F.floor(F.coalesce("budget", F.lit(0.0)) + F.lit(1e-6)).cast("long")
    ).drop("budget")


def _key(seed: int, epoch: str | Column, id_text: Column) -> Column:
    """Place of a text in one epoch of its leaf."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(epoch).cast("string"), id_text).cast("binary"))


def mix_sources(
    docs: DataFrame,
    levels: Iterable[Column],
    weights: DataFrame,
    share: float,
    epochs: int,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """Every row of ``docs`` with mix_tokens, mix_copies and mix_prefix.

    ``levels`` are the columns of the tree from the top (null counts as an empty name), ``weights``
    rows (node array, weight double), ``share`` the budget as a part of all tokens, ``epochs`` how
    often a text may be used at most. ``tokens`` counts a text's tokens, words by default.

    mix_tokens is the text's tokens, mix_copies how often it is taken whole, mix_prefix how many of
    its first tokens the leaf takes once more (0 for all texts but the last one of a leaf). A null
    or empty text has no tokens; a null id is an id like others. Rows of one leaf that share an id
    stand at one place of the order and share a prefix evenly, rounded down. Columns of ``docs`` named
    mix_tokens, mix_copies or mix_prefix are replaced. An empty table gives an empty result.
    """
    levels = list(levels)
    names = [f"l{k}" for k in range(len(levels))]
    counted = word_count(text_col) if tokens is None else tokens
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    leaf_names = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels)]
    slim = stored(docs.select(id_text.alias("id"), *leaf_names, counted.alias("tokens")), "mix-tokens")

    leaves = slim.groupBy(*names).agg(F.count("*").alias("docs"), F.sum("tokens").alias("supply"))
    plan = leaf_budgets(stored(leaves, "mix-leaves"), weights, len(levels), share, epochs)
    whole = F.when(F.col("supply") > 0, F.expr("take div greatest(supply, 1)")).otherwise(F.lit(0))
    plan = plan.withColumn("epoch", whole.cast("long")).withColumn("rest", F.col("take") - F.col("epoch") * F.col("supply"))
    plan = stored(plan, "mix-budgets")

    ranges = F.greatest(F.lit(1), F.expr(f"docs div {RANGE_TEXTS}"))
    placed = slim.join(plan.where("rest > 0"), names).withColumn("key", _key(seed, "epoch", F.col("id")))
    placed = placed.withColumn(
        "part", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * ranges / F.lit(2.0**32)).cast("long")
    )
    sums = placed.groupBy(*names, "part", "rest").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    edge = sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("tokens"))
    edge = stored(edge.where("before < rest and rest <= upto").select(*names, "part", "before"), "mix-ranges")

    places = placed.join(edge, [*names, "part"]).groupBy(*names, "key", "id", "rest", "before").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("n")
    )
    order = Window.partitionBy(*names).orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    places = places.withColumn("upto", F.col("before") + F.sum("tokens").over(order))
    cut = places.where("upto - tokens < rest and rest <= upto").select(
        *names, F.col("key").alias("cut_key"), F.col("id").alias("cut_id"),
        F.expr("(rest - upto + tokens) div n").alias("cut_tokens"),
    )
    plan = stored(plan.join(cut, names, "left").select(*names, "epoch", "cut_key", "cut_id", "cut_tokens"), "mix-plan")

    added = ("mix_tokens", "mix_copies", "mix_prefix")
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), id_text.alias("id"), *leaf_names, counted.alias("tokens"))
    rows = rows.join(plan, names, "left").withColumn("key", _key(seed, "epoch", F.col("id")))
    place, end = F.struct("key", "id"), F.struct(F.col("cut_key").alias("key"), F.col("cut_id").alias("id"))
    inside = F.coalesce(F.col("cut_key").isNotNull() & (place < end), F.lit(False))
    last = F.coalesce(F.col("cut_key").isNotNull() & (place == end), F.lit(False))
    return rows.select(
        *(F.col("row").getField(c).alias(c) for c in kept),
        F.col("tokens").alias("mix_tokens"),
        (F.coalesce("epoch", F.lit(0)) + inside.cast("long")).alias("mix_copies"),
        F.when(last, F.col("cut_tokens")).otherwise(F.lit(0)).cast("long").alias("mix_prefix"),
    )
