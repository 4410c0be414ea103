"""Mixing sources to target weights by hierarchical budgeting.

Documents are the leaves' rows of a tree of levels (domain, language,
source). A token budget goes down the tree: at each node it is shared among
the children in proportion to their weights, but no child gets more than its
subtree can give (its tokens times ``max_epochs``); what such a child cannot
take is shared among its siblings, and only a subtree that is full as a whole
leaves tokens to its parent's siblings. In closed form per node: children in
order of capacity over weight, a running sum, and one comparison; all in
whole tokens.

A leaf with budget ``b`` and supply ``s`` gives ``b div s`` whole epochs and a
prefix of the next one. Each epoch has its own order, by a hash of seed, epoch
and document; the prefix is the longest one within the rest of the budget.
Its end is found by radix selection: tokens are summed per 1/256 of the hash
range, the part in which the budget ends is summed again per 1/256, and only
what is left in that part (1/65536 of the leaf) is sorted. So a leaf with a
third of all rows is never gathered or sorted as a whole, and texts are not
shuffled: the leaf's last hash is joined to the documents.

Only DataFrame functions are used; decisions about a tree of nodes are small
tables, never collected.

Defined cases: a null level value is the node ``(none)``; null texts have no
tokens; rows with equal doc_id and text are taken or left together; a leaf
without tokens gives nothing; a budget beyond all capacity is cut to it; an
empty table gives an empty result; extra columns are passed on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlytics.llm.frames import NONE_VALUE, fresh, small_side, words, written

ALL = "g"  # above any hexadecimal digit


def token_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def _digest(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")),
                             F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def _order_key(seed: int, epoch: Column, digest: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), digest).cast("binary"))


def _weight(path: Sequence[str], weights: Mapping[tuple, int]) -> Column:
    """The stated weight of the node named by the columns ``path``: of its
    whole path, else of its own name at that level, else 1."""
    w = F.lit(1).cast("bigint")
    for key, value in sorted(weights.items(), key=lambda kv: kv[0][0] is not None):  # whole paths are asked first
        if len(key) != len(path):
            continue
        cond = F.lit(True)
        for c, v in zip(path, key):
            if v is not None:
                cond = cond & (F.col(c) == v)
        w = F.when(cond, F.lit(int(value)).cast("bigint")).otherwise(w)
    return w


def _shared(nodes: DataFrame, parent: Sequence[str], path: Sequence[str], weights: Mapping[tuple, int]) -> DataFrame:
    """``nodes`` (path, cap, parent_budget) with ``budget``."""
    of_parent = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    order = of_parent.orderBy(F.col("cap") / F.col("w"), *path)
    n = nodes.withColumn("w", _weight(path, weights)).where("w > 0")
    n = n.withColumn("cap_before", F.coalesce(
        F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("bigint")))
    n = n.withColumn("w_left", F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    n = n.withColumn("full", wide("cap") * wide("w_left") <= wide("w") * (F.col("parent_budget") - F.col("cap_before")))
    n = n.withColumn("cap_full", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(of_parent))
    n = n.withColumn("w_rest", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(of_parent))
    share = F.expr("cast(w as decimal(38,0)) * (parent_budget - cap_full) div nullif(w_rest, 0)")
    return n.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share)).drop(
        "w", "cap_before", "w_left", "full", "cap_full", "w_rest", "parent_budget")


def leaf_budgets(supply: DataFrame, levels: Sequence[str], weights: Mapping[tuple, int], budget_percent: int,
                 max_epochs: int) -> DataFrame:
    """Leaves (levels, supply) with ``budget``: whole tokens."""
    leaves = supply.withColumn("cap", F.col("supply") * max_epochs)
    total = supply.agg(F.expr(f"sum(supply) * {int(budget_percent)} div 100").alias("parent_budget"))
    above = None
    for depth in range(1, len(levels) + 1):
        path, parent = list(levels[:depth]), list(levels[:depth - 1])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        if above is None:  # one row with the whole budget, to the few nodes of the first level
            nodes = nodes.withColumn("one", F.lit(1)).join(
                F.broadcast(total.withColumn("one", F.lit(1))), "one").drop("one")
        else:
            nodes = nodes.join(above.select(*parent, F.col("budget").alias("parent_budget")), parent)
        above = _shared(nodes, parent, path, weights)
    return supply.join(above.drop("cap"), list(levels))


def _cut(sums: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Of ``sums`` (levels, part, tokens, rest) per leaf the first part, in
    order, in which the running sum passes ``rest``, with what is left before it."""
    running = W.partitionBy(*levels).orderBy("part")
    s = sums.withColumn("upto", F.sum("tokens").over(running)).where("upto > rest")
    return s.groupBy(*levels).agg(F.min(F.struct("part", (F.col("rest") - F.col("upto") + F.col("tokens"))
                                                 .alias("rest"))).alias("c")).select(
        *levels, F.col("c.part").alias("cut"), F.col("c.rest").alias("rest"))


def leaf_limits(rows: DataFrame, levels: Sequence[str], budgets: DataFrame, max_epochs: int, seed: int) -> DataFrame:
    """Per leaf: ``whole`` epochs, and the last hash of the next one that is
    taken (``limit``). ``rows``: levels, digest, tokens."""
    levels = list(levels)
    plan = budgets.where("supply > 0").withColumn("whole", F.least(
        F.expr("budget div supply"), F.lit(max_epochs).cast("bigint")))
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("supply"))
    plan = written(plan.select(*levels, "whole", "rest"), "plan")
    part = plan.where(F.col("whole") < max_epochs)
    keyed = rows.join(small_side(part, 100_000), levels).withColumn(
        "key", _order_key(seed, F.col("whole") + 1, F.col("digest")))
    keyed = written(keyed.select(*levels, "key", "tokens", "rest"), "keys")
    first = keyed.groupBy(*levels, F.substring("key", 1, 2).alias("part")).agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    cut1 = written(_cut(first, levels), "cut")
    inside = keyed.drop("rest").join(small_side(cut1, 100_000), levels).where(F.substring("key", 1, 2) == F.col("cut"))
    second = inside.groupBy(*levels, F.substring("key", 1, 4).alias("part")).agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    cut2 = written(_cut(second, levels), "cut")
    inside = keyed.drop("rest").join(small_side(cut2, 100_000), levels).where(F.substring("key", 1, 4) == F.col("cut"))
    upto = F.sum("tokens").over(W.partitionBy(*levels).orderBy("key"))  # equal keys together
    last = inside.withColumn("upto", upto).where("upto <= rest").groupBy(*levels).agg(F.max("key").alias("last"))
    limit = cut2.select(*levels, "cut").join(last, levels, "left").select(
        *levels, F.coalesce("last", "cut").alias("limit"))
    limits = plan.join(limit, levels, "left")
    # without a cut the whole of the epoch fits; after the last epoch there is none
    return limits.select(*levels, "whole", F.when(F.col("whole") >= max_epochs, "").otherwise(
        F.coalesce("limit", F.lit(ALL))).alias("limit"))


def mix_sources(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple, int],
                budget_percent: int = 50, max_epochs: int = 2, seed: int = 7,
                tokens: Column | None = None) -> DataFrame:
    """The selected documents with all their columns and a struct ``mix``
    (level values, tokens, epoch): one row per epoch in which a document is
    taken (its name gets a suffix if ``docs`` has such a column; it is the
    last column).

    ``levels``: names and expressions from the top of the tree down.
    ``weights``: whole numbers by path, e.g. ``("web", "en"): 3``, or by the
    node's own name at a level, ``(None, "en"): 3``; others weigh 1, those of
    weight 0 get nothing. ``budget_percent`` of all tokens is the budget.
    ``tokens``: a token count expression (words by default).
    """
    names = list(levels)
    own = docs.columns
    mix, digest = fresh(docs, "mix"), fresh(docs, "digest")
    count = token_count(F.col("text")) if tokens is None else tokens.cast("bigint")
    fields = [F.coalesce(c.cast("string"), F.lit(NONE_VALUE)).alias(k) for k, c in levels.items()]
    seen = docs.withColumn(mix, F.struct(*fields, F.coalesce(count, F.lit(0).cast("bigint")).alias("tokens")))
    seen = seen.withColumn(digest, _digest(F.col("doc_id"), F.col("text")))
    rows = written(seen.select(f"{mix}.*", F.col(digest).alias("digest")), "rows")
    supply = rows.groupBy(*names).agg(F.sum("tokens").alias("supply"))
    budgets = leaf_budgets(supply, names, weights, budget_percent, max_epochs)
    limits = written(leaf_limits(rows, names, budgets, max_epochs, seed), "limits")
    lim = limits.select(F.struct(*names, "whole", "limit").alias(fresh(seen, "lim")))
    side = small_side(lim, 100_000)
    name = side.columns[0]
    cond = None
    for k in names:
        c = F.col(f"{mix}.{k}") == F.col(f"{name}.{k}")
        cond = c if cond is None else cond & c
    got = seen.join(side, cond)
    key = _order_key(seed, F.col(f"{name}.whole") + 1, F.col(digest))
    copies = (F.col(f"{name}.whole") + (key <= F.col(f"{name}.limit")).cast("bigint")).cast("int")
    epoch = fresh(got, "epoch")
    got = got.select(*[F.col(f"`{c}`") for c in own], mix, F.explode(F.when(
        copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))).alias(epoch))
    return got.withColumn(mix, F.struct(*[F.col(f"{mix}.{k}").alias(k) for k in (*names, "tokens")],
                                        F.col(epoch).alias("epoch"))).drop(epoch)
