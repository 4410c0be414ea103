"""Audit of how a set of document filters interact, by decision diagrams.

Every document has a failure mask: one bit per filter. Masks are counted per
part (documents, and those with a good or a toxic label); a part then is a
small count-weighted decision diagram: one level per filter, a node's two
edges are "passes" and "fails", and a node weighs what its documents weigh.
Equal subdiagrams are one node. Swapping two adjacent levels changes the
order of two filters without a look at the documents; a sequence of adjacent
swaps runs through all orders. In each, the path on which everything passes
gives the steps: the weight beyond its pass edge is kept, that beyond its
fail edge is removed there. A filter's total is what it removes as the first,
its unique failures what it removes as the last one.

Documents are reduced to (id, digest of the text, mask) before anything is
shuffled; "the text of a smaller id" is a minimum per digest (partial before
the shuffle), joined back by id, so a text with any number of copies is never
in one task. A part's group is at most 2 ** filters rows.

Defined cases: a null text is empty; a null part is the empty string; a row
without an id is not compared with other ids (it is a copy of none, and no
label is its); rows with one id and text are no copies of each other; a
document has a label if any row of ``labels`` for its id gives it; an empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.frames import only, words, written

MOST_FILTERS = 7  # 5,040 orders a part
WEIGHTS = ("docs", "good", "toxic")
SCHEMA = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")

# A filter of texts: from the text and its words to "it fails".
TextFilter = Callable[[Column, Column], Column]

STANDARD: dict[str, TextFilter | None] = {
    "A": lambda text, w: F.size(w) < 100,
    "B": lambda text, w: 100 * F.size(F.array_distinct(w)) < 80 * F.size(w),
    "C": lambda text, w: 100 * (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")))
    > 10 * F.length(text),
    "D": lambda text, w: text.rlike(r"[#$%&*|]"),
    "E": None,  # the text of a smaller id
}


class Diagram:
    """Count-weighted, with every level on every path (see the module)."""

    def __init__(self, weights: dict[int, tuple[int, ...]], n: int):
        self.order = list(range(n))
        self.kids: list[tuple[int, int] | None] = []
        self.weight: list[tuple[int, ...]] = []
        self.known: dict[tuple, int] = {}
        self.zero = (0,) * len(WEIGHTS)
        self.root = self._grow(weights, 0, 0)

    def _node(self, key: tuple, weight, kids=None) -> int:
        if key not in self.known:
            self.known[key] = len(self.kids)
            self.kids.append(kids)
            self.weight.append(weight() if callable(weight) else weight)
        return self.known[key]

    def _join(self, passed: int, failed: int) -> int:
        return self._node(("node", passed, failed),
                          lambda: tuple(a + b for a, b in zip(self.weight[passed], self.weight[failed])),
                          (passed, failed))

    def _grow(self, weights: dict, level: int, mask: int) -> int:
        if level == len(self.order):
            w = weights.get(mask, self.zero)
            return self._node(("leaf", *w), w)
        return self._join(self._grow(weights, level + 1, mask),
                          self._grow(weights, level + 1, mask | 1 << self.order[level]))

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next one."""
        done: dict[int, int] = {}

        def turned(node: int, above: int) -> int:
            if node not in done:
                passed, failed = self.kids[node]
                if above:
                    done[node] = self._join(turned(passed, above - 1), turned(failed, above - 1))
                else:
                    (pp, pf), (fp, ff) = self.kids[passed], self.kids[failed]
                    done[node] = self._join(self._join(pp, fp), self._join(pf, ff))
            return done[node]

        self.root = turned(self.root, level)
        self.order[level:level + 2] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, weight kept, weight removed) of each step."""
        node = self.root
        for f in self.order:
            passed, failed = self.kids[node]
            yield f, self.weight[passed], self.weight[failed]
            node = passed


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next one, so that all orders of ``n`` filters
    are met once: the last filter walks through the orders of the others."""
    if n < 2:
        return
    to_front, others = True, adjacent_swaps(n - 1)
    while True:
        yield from (range(n - 2, -1, -1) if to_front else range(n - 1))
        step = next(others, None)
        if step is None:
            return
        yield step + 1 if to_front else step  # the walking filter stands at the front, or at the end
        to_front = not to_front


def interactions(weights: dict[int, tuple[int, ...]], names: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique, good lost, toxic lost,
    shapley) of every order of the filters, from the weights of the masks."""
    n = len(names)
    diagram, paths = Diagram(weights, n), []
    paths.append((list(diagram.order), list(diagram.all_pass())))
    for level in adjacent_swaps(n):
        diagram.swap(level)
        paths.append((list(diagram.order), list(diagram.all_pass())))
    total, unique, shapley = {}, {}, dict.fromkeys(range(n), 0)
    for _, path in paths:
        total[path[0][0]], unique[path[-1][0]] = path[0][2][0], path[-1][2][0]
        for f, _, removed in path:
            shapley[f] += removed[0]
    for order, path in paths:
        name = "".join(names[f] for f in order)
        for k, (f, kept, removed) in enumerate(path):
            yield (name, k + 1, kept[0], removed[0], total[f] - removed[0], unique[f], removed[1], removed[2],
                   shapley[f])


def failure_masks(docs: DataFrame, labels: DataFrame, filters: dict[str, TextFilter | None] = STANDARD,
                  part: str = "lang") -> DataFrame:
    """(part, mask, docs, good, toxic): documents per part and failure mask."""
    d = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                    F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))
    d = d.withColumn("w", words(F.col("text")))
    mask = F.lit(0)
    for k, fails in enumerate(filters.values()):
        if fails is not None:
            mask = mask + F.when(fails(F.col("text"), F.col("w")), 1 << k).otherwise(0)
    slim = written(d.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
                   .groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")
    known = slim.where(F.col("doc_id").isNotNull())
    repeats = sum(1 << k for k, fails in enumerate(filters.values()) if fails is None)
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = only(labels, "doc_id", "quality", "toxic").where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = (known.join(marks, "doc_id", "left").join(first, ["doc_id", "digest"], "left")
             .select("part", F.col("mask").bitwiseOR(F.when(F.col("first"), 0).otherwise(repeats)).alias("mask"), "n",
                     F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    others = slim.where(F.col("doc_id").isNull()).select("part", "mask", "n", F.lit(0).alias("good"),
                                                         F.lit(0).alias("toxic"))
    return known.unionByName(others).groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame, filters: dict[str, TextFilter | None] = STANDARD,
                  part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step (``SCHEMA``).

    ``filters`` maps letters to conditions of failure; None stands for "the
    text of a smaller id".
    """
    if not 0 < len(filters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, as all orders are audited")
    names = "".join(filters)

    def steps(counts: pd.DataFrame) -> pd.DataFrame:
        weights = {int(m): tuple(map(int, w)) for m, *w in counts[["mask", *WEIGHTS]].itertuples(index=False)}
        rows = [(counts["part"].iloc[0], *r) for r in interactions(weights, names)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return failure_masks(docs, labels, filters, part).groupBy("part").applyInPandas(steps, SCHEMA)
