"""Quality classifier: a sparse ensemble of rules over text statistics.

Each text becomes the statistics of ``STATS`` (shares of characters, words,
lines and repeats). A forest of shallow trees is grown on labelled rows; each
path from a root to a node below it is a rule, a conjunction of bounds on
statistics. A logistic regression with an L1 penalty (lasso) over the rules'
0/1 values keeps a few of them, and these are compiled into one Spark column
expression: the intercept plus the weight of every rule that holds.

Learning takes about ``train_rows`` labelled rows, chosen by a hash of their
doc_id; trees and weights come from Spark's ML library. Every text is scored
whole: the statistics in one Arrow pass without a shuffle, the rules as code.

Defined cases: null texts count as empty, and empty texts have all statistics
0 and are scored like any other; labels other than 0 and 1 and ids that are
null, unknown or held out are not learned from; an id labelled more than once
counts as 1 if no label is 0; without both labels the score is the share of
label 1 among those learned (0.5 without any); repeated rows are scored each
for itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.bytespans import SpanHasher, row_groups, utf8, word_spans
from eventlytics.llm.frames import learnable, only, small_side

STATS = (
    "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "punctuation_share",
    "bang_share", "bar_share", "lone_symbol_share", "symbol_end_share", "long_word_share",
    "repeat_share", "pair_repeat_share", "distinct_share", "same_next_share", "words_per_line", "dup_line_share",
)
GROUP_BYTES = 1 << 21
_CLASS = np.zeros(256, np.uint8)  # 1 upper, 2 digit, 4 symbol, 8 punctuation, 16 "!", 32 "|"
_CLASS[65:91] |= 1
_CLASS[48:58] |= 2
for _c in "#*$%&|<>@^~\\{}[]=+_/":
    _CLASS[ord(_c)] |= 4
for _c in ".,;:!?'\"-()":
    _CLASS[ord(_c)] |= 8
_CLASS[ord("!")] |= 16
_CLASS[ord("|")] |= 32


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic number, bound, True if it must exceed it)."""
    bounds: tuple[tuple[int, float, bool], ...]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, STATS) of texts given as bytes and offsets."""
    n = len(offsets) - 1
    start, end, row = word_spans(data, offsets)
    count = lambda rows, w=None: np.bincount(rows, w, minlength=n).astype(float)
    words = count(row)
    share = lambda x, of: x / np.maximum(of, 1.0)
    kinds = np.concatenate(([0], np.cumsum(data & 0xC0 != 0x80)))  # characters
    chars = (kinds[offsets[1:]] - kinds[offsets[:-1]]).astype(float)
    per = {}
    flags = _CLASS[data]
    sums = {}
    for bit in (1, 2, 4, 8, 16, 32):
        sums[bit] = np.concatenate(([0], np.cumsum(flags & bit != 0)))
        per[bit] = (sums[bit][offsets[1:]] - sums[bit][offsets[:-1]]).astype(float)
    upper_after_c3 = np.zeros(len(data) + 1, np.int64)  # two-byte capitals, as À to Þ
    if len(data) > 1:
        upper_after_c3[2:] = np.cumsum((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E))
    per[1] += upper_after_c3[offsets[1:]] - upper_after_c3[offsets[:-1]]
    length = kinds[end] - kinds[start]
    marks = (sums[4][end] - sums[4][start]) + (sums[8][end] - sums[8][start])
    lone = marks == length
    last = end - 1
    tail = (flags[last] & 4 != 0) & ~lone if len(last) else np.zeros(0, bool)
    h = SpanHasher(data)(start, end) if len(start) else np.zeros(0, np.uint64)

    def repeated(keys, rows):  # share of items seen twice or more in their row
        order = np.lexsort((keys, rows))
        k, r = keys[order], rows[order]
        same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
        twice = np.zeros(len(k), bool)
        twice[1:] |= same
        twice[:-1] |= same
        firsts = np.ones(len(k), bool)
        firsts[1:] = ~same
        return count(r, twice), count(r, firsts)

    _, distinct = repeated(h, row)
    together = row[1:] == row[:-1]
    pair = (h[:-1] * np.uint64(31) + h[1:])[together]
    pair_rep, _ = repeated(pair, row[:-1][together])
    same_next = count(row[:-1][together], (h[1:] == h[:-1])[together])
    five = np.zeros(0, np.uint64)
    five_row = np.zeros(0, np.int64)
    if len(h) >= 5:
        inside = row[4:] == row[:-4]
        five = h[:-4].copy()
        for k in range(1, 5):
            five = five * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - 4 + k]
        five, five_row = five[inside], row[:-4][inside]
    five_rep, _ = repeated(five, five_row)
    # lines with a word
    newline = np.concatenate(([0], np.cumsum(data == 10)))
    if len(start):
        begins = np.ones(len(start), bool)
        begins[1:] = ~together | (newline[start[1:]] > newline[end[:-1]])
        first = np.flatnonzero(begins)
        final = np.append(first[1:] - 1, len(start) - 1)
        line_row = row[first]
        lines = count(line_row)
        _, line_distinct = repeated(SpanHasher(data)(start[first], end[final]), line_row)
    else:
        lines = line_distinct = np.zeros(n)
    out = np.stack([
        np.log1p(words), share(count(row, length), words), share(per[1], chars), share(per[2], chars),
        share(per[4], chars), share(per[8], chars), share(per[16], words), share(per[32], words),
        share(count(row, lone), words), share(count(row, tail), words), share(count(row, length >= 20), words),
        share(five_rep, words), share(pair_rep, words), share(distinct, words), share(same_next, words),
        share(words, lines), share(lines - line_distinct, lines)], axis=1)
    return np.round(out, 6)


def _stats_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in row_groups(offsets, GROUP_BYTES):
            s = statistics(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), *[pa.array(s[:, k]) for k in range(len(STATS))]],
                names=["doc_id", *STATS])


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics, one row per document."""
    d = only(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_stats_pass, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATS))


def _paths(node, bounds: dict) -> Iterator[tuple]:
    """The bounds of every node below the root of a tree: per statistic and
    side only the tightest."""
    if node.getClass().getSimpleName() != "InternalNode":
        return
    split = node.split()
    k, at = split.featureIndex(), split.threshold()
    for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
        tight = dict(bounds)
        old = tight.get((k, above))
        tight[(k, above)] = at if old is None else (max if above else min)(old, at)
        yield tuple(sorted((f, b, up) for (f, up), b in tight.items()))
        yield from _paths(child, tight)


def extract_rules(forest) -> list[Rule]:
    """The distinct rules of a fitted tree ensemble. Of two rules that only
    say the opposite of each other one is enough."""
    rules: set[tuple] = set()
    for tree in forest.trees:
        for bounds in _paths(tree._java_obj.rootNode(), {}):
            opposite = ((bounds[0][0], bounds[0][1], not bounds[0][2]),) if len(bounds) == 1 else None
            if opposite not in rules:
                rules.add(bounds)
    return [Rule(b) for b in sorted(rules)]


def _holds(rule: Rule) -> Column:
    cond = None
    for k, at, above in rule.bounds:
        c = F.col(STATS[k]) > F.lit(at) if above else F.col(STATS[k]) <= F.lit(at)
        cond = c if cond is None else cond & c
    return cond


def fit_rules(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, trees: int = 24, depth: int = 3,
              lasso: float = 0.002, seed: int = 7) -> RuleModel:
    """Rules and weights from about ``train_rows`` labelled rows (doc_id,
    quality) that are not held out; ``lasso`` is the L1 penalty."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = only(labels, "doc_id", "quality").where("quality IN (0, 1)").where(learnable(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    n = known.count()
    scale = 1 << 30
    rate = int(min(1.0, train_rows / max(n, 1)) * scale)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < rate)
    rows = document_statistics(only(docs, "doc_id", "text").join(small_side(chosen.select("doc_id")), "doc_id",
                                                                 "left_semi"))
    rows = rows.join(chosen, "doc_id").select("label", *STATS)
    table = rows.toArrow()  # at most about train_rows rows of numbers
    ones = float(np.sum(table["label"].to_numpy())) if table.num_rows else 0.0
    if not table.num_rows or ones in (0.0, float(table.num_rows)):
        share = ones / table.num_rows if table.num_rows else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel(math.log(share / (1 - share)), (), ())
    spark = docs.sparkSession
    parts = max(1, min(64, table.num_rows // 2000))
    # the same order of the same rows whatever the partitions: the same trees
    order = np.lexsort([table[c].to_numpy() for c in table.column_names])
    train = spark.createDataFrame(table.take(pa.array(order))).repartition(parts).cache()
    try:
        ones_weight = (table.num_rows - ones) / ones
        weighted = train.withColumn("w", F.when(F.col("label") == 1, ones_weight).otherwise(1.0))
        features = VectorAssembler(inputCols=list(STATS), outputCol="features").transform(weighted)
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="w",
                                        maxBins=64).fit(features)
        rules = extract_rules(forest)
        holds = train.select("label", *[_holds(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)])
        x = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(holds)
        fitted = LogisticRegression(regParam=lasso, elasticNetParam=1.0, standardization=False,
                                    maxIter=100).fit(x)
    finally:
        train.unpersist()
    weights = fitted.coefficients.toArray()
    kept = [(r, round(float(w), 6)) for r, w in zip(rules, weights) if abs(w) > 1e-6]
    return RuleModel(float(fitted.intercept), tuple(r for r, _ in kept), tuple(w for _, w in kept))


def rule_score(model: RuleModel) -> Column:
    """The probability of label 1, from the statistics' columns."""
    total = F.lit(model.intercept)
    for rule, weight in zip(model.rules, model.weights):
        total = total + F.when(_holds(rule), weight).otherwise(0.0)
    return F.round(1 / (1 + F.exp(-total)), 9)


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """One row per document: doc_id, score and predicted (score >= 0.5)."""
    d = document_statistics(docs).select("doc_id", rule_score(model).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
