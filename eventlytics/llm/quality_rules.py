"""Quality rules: surface counts and a hashed n-gram likelihood ratio.

Every document gets the base counts of the word contract and a score: the
mean, over its hashed 1-grams and 2-grams, of ``ln p_target / p_raw``. Both
are multinomials over ``buckets`` hash buckets per order: ``target`` counts
the n-grams of the trusted documents, ``raw`` those of all documents. Both
are smoothed by pseudo-counts in proportion to their sizes, so that a bucket
with too few n-grams to tell is neutral. The number of buckets grows with the
square root of the corpus' bytes (``buckets_for``), as the number of different
n-grams of a corpus does, so that they do not fill up. Dividing by the number of n-grams makes texts of any length
comparable; a document is kept if it passes the base rules and its score is
at least ``threshold`` (same data, same verdicts: nothing is sampled).

N-grams are taken over runs of letters/digits and runs of other visible
characters, so that symbol noise glued to words is counted as such. Only
DataFrame functions are used: the corpus counts are one aggregation to at
most ``2 * buckets`` rows (partial before the shuffle). Up to ``MOST_INLINE``
weights (corpora of some 270 GB of text) are an array in an expression:
``score_documents`` applies it to tokens as rows, summed up per document before
one row of numbers each is shuffled, ``filter_documents``, which passes on whole
rows, within the row. More weights stay a table, joined to the texts' n-gram
counts on the bucket. Weights are whole millionths, whose sums are exact, so
all ways give the same scores.

Defined cases: a null text counts as empty: no words, all counts 0, score 0,
``base_failed`` true, ``kept`` false. A text of white space likewise. An
empty table gives an empty result; without any trusted document both
multinomials are set equal (score 0, the base rules decide). Repeated rows
are scored alike, each for itself. Extra columns are ignored by
``score_documents`` and passed on unchanged by ``filter_documents``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.frames import constant_array, fresh, only, small_side, written

# Runs of letters/digits (anything beyond ASCII counts as a letter), or of marks.
# Characters are listed one by one: Java looks them up in one table, and tests
# ranges one after the other.
_ASCII = [(f"\\x{i:02x}", chr(i).isalnum(), 32 < i < 127) for i in range(128)]
TOKEN_PATTERN = "[^{}]+|[{}]+".format("".join(x for x, letter, _ in _ASCII if not letter),
                                      "".join(x for x, letter, seen in _ASCII if seen and not letter))
SPACES = r"[\x20\x09\x0A\x0B\x0C\x0D]+"  # between words (``frames.WORD_PATTERN``)
NO_SYMBOLS, SYMBOLS = r"[^#*$%&|<>]+", r"[#*$%&|<>]"
WINDOW = 5           # words in a repeated window
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
POSITION_BITS = 24   # of a packed (hash, position); longer texts go the exact way
LEAST_BUCKETS = 1 << 14
MOST_INLINE = 1 << 20  # weights that go into the plan
MICRO = 1_000_000      # weights are whole millionths


@dataclass(frozen=True)
class RatioModel:
    """Frozen log ratios in millionths: ``weights[bucket]`` for 1-grams, then
    2-grams, or, if they are many, ``table`` (bucket, weight) without zeros."""
    buckets: int
    weights: tuple[int, ...] = ()
    table: DataFrame | None = None


def buckets_for(n_bytes: int) -> int:
    """Buckets per order for a corpus: the power of two at or above the square
    root of its bytes."""
    return max(LEAST_BUCKETS, 1 << (math.isqrt(max(n_bytes, 1) - 1)).bit_length())


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_PATTERN), F.lit(0))


def _one(t: Column, buckets: int) -> Column:
    return F.xxhash64(t).bitwiseAND(F.lit(buckets - 1).cast("long"))


def _two(t: Column, follow: Column, buckets: int) -> Column:
    """Bucket of a 2-gram; the last token (``follow`` null) meets the end."""
    return F.xxhash64(t, follow).bitwiseAND(F.lit(buckets - 1).cast("long")) + buckets


def _pairs(tokens: str) -> Column:
    """Per token a struct of it and its follower (null for the last)."""
    return F.arrays_zip(F.col(tokens).alias("t"), F.slice(tokens, F.lit(2), F.size(tokens)).alias("follow"))


def _each_bucket(df: DataFrame, key: str, tokens: str, buckets: int) -> DataFrame:
    """(key, bucket): one row per n-gram of an array column. Tokens become
    rows before they are hashed, as Spark compiles that and no lambda."""
    d = df.select(key, F.explode(_pairs(tokens)).alias("p"))
    return d.select(key, F.explode(F.array(
        _one(F.col("p.t"), buckets), _two(F.col("p.t"), F.col("p.follow"), buckets))).alias("bucket"))


def fit_ratio(docs: DataFrame, target_ids: DataFrame, buckets: int | None = None, prior: float = 5.0) -> RatioModel:
    """Count hashed n-grams of all documents and of the trusted ones.

    ``docs`` (doc_id, text); ``target_ids`` (doc_id): trusted documents. Ids
    that are null or unknown are ignored, repeated ids count once.
    ``buckets``, a power of two, is the number of hash buckets per order (by
    default ``buckets_for`` the bytes of all texts); ``prior`` the
    pseudo-count of each bucket in the target.
    """
    d = only(docs, "doc_id", "text")
    if buckets is None:
        buckets = buckets_for(d.agg(F.sum(F.octet_length("text").cast("bigint"))).head()[0] or 0)
    if not 2 <= buckets <= 1 << 30 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two, at most 2**30")
    ids = only(target_ids, "doc_id").where("doc_id IS NOT NULL").distinct().withColumn("trusted", F.lit(1))
    d = d.join(small_side(ids), "doc_id", "left").select("trusted", _tokens(F.col("text")).alias("t"))
    counts = written(_each_bucket(d, "trusted", "t", buckets).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target")), "ngrams")
    two = F.col("bucket") >= buckets
    sizes = {r["two"]: r for r in counts.groupBy(two.alias("two")).agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()}  # a row per order
    share = {k: r["target"] / r["raw"] for k, r in sizes.items()}
    expected = F.col("raw") * F.when(two, share.get(True, 0.0)).otherwise(share.get(False, 0.0))
    weight = F.round(F.log((F.col("target") + prior) / (expected + prior)) * MICRO).cast("bigint")
    table = counts.select("bucket", weight.alias("weight")).where("weight != 0")
    if 2 * buckets > MOST_INLINE:
        return RatioModel(buckets, table=written(table, "ratios"))
    weights = [0] * (2 * buckets)
    for r in table.collect():  # at most MOST_INLINE rows
        weights[r["bucket"]] = r["weight"]
    return RatioModel(buckets, tuple(weights))


def _mean_ratio(tokens: str, model: RatioModel) -> Column:
    """Mean log ratio of an array column's 1-grams and 2-grams (0 if empty)."""
    weights, n, b = constant_array(model.weights, "bigint"), F.size(tokens), model.buckets

    def gram(t, i):
        return F.get(weights, _one(t, b).cast("int")) + F.get(
            weights, _two(t, F.get(F.col(tokens), i + 1), b).cast("int"))

    total = F.aggregate(F.transform(tokens, gram), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return F.when(n == 0, 0.0).otherwise(F.round(total / (2 * n) / MICRO, 6))


def _with_ratio_by_rows(df: DataFrame, text: str, model: RatioModel, out: str) -> DataFrame:
    """Adds ``out``, the same mean, and drops the text: its tokens are rows
    that are added up again where they were made, so that one row of numbers
    per document is shuffled, and no text. Takes less time than
    ``_mean_ratio``, but suits narrow rows only."""
    kept = [c for c in df.columns if c != text]
    row, t, p, total, n = (fresh(df, x) for x in ("row", "t", "p", "total", "n"))
    d = df.select(*kept, F.monotonically_increasing_id().alias(row), _tokens(F.col(text)).alias(t))
    d = d.select(*kept, row, F.explode_outer(_pairs(t)).alias(p))  # without a token: one null
    weights, one, follow = constant_array(model.weights, "bigint"), F.col(f"{p}.t"), F.col(f"{p}.follow")
    weight = F.get(weights, _one(one, model.buckets).cast("int")) + F.get(
        weights, _two(one, follow, model.buckets).cast("int"))
    d = d.select(*kept, row, one.alias(t), weight.alias(total)).groupBy(row, *kept).agg(
        F.sum(total).alias(total), F.count(t).alias(n))
    return d.select(*kept, F.when(F.col(n) == 0, 0.0).otherwise(
        F.round(F.col(total) / (2 * F.col(n)) / MICRO, 6)).alias(out))


def _with_joined_ratio(df: DataFrame, text: str, model: RatioModel, out: str) -> DataFrame:
    """Adds ``out``, the same mean, by joins with the table of weights. Texts
    are told apart by a digest, so copies are counted as one text, several
    times over, which leaves its mean as it is; a frequent bucket is one row of
    a text, and its rows can be split."""
    key = fresh(df, "digest")
    df = df.withColumn(key, F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    grams = _each_bucket(df.select(F.col(key).alias("digest"), _tokens(F.col(text)).alias("t")), "digest", "t",
                         model.buckets).groupBy("digest", "bucket").agg(F.count(F.lit(1)).alias("n"))
    means = grams.join(model.table, "bucket", "left").groupBy("digest").agg(
        F.round(F.sum(F.coalesce(F.col("n") * F.col("weight"), F.lit(0))) / F.sum("n") / MICRO, 6).alias(out))
    return df.join(means.withColumnRenamed("digest", key), key, "left").withColumn(
        out, F.coalesce(F.col(out), F.lit(0.0))).drop(key)


def _covered(pairs: Column) -> Column:
    """Words under the windows named by ``pairs`` (struct of positions a, b)."""
    at = F.array_sort(F.array_distinct(F.concat(F.transform(pairs, lambda p: p["a"]),
                                                F.transform(pairs, lambda p: p["b"]))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc, p):
        return F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"),
                        (p + WINDOW).alias("end"))

    return F.aggregate(at, start, add, lambda acc: acc["n"])


def _neighbours(ordered: str, key, pos) -> Column:
    """Position pairs of neighbours in a sorted array column with equal keys."""
    a = F.expr(f"slice({ordered}, 1, size({ordered}) - 1)")
    b = F.expr(f"slice({ordered}, 2, size({ordered}) - 1)")
    pairs = F.zip_with(a, b, lambda x, y: F.when(
        key(x) == key(y), F.struct(pos(x).alias("a"), pos(y).alias("b"))))
    return F.filter(pairs, lambda p: p.isNotNull())


def _with_repeat_words(df: DataFrame, w: str, n: str, out: str) -> DataFrame:
    """Adds ``out``: words of array column ``w`` (size ``n``) in five-word
    windows found twice or more in the array.

    Where two window hashes are equal, 40 bits of them are packed with their
    positions and sorted, and equal neighbours compared word by word; if a
    hash has collided (or the text has 2**24 words or more) the windows
    themselves are sorted instead.
    """
    mask = (1 << POSITION_BITS) - 1
    hashes, grams, packed, same, sure = (fresh(df, x) for x in ("hashes", "grams", "packed", "same", "sure"))
    word = lambda i: F.get(F.col(w), i)
    starts = F.expr(f"sequence(0, {n} - {WINDOW})").cast("array<int>")
    df = df.withColumn(hashes, F.transform(w, lambda x: F.xxhash64(x)))
    df = df.withColumn(grams, F.when(F.col(n) > WINDOW, F.transform(
        F.slice(hashes, 1, F.col(n).cast("int") - (WINDOW - 1)),
        lambda h, i: F.xxhash64(h, *[F.get(F.col(hashes), i + j) for j in range(1, WINDOW)]))))
    # most texts repeat no window: only the others are sorted
    fits = (F.size(F.array_distinct(grams)) < F.size(grams)) & (F.col(n) < (1 << POSITION_BITS))
    df = df.withColumn(packed, F.when(fits, F.sort_array(F.transform(
        grams, lambda g, i: g.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))))
    df = df.withColumn(same, F.when(F.size(packed) > 1, _neighbours(
        packed, lambda x: F.shiftright(x, POSITION_BITS), lambda x: x.bitwiseAND(F.lit(mask)))))

    def equal(p):
        at = lambda side, j: word((p[side] + j).cast("int"))
        cond = at("a", 0) == at("b", 0)
        for j in range(1, WINDOW):
            cond = cond & (at("a", j) == at("b", j))
        return cond

    df = df.withColumn(sure, F.when(F.size(same) > 0, F.filter(same, equal)))
    # the exact way: sort (window, position) itself
    slow = F.array_sort(F.transform(starts.cast("array<long>"), lambda i: F.struct(
        F.array(*[word((i + j).cast("int")) for j in range(WINDOW)]).alias("g"), i.alias("i"))))
    slow_pairs = F.element_at(F.transform(F.array(slow), lambda s: F.filter(
        F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda x, y: F.when(
            x["g"] == y["g"], F.struct(x["i"].alias("a"), y["i"].alias("b")))),
        lambda p: p.isNotNull())), 1)
    collided = F.size(same) > F.size(sure)
    zero = F.lit(0).cast("long")
    count = (F.when(F.col(n) <= WINDOW, zero)
             .when(F.col(n) >= (1 << POSITION_BITS), _covered(slow_pairs))
             .when(F.coalesce(F.size(same), F.lit(0)) <= 0, zero)
             .when(collided, _covered(slow_pairs))
             .otherwise(_covered(F.col(sure))))
    return df.withColumn(out, count).drop(hashes, grams, packed, same, sure)


OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")
COUNTS = OUT[:5]


def _with_counts(df: DataFrame, text: str, names: dict) -> DataFrame:
    """Adds the contract's counts under ``names``."""
    w, body, lines = (fresh(df, x) for x in ("w", "body", "lines"))
    df = df.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn(w, F.array_remove(F.split(F.col(body), SPACES, -1), ""))
    df = df.withColumn(lines, F.filter(F.split(F.col(body), "\n", -1),
                                       lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn(names["n_words"], F.size(w).cast("long"))
    df = _with_repeat_words(df, w, names["n_words"], names["n_repeat_words"])
    return df.withColumns({
        names["word_chars"]: F.length(F.array_join(w, "")).cast("long"),
        names["n_symbols"]: F.when(F.col(body).rlike(SYMBOLS), F.length(F.regexp_replace(
            body, NO_SYMBOLS, ""))).otherwise(0).cast("long"),
        names["n_dup_lines"]: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }).drop(w, body, lines)


def _with_verdicts(df: DataFrame, threshold: float, names: dict) -> DataFrame:
    """Adds both verdicts to counts and score."""
    c = lambda k: F.col(names[k])
    df = df.withColumn(names["base_failed"], (c("n_words") < MIN_WORDS)
                       | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words")))
    return df.withColumn(names["kept"], ~c("base_failed") & (c("score") >= threshold))


def score_documents(docs: DataFrame, model: RatioModel, threshold: float = -0.25) -> DataFrame:
    """One row per document: doc_id, the base counts, score and verdicts."""
    d, names = only(docs, "doc_id", "text"), {k: k for k in OUT}
    if model.table is not None:
        d = _with_counts(_with_joined_ratio(d, "text", model, "score"), "text", names)
    else:
        d = _with_ratio_by_rows(_with_counts(d, "text", names), "text", model, "score")
    return _with_verdicts(d, threshold, names).select("doc_id", *OUT)


def filter_documents(docs: DataFrame, model: RatioModel, threshold: float = -0.25) -> DataFrame:
    """The documents that pass, with all their own columns."""
    names = {k: fresh(docs, f"rule_{k}") for k in OUT}
    if model.table is not None:
        d = _with_counts(_with_joined_ratio(docs, "text", model, names["score"]), "text", names)
    else:
        t = fresh(docs, "t")
        d = _with_counts(docs.withColumn(t, _tokens(F.col("text"))), "text", names)
        d = d.withColumn(names["score"], _mean_ratio(t, model))
    d = _with_verdicts(d, threshold, names)
    # not a filter: that would be moved below the columns it needs and copy their expressions
    once = F.explode(F.when(F.col(names["kept"]), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], once.alias(fresh(docs, "once"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that some label row marks as good and none as bad."""
    q = only(labels, "doc_id", "quality")
    return (q.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
            .agg(F.min("quality").alias("q")).where("q = 1").select("doc_id"))
