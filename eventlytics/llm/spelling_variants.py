"""Spelling variants by reduced alphabets.

Words are runs of letters, counted over all texts. To find the words that one
edit turns into each other, letters are hashed to a few symbols; each word's
reduced form gets its full neighbourhood of one edit (every deletion,
replacement and insertion of a symbol) and that is joined with the reduced
vocabulary: two words one edit apart have reduced forms at most one edit apart.
What the join finds is verified on the words themselves. The number of symbols
grows with the vocabulary, so that a reduced form stands for few words; it
changes the work, never the result. (A neighbourhood is at most ``LONGEST``
letters times twice the symbols; words above that length are few, and are
joined by their halves: one edit leaves the first or the second half of a word
as it is.)

A word's form is its most frequent near word, if that one is ``dominance`` times
as frequent; the root is the end of the chain of forms. A chain's counts grow
by that factor, so it has at most log(largest count) links, and following it
takes the logarithm of that in rounds of joins (each round doubles the steps).

Defined cases: a null text has no words; a null id counts as an empty one in
the hash that makes the typing errors; a row that is repeated counts each time;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from eventlytics.llm.frames import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "".join(chr(c) for c in range(0xC0, 0x100))
LETTER = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, DOMINANCE = 6, 5, 5
ERROR_EVERY = 199
LONGEST = 32                            # longer words are joined by halves
SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                error_every: int | None = ERROR_EVERY) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` letters that occur
    ``min_count`` times. With ``error_every`` a run of letters whose hash with
    its document's id that number divides loses one letter first."""
    # a run that is too short stays so, whether it loses a letter or not
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"{LETTER}{{{min_length},}}"), F.lit(0))
    d = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    run = F.col("run")
    d = d.select("doc_id", F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run).alias("run"))
    word = F.col("run")
    if error_every:
        h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(h % error_every == 0, cut).otherwise(word)
    words = d.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def symbols_for(words: int, min_length: int = MIN_LENGTH) -> int:
    """So many symbols that the shortest words have four reduced forms each."""
    n = 4
    while n < len(SYMBOLS) and n ** min_length < 4 * words:
        n += 1
    return n


def reduced(word: Column, symbols: int) -> Column:
    """The word with each letter hashed to one of ``symbols`` symbols."""
    to = "".join(SYMBOLS[(ord(c) * 0x9E3779B1 >> 16) % symbols] for c in ALPHABET)
    return F.translate(word, ALPHABET, to)


def neighbourhood(r: Column, symbols: int) -> Column:
    """Hashes of a reduced word and of all that one edit makes of it."""
    n = F.length(r)
    alphabet = F.array(*[F.lit(s) for s in SYMBOLS[:symbols]])
    head = lambda i: F.substring(r, F.lit(1), i)        # noqa: E731  first i symbols
    tail = lambda i: F.substring(r, i + 1, n)           # noqa: E731  all but them
    gaps, places = F.sequence(F.lit(0), n), F.sequence(F.lit(0), n - 1)
    deleted = F.transform(places, lambda i: F.concat(head(i), tail(i + 1)))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(
        alphabet, lambda s: F.concat(head(i), s, tail(i + 1)))))
    inserted = F.flatten(F.transform(gaps, lambda i: F.transform(alphabet, lambda s: F.concat(head(i), s, tail(i)))))
    return F.array_distinct(F.transform(F.concat(deleted, replaced, inserted), lambda x: F.xxhash64(x)))


def _short_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """(word, other, other_n) of near words, the shorter of at most LONGEST."""
    w = words.where(F.length("word") <= LONGEST + 1).withColumn("r", reduced(F.col("word"), symbols))
    left = w.select("word", F.explode(neighbourhood(F.col("r"), symbols)).alias("key"))
    right = w.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.xxhash64("r").alias("key"))
    pairs = left.join(right, "key").where(F.levenshtein("word", "other", 1) == 1)
    return pairs.where(F.least(F.length("word"), F.length("other")) <= LONGEST).select("word", "other", "other_n")


@F.pandas_udf(BooleanType())
def _one_edit(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([one_edit(x, y) for x, y in zip(a, b)], dtype=bool)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes one the other."""
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) > len(b) + 1:
        return False
    same, differ = 0, len(b) + 1  # the common prefix, by halving
    while differ - same > 1:
        mid = (same + differ) // 2
        same, differ = (mid, differ) if a[:mid] == b[:mid] else (same, mid)
    return a[same + 1:] == b[same + (len(a) == len(b)):]


def _long_pairs(words: DataFrame) -> DataFrame:
    """The same for words that are both longer than LONGEST: with the longer
    one of ``m`` letters, the first or the last (m - 1) / 2 letters agree."""
    w = words.where(F.length("word") > LONGEST)
    n = F.length("word")
    keys = F.array(*[F.xxhash64(F.lit(side), m, part(F.floor((m - 1) / 2).cast("int")))
                     for m in (n, n + 1)
                     for side, part in (("head", lambda k: F.left("word", k)), ("tail", lambda k: F.right("word", k)))])
    left = w.select("word", F.explode(keys).alias("key"))
    right = w.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.explode(keys).alias("key"))
    pairs = left.join(right, "key").where("word != other").select("word", "other", "other_n").distinct()
    return pairs.where(_one_edit("word", "other"))


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, other, other_n): all ordered pairs of words one edit apart."""
    symbols = symbols or symbols_for(words.count())
    return _short_pairs(words, symbols).unionByName(_long_pairs(words))


def group_variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of counted words (word, n)."""
    words = written(words, "words")
    size, most, least = words.agg(F.count(F.lit(1)), F.max("n"), F.min("n")).head()
    near = near_words(words, symbols_for(size)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus_n"), "other")).alias("best"))
    best = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.minus_n") >= dominance * F.col("n"), F.col("best")).alias("best")), "near").select(
        "word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.minus_n")).alias("form_n"))
    roots = best.where("form is not null").select("word", F.col("form").alias("root"))
    links = int(math.log(max(most // max(least, 1), 1), dominance)) + 1 if size else 0
    for _ in range(math.ceil(math.log2(links)) if links > 1 else 0):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = written(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
                        "roots")
    return best.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
