"""The quality rules' n-grams: hashed in compiled code, the same scores by
rows and by lambdas, and the same characters in words and tokens."""

import re

from pyspark.sql import functions as F

from eventlytics.llm import frames, quality_rules as Q

TEXTS = ["a b c, a b!", "", None, " \t\n", "x ** y ** z", "c b a c b", "a b c, a b!", "été l'été ** a", "b c " * 500,
         "\x01\x7f", "one two three four five six seven eight nine ten eleven", "!", None]


def numbered(spark, texts):
    return spark.createDataFrame([(i % 7 if i % 4 else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ngrams_are_not_hashed_in_lambdas(spark):
    docs = numbered(spark, TEXTS).select("doc_id", Q._tokens(F.col("text")).alias("t"))
    each = Q._each_bucket(docs, "doc_id", "t", 64)
    assert "xxhash64" in plan(each) and "lambda" not in plan(each)
    model = Q.RatioModel(4, tuple(range(8)))
    scored = plan(Q.score_documents(numbered(spark, TEXTS), model))
    assert not re.search(r"lambdafunction\([^\n]*\[0,1,2,3", scored)  # no look-up of a weight by a lambda
    assert "Generate explode" in scored and scored.count("Aggregate") == 1


def test_scores_by_rows_are_those_by_lambdas(spark):
    docs = numbered(spark, TEXTS)  # null and repeated ids, repeated texts
    model = Q.fit_ratio(docs, spark.createDataFrame([(1,), (5,)], "doc_id bigint"))
    got = sorted((r["doc_id"] or -1, r["n_words"], r["score"]) for r in Q.score_documents(docs, model).collect())
    d = docs.withColumn("t", Q._tokens(F.col("text"))).select(
        "doc_id", F.size(frames.words(F.col("text"))).alias("n"), Q._mean_ratio("t", model).alias("s"))
    want = sorted((r["doc_id"] or -1, r["n"], r["s"]) for r in d.collect())
    assert got == want and len(got) == len(TEXTS) and len({x[2] for x in got}) > 5
    kept = sorted((r["doc_id"] or -1) for r in Q.score_documents(docs, model).where("kept").collect())
    assert kept == sorted((r["doc_id"] or -1) for r in Q.filter_documents(docs, model).collect()) and kept


def test_every_character_is_in_the_same_class(spark):
    chars = [chr(i) for i in [*range(0x3000), *range(0xD7F0, 0xD800), *range(0xE000, 0xE010), 0xFFFF, 0x10000, 0x10FFFF]]
    texts = [c + d + c + "a " + c for c in chars[:256] for d in "\t-z\xa0"] + [c + "!" + c for c in chars]
    ranges = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]+"
    d = numbered(spark, texts).select(
        Q._tokens(F.col("text")).alias("t"), F.regexp_extract_all("text", F.lit(ranges), F.lit(0)).alias("ranges"),
        F.array_remove(F.split("text", Q.SPACES, -1), "").alias("w"), frames.words(F.col("text")).alias("words"))
    assert d.where("t <> ranges OR w <> words").count() == 0
    assert d.where("size(t) > 1 AND size(w) > 1").count() > 100
