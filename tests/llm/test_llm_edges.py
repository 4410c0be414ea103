"""Each document operator on awkward tables: nulls in any column, empty, long
and repeated texts, ties, extra columns with the operators' own names, and a
table without rows. The defined results are those of the docstrings."""

import hashlib

import pytest
from pyspark.sql import functions as F

from eventlytics.llm import (fingerprints, html_template, jaccard_join, language_id, mixing, packing,
                             quality_classifier, quality_rules, secret_scan, url_filter)
from eventlytics.llm.queries import MIX_WEIGHTS, URL_RULES, mix_levels

LONG = " ".join(f"word{i % 977} thing{i}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here today " * 1
ROWS = [  # doc_id, text, lang, source
    (1, PROSE + "one", "en", "a"), (2, PROSE + "one", "en", "a"), (2, PROSE + "one", "en", "a"),
    (3, None, "en", "a"), (4, "", None, None), (None, PROSE + "one", "en", "a"), (None, None, None, None),
    (5, " \t\n ", "fr", "b"), (6, LONG, "en", "a"), (7, "été à la plage", "fr", "b"),
    (8, "12345 !!! ???", "fr", None), (9, "a\u2028b \U0001F600 c", None, "b"), (10, 'token = "abcdef123"', "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASH = ["score", "words", "digest", "W", "t", "mix", "key", "p", "host", "rule", "kept", "n_words", "found", "row",
         "spans", "cuts", "piece", "root", "id", "one", "trusted", "label", "plan", "whole", "limit", "domain"]


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, SCHEMA)
    return d.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 1), (6, 0), (None, 1), (99, 0), (7, None), (10, 0), (2, 1)],
                                 "doc_id bigint, quality int")


def by_id(df, *cols):
    return sorted(((r["doc_id"], *[r[c] for c in cols]) for r in df.collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, str(r[1:])))


def test_language_id(docs, none):
    model = language_id.fit_languages(docs)
    got = by_id(language_id.identify_languages(docs, model), "lang_pred", "score")
    assert len(got) == len(ROWS)
    unknown = {r[0] for r in got if r[1] == "und"}
    assert unknown >= {3, 4, 5, 8} and all(r[2] == 0.0 for r in got if r[1] == "und")
    assert all(0 <= r[2] <= 1 for r in got)
    assert language_id.identify_languages(none, model).count() == 0
    empty = language_id.fit_languages(none)
    assert {r[1] for r in by_id(language_id.identify_languages(docs, empty), "lang_pred")} == {"und"}


def test_quality_classifier(docs, none, labels):
    model = quality_classifier.fit_rules(docs, labels)
    got = by_id(quality_classifier.score_quality(docs, model), "score", "predicted")
    assert len(got) == len(ROWS) and all(0 <= r[1] <= 1 and r[2] == int(r[1] >= 0.5) for r in got)
    assert quality_classifier.score_quality(none, model).count() == 0
    blank = quality_classifier.fit_rules(none, labels)
    assert {r[1] for r in by_id(quality_classifier.score_quality(docs, blank), "score")} == {0.5}


def test_jaccard_join(docs, none):
    got = by_id(jaccard_join.similar_documents(docs), "class_id", "text_id", "n_copies", "n_links")
    assert len(got) == len(ROWS)
    assert [r[1:] for r in got if r[0] in (1, 2)] == [(1, 1, 4, 0)] * 3
    assert [r for r in got if r[0] in (3, 4)] == [(3, 3, 3, 3, 0), (4, 3, 3, 3, 0)]
    assert jaccard_join.similar_documents(none).count() == 0
    kept = jaccard_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in by_id(kept, "text")] == [1, 3, 5, 6, 7, 8, 9, 10]
    assert jaccard_join.one_of_each_group(none).count() == 0


def test_quality_rules(docs, none, labels):
    model = quality_rules.fit_ratio(docs, quality_rules.trusted_ids(labels))
    got = by_id(quality_rules.score_documents(docs, model), "n_words", "base_failed", "kept")
    assert len(got) == len(ROWS)
    assert [r for r in got if r[0] in (3, 4, 5)] == [(k, 0, True, False) for k in (3, 4, 5)]
    assert [r[1] for r in got if r[0] == 6] == [60_000]
    kept = quality_rules.filter_documents(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r[3] for r in got)
    assert quality_rules.score_documents(none, model).count() == 0
    assert quality_rules.filter_documents(none, model).count() == 0
    blank = quality_rules.fit_ratio(none, quality_rules.trusted_ids(labels))
    assert all(r[1] == 0.0 for r in by_id(quality_rules.score_documents(docs, blank), "score"))


def test_packing(docs, none):
    got = packing.pack_documents(docs).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 3) == 1
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert max(r["offset"] + r["length"] for r in got) <= 1024
    assert packing.pack_documents(none).count() == 0
    assert packing.pack_documents(docs.where("doc_id = 4"), end_id=None).count() == 0


def test_secret_scan(docs, none):
    empty = hashlib.sha256(b"").hexdigest()
    got = by_id(secret_scan.scan_documents(docs), "base_sha256", "spans")
    assert len(got) == len(ROWS)
    assert [r for r in got if r[0] == 3] == [(3, empty, "")]
    assert [r[2] for r in got if r[0] == 10] == ["assign:0:18"]
    clean = secret_scan.redact_documents(docs)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert [r[1] for r in by_id(clean, "text") if r[0] in (3, 10)] == [None, '[SECRET]"']
    assert secret_scan.scan_documents(none).count() == secret_scan.redact_documents(none).count() == 0


def test_fingerprints(docs, none):
    got = by_id(fingerprints.compare_with_next(docs), "n_chars", "edited_sha256", "fingerprint", "near_edited",
                "near_next")
    assert len(got) == len(ROWS)
    own = {r[0]: r for r in got}
    assert own[1][3] == own[2][3] and own[1][5] == 1.0
    assert own[3][4:] == (1.0, 1.0)  # empty, and so is the next one
    edited = fingerprints.edited(LONG, "été à la plage")
    assert own[6][2] == hashlib.sha256(edited.encode()).hexdigest()
    last = fingerprints.edited('token = "abcdef123"', "")  # the first of all is the null id's null text
    assert own[10][2] == hashlib.sha256(last.encode()).hexdigest()
    assert fingerprints.compare_with_next(none).count() == 0
    assert fingerprints.fingerprint_documents(none).count() == 0
    alone = fingerprints.compare_with_next(docs.where("doc_id = 7")).collect()
    assert alone[0]["near_next"] == 1.0


def test_mixing(docs, none):
    out = mixing.mix_sources(docs, mix_levels(), MIX_WEIGHTS, 100, 1)
    name = out.columns[-1]
    assert out.columns[:-1] == docs.columns and name != "mix"
    spoken = docs.where(F.length(F.trim(F.coalesce("text", F.lit("")))) > 3).count()
    assert out.count() >= spoken  # the whole budget: all with words, once
    assert out.select(F.max(f"{name}.epoch")).head()[0] == 1
    half = mixing.mix_sources(docs, mix_levels(), MIX_WEIGHTS, 50, 3)
    assert half.select(F.sum(f"{half.columns[-1]}.tokens")).head()[0] <= 60_150 // 2
    assert mixing.mix_sources(none, mix_levels(), MIX_WEIGHTS).count() == 0


PAGES = [
    (1, "https://a.example.net/en/1", "<html><body><nav><a href='/x'>menu</a></nav><article><h1>T &amp; U</h1>"
     "<p>one<br>two <p>three</article><footer>f</footer></body></html>"),
    (1, "https://a.example.net/en/1", "<article><p>x</article>"), (2, None, None), (3, "no scheme", ""),
    (4, "HTTP://A.Example.COM/de/?q=1#f", "plain &eacute;t&eacute; text"), (None, "x://org/fr/a", "<p>half <b>open"),
    (5, "x://org", "<div class='sidebar'><p>side</p></div><div><p>" + "long " * 50_000 + "</div><script>no</script>"),
]


def test_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    pages = pages.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    got = html_template.extract_main_text(pages).collect()
    texts = sorted((str(r["page_id"]), r["text"]) for r in got)
    assert texts == sorted([("1", "T & U\n\none two\n\nthree"), ("1", "x"), ("2", ""), ("3", ""),
                            ("4", "plain été text"), ("None", "half open"),
                            ("5", " ".join(["long"] * 50_000))])
    assert html_template.extract_main_text(pages.where("false")).count() == 0
    judged = sorted((str(r["page_id"]), r["host"], r["path"], r["rule"]) for r in
                    url_filter.judge_urls(pages, URL_RULES).collect())
    assert judged == [
        ("1", "a.example.net", "/en/1", "example.net/en/"), ("1", "a.example.net", "/en/1", "example.net/en/"),
        ("2", "", "", None), ("3", "", "", None), ("4", "a.example.com", "/de/", "example.com/de/"),
        ("5", "org", "", None), ("None", "org", "/fr/a", "org/fr/")]
    assert url_filter.judge_urls(pages.where("false"), URL_RULES).count() == 0
    unlabelled = url_filter.judge_urls(pages.where("page_id = 2"), URL_RULES).collect()
    assert [(r["verdict"], r["score"]) for r in unlabelled] == [("allow", 0.0)]


def test_pipeline_stages(spark, docs, none):
    import corpus_pipeline as C
    for name, stage in C.STAGES:
        for frame in (docs, none):
            out = stage(spark, frame, "/root/testdata/sf0.001")
            assert (out.columns == docs.columns) == (name != C.STAGES[-1][0])
            assert out.count() == 0 if frame is none else out.count() > 0 or name == "quality_rules"


# Whole texts of a million characters: no stack overflow, panic or quadratic time.
MILLION = {
    "a hyphen chain": "a-" * 500_000 + "a1", "spaces": " " * 1_000_000, "line ends": "x" + "\n" * 1_000_000 + "y",
    "tabs between words": "a" + "\t" * 1_000_000 + "b", "one word": "ab" * 500_000, "open tags": "<a " * 330_000,
    "unclosed elements": "<div>" * 200_000, "open quotes": '<a ="x>" ' * 110_000, "digits": "0123456789" * 100_000,
}


@pytest.fixture(scope="module")
def million(spark):
    return spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(MILLION.values())], SCHEMA).repartition(8)


def test_a_million_characters_packed(million):
    got = packing.pack_documents(million).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert len(got) == len(MILLION) and all(r["n"] >= 2 for r in got)


def test_long_space_has_the_same_ids():
    encode = packing.Encoder("byte_bpe_50k")
    text = "a " + " " * packing.LONG_SPACE + "b\n" + "\n" * 100
    encode(text)
    assert encode._whole is not None  # went to the slower library
    encode("short")
    assert encode(text) == encode._fast.encode_ordinary(text)


def test_a_million_characters_scanned(million):
    got = {r["doc_id"]: r for r in secret_scan.scan_documents(million).collect()}
    assert len(got) == len(MILLION) and got[0]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact_documents(million).collect()}
    assert clean[0] == MILLION["a hyphen chain"]


def test_a_million_characters_extracted(spark):
    rows = [(i, f"https://a.example/{i}", t) for i, t in enumerate(MILLION.values())]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(8)
    got = {r["page_id"]: r["text"] for r in html_template.extract_main_text(pages).collect()}
    assert len(got) == len(MILLION) and got[6] == "" and got[1] == ""


def test_inside_the_article(spark):
    """Adverts, notices and comments in the article go; its own header's title,
    headings with ids and sections named by them stay; odd quotes are read."""
    def page(i):
        return f"""<html><body><div class="wrap"><article class=post data-x=it's><header><h1>Title {i}</h1>
        <p class="byline">By someone</p></header><p>First {i} don't stop.</p><div class='ad'>Buy {i}</div>
        <p title="5" tall">Second {i}.</p><div class="ad-slot wide"><p>Buy more {i}</p></div>
        <section id="related-work"><h2 id="search-trees">Related work {i}</h2><p class="notice">Third {i}.</p></section>
        <ul class="share-buttons"><li>Share {i}</li></ul><div class="cookie-notice">Cookies {i}</div>
        <div id='comments' class='comments'><p>Reader {i}</p></div><section id="comments"><p>Other {i}</p></section>
        <div class="comment-on-method"><p>Fourth {i}.</p></div></article></div></body></html>"""

    pages = spark.createDataFrame([(i, f"https://a.example/{i}", page(i)) for i in range(8)],
                                  "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_template.extract_main_text(pages).collect()}
    assert got == {i: "\n\n".join([f"Title {i}", f"First {i} don't stop.", f"Second {i}.", f"Related work {i}",
                                   f"Third {i}.", f"Fourth {i}."]) for i in range(8)}
