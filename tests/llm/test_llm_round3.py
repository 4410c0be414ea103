"""Spelling variants, the filter audit and substring removal against brute
force in plain Python, on awkward tables, and piece by piece."""

import collections
import glob
import hashlib
import itertools
import os
import random
import re
import tempfile
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlytics.llm import filter_audit, spelling_variants, substring_dedup
from eventlytics.llm.bytespans import utf8

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASH = ["w", "word", "n", "mask", "part", "digest", "h", "f", "first", "firsts", "kept", "run", "key", "root", "good",
         "docs", "has_id", "lo", "hi", "start", "form", "row", "block", "part2"]


def frame(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA)
    return d.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def prose(rng, n, size=60):
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta", "epsilon"]) + str(rng.randrange(size))
                    for _ in range(n))


# 11 ---------------------------------------------------------------------
def edits_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def naive_variants(rows, min_length=6, min_count=5, every=199):
    n = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= min_length:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= min_count}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and edits_one(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def variant_rows():
    rng = random.Random(5)
    words = ["kitten", "mitten", "kittens", "sitting", "Écoleß", "écoleß", "héllos", "hellos",
             "aaaaaa", "aaaaaaa", "strasse", "straße", "x×y÷zz", "Kitten", "KITTEN"]
    long = ["".join(rng.choice("abcé") for _ in range(k)) for k in (31, 32, 33, 34, 60, 200, 5000)]
    for w in list(long):
        k = rng.randrange(len(w))
        long += [w[:k] + w[k + 1:], w[:k] + "q" + w[k:], w[:k] + "z" + w[k + 1:], w + "y", "y" + w]
    rows = [(i, " ".join(rng.choice(words) for _ in range(200)), "en", "a") for i in range(12)]
    rows += [(20 + i, " ".join(" ".join([w] * (k + 1 if k < len(words) else 1)) for k, w in enumerate(words + long)),
              "en", "a") for i in range(6)]
    big = " ".join(["zebras"] * 400 + ["zebra's zebraz "] * 30)
    return rows + [(None, big, None, None), (None, big, None, None), (40, None, "en", None), (41, "", None, "b"),
                   (42, "1 2 3 --", "en", "a"), (42, big, "en", "a"), (43, "\U0001F600kittenĀmitten", "en", "a")]


def test_variants_equal_brute_force(spark):
    rows = variant_rows()
    got = spelling_variants.group_variants(spelling_variants.count_words(frame(spark, rows)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == naive_variants(rows)


def test_variants_without_rows(spark):
    none = frame(spark, variant_rows()).where("false")
    assert spelling_variants.group_variants(spelling_variants.count_words(none)).count() == 0


def test_chains_are_followed_to_their_end(spark):
    words = [("aaaaaa" + "b" * k, 5 ** (9 - k)) for k in range(9)]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling_variants.group_variants(
        spark.createDataFrame(words, "word string, n bigint")).collect()}
    assert got == {w: (None if w == "aaaaaa" else w[:-1], "aaaaaa") for w, _ in words}


@pytest.mark.parametrize("symbols", [4, 7])
def test_neighbourhood_is_whole(spark, symbols):
    """Whatever the number of symbols: every word one edit away is met."""
    rng = random.Random(symbols)
    letters = spelling_variants.ALPHABET
    words = {"".join(rng.choice(letters[:8]) for _ in range(rng.randrange(6, 9))) for _ in range(300)}
    words = sorted(words | {w[:2] + rng.choice(letters) + w[2 + rng.randrange(2):] for w in words})
    got = spelling_variants.near_words(spark.createDataFrame([(w, 9) for w in words], "word string, n bigint"), symbols)
    pairs = [(r["word"], r["other"]) for r in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a, b in itertools.permutations(words, 2) if edits_one(a, b)}


def test_one_edit_of_long_words():
    a = "ab" * 500_000
    assert spelling_variants.one_edit(a, a[:700_001] + "x" + a[700_002:])
    assert spelling_variants.one_edit(a, a[:700_001] + a[700_002:])
    assert not spelling_variants.one_edit(a, a) and not spelling_variants.one_edit(a, "x" + a[:-2] + "yz")
    assert spelling_variants.one_edit("", "a") and not spelling_variants.one_edit("", "ab")


def test_long_runs_are_words(spark):
    w = "ab" * 20_000
    rows = [(i, f"{w} {w[:-1]} {w}c", "en", "a") for i in range(5)]
    got = spelling_variants.group_variants(spelling_variants.count_words(frame(spark, rows), error_every=None))
    assert {len(r["word"]): r["n_near"] for r in got.collect()} == {40_000: 2, 39_999: 1, 40_001: 1}


# 12 ---------------------------------------------------------------------
def naive_masks(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        w = WORD.findall(text)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": doc_id is not None and any(o is not None and o < doc_id and (t or "") == text
                                                 for o, t, *_ in rows)}
        yield lang or "", {f for f, x in fails.items() if x}, doc_id in good, doc_id in toxic


def naive_audit(rows, labels):
    docs = list(naive_masks(rows, labels))
    out = set()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        steps, removed_in_all = [], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                hit = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_in_all[f] += len(hit)
                steps.append(("".join(order), k + 1, len(left), len(hit),
                              sum(f in d[1] for d in mine) - len(hit), sum(d[1] == {f} for d in mine),
                              sum(d[2] for d in hit), sum(d[3] for d in hit), f))
        out |= {(part, *s[:-1], removed_in_all[s[-1]]) for s in steps}
    return out


def audit_rows():
    rng = random.Random(3)
    rows = []
    for i in range(60):
        n = rng.choice([50, 99, 100, 130])
        text = prose(rng, n, rng.choice([5, 400]))
        text = rng.choice([text, text.upper(), text + " #", text + " 100%"])
        rows.append((i, text, rng.choice(["en", "de", None, ""]), "a"))
    rows += [(100 + i, rows[i % 7][1], rng.choice(["en", "fr"]), None) for i in range(30)]
    return rows + [(3, rows[3][1], "en", "a"), (3, rows[3][1], "en", "a"), (None, rows[4][1], "en", "a"),
                   (None, None, None, None), (200, None, "en", "a"), (201, "", "en", "a"), (202, " \n", "xx", None),
                   (203, prose(rng, 20_000), "en", "a")]


LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (4, None, 1), (None, 1, 1), (100, 1, 0), (101, 1, 1), (102, 0, 1),
          (203, 1, None), (999, 1, 1)]


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").withColumn("n", F.lit(7))
    got = [tuple(r) for r in filter_audit.audit_filters(frame(spark, rows), labels).collect()]
    assert len(got) == len({r[0] for r in got}) * 600
    assert set(got) == naive_audit(rows, LABELS)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    docs = frame(spark, audit_rows())
    assert filter_audit.audit_filters(docs.where("false"), labels).count() == 0
    kept = filter_audit.audit_filters(docs, labels.where("false"), part="source")
    assert {(r["good_lost"], r["toxic_lost"]) for r in kept.collect()} == {(0, 0)}
    assert {r["part"] for r in kept.collect()} == {"a", ""}
    with pytest.raises(ValueError):
        filter_audit.audit_filters(docs, labels, {c: None for c in "ABCDEFGH"})


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_swaps_meet_every_order(n):
    rng = random.Random(n)
    weights = {m: tuple(rng.randrange(3) for _ in range(3)) for m in rng.sample(range(2 ** n), 2 ** n - n % 3)}
    diagram = filter_audit.Diagram(weights, n)
    seen = []
    for level in [None, *filter_audit.adjacent_swaps(n)]:
        if level is not None:
            diagram.swap(level)
        seen.append(tuple(diagram.order))
        fresh = filter_audit.Diagram(weights, n)
        for k in range(n):  # the same order reached from the start, by insertion
            at = fresh.order.index(diagram.order[k])
            for j in range(at - 1, k - 1, -1):
                fresh.swap(j)
        assert list(fresh.all_pass()) == list(diagram.all_pass())
    assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_equal_subdiagrams_are_one_node():
    same = filter_audit.Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    assert len(same.kids) == 6


# 13 ---------------------------------------------------------------------
def naive_repeats(rows, width):
    """By definition: a document is its id; without an id it is a text, and
    compared with itself alone."""
    docs = [(d, WORD.findall(t or ""), t or "") for d, t, *_ in rows]
    places = collections.defaultdict(set)
    for k, (d, w, t) in enumerate(docs):
        for s in range(len(w) - width + 1):
            places[tuple(w[s:s + width])].add((d, t, s))
    out = []
    for d, w, t in docs:
        gone = set()
        for s in range(len(w) - width + 1):
            others = places[tuple(w[s:s + width])]
            if any((o_d == d and (d is not None or o_t == t) and o_s < s)
                   or (o_d is not None and d is not None and o_d < d) for o_d, o_t, o_s in others):
                gone |= set(range(s, s + width))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def repeat_rows():
    rng = random.Random(11)
    shared = [prose(rng, n) for n in (19, 20, 21, 55, 300)]
    rows = []
    for i in range(80):
        body = [prose(rng, rng.randrange(0, 60)), rng.choice(shared), prose(rng, rng.randrange(0, 40))]
        rows.append((i * 3, rng.choice([" ", "\n", "\t  "]).join(body), "en", "a"))
    rows += [(500 + i, rows[i][1], "en", "a") for i in range(20)] + [(600 + i, shared[4], "en", None) for i in range(40)]
    rows += [(0, rows[0][1], "en", "a"), (None, shared[3], None, None), (None, shared[3], "en", None),
             (None, shared[3] + " " + shared[3], "en", None), (None, None, None, None), (701, None, "en", "a"),
             (702, "", "en", "a"), (703, " \t\n ", "en", "a"), (704, "tick " * 3000, "en", "a"),
             (705, "a b éè \U0001F600 " * 25, "en", "a"), (-5, shared[2], "en", "a")]
    return rows


@pytest.mark.parametrize("most_cells", [1 << 23, 1 << 28])
def test_repeats_equal_brute_force(spark, most_cells):
    rows = repeat_rows()
    docs = frame(spark, rows).repartition(7)
    got = substring_dedup.remove_repeats(docs, most_cells=most_cells)
    assert sorted((tuple(r) for r in got.collect()), key=str) == naive_repeats(rows, substring_dedup.WIDTH)


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    """With far too few cells, all windows are candidates: the same result."""
    monkeypatch.setattr(substring_dedup, "cells_for", lambda chars, most: 1 << 23)
    monkeypatch.setattr(substring_dedup, "_cells", lambda lo, hi, row, cells: lo & np.uint64(63))
    rows = repeat_rows()
    # workers import the module anew: the cells are replaced in this process only
    data, offsets = utf8(pa.array([r[1] for r in rows]))
    planes = substring_dedup.Planes(1 << 10)
    _, _, _, lo, hi = substring_dedup.windows(data, offsets, 20)
    planes.add(lo, hi)
    assert planes.more[0][:8].all()
    monkeypatch.undo()
    got = substring_dedup.remove_repeats(frame(spark, rows), width=5)
    assert sorted((tuple(r) for r in got.collect()), key=str) == naive_repeats(rows, 5)


def test_repeats_of_nothing(spark):
    assert substring_dedup.remove_repeats(frame(spark, repeat_rows()).where("false")).count() == 0


def test_sketch_never_counts_too_little():
    rng = np.random.default_rng(1)
    lo = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    hi = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    twice = rng.choice(20_000, 500, replace=False)
    cells = 1 << 17
    parts = [substring_dedup.Planes(cells) for _ in range(3)]
    parts[0].add(lo[:10_000], hi[:10_000])
    parts[1].add(lo[10_000:], hi[10_000:])
    parts[2].add(lo[twice], hi[twice])
    batches = [substring_dedup._block(r, 0, p.once[r], p.more[r]) for r in range(substring_dedup.DEPTH) for p in parts]
    merged = [b.to_pylist()[0] for b in substring_dedup._merged(batches)]
    assert [m["row"] for m in merged] == [0, 1]
    found = substring_dedup.Candidates.__new__(substring_dedup.Candidates)
    found.cells = cells
    planes = [np.frombuffer(zlib.decompress(m["more"]), np.uint8) for m in merged]
    kept = set(found.repeated(planes, lo, hi).tolist())
    assert kept >= set(twice.tolist()) and len(kept) < 2_500


def test_kept_text_is_hashed(spark):
    got = substring_dedup.remove_repeats(frame(spark, [(1, "a  b\nc", "en", "a")])).select(
        F.sha2("kept", 256).alias("x")).head()["x"]
    assert got == hashlib.sha256(b"a b c").hexdigest()


def shuffle_files(spark):
    root = spark.sparkContext.getConf().get("spark.local.dir") or tempfile.gettempdir()
    roots = os.environ.get("SPARK_LOCAL_DIRS", root).split(",")
    return {f for r in roots for f in glob.glob(f"{r}/blockmgr-*/*/shuffle_*.data")}


def test_written_steps_keep_no_shuffle_files(spark):
    """Sketch blocks and windows on disk end with the step that wrote what came of them."""
    docs = frame(spark, repeat_rows()).repartition(7)
    before = shuffle_files(spark)
    got = substring_dedup.remove_repeats(docs)
    for _ in range(100):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert got.count() == len(repeat_rows())
