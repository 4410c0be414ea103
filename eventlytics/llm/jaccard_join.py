"""N-gram Jaccard join by MinHash banding.

Texts become sets of hashed word n-grams (a text of fewer words: one n-gram
of all of them). Equal texts are one class from the start, so that copies
cost nothing further. Each text class gets a MinHash signature, cut into
bands; numbers of bands and rows are chosen so that a pair at the threshold
shares a band with the target recall, with as many rows a band (as few false
candidates) as ``most_hashes`` allow. One shuffle on band hashes links each
class with the smallest of its bucket; the components of these links hold all
candidate pairs.

Candidates are verified on the full n-gram sets in one of two ways, per
component the one that moves fewer texts. ``whole``: every pair of the
component, right for dense groups of near copies, which meet in most bands. By
bucket: only pairs that share a band, each in its first shared one, right for
long chains of weakly similar texts, where all pairs would be the square of
the chain. Either way the members are dealt into blocks of ``block`` classes,
and each pair of blocks is one small group, so a component or bucket of
thousands spreads over many tasks and none is collected whole. A verified
block pair does not emit its pairs: it emits, per class, the number of its
links, and a spanning forest of them. (``similar_pairs`` emits pairs of
classes instead.) Nothing is capped: every pair of different texts that share
a band is compared.

Defined cases: null texts and texts without a word have no n-grams, are in a
class with texts equal to them but never linked otherwise; ids are compared
with null last; repeated rows are copies of one text; an empty table gives an
empty result; other columns are ignored or, by ``one_of_each_group``, kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.bytespans import SpanHasher, mix, row_groups, utf8, word_spans
from eventlytics.llm.components import components
from eventlytics.llm.frames import fresh, only, written

WORDS, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.9999, 256
BLOCK = 128                # texts of a block, about
BLOCK_GRAMS = 1 << 19      # n-grams of a block, about
MOST_BROADCAST = 500_000   # digests of 16 bytes
GROUP_BYTES = 1 << 20
PLACES = "array<struct<place:bigint,band:int,blocks:int>>"


def choose_bands(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which pairs at the threshold
    share a band with probability ``recall`` within ``most_hashes``."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows > most_hashes:
            break
        best = (bands, rows)
    return best


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct word n-grams of each row, sorted."""
    start, end, row = word_spans(data, offsets)
    if not len(start):
        return row, np.zeros(0, np.uint64)
    h = SpanHasher(data)(start, end)
    mult = np.uint64(0x9E3779B97F4A7C15)
    first = np.searchsorted(row, np.arange(len(offsets)))  # first word of each row
    n = np.diff(first)
    grams = h.copy()
    for k in range(1, words):
        grams[:len(h) - k] = grams[:len(h) - k] * mult + h[k:]
    ok = np.arange(len(h)) + words <= first[1:][row]
    out_row, out = row[ok], mix(grams[ok])
    for r in np.flatnonzero((n > 0) & (n < words)):
        g = 0
        for x in h[first[r]:first[r + 1]].tolist():
            g = (g * int(mult) + x) & (1 << 64) - 1
        out_row = np.append(out_row, r)
        out = np.append(out, mix(np.array([g ^ int(n[r])], np.uint64)))
    order = np.lexsort((out, out_row))
    out_row, out = out_row[order], out[order]
    new = np.ones(len(out), bool)
    new[1:] = (out_row[1:] != out_row[:-1]) | (out[1:] != out[:-1])
    return out_row[new], out[new]


def _seeds(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(bands * rows, dtype=np.uint64)
    return mix(k * np.uint64(2) + np.uint64(1)) | np.uint64(1), mix(k + np.uint64(0x5851F42D4C957F2D))


def band_hashes(row: np.ndarray, grams: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have n-grams, their band hashes as int64)."""
    have, first = np.unique(row, return_index=True)
    if not len(have):
        return have, np.zeros((0, bands), np.int64)
    a, b = _seeds(bands, rows)
    low = np.empty((bands * rows, len(have)), np.uint64)
    for k in range(bands * rows):
        low[k] = np.minimum.reduceat(grams * a[k] + b[k], first)
    out = np.zeros((bands, len(have)), np.uint64)
    for k in range(bands):
        for j in range(rows):
            out[k] = mix(out[k] ^ (low[k * rows + j] >> np.uint64(16)))
        out[k] += np.uint64(k)
    return have, out.T.astype(np.int64)


def _signer(words: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in row_groups(offsets, GROUP_BYTES):
                row, grams = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                have, hashes = band_hashes(row, grams, bands, rows)
                cuts = np.zeros(b - a + 1, np.int32)
                cuts[have + 1] = bands
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array(np.bincount(row, minlength=b - a).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.cumsum(cuts, dtype=np.int32)), pa.array(hashes.ravel()))],
                    names=["digest", "doc_id", "n_grams", "hashes"])

    return sign


def _gram_pass(words: int):
    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in row_groups(offsets, GROUP_BYTES):
                row, grams = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], words)
                cuts = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(a, b - a) for c in batch.columns[1:]],
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(grams.view(np.int64)))],
                    names=[*batch.schema.names[1:], "grams"])

    return grams_of


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(len(a), len(b)) sizes of the common parts of two lists of sets, each
    a sorted array of distinct numbers; in strips of shared elements."""
    out = np.zeros((len(a), len(b)), np.float32)
    values = np.concatenate([*a, *b]) if a and b else np.zeros(0, np.int64)
    if not len(values):
        return out.astype(np.int64)
    owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    known, where, n = np.unique(values, return_inverse=True, return_counts=True)
    in_b = np.bincount(where, owner >= len(a), len(known))
    shared = (in_b > 0) & (in_b < n)          # found on both sides
    number = np.cumsum(shared) - 1
    keep = shared[where]
    where, owner = number[where[keep]], owner[keep]
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    strip = 4096
    for first in range(0, int(shared.sum()), strip):
        lo, hi = np.searchsorted(where, [first, first + strip])
        w, o = where[lo:hi] - first, owner[lo:hi]
        left = np.zeros((len(a), strip), np.float32)
        right = np.zeros((len(b), strip), np.float32)
        mine = o < len(a)
        left[o[mine], w[mine]] = 1
        right[o[~mine] - len(a), w[~mine]] = 1
        out += left @ right.T
    return np.rint(out).astype(np.int64)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[int]:
    """Which of the links (i, j) among n nodes make a spanning forest."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = find(x), find(y)
        if x != y:
            parent[x] = y
            out.append(k)
    return out


def _verifier(threshold: float, pairs: bool):
    def verify(table: pa.Table) -> pa.Table:
        """One pair of blocks of a component (band -1) or bucket: columns id,
        side, grams, same (a block with itself), band, hashes (of a bucket's
        texts: pairs that share an earlier band are left to that). Rows out:
        (a, b, links): links of a, with b null; or a link (a, b) of the
        forest, or any if ``pairs``."""
        table = table.combine_chunks()
        order = np.lexsort((table["id"].to_numpy(), table["side"].to_numpy()))
        table = table.take(pa.array(order))
        side, ids = table["side"].to_numpy(), table["id"].to_pylist()
        lists = table["grams"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        values, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
        sets = [values[cuts[k]:cuts[k + 1]] for k in range(len(ids))]
        size = np.array([len(s) for s in sets], np.int64)
        alone = bool(table["same"][0].as_py()) if len(ids) else True
        n = int((side == 0).sum())
        right = range(n) if alone else range(n, len(ids))
        common = overlaps(sets[:n], [sets[k] for k in right])
        other = size[list(right)]
        union = size[:n, None] + other[None, :] - common
        linked = (common > 0) & (common >= threshold * union - 1e-9)
        if alone:
            linked &= ~np.eye(n, dtype=bool)
        band = table["band"][0].as_py() if len(ids) else -1
        if band > 0:
            hashes = table["hashes"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[:, :band]
            for k in range(band):
                linked &= hashes[:n, None, k] != hashes[None, list(right), k]
        i, j = np.nonzero(np.triu(linked) if alone else linked)
        jj = j if alone else j + n
        links = np.bincount(i, minlength=len(ids)) + np.bincount(jj, minlength=len(ids))
        some = np.flatnonzero(links)
        chosen = range(len(i)) if pairs else _forest(i, jj, len(ids))
        a = [ids[k] for k in some] + [ids[i[k]] for k in chosen]
        b = [None] * len(some) + [ids[jj[k]] for k in chosen]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                         "links": pa.array(links[some].tolist() + [0] * len(chosen), pa.int64())})

    return verify


def _digest(text: Column) -> Column:
    """128 bits of the text; null and empty texts are equal."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def text_classes(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """One row per distinct text, written: id (a number), digest, text_id
    (least doc_id), n_copies, n_grams and band hashes."""
    d = only(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    d = d.select(_digest(F.col("text")).alias("digest"), "doc_id", "text")
    signed = d.mapInArrow(_signer(words, bands, rows),
                          f"digest binary, doc_id {kind}, n_grams bigint, hashes array<bigint>")
    # copies of a text leave a task as one row
    one = signed.groupBy("digest").agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("n_copies"),
                                       F.first("n_grams").alias("n_grams"), F.first("hashes").alias("hashes"))
    return written(one.withColumn("id", F.monotonically_increasing_id()), "texts")


def _places(classes: DataFrame, near: DataFrame, low: DataFrame, blocks: Column) -> DataFrame:
    """(id, digest, hashes, places): where each candidate class is compared,
    with the number of blocks there: its component's root with band -1 (hashes
    are null), or the band hashes of its buckets."""
    sizes = near.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_grams").alias("g"))
    root_of = near.select(F.col("id").alias("a"), "root")
    moved = low.join(root_of, "a").groupBy("root").agg(F.sum(F.col("n") * F.col("blocks")).alias("by_bucket"))
    sizes = sizes.select("root", "n", blocks).join(moved, "root").select(
        "root", "blocks", (F.col("n") * F.col("blocks") <= F.col("by_bucket")).alias("whole"))
    near = near.join(sizes, "root")
    place = lambda at, band: F.struct(F.col(at).alias("place"), band.alias("band"), F.col("blocks"))
    whole = near.where("whole").select("id", "digest", F.lit(None).cast("array<bigint>").alias("hashes"),
                                       F.array(place("root", F.lit(-1))).alias("places"))
    chained = near.where("NOT whole").select("id").join(classes.select("id", "digest", "hashes"), "id")
    met = chained.select("id", F.posexplode("hashes").alias("band", "hash")).join(low.select("hash", "blocks"), "hash")
    met = met.groupBy("id").agg(F.collect_list(place("hash", F.col("band"))).alias("places"))  # at most one a band
    return whole.unionByName(chained.join(met, "id").select("id", "digest", "hashes", "places"))


def link_classes(docs: DataFrame, classes: DataFrame, words: int, threshold: float, block: int,
                 pairs: bool = False) -> DataFrame:
    """Rows (a, b, links) of ``_verifier`` over the ids of ``classes``, written."""
    buckets = classes.select("id", "n_grams", F.posexplode("hashes").alias("band", "hash"))
    # a block holds about ``block`` texts and BLOCK_GRAMS n-grams
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("g") / BLOCK_GRAMS)).cast("int").alias("blocks")
    low = buckets.groupBy("hash").agg(F.min("id").alias("a"), F.max("id").alias("z"),
                                      F.count(F.lit(1)).alias("n"), F.sum("n_grams").alias("g"))
    low = low.where("a < z").select("hash", "a", "n", blocks)  # buckets of several texts
    low = written(low, "buckets")
    edges = buckets.join(low, "hash").select("a", F.col("id").alias("b"))
    near = components(edges, "candidates").withColumnRenamed("node", "id")
    near = written(near.join(classes.select("id", "digest", "n_grams"), "id"), "candidates")
    members = written(_places(classes, near, low, blocks), "members")
    # one copy of each member's text
    d = only(docs, "text").select(_digest(F.col("text")).alias("digest"), "text")
    one_text = lambda t: t.groupBy("digest").agg(F.first("text").alias("text"))
    n = members.count()
    if n <= MOST_BROADCAST:
        texts = one_text(d.join(F.broadcast(members.select("digest")), "digest", "left_semi"))
    else:  # copies are reduced before the shuffle
        texts = one_text(d).join(members.select("digest"), "digest", "left_semi")
    grams = texts.join(members, "digest").select("text", "id", "places", "hashes").mapInArrow(
        _gram_pass(words), f"id bigint, places {PLACES}, hashes array<bigint>, grams array<bigint>")
    # members are dealt into blocks by a hash
    grams = grams.select("id", "hashes", "grams", F.inline("places")).withColumn(
        "mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # block pair (x, y), x <= y: x has side 0, y side 1, a block with itself only side 0
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = grams.select("id", "place", "band", "hashes", "grams", "mine", other.alias("k")).select(
        "id", "place", "band", "hashes", "grams", F.least("mine", "k").alias("x"), F.greatest("mine", "k").alias("y"),
        (F.col("mine") > F.col("k")).cast("int").alias("side"), (F.col("mine") == F.col("k")).alias("same"))
    return written(dealt.groupBy("place", "band", "x", "y").applyInArrow(
        _verifier(threshold, pairs), "a bigint, b bigint, links bigint"), "links")


def _grouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the root of each one's group of links."""
    roots = components(links.where("b IS NOT NULL"), "groups").withColumnRenamed("node", "id")
    return classes.drop("hashes").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def similar_documents(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL,
                      most_hashes: int = MOST_HASHES, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id among all
    documents joined to it by links, itself included), text_id (the least
    doc_id with the same text), n_copies (rows with the same text) and
    n_links (other texts at or above the threshold)."""
    classes = text_classes(docs, words, *choose_bands(threshold, recall, most_hashes))
    links = link_classes(docs, classes, words, threshold, block)
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("n_links"))
    texts = _grouped(classes, links).join(counts, "id", "left")
    texts = written(texts.select("digest", "text_id", "n_copies", "root", F.coalesce(
        "n_links", F.lit(0).cast("bigint")).alias("n_links")), "grouped")
    least = texts.groupBy("root").agg(F.min("text_id").alias("class_id"))
    texts = texts.join(least, "root").drop("root")
    d = only(docs, "doc_id", "text").select("doc_id", _digest(F.col("text")).alias("digest"))
    return d.join(texts, "digest").select("doc_id", "class_id", "text_id", "n_copies", "n_links")


def similar_pairs(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL,
                  most_hashes: int = MOST_HASHES, block: int = BLOCK) -> DataFrame:
    """(a, b): every pair of different texts at or above the threshold, each
    by its least doc_id. Grows with the square of a group."""
    classes = text_classes(docs, words, *choose_bands(threshold, recall, most_hashes))
    links = link_classes(docs, classes, words, threshold, block, pairs=True).where("b IS NOT NULL")
    name = lambda side: classes.select(F.col("id").alias(side), F.col("text_id").alias(f"id_{side}"))
    return links.join(name("a"), "a").join(name("b"), "b").select(
        F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def one_of_each_group(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL,
                      most_hashes: int = MOST_HASHES, block: int = BLOCK) -> DataFrame:
    """The documents without near copies: of each group joined by links the
    document with the least doc_id stays (a null id only if there is no
    other), with all its columns. Of several rows with that id and text one
    stays."""
    classes = text_classes(docs, words, *choose_bands(threshold, recall, most_hashes))
    texts = _grouped(classes, link_classes(docs, classes, words, threshold, block))
    digest, row = fresh(docs, "digest"), fresh(docs, "row")
    kept = texts.groupBy("root").agg(F.min(F.struct(
        F.col("text_id").isNull().alias("no_id"), "text_id", "digest")).alias("k"))
    # one row of each text, reduced before the shuffle; then those of the kept texts
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    one = docs.groupBy(_digest(F.col("text")).alias(digest)).agg(F.min_by(own, first).alias(row))
    one = one.join(kept.select(F.col("k.digest").alias(digest)), digest, "left_semi")
    return one.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])
