"""Language identification by prediction by partial matching.

One byte context tree per language, of contexts of up to ``order`` bytes. A
byte is coded in the longest context seen in training: its own probability
there, or an escape (method C: as many escapes as distinct bytes) to the
context one byte shorter, where the bytes seen in the longer one are excluded
from the counts; below order 0 the bytes never seen are equally likely. The
counts are frozen, so the exact code length of a text is the sum over its
``order + 1``-byte grams of a fixed number per language; the language with
the shortest code wins (ties: the first in alphabetical order).

Training takes about ``train_docs`` different labelled texts in all, an equal
share per language but at least about ``MIN_TEXTS``, chosen by a hash of the
text; copies of a text count once. Texts of up to ``max_train_bytes`` come
first. A language with fewer of them than its share is also learned from longer
ones, never cut, of about as many bytes as are missing (at least as many texts
as are missing to ``MIN_TEXTS``). Their counting is a distributed
aggregation; the model is broadcast. Every text is scored whole, without a
shuffle, in blocks of bytes of fixed size; per worker, the code lengths of
grams are kept in a direct-mapped table of fixed size.

Defined cases: null texts and texts without a letter give ``und`` with score
0, as does every text when nothing can be learned; repeated rows are scored
each for itself; rows with a null doc_id are scored but not learned from; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.bytespans import mix, row_groups, utf8
from eventlytics.llm.frames import learnable, only

UNKNOWN = "und"
BLOCK = 1 << 19       # bytes scored at once
SLOTS = 1 << 20       # of the table of code lengths
COUNTED = 1 << 22     # bytes whose grams are counted at once
MIN_TEXTS = 32        # learned from per language (expected), if there are


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte from ``order`` on, it and the ``order`` before it."""
    n = len(data) - order
    g = data[order:].astype(np.int64)
    for k in range(1, order + 1):
        g |= data[order - k:order - k + n].astype(np.int64) << (8 * k)
    return g


def _padded(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows with ``order`` zero bytes before each, and where each starts."""
    n = len(offsets) - 1
    starts = offsets[:-1] + order * np.arange(1, n + 1)
    out = np.zeros(len(data) + order * n, np.uint8)
    keep = np.ones(len(out), bool)
    for k in range(1, order + 1):
        keep[starts - k] = False
    out[keep] = data
    return out, starts


def _count_grams(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                data, offsets = utf8(batch.column(1).filter(pa.array(langs == lang)))
                for a, b in row_groups(offsets, COUNTED):
                    part, starts = _padded(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], order)
                    ok = np.ones(len(part), bool)
                    for k in range(1, order + 1):
                        ok[starts - k] = False
                    for first in range(order, len(part), COUNTED):  # a long text in blocks
                        last = min(first + COUNTED, len(part))
                        g = _grams(part[first - order:last], order)
                        keys, n = np.unique(g[ok[first:last]], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n.astype(np.int64))],
                            names=["lang", "gram", "n"])

    return count


class ContextTree:
    """Code lengths (bits) of one language's frozen counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int):
        self.order, self.levels = order, []
        for k in range(order + 1):  # symbols seen after contexts of k bytes
            keys = grams & ((1 << 8 * (k + 1)) - 1)
            keys, where = np.unique(keys, return_inverse=True)
            n = np.bincount(where, counts, len(keys))
            ctx, first, which, distinct = np.unique(
                keys >> 8, return_index=True, return_inverse=True, return_counts=True)
            total = np.bincount(which, n, len(ctx))
            self.levels.append({"keys": keys, "n": n, "ctx": ctx, "q": distinct.astype(float), "total": total,
                                "which": which})
        # for a context: the counts, one level down, of the bytes seen in it
        for k in range(1, order + 1):
            high, low = self.levels[k], self.levels[k - 1]
            at = np.searchsorted(low["keys"], high["keys"] & ((1 << 8 * k) - 1))
            high["below"] = np.bincount(high["which"], low["n"][at], len(high["ctx"]))

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """The code length of each gram's last byte after the others."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))       # not yet coded
        seen_q = np.zeros(len(grams))      # distinct bytes and counts excluded
        seen_n = np.zeros(len(grams))
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            g = grams[todo] & ((1 << 8 * (k + 1)) - 1)
            c, known = self._find(level["ctx"], g >> 8)
            i = np.flatnonzero(known)      # else the context is unknown: no cost
            c, rows = c[i], todo[i]
            q = level["q"][c] - seen_q[rows]
            whole = level["total"][c] - seen_n[rows] + q
            s, hit = self._find(level["keys"], g[i])
            with np.errstate(divide="ignore", invalid="ignore"):
                out[rows[hit]] += np.log2(whole[hit]) - np.log2(level["n"][s[hit]])
                escape = np.where(q > 0, np.log2(whole) - np.log2(q), 0.0)
            miss = ~hit
            out[rows[miss]] += escape[miss]
            seen_q[rows[miss]] = level["q"][c[miss]]
            if k:
                seen_n[rows[miss]] = level["below"][c[miss]]
            done = np.zeros(len(todo), bool)
            done[i[hit]] = True
            todo = todo[~done]
        out[todo] += np.log2(np.maximum(256 - seen_q[todo], 1))
        return out


class Model:
    """The languages' trees, and a per-process table of code lengths."""

    def __init__(self, order: int, languages: list[str], trees: list[ContextTree]):
        self.order, self.languages, self.trees = order, languages, trees

    def __getstate__(self):
        return {"order": self.order, "languages": self.languages, "trees": self.trees}

    def _table(self):
        if "_keys" not in self.__dict__:
            self._keys = np.full(SLOTS, -1, np.int64)
            self._bits = np.zeros((SLOTS, len(self.languages)), np.float32)
        return self._keys, self._bits

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """(grams, languages): bits of each gram's last byte."""
        keys, bits = self._table()
        slot = (mix(grams.astype(np.uint64)) & np.uint64(SLOTS - 1)).astype(np.int64)
        out = bits[slot]
        missing = np.flatnonzero(keys[slot] != grams)
        if len(missing):
            new, first, where = np.unique(grams[missing], return_index=True, return_inverse=True)
            values = np.stack([t.bits(new) for t in self.trees], axis=1).astype(np.float32)
            out[missing] = values[where]
            at, pick = np.unique(slot[missing][first], return_index=True)  # one gram per slot
            keys[at], bits[at] = new[pick], values[pick]
        return out

    def totals(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, languages): the code length of each whole text."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        part, starts = _padded(data, offsets, self.order)
        ends = starts + np.diff(offsets)
        for a in range(self.order, len(part), BLOCK):
            b = min(a + BLOCK, len(part))
            values = self.code_lengths(_grams(part[a - self.order:b], self.order))
            first = int(np.searchsorted(ends, a, side="right"))
            last = int(np.searchsorted(starts, b, side="left"))
            lo = np.maximum(starts[first:last], a) - a
            hi = np.minimum(ends[first:last], b) - a
            rows = np.flatnonzero(hi > lo)
            if len(rows):
                cuts = np.stack([lo[rows], hi[rows]], axis=1).ravel()
                more = np.append(values, np.zeros((1, values.shape[1]), values.dtype), axis=0)
                out[first + rows] += np.add.reduceat(more, cuts, axis=0, dtype=np.float64)[::2]
        return out


def fit_languages(docs: DataFrame, order: int = 4, train_docs: int = 2000,
                  max_train_bytes: int = 1 << 15) -> Model:
    """Frozen statistics from labelled rows of ``docs`` (doc_id, text, lang).

    ``train_docs`` bounds (in expectation, but for ``MIN_TEXTS`` per language)
    the number of different texts learned from, ``max_train_bytes`` the size of
    each unless a language has too few such texts.
    """
    d = only(docs, "doc_id", "text", "lang").where(learnable(F.col("doc_id")))
    d = d.where("text IS NOT NULL AND lang IS NOT NULL").select(
        "lang", "text", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))
    short = F.col("size") <= max_train_bytes
    texts = d.groupBy("lang", "hash").agg(F.max("size").alias("size"))
    per_lang = {r["lang"]: r for r in texts.groupBy("lang").agg(
        F.count_if(short).alias("short"), F.count_if(~short).alias("long"),
        F.avg(F.when(~short, F.col("size"))).alias("mean")).collect()}
    if not per_lang:
        return Model(order, [], [])
    share = max(train_docs / len(per_lang), MIN_TEXTS)
    scale = 1 << 30

    def rate(wanted: float, texts: int) -> int:
        return int(min(1.0, wanted / texts) * scale) if texts else 0

    def long_rate(r) -> int:
        if r["short"] >= share or not r["long"]:
            return 0
        wanted = (share - r["short"]) * max_train_bytes / r["mean"]
        return rate(max(wanted, MIN_TEXTS - r["short"]), r["long"])

    def rates(of) -> Column:
        literals = [x for lang, r in per_lang.items() for x in (F.lit(lang), F.lit(of(r)))]
        return F.element_at(F.create_map(*literals), F.col("lang"))

    chosen = F.pmod("hash", F.lit(scale)) < F.when(short, rates(lambda r: rate(share, r["short"]))
                                                   ).otherwise(rates(long_rate))
    sample = d.where(chosen).select("lang", "text").distinct()
    grams = (sample.mapInArrow(_count_grams(order), "lang string, gram bigint, n bigint")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n"))).toArrow()
    langs = np.array(grams["lang"].to_pylist(), dtype=object)
    gram, n = grams["gram"].to_numpy(), grams["n"].to_numpy()
    languages = sorted(set(langs))
    return Model(order, languages, [ContextTree(gram[langs == x], n[langs == x], order) for x in languages])


def _predictor(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        names = np.array(model.languages + [UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            known = np.array(batch.column(2).to_pylist(), dtype=bool)
            n = batch.num_rows
            best, score = np.full(n, len(names) - 1), np.zeros(n)
            if model.languages:
                for a, b in row_groups(offsets, 1 << 22):
                    bits = model.totals(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    best[a:b] = bits.argmin(axis=1)
                    score[a:b] = 1 / np.exp2(np.minimum(bits.min(axis=1, keepdims=True) - bits, 0)).sum(axis=1)
                best[~known], score[~known] = len(names) - 1, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"])

    return predict


def identify_languages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred and score, the probability of
    that language if all learned ones are equally likely beforehand."""
    d = only(docs, "doc_id", "text")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kind = d.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return d.select("doc_id", "text", letters.alias("letters")).mapInArrow(
        _predictor(shared), f"doc_id {kind}, lang_pred string, score double")
