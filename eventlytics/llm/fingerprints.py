"""Document fingerprints: invertible Bloom lookup sketches of paragraph cells.

A text is cut into paragraph cells: its lines, and long lines further at
words chosen by their hash (one in ``CUT``), so that equal passages give
equal cells wherever they stand. Each cell has a 64-bit digest (repeats in a
text count: the k-th one gets its own digest). The sketch adds every digest
to three cells of an invertible Bloom lookup table (count, xor of digests,
xor of checks).

Two sketches of equal size subtract cell by cell: what both texts share
cancels, and peeling (take a cell that holds one digest, remove that digest
from its other cells, go on) recovers the digests of either side alone. If
peeling gets stuck, both sketches are made anew, four times larger and with
other hash functions, until it succeeds. The likeness is shared cells over
all cells of both texts, 1.0 for two texts without any.

All texts of a batch are sketched and peeled together in flat numpy arrays,
so memory is in proportion to a batch. Comparing each document with the next
one needs the order of ids: rows are dealt by ranges of doc_id (quantiles of
all ids), each range also getting a copy of the row after it; one shuffle.

Defined cases: null texts count as empty; documents are ordered by doc_id,
nulls first, then by text; repeated rows follow one another; the next of the
last row is the first; a single row is its own next; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.bytespans import SpanHasher, mix, row_groups, utf8, word_spans
from eventlytics.llm.frames import constant_array, only

CUT = 8               # a long line is cut after one word in so many
HASHES = 3
CELLS = 12            # of the sketch in a fingerprint
GROW = 4
GROUP_BYTES = 1 << 21


def cell_digests(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, digest) of every paragraph cell, sorted by row and digest."""
    start, end, row = word_spans(data, offsets)
    if not len(start):
        return row, np.zeros(0, np.uint64)
    digest = SpanHasher(data)
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    last = np.ones(len(start), bool)
    last[:-1] = (row[1:] != row[:-1]) | (lines[start[1:]] > lines[end[:-1]])
    last |= digest(start, end) % np.uint64(CUT) == 0
    stop = np.flatnonzero(last)
    first = np.concatenate(([0], stop[:-1] + 1))
    cell_row, cells = row[stop], digest(start[first], end[stop])
    order = np.lexsort((cells, cell_row))
    cell_row, cells = cell_row[order], cells[order]
    new = np.ones(len(cells), bool)
    new[1:] = (cell_row[1:] != cell_row[:-1]) | (cells[1:] != cells[:-1])
    at = np.arange(len(cells))
    repeat = at - np.maximum.accumulate(np.where(new, at, 0))
    return cell_row, mix(cells + repeat.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


class Sketches:
    """One sketch per row; row r has ``3 * widths[r]`` cells, flat."""

    def __init__(self, widths: np.ndarray, salt: int):
        self.widths, self.salt = widths.astype(np.int64), np.uint64(salt * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        self.base = np.concatenate(([0], np.cumsum(HASHES * self.widths)))
        n = int(self.base[-1])
        self.count = np.zeros(n, np.int32)
        self.keys = np.zeros(n, np.uint64)
        self.checks = np.zeros(n, np.uint32)

    def check(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)

    def add(self, rows: np.ndarray, keys: np.ndarray, sign) -> None:
        checks = self.check(keys)
        for j in range(HASHES):
            seed = np.uint64((j + 1) * 0xE7037ED1A0B428DB & (1 << 64) - 1)
            h = mix((keys ^ seed) + self.salt)
            cell = self.base[rows] + j * self.widths[rows] + (
                h % self.widths[rows].astype(np.uint64)).astype(np.int64)
            np.add.at(self.count, cell, sign)
            np.bitwise_xor.at(self.keys, cell, keys)
            np.bitwise_xor.at(self.checks, cell, checks)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches.__new__(Sketches)
        out.widths, out.salt, out.base = self.widths, self.salt, self.base
        out.count, out.keys, out.checks = (
            self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks)
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest, +1/-1) recovered, and which rows peeled empty.
        Uses the sketches up."""
        rows_out, keys_out, signs_out = [], [], []
        look = np.flatnonzero(self.count)
        while len(look):
            look = look[np.abs(self.count[look]) == 1]
            look = look[self.checks[look] == self.check(self.keys[look])]
            if not len(look):
                break
            rows = np.searchsorted(self.base, look, side="right") - 1
            keys, signs = self.keys[look], self.count[look]
            order = np.lexsort((keys, rows))
            rows, keys, signs = rows[order], keys[order], signs[order]
            once = np.ones(len(rows), bool)
            once[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
            rows, keys, signs = rows[once], keys[once], signs[once]
            rows_out.append(rows), keys_out.append(keys), signs_out.append(signs)
            self.add(rows, keys, -signs)
            look = np.unique(np.flatnonzero(self.count)) if len(rows) else look[:0]
        left = (self.count != 0) | (self.keys != 0)
        stuck = (np.add.reduceat(np.append(left, False).astype(np.int64), self.base[:-1]) > 0
                 if len(self.widths) else left)
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return cat(rows_out, np.int64), cat(keys_out, np.uint64), cat(signs_out, np.int32), ~stuck

    def texts(self, sizes: np.ndarray) -> list[str]:
        """Each row's sketch as text: its number of cells and the table."""
        out = []
        for r, n in enumerate(sizes):
            a, b = self.base[r], self.base[r + 1]
            raw = (self.count[a:b].astype("<i4").tobytes() + self.keys[a:b].astype("<u8").tobytes()
                   + self.checks[a:b].astype("<u4").tobytes())
            out.append(f"{n}:{base64.b64encode(raw).decode()}")
        return out


def sketch(n_rows: int, rows: np.ndarray, digests: np.ndarray, widths=None, salt: int = 0) -> Sketches:
    s = Sketches(np.full(n_rows, CELLS // HASHES) if widths is None else widths, salt)
    s.add(rows, digests, 1)
    return s


def _of(rows, digests, chosen, n):
    """The cells of the chosen rows, renumbered."""
    place = np.full(n, -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[rows] >= 0
    return place[rows[keep]], digests[keep]


def likeness(n: int, a: tuple, b: tuple) -> np.ndarray:
    """Shared over all cells, for n pairs of texts; ``a`` and ``b`` are
    (row, digest) arrays. By subtracting and peeling sketches, with larger
    ones for the pairs that got stuck."""
    size = np.bincount(a[0], minlength=n) + np.bincount(b[0], minlength=n)
    differ = np.zeros(n, np.int64)
    todo, width, salt = np.arange(n), CELLS // HASHES, 0
    while len(todo):
        # no wider than what surely peels
        widths = np.minimum(width, np.maximum(size[todo], CELLS // HASHES)) if salt < 8 else np.full(len(todo), width)
        one = sketch(len(todo), *_of(*a, todo, n), widths, salt)
        two = sketch(len(todo), *_of(*b, todo, n), widths, salt)
        rows, _, _, done = one.minus(two).peel()
        differ[todo[done]] = np.bincount(rows, minlength=len(todo))[done]
        todo, width, salt = todo[~done], width * GROW, salt + 1
    return np.where(size > 0, (size - differ) / np.maximum(size + differ, 1), 1.0)


def _table(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return cell_digests(*utf8(pa.array(texts, pa.large_string())))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in row_groups(offsets, GROUP_BYTES):
            cells = cell_digests(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            s = sketch(b - a, *cells)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(s.texts(np.bincount(cells[0], minlength=b - a)))],
                names=["doc_id", "fingerprint"])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and fingerprint. No shuffle."""
    d = only(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(_fingerprints, f"doc_id {kind}, fingerprint string")


def edited(text: str, follow: str) -> str:
    """``text`` with its last quarter replaced by as much of ``follow``."""
    k = len(text) // 4
    return text[:len(text) - k] + follow[:k]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(ids, texts):  # rows 0..n-1, and the one after them
        n = len(ids)
        new = [edited(t, f) for t, f in zip(texts, texts[1:])]
        own, changed = _table(texts), _table(new)
        first = own[0] < n
        mine = own[0][first], own[1][first]
        after = own[0] > 0
        follow = own[0][after] - 1, own[1][after]
        size = np.bincount(own[0], minlength=n + 1)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, kind), pa.array([len(t) for t in texts[:n]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]),
            pa.array(sketch(n, *mine).texts(size[:n])),
            pa.array(sketch(n, *changed).texts(np.bincount(changed[0], minlength=n))),
            pa.array(likeness(n, mine, changed)), pa.array(likeness(n, mine, follow))], names=NAMES)

    ids, texts, ahead_of, part, size, kind = [], [], None, None, 0, pa.int64()
    for batch in batches:
        kind = batch.column(2).type
        for p, ahead, i, text in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part:
                ids, texts, ahead_of, part, size = [], [], None, p, 0
            elif ahead_of == p:
                continue  # the range is done: further copies of the row after it
            text = text or ""
            if ids and (ahead or size >= GROUP_BYTES):
                yield out(ids, texts + [text])
                ids, texts, size = [], [], 0
            if ahead:
                ahead_of = p
                continue
            ids.append(i), texts.append(text)
            size += len(text)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are at most ``doc_id`` (null: 0), by
    binary search in an array literal."""
    if not cuts:
        return F.lit(0)
    size = 1 << len(cuts).bit_length()
    table = constant_array(cuts, "bigint")
    steps = F.array(*[F.lit(size >> k) for k in range(1, size.bit_length())])
    return F.coalesce(F.when(doc_id.isNotNull(), F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(table, at + step - 1) <= doc_id, at + step).otherwise(at))), F.lit(0))


def compare_with_next(docs: DataFrame, rows_per_range: int = 4000, most_ranges: int = 20_000) -> DataFrame:
    """Each document's fingerprint, that of its edited text (last quarter
    replaced from the next document), and the likeness to it
    (``near_edited``) and to the next document (``near_next``).

    ``rows_per_range`` sets how many ranges of ids there are, up to
    ``most_ranges`` (their bounds go to every task).
    """
    d = only(docs, "doc_id", "text")
    ids = d.select("doc_id")
    n = ids.count()
    kind = d.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    if not n:
        return docs.sparkSession.createDataFrame([], schema)
    ranges = max(1, min(most_ranges, -(-n // rows_per_range)))
    cuts = [] if ranges == 1 else sorted(set(int(x) for x in ids.stat.approxQuantile(
        "doc_id", [k / ranges for k in range(1, ranges)], 1 / (4 * ranges))))
    # the first id of each range that has rows; null is the first of range 0
    firsts = {r["p"]: (None if r["nulls"] else r["low"]) for r in ids.select(
        "doc_id", _range_of(F.col("doc_id"), cuts).alias("p")).groupBy("p").agg(
        F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect()}
    used = sorted(firsts)
    before = {p: used[k - 1] for k, p in enumerate(used)}
    spots = range(len(cuts) + 1)
    low = constant_array([firsts.get(p) or 0 for p in spots], "bigint")
    prev = constant_array([before.get(p, 0) for p in spots], "int")
    nulls = 0 in firsts and firsts[0] is None
    d = d.withColumn("p", _range_of(F.col("doc_id"), cuts))
    is_first = F.when((F.col("p") == 0) & F.lit(nulls), F.col("doc_id").isNull()).otherwise(
        F.col("doc_id") == F.get(low, F.col("p")))
    dealt = d.select("doc_id", "text", F.explode(F.when(is_first, F.array(
        F.struct(F.col("p").alias("p"), F.lit(False).alias("ahead")),
        F.struct(F.get(prev, F.col("p")).alias("p"), F.lit(True).alias("ahead"))
    )).otherwise(F.array(F.struct(F.col("p").alias("p"), F.lit(False).alias("ahead"))))).alias("to"))
    dealt = dealt.select("to.p", "to.ahead", "doc_id", "text").repartitionById(len(cuts) + 1, "p")  # one each
    dealt = dealt.sortWithinPartitions("p", "ahead", F.col("doc_id").asc_nulls_first(),
                                       F.col("text").asc_nulls_first())
    return dealt.mapInArrow(_compare, schema)
