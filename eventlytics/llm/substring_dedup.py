"""Removal of repeated word passages, with a count-min prefilter.

A window is ``width`` consecutive words of one document. A word goes if a
window that covers it has a word sequence that also starts earlier (a smaller
id, or an earlier place of the same document). Windows are compared by two
independent 64-bit hashes of their words.

1. Each task counts its windows in a count-min sketch: ``DEPTH`` rows of cells
   that count to two ("once" and "more" bit planes, packed). The tasks' blocks
   of planes are merged where they meet in the shuffle, one block at a time.
   A cell never holds less than the count of a window that falls into it.
2. Windows whose cells are all "more" are candidates; all others occur once and
   are done. Candidates are grouped exactly, by 128 bits, to the first place of
   each. Only these first places go back to their documents: one row per
   different candidate, however often it occurs.
3. A document's candidates that are not the first of their kind cover the words
   that go; it finds its candidates again from the sketch.

The sketch has one and a half to three cells a row for each word expected in
the corpus (a power of two), at most ``most_cells`` a row: a task that counts
holds ``DEPTH * most_cells / 4`` bytes, 128 MiB, and half of that is broadcast
at most. On a corpus of more words than that the sketch lets more windows through and the
exact grouping does more of the work; nothing is lost, and the work stays in
proportion to the number of words.

Defined cases: a null text has no words; a text shorter than a window loses
nothing; rows of one id are one document (a window at the same place in both
starts in neither earlier); a row without an id has no place in the order of
documents, so it is compared only with itself; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.bytespans import SpanHasher, mix, row_groups, utf8, word_spans
from eventlytics.llm.frames import freed_shuffles, written

WIDTH = 20
DEPTH = 2
MOST_CELLS = 1 << 28     # per row of the sketch
BLOCK_BITS = 23          # cells of a block (a plane of 1 MiB), as a power of two
GROUP_BYTES = 1 << 20
CHARS_PER_WORD = 6       # only for the size of the sketch

_SPREAD = 0x9E3779B1     # times a place fits 63 bits
_STEP = np.uint64(0xD6E8FEB86659FD93)  # odd
_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_SALTS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25))


def _sums(h: np.ndarray, start: np.ndarray, width: int, power: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * power[:len(h)], out=sums[1:])
    return mix((sums[start + width] - sums[start]) * inverse[start])


def windows(data: np.ndarray, offsets: np.ndarray, width: int):
    """(first word of each row, row of each window, its first word within the
    rows' words, two hashes)."""
    start, end, row = word_spans(data, offsets)
    first = np.searchsorted(row, np.arange(len(offsets)))
    at = np.flatnonzero(np.arange(len(row)) + width <= first[1:][row]) if len(row) else np.zeros(0, np.int64)
    if not len(at):
        none = np.zeros(0, np.uint64)
        return first, np.zeros(0, np.int64), at, none, none
    h = SpanHasher(data)(start, end)
    n = len(h)
    power, inverse = np.full(n, _STEP, np.uint64), np.full(n, _BACK, np.uint64)
    power[0] = inverse[0] = 1
    power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
    return first, row[at], at, *(_sums(mix(h ^ s), at, width, power, inverse) for s in _SALTS)


def cells_for(chars: int, most_cells: int = MOST_CELLS) -> int:
    """Cells of a row: a power of two, so many for each word expected."""
    n = 1 << BLOCK_BITS
    while n < 1.5 * chars / CHARS_PER_WORD and n < most_cells:
        n *= 2
    return n


def _cells(lo: np.ndarray, hi: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (lo + np.uint64(row) * (hi | np.uint64(1))) & np.uint64(cells - 1)


class Planes:
    """Rows of cells that count to two, as packed bits."""

    def __init__(self, cells: int):
        self.cells = cells
        self.once = np.zeros((DEPTH, cells // 8), np.uint8)
        self.more = np.zeros((DEPTH, cells // 8), np.uint8)

    def add(self, lo: np.ndarray, hi: np.ndarray) -> None:
        for row in range(DEPTH):
            cell = np.sort(_cells(lo, hi, row, self.cells))
            new = np.concatenate(([True], cell[1:] != cell[:-1]))
            again = cell[1:][~new[1:]]
            self._mark(row, cell[new], np.unique(again))

    def _mark(self, row: int, cell: np.ndarray, again: np.ndarray) -> None:
        where, bits = _bytes(cell)
        self.more[row][where] |= self.once[row][where] & bits
        self.once[row][where] |= bits
        if len(again):
            where, bits = _bytes(again)
            self.more[row][where] |= bits


def _bytes(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte, bits in it) of sorted different cells."""
    where = cell >> np.uint64(3)
    bit = np.left_shift(np.uint8(1), (cell & np.uint64(7)).astype(np.uint8))
    first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
    return where[first].astype(np.int64), np.bitwise_or.reduceat(bit, first)


def _counter(cells: int, width: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in row_groups(offsets, GROUP_BYTES):
                _, _, _, lo, hi = windows(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                if len(lo):
                    planes = planes or Planes(cells)
                    planes.add(lo, hi)
        if planes is None:
            return
        size = (1 << BLOCK_BITS) // 8
        for row in range(DEPTH):
            for block in range(cells >> BLOCK_BITS):
                once = planes.once[row][block * size:(block + 1) * size]
                if once.any():
                    more = planes.more[row][block * size:(block + 1) * size]
                    yield _block(row, block, once, more)

    return count


def _block(row: int, block: int, once: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([row], pa.int32()), pa.array([block], pa.int32()),
         pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()),
         pa.array([zlib.compress(more.tobytes(), 1)], pa.binary())], names=["row", "block", "once", "more"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one place, which follow each other, become one."""
    key, once, more = None, None, None
    for batch in batches:
        for r in batch.to_pylist():
            o, m = (np.frombuffer(zlib.decompress(r[c]), np.uint8) for c in ("once", "more"))
            if key != (r["row"], r["block"]):
                if key is not None:
                    yield _block(*key, once, more)
                key, once, more = (r["row"], r["block"]), o.copy(), m.copy()
            else:
                more |= m | once & o
                once |= o
    if key is not None:
        yield _block(*key, once, more)


def sketch_windows(docs: DataFrame, width: int = WIDTH, most_cells: int = MOST_CELLS) -> tuple[int, DataFrame]:
    """(cells of a row, merged blocks) of the windows of all texts."""
    spark = docs.sparkSession
    with freed_shuffles(spark):
        cells = cells_for(docs.agg(F.sum(F.length("text"))).head()[0] or 0, most_cells)
    # a few tasks a core, as each sends a sketch: joining splits moves nothing
    texts = docs.select("text").coalesce(2 * spark.sparkContext.defaultParallelism)
    schema = "row int, block int, once binary, more binary"
    parts = texts.mapInArrow(_counter(cells, width), schema)
    merged = (parts.repartition("row", "block").sortWithinPartitions("row", "block")
              .mapInArrow(_merged, schema))
    with freed_shuffles(spark):
        return cells, written(merged, "sketch")


class Candidates:
    """The merged "more" planes, broadcast once and unpacked once a worker."""

    def __init__(self, cells: int, blocks: DataFrame):
        self.cells = cells
        rows = blocks.select("row", "block", "more").toArrow().to_pylist()
        self.sent = blocks.sparkSession.sparkContext.broadcast([(r["row"], r["block"], r["more"]) for r in rows])

    def planes(self) -> list[np.ndarray]:
        planes = np.zeros((DEPTH, self.cells // 8), np.uint8)
        size = (1 << BLOCK_BITS) // 8
        for row, block, more in self.sent.value:
            planes[row][block * size:(block + 1) * size] = np.frombuffer(zlib.decompress(more), np.uint8)
        return planes

    def repeated(self, planes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Numbers of the windows estimated to occur twice or more."""
        left = np.arange(len(lo))
        for row in range(DEPTH):
            cell = _cells(lo[left], hi[left], row, self.cells)
            bits = planes[row][(cell >> np.uint64(3)).astype(np.int64)]
            left = left[(bits >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return left


def _place(lo: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Names one window at one place of a document."""
    return lo.view(np.int64) ^ start.astype(np.int64) * _SPREAD


def _grouper(found: Candidates, width: int):
    """Rows (lo, hi, doc_id, start) of the first occurrence, within a batch, of
    each candidate."""
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            planes = found.planes() if planes is None else planes
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in row_groups(offsets, GROUP_BYTES):
                first, row, at, lo, hi = windows(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                keep = found.repeated(planes, lo, hi)
                if not len(keep):
                    continue
                row, at, lo, hi = row[keep], at[keep], lo[keep], hi[keep]
                start, doc = at - first[row], ids[a:b][row]
                order = np.lexsort((start, doc, hi, lo))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)
                pick = order[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[pick]) for x in (lo.view(np.int64), hi.view(np.int64), doc, start.astype(np.int64))],
                    names=["lo", "hi", "doc_id", "start"])

    return group


def _cutter(found: Candidates, width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            planes = found.planes() if planes is None else planes
            data, offsets = utf8(batch.column(1))
            firsts = batch.column(2)
            for a, b in row_groups(offsets, GROUP_BYTES):
                raw = data[offsets[a]:offsets[b]]
                first, row, at, lo, hi = windows(raw, offsets[a:b + 1] - offsets[a], width)
                mine = np.zeros(len(row), bool)
                keep = found.repeated(planes, lo, hi)
                mine[keep] = True
                start = at - first[row] if len(row) else at
                removed = np.zeros(first[-1] + 1, np.int64)
                text = raw.tobytes()
                kept, gone, sizes = [], [], np.diff(first)
                edge = np.searchsorted(row, np.arange(b - a + 1))
                for r in range(b - a):
                    lo_r, hi_r, st = (x[edge[r]:edge[r + 1]] for x in (lo, hi, start))
                    cand = np.flatnonzero(mine[edge[r]:edge[r + 1]])
                    if len(cand):
                        if batch.column(0)[a + r].as_py():  # has an id: all but the first of their kind
                            place = _place(lo_r[cand], st[cand])
                            known = firsts[a + r].values
                            later = ~np.isin(place, known.to_numpy() if known is not None else [])
                        else:  # only repeats within itself
                            order = np.lexsort((st[cand], hi_r[cand], lo_r[cand]))
                            later = np.zeros(len(cand), bool)
                            later[order[1:]] = ((np.diff(lo_r[cand][order]) == 0)
                                                & (np.diff(hi_r[cand][order]) == 0))
                        s = first[r] + st[cand[later]]
                        np.add.at(removed, s, 1)
                        np.add.at(removed, s + width, -1)
                    words = text[offsets[a + r] - offsets[a]:offsets[a + r + 1] - offsets[a]].split()
                    cover = np.cumsum(removed[first[r]:first[r + 1]]) == 0
                    kept.append(b" ".join(compress(words, cover.tolist())))
                    gone.append(int(sizes[r] - np.count_nonzero(cover)))
                    removed[first[r + 1]] = 0
                passed = batch.slice(a, b - a).select(range(3, batch.num_columns))
                yield pa.RecordBatch.from_arrays(
                    [*passed.columns, pa.array(sizes.astype(np.int64)), pa.array(gone, pa.int64()),
                     pa.array([k.decode() for k in kept], pa.string())],
                    names=[*passed.schema.names, "n_words", "n_removed", "kept"])

    return cut


def remove_repeats(docs: DataFrame, width: int = WIDTH, most_cells: int = MOST_CELLS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is what is left of the
    text, words joined by one space."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = Candidates(*sketch_windows(d, width, most_cells))
    places = (d.where("doc_id is not null")
              .mapInArrow(_grouper(found, width), "lo bigint, hi bigint, doc_id bigint, start bigint"))
    first = places.groupBy("lo", "hi").agg(F.min(F.struct("doc_id", "start")).alias("f"))
    place = F.col("lo").bitwiseXOR(F.col("f.start") * _SPREAD)
    back = first.groupBy(F.col("f.doc_id").alias("doc_id")).agg(F.collect_list(place).alias("firsts"))
    with freed_shuffles(d.sparkSession):
        back = written(back.withColumn("part", F.lit(0).cast("bigint")), "firsts")
    # hot ids of two plain shuffles are split; rows without an id go by their texts' hashes
    part = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0))
    whole = d.withColumn("part", part).join(back, ["doc_id", "part"], "left").select(
        F.col("doc_id").isNotNull().alias("has_id"), "text", "firsts", "doc_id")
    return whole.mapInArrow(_cutter(found, width), "doc_id bigint, n_words bigint, n_removed bigint, kept string")
