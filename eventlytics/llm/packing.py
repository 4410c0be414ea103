"""Best-fit packing of tokenised documents into fixed-length sequences.

Each document becomes its byte-level BPE ids and an end id; one longer than
``capacity`` is cut so that only its first piece may be shorter than that.
Pieces are packed online, a bounded number of them (``read_ahead``) read at a
time and the longest of these placed first: a piece goes to the open bin with
the least free space that holds it, else to a new bin. Open bins are stacks by
free space, and a bitset of the free spaces in use (one integer of ``capacity
+ 1`` bits) finds the best bin by two bit operations. At most ``open_bins``
are open; then the fullest one closes.

Every input partition is packed by itself in one pass, so there is no
shuffle, memory is the pieces read ahead and the open bins' free spaces, and a
lost task is simply run again. ``sequence_id`` is the partition number and a
running number.

Defined cases: a null text counts as empty (just the end id); a null doc_id
is kept; repeated rows are packed each for itself; an empty table gives an
empty result; other columns are ignored.

``ids`` are those of the ``tokenizers`` file with ``add_special_tokens=False``:
an added token (``<|endoftext|>``) that stands in a text is its one id. Texts of
plain Latin characters go through ``tiktoken`` with the same vocabulary, which
gives the same ids four times as fast; any other text, and one with an added
token, goes through ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from eventlytics.llm.frames import only

# Characters on which the two libraries' patterns agree whatever their
# Unicode version: printable ASCII, tab and line ends, Latin letters.
_OTHER = re.compile("[^\t\n\r -~¡-¬®-ɏ]")
# A white-space run of this length: the fast library's pattern gives up on
# some hundred thousand (ids are the same either way).
LONG_SPACE = 1 << 16
_SPACES = re.compile(rf"\s{{{LONG_SPACE}}}")
SEQUENCE_BITS = 40


class Encoder:
    """Texts to ids; loads each library's file at first use."""

    def __init__(self, name: str):
        self.name, self._fast, self._whole, self._added = name, None, None, None

    def _load_added(self):
        import public_tokenizers
        with open(public_tokenizers.path(f"{self.name}.json"), encoding="utf-8") as f:
            added = [re.escape(t["content"]) for t in json.load(f).get("added_tokens") or ()]
        self._added = re.compile("|".join(added) or r"(?!)")

    def _load_fast(self):
        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path(f"{self.name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding(self.name, pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=ranks, special_tokens={})

    def _load_whole(self):
        import public_tokenizers
        from tokenizers import Tokenizer
        self._whole = Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))

    def __call__(self, text: str) -> list[int]:
        if self._added is None:
            self._load_added()
        if (_OTHER.search(text) or self._added.search(text)
                or len(text) >= LONG_SPACE and _SPACES.search(text)):
            if self._whole is None:
                self._load_whole()
            return self._whole.encode(text, add_special_tokens=False).ids
        if self._fast is None:
            self._load_fast()
        return self._fast.encode_ordinary(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return _ENCODERS.setdefault(name, Encoder(name))


class BestFit:
    """Open bins by free space; ``place`` returns (bin number, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.n_open, self.n_bins = 0, 0, 0

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        b = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.n_open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            b = self._take(free)
        else:
            if self.n_open >= self.open_bins:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            b, free = self.n_bins, self.capacity
            self.n_bins += 1
        left = free - length
        if left:
            self.stacks[left].append(b)
            self.bits |= 1 << left
            self.n_open += 1
        return b, self.capacity - free


def pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be short."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def _packer(vocabulary: str, capacity: int, open_bins: int, read_ahead: int, end_id: int | None,
            schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(vocabulary), BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        tail = [] if end_id is None else [end_id]
        waiting: list[tuple] = []  # (length, doc_id, piece, start, ids)

        def placed() -> pa.RecordBatch:
            waiting.sort(key=lambda x: -x[0])  # equal lengths stay in order
            spots = [bins.place(x[0]) for x in waiting]
            length, doc_id, piece, start, ids = zip(*waiting)
            cols = [doc_id, piece, start, length, ids, [base + b for b, _ in spots], [o for _, o in spots]]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = np.array(encode(text.as_py() or "") + tail, dtype="<u4")
                for k, (start, length) in enumerate(pieces(len(tokens), capacity)):
                    waiting.append((length, doc_id, k, start, tokens[start:start + length].tobytes()))
                    if len(waiting) >= read_ahead:
                        yield placed()
        if waiting:
            yield placed()

    return pack


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k", capacity: int = 1024,
                   open_bins: int = 4096, read_ahead: int = 4096, end_id: int | None = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian
    unsigned 32-bit), sequence_id and offset.

    ``vocabulary`` names a public byte-level vocabulary that is installed as
    ``.json`` and ``.tiktoken``. ``open_bins`` is the number of bins open at
    once per task, ``read_ahead`` that of pieces read before they are placed;
    ``end_id=None`` adds no end id (an empty text then has no piece).
    """
    if capacity < 1 or open_bins < 1 or read_ahead < 1:
        raise ValueError("capacity, open_bins and read_ahead must be positive")
    d = only(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    out = (f"doc_id {kind}, piece int, start bigint, length bigint, ids binary, "
           "sequence_id bigint, offset bigint")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(out))
    return d.mapInArrow(_packer(vocabulary, capacity, open_bins, read_ahead, end_id, schema), out)
