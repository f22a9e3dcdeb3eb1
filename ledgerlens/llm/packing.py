"""Harmonic packing of token ids into sequences of a power-of-two capacity.

The classes are the reciprocal capacities C, C/2, C/4, ..., 1. A document is cut into pieces of
exactly those lengths: as many whole sequences as it fills, and its tail by the binary digits
of its length. A bin of class k takes exactly 2^k pieces, so a bin that has got its number of
pieces is full to the last token. Each task fills the bins of its own rows, without a shuffle.
When its rows are over, at most 2^k - 1 pieces of each class wait in open bins; taken in falling
order of length they fill whole sequences without gaps, and what is left is less than one
sequence and goes into sequences of its binary digits, which need no padding. No task pads
a token, whatever the number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import beside, slices, whole
from ledgerlens.llm.fast_encoding import byte_level

CAPACITY, END = 2048, 1
# Texts that are encoded at once, and ids that are sent out at once, in bytes.
SLICE, OUT = 4 << 20, 8 << 20
PIECE = "ids binary, start long, length long, doc_tokens long, sequence_id long, offset long"


def cut(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of these lengths: which document each piece is of, its start and length.

    The pieces of a document follow one another and fall in length.
    """
    classes = capacity.bit_length()
    full = lengths // capacity
    digits = (lengths[:, None] >> np.arange(classes - 2, -1, -1)) & 1
    counts = np.column_stack([full, digits]).ravel()
    sizes = np.tile(capacity >> np.arange(classes), len(lengths))
    length = np.repeat(sizes, counts)
    doc = np.repeat(np.repeat(np.arange(len(lengths)), classes), counts)
    ends = np.cumsum(length)
    first = np.concatenate([[0], np.cumsum(lengths)])[doc]
    return doc, ends - length - first, length


class Bins:
    """Where pieces go: complete bins at once, the others when the rows are over."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[tuple]] = {capacity >> k: [] for k in range(capacity.bit_length())}

    def put(self, pieces: list[tuple], lengths: np.ndarray) -> Iterator[tuple[tuple, int, int]]:
        """(piece, sequence, offset) of all bins that these pieces complete."""
        for size, waiting in self.open.items():
            waiting.extend([pieces[i] for i in np.flatnonzero(lengths == size)])
            each = self.capacity // size
            done = len(waiting) - len(waiting) % each
            for i, piece in enumerate(waiting[:done]):
                yield piece, self.next + i // each, i % each * size
            self.next += done // each
            del waiting[:done]

    def rest(self) -> Iterator[tuple[tuple, int, int]]:
        """The pieces of open bins, longest first: whole sequences, then ever shorter ones."""
        left = sum(size * len(waiting) for size, waiting in self.open.items())
        room = offset = 0
        for size, waiting in self.open.items():
            for piece in waiting:
                if not room:
                    # A power of two that all remaining pieces together reach; sizes fall, and
                    # each divides the room that is left.
                    room = min(self.capacity, 1 << left.bit_length() - 1)
                    offset, self.next = 0, self.next + 1
                yield piece, self.next - 1, offset
                offset, room, left = offset + size, room - size, left - size


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """A row per piece: id, ids (as little-endian unsigned 32-bit numbers), start (ids of its
    document before it), length, doc_tokens (ids of its document with `end`), sequence_id and
    offset (in its sequence).

    Null texts count as empty and are one piece with `end`; special tokens in a text are encoded
    as such. Rows are treated one by one: repeated ones, and rows with null ids, are packed
    each; other columns are not read; an empty table has no sequence. Sequences are of one
    partition of docs: a task that runs again gives the same rows again. A task holds a slice of
    texts or one text, and fewer than `capacity` open pieces of each class.
    """
    if capacity & (capacity - 1):
        raise ValueError("the capacity is a power of two")
    schema = beside(docs, id_col, PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level(tokenizer, True)
        # Fewer than 2^40 sequences in a task.
        bins, ids_of = Bins(capacity, TaskContext.get().partitionId() << 40), None

        def rows(placed: Iterator[tuple[tuple, int, int]]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for piece, sequence, offset in placed:
                held.append((*piece, sequence, offset))
                size += len(piece[1]) + 64
                if size > OUT:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)

        def batch(held: list[tuple]) -> pa.RecordBatch:
            of, raw, *numbers = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(of, ids_of), pa.array(raw, pa.binary()), *[pa.array(n, pa.int64()) for n in numbers]],
                [id_col, "ids", "start", "length", "doc_tokens", "sequence_id", "offset"])

        for b in slices(batches, "_text", SLICE):
            ids_of = b[id_col].type
            flat, bounds = encode(b["_text"])
            lengths = np.diff(bounds) + 1
            doc, start, length = cut(lengths, capacity)
            text, names = np.full(int(lengths.sum()), end, "<u4"), b[id_col].to_pylist()
            last = np.zeros(len(text), bool)
            last[np.cumsum(lengths) - 1] = True
            text[~last] = flat
            raw, edges = text.tobytes(), np.concatenate([[0], np.cumsum(length)]) * 4
            pieces = [(names[d], raw[i:j], s, n, t) for d, i, j, s, n, t in zip(
                doc.tolist(), edges[:-1].tolist(), edges[1:].tolist(), start.tolist(), length.tolist(), lengths[doc].tolist())]
            yield from rows(bins.put(pieces, length))
        yield from rows(bins.rest())

    return docs.select(id_col, whole(text_col).alias("_text")).mapInArrow(run, schema)


def packing_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """As `pack`, with ids_crc32 (unsigned) for ids; awkward rows as there."""
    return pack(docs, tokenizer, id_col, text_col, capacity, end).select(
        id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
