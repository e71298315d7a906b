"""Sum-of-squares online packing of token ids into windows of a fixed length.

Each task packs the documents it reads, one after the other; nothing is shuffled. A document longer than a
window fills windows of its own, its rest goes where the sum of squares says: with N[h] open windows at fill
h, the place that makes the sum of N[h] ** 2 over the partial fills least. At the end of a task the
open windows fill each other up, by cuts, and the last one is cut into sequences whose lengths are powers
of two. So there is no padding, and at most as many cuts besides those of long documents as windows were open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow.llm.common import STEP_BYTES, release_memory, small_batches, text_steps, texts_of
from pitchflow.llm.tokens import encoder

WINDOW = 4096
#: Open windows of a task; beyond this they fill each other up. Bounds memory: this many windows of ids.
MAX_OPEN = 2048
#: Sequences of a task are numbered from its number times this on.
TASK_SEQUENCES = 1 << 33
#: Chunks in the encoder's table: packing holds little else, so it can afford more of them than other operators.
CACHE_CHUNKS = 800_000
#: Sequences in a batch that a task puts out: at its end all open windows close at once.
OUT_SEQUENCES = 256

Piece = tuple[int | None, int, np.ndarray, int]  # doc_id, start, ids, ids of the document

SCHEMA = T.StructType(
    [T.StructField(k, T.LongType()) for k in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
    + [T.StructField("ids", T.BinaryType())]
)


class Packer:
    """Open windows by fill; `closed` holds the sequences that are done, as lists of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window, np.int64)  # N[h]
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.closed: list[list[Piece]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Place a document: whole windows first, then the rest of it."""
        whole = len(ids) - len(ids) % self.window
        for at in range(0, whole, self.window):
            self.closed.append([(doc_id, at, ids[at : at + self.window], len(ids))])
        if whole < len(ids):
            # a copy: an open window must not hold all ids of a long document
            self._place((doc_id, whole, ids[whole:].copy(), len(ids)))
        if self.n_open > self.max_open:
            self.settle()

    def level_for(self, size: int) -> int:
        """Fill to put a piece of `size` on: least change of the sum of squares, then the fullest; 0 is a new window."""
        n = self.levels
        fits = np.flatnonzero(n[: self.window - size + 1])
        fits = fits[fits > 0]
        best, least = 0, 1 + 2 * n[size]
        if len(fits):
            to = fits + size
            change = np.where(to < self.window, 2 * (n[to % self.window] - n[fits]) + 2, 1 - 2 * n[fits])
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= least:
                best = int(fits[k])
        return best

    def _place(self, piece: Piece) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        pieces = self._take(level) if level else []
        pieces.append(piece)
        self._put(pieces, level + size)

    def _take(self, level: int) -> list[Piece]:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, pieces: list[Piece], fill: int) -> None:
        if fill == self.window:
            self.closed.append(pieces)
        elif fill:
            self.levels[fill] += 1
            self.n_open += 1
            self.open.setdefault(fill, []).append(pieces)

    def settle(self) -> None:
        """Fill the fullest open windows from the emptiest, by cuts, until at most one is left open."""
        left = [(fill, x) for fill in sorted(self.open) for x in self.open[fill]]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        low = 0
        for at in range(len(left) - 1, -1, -1):
            fill, pieces = left[at]
            while fill < self.window and low < at:
                other_fill, other = left[low]
                doc_id, start, ids, total = other.pop()
                kept = max(0, len(ids) - (self.window - fill))
                moved = len(ids) - kept
                if kept:
                    other.append((doc_id, start, ids[:kept], total))
                pieces.append((doc_id, start + kept, ids[kept:], total))
                fill += moved
                left[low] = (other_fill - moved, other)
                low += not other
            if pieces:
                self._put(pieces, fill)
            left.pop()
            if low >= at:
                break

    def finish(self) -> None:
        """Close everything: what is left after `settle` is cut into sequences of powers of two."""
        self.settle()
        for fill, rest in [(f, p) for f, x in self.open.items() for p in x]:
            at, todo = 0, list(reversed(rest))
            size = 1 << (fill.bit_length() - 1)
            while at < fill:
                while size > fill - at:
                    size >>= 1
                sequence, room = [], size
                while room:
                    doc_id, start, ids, total = todo.pop()
                    if len(ids) > room:
                        todo.append((doc_id, start + room, ids[room:], total))
                        ids = ids[:room]
                    sequence.append((doc_id, start, ids, total))
                    room -= len(ids)
                self.closed.append(sequence)
                at += size
        self.open, self.n_open = {}, 0
        self.levels[:] = 0


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, cache_chunks: int = CACHE_CHUNKS, step_bytes: int = STEP_BYTES
) -> DataFrame:
    """Pieces of all documents in sequences of at most `window` ids: doc_id, start (ids of the document
    before the piece), length, doc_tokens, sequence_id, offset (in the sequence), ids (little-endian uint32).

    Each document's ids, and `end_id` behind them, lie in exactly one piece each. NULL and empty texts have
    the end alone; a NULL doc_id stays NULL; equal rows are packed as often as they come; an empty table gives
    no row. Other columns are left out. Sequence ids are unique, not dense. `cache_chunks` and `step_bytes` (of text
    encoded at once) trade a worker's memory for time and change no row.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, packer = encoder(tokenizer, cache_chunks), Packer(window)
        number = TaskContext.get().partitionId() * TASK_SEQUENCES
        for batch in text_steps(batches, step_bytes):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), to_ids.encode(texts_of(batch)), strict=True):
                packer.add(doc_id, np.append(ids, np.uint32(end_id)))
            first, number = number, number + len(packer.closed)
            yield from _batches(packer.closed, first)
        packer.finish()
        to_ids.trim()
        yield from _batches(packer.closed, number)
        release_memory()

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of_task, SCHEMA)


def _batches(sequences: list[list[Piece]], number: int) -> Iterator[pa.RecordBatch]:
    """Rows of the sequences, numbered from `number` on, a bounded number of sequences at a time; what is out is let go."""
    while sequences:
        some = sequences[:OUT_SEQUENCES]
        del sequences[:OUT_SEQUENCES]
        yield _rows(some, number)
        number += len(some)


def _rows(sequences: list[list[Piece]], number: int) -> pa.RecordBatch:
    columns: dict[str, list] = {f.name: [] for f in SCHEMA}
    for sequence_id, sequence in enumerate(sequences, number):
        offset = 0
        for doc_id, start, ids, total in sequence:
            row = (doc_id, start, len(ids), total, sequence_id, offset, ids.astype("<u4").tobytes())
            for column, value in zip(columns.values(), row, strict=True):
                column.append(value)
            offset += len(ids)
    kinds = {k: pa.binary() if k == "ids" else pa.int64() for k in columns}
    return pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in columns.items()})
