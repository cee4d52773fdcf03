"""Packing token sequences: bounded-space online packing.

Every partition tokenises its documents and keeps a fixed number of open windows.
A piece goes into the open window it fits best.  When it fits none, the fullest
window is topped up with the head of the piece and emitted, and the rest of the
piece is placed again.  What is still open at the end of a partition is written,
dealt to a few merging tasks (one for every ``MERGE`` partitions) and packed again
there; the last windows of a merging task are cut at powers of two.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.bpe import little_endian, pieces
from wattloom.llm.common import quoted, text_or_empty, written
from wattloom.llm.filetok import FileTokenizer

#: Open windows in a task.
OPEN = 64
#: Partitions whose open windows one merging task gets.
MERGE = 16
SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
    "offset long, ids_crc32 long, ids binary, open boolean"
)


class Windows:
    """Open windows of one task; ``closed`` collects ``(sequence, pieces)``.

    A piece is ``(doc_id, start, doc_tokens, ids)``.
    """

    def __init__(self, size: int, first_id: int, keep: int = OPEN):
        self.size, self.keep, self.next_id = size, keep, first_id
        self.free: list[tuple[int, int]] = []  # room left and window, sorted
        self.held: dict[int, list] = {}
        self.closed: list[tuple[int, list]] = []

    def _close(self, content: list) -> None:
        self.closed.append((self.next_id, content))
        self.next_id += 1

    def add(self, doc_id, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        while len(ids) >= self.size:
            self._close([(doc_id, start, doc_tokens, ids[: self.size])])
            start, ids = start + self.size, ids[self.size :]
        while len(ids):
            k = bisect_left(self.free, (len(ids), -1))
            if k < len(self.free):  # best fit
                room, w = self.free.pop(k)
                part = ids
            elif len(self.free) < self.keep:
                w = self.next_id
                self.next_id += 1
                self.held[w] = []
                room, part = self.size, ids
            else:  # fits none: the fullest is topped up and goes
                room, w = self.free.pop(0)
                part = ids[:room]
            self.held[w].append((doc_id, start, doc_tokens, part))
            start, ids, room = start + len(part), ids[len(part) :], room - len(part)
            if room:
                insort(self.free, (room, w))
            else:
                self.closed.append((w, self.held.pop(w)))

    def rest(self) -> Iterator[tuple[int, list]]:
        """What is open, as it is."""
        yield from sorted(self.held.items())

    def finish(self) -> None:
        """Fill the open windows from one another; the last one is cut at powers of two."""
        left = [p for _, content in self.rest() for p in content]
        total = sum(len(p[3]) for p in left)
        self.held, self.free = {}, []
        sizes = [self.size] * (total // self.size)
        sizes += [1 << b for b in reversed(range(self.size.bit_length())) if (total % self.size) >> b & 1]
        at = iter(left)
        piece = next(at, None)
        for size in sizes:
            content, room = [], size
            while room:
                doc_id, start, n, ids = piece
                content.append((doc_id, start, n, ids[:room]))
                if len(ids) > room:
                    piece = (doc_id, start + room, n, ids[room:])
                else:
                    piece = next(at, None)
                room -= len(content[-1][3])
            self._close(content)


def _batch(sequences: list[tuple[int, list]], is_open: bool, with_ids: bool) -> pa.RecordBatch:
    rows = []
    for sequence, content in sequences:
        at = 0
        for doc_id, start, n, ids in content:
            raw = ids.astype("<u4").tobytes()
            rows.append((doc_id, start, len(ids), n, sequence, at, zlib.crc32(raw), raw if is_open or with_ids else None, is_open))
            at += len(ids)
    columns = list(zip(*rows)) or [()] * 9
    kinds = [pa.int64()] * 7 + [pa.binary(), pa.bool_()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_tokenizers: dict[str, FileTokenizer] = {}


def forget(path: str) -> None:
    """Empty the cache of pieces: the worker lives on and runs tasks of other steps."""
    if path in _tokenizers:
        _tokenizers[path].cache.clear()


def tokenise(texts: list[str], path: str, end_id: int) -> Iterator[np.ndarray]:
    """Each text's ids, as the tokenizer gives them, with ``end_id`` after them.

    A special token's string in a text gives the special token's id.
    """
    if path not in _tokenizers:
        _tokenizers[path] = FileTokenizer(path)
    own, end = _tokenizers[path], little_endian([end_id])
    # texts with special tokens are cut differently: they are encoded as a whole
    whole = {k for k, t in enumerate(texts) if own.special and own.special.search(t)}
    plain = ["" if k in whole else t for k, t in enumerate(texts)] if whole else texts
    for a, _, items, counts in pieces(plain):
        got, at = own.cache.look_up(items), 0
        for k, n in enumerate(counts.tolist(), a):
            if k in whole:
                yield np.array([*own.model.encode(texts[k], add_special_tokens=False).ids, end_id], "<u4")
            else:
                yield np.frombuffer(b"".join([*got[at : at + n], end]), "<u4")
            at += n


def pack(
    docs: DataFrame, path: str, size: int = 2048, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` (a power of two) tokens.

    One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset,
    ids_crc32, ids`` (``ids`` little-endian unsigned 32-bit, null for
    ``with_ids=False``).  Null texts are empty; an empty text is its end id alone.
    Null and repeated ids are carried as they are: every row is a document of its
    own.  An empty table gives no piece.  ``path`` is a tokenizer file readable on
    every executor whose pre-tokenisation is the pattern of ``bpe.pieces``.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(size, TaskContext.get().partitionId() << 32)
        try:
            for batch in batches:
                ids = tokenise(batch["text"].to_pylist(), path, end_id)
                for doc_id, own in zip(batch["doc_id"].to_pylist(), ids):
                    windows.add(doc_id, 0, len(own), own)
                yield _batch(windows.closed, False, with_ids)
                windows.closed = []
            yield _batch(list(windows.rest()), True, with_ids)
        finally:
            forget(path)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(size, (1 << 62) + (TaskContext.get().partitionId() << 32))
        for batch in batches:
            for row in batch.to_pylist():
                windows.add(row["doc_id"], row["start"], row["doc_tokens"], np.frombuffer(row["ids"], "<u4"))
            yield _batch(windows.closed, False, with_ids)
            windows.closed = []
        windows.finish()
        yield _batch(windows.closed, False, with_ids)

    # written once: tokenising is not repeated, and a lost executor cannot change ids already given
    packed = written(rows.mapInArrow(first, SCHEMA), "packed")
    part = F.shiftright("sequence_id", 32)
    most = packed.filter("open").agg(F.max(part)).first()[0]
    tasks = max(1, -(-((most or 0) + 1) // MERGE))
    merged = (
        packed.filter("open")
        .repartition(tasks, F.floor(part / MERGE))
        .sortWithinPartitions("sequence_id", "offset")
        .mapInArrow(second, SCHEMA)
    )
    return packed.filter(~F.col("open")).unionByName(merged).drop("open")
