"""Alignment of two tokenizers by divide and conquer at shared cuts.

Both tokenizers cut the same bytes.  An interval of a text is divided at an offset
near its middle where a token of each ends: the offset is looked for by bisecting
each list of ends for the other's next end.  Both halves are divided in the same
way, and an interval without such an offset is a group of its own.  All intervals of
a batch of texts are divided at once, level by level.

Tokens that end together are linked.  One of two linked tokens is a suffix of the
other, so the pairs that can be linked at all are known from the vocabularies: that
bounds the table of link counts, whatever the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.bpe import pieces
from wattloom.llm.common import quoted, text_or_empty, written
from wattloom.llm.filetok import FileTokenizer, byte_level_tokens

#: Characters of text aligned at once (a longer text is aligned alone).
CHUNK = 1 << 18


# --- shared cuts -----------------------------------------------------------------


def _search_up(a, b, i, a_end, b_end):
    """The first common end from ``a[i]`` on: each list is bisected for the other's next end."""
    ai, bj = np.full(len(i), -1), np.full(len(i), -1)
    at = np.arange(len(i))
    while len(at):
        j = np.searchsorted(b, a[i])
        inside = j < b_end
        at, i, j, a_end, b_end = at[inside], i[inside], j[inside], a_end[inside], b_end[inside]
        nxt = np.searchsorted(a, b[j])
        inside = nxt < a_end
        at, i, j, a_end, b_end = at[inside], nxt[inside], j[inside], a_end[inside], b_end[inside]
        hit = a[i] == b[j]
        ai[at[hit]], bj[at[hit]] = i[hit], j[hit]
        at, i, a_end, b_end = at[~hit], i[~hit], a_end[~hit], b_end[~hit]
    return ai, bj


def _search_down(a, b, i, a_start, b_start):
    """The last common end up to ``a[i]``."""
    ai, bj = np.full(len(i), -1), np.full(len(i), -1)
    at = np.flatnonzero(i >= a_start)
    i, a_start, b_start = i[at], a_start[at], b_start[at]
    while len(at):
        j = np.searchsorted(b, a[i], "right") - 1
        inside = j >= b_start
        at, j, a_start, b_start = at[inside], j[inside], a_start[inside], b_start[inside]
        i = np.searchsorted(a, b[j], "right") - 1
        inside = i >= a_start
        at, i, j, a_start, b_start = at[inside], i[inside], j[inside], a_start[inside], b_start[inside]
        hit = a[i] == b[j]
        ai[at[hit]], bj[at[hit]] = i[hit], j[hit]
        at, i, a_start, b_start = at[~hit], i[~hit], a_start[~hit], b_start[~hit]
    return ai, bj


def shared_cuts(a: np.ndarray, b: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of common values of two increasing lists, inside ``spans``.

    A span is a row ``a_start, a_end, b_start, b_end`` of index ranges (end not
    included); spans are in order and apart.  Each is divided at a common end near its
    middle, then its halves are.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    spans = spans[(spans[:, 0] < spans[:, 1]) & (spans[:, 2] < spans[:, 3])]
    while len(spans):
        a0, a1, b0, b1 = spans.T
        middle = (a0 + a1) // 2
        i, j = _search_up(a, b, middle, a1, b1)
        miss = np.flatnonzero(i < 0)
        if len(miss):
            i[miss], j[miss] = _search_down(a, b, middle[miss] - 1, a0[miss], b0[miss])
        cut = i >= 0  # the others are groups of their own
        i, j, a0, a1, b0, b1 = i[cut], j[cut], a0[cut], a1[cut], b0[cut], b1[cut]
        found.append((i, j))
        halves = np.stack([np.stack([a0, i, b0, j], axis=1), np.stack([i + 1, a1, j + 1, b1], axis=1)], axis=1)
        spans = halves.reshape(-1, 4)
        spans = spans[(spans[:, 0] < spans[:, 1]) & (spans[:, 2] < spans[:, 3])]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.sort(np.concatenate(x)) for x in zip(*found))


# --- vocabularies ------------------------------------------------------------------


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a sentence-piece model; none for its control ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            out.append(b"")
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted codes ``id_a * len(b) + id_b`` of the pairs of which one is a suffix of the other."""

    def by_bytes(tokens):
        out: dict[bytes, list[int]] = {}
        for i, token in enumerate(tokens):
            if token:
                out.setdefault(token, []).append(i)
        return out

    in_a, in_b, codes = by_bytes(a), by_bytes(b), set()
    for token, ids in in_a.items():
        for k in range(len(token)):
            codes.update(i * len(b) + j for j in in_b.get(token[k:], ()) for i in ids)
    for token, ids in in_b.items():
        for k in range(1, len(token)):
            codes.update(i * len(b) + j for i in in_a.get(token[k:], ()) for j in ids)
    return np.array(sorted(codes), np.int64)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..n-1 with room for a mark after them, and which bytes count."""
    width = len(str(max(n - 1, 0)))
    text = np.char.zfill(np.arange(n).astype(str), width).astype(f"S{width}")
    table = np.zeros((n, width + 1), np.uint8)
    table[:, :width] = text.view(np.uint8).reshape(n, width)
    used = np.ones((n, width + 1), bool)
    used[:, :width] = np.arange(width) >= width - np.char.str_len(np.arange(n).astype(str))[:, None]
    return table, used


@dataclass
class Pair:
    """Two tokenizers, loaded once a worker."""

    a_model: FileTokenizer
    b_model: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]

    def __post_init__(self):
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.digits, self.used = _digits(max(len(self.a_bytes), len(self.b_bytes)))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text: space and text by the first, the text by the second."""
        a, empty = [], np.zeros(0, np.int64)
        for _, _, items, counts in pieces([" " + t for t in texts]):
            got, at = self.a_model.cache.look_up(items), 0
            for n in counts.tolist():
                a.append(np.frombuffer(b"".join(got[at : at + n]), "<u4").astype(np.int64))
                at += n
        b = [np.array(x, np.int64) if x else empty for x in self.b_model.encode(texts, num_threads=1)]
        return a, b


_pairs: dict[tuple[str, str], Pair] = {}


def tokenizers(a_path: str, b_path: str) -> Pair:
    """The process's pair of tokenizers."""
    if (a_path, b_path) not in _pairs:
        import sentencepiece

        _pairs[a_path, b_path] = Pair(
            FileTokenizer(a_path, specials=False), sentencepiece.SentencePieceProcessor(model_file=b_path),
            byte_level_tokens(a_path), piece_tokens(b_path),
        )
    return _pairs[a_path, b_path]


@dataclass
class Aligned:
    """A chunk of texts: token ids of all texts in a row, bounds by text, and the cuts."""

    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray
    cut_at: np.ndarray


def align_texts(texts: list[str], own: Pair) -> Aligned:
    """Tokens and shared cuts of each text; texts that cannot be aligned have no tokens."""
    all_a, all_b = own.encode(texts)
    a, b, sizes = [], [], []
    for text, x, y in zip(texts, all_a, all_b):
        whole = (" " + text).encode("utf-8", "surrogatepass")
        same = bool(text) and b"".join(map(own.a_bytes.__getitem__, x.tolist())) == whole
        same = same and b"".join(map(own.b_bytes.__getitem__, y.tolist())) == whole
        a.append(x if same else x[:0])
        b.append(y if same else y[:0])
        sizes.append(len(whole) if same else 0)
    a_at = np.cumsum([0, *map(len, a)])
    b_at = np.cumsum([0, *map(len, b)])
    ids_a = np.concatenate([np.zeros(0, np.int64), *a])
    ids_b = np.concatenate([np.zeros(0, np.int64), *b])
    # offsets run on over the texts, so both lists of ends increase
    a_ends, b_ends = np.cumsum(own.a_size[ids_a]), np.cumsum(own.b_size[ids_b])
    held = np.flatnonzero(np.array(sizes, np.int64))
    # the last tokens of a text always end together
    inner = np.stack([a_at[held], a_at[held + 1] - 1, b_at[held], b_at[held + 1] - 1], axis=1).reshape(-1, 4)
    a_cut, b_cut = shared_cuts(a_ends, b_ends, inner)
    a_cut = np.sort(np.concatenate([a_cut, inner[:, 1]]))
    b_cut = np.sort(np.concatenate([b_cut, inner[:, 3]]))
    return Aligned(ids_a, ids_b, a_at, b_at, a_cut, b_cut, np.searchsorted(a_cut, a_at))


def group_digests(got: Aligned, own: Pair) -> list[str]:
    """Per text the digest of its groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    n_a, n_b = len(got.a), len(got.b)
    a_group = np.searchsorted(got.a_cut, np.arange(n_a))
    b_group = np.searchsorted(got.b_cut, np.arange(n_b))
    a_before = np.concatenate([[0], got.a_cut + 1])  # tokens of the first in groups before
    b_before = np.concatenate([[0], got.b_cut + 1])
    order = np.zeros(n_a + n_b, np.int64)
    mark = np.full(n_a + n_b, ord(","), np.uint8)
    a_place = np.arange(n_a) + b_before[a_group]
    b_place = np.arange(n_b) + a_before[b_group + 1]
    order[a_place], order[b_place] = got.a, got.b
    mark[a_place[got.a_cut]] = ord("|")
    mark[b_place[got.b_cut]] = ord(";")
    rows, used = own.digits[order], own.used[order]
    rows[:, -1] = mark
    ends = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
    flat, bounds = rows[used].tobytes(), ends[got.a_at + got.b_at].tolist()
    return [
        hashlib.sha256(flat[lo : hi - 1]).hexdigest() if hi > lo else ""
        for lo, hi in zip(bounds, bounds[1:])
    ]


def _groups(got: Aligned) -> list[list[dict]]:
    """Per text its groups as lists of ids."""
    out = []
    for k in range(len(got.a_at) - 1):
        i, j, own = got.a_at[k], got.b_at[k], []
        for c in range(got.cut_at[k], got.cut_at[k + 1]):
            own.append({"a": got.a[i : got.a_cut[c] + 1].tolist(), "b": got.b[j : got.b_cut[c] + 1].tolist()})
            i, j = got.a_cut[c] + 1, got.b_cut[c] + 1
        out.append(own)
    return out


# --- tables ------------------------------------------------------------------------


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, room = 0, CHUNK
    for hi, text in enumerate(texts):
        if hi > lo and len(text) > room:
            yield lo, hi
            lo, room = hi, CHUNK
        room -= len(text)
    if texts:
        yield lo, len(texts)


BASE = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False
) -> DataFrame:
    """Each text's tokens by two tokenizers, grouped at the offsets where both have ends.

    ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links``, and with
    ``with_groups`` the groups as an array of ``{a, b}`` arrays of ids.  ``links``
    are little-endian 32-bit places in ``linkable`` of the two vocabularies, one for
    each pair of tokens that end together.  Texts that are null or empty, or that a
    tokenizer does not give back byte by byte, have no tokens.  Rows stay rows,
    whatever their ids; other columns are left out.  The paths must be readable on
    every executor (installed packages' files).
    """
    schema = BASE + (", groups array<struct<a: array<int>, b: array<int>>>" if with_groups else "")
    codes = docs.sparkSession.sparkContext.broadcast(linkable(byte_level_tokens(a_path), piece_tokens(b_path)))
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(a_path, b_path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for lo, hi in _chunks(texts):
                got = align_texts(texts[lo:hi], own)
                pair = got.a[got.a_cut] * len(own.b_bytes) + got.b[got.b_cut]
                place = np.searchsorted(codes.value, pair).astype("<u4")
                links = np.diff(got.cut_at)
                bounds = got.cut_at.tolist()
                columns = {
                    "doc_id": batch["doc_id"].slice(lo, hi - lo),
                    "n_a": pa.array(np.diff(got.a_at)),
                    "n_b": pa.array(np.diff(got.b_at)),
                    "n_groups": pa.array(links),
                    "n_links": pa.array(links),
                    "groups_sha256": pa.array(group_digests(got, own), pa.string()),
                    "links": pa.array([place[x:y].tobytes() for x, y in zip(bounds, bounds[1:])], pa.binary()),
                }
                if with_groups:
                    columns["groups"] = pa.array(_groups(got), kind)
                yield pa.record_batch(columns)

    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(apply, schema)


def link_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pair, id_a, id_b, n, best``: how many links of all texts hold each pair of ids.

    ``best`` says that no other pair of the same ``id_b`` has more.  At most as many rows as
    ``linkable`` has pairs; every task sums its own links first.
    """
    codes, width = linkable(byte_level_tokens(a_path), piece_tokens(b_path)), len(piece_tokens(b_path))
    shared = aligned.sparkSession.sparkContext.broadcast(codes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            column = batch["links"]
            data = np.frombuffer(b"".join(column.drop_null().to_pylist()), "<u4")
            total += np.bincount(data, minlength=len(total))
        place = np.flatnonzero(total)
        yield pa.record_batch({"pair": pa.array(place.astype(np.int32)), "n": pa.array(total[place])})

    counted = aligned.select("links").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = shared.value[batch["pair"].to_numpy()]
            yield pa.record_batch(
                {
                    "pair": batch["pair"], "id_a": pa.array((code // width).astype(np.int32)),
                    "id_b": pa.array((code % width).astype(np.int32)), "n": batch["n"],
                }
            )

    named = written(counted.mapInArrow(ids, "pair int, id_a int, id_b int, n long"), "link-counts")
    most = named.groupBy("id_b").agg(F.max("n").alias("most"))
    return named.join(most, "id_b").select("pair", "id_a", "id_b", "n", (F.col("n") == F.col("most")).alias("best"))


def link_quality(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``align`` with ``n_best`` (links whose count is the highest of their second id) and
    ``count_sum`` (over links) in place of the links.

    The alignment is written once; counts need all of it before any text can be judged.
    The counts that go to every worker are bounded by the vocabularies (``linkable``).
    """
    aligned = written(align(docs, a_path, b_path, id_col, text_col), "aligned")
    counts = link_counts(aligned, a_path, b_path).select("pair", "n", "best").toArrow()
    size = len(linkable(byte_level_tokens(a_path), piece_tokens(b_path)))
    n, best = np.zeros(size, np.int64), np.zeros(size, bool)
    at = counts["pair"].to_numpy()
    n[at], best[at] = counts["n"].to_numpy(), counts["best"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((n, best))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = shared.value
        for batch in batches:
            links = [np.frombuffer(x, "<u4") for x in batch["links"].to_pylist()]
            columns = {name: batch[name] for name in batch.schema.names if name != "links"}
            columns["n_best"] = pa.array([int(best[x].sum()) for x in links], pa.int64())
            columns["count_sum"] = pa.array([int(n[x].sum()) for x in links], pa.int64())
            yield pa.record_batch(columns)

    kept = [f for f in aligned.schema.fields if f.name != "links"]
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return aligned.mapInArrow(judge, schema)
