"""Byte-level BPE with vectorised pre-tokenisation.

A text's codepoints are mapped to classes by one table.  Where tokens of the
pattern begin is decided by an automaton over these classes whose transition
functions compose associatively: the texts are cut into blocks, each block's
function (every start state to its end state) is found for all blocks at once,
the functions are scanned to give every block its start state, and a second pass
marks the beginnings.  The slices feed a cache of merged pairs; token offsets are
kept, so that ids decode to the exact bytes.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from wattloom.llm.common import quoted, text_or_empty

#: Characters scanned at once, and the length of a block of the scan.
CHARS = 1 << 20
BLOCK = 256
#: Cached pieces in each of two generations; the older one is dropped when the younger is full.
CACHE = 400_000

# Codepoint classes.
LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
# Symbols of the automaton: the classes above with what follows them.
_APOS1, _APOS2, _SPACE_LAST, _WHITE_LAST, _CUT = 3, 4, 5, 6, 8
_WHITE_MORE = 7
_SYMBOLS = 9
# States: nothing open, in letters, numbers, others, white space, after one blank, and one or
# two letters of a contraction still to come.
_NONE, _IN_L, _IN_N, _IN_O, _IN_W, _BLANK, _ONE, _TWO = range(8)

# The white space of Unicode beyond what its categories tell.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a token begins here" by ``symbol * 8 + state``."""
    goes = np.zeros((_SYMBOLS, 8), np.uint8)
    begins = np.ones((_SYMBOLS, 8), np.uint8)
    for symbol, state in ((LETTER, _IN_L), (NUMBER, _IN_N), (OTHER, _IN_O)):
        goes[symbol, :] = state
        begins[symbol, [state, _BLANK]] = 0
    goes[LETTER, _ONE], goes[LETTER, _TWO] = _NONE, _ONE
    begins[LETTER, [_ONE, _TWO]] = 0
    for symbol, state in ((_APOS1, _ONE), (_APOS2, _TWO)):
        goes[symbol, :] = state
        goes[symbol, [_IN_O, _BLANK]] = _IN_O
        begins[symbol, [_IN_O, _BLANK]] = 0
    goes[_SPACE_LAST, :] = _BLANK
    goes[_WHITE_LAST, :] = _NONE
    goes[_WHITE_MORE, :] = _IN_W
    begins[_WHITE_MORE, _IN_W] = 0
    goes[_CUT, :] = _NONE
    return goes.ravel(), begins.ravel().astype(bool)


GOES, BEGINS = _automaton()
_tables: dict[str, np.ndarray] = {}


def codepoint_classes() -> np.ndarray:
    """The class of every codepoint (made once in a process)."""
    if "class" not in _tables:
        first = {"L": LETTER, "N": NUMBER}
        table = np.fromiter(
            (first.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000
        )
        table[_WHITE] = WHITE
        table[32] = SPACE
        _tables["class"] = table
    return _tables["class"]


def _symbols(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Automaton symbols; ``cuts`` are the positions of the breaks between texts."""
    kind = codepoint_classes()[points]
    symbol = kind.copy()
    blank = kind >= SPACE
    blank[cuts] = True  # the end of a text: white space before it is not followed by anything
    last = np.empty_like(blank)
    last[-1], last[:-1] = False, ~blank[1:]
    white = kind >= SPACE
    symbol[white] = _WHITE_MORE
    symbol[(kind == SPACE) & last] = _SPACE_LAST
    symbol[(kind == WHITE) & last] = _WHITE_LAST
    at = np.flatnonzero(points == 39)
    if len(at):
        padded = np.concatenate([points, [0, 0]])
        padded[cuts] = 0
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        symbol[at[short]] = _APOS1
        symbol[at[long]] = _APOS2
    symbol[cuts] = _CUT
    return symbol


def _token_begins(symbol: np.ndarray) -> np.ndarray:
    """Marks the first character of every token, by a blocked scan of transition functions."""
    n = len(symbol)
    blocks = -(-n // BLOCK)
    offs = np.full(blocks * BLOCK, _CUT * 8, np.uint8)
    np.multiply(symbol, 8, out=offs[:n])
    columns = np.ascontiguousarray(offs.reshape(blocks, BLOCK).T)
    # the function of each block: composed column by column, for every start state
    function = np.repeat(np.arange(8, dtype=np.uint8)[:, None], blocks, axis=1)
    for column in columns:
        function = GOES[function + column]
    # exclusive scan over the blocks
    state, starts, rows = _NONE, np.empty(blocks, np.uint8), function.T.tolist()
    for k, row in enumerate(rows):
        starts[k] = state
        state = row[state]
    begins = np.empty((BLOCK, blocks), bool)
    state = starts
    for j, column in enumerate(columns):
        at = state + column
        begins[j] = BEGINS[at]
        state = GOES[at]
    return begins.T.ravel()[:n]


def pieces(texts: list[str]) -> Iterator[tuple[int, int, list[str], np.ndarray]]:
    """Pre-tokens of texts ``a:b``: the slices, and how many belong to each text."""
    a, n = 0, len(texts)
    while a < n:
        b, size = a, 0
        while b < n and (b == a or size + len(texts[b]) < CHARS):
            size += len(texts[b]) + 1
            b += 1
        group = texts[a:b]
        joined = "\n".join(group) + "\n"
        lengths = np.fromiter(map(len, group), np.int64, len(group))
        cuts = np.cumsum(lengths + 1) - 1
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.flatnonzero(_token_begins(_symbols(points, cuts)))
        ends = begins[1:]  # the last token is the break after the last text
        real = ~np.isin(begins[:-1], cuts, assume_unique=True)
        starts, ends = begins[:-1][real], ends[real]
        counts = np.diff(np.searchsorted(starts, np.concatenate([[0], cuts])))
        yield a, b, [joined[i:j] for i, j in zip(starts.tolist(), ends.tolist())], counts
        a = b


class PieceCache:
    """Encoded pieces, in two generations of bounded size."""

    def __init__(self, encode, size: int = CACHE):
        self.encode, self.size = encode, size
        self.clear()

    def clear(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def look_up(self, items: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit numbers."""
        got = list(map(self.young.get, items))
        if None in got:
            gaps = [k for k, x in enumerate(got) if x is None]
            missing = dict.fromkeys([items[k] for k in gaps])
            if len(self.young) > self.size:
                self.old, self.young = self.young, {}
            fresh = {x: self.old[x] for x in missing if x in self.old}
            new = [x for x in missing if x not in fresh]
            fresh.update(zip(new, self.encode(new)))
            self.young.update(fresh)
            for k in gaps:
                got[k] = fresh[items[k]]
        return got


def little_endian(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes, and its rank, on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the adjacent pair of lowest rank is merged until none is known."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) > 200:
        return _merge_long(piece, ranks)
    none = 1 << 60
    pairs = [ranks.get(x + y, none) for x, y in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[x] for x in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long piece, with a heap over linked parts."""
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that begins here; 0: begins no more
    before = list(range(-1, n - 1))
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, j = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != j:
            continue
        end[i], end[mid] = j, 0
        if j < n:
            before[j] = i
            if (r := ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))
        if (h := before[i]) >= 0 and (r := ranks.get(piece[h:j])) is not None:
            heapq.heappush(heap, (r, h, j))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes and decodes texts by a rank file."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.cache = PieceCache(self._encode)

    def _encode(self, items: list[str]) -> list[bytes]:
        ranks = self.ranks
        return [little_endian(merge(x.encode("utf-8", "surrogatepass"), ranks)) for x in items]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        for _, _, items, counts in pieces(texts):
            got, at = self.cache.look_up(items), 0
            for n in counts.tolist():
                yield b"".join(got[at : at + n])
                at += n

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: bytes) -> np.ndarray:
        """Where each token ends in the decoded bytes."""
        sizes = map(len, map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return np.cumsum(np.fromiter(sizes, np.int64))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a rank file; it lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, token_ends``: ids and the byte offset at which each token ends.

    A null text is empty; an empty text has no ids.  ``path`` must be readable on
    every executor (an installed package's file).  Rows stay rows, whatever their ids.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = list(own.encode(batch["text"].to_pylist()))
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "ids": pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    "token_ends": pa.array([own.offsets(x) for x in ids], pa.list_(pa.int64())),
                }
            )

    return _rows(docs, id_col, text_col).mapInArrow(
        apply, "doc_id long, ids array<int>, token_ends array<long>"
    )


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode, decode the ids, digest both."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            sizes, ids_sha, decoded_sha = [], [], []
            for ids in own.encode(batch["text"].to_pylist()):
                sizes.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_sha256": pa.array(ids_sha, pa.string()),
                    "decoded_sha256": pa.array(decoded_sha, pa.string()),
                }
            )

    return _rows(docs, id_col, text_col).mapInArrow(
        apply, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id: Column = quoted(id_col).cast("long").alias("doc_id")
    return docs.select(doc_id, text_or_empty(text_col).alias("text"))
