"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes need to be told apart only through ``length`` bytes: two that agree so far
are a repeat.  They are sorted by most-significant-digit passes, and after every
pass only groups of several suffixes go on:

1. First digit: the *anchor*, the smallest hash of a gram in a suffix's window.
   Equal windows have equal anchors at equal places, and neighbouring suffixes
   share one, so one row stands for a run of suffixes (some 1 % of the bytes).
2. Second digit: the whole text from the first to the last window of a run.  Where
   all runs of an anchor agree, all their windows are repeats and the sort is done.
3. Further digits, eight bytes each, for the runs of an anchor that differ, one row
   for each distinct run.  Anchors with very many distinct runs (a line that a
   third of all documents share) are sorted in groupings by digests instead, which
   no single key can overload: of blocks of neighbouring windows first, then of the
   windows of those blocks that agree in part only.

Groups that remain are exactly the repeated windows; the bytes they cover go.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm import scan
from wattloom.llm.common import free_name, quoted, text_key, text_or_empty, written

#: Bytes of the gram that anchors a window.
GRAM = 24
#: Distinct runs up to which the suffixes of one anchor are sorted in one task.
SMALL = 2048
_LOW = np.uint64(0xFFFFFFFF)

RUNS = "k1 long, k2 long, first int, lead int, span int, anchor long, run long, n long"


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive keys, by doubling."""
    reach, low = 1, keys
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of window starts that share an anchor, in a buffer of documents.

    Returns ``doc, first, lead, span, anchor, run``: the document, the first start,
    the anchor's distance from it, the number of starts, and the hashes of the
    anchor and of the run's whole text.
    """
    gram = min(GRAM, length)
    starts = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= length:
            starts.append(np.arange(a, b - length + 1))
    if not starts:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    starts = np.concatenate(starts)
    sums = scan.running_sum(data)
    at = np.arange(len(data) - gram + 1)
    hashes = scan.slice_hash(sums, at, at + gram)
    low = _window_minima((hashes & ~_LOW) | at.astype(np.uint64), length - gram + 1)
    place = (low[starts] & _LOW).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    begun = np.flatnonzero(new)
    span = np.diff(np.append(begun, len(starts)))
    first, anchor_at = starts[begun], place[begun]
    lead = anchor_at - first
    run = scan.slice_hash(sums, first, first + span - 1 + length)
    run = scan.mix(run + lead.astype(np.uint64) * np.uint64(1 << 32) + span.astype(np.uint64))
    doc = np.searchsorted(offsets, first, "right") - 1
    return doc, first - offsets[doc], lead, span, hashes[anchor_at], run


def _slices(data: np.ndarray, offsets: np.ndarray, length: int):
    """Buffers of whole documents, or overlapping slices of one that is very long."""
    for a, b in scan.runs(offsets):
        lo, hi = int(offsets[a]), int(offsets[b])
        if b - a > 1 or hi - lo <= 2 * scan.SLICE:
            yield a, 0, data[lo:hi], offsets[a : b + 1] - lo
            continue
        for s in range(lo, hi - length + 1, scan.SLICE):
            e = min(s + scan.SLICE + length - 1, hi)
            yield a, s - lo, data[s:e], np.array([0, e - s])


def _run_rows(length: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch["k1"].to_numpy(), batch["k2"].to_numpy()], axis=1)
            # copies within a batch are one text with a count
            keys, rows, counts = np.unique(keys, axis=0, return_index=True, return_counts=True)
            data, offsets = scan.buffers(batch["text"].take(pa.array(rows)))
            for a, shift, part, at in _slices(data, offsets, length):
                doc, first, lead, span, anchor, run = anchored_runs(part, at, length)
                doc = doc + a
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[doc, 0]), pa.array(keys[doc, 1]), pa.array((first + shift).astype(np.int32)),
                        pa.array(lead.astype(np.int32)), pa.array(span.astype(np.int32)),
                        pa.array(anchor.view(np.int64)), pa.array(run.view(np.int64)), pa.array(counts[doc]),
                    ],
                    names=[x.split()[0] for x in RUNS.split(", ")],
                )

    return apply


def _run_texts(length: int):
    """The bytes of the runs asked for in each document."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, asked = batch["text"], batch["asked"]
            for i in range(len(batch)):
                raw, rows = texts[i].as_py().encode("utf-8", "surrogatepass"), asked[i].as_py()
                parts = [raw[r["first"] : r["first"] + r["span"] - 1 + length] for r in rows]
                columns = {k: pa.array([r[k] for r in rows]) for k in ("anchor", "run", "lead", "first", "n", "many")}
                keys = {k: pa.array([batch[k][i].as_py()] * len(rows)) for k in ("k1", "k2")}
                yield pa.record_batch(
                    {k: v.cast(pa.int32()) if k in ("lead", "first") else v for k, v in columns.items()}
                    | keys
                    | {"part": pa.array(parts, pa.binary())}
                )

    return apply


def repeated_windows(parts: list[bytes], group: np.ndarray, lead: np.ndarray, n: np.ndarray, length: int):
    """Radix sort of the windows of runs; returns ``row, start`` of the repeated ones.

    ``group`` numbers the anchor of each run.  Windows of one anchor at one distance
    from it are sorted by digits of eight bytes; a window is repeated when another
    equals it or its own run occurs several times.
    """
    joined = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    digits = np.zeros(len(joined) - 7, np.uint64)
    for j in range(8):
        digits = (digits << np.uint64(8)) | joined[j : len(joined) - 7 + j]
    span = sizes - length + 1
    row = np.repeat(np.arange(len(parts)), span)
    start = np.arange(len(row)) - np.repeat(np.cumsum(span) - span, span)
    base = (np.cumsum(sizes) - sizes)[row] + start
    bucket = group[row] * (1 << 20) + (lead[row] - start)
    alone = n[row] > 1
    alive = np.arange(len(row))
    for depth in range(0, length, 8):
        take = min(8, length - depth)
        digit = digits[base[alive] + depth] >> np.uint64(8 * (8 - take))
        order = np.lexsort((digit, bucket))
        alive, b, d = alive[order], bucket[order], digit[order]
        new = np.ones(len(alive), bool)
        new[1:] = (b[1:] != b[:-1]) | (d[1:] != d[:-1])
        number = np.cumsum(new) - 1
        several = np.bincount(number, minlength=1)[number] > 1 if len(number) else new
        alive, bucket = alive[several], number[several]
        if not len(alive):
            break
    alone[alive] = True
    hit = np.flatnonzero(alone)
    return row[hit], start[hit]


def _ranges(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive starts of one row as ``row, low, high``."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    begun = np.flatnonzero(new)
    ended = np.append(begun[1:], len(row))[: len(begun)] - 1
    return row[begun], start[begun], start[ended]


def _sorted_small(length: int):
    """Sorts the suffixes of whole anchors; the input is ordered by anchor."""

    def solve(tables: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(tables).combine_chunks()
        anchor = t["anchor"].to_numpy()
        _, group = np.unique(anchor, return_inverse=True)
        row, start = repeated_windows(
            t["part"].to_pylist(), group, t["lead"].to_numpy().astype(np.int64), t["n"].to_numpy(), length
        )
        row, low, high = _ranges(row, start)
        # runs that occur several times are repeats as a whole and only witness here
        one = t["n"].to_numpy()[row] == 1
        row, low, high = row[one], low[one], high[one]
        first = t["first"].to_numpy()[row]
        return pa.record_batch(
            {
                "k1": t["k1"].take(pa.array(row)).combine_chunks(), "k2": t["k2"].take(pa.array(row)).combine_chunks(),
                "low": pa.array((first + low).astype(np.int32)), "high": pa.array((first + high).astype(np.int32)),
            }
        )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                own = part["anchor"].to_numpy()
                others = np.flatnonzero(own != own[-1])
                cut = int(others[-1]) + 1 if len(others) else 0
                whole = pa.Table.from_batches([part])
                if cut:  # what is before the last anchor is complete
                    held.append(whole.slice(0, cut))
                    yield solve(held)
                    held = [whole.slice(cut)]
                elif held and held[-1]["anchor"][-1].as_py() != own[0]:
                    yield solve(held)
                    held = [whole]
                else:
                    held.append(whole)
        if held:
            yield solve(held)

    return apply


def _widths(length: int) -> list[int]:
    """Windows in a block of each pass over very frequent anchors: the root of all, then one."""
    return list(dict.fromkeys([math.isqrt(length - min(GRAM, length)) + 1, 1]))


def _window_blocks(length: int, width: int):
    """One row for each block of a run's windows: those at ``width`` neighbouring distances from the anchor.

    Windows of one block share a core.  ``c1, c2`` are the digest of the core and the
    block's place, ``w1, w2`` of what the run has of the block, whose bytes are ``part``.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 512):
                batch = whole.slice(lo, 512)
                parts = batch["part"].to_pylist()
                joined = b"".join(parts)
                data = np.frombuffer(joined, np.uint8)
                sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                lead = batch["lead"].to_numpy().astype(np.int64)
                low = (lead - sizes + length) // width  # the last window is the nearest to the anchor
                many = lead // width - low + 1
                row = np.repeat(np.arange(len(parts)), many)
                block = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                base = (np.cumsum(sizes) - sizes)[row]
                far = np.minimum(lead[row], (block + 1) * width - 1)
                near = np.maximum((lead - sizes + length)[row], block * width)
                begin = lead[row] - far
                end = begin + far - near + length
                core = base + lead[row] - block * width
                # two independent sums over other byte values
                sums = [scan.running_sum(data), scan.running_sum(data ^ np.uint8(0x5A))]
                place = block.astype(np.uint64)
                own = (far * (1 << 32) + far - near).astype(np.uint64)
                cores = [scan.mix(scan.slice_hash(x, core, core + length - width + 1) + place) for x in sums]
                texts = [scan.mix(scan.slice_hash(x, base + begin, base + end) + own) for x in sums]
                cuts = zip((base + begin).tolist(), (base + end).tolist())
                yield pa.record_batch(
                    {
                        **{k: batch[k].take(pa.array(row)) for k in ("k1", "k2", "n")},
                        "first": pa.array((begin + batch["first"].to_numpy()[row]).astype(np.int32)),
                        "lead": pa.array(far.astype(np.int32)),
                        "part": pa.array([joined[i:j] for i, j in cuts], pa.binary()),
                        **{k: pa.array(x.view(np.int64)) for k, x in zip(("c1", "c2", "w1", "w2"), cores + texts)},
                    }
                )

    return apply


def _removed(length: int):
    """Applies the repeated windows of each text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, spans, digest = [], [], [], []
            # the digest is of the bytes that stay; as text, a character cut in two is dropped
            for i in range(len(batch)):
                raw = batch["text"][i].as_py().encode("utf-8", "surrogatepass")
                flat = batch["windows"][i].values
                low, high = flat.field("low").to_numpy(), flat.field("high").to_numpy()
                change = np.zeros(len(raw) + 1, np.int64)
                np.add.at(change, low, 1)
                np.add.at(change, high + length, -1)
                gone = np.cumsum(change)[:-1] > 0
                rest = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                kept.append(rest.decode("utf-8", "ignore"))
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                digest.append(hashlib.sha256(rest).hexdigest())
            yield pa.record_batch(
                {
                    "k1": batch["k1"], "k2": batch["k2"], "kept": pa.array(kept, pa.string()),
                    "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                    "kept_sha256": pa.array(digest, pa.string()),
                }
            )

    return apply


def _repeated(rows: DataFrame, group: list[str], kind: list[str], tag: str) -> DataFrame:
    """Rows of groups that occur again: ``differ`` tells whether a group has several kinds,
    ``total`` how often the row's own kind occurs."""
    counted = written(rows.groupBy(*group, *kind).agg(F.sum("n").alias("total")), f"{tag}-counted")
    again = counted.groupBy(*group).agg(F.sum("total").alias("all"), F.count(F.lit(1)).alias("kinds"))
    again = again.filter("all > 1").select(*group, (F.col("kinds") > 1).alias("differ"))
    # written: a join of two plain shuffles can be split where a group is hot
    marked = written(counted.join(written(again, f"{tag}-again"), group), f"{tag}-marked")
    return rows.join(marked, [*group, *kind])


def _sorted_large(found: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the runs of very frequent anchors as ``k1, k2, low, high``.

    A run's windows are first taken in blocks.  Blocks whose core occurs once hold no
    repeat, those that agree as a whole are repeats as a whole; only the others are
    cut into single windows, so that a row stands for many windows in nearly all cases.
    """
    rows, hits = found, []
    for width in _widths(length):
        blocks = written(
            rows.mapInArrow(
                _window_blocks(length, width),
                "k1 long, k2 long, n long, first int, lead int, part binary, c1 long, c2 long, w1 long, w2 long",
            ),
            "blocks",
        )
        alive = written(_repeated(blocks, ["c1", "c2"], ["w1", "w2"], "blocks"), "blocks-alive")
        # runs that occur several times only witness here, as in the small anchors
        hits.append(
            alive.filter("n = 1 AND (NOT differ OR total > 1)").select(
                "k1", "k2", F.col("first").alias("low"),
                (F.col("first") + F.octet_length("part") - length).cast("int").alias("high"),
            )
        )
        one = F.first(F.struct("k1", "k2", "first", "lead", "part")).alias("one")
        rows = (
            alive.filter("differ").groupBy("c1", "c2", "w1", "w2").agg(one, F.sum("n").alias("n")).select("one.*", "n")
        )
    return reduce(DataFrame.unionByName, hits)


def repeats(texts: DataFrame, length: int) -> DataFrame:
    """Distinct texts with repeated strings: ``k1, k2, kept, n_removed, n_spans, kept_sha256``.

    ``texts`` has ``text`` (not null) and its ``text_key`` as ``k1, k2``.
    """
    runs = written(texts.select("k1", "k2", "text").mapInArrow(_run_rows(length), RUNS), "runs")
    # second digit: anchors that occur again, and whether their runs differ
    alive = written(_repeated(runs, ["anchor"], ["run"], "runs"), "runs-alive")
    distinct = written(
        alive.filter("differ").groupBy("anchor", "run").agg(
            *[F.first(c).alias(c) for c in ("k1", "k2", "first", "lead", "span")], F.sum("n").alias("n")
        ),
        "runs-distinct",
    )
    sizes = distinct.groupBy("anchor").agg((F.count(F.lit(1)) > SMALL).alias("many"))
    ask = F.struct("anchor", "run", "first", "lead", "span", "n", "many")
    asked = distinct.join(sizes, "anchor").groupBy("k1", "k2").agg(F.collect_list(ask).alias("asked"))
    one = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    found = written(
        one.join(asked, ["k1", "k2"]).select("k1", "k2", "text", "asked").mapInArrow(
            _run_texts(length),
            "anchor long, run long, lead int, first int, n long, many boolean, k1 long, k2 long, part binary",
        ),
        "run-texts",
    )
    small = (
        found.filter("NOT many").repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_sorted_small(length), "k1 long, k2 long, low int, high int")
    )
    large = _sorted_large(found.filter("many"), length)
    # a run that occurs several times is a repeat as a whole, also where its anchor has others
    whole = alive.filter("NOT differ OR total > 1").select(
        "k1", "k2", F.col("first").alias("low"), (F.col("first") + F.col("span") - 1).alias("high")
    )
    # distinct before collecting: copies of a text give the same windows
    marks = whole.unionByName(small).unionByName(large).distinct().groupBy("k1", "k2").agg(
        F.collect_list(F.struct("low", "high")).alias("windows")
    )
    return one.join(marks, ["k1", "k2"]).mapInArrow(
        _removed(length), "k1 long, k2 long, kept string, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, length: int = 200, text_col: str = "text") -> DataFrame:
    """``docs`` without each byte that a repeated ``length``-byte string covers.

    A string is repeated when it starts anywhere else in any text, the same one
    included; overlaps count, matches never cross texts, and all strings are judged
    on the input.  Copies of a text count as repeats of it.  The text column holds
    what is left (fragments of a character cut in two are dropped); a null text is
    empty and stays null.  Other columns, whatever their names, and repeated rows are kept.
    """
    text = text_or_empty(text_col)
    cut = repeats(docs.select(text.alias("text"), text_key(text).alias("k")).select("text", "k.*"), length)
    a, b, rest = (free_name(docs.columns, wish) for wish in ("k1", "k2", "rest"))
    cut = cut.select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("kept").alias(rest))
    key = text_key(text)
    joined = docs.join(cut, (key["k1"] == F.col(a)) & (key["k2"] == F.col(b)), "left")
    left = F.coalesce(F.col(rest), quoted(text_col).cast("string")).alias(text_col)
    return joined.select(*[left if c == text_col else quoted(c) for c in docs.columns])


def summary(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per row of ``docs``."""
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("doc_id", "text", text_key(F.col("text")).alias("k")).select("doc_id", "text", "k.*")
    cut = repeats(rows.select("text", "k1", "k2"), length)
    cut = cut.select("k1", "k2", "n_removed", "n_spans", "kept_sha256")
    thin = rows.select(
        "doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("whole"),
    )
    return thin.join(cut, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
