"""Near-duplicate detection by SetSketch registers.

1. Every document's set of word shingles is sketched: register ``i`` keeps the
   truncated logarithm of the smallest of exponentially distributed hash values,
   so sketches of parts merge by the maximum and equal registers tell similarity.
2. Equal sets become one node (a third of all rows may be copies of one text).
3. Bands of register values put nodes into buckets.  Of every bucket each member is
   compared with the smallest one only: the sketches' joint likelihood drops hopeless
   pairs, the best remaining pair of each node is verified on the full sets.
4. Buckets that then still hold several components are compared block by block,
   members of different components only: what the likelihood leaves is verified on
   the full sets in the same task by matrix products, and only links that join
   components leave it, never the pairs of a group.
5. Components of the verified links, by alternating stars on DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm import scan
from wattloom.llm.common import Scratch, free_name, quoted, text_key, text_or_empty, written

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: Base of the registers' logarithm, rate of the exponential values, largest register.
BASE, RATE, TOP = 1.02, 20.0, 32_000
#: A pair is hopeless when the likelihood of the threshold is below exp(-SLACK) of the best.
SLACK = 12.0
#: Chance below which a number of equal registers is ruled out at the threshold.
NEVER = 1e-10
#: Members of a block in the comparison of mixed buckets.
BLOCK = 128
#: Shingles compared at once in a matrix product.
COLUMNS = 4_096

_rng = np.random.default_rng(20)
_MULT = _rng.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, REGISTERS, np.uint64)
_SHIFTS = _rng.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document, sorted, and how many each has.

    With fewer than ``width`` words the whole sequence is the one shingle.
    """
    ends = np.cumsum(counts)
    many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    start = np.repeat(ends - counts, many) + _ranks(many)
    size = np.repeat(np.minimum(counts, width), many)
    value = np.zeros(len(start), np.uint64)
    for j in range(width):
        inside = j < size
        at = np.minimum(start + j, max(len(hashes) - 1, 0))
        value = value * _SHIFTS[j % 16] + np.where(inside, hashes[at] if len(hashes) else 0, np.uint64(0))
    value = scan.mix(value ^ (size.astype(np.uint64) << np.uint64(56)))
    bounds = np.concatenate([[0], np.cumsum(many)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        value[a:b].sort()
    first = np.ones(len(value), bool)
    first[1:] = value[1:] != value[:-1]
    first[bounds[:-1][many > 0]] = True
    sizes = np.add.reduceat(first, bounds[:-1][many > 0]) if len(value) else np.zeros(0, int)
    out = np.zeros(len(counts), np.int64)
    out[many > 0] = sizes
    return value[first], out


def _ranks(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive groups of these sizes."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def registers(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Registers of sets given one after the other; an empty set has all zero."""
    out = np.zeros((len(sizes), REGISTERS), np.int16)
    full = sizes > 0
    if full.any():
        begun = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for i in range(REGISTERS):
            least = np.minimum.reduceat(values * _MULT[i] + _PLUS[i], begun)
            share = (least.astype(np.float64) + 1.0) / 2.0**64
            exponential = -np.log1p(-np.minimum(share, 1 - 2.0**-53)) / RATE
            out[full, i] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP)
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """One hash for each band of registers, different for each band."""
    value = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sketch), BANDS)).copy()
    part = sketch.astype(np.uint64).reshape(len(sketch), BANDS, ROWS)
    for j in range(ROWS):
        value = scan.mix(value * np.uint64(0x9E3779B97F4A7C15) + part[:, :, j])
    return value


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def hopeful(more: np.ndarray, less: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Joint estimate of pairs of sketches: which may reach the threshold, and the best similarity.

    ``more`` and ``less`` count registers in which the first is larger or smaller,
    ``a`` and ``b`` are the exact set sizes.  The likelihood of similarity ``j`` is
    that of these counts; sizes alone bound ``j`` by their ratio.
    """
    u, v = a / (a + b), b / (a + b)
    most = np.minimum(a, b) / np.maximum(a, b)
    limit = percent / 100
    same = REGISTERS - more - less

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = (np.clip(_chance(np.maximum(x, 0)), 1e-12, 1) for x in (u - v * j, v - u * j))
        r = np.clip(1 - p - q, 1e-12, 1)
        return more * np.log(p) + less * np.log(q) + same * np.log(r)

    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    # a coarse grid can only understate the best, so it never drops more
    for step in np.linspace(0, 1, 13):
        j = step * most
        value = likelihood(j)
        better = value > best
        best[better], at[better] = value[better], j[better]
    floor = likelihood(np.minimum(limit, most))
    fits = most >= limit - 1e-12
    return fits & ((at >= limit) | (best - floor <= SLACK)), at


def least_same(percent: int) -> int:
    """Equal registers that a pair at the threshold has but for a chance of ``NEVER``.

    By the Chernoff bound for independent registers.
    """
    p = percent / 100
    for same in range(REGISTERS + 1):
        x = min(max(same / REGISTERS, 1e-9), 1 - 1e-9)
        if x >= p:
            return same
        far = x * np.log(x / p) + (1 - x) * np.log((1 - x) / (1 - p)) if p < 1 else np.inf
        if np.exp(-REGISTERS * far) >= NEVER:
            return same
    return REGISTERS


def _sketch_rows(width: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = scan.buffers(batch["text"])
            for a, b, hashes, counts, _ in scan.words(data, offsets):
                values, sizes = shingles(hashes, counts, width)
                sketch = registers(values, sizes)
                full = sizes > 0
                f = np.zeros((2, b - a), np.uint64)
                if len(values):
                    begun = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    f[0, full] = np.add.reduceat(values, begun)
                    f[1, full] = np.add.reduceat(scan.mix(values + np.uint64(99)), begun)
                part = batch.slice(a, b - a)
                yield pa.record_batch(
                    {
                        **{c: part[c] for c in ("doc_id", "k1", "k2")},
                        "n": pa.array(sizes),
                        "f1": pa.array(f[0].view(np.int64)),
                        "f2": pa.array(f[1].view(np.int64)),
                        "sketch": pa.array([x.tobytes() for x in sketch], pa.binary()),
                    }
                )

    return apply


def _registers_of(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.int16).reshape(-1, REGISTERS)


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each band of each sketch: shorter to compute again than to keep."""
    for batch in batches:
        value = bands(_registers_of(batch["sketch"])) if len(batch) else np.zeros((0, BANDS), np.uint64)
        node = batch["node"].take(pa.array(np.repeat(np.arange(len(batch)), BANDS)))
        yield pa.record_batch({"node": node, "band": pa.array(value.view(np.int64).ravel())})


def _estimated(percent: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _registers_of(batch["sketch_a"]), _registers_of(batch["sketch_b"])
            more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
            keep, at = hopeful(more, less, batch["n_a"].to_numpy(), batch["n_b"].to_numpy(), percent)
            keep = np.flatnonzero(keep)
            yield pa.record_batch(
                {"a": batch["a"].take(keep), "b": batch["b"].take(keep), "est": pa.array(at[keep])}
            )

    return apply


def shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of two lists of sorted sets, by products of 0/1 matrices."""
    out = np.zeros((len(x), len(y)), np.float32)
    common = np.intersect1d(np.concatenate(x), np.concatenate(y))
    sides = []
    for part in (x, y):
        row = np.repeat(np.arange(len(part)), [len(v) for v in part])
        value = np.concatenate(part)
        at = np.minimum(np.searchsorted(common, value), max(len(common) - 1, 0))
        hit = common[at] == value if len(common) else np.zeros(len(value), bool)
        sides.append((row[hit], at[hit], len(part)))
    for lo in range(0, len(common), COLUMNS):
        width = min(COLUMNS, len(common) - lo)
        dense = []
        for row, at, n in sides:
            own = (at >= lo) & (at < lo + width)
            m = np.zeros((n, width), np.float32)
            m[row[own], at[own] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def _spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of links that suffice to join what all of them join."""
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while root.get(i, i) != i:
            root[i] = root.get(root[i], root[i])
            i = root[i]
        return i

    keep = []
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
            keep.append(k)
    return np.array(keep, np.int64)


def _blocks_compared(percent: int):
    """Links between components of a bucket, found between two of its blocks."""
    least = least_same(percent)

    def unpack(members: pa.StructArray):
        items = members.field("items")
        bounds = items.offsets.to_numpy()
        values = items.values.to_numpy().view(np.uint64)
        sets = [values[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]
        comp = members.field("comp").to_numpy()
        return _registers_of(members.field("sketch")), sets, comp, members.field("node").to_numpy()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            for k in range(len(batch)):
                (rx, sx, cx, ix), (ry, sy, cy, iy) = (unpack(batch[c].slice(k, 1).flatten()) for c in "xy")
                nx, ny = (np.array([len(v) for v in side]) for side in (sx, sy))
                fits = 100 * np.minimum.outer(nx, ny) >= percent * np.maximum.outer(nx, ny)
                fits &= cx[:, None] != cy[None, :]
                if batch["same"][k].as_py():
                    fits &= ix[:, None] < iy[None, :]
                i, j = np.nonzero(fits)
                same = (rx[i] == ry[j]).sum(axis=1)
                i, j = i[same >= least], j[same >= least]
                more, less = (rx[i] > ry[j]).sum(axis=1), (rx[i] < ry[j]).sum(axis=1)
                keep, _ = hopeful(more, less, nx[i], ny[j], percent)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                (p, at_p), (q, at_q) = (np.unique(v, return_inverse=True) for v in (i, j))
                shared = shared_counts([sx[v] for v in p], [sy[v] for v in q])[at_p, at_q]
                linked = 100 * shared >= percent * (nx[i] + ny[j] - shared)
                a, b = cx[i[linked]], cy[j[linked]]
                found.append(np.stack([a, b])[:, _spanning(a, b)])
            a, b = np.concatenate(found, axis=1)
            yield pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

    return apply


def _shingle_rows(width: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = scan.buffers(batch["text"])
            for a, b, hashes, counts, _ in scan.words(data, offsets):
                values, sizes = shingles(hashes, counts, width)
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.record_batch(
                    {
                        "node": batch["node"].slice(a, b - a),
                        "items": pa.ListArray.from_arrays(bounds, pa.array(values.view(np.int64))),
                    }
                )

    return apply


def components(links: DataFrame, written=written) -> DataFrame:
    """``node, comp`` of every linked node: the smallest node reachable over ``links(a, b)``.

    Alternating stars; each round is a written table, nothing reaches the driver
    but whether another round is needed.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        edges = written(small, "links")
        # done when every node has one link and that leads to a node without one
        several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        onward = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").select("u")
        if several.unionByName(onward).isEmpty():
            break
    ends = edges.groupBy("v").agg(F.lit(0).alias("x")).select(F.col("v").alias("node"), F.col("v").alias("comp"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(ends)


def _full_sets(wanted: DataFrame, texts: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """``node, items``: all shingles of the wanted nodes."""
    keys = sets.join(wanted, "node").select("node", "k1", "k2")
    # one row for each wanted text: copies are merged before the shuffle
    one = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    chosen = one.join(keys, ["k1", "k2"]).select("node", "text")
    return chosen.mapInArrow(_shingle_rows(width), "node long, items array<long>")


def _verified(
    pairs: DataFrame, texts: DataFrame, sets: DataFrame, width: int, percent: int, written
) -> DataFrame:
    """Of ``pairs(a, b)`` those whose full sets reach the threshold."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    items = written(_full_sets(wanted, texts, sets, width), "shingles")
    a, b = (items.select(F.col("node").alias(s), F.col("items").alias(f"items_{s}")) for s in "ab")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    joined = pairs.join(a, "a").join(b, "b").withColumn("shared", shared)
    union = F.size("items_a") + F.size("items_b") - F.col("shared")
    return joined.filter(F.lit(100) * F.col("shared") >= F.lit(percent) * union).select("a", "b")


def find_groups(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Documents are linked when ``100 * |intersection| >= percent * |union|`` of their
    shingle sets; ``component_id`` is the smallest id reachable.  Null and blank
    texts have an empty set and are linked with nothing.  Null ids never become a
    component's id unless all its ids are null; rows with equal ids are all
    reported.  ``kept`` marks the row(s) whose id is the component's.
    """
    rows = _grouped(docs, width, percent, id_col, text_col)
    smallest = written(rows.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least")), "least")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return rows.join(smallest, "comp", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_one(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one text of each group.

    It is the one with the smallest id (null is larger than all; of equal ids the
    text with the smaller hash).  Rows without words all stay; rows that repeat both
    id and text of one that stays do, too.
    """
    rows = _grouped(docs, width, percent, id_col, text_col)
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "k1", "k2")
    firsts = rows.filter("comp IS NOT NULL").groupBy("comp").agg(F.min(order).alias("m")).select("m.doc_id", "m.k1", "m.k2")
    stay = firsts.unionByName(rows.filter("n = 0").select("doc_id", "k1", "k2").distinct())
    a, b, c = (free_name(docs.columns, wish) for wish in ("k1", "k2", "id"))
    stay = stay.select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("doc_id").alias(c))
    key = text_key(text_or_empty(text_col))
    same = (key["k1"] == F.col(a)) & (key["k2"] == F.col(b))
    return docs.join(stay, same & quoted(id_col).cast("long").eqNullSafe(F.col(c)), "left_semi")


def _grouped(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, k1, k2, n, comp`` of every row; ``comp`` is null for empty sets."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(
        quoted(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    ).select("doc_id", "text", text_key(F.col("text")).alias("k")).select("doc_id", "text", "k.*")
    sketched = scratch(
        texts.mapInArrow(
            _sketch_rows(width),
            "doc_id long, k1 long, k2 long, n long, f1 long, f2 long, sketch binary",
        ),
        "sketches",
    )
    key = ["f1", "f2", "n"]
    sets = scratch(
        sketched.filter("n > 0")
        .groupBy(*key)
        .agg(*[F.first(c).alias(c) for c in ("k1", "k2", "sketch")])
        .withColumn("node", F.monotonically_increasing_id()),
        "sets",
    )
    members = sets.select("node", "sketch").mapInArrow(_band_rows, "node long, band long")
    heads = members.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    # written first: a join of two plain shuffles can be split where a bucket is hot
    placed = scratch(members.join(scratch(heads.drop("size"), "heads"), "band"), "buckets")

    sketches = sets.select("node", "n", "sketch")
    with_head = placed.filter("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    for side in "ab":
        own = sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        with_head = with_head.join(own, side)
    estimated = with_head.mapInArrow(_estimated(percent), "a long, b long, est double")
    best = estimated.groupBy("b").agg(F.max(F.struct("est", (-F.col("a")).alias("a"))).alias("m"))
    links = scratch(
        _verified(scratch(best.select((-F.col("m.a")).alias("a"), "b"), "pairs"), texts, sets, width, percent, scratch), "verified"
    )
    first = scratch(components(links, scratch), "components")

    labelled = placed.join(first, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
    # bands that hold the same nodes find the same links: one of them is enough
    nodes = [F.sum(F.xxhash64(F.lit(seed), "node") % F.lit(1 << 30)).alias(f"h{seed}") for seed in (1, 2, 3, 4)]
    mixed = labelled.groupBy("band").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"), *nodes
    ).filter("lo < hi")
    mixed = mixed.groupBy("n", "lo", "hi", "h1", "h2", "h3", "h4").agg(F.min("band").alias("band"))
    sized = scratch(labelled.join(mixed.select("band"), "band"), "mixed")
    items = _full_sets(sized.select("node").distinct(), texts, sets, width)
    parts = sized.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("size"))
    # a large component of a bucket has blocks of its own, the small ones share blocks
    per_band = parts.groupBy("band").agg(F.sum(F.when(F.col("size") < BLOCK, F.col("size")).otherwise(0)).alias("rest"))
    own = F.col("size") >= BLOCK
    spread = F.ceil(F.when(own, F.col("size")).otherwise(F.greatest("rest", F.lit(1))) / BLOCK)
    dealt = (
        sized.join(parts, ["band", "comp"])
        .join(per_band, "band")
        .withColumn("owner", F.when(own, F.col("comp")).otherwise(F.lit(-1)))
        .withColumn("slot", F.pmod(F.xxhash64("node"), spread))
        .join(sketches.select("node", "sketch"), "node")
        .join(items, "node")
    )
    member = F.struct("node", "comp", "sketch", "items")
    blocks = scratch(dealt.groupBy("band", "owner", "slot").agg(F.collect_list(member).alias("m")), "blocks")
    block_id = F.struct("owner", "slot")
    x = blocks.select("band", block_id.alias("bx"), F.col("m").alias("x"))
    y = blocks.select("band", block_id.alias("by"), F.col("m").alias("y"))
    across = x.join(y, "band").filter(
        (F.col("bx") <= F.col("by")) & ((F.col("bx.owner") != F.col("by.owner")) | (F.col("bx.owner") == -1))
    )
    joined = across.select("x", "y", (F.col("bx") == F.col("by")).alias("same")).mapInArrow(
        _blocks_compared(percent), "a long, b long"
    )
    second = components(joined, scratch).select(F.col("node").alias("comp"), F.col("comp").alias("last"))

    nodes = sets.select(*key, "node").join(first, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    nodes = nodes.join(second, "comp", "left").select(*key, F.coalesce("last", "comp").alias("comp"))
    rows = sketched.select("doc_id", "k1", "k2", *key).join(nodes, key, "left")
    grouped = written(rows.select("doc_id", "k1", "k2", "n", "comp"), "grouped")
    scratch.remove()
    return grouped
