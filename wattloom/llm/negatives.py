"""Hard-negative mining with one shared candidate list for each cluster of anchors.

Anchors are clustered by direction.  For a cluster, candidates are sorted once by
an upper bound of their inner product with any unit member: the candidate's norm times
the cosine of its angle to the cluster's centre less the widest angle of a member.
Every member walks that one list and stops where its norm times the bound falls below
what it still needs, which certifies that nothing better follows.

Candidates lie in blocks by their nearest centre, and a list is walked block by block:
first the blocks of the anchor's own centre, which gives a threshold, then those blocks
of other centres whose bound reaches it.  Two rounds of walks find the positives, two
more the negatives between the bounds that the positives' scores set.  Results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import quoted, written

#: Anchors that the centres are learned from (about), and centres at most.  Both only set the speed.
SAMPLE, MAX_CENTRES = 20_000, 1_024
#: Vectors in a block of candidates, anchors that walk together, candidates scored at once.
CANDIDATES, MEMBERS, PAGE = 4_096, 256, 256
#: Angles are widened by this much, bounds raised by this share, so rounding cannot hide a candidate.
ANGLE_SLACK, BOUND_SLACK = 1e-6, 1e-9
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(sizes) or (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1 if len(flat) else 0)
    out = np.zeros((len(sizes), sizes.max()))
    out[np.arange(sizes.max()) < sizes[:, None]] = flat
    return out


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    if x.shape[1] >= width:
        return x
    return np.concatenate([x, np.zeros((len(x), width - x.shape[1]))], axis=1)


def _alike(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(x.shape[1], y.shape[1])
    return _wide(x, width), _wide(y, width)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero for zero) and norms."""
    top = np.abs(x).max(axis=1, initial=0)
    y = x / np.where(top > 0, top, 1)[:, None]
    size = np.sqrt((y * y).sum(axis=1))
    with np.errstate(over="ignore"):
        return y / np.where(size > 0, size, 1)[:, None], size * top


def angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of each unit vector to each centre; zero vectors lie at the centre."""
    u, c = _alike(units, centres)
    out = np.arccos(np.clip(u @ c.T, -1, 1))
    out[~units.any(axis=1)] = 0
    return out


def learn_centres(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """``k`` unit vectors: means of the directions nearest to them."""
    units = directions(x)[0]
    units = units[units.any(axis=1)]
    if not len(units):
        return np.eye(1, max(x.shape[1], 1))
    rng = np.random.default_rng(11)
    centres = units[rng.choice(len(units), min(k, len(units)), replace=False)]
    for _ in range(steps):
        home = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def bounds(norm: np.ndarray, angle: np.ndarray, spread: float) -> np.ndarray:
    """The most a candidate's inner product with a unit vector within ``spread`` of the centre can be."""
    out = norm * np.cos(np.maximum(angle - spread - ANGLE_SLACK, 0))
    out = out + np.abs(out) * BOUND_SLACK
    return np.where(np.isnan(out), np.inf, out)


def _products(u: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products of integer-valued rows, held to 64 bits."""
    if exact:  # every partial sum is an integer below 2**53
        return (u @ v.T).astype(np.int64)
    whole = [[int(a) for a in row] for row in u.tolist()], [[int(a) for a in row] for row in v.tolist()]
    out = [[min(max(sum(a * b for a, b in zip(p, q)), LEAST), MOST) for q in whole[1]] for p in whole[0]]
    return np.array(out, np.int64).reshape(len(u), len(v))


class Goal:
    """The best ``k`` of one range of scores."""

    def __init__(self, low: int, high: int, least: int, k: int):
        self.low, self.high, self.k = low, high, k
        self.need = max(low, least)
        self.best: list[tuple[int, int]] = []  # (-score, id)

    def add(self, scores: list[int], ids: list[int]) -> None:
        new = [(-s, i) for s, i in zip(scores, ids) if self.need <= s <= self.high]
        if new:
            self.best = sorted(self.best + new)[: self.k]
            if len(self.best) == self.k:
                self.need = max(self.need, -self.best[-1][0])


def walk(
    members: dict, candidates: dict, centre: np.ndarray, same: bool, k: int
) -> Iterator[tuple[int, int, int, int]]:
    """``member, goal, id, score`` of the best ``k`` in each goal of each member.

    ``members``: ids, labels, ``x`` and goals; ``candidates``: ids, labels and ``x``.
    """
    u, v = _alike(members["x"], candidates["x"])
    if not v.shape[1]:
        u, v = np.zeros((len(u), 1)), np.zeros((len(v), 1))
    (mu, mn), (cu, cn) = directions(u), directions(v)
    centre = centre[None, :]
    spread = angles(mu, centre).max(initial=0)
    bound = bounds(cn, angles(cu, centre)[:, 0], spread)
    order = np.argsort(-bound, kind="stable")  # the shared list
    v, bound = v[order], bound[order]
    ids, labels = candidates["ids"][order], candidates["labels"][order]
    exact = bool(np.isfinite(mn).all() and np.isfinite(cn).all() and mn.max(initial=0) * cn.max(initial=0) < 2.0**52)
    goals: list[list[Goal]] = members["goals"]
    need = np.array([min((g.need for g in own), default=MOST) for own in goals], np.int64)
    for lo in range(0, len(v), PAGE):
        if exact:
            reach = mn * bound[lo] + 1e-3
            active = np.flatnonzero([own and r >= n for own, r, n in zip(goals, reach, need)])
        else:
            active = np.array([i for i, own in enumerate(goals) if own], np.int64)
        if not len(active):
            break
        at = slice(lo, lo + PAGE)
        scores = _products(u[active], v[at], exact)
        agree = members["labels"][active][:, None] == labels[at][None, :]
        mask = (agree == same) & (members["ids"][active][:, None] != ids[at][None, :])
        mask &= scores >= need[active][:, None]
        for row in np.flatnonzero(mask.any(axis=1)):
            hits, i = np.flatnonzero(mask[row]), active[row]
            found, own = [int(s) for s in scores[row, hits]], ids[at][hits].tolist()
            for goal in goals[i]:
                goal.add(found, own)
            need[i] = min(g.need for g in goals[i])
    for i, own in enumerate(goals):
        for j, goal in enumerate(own):
            for score, vec_id in goal.best:
                yield i, j, vec_id, -score


VECTOR = "vec_id long, label string, q array<double>"
GOALS = "array<struct<low: long, high: long, least: long>>"
FOUND = "anchor_id long, tag long, goal int, vec_id long, score long"


def quantised(
    vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: float
) -> DataFrame:
    """``vec_id, label, q``: usable rows once each, components ``floor(scale * x)``."""
    v = F.col("v")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    raw = vectors.select(
        quoted(id_col).cast("long").alias("vec_id"), quoted(label_col).cast("string").alias("label"),
        quoted(vector_col).cast("array<double>").alias("v"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & ~bad)

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["v"]
            flat = column.flatten().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                whole = np.nan_to_num(np.floor(scale * flat)) + 0.0  # no negative zero
            starts = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))]).astype(np.int32)
            q = pa.ListArray.from_arrays(starts, pa.array(whole))
            yield pa.record_batch({"vec_id": batch["vec_id"], "label": batch["label"], "q": q})

    return raw.mapInArrow(floor, VECTOR).distinct()


def mine(
    vectors: DataFrame, asked: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: float = 256.0,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``asked`` (a condition on ``vec_id``) holds.  Scores
    are inner products of the components ``floor(scale * x)``, exact; ties go to the
    smaller id.  A positive is one of the ``positives`` best rows of another id and the
    anchor's label; its negatives are the ``negatives`` best of another label with
    ``low * positive <= 100 * score <= high * positive``.  Positives without a negative
    give no row.  Rows with a null id, label or vector, or a null or non-finite component
    take no part; equal rows count once; an id with different rows has each of them
    take part; a shorter vector ends in zeros.  A score beyond 64 bits counts as the
    nearest 64-bit number.
    """
    spark = vectors.sparkSession
    unique = quantised(vectors, id_col, label_col, vector_col, scale)
    # of equal vectors and labels only the smallest ids can be among the best
    most = max(positives, negatives) + 1
    same = Window.partitionBy("label", F.xxhash64("q"), F.xxhash64(F.lit(5), "q")).orderBy("vec_id")
    candidates = unique.withColumn("r", F.row_number().over(same)).filter(F.col("r") <= most).drop("r")
    anchors = written(unique.filter(asked).withColumn("tag", F.xxhash64("label", "q")), "anchors")

    total = anchors.count()
    share = F.lit(int(min(1.0, SAMPLE / max(total, 1)) * (1 << 30)))
    sample = anchors.filter(F.pmod(F.xxhash64("vec_id", "tag"), F.lit(1 << 30)) < share).select("vec_id", "tag", "q").toArrow()
    at = np.lexsort((sample["tag"].to_numpy(), sample["vec_id"].to_numpy()))
    k = min(MAX_CENTRES, max(2, int(np.ceil(total**0.5))))
    shared = spark.sparkContext.broadcast(learn_centres(_matrix(sample["q"])[at], k))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, norm = directions(_matrix(batch["q"]))
            apart = angles(units, shared.value)
            home = apart.argmin(axis=1) if len(apart) else np.zeros(0, int)
            columns = {name: batch[name] for name in batch.schema.names}
            columns["centre"] = pa.array(home.astype(np.int32))
            columns["norm"] = pa.array(norm)
            columns["angle"] = pa.array(apart[np.arange(len(home)), home])
            yield pa.record_batch(columns)

    placed = written(candidates.mapInArrow(place, VECTOR + ", centre int, norm double, angle double"), "placed")
    slots = F.ceil(F.count(F.lit(1)) / CANDIDATES).cast("int")
    # one row a centre
    cells = placed.groupBy("centre").agg(slots.alias("slots"), F.max("norm").alias("norm"), F.max("angle").alias("angle"))
    cells = written(cells, "cells")
    summary = sorted((r["centre"], r["slots"], r["norm"], r["angle"]) for r in cells.collect())
    cell = np.array([s[0] for s in summary], np.int64)
    cell_norm, cell_angle = (np.array([s[j] for s in summary], float) for j in (2, 3))
    slot = F.pmod(F.xxhash64("vec_id", "label", "q"), F.col("slots")).cast("int").alias("slot")
    own = F.collect_list(F.struct("vec_id", "label", "q")).alias("candidates")
    sized = F.broadcast(cells.select("centre", "slots"))
    # blocks of a bounded size, whatever a centre holds
    blocks = written(placed.join(sized, "centre").select("centre", slot, "vec_id", "label", "q").groupBy("centre", "slot").agg(own), "blocks")

    member = VECTOR + f", tag long, goals {GOALS}"

    def route(first: bool):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                units, norm = directions(_matrix(batch["q"]))
                apart = angles(units, shared.value)
                home = apart.argmin(axis=1) if len(apart) else np.zeros(0, int)
                if first:
                    use = home[:, None] == cell[None, :]
                else:
                    need = np.array(
                        [min((max(g["low"], g["least"]) for g in own), default=MOST) for own in batch["goals"].to_pylist()], float
                    )
                    near = np.maximum(apart[:, cell] - cell_angle - 2 * ANGLE_SLACK, 0)
                    top = norm[:, None] * cell_norm * np.maximum(np.cos(near), 0) * (1 + 4 * BOUND_SLACK)
                    top = np.where(np.isnan(top), np.inf, top)
                    # needs beyond 2**53 are rounded: leave room for it
                    use = (top + 1e-3 + np.abs(top) * 1e-12 >= need[:, None] - np.abs(need[:, None]) * 1e-12)
                    use &= home[:, None] != cell[None, :]
                i, j = np.nonzero(use)
                columns = {name: batch[name].take(pa.array(i)) for name in batch.schema.names}
                columns["home"] = pa.array(home[i].astype(np.int32))
                columns["centre"] = pa.array(cell[j].astype(np.int32))
                yield pa.record_batch(columns)

        return apply

    def walker(same: bool, k: int):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(len(batch)):
                    m, c = batch["members"][r].values, batch["candidates"][r].values
                    goals = [[Goal(g["low"], g["high"], g["least"], k) for g in own] for own in m.field("goals").to_pylist()]
                    ids, tags = m.field("vec_id").to_numpy(), m.field("tag").to_numpy()
                    members = {"ids": ids, "labels": np.array(m.field("label").to_pylist()), "x": _matrix(m.field("q")), "goals": goals}
                    block = {
                        "ids": c.field("vec_id").to_numpy(), "labels": np.array(c.field("label").to_pylist()), "x": _matrix(c.field("q")),
                    }
                    width = max(members["x"].shape[1], block["x"].shape[1], 1)
                    centre = _wide(shared.value, width)[batch["home"][r].as_py()]
                    found = list(walk(members, block, centre, same, k))
                    i, goal, vec_id, score = zip(*found) if found else ((), (), (), ())
                    i = np.array(i, np.int64)
                    yield pa.record_batch(
                        {
                            "anchor_id": pa.array(ids[i]), "tag": pa.array(tags[i]), "goal": pa.array(goal, pa.int32()),
                            "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.int64()),
                        }
                    )

        return apply

    def walked(rows: DataFrame, first: bool, same: bool, k: int) -> DataFrame:
        """One round: members meet the blocks that their bound cannot rule out."""
        routed = rows.mapInArrow(route(first), member + ", home int, centre int").join(sized, "centre")
        routed = routed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        asks = F.pmod(F.xxhash64("vec_id", "tag", F.lit("ask")), F.lit(max(1, -(-total // MEMBERS)))).alias("ask")
        group = routed.groupBy("centre", "slot", "home", asks).agg(
            F.collect_list(F.struct("vec_id", "label", "q", "tag", "goals")).alias("members")
        )
        met = group.join(blocks, ["centre", "slot"]).select("home", "members", "candidates")
        return met.mapInArrow(walker(same, k), FOUND)

    def best(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor_id", "tag", "goal").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)

    def both_rounds(rows: DataFrame, same: bool, k: int, tag: str) -> DataFrame:
        """The own centre's blocks, then what reaches the thresholds found there."""
        near = written(walked(rows, True, same, k), f"{tag}-near")
        full = best(near, k).groupBy("anchor_id", "tag", "goal").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        got = full.filter(F.col("n") == k).groupBy("anchor_id", "tag").agg(
            F.map_from_entries(F.collect_list(F.struct("goal", "least"))).alias("reached")
        )
        key = [rows["vec_id"] == got["anchor_id"], rows["tag"] == got["tag"]]
        raised = F.transform(
            "goals",
            lambda g, j: F.struct(
                g["low"].alias("low"), g["high"].alias("high"),
                F.coalesce(F.try_element_at("reached", j), F.lit(LEAST)).alias("least"),
            ),
        )
        again = rows.join(got, key, "left").select(rows["vec_id"], "label", "q", rows["tag"], raised.alias("goals"))
        far = written(walked(again, False, same, k), f"{tag}-far")
        return best(near.unionByName(far), k)

    any_score = F.array(F.struct(F.lit(LEAST).alias("low"), F.lit(MOST).alias("high"), F.lit(LEAST).alias("least")))
    first = anchors.select("vec_id", "label", "q", "tag", any_score.alias("goals"))
    liked = written(both_rounds(first, True, positives, "positives"), "positives")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            goals = [
                [
                    {"low": max(-((-low * s) // 100), LEAST), "high": min(high * s // 100, MOST), "least": LEAST}
                    for s in scores
                ]
                for scores in batch["scores"].to_pylist()
            ]
            columns = {name: batch[name] for name in ("vec_id", "label", "q", "tag")}
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("least", pa.int64())]))
            columns["goals"] = pa.array(goals, kind)
            yield pa.record_batch(columns)

    scores = liked.groupBy("anchor_id", "tag").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s"))
    scores = scores.select(F.col("anchor_id").alias("vec_id"), "tag", F.col("s.score").alias("scores"))
    second = written(anchors.join(scores, ["vec_id", "tag"]).select("vec_id", "label", "q", "tag", "scores").mapInArrow(ranges, member), "ranges")
    hard = both_rounds(second, False, negatives, "negatives")
    pairs = liked.select(
        "anchor_id", "tag", (F.col("rank") - 1).alias("goal"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    hard = hard.select("anchor_id", "tag", "goal", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    done = pairs.join(hard, ["anchor_id", "tag", "goal"])
    return done.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

