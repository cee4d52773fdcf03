"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is cut into balanced parts, and
a small neural classifier learns to tell a vector's part from the parts of its
neighbours.  Every vector is indexed in its most probable part; a query is routed to
its most probable parts, as many as reach the wanted recall on the sample, and ranked
there by exact distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import quoted, written

#: Indexed vectors for each part, and parts at most.
PER_PART, MAX_PARTS = 4_000, 1_024
#: Vectors in the sample (about; never more than 5 % above): so many for each part, at least
#: and, by the two limits above, at most 65,536.
PER_SAMPLED, SAMPLE = 64, 12_000
#: Neighbours in the graph, recall on the sample that sets the number of probes.
NEIGHBOURS, RECALL = 10, 0.98
HIDDEN = 64
#: Rows of a block of candidates and of queries.
CANDIDATES, QUERIES = 2_048, 256


def neighbour_graph(x: np.ndarray, k: int, rows: np.ndarray | None = None) -> np.ndarray:
    """Indexes of the ``k`` nearest others of each row (brute force in blocks)."""
    rows = np.arange(len(x)) if rows is None else rows
    norms, out = (x * x).sum(axis=1), np.zeros((len(rows), min(k, max(len(x) - 1, 0))), np.int64)
    for lo in range(0, len(rows), 512):
        part = rows[lo : lo + 512]
        far = norms - 2 * x[part] @ x.T
        far[np.arange(len(part)), part] = np.inf
        out[lo : lo + 512] = np.argpartition(far, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(graph: np.ndarray, levels: int, rng: np.random.Generator) -> np.ndarray:
    """``2**levels`` parts of equal size that cut few edges: repeated halving.

    A random vector smoothed over the graph tells the two sides apart; its median
    halves, then nodes with the most neighbours on the other side change places in
    pairs.
    """
    part = np.zeros(len(graph), np.int64)
    for _ in range(levels):
        new = part * 2
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            inside = part[graph[own]] == p
            place = np.full(len(graph), -1)
            place[own] = np.arange(len(own))
            near = np.where(inside, place[graph[own]], np.arange(len(own))[:, None])
            value = rng.normal(size=len(own))
            for _ in range(40):
                value = 0.5 * value + 0.5 * value[near].mean(axis=1)
                value -= value.mean()
                value /= np.abs(value).max() + 1e-12
            side = np.zeros(len(own), np.int64)
            side[np.argsort(value, kind="stable")[len(own) // 2 :]] = 1
            for _ in range(10):
                gain = (side[near] != side[:, None]).sum(axis=1) - (side[near] == side[:, None]).sum(axis=1)
                a, b = (np.flatnonzero(side == s) for s in (0, 1))
                a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
                n = min(len(a), len(b), max(1, len(own) // 20))
                n = int((gain[a[:n]] + gain[b[:n]] > 0).sum())
                if not n:
                    break
                side[a[:n]], side[b[:n]] = 1, 0
            new[own] += side
        part = new
    return part


@dataclass
class Router:
    """A classifier with one hidden layer: the probability of every part."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        return np.maximum(z @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def fit_router(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, epochs: int = 30) -> Router:
    """Cross-entropy against the shares of parts among each vector's neighbours (Adam)."""
    d, parts = x.shape[1], target.shape[1]
    scale = x.std(axis=0)
    router = Router(
        x.mean(axis=0), np.where(scale > 1e-12, scale, 1.0),
        rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, (2 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts),
    )
    z = (x - router.centre) / router.scale
    p = [router.w1, router.b1, router.w2, router.b2]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for lo in range(0, len(z), 256):
            at = order[lo : lo + 256]
            h = np.maximum(z[at] @ p[0] + p[1], 0)
            out = h @ p[2] + p[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            g = (out / out.sum(axis=1, keepdims=True) - target[at]) / len(at)
            gh = (g @ p[2].T) * (h > 0)
            step += 1
            for i, grad in enumerate((z[at].T @ gh, gh.sum(axis=0), h.T @ g, g.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                p[i] -= 0.005 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return router


def learn_router(x: np.ndarray, parts: int) -> Router | None:
    """Parts and router from a sample; None for a single part.

    The number of probes is the least that reaches ``RECALL`` on a tenth of the
    sample that the classifier was not fitted on.
    """
    levels = min(parts, max(1, int(len(x) / PER_SAMPLED * 1.05))).bit_length() - 1
    if levels < 1:
        return None
    rng = np.random.default_rng(3)
    graph = neighbour_graph(x, NEIGHBOURS)
    label = balanced_parts(graph, levels, rng)
    target = np.zeros((len(x), 1 << levels))
    for column in [label, *label[graph].T]:
        np.add.at(target, (np.arange(len(x)), column), 1 / (graph.shape[1] + 1))
    held = rng.random(len(x)) < 0.1
    router = fit_router(x[~held], target[~held], rng)
    home = router.logits(x).argmax(axis=1)
    ask = np.flatnonzero(held)
    ranked = np.argsort(-router.logits(x[ask]), axis=1, kind="stable")
    hits = np.zeros(1 << levels)
    for j in range(1 << levels):
        hits[j] = (home[graph[ask]] == ranked[:, j][:, None]).mean() if len(ask) else 1.0
    reach = np.cumsum(hits)
    router.probes = int(np.searchsorted(reach, RECALL * reach[-1])) + 1
    return router


def _usable(v: Column, size: Column) -> Column:
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return v.isNotNull() & (F.size(v) == size) & ~bad & F.exists(v, lambda e: e != 0)


def distances(rows: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances of ``v``; scaled first where a square would leave the range of doubles."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = rows - v
        far = np.sqrt((gap * gap).sum(axis=1))
        odd = np.flatnonzero(~np.isfinite(far) | (far < 1e-140))
        if len(odd):
            half = rows[odd] / 2 - v / 2  # the difference itself may be too large
            top = np.abs(half).max(axis=1)
            safe = np.where(top > 0, top, 1)[:, None]
            far[odd] = np.minimum(np.sqrt(((half / safe) ** 2).sum(axis=1)) * 2 * top, np.finfo(float).max)
    return far


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def search(
    vectors: DataFrame, asked: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query row.

    Queries are the rows for which ``asked`` (a condition on ``vec_id``) holds,
    candidates all rows but those with the query's id.  ``score`` is the Euclidean
    distance in double precision; ties go to the smaller id.  Rows take no part when
    their id or vector is null, the vector is zero, holds a null or a non-finite
    number, or has another length than most.  Neighbours are distinct ids: rows of one
    id and vector count once, an id with several vectors is as near as its nearest, and
    as a query it has the neighbours of all its vectors together, each at its least
    distance.  Up to ``PER_PART`` vectors the search is exact.
    """
    spark = vectors.sparkSession
    raw = vectors.select(quoted(id_col).cast("long").alias("vec_id"), quoted(vector_col).cast("array<double>").alias("v"))
    raw = raw.filter("vec_id IS NOT NULL AND v IS NOT NULL")
    sizes = raw.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    width = sizes["d"] if sizes else 1
    clean = raw.filter(_usable(F.col("v"), F.lit(width)))
    unique = clean.distinct()
    # of equal vectors only the k + 1 smallest ids can be among a query's k nearest
    same = Window.partitionBy(F.xxhash64("v"), F.xxhash64(F.lit(5), "v")).orderBy("vec_id")
    candidates = written(
        unique.withColumn("r", F.row_number().over(same)).filter(F.col("r") <= k + 1).select("vec_id", "v", "r"), "candidates"
    )
    distinct = candidates.filter("r = 1")
    total = distinct.count()
    parts = min(MAX_PARTS, max(2, 1 << (2 * -(-total // PER_PART) - 1).bit_length())) if total else 1
    if total >= 2 * PER_SAMPLED:
        share = F.lit(int(min(1.0, max(SAMPLE, PER_SAMPLED * parts) / total) * (1 << 30)))
        sample = distinct.filter(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) < share)
        rows = sample.select("vec_id", "v").toArrow()
        x = _matrix(rows["v"], width)[np.argsort(rows["vec_id"].to_numpy())]
        router = learn_router(x, parts)
    else:
        router = None
    shared = spark.sparkContext.broadcast(router)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            part = own.logits(_matrix(batch["v"], width)).argmax(axis=1) if own and len(batch) else np.zeros(len(batch), int)
            yield pa.record_batch({"part": pa.array(part.astype(np.int32)), "vec_id": batch["vec_id"], "v": batch["v"]})

    rows = "part int, vec_id long, v array<double>"
    indexed = written(candidates.select("vec_id", "v").mapInArrow(home, rows), "index")
    # an id with vectors in several parts counts in one
    owned = indexed.groupBy("vec_id").agg(F.min("part").alias("part"))
    counts = {r["part"]: r["n"] for r in owned.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = len(shared.value.b2) if router else 1
    held = np.array([counts.get(p, 0) for p in range(parts)])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if not len(batch):
                continue
            if own:
                ranked = np.argsort(-own.logits(_matrix(batch["v"], width)), axis=1, kind="stable")
                # further parts while fewer than k + 1 ids are in reach
                before = np.cumsum(held[ranked], axis=1) - held[ranked]
                use = (np.arange(parts) < own.probes) | (before <= k)
            else:
                ranked, use = np.zeros((len(batch), 1), int), np.ones((len(batch), 1), bool)
            i, j = np.nonzero(use)
            yield pa.record_batch(
                {"part": pa.array(ranked[i, j].astype(np.int32)), "vec_id": batch["vec_id"].take(pa.array(i)), "v": batch["v"].take(pa.array(i))}
            )

    routed = unique.filter(asked).select("vec_id", "v").mapInArrow(route, rows)

    def slots(df: DataFrame, size: int, name: str) -> DataFrame:
        """How many blocks of about ``size`` each part is dealt into: no part is one group."""
        return df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / size).alias(name))

    def slot(n: str) -> Column:
        return F.pmod(F.xxhash64("vec_id", "v", F.lit("slot")), F.col(n))

    def together(df: DataFrame, name: str, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.collect_list(F.struct("vec_id", "v")).alias(name))

    # every block of a part's candidates is a key of its own and meets the part's queries
    held_in, asked_in = slots(indexed, CANDIDATES, "blocks"), slots(routed, QUERIES, "asks")
    right = together(indexed.join(held_in, "part").withColumn("slot", slot("blocks")), "c", "part", "slot")
    spread = routed.join(asked_in, "part").withColumn("ask", slot("asks")).join(held_in, "part")
    spread = spread.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    left = together(spread, "q", "part", "slot", "ask")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                q, c = batch["q"][i].values, batch["c"][i].values
                qi, ci = q.field("vec_id").to_numpy(), c.field("vec_id").to_numpy()
                qv, cv = _matrix(q.field("v"), width), _matrix(c.field("v"), width)
                # an id's rows side by side: it is as near as its nearest vector
                order = np.argsort(ci, kind="stable")
                ci, cv = ci[order], cv[order]
                first = np.flatnonzero(np.append(True, ci[1:] != ci[:-1]))
                ci = ci[first]
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for own, v in zip(qi, qv):
                    far = np.minimum.reduceat(distances(cv, v), first)
                    others = np.flatnonzero(ci != own)
                    far, near_ids = far[others], ci[others]
                    if len(far) > k:
                        edge = np.partition(far, k - 1)[k - 1]
                        near = np.flatnonzero(far <= edge)
                    else:
                        near = np.arange(len(far))
                    near = near[np.lexsort((near_ids[near], far[near]))][:k]
                    out.append((np.full(len(near), own), near_ids[near], far[near]))
                a, b, s = (np.concatenate([o[j] for o in out]) for j in range(3))
                yield pa.record_batch({"query_id": pa.array(a), "vec_id": pa.array(b), "score": pa.array(s)})

    found = left.join(right, ["part", "slot"]).select("q", "c").mapInArrow(rank, "query_id long, vec_id long, score double")
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = nearest.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
