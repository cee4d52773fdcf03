"""A log-bilinear language model, trained by noise-contrastive estimation.

Tokens are lower-cased words and one end for each text.  All training tokens are
counted.  The model predicts a token's class, one of the most frequent words (more of
them the more words there are) or a spelling class of all others, from the classes of
the two tokens before it; within
a spelling class words have their smoothed share of its counts.  Training runs over
every training text: each task starts from the same parameters, makes one pass of
noise-contrastive estimation over its rows, and the parameters are averaged by
tokens.  As a context, a word beyond the ``CONTEXTS`` most frequent is its spelling
class, so the contexts are bounded while the classes grow.  As the score is bilinear,
one matrix product over all classes gives the normaliser of every pair of contexts, a
table of a fixed size, and all probabilities are normalised.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm import scan
from wattloom.llm.common import fold, quoted, text_key, text_or_empty, written

#: Words that are classes of their own at least, and for each root of the distinct words.
WORDS, GROWTH = 992, 2
#: Most words that are contexts of their own: the table of normalisers has at most the square
#: of that and the spelling classes (17 MB), whatever the corpus.
CONTEXTS = 2_048
#: The least number of classes with the spelling classes.
CLASSES = WORDS + scan.SHAPES
#: Size of a vector, shared noise words of a batch, tokens in a batch, step size.
WIDTH, NOISE, BATCH, STEP = 16, 64, 1024, 0.15
#: Most words whose counts are sent to every task; the counts of rarer ones are joined.
HEAD = 200_000
#: The end of a text as a token.
END = np.uint64(0x5EED)
#: Passes: the first over one in ``FIRST`` training texts, the second over all.
FIRST = 8
SHAPE = [(CLASSES + 1, WIDTH), (WIDTH, WIDTH), (WIDTH, WIDTH), (CLASSES, WIDTH), (CLASSES,)]


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Token hashes, tokens per text and spelling classes of texts ``a:b``; ends included."""
    data, offsets = scan.buffers(column)
    for a, b, hashes, counts, shapes in scan.words(data, offsets, detail=True):
        at = np.cumsum(counts)
        yield a, b, np.insert(hashes, at, END), counts + 1, np.insert(shapes, at, 0)


def count_tokens(texts: DataFrame) -> DataFrame:
    """``token, shape, n`` over all texts; batches and tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(h, s) for _, _, h, _, s in tokens(batch["text"])]
            if found:
                every = np.concatenate([h for h, _ in found])
                token, first, n = np.unique(every, return_index=True, return_counts=True)
                shape = np.concatenate([s for _, s in found])[first]
                yield pa.record_batch(
                    {"token": pa.array(token.view(np.int64)), "shape": pa.array(shape.astype(np.int32)), "n": pa.array(n)}
                )

    rows = texts.mapInArrow(count, "token long, shape int, n long")
    return rows.groupBy("token", "shape").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the most frequent tokens, and what is left for each spelling class."""

    total: int
    distinct: int
    head: np.ndarray  # sorted hashes
    counts: np.ndarray
    classes: np.ndarray  # class of a head token, -1: its spelling class
    rest: np.ndarray  # of each spelling class: log10 of its tokens + distinct words + 1
    noise: np.ndarray  # share of each class in the training tokens
    near: int = -1  # words that are contexts of their own; the spelling classes and a text's start follow

    def __post_init__(self):
        if self.near < 0:
            self.near = min(self.words, CONTEXTS)

    @property
    def words(self) -> int:
        """Words that are classes of their own; the spelling classes follow them."""
        return len(self.noise) - scan.SHAPES

    def contexts(self, cls: np.ndarray, shapes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts one and two tokens before each token, within each text."""
        own = np.where(cls < self.near, cls, self.near + np.where(cls < self.words, shapes, cls - self.words))
        return contexts(own, counts, self.near + scan.SHAPES)

    def look_up(self, hashes: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of each token, its count, and whether it is in the head."""
        at = np.minimum(np.searchsorted(self.head, hashes), max(len(self.head) - 1, 0))
        known = self.head[at] == hashes if len(self.head) else np.zeros(len(hashes), bool)
        n = np.where(known, self.counts[at] if len(self.head) else 0, 0)
        own = self.classes[at] if len(self.head) else np.full(len(hashes), -1)
        return np.where(known & (own >= 0), own, self.words + shapes), n, known


def vocabulary(counted: DataFrame) -> Vocabulary:
    """Frequent tokens by a count threshold: at most ``HEAD`` of them reach the driver."""
    # counts in bins: exact up to 512, then steps of 2 %; some 2,000 rows at most
    level = F.when(F.col("n") <= 512, F.col("n")).otherwise(F.floor(512 + F.log(F.col("n") / 512) / np.log(1.02)))
    bins = counted.groupBy(level.cast("long").alias("level")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")
    )
    got = sorted(bins.collect(), key=lambda r: -r["level"])
    total, distinct = sum(r["n"] for r in got), sum(r["words"] for r in got)
    taken, least = 0, None
    for r in got:
        taken += r["words"]
        if taken > HEAD:
            break
        least = r["least"]
    frequent = counted.filter(F.col("n") >= least) if least is not None else counted.limit(0)
    rows = frequent.toArrow()
    token = rows["token"].to_numpy().astype(np.int64).view(np.uint64)
    n, shape = rows["n"].to_numpy().astype(np.int64), rows["shape"].to_numpy().astype(np.int64)
    order = np.argsort(token)
    token, n, shape = token[order], n[order], shape[order]
    own = max(WORDS, int(GROWTH * distinct**0.5))
    top = np.lexsort((token, -n))[:own]
    classes = np.full(len(token), -1)
    classes[top] = np.arange(len(top))
    sums, words = np.zeros(scan.SHAPES), np.zeros(scan.SHAPES)
    for r in counted.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("w")).collect():
        sums[r["shape"]], words[r["shape"]] = r["n"], r["w"]
    np.subtract.at(sums, shape[top], n[top])
    np.subtract.at(words, shape[top], 1)
    share = np.zeros(own + scan.SHAPES)
    share[: len(top)] = n[top]
    share[own:] = sums
    share = (share + 0.5) / (share + 0.5).sum()
    return Vocabulary(total, distinct, token, n, classes, np.log10(sums + words + 1), share)


def contexts(cls: np.ndarray, counts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Values one and two tokens before, within each text; ``start`` before its begin."""
    begun = np.cumsum(counts) - counts
    one = np.concatenate([[start], cls[:-1]])
    two = np.concatenate([[start, start], cls[:-2]])[: len(cls)]
    one[begun] = start
    two[begun] = start
    second = begun[counts > 1] + 1
    two[second] = start
    return one, two


def initial(noise: np.ndarray, near: int) -> list[np.ndarray]:
    """Start: almost the class frequencies alone, whatever the context."""
    rng, n = np.random.default_rng(11), len(noise)
    out = [rng.normal(0, 0.1, s) for s in [(near + scan.SHAPES + 1, WIDTH), *SHAPE[1:3], (n, WIDTH)]]
    out[1], out[2] = np.eye(WIDTH) * 0.7, np.eye(WIDTH) * 0.3
    return [x.astype(np.float32) for x in out] + [np.log(noise).astype(np.float32)]


class Trainer:
    """One pass of noise-contrastive estimation with adaptive steps."""

    def __init__(self, start: list[np.ndarray], noise: np.ndarray, seed: int):
        self.p = [x.copy() for x in start]
        self.squares = [np.full(x.shape, 1e-2, np.float32) for x in start]
        self.edges = np.cumsum(noise)
        self.log_noise = np.log(noise * NOISE).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.seen = 0

    def learn(self, w: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        r, c1, c2, q, bias = self.p
        drawn = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), len(bias) - 1)
        r1, r2 = r[one], r[two]
        h = r1 @ c1 + r2 @ c2
        data = np.einsum("ij,ij->i", h, q[w]) + bias[w] - self.log_noise[w]
        fake = h @ q[drawn].T + (bias - self.log_noise)[drawn]
        up = 1 / (1 + np.exp(np.clip(data, -30, 30)))
        down = -1 / (1 + np.exp(np.clip(-fake, -30, 30)))
        gh = up[:, None] * q[w] + down @ q[drawn]
        # only the rows of the batch have a gradient: its cost is the same for all numbers of classes
        seen, (wx, dx) = _rows(len(bias), w, drawn)
        gq = _scatter(wx, up[:, None] * h, len(seen))
        np.add.at(gq, dx, down.T @ h)
        gb = np.bincount(wx, up, len(seen))
        np.add.at(gb, dx, down.sum(axis=0))
        before, (x1, x2) = _rows(len(r), one, two)
        gr = _scatter(x1, gh @ c1.T, len(before)) + _scatter(x2, gh @ c2.T, len(before))
        every = slice(None)
        grads = ((before, gr), (every, r1.T @ gh), (every, r2.T @ gh), (seen, gq), (seen, gb))
        for x, square, (at, g) in zip(self.p, self.squares, grads):
            g = (g / len(w) * 16).astype(np.float32)
            square[at] += g * g
            x[at] += STEP * g / np.sqrt(square[at])
        self.seen += len(w)


def _rows(size: int, *at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct indexes of ``at``, and where each index is among them."""
    found = np.zeros(size, bool)
    for x in at:
        found[x] = True
    distinct, place = np.flatnonzero(found), np.zeros(size, np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, [place[x] for x in at]


def _scatter(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(at, rows[:, d], size) for d in range(rows.shape[1])], axis=1)


def train_round(texts: DataFrame, vocab: Vocabulary, start: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """One pass over all ``texts`` in parallel, averaged by the tokens of each task."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((vocab, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, begin = shared.value
        trainer = Trainer(begin, own.noise, seed)
        for batch in batches:
            for _, _, hashes, counts, shapes in tokens(batch["text"]):
                cls, _, _ = own.look_up(hashes, shapes)
                one, two = own.contexts(cls, shapes, counts)
                order = trainer.rng.permutation(len(cls))
                for lo in range(0, len(order), BATCH):
                    part = order[lo : lo + BATCH]
                    trainer.learn(cls[part], one[part], two[part])
        if trainer.seen:
            flat = np.concatenate([x.ravel() for x in trainer.p]).astype(float) * trainer.seen
            yield pa.record_batch(
                {"at": pa.array(np.arange(len(flat), dtype=np.int32)), "x": pa.array(flat), "w": pa.array(np.full(len(flat), float(trainer.seen)))}
            )

    sums = texts.mapInArrow(run, "at int, x double, w double").groupBy("at").agg((F.sum("x") / F.sum("w")).alias("x"))
    got = sums.toArrow()
    if not got.num_rows:
        return start
    shape = [x.shape for x in start]
    flat = np.zeros(sum(int(np.prod(s)) for s in shape))
    flat[got["at"].to_numpy()] = got["x"].to_numpy()
    cuts = np.cumsum([int(np.prod(s)) for s in shape])[:-1]
    return [x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, cuts), shape)]


@dataclass
class Model:
    """A token's log10 probability: a product of vectors and a normaliser from a table."""

    vocab: Vocabulary
    first: np.ndarray  # vector of the context one before, and of two before; base 10
    second: np.ndarray
    own: np.ndarray  # vector of a class
    bias: np.ndarray
    norm: np.ndarray  # context x context

    @staticmethod
    def of(vocab: Vocabulary, p: list[np.ndarray]) -> Model:
        r, c1, c2, q, bias = (x.astype(np.float32) for x in p)
        one, two = r @ c1, r @ c2
        right = two @ q.T
        top2 = right.max(axis=1, keepdims=True)
        right = np.exp(right - top2)
        norm = np.empty((len(r), len(r)), np.float32)
        for lo in range(0, len(r), 512):
            left = one[lo : lo + 512] @ q.T + bias
            top1 = left.max(axis=1, keepdims=True)
            norm[lo : lo + 512] = np.log(np.exp(left - top1) @ right.T) + top1 + top2.T
        ten = np.float32(np.log(10))
        norm /= ten
        return Model(vocab, one / ten, two / ten, q, bias / ten, norm)

    def log10(self, cls: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Of each token's class after the two before it."""
        near = np.einsum("ij,ij->i", self.first[one] + self.second[two], self.own[cls])
        return near.astype(float) + self.bias[cls] - self.norm[one, two]


SCORED = (
    "doc boolean, doc_id long, k1 long, k2 long, token long, n_tokens long, "
    "n_known long, base double, score double"
)


def _score_rows(shared):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        vocab = model.vocab
        floor = np.log10(vocab.total + vocab.distinct + 1.0)
        for batch in batches:
            keys = np.stack([batch["k1"].to_numpy(), batch["k2"].to_numpy()], axis=1)
            _, where = np.unique(keys, axis=0, return_index=True)
            leads = np.zeros(len(keys), bool)
            leads[where] = True  # of equal texts in a batch, one asks for the rare words
            for a, b, hashes, counts, shapes in tokens(batch["text"]):
                cls, n, known = vocab.look_up(hashes, shapes)
                one, two = vocab.contexts(cls, shapes, counts)
                logs = np.log10(n + 1.0)
                begun = np.cumsum(counts) - counts
                other = cls >= vocab.words
                part = model.log10(cls, one, two)
                part[other] += logs[other] - vocab.rest[cls[other] - vocab.words]
                fields = {
                    "doc_id": batch["doc_id"].slice(a, b - a), "k1": batch["k1"].slice(a, b - a), "k2": batch["k2"].slice(a, b - a),
                    "token": pa.nulls(b - a, pa.int64()), "n_tokens": pa.array(counts),
                    "n_known": pa.array(np.add.reduceat((n > 0).astype(np.int64), begun)),
                    "base": pa.array(np.add.reduceat(logs - floor, begun)), "score": pa.array(np.add.reduceat(part, begun)),
                }
                yield pa.record_batch({"doc": pa.array(np.ones(b - a, bool)), **fields})
                doc = np.repeat(np.arange(a, b), counts)
                rare = np.flatnonzero(~known & leads[doc])
                # once for each text, a marker with the number of asks; then its rare words
                ask = np.unique(doc[rare])
                who = np.concatenate([ask, doc[rare]])
                token = pa.array(hashes[rare].view(np.int64))
                yield pa.record_batch(
                    {
                        "doc": pa.array(np.zeros(len(who), bool)), "doc_id": pa.nulls(len(who), pa.int64()),
                        "k1": pa.array(keys[who, 0]), "k2": pa.array(keys[who, 1]),
                        "token": pa.concat_arrays([pa.nulls(len(ask), pa.int64()), token]),
                        "n_tokens": pa.nulls(len(who), pa.int64()), "n_known": pa.nulls(len(who), pa.int64()),
                        "base": pa.nulls(len(who), pa.float64()), "score": pa.nulls(len(who), pa.float64()),
                    }
                )

    return apply


def score_texts(
    docs: DataFrame, modulus: int = 7, out: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Learns from the rows whose crc32 of the id modulo ``modulus`` is not ``out``.
    Scores are log10 probabilities of whole texts: ``base_score`` of smoothed token
    frequencies, ``score`` of the model.  A null text is empty: one end token.
    Without training rows both scores are 0.  Null ids are text ``''`` for the fold;
    repeated rows are scored and counted as often as they occur.
    """
    spark = docs.sparkSession
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    learned = rows.filter(fold(F.col("doc_id"), modulus) != out)
    counted = written(count_tokens(learned.select("text")), "token-counts")
    vocab = vocabulary(counted)
    params = initial(vocab.noise, vocab.near)
    few = learned.filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(FIRST)) == 0)
    for seed, part in ((1, few), (2, learned)):
        params = train_round(part.select("text"), vocab, params, seed)
    shared = spark.sparkContext.broadcast(Model.of(vocab, params))
    keyed = rows.select("doc_id", "text", text_key(F.col("text")).alias("k")).select("doc_id", "k.*", "text")
    scored = written(keyed.mapInArrow(_score_rows(shared), SCORED), "scored")
    # words beyond the head: their counts are joined, one sum for each text
    rare = scored.filter("NOT doc AND token IS NOT NULL").select("k1", "k2", "token")
    looked = rare.join(counted.select("token", "n"), "token", "left")
    asks = scored.filter("NOT doc AND token IS NULL").select("k1", "k2", F.lit(None).cast("long").alias("n"), F.lit(1).alias("ask"))
    per_text = (
        looked.select("k1", "k2", "n", F.lit(0).alias("ask")).unionByName(asks)
        .groupBy("k1", "k2")
        .agg(
            F.sum("ask").alias("asks"),
            F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("logs"),
            F.count("n").alias("known"),
        )
        .select("k1", "k2", (F.col("logs") / F.col("asks")).alias("logs"), (F.col("known") / F.col("asks")).cast("long").alias("known"))
    )
    zero = F.lit(vocab.total == 0)
    more = F.coalesce("logs", F.lit(0.0))
    return scored.filter("doc").drop("token").join(per_text, ["k1", "k2"], "left").select(
        "doc_id",
        (fold(F.col("doc_id"), modulus) == out).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        F.when(zero, 0.0).otherwise(F.col("base") + more).alias("base_score"),
        F.when(zero, 0.0).otherwise(F.col("score") + more).alias("score"),
    )
