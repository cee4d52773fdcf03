"""Document quality by Bradley-Terry pairwise ranking.

Pairs of a preferred and a rejected labelled document give logistic loss on the
difference of their features; the learned weights score any document.  The score
is shifted so that 0.7 falls on the quantile of the training scores at the share
of rejected documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wattloom.llm import scan
from wattloom.llm.common import free_name, quoted, text_or_empty

#: About so many labelled documents at most are fitted on, taken by a hash of their ids.
MAX_LABELLED = 20_000
#: Preference pairs drawn for each fitted document.
PAIRS_PER_ROW = 4
THRESHOLD = 0.7

# Byte classes: lower, upper, digit, space, line break, control, non-ASCII, and each mark.
_CLASS = np.full(256, 6, np.int64)
_CLASS[:32] = 5
_CLASS[127] = 5
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_MARKS] = 7 + np.arange(len(_MARKS))
CLASSES = 7 + len(_MARKS)
STRUCTURE = 7
WIDTH = CLASSES + STRUCTURE


def features(column: pa.Array) -> np.ndarray:
    """One row of ``WIDTH`` features per text, from the text alone."""
    data, offsets = scan.buffers(column)
    out = np.zeros((len(column), WIDTH))
    for a, b, hashes, counts, _ in scan.words(data, offsets):
        n, size = b - a, np.diff(offsets[a : b + 1])
        part, owner = data[offsets[a] : offsets[b]], np.repeat(np.arange(n), size)
        hist = np.bincount(owner * CLASSES + _CLASS[part], minlength=n * CLASSES).reshape(n, CLASSES)
        out[a:b, :CLASSES] = np.sqrt(hist / np.maximum(size, 1)[:, None])
        doc = np.repeat(np.arange(n), counts)
        words = np.maximum(counts, 1)
        same = (doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, bool)
        again = same & (hashes[1:] == hashes[:-1]) if len(doc) else same
        pair = scan.mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(doc) else hashes
        pairs = np.bincount(doc[1:][same], minlength=n) if len(doc) else np.zeros(n)
        out[a:b, CLASSES:] = np.stack(
            [
                np.log1p(size),
                np.log1p(counts),
                np.log1p(size / words),
                _distinct(doc, hashes, n) / words,
                np.bincount(doc[1:][again], minlength=n) / words if len(doc) else np.zeros(n),
                _distinct(doc[1:][same], pair[same], n) / np.maximum(pairs, 1) if len(doc) else np.zeros(n),
                np.sqrt(hist[:, 4] / words),
            ],
            axis=1,
        )
    return out


def _distinct(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, doc))
    d, v = doc[order], values[order]
    first = np.ones(len(d), bool)
    first[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return np.bincount(d[first], minlength=n).astype(float)


@dataclass
class Ranking:
    """Learned weights; ``score`` maps features to 0..1."""

    centre: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    scale: np.ndarray = field(default_factory=lambda: np.ones(WIDTH))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    cut: float | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.cut is None:
            return np.full(len(x), 0.5)
        shifted = self.raw(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(shifted, -700, 700)))


def fit(x: np.ndarray, good: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> Ranking:
    """Bradley-Terry weights from features and labels (Newton steps on the pair loss).

    Without both labels nothing can be ranked: with rows of one label all scores
    lie on its side of the cut, without rows every score is 0.5.
    """
    if not len(x):
        return Ranking()
    scale = x.std(axis=0)
    model = Ranking(x.mean(axis=0), np.where(scale > 1e-9, scale, 1.0))
    ups, downs = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(ups) or not len(downs):
        model.cut = -1.0 if len(ups) else 1.0
        return model
    rng = np.random.default_rng(5)
    n = PAIRS_PER_ROW * len(x)
    z = np.clip((x - model.centre) / model.scale, -8, 8)
    diff = z[rng.choice(ups, n)] - z[rng.choice(downs, n)]
    w = model.weights
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -50, 50)))  # chance of the wrong order
        slope = diff.T @ p / n - ridge * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / n + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    raw = np.sort(z @ w)
    model.cut = float(raw[len(downs) - 1 : len(downs) + 1].mean())
    return model


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", limit: int = MAX_LABELLED,
) -> Ranking:
    """Fit on labelled documents, about ``limit`` of them at most (a bounded sample).

    Rows with a null id or label are left out; an id with several labels counts
    as good if at least half of them are 1.
    """
    marked = (
        labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("double").alias("y"))
        .dropna()
        .groupBy("id")
        .agg((F.avg("y") >= 0.5).alias("good"))
    )
    known = marked.count()
    if known > limit:  # ids whose hash is below a bound: no sort and no single task
        part = int(limit / known * (1 << 30))
        marked = marked.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < part)
    # about ``limit`` small rows: safe to broadcast
    texts = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = texts.join(F.broadcast(marked), "id").select("text", "good")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch["text"])
            flat = pa.array(x.ravel())
            yield pa.record_batch(
                {
                    "x": pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * WIDTH, flat),
                    "good": batch["good"],
                }
            )

    got = rows.mapInArrow(measure, "x array<double>, good boolean").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
    good = got["good"].to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort(np.column_stack([x, good]).T)  # whatever order rows came in
    return fit(x[order], good[order])


def score(docs: DataFrame, model: Ranking, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name``; a column of that name is replaced.

    Null and empty texts are scored from their (empty) features.
    """
    rest = docs.drop(name) if name in docs.columns else docs
    held = free_name(rest.columns, "text_to_score")
    schema = StructType([*rest.schema.fields, StructField(name, DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = pa.array(model.score(features(batch.column(batch.num_columns - 1))))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, s], names=[*batch.schema.names[:-1], name])

    return rest.withColumn(held, text_or_empty(text_col)).mapInArrow(apply, schema)
