"""Language identification as inference in a mixture of languages.

Byte trigrams within words are counted by language over all training documents.
A document is a bag of words, each written in one of the languages; expectation
maximisation estimates the document's language proportions from the words'
trigram likelihoods.  Which languages are in the document is chosen by penalised
likelihood: one language, unless a mixture explains the words better by more than
its penalty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattloom.llm import scan
from wattloom.llm.common import free_name, quoted, text_or_empty

#: Trigrams are hashed into so many cells; the model's size is this times the languages.
CELLS = 1 << 16
#: Overlapping trigrams of a word tell the same thing about three times.
TEMPER = 1 / 3
ROUNDS = 8


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Trigram cells of a buffer with the word each lies in, and words per document."""
    part = np.where(scan.SPACE[data], np.uint8(32), scan.LOWER[data])
    starts, ends = scan.word_bounds(part, offsets)
    padded = np.full(len(part) + 2, 32, np.int64)
    padded[1:-1] = part
    left, right = padded[:-2].copy(), padded[2:].copy()
    edge = offsets[(offsets > 0) & (offsets < len(part))]
    left[edge], right[edge - 1] = 32, 32
    inside = np.flatnonzero(part != 32)
    code = (left[inside] << 16) | (padded[1:-1][inside] << 8) | right[inside]
    cell = (code * 0x9E3779B1 >> 12) & (CELLS - 1)
    return cell, ends - starts, np.diff(np.searchsorted(starts, offsets))


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, cell, n`` over all rows; one row per cell and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch["lang"].dictionary_encode()
            lang = codes.indices.to_numpy(zero_copy_only=False)
            total = np.zeros((len(codes.dictionary), CELLS), np.int64)
            data, offsets = scan.buffers(batch["text"])
            for a, b in scan.runs(offsets):
                at = offsets[a : b + 1] - offsets[a]
                cell, sizes, counts = _grams(data[offsets[a] : offsets[b]], at)
                owner = np.repeat(np.repeat(lang[a:b], counts), sizes)
                for k in np.unique(lang[a:b]):
                    total[k] += np.bincount(cell[owner == k], minlength=CELLS)
            k, c = np.nonzero(total)
            yield pa.record_batch(
                {"lang": codes.dictionary.take(pa.array(k)), "cell": pa.array(c.astype(np.int32)), "n": pa.array(total[k, c])}
            )

    rows = docs.select(quoted(lang_col).cast("string").alias("lang"), text_or_empty(text_col).alias("text"))
    counted = rows.mapInArrow(count, "lang string, cell int, n long")
    return counted.groupBy("lang", "cell").agg(F.sum("n").alias("n"))


@dataclass
class Languages:
    names: list[str]
    logs: np.ndarray  # CELLS x languages

    def infer(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predicted language, its proportion, and all proportions of each text."""
        data, offsets = scan.buffers(column)
        n, k = len(column), len(self.names)
        shares = np.full((n, k), 1 / max(k, 1))
        for a, b in scan.runs(offsets):
            at = offsets[a : b + 1] - offsets[a]
            cell, sizes, counts = _grams(data[offsets[a] : offsets[b]], at)
            if len(sizes):
                begun = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                by_word = np.add.reduceat(self.logs[cell], begun, axis=0)
                full = np.flatnonzero(counts)
                shares[a + full] = _mixtures(by_word, counts[full])
        best = shares.argmax(axis=1)
        return best, shares[np.arange(n), best], shares


def _mixtures(logs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Language proportions of documents of ``counts`` words with log-likelihoods ``logs``."""
    begun = np.concatenate([[0], np.cumsum(counts)[:-1]])
    docs, k = len(counts), logs.shape[1]
    top = logs.max(axis=1, keepdims=True)
    like = np.exp(logs - top)
    single = np.add.reduceat(logs - top, begun, axis=0)
    allowed = np.ones((docs, k), bool)
    owner = np.repeat(np.arange(docs), counts)

    def estimate(pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(ROUNDS):
            joint = like * pi[owner]
            total = joint.sum(axis=1, keepdims=True)
            pi = np.add.reduceat(joint / np.maximum(total, 1e-300), begun, axis=0) / counts[:, None]
        fit = np.log(np.maximum((like * pi[owner]).sum(axis=1), 1e-300))
        return pi, np.add.reduceat(fit, begun)

    pi, fit = estimate(np.full((docs, k), 1 / k))
    # languages of little weight leave, the rest is estimated again on their own
    allowed = pi >= np.minimum(0.05, pi.max(axis=1, keepdims=True))
    pi, fit = estimate(np.where(allowed, pi, 0) / np.where(allowed, pi, 0).sum(axis=1, keepdims=True))
    alone = single.argmax(axis=1)
    penalty = (allowed.sum(axis=1) - 1) * (0.5 * np.log(counts + 1) + 2)
    pure = fit - single.max(axis=1) <= penalty
    # of a document in one language the share is that language's posterior among pure ones
    posterior = np.exp(single - single.max(axis=1, keepdims=True))
    posterior /= posterior.sum(axis=1, keepdims=True)
    pi[pure] = posterior[pure]
    pi[pure, alone[pure]] = np.maximum(pi[pure, alone[pure]], 1 / k)
    return pi


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Trigram models of all languages in ``lang_col``, from every row with text and language.

    The counts collected are at most ``CELLS`` rows for each language.
    """
    known = docs.filter(quoted(lang_col).isNotNull() & quoted(text_col).isNotNull())
    got = count_grams(known, text_col, lang_col).toPandas()
    names = sorted(got["lang"].unique())
    counts = np.zeros((CELLS, len(names)))
    counts[got["cell"], [names.index(x) for x in got["lang"]]] = got["n"]
    smooth = counts + 0.1
    logs = TEMPER * np.log(smooth / smooth.sum(axis=0))
    return Languages(names, logs.astype(np.float32))


def predict(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``shares`` (language to proportion).

    A null text, or one without a letter, is ``und`` with score 0 and no shares;
    so is every text when no language was learned.  Equal likelihoods go to the
    language that sorts first.  Columns of these names are replaced.
    """
    rest = docs.drop(*[c for c in ("lang_pred", "score", "shares") if c in docs.columns])
    held = free_name(rest.columns, "text_to_identify")
    plain = F.when(quoted(text_col).cast("string").rlike(r"\p{L}"), quoted(text_col).cast("string"))
    added = "lang_pred string, score double, shares array<double>"
    schema = StructType(rest.schema.fields + StructType.fromDDL(added).fields)
    names = pa.array([*model.names, "und"])
    k = len(model.names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            none = text.is_null().to_numpy(zero_copy_only=False) | (k == 0)
            if k:
                best, score, shares = model.infer(text)
            else:
                best, score, shares = np.zeros(len(text), int), np.zeros(len(text)), np.zeros((len(text), 0))
            sizes = np.where(none, 0, k)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            new = [
                names.take(pa.array(np.where(none, k, best))),
                pa.array(np.where(none, 0.0, np.clip(score, 0, 1))),
                pa.ListArray.from_arrays(bounds, pa.array(shares[~none].ravel().astype(float))),
            ]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *new], names=[*batch.schema.names[:-1], "lang_pred", "score", "shares"]
            )

    done = rest.withColumn(held, plain).mapInArrow(apply, schema)
    keys = F.array(*[F.lit(x) for x in model.names]) if k else F.array().cast("array<string>")
    return done.withColumn(
        "shares", F.map_from_arrays(F.slice(keys, 1, F.size("shares")), F.col("shares"))
    )
