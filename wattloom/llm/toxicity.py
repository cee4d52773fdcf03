"""Toxicity by a weighted finite-state grammar of clauses.

Words become symbols (insult, harm, target, negation, report, ...).  Five transducers
rewrite the symbols of a line one after another - reported speech, negation, target,
threat, insult - and are composed into a single machine, whose outputs are the kinds
of attack that a clause holds; the words of an attack count as the clause around them
says.  The weights of the kinds are learned from labels by logistic regression, with
the grammar's own weights as the prior.  Insults are a fixed list and, for any language,
the stems of words that labelled toxic texts use in many different contexts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wattloom.llm.common import free_name, quoted, text_or_empty, written

#: About so many labelled documents at most are learned from, taken by a hash of their ids.
MAX_LABELLED = 20_000
#: Learned stems: at most so many, in contexts of at least so many texts, this share of their
#: contexts toxic, and so many contexts for each use (copies of a text repeat theirs).
LEXICON, CONTEXTS, PRECISION, VARIETY = 200, 8, 0.8, 0.5
#: Letters of a learned stem.
STEM = (3, 12)
THRESHOLD = 0.3

# --- fixed values: the words of the grammar --------------------------------------
INSULTS = frozenset(
    "bastard clown coward creep degenerate disgusting dumb filth fool garbage idiot idiotic imbecile jerk "
    "liar loser lowlife maggot moron moronic parasite pathetic pig rat retard scum scumbag stupid subhuman "
    "trash ugly useless vermin vile worthless".split()
)
HARM = frozenset("beat burn destroy hang hunt hurt kill murder shoot slaughter smash stab strangle".split())
TARGETS = frozenset(
    "he her him his she their them they those u ur you your yours yourself yourselves you're he's she's they're".split()
)
NEGATIONS = frozenset("aren't cannot don't hardly isn't neither never no nor not wasn't weren't without won't".split())
REPORTS = frozenset(
    "accused alleged called calling claimed quote quoted quoting reported said says shouted wrote yelled".split()
)
INTENT = frozenset("gonna going i'll shall should we'll will wanna want".split())

# --- symbols ---------------------------------------------------------------------
# other, insult, learned insult, harm, target, negation, report, intent, quote mark,
# comma, end of clause, end of line
WORD = ["o", "I", "L", "K", "T", "N", "R", "M", "q", "c", "E", "P"]
#: Kinds of attack with the weights that the grammar gives them.
KINDS = {"threat": 4.0, "directed": 3.5, "insult": 2.5, "learned": 1.5, "wish": 2.0, "reported": 0.5, "denied": 0.2}
BIAS = -2.5


@dataclass
class Transducer:
    """Reads one symbol and writes one: ``arcs[state, symbol] = (state, output)``.

    A symbol without an arc leaves ``(fallback[state], the symbol itself)``.
    """

    start: str
    arcs: dict[tuple[str, str], tuple[str, str]]
    fallback: dict[str, str] = field(default_factory=dict)

    def step(self, state: str, symbol: str) -> tuple[str, str]:
        return self.arcs.get((state, symbol)) or (self.fallback.get(state, state), symbol)


def _scope(enter: str, length: int, ends: str, changed: dict[str, str]) -> Transducer:
    """After ``enter``, for ``length`` symbols or until one of ``ends``, symbols are changed."""
    states = ["-"] + [str(k) for k in range(1, length + 1)]
    down = {s: states[max(k - 1, 0)] for k, s in enumerate(states)}
    arcs: dict[tuple[str, str], tuple[str, str]] = {}
    for s in states:
        arcs[s, enter] = (states[-1], enter)
        arcs.update({(s, e): ("-", e) for e in ends})
        if s != "-":
            arcs.update({(s, x): (down[s], y) for x, y in changed.items()})
    return Transducer("-", arcs, down)


def reported_speech() -> Transducer:
    """Attacks in the rest of a clause after a word of report, or in the quote it opens."""
    hidden = {"I": "Ir", "L": "Ir", "K": "o"}
    arcs: dict[tuple[str, str], tuple[str, str]] = {("plain", "R"): ("said", "R"), ("said", "q"): ("quoted", "q")}
    arcs[("quoted", "q")] = ("plain", "q")
    for state in ("said", "quoted"):
        arcs.update({(state, x): (state, y) for x, y in hidden.items()})
        arcs[state, "P"] = ("plain", "P")
    arcs["said", "E"] = ("plain", "E")
    return Transducer("plain", arcs)


def negation() -> Transducer:
    """Attacks up to four words after a negation in the same clause."""
    return _scope("N", 4, "cEP", {"I": "In", "L": "In", "K": "Kn"})


def target() -> Transducer:
    """Insults up to five words after a target, and targets up to two words after an insult (``U``)."""
    before = _scope("T", 5, "EP", {"I": "It"})
    arcs: dict[tuple[str, str], tuple[str, str]] = {}
    fallback = {}
    for near in ["-", *"12345"]:
        for open_ in "012":
            state = near + open_
            for symbol in [*WORD, "Ir", "In", "Kn"]:
                after, out = before.step(near, symbol)
                left = "2" if out == "I" else "0" if symbol in "EP" else str(max(int(open_) - 1, 0))
                if symbol == "T" and open_ != "0":
                    out, left = "U", "0"
                arcs[state, symbol] = (after + left, out)
            fallback[state] = before.fallback[near] + str(max(int(open_) - 1, 0))
    return Transducer("-0", arcs, fallback)


def threat() -> Transducer:
    """Intent, harm and target close together (``D``), or harm and target alone (``d``)."""
    arcs: dict[tuple[str, str], tuple[str, str]] = {}
    fallback = {"-": "-", "M2": "M1", "M1": "M0", "M0": "-", "MK2": "MK1", "MK1": "-", "K2": "K1", "K1": "-"}
    for state in fallback:
        arcs[state, "M"] = ("M2", "M")
        arcs[state, "K"] = ("MK2" if state.startswith("M") else "K2", "K")
        for end in "EP":
            arcs[state, end] = ("-", end)
        if "K" in state:
            for hit in "TU":
                arcs[state, hit] = ("-", "D" if state.startswith("M") else "d")
    return Transducer("-", arcs, fallback)


def insult() -> Transducer:
    """The kinds of attack; a target after an insult is ``U``, every other symbol none."""
    kinds = {"It": "directed", "U": "U", "I": "insult", "L": "learned", "Ir": "reported", "In": "denied", "D": "threat", "d": "wish"}
    none = {s: "" for s in [*WORD, "Kn"]}
    arcs = {("-", s): ("-", out) for s, out in {**none, **kinds}.items()}
    return Transducer("-", arcs)


def compose(first: Transducer, second: Transducer, symbols: Iterable[str]) -> Transducer:
    """One transducer that does what ``second`` does to the output of ``first``."""
    symbols = list(symbols)
    names = {(first.start, second.start): "0"}
    todo, arcs = [(first.start, second.start)], {}
    while todo:
        a, b = state = todo.pop()
        for symbol in symbols:
            a2, mid = first.step(a, symbol)
            b2, out = second.step(b, mid)
            if (a2, b2) not in names:
                names[a2, b2] = str(len(names))
                todo.append((a2, b2))
            arcs[names[state], symbol] = (names[a2, b2], out)
    return Transducer("0", arcs)


def grammar() -> Transducer:
    """Reported speech, negation, target, threat and insult in one machine over ``WORD``."""
    machine = reported_speech()
    for part in (negation(), target(), threat(), insult()):
        machine = compose(machine, part, WORD)
    return machine


# --- texts -------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»„]|[,:()|]|[.!?;]+|[^\W_]")


def symbol_of(token: str, insults: frozenset[str], stems: tuple[str, ...]) -> str:
    token = token.replace("’", "'")
    if token in insults:
        return "I"
    if stems and token.startswith(stems):
        return "L"
    for words, symbol in ((TARGETS, "T"), (NEGATIONS, "N"), (INTENT, "M"), (REPORTS, "R"), (HARM, "K")):
        if token in words:
            return symbol
    if token.endswith("n't"):
        return "N"
    if token.endswith("'ll"):
        return "M"
    if token in "\"“”«»„":
        return "q"
    if token in ",:()|":
        return "c"
    return "E" if token[0] in ".!?;" else "o"


class Grammar:
    """The composed machine with a lexicon, ready to run over texts."""

    def __init__(self, insults: Iterable[str] = INSULTS, stems: Iterable[str] = ()):
        self.insults, self.stems = frozenset(insults), tuple(sorted(stems))
        machine = grammar()
        self.start = int(machine.start)
        states = 1 + max(int(s) for s, _ in machine.arcs)
        self.kinds = list(KINDS)
        rank = {**{k: i for i, k in enumerate(self.kinds)}, "U": len(KINDS)}
        self.table = [
            {
                symbol: (int(machine.step(str(s), symbol)[0]), rank.get(machine.step(str(s), symbol)[1], -1))
                for symbol in WORD
            }
            for s in range(states)
        ]
        self.symbols: dict[str, str] = {}
        self.triggers = "|".join(sorted(map(re.escape, {*self.insults, *self.stems, *HARM})))
        self.trigger = re.compile(self.triggers)

    def count(self, text: str) -> np.ndarray:
        """Attacks by kind."""
        out = [0] * (len(self.kinds) + 1)
        table, symbols = self.table, self.symbols
        for line in text.lower().split("\n"):
            if not self.trigger.search(line):
                continue
            state = self.start
            for match in _TOKEN.finditer(line):
                token = match.group()
                symbol = symbols.get(token)
                if symbol is None:
                    if len(symbols) > 200_000:
                        symbols.clear()
                    symbol = symbols[token] = symbol_of(token, self.insults, self.stems)
                state, kind = table[state][symbol]
                if kind >= 0:
                    out[kind] += 1
        later = out.pop()  # insults that turned out to be directed
        out[self.kinds.index("insult")] -= later
        out[self.kinds.index("directed")] += later
        return np.array(out, np.int64)

    def features(self, column: pa.Array) -> np.ndarray:
        """``log2(1 + attacks)`` by kind for each text; texts without a trigger are not parsed."""
        counts = np.zeros((len(column), len(self.kinds)))
        some = pc.match_substring_regex(column, self.triggers, ignore_case=True)
        for i in np.flatnonzero(some.to_numpy(zero_copy_only=False)):
            counts[i] = self.count(column[i].as_py())
        return np.log2(1 + counts)


# --- learning ----------------------------------------------------------------------


@dataclass
class Model:
    """Lexicon and weights; ``score`` maps features to 0..1."""

    insults: frozenset[str] = INSULTS
    stems: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.array([*KINDS.values(), BIAS]))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -700, 700)))


def fit(x: np.ndarray, toxic: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression (Newton steps); the grammar's weights are the centre of its prior.

    Weights stay at 0 or above, so no kind of attack ever speaks for a text.
    """
    prior = np.array([*KINDS.values(), BIAS])
    firm = np.ones(len(prior))
    w, z = prior.copy(), np.column_stack([x, np.ones(len(x))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        slope = z.T @ (toxic - p) - firm * (w - prior)
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(firm)
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -2, 2)
        w[:-1] = np.maximum(w[:-1], 0)
        if np.abs(step).max() < 1e-8:
            break
    return w


def lexicon(texts: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Insults and learned stems from ``text, toxic``.

    A stem is the beginning of words that toxic texts use in many contexts and others
    hardly.  A context is the word before and the word after, so however many copies of
    a text there are, they count once; contexts of the same few texts make no stem.
    A fixed insult that other texts use in more contexts than toxic ones is left out.
    """

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uses, origin = [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                tokens = [t for t in _TOKEN.findall(text.lower()) if len(t) > 1 and t[0].isalpha()]
                own = {*zip(tokens, ["", *tokens], [*tokens[1:], ""])}
                uses.extend(own)
                origin.extend([i] * len(own))
            word, before, after = zip(*uses) if uses else ((), (), ())
            at = pa.array(origin, pa.int64())
            yield pa.record_batch(
                {
                    "word": pa.array(word, pa.string()), "before": pa.array(before, pa.string()),
                    "after": pa.array(after, pa.string()), "toxic": batch["toxic"].take(at), "doc": batch["doc"].take(at),
                }
            )

    uses = texts.distinct().select("text", "toxic", F.xxhash64("text").alias("doc")).mapInArrow(
        contexts, "word string, before string, after string, toxic boolean, doc long"
    )
    seen = uses.groupBy("word", F.xxhash64("before", "after").alias("place")).agg(
        F.max("toxic").alias("bad"), F.min("toxic").alias("only"), F.min("doc").alias("doc"),
        F.sum(F.col("toxic").cast("long")).alias("uses"),
    )
    words = seen.groupBy("word").agg(
        F.sum(F.col("bad").cast("long")).alias("bad"),
        F.sum((~F.col("only")).cast("long")).alias("good"),
        F.count_distinct(F.when(F.col("bad"), F.col("doc"))).alias("texts"),
        F.sum("uses").alias("uses"),
    )
    words = written(words, "words")
    fixed = F.col("word").isin(sorted(INSULTS))
    denied = words.filter(fixed & (F.col("good") >= CONTEXTS) & (F.col("good") > F.col("bad")))
    insults = INSULTS - {r["word"] for r in denied.collect()}
    lengths = F.sequence(F.lit(STEM[0]), F.least(F.length("word"), F.lit(STEM[1])))
    stems = (
        words.filter(~fixed & (F.length("word") >= STEM[0]))
        .withColumn("k", F.explode(lengths))
        .groupBy(F.expr("substring(word, 1, k)").alias("stem"))
        .agg(*[F.sum(c).alias(c) for c in ("bad", "good", "texts", "uses")])
    )
    share = (F.col("bad") + 1) / (F.col("bad") + F.col("good") + 2)
    fit_ = (F.col("texts") >= CONTEXTS) & (share >= PRECISION) & (F.col("bad") >= VARIETY * F.col("uses"))
    gain = F.col("bad") - F.col("good") * (PRECISION / (1 - PRECISION))
    # stems within one another stand in a row here, at most as many as a stem has letters
    best = stems.filter(fit_).orderBy(F.desc(gain), F.length("stem"), "stem").limit(LEXICON * (STEM[1] - STEM[0] + 1)).collect()
    chosen: list[str] = []
    for row in best:
        if len(chosen) < LEXICON and not any(row["stem"].startswith(c) or c.startswith(row["stem"]) for c in chosen):
            chosen.append(row["stem"])
    return insults, frozenset(chosen)


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", limit: int = MAX_LABELLED,
) -> Model:
    """Lexicon and weights from labelled documents, about ``limit`` of them at most (a bounded sample).

    Rows with a null id or label are left out; an id with several labels counts as
    toxic if at least half of them are 1.  Without labels the grammar's own weights stay.
    """
    marked = (
        labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("double").alias("y"))
        .dropna()
        .groupBy("id")
        .agg((F.avg("y") >= 0.5).alias("toxic"))
    )
    known = marked.count()
    if known > limit:  # ids whose hash is below a bound: no sort and no single task
        part = int(limit / known * (1 << 30))
        marked = marked.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < part)
    # about ``limit`` small rows: safe to broadcast
    texts = docs.select(quoted(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = written(texts.join(F.broadcast(marked), "id").select("text", "toxic"), "labelled")
    insults, stems = lexicon(rows)
    width = len(KINDS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(insults, stems)
        for batch in batches:
            x = own.features(batch["text"])
            at = np.arange(len(x) + 1, dtype=np.int32) * width
            yield pa.record_batch({"x": pa.ListArray.from_arrays(at, pa.array(x.ravel())), "toxic": batch["toxic"]})

    measured = rows.mapInArrow(measure, "x array<double>, toxic boolean")
    # equal features add up: few rows whatever the sample
    got = measured.groupBy("x", "toxic").agg(F.count(F.lit(1)).alias("n")).toArrow()
    n = got["n"].to_numpy()
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    toxic = got["toxic"].to_numpy(zero_copy_only=False).astype(float)
    order = np.lexsort(np.column_stack([x, toxic]).T)
    x, toxic, n = x[order], toxic[order], n[order]
    return Model(insults, stems, fit(np.repeat(x, n, axis=0), np.repeat(toxic, n)))


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name``; a column of that name is replaced.

    Null and empty texts hold no clause and get the score of a text without attacks.
    """
    rest = docs.drop(name) if name in docs.columns else docs
    held = free_name(rest.columns, "text_to_score")
    schema = StructType([*rest.schema.fields, StructField(name, DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(model.insults, model.stems)
        for batch in batches:
            s = pa.array(model.score(own.features(batch.column(batch.num_columns - 1))))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, s], names=[*batch.schema.names[:-1], name])

    return rest.withColumn(held, text_or_empty(text_col)).mapInArrow(apply, schema)
