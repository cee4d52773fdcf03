"""Scenario documents read by byte ranges: one large JSON object is cut by many tasks.

A document is read as text records that end at ``}``, so that Spark can split a file
anywhere.  A range's effect on what the reader knows - inside a string or not, how
deep, and where the last separator of each depth stands - is a function of the
lexical state it begins in; functions compose, and a scan over a file's few functions
gives the state at the beginning of every range.  With it each task cuts the pieces
of the top-level members out of its own range, and only those pieces are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.text import col, cols
from wattloom.session import shared_folder

#: Bytes scanned at once.
CHUNK = 1 << 22

_QUOTE, _SLASH, _COMMA = b'"'[0], b"\\"[0], b","[0]
_STEP = np.zeros(256, np.int8)
_STEP[list(b"{[")] = 1
_STEP[list(b"}]")] = -1
_STRUCTURE = _STEP != 0
_STRUCTURE[_COMMA] = True


def structure(data: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of braces, brackets and commas outside strings, the depth after each (from 0),
    and whether the text ends inside a string.

    ``data`` begins after a ``}``, so its first character is never escaped.
    """
    at = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != _SLASH, at, -1))
    before = np.concatenate([[-1], other[:-1]])
    quote = (data == _QUOTE) & ((at - 1 - before) % 2 == 0)
    within = (np.cumsum(quote) + inside) % 2 == 1
    places = np.flatnonzero(_STRUCTURE[data] & ~within)
    return places, np.cumsum(_STEP[data[places]]), bool(within[-1]) if len(data) else inside


@dataclass
class Effect:
    """What a range does, for each lexical state it may begin in (outside, inside a string).

    ``ends`` and ``depth`` are the state after it and the change of depth; ``last`` has for
    each relative depth the position of its last separator (a comma, or the opening brace).
    """

    ends: list[int] = field(default_factory=lambda: [0, 1])
    depth: list[int] = field(default_factory=lambda: [0, 0])
    last: list[dict[int, tuple[int, int]]] = field(default_factory=lambda: [{}, {}])

    def then(self, other: Effect) -> Effect:
        out = Effect()
        for s in (0, 1):
            mid, shift = self.ends[s], self.depth[s]
            out.ends[s], out.depth[s] = other.ends[mid], shift + other.depth[mid]
            out.last[s] = {**self.last[s], **{d + shift: p for d, p in other.last[mid].items()}}
        return out

    @staticmethod
    def of(data: np.ndarray, block: int, shift: int) -> Effect:
        out = Effect()
        for s in (0, 1):
            places, depth, inside = structure(data, bool(s))
            out.ends[s], out.depth[s] = int(inside), int(depth[-1]) if len(depth) else 0
            kind = data[places]
            mark = (kind == _COMMA) | (_STEP[kind] == 1)
            levels, where = np.unique(depth[mark][::-1], return_index=True)
            found = places[mark][::-1][where]
            out.last[s] = {int(d): (block, shift + int(p)) for d, p in zip(levels, found)}
        return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """Chunks of whole records of one range, in order: ``(file, size, block, *keep), bytes``."""
    key, held, size = None, [], 0
    for batch in batches:
        records = batch.column(0).to_pylist()
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(1, batch.num_columns)]))
        for record, own in zip(records, keys):
            if own != key or size > CHUNK:
                if held:
                    yield key, b"".join(held)
                key, held, size = own, [], 0
            raw = (record or "").encode() + b"}"
            held.append(raw)
            size += len(raw)
    if held:
        yield key, b"".join(held)


EFFECT = "file string, size long, block long, bytes long, " + ", ".join(
    f"ends{s} int, depth{s} int, last{s} map<int,struct<block:long,at:long>>" for s in (0, 1)
)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: dict[tuple, tuple[Effect, int]] = {}
    for key, raw in _texts(batches):
        before, size = done.get(key[:3], (Effect(), 0))
        own = Effect.of(np.frombuffer(raw, np.uint8), key[2], size)
        done[key[:3]] = before.then(own), size + len(raw)
    rows = [
        {
            "file": f, "size": n, "block": b, "bytes": size,
            **{f"ends{s}": e.ends[s] for s in (0, 1)}, **{f"depth{s}": e.depth[s] for s in (0, 1)},
            **{f"last{s}": [(d, {"block": p[0], "at": p[1]}) for d, p in e.last[s].items()] for s in (0, 1)},
        }
        for (f, n, b), (e, size) in done.items()
    ]
    yield pa.RecordBatch.from_pylist(rows, schema=_EFFECT_ARROW)


_LAST = pa.map_(pa.int32(), pa.struct([("block", pa.int64()), ("at", pa.int64())]))
_EFFECT_ARROW = pa.schema(
    [("file", pa.string()), ("size", pa.int64()), ("block", pa.int64()), ("bytes", pa.int64())]
    + [(f"{n}{s}", t) for s in (0, 1) for n, t in (("ends", pa.int32()), ("depth", pa.int32()), ("last", _LAST))]
)

BEGIN = "file string, block long, inside int, depth int, key_block long, key_at long, cut int"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the beginning of every range of a file; an incomplete document is an error."""
    for batch in batches:
        for row in batch.to_pylist():
            out, total = [], Effect()
            ranges = sorted(row["ranges"], key=lambda r: r["block"])
            # records end at a brace; the last one may lack it, and gets no brace then
            extra = sum(r["bytes"] for r in ranges) - row["size"]
            for k, r in enumerate(ranges):
                own = Effect([r["ends0"], r["ends1"]], [r["depth0"], r["depth1"]])
                own.last = [{d: (p["block"], p["at"]) for d, p in r[f"last{s}"]} for s in (0, 1)]
                key = total.last[0].get(1, (-1, -1))
                cut = extra if k + 1 == len(ranges) else 0
                out.append(
                    {
                        "file": row["file"], "block": r["block"], "inside": total.ends[0], "depth": total.depth[0],
                        "key_block": key[0], "key_at": key[1], "cut": cut,
                    }
                )
                total = total.then(own)
            # a brace that was added changes the depth only outside of a string
            depth = total.depth[0] + (extra if total.ends[0] == 0 else 0)
            if extra not in (0, 1) or depth != 0 or total.ends[0] != 0 or 1 not in total.last[0]:
                raise ValueError(f"not a JSON object (document): {row['file']}")
            yield pa.RecordBatch.from_pylist(out, schema=_BEGIN_ARROW)


_BEGIN_ARROW = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("inside", pa.int32()), ("depth", pa.int32())]
    + [("key_block", pa.int64()), ("key_at", pa.int64()), ("cut", pa.int32())]
)


def _cut(keep: int):
    """The pieces of top-level members in each range."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple, list] = {}  # where the reader of a range is: inside, depth, key, bytes read
        for key, raw in _texts(batches):
            file, _, block, inside, depth, key_block, key_at, cut, *kept = key
            begun = (key_block, key_at) if depth else (-1, -1)
            state = at.setdefault((file, block), [bool(inside), depth, begun, 0, key_block >= 0])
            data = np.frombuffer(raw, np.uint8)
            places, after, now_inside = structure(data, state[0])
            after = after + state[1]
            kind = data[places]
            # members lie between the opening brace, the commas of depth 1 and the closing brace
            edge = ((kind == _COMMA) | (_STEP[kind] == 1)) & (after == 1) | (_STEP[kind] == -1) & (after == 0)
            closes = _STEP[kind[edge]] == -1
            opened = int((_STEP[kind[edge]] == 1).sum()) + state[4]
            if opened > 1:
                raise ValueError(f"more than one JSON object (document): {file}")
            stops = [*places[edge].tolist(), len(raw)]
            rows, start, own = [], 0, state[2]
            for i, stop in enumerate(stops):
                text = raw[start:stop]
                if own != (-1, -1):
                    if text:
                        rows.append((own, state[3] + start, text.decode()))
                else:  # only the brace that was added at the end may stand here
                    text = text.removesuffix(b"}") if cut and stop == len(raw) else text
                    if text.strip(b" \t\r\n\xef\xbb\xbf"):
                        raise ValueError(f"text outside the JSON object (document): {file}")
                if i + 1 < len(stops):
                    own = (-1, -1) if closes[i] else (block, state[3] + stop)
                start = stop + 1
            depth = int(after[-1]) if len(after) else state[1]
            at[file, block] = [now_inside, depth, own, state[3] + len(raw), bool(opened)]
            columns = [
                [file] * len(rows), [r[0][0] for r in rows], [r[0][1] for r in rows], [block] * len(rows),
                [r[1] for r in rows], [r[2] for r in rows], *[[v] * len(rows) for v in kept],
            ]
            names = ["file", "key_block", "key_at", "block", "at", "text", *[f"keep{i}" for i in range(keep)]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.string()] * keep]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return apply


def read_measure_texts(
    spark: SparkSession, paths: str | Sequence[str], out: str | None = None, keep: Sequence[str] = (),
    name: str = "scenario", range_bytes: int | None = None,
) -> DataFrame:
    """One row per top-level member but the last: ``scenario`` (the file's name), ``meas``, ``text``.

    The counterpart of ``read_documents`` and ``measure_objects`` for documents of any size: a
    file is read in ranges of ``range_bytes`` (the session's split size by default) by as
    many tasks, twice; one row stands for a member, none for a document.  The members are
    written to ``out`` (a new path in the shared folder by default), so that everything that is read
    from the documents starts from them.  ``keep`` names folder columns (as in
    ``scenario=x/``); with them ``scenario`` need not be the file's name.  A document that is
    not one complete JSON object fails the job.
    """
    # the split size is a session setting, and this one must not change the caller's
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        own.conf.set(key, spark.conf.get(key))
    if range_bytes:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
        own.conf.set("spark.sql.files.openCostInBytes", "0")
        own.conf.set("spark.sql.files.minPartitionNum", "1")
    if out is None:
        out = f"{shared_folder(spark)}/measures-{uuid.uuid4().hex}"
    records = own.read.option("lineSep", "}").text([paths] if isinstance(paths, str) else list(paths))
    records = records.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_name").alias("__name"), *cols(keep),
    )
    carried = ["__name", *keep]
    effects = records.select("value", "file", "size", "block").mapInArrow(_effects, EFFECT)
    parts = [f.name for f in T.StructType.fromDDL(EFFECT).fields if f.name not in ("file", "size")]
    files = effects.groupBy("file", "size").agg(F.collect_list(F.struct(*parts)).alias("ranges"))
    begins = files.mapInArrow(_scan, BEGIN)
    # one row a range, some 60 bytes for each 128 MB of documents; records keep their order in this join
    known = records.join(F.broadcast(begins), ["file", "block"]).select(
        "value", "file", "size", "block", "inside", "depth", "key_block", "key_at", "cut",
        *[col(k).cast("string") for k in carried],
    )
    kept = [f"keep{i}" for i in range(len(carried))]
    schema = "file string, key_block long, key_at long, block long, at long, text string" + "".join(
        f", {k} string" for k in kept
    )
    pieces = known.mapInArrow(_cut(len(carried)), schema)
    member = ["file", "key_block", "key_at"]
    whole = pieces.groupBy(*member, *kept).agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "text"))).alias("pieces")
    ).select(*member, *kept, F.array_join("pieces.text", "").alias("text"))
    whole = whole.filter(F.trim("text") != "")
    ends = whole.groupBy("file").agg(F.max(F.struct("key_block", "key_at")).alias("end"))
    last = (F.col("key_block") == F.col("end.key_block")) & (F.col("key_at") == F.col("end.key_at"))
    stem = F.regexp_replace(F.col(kept[0]), r"\.[^.]*$", "")
    named = [F.col(k).alias(n) for k, n in zip(kept[1:], keep)]
    if name not in keep:
        named = [stem.alias(name), *named]
    object_ = F.concat(F.lit("{"), F.col("text"), F.lit("}"))
    single = F.from_json(object_, "map<string,string>")
    bad = F.raise_error(F.concat(F.lit("not a member of a JSON object: "), F.substring("text", 1, 200)))
    sure = F.when(F.size(single) == 1, single).otherwise(bad.cast("map<string,string>"))
    members = whole.join(ends, "file").filter(~last).select(*named, F.explode(sure).alias("meas", "text"))
    members.write.mode("errorifexists").parquet(out)
    return spark.read.schema(members.schema).parquet(out)
