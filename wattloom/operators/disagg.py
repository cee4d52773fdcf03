"""Annual state totals -> places -> hours."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wattloom.functions.numbers import is_number, non_negative
from wattloom.functions.text import col, cols
from wattloom.operators import vectors
from wattloom.operators.joins import join_null_safe
from wattloom.operators.mapping import melt
from wattloom.operators.shapes import HOUR
from wattloom.operators.shares import sum_by

STAGES = {"original_ann": "original_ann", "measure_ann": "measure_ann"}
SHAPE_STAGES = {"original_ts": "original_ann", "measure_ts": "measure_ann"}


def stage_groups(
    measure_map: DataFrame, ids: Sequence[str] = ("meas", "end_use", "sector")
) -> DataFrame:
    """(measure, end use, stage) -> annual group, from the two map columns."""
    return melt(measure_map, ids, STAGES, "tech_stage", "group_ann")


def stage_shapes(
    measure_map: DataFrame, ids: Sequence[str] = ("meas", "end_use")
) -> DataFrame:
    """(measure, end use, stage) -> hourly shape."""
    return melt(measure_map, ids, SHAPE_STAGES, "tech_stage", "shape_ts")


def disaggregate_annual(
    projection: DataFrame,
    groups: DataFrame,
    multipliers: DataFrame,
    region: str = "reg",
    state: str = "in.state",
    value: str = "state_ann_kwh",
    match: Sequence[str] = ("end_use", "fuel"),
    result: str = "county_ann_kwh",
) -> DataFrame:
    """State kWh x geographic multiplier, for every place of the state.

    ``groups`` is the melted measure map; ``match`` are the extra equality keys
    between projection and multipliers (leave out ``fuel`` for multipliers that
    have none).
    """
    if "sector" in groups.columns:
        projection = projection.drop("sector")  # the map's sector is the one used
    mapped = projection.join(groups, ["meas", "end_use", "tech_stage"], "inner")
    detail = multipliers.drop("sector").withColumnRenamed(state, region)
    out = mapped.join(detail, ["group_ann", region, *match], "inner")
    return (
        out.withColumn(result, col(value) * col("multiplier_annual"))
        .withColumnRenamed(region, state)
        .drop("group_ann")
    )


@dataclass(frozen=True)
class HourTotals:
    """Sums over the hours of a result key: by columns, with weights, both taken from the hour.

    ``by`` and the weights are expressions over the hour and NULL where the hour is; a sum
    without a weight is of the hourly values themselves.
    """

    by: Mapping[str, Column]
    count: str = "n_hours"
    sums: Mapping[str, Column | None] = field(default_factory=dict)

    def of(self, hourly: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
        """The totals of a table that has one row for each of ``keys``, hour and sector."""
        named = [expr.alias(n) for n, expr in self.by.items()]
        return hourly.groupBy(*cols(keys), *named, "sector").agg(
            F.count(F.lit(1)).alias(self.count),
            *[F.sum(col(value) if w is None else col(value) * w).alias(n) for n, w in self.sums.items()],
        )


def disaggregate_hourly(
    annual: DataFrame,
    shapes: DataFrame,
    multipliers: DataFrame,
    place: Sequence[str],
    carry: Sequence[str] = ("in.county", "in.state", "year", "turnover", "run_id"),
    match: Sequence[str] = ("end_use", "fuel"),
    value: str = "county_ann_kwh",
    result: str = "county_hourly_uncal_kwh",
    keep_unmatched: bool = True,
    group: bool = True,
    hour_blocks: int = 1,
    totals: HourTotals | None = None,
) -> DataFrame:
    """Place kWh x hourly multiplier, summed over measures and stages.

    Rows are pre-summed by shape before they meet 8,760 hours, and shapes the
    map does not name never leave the multiplier scan.  After the pre-sum both sides hold at
    most one row per key and hour, so no key can be larger than the calendar
    allows.  Both sides are clustered on (place, match), a subset of the join
    keys that is also a subset of the result keys: the exploded product is
    summed in the task that makes it and only the two inputs are shuffled.
    ``hour_blocks`` > 1 spreads one place's year over several tasks; of a place outside the
    result, the result keys are dealt instead and the year is worked off block by block
    (``_dealt_products``).

    With ``keep_unmatched`` a place row without a shape keeps one NULL hour.  With
    ``totals`` the result has the sums over the hours; dealt products take them from the
    hours they have just made.
    """
    if totals is not None and not group:
        raise ValueError("totals are of grouped hours")
    result_keys = list(dict.fromkeys([*carry, *match]))
    keys = list(dict.fromkeys([*place, *result_keys, "shape_ts"]))
    cluster = list(dict.fromkeys([*place, *match]))
    on = [*cluster, "shape_ts"]
    stage = ["meas", "end_use", "tech_stage"]
    outside = [c for c in cluster if c not in result_keys]
    dealt = bool(outside) and group and hour_blocks > 1
    annual = annual.filter(is_number(col(value)))
    if dealt:
        return _dealt_products(
            annual, shapes, multipliers, stage, cluster, result_keys, value, result, hour_blocks, keep_unmatched, totals
        )
    mapped = annual.join(shapes, stage, "inner").select(*cols([*keys, value]))
    if not outside:  # a place's few rows are shuffled once, for the sum and for the join
        mapped = mapped.repartition(*cols(cluster))
    presummed = sum_by(mapped, keys, {value: col(value)})
    used = shapes.select("shape_ts", "end_use").distinct()
    hours = (
        multipliers.filter(non_negative(col("multiplier_hourly")))
        .join(used, ["shape_ts", "end_use"], "left_semi")
        .select(*cols([*on, HOUR, "sector", "multiplier_hourly"]))
    )
    out_keys = [*result_keys, HOUR, "sector"]
    if hour_blocks > 1:
        by_block = [*cluster, "__block"]
        # Only rows that meet hours are copied to the blocks; the others stay one row, in block -1.
        held = hours.select(*cols(on)).distinct().repartition(*cols(cluster)).withColumn("__held", F.lit(True))
        blocks = F.sequence(F.lit(0), F.lit(hour_blocks - 1))
        left = presummed.join(held, on, "left" if keep_unmatched else "inner").withColumn(
            "__block", F.explode(F.when(col("__held"), blocks).otherwise(F.array(F.lit(-1))))
        )
        right = hours.withColumn("__block", _block(hour_blocks))
        matched = left.drop("__held").repartition(*cols(by_block)).join(
            right.repartition(*cols(by_block)),
            [*on, "__block"],
            "left" if keep_unmatched else "inner",
        )
        # a block may lack the hours that another one has
        matched = matched.filter((col("__block") < 0) | col("multiplier_hourly").isNotNull())
        extra = ["__block"]  # a function of the hour: never splits a result row
    else:
        left = presummed.repartition(*cols(cluster)) if outside else presummed
        matched = left.join(
            hours.repartition(*cols(cluster)),
            on,
            "left" if keep_unmatched else "inner",
        )
        extra = []
    product = matched.withColumn(result, col(value) * col("multiplier_hourly"))
    if not group:
        return product.select(*cols([*out_keys, "shape_ts", result]))
    # Grouping by all clustering columns needs no exchange.
    out = sum_by(product, [*outside, *extra, *out_keys], {result: col(result)})
    if outside:
        # A place key that is not in the result (the weather place behind a
        # county) may split a result row: add the few partial sums up.
        out = sum_by(out, out_keys, {result: col(result)})
    out = out.select(*cols([*out_keys, result]))
    return out if totals is None else totals.of(out, result_keys, result)


#: Energy rows of a place that one product takes; a place with more has several.
ENERGY_ROWS = 4_096
#: Rows of energy sums that a task holds while it cuts pieces.
HELD_ROWS = 1 << 17
#: Shapes of one row of energy sums.
SLOTS = 8


def _dealt_products(
    annual: DataFrame,
    shapes: DataFrame,
    multipliers: DataFrame,
    stage: Sequence[str],
    cluster: Sequence[str],
    result_keys: Sequence[str],
    value: str,
    result: str,
    blocks: int,
    keep_unmatched: bool,
    totals: HourTotals | None,
) -> DataFrame:
    """Hours of places that stand behind many result keys (a weather place and its counties).

    Shapes are numbered within their end use.  Energy rows are shuffled once, by result key; a
    task sums them by shape, ``SLOTS`` shapes in a row, and cuts them into pieces of one
    place, end use and fuel.  A piece meets the place's year as one row, and the sum over
    shapes is a product of energy by shape and shapes by hour, one block of the year after
    the other.  Only result keys behind several places have partial sums, which are added
    up; the others leave the product complete, as hours or as totals of hours.
    """
    outside = [c for c in cluster if c not in result_keys]
    inner = [c for c in result_keys if c not in cluster]
    kind = multipliers.schema[HOUR].dataType
    types = {f.name: f.dataType for f in annual.schema.fields}
    among = Window.partitionBy(*cols([n for n in ("end_use",) if n in cluster]))
    numbered = shapes.withColumn("__shape", F.dense_rank().over(among.orderBy("shape_ts")) - 1)
    plain = {n: f"r{i}" for i, n in enumerate(result_keys)}  # dotted names cannot pass
    plain |= {n: f"o{i}" for i, n in enumerate(outside)}
    own = [plain[n] for n in result_keys]
    texts = [c for n, c in plain.items() if isinstance(types[n], T.StringType)]
    others = [c for c in plain.values() if c not in texts]
    mapped = annual.join(numbered, stage, "inner").select(
        F.xxhash64(*cols(result_keys)).alias("hash"), *[col(n).alias(c) for n, c in plain.items()],
        F.floor(col("__shape") / SLOTS).cast("int").alias("deck"), (col("__shape") % SLOTS).alias("slot"),
        col(value).cast("double").alias("kwh"),
    )
    sums = [F.sum(F.when(col("slot") == i, col("kwh"))).alias(f"s{i}") for i in range(SLOTS)]
    summed = mapped.repartition("hash").groupBy("hash", *plain.values(), "deck").agg(*sums)
    # Spark leaves the second exchange out, as the sum keeps the first one's; texts and sums
    # travel as one array each, which costs Arrow less than columns
    rows = summed.repartition("hash").select(
        "hash", F.array(*texts).alias("texts"), *others, "deck", F.array(*[f"s{i}" for i in range(SLOTS)]).alias("kwh")
    ).sortWithinPartitions("hash")
    lists = {
        **{plain[n]: types[n] for n in inner}, "line": T.IntegerType(), "shape": T.IntegerType(), "kwh": T.DoubleType()
    }
    schema = T.StructType(
        [
            *[T.StructField(plain[n], types[n]) for n in cluster],
            T.StructField("several", T.BooleanType()),
            *[T.StructField(n, T.ArrayType(t)) for n, t in lists.items()],
        ]
    )
    pieces = rows.mapInArrow(
        _pieces(texts, own, [plain[n] for n in outside], [plain[n] for n in cluster], [plain[n] for n in inner]), schema
    )
    by, weights = ([], []) if totals is None else (list(totals.by.values()), list(totals.sums.values()))
    point = F.struct(
        _block(blocks).alias("block"),
        col("__shape").alias("shape"),
        "sector",
        F.unix_micros(col(HOUR).cast("timestamp")).alias("hour"),
        col("multiplier_hourly").alias("share"),
        *[expr.alias(f"by{i}") for i, expr in enumerate(by)],
        *[w.cast("double").alias(f"w{i}") for i, w in enumerate(weights) if w is not None],
    )
    used = numbered.select("shape_ts", "end_use", "__shape").distinct()
    hours = multipliers.filter(non_negative(col("multiplier_hourly"))).join(used, ["shape_ts", "end_use"], "inner")
    series = hours.groupBy(*[col(n).alias(plain[n]) for n in cluster]).agg(F.collect_list(point).alias("series"))
    on = [plain[n] for n in cluster]
    pieces = pieces.repartition(*on)
    here = F.spark_partition_id() >= 0  # always so; keeps the filters behind the exchange, which both share
    several, single = (pieces.filter(F.when(here, test)) for test in (col("several"), ~col("several")))
    fields = [T.StructField(plain[n], types[n]) for n in result_keys]
    sector = T.StructField("sector", T.StringType())
    values = T.ArrayType(T.StructType([T.StructField("hour", T.LongType()), T.StructField("value", T.DoubleType())]))
    names = [col(c).alias(n) for n, c in plain.items() if n in result_keys]

    def meet(some: DataFrame) -> DataFrame:
        met = some.join(series, on, "left" if keep_unmatched else "inner")
        return met.select(*cols(on), *lists, "series")

    def hourly(some: DataFrame) -> DataFrame:
        made = T.StructType([*fields, sector, T.StructField("hours", values)])
        out = meet(some).mapInArrow(_piece_hours(own, on, keep_unmatched), made)
        out = out.select(*own, "sector", F.inline("hours"))
        hour = F.timestamp_micros(col("hour")).cast(kind).alias(HOUR)
        return out.select(*names, hour, "sector", col("value").alias(result))

    shared = sum_by(hourly(several), [*result_keys, HOUR, "sector"], {result: col(result)})
    if totals is None:
        return hourly(single).unionByName(shared)
    made = T.StructType(
        [
            *fields,
            sector,
            T.StructField("hour", T.LongType()),
            T.StructField("n", T.LongType()),
            *[T.StructField(f"v{i}", T.DoubleType()) for i in range(len(weights))],
        ]
    )
    weighted = [w is not None for w in weights]
    out = meet(single).mapInArrow(_piece_totals(own, on, keep_unmatched, len(by), weighted), made)
    out = out.select(
        *names,
        F.timestamp_micros(col("hour")).cast(kind).alias(HOUR),
        "sector",
        col("n").alias(totals.count),
        *[col(f"v{i}").alias(n) for i, n in enumerate(totals.sums)],
    )
    out = out.select(
        *cols(result_keys), *[expr.alias(n) for n, expr in totals.by.items()], "sector",
        *cols([totals.count, *totals.sums]),
    )
    return out.unionByName(totals.of(shared, result_keys, result))


def _codes(columns: Sequence[pa.Array], n: int) -> np.ndarray:
    """A number below ``n`` for each combination of values; NULLs are equal."""
    encoded = [c.dictionary_encode() for c in columns]
    return _combined([c.indices.fill_null(len(c.dictionary)).to_numpy(zero_copy_only=False) for c in encoded], n)


def _combined(codes: Sequence[np.ndarray], n: int) -> np.ndarray:
    code, kinds = np.zeros(n, np.int64), 1
    for own in codes:
        present = np.bincount(own) > 0
        code = code * int(present.sum()) + (present.cumsum() - 1)[own]
        kinds *= int(present.sum())
        if kinds > n:
            found, code = np.unique(code, return_inverse=True)
            code, kinds = code.ravel(), len(found)
    return code


class _Coded:
    """The key columns of energy rows as numbers and the values that these stand for."""

    def __init__(self, rows: pa.RecordBatch, texts: Sequence[str], names: Sequence[str]):
        flat = rows.column("texts").flatten().cast(pa.string()).dictionary_encode()
        every = flat.indices.fill_null(len(flat.dictionary)).to_numpy(zero_copy_only=False).reshape(len(rows), len(texts))
        value = pa.concat_arrays([flat.dictionary, pa.nulls(1, pa.string())])
        self.code = {c: every[:, i] for i, c in enumerate(texts)}
        self.value = dict.fromkeys(texts, value)
        for c in names:
            if c not in self.code:
                own = rows.column(c).dictionary_encode()
                self.code[c] = own.indices.fill_null(len(own.dictionary)).to_numpy(zero_copy_only=False)
                self.value[c] = pa.concat_arrays([own.dictionary, pa.nulls(1, own.dictionary.type)])

    def combined(self, names: Sequence[str], n: int) -> np.ndarray:
        return _combined([self.code[c] for c in names], n)

    def take(self, name: str, rows: np.ndarray) -> pa.Array:
        return self.value[name].take(pa.array(self.code[name][rows]))


def _pieces(texts: Sequence[str], own: Sequence[str], outside: Sequence[str], cluster: Sequence[str], inner: Sequence[str]):
    """Sums sorted by ``hash`` of the result key -> pieces: one cluster's result keys and their energies.

    A result key's energies of one cluster are never in two pieces.  ``several`` are the
    result keys that stand behind more than one place.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, HELD_ROWS
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n < enough:
                continue
            whole = _joined(held)
            code = whole.column("hash").to_numpy()
            last = int(np.searchsorted(code, code[-1]))
            if last:  # rows of the last result key may follow
                yield cut(whole.slice(0, last))
            held, n = [whole.slice(last)], n - last
            enough = max(HELD_ROWS, 2 * n)
        if n:
            yield cut(_joined(held))

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = len(rows)
        hashed = rows.column("hash").to_numpy()
        coded = _Coded(rows, texts, [*own, *outside])
        key = coded.combined(own, n)
        # rows of one result key in a row, also where several result keys have one hash
        mixed = ((key[1:] != key[:-1]) & (hashed[1:] == hashed[:-1])).any()
        order = np.lexsort((key, hashed)) if mixed else np.arange(n)
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        run = np.empty(n, np.int64)
        run[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
        place = coded.combined(outside, n)[order]
        several = np.minimum.reduceat(place, starts) != np.maximum.reduceat(place, starts)
        sums = rows.column("kwh").flatten()
        there = np.flatnonzero(sums.is_valid().to_numpy(zero_copy_only=False))
        order, shape = np.divmod(there, len(sums) // n)
        shape += rows.column("deck").to_numpy()[order].astype(np.int64) * (len(sums) // n)
        code = coded.combined(cluster, n) * 2 + several[run]
        turn = np.lexsort((shape, (code * len(starts) + run)[order]))
        order, shape, kwh = order[turn], shape[turn], sums.to_numpy(zero_copy_only=False)[there[turn]]
        code, run, n = code[order], run[order], len(order)
        at = np.arange(n)
        new, line = np.ones(n, bool), np.ones(n, bool)  # where a cluster and where a result key in it begin
        new[1:] = code[1:] != code[:-1]
        line[1:] = new[1:] | (run[1:] != run[:-1])
        begin = np.maximum.accumulate(np.where(line, at, 0)) - np.maximum.accumulate(np.where(new, at, 0))
        deal = begin // ENERGY_ROWS
        new[1:] |= deal[1:] != deal[:-1]
        firsts, heads = np.flatnonzero(new), np.flatnonzero(line)
        number = line.cumsum() - 1
        number -= number[firsts][new.cumsum() - 1]
        ends = pa.array(np.append(firsts, n).astype(np.int32))
        of_key = pa.array(np.append(np.searchsorted(heads, firsts), len(heads)).astype(np.int32))

        def listed(offsets: pa.Array, values) -> pa.ListArray:
            return pa.ListArray.from_arrays(offsets, values if isinstance(values, pa.Array) else pa.array(values))

        return pa.RecordBatch.from_arrays(
            [
                *[coded.take(c, order[firsts]) for c in cluster],
                pa.array((code[firsts] % 2).astype(bool)),
                *[listed(of_key, coded.take(c, order[heads])) for c in inner],
                listed(ends, number.astype(np.int32)),
                listed(ends, shape.astype(np.int32)),
                listed(ends, kwh),
            ],
            names=[*cluster, "several", *inner, "line", "shape", "kwh"],
        )

    return apply


def _joined(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    columns = [pa.concat_arrays(list(c)) for c in zip(*[b.columns for b in batches])]
    return pa.RecordBatch.from_arrays(columns, names=batches[0].schema.names)


class _Year:
    """A place's year: for each block the matrices of its shapes by hour, one for each sector.

    With ``n_by`` columns hours are grouped; the slots of a block come group by group.
    """

    def __init__(self, batch: pa.RecordBatch, n_by: int = 0):
        series = batch.column("series").flatten()
        n = len(series)
        self.series = series
        self.shapes, self.shape = np.unique(series.field("shape").to_numpy(zero_copy_only=False), return_inverse=True)
        sector = series.field("sector").dictionary_encode()
        self.none = len(sector.dictionary)  # the sector of energy without a series
        self.sectors = pa.concat_arrays([sector.dictionary.cast(pa.string()), pa.nulls(1, pa.string())])
        self.sector = sector.indices.fill_null(self.none).to_numpy(zero_copy_only=False).astype(np.int64)
        hour = series.field("hour")
        self.dated = np.append(hour.is_valid().to_numpy(zero_copy_only=False), False)
        self.hour = np.append(hour.fill_null(0).to_numpy(zero_copy_only=False), 0)
        group = _codes([series.field(f"by{i}") for i in range(n_by)], n)
        self.groups = int(group.max(initial=-1)) + 2  # the last one: energy without a series
        undated = np.flatnonzero(~self.dated[:-1])
        #: The last point stands for the hour of energy without a series.
        self.group = np.append(group, group[undated[0]] if len(undated) else self.groups - 1)
        block = series.field("block").to_numpy(zero_copy_only=False)
        share = series.field("share").to_numpy(zero_copy_only=False)
        self.blocks = [self._block(b, np.flatnonzero(block == b), share) for b in sorted({0, *np.unique(block).tolist()})]

    def _block(self, block: int, at: np.ndarray, share: np.ndarray):
        """A point of each slot, the slot without an hour, and the matrices by sector."""
        at = at[np.lexsort((self.hour[at], ~self.dated[at], self.group[at]))]
        dated, hour = self.dated[at], self.hour[at]
        new = np.ones(len(at), bool)
        new[1:] = (dated[1:] != dated[:-1]) | (dated[1:] & (hour[1:] != hour[:-1]))
        slot, first = new.cumsum() - 1, at[new]
        unknown = np.flatnonzero(~self.dated[first])
        if block == 0 and not len(unknown):
            unknown, first = np.array([len(first)]), np.append(first, len(self.hour) - 1)
        size, kinds = len(first), max(1, len(self.shapes))
        lines, line = np.unique(self.sector[at] * kinds + self.shape[at], return_inverse=True)
        cell = line.ravel() * size + slot
        matrix = np.bincount(cell, share[at], len(lines) * size).reshape(-1, size)
        there = np.bincount(cell, minlength=len(lines) * size).reshape(-1, size) > 0
        sector, shape = np.divmod(lines, kinds)
        parts = {}
        for s in range(self.none + 1):
            some = sector == s
            if some.any() or (block == 0 and s == self.none):
                parts[s] = shape[some], matrix[some], there[some]
        return first, unknown if block == 0 else unknown[:0], parts, bool(np.isfinite(matrix).all())

    def hours_at(self, points: np.ndarray) -> pa.Array:
        return pa.array(self.hour[points], pa.int64(), mask=~self.dated[points])


class _Piece:
    """A piece that meets a year: energy by shape of its lines, and the lines' patterns.

    A pattern says which shapes a line has energy of; its last place stands for shapes that
    the year does not have.
    """

    def __init__(self, batch: pa.RecordBatch, year: _Year, keys: Sequence[str], keep_unmatched: bool):
        self.batch, self.year = batch, year
        self.keys = {n: batch.column(n).flatten() for n in keys}
        line, shape, energy = (batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in ("line", "shape", "kwh"))
        n, kinds = int(line.max(initial=-1)) + 1, len(year.shapes)
        column = np.searchsorted(year.shapes, shape)
        column[np.append(year.shapes, -1)[column] != shape] = kinds
        cell = line.astype(np.int64) * (kinds + 1) + column
        kwh = np.bincount(cell, energy, n * (kinds + 1)).reshape(n, -1)
        has = np.bincount(cell, minlength=n * (kinds + 1)).reshape(n, -1) > 0
        has[:, -1] &= keep_unmatched
        self.kwh, self.plain = kwh[:, :-1], bool(np.isfinite(kwh[:, :-1]).all())
        packed = np.ascontiguousarray(np.packbits(has, axis=1))
        _, first, of_line = np.unique(packed.view(f"V{packed.shape[1]}").ravel(), return_index=True, return_inverse=True)
        self.pattern, self.patterns = of_line.ravel(), has[first]

    def held(self, shape: np.ndarray, there: np.ndarray, lost: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The slots that a pattern's lines have, and those of them with a value."""
        known = (self.patterns[:, shape].astype(np.float32) @ there.astype(np.float32)) > 0
        if lost is None:
            return known, known
        held = known.copy()
        held[np.ix_(self.patterns[:, -1], lost)] = True
        return held, known

    def values(self, lines, shape: np.ndarray, matrix: np.ndarray, there: np.ndarray, finite: bool) -> np.ndarray:
        energy = self.kwh[lines][:, shape]
        if finite and self.plain:
            return energy @ matrix
        out = np.zeros((len(energy), matrix.shape[1]))
        for k in range(len(shape)):  # nothing is multiplied where a shape has no hour
            has = self.patterns[self.pattern[lines], shape[k]]
            out += np.where(has[:, None] & there[k], energy[:, k : k + 1] * matrix[k], 0.0)
        return out

    def columns(self, own: Sequence[str], lines: np.ndarray) -> list[pa.Array]:
        """The result keys of lines: of their own, or of the piece."""
        to, same = pa.array(lines), pa.array(np.zeros(len(lines), np.int64))
        return [self.keys[n].take(to) if n in self.keys else self.batch.column(n).take(same) for n in own]


def _met(
    batches: Iterator[pa.RecordBatch], on: Sequence[str], keys: Sequence[str], keep_unmatched: bool, n_by: int = 0
) -> Iterator[_Piece]:
    """The pieces one by one; a year is made once for pieces of one cluster in a row."""
    key, year = None, None
    for whole in batches:
        for k in range(len(whole)):
            batch = whole.slice(k, 1)
            own = tuple(batch.column(n)[0].as_py() for n in on)
            if year is None or own != key:
                key, year = own, _Year(batch, n_by)
            yield _Piece(batch, year, keys, keep_unmatched)


def _piece_hours(own: Sequence[str], on: Sequence[str], keep_unmatched: bool):
    """For each piece and block: the hours of its result keys, as lists."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _met(batches, on, [n for n in own if n not in on], keep_unmatched):
            year = piece.year
            for first, unknown, parts, finite in year.blocks:
                made = []
                for s, (shape, matrix, there) in parts.items():
                    held, known = piece.held(shape, there, unknown if s == year.none else None)
                    for number in np.flatnonzero(held.any(axis=1)):
                        lines, slots = np.flatnonzero(piece.pattern == number), np.flatnonzero(held[number])
                        out = piece.values(lines, shape, matrix[:, slots], there[:, slots], finite)
                        made.append(rows(piece, s, lines, first[slots], out, known[number, slots]))
                if made:
                    yield _joined(made)

    def rows(piece: _Piece, sector: int, lines, points, out, known) -> pa.RecordBatch:
        n = len(lines)
        hours = pa.StructArray.from_arrays(
            [piece.year.hours_at(np.tile(points, n)), pa.array(out.ravel(), mask=np.tile(~known, n))],
            names=["hour", "value"],
        )
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(points))
        return pa.RecordBatch.from_arrays(
            [
                *piece.columns(own, lines),
                piece.year.sectors.take(pa.array(np.full(n, sector))),
                pa.ListArray.from_arrays(ends, hours),
            ],
            names=[*own, "sector", "hours"],
        )

    return apply


def _piece_totals(own: Sequence[str], on: Sequence[str], keep_unmatched: bool, n_by: int, weighted: Sequence[bool]):
    """For each piece: its hours as in ``_piece_hours``, added up by their ``by`` columns.

    A row has an hour that stands for its group, the number of hours, and the sums.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _met(batches, on, [n for n in own if n not in on], keep_unmatched, n_by):
            made = [totals(piece, s) for s in range(piece.year.none + 1)]
            made = [batch for batch in made if batch is not None]
            if made:
                yield _joined(made)

    def totals(piece: _Piece, sector: int) -> pa.RecordBatch | None:
        year, n = piece.year, len(piece.kwh)
        stands = np.full(year.groups, -1)
        count = np.zeros((len(piece.patterns), year.groups), np.int64)
        sums = [(np.zeros((n, year.groups)), np.zeros(count.shape, bool)) for _ in weighted]
        for first, unknown, parts, finite in year.blocks:
            if sector not in parts:
                continue
            shape, matrix, there = parts[sector]
            held, known = piece.held(shape, there, unknown if sector == year.none else None)
            if not held.any():
                continue
            out = piece.values(slice(None), shape, matrix, there, finite)  # every hour of every line
            starts = np.flatnonzero(np.diff(year.group[first], prepend=-1))
            to = year.group[first][starts]
            stands[to] = first[starts]
            count[:, to] += np.add.reduceat(held, starts, axis=1, dtype=np.int64)
            for i, (total, real) in enumerate(sums):
                values, has = out, known
                if weighted[i]:
                    weight = year.series.field(f"w{i}")
                    valid = np.append(weight.is_valid().to_numpy(zero_copy_only=False), False)[first]
                    weight = np.append(weight.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0)[first]
                    has = known & valid
                    values = out * weight if valid.all() else np.where(valid, out * weight, 0.0)
                total[:, to] += np.add.reduceat(values, starts, axis=1)
                real[:, to] |= np.logical_or.reduceat(has, starts, axis=1)
        lines, group = np.nonzero(count[piece.pattern])
        if not len(lines):
            return None
        pattern = piece.pattern[lines]
        return pa.RecordBatch.from_arrays(
            [
                *piece.columns(own, lines),
                year.sectors.take(pa.array(np.full(len(lines), sector))),
                year.hours_at(stands[group]),
                pa.array(count[pattern, group]),
                *[pa.array(total[lines, group], mask=~real[pattern, group]) for total, real in sums],
            ],
            names=[*own, "sector", "hour", "n", *[f"v{i}" for i in range(len(weighted))]],
        )

    return apply


def _block(blocks: int) -> Column:
    """The block of an hour; rows without an hour are in the first one."""
    return F.coalesce(F.pmod(F.dayofyear(col(HOUR)), F.lit(blocks)), F.lit(0)).cast("int")


def annual_variant(
    projection: DataFrame,
    groups: DataFrame,
    multipliers: DataFrame,
    fuel: str | None = "Electric",
    **names: str,
) -> DataFrame:
    """One fuel only, multipliers without a fuel key."""
    kept = projection if fuel is None else projection.filter(col("fuel") == fuel)
    return disaggregate_annual(kept, groups, multipliers, match=("end_use",), **names)


def hourly_totals_by_kind(
    hourly: DataFrame,
    keys: Sequence[str],
    tag: str = "kind",
    value: str = "county_hourly_kwh",
    result: str = "state_hourly_kwh",
) -> DataFrame:
    """Totals of every tagged what-if variant in one aggregation."""
    return hourly.groupBy(*cols([*keys, tag])).agg(F.sum(col(value)).alias(result))


def combination_totals(
    hourly: DataFrame,
    combinations: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    value: str = "county_hourly_kwh",
    result: str = "state_monthly_kwh",
    tag: str = "kind",
) -> DataFrame:
    """Totals per combination of kinds; a kind may feed several combinations.

    The kinds are summed first; only the sums are copied to the combinations.
    """
    summed = hourly.groupBy(*cols([*keys, tag])).agg(F.sum(col(value)).alias(result))
    entries = F.filter(
        F.array(
            *[
                F.when(col(tag).isin(*kinds), F.lit(name))
                for name, kinds in combinations.items()
            ]
        ),
        lambda c: c.isNotNull(),
    )
    tagged = summed.withColumn("__combination", F.explode(entries))
    return tagged.select(
        *cols(keys), col("__combination").alias(tag), col(result)
    )
