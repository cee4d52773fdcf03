"""Hourly multipliers as one vector a year: place, shape and fuel in one row.

A year is an array with one element for each hour of a ``Calendar`` and a last one for
rows whose hour is not known; an hour without a value is NULL.  Shares are taken
inside the array, and places are disaggregated by one matrix product for each place,
end use and fuel: energy by shape times shapes by hour.  Nothing is joined on hours, and
hours become rows only where a table is written (``hour_rows``).

Where few hours of the year have readings, ``sparse`` holds only those: ``hours`` is then a
struct of two arrays, ``slots`` and ``values``, that grows with the readings and not with the
calendar.  Both forms give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.numbers import is_number, non_negative, safe_ratio
from wattloom.functions.text import col, cols
from wattloom.operators.shapes import HOUR
from wattloom.operators.shares import Target, sum_by

VECTOR = "hours"
#: Energy rows of a place that one matrix product takes; a place with more has several.
ENERGY_ROWS = 4_096
#: Numbers that the vectors of one matrix hold, but for a single place with more.
MATRIX = 1 << 22


@dataclass(frozen=True)
class Calendar:
    """``hours`` consecutive hours from ``start`` (a timestamp text, UTC)."""

    start: str
    hours: int = 8_784

    def slot(self, hour: Column) -> Column:
        """Place of an hour in the array; an unknown hour has the last one.

        An hour that is not a whole one, or outside the calendar, fails the job.
        """
        seconds = F.unix_seconds(hour.cast("timestamp")) - F.unix_seconds(F.lit(self.start).cast("timestamp"))
        at = F.floor(seconds / 3600)
        bad = F.raise_error(F.concat(F.lit("hour outside the calendar: "), hour.cast("string")))
        good = (at >= 0) & (at < self.hours) & (F.pmod(seconds, F.lit(3600)) == 0)
        return F.when(hour.isNull(), self.hours).when(good, at).otherwise(bad.cast("int")).cast("int")

    def hour(self, slot: Column) -> Column:
        start = F.unix_seconds(F.lit(self.start).cast("timestamp"))
        stamp = F.timestamp_seconds(start + slot.cast("long") * 3600)
        return F.when(slot < self.hours, stamp)


def calendar_of(hourly: DataFrame, hour: str = HOUR) -> Calendar:
    """The calendar from the first to the last hour of a table (one small aggregate)."""
    row = hourly.agg(
        F.min(col(hour)).cast("string").alias("first"),
        ((F.unix_seconds(F.max(col(hour))) - F.unix_seconds(F.min(col(hour)))) / 3600).alias("n"),
    ).first()
    return Calendar(row["first"] or "1970-01-01 00:00:00", int(row["n"] or 0) + 1)


def _points(slot: Column, value: Column) -> Column:
    return F.collect_list(F.struct(slot.alias("slot"), value.alias("value")))


def _dense(df: DataFrame, size: int, points: str = "__points", result: str = VECTOR) -> DataFrame:
    """The lists of ``(slot, value)`` as arrays of ``size``; values of one slot add up."""
    kept = [f for f in df.schema.fields if f.name != points]
    schema = T.StructType([*kept, T.StructField(result, T.ArrayType(T.DoubleType()))])
    plain = [col(f.name).alias(f"c{i}") for i, f in enumerate(kept)]  # dotted names cannot pass

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, column = len(batch), batch.column(batch.schema.names.index(points))
            flat = column.flatten()
            row = np.repeat(np.arange(n), np.diff(column.offsets.to_numpy()))
            value = flat.field("value")
            known = ~value.is_null().to_numpy(zero_copy_only=False)
            slot, value = flat.field("slot").to_numpy()[known], value.to_numpy(zero_copy_only=False)[known]
            at = row[known] * size + slot
            out = np.bincount(at, value, n * size)
            missing = np.ones(n * size, bool)
            missing[at] = False
            starts = np.arange(n + 1, dtype=np.int32) * size
            hours = pa.ListArray.from_arrays(starts, pa.array(out, mask=missing))
            columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != points]
            yield pa.RecordBatch.from_arrays([*columns, hours], names=[f.name for f in schema.fields])

    return df.select(*plain, col(points)).mapInArrow(fill, schema)


def hourly_vectors(
    hourly: DataFrame,
    calendar: Calendar,
    keys: Sequence[str],
    value: str = "multiplier_hourly",
    used: DataFrame | None = None,
    on: Sequence[str] = ("shape_ts", "end_use"),
    sparse: bool = False,
) -> DataFrame:
    """One row per ``keys`` and sector: ``hours``, an array of the year's multipliers.

    Multipliers that are no number or negative are left out, and so are shapes that
    ``used`` does not name.  A key's rows are its hours, so no list outgrows the calendar.
    With ``sparse`` several rows of one hour stay several values, which products add up.
    """
    rows = hourly.filter(non_negative(col(value)))
    if used is not None:
        rows = rows.join(used.select(*cols(on)).distinct(), list(on), "left_semi")
    listed = rows.groupBy(*cols([*keys, "sector"])).agg(
        _points(calendar.slot(col(HOUR)), col(value)).alias("__points")
    )
    if sparse:
        return listed.select(*cols([*keys, "sector"]), _sparse(col("__points")).alias(VECTOR))
    return _dense(listed, calendar.hours + 1)


def _sparse(points: Column) -> Column:
    """A list of ``(slot, value)`` as two arrays, without the slots that have no value."""
    known = F.filter(points, lambda p: p["value"].isNotNull())
    return F.struct(known.getField("slot").alias("slots"), known.getField("value").alias("values"))


def _points_of(vector: str) -> Column:
    """A sparse vector as a list of ``(slot, value)``."""
    return F.arrays_zip(col(vector).getField("slots").alias("slot"), col(vector).getField("values").alias("value"))


def is_sparse(vectors: DataFrame) -> bool:
    return isinstance(vectors.schema[VECTOR].dataType, T.StructType)


def _part_of(total: Column):
    return lambda p: F.struct(p["slot"].alias("slot"), safe_ratio(p["value"], total).alias("value"))


def share_vectors(
    sums: DataFrame,
    calendar: Calendar,
    keys: Sequence[str],
    targets: Mapping[str, Sequence[Target]],
    sector: str,
    sparse: bool = False,
) -> DataFrame:
    """Hourly sums to vectors of shares, fanned out to end uses and fuels.

    ``sums`` has one row per ``keys`` and hour; ``targets`` maps a value column to the
    rows it feeds.  Total and hours come from one aggregation, so the totals are not
    joined back.  A share of a zero or unknown total is NULL, with no hours at all where
    the target asks for a positive total.
    """
    out = None
    slot = calendar.slot(col(HOUR))
    totals = [F.sum(col(v)).alias(f"__total_{v}") for v in targets]
    listed = sums.groupBy(*cols(keys)).agg(*totals, *[_points(slot, col(v)).alias(f"__points_{v}") for v in targets])
    for value, rows in targets.items():
        total = col(f"__total_{value}")
        entries = F.array(
            *[
                F.struct(
                    F.lit(t.end_use).alias("end_use"),
                    F.lit(t.fuel).cast("string").alias("fuel"),
                    (F.coalesce(total > 0, F.lit(False)) if t.guard else F.lit(True)).alias("__keep"),
                )
                for t in rows
            ]
        )
        share = F.transform(col(f"__points_{value}"), _part_of(total))
        # dense first, fanned out last: fuels that share a profile share its arrays
        part = listed.select(*cols(keys), entries.alias("__to"), share.alias("__points"))
        if sparse:
            part = part.select(*cols(keys), "__to", _sparse(col("__points")).alias(VECTOR))
        else:
            part = _dense(part, calendar.hours + 1)
        part = part.select(*cols(keys), F.inline("__to"), F.lit(sector).alias("sector"), VECTOR).filter("__keep").drop("__keep")
        out = part if out is None else out.unionByName(part)
    return out


def key_codes(columns: Sequence[pa.Array], start: np.ndarray) -> np.ndarray:
    """A number for each combination of ``start`` and the columns' values; NULLs are equal."""
    code = np.unique(start, return_inverse=True)[1]
    for column in columns:
        own = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        code = np.unique(code * (own.max(initial=0) + 1) + own, return_inverse=True)[1]
    return code


def summed_products(row, key, shape, kwh, of_row, of_shape, of_sector, matrix, there):
    """Energy times the series of its row and shape, summed by key and sector, for many rows at once.

    ``row, key, shape, kwh`` describe the energies (a key belongs to one row);
    ``of_row, of_shape, of_sector`` the series, lines of ``matrix`` with the values that
    are ``there``.  Returns an energy and a series of each result line, the lines, which
    of their values are held, and the energies that no series meets.
    """
    kinds = int(max(shape.max(initial=0), of_shape.max(initial=0))) + 2  # a shape of -1 is met by none
    own, offered = row * kinds + shape, of_row * kinds + of_shape
    order = np.argsort(offered, kind="stable")
    low, high = np.searchsorted(offered[order], own, "left"), np.searchsorted(offered[order], own, "right")
    n = high - low
    i = np.repeat(np.arange(len(own)), n)
    j = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(len(i))]
    line = key[i] * (int(of_sector.max(initial=0)) + 2) + of_sector[j] + 1
    _, first, line = np.unique(line, return_index=True, return_inverse=True)
    out, held = np.zeros((len(first), matrix.shape[1])), np.zeros((len(first), matrix.shape[1]), bool)
    by_line = np.argsort(line, kind="stable")
    counts = np.bincount(line, minlength=len(first))
    turn = np.empty(len(line), np.int64)
    turn[by_line] = np.arange(len(line)) - np.repeat(np.cumsum(counts) - counts, counts)
    for q in range(int(counts.max(initial=0))):  # no line twice in one turn
        at = np.flatnonzero(turn == q)
        to, series = line[at], j[at]
        out[to] += np.where(there[series], kwh[i[at]][:, None] * matrix[series], 0.0)
        held[to] |= there[series]
    return i[first], j[first], out, held, np.flatnonzero(n == 0)


def shape_codes(*columns: pa.Array) -> list[np.ndarray]:
    """The columns' values as common numbers, NULL as one of them."""
    every = pa.chunked_array([c for c in columns]).combine_chunks()
    code = every.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    return np.split(code, np.cumsum([len(c) for c in columns])[:-1])


def _keys_of(batch: pa.RecordBatch, energy: pa.StructArray, row: np.ndarray, result_keys, outer) -> list[pa.Array]:
    """The result keys of each energy: of its own, or of the row it stands in."""
    at = pa.array(row)
    return [batch.column(outer[n]).take(at) if n in outer else energy.field(n) for n in result_keys]


def _product(result_keys: Sequence[str], outer: Mapping[str, str], size: int):
    """For each place: energy by shape times shapes by hour, summed by the result keys."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ends = [whole.column(n).offsets.to_numpy() for n in ("__energy", "__shapes")]
            # places whose vectors fit into one matrix
            heavy = np.maximum(np.diff(ends[0]), np.diff(ends[1])).cumsum() // max(1, MATRIX // size)
            cuts = [0, *(np.flatnonzero(np.diff(heavy)) + 1).tolist(), len(whole)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi > lo:
                    yield one(whole.slice(lo, hi - lo))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.arange(len(batch))
        listed = [batch.column(n) for n in ("__energy", "__shapes")]
        row, of_row = (np.repeat(rows, np.diff(c.offsets.to_numpy())) for c in listed)
        energy, shapes = (c.flatten() for c in listed)
        keys = _keys_of(batch, energy, row, result_keys, outer)
        shape, of_shape = shape_codes(energy.field("shape_ts"), shapes.field("shape_ts"))
        sector = shapes.field("sector")
        sectors = sector.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = shapes.field(VECTOR).flatten()
        matrix = flat.to_numpy(zero_copy_only=False).reshape(-1, size)
        there = ~np.isnan(matrix) if flat.null_count else np.ones(matrix.shape, bool)
        key = key_codes(keys, row)
        i, j, out, held, lost = summed_products(
            row, key, shape, energy.field("__kwh").to_numpy(zero_copy_only=False),
            of_row, of_shape, sectors, np.where(there, matrix, 0.0), there,
        )
        lost = lost[np.unique(key[lost], return_index=True)[1]]
        starts = np.concatenate([np.arange(len(i) + 1) * size, np.full(len(lost), len(i) * size)])
        vectors = pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(out.ravel(), mask=~held.ravel()))
        source = pa.array(np.concatenate([i, lost]))
        met = pa.concat_arrays([sector.take(pa.array(j)), pa.nulls(len(lost), sector.type)])
        return pa.RecordBatch.from_arrays(
            [*[k.take(source) for k in keys], met, vectors], names=[*result_keys, "sector", VECTOR]
        )

    return apply


def _runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count in turn."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def sparse_products(row, key, shape, kwh, of_row, of_shape, of_sector, begin, slots, values, size):
    """``summed_products`` of series that hold ``slots`` and ``values`` from ``begin`` on.

    Yields an energy and a series of each result line, how many hours each line has, their
    slots and values, for so many lines at once that ``MATRIX`` bounds their hours and
    their products (or a single line has more); last the energies that no series meets.
    """
    kinds = int(max(shape.max(initial=0), of_shape.max(initial=0))) + 2
    own, offered = row * kinds + shape, of_row * kinds + of_shape
    order = np.argsort(offered, kind="stable")
    low, high = np.searchsorted(offered[order], own, "left"), np.searchsorted(offered[order], own, "right")
    n = high - low
    i = np.repeat(np.arange(len(own)), n)
    j = order[np.repeat(low, n) + _runs(n)]
    line = key[i] * (int(of_sector.max(initial=0)) + 2) + of_sector[j] + 1
    by_line = np.argsort(line, kind="stable")
    i, j, line = i[by_line], j[by_line], line[by_line]
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    first, line = np.flatnonzero(new), np.cumsum(new) - 1
    points = np.diff(begin)[j]
    ends = np.append(first, len(line))
    weight = np.add.reduceat(points, first) if len(first) else points
    heavy = np.maximum(weight, size).cumsum() // max(1, MATRIX)
    cuts = [0, *(np.flatnonzero(np.diff(heavy)) + 1).tolist(), len(first)]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if hi == lo:
            continue
        at = slice(ends[lo], ends[hi])
        where = np.repeat(begin[j[at]], points[at]) + _runs(points[at])
        cell = np.repeat(line[at] - lo, points[at]) * size + slots[where]
        out = np.bincount(cell, np.repeat(kwh[i[at]], points[at]) * values[where], (hi - lo) * size)
        there = np.zeros((hi - lo) * size, bool)
        there[cell] = True
        held = np.flatnonzero(there)
        yield i[first[lo:hi]], j[first[lo:hi]], np.bincount(held // size, minlength=hi - lo), held % size, out[held]
    lost = np.flatnonzero(n == 0)
    none = np.zeros(0, np.int64)
    if len(lost):
        yield lost, none, none, none, np.zeros(0)


def _sparse_product(result_keys: Sequence[str], outer: Mapping[str, str], size: int):
    """``_product`` of sparse vectors; energy that no series meets has a NULL vector."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.arange(len(batch))
            listed = [batch.column(n) for n in ("__energy", "__shapes")]
            row, of_row = (np.repeat(rows, np.diff(c.offsets.to_numpy())) for c in listed)
            energy, shapes = (c.flatten() for c in listed)
            keys = _keys_of(batch, energy, row, result_keys, outer)
            shape, of_shape = shape_codes(energy.field("shape_ts"), shapes.field("shape_ts"))
            sector = shapes.field("sector")
            sectors = sector.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            slots, values = (shapes.field(VECTOR).field(n) for n in ("slots", "values"))
            begin = slots.offsets.to_numpy().astype(np.int64)
            slots, values = slots.flatten().to_numpy(), values.flatten().to_numpy()
            known = ~np.isnan(values)
            begin = np.append(0, np.cumsum(known))[begin - begin[0]]
            key = key_codes(keys, row)
            parts = sparse_products(
                row, key, shape, energy.field("__kwh").to_numpy(zero_copy_only=False),
                of_row, of_shape, sectors, begin, slots[known], values[known], size,
            )
            for i, j, counts, at, kwh in parts:
                if len(j) < len(i):  # one row for each key
                    i = i[np.unique(key[i], return_index=True)[1]]
                    met, vectors = pa.nulls(len(i), sector.type), pa.nulls(len(i), _SPARSE)
                else:
                    starts = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(starts, pa.array(v, t)) for v, t in ((at, pa.int32()), (kwh, pa.float64()))]
                    met, vectors = sector.take(pa.array(j)), pa.StructArray.from_arrays(lists, fields=list(_SPARSE))
                source = pa.array(i)
                yield pa.RecordBatch.from_arrays(
                    [*[k.take(source) for k in keys], met, vectors], names=[*result_keys, "sector", VECTOR]
                )

    return apply


_SPARSE = pa.struct({"slots": pa.list_(pa.int32()), "values": pa.list_(pa.float64())})


def disaggregate_vectors(
    annual: DataFrame,
    shapes: DataFrame,
    vectors: DataFrame,
    calendar: Calendar,
    place: Sequence[str],
    carry: Sequence[str] = ("in.county", "in.state", "year", "turnover", "run_id"),
    match: Sequence[str] = ("end_use", "fuel"),
    value: str = "county_ann_kwh",
    keep_unmatched: bool = True,
) -> DataFrame:
    """Place kWh x the year's vector, summed over measures and stages: one row per result key.

    Energy is pre-summed by shape; the energy rows and the vectors of a (place, match)
    meet once, as one row each, and their sum over shapes is a matrix product.  A place
    with more than ``ENERGY_ROWS`` energy rows (a weather place of very many counties)
    is dealt into several rows.  With ``keep_unmatched`` energy without a shape keeps one
    row whose sector is NULL and whose vector is empty (NULL where vectors are sparse).
    """
    result_keys = list(dict.fromkeys([*carry, *match]))
    keys = list(dict.fromkeys([*place, *result_keys, "shape_ts"]))
    on = list(dict.fromkeys([*place, *match]))
    stage = ["meas", "end_use", "tech_stage"]
    outside = [n for n in on if n not in result_keys]
    annual = annual.filter(is_number(col(value)))
    # a place's few rows are shuffled once, for the sum, the list and the meeting, before the map copies them
    early = not outside and set(on) <= set(annual.columns)
    if early:
        annual = annual.select(*cols([n for n in annual.columns if n in {*keys, *stage, value}])).repartition(*cols(on))
        if not keep_unmatched:  # energy that meets no year is neither copied nor listed
            annual = annual.join(vectors.select(*cols(on)).distinct(), on, "left_semi")
    mapped = annual.join(shapes, stage, "inner").select(*cols([*keys, value]))
    if not outside and not early:
        mapped = mapped.repartition(*cols(on))
    presummed = sum_by(mapped, keys, {"__kwh": col(value)})
    size = calendar.hours + 1
    sizes = presummed.groupBy(*cols(on)).agg(F.ceil(F.count(F.lit(1)) / ENERGY_ROWS).cast("int").alias("__deals"))
    if outside:  # a place behind many counties; one that is in the result is bounded by its keys
        dealt = presummed.join(sizes, on)
        deal = F.pmod(F.xxhash64(*cols(result_keys)), col("__deals")).alias("__deal")
    else:
        dealt, deal = presummed, F.lit(0).alias("__deal")
    inner = [n for n in result_keys if n not in on]
    energy = dealt.groupBy(*cols(on), deal).agg(
        F.collect_list(F.struct(*cols(["shape_ts", "__kwh", *inner]))).alias("__listed")
    )
    energy = energy.select(*cols(on), col("__listed").alias("__energy"))
    held = vectors.groupBy(*cols(on)).agg(F.collect_list(F.struct("shape_ts", "sector", VECTOR)).alias("__shapes"))
    sparse = is_sparse(vectors)
    kind = vectors.schema[VECTOR].dataType
    empty = F.array().cast(f"array<struct<shape_ts:string,sector:string,{VECTOR}:{kind.simpleString()}>>")
    # result keys of the place stand beside the lists, under plain names as dotted ones cannot pass
    outer = {n: f"__key{i}" for i, n in enumerate(result_keys) if n not in inner}
    met = energy.join(held, on, "left" if keep_unmatched else "inner").select(
        *[col(n).alias(name) for n, name in outer.items()],
        "__energy", F.coalesce("__shapes", empty).alias("__shapes"),
    )
    fields = [presummed.schema[n] for n in result_keys]
    schema = T.StructType(
        [*fields, T.StructField("sector", T.StringType()), T.StructField(VECTOR, kind)]
    )
    out = met.mapInArrow((_sparse_product if sparse else _product)(result_keys, outer, size), schema)
    if outside:
        # several weather places may feed one result row: the few vectors are added up
        out = add_vectors(out, [*result_keys, "sector"])
    met = col(VECTOR).isNotNull() if sparse else F.size(VECTOR) > 0
    return out if keep_unmatched else out.filter(col("sector").isNotNull() | met)


def add_vectors(df: DataFrame, keys: Sequence[str], vector: str = VECTOR) -> DataFrame:
    """Element-wise sum of vectors per key; an element that all of them lack stays NULL."""

    def both(a: Column, b: Column) -> Column:
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)

    if is_sparse(df):
        met = col(VECTOR).isNotNull().alias("__met")
        points = df.select(*cols(keys), met, F.explode_outer(_points_of(VECTOR)).alias("__point"))
        summed = points.groupBy(*cols(keys), col("__point").getField("slot").alias("slot")).agg(
            F.sum(col("__point").getField("value")).alias("value"), F.max("__met").alias("__met")
        )
        listed = summed.groupBy(*cols(keys)).agg(_points(col("slot"), col("value")).alias("__points"), F.max("__met").alias("__met"))
        return listed.select(*cols(keys), F.when(col("__met"), _sparse(col("__points"))).alias(vector))
    empty = F.array().cast("array<double>")
    total = F.aggregate("__all", empty, lambda a, v: F.when(F.size(v) == 0, a).otherwise(F.zip_with(a, v, both)))
    return df.groupBy(*cols(keys)).agg(F.collect_list(col(vector)).alias("__all")).select(*cols(keys), total.alias(vector))


def hour_rows(
    vectors: DataFrame, calendar: Calendar, result: str = "county_hourly_uncal_kwh", keep_unmatched: bool = True
) -> DataFrame:
    """Vectors as rows, for writing: one for each hour that has a value, and one for an empty vector."""
    names = [n for n in vectors.columns if n != VECTOR]
    blank = F.array(F.struct(F.lit(None).cast("int").alias("slot"), F.lit(None).cast("double").alias("value")))
    if is_sparse(vectors):
        rows = _points_of(VECTOR)
    else:
        points = F.filter(
            F.transform(col(VECTOR), lambda v, i: F.struct(i.alias("slot"), v.alias("value"))),
            lambda p: p["value"].isNotNull(),
        )
        rows = F.when(F.size(VECTOR) > 0, points)
    rows = F.coalesce(rows, blank) if keep_unmatched else rows
    out = vectors.select(*cols(names), F.inline(rows))
    return out.select(
        *cols([n for n in names if n != "sector"]), calendar.hour(col("slot")).alias(HOUR), "sector",
        col("value").alias(result),
    )


def group_hours(
    vectors: DataFrame, keys: Sequence[str], calendar: Calendar, result: str = "state_hourly_kwh"
) -> DataFrame:
    """Hourly totals of coarser keys: vectors are added before hours become rows."""
    if is_sparse(vectors):  # a task adds up its own hours first, so that few are shuffled
        points = vectors.select(*cols(keys), F.inline(_points_of(VECTOR))).filter(is_number(col("value")))
        totals = sum_by(points, [*keys, "slot"], {result: col("value")})
        return totals.select(*cols(keys), calendar.hour(col("slot")).alias(HOUR), col(result))
    summed = vectors.filter(F.size(VECTOR) > 0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial sums of a task, so that few vectors are shuffled."""
        total: dict[tuple, list] = {}
        for batch in batches:
            rows = list(zip(*[batch.column(i).to_pylist() for i in range(len(keys))]))
            column = batch.column(len(keys))
            flat = column.flatten().to_numpy(zero_copy_only=False)
            for key, v in zip(rows, flat.reshape(len(rows), -1)):
                there = ~np.isnan(v)
                if key in total:
                    total[key][0][there] += v[there]
                    total[key][1] |= there
                else:
                    total[key] = [np.where(there, v, 0.0), there]
            if len(total) * (calendar.hours + 1) > 1 << 24:
                yield _batch(total)
                total = {}
        if total:
            yield _batch(total)

    kinds = [summed.schema[n] for n in keys]
    schema = T.StructType([*kinds, T.StructField(VECTOR, T.ArrayType(T.DoubleType()))])
    arrow = [_arrow(f.dataType) for f in kinds]

    def _batch(total: dict) -> pa.RecordBatch:
        values = pa.array(
            np.concatenate([v for v, _ in total.values()]), mask=~np.concatenate([t for _, t in total.values()])
        )
        starts = np.arange(len(total) + 1, dtype=np.int32) * (calendar.hours + 1)
        columns = [pa.array(c, t) for c, t in zip(zip(*total), arrow)]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(starts, values)], names=[f.name for f in schema.fields])

    plain = [col(n).alias(f"c{i}") for i, n in enumerate(keys)]  # dotted names cannot pass
    partial = summed.select(*plain, col(VECTOR)).mapInArrow(add, schema)
    done = add_vectors(partial, keys).withColumn("sector", F.lit(None).cast("string"))
    return hour_rows(done, calendar, result, keep_unmatched=False).drop("sector")


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
