"""Exact distinct counts that can be kept and merged: bitmaps over numbered places.

A place has a number for life.  The places of a group are bits: some 4 KB for each
32,768 numbers that occur.  States of several runs are united by OR, so a new run
is counted without reading the facts of earlier ones again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.text import col, cols
from wattloom.operators.joins import join_null_safe

NUMBER, BUCKET, BITS = "place_number", "place_bucket", "place_bits"
#: Partitions that number new places.
PARTS = 16


def number_places(places: DataFrame, keys: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """``keys`` and a number for each distinct place; those of ``known`` stay, new ones follow.

    Numbers are positions within hash partitions, so no task sees all places; they have
    gaps, but stay dense inside each of a few ranges.  Write the result: numbers are given
    once.  A place with a NULL key has no number, as COUNT(DISTINCT) does not count it.
    """
    named = places.select(*cols(keys)).dropna().distinct()
    fresh = named if known is None else join_null_safe(named, known.select(*cols(keys)), keys, "left_anti")
    # the upper bits of the id are the partition; each gets a range of its own above the known numbers
    top = F.lit(0).cast("long")
    if known is not None:
        top = F.lit(known.agg(F.max(NUMBER)).first()[0] or 0).cast("long")
    numbered = fresh.repartition(PARTS, *cols(keys)).withColumn("__id", F.monotonically_increasing_id())
    part = F.shiftright("__id", 33)
    inside = F.pmod(col("__id"), F.lit(1 << 33))
    # blocks of 32,768 numbers are dealt to up to ``PARTS`` partitions in turn, so none is shared
    block = F.floor(inside / 32_768) * PARTS + part
    base = (F.floor(top / 32_768) + 1) * 32_768
    number = base + block * 32_768 + F.pmod(inside, F.lit(32_768))
    out = numbered.select(*cols(keys), number.cast("long").alias(NUMBER))
    return out if known is None else known.select(*cols([*keys, NUMBER])).unionByName(out)


def distinct_states(facts: DataFrame, keys: Sequence[str], numbers: DataFrame, place: Sequence[str]) -> DataFrame:
    """``keys``, bucket and bits: the places of every group, in a mergeable form.

    A group's places are spread over buckets, so no group is one task's.
    """
    numbered = facts.select(*cols(dict.fromkeys([*keys, *place]))).join(numbers, list(place), "inner")
    return numbered.groupBy(*cols(keys), F.bitmap_bucket_number(col(NUMBER)).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(col(NUMBER))).alias(BITS)
    )


def merge_states(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """States of several runs as one, without their facts."""
    out = states[0]
    for more in states[1:]:
        out = out.unionByName(more)
    return out.groupBy(*cols([*keys, BUCKET])).agg(F.bitmap_or_agg(col(BITS)).alias(BITS))


def distinct_counts(states: DataFrame, keys: Sequence[str], result: str = "n_places") -> DataFrame:
    """The number of distinct places of each group; coarser ``keys`` than the states' unite them."""
    united = merge_states([states], keys)
    return united.groupBy(*cols(keys)).agg(F.sum(F.bitmap_count(col(BITS))).cast("long").alias(result))
