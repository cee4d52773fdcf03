from __future__ import annotations

import re
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_disagg import ANNUAL, MAP, MAP_SCHEMA, annual_rows, hour_rows

from wattloom.functions import col
from wattloom.operators import disagg, shapes, vectors
from wattloom.operators.shares import Target

YEAR = vectors.Calendar("2018-01-01 00:00:00", 8_784)
SPANS = {"s1": 30, "s2": 5, "unused": 3}


def table(df):
    names = sorted(df.columns)
    rows = [tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*[col(n) for n in names]).collect()]
    return sorted(rows, key=str)


def inputs(frame, place, places):
    hours, schema = hour_rows(place, places, SPANS)
    hours += [(places[0], "s1", None, "com", "Cooking", "Electric", 0.25), (places[1], "s2", None, "com", "Cooking", "Gas", 0.5)]
    annual = frame(annual_rows(), ANNUAL)
    return annual, disagg.stage_shapes(frame(MAP, MAP_SCHEMA)), frame(hours, schema)


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("place", ["in.county", "city"])
def test_vectors_equal_rows(frame, monkeypatch, place, keep):
    """With the place in the result, and with a weather place behind many counties, dealt into pieces."""
    monkeypatch.setattr(vectors, "ENERGY_ROWS", 3)
    annual, used, hours = inputs(frame, place, ["c0", "c1", "c2"] if place == "in.county" else ["w0", "w1"])
    carry = ("in.county", "in.state", "year", "turnover", "run_id")
    want = disagg.disaggregate_hourly(annual, used, hours, [place], carry=carry, keep_unmatched=keep)
    years = vectors.hourly_vectors(hours, YEAR, [place, "shape_ts", "end_use", "fuel"], used=used)
    got = vectors.disaggregate_vectors(annual, used, years, YEAR, [place], carry=carry, keep_unmatched=keep)
    rows = vectors.hour_rows(got, YEAR, keep_unmatched=keep)
    assert sorted(rows.columns) == sorted(want.columns)
    assert table(rows) == table(want) and rows.count() > 100
    keys = [c for c in got.columns if c != "hours"]
    assert got.groupBy(*[col(k) for k in keys]).count().filter("count > 1").isEmpty()


def test_no_join_or_exchange_on_hours(spark, frame):
    annual, used, hours = inputs(frame, "in.county", ["c0", "c1"])
    years = vectors.hourly_vectors(hours, YEAR, ["in.county", "shape_ts", "end_use", "fuel"], used=used)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = vectors.hour_rows(vectors.disaggregate_vectors(annual, used, years, YEAR, ["in.county"]), YEAR)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = re.findall(r"(?:Join|hashpartitioning)[^\n]*", plan)
    assert shuffled and not any(shapes.HOUR in line for line in shuffled)


def test_shares_of_a_year_with_zero_and_missing_totals(frame):
    rows = [("a", "s", datetime(2018, 1, 1, h), float(h), 0.0) for h in range(4)]
    rows += [("b", "s", datetime(2018, 1, 1, 0), None, 5.0), ("b", "s", None, 3.0, 5.0)]
    sums = frame(rows, "place string, shape_ts string, timestamp_hour timestamp, p double, s double")
    small = vectors.Calendar("2018-01-01 00:00:00", 24)
    to = {"p": [Target("p", "Heating", "El"), Target("p", "Cooling", "El")], "s": [Target("s", "Heating", "Gas", True)]}
    got = {(r["place"], r["end_use"], r["fuel"]): r["hours"] for r in vectors.share_vectors(sums, small, ["place", "shape_ts"], to, "com").collect()}
    assert set(got) == {(p, u, "El") for p in "ab" for u in ("Heating", "Cooling")} | {("b", "Heating", "Gas")}
    assert got["a", "Heating", "El"][:4] == pytest.approx([0, 1 / 6, 2 / 6, 3 / 6]) and set(got["a", "Heating", "El"][4:]) == {None}
    assert got["b", "Cooling", "El"][24] == 1.0 and got["b", "Cooling", "El"][0] is None
    assert got["b", "Heating", "Gas"][0] == got["b", "Heating", "Gas"][24] == 0.5


def test_totals_of_states_add_vectors(frame):
    small = vectors.Calendar("2018-01-01 00:00:00", 3)
    df = frame(
        [("c1", "S", "com", [1.0, None, 2.0, None]), ("c2", "S", "com", [1.0, None, None, 4.0]), ("c3", "T", None, [])],
        "county string, `in.state` string, sector string, hours array<double>",
    )
    got = sorted(map(tuple, vectors.group_hours(df, ["in.state"], small, "kwh").collect()), key=str)
    assert got == [("S", None, 4.0), ("S", datetime(2018, 1, 1, 0), 2.0), ("S", datetime(2018, 1, 1, 2), 2.0)]


def test_calendar_reads_back_and_rejects_other_hours(frame):
    df = frame([(datetime(2018, 3, 1, 5),), (datetime(2018, 3, 2, 7),), (None,)], "timestamp_hour timestamp")
    own = vectors.calendar_of(df)
    assert own == vectors.Calendar("2018-03-01 05:00:00", 27)
    slots = df.select(own.slot(F.col("timestamp_hour")).alias("s"))
    assert sorted(r["s"] for r in slots.collect()) == [0, 26, 27]
    back = slots.select(own.hour(F.col("s")).alias("h")).collect()
    assert {r["h"] for r in back} == {r[0] for r in df.collect()}
    for bad in (datetime(2018, 3, 1, 4), datetime(2018, 3, 1, 5, 30)):
        with pytest.raises(Exception, match="outside the calendar"):
            frame([(bad,)], "timestamp_hour timestamp").select(own.slot(F.col("timestamp_hour"))).collect()
    assert vectors.calendar_of(df.filter("false")).hours == 1


def test_products_of_many_rows_at_once():
    """Two places in one call: energies that no shape meets, a kWh of 0 and hours that only one shape has."""
    matrix = np.array([[1.0, 0.0, 2.0], [0.0, 4.0, 0.0], [8.0, 8.0, 8.0]])
    there = np.array([[True, False, True], [False, True, False], [True, True, True]])
    row, key, shape = np.array([0, 0, 0, 1, 1]), np.array([0, 0, 1, 2, 3]), np.array([0, 1, 1, 0, 5])
    i, j, out, held, lost = vectors.summed_products(
        row, key, shape, np.array([10.0, 1.0, 0.0, 3.0, 9.0]),
        np.array([0, 0, 1]), np.array([0, 1, 0]), np.array([0, 0, 1]), matrix, there,
    )
    assert key[i].tolist() == [0, 1, 2] and j.tolist()[1:] == [1, 2]
    assert out.tolist() == [[10.0, 4.0, 20.0], [0.0, 0.0, 0.0], [24.0, 24.0, 24.0]]
    assert held.tolist() == [[True, True, True], [False, True, False], [True, True, True]]
    assert lost.tolist() == [4]
    none = np.zeros(0, np.int64)
    assert vectors.summed_products(row, key, shape, np.ones(5), none, none, none, np.zeros((0, 3)), np.zeros((0, 3), bool))[4].tolist() == list(range(5))


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("place", ["in.county", "city"])
def test_sparse_vectors_equal_rows(frame, monkeypatch, place, keep):
    """Only hours with readings are held; a shape without any, unknown hours and single lines over the bound stay right."""
    monkeypatch.setattr(vectors, "ENERGY_ROWS", 3)
    monkeypatch.setattr(vectors, "MATRIX", 50)
    annual, used, hours = inputs(frame, place, ["c0", "c1", "c2"] if place == "in.county" else ["w0", "w1"])
    carry = ("in.county", "in.state", "year", "turnover", "run_id")
    want = disagg.disaggregate_hourly(annual, used, hours, [place], carry=carry, keep_unmatched=keep)
    years = vectors.hourly_vectors(hours, YEAR, [place, "shape_ts", "end_use", "fuel"], used=used, sparse=True)
    longest = years.select(F.max(F.size("hours.slots")), F.max(F.size("hours.values"))).first()
    assert max(longest) <= max(SPANS.values()) + 1  # with the readings, not with the calendar
    got = vectors.disaggregate_vectors(annual, used, years, YEAR, [place], carry=carry, keep_unmatched=keep)
    rows = vectors.hour_rows(got, YEAR, keep_unmatched=keep)
    assert sorted(rows.columns) == sorted(want.columns)
    assert table(rows) == table(want) and rows.count() > 100
    keys = [c for c in got.columns if c != "hours"]
    assert got.groupBy(*[col(k) for k in keys]).count().filter("count > 1").isEmpty()
    dense = vectors.disaggregate_vectors(
        annual, used, vectors.hourly_vectors(hours, YEAR, [place, "shape_ts", "end_use", "fuel"], used=used),
        YEAR, [place], carry=carry, keep_unmatched=keep,
    )
    assert table(vectors.group_hours(got, ["in.state", "year"], YEAR)) == table(vectors.group_hours(dense, ["in.state", "year"], YEAR))


def test_sparse_shares_leave_out_missing_values(frame):
    rows = [("a", "s", datetime(2018, 1, 1, h), float(h)) for h in range(4)]
    rows += [("b", "s", datetime(2018, 1, 1, 0), None), ("b", "s", None, 3.0), ("z", "s", datetime(2018, 1, 1, 0), 0.0)]
    sums = frame(rows, "place string, shape_ts string, timestamp_hour timestamp, p double")
    small = vectors.Calendar("2018-01-01 00:00:00", 24)
    to = {"p": [Target("p", "Heating", "El")]}
    got = {
        r["place"]: dict(zip(r["hours"]["slots"], r["hours"]["values"], strict=True))
        for r in vectors.share_vectors(sums, small, ["place", "shape_ts"], to, "com", sparse=True).collect()
    }
    assert got == {"a": pytest.approx({0: 0, 1: 1 / 6, 2: 2 / 6, 3: 3 / 6}), "b": {24: 1.0}, "z": {}}


def test_energy_without_a_year_is_not_shuffled(spark, frame):
    """Where only matches are asked for, places without a vector leave before the map copies them."""
    annual, used, hours = inputs(frame, "in.county", ["c0", "c1"])
    years = vectors.hourly_vectors(hours, YEAR, ["in.county", "shape_ts", "end_use", "fuel"], used=used, sparse=True)
    out = vectors.disaggregate_vectors(annual, used, years, YEAR, ["in.county"], keep_unmatched=False)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2  # the shapes in use, and the places that have a vector
