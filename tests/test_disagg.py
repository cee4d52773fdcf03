from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattloom.functions import col
from wattloom.operators import calibrate, disagg, shapes
from wattloom.operators.shares import targets

MAP = [
    ("m1", "Cooking", "g1", "g2", "s1", "s2", "com"),
    ("m2", "Cooking", "g1", "g1", "s1", "s3", "com"),
]
MAP_SCHEMA = (
    "meas string, end_use string, original_ann string, measure_ann string, "
    "original_ts string, measure_ts string, sector string"
)
ANNUAL = (
    "`in.county` string, city string, `in.state` string, year int, turnover string, "
    "run_id string, meas string, end_use string, fuel string, tech_stage string, "
    "county_ann_kwh double"
)


def annual_rows():
    out = []
    for i in range(6):
        for meas in ("m1", "m2"):
            for stage in ("original_ann", "measure_ann"):
                for fuel in ("Electric", "Gas"):
                    out.append(
                        (f"c{i}", f"w{i % 3}", "S", 2026, "ref", "r", meas, "Cooking", fuel, stage, float(i + 1))
                    )
    out.append(("c0", "w1", "S", 2026, "ref", "r", "m1", "Cooking", "Electric", "measure_ann", 5.0))
    out.append(("c1", "w1", "S", 2026, "ref", "r", "m1", "Cooking", "Electric", "measure_ann", float("nan")))
    return out


def hour_rows(place, places, spans):
    out = []
    for p in places:
        for shape, n in spans.items():
            for fuel in ("Electric", "Gas"):
                for h in range(n):
                    out.append(
                        (p, shape, datetime(2018, 1, 1) + timedelta(hours=h), "com", "Cooking", fuel, 1 / n)
                    )
    out.append((places[0], "s1", datetime(2018, 5, 1), "com", "Cooking", "Electric", float("nan")))
    out.append((places[0], "s1", datetime(2018, 5, 2), "com", "Cooking", "Electric", -0.5))
    return out, (
        f"`{place}` string, shape_ts string, timestamp_hour timestamp, sector string, "
        "end_use string, fuel string, multiplier_hourly double"
    )


def brute(annual, hours, place, spans, carry):
    """Row by row: join to the map, look hours up, add up."""
    lookup = {}
    for p, shape, ts, sector, use, fuel, m in hours:
        if m == m and m >= 0:
            lookup.setdefault((p, use, fuel, shape), []).append((ts, sector, m))
    names = [c.split()[0].strip("`") for c in ANNUAL.split(", ")]
    sums = {}
    for row in annual:
        r = dict(zip(names, row, strict=True))
        if r["county_ann_kwh"] != r["county_ann_kwh"]:
            continue
        for meas, use, _, _, ots, mts, _ in MAP:
            if meas == r["meas"] and use == r["end_use"]:
                shape = ots if r["tech_stage"] == "original_ann" else mts
                key = tuple(r[c] for c in carry) + (r["end_use"], r["fuel"])
                found = lookup.get((r[place], use, r["fuel"], shape))
                for ts, sector, m in found or [(None, None, None)]:
                    k = (*key, ts, sector)
                    v = None if m is None else r["county_ann_kwh"] * m
                    old = sums.get(k)
                    sums[k] = old if v is None else (old or 0.0) + v
    return {k: None if v is None else round(v, 9) for k, v in sums.items()}


@pytest.mark.parametrize("blocks", [1, 3])
@pytest.mark.parametrize("place", ["in.county", "city"])
def test_hourly_matches_brute_force(spark, frame, blocks, place):
    annual = annual_rows()
    places = ["c0", "c1", "c2", "c3"] if place == "in.county" else ["w0", "w1"]
    # s3 is missing everywhere; the data end on 3 January, so some blocks are empty.
    spans = {"s1": 49, "s2": 30}
    hours, schema = hour_rows(place, places, spans)
    carry = ("in.county", "in.state", "year", "turnover", "run_id")
    out = disagg.disaggregate_hourly(
        frame(annual, ANNUAL),
        disagg.stage_shapes(frame(MAP, MAP_SCHEMA)),
        frame(hours, schema),
        [place],
        carry=carry,
        hour_blocks=blocks,
    )
    got = {}
    for r in out.collect():
        d = r.asDict()
        key = (*[d[c] for c in carry], d["end_use"], d["fuel"], d["timestamp_hour"], d["sector"])
        assert key not in got, "a result key must be unique"
        v = d["county_hourly_uncal_kwh"]
        got[key] = None if v is None else round(v, 9)
    assert got == brute(annual, hours, place, spans, carry)


def test_annual_cascade_conserves_energy(frame):
    projection = frame(
        [
            ("m1", "S", "Cooking", "Electric", 2026, "original_ann", 100.0, "ref", "r", "x"),
            ("m1", "S", "Cooking", "Electric", 2026, "measure_ann", 50.0, "ref", "r", "x"),
            ("m2", "S", "Cooking", "Gas", 2026, "original_ann", 10.0, "ref", "r", "x"),
            ("zz", "S", "Cooking", "Gas", 2026, "original_ann", 10.0, "ref", "r", "x"),
        ],
        "meas string, reg string, end_use string, fuel string, year int, tech_stage string, "
        "state_ann_kwh double, turnover string, run_id string, sector string",
    )
    mult = frame(
        [
            (c, "S", g, "Cooking", f, m)
            for g in ("g1", "g2")
            for f in ("Electric", "Gas")
            for c, m in (("c1", 0.25), ("c2", 0.75))
        ],
        "`in.county` string, `in.state` string, group_ann string, end_use string, "
        "fuel string, multiplier_annual double",
    )
    out = disagg.disaggregate_annual(
        projection, disagg.stage_groups(frame(MAP, MAP_SCHEMA)), mult
    )
    rows = out.collect()
    assert len(rows) == 6
    assert sum(r.county_ann_kwh for r in rows) == 160.0
    assert {r.sector for r in rows} == {"com"}
    assert "in.state" in out.columns and "reg" not in out.columns


def test_hourly_shape_against_pandas(spark, frame):
    rng = np.random.default_rng(7)
    data = [
        (f"p{rng.integers(0, 3)}", f"s{rng.integers(0, 2)}",
         datetime(2018, 12, 30) + timedelta(minutes=int(rng.integers(0, 2879))), float(rng.random()))
        for _ in range(500)
    ]
    df = frame(data, "place string, shape_ts string, timestamp timestamp, v double")
    out = shapes.hourly_shape(
        df, ["place"], ["shape_ts"], shapes.aligned(), {"v": col("v")}, targets("v", "O", ["E"], True)
    ).toPandas()
    pdf = pd.DataFrame(data, columns=["place", "shape_ts", "ts", "v"])
    hour = pdf.ts.dt.floor("h") + pd.Timedelta(hours=1)
    pdf["timestamp_hour"] = hour.where(hour.dt.year != 2019, hour - pd.DateOffset(years=1))
    want = pdf.groupby(["place", "shape_ts", "timestamp_hour"], as_index=False).v.sum()
    want["m"] = want.v / want.groupby(["place", "shape_ts"]).v.transform("sum")
    got = out.sort_values(["place", "shape_ts", "timestamp_hour"]).reset_index(drop=True)
    want = want.sort_values(["place", "shape_ts", "timestamp_hour"]).reset_index(drop=True)
    assert np.allclose(got.multiplier_hourly, want.m)
    assert (got.timestamp_hour.astype("datetime64[us]") == want.timestamp_hour.astype("datetime64[us]")).all()
    assert got.timestamp_hour.min() == pd.Timestamp("2018-01-01 00:00")


def test_shape_difference_and_spread(frame):
    df = frame(
        [("z", "0", datetime(2018, 1, 1, 1), 1.0), ("z", "40", datetime(2018, 1, 1, 1), 3.0),
         ("z", "40", datetime(2018, 1, 1, 2), 6.0)],
        "tz string, upgrade string, timestamp timestamp, v double",
    )
    per_zone = shapes.shape_difference(
        df, ["tz"], shapes.aligned(), col("v"), col("upgrade") == "0", col("upgrade") == "40"
    )
    places = frame([("c1", "z"), ("c2", "z"), ("c3", "y")], "`in.county` string, tz string")
    got = sorted(
        (r["in.county"], r.timestamp_hour.hour, r.kwh, r.multiplier_hourly)
        for r in shapes.spread_to_places(per_zone, places, ["tz"]).collect()
    )
    assert got == [("c1", 2, 2.0, 0.25), ("c1", 3, 6.0, 0.75), ("c2", 2, 2.0, 0.25), ("c2", 3, 6.0, 0.75)]


def test_calibration(frame):
    modelled = frame(
        [("res", "S", 1, "E", 2020, 10.0), ("res", "S", 1, "E", 2021, 20.0), ("res", "S", 2, "E", 2020, 0.0)],
        "sector string, `in.state` string, month int, fuel string, year int, state_monthly_uncal_kwh double",
    )
    measured = frame(
        [("res", "S", 1, "E", 2020, 20.0), ("res", "S", 1, "E", 2021, 20.0), ("res", "S", 2, "E", 2020, 5.0)],
        "sector string, `in.state` string, month int, fuel string, year int, `gross.kWh` double",
    )
    ratios = calibrate.calibration_ratios(modelled, measured)
    got = {r.month: r.calibration_multiplier for r in ratios.collect()}
    assert got == {1: 1.5, 2: None}
    hourly = frame(
        [("res", "S", "E", datetime(2018, 1, 5), 2.0), ("res", "S", "E", datetime(2018, 3, 5), 2.0),
         ("res", "S", "E", None, None)],
        "sector string, `in.state` string, fuel string, timestamp_hour timestamp, county_hourly_uncal_kwh double",
    )
    out = calibrate.calibrate_hours(hourly, ratios)
    assert sorted(r.county_hourly_cal_kwh for r in out.collect()) == [2.0, 3.0]
    assert "month" not in out.columns


def test_combination_totals(frame):
    df = frame([("a", "S", 1.0), ("b", "S", 2.0), ("c", "S", 4.0)], "kind string, st string, county_hourly_kwh double")
    out = disagg.combination_totals(df, {"ab": ("a", "b"), "bc": ("b", "c")}, ["st"])
    assert sorted((r.kind, r.state_monthly_kwh) for r in out.collect()) == [
        ("ab", 1.0), ("ab", 2.0), ("bc", 2.0), ("bc", 4.0)
    ]


def test_hourly_plan_has_no_exchange_above_the_join(spark, tmp_path):
    """Both inputs are shuffled once; the exploded product is not."""
    n = 1000
    hours = spark.range(n).select(
        F.concat(F.lit("c"), (col("id") % 7).cast("string")).alias("county"),
        F.concat(F.lit("s"), (col("id") % 3).cast("string")).alias("shape_ts"),
        F.concat(F.lit("e"), (col("id") % 2).cast("string")).alias("end_use"),
        F.timestamp_seconds(col("id") * 3600).alias("timestamp_hour"),
        F.lit("com").alias("sector"),
        (col("id") / n).alias("multiplier_hourly"),
    )
    annual = spark.range(n).select(
        F.concat(F.lit("c"), (col("id") % 7).cast("string")).alias("county"),
        F.concat(F.lit("m"), (col("id") % 5).cast("string")).alias("meas"),
        F.concat(F.lit("e"), (col("id") % 2).cast("string")).alias("end_use"),
        F.lit("original_ann").alias("tech_stage"),
        col("id").cast("double").alias("county_ann_kwh"),
    )
    mm = spark.range(20).select(
        F.concat(F.lit("m"), (col("id") % 5).cast("string")).alias("meas"),
        F.concat(F.lit("e"), (col("id") % 2).cast("string")).alias("end_use"),
        F.lit("original_ann").alias("tech_stage"),
        F.concat(F.lit("s"), (col("id") % 3).cast("string")).alias("shape_ts"),
    )
    for name, df in (("h", hours), ("a", annual), ("m", mm)):
        df.write.parquet(f"{tmp_path}/{name}")
    read = spark.read.parquet
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = disagg.disaggregate_hourly(
            read(f"{tmp_path}/a"), read(f"{tmp_path}/m"), read(f"{tmp_path}/h"),
            ["county"], carry=("county",), match=("end_use",),
        )
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    above = plan.split("SortMergeJoin [county", 1)[0]
    assert "HashAggregate" in above
    assert "Exchange" not in above, plan


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_blocks_of_a_weather_place_leave_the_product_complete(spark, frame):
    """Its hours are not joined row by row; only counties behind several places are summed again."""
    annual = [(*r[:1], f"w{int(r[0][1]) % 3}", *r[2:]) for r in annual_rows()]
    annual += [(*r[:1], None, *r[2:]) for r in annual_rows()[:4]]
    annual.append((*annual[0][:1], "w1", *annual[0][2:]))  # c0 is behind w0 and w1
    hours, schema = hour_rows("city", ["w0", "w1"], {"s1": 49, "s2": 30})
    hours += [("w0", "s2", None, "com", "Cooking", "Gas", 0.5), ("w0", "s2", None, "com", "Cooking", "Gas", 0.25)]
    hours.append(("w1", "s1", datetime(2018, 1, 1), "com", "Cooking", "Gas", float("inf")))
    args = (frame(annual, ANNUAL), disagg.stage_shapes(frame(MAP, MAP_SCHEMA)), frame(hours, schema), ["city"])
    for keep in (True, False):
        whole, split = (disagg.disaggregate_hourly(*args, keep_unmatched=keep, hour_blocks=n) for n in (1, 3))
        want, got = (
            sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*[col(c) for c in whole.columns]).collect()), key=str)
            for df in (whole, split)
        )
        assert got == want and len(got) > 100 and split.dtypes == whole.dtypes
    plan = _plan(split)
    assert "MapInArrow" in plan and not any("Join" in line and "__block" in line for line in plan.split("\n"))


def test_places_of_the_result_are_shuffled_once(spark, frame):
    """The sum over measures and the join share one exchange; rows without hours are not copied to blocks."""
    hours, schema = hour_rows("in.county", ["c0", "c1"], {"s1": 49, "s2": 30})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        args = (frame(annual_rows(), ANNUAL), disagg.stage_shapes(frame(MAP, MAP_SCHEMA)), frame(hours, schema), ["in.county"])
        plan = _plan(disagg.disaggregate_hourly(*args))
        split = _plan(disagg.disaggregate_hourly(*args, hour_blocks=4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    energy = [line for line in plan.split("\n") if "hashpartitioning(in.county" in line and "shape_ts" not in line.split("hashpartitioning(")[1].split(")")[0]]
    assert len(energy) == 2  # the energy and the hours
    assert not any("LeftAnti" in line for line in split.split("\n"))


def _weather_case(frame):
    """Counties behind one or several places, or none; hours of two months, unknown and endless ones."""
    annual = [(*r[:1], f"w{int(r[0][1]) % 3}", *r[2:]) for r in annual_rows()]
    annual += [(*r[:1], None, *r[2:]) for r in annual_rows()[:4]]
    annual.append((*annual[0][:1], "w1", *annual[0][2:]))  # c0 is behind w0 and w1
    hours, schema = hour_rows("city", ["w0", "w1"], {"s1": 24 * 40, "s2": 30})
    hours += [("w0", "s2", None, "com", "Cooking", "Gas", 0.5), ("w0", "s2", None, None, "Cooking", "Gas", 0.25)]
    hours.append(("w1", "s1", datetime(2018, 1, 1), "com", "Cooking", "Gas", float("inf")))
    return frame(annual, ANNUAL), disagg.stage_shapes(frame(MAP, MAP_SCHEMA)), frame(hours, schema), ["city"]


def _by_month():
    weight = F.dayofmonth("timestamp_hour") * 24 + F.hour("timestamp_hour")
    return disagg.HourTotals({"month": F.month("timestamp_hour")}, "n", {"kwh": None, "weighted": weight})


def _sorted_rows(df, names):
    rows = df.select(*[col(c) for c in names]).collect()
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("keep", [True, False])
def test_totals_of_dealt_products_are_the_sums_of_their_hours(spark, frame, keep):
    args, by_month = _weather_case(frame), _by_month()
    carry = ["in.county", "in.state", "year", "turnover", "run_id", "end_use", "fuel"]
    hourly = disagg.disaggregate_hourly(*args, keep_unmatched=keep)
    want = by_month.of(hourly, carry, "county_hourly_uncal_kwh")
    got = disagg.disaggregate_hourly(*args, keep_unmatched=keep, hour_blocks=3, totals=by_month)
    rows = _sorted_rows(got, want.columns)
    assert rows == _sorted_rows(want, want.columns) and got.dtypes == want.dtypes
    assert {r[want.columns.index("month")] for r in rows} == {1, 2, None}
    whole = disagg.disaggregate_hourly(*args, keep_unmatched=keep, totals=by_month)
    assert _sorted_rows(whole, want.columns) == rows


def test_energy_of_weather_places_is_shuffled_once_by_county(spark, frame):
    """The sum by shape, the look for several places and the pieces share one exchange."""
    annual, shapes, hours, place = _weather_case(frame)
    for options in ({}, {"totals": _by_month()}):
        plan = _plan(disagg.disaggregate_hourly(annual, shapes, hours, place, hour_blocks=4, **options))
        pieces = plan.split("MapInArrow")[2]  # below the product and the cutting of pieces
        exchanges = [line for line in pieces.split("Scan")[0].split("\n") if "Exchange hashpartitioning(" in line]
        assert len(exchanges) == 1 and "hashpartitioning(hash" in exchanges[0], plan
        assert "LeftAnti" not in plan


@pytest.mark.parametrize("limits", [(1 << 19, 4_096), (7, 4), (1, 1)])
@pytest.mark.parametrize("hashes", [1, 5, 1 << 40])
def test_pieces_hold_whole_result_keys(monkeypatch, limits, hashes):
    """However tasks are cut and hashes fall together: every sum once, in one piece for each key and place."""
    monkeypatch.setattr(disagg, "HELD_ROWS", limits[0])
    monkeypatch.setattr(disagg, "ENERGY_ROWS", limits[1])
    rows = []
    for i in range(23):
        key = (i or None, ["S", None][i % 2], f"u{i % 2}")
        for o0 in [f"w{i % 4}"] if i else ["w0", None, "w2"]:
            for deck in range(1 + i % 3):
                sums = [float(100 * i + 10 * deck + k) if (i + k) % 3 else None for k in range(8)]
                rows.append((i * 7_919 % hashes, [key[1], key[2], o0], key[0], deck, sums))
    rows.sort(key=lambda r: (r[0], r[3]))
    kinds = [pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int32(), pa.list_(pa.float64())]
    whole = pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=["hash", "texts", "r0", "deck", "kwh"]
    )
    cut = disagg._pieces(["r1", "r2", "o0"], ["r0", "r1", "r2"], ["o0"], ["o0", "r2"], ["r0", "r1"])
    want, places = {}, {}
    for _, (r1, r2, o0), r0, deck, sums in rows:
        want |= {(o0, r2, r0, r1, deck * 8 + k): v for k, v in enumerate(sums) if v is not None}
        places.setdefault((r0, r1, r2), set()).add(o0)
    got, seen = {}, set()
    for batch in cut(whole.slice(i, 11) for i in range(0, len(whole), 11)):
        for p in batch.to_pylist():
            assert len(p["r0"]) == 1 or len(p["kwh"]) < limits[1] + 24
            for r0, r1 in zip(p["r0"], p["r1"], strict=True):
                assert (p["o0"], p["r2"], r0, r1) not in seen, "a key in two pieces"
                seen.add((p["o0"], p["r2"], r0, r1))
                assert p["several"] == (len(places[r0, r1, p["r2"]]) > 1)
            for line, shape, kwh in zip(p["line"], p["shape"], p["kwh"], strict=True):
                key = (p["o0"], p["r2"], p["r0"][line], p["r1"][line], shape)
                assert key not in got
                got[key] = kwh
    assert got == want and len(got) > 200


def test_more_shapes_than_slots(spark, frame):
    """An end use with more shapes than one row of sums holds; a shape that is NULL meets no hours."""
    maps = [("m1", "Cooking", f"stage{i}", f"s{i:02}" if i else None) for i in range(20)]
    shapes = frame(maps, "meas string, end_use string, tech_stage string, shape_ts string")
    annual = frame(
        [(f"c{i % 3}", "w0", "S", 2026, "ref", "r", "m1", "Cooking", "Gas", f"stage{i}", float(i + 1)) for i in range(20)],
        ANNUAL,
    )
    rows, schema = hour_rows("city", ["w0"], {f"s{i:02}": i + 1 for i in range(0, 20, 2)})
    args = (annual, shapes, frame(rows, schema), ["city"])
    want = disagg.disaggregate_hourly(*args)
    got = disagg.disaggregate_hourly(*args, hour_blocks=2)
    assert _sorted_rows(got, want.columns) == _sorted_rows(want, want.columns) and got.count() > 30
