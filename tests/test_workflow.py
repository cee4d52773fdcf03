"""The whole chain on small synthetic buildings, checked by its own invariants."""

from __future__ import annotations

import json
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import types as T

from wattloom.functions import col
from wattloom.operators import scenario
from wattloom.plans import commercial as com
from wattloom.plans import residential as res
from wattloom.plans import workflow

COUNTIES = {"c1": ("AL", "w1", 1.0), "c2": ("AL", "w2", 2.0), "c3": ("GA", "w2", 2.0)}
HOURS = [datetime(2018, 12, 30) + timedelta(minutes=30 * i) for i in range(96)]


def outputs(specs, profiles):
    texts = [v for s in specs for v in s.values.values()]
    texts += [x for p in profiles for x in (p.primary, p.secondary) if x]
    names = {}
    for text in texts:
        for name in re.findall(r"`([^`]+)`", text):
            names[name] = None
    return [n for n in names if not n.startswith("in.")]


def schema(strings, doubles, extra=()):
    fields = [T.StructField(n, T.StringType()) for n in strings]
    fields += [T.StructField(n, T.DoubleType()) for n in doubles]
    return T.StructType(fields + [T.StructField(n, t) for n, t in extra])


@pytest.fixture(scope="module")
def tables(spark):
    from wattloom.sources.readers import literal_table

    rng = np.random.default_rng(3)
    made = {}

    res_cols = [n for n in outputs(res.ANNUAL, ()) ]
    ts_cols = outputs((), res.HOURLY)
    res_chars = [
        "in.cooking_range", "in.clothes_dryer", "in.heating_fuel", "in.hvac_cooling_type",
        "in.water_heater_efficiency", "in.hvac_heating_type_and_fuel",
    ]
    meta, series = [], []
    for b in range(9):
        county = list(COUNTIES)[b % 3]
        state, city, lon = COUNTIES[county]
        fuel = ["Electricity", "Natural Gas", "Propane"][b // 3]
        for upgrade in (0, 16):
            meta.append(
                (f"{b}", county, state, city, fuel, fuel, fuel, "AC", fuel, fuel,
                 *map(float, rng.random(len(res_cols)) + 0.1), lon, upgrade)
            )
            for ts in HOURS:
                series.append(
                    (f"{b}", state, str(upgrade), *map(float, rng.random(len(ts_cols)) + 0.1),
                     int(ts.timestamp() - datetime(1970, 1, 1).timestamp()) * 1_000_000_000)
                )
    made["meta_res"] = literal_table(
        spark, meta,
        schema(["bldg_id", "in.county", "in.state", "in.weather_file_city", *res_chars], res_cols,
               [("in.weather_file_longitude", T.DoubleType()), ("upgrade", T.IntegerType())]),
    )
    made["ts_res"] = literal_table(
        spark, series,
        schema(["bldg_id", "state", "upgrade"], ts_cols, [("timestamp", T.LongType())]),
    )

    com_doubles = [n for n in outputs(com.ANNUAL, ()) if not n.endswith("_fuel_type")]
    types = [f"out.params.{one}_fuel_type" for one, _ in com.APPLIANCES]
    com_ts = outputs((), com.HOURLY)
    com_chars = [
        "in.heating_fuel", "in.hvac_combined_type", "in.service_water_heating_fuel",
        "in.hvac_cool_type", "in.hvac_category", "in.hvac_heat_type", "applicability",
        "in.building_type",
    ]
    meta, series = [], []
    for b in range(6):
        # One model building stands for buildings in two counties.
        for county in (list(COUNTIES)[b % 3], list(COUNTIES)[(b + 1) % 3]):
            state = COUNTIES[county][0]
            for upgrade in (0, 28, 40):
                meta.append(
                    (f"{b}", county, state, state, "Gas", "RTU", "Gas", "DX", "Small", "Furnace",
                     "TRUE", "Hospital", *(["Electric", "Gas"] * 3),
                     *map(float, rng.random(len(com_doubles)) + 0.1), float(b + 1), upgrade)
                )
        for state in ("AL", "GA"):
            for upgrade in (0, 40):
                for ts in HOURS:
                    base = rng.random(len(com_ts)) + 0.1 + (1.5 if upgrade else 0.0)
                    series.append((f"{b}", state, str(upgrade), *map(float, base), ts))
    made["meta_com"] = literal_table(
        spark, meta,
        schema(["bldg_id", com.COUNTY, "in.state", "state", *com_chars, *types], com_doubles,
               [("weight", T.DoubleType()), ("upgrade", T.IntegerType())]),
    )
    made["ts_com"] = literal_table(
        spark, series,
        schema(["bldg_id", "state", "upgrade"], com_ts, [("timestamp", T.TimestampType())]),
    )
    gap = [
        (c, datetime(2018, 12, 30) + timedelta(hours=h + 1), float(rng.random()))
        for c in COUNTIES for h in range(48)
    ]
    made["gap_com"] = literal_table(
        spark, gap, schema(["in.county"], [], [("timestamp", T.TimestampType()), (com.GAP_VALUE, T.DoubleType())])
    )
    made["zones"] = literal_table(
        spark, [(c, s, "E" if s == "GA" else "C") for c, (s, _, _) in COUNTIES.items()],
        "`in.county` string, `in.state` string, tz string",
    )
    buildings = workflow.Buildings(**made)

    def text_map(columns, rows):
        return literal_table(spark, rows, ", ".join(f"`{c}` string" for c in columns))

    fuels = ["Electricity", "Natural Gas", "Propane"]
    maps = {
        "res_ann_cook": text_map(["in.cooking_range", "upgrade", "group_ann"], [(f, "0", "cook_1") for f in fuels]),
        "res_ann_dry": text_map(["in.clothes_dryer", "upgrade", "group_ann"], [(f, "0", "dry_1") for f in fuels]),
        "res_ann_hvac": text_map(
            ["in.heating_fuel", "in.hvac_cooling_type", "upgrade", "group_ann"],
            [(f, "AC", "0", "hvac_1") for f in fuels] + [("Propane", "AC", "0", "res_hvac_ann_52")],
        ),
        "res_ann_wh": text_map(["in.water_heater_efficiency", "upgrade", "group_ann"], [(f, "0", "wh_1") for f in fuels]),
        "res_ts_cooling": text_map(["in.hvac_cooling_type", "upgrade", "shape_ts"], [("AC", "0", "cool_ts")]),
        "res_ts_heating": text_map(
            ["in.hvac_heating_type_and_fuel", "upgrade", "shape_ts"],
            [(f, "0", "heat_ts") for f in fuels] + [(f, "16", "heat_ts_16") for f in fuels],
        ),
        "res_ts_cook": text_map(["in.cooking_range", "upgrade", "shape_ts"], [(f, "0", "cook_ts") for f in fuels]),
        "res_ts_dry": text_map(["in.clothes_dryer", "upgrade", "shape_ts"], [(f, "0", "dry_ts") for f in fuels]),
        "res_ts_wh": text_map(["in.water_heater_efficiency", "upgrade", "shape_ts"], [(f, "0", "wh_ts") for f in fuels]),
        "com_ann_hvac": text_map(["in.heating_fuel", "in.hvac_combined_type", "upgrade", "group_ann"], [("Gas", "RTU", "0", "chvac_1")]),
        "com_ann_wh": text_map(["in.service_water_heating_fuel", "upgrade", "group_ann"], [("Gas", "0", "cwh_1")]),
        "com_ts_cooling": text_map(["in.hvac_cool_type", "in.hvac_category", "applicability", "upgrade", "shape_ts"], [("DX", "Small", "TRUE", "0", "ccool_ts")]),
        "com_ts_heating": text_map(["in.heating_fuel", "in.hvac_heat_type", "applicability", "upgrade", "shape_ts"], [("Gas", "Furnace", "TRUE", "0", "cheat_ts")]),
        "com_ts_ventilation": text_map(
            ["in.hvac_cool_type", "in.hvac_category", "in.hvac_heat_type", "applicability", "upgrade", "shape_ts"],
            [("DX", "Small", "Furnace", "TRUE", "0", "cvent_ts")],
        ),
    }
    measure_map = text_map(
        ["meas", "end_use", "original_ann", "measure_ann", "original_ts", "measure_ts", "sector"],
        [
            ("(R) HP", res.HEATING, "hvac_1", "res_hvac_ann_86", "heat_ts", "heat_ts_16", "res"),
            ("(R) Light", res.LIGHTING, "res_light_ann_1", "res_light_ann_1", "res_light_ts_1", "res_light_ts_1", "res"),
            ("(C) Cook", com.COOKING, "com_cook_ann_1", "com_cook_ann_1", "com_cook_ts_1", "com_cook_ts_1", "com"),
            ("(C) Vent", com.VENTILATION, "com_hvac_ann_41", "chvac_1", "com_ventilation_11", "cvent_ts", "com"),
            ("Gap", com.VENTILATION, "com_gap_ann_1", "com_gap_ann_1", "com_gap_ts_1", "com_gap_ts_1", "com"),
            ("Gap", com.COOKING, "com_gap_ann_1", "com_gap_ann_1", "com_gap_ts_1", "com_gap_ts_1", "com"),
        ],
    )

    def market(use, kind, fuel, scale):
        def at(v):
            return {s: {kind: {use: {fuel: {"2026": v * scale, "2030": 2 * v * scale}}}} for s in ("AL", "GA")}
        return {
            "Markets and Savings (by Category)": {
                "Max": {scenario.EFFICIENT: at(10.0), scenario.MEASURE: at(4.0), scenario.BASELINE: at(12.0)}
            }
        }

    def document(scale):
        doc = {
            "(R) HP": market(res.HEATING, "Home", "Electric", scale),
            "(R) Light": market(res.LIGHTING, "Home", "Electric", scale),
            "(C) Cook": market(com.COOKING, "Office", "Electric", scale),
            "(C) Vent": market(com.VENTILATION, "Office", "Electric", scale),
            "Run": {},
        }
        doc["(C) Cook"]["Gap Weights"] = {"Office": {"2026": 0.3, "2030": 0.4}}
        return literal_table(spark, [(json.dumps(doc),)], "value string")

    scenarios = {"ref": document(1.0), "high": document(3.0)}
    ratios = literal_table(
        spark, [("res", "AL", 12, "Electric", 1.5)],
        "sector string, `in.state` string, month int, fuel string, calibration_multiplier double",
    )
    packages = literal_table(
        spark, [("p", "q", "equipment")], "meas string, meas_separated string, component string"
    )
    return buildings, maps, measure_map, packages, scenarios, ratios


@pytest.fixture(scope="module")
def written(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    paths = workflow.run_all(spark, *tables, workflow.Layout(root), "r1")
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def test_every_multiplier_group_sums_to_one(written):
    annual = {s: written[f"annual_multipliers_{s}"] for s in ("res", "com")}
    hourly = {s: written[f"hourly_multipliers_{s}"] for s in ("res", "com")}
    for name, bad in workflow.multiplier_checks(annual, hourly).items():
        assert bad.collect() == [], name
    groups = {r.group_ann for r in annual["res"].select("group_ann").distinct().collect()}
    assert {"hvac_1", "res_hvac_ann_52", "res_hvac_ann_86", "res_hvac_ann_87", "res_misc_ann_1"} <= groups
    # The delivered-heat group comes from its own spec; the map's copy is excluded.
    fuels = annual["res"].filter(col("group_ann") == "res_hvac_ann_52").select("fuel").distinct()
    assert fuels.count() == 5
    uses = annual["com"].filter(col("group_ann") == "com_gap_ann_1").select("end_use").distinct()
    assert uses.count() == 10


def test_weather_places_cross_states(written):
    shapes = written["hourly_multipliers_res"].filter(
        (col("shape_ts") == "heat_ts") & (col("fuel") == "Electric")
    )
    assert shapes.select("timestamp_hour").distinct().count() == 48
    # 23:00 and later of 31 December belong to the first hour of the base year.
    assert shapes.filter(col("timestamp_hour") == datetime(2018, 1, 1)).count() == 2
    assert shapes.count() == 2 * 48


def test_nothing_is_lost_on_the_way_down(written):
    checks = workflow.county_checks(
        written["projection"].filter(col("state_ann_kwh").isNotNull()),
        written["long_county_annual"],
        written["long_county_hourly"],
    )
    for name, bad in checks.items():
        assert bad.collect() == [], name


def test_calibration_touches_only_known_months(written):
    hours = written["long_county_hourly"]
    off = hours.filter(
        (col("county_hourly_cal_kwh") - col("county_hourly_uncal_kwh")) > 1e-12
    )
    got = {tuple(r) for r in off.selectExpr("sector", "`in.state`", "month(timestamp_hour)").distinct().collect()}
    assert got == {("res", "AL", 12)}


def test_gap_rows_and_baseline(written):
    projection = written["projection"]
    assert projection.filter(col("turnover") == "baseline").count() > 0
    gap = projection.filter((col("meas") == "Gap") & (col("end_use") == com.COOKING) & (col("year") == 2030))
    values = {(r.turnover, r.reg, r.tech_stage): r.state_ann_kwh for r in gap.collect()}
    assert values[("ref", "AL", "measure_ann")] == pytest.approx(0.4 * 8.0 / 3412 * 1e6)


def test_published_tables(written):
    wide = written["wide_county_hourly"]
    assert {r.scenario for r in wide.select("scenario").distinct().collect()} == {"ref", "high"}
    (total,) = wide.filter((col("year") == 2026) & (col("scenario") == "ref")).selectExpr(
        "sum(uncal_lighting)"
    ).first()
    assert total == pytest.approx(2 * 10.0 / 3412 * 1e6, rel=1e-6)
    annual = written["wide_annual_state"].filter(col("year") == 2026).collect()
    res_row = next(r for r in annual if r.sector == "res" and r.state == "AL" and r.scenario == "ref")
    assert res_row["electricity_uncalibrated.heating.kwh"] == pytest.approx(10.0 / 3412 * 1e6)
    ratio = res_row["electricity_calibrated.heating.kwh"] / res_row["electricity_uncalibrated.heating.kwh"]
    assert 1.0 < ratio < 1.5  # one hour of the sample falls into January


def test_extracts_and_checks_run(written, tables):
    hours = written["long_county_hourly"]
    for name, df in workflow.extracts(hours, 2026, 2030).items():
        assert df.count() > 0, name
    change = workflow.extracts(hours, 2026, 2030)["county_peak_hour"].first()
    # Energy doubles; only the gap share differs between the two years.
    assert change.percent_change == pytest.approx(1.0, abs=0.2)
    assert workflow.air_quality(hours).filter(col("turnover") == "baseline").count() == 0
    _, _, measure_map, packages, scenarios, _ = tables
    checks = workflow.projection_checks(
        scenarios["ref"], written["projection"], measure_map, packages
    )
    assert checks["unmapped_measures"].count() == 0
    assert checks["unmapped_packages"].count() == 0


def test_residential_gap_shape(tables):
    out = workflow.gap_shape_res(tables[0])
    sums = out.groupBy(col("in.weather_file_city")).sum("multiplier_hourly").collect()
    assert all(r[1] == pytest.approx(1.0) for r in sums) and len(sums) == 2


def test_coverage_and_split_checks(written, tables, frame):
    _, _, measure_map, packages, scenarios, _ = tables
    annual = {s: written[f"annual_multipliers_{s}"] for s in ("res", "com")}
    counties = {s: written[f"county_annual_{s}"] for s in ("res", "com")}
    hourly = {s: written[f"hourly_multipliers_{s}"] for s in ("res", "com")}
    checks = workflow.coverage_checks(
        written["projection"], measure_map, annual, counties, hourly
    )
    for name, bad in checks.items():
        assert bad.collect() == [], name
    # Without the gap group its combinations show up.
    annual["com"] = annual["com"].filter(col("group_ann") != "com_gap_ann_1")
    bad = workflow.coverage_checks(
        written["projection"], measure_map, annual, counties, hourly
    )["annual"].collect()
    assert {r.group_ann for r in bad} == {"com_gap_ann_1"}
    split = workflow.split_check(scenarios["ref"], packages, "ref", "r1").collect()
    assert split and all(abs(r.delta) < 1e-6 for r in split)


def test_publication(spark, written, tmp_path):
    paths = workflow.publish(
        written["long_county_hourly"],
        written["wide_county_hourly"],
        written["hourly_multipliers_com"],
        workflow.Layout(str(tmp_path)),
    )
    back = {n: spark.read.parquet(p) for n, p in paths.items()}
    assert back["published_county_hourly"].count() == written["wide_county_hourly"].count()
    electric = written["long_county_hourly"].selectExpr("sum(county_hourly_cal_kwh)").first()[0]
    total = back["published_totals"].selectExpr("sum(buildings_kwh)").first()[0]
    assert total == pytest.approx(electric)
    assert back["multipliers_by_county"].select("in_county").distinct().count() == 3
    assert back["air_quality"].filter(col("turnover") == "baseline").count() == 0
