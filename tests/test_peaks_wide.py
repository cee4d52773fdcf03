from __future__ import annotations

from datetime import datetime

from wattloom.functions import col
from wattloom.operators import peaks, reconcile, wide

H = datetime


def test_top_hours_keep_ties(frame):
    df = frame(
        [("c", 1, 5.0), ("c", 2, 5.0), ("c", 3, 4.0), ("d", 1, 1.0)], "place string, h int, v double"
    )
    top = peaks.top_hours(df, ["place"], "v", 1)
    assert sorted((r.place, r.h) for r in top.collect()) == [("c", 1), ("c", 2), ("d", 1)]
    two = peaks.top_hours(df, ["place"], "v", 2)
    assert sorted((r.place, r.h) for r in two.collect()) == [("c", 1), ("c", 2), ("d", 1)]


def test_day_profiles_resolve_ties_to_the_earlier_hour(frame):
    df = frame(
        [
            ("c", 2026, "a", H(2018, 1, 1, 5), 9.0),
            ("c", 2026, "a", H(2018, 1, 2, 5), 9.0),
            ("c", 2026, "a", H(2018, 1, 3, 5), 1.0),
            ("c", 2026, "a", H(2018, 1, 2, 6), 1.0),
            ("c", 2026, "b", H(2018, 1, 1, 5), 2.0),
            ("c", 2026, "b", H(2018, 1, 9, 5), 8.0),
        ],
        "place string, year int, turnover string, timestamp_hour timestamp, v double",
    )
    out = peaks.day_profiles(df, ["place", "year"], "turnover", "v").collect()
    peak_a = {(r.turnover, r.date.day) for r in out if r.day_type == "monthly_peak_day" and r.peak_source == "a"}
    assert peak_a == {("a", 1), ("b", 1)}  # both scenarios are shown on a's peak day
    low_a = {r.date.day for r in out if r.day_type == "monthly_min_peak_day" and r.peak_source == "a"}
    assert low_a == {2}
    mean = {(r.turnover, r.hour_of_day): r.v for r in out if r.day_type == "monthly_mean"}
    assert mean[("a", 6)] == 19.0 / 3 and mean[("a", 7)] == 1.0


def test_example_places_in_one_plan(frame):
    changes = frame(
        [(f"c{i}", float(i)) for i in range(6)] + [("n", None)], "place string, percent_difference double"
    )
    fixed = frame([("z", "Hot")], "place string, example_type string")
    got = sorted(tuple(r) for r in peaks.example_places(changes, "place", fixed).collect())
    assert got == [
        ("c0", "Large decrease"), ("c1", "Large decrease"),
        ("c4", "Large increase"), ("c5", "Large increase"), ("z", "Hot"),
    ]


def test_rows_of_maximum_day(frame):
    df = frame(
        [("c", "d1", "base", 9.0), ("c", "d1", "x", 1.0), ("c", "d2", "x", 5.0), ("c", "d2", "base", 2.0)],
        "place string, day string, turnover string, v double",
    )
    out = peaks.rows_of_maximum_day(df, ["place"], "day", "v", col("turnover") != "base")
    assert sorted((r.turnover, r.v) for r in out.collect()) == [("base", 2.0), ("x", 5.0)]


def test_winter_share_and_season_ratio(frame):
    df = frame(
        [("c", H(2018, 1, 1), 4.0), ("c", H(2018, 7, 1), 2.0), ("c", H(2018, 4, 1), 8.0), ("d", H(2018, 7, 1), 1.0)],
        "place string, timestamp_hour timestamp, v double",
    )
    share = {r.place: r.share_winter for r in peaks.winter_share(df, ["place"], "v", 2).collect()}
    assert share == {"c": 0.5, "d": 0.0}
    from pyspark.sql import functions as F

    ratio = {
        r.place: (r.winter_to_summer, r.log_winter_to_summer)
        for r in peaks.season_ratio(df, ["place"], F.month("timestamp_hour"), "v").collect()
    }
    assert ratio["c"][0] == 2.0 and round(ratio["c"][1], 5) == 0.30103
    assert ratio["d"] == (None, None)


def test_binned_caps(frame):
    df = frame([(9.0,), (0.26,), (-0.31,)], "x double")
    got = [round(r[0], 6) for r in df.select(peaks.binned(col("x"))).collect()]
    assert got == [3.0, 0.3, -0.3]


HOURLY = (
    "turnover string, year int, sector string, `in.state` string, `in.county` string, "
    "timestamp_hour timestamp, end_use string, fuel string, "
    "county_hourly_uncal_kwh double, county_hourly_cal_kwh double"
)


def test_wide_hourly_does_not_mix_fuels(frame):
    hour = H(2018, 1, 1, 5)
    df = frame(
        [
            ("ref", 2026, "res", "S", "c", hour, "Cooking", "Electric", 1.0, 2.0),
            ("ref", 2026, "res", "S", "c", hour, "Cooking", "Natural Gas", 9.0, 9.0),
            ("ref", 2026, "res", "S", "c", hour, "Lighting", "Electric", 3.0, 4.0),
            ("baseline", 2026, "res", "S", "c", hour, "Lighting", "Electric", 5.0, 6.0),
            ("ref", 2026, "res", "S", "c", H(2020, 2, 29), "Lighting", "Electric", 1.0, 1.0),
        ],
        HOURLY,
    )
    (r,) = wide.wide_hourly(df).collect()
    assert (r.uncal_cooking, r.cal_lighting, r.uncal_other) == (1.0, 4.0, None)
    assert r.date_time == H(2026, 1, 1, 5) and r.sector == "Residential"
    assert len(wide.wide_hourly(df).columns) == 6 + 18
    (b,) = wide.wide_hourly(df, baseline=True).collect()
    assert b.uncal_lighting == 5.0
    assert [tuple(r) for r in wide.unstampable(df).collect()] == [(2026, 1)]


def test_wide_annual_columns(frame):
    projection = frame(
        [
            ("ref", 2026, "res", "S", "Heating (Equip.)", "Electric", 1.0),
            ("ref", 2026, "res", "S", "Heating (Equip.)", "Electric", 2.0),
            ("ref", 2026, "res", "S", "Heating (Equip.)", "Propane", 4.0),
            ("ref", 2026, "res", "S", "Heating (Equip.)", "Coal", 5.0),
            ("ref", 2027, "res", "S", "Heating (Equip.)", "Coal", 5.0),
        ],
        "turnover string, year int, sector string, reg string, end_use string, fuel string, state_ann_kwh double",
    )
    hourly = frame(
        [
            ("ref", 2026, "res", "S", "c", H(2018, 1, 1), "Heating (Equip.)", "Electric", 1.0, 7.0),
            ("ref", 2026, "res", "S", "c", H(2018, 1, 1), "Heating (Equip.)", "Propane", 1.0, 70.0),
            ("ref", 2026, "com", "S", "c", H(2018, 1, 1), "Ventilation", "Electric", 1.0, 8.0),
        ],
        HOURLY,
    )
    out = wide.wide_annual(projection, hourly)
    assert len(out.columns) == 4 + 30
    rows = {r.sector: r for r in out.collect()}
    assert rows["res"]["electricity_uncalibrated.heating.kwh"] == 3.0
    assert rows["res"]["propane.heating.kwh"] == 4.0
    assert rows["res"]["other.heating.kwh"] == 5.0
    assert rows["res"]["electricity_calibrated.heating.kwh"] == 7.0
    assert rows["com"]["electricity_calibrated.ventilation.kwh"] == 8.0


def test_reconcile_keeps_one_sided_and_null_keys(frame):
    a = frame([("x", 1.0), ("x", 1.0), (None, 3.0), ("only_a", 4.0)], "k string, v double")
    b = frame([("x", 2.002), (None, 3.0), ("only_b", 1.0)], "k string, w double")
    out = reconcile.reconcile({"base": (a, "v"), "other": (b, "w")}, ["k"])
    got = {r.k: (r.base, r.other) for r in out.collect()}
    assert got == {"x": (2.0, 2.002), None: (3.0, 3.0), "only_a": (4.0, None), "only_b": (None, 1.0)}
    bad = {r.k for r in reconcile.unreconciled(out, "base", ["other"], 0.001).collect()}
    assert bad == {"only_a", "only_b"}
    strict = {r.k for r in reconcile.unreconciled(out, "base", ["other"], 0.0009).collect()}
    assert strict == {"x", "only_a", "only_b"}


def test_conservation_totals(frame):
    a = frame([("x", 2.0), ("y", 0.0)], "k string, v double")
    b = frame([("x", 3.0), ("z", 1.0)], "k string, v double")
    out = reconcile.conservation(a, b, ["k"], "v", {"ALL": col("k").isNotNull(), "X": col("k") == "x"})
    got = {(r.scope, r.k): (r.delta, r.pct_delta) for r in out.collect()}
    assert got[("ALL", "x")] == (1.0, 0.5)
    assert got[("ALL", "y")] == (0.0, 0.0)
    assert got[("ALL", "z")] == (1.0, float("inf"))
    assert got[("ALL_TOTAL", "ALL")] == (2.0, 1.0)
    assert got[("X_TOTAL", "ALL")] == (1.0, 0.5)


def test_coverage_and_status(frame):
    used = frame([("g1", "E"), ("g1", "E"), ("g2", "E")], "g string, f string")
    mult = frame([("g1", "E", 0.5), ("g1", "E", 0.5), ("g1", "E", float("nan"))], "g string, f string, m double")
    got = {r.g: r.mult_sum for r in reconcile.coverage(used, mult, ["g", "f"], "m").collect()}
    assert got == {"g1": 1.0, "g2": None}
    assert [r.g for r in reconcile.off_by(reconcile.coverage(used, mult, ["g", "f"], "m"), "mult_sum").collect()] == ["g2"]


def test_compare_sources(frame):
    a = frame([("x", 1.0), ("y", float("nan"))], "k string, v double")
    b = frame([("x", 4.0), ("z", 2.0)], "k string, v double")
    out = reconcile.compare_sources({"a": (a, "v", col("k") != "q"), "b": (b, "v", col("k") != "q")}, ["k"], {"d": ("a", "b")})
    got = {r.k: (r.a, r.b, r.d) for r in out.collect()}
    assert got == {"x": (1.0, 4.0, 0.75), "z": (0.0, 2.0, 1.0)}
