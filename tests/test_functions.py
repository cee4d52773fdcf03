from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import functions as F

from wattloom import functions as X

NAN = float("nan")


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_number_rules_reject_null_and_nan(frame):
    df = frame([(1.0,), (-1.0,), (None,), (NAN,), (0.0,)], "x double")
    x = F.col("x")
    assert values(df, X.is_number(x)) == [True, True, False, False, True]
    kept = [r.x for r in df.filter(X.non_negative(x)).collect()]
    assert kept == [1.0, 0.0]
    assert values(df, X.out_of_tolerance(x)) == [False, True, True, True, True]


def test_ratio_without_denominator_is_null(frame):
    df = frame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    assert values(df, X.safe_ratio(F.col("a"), F.col("b"))) == [0.5, None, None, None]
    assert values(df, X.relative_difference(F.col("a"), F.col("b")))[0] == 0.5


def test_percent_delta_zero_and_infinity(frame):
    df = frame([(2.0, 3.0), (0.0, 0.0), (0.0, 1.0)], "a double, b double")
    assert values(df, X.percent_delta(F.col("a"), F.col("b"))) == [0.5, 0.0, math.inf]


def test_hour_ending_wraps_at_the_year_end(frame):
    df = frame(
        [
            (datetime(2018, 3, 1, 7, 15),),
            (datetime(2018, 12, 31, 23, 45),),
            (datetime(2018, 12, 31, 22, 59),),
        ],
        "ts timestamp",
    )
    got = [r[0] for r in df.select(X.align_hour(F.col("ts")).cast("string")).collect()]
    assert got == ["2018-03-01 08:00:00", "2018-01-01 00:00:00", "2018-12-31 23:00:00"]


def test_epoch_nanos_keeps_whole_seconds(frame):
    df = frame([(1_514_764_800_999_999_999,), (1_514_764_801_000_000_000,)], "n bigint")
    got = values(df, X.epoch_nanos_to_timestamp(F.col("n")).cast("string"))
    assert got == ["2018-01-01 00:00:00", "2018-01-01 00:00:01"]


def test_restamp_drops_a_day_the_year_lacks(frame):
    df = frame(
        [(datetime(2020, 2, 29, 5), 2026), (datetime(2018, 7, 4, 5, 6, 7), 2026)],
        "ts timestamp, y int",
    )
    got = values(df, X.restamp_year(F.col("ts"), F.col("y")).cast("string"))
    assert got == [None, "2026-07-04 05:06:07"]


def test_seasons_and_text(frame):
    months = frame([(m,) for m in range(1, 13)], "m int")
    got = values(months, X.season(F.col("m")))
    assert got == ["Winter"] * 2 + ["Shoulder"] * 2 + ["Summer"] * 5 + ["Shoulder"] + [
        "Winter"
    ] * 2
    names = frame(
        [("(C) Best HP",), ("(R) HP",), ("Gap",), ("X (C)",), (None,)], "meas string"
    )
    assert values(names, X.sector_of(F.col("meas"))) == ["com", "res", "com", None, None]
    uses = frame([("Heating (Equip.)",), ("Computers and Electronics",)], "u string")
    assert values(uses, X.slug(F.col("u"))) == [
        "heating_equip_",
        "computers_and_electronics",
    ]


def test_units_and_bins(frame):
    df = frame([(3.412,), (0.26,)], "x double")
    assert values(df, X.mmbtu_to_kwh(F.col("x")))[0] == 1000.0
    assert round(values(df, X.round_any(F.col("x"), 0.1))[1], 6) == 0.3
