from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.functions import col
from wattloom.operators import mapping, reconcile, shares
from wattloom.operators.shares import Target, targets
from wattloom.plans.specs import AnnualSpec, annual_multipliers, gap_annual


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_zero_total_null_value_and_null_key(frame):
    df = frame(
        [
            ("c1", "A", 3.0),
            ("c2", "A", 1.0),
            ("c3", "B", 0.0),
            ("c4", "B", 0.0),
            ("c5", None, 5.0),
            ("c6", None, 5.0),
            ("c7", "A", None),
        ],
        "place string, state string, v double",
    )
    free = shares.share_of_group(
        df, ["place", "state"], ["state"], {"v": col("v")}, targets("v", "Other", ["E"])
    )
    got = {r.place: r.multiplier for r in free.collect()}
    assert got == {
        "c1": 0.75,
        "c2": 0.25,
        "c3": None,
        "c4": None,
        "c5": 0.5,
        "c6": 0.5,
        "c7": None,
    }
    guarded = shares.share_of_group(
        df,
        ["place", "state"],
        ["state"],
        {"v": col("v")},
        targets("v", "Other", ["E"], guard=True),
    )
    assert {r.place for r in guarded.collect()} == {"c1", "c2", "c5", "c6", "c7"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_multipliers_sum_to_one_on_random_data(spark, frame, seed):
    rng = np.random.default_rng(seed)
    # One state holds a third of all rows.
    states = np.where(rng.random(3000) < 1 / 3, 0, rng.integers(0, 9, 3000))
    data = [
        (f"c{rng.integers(0, 40)}", f"s{s}", f"g{rng.integers(0, 4)}", float(v))
        for s, v in zip(states, rng.random(3000), strict=True)
    ]
    df = frame(data, "place string, state string, grp string, v double")
    out = shares.share_of_group(
        df,
        ["place", "state"],
        ["state", "grp"],
        {"v": col("v"), "w": col("v") * 2},
        targets("v", "Other", ["E", "P"], True) + targets("w", "Cooking", ["E"]),
    )
    sums = reconcile.multiplier_sums(
        out, ["state", "grp", "end_use", "fuel"], "multiplier", place="place"
    )
    assert reconcile.off_by(sums, low=1 - 1e-9, high=1 + 1e-9).count() == 0
    assert sums.count() == len({(d[1], d[2]) for d in data}) * 3


def test_attach_groups_casts_upgrade_and_fans_out(frame):
    meta = frame(
        [("b1", "gas", 0), ("b2", "gas", 11), ("b3", "el", 0), ("b4", None, 0)],
        "id string, `in.range` string, upgrade int",
    )
    chars = frame(
        [("gas", "0", "g1"), ("gas", "0", "g2"), ("el", "0", "g3"), ("gas", "11", "g4")],
        "`in.range` string, upgrade string, group_ann string",
    )
    out = mapping.attach_groups(meta, chars, ["in.range"], "group_ann", exclude=["g3"])
    got = sorted((r.id, r.group_ann) for r in out.collect())
    assert got == [("b1", "g1"), ("b1", "g2"), ("b2", "g4")]


def test_literal_specs_share_one_pass_but_keep_their_own_rows(frame):
    meta = frame(
        [
            ("c1", "S", 0, "gas", 4.0),
            ("c2", "S", 0, "Electricity", 6.0),
            ("c2", "S", 16, "gas", 9.0),
        ],
        "`in.county` string, `in.state` string, upgrade int, `in.heating_fuel` string, x double",
    )
    specs = (
        AnnualSpec("all", {"v": "x"}, targets("v", "Heating", ["E"]), group="g1"),
        AnnualSpec(
            "gas",
            {"v": "x"},
            targets("v", "Heating", ["E"]),
            group="g2",
            where="upgrade = 0 AND `in.heating_fuel` != 'Electricity'",
        ),
        AnnualSpec(
            "later", {"v": "x"}, targets("v", "Cooling", ["E", "G"]), group="g3",
            where="upgrade = 16",
        ),
    )
    out = annual_multipliers(meta, {}, specs, ["in.county"], "res")
    got = sorted(
        (r["in.county"], r.group_ann, r.fuel, r.multiplier_annual) for r in out.collect()
    )
    assert got == [
        ("c1", "g1", "E", 0.4),
        ("c1", "g2", "E", 1.0),
        ("c2", "g1", "E", 0.6),
        ("c2", "g3", "E", 1.0),
        ("c2", "g3", "G", 1.0),
    ]


def test_gap_keeps_counties_without_a_state(frame):
    gap = frame(
        [("c1", 1.0), ("c1", 2.0), ("c2", 1.0), ("x", 7.0)], "`in.county` string, kwh double"
    )
    known = frame([("c1", "S"), ("c2", "S")], "`in.county` string, `in.state` string")
    out = gap_annual(gap, known, "kwh", ["Gap", "Other"])
    got = {(r["in.county"], r.end_use): (r["in.state"], r.multiplier_annual) for r in out.collect()}
    assert got[("c1", "Gap")] == ("S", 0.75)
    assert got[("c2", "Other")] == ("S", 0.25)
    assert got[("x", "Gap")] == (None, 1.0)


def test_nested_shares(frame):
    df = frame(
        [("a", "x", 1.0), ("b", "x", 3.0), ("c", "y", 4.0)], "m string, u string, v double"
    )
    out = shares.nested_shares(
        df.withColumn("one", F.lit(1)),
        ["m", "u", "one"],
        col("v"),
        {"of_use": ["u", "one"], "of_all": ["one"]},
    )
    got = {r.m: (r.of_use, r.of_all) for r in out.collect()}
    assert got == {"a": (0.25, 0.125), "b": (0.75, 0.375), "c": (1.0, 0.5)}


def test_fan_out_is_one_scan(frame):
    df = frame([("c", "s", 1.0)], "place string, state string, v double")
    out = shares.share_of_group(
        df,
        ["place", "state"],
        ["state"],
        {"v": col("v")},
        tuple(Target("v", f"use{i}", "E") for i in range(10)),
    )
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    assert out.count() == 10


def test_missing_keys_compare_nulls(frame):
    used = frame([("a", None), ("b", "x"), ("b", "x")], "m string, u string")
    known = frame([("a", None)], "m string, u string")
    assert rows(mapping.missing_keys(used, known, ["m", "u"])) == [("b", "x")]


def test_replace_rows_and_variants(frame):
    base = frame([("Gap", "g1"), ("m", "g2")], "meas string, grp string")
    new = frame([("Gap", "g9")], "meas string, grp string")
    swapped = mapping.replace_rows(base, col("meas") == "Gap", new)
    assert rows(swapped) == [("Gap", "g9"), ("m", "g2")]
    tagged = mapping.tagged_variants({"always": base, "never": swapped})
    assert sorted((r.kind, r.grp) for r in tagged.collect()) == [
        ("always", "g1"),
        ("always", "g2"),
        ("never", "g2"),
        ("never", "g9"),
    ]
