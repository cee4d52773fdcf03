from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException

from wattloom.functions import col
from wattloom.operators import scenario, stock

DOC = {
    "(C) HP": {
        "Markets and Savings (by Category)": {
            "Max": {
                scenario.EFFICIENT: {"AL": {"Office": {"Heating (Equip.)": {"Electric": {"2026": 34.12, "2030": 3.412}}}}},
                scenario.MEASURE: {"AL": {"Office": {"Heating (Equip.)": {"Electric": {"2026": 3.412}}}}},
                scenario.BASELINE: {"AL": {"Office": {"Heating (Equip.)": {"Electric": {"2026": 68.24}}}}},
                "Other Metric": {"AL": {"Office": {"Heating (Equip.)": {"Electric": {"2026": 1.0}}}}},
            }
        },
        "Model Gap Weights": {"Office": {"2026": 0.25}},
    },
    "(R) Light": {
        "Markets and Savings (by Category)": {
            "Max": {
                scenario.EFFICIENT: {"AL": {"Home": {"Lighting": {"2026": 6.824, "2030": 3.412}}}},
                scenario.MEASURE: {"AL": {"Home": {"Lighting": {"2026": 3.412}}}},
            }
        }
    },
    "(R) Pack": {
        "Markets and Savings (by Category)": {
            "Max": {
                scenario.EFFICIENT: {"AL": {"Home": {"Heating (Equip.)": {"Natural Gas": {"2026": 341.2}}}}},
                scenario.MEASURE: {"AL": {"Home": {"Heating (Equip.)": {"Natural Gas": {"2026": 34.12}}}}},
                scenario.ENVELOPE: {"AL": {"Home": {"Heating (Equip.)": {"Natural Gas": {"2026": 3.412}}}}},
                scenario.BASELINE: {"AL": {"Home": {"Heating (Equip.)": {"Natural Gas": {"2026": 341.2}}}}},
            }
        }
    },
    "Energy Output Type": {"Markets and Savings (by Category)": {"Max": {}}},
}
PACKAGES = [
    ("(R) Pack", "(R) Pack HP", "equipment"),
    ("(R) Pack", "(R) Pack & Env.", "equipment + env"),
]


@pytest.fixture
def docs(frame):
    return frame([(json.dumps(DOC, indent=1),)], "value string")


@pytest.fixture
def packages(frame):
    return frame(PACKAGES, "meas string, meas_separated string, component string")


def test_flatten_handles_both_depths_and_skips_the_last_key(docs):
    rows = scenario.flatten_scenario(docs).collect()
    assert {r.meas for r in rows} == {"(C) HP", "(R) Light", "(R) Pack"}
    assert len(rows) == 12
    light = {(r.metric, r.year): (r.fuel, r.value) for r in rows if r.meas == "(R) Light"}
    assert light[(scenario.EFFICIENT, 2030)] == ("Electric", 3.412)
    heat = [r for r in rows if r.meas == "(R) Pack" and r.metric == scenario.ENVELOPE]
    assert [(r.fuel, r.year, r.value) for r in heat] == [("Natural Gas", 2026, 3.412)]


def test_flatten_keeps_scenario_tags_of_many_files(spark, tmp_path):
    from wattloom.sources.readers import read_documents

    for name in ("aa", "bb"):
        (tmp_path / f"{name}.json").write_text(json.dumps(DOC))
    tagged = read_documents(spark, [str(tmp_path / "aa.json"), str(tmp_path / "bb.json")])
    out = scenario.flatten_scenario(tagged, keep=["scenario"])
    assert {(r.scenario, r["count"]) for r in out.groupBy("scenario").count().collect()} == {
        ("aa", 12),
        ("bb", 12),
    }


def test_weights(docs):
    got = [tuple(r) for r in scenario.gap_weights(docs).collect()]
    assert got == [("(C) HP", "Office", 2026, 0.25)]


def long_table(docs, packages, **kw):
    return scenario.annual_long(scenario.flatten_scenario(docs), packages, "ref", "run", **kw)


def test_annual_long(docs, packages):
    got = {
        (r.meas, r.year, r.tech_stage, r.turnover): r.state_ann_kwh
        for r in long_table(docs, packages).collect()
    }
    assert got[("(C) HP", 2026, "original_ann", "ref")] == pytest.approx(9000)
    assert got[("(C) HP", 2026, "measure_ann", "ref")] == pytest.approx(1000)
    # A metric missing for a year leaves both stages empty.
    assert got[("(C) HP", 2030, "measure_ann", "ref")] is None
    assert got[("(R) Pack HP", 2026, "original_ann", "ref")] == pytest.approx(90000)
    assert got[("(R) Pack HP", 2026, "measure_ann", "ref")] == pytest.approx(9000)
    assert got[("(R) Pack & Env.", 2026, "original_ann", "ref")] == 0
    assert got[("(R) Pack & Env.", 2026, "measure_ann", "ref")] == pytest.approx(1000)
    assert got[("(C) HP", 2026, "original_ann", "baseline")] == pytest.approx(20000)
    assert got[("(R) Pack HP", 2026, "original_ann", "baseline")] == pytest.approx(100000)
    assert len(got) == 8 + 4 + 2
    sectors = {r.meas: r.sector for r in long_table(docs, packages).collect()}
    assert sectors["(C) HP"] == "com" and sectors["(R) Light"] == "res"


def test_without_packages_the_measure_stays_whole(docs):
    got = {
        (r.meas, r.tech_stage, r.turnover): r.state_ann_kwh
        for r in long_table(docs, None, include_bldg_type=False).collect()
        if r.year == 2026
    }
    assert got[("(R) Pack", "measure_ann", "ref")] == pytest.approx(10000)
    assert got[("(R) Pack", "original_ann", "baseline")] == pytest.approx(100000)


def test_unmapped_package_is_visible(docs, frame):
    from wattloom.operators.mapping import unmapped_packages

    other = frame([("x", "y", "equipment")], "meas string, meas_separated string, component string")
    rows = scenario.flatten_scenario(docs)
    got = unmapped_packages(rows, other, scenario.ENVELOPE).collect()
    assert [r.meas for r in got] == ["(R) Pack"]
    split = scenario.annual_long(rows, other, "ref", "run").filter(col("meas").isNull())
    assert split.count() == 2  # the package's rows have no name and no energy


def test_weighted_split_conserves(docs, packages, frame):
    before = long_table(docs, packages)
    after = scenario.weighted_split(before, scenario.gap_weights(docs))
    gap = [r for r in after.collect() if r.meas == "Gap" and r.year == 2026]
    assert sorted(r.state_ann_kwh for r in gap) == pytest.approx([250, 2250, 5000])
    keys = ["reg", "bldg_type", "end_use", "fuel", "year", "tech_stage", "turnover", "sector", "run_id"]
    check = scenario.split_conservation(before, after, keys).collect()
    assert {r.scope for r in check} == {
        "ALL_ROWS", "ALL_ROWS_TOTAL", "COM_ELECTRIC_ONLY", "COM_ELECTRIC_ONLY_TOTAL",
    }
    assert all(abs(r.delta) < 1e-9 and abs(r.pct_delta) < 1e-12 for r in check)
    total = next(r for r in check if r.scope == "COM_ELECTRIC_ONLY_TOTAL")
    assert total.reg == "ALL" and total.kwh_before == pytest.approx(30000)


def test_duplicate_weights_fail_the_job(docs, packages, frame):
    twice = frame(
        [("(C) HP", "Office", 2026, 0.1), ("(C) HP", "Office", 2026, 0.2)],
        "meas string, bldg_type string, year int, gap_weight double",
    )
    with pytest.raises(PySparkException, match="duplicate key in split weights"):
        scenario.weighted_split(long_table(docs, packages), twice).collect()


STOCK = "scenario string, year string, reg string, meas string, bldg_type string, end_use string, fuel string, metric string, value double"


def test_household_counts(frame):
    heat = stock.HEATING

    def cell(meas, fuel, base, measure):
        return [
            ("s", "2026", "AL", meas, "Home", heat, fuel, stock.BASE_UNITS, base),
            ("s", "2026", "AL", meas, "Home", heat, fuel, stock.MEASURE_UNITS, measure),
        ]

    data = (
        cell("(R) HP", "Electric", 10.0, 4.0)
        + cell("(R) New HP", "Electric", 0.0, 3.0)
        + cell("(R) ES HP, No Cool (FS)", "Electric", 5.0, 2.0)
        + cell("(R) ES Furnace, No Cool", "Non-Electric", 7.0, 1.0)
        + cell("(R) Best NG Heat, No Cooling", "Non-Electric", 9.0, 1.0)
        + [("s", "2026", "AL", "(R) HP", "Home", "Lighting", "Electric", stock.BASE_UNITS, 99.0)]
        # The same cell twice counts once in the wide cells.
        + [("s", "2026", "AL", "(R) HP", "Home", heat, "Electric", stock.MEASURE_UNITS, 4.0)]
    )
    (r,) = stock.household_counts(frame(data, STOCK)).collect()
    assert r.heating_units_total == 31.0
    assert r.heating_units_elec == 10.0 + 3.0 + 5.0
    assert r.cooling_units == 10.0 + 0.0 + 2.0 + 0.0 + 0.0
    assert r.share_elec_heat == pytest.approx(18 / 31)


def test_building_counts(frame):
    heat = stock.HEATING
    data = [
        ("s", "2026", "AL", "(C) a", "Office", heat, "Electric", stock.BASE_SERVED, 6.0),
        ("s", "2026", "AL", "(C) a", "Office", heat, "Electric", stock.MEASURE_SERVED, 2.0),
        ("s", "2026", "AL", "(C) a", "Office", heat, "Natural Gas", stock.BASE_SERVED, 10.0),
        ("s", "2026", "AL", "(C) b", "Office", heat, "Natural Gas", stock.MEASURE_SERVED, 3.0),
    ]
    division = frame([("D", "Office", 2026, 100.0)], "div string, kind string, year int, N_bldgs_CDIV double")
    states = frame(
        [("D", "Office", "AL", 0.4), ("D", "Office", "KY", 0.6)],
        "div string, kind string, `in.state` string, cdiv_share double",
    )
    (r,) = stock.building_counts(frame(data, STOCK), division, states, ["div", "kind"]).collect()
    assert (r.state, r.year, r.N_bldgs) == ("AL", 2026, 40.0)
    assert r.N_bldgs_elec_heat == pytest.approx(40 * 4 / 16)


def office(energy, weight=None):
    def at(v):
        return {"AL": {"Office": {"Cooking": {"Electric": {"2026": v}}}}}

    body = {
        "Markets and Savings (by Category)": {
            "Max": {scenario.EFFICIENT: at(energy), scenario.MEASURE: at(energy / 2), scenario.BASELINE: at(energy)}
        }
    }
    return body | ({"Gap Weights": {"Office": {"2026": weight}}} if weight is not None else {})


def merged(frame, packages, *documents):
    from wattloom.plans import workflow

    parts = [
        workflow.projection(frame([(json.dumps(d | {"Run": {}}),)], "value string"), packages, f"s{i}", "r", include_origin=True)
        for i, d in enumerate(documents)
    ]
    rows = scenario.merge_baselines(parts).filter(col("turnover") == "baseline").collect()
    assert len({r.meas for r in rows}) == len(rows)
    listed = {(r.origin, r.meas) for r in scenario.baseline_conflicts(parts).collect()}
    return {r.meas: r.state_ann_kwh / 1e6 * 3412 for r in rows}, listed


@pytest.mark.parametrize("scenarios", [1, 2])
def test_baseline_gap_of_several_measures_adds_up(packages, frame, scenarios):
    doc = {"(C) a": office(10.0, 0.3), "(C) b": office(20.0, 0.5), "(C) c": office(40.0)}
    got, listed = merged(frame, packages, *[doc] * scenarios)
    assert got == pytest.approx({"(C) a": 7.0, "(C) b": 10.0, "(C) c": 40.0, "Gap": 13.0})
    assert not listed


def test_baseline_of_scenarios_with_other_measures_and_weights(packages, frame):
    """Measures of single scenarios are united; both halves come from one scenario."""
    one = {"(C) a": office(10.0, 0.3), "(C) b": office(20.0, 0.5)}
    two = {"(C) b": office(20.0, 0.25), "(C) c": office(40.0, 0.1), "(C) a": office(12.0, 0.5)}
    for docs in ((one, two), (two, one)):
        got, listed = merged(frame, packages, *docs)
        assert sum(got.values()) == pytest.approx(10.0 + 20.0 + 40.0)
        assert got["(C) a"] == pytest.approx(7.0) and got["(C) c"] == pytest.approx(36.0)
        assert listed == {("(C) a", "(C) a"), ("(C) a", "Gap"), ("(C) b", "(C) b"), ("(C) b", "Gap")}


def test_baselines_of_packages_with_one_equipment_add_up(frame):
    names = [(p, n, c) for p in ("(R) P", "(R) Q") for n, c in (("(R) HP", "equipment"), (p + " & Env.", "equipment + env"))]
    packages = frame(names, "meas string, meas_separated string, component string")
    doc = {"(R) P": office(10.0), "(R) Q": office(5.0)}
    assert merged(frame, packages, doc, doc)[0] == pytest.approx({"(R) HP": 15.0})
