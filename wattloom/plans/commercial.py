"""Commercial multiplier catalogue."""

from __future__ import annotations

from wattloom.operators.shapes import HourlyProfile
from wattloom.operators.shares import targets
from wattloom.plans.residential import (
    COMPUTERS,
    COOKING,
    COOLING,
    EL,
    FO,
    HEATING,
    LIGHTING,
    NG,
    OTHER,
    REFRIGERATION,
    WATER_HEATING,
)
from wattloom.plans.specs import AnnualSpec, add

# ---------------------------------------------------------------------------
# Names in the building data and in the published results.
# ---------------------------------------------------------------------------
COUNTY = "in.nhgis_county_gisjoin"
PLACE = ("in.county",)
VENTILATION = "Ventilation"
GAP = "Gap"
GAP_VALUE = "out.electricity.total.energy_consumption..kwh"
GAP_END_USES = (
    GAP,
    OTHER,
    LIGHTING,
    HEATING,
    COOLING,
    VENTILATION,
    COMPUTERS,
    WATER_HEATING,
    REFRIGERATION,
    COOKING,
)
COOKING_TYPES = (
    "FullServiceRestaurant",
    "Hospital",
    "LargeHotel",
    "PrimarySchool",
    "QuickServiceRestaurant",
    "SecondarySchool",
)
APPLIANCES = (
    ("fryer", "fryers"),
    ("griddle", "griddles"),
    ("oven", "ovens"),
    ("range", "ranges"),
    ("steamer", "steamers"),
    ("broiler", "broilers"),
)
COOKING_UPGRADE = 40
COOKING_SHAPE = "com_cook_ts_1"


def _el(*names: str) -> str:
    return add("calc.weighted.electricity.{}.energy_consumption..tbtu", *names)


def _ng(*names: str) -> str:
    return add("calc.weighted.natural_gas.{}.energy_consumption..tbtu", *names)


def _fo(*names: str) -> str:
    return add("calc.weighted.other_fuel.{}.energy_consumption..tbtu", *names)


def _dh(*names: str) -> str:
    return add("calc.weighted.district_heating.{}.energy_consumption..tbtu", *names)


def _dc(*names: str) -> str:
    return add("calc.weighted.district_cooling.{}.energy_consumption..tbtu", *names)


def _count(fuel: str, upgrade: int) -> str:
    """Weighted number of cooking appliances of one fuel in one upgrade."""
    return " + ".join(
        f"CASE WHEN upgrade = {upgrade} AND `out.params.{one}_fuel_type` = '{fuel}' "
        f"THEN CAST(`out.params.num_{many}` AS DOUBLE) * weight ELSE 0 END"
        for one, many in APPLIANCES
    )


LOADS = add(
    "out.params.{}",
    "dx_cooling_load..j",
    "heat_pump_cooling_total_load..j",
    "vrf_total_cooling_load..j",
    "wa_hp_cooling_load..j",
)
HEAT_EL = _el("heating", "heat_recovery")


def _single(name: str, group: str, value: str, end_use: str) -> AnnualSpec:
    return AnnualSpec(name, {"tbtu": value}, targets("tbtu", end_use, [EL]), group=group)


ANNUAL = (
    AnnualSpec(
        "hvac",
        {
            "el": HEAT_EL,
            "ng": f"{_ng('heating')} + {_dh('heating')}",
            "fo": _fo("heating"),
            "cool": f"{_el('cooling', 'heat_rejection')} + {_dc('cooling')} + {_el('pumps')}",
            "vent": _el("fans"),
        },
        targets("el", HEATING, [EL], True)
        + targets("ng", HEATING, [NG], True)
        + targets("fo", HEATING, [FO], True)
        + targets("cool", COOLING, [EL, NG])
        + targets("vent", VENTILATION, [EL]),
        map_name="com_ann_hvac",
        keys=("in.heating_fuel", "in.hvac_combined_type"),
    ),
    AnnualSpec(
        "heat_agnostic",
        {"el": HEAT_EL, "ng": _ng("heating"), "fo": _fo("heating")},
        targets("el", HEATING, [EL], True)
        + targets("ng", HEATING, [NG], True)
        + targets("fo", HEATING, [FO], True),
        group="com_hvac_ann_42",
    ),
    AnnualSpec(
        "wh",
        {
            "el": _el("water_systems"),
            "ng": f"{_ng('water_systems')} + {_dh('water_systems')}",
            "fo": _fo("water_systems"),
        },
        targets("el", WATER_HEATING, [EL], True)
        + targets("ng", WATER_HEATING, [NG], True)
        + targets("fo", WATER_HEATING, [FO], True),
        map_name="com_ann_wh",
        keys=("in.service_water_heating_fuel",),
    ),
    AnnualSpec(
        "wh_agnostic",
        {
            "every": f"{_el('water_systems')} + {_ng('water_systems')} + "
            f"{_dh('water_systems')} + {_fo('water_systems')}"
        },
        targets("every", WATER_HEATING, [EL, NG, FO]),
        group="com_wh_ann_3",
    ),
    AnnualSpec(
        "cool_delivered",
        {"load": f"weight * ({LOADS})"},
        targets("load", COOLING, [EL, NG]),
        group="com_hvac_ann_43",
    ),
    AnnualSpec(
        "cook",
        {"ng": _count("Gas", 0), "el": _count("Electric", 28)},
        targets("ng", COOKING, [NG]) + targets("el", COOKING, [EL]),
        group="com_cook_ann_1",
        where="upgrade IN (0, 28)",
    ),
    _single("lighting", "com_light_ann_1", _el("interior_lighting", "exterior_lighting"), LIGHTING),
    _single("refrig", "com_refrig_ann_1", _el("refrigeration"), REFRIGERATION),
    _single("ventilation_ref", "com_hvac_ann_41", _el("fans"), VENTILATION),
    AnnualSpec(
        "misc",
        {"el": _el("interior_equipment"), "ng": _ng("interior_equipment")},
        targets("el", OTHER, [EL])
        + targets("el", COMPUTERS, [EL])
        + targets("ng", OTHER, [NG, FO]),
        group="com_misc_ann_1",
    ),
)

# Earlier definitions, not part of a run; their multipliers carry no fuel.
SUPERSEDED = (
    AnnualSpec(
        "fossil_heat",
        {"heat": f"{_ng('heating')} + {_fo('heating')} + {_el('heat_recovery')}"},
        targets("heat", HEATING, [None]),
        map_name="com_ann_hvac_fossil",
        keys=("in.heating_fuel", "in.hvac_combined_type"),
    ),
    AnnualSpec(
        "electric_heat",
        {"heat": HEAT_EL},
        targets("heat", HEATING, [None]),
        group="com_hvac_ann_42",
    ),
    AnnualSpec(
        "delivered_cool",
        {"load": LOADS},
        targets("load", COOLING, [None]),
        group="com_hvac_ann_43",
    ),
)


def _ts(template: str, *names: str) -> str:
    return add("out." + template + ".{}.energy_consumption", *names)


HOURLY = (
    HourlyProfile(
        "cooling",
        f"{_ts('electricity', 'cooling', 'heat_rejection')} + "
        f"{_ts('district_cooling', 'cooling')} + {_ts('electricity', 'pumps')}",
        targets("primary", COOLING, [EL, NG], True),
        map_name="com_ts_cooling",
        keys=("in.hvac_cool_type", "in.hvac_category", "applicability"),
    ),
    HourlyProfile(
        "heating",
        _ts("electricity", "heating", "heat_recovery"),
        targets("primary", HEATING, [EL], True)
        + targets("secondary", HEATING, [NG, FO], True),
        secondary=f"{_ts('natural_gas', 'heating')} + {_ts('other_fuel', 'heating')} + "
        f"{_ts('district_heating', 'heating')}",
        map_name="com_ts_heating",
        keys=("in.heating_fuel", "in.hvac_heat_type", "applicability"),
    ),
    HourlyProfile(
        "ventilation",
        _ts("electricity", "fans"),
        targets("primary", VENTILATION, [EL], True),
        map_name="com_ts_ventilation",
        keys=(
            "in.hvac_cool_type",
            "in.hvac_category",
            "in.hvac_heat_type",
            "applicability",
        ),
    ),
    HourlyProfile(
        "ventilation_ref",
        _ts("electricity", "fans"),
        targets("primary", VENTILATION, [EL], True),
        shape="com_ventilation_11",
    ),
    HourlyProfile(
        "lighting",
        _ts("electricity", "interior_lighting", "exterior_lighting"),
        targets("primary", LIGHTING, [EL]),
        shape="com_light_ts_1",
    ),
    HourlyProfile(
        "refrig",
        _ts("electricity", "refrigeration"),
        targets("primary", REFRIGERATION, [EL]),
        shape="com_refrig_ts_1",
    ),
    # The fossil water-heating sum includes electricity, as in the published data.
    HourlyProfile(
        "wh",
        _ts("electricity", "water_systems"),
        targets("primary", WATER_HEATING, [EL])
        + targets("secondary", WATER_HEATING, [NG, FO]),
        secondary=f"{_ts('natural_gas', 'water_systems')} + "
        f"{_ts('other_fuel', 'water_systems')} + "
        f"{_ts('district_heating', 'water_systems')} + "
        f"{_ts('electricity', 'water_systems')}",
        shape="com_wh_ts_1",
    ),
    HourlyProfile(
        "misc",
        _ts("electricity", "interior_equipment"),
        targets("primary", OTHER, [EL])
        + targets("primary", COMPUTERS, [EL])
        + targets("secondary", OTHER, [NG, FO]),
        secondary=_ts("natural_gas", "interior_equipment"),
        shape="com_misc_ts_1",
    ),
)
