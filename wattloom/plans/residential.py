"""Residential multiplier catalogue."""

from __future__ import annotations

from wattloom.operators.shapes import HourlyProfile
from wattloom.operators.shares import targets
from wattloom.plans.specs import AnnualSpec, add

# ---------------------------------------------------------------------------
# Names in the building data and in the published results.
# ---------------------------------------------------------------------------
PLACE = ("in.county", "in.weather_file_city", "in.weather_file_longitude")
WEATHER = ("in.weather_file_city", "in.weather_file_longitude")

EL, NG, FO, LP, BIO = (
    "Electric",
    "Natural Gas",
    "Distillate/Other",
    "Propane",
    "Biomass",
)
COOKING = "Cooking"
COMPUTERS = "Computers and Electronics"
COOLING = "Cooling (Equip.)"
HEATING = "Heating (Equip.)"
LIGHTING = "Lighting"
OTHER = "Other"
REFRIGERATION = "Refrigeration"
WATER_HEATING = "Water Heating"


def _el(*names: str) -> str:
    return add("out.electricity.{}.energy_consumption", *names)


def _ng(*names: str) -> str:
    return add("out.natural_gas.{}.energy_consumption", *names)


def _fo(*names: str) -> str:
    return add("out.fuel_oil.{}.energy_consumption", *names)


def _lp(*names: str) -> str:
    return add("out.propane.{}.energy_consumption", *names)


def _delivered(name: str) -> str:
    return add("out.load.{}.energy_delivered.kbtu", name)


HEAT_EL = _el("heating", "heating_hp_bkup")
FANS = _el(
    "mech_vent",
    "ceiling_fan",
    "cooling_fans_pumps",
    "heating_fans_pumps",
    "heating_hp_bkup_fa",
)
LIGHTS = _el("lighting_exterior", "lighting_interior", "lighting_garage")
COLD = _el("freezer", "refrigerator")
PLUGS = _el(
    "plug_loads",
    "permanent_spa_heat",
    "permanent_spa_pump",
    "pool_heater",
    "well_pump",
)
GAS_MISC = _ng("grill", "fireplace", "lighting", "permanent_spa_heat", "pool_heater")
NOT_ELECTRIC = "`in.heating_fuel` != 'Electricity'"


def _single(name: str, group: str, value: str, end_use: str) -> AnnualSpec:
    return AnnualSpec(name, {"kwh": value}, targets("kwh", end_use, [EL]), group=group)


ANNUAL = (
    AnnualSpec(
        "cook",
        {"el": _el("range_oven"), "ng": _ng("range_oven"), "lp": _lp("range_oven")},
        targets("el", COOKING, [EL], True)
        + targets("ng", COOKING, [NG], True)
        + targets("lp", COOKING, [LP], True),
        map_name="res_ann_cook",
        keys=("in.cooking_range",),
    ),
    AnnualSpec(
        "dry",
        {
            "el": _el("clothes_dryer"),
            "ng": _ng("clothes_dryer"),
            "lp": _lp("clothes_dryer"),
        },
        targets("el", OTHER, [EL], True)
        + targets("ng", OTHER, [NG], True)
        + targets("lp", OTHER, [LP], True),
        map_name="res_ann_dry",
        keys=("in.clothes_dryer",),
    ),
    AnnualSpec(
        "hvac",
        {
            "el": HEAT_EL,
            "ng": _ng("heating"),
            "fo": _fo("heating"),
            "lp": _lp("heating"),
            "cool": _el("cooling"),
        },
        targets("el", HEATING, [EL], True)
        + targets("ng", HEATING, [NG], True)
        + targets("fo", HEATING, [FO], True)
        + targets("lp", HEATING, [LP], True)
        + targets("cool", COOLING, [EL, NG], True),
        map_name="res_ann_hvac",
        keys=("in.heating_fuel", "in.hvac_cooling_type"),
        exclude=("res_hvac_ann_52", "res_hvac_ann_84", "res_hvac_ann_87"),
    ),
    AnnualSpec(
        "wh",
        {
            "el": _el("hot_water"),
            "ng": _ng("hot_water"),
            "fo": _fo("hot_water"),
            "lp": _lp("hot_water"),
        },
        targets("el", WATER_HEATING, [EL], True)
        + targets("ng", WATER_HEATING, [NG], True)
        + targets("fo", WATER_HEATING, [FO], True)
        + targets("lp", WATER_HEATING, [LP], True),
        map_name="res_ann_wh",
        keys=("in.water_heater_efficiency",),
        exclude=("res_wh_ann_6",),
    ),
    _single("cw", "res_cw_ann_1", _el("clothes_washer"), OTHER),
    _single("dw", "res_dw_ann_1", _el("dishwasher"), OTHER),
    _single("fanspumps", "res_fanspumps_ann_1", FANS, OTHER),
    _single("poolpump", "res_pp_ann_1", _el("pool_pump"), OTHER),
    _single("lighting", "res_light_ann_1", LIGHTS, LIGHTING),
    _single("refrig", "res_refrig_ann_1", COLD, REFRIGERATION),
    AnnualSpec(
        "misc",
        {"el": PLUGS, "ng": GAS_MISC},
        targets("el", OTHER, [EL])
        + targets("el", COMPUTERS, [EL])
        + targets("ng", OTHER, [NG, LP, FO]),
        group="res_misc_ann_1",
    ),
    AnnualSpec(
        "heating_delivered_52",
        {"heat": _delivered("heating")},
        targets("heat", HEATING, [EL, NG, LP, FO, BIO]),
        group="res_hvac_ann_52",
    ),
    AnnualSpec(
        "heating_delivered_84",
        {"heat": _delivered("heating")},
        targets("heat", HEATING, [EL, NG, LP, FO, BIO]),
        group="res_hvac_ann_84",
        where=f"upgrade = 0 AND {NOT_ELECTRIC}",
    ),
    AnnualSpec(
        "heating_delivered_86",
        {"heat": _delivered("heating")},
        targets("heat", HEATING, [EL, NG, LP, FO, BIO]),
        group="res_hvac_ann_86",
        where=f"upgrade = 16 AND {NOT_ELECTRIC}",
    ),
    AnnualSpec(
        "cooling_delivered",
        {"cool": _delivered("cooling")},
        targets("cool", COOLING, [EL, NG]),
        group="res_hvac_ann_87",
        where="upgrade = 16",
    ),
    AnnualSpec(
        "wh_delivered",
        {"heat": _delivered("hot_water")},
        targets("heat", WATER_HEATING, [EL, NG, LP, FO]),
        group="res_wh_ann_6",
    ),
)


def _profile(name: str, shape: str, value: str, end_use: str) -> HourlyProfile:
    return HourlyProfile(
        name, value, targets("primary", end_use, [EL], True), shape=shape
    )


HOURLY = (
    HourlyProfile(
        "cooling",
        _el("cooling"),
        targets("primary", COOLING, [EL, NG], True),
        map_name="res_ts_cooling",
        keys=("in.hvac_cooling_type",),
    ),
    HourlyProfile(
        "heating",
        HEAT_EL,
        targets("primary", HEATING, [EL], True)
        + targets("secondary", HEATING, [NG, LP, FO, BIO], True),
        secondary=f"{_fo('heating')} + {_ng('heating')} + {_lp('heating')}",
        map_name="res_ts_heating",
        keys=("in.hvac_heating_type_and_fuel",),
    ),
    HourlyProfile(
        "cook",
        _el("range_oven"),
        targets("primary", COOKING, [EL], True)
        + targets("secondary", COOKING, [NG, LP], True),
        secondary=f"{_ng('range_oven')} + {_lp('range_oven')}",
        map_name="res_ts_cook",
        keys=("in.cooking_range",),
    ),
    HourlyProfile(
        "dry",
        _el("clothes_dryer"),
        targets("primary", OTHER, [EL], True) + targets("secondary", OTHER, [NG], True),
        secondary=f"{_ng('clothes_dryer')} + {_lp('clothes_dryer')}",
        map_name="res_ts_dry",
        keys=("in.clothes_dryer",),
    ),
    HourlyProfile(
        "wh",
        _el("hot_water"),
        targets("primary", WATER_HEATING, [EL], True)
        + targets("secondary", WATER_HEATING, [NG, FO, LP], True),
        secondary=f"{_fo('hot_water')} + {_ng('hot_water')} + {_lp('hot_water')}",
        map_name="res_ts_wh",
        keys=("in.water_heater_efficiency",),
    ),
    _profile("cw", "res_cw_ts_1", _el("clothes_washer"), OTHER),
    _profile("dw", "res_dw_ts_1", _el("dishwasher"), OTHER),
    _profile("fanspumps", "res_fanspumps_ts_1", FANS, OTHER),
    _profile("poolpump", "res_pp_ts_1", _el("pool_pump"), OTHER),
    _profile("lighting", "res_light_ts_1", LIGHTS, LIGHTING),
    _profile("refrig", "res_refrig_ts_1", COLD, REFRIGERATION),
    HourlyProfile(
        "misc",
        PLUGS,
        targets("primary", OTHER, [EL], True)
        + targets("primary", COMPUTERS, [EL], True)
        + targets("secondary", OTHER, [NG, LP, FO], True),
        secondary=GAS_MISC,
        shape="res_misc_ts_1",
    ),
)
