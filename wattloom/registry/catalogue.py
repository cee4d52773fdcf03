"""The domain catalogues, run over building tables derived from the line items.

Every line item stands for one building (or one reading of it).  Output columns
are whole-number multiples of its quantity, so sums are exact in any engine.
The SQL is written out per catalogue entry: one grouped SELECT and one branch
per (end use, fuel), which is what the one-pass operators must reproduce.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.operators import shapes
from wattloom.plans import commercial as com
from wattloom.plans import residential as res
from wattloom.plans import workflow
from wattloom.plans.specs import annual_multipliers
from wattloom.registry.core import LINES_SQL, PLACES_SQL, Tables, query, rounded

FUELS = {"1-URGENT": "Electricity", "2-HIGH": "Natural Gas", "3-MEDIUM": "Propane"}
UPGRADES = {1: 0, 2: 0, 3: 0, 4: 16, 5: 28, 6: 11, 7: 0}
PARAMS = {"A": "Electric", "N": "Gas", "R": "Gas"}


def _columns(*texts: str) -> list[str]:
    """Numeric columns named in SQL expressions, in order of appearance."""
    names: dict[str, None] = {}
    for text in texts:
        for name in re.findall(r"`([^`]+)`", text):
            if not name.startswith("in.") and not name.endswith("_fuel_type"):
                names[name] = None
    return list(names)


def _texts(specs, profiles) -> list[str]:
    out = [v for s in specs for v in s.values.values()]
    for p in profiles:
        out += [p.primary, *([p.secondary] if p.secondary else [])]
    return out


def _factor(i: int) -> str:
    """Multiplier of the i-th output column; some columns are 0 for many rows."""
    return f"CASE WHEN l_partkey % {i % 5 + 2} = 0 THEN 0 ELSE {i % 7 + 1} END"


def _case_sql(on: str, labels: dict, default: str) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in labels.items())
    return f"CASE {on} {whens} ELSE {default} END"


def _sql_names(text: str, table: str = "") -> str:
    return re.sub(r"`([^`]+)`", table + r'"\1"', text)


SECTORS = {
    "res": (res.ANNUAL, res.HOURLY),
    "com": (com.ANNUAL, com.HOURLY),
    "com_old": (com.SUPERSEDED, ()),
}
# Characteristic columns and where they come from.
CHARACTERISTICS: dict[str, dict[str, str]] = {
    "res": {
        "in.cooking_range": "c_mktsegment",
        "in.clothes_dryer": "c_mktsegment",
        "in.water_heater_efficiency": "o_orderpriority",
        "in.hvac_cooling_type": "l_returnflag",
        "in.hvac_heating_type_and_fuel": "o_orderpriority",
    },
    "com": {
        "in.hvac_combined_type": "c_mktsegment",
        "in.service_water_heating_fuel": "c_mktsegment",
        "in.hvac_cool_type": "l_returnflag",
        "in.hvac_category": "c_mktsegment",
        "in.hvac_heat_type": "o_orderpriority",
        "applicability": "l_linestatus",
    },
}
CHARACTERISTICS["com_old"] = CHARACTERISTICS["com"]
COMMON_SQL = f"""l_orderkey * 10 + l_linenumber AS bldg_id, state AS "in.state",
    state || '-' || c_mktsegment AS "in.county", c_mktsegment AS "in.weather_file_city",
    CAST(ROUND(l_discount * 100) AS INTEGER) AS "in.weather_file_longitude", state,
    {_case_sql("l_linenumber", UPGRADES, "0")} AS upgrade, l_tax * 100 + 1 AS weight,
    {_case_sql("o_orderpriority", FUELS, "'Fuel Oil'")} AS "in.heating_fuel",
    l_shipdate, l_partkey, l_linenumber"""


def _stamp_sql() -> str:
    return (
        "TIMESTAMP '2018-01-01' + to_days(CAST(dayofyear(l_shipdate) - 1 AS INTEGER)) "
        "+ to_hours(l_partkey % 24) + to_minutes(l_linenumber * 7)"
    )


def _buildings_sql(sector: str) -> str:
    specs, profiles = SECTORS[sector]
    chars = "".join(
        f',\n    {source} AS "{name}"' for name, source in CHARACTERISTICS[sector].items()
    )
    outs = "".join(
        f',\n    l_quantity * {_factor(i)} AS "{name}"'
        for i, name in enumerate(_columns(*_texts(specs, profiles)))
    )
    params = ""
    if sector == "com":
        params = "".join(
            f",\n    {_case_sql('l_returnflag', PARAMS, 'NULL')} "
            f'AS "out.params.{one}_fuel_type"'
            for one, _ in com.APPLIANCES
        )
    return f"""{LINES_SQL},
buildings AS (
  SELECT {COMMON_SQL}{chars}{params}{outs},
    {_stamp_sql()} AS stamp
  FROM lines)"""


def buildings(t: Tables, sector: str) -> DataFrame:
    specs, profiles = SECTORS[sector]
    outs = [
        (col("l_quantity") * F.expr(_factor(i))).alias(name)
        for i, name in enumerate(_columns(*_texts(specs, profiles)))
    ]
    params = []
    if sector == "com":
        label = F.expr(_case_sql("l_returnflag", PARAMS, "NULL"))
        params = [label.alias(f"out.params.{one}_fuel_type") for one, _ in com.APPLIANCES]
    stamp = (
        F.lit("2018-01-01").cast("timestamp")
        + F.make_interval(
            days=F.dayofyear("l_shipdate") - 1,
            hours=(col("l_partkey") % 24).cast("int"),
            mins=col("l_linenumber") * 7,
        )
    )
    return t.lines().select(
        (col("l_orderkey") * 10 + col("l_linenumber")).alias("bldg_id"),
        col("state").alias("in.state"),
        F.concat_ws("-", "state", "c_mktsegment").alias("in.county"),
        col("c_mktsegment").alias("in.weather_file_city"),
        F.round(col("l_discount") * 100).cast("int").alias("in.weather_file_longitude"),
        "state",
        F.expr(_case_sql("l_linenumber", UPGRADES, "0")).alias("upgrade"),
        (col("l_tax") * 100 + 1).alias("weight"),
        F.expr(_case_sql("o_orderpriority", FUELS, "'Fuel Oil'")).alias("in.heating_fuel"),
        *[col(source).alias(name) for name, source in CHARACTERISTICS[sector].items()],
        *params,
        *outs,
        stamp.alias("timestamp"),
    )


VALUES = {
    "c_mktsegment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "o_orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    "l_returnflag": ("A", "N", "R"),
    "l_linestatus": ("F", "O"),
}


def _map_rows(sector: str, keys: tuple[str, ...], prefix: str) -> list[tuple]:
    """A characteristics map by rule: every third combination is left unmapped."""
    combos: list[tuple] = [()]
    for key in keys:
        source = CHARACTERISTICS[sector].get(key)
        values = VALUES[source] if source else (*FUELS.values(), "Fuel Oil")
        combos = [(*c, v) for c in combos for v in values]
    rows = []
    for i, combo in enumerate(combos):
        if i % 3 != 2:
            rows.append((*combo, str((0, 16, 28)[i % 3 if i % 2 else 0]), f"{prefix}_{i % 7}"))
            if i % 4 == 0:
                rows.append((*combo, "0", f"{prefix}_{i % 7 + 10}"))
    return list(dict.fromkeys(rows))


def _maps(t: Tables, sector: str) -> dict[str, DataFrame]:
    specs, profiles = SECTORS[sector]
    out = {}
    for entry, group in (*((s, "group_ann") for s in specs), *((p, "shape_ts") for p in profiles)):
        if entry.map_name:
            names = [*entry.keys, "upgrade", group]
            schema = ", ".join(f"`{n}` string" for n in names)
            rows = _map_rows(sector, entry.keys, entry.map_name)
            out[entry.map_name] = t.literal(rows, schema)
    return out


def _map_sql(sector: str, entry, group: str) -> str:
    names = ", ".join(f'"{n}"' for n in (*entry.keys, "upgrade", group))
    rows = ", ".join(
        "(" + ", ".join(f"'{v}'" for v in row) + ")"
        for row in _map_rows(sector, entry.keys, entry.map_name)
    )
    return f"(SELECT * FROM (VALUES {rows}) AS m({names}))"


def _annual_sql(sector: str, place: tuple[str, ...]) -> str:
    keys = ", ".join(f'"{p}"' for p in (*place, "in.state"))
    ctes, branches = [_buildings_sql(sector)], []
    for spec in SECTORS[sector][0]:
        sums = ", ".join(f"SUM({_sql_names(v)}) AS {n}" for n, v in spec.values.items())
        if spec.map_name:
            using = " AND ".join(f'b."{k}" = m."{k}"' for k in spec.keys)
            where = ", ".join(f"'{g}'" for g in spec.exclude) or "''"
            body = f"""SELECT {", ".join(f'b."{p}"' for p in (*place, "in.state"))}, group_ann,
      {sums}
    FROM buildings b JOIN {_map_sql(sector, spec, "group_ann")} m
      ON {using} AND CAST(b.upgrade AS VARCHAR) = m.upgrade
    WHERE group_ann NOT IN ({where}) GROUP BY ALL"""
        else:
            body = f"""SELECT {keys}, '{spec.group}' AS group_ann, {sums}
    FROM buildings WHERE {_sql_names(spec.where)} GROUP BY ALL"""
        totals = ", ".join(
            f'SUM({n}) OVER (PARTITION BY "in.state", group_ann) AS {n}_total' for n in spec.values
        )
        ctes.append(f"a_{spec.name} AS (SELECT *, {totals} FROM ({body}))")
        for x in spec.targets:
            guard = f" WHERE {x.measure}_total > 0" if x.guard else ""
            branches.append(
                f"""SELECT {keys}, group_ann,
  ROUND({x.measure} / NULLIF({x.measure}_total, 0), 9) AS multiplier_annual,
  '{sector}' AS sector, '{x.end_use}' AS end_use, {f"'{x.fuel}'" if x.fuel else "CAST(NULL AS VARCHAR)"} AS fuel
FROM a_{spec.name}{guard}"""
            )
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(branches)


def _annual(t: Tables, sector: str, place: tuple[str, ...]) -> DataFrame:
    out = annual_multipliers(
        buildings(t, sector), _maps(t, sector), SECTORS[sector][0], place, sector
    )
    return rounded(out, {"multiplier_annual": 9})


@query("res_annual_catalogue", _annual_sql("res", res.PLACE))
def res_annual_catalogue(t: Tables):
    """All residential geographic multipliers."""
    return _annual(t, "res", res.PLACE)


@query("com_annual_catalogue", _annual_sql("com", com.PLACE))
def com_annual_catalogue(t: Tables):
    """All commercial geographic multipliers."""
    return _annual(t, "com", com.PLACE)


@query("com_superseded_catalogue", _annual_sql("com_old", com.PLACE))
def com_superseded_catalogue(t: Tables):
    """Earlier commercial multipliers: fossil heat, electric heat, delivered cooling; no fuel."""
    return _annual(t, "com_old", com.PLACE)


def _hourly_sql(sector: str, place: tuple[str, ...], weight: str) -> str:
    keys = ", ".join(f'"{p}"' for p in place)
    placed = ", ".join(f'b."{p}"' for p in place)
    ctes = [
        _buildings_sql(sector),
        """readings AS (
  SELECT *, CASE WHEN YEAR(ending) = 2019 THEN ending - INTERVAL 1 YEAR ELSE ending END
    AS timestamp_hour
  FROM (SELECT *, date_trunc('hour', stamp) + INTERVAL 1 HOUR AS ending FROM buildings))""",
    ]
    branches = []
    for p in SECTORS[sector][1]:
        sums = f"SUM(({_sql_names(p.primary, 'r.')}) * {weight}) AS primary_kwh, " + (
            f"SUM(({_sql_names(p.secondary, 'r.')}) * {weight}) AS secondary_kwh"
            if p.secondary
            else "CAST(NULL AS DOUBLE) AS secondary_kwh"
        )
        if p.map_name:
            on = " AND ".join(f'b."{k}" = m."{k}"' for k in p.keys)
            body = f"""SELECT {placed}, shape_ts, timestamp_hour, {sums}
    FROM readings r JOIN buildings b ON r.bldg_id = b.bldg_id AND r.upgrade = b.upgrade
    JOIN {_map_sql(sector, p, "shape_ts")} m ON {on} AND CAST(b.upgrade AS VARCHAR) = m.upgrade GROUP BY ALL"""
        else:
            body = f"""SELECT {placed}, '{p.shape}' AS shape_ts, timestamp_hour, {sums}
    FROM readings r JOIN buildings b ON r.bldg_id = b.bldg_id AND r.upgrade = b.upgrade
    WHERE b.upgrade = 0 GROUP BY ALL"""
        ctes.append(
            f"""h_{p.name} AS (SELECT *, SUM(primary_kwh) OVER w AS primary_total,
    SUM(secondary_kwh) OVER w AS secondary_total
  FROM ({body}) WINDOW w AS (PARTITION BY {keys}, shape_ts))"""
        )
        for x in p.targets:
            guard = f" WHERE {x.measure}_total > 0" if x.guard else ""
            branches.append(
                f"""SELECT shape_ts, '{x.end_use}' AS end_use, '{x.fuel}' AS fuel, timestamp_hour, CAST("{place[0]}" AS VARCHAR) AS place,
    {x.measure}_kwh AS kwh, {x.measure}_kwh / NULLIF({x.measure}_total, 0) AS m
  FROM h_{p.name}{guard}"""
            )
    union = "\n  UNION ALL\n  ".join(branches)
    return f"""WITH {", ".join(ctes)}
SELECT shape_ts, end_use, fuel, CAST(MONTH(timestamp_hour) AS INTEGER) AS month,
  COUNT(*) AS n_rows, ROUND(SUM(kwh), 2) AS kwh, ROUND(SUM(m), 7) AS multiplier_sum,
  ROUND(SUM(m * (DAY(timestamp_hour) * 24 + HOUR(timestamp_hour))), 5) AS by_hour,
  ROUND(SUM(m * (ascii(right(place, 1)) + 3 * length(place))), 5) AS by_place
FROM ({union}) GROUP BY ALL"""


def _hourly(t: Tables, sector: str, place: tuple[str, ...], weight: str | None) -> DataFrame:
    """Buildings and their series are two views of the same line items."""
    profiles = SECTORS[sector][1]
    on = ("bldg_id", "upgrade")
    keep = [*place, *([weight] if weight else [])]
    linked = shapes.building_shapes(buildings(t, sector), _maps(t, sector), profiles, keep, on)
    sums = shapes.hourly_sums(
        buildings(t, sector), linked, profiles, place, shapes.aligned(), weight, on
    )
    hours = shapes.hourly_multipliers(sums, profiles, place, sector)
    return _by_month(hours, place)


def _by_month(hours: DataFrame, place: tuple[str, ...]) -> DataFrame:
    share, name = F.col("multiplier_hourly"), col(place[0]).cast("string")
    out = hours.groupBy(
        "shape_ts", "end_use", "fuel", F.month("timestamp_hour").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("kwh").alias("kwh"),
        F.sum("multiplier_hourly").alias("multiplier_sum"),
        # an hour moved inside its month, or a share given to another place, shows here
        F.sum(share * (F.dayofmonth("timestamp_hour") * 24 + F.hour("timestamp_hour"))).alias("by_hour"),
        F.sum(share * (F.ascii(F.right(name, F.lit(1))) + 3 * F.length(name))).alias("by_place"),
    )
    return rounded(out, {"kwh": 2, "multiplier_sum": 7, "by_hour": 5, "by_place": 5})


@query("res_hourly_catalogue", _hourly_sql("res", ("in.weather_file_city", "in.state"), "1"))
def res_hourly_catalogue(t: Tables):
    """All residential shapes from one scan, summarised by month."""
    return _hourly(t, "res", ("in.weather_file_city", "in.state"), None)


def _as_series(rows: DataFrame) -> DataFrame:
    """The readings with their stamps as whole nanoseconds."""
    return rows.withColumn("timestamp", F.unix_micros(col("timestamp").cast("timestamp")) * 1000)


@query("hourly_res_places", _hourly_sql("res", ("in.weather_file_city", "in.weather_file_longitude"), "1"))
def hourly_res_places(t: Tables):
    """The workflow's residential stage: series collapsed, upgrades in use only, by weather place."""
    rows = buildings(t, "res")
    b = workflow.Buildings(rows, _as_series(rows), rows, rows, rows, rows)
    return _by_month(workflow.hourly_res(b, _maps(t, "res")), tuple(res.WEATHER))


def _kitchens(t: Tables) -> workflow.Buildings:
    """Customers as commercial buildings with three metadata rows each, events as their series."""
    county = F.concat_ws("-", "state", "c_mktsegment")
    kind = (
        F.when(col("c_mktsegment") == "BUILDING", com.COOKING_TYPES[0])
        .when(col("c_mktsegment") == "FURNITURE", com.COOKING_TYPES[1]).otherwise("Office")
    )
    meta = t.places().select(
        col("c_custkey").alias("bldg_id"), county.alias(com.COUNTY), kind.alias("in.building_type"),
        (col("c_custkey") % 3 + 1).cast("double").alias("weight"),
        F.explode(F.array(*[F.lit(u) for u in (0, 7, com.COOKING_UPGRADE)])).alias("upgrade"),
    )
    upgrade = F.when(col("event_type").isin("view", "signup"), 0).when(col("event_type") == "error", 7)
    series = t("events").select(
        col("user_id").alias("bldg_id"), upgrade.otherwise(com.COOKING_UPGRADE).cast("string").alias("upgrade"),
        (col("ts") + F.expr("INTERVAL '-1826' DAY")).alias("timestamp"),
        col("value").alias("out.electricity.interior_equipment.energy_consumption"),
    )
    zones = t.places().join(t("nation").select(col("n_name").alias("state"), "n_regionkey"), "state").select(
        county.alias("in.county"), col("state").alias("in.state"), F.concat(F.lit("z"), "n_regionkey").alias("tz")
    ).distinct()
    gap = t.lines().groupBy(
        county.alias("in.county"),
        (F.date_trunc("hour", F.col("l_shipdate").cast("timestamp") + F.make_interval(hours=col("l_partkey") % 24))).alias("timestamp"),
    ).agg(F.sum("l_quantity").alias(com.GAP_VALUE))
    homes = t.places().select(county.alias("in.county"), col("state").alias("in.state"), F.lit(0).alias("upgrade"))
    return workflow.Buildings(homes, series, meta, series, gap, zones, spill_year=1998)


@query(
    "cooking_shape",
    f"""
WITH {PLACES_SQL},
kitchens AS (
  SELECT county AS bldg_id, 'z' || n_regionkey AS tz, 2 * (county % 3 + 1) AS weight
  FROM places JOIN nation ON n_name = state WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')),
hours AS (
  SELECT tz, CASE WHEN YEAR(h) = 1998 THEN h - INTERVAL 1 YEAR ELSE h END AS timestamp_hour,
    SUM(CASE WHEN event_type IN ('view', 'signup') THEN -value * weight WHEN event_type = 'error' THEN 0 ELSE value * weight END) AS kwh
  FROM (SELECT *, date_trunc('hour', ts - INTERVAL 1826 DAY) + INTERVAL 1 HOUR AS h FROM events WHERE event_type <> 'error')
    JOIN kitchens ON user_id = bldg_id GROUP BY ALL),
shares AS (SELECT *, kwh / NULLIF(SUM(kwh) OVER (PARTITION BY tz), 0) AS m FROM hours),
zones AS (
  SELECT DISTINCT state || '-' || c_mktsegment AS county, state, 'z' || n_regionkey AS tz
  FROM places JOIN nation ON n_name = state)
SELECT county AS "in.county", state AS "in.state", '{com.COOKING_SHAPE}' AS shape_ts, timestamp_hour,
  ROUND(kwh, 4) AS kwh, ROUND(m, 9) AS multiplier_hourly, 'com' AS sector, '{com.COOKING}' AS end_use, fuel
FROM shares JOIN zones USING (tz), (VALUES ('{com.EL}'), ('{com.NG}')) f(fuel)
""",
)
def cooking_shape(t: Tables):
    """Electric cooking: what the kitchen upgrade adds by time zone, given to every county of the zone."""
    return rounded(workflow.cooking_shape(_kitchens(t)), {"kwh": 4, "multiplier_hourly": 9})


GAP_SQL = f"""
WITH {LINES_SQL},
gap AS (
  SELECT state, c_mktsegment, date_trunc('hour', CAST(l_shipdate AS TIMESTAMP) + to_hours(l_partkey % 24)) AS h,
    SUM(l_quantity) AS kwh
  FROM lines GROUP BY ALL),
shared AS (SELECT *, kwh / SUM(kwh) OVER (PARTITION BY state, c_mktsegment) AS m FROM gap)
SELECT state || '-' || c_mktsegment AS "in.county", state AS "in.state",
  CASE WHEN YEAR(h) = 1998 THEN h - INTERVAL 1 YEAR ELSE h END AS timestamp_hour, ROUND(kwh, 4) AS kwh,
  ROUND(m, 9) AS multiplier_hourly, '{com.EL}' AS fuel, end_use, 'com_gap_ts_1' AS shape_ts, 'com' AS sector
FROM shared, (VALUES {", ".join(f"('{u}')" for u in com.GAP_END_USES)}) u(end_use)
"""


@query("gap_shape", GAP_SQL)
def gap_shape(t: Tables):
    """The unmodelled series of every county, shared over its hours and copied to ten end uses."""
    out = workflow.gap_shape(_kitchens(t))
    return rounded(out, {"kwh": 4, "multiplier_hourly": 9})


@query("com_hourly_catalogue", _hourly_sql("com", ("in.county",), "b.weight"))
def com_hourly_catalogue(t: Tables):
    """All commercial shapes from one scan, weighted, summarised by month."""
    return _hourly(t, "com", ("in.county",), "weight")
