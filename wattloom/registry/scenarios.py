"""Scenario preparation and stock counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.operators import scenario, stock, wide
from wattloom.plans import workflow
from wattloom.registry.core import LINES_SQL, ORACLE, Tables, query, rounded
from wattloom.session import shared_folder
from wattloom.sources import ranges, readers

METRICS = (scenario.EFFICIENT, scenario.MEASURE, scenario.ENVELOPE, scenario.BASELINE)
KEYS = ["meas", "reg", "bldg_type", "end_use", "fuel", "year"]
PACKAGES = (
    ("(C) BUILDING", "(C) BUILDING & Env.", "equipment + env"),
    ("(C) BUILDING", "(C) BUILDING HP", "equipment"),
    ("(R) FURNITURE", "(R) FURNITURE & Env.", "equipment + env"),
    ("(R) FURNITURE", "(R) FURNITURE HP", "equipment"),
)


def scenario_rows(t: Tables) -> DataFrame:
    """Flat scenario rows; one measure has no fuels, two carry an envelope metric."""
    meas = F.concat(
        F.when(col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "(C) ").otherwise("(R) "),
        col("c_mktsegment"),
    )
    fuel = (
        F.when(col("c_mktsegment") == "MACHINERY", "Electric")
        .when(col("l_linestatus") == "F", "Electric")
        .otherwise("Natural Gas")
    )
    price = col("l_extendedprice")
    summed = (
        t.lines()
        .groupBy(
            meas.alias("meas"),
            col("state").alias("reg"),
            col("o_orderpriority").alias("bldg_type"),
            col("l_returnflag").alias("end_use"),
            fuel.alias("fuel"),
            F.year("l_shipdate").alias("year"),
        )
        .agg(
            F.sum(price).alias("e"),
            F.sum(price * col("l_discount")).alias("m"),
            F.sum(price * col("l_tax")).alias("v"),
            F.sum("l_quantity").alias("b"),
        )
    )
    packaged = col("meas").isin(*{p[0] for p in PACKAGES})
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), value.alias("value"))
            for name, value in zip(
                METRICS,
                (col("e"), col("m"), F.when(packaged, col("v")), col("b")),
                strict=True,
            )
        ]
    )
    return summed.select(*KEYS, F.inline(pairs)).filter(col("value").isNotNull())


ROWS_SQL = f"""{LINES_SQL},
summed AS (
  SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN '(C) ' ELSE '(R) ' END
      || c_mktsegment AS meas,
    state AS reg, o_orderpriority AS bldg_type, l_returnflag AS end_use,
    CASE WHEN c_mktsegment = 'MACHINERY' OR l_linestatus = 'F' THEN 'Electric'
      ELSE 'Natural Gas' END AS fuel,
    CAST(YEAR(l_shipdate) AS INTEGER) AS year, SUM(l_extendedprice) AS e,
    SUM(l_extendedprice * l_discount) AS m,
    CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN SUM(l_extendedprice * l_tax) END AS v,
    SUM(l_quantity) AS b
  FROM lines GROUP BY state, c_mktsegment, o_orderpriority, l_returnflag, fuel, YEAR(l_shipdate)),
packages(meas, meas_separated, component) AS (VALUES {", ".join(str(p) for p in PACKAGES)})"""


def weight_rows(t: Tables) -> DataFrame:
    """Weights of some measures and years."""
    return (
        t.orders()
        .filter(col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"))
        .filter(F.year("o_orderdate") >= 1998)
        .groupBy(
            F.concat(F.lit("(C) "), col("c_mktsegment")).alias("meas"),
            col("o_orderpriority").alias("bldg_type"),
            F.year("o_orderdate").alias("year"),
        )
        .agg(F.round(F.avg("o_totalprice") / 700000, 4).alias("gap_weight"))
    )


WEIGHTS_SQL = """
weights AS (
  SELECT '(C) ' || c_mktsegment AS meas, o_orderpriority AS bldg_type,
    CAST(YEAR(o_orderdate) AS INTEGER) AS year,
    ROUND(AVG(o_totalprice) / 700000, 4) AS gap_weight
  FROM placed_orders
  WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AND YEAR(o_orderdate) >= 1998
  GROUP BY ALL)"""


def documents(t: Tables, given: DataFrame | None = None, name: str = "reg") -> DataFrame:
    """One JSON document per state (or other column ``name``), nested like a scenario file.

    A document's size is fixed by its dimensions (types x uses x years), not by
    the number of line items behind it.
    """
    levels = ["adoption_scn", "metric", "reg", "bldg_type", "end_use"]
    rows = (scenario_rows(t) if given is None else given).withColumns(
        {
            "adoption_scn": F.lit("Max"),
            "doc": col(name),
            "year": col("year").cast("string"),
        }
    )
    no_fuel = col("meas") == "(R) MACHINERY"
    bodies = []
    for part, inner in ((rows.filter(~no_fuel), ["fuel", "year"]), (rows.filter(no_fuel), ["year"])):
        nested = _nest(part, ["doc", "meas", *levels, *inner], "value", down_to=2)
        bodies.append(nested.select("doc", "meas", F.to_json("value").alias("markets")))
    weights = _nest(
        weight_rows(t).withColumn("year", col("year").cast("string")),
        ["meas", "bldg_type", "year"],
        "gap_weight",
    ).select("meas", F.to_json("gap_weight").alias("weights"))
    measures = bodies[0].unionByName(bodies[1]).join(weights, "meas", "left")
    text = F.concat(
        F.to_json(F.array("meas")).substr(F.lit(2), F.length(F.to_json(F.array("meas"))) - 2),
        F.lit(': {"Markets and Savings (by Category)": '),
        col("markets"),
        F.coalesce(F.concat(F.lit(', "Gap Weights": '), col("weights")), F.lit("")),
        F.lit("}"),
    )
    return measures.groupBy(col("doc").alias("scenario")).agg(
        F.concat(
            F.lit("{"),
            F.concat_ws(", ", F.sort_array(F.collect_list(text))),
            F.lit(', "Energy Output Type": {"a": {"b": 1}}}'),
        ).alias("value")
    )


def _nest(df: DataFrame, keys: list[str], value: str, down_to: int = 1) -> DataFrame:
    """Fold the innermost keys into nested maps, down to ``down_to`` key columns."""
    for depth in range(len(keys) - 1, down_to - 1, -1):
        entry = F.struct(col(keys[depth]), col(value))
        df = df.groupBy(*keys[:depth]).agg(
            F.map_from_entries(F.collect_list(entry)).alias(value)
        )
    return df


UNPIVOT_SQL = "SELECT {0}, metric, value FROM (" + " UNION ALL ".join(
    f"SELECT *, '{m}' AS metric, {v} AS value FROM summed"
    for m, v in zip(METRICS, "emvb", strict=True)
) + ") WHERE value IS NOT NULL"


@query(
    "flatten_scenario",
    f"""
WITH {ROWS_SQL}
SELECT reg AS scenario, meas, 'Max' AS adoption_scn, metric, reg, bldg_type, end_use, fuel,
  year, ROUND(value, 4) AS value
FROM ({UNPIVOT_SQL.format(", ".join(KEYS))})
""",
)
def flatten_scenario(t: Tables):
    """Nested documents to rows; paths with and without a fuel level."""
    out = scenario.flatten_scenario(documents(t), keep=["scenario"])
    return rounded(out, {"value": 4})


RANGE_BYTES = 64 * 1024


def cut_measures(t: Tables) -> DataFrame:
    """The documents as files, read again in ranges much smaller than a document."""
    folder = f"{shared_folder(t.spark)}/documents-{uuid.uuid4().hex}"
    # one document a file, as scenario files are
    documents(t).repartition("scenario").write.partitionBy("scenario").text(folder)
    return ranges.read_measure_texts(t.spark, folder, keep=["scenario"], range_bytes=RANGE_BYTES)


@query(
    "flatten_scenario_ranges",
    f"""
WITH {ROWS_SQL}
SELECT reg AS scenario, meas, 'Max' AS adoption_scn, metric, reg, bldg_type, end_use, fuel,
  year, ROUND(value, 4) AS value
FROM ({UNPIVOT_SQL.format(", ".join(KEYS))})
""",
)
def flatten_scenario_ranges(t: Tables):
    """Every document read by many tasks, a range of bytes each."""
    out = scenario.flatten_scenario(cut_measures(t), "text", keep=["scenario"], cut=True)
    return rounded(out, {"value": 4})


@query(
    "scenario_weights_ranges",
    f"""
WITH {ROWS_SQL}, {WEIGHTS_SQL}
SELECT reg AS scenario, w.meas, w.bldg_type, w.year, gap_weight
FROM weights w JOIN (SELECT DISTINCT meas, reg FROM summed) USING (meas)
""",
)
def scenario_weights_ranges(t: Tables):
    """Weights from the measures that were cut out of ranges."""
    return scenario.gap_weights(cut_measures(t), "text", keep=["scenario"], cut=True)


@query(
    "flatten_scenario_dirty",
    f"""
WITH {ROWS_SQL}
SELECT reg AS scenario, meas, 'Max' AS adoption_scn, metric, reg, bldg_type, end_use, fuel,
  year, CASE WHEN year % 4 > 1 THEN ROUND(value, 4) END AS value, year % 4 = 0 AS not_a_number
FROM ({UNPIVOT_SQL.format(", ".join(KEYS))})
""",
)
def flatten_scenario_dirty(t: Tables):
    """A year that is ``null`` or the text ``NaN`` leaves the other years alone."""
    value = F.when(col("year") % 4 == 0, float("nan")).when(col("year") % 4 > 1, col("value"))
    rows = scenario_rows(t).withColumn("value", value)
    out = scenario.flatten_scenario(documents(t, rows), keep=["scenario"])
    no_number = F.coalesce(F.isnan("value"), F.lit(False))
    return out.withColumns({"not_a_number": no_number, "value": F.when(~no_number, F.round("value", 4))})


@query(
    "scenario_weights",
    f"""
WITH {ROWS_SQL}, {WEIGHTS_SQL}
SELECT reg AS scenario, w.meas, w.bldg_type, w.year, gap_weight
FROM weights w JOIN (SELECT DISTINCT meas, reg FROM summed) USING (meas)
""",
)
def scenario_weights(t: Tables):
    """Weights nested next to the categories."""
    return scenario.gap_weights(documents(t), keep=["scenario"])


@query(
    "flatten_json_props",
    """
SELECT event_id, 'k' AS key, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS value
FROM events
""",
)
def flatten_json_props(t: Tables):
    """JSON text of every event to key / value rows."""
    parsed = F.from_json(col("props"), "map<string,double>")
    return t("events").select("event_id", F.explode(parsed).alias("key", "value"))


def package_map(t: Tables) -> DataFrame:
    return t.literal(
        list(PACKAGES), "meas string, meas_separated string, component string"
    )


SPLIT_SQL = """
split AS (
  SELECT meas, reg, bldg_type, end_use, fuel, year, (e - m) / 3412 * 1e6 AS original_ann,
    m / 3412 * 1e6 AS measure_ann
  FROM summed WHERE v IS NULL
  UNION ALL
  SELECT meas_separated, reg, bldg_type, end_use, fuel, year,
    CASE component WHEN 'equipment' THEN (e - m) / 3412 * 1e6 WHEN 'equipment + env' THEN 0 END,
    CASE component WHEN 'equipment' THEN (m - v) / 3412 * 1e6
      WHEN 'equipment + env' THEN v / 3412 * 1e6 END
  FROM summed LEFT JOIN packages USING (meas) WHERE v IS NOT NULL)"""

LONG_SQL = f"""{ROWS_SQL}, {SPLIT_SQL},
stages AS (
  SELECT meas, reg, bldg_type, end_use, fuel, year, 'original_ann' AS tech_stage,
    original_ann AS state_ann_kwh, 'ref' AS turnover FROM split
  UNION ALL
  SELECT meas, reg, bldg_type, end_use, fuel, year, 'measure_ann', measure_ann, 'ref' FROM split
  UNION ALL
  SELECT COALESCE(meas_separated, meas), reg, bldg_type, end_use, fuel, year, 'original_ann',
    b / 3412 * 1e6, 'baseline'
  FROM summed LEFT JOIN (SELECT * FROM packages WHERE component = 'equipment') USING (meas)),
long AS (
  SELECT *, CASE WHEN contains(split_part(meas, ' ', 1), '(C)') THEN 'com'
      WHEN contains(split_part(meas, ' ', 1), 'Gap') THEN 'com'
      WHEN contains(split_part(meas, ' ', 1), '(R)') THEN 'res' END AS sector, 'r1' AS run_id
  FROM stages)"""


def long_rows(t: Tables) -> DataFrame:
    return scenario.annual_long(scenario_rows(t), package_map(t), "ref", "r1")


@query(
    "package_split",
    f"""
WITH {ROWS_SQL}, {SPLIT_SQL}
SELECT meas, reg, bldg_type, end_use, fuel, year, ROUND(original_ann, 2) AS original_ann,
  ROUND(measure_ann, 2) AS measure_ann
FROM split
""",
)
def package_split(t: Tables):
    """Packages split into equipment and envelope components."""
    metrics = {
        scenario.EFFICIENT: "efficient_mmbtu",
        scenario.MEASURE: "efficient_measure_mmbtu",
        scenario.ENVELOPE: "efficient_measure_env_mmbtu",
    }
    columns = scenario.metric_columns(scenario_rows(t), KEYS, metrics)
    out = scenario.package_split(columns, package_map(t), KEYS)
    return rounded(out, {"original_ann": 2, "measure_ann": 2})


@query(
    "metric_pivot_melt",
    f"""
WITH {LONG_SQL}
SELECT * REPLACE (ROUND(state_ann_kwh, 2) AS state_ann_kwh) FROM long
""",
)
def metric_pivot_melt(t: Tables):
    """Metrics to columns, columns to stages, baseline rows, sector and run tags."""
    return rounded(long_rows(t), {"state_ann_kwh": 2})


@query(
    "baseline_every_scenario",
    f"""
WITH {LONG_SQL}
SELECT * REPLACE (ROUND(state_ann_kwh, 2) AS state_ann_kwh) FROM long WHERE turnover = 'baseline'
UNION ALL
SELECT long.* REPLACE (ROUND(state_ann_kwh, 2) AS state_ann_kwh, t.turnover AS turnover)
FROM long JOIN (VALUES ('early'), ('late')) t(turnover) ON long.turnover = 'ref'
  AND CASE t.turnover WHEN 'early' THEN year <= 1996 ELSE year >= 1995 END
""",
)
def baseline_every_scenario(t: Tables):
    """Scenarios of different years: shared baseline rows once, the others united."""
    rows, packages = scenario_rows(t), package_map(t)
    parts = [
        scenario.annual_long(rows.filter(kept), packages, name, "r1")
        for name, kept in (("early", col("year") <= 1996), ("late", col("year") >= 1995))
    ]
    out = scenario.merge_baselines(parts)
    return rounded(out, {"state_ann_kwh": 2})


SPLIT_ROWS_SQL = f"""{LONG_SQL}, {WEIGHTS_SQL},
affected AS (
  SELECT l.*, COALESCE(gap_weight, 0) AS w
  FROM long l LEFT JOIN weights USING (meas, bldg_type, year)
  WHERE sector = 'com' AND fuel = 'Electric'),
after AS (
  SELECT * FROM long WHERE NOT COALESCE(sector = 'com' AND fuel = 'Electric', FALSE)
  UNION ALL
  SELECT * EXCLUDE (w) REPLACE ((1 - w) * state_ann_kwh AS state_ann_kwh) FROM affected
  UNION ALL
  SELECT * EXCLUDE (w) REPLACE ('Gap' AS meas, w * state_ann_kwh AS state_ann_kwh) FROM affected)"""


@query(
    "weighted_split",
    f"""
WITH {SPLIT_ROWS_SQL}
SELECT * REPLACE (ROUND(state_ann_kwh, 2) AS state_ann_kwh) FROM after
""",
)
def weighted_split(t: Tables):
    """Commercial electricity divided by weight; missing weights are 0."""
    return rounded(
        scenario.weighted_split(long_rows(t), weight_rows(t)), {"state_ann_kwh": 2}
    )


CONSERVED = ["reg", "bldg_type", "end_use", "fuel", "year", "tech_stage", "turnover", "sector", "run_id"]


def _conservation_sql(scope: str, where: str) -> str:
    keys = ", ".join(CONSERVED)
    text = ", ".join(f"CAST({k} AS VARCHAR) AS {k}" for k in CONSERVED)
    return f"""
  SELECT {text}, b, a, '{scope}' AS scope FROM (
    SELECT {keys}, SUM(b) AS b, SUM(a) AS a FROM (
      SELECT {keys}, state_ann_kwh AS b, 0 AS a FROM long WHERE {where}
      UNION ALL
      SELECT {keys}, 0, state_ann_kwh FROM after WHERE {where}) GROUP BY ALL)"""


def _conservation_total(scope: str, where: str) -> str:
    text = ", ".join(f"'ALL' AS {k}" for k in CONSERVED)
    return f"""
  SELECT {text}, (SELECT SUM(state_ann_kwh) FROM long WHERE {where}) AS b,
    (SELECT SUM(state_ann_kwh) FROM after WHERE {where}) AS a, '{scope}_TOTAL' AS scope"""


AFFECTED = "sector = 'com' AND fuel = 'Electric'"


@query(
    "split_conservation",
    f"""
WITH {SPLIT_ROWS_SQL},
pairs AS ({_conservation_sql("ALL_ROWS", "TRUE")} UNION ALL
  {_conservation_sql("COM_ELECTRIC_ONLY", AFFECTED)} UNION ALL
  {_conservation_total("ALL_ROWS", "TRUE")} UNION ALL
  {_conservation_total("COM_ELECTRIC_ONLY", AFFECTED)})
SELECT {", ".join(CONSERVED)}, ROUND(b, 1) AS kwh_before, ROUND(a, 1) AS kwh_after,
  ROUND(a - b, 1) + 0.0 AS delta, CASE WHEN b = 0 THEN 0 ELSE ROUND((a - b) / b, 6) + 0.0 END AS pct_delta, scope
FROM pairs
""",
)
def split_conservation(t: Tables):
    """The split loses nothing: sums before and after, with totals rows."""
    before = long_rows(t)
    after = scenario.weighted_split(before, weight_rows(t))
    out = rounded(
        scenario.split_conservation(before, after, CONSERVED),
        {"kwh_before": 1, "kwh_after": 1, "delta": 1, "pct_delta": 6},
    )
    # adding zero clears the sign of a negative zero, nothing else
    return out.withColumns({"delta": F.col("delta") + 0.0, "pct_delta": F.col("pct_delta") + 0.0})


# --- stock -------------------------------------------------------------------

STOCK_MEASURES = {
    "AUTOMOBILE": "(R) Ref. Case NG Heat, No Cooling",
    "BUILDING": "(R) ES HP, No Cooling (FS)",
    "FURNITURE": "(R) Ref. Case HP",
    "HOUSEHOLD": "(R) Best NG Heat",
    "MACHINERY": "(R) Ref. Case Resist. Heat, No Cooling (TS)",
}
MEASURE_SQL = "CASE c_mktsegment " + " ".join(
    f"WHEN '{s}' THEN '{m}'" for s, m in STOCK_MEASURES.items()
) + " END"


def stock_rows(t: Tables, base: str, measure: str) -> DataFrame:
    """Stock cells: baseline units of first lines, measure units of second ones."""
    name = F.lit(None).cast("string")
    for segment, text in STOCK_MEASURES.items():
        name = F.when(col("c_mktsegment") == segment, text).otherwise(name)
    number = col("l_linenumber")
    cells = (
        t.lines()
        .groupBy(
            col("o_orderstatus").alias("scenario"),
            F.year("l_shipdate").alias("year"),
            col("state").alias("reg"),
            name.alias("meas"),
            col("o_orderpriority").alias("bldg_type"),
            F.when(col("l_linestatus") == "F", "Electric").otherwise("Non-Electric").alias("fuel"),
        )
        .agg(
            F.sum(F.when(number <= 2, col("l_quantity")).otherwise(0.0)).alias("b"),
            F.sum(F.when(number > 4, col("l_quantity")).otherwise(0.0)).alias("m"),
        )
        .withColumn("end_use", F.lit(stock.HEATING))
    )
    keys = ["scenario", "year", "reg", "meas", "bldg_type", "end_use", "fuel"]
    return cells.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit(base).alias("metric"), col("b").alias("value")),
                F.struct(F.lit(measure).alias("metric"), col("m").alias("value")),
            )
        ),
    )


STOCK_SQL = f"""{LINES_SQL},
cells AS (
  SELECT o_orderstatus AS scenario, CAST(YEAR(l_shipdate) AS INTEGER) AS year, state AS reg,
    {MEASURE_SQL} AS meas, o_orderpriority AS bldg_type,
    CASE WHEN l_linestatus = 'F' THEN 'Electric' ELSE 'Non-Electric' END AS fuel,
    SUM(CASE WHEN l_linenumber <= 2 THEN l_quantity ELSE 0 END) AS b,
    SUM(CASE WHEN l_linenumber > 4 THEN l_quantity ELSE 0 END) AS m
  FROM lines GROUP BY ALL)"""
NO_COOL_SQL = ", ".join(f"'{m}'" for m in stock.NO_COOL_MEASURES)


@query(
    "stock_counts",
    f"""
WITH {STOCK_SQL},
counts AS (
  SELECT scenario, year, reg AS state, SUM(b) AS heating_units_total,
    SUM(CASE WHEN fuel = 'Electric' THEN CASE WHEN b > 0 THEN b WHEN b = 0 THEN m END END)
      AS heating_units_elec,
    SUM(CASE WHEN meas IN ({NO_COOL_SQL}) THEN 0
      WHEN contains(meas, 'No Cool') AND fuel = 'Electric' THEN m
      WHEN contains(meas, 'No Cool') AND fuel = 'Non-Electric' THEN 0 ELSE b END)
      AS cooling_units
  FROM cells GROUP BY ALL)
SELECT scenario, year, state, ROUND(heating_units_total, 2) AS heating_units_total,
  ROUND(heating_units_elec, 2) AS heating_units_elec, ROUND(cooling_units, 2) AS cooling_units,
  ROUND(heating_units_elec / NULLIF(heating_units_total, 0), 9) AS share_elec_heat,
  ROUND(cooling_units / NULLIF(heating_units_total, 0), 9) AS share_cooling
FROM counts
""",
)
def stock_counts(t: Tables):
    """Households: heating units, electric heating, cooling, and shares."""
    out = stock.household_counts(stock_rows(t, stock.BASE_UNITS, stock.MEASURE_UNITS))
    return rounded(
        out,
        {
            "heating_units_total": 2,
            "heating_units_elec": 2,
            "cooling_units": 2,
            "share_elec_heat": 9,
            "share_cooling": 9,
        },
    )


@query(
    "electric_share_buildings",
    f"""
WITH {STOCK_SQL},
served AS (
  SELECT scenario, reg, year, meas,
    SUM(CASE WHEN fuel = 'Electric' THEN b ELSE 0 END) AS eb,
    SUM(CASE WHEN fuel = 'Electric' THEN m ELSE 0 END) AS em, SUM(b) AS total
  FROM cells GROUP BY ALL),
shares AS (
  SELECT scenario, reg, year,
    SUM(CASE WHEN eb > 0 THEN eb - em ELSE 0 END) / NULLIF(SUM(total), 0) AS share_elec
  FROM served GROUP BY ALL),
division AS (
  SELECT o_orderpriority, CAST(YEAR(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n
  FROM placed_orders GROUP BY ALL),
allocation AS (
  SELECT o_orderpriority, state, COUNT(*) / 1000.0::DOUBLE AS s
  FROM placed_orders WHERE o_orderstatus = 'F' GROUP BY ALL),
spread AS (
  SELECT year, state, SUM(n * s) AS n_bldgs
  FROM division FULL JOIN allocation USING (o_orderpriority) GROUP BY ALL)
SELECT h.year, h.reg AS state, h.scenario, ROUND(n_bldgs, 4) AS N_bldgs,
  ROUND(n_bldgs * share_elec, 8) AS N_bldgs_elec_heat
FROM shares h LEFT JOIN spread p ON h.reg = p.state AND h.year = p.year
""",
)
def electric_share_buildings(t: Tables):
    """Commercial buildings by state, and those heated electrically."""
    out = stock.building_counts(
        stock_rows(t, stock.BASE_SERVED, stock.MEASURE_SERVED), *_allocation(t), ["o_orderpriority"]
    )
    return rounded(out, {"N_bldgs": 4, "N_bldgs_elec_heat": 8})


def _allocation(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Buildings by division and type, and the states' shares of them."""
    division = t.orders().groupBy(
        "o_orderpriority", F.year("o_orderdate").alias("year")
    ).agg(F.count(F.lit(1)).cast("double").alias("N_bldgs_CDIV"))
    allocation = (
        t.orders()
        .filter(col("o_orderstatus") == "F")
        .groupBy("o_orderpriority", col("state").alias("in.state"))
        .agg((F.count(F.lit(1)) / 1000.0).alias("cdiv_share"))
    )
    return division, allocation


def _stock_files(t: Tables) -> dict[str, DataFrame]:
    """Documents of all scenarios to counts to .tsv, read back."""
    rows = stock_rows(t, stock.BASE_UNITS, stock.MEASURE_UNITS).unionByName(
        stock_rows(t, stock.BASE_SERVED, stock.MEASURE_SERVED)
    )
    found = workflow.stock_tables(documents(t, rows, "scenario"), *_allocation(t), ["o_orderpriority"])
    layout = workflow.Layout(f"{shared_folder(t.spark)}/stock-{uuid.uuid4().hex}")
    paths = workflow.write_stock(found, layout)
    return {n: readers.read_delimited(t.spark, p, found[n].schema) for n, p in paths.items()}


@query("stock_pipeline_households", ORACLE["stock_counts"])
def stock_pipeline_households(t: Tables):
    """Households of all scenarios from their documents, through the .tsv file."""
    digits = {"heating_units_total": 2, "heating_units_elec": 2, "cooling_units": 2}
    return rounded(_stock_files(t)["households"], {**digits, "share_elec_heat": 9, "share_cooling": 9})


@query("stock_pipeline_buildings", ORACLE["electric_share_buildings"])
def stock_pipeline_buildings(t: Tables):
    """Commercial buildings of all scenarios from their documents, through the .tsv file."""
    return rounded(_stock_files(t)["buildings"], {"N_bldgs": 4, "N_bldgs_elec_heat": 8})


@query(
    "pivot_filled",
    f"""
WITH {STOCK_SQL}
SELECT scenario, reg, year,
  COALESCE(SUM(CASE WHEN fuel = 'Electric' THEN b END), 0) AS "Electric_base",
  COALESCE(SUM(CASE WHEN fuel = 'Electric' THEN m END), 0) AS "Electric_measure",
  COALESCE(SUM(CASE WHEN fuel = 'Propane' THEN b END), 0) AS "Propane_base"
FROM cells GROUP BY ALL
""",
)
def pivot_filled(t: Tables):
    """Pivot on two keys at once with missing cells filled."""
    rows = stock_rows(t, "base", "measure")
    return wide.pivot_filled(
        rows,
        ["scenario", "reg", "year"],
        ["fuel", "metric"],
        [("Electric", "base"), ("Electric", "measure"), ("Propane", "base")],
        "value",
    )
